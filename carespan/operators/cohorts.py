"""Vulnerable-group cohorts and the population counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.codes import DISABILITY_LABELS
from carespan.functions.scalars import blank, cns_valid, cpf_present, flag, labels_of
from carespan.operators.population import (
    active_registrations, contact_columns, is_live, latest_registration, live_persons, valid_links,
    with_units,
)
from carespan.setting import Setting, months_later
from carespan.sources.lake import within
from carespan.sources.tables import Tables


def current_registrations(T: Tables, s: Setting, registrations: DataFrame) -> DataFrame:
    """Those with a link in force, and with a link to a root some row of which is in force.

    A root row is in force when its root validity covers the as-of date and it is alive and not moved;
    it may belong to another registration of the same root.
    """
    linked = valid_links(T, s.as_of).select("registration_id")
    roots = T["person_link"].where(
        (F.col("root_valid_to") > F.lit(s.as_of)) & (F.col("valid_from") <= F.lit(s.as_of))
        & (F.col("alive") == 1) & (F.col("moved") == 0)
    ).select("root_id")
    rooted = T["person_link"].select("registration_id", "root_id").join(roots, "root_id", "left_semi")
    return registrations.join(linked, "registration_id", "left_semi").join(
        rooted.select("registration_id"), "registration_id", "left_semi"
    )


def is_indigenous(s: Setting) -> Column:
    return F.col("race_id") == s.codes.indigenous_race


def is_foreign(s: Setting) -> Column:
    return F.col("nationality_id") == s.codes.foreign_nationality


def _cohort_rows(T: Tables, s: Setting, where: Column) -> DataFrame:
    """Active, current registrations fulfilling the condition: a row per link in force, with flags."""
    chosen = current_registrations(T, s, active_registrations(T, s).where(where))
    links = valid_links(T, s.as_of).select("registration_id", "link_id", "facility_id", "team_id")
    # only the cohort's encounters are told apart by person
    recent = within(T["encounter"], months_later(s.as_of, -12)).select("person_id").join(
        chosen.select("person_id"), "person_id", "left_semi"
    ).distinct()
    rows = (
        chosen.join(T["person"].select("person_id", "name"), "person_id")
        .join(recent.withColumn("seen", F.lit(1)), "person_id", "left")
        .join(links, "registration_id", "left")
    )
    return with_units(rows, T).withColumns({
        "flag_atendimento_recente": F.coalesce(F.col("seen"), F.lit(0)),
        "flag_vinculo_unidade": flag(F.col("link_id").isNotNull()),
        "flag_cpf_presente": cpf_present(F.col("cpf")),
    })


def indigenous_cohort(T: Tables, s: Setting) -> DataFrame:
    rows = _cohort_rows(T, s, is_indigenous(s)).join(T["ethnicity"], "ethnicity_id", "left")
    return rows.select(
        "cns", blank(F.col("cpf")).alias("cpf"), F.col("name").alias("nome"),
        blank(F.col("birth_date")).alias("data_nascimento"),
        blank(F.col("ethnicity_name")).alias("etnia"), blank(F.col("unidade_saude")).alias("unidade_saude"),
        blank(F.col("cnes")).alias("cnes"), blank(F.col("micro_area")).alias("microarea"),
        "flag_atendimento_recente", "flag_vinculo_unidade", "flag_cpf_presente",
    )


def foreigner_cohort(T: Tables, s: Setting, detail: bool = False) -> DataFrame:
    """Foreign nationals; ``detail`` is the mart form, with team and a real check of the card number."""
    rows = _cohort_rows(T, s, is_foreign(s)).join(T["country"], "country_id", "left")
    if not detail:
        return rows.select(
            "cns", blank(F.col("cpf")).alias("cpf"), F.col("name").alias("nome"),
            blank(F.col("birth_date")).alias("data_nascimento"),
            blank(F.col("country_name")).alias("pais_origem"),
            blank(F.col("unidade_saude")).alias("unidade_saude"), blank(F.col("cnes")).alias("cnes"),
            blank(F.col("micro_area")).alias("microarea"),
            "flag_atendimento_recente", "flag_vinculo_unidade", "flag_cpf_presente",
            F.lit(1).alias("flag_cns_valido"),
        )
    teamed = valid_links(T, s.as_of).where(F.col("team_id").isNotNull()).select("registration_id")
    rows = rows.join(
        teamed.distinct().withColumn("teamed", F.lit(1)), "registration_id", "left"
    )
    return rows.select(
        "cns", "cpf", F.col("name").alias("nome"), F.col("birth_date").alias("data_nascimento"),
        F.col("country_name").alias("pais_origem"), F.col("country_name").alias("pais_nascimento"),
        "unidade_saude", "cnes", F.col("nu_ine").alias("ine"), F.col("no_equipe").alias("equipe"),
        F.col("micro_area").alias("microarea"), "flag_atendimento_recente",
        F.coalesce(F.col("teamed"), F.lit(0)).alias("flag_vinculo_equipe"), "flag_cpf_presente",
        flag((F.length("cns") == 15) & (cns_valid(F.col("cns")) == 1)).alias("flag_cns_valido"),
    )


def cohort_totals(cohort: DataFrame, *flags: str) -> DataFrame:
    """One row: size of a cohort, and how many rows lack each flag."""
    lacking = [
        F.coalesce(F.sum(1 - F.col(f)), F.lit(0)).alias(f.replace("flag_", "sem_")) for f in flags
    ]
    return cohort.agg(F.count("*").alias("total"), *lacking)


def _one_per_person(T: Tables, s: Setting, chosen: DataFrame) -> DataFrame:
    rows = latest_registration(T, s, registrations=chosen)
    people = live_persons(T).select("person_id", "name", "cns", "cpf")
    return with_units(rows.join(people, "person_id"), T)


def homeless_cohort(T: Tables, s: Setting) -> DataFrame:
    """Live people with a registration marked homeless, one row each."""
    chosen = T["registration"].where(F.col("homeless") == 1)
    chosen = chosen.select("registration_id", "person_id", "birth_date")
    return _one_per_person(T, s, chosen).select(
        F.col("person_id").alias("paciente_id"), *contact_columns(),
        blank(F.col("birth_date")).alias("data_nascimento"), "unidade_saude", "no_equipe",
    )


DISABILITY_KINDS = {"fisica": "dis_physical", "mental": "dis_cognitive"}


def disability_cohort(T: Tables, s: Setting, kind: str) -> DataFrame:
    """Live people with an active registration marked with the disability, and all their labels."""
    if kind not in DISABILITY_KINDS:
        raise ValueError("kind must be 'fisica' or 'mental'")
    flags = list(DISABILITY_LABELS)
    chosen = active_registrations(T, s).where(F.col(DISABILITY_KINDS[kind]) == 1)
    chosen = chosen.select("registration_id", "person_id", "birth_date", *flags)
    return _one_per_person(T, s, chosen).select(
        *contact_columns(), blank(F.col("birth_date")).alias("data_nascimento"),
        blank(F.col("unidade_saude")).alias("unidade_saude"), blank(F.col("no_equipe")).alias("equipe"),
        *flags, labels_of(DISABILITY_LABELS).alias("tipos_deficiencia"),
    )


def population_stats(T: Tables, s: Setting) -> DataFrame:
    """Six totals in one row.

    Every part is counted on its own into the same columns and the parts are added up, so no row ever
    meets another but in a sum.
    """
    names = [
        "total_cidadaos", "total_morador_rua", "total_estrangeiros", "total_indigenas",
        "total_def_fisica", "total_def_mental",
    ]

    def part(df, **columns):
        return df.agg(*[columns.get(n, F.lit(0).cast("long")).alias(n) for n in names])

    def counted(condition):
        return F.count_if(condition)

    people = part(T["person"], total_cidadaos=counted(is_live()))
    live = live_persons(T).select("person_id")
    homeless = T["registration"].where(F.col("homeless") == 1).select("person_id").distinct()
    homeless = part(
        homeless.join(live, "person_id", "left_semi"), total_morador_rua=F.count("*")
    )
    physical, cognitive = F.col("dis_physical") == 1, F.col("dis_cognitive") == 1
    active = active_registrations(T, s)
    groups = part(
        current_registrations(T, s, active.where(is_foreign(s) | is_indigenous(s))),
        total_estrangeiros=counted(is_foreign(s)), total_indigenas=counted(is_indigenous(s)),
    )
    linked = valid_links(T, s.as_of).select("registration_id")
    disabled = active.where(physical | cognitive).join(linked, "registration_id", "left_semi")
    disabled = part(
        disabled.join(live, "person_id", "left_semi"),
        total_def_fisica=counted(physical), total_def_mental=counted(cognitive),
    )
    stacked = people.unionByName(homeless).unionByName(groups).unionByName(disabled)
    return stacked.agg(*[F.sum(n).alias(n) for n in names])
