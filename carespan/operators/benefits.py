"""Health conditions of the cash-transfer benefit: who has which check pending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.scalars import blank, flag
from carespan.operators.listing import filter_unit
from carespan.operators.marks import encounter_marks, stacked
from carespan.operators.population import live_persons, valid_links, with_units
from carespan.setting import Setting, months_later
from carespan.sources.lake import within
from carespan.sources.tables import Tables

PENDING = ["pendencia_consulta", "pendencia_vacina", "pendencia_peso_altura", "pendencia_prenatal"]


def beneficiaries(T: Tables) -> DataFrame:
    """Live people whose CPF is on the newest benefit roll, with the name on the roll."""
    roll = T["benefit_roll"].where(F.col("document_type") == "CPF")
    newest = T["benefit_roll"].agg(F.max("cycle")).scalar()
    documents = roll.where(F.col("cycle") == newest).groupBy(F.col("document").alias("cpf")).agg(
        F.min("roll_name").alias("nome_bolsa")
    )
    return live_persons(T).select("person_id", "name", "cns", "cpf").join(documents, "cpf")


def _named(rows: DataFrame, people: list[int] | None) -> DataFrame:
    """The rows of some people, of all if none are named."""
    return rows if people is None else rows.where(F.col("person_id").isin(people))


def _current_units(T: Tables, s: Setting, people: list[int] | None) -> DataFrame:
    """Per person: earliest birth date on record, and the unit of the newest link in force."""
    owners = _named(T["registration"].select("registration_id", "person_id", "birth_date"), people)
    links = valid_links(T, s.as_of).select(
        "registration_id", "valid_from", "link_id", "facility_id", "team_id"
    )
    link = F.struct("valid_from", "link_id", "facility_id", "team_id")
    rows = owners.join(links, "registration_id", "left").groupBy("person_id").agg(
        F.min("birth_date").alias("birth_date"),
        F.max(F.when(F.col("link_id").isNotNull(), link)).alias("link"),
    )
    return rows.select("person_id", "birth_date", "link.facility_id", "link.team_id")


def _care(T: Tables, s: Setting, people: list[int] | None) -> DataFrame:
    """Per person: what happened within the months that each condition looks back."""

    def since(months):
        return F.col("event_date") >= F.lit(months_later(s.as_of, -months))

    year = months_later(s.as_of, -12)
    encounters = encounter_marks(T, s, year, None, "med_nurse_benefit").select(
        "person_id", flag(since(6)).alias("seen"), flag(F.col("measured")).alias("weighed"),
        flag(F.col("med_nurse_benefit") & since(3)).alias("prenatal"),
    ).where((F.col("seen") == 1) | (F.col("weighed") == 1))
    doses = within(T["vaccination"], year).select("person_id", F.lit(1).alias("dose"))
    ended = F.col("puerperium_end")
    pregnancies = T["pregnancy"].where(
        F.col("start_date").isNotNull() & (ended.isNull() | (ended >= F.lit(s.as_of)))
    ).select("person_id", F.lit(1).alias("pregnant"))
    parts = [encounters, doses, pregnancies]
    parts = [_named(p, people) for p in parts]
    kinds = ["seen", "weighed", "prenatal", "dose", "pregnant"]
    return stacked(*parts).groupBy("person_id").agg(
        *[F.max(F.coalesce(F.col(k), F.lit(0))).alias(k) for k in kinds]
    )


def benefit_conditions(T: Tables, s: Setting, people: list[int] | None = None) -> DataFrame:
    """Beneficiaries with their unit and four pending-check flags.

    ``people`` limits the work to the person ids of a page. They are a filter on every table, so a page
    groups no one else's history.
    """
    rows = _named(beneficiaries(T), people).join(_current_units(T, s, people), "person_id", "left").join(
        _care(T, s, people), "person_id", "left"
    )

    def lacks(kind):
        return F.coalesce(F.col(kind), F.lit(0)) == 0

    child = F.coalesce(F.col("birth_date") >= F.lit(months_later(s.as_of, -84)), F.lit(False))
    return with_units(rows, T).select(
        "person_id", "nome_bolsa", F.col("name").alias("nome_esus"), blank(F.col("cpf")).alias("cpf"),
        blank(F.col("cns")).alias("cns"), F.col("birth_date").alias("dt_nascimento"),
        F.col("unidade_saude").alias("no_unidade_saude"), F.col("cnes").alias("nu_cnes"), "no_equipe",
        flag(lacks("seen")).alias("pendencia_consulta"),
        flag(child & lacks("dose")).alias("pendencia_vacina"),
        flag(child & lacks("weighed")).alias("pendencia_peso_altura"),
        flag((F.col("pregnant") == 1) & lacks("prenatal")).alias("pendencia_prenatal"),
    )


def benefit_page(
    T: Tables, s: Setting, after_id: int = 0, size: int = 500, unit: str | None = None, conditions: DataFrame | None = None,
) -> DataFrame:
    """The next ``size`` beneficiaries by person id after ``after_id``.

    Paging by key: a page costs the same wherever it lies. The ids of the page, ``size`` at most, are
    picked first and named to every scan. With a unit filter the conditions come first, as the unit
    decides who is listed; a reader of many such pages gives the written ``conditions`` to page over.
    """
    if unit is not None or conditions is not None:
        rows = benefit_conditions(T, s) if conditions is None else conditions
        rows = rows if unit is None else filter_unit(rows, unit, "no_unidade_saude", "nu_cnes")
        return rows.where(F.col("person_id") > after_id).orderBy("person_id").limit(size)
    ids = beneficiaries(T).select("person_id").where(F.col("person_id") > after_id)
    page = [r["person_id"] for r in ids.orderBy("person_id").limit(size).collect()]
    return benefit_conditions(T, s, page)


def benefit_totals(conditions: DataFrame, page_size: int = 500, counted: Column | None = None) -> DataFrame:
    """One row: beneficiaries, pages, pending checks by kind and in all.

    ``counted`` is the number of beneficiaries where rows are counts already.
    """
    counted = F.count("*") if counted is None else F.coalesce(counted, F.lit(0).cast("long"))
    sums = conditions.agg(
        counted.alias("total"),
        *[F.coalesce(F.sum(p), F.lit(0)).alias(p) for p in PENDING],
    )
    pages = F.call_function("div", F.col("total") + (page_size - 1), F.lit(page_size))
    return sums.withColumns({
        "total_pendencias": sum((F.col(p) for p in PENDING[1:]), F.col(PENDING[0])),
        "total_paginas": F.greatest(F.lit(1).cast("long"), pages),
    })
