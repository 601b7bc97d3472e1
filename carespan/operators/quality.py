"""Data-quality worklists: likely duplicates, placeholder names, stale pregnancies, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.codes import OPEN_END
from carespan.functions.scalars import blank, cns_valid, cpf_present, date_number, flag
from carespan.operators.population import (
    contact_columns, latest_registration, live_persons, valid_links, with_units,
)
from carespan.operators.units import facility_names
from carespan.setting import Setting, months_later
from carespan.sources.tables import Tables

MEMBER = ["paciente_id", "cns", "cpf", "no_equipe", "unidade_saude"]


def _profiles(T: Tables, s: Setting) -> DataFrame:
    """Live people with the data of their newest registration, if any."""
    newest = latest_registration(
        T, s, registrations=T["registration"].select("registration_id", "person_id", "birth_date")
    )
    people = live_persons(T).select("person_id", "name", "cns", "cpf").join(newest, "person_id", "left")
    return with_units(people, T).select(
        F.col("person_id").alias("paciente_id"), F.col("name").alias("nome"), "birth_date",
        *[blank(F.col(c)).alias(c) for c in MEMBER[1:]],
    )


def duplicate_persons(T: Tables, s: Setting) -> DataFrame:
    """Live people who share name and birth date, one row per person with the size of the group.

    The group is its name and birth date. Sizes are combined in map tasks. People meet the size of their
    group over both in a struct (where a missing name equals another), so the layout of the sizes does
    not serve and the skew rule can split a hot name.
    """
    people = _profiles(T, s).where(F.col("birth_date").isNotNull())
    sizes = people.groupBy("nome", "birth_date").agg(F.count("*").alias("quantidade"))
    group = F.struct("nome", "birth_date").alias("group")
    sizes = sizes.where(F.col("quantidade") > 1).select(group, "quantidade")
    return people.select("*", group).join(sizes, "group").select(
        F.lit("duplicados").alias("tipo"), "nome", F.col("birth_date").cast("string").alias("data_nascimento"),
        "quantidade", *MEMBER,
    )


def newborn_placeholder_names(T: Tables, s: Setting) -> DataFrame:
    """Live people still named "RN ..." (newborn of), in the shape of the duplicates."""
    people = _profiles(T, s).where(F.col("nome").rlike(r"(?i)^RN\s"))
    return people.select(
        F.lit("rn_de").alias("tipo"), "nome", blank(F.col("birth_date")).alias("data_nascimento"),
        F.lit(1).cast("long").alias("quantidade"), *MEMBER,
    )


def inconsistencies(T: Tables, s: Setting) -> DataFrame:
    return duplicate_persons(T, s).unionByName(newborn_placeholder_names(T, s))


def stale_pregnancies(T: Tables, s: Setting, months: int = 11) -> DataFrame:
    """Live people whose latest last-menstrual date of those ``months`` or more back is on record.

    A newer date does not cancel an old one: it is only the old ones that are compared.
    """
    cutoff = months_later(s.as_of, -months)
    lmp = F.col("lmp_date")
    dates = (
        T["encounter"].where((lmp != F.lit(OPEN_END)) & (lmp <= F.lit(cutoff)))
        .groupBy("person_id").agg(F.max("lmp_date").alias("lmp_date"))
    )
    newest = latest_registration(T, s, registrations=T["registration"].select("registration_id", "person_id"))
    people = live_persons(T).select("person_id", "name", "cns", "cpf")
    rows = dates.join(people, "person_id").join(newest, "person_id", "left")
    # days to months in hundredths of a day, so that the division is exact
    days = F.datediff(F.lit(s.as_of), lmp).cast("long") * 100
    return with_units(rows, T).select(
        F.col("person_id").alias("paciente_id"), date_number(lmp).alias("dum"),
        F.date_format(lmp, "yyyy-MM-dd").alias("dum_formatado"),
        F.call_function("div", days + 3043, F.lit(3044)).cast("int").alias("meses_desde_dum"),
        *contact_columns(), "unidade_saude", "no_equipe",
    )


def document_flags(T: Tables) -> DataFrame:
    """Per registration: whether the CPF is filled in and the health card number well formed."""
    cns = F.col("cns")
    return T["registration"].select(
        "registration_id", cpf_present(F.col("cpf")).alias("flag_cpf_presente"),
        flag(cns.isNotNull() & (F.trim(cns) != "")).alias("flag_cns_presente"),
        flag((F.length(cns) == 15) & (cns_valid(cns) == 1)).alias("flag_cns_valido"),
    )


def cns_quality(T: Tables, s: Setting, strict: bool = False) -> DataFrame:
    """Valid, invalid and missing card numbers of registrations, by facility of the links in force.

    Registrations without a link in force are counted under a missing facility.
    """
    links = valid_links(T, s.as_of).select("registration_id", "facility_id").distinct()
    cns = F.col("cns")
    missing = cns.isNull() | (F.trim(cns) == "")
    counts = (
        T["registration"].select("registration_id", "cns").join(links, "registration_id", "left")
        .groupBy("facility_id").agg(
            F.count_if(~missing & (cns_valid(cns, strict) == 1)).alias("validos"),
            F.count_if(~missing & (cns_valid(cns, strict) == 0)).alias("invalidos"),
            F.count_if(missing).alias("ausentes"),
        )
    )
    return counts.join(facility_names(T), "facility_id", "left").drop("facility_id")
