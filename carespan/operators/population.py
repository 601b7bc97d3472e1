"""People, their registrations and their validity-ranged links to facilities and teams."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.scalars import blank
from carespan.operators.units import in_scope, named, unit_keys
from carespan.setting import Setting
from carespan.sources.tables import Tables

PERSON = ["person_id", "name", "cns", "cpf", "sex_id"]


def valid_links(T: Tables, as_of: date) -> DataFrame:
    """Links in force: begun by ``as_of``, and ending after it."""
    return T["person_link"].where(
        (F.col("facility_valid_to") > F.lit(as_of)) & (F.col("valid_from") <= F.lit(as_of))
    )


def is_live() -> Column:
    return (F.col("deceased") == 0) & (F.coalesce(F.col("deleted"), F.lit(0)) == 0)


def live_persons(T: Tables) -> DataFrame:
    """People neither deceased nor deleted; a missing deletion mark counts as not deleted."""
    return T["person"].where(is_live())


def active_registrations(T: Tables, s: Setting) -> DataFrame:
    """Registrations not closed by an exit and not inactive."""
    still_in = T["exit_type"].where(F.col("marker") == s.codes.active_exit_marker)
    return T["registration"].where(F.col("inactive") == 0).join(still_in, "exit_type_id", "left_semi")


def linked_people(T: Tables, s: Setting, where: Column | None = None) -> DataFrame:
    """Live people with the facility and team of each link in force at a facility in scope.

    ``where`` may test the person's columns and ``birth_date``. The join on the registration comes
    first and the one on the person last, so the result is laid out by person and what follows
    (distinct rows, the join with practice flags) needs no further shuffle.
    """
    links = valid_links(T, s.as_of).where(in_scope(s)).select(
        "registration_id", "facility_id", "team_id"
    )
    registrations = T["registration"].select("registration_id", "person_id", "birth_date")
    people = links.join(registrations, "registration_id").join(
        live_persons(T).select(*PERSON), "person_id"
    )
    return people if where is None else people.where(where)


def linked_population(T: Tables, s: Setting) -> DataFrame:
    """Distinct person x birth date x facility x team, with names."""
    rows = unit_keys(linked_people(T, s), T, team="left").select(
        "person_id", "birth_date", "sex_id", "facility_id", "team_id"
    )
    return named(rows.distinct(), T, team="left")


def people_by_facility(T: Tables, s: Setting, where: Column | None = None) -> DataFrame:
    """Number of distinct linked people per facility id."""
    pairs = linked_people(T, s, where).select("facility_id", "person_id").distinct()
    return pairs.groupBy("facility_id").agg(F.count("*").alias("people"))


def latest_registration(T: Tables, s: Setting, where: Column | None = None, registrations=None) -> DataFrame:
    """One row per person: the newest registration (highest id), with its newest link in force, if any.

    An aggregate rather than a window: map tasks already reduce a person to one row, so a person with
    very many registrations costs no more than any other.
    """
    chosen = T["registration"] if registrations is None else registrations
    if where is not None:
        chosen = chosen.where(where)
    links = valid_links(T, s.as_of).select("registration_id", "link_id", "facility_id", "team_id")
    kept = [c for c in chosen.columns if c not in ("person_id", "registration_id")]
    newest = F.max(F.struct("registration_id", "link_id", "facility_id", "team_id", *kept))
    return (
        chosen.join(links, "registration_id", "left")
        .groupBy("person_id").agg(newest.alias("newest")).select("person_id", "newest.*")
    )


def with_units(df: DataFrame, T: Tables) -> DataFrame:
    """Add the names of facility and team where the ids are known, keeping every row."""
    facility = T["facility"].select("facility_id", F.col("facility_name").alias("unidade_saude"), "cnes")
    team = T["team"].select("team_id", F.col("team_name").alias("no_equipe"), F.col("ine").alias("nu_ine"))
    return df.join(facility, "facility_id", "left").join(team, "team_id", "left")


def contact_columns() -> list[Column]:
    """Name and documents as the lists show them: empty text for a missing document."""
    return [
        F.col("name").alias("nome"), blank(F.col("cns")).alias("cns"), blank(F.col("cpf")).alias("cpf"),
    ]
