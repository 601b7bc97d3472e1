"""Facilities and teams: scope, names, and one id per distinct name.

Event tables are grouped by the ids of facility and team, and the names join the grouped rows. Where
results are distinct by name, ``unit_keys`` first maps every id to the lowest id that bears the same
names, so the wide text never travels through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from carespan.functions.scalars import in_list, valid_team
from carespan.setting import Setting
from carespan.sources.tables import Tables

FACILITY = ["unidade_saude", "cnes"]
TEAM = FACILITY + ["no_equipe", "nu_ine"]


def in_scope(s: Setting, facility: Column | None = None) -> Column:
    """The facility is one of those reported on."""
    facility = F.col("facility_id") if facility is None else facility
    return facility.isNotNull() if s.scope is None else in_list(facility, s.scope)


def facility_names(T: Tables) -> DataFrame:
    return T["facility"].select(
        "facility_id", F.col("facility_name").alias("unidade_saude"), "cnes"
    )


def team_names(T: Tables, valid_only: bool = False) -> DataFrame:
    names = T["team"].select(
        "team_id", F.col("team_name").alias("no_equipe"), F.col("ine").alias("nu_ine")
    )
    return names.where(valid_team(F.col("no_equipe"))) if valid_only else names


def named(df: DataFrame, T: Tables, team: str | None = "inner", valid_only: bool = False) -> DataFrame:
    """Replace facility and team ids by their names. ``team`` is the join kind, None for no team."""
    df = df.join(facility_names(T), "facility_id").drop("facility_id")
    if team:
        df = df.join(team_names(T, valid_only), "team_id", team).drop("team_id")
    return df


def _lowest_ids(dimension: DataFrame, key: str, *names: str) -> DataFrame:
    """Each id of a dimension with the lowest id of the same names (NULLs count as the same)."""
    return dimension.select(key, F.min(key).over(Window.partitionBy(*names)).alias("_lowest"))


def unit_keys(df: DataFrame, T: Tables, team: str | None = "inner") -> DataFrame:
    """Map facility and team ids to one id per distinct name; ids without a row drop out.

    With ``team="left"`` rows without a known team stay, their team id is NULL; with None teams are
    left as they are.
    """
    facilities = _lowest_ids(T["facility"], "facility_id", "facility_name", "cnes")
    df = df.join(facilities, "facility_id").drop("facility_id")
    df = df.withColumnRenamed("_lowest", "facility_id")
    if team is None:
        return df
    teams = _lowest_ids(T["team"], "team_id", "team_name", "ine")
    df = df.join(teams, "team_id", team).drop("team_id")
    return df.withColumnRenamed("_lowest", "team_id")


def facilities(T: Tables, s: Setting) -> DataFrame:
    """Facilities in scope."""
    return T["facility"].where(in_scope(s)).select(
        F.col("facility_id").alias("id"), F.col("facility_name").alias("nome"), "cnes"
    )


def active_teams(T: Tables, s: Setting) -> DataFrame:
    """Teams with a real national identifier and some encounter at a facility in scope."""
    seen = T["encounter"].where(in_scope(s)).select("team_id", "facility_id").distinct()
    real = T["team"].where(F.col("ine").isNotNull() & (F.col("ine") != "-"))
    return (
        seen.join(real, "team_id").join(facility_names(T), "facility_id")
        .select(
            F.col("team_id").alias("id"), F.col("team_name").alias("nome"),
            "ine", F.col("unidade_saude").alias("unidade"),
        )
        .distinct()
    )
