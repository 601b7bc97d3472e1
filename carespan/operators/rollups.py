"""Roll-ups of team rows to units and the city."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.codes import BANDS, ENOUGH, GOOD, GREAT, REGULAR
from carespan.functions.scalars import band, ratio
from carespan.operators.ratio_indicators import access_and_contact_counts, first_dental_visits
from carespan.operators.units import in_scope, named, unit_keys
from carespan.setting import Setting
from carespan.sources.tables import Tables

UNIT_IDS = ["facility_id", "team_id"]


def rollup_units(teams: DataFrame, scale: int = 100) -> DataFrame:
    """Add up team rows per unit name; the value is worked out anew from the sums, 0 if there are none."""
    units = teams.groupBy("unidade_saude").agg(
        F.max("cnes").alias("cnes"), F.sum("numerator").alias("numerator"),
        F.sum("denominator").alias("denominator"),
    )
    return units.withColumn("value", ratio(F.col("numerator"), F.col("denominator"), scale, empty=0))


def first_visit_counts(T: Tables, s: Setting) -> DataFrame:
    """Distinct people with a first dental visit per team name in scope."""
    visits = first_dental_visits(T, s).where(in_scope(s)).select("person_id", *UNIT_IDS)
    people = unit_keys(visits, T).groupBy(*UNIT_IDS).agg(F.countDistinct("person_id").alias("numerator"))
    return named(people, T).withColumn("denominator", F.lit(None).cast("long"))


def city_summary(T: Tables, s: Setting) -> DataFrame:
    """Units and the city for C1, B1 and M1.

    The city's C1 and M1 are unweighted means of the unit values; its B1 is the sum over teams, so a
    person seen by two teams counts twice.
    """
    first = first_visit_counts(T, s).select(
        F.lit("b1").alias("indicador"), "unidade_saude", "cnes", "numerator", "denominator"
    )
    num, den = F.col("numerator"), F.col("denominator")
    value = F.when(F.col("indicador") == "c1", ratio(num, den, empty=0)).when(
        F.col("indicador") == "m1", ratio(num, den, scale=1, empty=0)
    )
    units = access_and_contact_counts(T, s).where("indicador <> 'm2'").select(*first.columns).unionByName(first).groupBy("indicador", "unidade_saude").agg(
        F.max("cnes").alias("cnes"), F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"),
    ).withColumn("value", value)
    label = F.lit(None).cast("string")
    parts = [units.select(
        "indicador", F.lit("unidade").alias("nivel"), "unidade_saude", "cnes", "numerator", "denominator", "value",
        label.alias("classificacao"),
    )]
    for name in ("c1", "b1", "m1"):
        valued = name != "b1"
        # unit values have two places, so their mean is one of whole hundredths
        hundredths = F.sum(F.round(F.col("value") * 100).cast("long"))
        mean: Column = ratio(hundredths, F.count("value") * 100, scale=1, empty=0) if valued else F.max("value")
        city = units.where(F.col("indicador") == name).agg(
            F.coalesce(F.sum("numerator"), F.lit(0)).alias("numerator"),
            F.sum("denominator").alias("denominator"), mean.alias("value"),
        )
        parts.append(city.select(
            F.lit(name).alias("indicador"), F.lit("municipio").alias("nivel"),
            label.alias("unidade_saude"), label.alias("cnes"), "numerator", "denominator", "value",
            (band(F.col("value"), BANDS[name]) if valued else label).alias("classificacao"),
        ))
    return reduce(DataFrame.unionByName, parts)


def band_distribution(indicators: DataFrame) -> DataFrame:
    """Teams per class and indicator; teams without data are not counted."""
    columns = {"otimo": GREAT, "bom": GOOD, "suficiente": ENOUGH, "regular": REGULAR}
    return indicators.groupBy("indicador").agg(
        *[F.count_if(F.col("classificacao") == label).alias(c) for c, label in columns.items()]
    )
