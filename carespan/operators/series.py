"""Figures for many dates in one pass.

**Yearly care at many period ends (C4 to C6).** The days are cut into cells at every end and at the first day of every
window that reaches back from one, so each window is a run of whole cells. Events are reduced to one state per
person and cell (kinds of care, number of visits, first and last visit), which map tasks combine; a frame
over a person's cells then merges the states of each window. A person has as many cells as there are cuts,
whatever the number of events.

**Linked people at many dates.** A link's validity is cut by month, so links and dates meet by equality of the
month, and the day decides within it: no range join, no nested loop.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from carespan.codes import STANDARD_BANDS
from carespan.functions.scalars import band, flag, ratio
from carespan.operators.marks import dose_marks, encounter_marks, procedure_marks, spread_enough, stacked, visit_marks
from carespan.operators.population import live_persons
from carespan.operators.practice_indicators import (
    LATELY, UNIT_IDS, YEAR, YEARLY, _linked_cohort, condition_people, older_people,
)
from carespan.operators.units import in_scope, named, unit_keys
from carespan.setting import Setting
from carespan.sources.tables import Tables

# kind of care -> (mark of an event, days that the window reaches back)
WINDOWS = {
    "seen": ("seen", YEAR), "seen_lately": ("seen", LATELY), "pressure_lately": ("pressure", LATELY),
    "weighed": ("weighed", YEAR), "weighed_by_team": ("weighed_by_team", YEAR), "hba1c": ("hba1c", YEAR),
    "diabetic_foot": ("diabetic_foot", YEAR), "influenza": ("influenza", YEAR),
}
MARKS = sorted({mark for mark, _ in WINDOWS.values()})


def _day(d: date) -> int:
    return (d - date(1970, 1, 1)).days


def cuts(ends) -> list[date]:
    """First days of the cells: the day after each end, and the first day of each window."""
    days = {e + timedelta(days=1) for e in ends}
    days |= {e - timedelta(days=back) for e in ends for back in (YEAR, LATELY)}
    return sorted(days)


def cell_of(day: Column, firsts: list[date]) -> Column:
    """The first day of a date's cell, found by halving."""
    if len(firsts) == 1:
        return F.lit(firsts[0])
    half = len(firsts) // 2
    return F.when(day < F.lit(firsts[half]), cell_of(day, firsts[:half])).otherwise(cell_of(day, firsts[half:]))


def care_cells(T: Tables, s: Setting, ends) -> DataFrame:
    """Per person and cell: which marks its events have, the visits, the first and the last of them."""
    start, end = min(ends) - timedelta(days=YEAR), max(ends)
    weighed, pressure = F.col("measured"), F.col("pressure")

    def marked(rows, *columns, **marks):
        return rows.select("person_id", "event_date", *[flag(test).alias(m) for m, test in marks.items()], *columns)

    encounters = encounter_marks(T, s, start, end, "med_nurse", "anthropometry").where(
        F.col("med_nurse") | weighed | pressure
    )
    visits = visit_marks(T, s, start, end, "community_agent", "anthropometry")
    visit_day = F.when(F.col("community_agent"), F.col("event_date")).alias("visit_day")
    procedures = procedure_marks(T, s, start, end, "weight_height", "blood_pressure", "hba1c", "diabetic_foot")
    doses = dose_marks(T, s, start, end, "influenza")
    by_team = weighed & F.col("anthropometry")
    events = stacked(
        marked(encounters, seen=F.col("med_nurse"), pressure=pressure, weighed=weighed, weighed_by_team=by_team),
        marked(visits, visit_day, pressure=pressure, weighed=weighed, weighed_by_team=by_team),
        marked(
            procedures, pressure=F.col("blood_pressure") == 1, weighed=F.col("weight_height") == 1,
            weighed_by_team=F.col("weight_height") == 1, hba1c=F.col("hba1c") == 1, diabetic_foot=F.col("diabetic_foot") == 1,
        ),
        marked(doses, influenza=F.col("influenza")),
    )
    cell = F.datediff(cell_of(F.col("event_date"), cuts(ends)), F.lit(date(1970, 1, 1)))
    return events.withColumn("day", cell).groupBy("person_id", "day").agg(
        *[F.max(m).alias(m) for m in MARKS], F.count("visit_day").alias("visits"),
        F.min("visit_day").alias("first"), F.max("visit_day").alias("last"),
    )


def yearly_care_series(T: Tables, s: Setting, people: DataFrame, ends) -> DataFrame:
    """The rows of ``people`` at each end of a period, with the kinds of care within the windows that end there.

    A row and end stands among the person's cells as one more, in whose frames the care is found, so the
    people are read once and joined with nothing.
    """
    points = F.explode(F.array(*[F.lit(_day(e)) for e in sorted(set(ends))]))
    asked = people.select("*", points.alias("day"), F.lit(True).alias("asked"))
    rows = care_cells(T, s, ends).unionByName(asked, allowMissingColumns=True)
    whole = Window.partitionBy("person_id").orderBy("day")
    # the cells of a window start in it, and none of them goes on beyond its end
    frames = {back: whole.rangeBetween(-back, Window.currentRow) for back in (YEAR, LATELY)}
    merged = rows.select(
        *people.columns, "day", "asked",
        *[F.coalesce(F.max(mark).over(frames[back]), F.lit(0)).alias(kind) for kind, (mark, back) in WINDOWS.items()],
        F.sum("visits").over(frames[YEAR]).alias("visits"), F.min("first").over(frames[YEAR]).alias("first"),
        F.max("last").over(frames[YEAR]).alias("last"),
    ).where("asked")
    visited = F.coalesce(flag(spread_enough("visits", "first", "last", s)), F.lit(0)).alias("visited")
    return merged.select(*people.columns, F.date_from_unix_date("day").alias("fim"), *WINDOWS, visited)


def yearly_series(T: Tables, s: Setting, ends) -> DataFrame:
    """C4, C5 and C6 at each of the period ends: end, indicator, team, practices done, people, value, class.

    The same rows as ``yearly_indicators`` with each period in turn; the events are read and shuffled once.
    The cohorts depend on the as-of date only.
    """
    older = _linked_cohort(T, s, older_people(s)).withColumn("indicador", F.lit("c6"))
    cohort = condition_people(T, s).unionByName(older)
    care = yearly_care_series(T, s, cohort, ends)
    points, practices = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, kinds in YEARLY.items():
        total = reduce(Column.__add__, [F.col(k) for k in kinds.values()])
        points = F.when(F.col("indicador") == name, total).otherwise(points)
        practices = F.when(F.col("indicador") == name, len(kinds)).otherwise(practices)
    counts = care.groupBy("fim", "indicador", *UNIT_IDS).agg(
        F.sum(points).alias("numerator"), F.count("*").alias("denominator")
    )
    value = ratio(F.col("numerator"), F.col("denominator") * practices)
    return named(counts, T, team="left").withColumn("value", value).withColumn(
        "classificacao", band(F.col("value"), STANDARD_BANDS)
    )


# ---- links in force at many dates ----


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def links_at(T: Tables, dates: DataFrame) -> DataFrame:
    """The links in force at each date of the column ``dia``: the links' columns and ``dia``.

    A link is in force from its first day up to the day before its last. Its months are cut to those
    that the dates span, which an aggregate over the dates tells, so an open end costs no more than the series is long.
    """
    dates = dates.select("dia").where("dia IS NOT NULL").distinct().withColumn("mes", _month(F.col("dia")))
    span = dates.agg(F.min("mes").alias("low"), F.max("mes").alias("high")).first()  # one row
    if span["low"] is None:
        return T["person_link"].withColumn("dia", F.lit(None).cast("date")).where("false")
    low, high = F.lit(span["low"]), F.lit(span["high"])
    start = F.greatest(_month(F.col("valid_from")), low)
    stop = F.least(_month(F.col("facility_valid_to")), high)
    cells = T["person_link"].where((start <= stop) & (F.col("valid_from") < F.col("facility_valid_to"))).withColumn(
        "mes", F.explode(F.sequence(start, stop))
    )
    in_force = (F.col("valid_from") <= F.col("dia")) & (F.col("facility_valid_to") > F.col("dia"))
    return cells.join(dates, "mes").where(in_force).drop("mes")


def population_series(T: Tables, s: Setting, dates: DataFrame) -> DataFrame:
    """Distinct linked people per team at facilities in scope, at each date: dia, team, people."""
    links = links_at(T, dates).where(in_scope(s)).select("dia", "registration_id", *UNIT_IDS)
    owners = T["registration"].select("registration_id", "person_id")
    live = live_persons(T).select("person_id")
    rows = links.join(owners, "registration_id").join(live, "person_id", "left_semi")
    people = unit_keys(rows, T, team="left").select("dia", *UNIT_IDS, "person_id").distinct()
    counts = people.groupBy("dia", *UNIT_IDS).agg(F.count("*").alias("pessoas"))
    return named(counts, T, team="left")
