"""Narrow views of the event tables: who, when, and which kinds of care the row stands for.

Each function prunes to a few columns, cuts to the dates asked for, and joins the occupation or
procedure code table once for all code sets, so a practice is later one conditional aggregate.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.scalars import date_number, lists_any, starts_with_any
from carespan.operators.ratio_indicators import procedures_of
from carespan.setting import Setting
from carespan.sources.lake import within
from carespan.sources.tables import Tables

def with_occupation(events: DataFrame, T: Tables, s: Setting, *sets: str) -> DataFrame:
    """Add one boolean per occupation set; false for an occupation without a row."""
    marks = T["occupation"].select(
        "occupation_id", *[starts_with_any(F.col("cbo"), getattr(s.codes, n)).alias(n) for n in sets]
    )
    known = [F.coalesce(F.col(n), F.lit(False)) for n in sets]
    return events.join(marks, "occupation_id", "left").withColumns(dict(zip(sets, known))).drop("occupation_id")


def encounter_marks(T: Tables, s: Setting, start: date | None, end: date | None, *sets: str) -> DataFrame:
    """Encounters with one boolean per named occupation set."""
    events = within(T["encounter"], start, end).select(
        "person_id", "event_date", "occupation_id", "icd_codes", "icpc_codes",
        (F.col("systolic").isNotNull() | F.col("diastolic").isNotNull()).alias("pressure"),
        (F.col("weight").isNotNull() & F.col("height").isNotNull()).alias("measured"),
    )
    return with_occupation(events, T, s, *sets)


def visit_marks(T: Tables, s: Setting, start: date | None, end: date | None, *sets: str) -> DataFrame:
    """Home visits with one boolean per named occupation set."""
    events = within(T["home_visit"], start, end).select(
        "person_id", "event_date", "occupation_id",
        F.col("blood_pressure").isNotNull().alias("pressure"),
        (F.col("weight").isNotNull() & F.col("height").isNotNull()).alias("measured"),
        F.coalesce(
            (F.col("newborn_followup") == 1) | (F.col("child_followup") == 1), F.lit(False)
        ).alias("child_visit"),
    )
    return with_occupation(events, T, s, *sets)


def procedure_marks(T: Tables, s: Setting, start: date | None, end: date | None, *sets: str) -> DataFrame:
    """Procedures of the named sets, one 0/1 column each."""
    listed = procedures_of(T, **{n: getattr(s.codes, n) for n in sets})
    events = within(T["procedure_event"], start, end).select("person_id", "event_date", "procedure_id")
    return events.join(listed, "procedure_id").drop("procedure_id")


def dose_marks(T: Tables, s: Setting, start: date | None, end: date | None, *sets: str) -> DataFrame:
    """Vaccinations that list a code of the named sets, one boolean per set."""
    marks = [lists_any(F.col("vaccine_codes"), getattr(s.codes, n)).alias(n) for n in sets]
    rows = within(T["vaccination"], start, end).select("person_id", "event_date", *marks)
    return rows.where(reduce(Column.__or__, [F.col(n) for n in sets]))


def stacked(*parts: DataFrame) -> DataFrame:
    """Union by name; a column that a part lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def events_of(people: DataFrame, *events: DataFrame, heavy: tuple[int, ...] | None = None) -> DataFrame:
    """Join people (one or few rows each) with their events, whose tables are stacked.

    Where nobody looked for heavy people, the key is the person in a struct, so that neither side's layout serves:
    both reach the join through exchanges of their own, which is what the session's skew rule can split where a
    person has very many events.

    Where the heavy people are known, all others join by the plain key, table by table, so events that are
    bucketed by person stay where they are; only events of the named people take the way through exchanges.
    Either way the events of the people asked for are then combined in map tasks.
    """
    if heavy is None:
        return _split_join(people, stacked(*events))
    named = F.col("person_id").isin(*heavy) if heavy else F.lit(False)
    parts = [e.where(F.col("person_id").isNotNull() & ~named).join(people, "person_id") for e in events]
    if heavy:
        parts.append(_split_join(people.where(named), stacked(*[e.where(named) for e in events])))
    return stacked(*parts)


def _split_join(people: DataFrame, events: DataFrame) -> DataFrame:
    named = events.where(F.col("person_id").isNotNull()).withColumn("who", F.struct("person_id"))
    who = people.withColumn("who", F.struct("person_id")).drop("person_id")
    return named.join(who, "who").drop("who")


def spread_enough(visits: str, first: str, last: str, s: Setting) -> Column:
    """Two visits or more, the last at least 30 days after the first."""
    if s.gap_mode == "days":
        gap = F.datediff(F.col(last), F.col(first))
    else:
        gap = date_number(F.col(last)) - date_number(F.col(first))
    return (F.col(visits) >= 2) & (gap >= 30)
