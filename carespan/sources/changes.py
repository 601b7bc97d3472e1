"""Loading changes: what differs between two states of a table, and a lake that is brought up to its source.

Two states meet by key and row hash in one aggregate, which map tasks combine; rows that both have never
travel together with their texts, and no state is joined with the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.sources.lake import MONTH, gathered
from carespan.sources.published import Entry, Published
from carespan.sources.schemas import COLUMNS, FACTS, schema_of
from carespan.sources.tables import Tables

# Columns that name a row; in tables without them a row is known by all it holds.
KEYS = {"encounter": ("encounter_id",), "group_activity": ("activity_id", "practice_id")}
KINDS = ("inserted", "changed", "deleted")


def row_changes(new: DataFrame, old: DataFrame, key: tuple = ()) -> DataFrame:
    """Per key (per row, without one) that differs: the key columns, ``change`` and ``n``.

    A key that both states have, with other rows, is changed and counts the larger number of rows that
    differ; one that a single state has is inserted or deleted. Equal rows are counted, so one more copy of a row is
    a change, too. Missing values are values like others.
    """
    key = tuple(key) or tuple(new.columns)
    row = F.xxhash64(*[F.col(c) for c in sorted(new.columns)]).alias("_row")

    def side(df, sign):
        return df.select(*key, row, F.lit(sign).alias("_sign"))

    rows = side(new, 1).unionByName(side(old, -1)).groupBy(*key, "_row").agg(
        F.sum("_sign").alias("_more"), F.count_if(F.col("_sign") > 0).alias("_new"), F.count_if(F.col("_sign") < 0).alias("_old"),
    )
    keys = rows.groupBy(*key).agg(
        F.sum(F.greatest("_more", F.lit(0))).alias("_in"), F.sum(F.greatest(-F.col("_more"), F.lit(0))).alias("_out"),
        F.sum("_new").alias("_new"), F.sum("_old").alias("_old"),
    ).where("_in > 0 OR _out > 0")
    if len(key) == len(new.columns):  # without a key there is no telling what a row was before
        kind = F.when(F.col("_in") > 0, "inserted").otherwise("deleted")
    else:
        kind = F.when(F.col("_old") == 0, "inserted").when(F.col("_new") == 0, "deleted").otherwise("changed")
    return keys.select(*key, kind.alias("change"), F.greatest("_in", "_out").alias("n"))


def by_month(events: DataFrame) -> DataFrame:
    return events.withColumn(MONTH, F.date_format("event_date", "yyyy-MM"))


def lake(spark: SparkSession, root: str) -> Published:
    """The published lake under a folder."""
    return Published(spark, root, MONTH)


def load_changes(source: Tables, published: Published, names=None) -> dict[str, dict]:
    """Bring the lake to what the source holds, and publish all tables in one step.

    Event tables are compared by month: months whose fingerprint is that of the index are not written,
    those that the source has no rows of any more are dropped, and late rows show in the month they belong
    to. Other tables are written where they changed. Returns per table the months written, dropped and kept.
    """
    told = {}
    with published.refresh() as run:
        for name in names or COLUMNS:
            rows = source[name].select(*COLUMNS[name])
            if name in FACTS:
                told[name] = run.months(name, by_month(rows), gather=lambda df: gathered(df, MONTH))
            else:
                written = run.whole_if_changed(name, rows)
                told[name] = {"written": [None] * written, "dropped": [], "kept": [None] * (not written)}
    return told


def open_published(published: Published) -> Tables:
    """The tables of the newest load."""
    entries = published.index()

    def opener(name):
        schema = schema_of(name)
        if name in FACTS:
            schema = schema.add(MONTH, "string")
        return lambda: published.read(name, schema, entries)

    return Tables({name: opener(name) for name in COLUMNS})


def load_report(published: Published, name: str, before: int, after: int) -> DataFrame:
    """Rows inserted, changed and deleted between two loads of an event table, per month.

    Only months that the two indexes hold in different places are read. A row that moved to another month
    counts in both: deleted there, inserted here.
    """
    held = [{e.mes: e for e in published.index(n) if e.tabela == name} for n in (before, after)]

    def differing(side: int) -> list[Entry]:
        mine, other = held[side], held[1 - side]
        return [e for m, e in mine.items() if m not in other or other[m].run != e.run]

    old, new = (published.read(name, schema_of(name), differing(i)) for i in (0, 1))
    key = KEYS.get(name)
    month = F.date_format("event_date", "yyyy-MM").alias("mes")
    if key is None:
        changes = row_changes(new, old).select(month, "change", "n")
    else:
        changes = row_changes(new.select("*", month), old.select("*", month), (*key, "mes"))
    return changes.groupBy("mes").agg(
        *[F.coalesce(F.sum(F.when(F.col("change") == k, F.col("n"))), F.lit(0)).alias(k) for k in KINDS]
    ).select(F.lit(name).alias("tabela"), "mes", *KINDS)
