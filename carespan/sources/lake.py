"""Canonical tables as Parquet: event tables partitioned by month of event.

``within`` is how operators restrict an event table to dates. On a table read back from the lake it
adds the month bounds too, so the scan opens only the months asked for.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.sources.schemas import COLUMNS, FACTS, schema_of
from carespan.sources.tables import Tables

MONTH = "event_month"
HEAVY = "heavy_person"


def gathered(rows: DataFrame, column: str) -> DataFrame:
    """Rows brought together by a partition column before a write.

    The rebalance hint sizes the tasks by what was shuffled: small months share one task, a large one is
    split over as many as its bytes ask for, so neither tiny files nor one overlong task come of it.
    """
    return rows.hint("rebalance", column)


def write_lake(tables: Tables, path: str, names=None) -> None:
    """Write canonical tables under ``path``, replacing what is there."""
    for name in names or COLUMNS:
        table = tables[name].select(*COLUMNS[name])
        if name in FACTS:
            table = gathered(table.withColumn(MONTH, F.date_format("event_date", "yyyy-MM")), MONTH)
            table.write.mode("overwrite").partitionBy(MONTH).parquet(f"{path}/{name}")
        else:
            table.write.mode("overwrite").parquet(f"{path}/{name}")


def open_lake(spark: SparkSession, path: str) -> Tables:
    """Tables written by ``write_lake``, with the declared schemas (no inference)."""

    def opener(name):
        schema = schema_of(name)
        if name in FACTS:
            schema = schema.add(MONTH, "string")
        return lambda: spark.read.schema(schema).parquet(f"{path}/{name}")

    return Tables({name: opener(name) for name in COLUMNS})


def heavy_people(tables: Tables, buckets: int, names=FACTS) -> DataFrame:
    """People with more rows of an event table than a quarter of an even bucket: person_id.

    A sketch of the most frequent values per table finds them in one pass and in bounded space; a table
    can have at most four times as many of them as buckets.
    """
    most = min(4 * buckets, 1000)
    found = []
    for name in (n for n in names if "person_id" in COLUMNS[n]):
        rows = tables[name].where("person_id IS NOT NULL").agg(
            F.count("*").alias("n"), F.expr(f"approx_top_k(person_id, {most}, {20 * most})").alias("top")
        )
        hits = rows.select("n", F.explode("top").alias("t"))
        found.append(hits.where(F.col("t.count") * (4 * buckets) > F.col("n")).select(F.col("t.item").alias("person_id")))
    return reduce(DataFrame.unionByName, found).distinct()


def save_bucketed(tables: Tables, database: str, buckets: int, names=None) -> None:
    """Save canonical tables in the catalog, those with a person bucketed on it, events also by month.

    Joins and groupings on the person then read co-located buckets and need no shuffle, and a query of a
    period opens the buckets of its months only. Before the write, rows are dealt as the buckets are, so
    a month has one file per bucket. People with a large share of an event table are named in a small
    table beside them, for joins that must not leave such a person to one task.
    """
    for name in names or COLUMNS:
        table = tables[name].select(*COLUMNS[name])
        if name in FACTS:
            table = table.withColumn(MONTH, F.date_format("event_date", "yyyy-MM"))
        if "person_id" in COLUMNS[name]:
            table = table.repartition(buckets, "person_id")
        writer = table.write.mode("overwrite").format("parquet")
        if name in FACTS:
            writer = writer.partitionBy(MONTH)
        if "person_id" in COLUMNS[name]:
            writer = writer.bucketBy(buckets, "person_id").sortBy("person_id")
        writer.saveAsTable(f"{database}.{name}")
    saved = [n for n in FACTS if names is None or n in names]
    if saved:
        heavy_people(tables, buckets, saved).write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{HEAVY}")


def open_bucketed(spark: SparkSession, database: str) -> Tables:
    """Tables saved by ``save_bucketed``; the few heavy people are read with the names of the tables."""
    heavy = None
    if spark.catalog.tableExists(f"{database}.{HEAVY}"):
        heavy = tuple(sorted(r["person_id"] for r in spark.read.table(f"{database}.{HEAVY}").collect()))
    return Tables({n: (lambda n=n: spark.read.table(f"{database}.{n}")) for n in COLUMNS}, heavy)


def within(events: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Events dated from ``start`` to ``end``, both included; either may be open."""
    for bound, compare in ((start, "__ge__"), (end, "__le__")):
        if bound is None:
            continue
        events = events.where(getattr(F.col("event_date"), compare)(F.lit(bound)))
        if MONTH in events.columns:
            events = events.where(getattr(F.col(MONTH), compare)(F.lit(f"{bound:%Y-%m}")))
    return events
