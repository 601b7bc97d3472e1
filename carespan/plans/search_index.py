"""Search in a written list by trigrams.

A list is written once, numbered, in blocks, with postings: for every run of three characters of the searched
columns, the places that hold it, per block. A search for three characters or more reads the postings of its own trigrams,
keeps the places that have all of them, opens the blocks of those, and tests the rows exactly. Shorter texts
are looked for in all rows, as every row may hold them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carespan.functions.scalars import blank
from carespan.operators.listing import ascending, numbered, search_rows

BLOCK_ROWS = 20_000
GRAM = 3
POSTINGS = "trigrama string, bloco bigint, lugares array<bigint>"


def grams(text: Column) -> Column:
    """The distinct runs of three characters of a text in lower case; none in a shorter one."""
    low = F.lower(text)
    places = F.when(F.length(low) >= GRAM, F.sequence(F.lit(1), F.length(low) - (GRAM - 1))).otherwise(
        F.array().cast("array<int>")
    )
    return F.array_distinct(F.transform(places, lambda i: F.substring(low, i, F.lit(GRAM))))


def write_search_list(rows: DataFrame, path: str, key: str, columns: tuple, block_rows: int = BLOCK_ROWS) -> "SearchList":
    """Write a list ordered by ``key`` with the postings of ``columns`` under a path that must not exist."""
    spark = rows.sparkSession
    placed = numbered(rows, *ascending(key), name="_lugar", first=0)
    placed = placed.withColumn("bloco", F.call_function("div", F.col("_lugar"), F.lit(block_rows)))
    placed.repartition("bloco").sortWithinPartitions("bloco", "_lugar").write.partitionBy("bloco").parquet(f"{path}/linhas")
    found = SearchList(spark, path, rows.schema, tuple(columns))
    every = F.array_distinct(F.flatten(F.array(*[grams(blank(F.col(c))) for c in columns])))
    postings = found.rows.select("bloco", "_lugar", F.explode(every).alias("trigrama")).groupBy("trigrama", "bloco").agg(
        F.array_sort(F.collect_list("_lugar")).alias("lugares")  # a block's rows at most
    )
    # in the order of trigrams, so that a reader skips what it doesn't ask for
    postings.repartitionByRange("trigrama", "bloco").sortWithinPartitions("trigrama", "bloco").write.parquet(f"{path}/trigramas")
    return found


@dataclass(frozen=True)
class SearchList:
    """Reader of a written list: ``columns`` are those that are searched."""

    spark: SparkSession
    path: str
    schema: StructType
    columns: tuple

    @property
    def rows(self) -> DataFrame:
        schema = StructType([*self.schema.fields]).add("_lugar", "long").add("bloco", "long")
        return self.spark.read.schema(schema).parquet(f"{self.path}/linhas")

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema(POSTINGS).parquet(f"{self.path}/trigramas")

    def candidates(self, text: str) -> DataFrame:
        """Places that hold all trigrams of a text of three characters or more: bloco, _lugar."""
        low = text.lower()
        asked = sorted({low[i:i + GRAM] for i in range(len(low) - GRAM + 1)})
        lists = self.postings.where(F.col("trigrama").isin(asked))
        shared = lists.groupBy("bloco").agg(F.collect_list("lugares").alias("all")).where(F.size("all") == len(asked))
        both = F.aggregate(F.slice("all", 2, len(asked)), F.col("all")[0], F.array_intersect)
        return shared.select("bloco", F.explode(both).alias("_lugar"))

    def search(self, text: str) -> DataFrame:
        """Rows with the text, in any case, in one of the searched columns."""
        names = self.schema.fieldNames()
        if len(text.lower()) < GRAM:
            return search_rows(self.rows, text, self.columns).select(*names)
        found = self.candidates(text)
        blocks = [r["bloco"] for r in found.select("bloco").distinct().collect()]  # one per block
        opened = self.rows.where(F.col("bloco").isin(blocks)).join(found, ["bloco", "_lugar"], "left_semi")
        return search_rows(opened, text, self.columns).select(*names)
