"""Operator 7: shards of near equal size by longest-processing-time scheduling.

Groups (equal texts) stay together. They are dealt into blocks by a hash of their key; a block's
groups, sorted by size, each go to the least loaded of the block's bins through a heap. The bins of all
blocks, sorted by size, then go to the least loaded shard in the same way, with the loads of blocks
known. A task streams over its sorted groups and holds one heap; the driver sees one row per bin.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carespan.llm.common import settle, table

SHARDS = 8
MIN_BLOCKS = 32
BLOCK_GROUPS = 100_000
MAX_BLOCKS = 8192
CHUNK_ROWS = 500
LAW = "bytes"


def least_loaded(sizes: list[int], bins: int) -> list[int]:
    """The bin of each size, taken in the given order: always the least loaded, the lowest of equals."""
    heap = [(0, b) for b in range(bins)]
    placed = []
    for size in sizes:
        load, b = heap[0]
        heapq.heapreplace(heap, (load + size, b))
        placed.append(b)
    return placed


def _schedule(bins: int):
    """Bins of groups that arrive sorted by block, size (largest first) and key."""

    def run(batches):
        block, heap = None, []
        for batch in batches:
            blocks, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            placed = []
            for this, size in zip(blocks, sizes):
                if this != block:
                    block, heap = this, [(0, b) for b in range(bins)]
                load, b = heap[0]
                heapq.heapreplace(heap, (load + size, b))
                placed.append(b)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(placed, pa.int32())], names=[*batch.schema.names, "bin"]
            )

    return run


def group_shards(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Group key to shard. `groups` has one row per group: group_key (string), group_size (long).

    The number of blocks follows the number of groups, between MIN_BLOCKS and MAX_BLOCKS, so the bins
    that meet in the driver are bounded by MAX_BLOCKS * shards.
    """
    count = groups.count()
    blocks = max(MIN_BLOCKS, min(MAX_BLOCKS, -(-count // BLOCK_GROUPS)))
    block = F.pmod(F.xxhash64("group_key"), F.lit(blocks)).cast("int").alias("block")
    dealt = groups.select(block, "group_key", "group_size").repartition(blocks, "block").sortWithinPartitions(
        "block", F.desc("group_size"), "group_key"
    )
    binned = settle(dealt.mapInArrow(_schedule(shards), "block int, group_key string, group_size bigint, bin int"))
    # at most MAX_BLOCKS * shards rows
    loads = sorted(
        ((r["load"], r["block"], r["bin"]) for r in binned.groupBy("block", "bin").agg(F.sum("group_size").alias("load")).collect()),
        key=lambda r: (-r[0], r[1], r[2]),
    )
    placed = least_loaded([load for load, _, _ in loads], shards)
    final = binned.sparkSession.createDataFrame(
        [(block, b, shard) for (_, block, b), shard in zip(loads, placed)], "block int, bin int, shard int"
    )
    return binned.join(final, ["block", "bin"]).select("group_key", "shard")


def slots(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows with a gapless `slot` from 0 in each `shard`, in the order of chunk and `row_key`.

    A shard's rows are cut into chunks by a hash of the row key. Chunks are numbered by windows of
    bounded length; the rows before a chunk come from the counts of chunks.
    """
    chunks = max(1, -(-rows.count() // (CHUNK_ROWS * shards)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("row_key", F.lit(7)), F.lit(chunks)).cast("int"))
    counts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    # Counts of a shard's chunks, a thousand to a page, so that neither window grows without bound.
    paged = counts.withColumn("page", F.floor(F.col("chunk") / 1000))
    pages = paged.groupBy("shard", "page").agg(F.sum("n").alias("page_n"))
    before_page = pages.withColumn("page_start", F.sum("page_n").over(
        Window.partitionBy("shard").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ))
    within = paged.withColumn("start", F.sum("n").over(
        Window.partitionBy("shard", "page").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ))
    zero = F.lit(0).cast("long")
    starts = within.join(before_page, ["shard", "page"]).select(
        "shard", "chunk", (F.coalesce("page_start", zero) + F.coalesce("start", zero)).alias("start"),
    )
    place = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("row_key"))
    return rows.withColumn("place", place).join(starts, ["shard", "chunk"]).withColumn(
        "slot", F.col("start") + F.col("place") - 1
    ).drop("chunk", "place", "start")


def sharded(docs: DataFrame, shards: int = SHARDS, keep: tuple = ("doc_id",)) -> DataFrame:
    """The columns `keep` with size, text_crc32, law, shard, slot and grown_shard of every row.

    Size is the text's UTF-8 bytes plus 1. Null and empty texts have no bytes and form one group, like
    all equal texts; repeated rows belong to their text's group and get slots of their own. A group
    larger than a shard's share makes its shard larger than the others. `grown_shard` is null, as the law
    is `bytes`. An empty table gives none; other columns are ignored.
    """
    own = [f"__kept_{i}" for i in range(len(keep))]
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(
        *[F.col(c).alias(o) for c, o in zip(keep, own)],
        F.sha2(raw, 256).alias("group_key"), (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ).withColumn("row_key", F.xxhash64(*own, "group_key"))
    rows = settle(rows)
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("group_size"))
    placed = slots(rows.join(group_shards(groups, shards), "group_key"), shards)
    return placed.select(
        *[F.col(o).alias(c) for c, o in zip(keep, own)], "size", "text_crc32", F.lit(LAW).alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents with their own columns, `shard` and `slot` (which replace columns of these names).

    Shards and slots are settled on narrow rows; the texts are shuffled once, to meet them.
    """
    key = F.xxhash64("doc_id", "text")
    narrow = sharded(docs.select("doc_id", "text", key.alias("key")), shards, ("key",)).select("key", "shard", "slot")

    def placed(rows, *order):
        return rows.withColumn("__place", F.row_number().over(Window.partitionBy("__key").orderBy(*order)))

    left = placed(docs.drop("shard", "slot").withColumn("__key", key), "__key")
    right = placed(settle(narrow).withColumnRenamed("key", "__key"), "shard", "slot")
    return left.join(right, ["__key", "__place"]).drop("__key", "__place")


def op7_sharding(spark, sf_dir) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


QUERIES = {"op7_sharding": op7_sharding}
SQL: dict[str, str] = {}
