"""Operator 8: mixing sources to target weights by systematic sampling.

Within a source, each document's expected copies are added up along an order; one random offset is
added, and the document is emitted once per whole number that the sum crosses. Only built-in
expressions, aggregates, joins and bounded windows are used.

Sums are whole numbers in units of 1 / UNIT copies, so they are exact. The order is by size (by the
number of binary digits, then chunk, then size), which makes the words taken follow the target closely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.llm.common import settle, table

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
UNIT = 100_000_000
CHUNK_ROWS = 400
PAGE_CHUNKS = 1000
SEED = "mix"
HASH_HEX = 13  # hex digits of a hash that are used: 52 bits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def hashed(*parts: Column) -> Column:
    """A whole number from 0 to 2^52 - 1 made from texts by MD5."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined.cast("binary")), 1, HASH_HEX), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """Per source: n_rows, source_size, weight, target. `rows` has source and size.

    Sources in the order of their code points, null last, weigh `weights` in turn and share the sum of
    all sizes. A target stops at `max_copies` times its source's size; the excess goes to the others by
    weight until none is above. That fixed point is found at once: with sources sorted by limit over
    weight, those before the first that stays below its limit are at theirs.
    """
    # One row per source; its windows run over the list of sources, not over documents.
    sums = settle(rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size")))
    order = F.row_number().over(Window.orderBy(F.col("source").cast("binary").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (order % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * max_copies).cast("double")
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    after = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(F.col("source_size") * max_copies).over(before), F.lit(0))).cast(
        "double"
    ) / F.sum("weight").over(after)
    ranked = sums.withColumn("weight", weight).withColumn("level", level)
    free = F.min(F.when(F.col("level") * F.col("weight") <= limit, F.struct(limit / F.col("weight"), "level")))
    found = free.over(everything)["level"]
    return ranked.withColumn("free_level", found).withColumn(
        "target", F.least(limit, F.col("free_level") * F.col("weight"))
    ).drop("level", "free_level")


def copies(rows: DataFrame, weights: tuple = WEIGHTS, max_copies: int = MAX_COPIES, seed: str = SEED) -> DataFrame:
    """The rows (doc_id, row_key, source, size, ...) with source_size, target and `copies`.

    The rows of a source and number of digits are cut into chunks of about CHUNK_ROWS by a hash; the sum
    before a chunk comes from the sums of chunks, the sum within it from a window of bounded length. A hot
    source has more chunks, not larger ones. Expected copies are the source's target over its size, `max_copies` at most.
    """
    targets = settle(source_targets(rows, weights, max_copies))
    rate = F.least(F.lit(max_copies * UNIT), F.round(F.col("target") / F.col("source_size") * UNIT).cast("long"))
    targets = targets.select(
        F.col("source").alias("of_source"), "source_size", "target",
        F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0)).cast("long").alias("expected"),
        F.pmod(hashed(F.lit(seed), F.col("source")), F.lit(UNIT)).alias("offset"),
    )
    rows = rows.withColumn("digits", F.length(F.bin("size")))
    classes = rows.groupBy(F.col("source").alias("k_source"), F.col("digits").alias("k_digits")).agg(
        F.ceil(F.count("*") / CHUNK_ROWS).alias("chunks")
    )
    classes = settle(classes.join(targets, classes["k_source"].eqNullSafe(targets["of_source"])).drop("of_source"))
    rows = rows.join(classes, rows["source"].eqNullSafe(classes["k_source"]) & (rows["digits"] == classes["k_digits"]))
    chunked = rows.drop("k_source", "k_digits").withColumn(
        "chunk", F.pmod(hashed(F.lit(seed), F.col("doc_id")), F.col("chunks"))
    )
    # The sum before each chunk, over pages of chunks, so that no window grows with the source.
    page = F.floor(F.col("chunk") / PAGE_CHUNKS).alias("page")
    counts = chunked.groupBy("source", "digits", page, "chunk").agg(F.sum("expected").alias("chunk_sum"))
    pages = counts.groupBy("source", "digits", "page").agg(F.sum("chunk_sum").alias("page_sum"))
    earlier = (Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    page_start = F.coalesce(F.sum("page_sum").over(
        Window.partitionBy("source").orderBy("digits", "page").rowsBetween(*earlier)), zero)
    chunk_start = F.coalesce(F.sum("chunk_sum").over(
        Window.partitionBy("source", "digits", "page").orderBy("chunk").rowsBetween(*earlier)), zero)
    pages = pages.select(*[F.col(c).alias(f"p_{c}") for c in ("source", "digits", "page")], page_start.alias("page_start"))
    starts = counts.withColumn("chunk_start", chunk_start)
    starts = starts.join(pages, (
        starts["source"].eqNullSafe(pages["p_source"]) & (starts["digits"] == pages["p_digits"]) & (starts["page"] == pages["p_page"])
    )).select(
        F.col("source").alias("c_source"), F.col("digits").alias("c_digits"), F.col("chunk").alias("c_chunk"),
        (F.col("page_start") + F.col("chunk_start")).alias("start"),
    )
    within = F.sum("expected").over(
        Window.partitionBy("source", "digits", "chunk").orderBy("size", "doc_id", "row_key")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = chunked.withColumn("within", within)
    summed = summed.join(starts, (
        summed["source"].eqNullSafe(starts["c_source"]) & (summed["digits"] == starts["c_digits"])
        & (summed["chunk"] == starts["c_chunk"])
    ))
    crossed = F.expr(
        f"cast((offset + start + within) div {UNIT} - (offset + start + within - expected) div {UNIT} as int)"
    )
    return summed.withColumn("copies", crossed).drop(
        "digits", "chunk", "chunks", "within", "start", "expected", "offset", "c_source", "c_digits", "c_chunk"
    )


def mixed(docs: DataFrame, keep: tuple = ("doc_id",), weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The columns `keep` with size, source_size, target, taken and copies of every row.

    A null or empty text has size 0; a null source is a source, the last. A source without words has
    target 0 and gives nothing. Rows that repeat are told apart by nothing and may get different copies;
    which of them does is of no account. Reruns agree. An empty table gives none; other columns are
    ignored.
    """
    own = [f"__kept_{i}" for i in range(len(keep))]
    rows = docs.select(
        *[F.col(c).alias(o) for c, o in zip(keep, own)], F.col("source").cast("string").alias("source"),
        "doc_id", word_count(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("row_key"),
    )
    found = copies(settle(rows), weights, seed=seed)
    return found.select(
        *[F.col(o).alias(c) for c, o in zip(keep, own)], "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def mix_documents(docs: DataFrame, weights: tuple = WEIGHTS, seed: str = SEED) -> DataFrame:
    """The documents in the copies that the mix takes, with their own columns.

    The copies are settled on narrow rows, so the texts are shuffled once, to meet them. The copies of
    rows that repeat are shared out among them.
    """
    key = F.xxhash64("doc_id", "text")
    taken = settle(mixed(docs.select("doc_id", "text", "source", key.alias("key")), ("key",), weights, seed))
    taken = taken.groupBy(F.col("key").alias("__key")).agg(F.sum("copies").alias("__copies"), F.count("*").alias("__rows"))
    rows = docs.withColumn("__key", key)
    rows = rows.withColumn("__place", F.row_number().over(Window.partitionBy("__key").orderBy("__key")))
    share = F.expr("__copies div __rows + if(__place <= __copies % __rows, 1, 0)")
    rows = rows.join(taken, "__key").withColumn("__share", share).where("__share > 0")
    return rows.select(*docs.columns, F.explode(F.expr("sequence(1, cast(__share as int))")).alias("__copy")).drop("__copy")


def op8_mixing(spark, sf_dir) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"))


QUERIES = {"op8_mixing": op8_mixing}
SQL: dict[str, str] = {}
