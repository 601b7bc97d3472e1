"""Operator 10: benchmark items found inside documents by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets; a partition fixes the overlap that is needed,
the length of its items' signatures and the least document that can hold them. A signature is the
smallest shingle hashes, one more than an item of that size may miss at the threshold: a document that
contains enough of the item holds at least one of them, so the search loses nothing. Candidates meet by
equal hashes in the partitions that the document is large enough for, then the exact shingles decide.
Built-in expressions, explodes and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import same, settle, table, text_key

WORDS = 5
PERCENT = 80


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.filter(F.split(lower, r"[ \t-\r]+"), lambda w: w != "")


def _starts(column: str) -> Column:
    """Where the shingles of a word list start; with fewer words the whole list is one, without none."""
    last = F.greatest(F.size(column) - (WORDS - 1), F.lit(1))
    return F.when(F.size(column) > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(column: str) -> Column:
    return F.transform(_starts(column), lambda i: F.xxhash64(F.slice(F.col(column), i, WORDS)))


def shingles(column: str) -> Column:
    """The distinct shingles as texts."""
    return F.array_distinct(
        F.transform(_starts(column), lambda i: F.array_join(F.slice(F.col(column), i, WORDS), " "))
    )


def indexed(items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Items (item_id, text) with their shingles, the overlap `needed` in their size partition, the signature."""
    rows = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0).select(
        "item_id", shingles("w").alias("shingles"), F.array_sort(F.array_distinct(shingle_hashes("w"))).alias("hashes")
    ).distinct()
    n = F.size("shingles")
    rows = rows.withColumns({
        "n_item_shingles": n, "needed": F.expr(f"(size(shingles) * {percent} + 99) div 100").cast("int"),
    })
    return rows.withColumn("signature", F.slice("hashes", F.lit(1), F.col("n_item_shingles") - F.col("needed") + 1))


def _leaking(docs: DataFrame, items: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_key, item_id, n_item_shingles, n_shared: items of which a text holds enough."""
    index = settle(indexed(items.select("item_id", "text"), percent))
    signature = index.select(
        "item_id", "needed", F.explode("signature").alias("hash")
    ).distinct()
    own = docs.select("doc_id", "text", text_key())
    hashed = own.select("doc_id", "text_key", words(F.col("text")).alias("w")).select(
        "doc_id", "text_key", F.size("w").alias("n_words"), F.explode(shingle_hashes("w")).alias("hash")
    )
    # A document of n words has n - 4 shingles at most.
    large_enough = F.greatest(F.col("n_words") - (WORDS - 1), F.lit(1)) >= F.col("needed")
    found = settle(
        hashed.join(signature, "hash").where(large_enough).select("doc_id", "text_key", "item_id").distinct()
    )
    holders = found.select("doc_id", "text_key").distinct()
    texts = own.join(holders, same(own, holders, "doc_id", "text_key"), "left_semi").dropDuplicates(["doc_id", "text_key"])
    held = texts.select("doc_id", "text_key", words(F.col("text")).alias("w")).select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), shingles("w").alias("doc_shingles")
    )
    pairs = found.join(held, found["doc_id"].eqNullSafe(held["d"]) & (found["text_key"] == held["k"]))
    pairs = pairs.join(index.select("item_id", "shingles", "n_item_shingles", "needed"), "item_id")
    shared = F.size(F.array_intersect("shingles", "doc_shingles"))
    pairs = pairs.withColumn("n_shared", shared).where(F.col("n_shared") >= F.col("needed"))
    return pairs.select(found["doc_id"], "text_key", "item_id", "n_item_shingles", "n_shared")


def leaks(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, item_id, n_item_shingles, n_shared, containment: items of which a document holds enough.

    One row per pair of ids. Documents or items without words are in no pair; an item of fewer than five
    words is found where it is a whole document. Repeated rows and copies of an id count once, with the
    largest overlap. Empty tables give no pairs; other columns are ignored.
    """
    pairs = _leaking(docs, items, percent)
    best = pairs.groupBy("doc_id", "item_id").agg(
        F.max(F.struct((F.col("n_shared") / F.col("n_item_shingles")).alias("containment"), "n_shared", "n_item_shingles")).alias("b")
    )
    return best.select(
        "doc_id", "item_id", F.col("b.n_item_shingles").cast("long").alias("n_item_shingles"),
        F.col("b.n_shared").cast("long").alias("n_shared"), F.col("b.containment").alias("containment"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that hold no item, with their own columns; one that shares the id of a leak stays."""
    bad = settle(_leaking(docs, items, percent).select("doc_id", "text_key").distinct())
    leaking = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["text_key"])
    return docs.join(bad, leaking, "left_anti")


def op10_decontamination(spark, sf_dir) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op10_decontamination": op10_decontamination}
SQL = {"op10_decontamination": f"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), doc_sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {WORDS - 1}], ' ') AS s
  FROM doc_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i) WHERE len(w) > 0
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark
), item_sets AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + {WORDS - 1}], ' ') AS s
  FROM item_words, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1)) AS i) WHERE len(w) > 0
), sizes AS (SELECT item_id, count(*) AS n FROM item_sets GROUP BY item_id),
shared AS (
  SELECT doc_id, item_id, count(*) AS k FROM doc_sets JOIN item_sets USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n AS n_item_shingles, k AS n_shared, k::DOUBLE / n::DOUBLE AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * k >= {PERCENT} * n
"""}
