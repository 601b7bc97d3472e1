"""A corpus from raw documents to shards, in stages that each call one of the text operators.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of documents;
the last adds each document's shard and its slot there. Between stages the rows are written as Parquet
in the shared folder and read again, so a lost executor costs no more than its running tasks.

Nulls: a null text has no words, so the quality stage drops it; a null doc_id, lang or source is a value
like others. Repeated rows count as copies, of which the near-duplicate stage keeps one. Empty tables
pass through. Columns beside those of documents are carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carespan.llm.common import settle, table
from carespan.llm.decontamination import decontaminated
from carespan.llm.mixing import mix_documents
from carespan.llm.ngram_join import one_per_class
from carespan.llm.quality_rules import quality_filter
from carespan.llm.sharding import shard_documents
from carespan.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near enough to their language (operator 2)."""
    return quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group that similarity links (operator 3)."""
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 10)."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the copies that bring each source to its target (operator 8)."""
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; equal texts share a shard (operator 7)."""
    return shard_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

# SQL can't express the scheduling of the last stage; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a directory through all stages."""
    docs = table(tune(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
