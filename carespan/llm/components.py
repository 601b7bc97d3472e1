"""Connected components by alternating star steps (Kiveris et al. 2014), all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from carespan.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them. Edges run a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a > b").distinct()


def _round(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The settled edges after both steps, and what tells two states apart (observed while writing)."""
    state = Observation()
    seen = _small_star(_large_star(edges)).observe(
        state, F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")
    )
    return settle(seen), state.get


def gathered_roots(links: DataFrame) -> DataFrame:
    """Node to a smaller node of its component, after one round: what shares a root is connected."""
    edges, _ = _round(_oriented(links))
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Node to the smallest node of its component, for nodes that are not their component's smallest.

    `links` has columns a and b (long), in any direction, repeats and loops allowed. Each round is
    settled in the shared folder; the rounds grow with the logarithm of the longest chain. A node with
    very many links is combined in map tasks and its join is split by the engine.
    """
    edges, state = settle(_oriented(links)), None
    while True:
        edges, now = _round(edges)
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
