"""Operator 1: secrets in texts, told apart by how widely the corpus owns them.

Candidates are found in every whole text and hashed. Per hash the corpus gives the distinct
repositories and owners that hold it: a value that many owners or many repositories hold is a copied
example, one that few repositories of a single owner hold and that looks random is taken for a live
credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import SPAN, map_texts, settle, spans_text, table

KINDS = ("assign", "access", "hex")
VERDICTS = ("live", "example")
WIDE_OWNERS = 3
WIDE_REPOSITORIES = 10
MIN_ENTROPY = 3.0
MIN_LIVE_CHARS = 16

# The patterns of the base kinds.
_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so shorter ones need no match of their own


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, value) of the base kinds, by start and kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in _WORDS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def live_looking(value: str) -> bool:
    """Long, and with the character entropy (bits) of random text."""
    if len(value) < MIN_LIVE_CHARS:
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= MIN_ENTROPY


def _scan():
    def one(raw: bytes):
        spans = base_spans(raw.decode())
        counts = Counter(s[1] for s in spans)
        digest = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b, _ in spans)
        base = [{"start": a, "place": k, "end": b, "kind": KINDS[k]} for a, k, b, _ in spans]
        values = {(b - len(v), b): v for _, _, b, v in spans}
        held = [
            {"start": a, "end": b, "hash": hashlib.sha256(v.encode()).hexdigest(), "random": live_looking(v)}
            for (a, b), v in sorted(values.items())
        ]
        return (counts[0], counts[1], counts[2], hashlib.sha256(digest.encode()).hexdigest(), base, held)

    return lambda texts: [one(t) for t in texts]


FOUND = (
    "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string,"
    f" base array<{SPAN}>, held array<struct<start:bigint,end:bigint,hash:string,random:boolean>>"
)


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the base spans and the hashed values in it, settled with a row number."""
    rows = docs.select(
        F.col("doc_id"), F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"), F.col(text).alias("text"),
    )
    found = map_texts(rows, _scan, FOUND, ("doc_id", "repository", "owner"))
    return settle(found.withColumn("row", F.monotonically_increasing_id()))


def ownership(found: DataFrame) -> DataFrame:
    """Per value hash: n_repositories, n_owners, the verdict (live, example or none).

    Counted in steps, each combined in map tasks, so a value in a third of all rows arrives as one row
    per task. A null owner or repository counts as one of its own.
    """
    seen = found.where(F.size("held") > 0).select("repository", "owner", F.explode("held").alias("h")).select(
        "repository", "owner", "h.hash", "h.random"
    )
    held = seen.groupBy("hash", "random", "repository").agg(F.lit(1).alias("one"))
    repositories = held.groupBy("hash", "random").agg(F.count("one").alias("n_repositories"))
    owners = seen.groupBy("hash", "owner").agg(F.lit(1).alias("one")).groupBy("hash").agg(
        F.count("one").alias("n_owners")
    )
    wide = (F.col("n_owners") >= WIDE_OWNERS) | (F.col("n_repositories") >= WIDE_REPOSITORIES)
    verdict = F.when(wide, "example").when(
        (F.col("n_owners") == 1) & F.col("random"), "live"
    )
    return repositories.join(owners, "hash").withColumn("verdict", verdict)


def secret_scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans (all), n_live and n_example of every row.

    `spans` holds the base spans and, for values with a verdict, `live` or `example` over the value.
    Null and empty texts have no spans. Rows that repeat are scanned each; as copies of one repository
    they do not raise its counts. An empty table gives none; other columns are ignored.
    """
    found = candidates(docs, owner, repository, text)
    # settled, so that the join deals both sides anew and a value in very many rows can be split
    verdicts = settle(ownership(found).where(F.col("verdict").isNotNull()).select("hash", "verdict"))
    held = found.where(F.size("held") > 0).select("row", F.explode("held").alias("h")).select("row", "h.*")
    place = F.when(F.col("verdict") == "live", len(KINDS)).otherwise(len(KINDS) + 1)
    span = F.struct(
        "start", place.cast("int").alias("place"), "end", F.col("verdict").alias("kind")
    )
    judged = held.join(verdicts, "hash").groupBy("row").agg(F.collect_list(span).alias("more"))
    rows = found.drop("held", "owner", "repository").join(judged, "row", "left")
    more = F.coalesce("more", F.array().cast(f"array<{SPAN}>"))

    def count(kind):
        return F.size(F.filter(more, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
        spans_text(F.concat("base", more)).alias("spans"), count("live"), count("example"),
    )


def op1_secret_scan(spark, sf_dir) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


QUERIES = {"op1_secret_scan": op1_secret_scan}
SQL: dict[str, str] = {}
