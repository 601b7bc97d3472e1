"""Operator 2: quality rules with distribution divergence.

Per language the corpus gives two reference histograms over all its documents: character classes and
common words. A document whose histogram lies far from its language's, by Jensen-Shannon distance
(base 2, so 0 to 1), is rejected; each test asks for a minimum length, below which it says nothing, and
the limit for common words is wider for short documents.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import map_texts, settle, table

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_CHARS_FOR_CLASSES = 200
MIN_WORDS_FOR_COMMON = 120  # from here on the limit is MAX_COMMON_DISTANCE
MIN_WORDS_FOR_SHORT = 40  # from here on it is wider by the spread of a sample of so many words
MAX_CLASS_DISTANCE = 0.25
MAX_COMMON_DISTANCE = 0.3
LISTED = 20  # words of a language's list, the degrees of freedom of its histogram
SYMBOLS = "#*$%&|<>"

# Frequent words, the bins of the word histogram (one more bin holds all others).
COMMON = {
    "en": "the of and to a in is that for it was on are as with be by at from this",
    "de": "der die das und ist in den von zu mit sich des auf nicht ein eine auch im dem für",
    "fr": "le la les de des et en un une est que qui dans pour pas sur par au il avec",
    "es": "el la los las de que y en un una es se no por con para su al lo como",
}
BINS = tuple(sorted(set(chain.from_iterable(v.split() for v in COMMON.values()))))
# Character classes: lower case, upper case, digit, white space, sentence mark, other ASCII, beyond ASCII.
CLASSES = 7


def _class_table() -> np.ndarray:
    """Class of every byte; the later bytes of a character have none (CLASSES)."""
    kinds = np.full(256, 5, np.uint8)
    kinds[list(b"abcdefghijklmnopqrstuvwxyz")] = 0
    kinds[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
    kinds[list(b"0123456789")] = 2
    kinds[list(b" \t\n\x0b\x0c\r")] = 3
    kinds[list(b".,;:!?'\"-()")] = 4
    kinds[0x80:0xC0] = CLASSES
    kinds[0xC0:] = 6
    return kinds


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words that stand in a window of words found twice or more. Windows are compared exactly.

    Windows double in length step by step; equal windows get equal numbers at each step.
    """
    n = len(words)
    if n <= window:
        return 0
    numbers: dict = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    if len(numbers) == n:
        return 0
    length = 1
    while length < window:
        step = min(length, window - length)
        pair = codes[:-step] * (n + 1) + codes[step:]
        codes = np.unique(pair, return_inverse=True)[1]
        length += step
    twice = np.bincount(codes)[codes] > 1
    if not twice.any():
        return 0
    edges = np.zeros(n + 1, np.int64)
    edges[:len(twice)] += twice
    edges[window:window + len(twice)] -= twice
    return int((np.cumsum(edges[:n]) > 0).sum())


def _histograms(raw: bytes, words: list, kinds: np.ndarray, bins: dict) -> tuple[list, list]:
    classes = np.bincount(kinds[np.frombuffer(raw, np.uint8)], minlength=CLASSES + 1)[:CLASSES].tolist()
    common = [0] * (len(bins) + 1)
    for w in words:
        at = bins.get(w)
        if at is not None:
            common[at] += 1
    common[-1] = len(words) - sum(common)
    return classes, common


def _shares(counts: list) -> list | None:
    total = sum(counts)
    return [c / total for c in counts] if total else None


def _histogram_scan():
    kinds, bins = _class_table(), {w.encode(): i for i, w in enumerate(BINS)}
    return lambda texts: [_histograms(t, t.split(), kinds, bins) for t in texts]


def _rule_scan():
    kinds, bins = _class_table(), {w.encode(): i for i, w in enumerate(BINS)}
    spaces = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
    symbols = np.isin(np.arange(256), list(SYMBOLS.encode()))
    starts = (np.arange(256) & 0xC0) != 0x80

    def one(raw: bytes):
        words = raw.split()  # of bytes: at exactly the six ASCII white-space characters
        seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        lines, again = set(), 0
        for line in raw.split(b"\n"):
            if line.strip():
                again += line in lines
                lines.add(line)
        classes, common = _histograms(raw, words, kinds, bins)
        return (
            len(words), int(seen[starts & ~spaces].sum()), int(seen[symbols].sum()), again,
            repeated_words(words), sum(classes), _shares(classes), _shares(common),
        )

    return lambda texts: [one(t) for t in texts]


def common_limit(words: Column) -> Column:
    """The largest distance of common words by the number of words, null below MIN_WORDS_FOR_SHORT.

    A sample of n words has an expected divergence from its source of about LISTED / (8 n ln 2) bits. What
    a shorter text has beyond one of MIN_WORDS_FOR_COMMON words is added to the square of the limit.
    """
    spread = LISTED / (8 * math.log(2)) * (1 / F.greatest(words, F.lit(1)) - 1 / MIN_WORDS_FOR_COMMON)
    wide = F.sqrt(MAX_COMMON_DISTANCE ** 2 + F.greatest(spread, F.lit(0.0)))
    return F.when(words >= MIN_WORDS_FOR_COMMON, F.lit(MAX_COMMON_DISTANCE)).when(words >= MIN_WORDS_FOR_SHORT, wide)


HISTOGRAMS = "classes array<bigint>, common array<bigint>"
FOUND = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " n_chars bigint, classes array<double>, common array<double>"
)


def references(found: DataFrame) -> DataFrame:
    """One row per language: the shares of its documents' summed histograms (null is a language, too)."""
    sizes = {"classes": CLASSES, "common": len(BINS) + 1}
    sums = [F.sum(F.col(c)[i]).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]

    def shares(c, n):
        counts = F.array(*[F.col(f"{c}_{i}") for i in range(n)])
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.when(total > 0, F.transform(counts, lambda x: x / total)).alias(f"ref_{c}")

    return found.groupBy("lang").agg(*sums).select(F.col("lang").alias("ref_lang"), *[shares(c, n) for c, n in sizes.items()])


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares; null if one of them is."""

    def part(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: part(x, (x + y) / 2) / 2 + part(y, (x + y) / 2) / 2)
    divergence = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    # equal arrays may come out a little below 0; a null stays one, which greatest() would not leave
    return F.sqrt(F.when(divergence < 0, 0.0).otherwise(divergence))


def judged(docs: DataFrame, keep: tuple = ("doc_id",), lang: str = "lang", text: str = "text") -> DataFrame:
    """The columns `keep` of every row with the base figures, both distances, base_failed and kept.

    Two passes over the whole texts: the references (settled, one row per language), then the rows. The
    rows meet their reference by language; as it is a small table on disk, no text is shuffled for it.
    Null and empty texts have no words and fail the base rules. Documents without a language are compared
    with each other by character classes, but not rejected by words, as theirs may be in any language.
    Repeated rows are each judged; an empty table gives none.
    """
    ranked = settle(references(
        map_texts(docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")), _histogram_scan, HISTOGRAMS, ("lang",))
    ))
    own = [f"__kept_{i}" for i in range(len(keep))]
    rows = map_texts(
        docs.select(
            *[F.col(c).alias(o) for c, o in zip(keep, own)], F.col(lang).alias("__lang"), F.col(text).alias("__source"),
        ), _rule_scan, FOUND, (*own, "__lang"), "__source",
    )
    rows = rows.join(ranked, rows["__lang"].eqNullSafe(ranked["ref_lang"]), "left")
    words, repeats = F.col("n_words"), F.col("n_repeat_words")
    rows = rows.withColumns({
        "class_distance": js_distance(F.col("classes"), F.col("ref_classes")),
        "common_distance": js_distance(F.col("common"), F.col("ref_common")),
        "base_failed": (words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * words),
    })
    far = [
        (F.col("n_chars") >= MIN_CHARS_FOR_CLASSES) & (F.col("class_distance") > MAX_CLASS_DISTANCE),
        F.col("__lang").isNotNull() & (F.col("common_distance") > common_limit(words)),
    ]
    diverged = reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in far])
    return rows.select(
        *[F.col(o).alias(c) for c, o in zip(keep, own)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance",
        "common_distance", "base_failed", (~F.col("base_failed") & ~diverged).alias("kept"),
    )


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    verdict = "__quality_kept"
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    packed = docs.select(whole, F.col("lang").alias("lang"), F.col("text").alias("text"))
    rows = judged(packed, ("__row",)).withColumnRenamed("kept", verdict)
    return rows.where(verdict).select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def op2_quality_rules(spark, sf_dir) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"))


QUERIES = {"op2_quality_rules": op2_quality_rules}
SQL: dict[str, str] = {}
