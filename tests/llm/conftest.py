"""Small documents with awkward cases, and the plain definitions the operators are held against."""

import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, source="src0", lang="en"):
    """Documents from texts or (text, source, lang), numbered from 0."""
    rows = []
    for i, t in enumerate(texts):
        text, s, l = t if isinstance(t, tuple) else (t, source, lang)
        rows.append((i, text, l, s, len(text or "")))
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, width=5):
    words = WORD.findall(lower(text))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def rows_by(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest test documents, as a DataFrame and as rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, docs.collect()


AWKWARD = [
    None, "", " \t\n", "word", "a b c d", "a b c d e", "same text again", "same text again",
    "x" * 300_000, "long " * 60_000, "é ü ß     漢字 🙂", "tab\tand\x0bvertical\x0cfeed\r\nend",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [(i, t, "en", "src0", 1) for i, t in enumerate(AWKWARD)]
    rows += [rows[6], rows[6], (None, "same text again", None, None, None), (99, "no source", None, None, None)]
    names = (
        "shard int, slot bigint, size bigint, target double, kept boolean, row bigint, node bigint, `group` string,"
        " row_key string, place int, owner string, hash string, text_key string, n_words bigint, copies int"
    )
    clash = (1, 2, 3, 4.0, True, 5, 6, "g", "k", 7, "o", "h", "t", 8, 9)
    return spark.createDataFrame([r + clash for r in rows], f"{COLUMNS}, {names}").repartition(4)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
