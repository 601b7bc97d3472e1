"""Periodic runs beside a search of every period."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from carespan.llm import periodic_runs as pr
from tests.llm.conftest import AWKWARD, WORD, documents, rows_by

SF = "/root/testdata/sf0.001"


def plain_runs(words):
    """(start, end, period) of all runs: for every period the maximal stretches that keep it."""
    names = {}
    ids = np.array([names.setdefault(w, len(names)) for w in words], np.int64)
    least = {}
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b + q - a >= max(6, 4 * q):
                least.setdefault((a, b + q), q)
    return sorted((a, b, q) for (a, b), q in least.items())


@settings(max_examples=600, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70))
def test_random_words(words):
    assert sorted(pr.stretch_runs(words)) == plain_runs(words) if words else pr.stretch_runs([0]) == []


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=6))
def test_powers(parts):
    """Powers of short words one after another, with runs inside runs."""
    words = [w for root, times in parts for w in root * times]
    if words:
        assert sorted(pr.stretch_runs(words)) == plain_runs(words)
        deeper = words * 5
        assert sorted(pr.stretch_runs(deeper)) == plain_runs(deeper)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=5), st.integers(1, 8)), max_size=8))
def test_scan_of_texts(parts):
    words = [w for root, times in parts for w in root * times]
    other = ["x"] * 7 + ["y"]
    (runs, collapsed), (beside, rest) = pr._scan()([" ".join(words).encode(), " ".join(other).encode()])
    assert [(s, s + n, q) for s, n, q in runs] == plain_runs(words)
    assert collapsed == plain_collapsed(words, plain_runs(words))
    assert beside == [(0, 7, 1)] and rest == "x y"


def plain_collapsed(words, runs):
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_grammar_gives_the_words_back(words):
    rules, rest = pr.grammar(words)
    base = max(words) + 1

    def expand(symbol):
        if symbol < base:
            return [symbol]
        left, right, _ = rules[symbol - base]
        return expand(left) + expand(right)

    assert [w for s in rest for w in expand(s)] == words
    for k, (_, _, first) in enumerate(rules):
        whole = expand(base + k)
        assert words[first:first + len(whole)] == whole
    pairs = [p for p in zip(rest, rest[1:])]
    apart = {p for p in pairs if p[0] != p[1]}
    assert all(pairs.count(p) == 1 for p in apart)  # no pair stands twice in what stays


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("aabc"), min_size=1, max_size=40), st.data())
def test_runs_that_cross_a_place(words, data):
    middle = data.draw(st.integers(1, max(1, len(words) - 1)))
    ids = [ord(w) for w in words]
    expected = [r for r in plain_runs(words) if r[0] < middle < r[1]]
    assert sorted(pr.crossing(ids, middle)) == expected if middle < len(words) else True


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = None
    for s, e, q in runs:
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    return (
        len(runs), *(best or (None,) * 3), best and best[1] * 1000 // best[2],
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query(spark, sf):
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    got = rows_by(pr.op13_periodic_runs(spark, path))
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert tuple(g[c] for c in COLUMNS) == plain_row(r["doc_id"], r["text"]), r["doc_id"]
    assert sum(g["n_runs"] > 0 for g in got.values()) > len(rows) // 20


def test_places_of_a_period(spark):
    prose = [f"w{i}" for i in range(40)]
    texts = [
        " ".join(prose * 3), " ".join(prose * 4), " ".join(prose * 9 + prose[:7]), "a " * 5, "a " * 6, "a b " * 3, "a b " * 4,
        " ".join(["in"] + ["a", "b"] * 6 + ["b", "a"] * 6 + ["out"]),
    ]
    got = rows_by(pr.periodic_runs(documents(spark, texts)))
    for i, t in enumerate(texts):
        assert [(r["start"], r["start"] + r["length"], r["period"]) for r in got[i]["runs"]] == plain_runs(t.split())
    assert got[0]["runs"] == [] and got[1]["collapsed"] == " ".join(prose)


def test_tie_of_exponents(spark):
    text = "a a a a a a x " + "b c " * 6 + "y " + "d " * 6
    rows = pr.periodic_runs(documents(spark, [text])).withColumn("best", pr.strongest(pr.F.col("runs")))
    assert tuple(rows.first()["best"]) == (0, 6, 1)


def test_awkward_rows(spark, awkward, nothing):
    rows = pr.periodic_runs(awkward).collect()
    assert len(rows) == len(AWKWARD) + 4
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["runs"] == [] and by_id[0]["collapsed"] == ""
    assert [tuple(r) for r in by_id[9]["runs"]] == [(0, 60_000, 1)] and by_id[9]["collapsed"] == "long"
    assert by_id[6]["collapsed"] == "same text again" and by_id[None]["collapsed"] == "same text again"
    assert pr.periodic_runs(nothing).count() == 0
    assert pr.repeated_tail(nothing).count() == 0
