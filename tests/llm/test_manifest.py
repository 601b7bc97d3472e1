"""The manifest beside a plain tree."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from carespan.llm import manifest
from tests.llm.conftest import documents, lower


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """The levels of a tree over nodes; the last has one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i:i + 8])) for i in range(0, len(last), 8)])
    return levels


def siblings(levels, at):
    path = []
    for nodes in levels[:-1]:
        run = at - at % 8
        path.append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 8])))
        at //= 8
    return path


def plain_manifest(rows):
    """Sorted (doc_id, leaf, subroot, root, proof, folded root, verified)."""
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        trees[g] = climb([leaf(r, r["text"]) for r in groups[g]])
    top = climb([trees[g][-1][0] for g in order])
    found = []
    for at_group, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            path = siblings(trees[g], at) + siblings(top, at_group)
            text = r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = lower(text)
            node = leaf(r, text)
            for left, right in path:
                node = sha(left + node + right)
            found.append((
                r["doc_id"], trees[g][0][at], trees[g][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), node,
                node == top[-1][0],
            ))
    return sorted(found, key=repr)


def result(df):
    joined = F.array_join(F.transform("proof", lambda p: F.concat(p["left"], p["right"])), "")
    rows = df.withColumn("p", F.sha2(joined, 256)).select("doc_id", "leaf", "subroot", "root", "p", "folded_root", "verified")
    return sorted((tuple(r) for r in rows.collect()), key=repr)


# lengths on both sides of every power of eight, and more than one block of 512
@pytest.mark.parametrize("sizes", [[1], [1, 1], [8], [9, 1], [64, 65, 7], [511], [512, 3], [513, 8], [1100, 0, 1, 2, 3, 4, 5, 6, 7, 8]])
def test_against_a_plain_tree(spark, sizes):
    texts = [(f"Text {i} of G{g}" if i % 5 else None, None if i % 7 == 3 else f"s{i % 3}", None if g == 1 else f"l{g}")
             for g, n in enumerate(sizes) for i in range(n)]
    docs = documents(spark, texts)
    got = result(manifest.manifest(docs))
    assert got == plain_manifest(docs.collect())


def test_tampering_shows_exactly_where_a_text_changed(spark, sample):
    docs, rows = sample
    got = {r["doc_id"]: r["verified"] for r in manifest.manifest(docs).collect()}
    for r in rows:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and lower(r["text"]) != (r["text"] or "")
        assert got[r["doc_id"]] is not changed


def test_awkward_rows(spark, awkward, nothing):
    assert result(manifest.manifest(awkward)) == plain_manifest(awkward.collect())
    assert manifest.manifest(nothing).count() == 0


def test_order_of_languages(spark):
    langs = ["zz", None, "", "-", "=", "\U0001F600", "～", "é", "e", "E"]
    docs = documents(spark, [("t", "s", g) for g in langs for _ in range(2)])
    assert result(manifest.manifest(docs)) == plain_manifest(docs.collect())


def test_one_repeated_row_spreads_over_ranges(spark, monkeypatch):
    """A row that stands 3000 times is cut like any others: no range holds all of it."""
    monkeypatch.setattr(manifest, "RANGE_ROWS", 200)
    docs = documents(spark, ["x"]).crossJoin(spark.range(3000)).drop("id")
    rows = manifest.numbered(manifest.leaves(docs), "grp", "doc_id", "node")
    assert sorted(r["place"] for r in rows.collect()) == list(range(3000))
    ranges = docs.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(16, "doc_id", "row")
    assert max(r["count"] for r in ranges.groupBy(F.spark_partition_id()).count().collect()) < 1500
    assert result(manifest.manifest(docs)) == plain_manifest(docs.collect())
