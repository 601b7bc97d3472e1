"""Quality rules, n-gram join, decontamination, mixing and sharding beside brute force."""

import collections
import hashlib
import math
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from carespan.llm import components, decontamination, mixing, ngram_join, quality_rules, sharding
from carespan.llm.checks import TEXTS
from carespan.llm.registry import QUERIES
from tests.compare import database, difference
from tests.llm.conftest import AWKWARD, WORD, documents, rows_by, shingle_set

SF = "/root/testdata/sf0.001"


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


QUALITY = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_quality_query(spark, sample):
    _, rows = sample
    got = rows_by(quality_rules.op2_quality_rules(spark, SF))
    for row in rows:
        r = got[row["doc_id"]]
        assert tuple(r[c] for c in QUALITY) == plain_quality(row["text"])
        assert not (r["kept"] and r["base_failed"])
    assert sum(r["kept"] for r in got.values()) > 0.6 * len(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words(words):
    assert quality_rules.repeated_words([w.encode() for w in words]) == plain_quality(" ".join(words))[4]


def plain_distance(p, q):
    p, q = np.array(p) / sum(p), np.array(q) / sum(q)
    m = (p + q) / 2
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt((kl(p) + kl(q)) / 2)


def test_distance_and_references(spark):
    prose = "the cat is on the mat and it was not for us to see what that was in the end of a long day. "
    docs = documents(spark, [prose * 5] * 8 + ["|&%$ 12 #" * 200, None, "zzz qqq " * 200 + "end of it"])
    got = rows_by(quality_rules.judged(docs))
    histograms = [quality_rules._histogram_scan()([(t or "").encode()])[0] for t in [prose * 5] * 8 + ["|&%$ 12 #" * 200, None, "zzz qqq " * 200 + "end of it"]]
    for at, name in ((0, "class_distance"), (1, "common_distance")):
        total = np.sum([h[at] for h in histograms], axis=0)
        for i in (0, 8, 10):
            assert got[i][name] == pytest.approx(plain_distance(histograms[i][at], total), abs=1e-9)
    assert got[9]["class_distance"] is None and not got[9]["kept"]
    assert got[8]["class_distance"] > quality_rules.MAX_CLASS_DISTANCE and not got[8]["kept"]


def test_common_words_of_short_documents(spark):
    """Texts under a wrong label and long menus are rejected below 120 words, too; prose of any length stays."""
    rng = np.random.default_rng(4)
    word = lambda: "w" + "".join(rng.choice(list("abcdefgh"), 5))

    def prose(lang, n):
        listed = list(dict.fromkeys(quality_rules.COMMON[lang].split()))[:12]
        odds = 1 / np.arange(1, len(listed) + 1)
        return " ".join(str(rng.choice(listed, p=odds / odds.sum())) if rng.random() < 0.4 else word() for _ in range(n))

    long = [(prose(lang, 800), "s", lang) for lang in ("en", "de") for _ in range(20)]
    sizes = (60, 80, 100, 119)
    wrong = [(prose("de", n), "s", "en") for n in (45, *sizes)]
    menus = [(" | ".join(word() for _ in range(n // 2)), "s", "en") for n in sizes]
    right = [(prose("en", n), "s", "en") for n in (25, 45, *sizes) for _ in range(10)]
    got = rows_by(quality_rules.judged(documents(spark, long + wrong + menus + right)))
    first = len(long) + len(wrong) + len(menus)
    assert not any(got[i]["base_failed"] for i in got)
    assert not any(got[i]["kept"] for i in range(len(long), first))
    assert all(got[i]["kept"] for i in [*range(len(long)), *range(first, len(got))])


def test_a_missing_language_is_no_fault(spark):
    prose = {"en": "the cat is on the mat and it was not for us to see that ", "de": "der hund und die katze ist nicht in dem haus und das ist gut "}
    docs = documents(spark, [(" ".join([prose[x]] + [f"{x}{i}w{k} {prose[x]}" for k in range(20)]), "s", None) for i in range(6) for x in prose])
    got = rows_by(quality_rules.judged(docs))
    assert all(r["kept"] == (not r["base_failed"]) for r in got.values())


def plain_classes(rows):
    """doc_id -> (set size, smallest doc_id that links reach)."""
    sets = [(r["doc_id"], shingle_set(r["text"])) for r in rows]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, by_id = collections.defaultdict(set), dict(sets)
    for i, s in sets:
        for x in s:
            holders[x].add(i)
    for i, s in sets:
        for j, k in collections.Counter(j for x in s for j in holders[x]).items():
            if j < i and 100 * k >= 80 * (len(s) + len(by_id[j]) - k):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets}


def classes_of(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_ngram_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
        assert classes_of(ngram_join.op3_ngram_join(spark, sf)) == plain_classes(rows)


def test_ngram_edges_of_the_threshold(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n in (5, 6, 9, 13, 14, 15, 30, 60, 200, 900):
        words = [f"w{n}x{i}" for i in range(n)]
        texts.append(" ".join(words))
        for edits in (1, 2, 3, n // 40 + 1, n // 25 + 1):
            for at in (0, n // 2):
                changed = list(words)
                for k in range(edits):
                    changed[(at + int(rng.integers(0, n))) % n] = f"e{rng.integers(1 << 30)}"
                texts.append(" ".join(changed))
        texts += [" ".join(words[: n - n // 9]), " ".join(words) + " more words at its end", " ".join(words).upper()]
    texts += ["one two", "One Two", "one two three", None, "", " ", "é ü a b c d", "É ü a b c d"]
    docs = documents(spark, texts)
    assert classes_of(ngram_join.similarity_classes(docs)) == plain_classes(docs.collect())


def test_ngram_shared_passages(spark):
    """Passages in most documents, a chain of drifting copies, many near copies of one text."""
    rng = np.random.default_rng(8)
    word = lambda: f"v{rng.integers(1 << 40)}"
    passage = [word() for _ in range(60)]
    texts = [" ".join([*(word() for _ in range(40)), *passage, *(word() for _ in range(30))]) for _ in range(150)]
    base = [word() for _ in range(100)]
    for _ in range(120):
        near = list(base)
        near[int(rng.integers(100))] = word()
        texts.append(" ".join(near))
    chain = [word() for _ in range(80)]
    for _ in range(40):
        chain = [*chain[3:], word(), word(), word()]
        texts.append(" ".join(chain))
    texts += [" ".join(passage)] * 3 + [" ".join(passage[:-4] + [word()])]
    docs = documents(spark, texts)
    assert classes_of(ngram_join.similarity_classes(docs)) == plain_classes(docs.collect())


def test_prefix_and_bitmap_bounds():
    rng = np.random.default_rng(3)
    for n in range(1, 200):
        assert ngram_join.prefix_length(n) == n - math.ceil(4 * n / 5 - 1e-9) + 1
    for n, m in ((40, 44), (500, 520), (513, 511), (1100, 1000)):
        x = np.unique(rng.integers(0, 1 << 63, n, np.int64).astype(np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[: int(n * 0.9)], rng.integers(0, 1 << 63, m - int(n * 0.9), np.int64).astype(np.uint64)]))
        a, b = sorted((ngram_join.bitmap(x), ngram_join.bitmap(y)), key=len)
        while len(b) > len(a):
            b = b[: len(b) // 2] ^ b[len(b) // 2:]
        differ = sum(int(v).bit_count() for v in (a ^ b).view(np.uint64))
        assert differ <= len(np.setxor1d(x, y))


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, int(i)) for i in rng.integers(1000, 2000, 300)] + [(7, 7), (9, 8), (9, 8)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[i] == 100 for i in range(101, 161)) and got[9] == 8 and 7 not in got
    assert all(got[max(l)] == 5 for l in links if 5 in l)
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def plain_leaks(docs, items):
    found = {}
    for d in docs:
        s = shingle_set(d["text"])
        for i in items:
            t = shingle_set(i["text"])
            k = len(s & t)
            if t and 100 * k >= 80 * len(t):
                found[d["doc_id"], i["item_id"]] = (len(t), k)
    return found


def test_leaks_query(spark, sample):
    _, rows = sample
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]): (r["n_item_shingles"], r["n_shared"]) for r in decontamination.op10_decontamination(spark, SF).collect()}
    assert got == plain_leaks(rows, items) and got


def test_leaks_edges(spark):
    words = [f"w{i}" for i in range(30)]
    items = [(0, " ".join(words)), (1, " ".join(words[:5])), (2, "too short"), (3, None), (4, ""), (5, " ".join(words)), (5, " ".join(words))]
    texts = [
        "before " * 300 + " ".join(words) + " after" * 300, " ".join(words[:25]), " ".join(words[:24]), "too short",
        "this is too short by far", None, "", " ".join(words).upper(), " ".join(words[:12] + ["x"] + words[13:]),
        " ".join(words[:12]) + " cut " + " ".join(words[8:]),
    ]
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["n_item_shingles"], r["n_shared"]) for r in decontamination.leaks(docs, bench).collect()}
    assert got == plain_leaks(docs.collect(), bench.collect())
    bad = {d for d, _ in got}
    kept = decontamination.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == set(range(len(texts))) - bad


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, the excess over a limit given to the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > most * sizes[s]}
        if not over:
            target.update({s: share * weight[s] for s in free})
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        free -= over
    return target


def check_mix(rows, got, tolerance):
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        n = len(WORD.findall(r["text"] or ""))
        g = got[r["doc_id"]]
        assert g["size"] == n and g["taken"] <= 3 * n and (n == 0 or g["taken"] % n == 0)
        sizes[r["source"]] += n
        taken[r["source"]] += g["taken"]
        largest[r["source"]] = max(largest[r["source"]], n)
    target = plain_targets(sizes)
    for r in rows:
        assert got[r["doc_id"]]["source_size"] == sizes[r["source"]]
        assert got[r["doc_id"]]["target"] == pytest.approx(target[r["source"]])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= tolerance * target[s] + 2 * largest[s]


def test_mixing_query(spark, sample):
    _, rows = sample
    got = rows_by(mixing.op8_mixing(spark, SF))
    check_mix(rows, got, 0.05)
    assert got == rows_by(mixing.op8_mixing(spark, SF))


def test_mixing_limits_and_nulls(spark):
    rng = np.random.default_rng(2)
    texts = [("w " * int(rng.integers(1, 60)), "a", "en") for _ in range(900)]
    texts += [("w " * int(rng.integers(1, 60)), s, "en") for s in ("b", "É", None, "Z", "f") for _ in range(int(rng.integers(5, 90)))]
    texts += [(None, "empty", "en"), ("", "empty", "en")]
    docs = documents(spark, texts)
    got = rows_by(mixing.mixed(docs))
    check_mix(docs.collect(), got, 0.05)
    whole = mixing.mix_documents(docs)
    assert whole.columns == docs.columns
    copies = collections.Counter(r["doc_id"] for r in whole.collect())
    assert copies == collections.Counter({i: g["copies"] for i, g in got.items() if g["copies"]})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=60), st.integers(1, 9))
def test_least_loaded(sizes, bins):
    sizes = sorted(sizes, reverse=True)
    loads = [0] * bins
    for size, b in zip(sizes, sharding.least_loaded(sizes, bins)):
        assert loads[b] == min(loads)
        loads[b] += size


def check_shards(rows, got, shards=8):
    by_shard, by_text, loads = collections.defaultdict(list), {}, [0] * shards
    assert len(rows) == len(got)
    for r, g in zip(rows, got):
        raw = (r["text"] or "").encode()
        assert (g["size"], g["text_crc32"], g["law"], g["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert by_text.setdefault(raw, g["shard"]) == g["shard"]
        by_shard[g["shard"]].append(g["slot"])
        loads[g["shard"]] += g["size"]
    for found in by_shard.values():
        assert sorted(found) == list(range(len(found)))
    return loads


def test_sharding_query(spark, sample):
    _, rows = sample
    got = rows_by(sharding.op7_sharding(spark, SF))
    loads = check_shards(rows, [got[r["doc_id"]] for r in rows])
    assert max(loads) - min(loads) <= 0.05 * sum(loads) / 8
    assert got == rows_by(sharding.op7_sharding(spark, SF))


def test_sharding_large_group(spark):
    docs = documents(spark, ["the same text " * 20] * 300 + [f"text {i} " * (i % 40) for i in range(900)])
    rows, got = docs.collect(), rows_by(sharding.sharded(docs))
    loads = check_shards(rows, [got[r["doc_id"]] for r in rows])
    others = sorted(loads)[:-1]
    assert others[-1] - others[0] <= 0.02 * others[-1]
    whole = sharding.shard_documents(docs)
    assert whole.columns == [*docs.columns, "shard", "slot"]
    placed = rows_by(whole)
    assert {i: r["shard"] for i, r in placed.items()} == {i: g["shard"] for i, g in got.items()}
    check_shards(rows, [{**got[r["doc_id"]], **placed[r["doc_id"]]} for r in rows])


def spark_hash(*values):
    """xxhash64 of Spark over strings, longs (int) and ints (in a tuple), as a signed number."""
    seed = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def plain_least_loaded(sizes, bins):
    loads, placed = [0] * bins, []
    for size in sizes:
        at = min(range(bins), key=lambda b: (loads[b], b))
        loads[at] += size
        placed.append(at)
    return placed


def plain_shards(rows, shards=8):
    """doc_id -> (size, shard, slot) by the definition: blocks of groups, bins of blocks, chunks of rows."""
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in rows}
    groups = collections.Counter()
    key = {i: hashlib.sha256(t).hexdigest() for i, t in texts.items()}
    for i, t in texts.items():
        groups[key[i]] += len(t) + 1
    blocks = max(sharding.MIN_BLOCKS, min(sharding.MAX_BLOCKS, -(-len(groups) // sharding.BLOCK_GROUPS)))
    dealt = collections.defaultdict(list)
    for g, size in groups.items():
        dealt[spark_hash(g) % blocks].append((-size, g))
    bin_of, loads = {}, collections.Counter()
    for block, members in dealt.items():
        members.sort()
        for (size, g), b in zip(members, plain_least_loaded([-s for s, _ in members], shards)):
            bin_of[g] = block, b
            loads[block, b] -= size
    order = sorted(loads, key=lambda k: (-loads[k], k))
    shard_of = dict(zip(order, plain_least_loaded([loads[k] for k in order], shards)))
    chunks = max(1, -(-len(texts) // (sharding.CHUNK_ROWS * shards)))
    found, members = {}, collections.defaultdict(list)
    for i in texts:
        row_key = spark_hash(i, key[i])
        members[shard_of[bin_of[key[i]]]].append((spark_hash(row_key, (7,)) % chunks, row_key, i))
    for shard, own in members.items():
        for slot, (_, _, i) in enumerate(sorted(own)):
            found[i] = len(texts[i]) + 1, shard, slot
    return found


@pytest.mark.parametrize("sf, chunk", [("sf0.001", 500), ("sf0.01", 20)])
def test_sharding_beside_a_plain_version(spark, monkeypatch, sf, chunk):
    monkeypatch.setattr(sharding, "CHUNK_ROWS", chunk)
    path = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{path}/documents.parquet").collect()
    got = {r["doc_id"]: (r["size"], r["shard"], r["slot"]) for r in sharding.op7_sharding(spark, path).collect()}
    assert got == plain_shards(rows)


@pytest.mark.parametrize("run, rows", [
    (quality_rules.judged, len(AWKWARD) + 4), (ngram_join.similarity_classes, len(AWKWARD) + 4),
    (mixing.mixed, len(AWKWARD) + 4), (sharding.sharded, len(AWKWARD) + 4), (sharding.shard_documents, len(AWKWARD) + 4),
    (quality_rules.quality_filter, None), (ngram_join.one_per_class, None), (mixing.mix_documents, None),
])
def test_awkward_rows(spark, awkward, nothing, run, rows):
    found = run(awkward)
    n = found.count()
    assert n == rows or rows is None
    if rows is None:
        assert found.columns == awkward.columns and (n > 0 or run is quality_rules.quality_filter)
    assert run(nothing).count() == 0


def test_awkward_rows_in_decontamination(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "same text again", 3), (None, None, 4), (2, "", 5)], "item_id bigint, text string, doc_id int")
    assert decontamination.leaks(awkward, bench).select("doc_id", "item_id").distinct().count() == 3
    assert decontamination.decontaminated(awkward, bench).columns == awkward.columns
    assert decontamination.leaks(nothing, bench).count() == 0
    assert decontamination.leaks(awkward, bench.where("false")).count() == 0


def test_repeated_rows_and_groups(spark, awkward):
    classes = ngram_join.similarity_classes(awkward).where("n_shingles = 1").collect()
    same = [r for r in classes if r["doc_id"] in (6, 7, None)]
    assert len(same) == 5 and {r["component_id"] for r in same} == {6}
    kept = [r["doc_id"] for r in ngram_join.one_per_class(awkward).collect()]
    assert kept.count(6) == 1 and 7 not in kept and None not in kept


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(TEXTS))
def test_duckdb_text(spark, name, sf):
    assert difference(QUERIES[name](spark, sf), database(sf), TEXTS[name]) is None


def test_only_native_operators(spark):
    for query in (mixing.op8_mixing, decontamination.op10_decontamination):
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)
