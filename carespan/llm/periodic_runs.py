"""Operator 13: periodic runs of words, found in a grammar of the text.

A run is a stretch of consecutive words with smallest period q and max(6, 4 q) words or more that no
neighbouring word extends. Each three consecutive words of a run stand in it three times or more, so a
text is first cut where three words stand less often (exact: no run is cut). What remains is compressed
by Re-Pair: the most frequent pair of neighbours becomes a rule until no pair stands twice, and the rest
is halved into rules, too. The runs that cross the boundary of a rule's two halves are computed once per rule, from
Z-arrays of its expansion; they are then translated to all places where the rule is derived. A run is
whole at the lowest rule that holds it and clipped at others, so of each period the maximal intervals stay.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import map_texts, table

MIN_WORDS = 6
MIN_EXPONENT = 4
TRIPLE_TIMES = 3
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def grammar(words: list[int]) -> tuple[list[tuple[int, int, int]], list[int]]:
    """Re-Pair: the rules (left, right, first place) in the order they were made, and the symbols that stay.

    Symbols below `base` (the highest word + 1) are words, the k-th rule is base + k. Of equally
    frequent pairs the one that was counted first is replaced.
    """
    n, base = len(words), max(words, default=-1) + 1
    symbols, after, before = list(words), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], list[int]] = {}
    for i, pair in enumerate(zip(words, words[1:])):
        places.setdefault(pair, []).append(i)
    turn = 0
    queue = []
    for pair, at in places.items():
        if len(at) > 1:
            queue.append((-len(at), turn, pair))
            turn += 1
    heapq.heapify(queue)
    rules: list[tuple[int, int, int]] = []
    while queue:
        claimed, _, pair = heapq.heappop(queue)
        left, right = pair
        live = [i for i in places.pop(pair, ()) if symbols[i] == left and after[i] < n and symbols[after[i]] == right]
        if left == right:  # overlapping places: every second of a row of equal symbols
            live.sort()
            apart, last = [], -1
            for i in live:
                if i != last:
                    apart.append(i)
                    last = after[i]
            live = apart
        if len(live) < 2:
            continue
        if len(live) < -claimed and queue and len(live) < -queue[0][0]:
            places[pair] = live
            heapq.heappush(queue, (-len(live), turn, pair))
            turn += 1
            continue
        made = base + len(rules)
        rules.append((left, right, min(live)))
        touched = {}
        for i in live:
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = (made, symbols[k])
                places.setdefault(new, []).append(i)
                touched[new] = True
            k = before[i]
            if k >= 0:
                new = (symbols[k], made)
                places.setdefault(new, []).append(k)
                touched[new] = True
        for new in touched:
            if len(places[new]) > 1:
                heapq.heappush(queue, (-len(places[new]), turn, new))
                turn += 1
    rest, i = [], 0
    while i < n:
        rest.append(i)
        i = after[i]
    return rules, [symbols[i] for i in rest]


def z_array(s: list[int]) -> list[int]:
    """For each place the length of the longest prefix of the whole that stands there; the whole at 0."""
    n = len(s)
    z = [0] * n
    z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def crossing(words: list[int], middle: int) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of the words that have words on both sides of `middle`."""
    n = len(words)
    if n < MIN_WORDS:
        return []
    head, tail = words[:middle], words[middle:]
    forward = z_array([*tail, -1, *words])
    words_back = words[::-1]
    backward = z_array([*head[::-1], -1, *words_back])
    u, v = middle, n - middle
    found: dict[tuple[int, int], int] = {}
    for q in range(1, n // MIN_EXPONENT + 1):
        need = max(MIN_WORDS, MIN_EXPONENT * q)
        if q <= v:  # a period or more behind the middle
            left = backward[u + 1 + v - q]
            right = forward[q] if q < v else 0
            if left and left + q + right >= need:
                found.setdefault((middle - left, middle + q + right), q)
        if q <= u:  # a period or more before it
            left = backward[q] if q < u else 0
            right = forward[v + 1 + middle - q]
            if right and left + q + right >= need:
                found.setdefault((middle - q - left, middle + right), q)
    return [(a, b, q) for (a, b), q in found.items()]


def stretch_runs(words: list[int]) -> list[tuple[int, int, int]]:
    """All runs (start, end, period) of a stretch of word ids, by way of its grammar."""
    names: dict[int, int] = {}
    words = [names.setdefault(w, len(names)) for w in words]
    base = len(names)
    rules, rest = grammar(words)
    sizes = [1] * base
    for left, right, _ in rules:
        sizes.append(sizes[left] + sizes[right])
    places, at = [], 0
    for symbol in rest:
        places.append(at)
        at += sizes[symbol]
    while len(rest) > 1:  # the rest, halved: neighbours meet, a last single one waits
        paired, starts = [], []
        for i in range(0, len(rest) - 1, 2):
            rules.append((rest[i], rest[i + 1], places[i]))
            sizes.append(sizes[rest[i]] + sizes[rest[i + 1]])
            paired.append(base + len(rules) - 1)
            starts.append(places[i])
        if len(rest) % 2:
            paired.append(rest[-1])
            starts.append(places[-1])
        rest, places = paired, starts
    own: list[list] = [[]] * base
    holds = [False] * base
    for k, (left, right, first) in enumerate(rules):
        mine = crossing(words[first:first + sizes[base + k]], sizes[left])
        own.append(mine)
        holds.append(bool(mine) or holds[left] or holds[right])
    by_period: dict[int, set] = {}
    todo = [(symbol, 0) for symbol in rest if holds[symbol]]
    while todo:
        symbol, at = todo.pop()
        for a, b, q in own[symbol]:
            by_period.setdefault(q, set()).add((at + a, -at - b))
        left, right, _ = rules[symbol - base]
        if holds[left]:
            todo.append((left, at))
        if holds[right]:
            todo.append((right, at + sizes[left]))
    found = []
    for q, intervals in by_period.items():
        reached = -1
        for a, b in sorted(intervals):
            if -b > reached:
                reached = -b
                found.append((a, -b, q))
    return found


def stretches(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches that runs may lie in, each within one of the given ones.

    Three words are counted by a hash in a table of counters; a collision only makes a count larger, so it
    keeps a place that could be cut. Each round mixes anew; the last one changes nothing.
    """
    round_ = 0
    while True:
        long = ends - starts >= MIN_WORDS
        starts, ends = starts[long], ends[long]
        if not len(starts):
            return starts, ends
        counts = ends - starts - 2
        first = np.cumsum(counts) - counts
        group = np.repeat(np.arange(len(starts), dtype=np.uint64), counts)
        at = np.arange(counts.sum()) + np.repeat(starts - first, counts)
        bits = max(10, int(8 * len(at)).bit_length())
        code = group * np.uint64(0x9E3779B97F4A7C15) + np.uint64(round_ * 2 + 1)
        for k in range(3):
            code ^= ids[at + k]
            code *= np.uint64(0xD6E8FEB86659FD93)
            code ^= code >> np.uint64(32)
        code = (code * np.uint64(0x9FB21C651E98DF25) >> np.uint64(64 - bits)).astype(np.int64)
        good = np.bincount(code, minlength=1 << bits)[code] >= TRIPLE_TIMES
        if good.all():
            return starts, ends
        edge = np.zeros(len(at), bool)
        edge[first] = True
        opens = np.flatnonzero(good & (edge | ~np.concatenate(([False], good[:-1]))))
        closes = np.flatnonzero(good & np.concatenate((edge[1:] | ~good[1:], [True])))
        starts, ends = at[opens], at[closes] + 3
        round_ += 1


def _scan():
    def find(texts):
        cut = [t.split() for t in texts]  # bytes split at exactly the white space of the word rule
        flat = [w for words in cut for w in words]
        found = [[] for _ in texts]
        if flat:
            ids = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
            ends = np.cumsum([len(words) for words in cut])
            begins = ends - [len(words) for words in cut]
            for a, b in zip(*(x.tolist() for x in stretches(ids, begins, ends))):
                doc = int(np.searchsorted(ends, a, side="right"))
                shift = a - int(begins[doc])
                found[doc] += [(shift + s, shift + e, q) for s, e, q in stretch_runs(ids[a:b].tolist())]
        out = []
        for words, runs in zip(cut, found):
            runs.sort(key=lambda r: (r[0], r[2]))
            reached, kept = 0, []
            for s, e, q in sorted((s + q, e, q) for s, e, q in runs):
                if e > reached:
                    kept += words[reached:max(s, reached)]
                    reached = e
            kept += words[reached:]
            out.append(([(s, e - s, q) for s, e, q in runs], b" ".join(kept).decode()))
        return out

    return find


def periodic_runs(docs: DataFrame, keep: tuple = ("doc_id",), text: str = "text") -> DataFrame:
    """The columns `keep` with `runs` (start, length, period, by start and period) and `collapsed`.

    Words are what stands between ASCII white space, numbered from 0. `collapsed` has the words that no
    run contains after its first period, joined by one space. Null and empty texts have no runs and are
    empty. Repeated rows each get their row, an empty table gives none, other columns are ignored.
    """
    return map_texts(docs, _scan, f"runs array<{RUN}>, collapsed string", keep, text)


def strongest(runs: Column) -> Column:
    """Of an array of runs by start and period, the first with the greatest length over period."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
    ).otherwise(best))


def repeated_tail(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by the CRC-32 of its number, ends in copies of its own words.

    With h the CRC-32 of the decimal doc_id, g = h div 10 and n words, the words from a = g mod n on
    repeat the first p = 1 + (n - a) div (3 + g mod 8) of them. A null doc_id or text stays as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    cut = docs.withColumn("__words", F.when(h % 10 == 0, words))
    n = F.nullif(F.size("__words"), F.lit(0))
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    places = F.sequence(F.lit(0).cast("long"), (n - 1).cast("long"))
    moved = F.transform(places, lambda i: F.get("__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return cut.withColumn("text", F.when(n > 0, F.array_join(moved, " ")).otherwise(F.col("text"))).drop("__words")


def op13_periodic_runs(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = periodic_runs(repeated_tail(docs)).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13_periodic_runs}
SQL: dict[str, str] = {}
