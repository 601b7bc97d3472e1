"""Operator 5: personal data, and the terms that give it away.

Entities are found by pattern in every whole text. What a term discloses of an entity is estimated from
the corpus: pointwise mutual information of term and entity over the information content of the
entity, from the numbers of documents that hold each and both, wherever they stand there. It is 1 for a
term that occurs only with the entity and 0 for one that is independent of it. A rare word meets some
entity by chance, so a pair must also be unlikely among all pairs of an entity and a term that meet in the
corpus. Terms that disclose too much are removed in every document that holds the entity, those that disclose
much are generalised.

What cannot pass this test is left out before pairs are made, with no pair lost: an entity needs a number of
distinct lines, and a term a number of documents, below which even meeting each time is no evidence among so many
pairs; a term in too many documents tells too little of any entity. The bounds follow from the counts of the corpus.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.llm.common import (
    SPAN, is_named, key_bitmap, map_texts, portions, settle, spans_text, table,
)

KINDS = ("email", "ip", "card", "phone")
VERDICTS = ("term", "broad")
REMOVE_AT = 0.9
GENERALISE_AT = 0.6
MAX_CHANCE = 0.05  # of a pair as close among all that meet, if terms were dealt at random
FLUSH_TERMS = 100_000
SLACK = 1 + 1e-9  # so that rounding leaves no pair out

# The patterns of the base kinds. Digit runs are taken whole, so none is tried twice.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]{}<>|*#$%&"
_EDGE_BYTES = EDGES.encode()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """An address is read from each @: back over its local part, then forward over its domain."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            found.append((start, free))
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the base kinds, by start and kind."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def term_of(word: str) -> str:
    """A word without marks at its ends, A-Z as a-z."""
    return word.strip(EDGES).encode().lower().decode()


def entities(text: str, spans: list[tuple[int, int, int]]) -> dict[str, int]:
    """The entities of a text, each with the hash of the first line it stands in."""
    found: dict[str, int] = {}
    hashes: dict[int, tuple[int, int]] = {}  # start of a line -> its end and hash
    for start, kind, end in spans:
        left = text.rfind("\n", 0, start) + 1
        right, line = hashes.get(left, (0, 0))
        if right < end:
            right = text.find("\n", end)
            right = len(text) if right < 0 else right
            line = xxhash.xxh3_64_intdigest(text[left:right]) - (1 << 63)
            hashes[left] = right, line
        value = text[start:end] if kind == 0 else _NOT_DIGIT.sub("." if kind == 1 else "", text[start:end])
        entity = hashlib.sha256(f"{KINDS[kind]}:{value.lower()}".encode()).hexdigest()[:32]
        found.setdefault(entity, line)
    return found


def terms(text: str, spans: list[tuple[int, int, int]]):
    """(term, start, end) of every word that no entity touches; spans are sorted by start."""
    at, until = 0, 0  # the first span that is not before the word, the largest end so far
    for m in _WORD.finditer(text):
        a, b = m.span()
        while at < len(spans) and spans[at][0] < b:
            until = max(until, spans[at][2])
            at += 1
        if until > a:
            continue
        term = term_of(m[0])
        if term:
            a += len(m[0]) - len(m[0].lstrip(EDGES))
            yield term, a, a + len(term)


def _scan():
    def one(raw: bytes):
        text = raw.decode()
        spans = base_spans(text)
        counts = Counter(s[1] for s in spans)
        digest = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        base = [{"start": a, "place": k, "end": b, "kind": KINDS[k]} for a, k, b in spans]
        held = [{"entity": e, "line": line} for e, line in entities(text, spans).items()]
        met = len({t for t, _, _ in terms(text, spans)}) if spans else 0
        return (*[counts[k] for k in range(4)], hashlib.sha256(digest.encode()).hexdigest(), base, held, met)

    return lambda texts: [one(t) for t in texts]


FOUND = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string,"
    f" base array<{SPAN}>, held array<struct<entity:string,line:bigint>>, n_met bigint"
)
PAIRS = "entity string, line bigint, term string, n bigint"
MARKS = "row_key bigint, entity string, term string, start bigint, end bigint"


def pair_key(entity: str, term: str) -> int:
    return xxhash.xxh64_intdigest(entity + term, 42)


def text_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text, 42)


def _texts_with(batches, rows: bytes | None):
    """(text, spans) of the rows that a bitmap names (all, without one) and that hold an entity."""
    for batch in batches:
        for part in portions(batch, 1):
            for key, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if rows is None or is_named(rows, key & (1 << 64) - 1):
                    text = raw.decode()
                    spans = base_spans(text)
                    if spans:
                        yield text, spans


def _met_scan(rows: bytes | None):
    """Hashes of the terms of these rows, those of a task without repeats up to a bound."""

    def run(batches):
        seen: set[int] = set()

        def flush():
            keys = np.array(list(seen), np.uint64).view(np.int64)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(keys)], names=["key"])

        for text, spans in _texts_with(batches, rows):
            seen.update(text_hash(t) for t, _, _ in terms(text, spans))
            if len(seen) > FLUSH_TERMS:
                yield flush()
        yield flush()

    return run


def _pair_scan(rows: bytes | None, whom: bytes | None, what: bytes | None):
    """(entity, line, term, documents of the task that hold them) of the entities and terms that bitmaps name."""

    def run(batches):
        counts = Counter()

        def flush():
            columns = [list(c) for c in zip(*counts)] or [[], [], []]
            kinds = (pa.string(), pa.int64(), pa.string())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["entity", "line", "term", "n"])

        for text, spans in _texts_with(batches, rows):
            own = [(e, line) for e, line in entities(text, spans).items() if whom is None or is_named(whom, text_hash(e))]
            words = {t for t, _, _ in terms(text, spans)} if own else ()
            words = [t for t in words if what is None or is_named(what, text_hash(t))]
            for entity, line in own:
                for term in words:
                    counts[entity, line, term] += 1
                if len(counts) > FLUSH_TERMS:
                    yield flush()
        yield flush()

    return run


def _mark_scan(wanted: bytes, chosen: bytes):
    """Places of the terms in the chosen texts that hold an entity of theirs, for pairs that a bitmap names."""

    def run(batches):
        rows: list[tuple] = []
        names = ["row_key", "entity", "term", "start", "end"]
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())

        def flush():
            columns = [list(c) for c in zip(*rows)] or [[]] * len(names)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for part in portions(batch, 1):
                for key, raw in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    if not is_named(chosen, key & (1 << 64) - 1):
                        continue
                    text = raw.decode()
                    spans = base_spans(text)
                    places: dict[str, list] = {}
                    for term, a, b in terms(text, spans):
                        places.setdefault(term, []).append((a, b))
                    for entity in entities(text, spans):
                        for term, found in places.items():
                            if is_named(wanted, pair_key(entity, term)):
                                rows += [(key, entity, term, a, b) for a, b in found]
                                if len(rows) > FLUSH_TERMS:
                                    yield flush()
        yield flush()

    return run


def _term_scan(wanted: bytes):
    """(term, documents of the task that hold it) of terms that a bitmap names."""

    def run(batches):
        known, counts = {}, Counter()

        def flush():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
            )
            counts.clear()

        for batch in batches:
            for part in portions(batch, 0):
                for raw in part.column(0).to_pylist():
                    terms = set()
                    for word in set(raw.lower().split()):
                        term = known.get(word, 0)
                        if term == 0:
                            if len(known) > FLUSH_TERMS:
                                known.clear()
                            term = word.strip(_EDGE_BYTES)
                            if not is_named(wanted, xxhash.xxh64_intdigest(term, 42)):
                                term = None
                            known[word] = term
                        if term:
                            terms.add(term)
                    counts.update(t.decode() for t in terms)
                if len(counts) > FLUSH_TERMS:
                    yield from flush()
        yield from flush()

    return run


def _chance(n_lines, n_entity_lines, share, trials: float):
    """Chernoff's bound on that many of the entity's lines meeting a term of that share, times the pairs tried."""
    miss, met = n_entity_lines - n_lines, n_lines / n_entity_lines
    far = n_lines * F.log(met / share) + F.when(miss > 0, miss * (F.log1p(-met) - F.log1p(-share))).otherwise(0.0)
    return F.when(met > share, F.least(F.lit(trials) * F.exp(-far), F.lit(1.0))).otherwise(1.0)


def least_lines(trials: float, total: float) -> int:
    """The least number of lines that can be evidence among so many pairs, in a corpus of so many documents.

    With k lines, all of which meet the term, a pair's chance is at least trials (k / total)^k, as the term
    stands in k documents or more; lines that don't meet it only add to the chance. The bound falls up to
    k = total / e, so below the first k that passes none can; from total / e on it says nothing.
    """
    k = 1
    while k < total / math.e and trials * (k / total) ** k > MAX_CHANCE * SLACK:
        k += 1
    return k


def disclosure(found: DataFrame, docs: DataFrame, text: str = "text", pruned: bool = True) -> DataFrame:
    """entity, term, n_both, n_term, n_entity, disclosed, chance of pairs that two lines or one unlikely one back.

    Counts are of documents and taken over all of them, and combined in map tasks. Entities come first, then
    the documents of the terms that meet them (thinned by a bitmap of bounded size), then the pairs of entities
    and terms within the bounds. `chance` counts distinct lines of the entity instead of documents, as copies
    of one line prove no more than one. Without `pruned` all pairs are made.
    """
    raw = docs.select(
        F.xxhash64("doc_id", text).alias("row_key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw")
    )
    near = found.where(F.size("held") > 0).select("row_key", F.explode("held").alias("c")).select("row_key", "c.*")
    lines = near.groupBy("entity", "line").agg(F.count("*").alias("n"))
    owners = settle(lines.groupBy("entity").agg(F.sum("n").alias("n_entity"), F.count("*").alias("n_entity_lines")))
    sizes = found.agg(F.count("*"), F.sum(F.size("held") * F.col("n_met"))).first()
    total, trials = float(max(sizes[0], 1)), float(sizes[1] or 0)
    rows = whom = what = None
    low, high = 1, total
    if pruned:
        low = least_lines(trials, total)
        owners = settle(owners.where(F.col("n_entity_lines") >= low))
        whom = key_bitmap(owners.select(F.xxhash64("entity").alias("key")), "key")
        # a named entity's rows; the bitmap is of bounded size and names a few others, which bring no pair
        rows = key_bitmap(near.join(owners.select("entity"), "entity", "left_semi").select("row_key"), "row_key")
        most = owners.agg(F.max("n_entity")).first()[0] or 0
        high = total ** (1 - GENERALISE_AT) * most ** GENERALISE_AT * SLACK
    # terms of all rows with an entity are counted, as many as the corpus has, whatever the bounds let through
    met = key_bitmap(raw.mapInArrow(_met_scan(key_bitmap(near.select("row_key"), "row_key")), "key bigint"), "key")
    held = raw.select("raw").mapInArrow(_term_scan(met), "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n_term"))
    held = settle(held.where(F.col("n_term").between(low, high)) if pruned else held)
    if pruned:
        what = key_bitmap(held.select(F.xxhash64("term").alias("key")), "key")
    each = raw.mapInArrow(_pair_scan(rows, whom, what), PAIRS).groupBy("entity", "line", "term").agg(F.sum("n").alias("n"))
    # settled, so that the joins deal both sides anew and an entity with very many terms can be split
    pairs = settle(each.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("n_lines")))
    information = F.log(F.lit(total) / F.col("n_entity"))
    mutual = F.log(F.col("n_both") * total / (F.col("n_term") * F.col("n_entity")))
    chance = _chance(F.col("n_lines"), F.col("n_entity_lines"), F.col("n_term") / total, trials)
    rows = pairs.join(held, "term").join(owners, "entity").withColumns({
        "disclosed": F.when(information > 0, mutual / information), "chance": chance,
    })
    return rows.where((F.col("n_lines") > 1) | (F.col("chance") <= MAX_CHANCE)).drop("n_lines", "n_entity_lines")


def _found(docs: DataFrame, text: str) -> DataFrame:
    rows = docs.select("doc_id", F.col(text).alias("text"), F.xxhash64("doc_id", text).alias("row_key"))
    return settle(map_texts(rows, _scan, FOUND, ("doc_id", "row_key")))


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, row_key, counts of the base kinds, base_sha256, all spans (array), n_term, n_broad.

    `term` marks a word to remove, `broad` one to generalise, wherever it stands in a document with the
    entity. Null and empty texts have no spans. Rows that repeat count as documents of their own, but their
    lines count once. An empty table gives none; other columns are ignored.
    """
    found = _found(docs, text)
    place = F.when(F.col("disclosed") >= REMOVE_AT, len(KINDS)).otherwise(len(KINDS) + 1).alias("place")
    near = disclosure(found, docs, text).where((F.col("disclosed") >= GENERALISE_AT) & (F.col("chance") <= MAX_CHANCE))
    # settled, so that the join deals both sides anew and an entity in very many rows can be split
    risky = settle(near.select("entity", "term", place))
    wanted = key_bitmap(risky.select(F.xxhash64(F.concat("entity", "term")).alias("key")), "key")
    raw = docs.select(
        F.xxhash64("doc_id", text).alias("row_key"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("raw")
    )
    holders = found.select("row_key", F.explode("held.entity").alias("entity")).join(risky.select("entity").distinct(), "entity", "left_semi")
    chosen = key_bitmap(holders.select("row_key"), "row_key")
    marks = settle(raw.mapInArrow(_mark_scan(wanted, chosen), MARKS))
    marked = marks.join(risky, ["entity", "term"]).groupBy("row_key", "start", "end").agg(F.min("place").alias("place"))
    kind = F.when(F.col("place") == len(KINDS), VERDICTS[0]).otherwise(VERDICTS[1])
    more = marked.groupBy("row_key").agg(
        F.collect_list(F.struct("start", F.col("place").cast("int").alias("place"), "end", kind.alias("kind"))).alias("more")
    )
    rows = found.drop("held", "n_met").join(settle(more), "row_key", "left")
    extra = F.coalesce("more", F.array().cast(f"array<{SPAN}>"))

    def count(name):
        return F.size(F.filter(extra, lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return rows.select(
        "doc_id", "row_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.array_sort(F.array_distinct(F.concat("base", extra))).alias("spans"), *map(count, VERDICTS),
    )


def _general(word: str) -> str:
    if any(c.isdigit() for c in word):
        return "[code]"
    return "[name]" if word[:1].isupper() else "[word]"


def clean(text: str, spans: list) -> str:
    """The text with entities and removed terms replaced by their kind, broad ones by a class of words."""
    out, at = [], 0
    for s in spans:
        if s["start"] < at:
            continue
        out.append(text[at:s["start"]])
        out.append(_general(text[s["start"]:s["end"]]) if s["kind"] == "broad" else f"[{s['kind']}]")
        at = s["end"]
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with their own columns, personal data and disclosing terms replaced in `text`."""
    spans = pii_spans(docs).where(F.size("spans") > 0).select(
        F.col("row_key").alias("__key"), F.col("spans").alias("__spans")
    ).dropDuplicates(["__key"])
    rows = docs.withColumn("__key", F.xxhash64("doc_id", "text")).join(settle(spans), "__key", "left").drop("__key")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for part in portions(batch, at):
                texts, marks = part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist()
                new = [clean(t, s) if s and t is not None else t for t, s in zip(texts, marks)]
                columns = part.columns[:-1]
                columns[at] = pa.array(new, columns[at].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return rows.mapInArrow(run, docs.schema)


def op5_pii(spark, sf_dir) -> DataFrame:
    return pii_spans(table(spark, sf_dir, "documents")).drop("row_key").withColumn("spans", spans_text(F.col("spans")))


QUERIES = {"op5_pii": op5_pii}
SQL: dict[str, str] = {}
