"""Operator 3: exact Jaccard join of word-shingle sets, in size-banded tiles with bitmap signatures.

1. One pass gives each text's set: its size and a 64-bit name made from the sorted hashes of its
   shingles. Equal sets are one node from then on. The same pass counts shingles in a bounded sketch.
2. A second pass emits each set's prefix: of any two sets that are similar enough, both prefixes hold a
   common shingle, in whatever fixed order shingles are taken. Shingles of crowded sketch cells come
   last, so passages that many documents share seldom bring documents together.
3. Sets that share a prefix shingle meet in tiles (shingle, size band), where enough of both may follow
   the shingle. In the first round each meets only two sets of the tile, so a group of near copies grows
   together without its pairs; in the second, sets that this hasn't joined and that hold a shingle in
   common all meet.
4. A pair is tested by size, then by its bitmaps (each shingle flips one bit, so the bits that differ
   bound the overlap from above), and last by the exact intersection of the sorted arrays.

All identities of shingles and sets are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.llm.common import is_named, key_bitmap, portions, settle, table
from carespan.llm.components import components, gathered_roots

WORDS = 5
SKETCH_BITS = 18
MIN_BITMAP_BITS = 512
BAND_RATIO = 1.25  # neighbouring bands hold all sizes that 80 % allows
SCANNED = "doc_id bigint, row_key bigint, n_shingles bigint, node bigint, bits array<bigint>, cell int, times bigint"
STAMPS = ("stamp_0", "stamp_1", "stamp_2", "stamp_3")
MEMBER = ("n", "place", *STAMPS)  # what a posting tells of its set
POSTINGS = "shingle bigint, node bigint, n int, place int"
ARRAYS = "row_key bigint, node bigint, hashes binary"

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingles(raw: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = raw.lower().split()  # of bytes: A-Z only, at ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, WORDS)
    mixed = np.full(n - width + 1, width, np.uint64)
    for i in range(width):
        mixed += codes[i:n - width + 1 + i] * _FACTORS[i]
    mixed ^= mixed >> np.uint64(30)
    mixed *= _MIX[0]
    mixed ^= mixed >> np.uint64(27)
    mixed *= _MIX[1]
    mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def set_name(hashes: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def prefix_length(n: int) -> int:
    """Shingles of a set of n without which at most 4/5 of it is left."""
    return n - (4 * n + 4) // 5 + 1


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """Each shingle flips the bit that its hash names. As wide as the set is large, in 64-bit words.

    A wide bitmap folds into a narrow one: its second half is laid over the first.
    """
    width = max(MIN_BITMAP_BITS, 1 << int(len(hashes) - 1).bit_length())
    bits = np.bincount((hashes % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _set_scan(batches):
    """Rows of documents (cell null), then the task's counts per sketch cell (cell set)."""
    seen, cells = set(), np.zeros(1 << SKETCH_BITS, np.int64)
    shift = np.uint64(64 - SKETCH_BITS)
    names = ["doc_id", "row_key", "n_shingles", "node", "bits", "cell", "times"]
    types = [*[pa.int64()] * 4, pa.list_(pa.int64()), pa.int32(), pa.int64()]
    for batch in batches:
        for part in portions(batch, 2):
            sizes, nodes, bits, fresh = [], [], [], []
            for raw in part.column(2).to_pylist():
                hashes = shingles(raw)
                node = set_name(hashes) if len(hashes) else None
                sizes.append(len(hashes))
                nodes.append(node)
                bits.append(bitmap(hashes) if len(hashes) else None)
                if node is not None and node not in seen:
                    seen.add(node)
                    fresh.append(hashes)
            if fresh:
                cells += np.bincount((np.concatenate(fresh) >> shift).astype(np.int64), minlength=len(cells))
            none = pa.nulls(part.num_rows)
            columns = [part.column(0), part.column(1), sizes, nodes, bits, none, none]
            yield pa.RecordBatch.from_arrays(
                [c.cast(t) if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names
            )
    filled = np.flatnonzero(cells)
    for at in range(0, len(filled), 10_000):
        some = filled[at:at + 10_000]
        none = [pa.nulls(len(some), t) for t in types[:5]]
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array(some, pa.int32()), pa.array(cells[some], pa.int64())], names=names
        )


def _prefix_scan(levels: bytes, wanted: bytes | None):
    """Postings (shingle, node, size, place) of each set's prefix; a batch emits equal sets once.

    With a bitmap, only shingles that it names.
    """

    def run(batches):
        level = np.frombuffer(levels, np.uint8)
        shift = np.uint64(64 - SKETCH_BITS)
        for batch in batches:
            seen = set()
            for part in portions(batch, 0):
                keys, nodes, sizes, places = [], [], [], []
                for raw in part.column(0).to_pylist():
                    hashes = shingles(raw)
                    node = set_name(hashes)
                    if not len(hashes) or node in seen:
                        continue
                    seen.add(node)
                    crowd = level[(hashes >> shift).astype(np.int64)]
                    first = np.argsort(crowd, kind="stable")[:prefix_length(len(hashes))]
                    prefix, place = hashes[first].view(np.int64), np.arange(len(first), dtype=np.int32)
                    if wanted is not None:
                        named = is_named(wanted, prefix)
                        prefix, place = prefix[named], place[named]
                    keys.append(prefix)
                    places.append(place)
                    nodes.append(np.full(len(prefix), node, np.int64))
                    sizes.append(np.full(len(prefix), len(hashes), np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(v)) for v in (keys, nodes, sizes, places)],
                        names=["shingle", "node", "n", "place"],
                    )

    return run


def _array_scan(wanted: bytes):
    """Arrays of the rows that a bitmap of row keys names."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0)
            named = batch.filter(pa.array(is_named(wanted, keys.to_numpy())))
            for part in portions(named, 1):
                sets = [shingles(raw) for raw in part.column(1).to_pylist()]
                columns = [
                    part.column(0), pa.array([set_name(h) for h in sets], pa.int64()),
                    pa.array([h.tobytes() for h in sets], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row_key", "node", "hashes"])

    return run


def _verify(batches):
    """Links among pairs (a, b, array_a, array_b): the exact intersection of the sorted arrays decides."""
    for batch in batches:
        left, right = batch.column(2), batch.column(3)
        good = []
        for i in range(batch.num_rows):
            x = np.frombuffer(left[i].as_buffer(), np.uint64)
            y = np.frombuffer(right[i].as_buffer(), np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            good.append(9 * both >= 4 * (len(x) + len(y)))  # 100 both >= 80 (x + y - both)
        yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))


def _crowded(sets: DataFrame) -> bytes:
    """Per sketch cell 0, or how crowded it is beyond what chance allows. Bounded by the sketch's size."""
    counts = sets.where("cell is not null").groupBy("cell").agg(F.sum("times").alias("times"))
    total = counts.agg(F.sum("times")).first()[0] or 0
    mean = total / (1 << SKETCH_BITS)
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    for cell, times in counts.where(F.col("times") > mean + 8 * mean ** 0.5 + 64).collect():
        levels[cell] = int(times).bit_length()
    return levels.tobytes()


def _near(n: Column, m: Column) -> Column:
    """Sizes of sets that may be similar enough."""
    return 5 * F.least(n, m) >= 4 * F.greatest(n, m)


def _overlap(n: Column, m: Column) -> Column:
    """The least overlap of similar sets of these sizes: 4/9 of their sum, rounded up."""
    return F.call_function("div", 4 * (n + m) + 8, F.lit(9))


def _may_meet(x: str, y: str) -> Column:
    """Whether the shingle may be the first that two similar sets have in common.

    All they have in common comes from its places on, so enough of both must follow; and their stamps,
    bitmaps folded to four words, must not differ too much.
    """
    n, m = F.col(f"n_{x}"), F.col(f"n_{y}")
    least = _overlap(n, m)
    placed = (F.col(f"place_{x}") <= n - least) & (F.col(f"place_{y}") <= m - least)
    differ = [F.bit_count(F.col(f"{s}_{x}").bitwiseXOR(F.col(f"{s}_{y}"))) for s in STAMPS]
    return _near(n, m) & placed & _bounded(n + m, reduce(Column.__add__, differ))


def _bounded(both: Column, differ: Column) -> Column:
    """Whether sets of these sizes together may overlap enough although so many bits differ."""
    return 9 * (both - differ) >= 8 * both


def _possible(postings: DataFrame) -> DataFrame:
    """Postings of sets for which the tile, or the one of the band below, has a set that may be met.

    The smaller the other set, the later the place may be; the smallest of these tiles decides.
    """
    least = postings.groupBy("shingle", "band").agg(F.min("n").alias("least"))
    below = least.select("shingle", (F.col("band") + 1).alias("band"), F.col("least").alias("below"))
    smallest = F.greatest(F.coalesce("below", "least"), F.call_function("div", 4 * F.col("n") + 4, F.lit(5)))
    rows = postings.join(least, ["shingle", "band"]).join(below, ["shingle", "band"], "left")
    kept = rows.where(F.col("place") <= F.col("n") - _overlap(F.col("n"), smallest))
    return kept.drop("least", "below")


def _shared_postings(postings: Callable[[bytes | None], DataFrame], nodes: DataFrame) -> DataFrame:
    """Postings of prefix shingles that two sets hold, settled with their size band and their set's stamps.

    The first pass finds those shingles by an aggregate that is combined in map tasks. The second emits
    the postings again, thinned by a bitmap of bounded size before they are shuffled.
    """
    ends = postings(None).groupBy("shingle").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = settle(ends.where("low < high").select("shingle"))
    found = postings(key_bitmap(shared, "shingle")).join(shared, "shingle")
    banded = found.distinct().withColumn("band", F.floor(F.log(BAND_RATIO, F.col("n"))).cast("int"))
    return settle(_possible(settle(banded)).join(nodes.select("node", *STAMPS), "node"))


def _stamp(bits: Column, place: int) -> Column:
    """Every fourth word of a bitmap laid over each other."""
    words = F.filter(bits, lambda _, i: i % len(STAMPS) == place)
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _differing_bits(x: Column, y: Column) -> Column:
    """Bits that differ in two bitmaps, the wider folded onto the narrower. Sizes near each other need one fold."""
    width = F.least(F.size(x), F.size(y))

    def folded(bits):
        half = F.zip_with(F.slice(bits, 1, width), F.slice(bits, width + 1, width), lambda a, b: a.bitwiseXOR(b))
        return F.when(F.size(bits) > width, half).otherwise(bits)

    return F.aggregate(
        F.zip_with(folded(x), folded(y), lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, k: s + k
    )


def _links(pairs: DataFrame, nodes: DataFrame, arrays_of: Callable[[bytes], DataFrame]) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough, settled.

    Pairs are thinned by the bound that sizes and bitmaps give. Only texts of sets in the pairs left
    give arrays: one row per set is named in a bitmap of bounded size, and what passes it by chance is
    joined away.
    """

    def side(rows, s, *columns):
        return rows.select(F.col("node").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns])

    marked = pairs.join(side(nodes, "a", "n", "bits"), "a").join(side(nodes, "b", "n", "bits"), "b")
    both = F.col("n_a") + F.col("n_b")
    differ = _differing_bits(F.col("bits_a"), F.col("bits_b"))
    close = settle(marked.where(_near(F.col("n_a"), F.col("n_b")) & _bounded(both, differ)).select("a", "b"))
    used = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    rows = settle(nodes.select("node", "row_key").join(used, "node", "left_semi"))
    arrays = arrays_of(key_bitmap(rows, "row_key")).join(rows, ["node", "row_key"], "left_semi")
    arrays = settle(arrays.select("node", "hashes"))
    whole = close.join(side(arrays, "b", "hashes"), "b").join(side(arrays, "a", "hashes"), "a")
    return settle(whole.select("a", "b", "hashes_a", "hashes_b").mapInArrow(_verify, "a bigint, b bigint"))


def _tile_stars(postings: DataFrame) -> DataFrame:
    """Two sets of each tile (shingle, band), picked by hash, with each other set of the tile."""
    order = F.struct(F.xxhash64("node", "shingle"), "node", *MEMBER)
    hub = F.explode(F.array(F.min(order), F.max(order))).alias("h")
    hubs = postings.groupBy("shingle", "band").agg(hub).select(
        "shingle", "band", *[F.col(f"h.{c}").alias(f"{c}_hub") for c in ("node", *MEMBER)]
    )
    rows = postings.withColumnsRenamed({c: f"{c}_own" for c in MEMBER}).join(hubs, ["shingle", "band"])
    rows = rows.where((F.col("node") != F.col("node_hub")) & _may_meet("own", "hub"))
    return rows.select(F.least("node", "node_hub").alias("a"), F.greatest("node", "node_hub").alias("b")).distinct()


def _undecided(postings: DataFrame, roots: DataFrame) -> DataFrame:
    """Postings with their set's component, of shingles that several components hold."""
    members = postings.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    mixed = members.groupBy("shingle").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y")
    return settle(members.join(mixed.select("shingle"), "shingle", "left_semi"))


def _across_components(members: DataFrame) -> DataFrame:
    """Sets of different components that hold a shingle in common and may be near in size.

    Components meet first, so the members of one are not paired with each other.
    """
    tiles = members.groupBy("shingle", "comp").agg(F.min("n").alias("least"), F.max("n").alias("most"))

    def side(s):
        return tiles.select("shingle", *[F.col(c).alias(f"{c}_{s}") for c in ("comp", "least", "most")])

    meet = side("a").join(side("b"), "shingle").where(
        "comp_a < comp_b and 5 * most_a >= 4 * least_b and 5 * most_b >= 4 * least_a"
    ).select("shingle", "comp_a", "comp_b")

    def rows(s):
        named = {"comp": f"comp_{s}", "node": s, **{c: f"{c}_{s}" for c in MEMBER}}
        return members.drop("band").withColumnsRenamed(named)

    pairs = meet.join(rows("a"), ["shingle", "comp_a"]).join(rows("b"), ["shingle", "comp_b"])
    return pairs.where(_may_meet("a", "b")).select("a", "b").distinct()


def similarity_classes(docs: DataFrame) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id, group of every row.

    component_id is the smallest doc_id that links reach, group the component's own name: null without
    shingles, and different for components whose smallest ids are null or repeat. Null texts and texts without words have no
    shingles and are linked with nothing: their component is their own id. Equal sets are linked, so
    repeated rows fall together. A null doc_id counts only where a component has no other. Empty tables
    give no rows; other columns are ignored.
    """
    row_key = F.xxhash64("doc_id", "text").alias("row_key")
    own = docs.select("doc_id", row_key, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    scanned = settle(own.mapInArrow(_set_scan, SCANNED))
    levels = _crowded(scanned)
    sets = scanned.where("cell is null").drop("cell", "times", "bits")
    one = F.min(F.struct("row_key", F.col("n_shingles").alias("n"), "bits")).alias("one")
    nodes = scanned.where("node is not null").groupBy("node").agg(one).select("node", "one.*")
    nodes = settle(nodes.withColumns({s: _stamp(F.col("bits"), i) for i, s in enumerate(STAMPS)}))
    postings = _shared_postings(
        lambda wanted: own.select("raw").mapInArrow(_prefix_scan(levels, wanted), POSTINGS), nodes
    )

    def arrays_of(wanted: bytes) -> DataFrame:
        return own.select("row_key", "raw").mapInArrow(_array_scan(wanted), ARRAYS)

    links = _links(_tile_stars(postings), nodes, arrays_of)
    roots = settle(gathered_roots(links))
    more = _links(_across_components(_undecided(postings, roots)), nodes, arrays_of)
    roots = components(links.unionByName(more))
    placed = sets.join(roots, "node", "left").withColumn("group", F.coalesce("root", "node"))
    placed = settle(placed.select("doc_id", "row_key", "n_shingles", "group"))
    # settled, so that the join deals both sides anew and a very large group can be split
    least = settle(placed.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("component_id")))
    return placed.join(least, "group", "left").select(
        "doc_id", "row_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "group"
    )


def one_per_class(docs: DataFrame) -> DataFrame:
    """The documents with the smallest doc_id of each class, one row each, with their own columns.

    Rows without words are alone in their classes and all stay.
    """
    classes = settle(similarity_classes(docs))
    # One row per class stays; ids may be null (these come last) or repeat, so the class goes by its own name.
    first = classes.where("n_shingles > 0").groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key"))["row_key"].alias("__row_key")
    ).select("__row_key")
    own = F.xxhash64("doc_id", "text")
    rows = docs.withColumn("__row_key", own)
    blank = rows.where(~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^ \t-\r]")).drop("__row_key")
    kept = rows.where(F.col("text").rlike(r"[^ \t-\r]")).join(settle(first), "__row_key", "left_semi")
    place = F.row_number().over(Window.partitionBy("__row_key").orderBy("__row_key"))
    kept = kept.withColumn("__place", place).where("__place = 1").drop("__place", "__row_key")
    return kept.unionByName(blank)


def op3_ngram_join(spark, sf_dir) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents")).drop("row_key", "group")


QUERIES = {"op3_ngram_join": op3_ngram_join}
SQL: dict[str, str] = {}
