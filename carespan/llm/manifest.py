"""Operator 11: a Merkle manifest of a table, by lag and lead windows.

Rows become leaves, numbered within their group by range partitions: a task knows a row's place in its
partition, and the counts of partitions before it are added. Leaves of a group are cut into blocks of
512 (three levels of eight). Within a block, per level, lag and lead columns at the fixed offsets 1 to 7
times 8^level supply the siblings of a first-child row, masked by its slot and by the length of its run;
first-child rows hash parents. The roots of blocks are the leaves of the next round, a 512th of the
rows, until each group has one node; subroots then are the leaves of one last group. The way back joins
each round's rows with the paths of their blocks. No window holds more than a block, whatever the size
of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carespan.llm.common import settle, table

FAN_OUT = 8
LEVELS = 3
BLOCK = FAN_OUT ** LEVELS
RANGE_ROWS = 200_000
MIN_RANGES = 16
MAX_RANGES = 8192
TAMPER_EVERY = 3
PARTS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*texts) -> Column:
    """Lowercase hex SHA-256 of the inputs, concatenated."""
    return F.sha2(F.concat(*texts), 256)


def encoded(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_name(value: Column) -> Column:
    """A name that is never null and sorts as the value does: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """The rows with `place` (from 0) and `nodes` (their number) in each group, by the given order.

    Rows that the order doesn't tell apart are told apart by their place in the input, so equal rows
    spread over ranges, too. Ranges are at most MAX_RANGES, which bounds the window over their counts.
    """
    rows = settle(rows.withColumn("__row", F.monotonically_increasing_id()))
    ranges = max(MIN_RANGES, min(MAX_RANGES, -(-rows.count() // RANGE_ROWS)))
    keys = (group, *order, "__row")
    ranged = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()  # partition in the upper bits, place in the lower 33
    ranged = settle(ranged.drop("__row").withColumns({
        "__range": F.shiftright(at, 33), "__at": at.bitwiseAND(F.lit((1 << 33) - 1)),
    }))
    counts = ranged.groupBy(group, "__range").agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({
        "__before": F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")),
        "nodes": F.sum("__n").over(whole),
    }).drop("__n")
    placed = ranged.join(counts, [group, "__range"])
    place = F.col("__before") + F.col("__at") - F.col("__first")
    return placed.withColumn("place", place).drop("__range", "__at", "__first", "__before")


def _div(a: Column, by: int) -> Column:
    return F.call_function("div", a, F.lit(by)).cast("long")


def with_siblings(rows: DataFrame) -> DataFrame:
    """The rows (grp, place, nodes, node) with the siblings of their ancestors in the block and its root.

    Adds `block`, `path` (left and right siblings per level, joined; no entry at a level where the group
    has one node) and, in the first row of a block, `top`, the node that the block comes to.
    """
    rows = rows.withColumn("block", _div(F.col("place"), BLOCK))
    block = Window.partitionBy("grp", "block").orderBy("place")
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    node, path = "node", []
    for level in range(LEVELS):
        width = FAN_OUT ** level
        first = F.col("place") % width == 0  # the row that stands for a node of this level
        at = _div(F.col("place"), width)
        nodes = _div(F.col("nodes") + (width - 1), width)
        slot = (at % FAN_OUT).cast("int")
        run = F.least(F.lit(FAN_OUT).cast("long"), nodes - at + slot).cast("int")
        lags = [
            F.when(slot >= k, F.lag(node, k * width).over(block)) for k in range(FAN_OUT - 1, 0, -1)
        ]
        leads = [F.when(slot + k < run, F.lead(node, k * width).over(block)) for k in range(1, FAN_OUT)]
        left, right, up = f"left_{level}", f"right_{level}", f"node_{level + 1}"
        rows = rows.withColumns({
            left: F.when(first, F.concat_ws("", *lags)), right: F.when(first, F.concat_ws("", *leads)),
        })
        joined = digest(node, right)
        rows = rows.withColumn(
            up, F.when(F.col("place") % (width * FAN_OUT) == 0, F.when(nodes > 1, joined).otherwise(F.col(node)))
        )
        if level:  # the rows below a node have the siblings of its first row
            rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in (left, right)})
        path.append(F.when(nodes > 1, F.struct(F.col(left).alias("left"), F.col(right).alias("right"))))
        node = up
    inner = [f"{side}_{level}" for level in range(LEVELS) for side in ("left", "right")]
    inner += [f"node_{level}" for level in range(1, LEVELS)]
    return rows.withColumn("path", F.filter(F.array(*path), lambda p: p.isNotNull())).withColumnRenamed(
        node, "top"
    ).drop(*inner)


def climbed(rows: DataFrame) -> list[DataFrame]:
    """The rows (grp, place, nodes, node, ...) and, round by round, what is left of them.

    A round takes three levels and leaves a 512th of the rows; the last one has one node per group. The
    number of rounds follows the largest group. Each round's nodes are written, so no loss goes further back.
    """
    rounds, largest = [rows], rows.agg(F.max("nodes")).first()[0] or 0
    while largest > 1:
        tops = with_siblings(rounds[-1].select("grp", "place", "nodes", "node")).where(F.col("top").isNotNull())
        rounds.append(settle(tops.select(
            "grp", F.col("block").alias("place"), _div(F.col("nodes") + (BLOCK - 1), BLOCK).alias("nodes"),
            F.col("top").alias("node"),
        )))
        largest = -(-largest // BLOCK)
    return rounds


def descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The rows of the first round with `path`, from the row to the end of the path `above` its group.

    `above` has grp, `above` (a path) and columns to carry to every row of the group.
    """
    carried = [c for c in above.columns if c not in ("grp", "above")]
    paths = above.withColumn("block", F.lit(0).cast("long"))
    if len(rounds) == 1:
        return rounds[0].join(paths.drop("block"), "grp").withColumnRenamed("above", "path")
    for nodes in reversed(rounds[:-1]):
        own = with_siblings(nodes).drop("top").join(paths, ["grp", "block"]).drop("block")
        own = own.withColumn("path", F.concat("path", "above")).drop("above")
        paths = own.select("grp", F.col("place").alias("block"), F.col("path").alias("above"), *carried)
    return own


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings come to."""
    return F.aggregate(path, leaf, lambda node, p: digest(p["left"], node, p["right"]))


def leaves(docs: DataFrame, group: str = "lang", order: str = "doc_id", parts: tuple = PARTS) -> DataFrame:
    """Per row: its order, `grp`, `node` (the leaf) and `other`, the leaf of the tampered row.

    Tampering lower-cases the A-Z of the text of rows whose decimal number has a CRC-32 that 3 divides.
    """
    def leaf(text):
        return digest(*[encoded(text if p == "text" else F.col(p)) for p in parts])

    hit = F.crc32(F.col(order).cast("string").cast("binary")) % TAMPER_EVERY == 0
    lower = F.translate(F.col("text"), UPPER, LOWER)
    return docs.select(
        F.col(order), group_name(F.col(group)).alias("grp"), leaf(F.col("text")).alias("node"),
        F.when(hit, leaf(lower)).alias("other"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root, proof, folded root and verdict of every row, one row out per row in.

    Leaves of a language ascend by doc_id; a null doc_id comes first, equal ones by their leaf (equal
    rows have equal leaves, so their order is free). Null columns are encoded as `-`; a null language is
    a group of its own, the first. A row without a doc_id is not tampered with. `proof` lists the
    siblings per level, left and right, from the leaf to the root; it is empty for a table of one row.
    An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rounds = climbed(numbered(leaves(docs), "grp", "doc_id", "node"))
    subroots = rounds[-1].select(F.lit("").alias("grp"), F.col("grp").alias("name"), "node")
    top = climbed(numbered(subroots, "grp", "name"))
    whole = top[-1].select("grp", F.array().cast(PATH).alias("above"), F.col("node").alias("root"))
    across = descended(top, whole).select(
        F.col("name").alias("grp"), F.col("path").alias("above"), F.col("node").alias("subroot"), "root"
    )
    rows = descended(rounds, across).withColumnsRenamed({"path": "proof", "node": "leaf"})
    rows = rows.withColumn("folded_root", folded(F.coalesce("other", "leaf"), F.col("proof")))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def op11_manifest(spark, sf_dir) -> DataFrame:
    rows = manifest(table(spark, sf_dir, "documents"))
    siblings = F.transform("proof", lambda p: F.concat(p["left"], p["right"]))
    return rows.withColumn("proof_sha256", F.sha2(F.array_join(siblings, ""), 256)).drop("proof")


QUERIES = {"op11_manifest": op11_manifest}
SQL: dict[str, str] = {}
