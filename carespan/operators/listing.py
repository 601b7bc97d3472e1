"""What a reader of a list does with it: filter, search, sort, page, print."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.functions.scalars import blank
from carespan.session import written


def filter_unit(df: DataFrame, text: str, name: str = "unidade_saude", code: str | None = "cnes") -> DataFrame:
    """Rows whose unit name contains the text, in any case, or whose unit code contains it."""
    hit = F.lower(blank(F.col(name))).contains(text.lower())
    if code is not None:
        hit = hit | blank(F.col(code)).contains(text)
    return df.where(hit)


def filter_team(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("no_equipe") == name)


def _text(df: DataFrame, column: str):
    value = F.col(column)
    if dict(df.dtypes)[column].startswith("array"):
        value = F.array_join(value, ", ")
    return blank(value)


def search_rows(df: DataFrame, text: str, columns=None) -> DataFrame:
    """Rows with the text, in any case, in one of the columns (all, if none are named)."""
    hit = F.lit(False)
    for column in columns or df.columns:
        hit = hit | F.lower(_text(df, column)).contains(text.lower())
    return df.where(hit)


NUMBERS = ("int", "bigint", "smallint", "tinyint", "double", "float")


def sort_key(df: DataFrame, column: str, descending: bool = False) -> Column:
    """Order of one column: numbers by value, all else as text with missing values as empty text."""
    kind = dict(df.dtypes)[column]
    if kind in NUMBERS or kind.startswith("decimal"):
        key = F.col(column)
        return key.desc_nulls_last() if descending else key.asc_nulls_first()
    key = _text(df, column)
    return key.desc() if descending else key.asc()


def sort_rows(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sort by one column: numbers by value, all else as text with missing values as empty text."""
    return df.orderBy(sort_key(df, column, descending))


def ascending(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending order with missing values last."""
    return df.orderBy(*ascending(*columns))


def numbered(df: DataFrame, *order: Column, name: str = "posicao", first: int = 1) -> DataFrame:
    """The rows with their gapless place in an order, as a long from ``first`` on.

    Rows are dealt into ranges of the order and sorted within them; a row's place is its place in the
    range and the rows of the ranges before, of which the driver sees one count each. Rows that the order
    leaves equal are told apart by where they stood, so a value that very many share is spread over ranges, too.
    """
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    keys = [*order, F.col("_row")]
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in the lower 33
    ranged = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumns({
        "_range": F.shiftright(at, 33), "_at": at.bitwiseAND(F.lit((1 << 33) - 1)),
    }))
    before, offsets = first, []
    for part in sorted(ranged.groupBy("_range").count().collect()):
        offsets.append((part["_range"], before))
        before += part["count"]
    starts = ranged.sparkSession.createDataFrame(offsets, "_range bigint, _start bigint")
    return ranged.join(starts, "_range").withColumn(name, F.col("_start") + F.col("_at")).drop("_range", "_at", "_start")


def page_after(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """The next rows by key."""
    rows = df if after is None else df.where(F.col(key) > after)
    return rows.orderBy(key).limit(size)


def masked(df: DataFrame, documents=("cns", "cpf"), names=("nome",)) -> DataFrame:
    """Hide documents but for the last three digits, and names but for the initials."""
    kept = {c: F.regexp_replace(blank(F.col(c)), r".(?=.{3})", "*") for c in documents if c in df.columns}
    for name in names:
        if name in df.columns:
            words = F.split(blank(F.col(name)), r"\s+")
            kept[name] = F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), ".")
    return df.withColumns(kept)


def json_rows(df: DataFrame) -> DataFrame:
    """One JSON object per row, dates in ISO form, missing values written as null."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}).alias("json"))
