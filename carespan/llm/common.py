"""What the text operators share: reading, settled intermediates, maps over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from carespan.session import shared_folder

PORTION_BYTES = 2 << 20
NAMED_BITS = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, *partition_by: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again.

    Cuts lineage without executor storage, so a lost executor costs only its running tasks. The files
    go when the session's file system is closed.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.partitionBy(*partition_by).parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def text_key() -> Column:
    """With doc_id, the identity of a row's text; equal for repeated rows."""
    return F.xxhash64(F.col("text")).alias("text_key")


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Null-safe equality on some columns."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def portions(batch: pa.RecordBatch, index: int, limit: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows whose texts have about `limit` bytes; a longer text stands alone."""
    sizes = pc.binary_length(batch.column(index)).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + (size or 0) > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size or 0
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(
    docs: DataFrame, work: Callable[[], Callable], fields: str, keep: tuple = ("doc_id",), text: str = "text",
) -> DataFrame:
    """Per row the columns `keep` and what `work` finds in the text.

    `work()` is called once per task and returns a function from a list of texts (UTF-8 bytes, b"" for
    null) to a list of tuples, in the order of `fields`.
    """
    chosen = docs.select(*keep, F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("__text"))
    added = _parse_datatype_string(fields)
    schema = StructType([*(f for f in chosen.schema.fields if f.name != "__text"), *added.fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        made = work()
        for batch in batches:
            at = batch.num_columns - 1
            for part in portions(batch, at):
                found = made(part.column(at).to_pylist())
                columns = [part.column(i).cast(arrow.field(i).type) for i in range(at)]
                columns += [pa.array(v, arrow.field(at + i).type) for i, v in enumerate(zip(*found))]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return chosen.mapInArrow(run, schema)


def key_bitmap(keys: DataFrame, column: str, bits: int = NAMED_BITS) -> bytes:
    """A bitmap of a fixed size that names the keys (long). What it doesn't name is not among them."""
    bit = F.pmod(F.col(column), F.lit(bits)) + 1  # the functions count bits from 1
    rows = keys.groupBy(F.bitmap_bucket_number(bit).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap")
    ).collect()  # bits / 8 bytes at most
    whole = bytearray(bits // 8)
    for bucket, part in rows:
        at = (bucket - 1) * len(part)
        whole[at:at + len(part)] = part
    return bytes(whole)


def is_named(bitmap: bytes, keys):
    """Whether a bitmap names the keys: one key (int), or an array of them. The bitmap stays packed."""
    if isinstance(keys, int):
        return bitmap[keys % (8 * len(bitmap)) >> 3] >> (keys & 7) & 1 == 1
    packed, at = np.frombuffer(bitmap, np.uint8), np.mod(keys, 8 * len(bitmap))
    return (packed[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def spans_text(spans: Column) -> Column:
    """Spans (start, place of the kind, end, kind) as kind:start:end by start, then kind, comma-joined."""
    named = F.transform(
        F.array_sort(F.array_distinct(spans)),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(named, ",")


SPAN = "struct<start:bigint,place:int,end:bigint,kind:string>"
