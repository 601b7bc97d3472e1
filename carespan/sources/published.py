"""Tables that are refreshed together and published in one step.

A run writes into folders of its own and never touches those of earlier runs. What a reader sees is told
by the run's index, a small Parquet table that is written last and says for every table, and for every
month of a table kept by months, which run holds it. A run that fails leaves the newest whole index, and
with it all tables, as they were.

    <root>/<table>/run=<run>/...                     a whole table
    <root>/<table>/run=<run>/<month column>=<m>/...  the months of a table that the run changed
    <root>/indice/carga=<number>                     the index of a run

A table kept by months is refreshed by fingerprints: rows, XOR and sum of row hashes per month. Months
whose rows are those of the index are not written again, months that have no rows any more are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from carespan.session import files_of

INDEX = "indice"
INDEX_ROW = "tabela string, mensal boolean, mes string, run string, n bigint, mistura bigint, soma decimal(38,0)"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"  # how Parquet folders name a missing value


@dataclass(frozen=True)
class Entry:
    """Where a table, or a month of it, is held, and the fingerprint of its rows."""

    tabela: str
    mensal: bool
    mes: str | None
    run: str
    n: int | None = None
    mistura: int | None = None
    soma: object = None

    @property
    def mark(self) -> tuple:
        return self.n, self.mistura, self.soma


def fingerprint(columns) -> list[Column]:
    """Rows, XOR and sum of the row hashes: the same for the same rows in any order, repeated ones too."""
    row = F.xxhash64(*[F.col(c) for c in sorted(columns)])
    return [
        F.count("*").alias("n"), F.bit_xor(row).alias("mistura"),
        F.sum(row.cast("decimal(20,0)")).cast("decimal(38,0)").alias("soma"),
    ]


def _is_one_of(value: Column, wanted: list) -> Column:
    """Whether the value is among those wanted, one of which may be None: a lookup, however many they are."""
    return F.when(value.isNull(), F.lit(None in wanted)).otherwise(value.isin([w for w in wanted if w is not None]))


class Published:
    """Reader and writer of a set of published tables under one folder."""

    def __init__(self, spark: SparkSession, root: str, month: str = "competencia"):
        self.spark, self.root, self.month = spark, root.rstrip("/"), month

    def runs(self) -> list[int]:
        """Numbers of the published runs: those whose index is whole."""
        where, files = files_of(self.spark, f"{self.root}/{INDEX}")
        if not files.exists(where):
            return []
        folders = [f.getPath() for f in files.listStatus(where)]
        jvm = self.spark._jvm.org.apache.hadoop.fs
        return sorted(
            int(p.getName().partition("=")[2]) for p in folders
            if p.getName().startswith("carga=") and files.exists(jvm.Path(p, "_SUCCESS"))
        )

    def index_path(self, number: int) -> str:
        return f"{self.root}/{INDEX}/carga={number:010d}"

    def index(self, number: int | None = None) -> list[Entry]:
        """The entries of a run, the newest if none is named: one per table, or per month of a table."""
        runs = self.runs()
        if not runs:
            return []
        rows = self.spark.read.schema(INDEX_ROW).parquet(self.index_path(runs[-1] if number is None else number))
        return sorted((Entry(**r.asDict()) for r in rows.collect()), key=lambda e: (e.tabela, e.mes or ""))

    def folder(self, entry: Entry) -> str:
        path = f"{self.root}/{entry.tabela}/run={entry.run}"
        return f"{path}/{self.month}={NO_MONTH if entry.mes is None else entry.mes}" if entry.mensal else path

    def read(self, table: str, schema: StructType | str, entries: list[Entry] | None = None) -> DataFrame:
        """A published table with the declared columns; only the folders that the index names are opened."""
        schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
        chosen = [e for e in (self.index() if entries is None else entries) if e.tabela == table]
        paths = [self.folder(e) for e in chosen if e.n != 0]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*paths).select(*schema.fieldNames())

    @contextmanager
    def refresh(self) -> Iterator["Run"]:
        """A run: what it writes is published together when the block ends, and dropped if the block fails."""
        runs = self.runs()
        number = runs[-1] + 1 if runs else 1
        run = Run(self, f"{number:010d}-{uuid.uuid4().hex[:8]}", self.index())
        try:
            yield run
            rows = [(e.tabela, e.mensal, e.mes, e.run, e.n, e.mistura, e.soma) for e in run.entries.values()]
            index = self.spark.createDataFrame(rows, _parse_datatype_string(INDEX_ROW)).coalesce(1)
            index.write.mode("errorifexists").parquet(self.index_path(number))
        except Exception:
            for table in run.touched:
                where, files = files_of(self.spark, f"{self.root}/{table}/run={run.name}")
                files.delete(where, True)
            raise

    def drop_old_runs(self, keep: int = 2) -> None:
        """Delete the indexes of all but the newest runs, and the folders that no index left names."""
        runs = self.runs()
        named = {(e.tabela, e.run) for n in runs[-keep:] for e in self.index(n)}
        tables = {e.tabela for n in runs for e in self.index(n)}
        for number in runs[:-keep]:
            where, files = files_of(self.spark, self.index_path(number))
            files.delete(where, True)
        for table in tables:
            where, files = files_of(self.spark, f"{self.root}/{table}")
            for folder in [f.getPath() for f in files.listStatus(where)]:
                name = folder.getName().partition("=")[2]
                if (table, name) not in named and int(name[:10]) <= runs[-1]:
                    files.delete(folder, True)


class Run:
    """One refresh in progress."""

    def __init__(self, tables: Published, name: str, entries: list[Entry]):
        self.tables, self.name = tables, name
        self.entries = {(e.tabela, e.mes, e.mensal): e for e in entries}
        self.touched: set[str] = set()

    def _write(self, table: str, parts: list[DataFrame], partitions, inside: str = "") -> int | None:
        """Write the parts; 0 if that left no files at all (no rows under partition columns)."""
        self.touched.add(table)
        path = f"{self.tables.root}/{table}/run={self.name}{inside}"
        for rows in parts:
            writer = rows.write.mode("append")
            (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
        where, files = files_of(self.tables.spark, path)
        names = [f.getPath().getName() for f in files.listStatus(where)]
        return None if any(not n.startswith(("_", ".")) for n in names) else 0

    def _put(self, entry: Entry) -> None:
        self.entries[entry.tabela, entry.mes, entry.mensal] = entry

    def whole(self, table: str, parts: list[DataFrame], *partitions: str) -> None:
        """Replace a table."""
        self._put(Entry(table, False, None, self.name, self._write(table, parts, partitions)))

    def whole_if_changed(self, table: str, rows: DataFrame) -> bool:
        """Replace a table, if its rows are not those of the index. Returns whether it was written."""
        told = fingerprint(rows.columns)
        new = tuple(rows.agg(*told).first())
        old = self.entries.get((table, None, False))
        if old is not None and old.mark == new:
            return False
        self._write(table, [rows], ())
        files = self.tables.spark.read.schema(rows.schema).parquet(f"{self.tables.root}/{table}/run={self.name}")
        self._put(Entry(table, False, None, self.name, *files.agg(*told).first()))
        return True

    def one_month(self, table: str, month: str, parts: list[DataFrame], *partitions: str) -> None:
        """Replace one month of a table; the others stay with the runs that wrote them."""
        n = self._write(table, parts, partitions, f"/{self.tables.month}={month}")
        self._put(Entry(table, True, month, self.name, n))

    def months(
        self, table: str, rows: DataFrame, since: str | None = None, besides: tuple = (), gather=None,
    ) -> dict[str, list]:
        """Bring a table kept by months to what ``rows`` are, from month ``since`` on.

        Only months whose fingerprint differs from the index are written; months without rows are left
        out. ``besides`` are columns that tell of the load, not of the row. Returns the months written,
        dropped and kept. The fingerprints are those of what stands in the files, so a source that
        changes while it is read shows as a difference in the next run.
        """
        month, spark = self.tables.month, self.tables.spark
        told = [c for c in rows.columns if c not in (month, *besides)]

        def marks(df):
            found = df.groupBy(F.col(month).cast("string").alias("mes")).agg(*fingerprint(told))
            return {r["mes"]: (r["n"], r["mistura"], r["soma"]) for r in found.collect()}  # one row a month

        def counted(m):
            return since is None or (m is not None and m >= since)

        if since is not None:
            rows = rows.where(F.col(month).cast("string") >= since)
        new = marks(rows)
        old = {e.mes: e for e in self.entries.values() if e.tabela == table and e.mensal and counted(e.mes)}
        written = sorted((m for m in new if m not in old or old[m].mark != new[m]), key=lambda m: m or "")
        dropped = sorted((m for m in old if m not in new), key=lambda m: m or "")
        if written:
            chosen = rows if len(written) == len(new) else rows.where(_is_one_of(F.col(month).cast("string"), written))
            self._write(table, [gather(chosen) if gather else chosen], (month,))
            files = spark.read.schema(rows.schema).parquet(f"{self.tables.root}/{table}/run={self.name}")
            stands = marks(files)
            for m in written:
                self.entries.pop((table, m, True), None)
                if m in stands:
                    self._put(Entry(table, True, m, self.name, *stands[m]))
        for m in dropped:
            del self.entries[table, m, True]
        kept = sorted((m for m in new if m not in written), key=lambda m: m or "")
        return {"written": written, "dropped": dropped, "kept": kept}
