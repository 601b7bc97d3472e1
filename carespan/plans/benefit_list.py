"""The benefit list as a written table that is read page by page.

The list is ordered by person and numbered once; blocks of consecutive rows are the partitions of the
table. A small index holds per block and unit the number of rows, the pending checks and the first and
last person. A page is looked up in the index, which tells the few blocks to open, whatever the page's
number; within a block the rows are sorted, so a reader skips the pages of Parquet files it doesn't need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.operators.benefits import PENDING, benefit_conditions, benefit_totals
from carespan.operators.listing import filter_unit, numbered
from carespan.setting import Setting
from carespan.sources.tables import Tables

BLOCK_ROWS = 20_000
UNIT = ("no_unidade_saude", "nu_cnes")
ROWS = (
    "person_id bigint, nome_bolsa string, nome_esus string, cpf string, cns string, dt_nascimento date,"
    " no_unidade_saude string, nu_cnes string, no_equipe string, pendencia_consulta int, pendencia_vacina int,"
    " pendencia_peso_altura int, pendencia_prenatal int, posicao bigint, bloco bigint"
)


def write_benefit_list(T: Tables, s: Setting, path: str, block_rows: int = BLOCK_ROWS) -> str:
    """Write the list with its index under ``path``, which must not exist."""
    rows = numbered(benefit_conditions(T, s), F.col("person_id").asc(), first=0)
    rows = rows.withColumn("bloco", F.call_function("div", F.col("posicao"), F.lit(block_rows)))
    # blocks are small and of one size, so a task takes whole ones
    rows.repartition("bloco").sortWithinPartitions("bloco", "posicao").write.partitionBy("bloco").parquet(f"{path}/linhas")
    listed = rows.sparkSession.read.schema(ROWS).parquet(f"{path}/linhas")
    listed.groupBy("bloco", *UNIT).agg(
        F.count("*").alias("total"), *[F.sum(p).alias(p) for p in PENDING],
        F.min("person_id").alias("primeira"), F.max("person_id").alias("ultima"),
    ).coalesce(1).write.parquet(f"{path}/indice")  # a row per block and unit of it
    return path


@dataclass(frozen=True)
class BenefitList:
    """Reader of a written list."""

    spark: SparkSession
    path: str

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(f"{self.path}/linhas")

    @property
    def index(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/indice")

    def _of_unit(self, rows: DataFrame, unit: str | None) -> DataFrame:
        return rows if unit is None else filter_unit(rows, unit, *UNIT)

    def _blocks(self, unit: str | None, *where: Column) -> list:
        """Blocks with rows of the unit, in order, with their number of rows: one entry per block."""
        parts = self._of_unit(self.index, unit)
        for condition in where:
            parts = parts.where(condition)
        return sorted(parts.groupBy("bloco").agg(F.sum("total").alias("total")).collect())

    def _taken(self, blocks: list[int], unit: str | None, skip: int, size: int, *where: Column) -> DataFrame:
        rows = self._of_unit(self.rows.where(F.col("bloco").isin(blocks)), unit)
        for condition in where:
            rows = rows.where(condition)
        return rows.orderBy("person_id", "posicao").offset(skip).limit(size).drop("bloco", "posicao")

    def page(self, number: int, size: int = 500, unit: str | None = None) -> DataFrame:
        """Page ``number`` (from 1) of the list, or of the rows whose unit matches a text."""
        start, end = (number - 1) * size, number * size
        before, opened, skip = 0, [], 0
        for block, total in self._blocks(unit):
            if before < end and before + total > start:
                if not opened:
                    skip = start - before
                opened.append(block)
            before += total
        if unit is None:  # the place is known, so the files skip to it
            return self._taken(opened, None, 0, size, F.col("posicao").between(start, end - 1))
        return self._taken(opened, unit, skip, size)

    def after(self, person_id: int, size: int = 500, unit: str | None = None) -> DataFrame:
        """The next rows by person after one; costs the same wherever it lies."""
        left, opened = size, []
        for block, total in self._blocks(unit, F.col("ultima") > person_id):
            if left <= 0:
                break
            # the first block may hold rows up to the person asked for, so it counts for none
            left -= total if opened else 0
            opened.append(block)
        return self._taken(opened, unit, 0, size, F.col("person_id") > person_id)

    def totals(self, page_size: int = 500, unit: str | None = None) -> DataFrame:
        """Beneficiaries, pages and pending checks of the list or of a unit, from the index alone."""
        return benefit_totals(self._of_unit(self.index, unit), page_size, counted=F.sum("total"))
