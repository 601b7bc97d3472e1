"""Every query beside its DuckDB text on small random tables full of awkward cases."""

import duckdb
import pytest

import __spark_entry__ as entry
from carespan.sources.derived import SETTING
from carespan.sources.schemas import COLUMNS, schema_of
from carespan.sources.tables import Tables
from oracle.queries import texts
from tests.compare import difference
from tests.random_tables import build, write


def opened(spark, folder):
    return Tables({
        n: (lambda n=n: spark.read.schema(schema_of(n)).parquet(f"{folder}/{n}.parquet")) for n in COLUMNS
    })


def check(spark, folder, names):
    tables = opened(spark, folder)
    expected = texts(view=lambda t: f"SELECT * FROM '{folder}/{t}.parquet'")
    con = duckdb.connect()
    return {
        name: found for name in names
        if (found := difference(entry.BUILDS[name](tables, SETTING), con, expected[name]))
    }


HEAVY = ("indicator_long", "band_distribution", "outreach_all")


@pytest.mark.parametrize("seed", [1])
def test_queries_on_random_tables(spark, tmp_path, seed):
    write(build(seed), str(tmp_path))
    assert check(spark, str(tmp_path), [n for n in entry.BUILDS if n not in HEAVY]) == {}
