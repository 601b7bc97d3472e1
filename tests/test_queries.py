"""Every registered query beside its DuckDB text on the smallest test files, and its plan."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import database, difference

SF = "/root/testdata/sf0.001"
TEXTS = entry.oracle_sql()
FORBIDDEN = (
    "CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas"
)


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in entry.TEXT_QUERIES])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert difference(df, con, TEXTS[name]) is None
    assert not re.search(FORBIDDEN, df._jdf.queryExecution().executedPlan().toString())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
