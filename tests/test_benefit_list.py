"""The written benefit list: pages, totals, and what a page opens."""

import random
import re

import pytest
from pyspark.sql import functions as F

from carespan.operators import benefits, listing
from carespan.plans import benefit_list
from carespan.sources.derived import SETTING, open_derived
from tests.golden import S, make

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The list in blocks of 7 rows, and its rows as plain tuples in order."""
    T = open_derived(spark, SF)
    path = benefit_list.write_benefit_list(T, SETTING, str(tmp_path_factory.mktemp("list") / "l"), block_rows=7)
    rows = sorted(tuple(r) for r in benefits.benefit_conditions(T, SETTING).collect())
    return benefit_list.BenefitList(spark, path), rows


def matches(unit):
    return lambda r: unit is None or unit.lower() in (r[6] or "").lower() or unit in (r[7] or "")


@pytest.mark.parametrize("unit", [None, "nation_1", "NATION_12", "000001", "nowhere"])
def test_pages(written, unit):
    paged, rows = written
    chosen = [r for r in rows if matches(unit)(r)]
    for size in (3, 7, 500):
        for number in (1, 2, 3, 9, 40):
            got = [tuple(r) for r in paged.page(number, size, unit).collect()]
            assert got == chosen[(number - 1) * size:number * size], (size, number)
    for after in (-1, 0, rows[10][0], rows[11][0] + 1, rows[-1][0]):
        got = [tuple(r) for r in paged.after(after, 9, unit).collect()]
        assert got == [r for r in chosen if r[0] > after][:9]


@pytest.mark.parametrize("unit", [None, "nation_1", "nowhere"])
def test_totals(written, unit):
    paged, rows = written
    chosen = [r for r in rows if matches(unit)(r)]
    total = paged.totals(5, unit).collect()[0].asDict()
    assert total["total"] == len(chosen) and total["total_paginas"] == max(1, -(-len(chosen) // 5))
    for i, kind in enumerate(benefits.PENDING):
        assert total[kind] == sum(r[9 + i] for r in chosen)


def test_a_page_opens_its_block_only(written):
    """Whatever the page's number: the files of one or two blocks, and the totals none at all."""
    paged, rows = written
    for page in (paged.page(2, 7), paged.page(len(rows) // 7, 7), paged.after(rows[20][0], 5)):
        scan = page._jdf.queryExecution().executedPlan().toString()
        named = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan).group(1)
        assert 1 <= len(re.findall(r"(?<=[ (,])\d+", named)) <= 2, named
    assert "GreaterThanOrEqual(posicao" in paged.page(2, 7)._jdf.queryExecution().executedPlan().toString()
    assert "linhas" not in paged.totals()._jdf.queryExecution().executedPlan().toString()


def test_an_empty_list(spark, tmp_path):
    path = benefit_list.write_benefit_list(make(spark), S, str(tmp_path / "none"))
    paged = benefit_list.BenefitList(spark, path)
    assert paged.page(1).count() == paged.after(0).count() == 0
    assert paged.totals().collect()[0]["total"] == 0


@pytest.mark.parametrize("seed", range(3))
def test_numbered(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, "a", "b", "ção"]), rng.choice([None, *range(5)]), i) for i in range(rng.choice([1, 400]))]
    rows += [("hot", 1, 1000 + i) for i in range(300)]  # one value with a large share of the rows
    df = spark.createDataFrame(rows, "a string, b int, i int").repartition(5)
    got = listing.numbered(df, *listing.ascending("a", "b"), name="at", first=0).collect()
    assert sorted(r["at"] for r in got) == list(range(len(rows)))
    assert sorted(r["i"] for r in got) == sorted(r[2] for r in rows)
    last = lambda v: (v is None, v if v is not None else "")
    keys = [(last(r["a"]), (r["b"] is None, r["b"] or 0)) for r in sorted(got, key=lambda r: r["at"])]
    assert keys == sorted(keys)


def test_numbered_of_nothing(spark):
    assert listing.numbered(spark.range(0), F.col("id").asc()).count() == 0
