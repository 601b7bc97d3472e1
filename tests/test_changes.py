"""Loads of changes beside full loads and plain differences."""

import collections
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.operators import practice_indicators, ratio_indicators
from carespan.sources import changes
from carespan.sources.derived import SETTING, earlier, open_derived, operational_reader
from carespan.sources.lake import MONTH, within
from carespan.sources.operational import open_operational
from carespan.sources.schemas import COLUMNS, FACTS
from tests.compare import rows_of

SF = "/root/testdata/sf0.001"
ROW = "k int, a string, b int"


def plain(new, old, key):
    """Per key: kind and number of rows, from multisets."""
    groups = [collections.defaultdict(collections.Counter) for _ in range(2)]
    for group, rows in zip(groups, (new, old)):
        for r in rows:
            group[tuple(r[i] for i in key)][r] += 1
    found = {}
    for k in set(groups[0]) | set(groups[1]):
        came, went = groups[0][k] - groups[1][k], groups[1][k] - groups[0][k]
        n = max(came.total(), went.total())
        if not n:
            continue
        if len(key) == 3:
            found[k] = ("inserted" if came else "deleted", n)
        else:
            found[k] = ("inserted" if not groups[1][k] else "deleted" if not groups[0][k] else "changed", n)
    return found


@pytest.mark.parametrize("seed", range(4))
def test_row_changes(spark, seed):
    rng = random.Random(seed)

    def some(n):
        return [(rng.choice([None, *range(12)]), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for _ in range(n)]

    shared = some(30)
    new, old = shared + some(8), shared + some(8)
    for key, at in ((("k",), (0,)), (("k", "b"), (0, 2)), ((), (0, 1, 2))):
        df = changes.row_changes(spark.createDataFrame(new, ROW), spark.createDataFrame(old, ROW), key)
        got = {tuple(r)[:-2]: tuple(r)[-2:] for r in df.collect()}
        assert got == plain(new, old, at)
    assert changes.row_changes(spark.createDataFrame(new, ROW), spark.createDataFrame(new, ROW)).count() == 0


@pytest.fixture(scope="module")
def loads(spark, tmp_path_factory):
    """A lake that saw an earlier state of the source first, and then the source."""
    derived = open_derived(spark, SF)
    published = changes.lake(spark, str(tmp_path_factory.mktemp("lake")))
    first = changes.load_changes(open_operational(operational_reader(earlier(derived))), published)
    second = changes.load_changes(open_operational(operational_reader(derived)), published)
    return derived, published, first, second


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_changes_equal_a_full_load(loads, name):
    derived, published, _, _ = loads
    got, expected = changes.open_published(published)[name].select(*COLUMNS[name]), derived[name]
    assert rows_of(got.collect(), got.columns) == rows_of(expected.collect(), expected.columns)


@pytest.mark.parametrize("name", FACTS)
def test_only_months_that_differ_are_written(loads, name):
    _, published, first, second = loads
    assert "1980-05" in first[name]["written"] and second[name]["dropped"] == ["1980-05"]
    assert "2001-07" in second[name]["written"] and second[name]["kept"]
    runs = {e.mes: e.run[:10] for e in published.index() if e.tabela == name}
    assert all(runs[m] == "0000000001" for m in second[name]["kept"])


def test_tables_that_did_not_change_are_left(loads):
    _, published, _, second = loads
    assert second["facility"]["kept"] == [None] and second["person"]["kept"] == [None]
    assert {e.run[:10] for e in published.index() if e.tabela == "person"} == {"0000000001"}


def test_report_by_key(loads, spark):
    derived, published, _, _ = loads
    rows = {r["mes"]: r for r in changes.load_report(published, "encounter", 1, 2).collect()}
    july = derived["encounter"].where("date_format(event_date, 'yyyy-MM') = '2001-07'").count()
    assert (rows["2001-07"]["inserted"], rows["2001-07"]["deleted"]) == (july, 0)
    assert rows["1980-05"]["deleted"] > 0 and rows["1980-05"]["inserted"] == 0
    changed = derived["encounter"].where("date_format(event_date, 'yyyy-MM') = '2001-06' AND day(event_date) = 15").count()
    assert rows["2001-06"]["changed"] == changed and rows["2001-06"]["inserted"] == rows["2001-06"]["deleted"] == 0


def test_operators_over_the_published_lake(loads):
    derived, published, _, _ = loads
    tables = changes.open_published(published)
    for build in (ratio_indicators.indicator_c1, practice_indicators.indicator_c6):
        got, expected = build(tables, SETTING), build(derived, SETTING)
        assert rows_of(got.collect(), got.columns) == rows_of(expected.collect(), expected.columns)
    plan = within(tables["encounter"], date(2001, 1, 1), date(2001, 3, 31))._jdf.queryExecution().executedPlan().toString()
    assert f"({MONTH}" in plan.split("PartitionFilters")[1]


def test_a_removed_person_and_a_failed_load(loads, spark, tmp_path):
    derived, _, _, _ = loads
    published = changes.lake(spark, str(tmp_path))
    names = ("person", "vaccination")
    changes.load_changes(derived, published, names)
    bad = derived.replacing(vaccination=derived["vaccination"].withColumn("vaccine_codes", F.raise_error(F.lit("no")).cast("string")),
                            person=derived["person"].where("person_id > 3"))
    with pytest.raises(Exception, match="no"):
        changes.load_changes(bad, published, names)
    assert changes.open_published(published)["person"].count() == derived["person"].count()
    less = derived.replacing(person=derived["person"].where("person_id > 3"))
    told = changes.load_changes(less, published, names)
    assert told["person"]["written"] and not told["vaccination"]["written"]
    assert changes.open_published(published)["person"].count() == derived["person"].where("person_id > 3").count()
