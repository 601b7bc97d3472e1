"""Many dates in one pass, beside one run per date."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from carespan.operators import population, practice_indicators, series
from carespan.setting import Period
from carespan.sources.derived import AS_OF, SETTING, open_derived
from tests.compare import rows_of
from tests.random_tables import build, write
from tests.test_random import opened

SF = "/root/testdata/sf0.001"
TWELVE = [date(y, m, 1) - timedelta(days=1) for y, m in [(2000, m) for m in range(9, 13)] + [(2001, m) for m in range(1, 9)]]


@pytest.fixture(scope="module")
def random_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("random"))
    write(build(5), folder)
    return opened(spark, folder)


def one_by_one(T, s, ends):
    rows = []
    for end in ends:
        period = Period(end - timedelta(days=300), end)
        df = practice_indicators.yearly_indicators(T, s.but(period=period)).withColumn("fim", F.lit(end))
        rows += rows_of(df.collect(), df.columns)
    return sorted(rows, key=repr)


@pytest.mark.parametrize("gap_mode", ["days", "yyyymmdd"])
def test_ends_equal_single_runs(random_tables, gap_mode):
    s = SETTING.but(gap_mode=gap_mode)
    ends = TWELVE if gap_mode == "days" else [date(2001, 2, 28), date(2001, 3, 1), date(2001, 3, 2), date(2000, 3, 1)]
    df = series.yearly_series(random_tables, s, ends)
    assert rows_of(df.collect(), df.columns) == one_by_one(random_tables, s, ends)


def test_one_pass_over_the_events(spark):
    """The events are scanned and shuffled as often as by one run, whatever the number of ends."""
    T = open_derived(spark, SF)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Scan parquet")

    many, one = series.yearly_series(T, SETTING, TWELVE), practice_indicators.yearly_indicators(T, SETTING)
    assert scans(many) <= scans(one)


def test_dates_equal_single_dates(spark, random_tables):
    days = [AS_OF - timedelta(days=30 * k) for k in range(-1, 20)]
    df = series.links_at(random_tables, spark.createDataFrame([(d,) for d in [*days, days[0], None]], "dia date"))
    got = sorted((r["dia"], r["link_id"]) for r in df.collect())
    expected = sorted((d, r["link_id"]) for d in days for r in population.valid_links(random_tables, d).collect())
    assert got == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_dates(spark, random_tables):
    assert series.links_at(random_tables, spark.createDataFrame([], "dia date")).count() == 0


def test_the_last_date_is_the_population(spark, random_tables):
    one = series.population_series(random_tables, SETTING, spark.createDataFrame([(AS_OF,)], "dia date"))
    linked = entry.BUILDS["linked_population"](random_tables, SETTING)
    people = linked.groupBy("unidade_saude", "cnes", "no_equipe", "nu_ine").agg(F.countDistinct("person_id").alias("pessoas"))
    assert rows_of(one.drop("dia").collect(), one.drop("dia").columns) == rows_of(people.collect(), people.columns)
