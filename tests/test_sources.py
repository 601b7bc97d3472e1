"""Lake, catalog and operational sources; list tools."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from carespan.operators import listing, practice_indicators, ratio_indicators
from carespan.sources.derived import SETTING, open_derived, operational_reader
from carespan.sources.lake import gathered, open_bucketed, open_lake, save_bucketed, within, write_lake
from carespan.sources.operational import EVENT_TABLES, jdbc_reader, open_operational
from carespan.sources.schemas import COLUMNS, FACTS
from tests.compare import rows_of
from tests.golden import AS_OF, S, linked, make

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def derived(spark):
    return open_derived(spark, SF)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return rows_of(a.collect(), a.columns) == rows_of(b.collect(), b.columns)


def test_lake_round_trip_and_pruning(spark, derived, tmp_path):
    write_lake(derived, str(tmp_path))
    lake = open_lake(spark, str(tmp_path))
    for name in ("encounter", "group_activity", "person"):
        assert same(lake[name].select(*COLUMNS[name]), derived[name])
    for build in (ratio_indicators.indicator_c1, practice_indicators.indicator_c6):
        assert same(build(lake, SETTING), build(derived, SETTING))
    plan = plan_of(within(lake["encounter"], date(2001, 1, 1), date(2001, 3, 31)).select("person_id"))
    assert "(event_month" in plan.split("PartitionFilters")[1] and "GreaterThanOrEqual(event_date" in plan
    # only the columns asked for are read
    assert "ReadSchema: struct<person_id:bigint,event_date:date>" in plan


def test_facts_have_dates():
    assert all("event_date" in COLUMNS[name] for name in FACTS)


def test_bucketed_tables_need_no_shuffle_by_person(spark, derived, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    try:
        save_bucketed(derived, "bucketed", 4, ("person", "vaccination"))
        tables = open_bucketed(spark, "bucketed")
        joined = tables["vaccination"].join(tables["person"].hint("merge"), "person_id").groupBy("person_id").count()
        assert "Exchange" not in plan_of(joined)
        assert joined.agg(F.sum("count")).collect()[0][0] == derived["vaccination"].count()
        # the months of a period only, and still no exchange by person
        save_bucketed(derived, "bucketed", 4)
        tables = open_bucketed(spark, "bucketed")
        plan = plan_of(practice_indicators.yearly_care(tables, SETTING))
        assert "(event_month" in plan.split("PartitionFilters")[1]
        assert same(practice_indicators.indicator_c4(tables, SETTING), practice_indicators.indicator_c4(derived, SETTING))
        year = within(tables["vaccination"], date(2001, 1, 1), date(2001, 3, 31))
        plan = plan_of(year.groupBy("person_id").count())
        assert "(event_month" in plan.split("PartitionFilters")[1] and "Exchange" not in plan
    finally:
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_operational_schema(spark, derived, tmp_path):
    read = operational_reader(derived)
    tables = open_operational(read)
    write_lake(tables, str(tmp_path))
    lake = open_lake(spark, str(tmp_path))
    for name in COLUMNS:
        assert same(lake[name].select(*COLUMNS[name]), derived[name]), name
    for build in (ratio_indicators.indicator_b4, practice_indicators.indicator_c3):
        assert same(build(tables, SETTING), build(derived, SETTING))
    year = open_operational(read, since=date(2001, 1, 1), until=date(2001, 3, 31))["vaccination"]
    low, high = year.agg(F.min("event_date"), F.max("event_date")).collect()[0]
    assert date(2001, 1, 1) <= low and high <= date(2001, 3, 31)


def test_event_tables_are_not_read_through_one_connection(spark):
    read = jdbc_reader(spark, "jdbc:none", {})
    assert "tb_fat_atendimento_individual" in EVENT_TABLES
    for table in EVENT_TABLES:
        with pytest.raises(ValueError):
            read(table)


def test_listing(spark):
    df = spark.createDataFrame(
        [("Norte", "10", 2, ["a"], date(2024, 1, 2)), (None, "20", None, ["b", "c"], None), ("norte 2", "30", 1, [], date(2023, 1, 1))],
        "unidade_saude string, cnes string, n int, tags array<string>, d date",
    )

    def codes(rows):
        return [r["cnes"] for r in rows.collect()]

    assert codes(listing.filter_unit(df, "NORTE")) == ["10", "30"] and codes(listing.filter_unit(df, "2")) == ["20", "30"]
    assert codes(listing.search_rows(df, "B, C")) == ["20"] and codes(listing.search_rows(df, "2024", ["d"])) == ["10"]
    assert codes(listing.sort_rows(df, "unidade_saude")) == ["20", "10", "30"]
    assert codes(listing.sort_rows(df, "n")) == ["20", "30", "10"] and codes(listing.sort_rows(df, "n", True)) == ["10", "30", "20"]
    assert codes(listing.sort_rows(df, "tags")) == ["30", "10", "20"]
    assert codes(listing.ordered(df, "unidade_saude")) == ["10", "30", "20"]
    assert codes(listing.page_after(df, "cnes", "10", 1)) == ["20"] and codes(listing.page_after(df, "cnes", None, 2)) == ["10", "20"]
    assert listing.json_rows(df.where("cnes = '20'")).collect()[0][0] == (
        '{"unidade_saude":null,"cnes":"20","n":null,"tags":["b","c"],"d":null}'
    )


def test_masked_list(spark):
    T = make(spark, **linked({"person_id": 1, "name": "ANA MARIA", "cns": "700000000000005", "homeless": 1}))
    from carespan.operators.cohorts import homeless_cohort

    row = listing.masked(homeless_cohort(T, S)).collect()[0]
    assert (row["nome"], row["cns"], row["cpf"]) == ("A.M", "*" * 12 + "005", "")
    assert AS_OF == S.as_of


def test_large_months_are_split_for_the_write(spark, derived):
    plan = plan_of(gathered(derived["group_activity"].withColumn("m", F.month("event_date")), "m"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
