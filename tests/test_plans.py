"""What the plans of all registered queries must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from carespan.operators import benefits, practice_indicators, quality
from carespan.session import RUNTIME, shared_folder, tune
from carespan.sources.derived import SETTING, open_derived

SF = "/root/testdata/sf0.001"

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_check():
    assert set(entry.queries()) - set(entry.TEXT_QUERIES) <= set(entry.oracle_sql())


def test_runtime_settings(spark):
    tune(spark)
    assert all(spark.conf.get(k) == v for k, v in RUNTIME.items())
    assert shared_folder(spark) != shared_folder(spark)


def test_events_are_reduced_before_the_shuffle(spark):
    """A person's events are one row per map task before they are exchanged."""
    plan = plan_of(practice_indicators.yearly_care(open_derived(spark, SF), SETTING))
    exchange = plan.index("Exchange hashpartitioning(person_id")
    assert "partial_max" in plan[exchange:] and plan.count("Exchange hashpartitioning") == 1


def test_dates_reach_the_scan(spark):
    plan = plan_of(entry.queries()["ind_c1"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan  # only the columns in use are read


def splittable_joins(plan):
    """Keys of the sort-merge joins both sides of which come straight from exchanges."""
    return re.findall(
        r"SortMergeJoin \[(\w+)#[^\n]*\n[^\n]*Sort \[[^\n]*\n[^\n]*Exchange hashpartitioning[^\n]*ENSURE_REQUIREMENTS", plan
    )


def test_hot_people_and_names_can_be_split(spark):
    """A third of all events of one person, or of all people under one name: the skew rule can split them."""
    T = open_derived(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for build, key in (
            (practice_indicators.practices_c2, "who"), (practice_indicators.practices_c3, "who"),
            (quality.duplicate_persons, "group"),
        ):
            plan = plan_of(build(T, SETTING))
            assert "salt" not in plan and key in splittable_joins(plan)
            right = plan[plan.index(f"SortMergeJoin [{key}#"):]
            assert right.count(f"Exchange hashpartitioning({key}#") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_page_of_benefits_names_its_people_to_the_scans(spark):
    page = plan_of(benefits.benefit_page(open_derived(spark, SF), SETTING, after_id=100, size=500))
    assert page.count("Exchange") < plan_of(entry.queries()["benefit_conditions"](spark, SF)).count("Exchange") + 1
    assert "o_custkey" in "".join(x for x in page.split("PushedFilters")[1:])


def test_cohorts_reduce_only_their_own_encounters(spark):
    plan = plan_of(entry.queries()["cohort_indigenous"](spark, SF))
    assert "LeftSemi" in plan


def test_results_do_not_depend_on_partitions(spark):
    T = open_derived(spark, SF)
    results = []
    for partitions in ("1", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(sorted(map(tuple, practice_indicators.indicator_c4(T, SETTING).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_teams_add_up_to_units(spark):
    T = open_derived(spark, SF)
    teams = entry.BUILDS["ind_c1"](T, SETTING).agg(F.sum("numerator"), F.sum("denominator")).collect()
    units = entry.BUILDS["rollup_units"](T, SETTING).agg(F.sum("numerator"), F.sum("denominator")).collect()
    assert teams == units


@pytest.mark.parametrize("name", [f"ind_{n}" for n in ("c1", "b3", "b5", "b6", "c2", "c3", "c4", "c5", "c6", "c7")])
def test_practices_stay_within_the_base(spark, name):
    rows = entry.queries()[name](spark, SF)
    bad = rows.where((F.col("value") < 0) | (F.col("value") > 100))
    assert bad.count() == 0
