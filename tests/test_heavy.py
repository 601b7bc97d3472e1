"""Heavy people on bucketed tables: found by a sketch, joined apart, all others without an exchange."""

import re

import pytest

from carespan.operators import practice_indicators as practice
from carespan.sources.derived import SETTING
from carespan.sources.lake import heavy_people, open_bucketed, save_bucketed
from tests.compare import rows_of
from tests.random_tables import build, write
from tests.test_random import opened

EVENTS = ("encounter", "home_visit", "vaccination", "procedure_event", "dental_encounter")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Random tables, in which person 7 has a third of all events, plain and bucketed."""
    folder = str(tmp_path_factory.mktemp("random"))
    write(build(3), folder)
    plain = opened(spark, folder)
    spark.sql(f"CREATE DATABASE heavy LOCATION '{folder}/db'")
    save_bucketed(plain, "heavy", 8)
    yield plain, open_bucketed(spark, "heavy")
    spark.sql("DROP DATABASE heavy CASCADE")


def test_the_sketch_names_the_hot_person(spark, tables):
    plain, bucketed = tables
    assert bucketed.heavy_people == (7,) and plain.heavy_people is None
    assert bucketed.replacing(person=bucketed["person"]).heavy_people == (7,)
    assert [r[0] for r in heavy_people(plain, 8, ("encounter",)).collect()] == [7]


@pytest.mark.parametrize("build_", [practice.practices_c2, practice.practices_c3, practice.indicator_c2, practice.indicator_c3])
def test_results_are_the_same(tables, build_):
    plain, bucketed = tables
    expected, got = build_(plain, SETTING), build_(bucketed, SETTING)
    assert rows_of(got.collect(), got.columns) == rows_of(expected.collect(), expected.columns)
    nobody = bucketed.replacing()
    nobody.heavy_people = ()
    assert rows_of(build_(nobody, SETTING).collect(), got.columns) == rows_of(expected.collect(), expected.columns)


def exchanged_scans(plan):
    """(table, named in the filter, passes an exchange before a join by person) of every scan of events."""
    lines, found = plan.split("\n"), []
    depth = [len(re.match(r"[\s:+\-*|]*(?:\(\d+\) )?", line).group()) for line in lines]
    for i, line in enumerate(lines):
        scan = re.search(r"FileScan parquet \S+\.heavy\.(\w+)\[", line)
        if not scan or scan.group(1) not in EVENTS:
            continue
        above, level, exchanged = i, depth[i], False
        while above > 0:
            above -= 1
            if depth[above] >= level:
                continue
            level = depth[above]
            if "Join [who#" in lines[above] or re.search(r"Join \[person_id#", lines[above]):
                break
            exchanged |= "Exchange hashpartitioning" in lines[above]
        named = re.search(r"(?<!NOT )\(?person_id#\d+L? = 7\)?", line) is not None and "NOT (person_id" not in line
        found.append((scan.group(1), named, exchanged))
    return found


@pytest.mark.parametrize("build_", [practice.practices_c2, practice.practices_c3])
def test_only_events_of_named_people_are_exchanged(spark, tables, build_):
    _, bucketed = tables
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "3000")  # the occupations, not the people
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        scans = exchanged_scans(build_(bucketed, SETTING)._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.maxMetadataStringLength")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(scans) >= 8 and {named for _, named, _ in scans} == {True, False}
    assert [s for s in scans if s[1] != s[2]] == []
