"""Distinct people from monthly bitmaps beside distinct counts over events."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.operators import ratio_indicators
from carespan.plans import contact_months as cm
from carespan.setting import Period
from carespan.sources.derived import SETTING, earlier, open_derived
from carespan.sources.published import Published
from tests.compare import rows_of
from tests.random_tables import build, write
from tests.test_random import opened

RANGES = [(200001, 200001), (200008, 200107), (200011, 200102), (199901, 200112), (198001, 198012)]


def same(a, b):
    return rows_of(a.collect(), a.columns) == rows_of(b.collect(), b.columns)


def days(first, last):
    end = date(last // 100 + last % 100 // 12, last % 100 % 12 + 1, 1)
    return Period(date(first // 100, first % 100, 1), date.fromordinal(end.toordinal() - 1))


@pytest.fixture(scope="module")
def states(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("random"))
    write(build(9), folder)
    T = opened(spark, folder)
    published = Published(spark, str(tmp_path_factory.mktemp("states")))
    cm.refresh_contact_months(T, SETTING, published)
    return T, published


def check(T, published, ranges):
    for first, last in ranges:
        s = SETTING.but(period=days(first, last))
        assert same(cm.contacts_between(published, T, s, first, last), ratio_indicators.indicator_m1(T, s))
        assert same(cm.first_visits_between(published, T, s, first, last), ratio_indicators.indicator_b1(T, s))


def test_any_months(states):
    check(*states, RANGES)


def test_the_city(states):
    T, published = states
    s = SETTING.but(period=days(200008, 200107))
    met = ratio_indicators.team_encounters(T, s, s.codes.multi_professional_ids)
    row = cm.people_between(published, s, 200008, 200107).where("tipo = 'contato'").collect()[0]
    assert (row["numerator"], row["people"]) == tuple(met.agg(F.count("*"), F.countDistinct("person_id")).first())


def test_numbers_are_dense_and_stay(spark, tmp_path):
    """People of changed and late months get the next numbers; nobody's number changes."""
    T = open_derived(spark, "/root/testdata/sf0.001")
    some = T.replacing(encounter=T["encounter"].where("event_date < DATE '2000-01-01'"))
    published = Published(spark, str(tmp_path))
    cm.refresh_contact_months(some, SETTING, published)
    first = {r["person_id"]: r["numero"] for r in published.read("pessoas", cm.NUMBERS).collect()}
    told = cm.refresh_contact_months(T, SETTING, published)
    then = {r["person_id"]: r["numero"] for r in published.read("pessoas", cm.NUMBERS).collect()}
    assert sorted(then.values()) == list(range(1, len(then) + 1)) and len(then) > len(first) > 0
    assert all(then[p] == n for p, n in first.items())
    assert min(told["written"]) == "200001" and "199912" in told["kept"]
    check(T, published, [(199901, 199912), (200008, 200107)])
    told = cm.refresh_contact_months(T, SETTING, published)
    assert not told["written"] and not told["dropped"]


def test_a_state_is_as_large_as_its_people(states):
    """However many people the city has, a person of a unit's month takes 8 bytes of bitmap at most."""
    T, published = states
    people = cm.contacts(T, SETTING).where("person_id IS NOT NULL")
    met = people.groupBy("tipo", *cm.UNIT_IDS, cm.MONTH).agg(F.countDistinct("person_id").alias("n"), F.sum("eventos").alias("e"))
    rows = published.read(cm.STATES, cm.STATE).where("faixa IS NOT NULL")
    kept = rows.groupBy("tipo", *cm.UNIT_IDS, cm.MONTH).agg(
        F.sum(F.bit_count("pessoas")).alias("n"), F.sum("eventos").alias("e")
    )
    assert same(met.withColumn("n", F.col("n").cast("long")), kept.withColumn("n", F.col("n").cast("long")))
    held = rows.agg(F.sum(F.octet_length(F.to_binary(F.hex("pessoas"), F.lit("hex"))))).first()[0]
    assert 0 < held <= 8 * met.agg(F.sum("n")).first()[0]


def test_no_event_is_read(states):
    T, published = states
    plan = cm.contacts_between(published, T, SETTING, 200008, 200107)._jdf.queryExecution().executedPlan().toString()
    assert "encounter" not in plan and "competencia" in plan.split("PartitionFilters")[1]
