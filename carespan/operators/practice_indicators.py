"""Indicators made of several good practices per person.

Every indicator has the same three steps: a cohort of people with their team, one row of 0/1
practices per person, and a count per team. The events of all tables are stacked and reduced in map
tasks before they are shuffled by person, so neither a long history nor one person with a large share
of the rows weighs on a single task:

* practices with fixed dates (C4 to C7) reduce straight to one row per person;
* practices counted from a birth or a pregnancy (C2, C3) keep the events of the cohort only and reduce
  to one row per person and day, which bounds what any person brings to the join with the dates.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from carespan.codes import STANDARD_BANDS
from carespan.functions.scalars import band, flag, matches_any, ratio
from carespan.operators.marks import (
    dose_marks, encounter_marks, events_of, procedure_marks, spread_enough, stacked, visit_marks,
    with_occupation,
)
from carespan.operators.population import linked_people, live_persons, valid_links
from carespan.operators.ratio_indicators import scored
from carespan.operators.units import in_scope, named, unit_keys
from carespan.setting import Setting, months_later
from carespan.sources.lake import within
from carespan.sources.tables import Tables

UNIT_IDS = ["facility_id", "team_id"]
PRACTICES = {"c2": "abcde", "c3": "abcdefghijk", "c4": "abcdef", "c5": "abcd", "c6": "abcd", "c7": "abcd"}


def practice_columns(name: str) -> list[str]:
    return [f"pratica_{letter}" for letter in PRACTICES[name]]


def _any(condition: Column) -> Column:
    """1 where some row of the group fulfils the condition."""
    return F.max(flag(condition))


def _flagged(cohort: DataFrame, flags: DataFrame, keys, name: str) -> DataFrame:
    """Cohort with its practices; a person without events has none."""
    practices = practice_columns(name)
    filled = [F.coalesce(F.col(p), F.lit(0)).alias(p) for p in practices]
    return cohort.join(flags.select(*keys, *practices), keys, "left").select(*cohort.columns, *filled)


def _linked_cohort(T: Tables, s: Setting, where: Column, team: str = "left") -> DataFrame:
    """Distinct person x team of the linked people fulfilling the condition."""
    people = unit_keys(linked_people(T, s, where), T, team=team)
    return people.select("person_id", *UNIT_IDS).distinct()


def _team_counts(rows: DataFrame, T: Tables, name: str, team: str, *extra: str) -> DataFrame:
    columns = [*practice_columns(name), *extra]
    counts = rows.groupBy(*UNIT_IDS).agg(
        F.count("*").alias("denominator"), *[F.sum(c).alias(c) for c in columns]
    )
    return named(counts, T, team=team)


def _total(columns) -> Column:
    return reduce(Column.__add__, [F.col(c) for c in columns])


# ---- diabetes, hypertension, older people: care within a year of the end of the period ----

# Kind of care behind each practice; "visited" is two agent's visits 30 days apart.
YEARLY = {
    "c4": {
        "a": "seen_lately", "b": "pressure_lately", "c": "weighed", "d": "visited", "e": "hba1c",
        "f": "diabetic_foot",
    },
    "c5": {"a": "seen_lately", "b": "pressure_lately", "c": "weighed", "d": "visited"},
    "c6": {"a": "seen", "b": "weighed_by_team", "c": "visited", "d": "influenza"},
}
LATELY, YEAR = 183, 366


def yearly_care(T: Tables, s: Setting, names=tuple(YEARLY)) -> DataFrame:
    """Per person, the kinds of care that the named indicators ask for, in one pass over the events."""
    kinds = {kind for name in names for kind in YEARLY[name].values()} - {"visited"}
    end = s.period.end
    year = end - timedelta(days=YEAR)
    lately = F.col("event_date") >= F.lit(end - timedelta(days=LATELY))

    def marked(rows, *columns, **tests):
        chosen = [flag(test).alias(kind) for kind, test in tests.items() if kind in kinds]
        return rows.select("person_id", *chosen, *columns)

    seen, pressure, weighed = F.col("med_nurse"), F.col("pressure"), F.col("measured")
    by_team = weighed & F.col("anthropometry")
    encounters = encounter_marks(T, s, year, end, "med_nurse", "anthropometry").where(
        seen | weighed | (pressure & lately)
    )
    visits = visit_marks(T, s, year, end, "community_agent", "anthropometry")
    visit_day = F.when(F.col("community_agent"), F.col("event_date")).alias("visit_day")
    sets = ["weight_height"]
    sets += ["blood_pressure"] * ("pressure_lately" in kinds)
    sets += [x for x in ("hba1c", "diabetic_foot") if x in kinds]
    procedures = procedure_marks(T, s, year, end, *sets)
    parts = [
        marked(
            encounters, seen=seen, seen_lately=seen & lately, pressure_lately=pressure & lately,
            weighed=weighed, weighed_by_team=by_team,
        ),
        marked(visits, visit_day, pressure_lately=pressure & lately, weighed=weighed, weighed_by_team=by_team),
        marked(
            procedures, pressure_lately=(F.col("blood_pressure") == 1) & lately,
            weighed=F.col("weight_height") == 1, weighed_by_team=F.col("weight_height") == 1,
            hba1c=F.col("hba1c") == 1, diabetic_foot=F.col("diabetic_foot") == 1,
        ),
    ]
    if "influenza" in kinds:
        parts.append(marked(dose_marks(T, s, year, end, "influenza"), influenza=F.col("influenza")))
    care = stacked(*parts).groupBy("person_id").agg(
        *[F.max(kind).alias(kind) for kind in sorted(kinds)], F.count("visit_day").alias("visits"),
        F.min("visit_day").alias("first"), F.max("visit_day").alias("last"),
    )
    return care.withColumn("visited", flag(spread_enough("visits", "first", "last", s)))


def names_condition(icd, icpc) -> Column:
    return matches_any(F.col("icd_codes"), icd) | matches_any(F.col("icpc_codes"), icpc)


def condition_people(T: Tables, s: Setting, names=("c4", "c5")) -> DataFrame:
    """Live people with the conditions, each in the team of the latest encounter that names it.

    One pass over the encounters serves both conditions.
    """
    tests = {
        "c4": names_condition(s.codes.diabetes_icd, s.codes.diabetes_icpc),
        "c5": names_condition(s.codes.hypertension_icd, s.codes.hypertension_icpc),
    }
    row = F.struct("event_date", "encounter_id", *UNIT_IDS)
    events = within(T["encounter"], s.codes.condition_since).where(
        reduce(Column.__or__, [tests[n] for n in names]) & in_scope(s)
    )
    latest = unit_keys(events, T).groupBy("person_id").agg(
        *[F.max(F.when(tests[n], row)).alias(n) for n in names]
    )
    live = latest.join(live_persons(T).select("person_id"), "person_id", "left_semi")
    cases = [F.struct(F.lit(n).alias("indicador"), F.col(n).alias("row")) for n in names]
    people = live.select("person_id", F.explode(F.array(*cases)).alias("case")).where("case.row IS NOT NULL")
    return people.select("case.indicador", "person_id", *[F.col(f"case.row.{c}") for c in UNIT_IDS])


def older_people(s: Setting) -> Column:
    return F.col("birth_date") <= F.add_months(F.lit(s.as_of), -12 * 60)


def _yearly_practices(T: Tables, s: Setting, name: str, cohort: DataFrame) -> DataFrame:
    done = [F.col(kind).alias(f"pratica_{x}") for x, kind in YEARLY[name].items()]
    flags = yearly_care(T, s, (name,)).select("person_id", *done)
    return _flagged(cohort, flags, ["person_id"], name)


def practices_c4(T: Tables, s: Setting) -> DataFrame:
    return _yearly_practices(T, s, "c4", condition_people(T, s, ("c4",)).drop("indicador"))


def practices_c5(T: Tables, s: Setting) -> DataFrame:
    return _yearly_practices(T, s, "c5", condition_people(T, s, ("c5",)).drop("indicador"))


def practices_c6(T: Tables, s: Setting) -> DataFrame:
    return _yearly_practices(T, s, "c6", _linked_cohort(T, s, older_people(s)))


def yearly_people(T: Tables, s: Setting) -> DataFrame:
    """The cohorts of C4, C5 and C6 in one table with every kind of care: the events are read once."""
    older = _linked_cohort(T, s, older_people(s)).withColumn("indicador", F.lit("c6"))
    cohort = condition_people(T, s).unionByName(older)
    kinds = sorted({kind for practices in YEARLY.values() for kind in practices.values()})
    filled = [F.coalesce(F.col(k), F.lit(0)).alias(k) for k in kinds]
    return cohort.join(yearly_care(T, s), "person_id", "left").select(*cohort.columns, *filled)


def yearly_indicators(T: Tables, s: Setting) -> DataFrame:
    """C4, C5 and C6 at once: indicator, team, practices done, people, value and class."""
    points, practices = F.lit(None).cast("int"), F.lit(None).cast("int")
    for name, kinds in YEARLY.items():
        points = F.when(F.col("indicador") == name, _total(kinds.values())).otherwise(points)
        practices = F.when(F.col("indicador") == name, len(kinds)).otherwise(practices)
    counts = yearly_people(T, s).groupBy("indicador", *UNIT_IDS).agg(
        F.sum(points).alias("numerator"), F.count("*").alias("denominator")
    )
    value = ratio(F.col("numerator"), F.col("denominator") * practices)
    return named(counts, T, team="left").withColumn("value", value).withColumn(
        "classificacao", band(F.col("value"), STANDARD_BANDS)
    )


def _plain_score(rows: DataFrame, T: Tables, name: str, team: str, scale: int, per_person: int) -> DataFrame:
    practices = practice_columns(name)
    counts = _team_counts(rows, T, name, team).withColumn("numerator", _total(practices))
    value = ratio(F.col("numerator"), F.col("denominator") * per_person, scale=scale)
    return scored(counts, name, value, *practices)


def indicator_c4(T: Tables, s: Setting) -> DataFrame:
    """Care of people with diabetes: six practices."""
    return _plain_score(practices_c4(T, s), T, "c4", "inner", 100, 6)


def indicator_c5(T: Tables, s: Setting) -> DataFrame:
    """Care of people with hypertension: four practices."""
    return _plain_score(practices_c5(T, s), T, "c5", "inner", 100, 4)


def indicator_c6(T: Tables, s: Setting) -> DataFrame:
    """Care of people of 60 and over: four practices."""
    return _plain_score(practices_c6(T, s), T, "c6", "left", 100, 4)


# ---- cancer prevention in women ----

# Practice -> (youngest age, first age no longer counted, weight).
WOMEN_AGES = {"a": (25, 65, 20), "b": (9, 15, 30), "c": (14, 70, 30), "d": (50, 70, 20)}


def _aged(s: Setting, youngest: int, beyond: int) -> Column:
    """Age at the end of the period, from ``youngest`` to just under ``beyond``."""
    end = F.lit(s.period.end)
    return (F.col("birth_date") <= F.add_months(end, -12 * youngest)) & (
        F.col("birth_date") > F.add_months(end, -12 * beyond)
    )


def practices_c7(T: Tables, s: Setting) -> DataFrame:
    """Women of 9 to 69: per practice, whether the age counts (base) and whether it was done."""
    start, end = s.period.start, s.period.end

    def back(days):
        return end - timedelta(days=days)

    procedures = procedure_marks(T, s, back(1096), end, "cytology", "mammography").select(
        "person_id", F.col("cytology").alias("a"),
        flag((F.col("mammography") == 1) & (F.col("event_date") >= F.lit(back(731)))).alias("d"),
    )
    doses = dose_marks(T, s, start, end, "hpv").select("person_id", F.lit(1).alias("b"))
    about = matches_any(F.col("icd_codes"), s.codes.sexual_health_icd) | matches_any(
        F.col("icpc_codes"), s.codes.sexual_health_icpc
    )
    encounters = encounter_marks(T, s, back(366), end, "med_nurse").where(F.col("med_nurse") & about).select(
        "person_id", F.lit(1).alias("c")
    )
    done = stacked(procedures, doses, encounters).groupBy("person_id").agg(
        *[F.max(letter).alias(letter) for letter in WOMEN_AGES]
    )
    women = (F.col("sex_id") == s.codes.female_sex) & _aged(s, 9, 70)
    people = unit_keys(linked_people(T, s, women), T, team="left")
    cohort = people.groupBy("person_id", *UNIT_IDS).agg(
        *[_any(_aged(s, low, high)).alias(f"base_{x}") for x, (low, high, _) in WOMEN_AGES.items()]
    )
    counted = [
        (F.col(f"base_{x}") * F.coalesce(F.col(x), F.lit(0))).alias(f"pratica_{x}") for x in WOMEN_AGES
    ]
    return cohort.join(done, "person_id", "left").select(*cohort.columns, *counted)


def indicator_c7(T: Tables, s: Setting) -> DataFrame:
    """Weighted coverage of four practices, each over the women of its own ages."""
    bases = [f"base_{x}" for x in WOMEN_AGES]
    practices = practice_columns("c7")
    counts = _team_counts(practices_c7(T, s), T, "c7", "left", *bases).withColumns(
        {"numerator": _total(practices), "denominator": _total(bases)}
    )
    # All shares over the product of the bases, in whole numbers, so that a tie rounds as it should.
    def whole(name):
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(9,0)")

    over = {x: F.greatest(whole(f"base_{x}"), F.lit(1).cast("decimal(9,0)")) for x in WOMEN_AGES}
    bases_product = reduce(Column.__mul__, over.values())
    parts = [
        reduce(Column.__mul__, [over[y] for y in WOMEN_AGES if y != x], whole(f"pratica_{x}") * weight)
        for x, (_, _, weight) in WOMEN_AGES.items()
    ]
    hundredths = F.call_function("div", reduce(Column.__add__, parts) * 200 + bases_product, bases_product * 2)
    value = hundredths / F.lit(100.0)
    both = [c for x in WOMEN_AGES for c in (f"base_{x}", f"pratica_{x}")]
    return scored(counts, "c7", value, *both)


# ---- child development ----


def practices_c2(T: Tables, s: Setting) -> DataFrame:
    """Children of up to two years at the end of the period."""
    end = s.period.end
    born = months_later(end, -24)
    people = unit_keys(linked_people(T, s, F.col("birth_date") >= F.lit(born)), T)
    children = people.select("person_id", *UNIT_IDS, "birth_date").distinct()
    cohort = children.select("person_id", *UNIT_IDS).distinct()
    # a person registered with several birth dates is one row with all of them
    births = children.groupBy("person_id").agg(
        F.collect_set("birth_date").alias("births"), F.min("birth_date").alias("earliest")
    )

    # the oldest child counted was born two years before the end, so nothing earlier matters
    encounters = encounter_marks(T, s, born, None, "med_nurse", "anthropometry").select(
        "person_id", "event_date", flag(F.col("med_nurse")).alias("seen"),
        flag(F.col("measured") & F.col("anthropometry")).alias("weighed"),
    ).where((F.col("seen") == 1) | (F.col("weighed") == 1))
    visits = visit_marks(T, s, born, None, "community_agent").select(
        "person_id", "event_date", flag(F.col("measured")).alias("weighed"),
        flag(F.col("community_agent") & F.col("child_visit")).alias("visited"),
    ).where((F.col("weighed") == 1) | (F.col("visited") == 1))
    procedures = procedure_marks(T, s, born, end, "weight_height").select(
        "person_id", "event_date", F.col("weight_height").alias("weighed")
    )
    vaccines = ("penta", "polio", "mmr", "pneumo")
    doses = dose_marks(T, s, None, end, *vaccines).select(
        "person_id", "event_date", *[flag(F.col(v)).alias(v) for v in vaccines]
    )
    kinds = ("seen", "weighed", "visited", *vaccines)
    day = F.col("event_date")

    def by_age(days):
        return F.exists("births", lambda b: (day >= b) & (day <= F.date_add(b, days)))

    lived = (
        events_of(births, encounters, visits, procedures, doses, heavy=T.heavy_people)
        .withColumns({"first_month": flag(by_age(30)), "half_year": flag(by_age(180))})
        .groupBy("person_id", "event_date").agg(
            *[F.sum(k).alias(k) for k in kinds],
            *[F.max(c).alias(c) for c in ("earliest", "first_month", "half_year")],
        )
    )
    ended = day <= F.lit(end)
    alive = day >= F.col("earliest")
    visiting = (F.col("half_year") == 1) & (F.col("visited") > 0)
    sums = lived.groupBy("person_id").agg(
        _any((F.col("seen") > 0) & (F.col("first_month") == 1)).alias("pratica_a"),
        F.sum(flag((F.col("seen") > 0) & alive & ended)).alias("seen_days"),
        F.sum(flag((F.col("weighed") > 0) & alive & ended)).alias("weighed_days"),
        F.sum(F.when(visiting, F.col("visited"))).alias("visits"),
        F.min(F.when(visiting, day)).alias("first_visit"),
        F.max("earliest").alias("earliest"),
        *[F.sum(v).alias(v) for v in vaccines],
    )
    flags = sums.select(
        "person_id", "pratica_a",
        flag(F.col("seen_days") >= 9).alias("pratica_b"),
        flag(F.col("weighed_days") >= 9).alias("pratica_c"),
        flag(
            (F.col("visits") >= 2) & (F.col("first_visit") <= F.date_add("earliest", 30))
        ).alias("pratica_d"),
        flag(
            (F.col("penta") >= 3) & (F.col("polio") >= 3) & (F.col("mmr") >= 2) & (F.col("pneumo") >= 2)
        ).alias("pratica_e"),
    )
    return _flagged(cohort, flags, ["person_id"], "c2")


def indicator_c2(T: Tables, s: Setting) -> DataFrame:
    """Child development: five practices of 20 points."""
    return _plain_score(practices_c2(T, s), T, "c2", "inner", 20, 1)


# ---- pregnancy and puerperium ----


def active_pregnancies(T: Tables, s: Setting) -> DataFrame:
    """Pregnancies begun by the end of the period whose puerperium had not ended before its start."""
    return T["pregnancy"].where(
        (F.col("start_date") <= F.lit(s.period.end))
        & (F.col("puerperium_end").isNull() | (F.col("puerperium_end") >= F.lit(s.period.start)))
    )


def _pregnancy_cohort(T: Tables, s: Setting) -> DataFrame:
    """One row per person and pregnancy, in the team of the newest link in force in scope."""
    links = valid_links(T, s.as_of).where(in_scope(s)).join(
        T["facility"].select("facility_id"), "facility_id", "left_semi"
    )
    owners = T["registration"].select("registration_id", "person_id")
    newest_link = F.max(F.struct("valid_from", "link_id", *UNIT_IDS)).alias("link")
    linked = links.join(owners, "registration_id").groupBy("person_id").agg(newest_link)
    dates = ["start_date", "puerperium_start", "puerperium_end"]
    pregnancies = active_pregnancies(T, s).groupBy("person_id", "pregnancy_no").agg(
        F.max(F.struct(*dates)).alias("dates")
    )
    rows = (
        pregnancies.join(linked, "person_id")
        .join(T["person"].select("person_id"), "person_id", "left_semi")
        .select("person_id", "pregnancy_no", "dates.*", "link.facility_id", "link.team_id")
    )
    before_birth = F.coalesce(F.date_sub("puerperium_start", 1), F.lit(s.as_of))
    last_day = F.coalesce(F.col("puerperium_end"), F.date_add("puerperium_start", 42))
    rows = rows.withColumns({"pregnant_until": before_birth, "puerperium_end": last_day})
    return unit_keys(rows, T, team="left")


def practices_c3(T: Tables, s: Setting) -> DataFrame:
    """Pregnancies active in the period; only events of the period count."""
    start, end = s.period.start, s.period.end
    cohort = _pregnancy_cohort(T, s)
    keys = ["person_id", "pregnancy_no"]

    encounters = encounter_marks(T, s, start, end, "med_nurse_wide").select(
        "person_id", "event_date", flag(F.col("med_nurse_wide")).alias("seen"),
        flag(F.col("pressure")).alias("pressure"), flag(F.col("measured")).alias("weighed"),
    )
    visits = visit_marks(T, s, start, end, "community_agent").select(
        "person_id", "event_date", flag(F.col("community_agent")).alias("visited"),
        flag(F.col("pressure")).alias("pressure"), flag(F.col("measured")).alias("weighed"),
    )
    sets = ("blood_pressure", "weight_height_pregnancy", "first_trimester_tests", "third_trimester_tests")
    procedures = procedure_marks(T, s, start, end, *sets).select(
        "person_id", "event_date", F.col("blood_pressure").alias("pressure"),
        F.col("weight_height_pregnancy").alias("weighed"), F.col("first_trimester_tests").alias("test1"),
        F.col("third_trimester_tests").alias("test3"),
    )
    doses = dose_marks(T, s, start, end, "dtpa").select(
        "person_id", "event_date", F.lit(1).alias("dtpa")
    )
    dental = with_occupation(
        within(T["dental_encounter"], start, end).select("person_id", "event_date", "occupation_id"),
        T, s, "dental_team",
    ).where("dental_team").select("person_id", "event_date", F.lit(1).alias("dental"))
    kinds = ("seen", "visited", "pressure", "weighed", "test1", "test3", "dtpa", "dental")
    dates = ["start_date", "puerperium_start", "puerperium_end", "pregnant_until"]
    events = (encounters, visits, procedures, doses, dental)
    lived = events_of(cohort.select(*keys, *dates), *events, heavy=T.heavy_people)
    days = lived.groupBy(*keys, *dates, "event_date").agg(*[F.sum(k).alias(k) for k in kinds])

    day, begin = F.col("event_date"), F.col("start_date")
    until = F.col("pregnant_until")
    pregnant = (day >= begin) & (day <= until)
    after_birth = (day >= F.col("puerperium_start")) & (day <= F.col("puerperium_end"))

    def some(kind):
        return F.col(kind) > 0

    # the days of one pregnancy are bounded by the length of the period
    first_seen = F.min(F.when(pregnant & some("seen"), day)).over(Window.partitionBy(*keys))
    met = days.withColumn("first_seen", first_seen)
    sums = met.groupBy(*keys).agg(
        _any(some("seen") & day.between(begin, F.date_add(begin, 84))).alias("pratica_a"),
        F.sum(F.when(pregnant, F.col("seen"))).alias("seen"),
        F.sum(flag(pregnant & some("pressure"))).alias("pressure_days"),
        F.sum(flag(pregnant & some("weighed"))).alias("weighed_days"),
        F.sum(F.when((day >= F.col("first_seen")) & (day <= until), F.col("visited"))).alias("visits"),
        _any(some("dtpa") & (day >= F.date_add(begin, 140)) & (day <= until)).alias("pratica_f"),
        _any(some("test1") & day.between(begin, F.date_add(begin, 91))).alias("pratica_g"),
        _any(some("test3") & (day >= F.date_add(begin, 196)) & (day <= until)).alias("pratica_h"),
        _any(some("seen") & after_birth).alias("pratica_i"),
        _any(some("visited") & after_birth).alias("pratica_j"),
        _any(some("dental") & pregnant).alias("pratica_k"),
    )
    flags = sums.withColumns({
        "pratica_b": flag(F.col("seen") >= 7),
        "pratica_c": flag(F.col("pressure_days") >= 7),
        "pratica_d": flag(F.col("weighed_days") >= 7),
        "pratica_e": flag(F.col("visits") >= 3),
    })
    return _flagged(cohort.select(*keys, *UNIT_IDS), flags, keys, "c3")


def indicator_c3(T: Tables, s: Setting) -> DataFrame:
    """Pregnancy and puerperium: practice A is worth 10 points, the others 9 each, of 100."""
    practices = practice_columns("c3")
    points = F.col("pratica_a") * 10 + _total(practices[1:]) * 9
    counts = _team_counts(practices_c3(T, s), T, "c3", "left").withColumn("numerator", points)
    return scored(counts, "c3", ratio(F.col("numerator"), F.col("denominator"), scale=1), *practices)


PERSON_PRACTICES = {
    "c2": practices_c2, "c3": practices_c3, "c4": practices_c4, "c5": practices_c5,
    "c6": practices_c6, "c7": practices_c7,
}
