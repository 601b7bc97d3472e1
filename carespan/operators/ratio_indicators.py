"""Indicators that are one ratio per team: access, dental care, multi-professional care."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carespan.codes import BANDS
from carespan.functions.scalars import age_years, band, flag, in_list, ratio
from carespan.operators.population import people_by_facility
from carespan.operators.units import TEAM, in_scope, named, unit_keys
from carespan.setting import Setting
from carespan.sources.lake import within
from carespan.sources.tables import Tables

UNIT_IDS = ["facility_id", "team_id"]


def scored(df: DataFrame, name: str, value: Column, *extra: str) -> DataFrame:
    """Team, numerator, denominator, extra counts, value and its class."""
    return df.withColumn("value", value).select(
        *TEAM, "numerator", "denominator", *extra, "value",
        band(F.col("value"), BANDS[name]).alias("classificacao"),
    )


def counts_by_name(df: DataFrame, *counts: str) -> DataFrame:
    """Add up counts of teams that share all four names."""
    return df.groupBy(*TEAM).agg(*[F.sum(c).alias(c) for c in counts])


def in_period(T: Tables, table: str, s: Setting) -> DataFrame:
    return within(T[table], s.period.start, s.period.end)


def team_encounters(T: Tables, s: Setting, occupations) -> DataFrame:
    """Encounters of the period at facilities in scope, by the given occupations."""
    return in_period(T, "encounter", s).where(
        in_list(F.col("occupation_id"), occupations) & in_scope(s)
    )


def access_counts(T: Tables, s: Setting) -> DataFrame:
    """Scheduled and all encounters of doctors and nurses per team name."""
    scheduled = in_list(F.col("visit_type_id"), s.codes.scheduled_visit_types)
    counts = team_encounters(T, s, s.codes.med_nurse_ids).groupBy(*UNIT_IDS).agg(
        F.sum(flag(scheduled)).alias("numerator"), F.count("*").alias("denominator")
    )
    return counts_by_name(named(counts, T), "numerator", "denominator")


def indicator_c1(T: Tables, s: Setting) -> DataFrame:
    """Share of scheduled encounters among those of doctors and nurses."""
    return scored(access_counts(T, s), "c1", ratio(F.col("numerator"), F.col("denominator")))


def contact_counts(T: Tables, s: Setting) -> DataFrame:
    """Encounters and distinct people of the multi-professional team per team name.

    Grouping by person first keeps the distinct count exact without collecting anyone's rows.
    """
    per_person = (
        unit_keys(team_encounters(T, s, s.codes.multi_professional_ids), T)
        .groupBy(*UNIT_IDS, "person_id").agg(F.count("*").alias("contacts"))
    )
    counts = per_person.groupBy(*UNIT_IDS).agg(
        F.sum("contacts").alias("numerator"), F.count("person_id").alias("denominator")
    )
    return named(counts, T)


def indicator_m1(T: Tables, s: Setting) -> DataFrame:
    """Encounters per person seen by the multi-professional team."""
    return scored(contact_counts(T, s), "m1", ratio(F.col("numerator"), F.col("denominator"), scale=1))


def indicator_m2(T: Tables, s: Setting) -> DataFrame:
    """Actions per person: the same measure, reported under its own name."""
    return scored(contact_counts(T, s), "m2", ratio(F.col("numerator"), F.col("denominator"), scale=1))


def contact_indicators(T: Tables, s: Setting) -> DataFrame:
    """M1 and M2 at once, from one count."""
    value = ratio(F.col("numerator"), F.col("denominator"), scale=1)
    counts = contact_counts(T, s).withColumn("value", value)
    names = F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("indicador")
    return counts.select("*", names, band(F.col("value"), BANDS["m1"]).alias("classificacao"))


def access_and_contact_counts(T: Tables, s: Setting) -> DataFrame:
    """Team rows of C1, M1 and M2 from one pass over the encounters, grouped by person first.

    Only rows that count for contacts keep their person; those that count for access alone meet in one
    row per team before the shuffle.
    """
    access = in_list(F.col("occupation_id"), s.codes.med_nurse_ids)
    contact = in_list(F.col("occupation_id"), s.codes.multi_professional_ids)
    scheduled = access & in_list(F.col("visit_type_id"), s.codes.scheduled_visit_types)
    events = in_period(T, "encounter", s).where((access | contact) & in_scope(s)).select(
        *UNIT_IDS, F.when(contact, F.col("person_id")).alias("person_id"), scheduled.alias("scheduled"),
        access.alias("access"), contact.alias("contact"),
    )
    per_person = unit_keys(events, T).groupBy(*UNIT_IDS, "person_id").agg(
        *[F.count_if(c).alias(c) for c in ("scheduled", "access", "contact")]
    )
    met = (F.col("contact") > 0) & F.col("person_id").isNotNull()
    counts = per_person.groupBy(*UNIT_IDS).agg(
        *[F.sum(c).alias(c) for c in ("scheduled", "access", "contact")], F.count_if(met).alias("people"),
    )

    def row(name, numerator, denominator, events):
        return F.struct(
            F.lit(name).alias("indicador"), F.col(numerator).alias("numerator"), F.col(denominator).alias("denominator"),
            F.col(events).alias("events"),
        )

    rows = F.explode(F.array(row("c1", "scheduled", "access", "access"), *[
        row(name, "contact", "people", "contact") for name in ("m1", "m2")
    ])).alias("r")
    return named(counts.select(*UNIT_IDS, rows), T).where("r.events > 0").select(
        "r.indicador", *TEAM, "r.numerator", "r.denominator"
    )


def _valued(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Value and class of rows of several indicators."""
    value, label = F.lit(None).cast("double"), F.lit(None).cast("string")
    for name, own in values.items():
        mine = F.col("indicador") == name
        value, label = F.when(mine, own).otherwise(value), F.when(mine, band(own, BANDS[name])).otherwise(label)
    return rows.withColumns({"value": value, "classificacao": label})


def access_and_contact_indicators(T: Tables, s: Setting) -> DataFrame:
    """C1, M1 and M2 at once."""
    num, den = F.col("numerator"), F.col("denominator")
    per_person = ratio(num, den, scale=1)
    return _valued(access_and_contact_counts(T, s), {"c1": ratio(num, den), "m1": per_person, "m2": per_person})


def procedures_of(T: Tables, **sets) -> DataFrame:
    """Procedure ids with one 0/1 column per code set, only ids in some set."""
    marks = [flag(in_list(F.col("code"), codes)).alias(name) for name, codes in sets.items()]
    rows = T["procedure_code"].select("procedure_id", *marks)
    return rows.where(F.greatest(*[F.col(n) for n in sets], F.lit(0)) == 1)


def first_dental_visits(T: Tables, s: Setting) -> DataFrame:
    """Rows of a dentist's first-visit procedure in the period."""
    first = procedures_of(T, first=s.codes.first_dental_visit)
    return in_period(T, "dental_procedure", s).where(
        in_list(F.col("occupation_id"), s.codes.dentist_ids)
    ).join(first, "procedure_id", "left_semi")


def completed_treatments(T: Tables, s: Setting) -> DataFrame:
    """A dentist's encounters of the period that completed the treatment."""
    return in_period(T, "dental_encounter", s).where(
        in_list(F.col("occupation_id"), s.codes.dentist_ids) & (F.col("treatment_completed") == 1)
    )


def _distinct_people(df: DataFrame) -> DataFrame:
    return df.groupBy(*UNIT_IDS).agg(F.countDistinct("person_id").alias("numerator"))


def indicator_b1(T: Tables, s: Setting) -> DataFrame:
    """People with a first dental visit, against the people linked to the facility.

    The scope limits only the linked people: a team outside it has no denominator and no value.
    """
    linked = people_by_facility(T, s).withColumnRenamed("people", "denominator")
    counts = _distinct_people(first_dental_visits(T, s)).join(linked, "facility_id", "left")
    return scored(
        named(counts, T, valid_only=True), "b1", ratio(F.col("numerator"), F.col("denominator"))
    )


def indicator_b2(T: Tables, s: Setting) -> DataFrame:
    """People with a completed dental treatment, against those with a first visit.

    Both events are reduced to one row per team and person in a single grouping.
    """
    ids = UNIT_IDS + ["person_id"]
    first = first_dental_visits(T, s).where(in_scope(s)).select(
        *ids, F.lit(1).alias("first"), F.lit(0).alias("completed")
    )
    completed = completed_treatments(T, s).where(in_scope(s)).select(
        *ids, F.lit(0).alias("first"), F.lit(1).alias("completed")
    )
    per_person = first.unionByName(completed).groupBy(*ids).agg(
        F.max("first").alias("first"), F.max("completed").alias("completed")
    )
    known = flag(F.col("person_id").isNotNull())
    counts = per_person.groupBy(*UNIT_IDS).agg(
        F.sum(F.col("completed") * known).alias("numerator"),
        F.sum(F.col("first") * known).alias("denominator"),
        F.max("first").alias("reported"),
    )
    return scored(
        named(counts.where(F.col("reported") == 1), T), "b2",
        ratio(F.col("numerator"), F.col("denominator"), empty=0),
    )


def _dental_share(T: Tables, s: Setting, counted, base: Column, **sets) -> DataFrame:
    """Rows of the ``counted`` set among the rows where ``base`` holds, per team with a real name."""
    rows = in_period(T, "dental_procedure", s).where(in_scope(s))
    rows = rows.join(procedures_of(T, **sets), "procedure_id").where(base)
    counts = rows.groupBy(*UNIT_IDS).agg(
        F.sum(counted).alias("numerator"), F.count("*").alias("denominator")
    )
    return named(counts, T, valid_only=True)


def indicator_b3(T: Tables, s: Setting) -> DataFrame:
    """Share of extractions among the listed dental procedures."""
    by = in_list(F.col("occupation_id"), s.codes.dentist_ids + s.codes.dental_technician_ids)
    counts = _dental_share(
        T, s, "extraction", by & (F.col("listed") == 1),
        extraction=s.codes.extractions, listed=s.codes.listed_dental,
    )
    return scored(counts, "b3", ratio(F.col("numerator"), F.col("denominator")))


def preventive_base(s: Setting) -> Column:
    """Rows that count for the preventive share: of dentists all listed, of technicians only preventive."""
    dentist = in_list(F.col("occupation_id"), s.codes.dentist_ids)
    technician = in_list(F.col("occupation_id"), s.codes.dental_technician_ids)
    return (dentist & (F.col("listed") == 1)) | (technician & (F.col("preventive") == 1))


def indicator_b5(T: Tables, s: Setting) -> DataFrame:
    """Share of preventive procedures."""
    counts = _dental_share(
        T, s, "preventive", preventive_base(s),
        preventive=s.codes.preventive_dental, listed=s.codes.preventive_base,
    )
    return scored(counts, "b5", ratio(F.col("numerator"), F.col("denominator")))


def indicator_b6(T: Tables, s: Setting) -> DataFrame:
    """Share of atraumatic treatment among restorative procedures."""
    by = in_list(F.col("occupation_id"), s.codes.dentist_ids)
    counts = _dental_share(
        T, s, "atraumatic", by & (F.col("listed") == 1),
        atraumatic=s.codes.atraumatic, listed=s.codes.restorative_dental,
    )
    return scored(counts, "b6", ratio(F.col("numerator"), F.col("denominator"), empty=0))


def dental_shares(T: Tables, s: Setting) -> DataFrame:
    """B3, B5 and B6 at once, from one pass over the dental procedures."""
    codes = s.codes
    sets = procedures_of(
        T, extraction=codes.extractions, listed_b3=codes.listed_dental, preventive=codes.preventive_dental,
        listed=codes.preventive_base, atraumatic=codes.atraumatic, listed_b6=codes.restorative_dental,
    )
    by_dentist = in_list(F.col("occupation_id"), codes.dentist_ids)
    by_either = in_list(F.col("occupation_id"), codes.dentist_ids + codes.dental_technician_ids)
    shares = {
        "b3": ("extraction", by_either & (F.col("listed_b3") == 1)),
        "b5": ("preventive", preventive_base(s)),
        "b6": ("atraumatic", by_dentist & (F.col("listed_b6") == 1)),
    }
    rows = in_period(T, "dental_procedure", s).where(in_scope(s)).join(sets, "procedure_id")
    counts = rows.groupBy(*UNIT_IDS).agg(
        *[F.sum(F.when(base, F.col(counted))).alias(f"{name}_numerator") for name, (counted, base) in shares.items()],
        *[F.count_if(base).alias(f"{name}_denominator") for name, (_, base) in shares.items()],
    )
    each = F.explode(F.array(*[
        F.struct(
            F.lit(name).alias("indicador"), F.col(f"{name}_numerator").alias("numerator"),
            F.col(f"{name}_denominator").alias("denominator"),
        ) for name in shares
    ])).alias("r")
    teams = named(counts.select(*UNIT_IDS, each).where("r.denominator > 0"), T, valid_only=True)
    share = ratio(F.col("numerator"), F.col("denominator"))
    return _valued(teams.select(*TEAM, "r.*"), {"b3": share, "b5": share, "b6": F.coalesce(share, F.lit(0.0))})


def indicator_b4(T: Tables, s: Setting) -> DataFrame:
    """Participants in supervised brushing, against the children of 6 to 12 linked to the facility."""
    dental = s.codes.dentist_ids + s.codes.dental_technician_ids + s.codes.dental_assistant_ids
    sessions = in_period(T, "group_activity", s).where(
        (F.col("practice_id") == s.codes.brushing_practice) & in_list(F.col("occupation_id"), dental)
    )
    counts = sessions.groupBy(*UNIT_IDS).agg(
        F.coalesce(F.sum("participants"), F.lit(0).cast("long")).alias("numerator"),
        F.count("*").alias("atividades"),
    )
    children = people_by_facility(T, s, age_years(s.as_of, F.col("birth_date")).between(6, 12))
    counts = counts.join(children.withColumnRenamed("people", "denominator"), "facility_id", "left")
    return scored(
        named(counts, T, valid_only=True), "b4",
        ratio(F.col("numerator"), F.col("denominator"), empty=0), "atividades",
    )
