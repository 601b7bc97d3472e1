"""Outreach worklists: who still lacks the care an indicator asks for.

Every list carries the team, so the team filter works on all of them. A list is a set of people minus
those already seen; the seen are reduced to distinct ids in map tasks before the anti-join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from carespan.codes import ACCESS_GAP_BANDS
from carespan.functions.scalars import age_years, band, blank, flag, in_list, ratio
from carespan.operators.listing import filter_team, filter_unit
from carespan.operators.marks import with_occupation
from carespan.operators.population import contact_columns, linked_people
from carespan.operators.practice_indicators import (
    active_pregnancies, names_condition, older_people,
)
from carespan.operators.ratio_indicators import (
    access_counts, completed_treatments, first_dental_visits, in_period, preventive_base, procedures_of,
)
from carespan.operators.units import FACILITY, TEAM, in_scope, named, team_names, unit_keys
from carespan.setting import Setting
from carespan.sources.lake import within
from carespan.sources.tables import Tables

CONTACT = ["paciente_id", "nome", "cns", "cpf", "data_nascimento"]


def _contact(*extra) -> list:
    birth = blank(F.col("birth_date")).alias("data_nascimento")
    return [F.col("person_id").alias("paciente_id"), *contact_columns(), birth, *extra]


def _linked(T: Tables, s: Setting, where: Column | None = None) -> DataFrame:
    """Distinct linked people x birth date x team (ids per distinct name)."""
    rows = unit_keys(linked_people(T, s, where), T, team="left")
    return rows.dropDuplicates(["person_id", "birth_date", "facility_id", "team_id"])


def _listed(rows: DataFrame, T: Tables) -> DataFrame:
    return named(rows, T, team="left").select(*TEAM, *_contact())


def _with_contact(rows: DataFrame, T: Tables) -> DataFrame:
    """Add the person's data, and a row per distinct birth date of the person's registrations."""
    births = T["registration"].select("person_id", "birth_date").join(
        rows.select("person_id"), "person_id", "left_semi"
    ).distinct()
    people = T["person"].select("person_id", "name", "cns", "cpf")
    return rows.join(people, "person_id").join(births, "person_id", "left")


def outreach_c1(T: Tables, s: Setting) -> DataFrame:
    """People seen by a doctor or nurse in the period, but never at a scheduled visit.

    Encounters are counted per person and team first; whether any of them was scheduled is then a
    window over those few rows per person.
    """
    scheduled = in_list(F.col("visit_type_id"), s.codes.scheduled_visit_types)
    by = in_list(F.col("occupation_id"), s.codes.med_nurse_ids) & F.col("person_id").isNotNull()
    counts = in_period(T, "encounter", s).where(by).groupBy("person_id", "facility_id", "team_id").agg(
        F.count("*").alias("contacts"), F.max(flag(scheduled)).alias("scheduled")
    )
    ever = F.max("scheduled").over(Window.partitionBy("person_id"))
    unscheduled = counts.withColumn("ever", ever).where((F.col("ever") == 0) & in_scope(s))
    rows = unit_keys(unscheduled, T).groupBy("person_id", "facility_id", "team_id").agg(
        F.sum("contacts").alias("total_consultas_no_periodo")
    )
    return named(_with_contact(rows, T), T).select(*TEAM, *_contact("total_consultas_no_periodo"))


def _women_from_nine(s: Setting) -> Column:
    return (F.col("sex_id") == s.codes.female_sex) & (
        F.col("birth_date") <= F.add_months(F.lit(s.as_of), -12 * 9)
    )


LINKED_LISTS = ("c2", "c3", "c4", "c5", "c6", "c7")


def linked_worklists(T: Tables, s: Setting, names=LINKED_LISTS) -> DataFrame:
    """Some of the worklists of C2 to C7, tagged with their condition: people not seen by a doctor or nurse.

    C2: children of up to two full years; C3: women with an active pregnancy; C4, C5: people with
    diabetes, hypertension; C6: people of 60 and over; C7: women from 9 years on. The linked people are
    built once, and the encounters are read once for who was seen (by each rule of who counts as doctor
    or nurse that the lists ask for) and once for who has a condition.
    """
    c, birth = s.codes, F.col("birth_date")
    wanted = {
        "c2": (age_years(s.as_of, birth) <= 2, "seen_by_id"),
        "c3": ((F.col("pregnant") == 1) & birth.isNotNull(), "med_nurse_wide"),
        "c4": (F.col("diabetes") == 1, "med_nurse_wide"),
        "c5": (F.col("hypertension") == 1, "med_nurse_wide"),
        "c6": (older_people(s), "med_nurse"),
        "c7": (_women_from_nine(s), "seen_by_id"),
    }
    wanted = {n: wanted[n] for n in names}
    # lists that only ask for age and sex need no other linked people
    of_people = [wanted[n][0] for n in names if n in ("c2", "c6", "c7")]
    people = _linked(T, s, reduce(Column.__or__, of_people) if len(of_people) == len(names) else None)

    rules = sorted({rule for _, rule in wanted.values()})
    contacts = in_period(T, "encounter", s).select("person_id", "occupation_id").withColumn(
        "seen_by_id", F.coalesce(in_list(F.col("occupation_id"), c.med_nurse_ids), F.lit(False))
    )
    coded = [r for r in rules if r != "seen_by_id"]
    contacts = with_occupation(contacts, T, s, *coded) if coded else contacts
    seen = contacts.where(reduce(Column.__or__, [F.col(r) for r in rules])).groupBy("person_id").agg(
        *[F.max(flag(F.col(r))).alias(r) for r in rules]
    )
    marks = [seen]
    conditions = {
        "c4": ("diabetes", names_condition(c.diabetes_icd, c.diabetes_icpc)),
        "c5": ("hypertension", names_condition(c.hypertension_icd, c.hypertension_icpc)),
    }
    conditions = [conditions[n] for n in names if n in conditions]
    if conditions:
        ill = within(T["encounter"], c.condition_since).where(reduce(Column.__or__, [test for _, test in conditions]))
        marks.append(ill.groupBy("person_id").agg(*[F.max(flag(test)).alias(name) for name, test in conditions]))
    if "c3" in names:
        marks.append(active_pregnancies(T, s).select("person_id").distinct().withColumn("pregnant", F.lit(1)))
    for rows in marks:
        people = people.join(rows, "person_id", "left")
    lists = [
        F.when(belongs & (F.coalesce(F.col(rule), F.lit(0)) == 0), F.lit(name)) for name, (belongs, rule) in wanted.items()
    ]
    rows = people.withColumn("condicao", F.explode(F.array_compact(F.array(*lists))))
    return named(rows, T, team="left").select("condicao", *TEAM, *_contact())


def linked_worklist(name: str):
    """One of the worklists of C2 to C7."""
    return lambda T, s: linked_worklists(T, s, (name,)).drop("condicao")


def outreach_b1(T: Tables, s: Setting, by: str = "facility") -> DataFrame:
    """Linked people without any dentist's procedure in the period.

    A person treated at another facility only stays on the list of the own one; with ``by="person"``
    treatment anywhere in scope counts.
    """
    if by not in ("facility", "person"):
        raise ValueError("by must be 'facility' or 'person'")
    dentist = in_list(F.col("occupation_id"), s.codes.dentist_ids)
    treated = in_period(T, "dental_procedure", s).where(dentist & in_scope(s))
    keys = ["person_id", "facility_id"] if by == "facility" else ["person_id"]
    treated = unit_keys(treated.select("person_id", "facility_id"), T, team=None).select(*keys).distinct()
    return _listed(_linked(T, s).join(treated, keys, "left_anti"), T)


def outreach_b2(T: Tables, s: Setting, by: str = "facility") -> DataFrame:
    """People with a first dental visit but no completed treatment at that facility."""
    if by not in ("facility", "person"):
        raise ValueError("by must be 'facility' or 'person'")
    keys = ["person_id", "facility_id"] if by == "facility" else ["person_id"]
    started = first_dental_visits(T, s).where(in_scope(s)).select("person_id", "facility_id", "team_id")
    started = unit_keys(started, T, team="left").select("person_id", "facility_id", "team_id").distinct()
    done = completed_treatments(T, s).where(in_scope(s)).select("person_id", "facility_id")
    done = unit_keys(done, T, team=None).select(*keys).distinct()
    return _listed(_with_contact(started.join(done, keys, "left_anti"), T), T)


def _dental_rows(T: Tables, s: Setting, **sets) -> DataFrame:
    """Dental procedures of the period in scope with their code sets, by teams with a real name."""
    rows = in_period(T, "dental_procedure", s).where(in_scope(s)).join(procedures_of(T, **sets), "procedure_id")
    return rows.join(team_names(T, valid_only=True), "team_id")


def outreach_b3(T: Tables, s: Setting, team: str | None = None) -> DataFrame:
    """People with an extraction: extractions, other listed procedures, all. One row per facility.

    ``team`` limits the procedures that are counted, as the rows have no team of their own.
    """
    rows = _dental_rows(T, s, extraction=s.codes.extractions, listed=s.codes.listed_dental)
    by = in_list(F.col("occupation_id"), s.codes.dentist_ids + s.codes.dental_technician_ids)
    rows = rows.where(by & (F.col("listed") == 1))
    if team is not None:
        rows = filter_team(rows, team)
    counts = rows.groupBy("person_id", "facility_id").agg(
        F.sum("extraction").alias("exodontias"), F.count("*").alias("total_procedimentos")
    )
    counts = unit_keys(counts, T, team=None).groupBy("person_id", "facility_id").agg(
        F.sum("exodontias").alias("exodontias"), F.sum("total_procedimentos").alias("total_procedimentos")
    ).where(F.col("exodontias") > 0)
    counts = counts.withColumn("preventivos_curativos", F.col("total_procedimentos") - F.col("exodontias"))
    return named(_with_contact(counts, T), T, team=None).select(
        *FACILITY, *_contact("exodontias", "preventivos_curativos", "total_procedimentos")
    )


def _without(T: Tables, rows: DataFrame, base: Column, wanted: Column) -> DataFrame:
    """People in the base of a share without the wanted procedure in the same facility and team name.

    One grouping decides both, where a set difference would need the rows twice.
    """
    marked = rows.select("person_id", "facility_id", "no_equipe", flag(base).alias("base"), flag(wanted).alias("wanted"))
    marked = marked.where((F.col("base") == 1) | (F.col("wanted") == 1))
    keys = ["person_id", "facility_id", "no_equipe"]
    most = [F.max("base").alias("base"), F.max("wanted").alias("wanted")]
    people = unit_keys(marked.groupBy(*keys).agg(*most), T, team=None).groupBy(*keys).agg(*most)
    people = people.where((F.col("base") == 1) & (F.col("wanted") == 0))
    return named(_with_contact(people, T), T, team=None).select(
        *FACILITY, "no_equipe", F.lit(None).cast("string").alias("nu_ine"), *_contact()
    )


def outreach_b5(T: Tables, s: Setting) -> DataFrame:
    """People counted for the preventive share without a preventive procedure."""
    rows = _dental_rows(T, s, preventive=s.codes.preventive_dental, listed=s.codes.preventive_base)
    by = in_list(F.col("occupation_id"), s.codes.dentist_ids + s.codes.dental_technician_ids)
    return _without(T, rows, preventive_base(s), by & (F.col("preventive") == 1))


def outreach_b6(T: Tables, s: Setting) -> DataFrame:
    """People with restorative procedures, none of them atraumatic."""
    rows = _dental_rows(T, s, atraumatic=s.codes.atraumatic, listed=s.codes.restorative_dental)
    by = in_list(F.col("occupation_id"), s.codes.dentist_ids)
    return _without(T, rows, by & (F.col("listed") == 1), by & (F.col("atraumatic") == 1))


OUTREACH = {
    "c1": outreach_c1, **{name: linked_worklist(name) for name in LINKED_LISTS}, "b1": outreach_b1, "b2": outreach_b2,
    "b3": outreach_b3, "b5": outreach_b5, "b6": outreach_b6,
}


def outreach_list(name: str, T: Tables, s: Setting, unit: str | None = None, team: str | None = None) -> DataFrame:
    """A worklist by indicator, limited to units whose name contains a text, and to one team."""
    if name == "b3":
        rows = outreach_b3(T, s, team)
    else:
        rows = OUTREACH[name](T, s)
        if team is not None:
            rows = filter_team(rows, team)
    return rows if unit is None else filter_unit(rows, unit, code=None)


# ---- how far a team is from the next access band ----

# Level, its lowest share, both in per cent.
LEVELS = (("Ótimo", 50), ("Bom", 30))
HIGHEST = 70


def _ceil_div(num: Column, den: int) -> Column:
    return F.call_function("div", num + (den - 1), F.lit(den))


def access_gap(T: Tables, s: Setting) -> DataFrame:
    """Per team and reachable level: the visits that are missing, and how many people to call.

    Below a level, each further scheduled visit also adds to the total; above 70 % it takes more
    walk-in visits. The missing visits are whole-number ceilings, free of binary rounding. The people
    themselves are the rows of ``outreach_c1`` of the same team, a list without bound that is not
    nested here.
    """
    done, total, share = F.col("numerator"), F.col("denominator"), F.col("value")
    counts = access_counts(T, s).withColumn("value", ratio(done, total))

    def entry(level, goal, missing, kind):
        return F.struct(
            F.lit(level).alias("nivel"), F.lit(goal).cast("string").alias("meta"),
            missing.cast("long").alias("faltam"), F.lit(kind).alias("tipo"),
        )

    above = entry("Ótimo", f"≤{HIGHEST}%", F.greatest(F.lit(0), _ceil_div(done * 100 - total * HIGHEST, HIGHEST)), "consultas espontâneas")
    reached = entry("Ótimo (já atingido)", None, F.lit(0), "—")
    below = [
        F.when(
            share < low,
            entry(level, f"≥{low}%", _ceil_div(total * low - done * 100, 100 - low), "consultas programadas"),
        )
        for level, low in LEVELS
    ]
    gaps = (
        F.when(share > HIGHEST, F.array(above)).when(share >= LEVELS[0][1], F.array(reached))
        .otherwise(F.array_compact(F.array(*below)))
    )
    people = outreach_c1(T, s).groupBy(*TEAM).agg(F.count("*").alias("people"))
    same_team = [F.col(f"g.{c}").eqNullSafe(F.col(f"p.{c}")) for c in TEAM]
    rows = counts.select(*TEAM, "value", F.explode(gaps).alias("gap"))
    joined = rows.alias("g").join(people.alias("p"), same_team, "left")
    return joined.select(
        *[f"g.{c}" for c in TEAM], F.col("g.value").alias("atual"),
        band(F.col("g.value"), ACCESS_GAP_BANDS).alias("classificacao"), "g.gap.*",
        F.coalesce(F.col("p.people"), F.lit(0)).alias("total_pacientes_para_busca"),
    )
