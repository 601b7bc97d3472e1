"""Checks of the fifteen indicators. Each returns (parts, select)."""

from __future__ import annotations

from oracle.base import (
    ACCESS, AS_OF, CONTACTS, END, LINKED, PERIOD, STANDARD, START, TEAM, above, half_up, inside,
)

VALID = "no_equipe IS NOT NULL AND no_equipe NOT IN ('', 'SEM EQUIPE')"

UNITS = """units AS (
  SELECT f.facility_id, t.team_id, f.facility_name AS unidade_saude, f.cnes,
    t.team_name AS no_equipe, t.ine AS nu_ine
  FROM facility AS f CROSS JOIN team AS t)"""


def _classified(source: str, bands: str, extra: str = "") -> str:
    extra = f", {extra}" if extra else ""
    return (
        f"SELECT {TEAM}, CAST(numerator AS BIGINT) AS numerator, CAST(denominator AS BIGINT) AS denominator"
        f"{extra}, value, {bands} AS classificacao FROM {source}"
    )


def c1():
    return [UNITS, f"""counted AS (
      SELECT {TEAM}, count(*) AS denominator, count(*) FILTER (visit_type_id IN (2, 3, 8)) AS numerator
      FROM encounter JOIN units USING (facility_id, team_id)
      WHERE occupation_id IN (0, 1) AND facility_id < 20 AND event_date {PERIOD} GROUP BY ALL)""",
      f"result AS (SELECT *, {half_up('numerator', 'denominator')} AS value FROM counted)"], _classified("result", ACCESS)


def _contacts():
    return [UNITS, f"""counted AS (
      SELECT {TEAM}, count(*) AS numerator, count(DISTINCT person_id) AS denominator
      FROM encounter JOIN units USING (facility_id, team_id)
      WHERE occupation_id IN (1, 2) AND facility_id < 20 AND event_date {PERIOD} GROUP BY ALL)""",
      f"result AS (SELECT *, {half_up('numerator', 'denominator', 1)} AS value FROM counted)"], _classified("result", CONTACTS)


def m1():
    return _contacts()


def m2():
    return _contacts()


def b1():
    return [UNITS, LINKED, f"""counted AS (
      SELECT u.*, (SELECT count(DISTINCT d.person_id) FROM dental_procedure AS d
          WHERE d.facility_id = u.facility_id AND d.team_id = u.team_id
            AND d.occupation_id = 5 AND d.procedure_id = 18 AND d.event_date {PERIOD}) AS numerator,
        (SELECT nullif(count(DISTINCT l.person_id), 0) FROM linked AS l WHERE l.facility_id = u.facility_id) AS denominator,
        (SELECT count(*) FROM dental_procedure AS d
          WHERE d.facility_id = u.facility_id AND d.team_id = u.team_id
            AND d.occupation_id = 5 AND d.procedure_id = 18 AND d.event_date {PERIOD}) AS visits
      FROM units AS u WHERE {VALID})""",
      f"result AS (SELECT *, {half_up('numerator', 'denominator')} AS value FROM counted WHERE visits > 0)"], _classified("result", above(5, 3, 1))


def b2():
    return [UNITS, f"""counted AS (
      SELECT u.*, (SELECT count(DISTINCT d.person_id) FROM dental_procedure AS d
          WHERE d.facility_id = u.facility_id AND d.team_id = u.team_id
            AND d.occupation_id = 5 AND d.procedure_id = 18 AND d.event_date {PERIOD}) AS denominator,
        (SELECT count(DISTINCT e.person_id) FROM dental_encounter AS e
          WHERE e.facility_id = u.facility_id AND e.team_id = u.team_id
            AND e.occupation_id = 5 AND e.treatment_completed = 1 AND e.event_date {PERIOD}) AS numerator,
        (SELECT count(*) FROM dental_procedure AS d
          WHERE d.facility_id = u.facility_id AND d.team_id = u.team_id
            AND d.occupation_id = 5 AND d.procedure_id = 18 AND d.event_date {PERIOD}) AS visits
      FROM units AS u WHERE u.facility_id < 20)""",
      f"result AS (SELECT *, coalesce({half_up('numerator', 'denominator')}, 0.0) AS value FROM counted WHERE visits > 0)"], _classified("result", STANDARD)


def _dental(base: str, counted: str):
    return [UNITS, f"""counted AS (
      SELECT facility_id, team_id, {TEAM}, count(*) AS denominator, count(*) FILTER ({counted}) AS numerator
      FROM dental_procedure JOIN units USING (facility_id, team_id)
      WHERE facility_id < 20 AND event_date {PERIOD} AND {VALID} AND ({base}) GROUP BY ALL)""",
      f"result AS (SELECT *, {half_up('numerator', 'denominator')} AS value FROM counted)"]


def b3():
    base = "occupation_id IN (5, 6) AND (procedure_id <= 5 OR procedure_id BETWEEN 7 AND 17)"
    bands = inside("value >= 3 AND value < 10", "value >= 10 AND value < 12", "value >= 12 AND value < 14")
    return _dental(base, "procedure_id <= 1"), _classified("result", bands)


def b5():
    base = "(occupation_id = 5 AND procedure_id <= 17 AND procedure_id <> 1) OR (occupation_id = 6 AND procedure_id BETWEEN 2 AND 8)"
    bands = inside("value BETWEEN 65 AND 85", "value >= 55 AND value < 65", "value >= 40 AND value < 55")
    return _dental(base, "procedure_id BETWEEN 2 AND 8"), _classified("result", bands)


def b6():
    base = "occupation_id = 5 AND procedure_id BETWEEN 9 AND 14"
    return _dental(base, "procedure_id = 10"), _classified("result", above(8, 6, 3))


# Full years of age: the year difference, less one before the birthday.
AGE = f"(year({AS_OF}) - year(birth_date) - CASE WHEN (month(birth_date), day(birth_date)) > (8, 1) THEN 1 ELSE 0 END)"


def b4():
    return [UNITS, LINKED, f"""counted AS (
      SELECT facility_id, team_id, {TEAM}, coalesce(sum(participants), 0) AS numerator, count(*) AS atividades,
        any_value(children) AS denominator
      FROM group_activity AS g JOIN units USING (facility_id, team_id)
      LEFT JOIN (SELECT facility_id, count(DISTINCT person_id) AS children FROM linked WHERE {AGE} BETWEEN 6 AND 12 GROUP BY 1)
        USING (facility_id)
      WHERE practice_id = 9 AND event_date {PERIOD} AND {VALID} GROUP BY ALL)""",
      f"result AS (SELECT *, coalesce({half_up('numerator', 'denominator')}, 0.0) AS value FROM counted)"], _classified("result", above(1, 0.5, 0.25), "atividades")


# ---- practices per person ----

MED_NURSE = "occupation_id IN (0, 1)"
AGENT = "occupation_id IN (3, 4)"


def _exists(table: str, condition: str, owner: str = "c") -> str:
    return f"EXISTS (SELECT 1 FROM {table} AS x WHERE x.person_id = {owner}.person_id AND {condition})"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _year(days: int) -> str:
    return f"x.event_date BETWEEN {END} - {days} AND {END}"


def _two_visits(days: int) -> str:
    return (
        "(SELECT count(*) >= 2 AND max(x.event_date) - min(x.event_date) >= 30 FROM home_visit AS x"
        f" WHERE x.person_id = c.person_id AND x.{AGENT} AND {_year(days)})"
    )


def _pressure(when: str) -> str:
    return "(" + " OR ".join([
        _exists("encounter", f"{when} AND (x.systolic IS NOT NULL OR x.diastolic IS NOT NULL)"),
        _exists("procedure_event", f"{when} AND x.procedure_id = 19"),
        _exists("home_visit", f"{when} AND x.blood_pressure IS NOT NULL"),
    ]) + ")"


def _measured(when: str, occupations: str = "") -> str:
    by = f" AND x.occupation_id IN ({occupations})" if occupations else ""
    return "(" + " OR ".join([
        _exists("encounter", f"{when} AND x.weight IS NOT NULL AND x.height IS NOT NULL{by}"),
        _exists("procedure_event", f"{when} AND x.procedure_id = 20"),
        _exists("home_visit", f"{when} AND x.weight IS NOT NULL AND x.height IS NOT NULL{by}"),
    ]) + ")"


def _practices(marks: dict[str, str]) -> str:
    columns = ", ".join(f"{_flag(test)} AS pratica_{x}" for x, test in marks.items())
    return f"marked AS (SELECT c.*, {columns} FROM cohort AS c)"


def _sums(letters: str) -> str:
    return ", ".join(f"CAST(sum(pratica_{x}) AS BIGINT) AS pratica_{x}" for x in letters)


def _names(letters: str) -> str:
    return ", ".join(f"pratica_{x}" for x in letters)


def _totalled(letters: str, scale: int, times: int):
    total = " + ".join(f"pratica_{x}" for x in letters)
    counted = f"counted AS (SELECT {TEAM}, count(*) AS denominator, {_sums(letters)} FROM marked GROUP BY ALL)"
    value = half_up(total, f"denominator * {times}", scale)
    return [counted, f"result AS (SELECT *, {total} AS numerator, {value} AS value FROM counted)"], _classified("result", STANDARD, _names(letters))


def chronic_cohort(icd: str, icpc: str) -> str:
    return f"""cohort AS (
      SELECT person_id, {TEAM} FROM encounter JOIN units USING (facility_id, team_id) JOIN person USING (person_id)
      WHERE facility_id < 20 AND (regexp_matches(icd_codes, '{icd}') OR regexp_matches(icpc_codes, '{icpc}'))
        AND deceased = 0 AND coalesce(deleted, 0) = 0
      QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY event_date DESC, encounter_id DESC) = 1)"""


# Codes of the conditions (ICD-10, ICPC-2).
DIABETES = ("E10|E11|E14", "T89|T90")
HYPERTENSION = ("I10|I11|I12|I13|I15|O10|O11", "K86|K87")


def _chronic_marks():
    return {
        "a": _exists("encounter", f"x.{MED_NURSE} AND {_year(183)}"),
        "b": _pressure(_year(183)),
        "c": _measured(_year(366)),
        "d": _two_visits(366),
    }


def c4_parts():
    marks = _chronic_marks()
    marks["e"] = _exists("procedure_event", f"x.procedure_id = 21 AND {_year(366)}")
    marks["f"] = _exists("procedure_event", f"x.procedure_id = 22 AND {_year(366)}")
    return [UNITS, chronic_cohort(*DIABETES), _practices(marks)]


def c4():
    more, select = _totalled("abcdef", 100, 6)
    return c4_parts() + more, select


def c5_parts():
    return [UNITS, chronic_cohort(*HYPERTENSION), _practices(_chronic_marks())]


def c5():
    more, select = _totalled("abcd", 100, 4)
    return c5_parts() + more, select


def c6_parts():
    cohort = f"cohort AS (SELECT DISTINCT person_id, {TEAM} FROM linked WHERE birth_date <= {AS_OF} - INTERVAL 60 YEAR)"
    return [LINKED, cohort, _practices({
        "a": _exists("encounter", f"x.{MED_NURSE} AND {_year(366)}"),
        "b": _measured(_year(366), "0, 1, 2, 3, 4"),
        "c": _two_visits(366),
        "d": _exists("vaccination", f"(x.vaccine_codes LIKE '%|33|%' OR x.vaccine_codes LIKE '%|77|%') AND {_year(366)}"),
    })]


def c6():
    more, select = _totalled("abcd", 100, 4)
    return c6_parts() + more, select


def _aged(low: int, high: int) -> str:
    return f"birth_date <= {END} - INTERVAL {low} YEAR AND birth_date > {END} - INTERVAL {high} YEAR"


# Patterns of sexual and reproductive health (ICD-10, ICPC-2).
C7_ICD = (
    r"N80[0-9]?|N91[0-5]?|N92[0-6]?|N93[089]?|N94[0-689]?|N95[0-389]?|N96|N97[0-489]?|O0[34]|R102|T742|"
    r"Y05[0-9]|Z12[34]|Z20[56]|Z30[0-59]?|Z31[0-689]?|Z320|Z600|Z630|Z640|Z70[0-389]?|Z717|Z725"
)
C7_ICPC = "B25|W02|W1[0-5]|W79|W82|X0[1-9]|X1[0-3]|X23|X24|X82|X89|Y14"


def c7_parts():
    ages = {"a": (25, 65), "b": (9, 15), "c": (14, 70), "d": (50, 70)}
    bases = ", ".join(f"max({_flag(_aged(*limits))}) AS base_{x}" for x, limits in ages.items())
    cohort = f"""cohort AS (SELECT person_id, {TEAM}, {bases} FROM linked
      WHERE sex_id = 2 AND {_aged(9, 70)} GROUP BY ALL)"""
    about = f"(regexp_matches(x.icd_codes, '{C7_ICD}') OR regexp_matches(x.icpc_codes, '{C7_ICPC}'))"
    return [LINKED, cohort, _practices({
        "a": "c.base_a = 1 AND " + _exists("procedure_event", f"x.procedure_id = 23 AND {_year(1096)}"),
        "b": "c.base_b = 1 AND " + _exists("vaccination", f"regexp_matches(x.vaccine_codes, '\\|(67|93)\\|') AND x.event_date {PERIOD}"),
        "c": "c.base_c = 1 AND " + _exists("encounter", f"x.{MED_NURSE} AND {about} AND {_year(366)}"),
        "d": "c.base_d = 1 AND " + _exists("procedure_event", f"x.procedure_id = 24 AND {_year(731)}"),
    })]


def c7():
    bases = ", ".join(f"CAST(sum(base_{x}) AS BIGINT) AS base_{x}" for x in "abcd")
    weights = {"a": 20, "b": 30, "c": 30, "d": 20}
    base = {x: f"CAST(greatest(coalesce(base_{x}, 0), 1) AS HUGEINT)" for x in "abcd"}
    product = " * ".join(base.values())
    points = " + ".join(
        " * ".join([f"{w} * coalesce(pratica_{x}, 0)", *(base[y] for y in "abcd" if y != x)]) for x, w in weights.items()
    )
    value = f"CAST((200 * ({points}) + {product}) // (2 * {product}) AS DOUBLE) / 100"
    return c7_parts() + [
        f"counted AS (SELECT {TEAM}, {_sums('abcd')}, {bases} FROM marked GROUP BY ALL)",
        "result AS (SELECT *, pratica_a + pratica_b + pratica_c + pratica_d AS numerator,"
        f" base_a + base_b + base_c + base_d AS denominator, {value} AS value FROM counted)",
    ], _classified("result", STANDARD, "base_a, base_b, base_c, base_d, " + _names("abcd"))


def c2_parts():
    births = f"births AS (SELECT DISTINCT person_id, birth_date FROM linked WHERE birth_date >= {END} - INTERVAL 2 YEAR AND known_team IS NOT NULL)"
    cohort = f"""cohort AS (SELECT DISTINCT person_id, {TEAM},
        (SELECT min(b.birth_date) FROM births AS b WHERE b.person_id = l.person_id) AS born
      FROM linked AS l WHERE birth_date >= {END} - INTERVAL 2 YEAR AND known_team IS NOT NULL)"""

    def after(days):
        return f"EXISTS (SELECT 1 FROM births AS b WHERE b.person_id = x.person_id AND x.event_date BETWEEN b.birth_date AND b.birth_date + {days})"

    lived = f"x.event_date BETWEEN c.born AND {END}"
    measured_days = f"""(SELECT count(DISTINCT day) FROM (
        SELECT x.person_id, x.event_date AS day FROM encounter AS x WHERE x.occupation_id <= 4 AND x.weight IS NOT NULL AND x.height IS NOT NULL
        UNION ALL SELECT x.person_id, x.event_date FROM home_visit AS x WHERE x.weight IS NOT NULL AND x.height IS NOT NULL
        UNION ALL SELECT x.person_id, x.event_date FROM procedure_event AS x WHERE x.procedure_id = 20) AS m
      WHERE m.person_id = c.person_id AND m.day BETWEEN c.born AND {END}) >= 9"""
    visits = f"""(SELECT count(*) >= 2 AND coalesce(min(x.event_date) <= c.born + 30, false) FROM home_visit AS x
      WHERE x.person_id = c.person_id AND x.{AGENT} AND (x.newborn_followup = 1 OR x.child_followup = 1) AND {after(180)})"""

    def doses(codes, least):
        return f"(SELECT count(*) FROM vaccination AS x WHERE x.person_id = c.person_id AND x.event_date <= {END} AND regexp_matches(x.vaccine_codes, '\\|({codes})\\|')) >= {least}"

    return [LINKED, births, cohort, _practices({
        "a": _exists("encounter", f"x.{MED_NURSE} AND {after(30)}"),
        "b": f"(SELECT count(DISTINCT x.event_date) FROM encounter AS x WHERE x.person_id = c.person_id AND x.{MED_NURSE} AND {lived}) >= 9",
        "c": measured_days,
        "d": visits,
        "e": " AND ".join([
            doses("09|17|29|39|42|43|46|47|58", 3), doses("22|29|43|58", 3), doses("24|56", 2),
            doses("26|59|106|107", 2),
        ]),
    })]


def c2():
    more, select = _totalled("abcde", 20, 1)
    return c2_parts() + more, select


def c3_parts():
    cohort = f"""cohort AS (
      SELECT g.person_id, g.pregnancy_no, g.start_date AS b, g.puerperium_start AS pp,
        coalesce(g.puerperium_end, g.puerperium_start + 42) AS pe, coalesce(g.puerperium_start - 1, {AS_OF}) AS until,
        f.facility_name AS unidade_saude, f.cnes, t.team_name AS no_equipe, t.ine AS nu_ine
      FROM pregnancy AS g JOIN person AS p ON p.person_id = g.person_id
      JOIN registration AS r ON r.person_id = p.person_id
      JOIN person_link AS l ON l.registration_id = r.registration_id AND l.valid_from <= {AS_OF} AND l.facility_valid_to > {AS_OF}
      JOIN facility AS f ON f.facility_id = l.facility_id AND f.facility_id < 20
      LEFT JOIN team AS t ON t.team_id = l.team_id
      WHERE g.start_date <= {END} AND (g.puerperium_end IS NULL OR g.puerperium_end >= {START})
      QUALIFY row_number() OVER (PARTITION BY g.person_id, g.pregnancy_no ORDER BY l.valid_from DESC, l.link_id DESC) = 1)"""
    now = f"x.event_date {PERIOD}"
    carrying = f"{now} AND x.event_date BETWEEN c.b AND c.until"

    def counted(table, condition, what="count(*)"):
        return f"(SELECT {what} FROM {table} AS x WHERE x.person_id = c.person_id AND {condition})"

    def days(*sources):
        union = " UNION ALL ".join(f"SELECT person_id, event_date FROM {t} WHERE {w}" for t, w in sources)
        return f"(SELECT count(DISTINCT x.event_date) FROM ({union}) AS x WHERE x.person_id = c.person_id AND {carrying})"

    first = "(" + counted("encounter", f"x.{MED_NURSE} AND {carrying}", "min(x.event_date)") + ")"
    weighed = "weight IS NOT NULL AND height IS NOT NULL"
    return [cohort, _practices({
        "a": _exists("encounter", f"x.{MED_NURSE} AND {now} AND x.event_date BETWEEN c.b AND c.b + 84"),
        "b": counted("encounter", f"x.{MED_NURSE} AND {carrying}") + " >= 7",
        "c": days(
            ("encounter", "systolic IS NOT NULL OR diastolic IS NOT NULL"), ("procedure_event", "procedure_id = 19"),
            ("home_visit", "blood_pressure IS NOT NULL"),
        ) + " >= 7",
        "d": days(("encounter", weighed), ("home_visit", weighed)) + " >= 7",
        "e": counted("home_visit", f"x.{AGENT} AND {now} AND x.event_date <= c.until AND x.event_date >= first_seen") + " >= 3",
        "f": _exists("vaccination", f"x.vaccine_codes LIKE '%|57|%' AND {now} AND x.event_date BETWEEN c.b + 140 AND c.until"),
        "g": _exists("procedure_event", f"x.procedure_id = 25 AND {now} AND x.event_date BETWEEN c.b AND c.b + 91"),
        "h": _exists("procedure_event", f"x.procedure_id = 25 AND {now} AND x.event_date BETWEEN c.b + 196 AND c.until"),
        "i": _exists("encounter", f"x.{MED_NURSE} AND {now} AND x.event_date BETWEEN c.pp AND c.pe"),
        "j": _exists("home_visit", f"x.{AGENT} AND {now} AND x.event_date BETWEEN c.pp AND c.pe"),
        "k": _exists("dental_encounter", f"x.occupation_id IN (5, 6, 7) AND {carrying}"),
    }).replace("FROM cohort AS c", f"FROM (SELECT c.*, {first} AS first_seen FROM cohort AS c) AS c")]


def c3():
    letters = "abcdefghijk"
    points = "10 * pratica_a + 9 * (" + " + ".join(f"pratica_{x}" for x in letters[1:]) + ")"
    return c3_parts() + [
        f"counted AS (SELECT {TEAM}, count(*) AS denominator, {_sums(letters)} FROM marked GROUP BY ALL)",
        f"result AS (SELECT *, {points} AS numerator, {half_up(points, 'denominator', 1)} AS value FROM counted)",
    ], _classified("result", STANDARD, _names(letters))


PRACTICE_PARTS = {
    "c2": (c2_parts, "abcde"), "c3": (c3_parts, "abcdefghijk"), "c4": (c4_parts, "abcdef"),
    "c5": (c5_parts, "abcd"), "c6": (c6_parts, "abcd"), "c7": (c7_parts, "abcd"),
}

INDICATORS = {
    "c1": c1, "c2": c2, "c3": c3, "c4": c4, "c5": c5, "c6": c6, "c7": c7,
    "b1": b1, "b2": b2, "b3": b3, "b4": b4, "b5": b5, "b6": b6, "m1": m1, "m2": m2,
}
