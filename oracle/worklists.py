"""Checks of outreach lists and roll-ups."""

from __future__ import annotations

from oracle.base import ACCESS, AS_OF, CONTACTS, END, LINKED, PERIOD, START, TEAM, half_up
from oracle.indicators import AGE, INDICATORS, UNITS, VALID, c1

CONTACT = """person_id AS paciente_id, name AS nome, coalesce(cns, '') AS cns, coalesce(cpf, '') AS cpf,
  coalesce(CAST(birth_date AS VARCHAR), '') AS data_nascimento"""


def _unseen(condition: str, owner: str = "true"):
    """Linked people fulfilling the condition without a doctor's or nurse's encounter in the period."""
    return [LINKED], f"""SELECT DISTINCT {TEAM}, {CONTACT} FROM linked AS i WHERE {condition} AND {owner}
      AND NOT EXISTS (SELECT 1 FROM encounter AS x WHERE x.person_id = i.person_id AND x.occupation_id < 2 AND x.event_date {PERIOD})"""


def o_c2():
    return _unseen(f"{AGE} <= 2")


def o_c3():
    return _unseen("birth_date IS NOT NULL", f"""EXISTS (SELECT 1 FROM pregnancy AS g WHERE g.person_id = i.person_id
      AND g.start_date <= {END} AND coalesce(g.puerperium_end, {START}) >= {START})""")


def _ill(test: str):
    return _unseen("true", f"i.person_id IN (SELECT person_id FROM encounter WHERE {test})")


def o_c4():
    return _ill("icd_codes IN ('|E11|', '|J00|E14|') OR icpc_codes = '|T90|'")


def o_c5():
    return _ill("icd_codes = '|I10|' OR icpc_codes = '|K86|'")


def o_c6():
    return _unseen(f"birth_date <= {AS_OF} - INTERVAL 60 YEAR")


def o_c7():
    return _unseen(f"sex_id = 2 AND birth_date <= {AS_OF} - INTERVAL 9 YEAR")


BIRTHS = "births AS (SELECT DISTINCT person_id, birth_date FROM registration)"


def o_c1():
    return [UNITS, BIRTHS, f"""contacts AS (SELECT * FROM encounter WHERE occupation_id < 2 AND event_date {PERIOD})""", f"""focus AS (
      SELECT person_id FROM contacts EXCEPT SELECT person_id FROM contacts WHERE visit_type_id IN (2, 3, 8))""", f"""listed AS (
      SELECT person_id, {TEAM}, count(*) AS total_consultas_no_periodo
      FROM focus JOIN contacts USING (person_id) JOIN units USING (facility_id, team_id) WHERE facility_id < 20 GROUP BY ALL)"""], f"""
      SELECT {TEAM}, {CONTACT}, total_consultas_no_periodo FROM listed JOIN person USING (person_id) LEFT JOIN births USING (person_id)"""


def o_b1():
    return [LINKED], f"""SELECT DISTINCT {TEAM}, {CONTACT} FROM linked AS i WHERE NOT EXISTS (
      SELECT 1 FROM dental_procedure AS d JOIN facility AS f ON f.facility_id = d.facility_id
      WHERE d.person_id = i.person_id AND f.facility_name = i.unidade_saude AND f.cnes = i.cnes AND f.facility_id < 20
        AND d.occupation_id = 5 AND d.event_date {PERIOD})"""


def o_b2():
    return [BIRTHS, f"""open_cases AS (
      SELECT DISTINCT d.person_id, f.facility_name AS unidade_saude, f.cnes, t.team_name AS no_equipe, t.ine AS nu_ine
      FROM dental_procedure AS d JOIN facility AS f ON f.facility_id = d.facility_id LEFT JOIN team AS t ON t.team_id = d.team_id
      WHERE d.facility_id < 20 AND d.occupation_id = 5 AND d.procedure_id = 18 AND d.event_date {PERIOD}
        AND NOT EXISTS (SELECT 1 FROM dental_encounter AS e JOIN facility AS o ON o.facility_id = e.facility_id
          WHERE e.person_id = d.person_id AND o.facility_name = f.facility_name AND o.cnes = f.cnes AND o.facility_id < 20
          AND e.occupation_id = 5 AND e.treatment_completed = 1 AND e.event_date {PERIOD}))"""], f"""
      SELECT {TEAM}, {CONTACT} FROM open_cases JOIN person USING (person_id) LEFT JOIN births USING (person_id)"""


def o_b3():
    return [UNITS, BIRTHS, f"""counted AS (
      SELECT person_id, unidade_saude, cnes, count(*) AS total_procedimentos, count(*) FILTER (procedure_id < 2) AS exodontias,
        count(*) FILTER (procedure_id >= 2) AS preventivos_curativos
      FROM dental_procedure JOIN units USING (facility_id, team_id)
      WHERE facility_id < 20 AND occupation_id IN (5, 6) AND procedure_id <= 17 AND procedure_id <> 6 AND event_date {PERIOD} AND {VALID}
      GROUP BY ALL)"""], f"""SELECT unidade_saude, cnes, {CONTACT}, exodontias, preventivos_curativos, total_procedimentos
      FROM counted JOIN person USING (person_id) LEFT JOIN births USING (person_id) WHERE exodontias > 0"""


def _lacking(base: str, wanted: str):
    rows = f"""SELECT person_id, unidade_saude, cnes, no_equipe FROM dental_procedure JOIN units USING (facility_id, team_id)
      WHERE facility_id < 20 AND event_date {PERIOD} AND {VALID}"""
    return [UNITS, BIRTHS, f"lacking AS ({rows} AND ({base}) EXCEPT {rows} AND {wanted})"], f"""
      SELECT unidade_saude, cnes, no_equipe, CAST(NULL AS VARCHAR) AS nu_ine, {CONTACT}
      FROM lacking JOIN person USING (person_id) LEFT JOIN births USING (person_id)"""


def o_b5():
    base = "occupation_id = 5 AND procedure_id <= 17 AND procedure_id <> 1 OR occupation_id = 6 AND procedure_id BETWEEN 2 AND 8"
    return _lacking(base, "occupation_id IN (5, 6) AND procedure_id BETWEEN 2 AND 8")


def o_b6():
    return _lacking("occupation_id = 5 AND procedure_id BETWEEN 9 AND 14", "occupation_id = 5 AND procedure_id = 10")


OUTREACH = {
    "c1": o_c1, "c2": o_c2, "c3": o_c3, "c4": o_c4, "c5": o_c5, "c6": o_c6, "c7": o_c7,
    "b1": o_b1, "b2": o_b2, "b3": o_b3, "b5": o_b5, "b6": o_b6,
}


def _merged(queries: dict):
    """Parts of several checks side by side: shared ones once, own ones under a prefix."""
    shared, selects, parts = {UNITS, LINKED, BIRTHS}, {}, []
    for name, make in queries.items():
        own, select = make()
        nested = [p for p in own if p not in shared]
        parts += [p for p in own if p in shared and p not in parts]
        selects[name] = ("WITH " + ", ".join(nested) + " " if nested else "") + select
    return parts, selects


def outreach_all():
    parts, selects = _merged(OUTREACH)
    columns = "paciente_id, nome, cns, cpf, data_nascimento"
    union = []
    for name, select in selects.items():
        team = "CAST(NULL AS VARCHAR) AS no_equipe, CAST(NULL AS VARCHAR) AS nu_ine" if name == "b3" else "no_equipe, nu_ine"
        union.append(f"SELECT '{name}' AS condicao, unidade_saude, cnes, {team}, {columns} FROM ({select}) AS q")
    return parts, " UNION ALL ".join(union)


def access_gap():
    parts, select = c1()
    own, listed = o_c1()
    levels = """gaps AS (
      SELECT *, 'Ótimo' AS nivel, '≤70%' AS meta, greatest(0, (100 * numerator + 69) // 70 - denominator) AS faltam, 'consultas espontâneas' AS tipo FROM teams WHERE value > 70
      UNION ALL SELECT *, 'Ótimo (já atingido)', NULL, 0, '—' FROM teams WHERE value BETWEEN 50 AND 70
      UNION ALL SELECT *, 'Ótimo', '≥50%', denominator - 2 * numerator, 'consultas programadas' FROM teams WHERE value < 50
      UNION ALL SELECT *, 'Bom', '≥30%', (3 * denominator - 10 * numerator + 6) // 7, 'consultas programadas' FROM teams WHERE value < 30)"""
    bands = ACCESS.replace("value < 10", "value <= 10")
    return parts + [p for p in own if p != UNITS and not p.startswith("listed")] + [p.replace("listed AS", "called AS") for p in own if p.startswith("listed")] + [
        f"teams AS ({select})", f"people AS ({listed.replace('FROM listed', 'FROM called')})", levels,
    ], f"""SELECT {TEAM}, value AS atual, {bands} AS classificacao, nivel, meta, CAST(faltam AS BIGINT) AS faltam, tipo,
      (SELECT count(*) FROM people AS p WHERE p.cnes = g.cnes AND p.unidade_saude = g.unidade_saude AND p.no_equipe IS NOT DISTINCT FROM g.no_equipe
          AND p.nu_ine IS NOT DISTINCT FROM g.nu_ine)
        AS total_pacientes_para_busca FROM gaps AS g"""


def rollup_units():
    parts, select = c1()
    return parts + [f"teams AS ({select})", """sums AS (SELECT unidade_saude, max(cnes) AS cnes, CAST(sum(numerator) AS BIGINT) AS numerator,
      CAST(sum(denominator) AS BIGINT) AS denominator FROM teams GROUP BY 1)"""], f"SELECT *, {half_up('numerator', 'denominator')} AS value FROM sums"


def rollup_city():
    sums = {
        "c1": (f"occupation_id < 2 AND facility_id < 20 AND event_date {PERIOD}", "count(*) FILTER (visit_type_id IN (2, 3, 8))", "count(*)", "encounter", 100, ACCESS),
        "m1": (f"occupation_id IN (1, 2) AND facility_id < 20 AND event_date {PERIOD}", "count(*)", "count(DISTINCT person_id)", "encounter", 1, CONTACTS),
        "b1": (f"occupation_id = 5 AND procedure_id = 18 AND facility_id < 20 AND event_date {PERIOD}", "count(DISTINCT person_id)", "CAST(NULL AS BIGINT)", "dental_procedure", 1, None),
    }
    parts, selects = [UNITS], []
    for name, (condition, num, den, table, scale, bands) in sums.items():
        value = "CAST(NULL AS DOUBLE)" if bands is None else half_up("numerator", "denominator", scale)
        parts.append(f"""{name}_teams AS (SELECT {TEAM}, {num} AS numerator, {den} AS denominator
          FROM {table} JOIN units USING (facility_id, team_id) WHERE {condition} GROUP BY {TEAM})""")
        parts.append(f"""{name}_units AS (SELECT *, {value} AS value FROM (SELECT unidade_saude, max(cnes) AS cnes,
          CAST(sum(numerator) AS BIGINT) AS numerator, CAST(sum(denominator) AS BIGINT) AS denominator FROM {name}_teams GROUP BY 1) AS q)""")
        selects.append(f"""SELECT '{name}' AS indicador, 'unidade' AS nivel, unidade_saude, cnes, numerator, denominator, value,
          CAST(NULL AS VARCHAR) AS classificacao FROM {name}_units""")
        mean = "CAST(NULL AS DOUBLE)" if bands is None else half_up("CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT)", "(100 * count(value))", 1)
        selects.append(f"""SELECT '{name}', 'municipio', NULL, NULL, numerator, denominator, value, {bands or 'NULL'} FROM (
          SELECT CAST(sum(numerator) AS BIGINT) AS numerator, CAST(sum(denominator) AS BIGINT) AS denominator, {mean} AS value FROM {name}_units) AS q""")
    return parts, " UNION ALL ".join(selects)


def indicator_long():
    parts, selects = _merged(INDICATORS)
    union = [
        f"""SELECT '{name}' AS indicador, {TEAM}, numerator, denominator, value, classificacao, {START} AS inicio, {END} AS fim
          FROM ({select}) AS q""" for name, select in selects.items()
    ]
    return parts, " UNION ALL ".join(union)


def band_distribution():
    parts, rows = indicator_long()
    labels = {"otimo": "Ótimo", "bom": "Bom", "suficiente": "Suficiente", "regular": "Regular"}
    counts = ", ".join(f"count(*) FILTER (classificacao = '{t}') AS {c}" for c, t in labels.items())
    return parts, f"SELECT indicador, {counts} FROM ({rows}) AS w GROUP BY 1"


WORKLISTS = {
    **{f"outreach_{name}": make for name, make in OUTREACH.items()},
    "outreach_all": outreach_all, "outreach_access_gap": access_gap, "rollup_units": rollup_units,
    "rollup_city": rollup_city, "indicator_long": indicator_long, "band_distribution": band_distribution,
}
