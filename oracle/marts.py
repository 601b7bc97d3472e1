"""Checks of the marts, as read back."""

from __future__ import annotations

from oracle.base import AS_OF, PERIOD, half_up
from oracle.indicators import PRACTICE_PARTS, b1, m1
from oracle.people import IN_FORCE, LIVE, documents, duplicates, foreigners_detail, stale
from oracle.worklists import _merged, indicator_long, outreach_all


def foreigners():
    return foreigners_detail(f", {AS_OF} AS dt_carga")


def indicators():
    parts, rows = indicator_long()
    return parts, f"""SELECT nu_ine, cnes, 200107 AS competencia, upper(indicador) AS cd_indicador, CAST(numerator AS DECIMAL(12,4)) AS numerador,
      CAST(denominator AS DECIMAL(12,4)) AS denominador, CAST(value AS DECIMAL(10,4)) AS vl_indicador, classificacao, {AS_OF} AS dt_carga
      FROM ({rows}) AS w"""


def _score(name: str, letters: str) -> str:
    if name == "c7":
        return "20 * pratica_a + 30 * pratica_b + 30 * pratica_c + 20 * pratica_d"
    if name == "c3":
        return "10 * pratica_a + 9 * (" + " + ".join(f"pratica_{x}" for x in letters[1:]) + ")"
    return half_up(" + ".join(f"pratica_{x}" for x in letters), str(len(letters)))


def person_practices():
    makes = {}
    for name, (parts_of, letters) in PRACTICE_PARTS.items():
        done = ", ".join(f"CASE WHEN pratica_{x} = 1 THEN '{x.upper()}' END" for x in letters)
        select = f"""SELECT person_id AS paciente_id, (SELECT p.cns FROM person AS p WHERE p.person_id = m.person_id) AS cns, nu_ine,
          200107 AS competencia, '{name.upper()}' AS cd_indicador, CAST({_score(name, letters)} AS DECIMAL(5,2)) AS pontuacao,
          concat_ws(',', {done}) AS boas_praticas, {AS_OF} AS dt_carga FROM marked AS m"""
        makes[name] = lambda parts_of=parts_of, select=select: (parts_of(), select)
    parts, selects = _merged(makes)
    return parts, " UNION ALL ".join(f"SELECT * FROM ({q}) AS q" for q in selects.values())


def worklists():
    parts, rows = outreach_all()
    return parts + ["""areas AS (SELECT person_id, arg_max(micro_area, registration_id) AS micro_area FROM registration GROUP BY 1)"""], f"""
      SELECT paciente_id, cns, cpf, nome, condicao, nu_ine, micro_area, CAST(NULL AS VARCHAR) AS telefone,
        CAST(NULL AS VARCHAR) AS acs_responsavel, 0 AS prioridade, {AS_OF} AS dt_geracao
      FROM ({rows}) AS w LEFT JOIN areas ON person_id = paciente_id"""


def inconsistencies():
    profiles, _ = duplicates()
    old = [p for p in stale()[0] if p.startswith("old")]
    flags = documents()[1]
    found = f"""found AS (
        SELECT cns, cpf, 'duplicados' AS kind, concat_ws(' ', name, CAST(birth_date AS VARCHAR)) AS text FROM newest
        WHERE birth_date IS NOT NULL QUALIFY count(*) OVER (PARTITION BY name, birth_date) > 1
        UNION ALL SELECT cns, cpf, 'rn_de', concat_ws(' ', name, coalesce(CAST(birth_date AS VARCHAR), '')) FROM newest WHERE name LIKE 'RN %'
        UNION ALL SELECT p.cns, p.cpf, 'gestante_dum_antiga', 'DUM ' || strftime(o.lmp, '%d/%m/%Y') FROM old AS o JOIN person AS p ON p.person_id = o.person_id WHERE {LIVE}
        UNION ALL SELECT r.cns, r.cpf, 'cpf_ausente', 'cadastro ' || r.registration_id FROM registration AS r JOIN papers AS k ON k.registration_id = r.registration_id
          JOIN person AS p ON p.person_id = r.person_id WHERE {LIVE} AND k.flag_cpf_presente = 0
        UNION ALL SELECT r.cns, r.cpf, 'cns_invalido', 'cadastro ' || r.registration_id FROM registration AS r JOIN papers AS k ON k.registration_id = r.registration_id
          JOIN person AS p ON p.person_id = r.person_id WHERE {LIVE} AND k.flag_cns_valido = 0)"""
    return profiles + old + [f"papers AS ({flags})", found], f"""
      SELECT coalesce(cns, '') AS cns, coalesce(cpf, '') AS cpf, kind AS tp_inconsistencia, text AS descricao, {AS_OF} AS dt_deteccao FROM found"""


NONE = "CAST(NULL AS VARCHAR)"


def patients():
    return [f"""newest AS (SELECT * FROM registration QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY registration_id DESC) = 1)"""], f"""
      SELECT p.person_id AS paciente_id, p.cns, p.cpf, p.name AS nome, n.birth_date AS data_nascimento, CASE p.sex_id WHEN 2 THEN 'F' WHEN 1 THEN 'M' END AS sexo,
        {NONE} AS nome_mae, n.nationality_id AS nacionalidade, n.country_id AS pais_nascimento, n.micro_area, n.ethnicity_id AS etnia,
        1 - p.deceased AS st_vivo, {AS_OF} AS dt_carga FROM person AS p LEFT JOIN newest AS n ON n.person_id = p.person_id"""


def teams():
    return [f"""homes AS (SELECT l.team_id, l.facility_id FROM person_link AS l WHERE {IN_FORCE} AND l.facility_id IS NOT NULL
        GROUP BY l.team_id, l.facility_id
        QUALIFY row_number() OVER (PARTITION BY l.team_id ORDER BY count(*) DESC, l.facility_id DESC) = 1)"""], f"""
      SELECT t.ine AS nu_ine, t.team_name AS no_equipe, {NONE} AS tp_equipe, f.cnes, f.facility_name AS no_unidade, {AS_OF} AS dt_carga
      FROM team AS t LEFT JOIN homes AS h ON h.team_id = t.team_id LEFT JOIN facility AS f ON f.facility_id = h.facility_id"""


def encounters():
    return [], f"""SELECT e.person_id AS paciente_id, p.cns AS cns_paciente, {NONE} AS cns_profissional, t.ine AS nu_ine, f.cnes AS cnes_unidade,
        CAST(e.visit_type_id AS VARCHAR) AS tp_atendimento, {NONE} AS ds_tipo_demanda, {NONE} AS co_sigtap,
        CAST(strftime(e.event_date, '%Y%m') AS INTEGER) AS competencia, e.event_date AS dt_atendimento, {AS_OF} AS dt_carga
      FROM encounter AS e LEFT JOIN person AS p ON p.person_id = e.person_id LEFT JOIN facility AS f ON f.facility_id = e.facility_id
      LEFT JOIN team AS t ON t.team_id = e.team_id"""


def units():
    return [], f"SELECT cnes, facility_name AS no_unidade, {NONE} AS tp_unidade, {AS_OF} AS dt_carga FROM facility"


def procedures():
    return [], f"SELECT code AS co_sigtap, {NONE} AS no_procedimento, {NONE} AS categoria, {AS_OF} AS dt_carga FROM procedure_code"


def vaccinations():
    return [], f"""SELECT p.cns, {NONE} AS co_sigtap, v.vaccine_codes AS ds_vacina, {NONE} AS dose, v.event_date AS dt_aplicacao,
      {NONE} AS fonte, {AS_OF} AS dt_carga FROM vaccination AS v LEFT JOIN person AS p ON p.person_id = v.person_id"""


def home_visits():
    return [], f"""SELECT p.cns, {NONE} AS cns_acs, {NONE} AS nu_ine, v.event_date AS dt_visita, {NONE} AS tp_visita, {AS_OF} AS dt_carga
      FROM home_visit AS v LEFT JOIN person AS p ON p.person_id = v.person_id"""


FACTS = ("encounter", "home_visit", "vaccination", "procedure_event", "dental_procedure", "dental_encounter", "group_activity")
KEYS = {"encounter": ("encounter_id",), "group_activity": ("activity_id", "practice_id")}


def _earlier(name: str) -> str:
    """The table as it was before: July 2001 missing, the 15th of each month other, January 2000 again in May 1980."""
    other = "participants" if name == "group_activity" else "person_id"
    key = KEYS[name][0] if name in KEYS else None
    moved = "make_date(1980, 5, day(event_date)) AS event_date" + (f", {key} + 1000000000000 AS {key}" if key else "")
    return f"""SELECT * REPLACE (CASE WHEN day(event_date) = 15 THEN {other} + 1 ELSE {other} END AS {other}) FROM {name}
        WHERE strftime(event_date, '%Y-%m') <> '2001-07'
      UNION ALL SELECT * REPLACE ({moved}) FROM {name} WHERE strftime(event_date, '%Y-%m') = '2000-01'"""


def lake_changes():
    parts, selects = [], []
    for name in ("encounter", "group_activity", "vaccination"):
        month = "strftime(event_date, '%Y-%m') AS mes"
        key = KEYS.get(name)
        parts += [
            f"old_{name} AS ({_earlier(name)})",
            f"came_{name} AS (SELECT * FROM {name} EXCEPT ALL SELECT * FROM old_{name})",
            f"went_{name} AS (SELECT * FROM old_{name} EXCEPT ALL SELECT * FROM {name})",
        ]
        if key is None:
            selects.append(f"""SELECT '{name}' AS tabela, mes, CAST(sum(i) AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS changed, CAST(sum(d) AS BIGINT) AS deleted FROM (
              SELECT {month}, 1 AS i, 0 AS d FROM came_{name} UNION ALL SELECT {month}, 0, 1 FROM went_{name}) AS x GROUP BY mes""")
        else:
            on = " AND ".join(f"o.{k} = c.{k}" for k in key)
            back = " AND ".join(f"c.{k} = o.{k}" for k in key)
            selects.append(f"""SELECT '{name}' AS tabela, mes, CAST(sum(i) AS BIGINT) AS inserted, CAST(sum(x) AS BIGINT) AS changed, CAST(sum(d) AS BIGINT) AS deleted FROM (
              SELECT strftime(c.event_date, '%Y-%m') AS mes, CASE WHEN EXISTS (SELECT 1 FROM went_{name} AS o WHERE {on}) THEN 0 ELSE 1 END AS i,
                CASE WHEN EXISTS (SELECT 1 FROM went_{name} AS o WHERE {on}) THEN 1 ELSE 0 END AS x, 0 AS d FROM came_{name} AS c
              UNION ALL SELECT strftime(o.event_date, '%Y-%m'), 0, 0, 1 FROM went_{name} AS o WHERE NOT EXISTS (SELECT 1 FROM came_{name} AS c WHERE {back})) AS y GROUP BY mes""")
    return parts, " UNION ALL ".join(selects)


def months_city():
    return [], f"""SELECT 'contato' AS tipo, count(*) AS numerator, CAST(count(DISTINCT person_id) AS BIGINT) AS people FROM encounter
        WHERE occupation_id IN (1, 2) AND facility_id < 20 AND event_date {PERIOD}
      UNION ALL SELECT 'primeira', count(*), count(DISTINCT person_id) FROM dental_procedure
        WHERE occupation_id = 5 AND procedure_id = 18 AND facility_id < 20 AND event_date {PERIOD}"""


MARTS = {
    "months_m1": m1, "months_b1": b1, "months_city": months_city,
    **{f"lake_{name}": (lambda name=name: ([], f"SELECT * FROM {name}")) for name in FACTS}, "lake_changes": lake_changes,
    "mart_encounters_refresh": encounters, "mart_declared": inconsistencies,
    "mart_foreigners": foreigners, "mart_indicators": indicators, "mart_person_practices": person_practices,
    "mart_worklists": worklists, "mart_inconsistencies": inconsistencies, "mart_patients": patients, "mart_teams": teams,
    "mart_encounters": encounters, "mart_units": units, "mart_procedures": procedures,
    "mart_vaccinations": vaccinations, "mart_home_visits": home_visits,
}
