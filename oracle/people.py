"""Checks of cohorts, reference lists, quality worklists and benefits."""

from __future__ import annotations

from oracle.base import AS_OF, LINKED, TEAM

IN_FORCE = f"(l.valid_from <= {AS_OF} AND l.facility_valid_to > {AS_OF})"
LIVE = "(p.deceased = 0 AND coalesce(p.deleted, 0) = 0)"
CPF_FLAG = "CASE WHEN length(trim(coalesce(r.cpf, ''))) > 0 AND trim(r.cpf, '0') <> '' THEN 1 ELSE 0 END"


def _weighted(column: str) -> str:
    digits = f"regexp_replace({column}, '[^0-9]', '', 'g')"
    return " + ".join(f"CAST(substr({digits}, {i}, 1) AS INT) * {16 - i}" for i in range(1, 16))


def _cns_ok(column: str) -> str:
    return (
        f"(CASE WHEN {column} IS NULL OR length(regexp_replace({column}, '[^0-9]', '', 'g')) <> 15 THEN false"
        f" WHEN {column}[1] NOT IN ('1', '2', '7', '8', '9') THEN false ELSE ({_weighted(column)}) % 11 <> 1 END)"
    )


def facilities():
    return [], "SELECT facility_id AS id, facility_name AS nome, cnes FROM facility WHERE facility_id < 20"


def active_teams():
    return [], """SELECT DISTINCT t.team_id AS id, t.team_name AS nome, t.ine, f.facility_name AS unidade
      FROM team AS t, (SELECT DISTINCT team_id, facility_id FROM encounter) AS e JOIN facility AS f ON f.facility_id = e.facility_id
      WHERE e.team_id = t.team_id AND e.facility_id < 20 AND t.ine <> '-'"""


def linked_population():
    return [LINKED], f"SELECT DISTINCT person_id, birth_date, sex_id, {TEAM} FROM linked"


def _chosen(condition: str) -> str:
    return f"""chosen AS (
      SELECT r.*, p.name FROM registration AS r JOIN person AS p ON p.person_id = r.person_id
      WHERE r.exit_type_id IN (SELECT exit_type_id FROM exit_type WHERE marker = '-') AND r.inactive = 0 AND {condition}
        AND EXISTS (SELECT 1 FROM person_link AS l WHERE l.registration_id = r.registration_id AND {IN_FORCE})
        AND r.registration_id IN (SELECT a.registration_id FROM person_link AS a JOIN person_link AS b ON a.root_id = b.root_id
          WHERE b.root_valid_to > {AS_OF} AND b.valid_from <= {AS_OF} AND b.alive = 1 AND b.moved = 0))"""


def _cohort_from() -> str:
    return f"""FROM chosen AS r LEFT JOIN person_link AS l ON l.registration_id = r.registration_id AND {IN_FORCE}
      LEFT JOIN facility AS f ON f.facility_id = l.facility_id LEFT JOIN team AS t ON t.team_id = l.team_id"""


RECENT = f"CASE WHEN r.person_id IN (SELECT person_id FROM encounter WHERE event_date >= {AS_OF} - INTERVAL 12 MONTH) THEN 1 ELSE 0 END"


def _short(extra: str) -> str:
    return f"""SELECT r.cns, coalesce(r.cpf, '') AS cpf, r.name AS nome, coalesce(CAST(r.birth_date AS VARCHAR), '') AS data_nascimento,
      {extra}, coalesce(f.facility_name, '') AS unidade_saude, coalesce(f.cnes, '') AS cnes,
      coalesce(r.micro_area, '') AS microarea, {RECENT} AS flag_atendimento_recente,
      CASE WHEN l.link_id IS NULL THEN 0 ELSE 1 END AS flag_vinculo_unidade, {CPF_FLAG} AS flag_cpf_presente"""


ETHNICITY = "coalesce((SELECT ethnicity_name FROM ethnicity AS y WHERE y.ethnicity_id = r.ethnicity_id), '') AS etnia"
COUNTRY = "(SELECT country_name FROM country AS y WHERE y.country_id = r.country_id)"


def indigenous():
    return [_chosen("r.race_id = 5")], f"{_short(ETHNICITY)} {_cohort_from()}"


def foreigners():
    country = f"coalesce({COUNTRY}, '') AS pais_origem"
    return [_chosen("r.nationality_id = 3")], f"{_short(country)}, 1 AS flag_cns_valido {_cohort_from()}"


def foreigners_detail(more: str = ""):
    return [_chosen("r.nationality_id = 3")], f"""SELECT r.cns, r.cpf, r.name AS nome, r.birth_date AS data_nascimento,
      {COUNTRY} AS pais_origem, {COUNTRY} AS pais_nascimento, f.facility_name AS unidade_saude, f.cnes,
      t.ine, t.team_name AS equipe, r.micro_area AS microarea, {RECENT} AS flag_atendimento_recente,
      CASE WHEN EXISTS (SELECT 1 FROM person_link AS x WHERE x.registration_id = r.registration_id AND x.team_id IS NOT NULL
        AND x.valid_from <= {AS_OF} AND x.facility_valid_to > {AS_OF}) THEN 1 ELSE 0 END AS flag_vinculo_equipe,
      {CPF_FLAG} AS flag_cpf_presente, CASE WHEN length(r.cns) = 15 AND {_cns_ok('r.cns')} THEN 1 ELSE 0 END AS flag_cns_valido{more}
      {_cohort_from()}"""


def totals():
    parts, rows = indigenous()
    return parts + [f"listed AS ({rows})"], """SELECT count(*) AS total,
      count(*) FILTER (flag_cpf_presente = 0) AS sem_cpf_presente,
      count(*) FILTER (flag_vinculo_unidade = 0) AS sem_vinculo_unidade,
      count(*) FILTER (flag_atendimento_recente = 0) AS sem_atendimento_recente FROM listed"""


def _newest(condition: str) -> str:
    """Newest registration per live person among those fulfilling the condition."""
    return f"""newest AS (
      SELECT p.person_id, p.name, p.cns, p.cpf, r.* EXCLUDE (person_id, cns, cpf), f.facility_name, t.team_name
      FROM person AS p JOIN registration AS r ON r.person_id = p.person_id
      LEFT JOIN person_link AS l ON l.registration_id = r.registration_id AND {IN_FORCE}
      LEFT JOIN facility AS f ON f.facility_id = l.facility_id LEFT JOIN team AS t ON t.team_id = l.team_id
      WHERE {LIVE} AND {condition}
      QUALIFY row_number() OVER (PARTITION BY p.person_id ORDER BY r.registration_id DESC, l.link_id DESC NULLS LAST) = 1)"""


def homeless():
    return [_newest("r.homeless = 1")], """SELECT person_id AS paciente_id, name AS nome, coalesce(cns, '') AS cns, coalesce(cpf, '') AS cpf,
      coalesce(CAST(birth_date AS VARCHAR), '') AS data_nascimento, facility_name AS unidade_saude, team_name AS no_equipe FROM newest"""


def _disability(column: str):
    labels = {
        "dis_physical": "Física", "dis_cognitive": "Intelectual/Cognitiva", "dis_autism": "TEA",
        "dis_hearing": "Auditiva", "dis_visual": "Visual", "dis_other": "Outra",
    }
    listed = ", ".join(f"CASE WHEN {c} = 1 THEN '{text}' END" for c, text in labels.items())
    active = "r.exit_type_id = 0 AND r.inactive = 0"
    return [_newest(f"{active} AND r.{column} = 1")], f"""SELECT name AS nome, coalesce(cns, '') AS cns, coalesce(cpf, '') AS cpf,
      coalesce(CAST(birth_date AS VARCHAR), '') AS data_nascimento, coalesce(facility_name, '') AS unidade_saude,
      coalesce(team_name, '') AS equipe, {', '.join(labels)}, concat_ws(', ', {listed}) AS tipos_deficiencia FROM newest"""


def disability_physical():
    return _disability("dis_physical")


def disability_cognitive():
    return _disability("dis_cognitive")


def stats():
    linked = f"EXISTS (SELECT 1 FROM person_link AS l WHERE l.registration_id = r.registration_id AND {IN_FORCE})"

    def of(condition):
        return _chosen(condition)[len("chosen AS ("):-1]

    def disabled(column):
        return f"""(SELECT count(*) FROM registration AS r JOIN person AS p ON p.person_id = r.person_id
          WHERE r.exit_type_id = 0 AND r.inactive = 0 AND r.{column} = 1 AND {LIVE} AND {linked})"""

    return [f"foreign_rows AS ({of('r.nationality_id = 3')})", f"indigenous_rows AS ({of('r.race_id = 5')})"], f"""SELECT
      (SELECT count(*) FROM person AS p WHERE {LIVE}) AS total_cidadaos,
      (SELECT count(DISTINCT p.person_id) FROM person AS p JOIN registration AS r ON r.person_id = p.person_id
        WHERE {LIVE} AND r.homeless = 1) AS total_morador_rua,
      (SELECT count(*) FROM foreign_rows) AS total_estrangeiros, (SELECT count(*) FROM indigenous_rows) AS total_indigenas,
      {disabled('dis_physical')} AS total_def_fisica, {disabled('dis_cognitive')} AS total_def_mental"""


# ---- quality ----


def _profiles() -> str:
    return _newest("true").replace("JOIN registration AS r", "LEFT JOIN registration AS r", 1).replace("r.registration_id DESC,", "r.registration_id DESC NULLS LAST,")


MEMBER = """person_id AS paciente_id, coalesce(cns, '') AS cns, coalesce(cpf, '') AS cpf, coalesce(team_name, '') AS no_equipe,
      coalesce(facility_name, '') AS unidade_saude"""


def duplicates():
    return [_profiles()], f"""SELECT 'duplicados' AS tipo, name AS nome, CAST(birth_date AS VARCHAR) AS data_nascimento,
      count(*) OVER (PARTITION BY name, birth_date) AS quantidade, {MEMBER}
      FROM newest WHERE birth_date IS NOT NULL QUALIFY count(*) OVER (PARTITION BY name, birth_date) > 1"""


def newborns():
    return [_profiles()], f"""SELECT 'rn_de' AS tipo, name AS nome, coalesce(CAST(birth_date AS VARCHAR), '') AS data_nascimento,
      CAST(1 AS BIGINT) AS quantidade, {MEMBER}
      FROM newest WHERE upper(name[1:2]) = 'RN' AND regexp_matches(name[3:3], '\\s')"""


def stale():
    return [_newest("true"), f"""old AS (SELECT person_id, max(lmp_date) AS lmp FROM encounter
        WHERE lmp_date <= {AS_OF} - INTERVAL 11 MONTH GROUP BY 1)"""], f"""
      SELECT p.person_id AS paciente_id, CAST(strftime(o.lmp, '%Y%m%d') AS INTEGER) AS dum, strftime(o.lmp, '%Y-%m-%d') AS dum_formatado,
        CAST(ceil(({AS_OF} - CAST(o.lmp AS DATE)) / 30.44) AS INTEGER) AS meses_desde_dum, p.name AS nome, coalesce(p.cns, '') AS cns,
        coalesce(p.cpf, '') AS cpf, n.facility_name AS unidade_saude, n.team_name AS no_equipe
      FROM old AS o JOIN person AS p ON p.person_id = o.person_id LEFT JOIN newest AS n ON n.person_id = p.person_id WHERE {LIVE}"""


def documents():
    return [], f"""SELECT r.registration_id, {CPF_FLAG} AS flag_cpf_presente,
      CASE WHEN trim(coalesce(r.cns, '')) = '' THEN 0 ELSE 1 END AS flag_cns_presente,
      CASE WHEN length(r.cns) = 15 AND {_cns_ok('r.cns')} THEN 1 ELSE 0 END AS flag_cns_valido FROM registration AS r"""


def cns_quality():
    return [], f"""SELECT f.facility_name AS unidade_saude, f.cnes, count(*) FILTER (trim(r.cns) <> '' AND {_cns_ok('r.cns')}) AS validos,
      count(*) FILTER (trim(r.cns) <> '' AND NOT {_cns_ok('r.cns')}) AS invalidos, count(*) FILTER (coalesce(trim(r.cns), '') = '') AS ausentes
      FROM registration AS r LEFT JOIN (SELECT DISTINCT l.registration_id, l.facility_id FROM person_link AS l WHERE {IN_FORCE}) AS k
        ON k.registration_id = r.registration_id
      LEFT JOIN facility AS f ON f.facility_id = k.facility_id GROUP BY k.facility_id, f.facility_name, f.cnes"""


# ---- benefits ----

BENEFIT = f"""enrolled AS (
  SELECT p.person_id, min(b.roll_name) AS nome_bolsa, p.name AS nome_esus, p.cpf, p.cns,
    (SELECT min(r.birth_date) FROM registration AS r WHERE r.person_id = p.person_id) AS birth
  FROM benefit_roll AS b JOIN person AS p ON p.cpf = b.document
  WHERE b.document_type = 'CPF' AND b.cycle = (SELECT max(cycle) FROM benefit_roll) AND {LIVE}
  GROUP BY p.person_id, p.name, p.cpf, p.cns)"""

CURRENT = f"""placed AS (
  SELECT r.person_id, f.facility_name, f.cnes, t.team_name
  FROM registration AS r JOIN person_link AS l ON l.registration_id = r.registration_id AND {IN_FORCE}
  LEFT JOIN facility AS f ON f.facility_id = l.facility_id LEFT JOIN team AS t ON t.team_id = l.team_id
  QUALIFY row_number() OVER (PARTITION BY r.person_id ORDER BY l.valid_from DESC, l.link_id DESC) = 1)"""


def _since(months: int) -> str:
    return f"x.event_date >= {AS_OF} - INTERVAL {months} MONTH"


def _absent(table: str, condition: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {table} AS x WHERE x.person_id = e.person_id AND {condition})"


CHILD = f"e.birth >= {AS_OF} - INTERVAL 7 YEAR"
CONDITIONS = f"""conditions AS (
  SELECT e.person_id, e.nome_bolsa, e.nome_esus, coalesce(e.cpf, '') AS cpf, coalesce(e.cns, '') AS cns, e.birth AS dt_nascimento,
    k.facility_name AS no_unidade_saude, k.cnes AS nu_cnes, k.team_name AS no_equipe,
    CASE WHEN {_absent('encounter', _since(6))} THEN 1 ELSE 0 END AS pendencia_consulta,
    CASE WHEN {CHILD} AND {_absent('vaccination', _since(12))} THEN 1 ELSE 0 END AS pendencia_vacina,
    CASE WHEN {CHILD} AND {_absent('encounter', _since(12) + ' AND x.weight > 0 AND x.height > 0')} THEN 1 ELSE 0 END AS pendencia_peso_altura,
    CASE WHEN EXISTS (SELECT 1 FROM pregnancy AS g WHERE g.person_id = e.person_id AND coalesce(g.puerperium_end, {AS_OF}) >= {AS_OF})
      AND {_absent('encounter', _since(3) + ' AND x.occupation_id < 2')} THEN 1 ELSE 0 END AS pendencia_prenatal
  FROM enrolled AS e LEFT JOIN placed AS k ON k.person_id = e.person_id)"""


def conditions():
    return [BENEFIT, CURRENT, CONDITIONS], "SELECT * FROM conditions"


def page():
    return [BENEFIT, CURRENT, CONDITIONS], "SELECT * FROM conditions WHERE person_id > 100 ORDER BY person_id LIMIT 500"


def benefit_totals():
    kinds = ["pendencia_consulta", "pendencia_vacina", "pendencia_peso_altura", "pendencia_prenatal"]
    sums = ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in kinds)
    return [BENEFIT, CURRENT, CONDITIONS], f"""SELECT count(*) AS total, {sums}, CAST(sum({' + '.join(kinds)}) AS BIGINT) AS total_pendencias,
      greatest(1, (count(*) + 499) // 500) AS total_paginas FROM conditions"""


PEOPLE = {
    "ref_facilities": facilities, "ref_active_teams": active_teams, "linked_population": linked_population,
    "cohort_indigenous": indigenous, "cohort_foreigners": foreigners, "cohort_foreigners_detail": foreigners_detail,
    "cohort_totals": totals, "cohort_homeless": homeless, "cohort_disability_physical": disability_physical,
    "cohort_disability_cognitive": disability_cognitive, "population_stats": stats,
    "quality_duplicates": duplicates, "quality_newborn_names": newborns, "quality_stale_pregnancies": stale,
    "quality_document_flags": documents, "quality_cns": cns_quality,
    "benefit_conditions": conditions, "benefit_page": page, "benefit_totals": benefit_totals,
}
