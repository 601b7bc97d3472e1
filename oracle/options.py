"""Checks of person-level practices, of options, and of the list tools."""

from __future__ import annotations

from oracle.base import END, LINKED, PERIOD, TEAM
from oracle.indicators import PRACTICE_PARTS, b3, b4, c1, c3, c4, c5, c6, c7, m2
from oracle.people import cns_quality, conditions, facilities, foreigners, homeless
from oracle.worklists import CONTACT, o_c1


def _practices(name: str):
    parts_of, letters = PRACTICE_PARTS[name]
    columns = ", ".join(f"pratica_{x}" for x in letters)
    # the lowest id of the teams that share both names
    team = """(SELECT min(t.team_id) FROM team AS t WHERE t.team_name IS NOT DISTINCT FROM m.no_equipe
      AND t.ine IS NOT DISTINCT FROM m.nu_ine)"""
    return parts_of(), f"SELECT person_id, {team} AS team_id, {columns} FROM marked AS m"


def integer_gap():
    parts, select = c4()
    gap = "max(x.event_date) - min(x.event_date) >= 30"
    number = "CAST(strftime({}(x.event_date), '%Y%m%d') AS INTEGER)"
    return [p.replace(gap, f"{number.format('max')} - {number.format('min')} >= 30") for p in parts], select


def strict():
    parts, select = cns_quality()
    return parts, select.replace("% 11 <> 1", "% 11 = 0")


def by_person():
    return [LINKED], f"""SELECT DISTINCT {TEAM}, {CONTACT} FROM linked AS i WHERE NOT EXISTS (
      SELECT 1 FROM dental_procedure AS d JOIN facility AS f ON f.facility_id = d.facility_id
      WHERE d.person_id = i.person_id AND f.facility_id < 20 AND d.occupation_id = 5 AND d.event_date {PERIOD})"""


def one_team():
    parts, select = o_c1()
    return parts, f"SELECT * FROM ({select}) AS q WHERE unidade_saude ILIKE '%nation_0%' AND no_equipe = 'Supplier#000000000'"


def unit_page():
    parts, select = conditions()
    return parts, f"""SELECT * FROM ({select}) AS q WHERE no_unidade_saude LIKE 'NATION\\_1%' ESCAPE '\\'
      ORDER BY person_id LIMIT 50"""


def numbered_page(size: int, skipped: int, unit: str = "true"):
    parts, select = conditions()
    return parts, f"SELECT * FROM ({select}) AS q WHERE {unit} ORDER BY person_id LIMIT {size} OFFSET {skipped}"


NATION_1 = "no_unidade_saude LIKE 'NATION\\_1%' ESCAPE '\\'"


def unit_totals():
    parts, select = conditions()
    kinds = ("pendencia_consulta", "pendencia_vacina", "pendencia_peso_altura", "pendencia_prenatal")
    sums = ", ".join(f"CAST(coalesce(sum({k}), 0) AS BIGINT) AS {k}" for k in kinds)
    return parts, f"""SELECT count(*) AS total, {sums}, CAST(coalesce(sum({' + '.join(kinds)}), 0) AS BIGINT) AS total_pendencias,
      greatest(1, (count(*) + 499) // 500) AS total_paginas FROM ({select}) AS q WHERE {NATION_1}"""


def unit_filter():
    parts, select = c1()
    return parts, f"SELECT * FROM ({select}) AS q WHERE cnes LIKE '%000001%'"


def search():
    parts, select = foreigners()
    named = " OR ".join(f"{c} ILIKE '%rn c%'" for c in ("nome", "unidade_saude", "pais_origem"))
    return parts, f"SELECT * FROM ({select}) AS q WHERE {named}"


def search_benefits():
    parts, select = conditions()
    named = " OR ".join(f"coalesce({c}, '') ILIKE '%00001%'" for c in ("nome_esus", "cpf", "cns"))
    return parts, f"SELECT * FROM ({select}) AS q WHERE {named}"


def masked():
    parts, select = homeless()

    def stars(column):
        return f"repeat('*', greatest(length({column}) - 3, 0)) || right({column}, 3) AS {column}"

    initials = "array_to_string(list_transform(string_split_regex(coalesce(nome, ''), '\\s+'), lambda w: w[1:1]), '.') AS nome"
    return parts, f"SELECT * EXCLUDE (cns, cpf, nome), {stars('cns')}, {stars('cpf')}, {initials} FROM ({select}) AS q"


def _service(make, names: dict, unit: str = "true"):
    parts, select = make()
    renamed = ", ".join(f"{ours} AS {theirs}" for ours, theirs in names.items())
    return parts, f"SELECT * RENAME ({renamed}) FROM ({select}) AS q WHERE {unit}"


def service_c7():
    parts, select = c7()
    return parts, f"SELECT * EXCLUDE (numerator, denominator) RENAME (value AS percentual) FROM ({select}) AS q"


def _places(make, *columns, descending=False):
    """Places in a list: missing values last, or as empty text where the list is sorted by one text."""
    parts, select = make()
    order = f"coalesce({columns[0]}, '') DESC" if descending else ", ".join(f"{c} ASC NULLS LAST" for c in columns)
    return parts, f"SELECT {', '.join(columns)}, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS posicao FROM ({select}) AS q"


def as_json():
    parts, select = facilities()
    return parts, f"""SELECT '{{"id":' || id || ',"nome":"' || nome || '","cnes":"' || cnes || '"}}' AS json FROM ({select}) AS q"""


ENDS = ("2000-08-31", "2000-12-31", "2001-03-15", "2001-07-31")


def series_yearly():
    """C4, C5 and C6 once for each end of a period."""
    each = []
    for end in ENDS:
        for name, make in (("c4", c4), ("c5", c5), ("c6", c6)):
            parts, select = make()
            text = f"WITH {', '.join(parts)} {select}".replace(END, f"DATE '{end}'")
            each.append(f"SELECT DATE '{end}' AS fim, '{name}' AS indicador, {TEAM}, numerator, denominator, value, classificacao FROM ({text}) AS q")
    return [], " UNION ALL ".join(each)


def series_population():
    """Linked people of each team at 24 month ends."""
    return [f"""days AS (SELECT CAST(last_day(d) AS DATE) AS dia FROM generate_series(DATE '1999-08-01', DATE '2001-07-01', INTERVAL 1 MONTH) AS g(d))"""], f"""
      SELECT dia, unidade_saude, cnes, no_equipe, nu_ine, count(DISTINCT person_id) AS pessoas FROM (
        SELECT d.dia, p.person_id, f.facility_name AS unidade_saude, f.cnes, t.team_name AS no_equipe, t.ine AS nu_ine, t.team_id IS NULL AS unknown
        FROM days AS d JOIN person_link AS l ON l.valid_from <= d.dia AND l.facility_valid_to > d.dia AND l.facility_id < 20
        JOIN registration AS r ON r.registration_id = l.registration_id JOIN person AS p ON p.person_id = r.person_id
        JOIN facility AS f ON f.facility_id = l.facility_id LEFT JOIN team AS t ON t.team_id = l.team_id
        WHERE p.deceased = 0 AND (p.deleted IS NULL OR p.deleted = 0)) AS q
      GROUP BY dia, unidade_saude, cnes, no_equipe, nu_ine, unknown"""


OPTIONS = {
    "series_yearly": series_yearly, "series_population": series_population,
    **{f"practice_flags_{name}": (lambda name=name: _practices(name)) for name in PRACTICE_PARTS},
    "ind_c4_integer_gap": integer_gap, "quality_cns_strict": strict, "outreach_b1_by_person": by_person,
    "outreach_c1_team": one_team, "benefit_page_unit": unit_page,
    "benefit_page_number": lambda: numbered_page(20, 40), "benefit_page_number_unit": lambda: numbered_page(5, 5, NATION_1),
    "benefit_totals_unit": unit_totals, "benefit_list": conditions, "list_unit_filter": unit_filter,
    "list_search": search, "search_foreigners": search, "search_benefits": search_benefits, "list_sorted": homeless, "list_ordered": b3, "list_masked": masked,
    "list_json": as_json, "ind_c1_period": c1, "lake_b4": b4,
    "list_sorted_places": lambda: _places(homeless, "unidade_saude", descending=True),
    "list_ordered_places": lambda: _places(b3, "unidade_saude", "no_equipe"),
    "service_m2_places": lambda: _places(m2, "unidade_saude", "no_equipe"),
    "service_b4": lambda: _service(b4, {
        "numerator": "total_participantes", "denominator": "total_criancas", "value": "percentual",
        "atividades": "total_atividades",
    }),
    "service_c3": lambda: _service(c3, {"numerator": "soma_pontos", "denominator": "total_gestacoes", "value": "percentual"}),
    "service_c7": service_c7,
    "service_m2": lambda: _service(m2, {
        "numerator": "total_acoes", "denominator": "pessoas_atendidas", "value": "media_acoes_por_pessoa",
    }),
    "service_c1_unit": lambda: _service(c1, {
        "numerator": "programada", "denominator": "total_atendimentos", "value": "perc_programada",
    }, "unidade_saude ILIKE '%nation$_1%' ESCAPE '$'"),
}
