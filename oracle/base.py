"""Building blocks of the DuckDB checks.

The checks are written apart from the library: they name the fixture's own procedure and occupation
ids (FIXTURES.md) instead of the code lists, and test each practice with a correlated EXISTS or count
per person instead of stacked aggregates.
"""

from __future__ import annotations

import re

from carespan.sources.derived import view_sql
from carespan.sources.schemas import COLUMNS

AS_OF = "DATE '2001-08-01'"
START = "DATE '2000-08-01'"
END = "DATE '2001-07-31'"
PERIOD = f"BETWEEN {START} AND {END}"

TEAM = "unidade_saude, cnes, no_equipe, nu_ine"

# Facility ids 0 to 19 are in scope.
LINKED = f"""linked AS (
  SELECT p.person_id, p.name, p.cns, p.cpf, p.sex_id, r.registration_id, r.birth_date, l.facility_id,
    l.team_id, f.facility_name AS unidade_saude, f.cnes, t.team_name AS no_equipe, t.ine AS nu_ine,
    t.team_id AS known_team
  FROM person_link AS l
  JOIN registration AS r ON r.registration_id = l.registration_id
  JOIN person AS p ON p.person_id = r.person_id
  JOIN facility AS f ON f.facility_id = l.facility_id
  LEFT JOIN team AS t ON t.team_id = l.team_id
  WHERE l.facility_id < 20 AND l.valid_from <= {AS_OF} AND l.facility_valid_to > {AS_OF}
    AND p.deceased = 0 AND (p.deleted IS NULL OR p.deleted = 0))"""


def half_up(num: str, den: str, scale: int = 100) -> str:
    """scale * num / den to two places, ties up, in whole numbers."""
    num, den = f"CAST({num} AS BIGINT)", f"CAST(nullif({den}, 0) AS BIGINT)"
    return f"(CAST(({200 * scale} * {num} + {den}) // (2 * {den}) AS DOUBLE) / 100)"


STANDARD = "CASE WHEN value > 75 THEN 'Ótimo' WHEN value > 50 THEN 'Bom' WHEN value > 25 THEN 'Suficiente' WHEN value IS NULL THEN 'Sem dados' ELSE 'Regular' END"
ACCESS = "CASE WHEN value IS NULL THEN 'Sem dados' WHEN value < 10 OR value > 70 THEN 'Regular' WHEN value < 30 THEN 'Suficiente' WHEN value < 50 THEN 'Bom' ELSE 'Ótimo' END"
CONTACTS = "CASE WHEN value IS NULL THEN 'Sem dados' WHEN value < 1 THEN 'Regular' WHEN value < 2 THEN 'Suficiente' WHEN value <= 3 THEN 'Bom' ELSE 'Ótimo' END"


def above(great, good, enough) -> str:
    return (
        f"CASE WHEN value > {great} THEN 'Ótimo' WHEN value > {good} THEN 'Bom'"
        f" WHEN value > {enough} THEN 'Suficiente' WHEN value IS NULL THEN 'Sem dados' ELSE 'Regular' END"
    )


def inside(great, good, enough) -> str:
    return (
        f"CASE WHEN value IS NULL THEN 'Sem dados' WHEN {great} THEN 'Ótimo' WHEN {good} THEN 'Bom'"
        f" WHEN {enough} THEN 'Suficiente' ELSE 'Regular' END"
    )


def complete(parts: list[str], select: str, view=view_sql) -> str:
    """A full query: the views of the tables it names, its own parts, then its SELECT."""
    body = " ".join(parts) + " " + select
    needed = [t for t in COLUMNS if re.search(rf"\b(FROM|JOIN) {t}\b", body)]
    views = [f"{t} AS ({view(t)})" for t in needed]
    return "WITH " + ",\n".join(views + parts) + "\n" + select
