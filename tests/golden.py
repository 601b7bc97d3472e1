"""Hand-made canonical tables: name only the columns a test is about."""

from __future__ import annotations

from datetime import date, timedelta

import pyarrow as pa

from carespan.codes import OPEN_END
from carespan.setting import Period, Setting
from carespan.sources.derived import LITERALS, SETTING
from carespan.sources.schemas import COLUMNS
from carespan.sources.tables import Tables
from tests.random_tables import ARROW

AS_OF = date(2024, 7, 1)
S = Setting(
    period=Period(date(2023, 7, 1), date(2024, 6, 30)), as_of=AS_OF, scope=(1,), codes=SETTING.codes,
)
MN, AGENT, DENTIST = 0, 3, 5
BIRTH = date(2023, 1, 10)

DEFAULTS = {
    "person": {"name": "ANA", "sex_id": 2, "deceased": 0},
    "registration": {"exit_type_id": 0, "inactive": 0, "homeless": 0, "birth_date": date(1980, 1, 1)},
    "person_link": {
        "facility_id": 1, "team_id": 1, "valid_from": date(2020, 1, 1), "facility_valid_to": OPEN_END,
        "root_valid_to": OPEN_END, "alive": 1, "moved": 0,
    },
    "encounter": {"facility_id": 1, "team_id": 1, "occupation_id": MN, "visit_type_id": 1},
    "home_visit": {"occupation_id": AGENT, "newborn_followup": 1},
    "dental_procedure": {"facility_id": 1, "team_id": 1, "occupation_id": DENTIST},
}


def make(spark, **given) -> Tables:
    """Tables with the given rows (dictionaries); the code tables are always there."""
    rows = {name: given.get(name, []) for name in COLUMNS}
    for name, texts in LITERALS.items():
        key, text = COLUMNS[name]
        rows[name] = [{key: i, text: t} for i, t in enumerate(texts)]
    rows["facility"] = given.get("facility") or [{"facility_id": 1, "facility_name": "UBS", "cnes": "0001"}]
    rows["team"] = given.get("team") or [{"team_id": 1, "team_name": "A", "ine": "01"}]

    def opener(name):
        filled = [{**DEFAULTS.get(name, {}), **row} for row in rows[name]]
        types = pa.schema([(c, ARROW[t]) for c, t in COLUMNS[name].items()])
        data = {c: pa.array([row.get(c) for row in filled], types.field(c).type) for c in types.names}
        return lambda: spark.createDataFrame(pa.table(data, schema=types))

    return Tables({name: opener(name) for name in COLUMNS})


def linked(*people: dict) -> dict:
    """person, registration and person_link rows: one of each per person id."""
    return {
        "person": [{k: v for k, v in p.items() if k in COLUMNS["person"]} for p in people],
        "registration": [
            {"registration_id": p["person_id"], "person_id": p["person_id"],
             **{k: v for k, v in p.items() if k in COLUMNS["registration"]}} for p in people
        ],
        "person_link": [
            {"link_id": p["person_id"], "registration_id": p["person_id"], "root_id": p["person_id"],
             **{k: v for k, v in p.items() if k in COLUMNS["person_link"]}} for p in people
        ],
    }


def day(n: int, start: date = BIRTH) -> date:
    return start + timedelta(days=n)


def flags(df, letters: str, key: str = "person_id") -> dict:
    """Key -> letters of the practices done."""
    return {r[key]: "".join(x for x in letters if r[f"pratica_{x}"]) for r in df.collect()}
