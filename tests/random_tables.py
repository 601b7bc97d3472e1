"""Small random canonical tables full of awkward cases, written as one Parquet file per table.

Repeated names of teams and facilities, ids without a dimension row, people with several
registrations and birth dates, missing people on events, overlapping pregnancies, several events on a
day, and one person holding a third of all events.
"""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from carespan.sources.derived import AS_OF, LITERALS
from carespan.sources.schemas import COLUMNS

ARROW = {
    "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "date": pa.date32(),
    "double": pa.float64(),
}


class Maker:
    def __init__(self, seed: int, people: int):
        self.rng = np.random.default_rng(seed)
        self.people = people

    def pick(self, n, values, p=None):
        values = list(values)
        return [values[i] for i in self.rng.choice(len(values), n, p=p)]

    def days(self, n, furthest=760, nearest=-10, missing=0.0):
        back = self.rng.integers(nearest, furthest, n)
        return [None if self.rng.random() < missing else AS_OF - timedelta(days=int(b)) for b in back]

    def owners(self, n):
        """People on events: one of them on a third of the rows, some missing, some unknown."""
        ids = self.rng.integers(0, self.people + 3, n)
        ids[self.rng.random(n) < 0.33] = 7
        return [None if self.rng.random() < 0.01 else int(i) for i in ids]

    def units(self, n):
        return {
            "facility_id": self.pick(n, range(27)),
            "team_id": [None if self.rng.random() < 0.02 else int(t) for t in self.rng.integers(0, 13, n)],
        }

    def measures(self, n):
        def some(value, share):
            return [value if self.rng.random() < share else None for _ in range(n)]

        return {"weight": some(70.5, 0.5), "height": some(1.7, 0.6)}, some


def build(seed: int, people: int = 160, events: int = 6000) -> dict[str, dict]:
    make = Maker(seed, people)
    rng, pick = make.rng, make.pick
    tables: dict[str, dict] = {}
    for name, texts in LITERALS.items():
        key, text = COLUMNS[name]
        tables[name] = {key: list(range(len(texts))), text: texts}
    names = [f"UBS {i // 2}" for i in range(25)]
    tables["facility"] = {
        "facility_id": list(range(25)), "facility_name": names,
        "cnes": [f"{i // 2 if i < 10 else i:07d}" for i in range(25)],
    }
    tables["team"] = {
        "team_id": list(range(12)),
        "team_name": ["A", "A", "B", "B", "SEM EQUIPE", "", "C", "D", "E", "F", None, "G"],
        "ine": ["1", "1", "2", "3", "4", "5", "-", "-", "6", None, "8", "9"],
    }
    tables["ethnicity"] = {"ethnicity_id": list(range(4)), "ethnicity_name": list("WXYZ")}
    tables["country"] = {"country_id": list(range(4)), "country_name": list("KLMN")}
    ids = list(range(people))
    documents = [None, "", "000000000000000", "700000000000005", "70000000000001", "300000000000001", "898001160651234"]
    cns = [d if d is not None and rng.random() < 0.5 else f"{700000000000005 + 11 * i}" for i, d in zip(ids, pick(people, documents))]
    cpf = [pick(1, [None, "", "00000000000", f"{i:011d}"], [0.1, 0.05, 0.1, 0.75])[0] for i in ids]
    tables["person"] = {
        "person_id": ids, "name": pick(people, ["RN ANA", "rn\tbia", "RNA", "EVA", "IVO", "LIA", None]),
        "cns": cns, "cpf": cpf, "sex_id": pick(people, [1, 2, 2]), "deceased": pick(people, [0, 0, 0, 1]),
        "deleted": pick(people, [0, None, None, 1]),
    }
    owners = ids + pick(people, ids + [people + 1])
    n = len(owners)
    births = [
        AS_OF - timedelta(days=int(d))
        for d in np.where(rng.random(n) < 0.4, rng.integers(0, 800, n), rng.integers(0, 30000, n))
    ]
    births = [None if rng.random() < 0.05 else (date(2000, 2, 29) if rng.random() < 0.1 else b) for b in births]
    flags = [c for c in COLUMNS["registration"] if c.startswith("dis_")]
    tables["registration"] = {
        "registration_id": list(range(n)), "person_id": owners, "cns": pick(n, documents),
        "cpf": pick(n, [None, "", "0000", "11111111111"]), "birth_date": births,
        "race_id": pick(n, [1, 5]), "nationality_id": pick(n, [1, 3]),
        "ethnicity_id": pick(n, [0, 1, 9, None]), "country_id": pick(n, [0, 1, 9, None]),
        "exit_type_id": pick(n, [0, 0, 0, 1]), "inactive": pick(n, [0, 0, 0, 1]), "homeless": pick(n, [0, 1]),
        **{f: pick(n, [0, 1, None]) for f in flags}, "micro_area": pick(n, ["01", "02", None]),
    }
    m = 2 * n
    tables["person_link"] = {
        "link_id": list(range(m)), "registration_id": pick(m, range(n)), "root_id": pick(m, range(people)),
        **make.units(m), "valid_from": make.days(m, 400, -3),
        "facility_valid_to": pick(m, [AS_OF, AS_OF + timedelta(days=1), date(3000, 12, 31), date(3000, 12, 31)]),
        "root_valid_to": pick(m, [AS_OF, date(3000, 12, 31)]), "alive": pick(m, [1, 1, 0]), "moved": pick(m, [0, 0, 1]),
    }
    e = events
    measured, some = make.measures(e)
    tables["encounter"] = {
        "encounter_id": list(range(e)), "person_id": make.owners(e), "event_date": make.days(e),
        "occupation_id": pick(e, [*range(10), 99]), "visit_type_id": pick(e, range(1, 10)), **make.units(e),
        **measured, "systolic": some(120, 0.3), "diastolic": some(80, 0.3),
        "icd_codes": pick(e, ["|E11|", "|I10|", "|Z30|", "|J00|E14|", "|J00|", None], [0.02, 0.02, 0.02, 0.02, 0.9, 0.02]),
        "icpc_codes": pick(e, ["|T90|", "|K86|", "|W11|", "|R74|", None], [0.02, 0.02, 0.02, 0.9, 0.04]),
        "lmp_date": [
            d if rng.random() < 0.1 else (date(3000, 12, 31) if rng.random() < 0.1 else None) for d in make.days(e, 900, 0)
        ],
    }
    measured, some = make.measures(e)
    tables["home_visit"] = {
        "person_id": make.owners(e), "event_date": make.days(e),
        "occupation_id": pick(e, [0, 2, 3, 4, 5, 99]), "newborn_followup": pick(e, [0, 1, None]),
        "child_followup": pick(e, [0, 1, None]), **measured, "blood_pressure": some("120/80", 0.3),
    }
    codes = ["09", "17", "29", "22", "24", "56", "26", "59", "107", "57", "33", "77", "67", "93", "1"]
    tables["vaccination"] = {
        "person_id": make.owners(e), "event_date": make.days(e),
        "vaccine_codes": ["|" + "|".join(pick(int(k), codes)) + "|" for k in rng.integers(1, 4, e)],
    }
    g = people
    starts = make.days(g, 700, 0)
    gaps = rng.integers(200, 300, g)
    ends = rng.integers(0, 60, g)
    after = [s + timedelta(days=int(k)) if rng.random() < 0.7 else None for s, k in zip(starts, gaps)]
    tables["pregnancy"] = {
        "person_id": [int(i) for i in rng.integers(0, people, g)], "pregnancy_no": list(range(g)), "start_date": starts,
        "puerperium_start": after,
        "puerperium_end": [a + timedelta(days=int(k)) if a and rng.random() < 0.6 else None for a, k in zip(after, ends)],
    }
    tables["procedure_event"] = {
        "person_id": make.owners(e), "event_date": make.days(e, 1200),
        "procedure_id": pick(e, [*range(26), 99]),
    }
    tables["dental_procedure"] = {
        "person_id": make.owners(e), "event_date": make.days(e), **make.units(e),
        "occupation_id": pick(e, [5, 6, 7, 1]), "procedure_id": pick(e, [*range(26), 99]),
    }
    tables["dental_encounter"] = {
        "person_id": make.owners(e), "event_date": make.days(e), **make.units(e),
        "occupation_id": pick(e, [5, 6, 7, 1]), "treatment_completed": pick(e, [0, 0, 0, 0, 0, 0, 0, 0, 0, 1, None]),
    }
    tables["group_activity"] = {
        "activity_id": list(range(e)), "event_date": make.days(e), "practice_id": pick(e, range(7, 11)),
        "participants": pick(e, [None, 0, 5, 9, 14]), **make.units(e), "occupation_id": pick(e, [5, 6, 7]),
    }
    b = 2 * people
    tables["benefit_roll"] = {
        "document": pick(b, [c for c in cpf if c is not None]),
        "document_type": pick(b, ["CPF", "CPF", "NIS"]), "roll_name": pick(b, ["X", "Y", "Z"]),
        "cycle": pick(b, [date(2001, 6, 1), date(2001, 7, 1)]),
    }
    return tables


def write(tables: dict[str, dict], folder: str) -> None:
    for name, columns in COLUMNS.items():
        schema = pa.schema([(c, ARROW[t]) for c, t in columns.items()])
        frame = {c: pa.array(tables[name][c], schema.field(c).type) for c in columns}
        pq.write_table(pa.table(frame, schema=schema), f"{folder}/{name}.parquet")
