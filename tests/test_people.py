"""Links, one row per person, duplicates, quality and benefits on hand-made rows."""

from datetime import date, timedelta

import pytest

from carespan.codes import OPEN_END
from carespan.operators import benefits, cohorts, outreach, population, quality, ratio_indicators, rollups
from tests.golden import AS_OF, S, linked, make


def test_links_in_force(spark):
    one = timedelta(days=1)
    T = make(spark, person_link=[
        {"link_id": 1, "facility_valid_to": AS_OF}, {"link_id": 2, "facility_valid_to": AS_OF + one},
        {"link_id": 3, "valid_from": AS_OF}, {"link_id": 4, "valid_from": AS_OF + one},
        {"link_id": 5, "facility_valid_to": OPEN_END},
    ])
    assert sorted(r["link_id"] for r in population.valid_links(T, AS_OF).collect()) == [2, 3, 5]


def test_live_people(spark):
    T = make(spark, person=[
        {"person_id": 1, "deleted": None}, {"person_id": 2, "deleted": 0}, {"person_id": 3, "deleted": 1},
        {"person_id": 4, "deceased": 1},
    ])
    assert sorted(r["person_id"] for r in population.live_persons(T).collect()) == [1, 2]


def test_root_of_another_registration_counts(spark):
    people = linked({"person_id": 1, "race_id": 5, "moved": 1}, {"person_id": 2, "race_id": 1})
    T = make(spark, **people)
    assert cohorts.indigenous_cohort(T, S).count() == 0
    people["person_link"][1]["root_id"] = 1
    assert cohorts.indigenous_cohort(make(spark, **people), S).count() == 1


def test_newest_registration_wins(spark):
    people = linked({"person_id": 1, "homeless": 1, "birth_date": date(1970, 1, 1)})
    people["registration"].append({"registration_id": 8, "person_id": 1, "homeless": 1, "birth_date": date(1971, 1, 1)})
    people["registration"].append({"registration_id": 9, "person_id": 1, "homeless": 0, "birth_date": date(1972, 1, 1)})
    rows = cohorts.homeless_cohort(make(spark, **people), S).collect()
    assert [(r["data_nascimento"], r["unidade_saude"]) for r in rows] == [("1971-01-01", None)]


def test_disability_labels_and_kind(spark):
    T = make(spark, **linked({"person_id": 1, "dis_physical": 1, "dis_visual": 1, "dis_other": 0}))
    row = cohorts.disability_cohort(T, S, "fisica").collect()[0]
    assert row["tipos_deficiencia"] == ["Física", "Visual"]
    with pytest.raises(ValueError):
        cohorts.disability_cohort(T, S, "outra")


def same_name(*births):
    return linked(*[{"person_id": i, "birth_date": b, "name": "EVA", "cns": f"C{i}"} for i, b in enumerate(births)])


def test_duplicates(spark):
    d = date(1980, 1, 1)
    T = make(spark, **same_name(d, date(1981, 1, 1), d, None, None))
    rows = quality.duplicate_persons(T, S).collect()
    assert sorted((r["quantidade"], r["paciente_id"], r["cns"]) for r in rows) == [(2, 0, "C0"), (2, 2, "C2")]


def test_large_groups_have_the_shape_of_small_ones(spark):
    T = make(spark, **same_name(*[date(1980, 1, 1)] * 1200, *[date(1990, 1, 1)] * 2))
    rows = quality.duplicate_persons(T, S)
    assert rows.columns == ["tipo", "nome", "data_nascimento", "quantidade", "paciente_id", "cns", "cpf", "no_equipe", "unidade_saude"]
    found = rows.groupBy("data_nascimento", "quantidade").count().collect()
    assert sorted(map(tuple, found)) == [("1980-01-01", 1200, 1200), ("1990-01-01", 2, 2)]


def test_newborn_names(spark):
    names = ["RN MARIA", "rn maria", "RNA", "RN\tANA", "MARIA RN "]
    T = make(spark, **linked(*[{"person_id": i, "name": n} for i, n in enumerate(names)]))
    assert sorted(r["paciente_id"] for r in quality.newborn_placeholder_names(T, S).collect()) == [0, 1, 3]


def test_stale_pregnancies(spark):
    rows = {1: [date(2023, 8, 1)], 2: [date(2023, 8, 2)], 3: [date(2023, 1, 1), date(2024, 6, 1)], 4: [OPEN_END]}
    T = make(
        spark, **linked(*[{"person_id": i} for i in rows]),
        encounter=[{"person_id": i, "event_date": AS_OF, "lmp_date": d} for i, days in rows.items() for d in days],
    )
    got = {r["paciente_id"]: (r["dum"], r["meses_desde_dum"]) for r in quality.stale_pregnancies(T, S).collect()}
    # eleven months to the day counts (335 days, over 11 x 30.44); a newer date does not cancel an old one
    assert got == {1: (20230801, 12), 3: (20230101, 18)}


def test_benefit_conditions(spark):
    people = linked(
        {"person_id": 1, "cpf": "11", "birth_date": date(2017, 7, 1)},
        {"person_id": 2, "cpf": "22", "birth_date": date(2017, 6, 30)},
        {"person_id": 3, "cpf": "33"}, {"person_id": 4, "cpf": "44"},
    )
    roll = [
        {"document": c, "document_type": "CPF", "roll_name": "X", "cycle": date(2024, 6, 1)} for c in ("11", "22", "33")
    ] + [{"document": "44", "document_type": "CPF", "roll_name": "X", "cycle": date(2024, 5, 1)}]
    T = make(
        spark, **people, benefit_roll=roll,
        pregnancy=[{"person_id": 3, "start_date": date(2023, 10, 1), "puerperium_end": AS_OF}],
        encounter=[{"person_id": 1, "event_date": date(2024, 1, 1)}, {"person_id": 2, "event_date": date(2023, 12, 31)}],
    )
    rows = benefits.benefit_conditions(T, S)
    got = {r["person_id"]: tuple(r[p] for p in benefits.PENDING) for r in rows.collect()}
    assert got == {1: (0, 1, 1, 0), 2: (1, 0, 0, 0), 3: (1, 0, 0, 1)}
    totals = benefits.benefit_totals(rows, page_size=2).collect()[0]
    assert (totals["total"], totals["total_pendencias"], totals["total_paginas"]) == (3, 5, 2)
    pages = [[r["person_id"] for r in benefits.benefit_page(T, S, after, 2).collect()] for after in (0, 2, 3)]
    assert pages == [[1, 2], [3], []]
    assert benefits.benefit_totals(rows.limit(0)).collect()[0]["total_paginas"] == 1


@pytest.mark.parametrize("scheduled, total, expected", [
    (1, 20, [("Ótimo", 18), ("Bom", 8)]),
    (4, 20, [("Ótimo", 12), ("Bom", 3)]),
    (8, 20, [("Ótimo", 4)]),
    (12, 20, [("Ótimo (já atingido)", 0)]),
    (21, 29, [("Ótimo", 1)]),
])
def test_access_gap(spark, scheduled, total, expected):
    T = make(
        spark, **linked({"person_id": 1}),
        encounter=[
            {"person_id": 1, "event_date": date(2024, 1, 1), "visit_type_id": 2 if i < scheduled else 1} for i in range(total)
        ],
    )
    assert [(r["nivel"], r["faltam"]) for r in outreach.access_gap(T, S).collect()] == expected


def test_person_treated_elsewhere(spark):
    units = [{"facility_id": 1, "facility_name": "UBS", "cnes": "1"}, {"facility_id": 2, "facility_name": "CEO", "cnes": "2"}]
    s = S.but(scope=(1, 2))
    T = make(
        spark, **linked({"person_id": 1}), facility=units,
        dental_procedure=[{"person_id": 1, "facility_id": 2, "event_date": date(2024, 1, 1), "procedure_id": 2}],
    )
    assert outreach.outreach_b1(T, s).count() == 1 and outreach.outreach_b1(T, s, by="person").count() == 0


def test_team_filter_works_on_every_list(spark):
    T = make(spark, **linked({"person_id": 1, "birth_date": date(1950, 1, 1)}))
    assert outreach.outreach_list("c6", T, S, unit="ub", team="A").count() == 1
    assert outreach.outreach_list("c6", T, S, unit="ub", team="B").count() == 0


def test_numerator_and_outreach_are_apart(spark):
    T = make(
        spark, **linked({"person_id": 1, "birth_date": date(1950, 1, 1)}, {"person_id": 2, "birth_date": date(1950, 1, 1)}),
        encounter=[{"person_id": 1, "event_date": date(2024, 1, 1)}],
    )
    assert [r["paciente_id"] for r in outreach.OUTREACH["c6"](T, S).collect()] == [2]


def test_city_mean_is_unweighted(spark):
    units = [{"facility_id": 1, "facility_name": "X", "cnes": "1"}, {"facility_id": 2, "facility_name": "Y", "cnes": "2"}]
    seen = [(1, 2)] * 9 + [(1, 1)] + [(2, 1)]  # 90 % of ten, and 0 % of one
    T = make(
        spark, **linked({"person_id": 1}), facility=units,
        encounter=[{"person_id": 1, "event_date": date(2024, 1, 1), "facility_id": f, "visit_type_id": v} for f, v in seen],
    )
    s = S.but(scope=(1, 2))
    city = [r for r in rollups.city_summary(T, s).collect() if r["nivel"] == "municipio" and r["indicador"] == "c1"][0]
    assert (city["value"], city["numerator"], city["denominator"], city["classificacao"]) == (45.0, 9, 11, "Bom")
    teams = ratio_indicators.indicator_c1(T, s)
    assert sum(r["denominator"] for r in rollups.rollup_units(teams).collect()) == 11


def test_scope_of_all_facilities(spark):
    units = [{"facility_id": i, "facility_name": f"U{i}", "cnes": str(i)} for i in (1, 2)]
    T = make(
        spark, **linked({"person_id": 1}), facility=units,
        encounter=[{"person_id": 1, "event_date": date(2024, 1, 1), "facility_id": i} for i in (1, 2, 3, None)],
    )

    def seen(scope):
        return sorted(r["cnes"] for r in ratio_indicators.indicator_c1(T, S.but(scope=scope)).collect())

    assert seen((1,)) == ["1"] and seen(None) == ["1", "2"] and seen(()) == []
