"""Windows and thresholds of the good practices, one hand-made person per case."""

from datetime import date, timedelta

from carespan.operators import practice_indicators as p
from tests.golden import AGENT, AS_OF, BIRTH, MN, S, day, flags, linked, make


def events(table, **days_of):
    return [{"person_id": int(k[1:]), "event_date": d} for k, ds in days_of.items() for d in ds]


def test_c2_first_month_and_visits(spark):
    people = linked(*[{"person_id": i, "birth_date": BIRTH} for i in range(1, 8)])
    T = make(
        spark, **people,
        encounter=events("encounter", p1=[day(0)], p2=[day(30)], p3=[day(31)], p4=[day(-1)]),
        home_visit=events(
            "home_visit", p5=[day(30), day(180)], p6=[day(30), day(181)], p7=[day(31), day(60)],
        ),
    )
    assert flags(p.practices_c2(T, S), "abcde") == {1: "a", 2: "a", 3: "", 4: "", 5: "d", 6: "", 7: ""}


def test_c2_counts_days_not_rows(spark):
    people = linked(*[{"person_id": i, "birth_date": BIRTH} for i in (1, 2, 3)])
    weighed = {"weight": 9.0, "height": 0.7}
    ten = [day(40 + i) for i in range(9)]
    T = make(
        spark, **people,
        encounter=[
            *[{"person_id": 1, "event_date": d} for d in ten],
            *[{"person_id": 2, "event_date": d} for d in ten[:8] + ten[:8]],
            *[{"person_id": 3, "event_date": d, **weighed, "occupation_id": 2} for d in ten[:8]],
        ],
        # a day already weighed in another table, and one more day
        home_visit=[{"person_id": 3, "event_date": d, **weighed, "newborn_followup": 0} for d in (ten[0], ten[8])],
        procedure_event=[{"person_id": 3, "event_date": ten[1], "procedure_id": 20}],
    )
    assert flags(p.practices_c2(T, S), "abcde") == {1: "b", 2: "", 3: "c"}


def test_c2_doses(spark):
    people = linked(*[{"person_id": i, "birth_date": BIRTH} for i in (1, 2)])
    both, rest = ["|29|"] * 3, ["|24|", "|56|", "|26|", "|107|"]

    def doses(person, codes):
        return [{"person_id": person, "event_date": day(60 + i), "vaccine_codes": c} for i, c in enumerate(codes)]

    # code 29 counts for two vaccines at once
    T = make(spark, **people, vaccination=doses(1, both + rest) + doses(2, both + rest[:-1]))
    assert flags(p.practices_c2(T, S), "abcde") == {1: "e", 2: ""}


def test_c2_person_with_two_birth_dates_is_counted_once(spark):
    people = linked({"person_id": 1, "birth_date": BIRTH})
    people["registration"].append({"registration_id": 9, "person_id": 1, "birth_date": day(10)})
    people["person_link"].append({"link_id": 9, "registration_id": 9, "root_id": 1})
    T = make(spark, **people, encounter=events("encounter", p1=[day(40)]))  # 30 days after the later birth
    assert flags(p.practices_c2(T, S), "abcde") == {1: "a"}
    assert [r["denominator"] for r in p.indicator_c2(T, S).collect()] == [1]


START = date(2023, 9, 1)


def pregnancy(person, number=1, start=START, after=None, end=None):
    return {
        "person_id": person, "pregnancy_no": number, "start_date": start, "puerperium_start": after,
        "puerperium_end": end,
    }


def test_c3_windows_from_the_start(spark):
    n = range(1, 9)
    T = make(
        spark, **linked(*[{"person_id": i} for i in n]), pregnancy=[pregnancy(i) for i in n],
        encounter=events("encounter", p1=[day(84, START)], p2=[day(85, START)]),
        procedure_event=[
            {"person_id": i, "event_date": day(k, START), "procedure_id": 25}
            for i, k in ((3, 91), (4, 92), (5, 195), (6, 196))
        ],
        vaccination=[
            {"person_id": i, "event_date": day(k, START), "vaccine_codes": "|57|"} for i, k in ((7, 139), (8, 140))
        ],
    )
    assert flags(p.practices_c3(T, S), "abcdefghijk") == {1: "a", 2: "", 3: "g", 4: "", 5: "", 6: "h", 7: "", 8: "f"}


def test_c3_rows_against_days(spark):
    twice = [day(100 + i // 2, START) for i in range(7)]  # seven rows on four days
    pressure = {"systolic": 120}
    T = make(
        spark, **linked({"person_id": 1}), pregnancy=[pregnancy(1)],
        encounter=[{"person_id": 1, "event_date": d, **pressure} for d in twice],
    )
    assert flags(p.practices_c3(T, S), "abcdefghijk") == {1: "b"}


def test_c3_visits_count_from_the_first_consultation(spark):
    T = make(
        spark, **linked({"person_id": 1}, {"person_id": 2}, {"person_id": 3}),
        pregnancy=[pregnancy(1), pregnancy(2), pregnancy(3)],
        encounter=events("encounter", p1=[day(100, START)], p2=[day(100, START)]),
        home_visit=events(
            "home_visit", p1=[day(100, START), day(101, START), day(102, START)],
            p2=[day(99, START), day(101, START), day(102, START)], p3=[day(i, START) for i in (1, 2, 3)],
        ),
    )
    assert flags(p.practices_c3(T, S), "abcdefghijk") == {1: "e", 2: "", 3: ""}


def test_c3_puerperium(spark):
    birth = day(270, START)
    T = make(
        spark, **linked(*[{"person_id": i} for i in range(1, 5)]),
        pregnancy=[pregnancy(1, after=birth), pregnancy(2, after=birth, end=day(10, birth)), pregnancy(3), pregnancy(4, after=birth)],
        encounter=events("encounter", p1=[birth], p2=[day(11, birth)], p3=[birth], p4=[day(-1, birth)]),
        home_visit=events("home_visit", p1=[day(10, birth)]),
    )
    assert flags(p.practices_c3(T, S), "abcdefghijk") == {1: "ij", 2: "", 3: "", 4: ""}


def test_c3_keeps_active_pregnancies_only(spark):
    T = make(
        spark, **linked({"person_id": 1}),
        pregnancy=[
            pregnancy(1, 1, date(2024, 7, 1)),  # begins after the period
            pregnancy(1, 2, date(2022, 1, 1), date(2022, 10, 1), date(2023, 6, 30)),  # over before it
            pregnancy(1, 3, date(2022, 6, 1), date(2023, 5, 20), date(2023, 7, 1)),
            pregnancy(1, 4),
        ],
    )
    assert sorted(flags(p.practices_c3(T, S), "a", "pregnancy_no")) == [3, 4]


def chronic(spark, visits, s=S):
    ill = [{"person_id": i, "event_date": date(2020, 1, 1), "icd_codes": "|E11|", "occupation_id": 2} for i in visits]
    T = make(
        spark, **linked(*[{"person_id": i} for i in visits]), encounter=ill,
        home_visit=[{"person_id": i, "event_date": d} for i, days in visits.items() for d in days],
    )
    return flags(p.practices_c4(T, s), "abcdef")


def test_gap_between_visits(spark):
    visits = {
        1: [date(2024, 1, 31), date(2024, 2, 1)],  # a day apart, 70 as integers
        2: [date(2024, 1, 1), date(2024, 1, 31)],  # 30 days
        3: [date(2024, 1, 1), date(2024, 1, 30)],
        4: [date(2024, 1, 1)],
    }
    assert chronic(spark, visits) == {1: "", 2: "d", 3: "", 4: ""}
    assert chronic(spark, visits, S.but(gap_mode="yyyymmdd")) == {1: "d", 2: "d", 3: "", 4: ""}


def test_c4_takes_the_team_of_the_latest_encounter(spark):
    rows = [
        {"person_id": 1, "encounter_id": 1, "event_date": date(2022, 1, 1), "icd_codes": "|E10|", "team_id": 1},
        {"person_id": 1, "encounter_id": 2, "event_date": date(2023, 1, 1), "icpc_codes": "|T90|", "team_id": 1},
        {"person_id": 1, "encounter_id": 3, "event_date": date(2023, 1, 1), "icpc_codes": "|T89|", "team_id": 2},
        {"person_id": 1, "encounter_id": 4, "event_date": date(2024, 1, 1), "icd_codes": "|J00|", "team_id": 1},
        {"person_id": 2, "encounter_id": 5, "event_date": date(2024, 1, 1), "icd_codes": "|E11|", "team_id": 1},
    ]
    teams = [{"team_id": 1, "team_name": "A", "ine": "01"}, {"team_id": 2, "team_name": "B", "ine": "02"}]
    people = linked({"person_id": 1}, {"person_id": 2, "deceased": 1})
    T = make(spark, **people, encounter=rows, team=teams)
    assert [(r["person_id"], r["team_id"]) for r in p.practices_c4(T, S).collect()] == [(1, 2)]


def test_c4_looks_back_183_and_366_days(spark):
    end = S.period.end
    T = make(
        spark, **linked(*[{"person_id": i} for i in range(1, 5)]),
        encounter=[{"person_id": i, "event_date": date(2020, 1, 1), "icd_codes": "|E11|", "occupation_id": 2} for i in range(1, 5)]
        + [{"person_id": i, "event_date": end - timedelta(days=k)} for i, k in ((1, 183), (2, 184))],
        procedure_event=[
            {"person_id": i, "event_date": end - timedelta(days=k), "procedure_id": 21} for i, k in ((3, 366), (4, 367))
        ],
    )
    assert flags(p.practices_c4(T, S), "abcdef") == {1: "a", 2: "", 3: "e", 4: ""}


def test_c6_ages(spark):
    T = make(spark, **linked(
        {"person_id": 1, "birth_date": date(AS_OF.year - 60, 7, 1)},
        {"person_id": 2, "birth_date": date(AS_OF.year - 60, 7, 2)},
        {"person_id": 3, "birth_date": None},
    ))
    assert flags(p.practices_c6(T, S), "abcd") == {1: ""}


def test_c7_ages_at_the_end_of_the_period(spark):
    end = S.period.end

    def born(years, later=0):
        return date(end.year - years, end.month, end.day) + timedelta(days=later)

    T = make(
        spark, **linked(
            {"person_id": 1, "birth_date": born(9)}, {"person_id": 2, "birth_date": born(9, 1)},
            {"person_id": 3, "birth_date": born(14)}, {"person_id": 4, "birth_date": born(15)},
            {"person_id": 5, "birth_date": born(64)}, {"person_id": 6, "birth_date": born(65)},
            {"person_id": 7, "birth_date": born(70)}, {"person_id": 8, "birth_date": born(30), "sex_id": 1},
        ),
    )
    bases = {
        r["person_id"]: "".join(x for x in "abcd" if r[f"base_{x}"]) for r in p.practices_c7(T, S).collect()
    }
    assert bases == {1: "b", 3: "bc", 4: "c", 5: "acd", 6: "cd"}


def test_c7_value_leaves_out_ages_without_women(spark):
    people = [{"person_id": i, "birth_date": date(1990, 1, 1)} for i in (1, 2)]
    T = make(
        spark, **linked(*people),
        procedure_event=[{"person_id": 1, "event_date": date(2024, 1, 1), "procedure_id": 23}],
        encounter=[{"person_id": 2, "event_date": date(2024, 1, 1), "icd_codes": "|Z30|"}],
    )
    row = p.indicator_c7(T, S).collect()[0]
    assert (row["base_a"], row["base_b"], row["pratica_a"], row["pratica_c"]) == (2, 0, 1, 1)
    assert row["value"] == 25.0  # half of 20 and half of 30


def test_occupations_decide(spark):
    T = make(
        spark, **linked(*[{"person_id": i, "birth_date": date(1950, 1, 1)} for i in (1, 2, 3)]),
        encounter=[
            {"person_id": 1, "event_date": date(2024, 1, 1), "occupation_id": MN},
            {"person_id": 2, "event_date": date(2024, 1, 1), "occupation_id": AGENT, "weight": 70.0, "height": 1.7},
            {"person_id": 3, "event_date": date(2024, 1, 1), "occupation_id": 9, "weight": 70.0, "height": 1.7},
        ],
    )
    assert flags(p.practices_c6(T, S), "abcd") == {1: "a", 2: "b", 3: ""}


def test_c7_rounds_exact_ties_up(spark):
    T = make(
        spark, **linked(*[{"person_id": i, "birth_date": date(1990, 1, 1)} for i in range(1, 33)]),
        procedure_event=[{"person_id": 1, "event_date": date(2024, 1, 1), "procedure_id": 23}],
    )
    assert p.indicator_c7(T, S).collect()[0]["value"] == 0.63  # 20 / 32 = 0.625


def test_city_means_round_exact_ties_up(spark):
    def seen(facility, visits, scheduled):
        return [
            {"encounter_id": 10 * facility + i, "person_id": i, "event_date": date(2024, 1, 1), "facility_id": facility,
             "team_id": facility, "visit_type_id": 2 if i < scheduled else 1} for i in range(visits)
        ]

    T = make(
        spark, facility=[{"facility_id": i, "facility_name": f"U{i}", "cnes": f"{i}"} for i in (1, 2)],
        team=[{"team_id": i, "team_name": f"T{i}", "ine": f"{i}"} for i in (1, 2)],
        encounter=seen(1, 3, 1) + seen(2, 4, 1),
    )
    from carespan.operators.rollups import city_summary

    rows = {(r["indicador"], r["unidade_saude"]): r["value"] for r in city_summary(T, S.but(scope=(1, 2))).collect()}
    assert (rows["c1", "U1"], rows["c1", "U2"]) == (33.33, 25.0)
    assert rows["c1", None] == 29.17  # 29.165
