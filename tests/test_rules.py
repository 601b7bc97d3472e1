"""Parameters and scalar rules at their edges."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.codes import ACCESS_GAP_BANDS, BANDS, CodeSets
from carespan.functions import scalars as f
from carespan.setting import Period, Setting, months_later, period_bounds


def test_period_lengths():
    assert period_bounds("2024-01-01", "2024-01-07") == Period(date(2024, 1, 1), date(2024, 1, 7))
    assert period_bounds("2022-01-01", "2024-01-02").end == date(2024, 1, 2)  # 731 days on
    for start, end in (("2024-01-01", "2024-01-06"), ("2022-01-01", "2024-01-03")):
        with pytest.raises(ValueError):
            period_bounds(start, end)


def test_period_needs_both_dates_or_none():
    for given in ({"start": "2024-01-01"}, {"end": "2024-01-01"}):
        with pytest.raises(ValueError):
            period_bounds(**given)
    assert period_bounds(as_of=date(2024, 1, 15)) == Period(date(2023, 12, 1), date(2023, 12, 31))
    assert period_bounds(as_of=date(2024, 3, 31)) == Period(date(2024, 2, 1), date(2024, 2, 29))


def test_months_later_keeps_to_the_month():
    assert months_later(date(2024, 2, 29), -24) == date(2022, 2, 28)
    assert months_later(date(2024, 8, 31), -6) == date(2024, 2, 29)
    assert months_later(date(2024, 1, 15), -1) == date(2023, 12, 15)


def test_unknown_gap_mode():
    with pytest.raises(ValueError):
        Setting(Period(date(2024, 1, 1), date(2024, 1, 31)), date(2024, 2, 1), gap_mode="weeks")


def test_code_sets():
    codes = CodeSets()
    assert codes.weight_height == ("0101040024",)
    assert codes.weight_height_pregnancy == ()
    assert len(codes.listed_dental) == 26 and len(codes.preventive_base) == 26
    assert set(codes.preventive_dental) <= set(codes.preventive_base)


def column(spark, expression, rows, types):
    return [r[0] for r in spark.createDataFrame(rows, types).select(expression).collect()]


def test_ratio(spark):
    rows = [(1, 8), (1, 3), (2, 3), (1, 800), (41, 4000), (0, 5), (3, 0), (3, None)]
    expected = [12.5, 33.33, 66.67, 0.13, 1.03, 0.0]
    num, den = F.col("n"), F.col("d")
    assert column(spark, f.ratio(num, den), rows, "n int, d int") == expected + [None, None]
    assert column(spark, f.ratio(num, den, empty=0), rows, "n int, d int") == expected + [0.0, 0.0]


@pytest.mark.parametrize("name, cases", [
    ("c1", {9.99: "Regular", 10.0: "Suficiente", 29.99: "Suficiente", 30.0: "Bom", 50.0: "Ótimo", 70.0: "Ótimo", 70.01: "Regular"}),
    ("b1", {1.0: "Regular", 1.01: "Suficiente", 3.0: "Suficiente", 3.01: "Bom", 5.0: "Bom", 5.01: "Ótimo"}),
    ("b3", {2.99: "Regular", 3.0: "Ótimo", 9.99: "Ótimo", 10.0: "Bom", 12.0: "Suficiente", 14.0: "Regular"}),
    ("b4", {0.25: "Regular", 0.26: "Suficiente", 0.51: "Bom", 1.0: "Bom", 1.01: "Ótimo"}),
    ("b5", {39.99: "Regular", 40.0: "Suficiente", 55.0: "Bom", 65.0: "Ótimo", 85.0: "Ótimo", 85.01: "Regular"}),
    ("b6", {3.0: "Regular", 3.01: "Suficiente", 6.01: "Bom", 8.0: "Bom", 8.01: "Ótimo"}),
    ("c6", {25.0: "Regular", 25.01: "Suficiente", 50.01: "Bom", 75.0: "Bom", 75.01: "Ótimo"}),
    ("m1", {0.99: "Regular", 1.0: "Suficiente", 2.0: "Bom", 3.0: "Bom", 3.01: "Ótimo"}),
])
def test_bands(spark, name, cases):
    got = column(spark, f.band(F.col("v"), BANDS[name]), [(v,) for v in [*cases, None]], "v double")
    assert got == [*cases.values(), "Sem dados"]


def test_access_gap_band_closes_at_ten(spark):
    assert column(spark, f.band(F.col("v"), ACCESS_GAP_BANDS), [(10.0,), (10.01,)], "v double") == ["Regular", "Suficiente"]


def test_age(spark):
    births = [date(2020, 2, 29), date(2018, 3, 1), date(2018, 2, 28), date(2011, 2, 28), date(2010, 2, 28), None]
    got = column(spark, f.age_years(date(2023, 2, 28), F.col("b")), [(b,) for b in births], "b date")
    assert got == [2, 4, 5, 12, 13, None]


def test_dates(spark):
    numbers = [(20240229,), (30001231,), (20240230,), (0,), (None,)]
    assert column(spark, f.number_date(F.col("n")), numbers, "n int") == [date(2024, 2, 29), date(3000, 12, 31), None, None, None]
    assert column(spark, f.date_number(F.col("d")), [(date(2024, 2, 29),)], "d date") == [20240229]
    assert column(spark, f.display_date(F.col("d")), [(date(2024, 2, 9),)], "d date") == ["09/02/2024"]


def weighted(number):
    return sum(int(c) * (15 - i) for i, c in enumerate(number)) % 11


def test_cns(spark):
    by_remainder = {}
    for tail in range(100):
        number = f"7000000000000{tail:02d}"
        by_remainder.setdefault(weighted(number), number)
    good, rejected, loose = by_remainder[0], by_remainder[1], by_remainder[5]
    dotted = f"{good[:3]} {good[3:7]}.{good[7:11]}-{good[11:]}"
    rows = [(x,) for x in (good, rejected, loose, dotted, good[:14], "3" + good[1:], "", "abc", None)]
    assert column(spark, f.cns_valid(F.col("c")), rows, "c string") == [1, 0, 1, 1, 0, 0, 0, 0, 0]
    assert column(spark, f.cns_valid(F.col("c"), strict=True), rows, "c string") == [1, 0, 0, 1, 0, 0, 0, 0, 0]


def test_documents_and_lists(spark):
    cpfs = [(x,) for x in ("12345678901", "00000000000", "  ", "", None)]
    assert column(spark, f.cpf_present(F.col("c")), cpfs, "c string") == [1, 0, 0, 0, 0]
    lists = [(x,) for x in ("|22|42|", "|122|", "|2|", "", None)]
    assert column(spark, f.lists_any(F.col("c"), ("22", "29")), lists, "c string") == [True, False, False, False, False]
    teams = [(x,) for x in ("A", "", "SEM EQUIPE", None)]
    assert column(spark, F.coalesce(f.valid_team(F.col("c")), F.lit(False)), teams, "c string") == [True, False, False, False]
