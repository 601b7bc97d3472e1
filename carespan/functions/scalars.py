"""Column expressions shared by the operators. All run inside whole-stage code generation; no UDFs."""

from __future__ import annotations

import operator
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from carespan.codes import NO_DATA

_TESTS = {">": operator.gt, ">=": operator.ge, "<": operator.lt, "<=": operator.le}


def ratio(num: Column, den: Column, scale: int = 100, digits: int = 2, empty: float | None = None) -> Column:
    """``scale * num / den`` rounded half away from zero, as a double.

    Works on whole numbers throughout, so a tie at the last digit rounds as exact decimals would.
    ``empty`` is the result when the denominator is zero or missing.
    """
    unit = 10**digits
    num, den = num.cast("long"), F.nullif(den.cast("long"), F.lit(0).cast("long"))
    value = F.call_function("div", num * (2 * scale * unit) + den, den * 2) / F.lit(float(unit))
    return value if empty is None else F.coalesce(value, F.lit(float(empty)))


def band(value: Column, rules) -> Column:
    """Label of the first rule whose tests all hold; a missing value has its own label."""
    labels = F.when(value.isNull(), NO_DATA)
    for label, *tests in rules:
        if not tests:
            return labels.otherwise(label)
        hit = F.lit(True)
        for symbol, threshold in tests:
            hit = hit & _TESTS[symbol](value, F.lit(float(threshold)))
        labels = labels.when(hit, label)
    return labels


def date_number(day: Column) -> Column:
    """A date as the integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def number_date(number: Column) -> Column:
    """The integer YYYYMMDD as a date, NULL when it is not one."""
    return F.try_to_date(number.cast("string"), "yyyyMMdd")


def age_years(as_of: date, birth: Column) -> Column:
    """Full years of age; a birthday on 29 February is reached on 1 March in common years."""
    today = as_of.year * 10000 + as_of.month * 100 + as_of.day
    return F.call_function("div", F.lit(today) - date_number(birth), F.lit(10000)).cast("int")


def starts_with_any(code: Column, prefixes) -> Column:
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | code.startswith(prefix)
    return F.coalesce(hit, F.lit(False))


def matches_any(text: Column, patterns) -> Column:
    """Some pattern occurs in the text; false for a missing text."""
    return F.coalesce(text.rlike("|".join(patterns)), F.lit(False))


def lists_any(text: Column, codes) -> Column:
    """Some code is a member of the pipe-delimited list; false for a missing list."""
    return F.coalesce(text.rlike(r"\|(" + "|".join(codes) + r")\|"), F.lit(False))


def in_list(column: Column, codes) -> Column:
    """Membership in a literal list; false for a missing value."""
    return F.coalesce(column.isin(*codes), F.lit(False)) if codes else F.lit(False)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, 1).otherwise(0)


def blank(column: Column) -> Column:
    """Text of the column, empty for NULL."""
    return F.coalesce(column.cast("string"), F.lit(""))


def cpf_present(cpf: Column) -> Column:
    """Filled in, and not only zeros."""
    return flag(cpf.isNotNull() & (F.trim(cpf) != "") & ~cpf.rlike("^0+$"))


def cns_valid(cns: Column, strict: bool = False) -> Column:
    """Check of the 15-digit health card number, 1 or 0.

    The weights run from 15 down to 1. The lenient form rejects only a remainder of 1 (whose check
    digit would be 10); the strict form wants the weighted sum to divide by 11.
    """
    digits = F.regexp_replace(cns, "[^0-9]", "")
    total = F.lit(0)
    for position in range(1, 16):
        total = total + F.substring(digits, position, 1).try_cast("int") * (16 - position)
    shaped = (F.length(digits) == 15) & F.substring(digits, 1, 1).isin("1", "2", "7", "8", "9")
    remainder = total % 11
    return flag(F.coalesce(shaped & ((remainder == 0) if strict else (remainder != 1)), F.lit(False)))


def valid_team(name: Column) -> Column:
    """A real team name: present, not empty, not the placeholder."""
    return name.isNotNull() & (name != "") & (name != "SEM EQUIPE")


def labels_of(labels: dict[str, str]) -> Column:
    """Array of the labels whose 0/1 column is set, in the order of the dictionary."""
    return F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(t)) for c, t in labels.items()]))


def display_date(day: Column) -> Column:
    return F.date_format(day, "dd/MM/yyyy")
