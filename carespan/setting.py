"""Run parameters: the reporting period, the as-of date, the facility scope and the code sets.

Nothing in the library reads the clock except ``period_bounds`` when it is given no dates, so every
result is a function of its inputs.
"""

from __future__ import annotations

from calendar import monthrange
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from carespan.codes import CodeSets

# A period spans 7 to 732 days, both ends included.
SHORTEST_DIFFERENCE = 6
LONGEST_DIFFERENCE = 731


@dataclass(frozen=True)
class Period:
    """A reporting period, closed at both ends."""

    start: date
    end: date


def months_later(day: date, months: int) -> date:
    """The same day some months on (back, if negative), the last of a shorter month."""
    years, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return date(years, month + 1, min(day.day, monthrange(years, month + 1)[1]))


def _as_date(value) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def period_bounds(start=None, end=None, as_of: date | None = None) -> Period:
    """Check a requested period; with no dates, take the calendar month before ``as_of``."""
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither")
    if start is None:
        last = (as_of or date.today()).replace(day=1) - timedelta(days=1)
        return Period(last.replace(day=1), last)
    bounds = Period(_as_date(start), _as_date(end))
    span = (bounds.end - bounds.start).days
    if not SHORTEST_DIFFERENCE <= span <= LONGEST_DIFFERENCE:
        raise ValueError("a period must span 7 to 732 days")
    return bounds


@dataclass(frozen=True)
class Setting:
    """What every operator needs besides the tables.

    ``scope`` is the set of facility ids reported on, None for all of them. ``gap_mode`` says how the
    30 days between home visits are measured: "days" on the calendar, "yyyymmdd" as the difference of
    the two dates written as integers.
    """

    period: Period
    as_of: date
    scope: tuple[int, ...] | None = None
    codes: CodeSets = field(default_factory=CodeSets)
    gap_mode: str = "days"

    def __post_init__(self):
        if self.gap_mode not in ("days", "yyyymmdd"):
            raise ValueError(f"unknown gap mode: {self.gap_mode}")

    def but(self, **changes) -> "Setting":
        return replace(self, **changes)
