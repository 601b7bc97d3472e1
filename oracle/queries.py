"""All checks by query name."""

from __future__ import annotations

from oracle.base import complete
from oracle.indicators import INDICATORS
from oracle.marts import MARTS
from oracle.options import OPTIONS
from oracle.people import PEOPLE
from oracle.worklists import WORKLISTS


def checks() -> dict[str, tuple]:
    """Query name -> (parts, select)."""
    built = {f"ind_{name}": make() for name, make in INDICATORS.items()}
    for group in (PEOPLE, WORKLISTS, OPTIONS, MARTS):
        built.update({name: make() for name, make in group.items()})
    return built


def texts(**options) -> dict[str, str]:
    return {name: complete(*parts, **options) for name, parts in checks().items()}
