"""The set of canonical tables an operator reads."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class Tables(Mapping):
    """Canonical tables by name. A table is opened at first use, so a query opens only what it reads.

    ``heavy_people`` names the people with a large share of an event table, where that is known; None says
    that nobody looked. Joins of people with their events treat them apart.
    """

    def __init__(
        self, openers: Mapping[str, DataFrame | Callable[[], DataFrame]], heavy_people: tuple[int, ...] | None = None,
    ):
        self._openers = dict(openers)
        self._opened: dict[str, DataFrame] = {}
        self.heavy_people = heavy_people

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._opened:
            source = self._openers[name]
            self._opened[name] = source() if callable(source) else source
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._openers)

    def __len__(self) -> int:
        return len(self._openers)

    def replacing(self, **tables: DataFrame) -> "Tables":
        """The same set with some tables exchanged."""
        return Tables({**self._openers, **tables}, self.heavy_people)
