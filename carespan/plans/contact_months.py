"""Distinct people over any months, from written monthly states instead of events.

People have dense numbers, ordered by the facility and team of their newest link, so a team's people lie
close together. Per kind of contact, unit and month the numbers are kept as exact bitmaps with the number
of events. Bitmaps of several months are merged by OR and counted: the result is that of a distinct count
over the events, for any run of months, and no event is read. A bitmap is one long of 64 people, and only
those with a person in them are kept: a unit that meets few people of the city takes a row for each of
them at most, one that meets its own people a row for 64.

States are published by month like the marts: a refresh writes the months whose states changed. Numbers are
never given anew; people who are seen for the first time get the next ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.functions.scalars import in_list, ratio
from carespan.operators.listing import numbered
from carespan.operators.population import latest_registration, people_by_facility
from carespan.operators.ratio_indicators import UNIT_IDS, procedures_of, scored
from carespan.operators.units import in_scope, named, unit_keys
from carespan.session import written
from carespan.setting import Setting
from carespan.sources.lake import gathered
from carespan.sources.published import Published
from carespan.sources.tables import Tables

MONTH = "competencia"
STATES = "contatos_64"  # named by what a row holds: states of other bitmaps are not read as these
BITS = 6  # of a number, its place in the bitmap
STATE = (
    "tipo string, facility_id int, team_id bigint, faixa bigint, eventos bigint, pessoas bigint, competencia int"
)
NUMBERS = "person_id bigint, numero bigint"


def contacts(T: Tables, s: Setting) -> DataFrame:
    """Events per kind, unit, month and person: contacts of M1 and M2, first dental visits of B1."""
    month = (F.year("event_date") * 100 + F.month("event_date")).alias(MONTH)
    multi = T["encounter"].where(in_list(F.col("occupation_id"), s.codes.multi_professional_ids)).select(
        F.lit("contato").alias("tipo"), *UNIT_IDS, month, "person_id"
    )
    first = procedures_of(T, first=s.codes.first_dental_visit)
    dental = T["dental_procedure"].where(in_list(F.col("occupation_id"), s.codes.dentist_ids)).join(
        first, "procedure_id", "left_semi"
    ).select(F.lit("primeira").alias("tipo"), *UNIT_IDS, month, "person_id")
    return multi.unionByName(dental).where(f"{MONTH} IS NOT NULL").groupBy("tipo", *UNIT_IDS, MONTH, "person_id").agg(
        F.count("*").alias("eventos")
    )


def _numbers(T: Tables, s: Setting, seen: DataFrame, known: DataFrame) -> DataFrame:
    """Known numbers, and the next ones for people who have none, by unit and person."""
    new = seen.select("person_id").where("person_id IS NOT NULL").distinct().join(known, "person_id", "left_anti")
    homes = latest_registration(
        T, s, registrations=T["registration"].select("registration_id", "person_id")
    ).select("person_id", *UNIT_IDS)
    order = [F.col(c).asc_nulls_last() for c in (*UNIT_IDS, "person_id")]
    given = numbered(new.join(homes, "person_id", "left"), *order, name="numero", first=known.count() + 1)
    return known.unionByName(given.select("person_id", "numero"))


def refresh_contact_months(T: Tables, s: Setting, published: Published) -> dict[str, list]:
    """Bring the states to the events; returns the months written, dropped and kept."""
    events = written(contacts(T, s))
    numbers = written(_numbers(T, s, events, published.read("pessoas", NUMBERS)))
    at = F.col("numero")
    bit = F.expr(f"shiftleft(1L, cast(numero & {(1 << BITS) - 1} AS INT))")
    # events without a person count, but for nobody: their bitmap is null
    states = written(events.join(numbers, "person_id", "left").select(
        "tipo", *UNIT_IDS, MONTH, "eventos", F.shiftright(at, BITS).alias("faixa"), bit.alias("bit"),
    ).groupBy("tipo", *UNIT_IDS, MONTH, "faixa").agg(
        F.sum("eventos").alias("eventos"), F.bit_or("bit").alias("pessoas")
    ))
    with published.refresh() as run:
        run.whole_if_changed("pessoas", numbers)
        return run.months(STATES, states, gather=lambda rows: gathered(rows, MONTH))


def _merged(published: Published, kind: str, first: int, last: int, keys, prepare=None) -> DataFrame:
    """Events and distinct people per key over the months, both included."""
    rows = published.read(STATES, STATE).where(
        (F.col("tipo") == kind) & F.col(MONTH).between(first, last)
    )
    rows = rows if prepare is None else prepare(rows)
    ranges = rows.groupBy(*keys, "faixa").agg(
        F.sum("eventos").alias("eventos"), F.bit_count(F.bit_or("pessoas")).alias("pessoas")
    )
    return ranges.groupBy(*keys).agg(
        F.sum("eventos").alias("numerator"), F.sum(F.when(F.col("faixa").isNotNull(), F.col("pessoas")).otherwise(0)).alias("people")
    )


def contacts_between(published: Published, T: Tables, s: Setting, first: int, last: int, name: str = "m1") -> DataFrame:
    """M1 or M2 over whole months (YYYYMM), the same rows as over the events of these days."""
    counts = _merged(published, "contato", first, last, UNIT_IDS, lambda rows: unit_keys(rows.where(in_scope(s)), T))
    counts = named(counts.withColumnRenamed("people", "denominator"), T)
    return scored(counts, name, ratio(F.col("numerator"), F.col("denominator"), scale=1))


def first_visits_between(published: Published, T: Tables, s: Setting, first: int, last: int) -> DataFrame:
    """B1 over whole months."""
    linked = people_by_facility(T, s).withColumnRenamed("people", "denominator")
    people = _merged(published, "primeira", first, last, UNIT_IDS).select(*UNIT_IDS, F.col("people").alias("numerator"))
    counts = people.join(linked, "facility_id", "left")
    return scored(named(counts, T, valid_only=True), "b1", ratio(F.col("numerator"), F.col("denominator")))


def people_between(published: Published, s: Setting, first: int, last: int) -> DataFrame:
    """Events and distinct people of the whole city in scope per kind; a person met by many teams counts once."""
    return _merged(published, "contato", first, last, ["tipo"], lambda rows: rows.where(in_scope(s))).unionByName(
        _merged(published, "primeira", first, last, ["tipo"], lambda rows: rows.where(in_scope(s)))
    )
