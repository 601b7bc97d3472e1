
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce
from inspect import signature

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from carespan.operators import benefits, cohorts, listing, population, quality, rollups, series, units  # noqa: E402
from carespan.operators.outreach import OUTREACH, access_gap, outreach_b1, outreach_list  # noqa: E402
from carespan.operators.practice_indicators import PERSON_PRACTICES, practice_columns  # noqa: E402
from carespan.plans.catalog import INDICATORS, indicator_long, outreach_all, service_rows  # noqa: E402
from carespan.plans import contact_months, marts  # noqa: E402
from carespan.plans.benefit_list import BenefitList, write_benefit_list  # noqa: E402
from carespan.session import drop_at_end, shared_folder, tune  # noqa: E402
from carespan.setting import period_bounds  # noqa: E402
from carespan.plans.mart_tables import switch_catalog  # noqa: E402
from carespan.plans.search_index import write_search_list  # noqa: E402
from carespan.sources import changes  # noqa: E402
from carespan.sources.derived import SETTING, earlier, open_derived, operational_reader  # noqa: E402
from carespan.sources.lake import open_lake, write_lake  # noqa: E402
from carespan.sources.operational import open_operational  # noqa: E402
from carespan.sources.published import Published  # noqa: E402
from carespan.sources.schemas import COLUMNS, FACTS  # noqa: E402
from oracle.queries import texts  # noqa: E402

try:  # the text operators can be left out as a whole
    from carespan.llm.registry import QUERIES as TEXT_QUERIES  # noqa: E402
    from carespan.llm.registry import SQL as TEXT_SQL  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("carespan.llm", "carespan.llm.registry", "corpus_pipeline"):
        raise
    TEXT_QUERIES, TEXT_SQL = {}, {}


def entry(spark: SparkSession) -> DataFrame:
    """Access indicator per team on the smallest test files."""
    return queries()["ind_c1"](spark, "/root/testdata/sf0.001")


def _joined(df: DataFrame, separator: str = ";") -> DataFrame:
    """Arrays as joined text, so both engines return the same type."""
    kinds = dict(df.dtypes)
    return df.select(*[
        F.array_join(c, separator).alias(c) if kinds[c].startswith("array") else F.col(c)
        for c in df.columns
    ])


def _placed(df: DataFrame, *order) -> DataFrame:
    """Rows with their place in the order; rows it leaves equal are equal here."""
    places = listing.numbered(df, *(order or listing.ascending(*df.columns)))
    return places.withColumn("posicao", F.col("posicao").cast("int"))


def _by_unit_descending(df: DataFrame) -> DataFrame:
    return _placed(df.select("unidade_saude"), listing.sort_key(df, "unidade_saude", True))


def _totals(T, s):
    flags = ("flag_cpf_presente", "flag_vinculo_unidade", "flag_atendimento_recente")
    return cohorts.cohort_totals(cohorts.indigenous_cohort(T, s), *flags)


def _flags(name, T, s):
    rows = PERSON_PRACTICES[name](T, s)
    return rows.select("person_id", "team_id", *practice_columns(name))


_lists: dict[int, tuple] = {}


def _benefit_list(T, s) -> BenefitList:
    """The written benefit list of a set of tables: written once, then read page by page."""
    if id(T) not in _lists:
        spark = T["person"].sparkSession
        path = drop_at_end(spark, write_benefit_list(T, s, shared_folder(spark)))
        _lists[id(T)] = (T, BenefitList(spark, path))
    return _lists[id(T)][1]


ENDS = (date(2000, 8, 31), date(2000, 12, 31), date(2001, 3, 15), date(2001, 7, 31))
MONTH_ENDS = tuple(date(y, m, 1) - timedelta(days=1) for y in (1999, 2000, 2001) for m in range(1, 13))[8:32]


_searches: dict[tuple, tuple] = {}


def _search_list(name, T, s):
    """A list that is searched often: written once with its postings, then read by candidates."""
    build, columns = {
        "foreigners": (cohorts.foreigner_cohort, ("nome", "unidade_saude", "pais_origem")),
        "benefits": (benefits.benefit_conditions, ("nome_esus", "cpf", "cns")),
    }[name]
    if (name, id(T)) not in _searches:
        rows = build(T, s)
        path = shared_folder(rows.sparkSession)
        found = write_search_list(rows, path, rows.columns[0], columns)
        drop_at_end(rows.sparkSession, path)
        _searches[name, id(T)] = (T, found)
    return _searches[name, id(T)][1]


def _days(T, days) -> DataFrame:
    return T["person"].sparkSession.createDataFrame([(d,) for d in days], "dia date")


# query name -> function of (tables, setting)
BUILDS = {
    **{f"ind_{name}": build for name, build in INDICATORS.items()},
    "ref_facilities": units.facilities,
    "ref_active_teams": units.active_teams,
    "linked_population": population.linked_population,
    "cohort_indigenous": cohorts.indigenous_cohort,
    "cohort_foreigners": cohorts.foreigner_cohort,
    "cohort_foreigners_detail": lambda T, s: cohorts.foreigner_cohort(T, s, detail=True),
    "cohort_totals": _totals,
    "cohort_homeless": cohorts.homeless_cohort,
    "cohort_disability_physical": lambda T, s: _joined(cohorts.disability_cohort(T, s, "fisica"), ", "),
    "cohort_disability_cognitive": lambda T, s: _joined(cohorts.disability_cohort(T, s, "mental"), ", "),
    "population_stats": cohorts.population_stats,
    "quality_duplicates": quality.duplicate_persons,
    "quality_newborn_names": quality.newborn_placeholder_names,
    "quality_stale_pregnancies": quality.stale_pregnancies,
    "quality_document_flags": lambda T, s: quality.document_flags(T),
    "quality_cns": quality.cns_quality,
    "benefit_conditions": benefits.benefit_conditions,
    "benefit_page": lambda T, s: _benefit_list(T, s).after(100, 500),
    "benefit_page_number": lambda T, s: _benefit_list(T, s).page(3, 20),
    "benefit_totals": lambda T, s: benefits.benefit_totals(benefits.benefit_conditions(T, s)),
    **{f"outreach_{n}": (lambda T, s, n=n: outreach_list(n, T, s)) for n in OUTREACH},
    "outreach_all": outreach_all,
    "outreach_access_gap": access_gap,
    "rollup_units": lambda T, s: rollups.rollup_units(INDICATORS["c1"](T, s)),
    "rollup_city": rollups.city_summary,
    "indicator_long": indicator_long,
    "band_distribution": lambda T, s: rollups.band_distribution(indicator_long(T, s)),
    **{f"practice_flags_{n}": (lambda T, s, n=n: _flags(n, T, s)) for n in PERSON_PRACTICES},
    "series_yearly": lambda T, s: series.yearly_series(T, s, ENDS),
    "series_population": lambda T, s: series.population_series(T, s, _days(T, MONTH_ENDS)),
    # the options of operators above
    "ind_c4_integer_gap": lambda T, s: INDICATORS["c4"](T, s.but(gap_mode="yyyymmdd")),
    "ind_c1_period": lambda T, s: INDICATORS["c1"](T, s.but(period=period_bounds("2000-08-01", "2001-07-31"))),
    "quality_cns_strict": lambda T, s: quality.cns_quality(T, s, strict=True),
    "outreach_b1_by_person": lambda T, s: outreach_b1(T, s, by="person"),
    "outreach_c1_team": lambda T, s: outreach_list("c1", T, s, unit="nation_0", team="Supplier#000000000"),
    "benefit_page_unit": lambda T, s: _benefit_list(T, s).after(0, 50, "Nation_1"),
    "benefit_page_number_unit": lambda T, s: _benefit_list(T, s).page(2, 5, "Nation_1"),
    "benefit_totals_unit": lambda T, s: _benefit_list(T, s).totals(unit="Nation_1"),
    "benefit_list": lambda T, s: _benefit_list(T, s).rows.drop("posicao", "bloco"),
    **{f"service_{n}": (lambda T, s, n=n: service_rows(n, T, s)) for n in ("b4", "c3", "c7", "m2")},
    "service_c1_unit": lambda T, s: service_rows("c1", T, s, unit="nation_1"),
    # what a reader does with a list
    "list_unit_filter": lambda T, s: listing.filter_unit(INDICATORS["c1"](T, s), "000001"),
    "list_search": lambda T, s: listing.search_rows(cohorts.foreigner_cohort(T, s), "rn c"),
    "search_foreigners": lambda T, s: _search_list("foreigners", T, s).search("rn c"),
    "search_benefits": lambda T, s: _search_list("benefits", T, s).search("00001"),
    "list_sorted": lambda T, s: listing.sort_rows(cohorts.homeless_cohort(T, s), "unidade_saude", True),
    "list_ordered": lambda T, s: listing.ordered(INDICATORS["b3"](T, s), "unidade_saude", "no_equipe"),
    "list_sorted_places": lambda T, s: _by_unit_descending(cohorts.homeless_cohort(T, s)),
    "list_ordered_places": lambda T, s: _placed(INDICATORS["b3"](T, s).select("unidade_saude", "no_equipe")),
    "service_m2_places": lambda T, s: _placed(service_rows("m2", T, s).select("unidade_saude", "no_equipe")),
    "list_masked": lambda T, s: listing.masked(cohorts.homeless_cohort(T, s)),
    "list_json": lambda T, s: listing.json_rows(units.facilities(T, s)),
}


def _practices_read(spark, path):
    done = F.map_filter("boas_praticas", lambda letter, was: was)
    return spark.read.parquet(path).withColumn("boas_praticas", F.array_join(F.map_keys(done), ","))


def _conformed(table):
    return lambda T, s, path: marts.write_conformed(T, s, path, (table,)) + f"/{table}", None


def _lake_b4(T, s, path):
    """Child brushing over the lake, loaded from the operational schema with its bridge of practices."""
    source = open_operational(operational_reader(T))
    write_lake(source, path, ("facility", "team", "group_activity", "person", "registration", "person_link", "occupation"))
    return path


def _lake_of(name):
    """An event table of a lake that saw an earlier state of the source and was brought up to date by changes."""

    def write(T, s, path):
        published = changes.lake(T[name].sparkSession, path)
        for state in (earlier(T), T):
            changes.load_changes(open_operational(operational_reader(state)), published, (name,))
        return path

    return write, lambda spark, path: changes.open_published(changes.lake(spark, path))[name].select(*COLUMNS[name])


REPORTED = ("encounter", "group_activity", "vaccination")  # with a key of one column, of two, and without


def _lake_report(spark, path):
    published = changes.lake(spark, path)
    return reduce(DataFrame.unionByName, [changes.load_report(published, name, 1, 2) for name in REPORTED])


def _two_loads(T, s, path):
    published = changes.lake(T["encounter"].sparkSession, path)
    for state in (earlier(T), T):
        changes.load_changes(state, published, REPORTED)
    return path


def _refreshed_encounters(T, s, path):
    """Encounters refreshed after a change of the source: late, removed and corrected rows, a month that ended empty."""
    for state in (earlier(T), T):
        marts.refresh_all(state, s, path, names=("fato_atendimento",))
    return path


def _read_mart(name):
    return lambda spark, path: marts.read_mart(Published(spark, path), name)


def _declared_mart(spark, path):
    """The inconsistencies, read through their table in the catalog."""
    database = f"marts_{os.path.basename(path).replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}/catalogo'")
    switch_catalog(spark, database, Published(spark, path))
    return spark.read.table(f"{database}.inconsistencias")


def _contact_months(T, s, path):
    """Monthly states of contacts, first for an earlier state of the source, then refreshed."""
    published = Published(T["person"].sparkSession, path)
    for state in (earlier(T), T):
        contact_months.refresh_contact_months(state, s, published)
    return path


def _from_months(read) -> Callable:
    return _contact_months, lambda spark, path, T: read(Published(spark, path), T, SETTING, 200008, 200107)


# query name -> (function that writes the mart under a path, function that reads it back, with the tables if it takes them)
MARTS = {
    "months_m1": _from_months(contact_months.contacts_between),
    "months_b1": _from_months(contact_months.first_visits_between),
    "months_city": _from_months(lambda published, T, *rest: contact_months.people_between(published, *rest)),
    "mart_foreigners": (marts.write_foreigners, None),
    "mart_indicators": (marts.write_indicators, None),
    "mart_person_practices": (marts.write_person_practices, _practices_read),
    "mart_worklists": (marts.write_outreach, None),
    "mart_inconsistencies": (marts.write_inconsistencies, None),
    "mart_patients": _conformed("dim_paciente"),
    "mart_teams": _conformed("dim_equipe"),
    "mart_encounters": _conformed("fato_atendimento"),
    "mart_units": _conformed("dim_unidade"),
    "mart_procedures": _conformed("dim_sigtap"),
    "mart_vaccinations": _conformed("fato_vacinacao"),
    "mart_home_visits": _conformed("fato_visita_domiciliar"),
    "mart_encounters_refresh": (_refreshed_encounters, _read_mart("fato_atendimento")),
    "mart_declared": (
        lambda T, s, path: marts.refresh_all(T, s, path, names=("inconsistencias", "dim_unidade")).root, _declared_mart,
    ),
    **{f"lake_{name}": _lake_of(name) for name in FACTS},
    "lake_changes": (_two_loads, _lake_report),
    "lake_b4": (_lake_b4, lambda spark, path: INDICATORS["b4"](open_lake(spark, path), SETTING)),
}


_opened: dict[tuple, tuple] = {}


def _tables(spark, sf_dir):
    """The tables of a directory, opened once per session."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _opened:
        _opened[key] = (spark, open_derived(tune(spark), sf_dir))
    return _opened[key][1]


def _written(write, read) -> Callable[[SparkSession, str], DataFrame]:
    """A query that writes a mart into a fresh shared folder and returns what it reads back."""

    def run(spark, sf_dir):
        root = shared_folder(spark)
        path = write(_tables(spark, sf_dir), SETTING, root)
        drop_at_end(spark, root)
        if read is None:
            return spark.read.parquet(path)
        takes_tables = len(signature(read).parameters) == 3
        return read(spark, path, _tables(spark, sf_dir)) if takes_tables else read(spark, path)

    return run


def _over(build) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(_tables(spark, sf_dir), SETTING)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **{name: _over(build) for name, build in BUILDS.items()},
        **{name: _written(*mart) for name, mart in MARTS.items()},
        **TEXT_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB text per query, over the test files registered as views."""
    known = queries()
    return {name: text for name, text in {**texts(), **TEXT_SQL}.items() if name in known}
