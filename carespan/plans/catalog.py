"""Indicators and worklists by name, and the unions over all of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carespan.operators import practice_indicators as practice
from carespan.operators import ratio_indicators as ratios
from carespan.operators.listing import filter_unit, ordered
from carespan.operators.outreach import CONTACT, LINKED_LISTS, OUTREACH, linked_worklists
from carespan.operators.units import TEAM
from carespan.setting import Setting
from carespan.sources.tables import Tables

INDICATORS = {
    "c1": ratios.indicator_c1, "c2": practice.indicator_c2, "c3": practice.indicator_c3,
    "c4": practice.indicator_c4, "c5": practice.indicator_c5, "c6": practice.indicator_c6,
    "c7": practice.indicator_c7, "b1": ratios.indicator_b1, "b2": ratios.indicator_b2,
    "b3": ratios.indicator_b3, "b4": ratios.indicator_b4, "b5": ratios.indicator_b5,
    "b6": ratios.indicator_b6, "m1": ratios.indicator_m1, "m2": ratios.indicator_m2,
}


# Indicators that share their pass over the events when several are asked for.
TOGETHER = {
    ("c4", "c5", "c6"): practice.yearly_indicators,
    ("c1", "m1", "m2"): ratios.access_and_contact_indicators,
    ("m1", "m2"): ratios.contact_indicators,
    ("b3", "b5", "b6"): ratios.dental_shares,
}


def _long(rows: DataFrame, s: Setting) -> DataFrame:
    return rows.select(
        "indicador", *TEAM, "numerator", "denominator", "value", "classificacao",
        F.lit(s.period.start).alias("inicio"), F.lit(s.period.end).alias("fim"),
    )


def indicator_parts(T: Tables, s: Setting, names=tuple(INDICATORS)) -> list[DataFrame]:
    """The named indicators in the shape all share, in as few tables as their passes allow."""
    left, parts = list(names), []
    for group, build in TOGETHER.items():
        if group[0] in left and len(set(group) & set(left)) > 1:
            rows = build(T, s)
            parts.append(_long(rows.where(F.col("indicador").isin(*left)), s))
            left = [n for n in left if n not in group]
    single = [INDICATORS[n](T, s).withColumn("indicador", F.lit(n)) for n in left]
    return [_long(rows, s) for rows in single] + parts


def indicator_long(T: Tables, s: Setting, names=tuple(INDICATORS)) -> DataFrame:
    """All indicators, one row per indicator and team."""
    return reduce(DataFrame.unionByName, indicator_parts(T, s, names))


def _tagged(name: str, T: Tables, s: Setting) -> DataFrame:
    """A worklist in the shape all share; one without a team has none in its rows."""
    rows = OUTREACH[name](T, s)
    team = [c if c in rows.columns else F.lit(None).cast("string").alias(c) for c in TEAM]
    return rows.select(F.lit(name).alias("condicao"), *team, *CONTACT)


# Field names of the service's answers, as (numerator, denominator, value).
FIELDS = {
    "c1": ("programada", "total_atendimentos", "perc_programada"),
    "b1": ("pessoas_1a_consulta", "total_pessoas", "percentual"),
    "b2": ("pessoas_tratamento_concluido", "pessoas_1a_consulta", "percentual"),
    "b3": ("exodontias", "total_procedimentos", "percentual"),
    "b4": ("total_participantes", "total_criancas", "percentual"),
    "b5": ("preventivos", "total_procedimentos", "percentual"),
    "b6": ("tra_art", "total_restauradores", "percentual"),
    "m1": ("total_atendimentos", "pessoas_atendidas", "media_atend_por_pessoa"),
    "m2": ("total_acoes", "pessoas_atendidas", "media_acoes_por_pessoa"),
    "c2": ("soma_praticas", "total_criancas", "percentual"),
    "c3": ("soma_pontos", "total_gestacoes", "percentual"),
    "c4": ("soma_praticas", "total_pessoas", "percentual"),
    "c5": ("soma_praticas", "total_pessoas", "percentual"),
    "c6": ("soma_praticas", "total_pessoas", "percentual"),
    "c7": (None, None, "percentual"),
}


def service_rows(name: str, T: Tables, s: Setting, unit: str | None = None) -> DataFrame:
    """An indicator under the service's field names, for units matching a text, by unit and team."""
    rows = INDICATORS[name](T, s)
    for ours, theirs in zip(("numerator", "denominator", "value"), FIELDS[name]):
        rows = rows.withColumnRenamed(ours, theirs) if theirs else rows.drop(ours)
    rows = rows.withColumnRenamed("atividades", "total_atividades")
    rows = rows if unit is None else filter_unit(rows, unit)
    return ordered(rows, "unidade_saude", "no_equipe")


def outreach_parts(T: Tables, s: Setting, names=tuple(OUTREACH)) -> list[DataFrame]:
    """The named worklists, those over linked people from one pass if several are asked for."""
    shared = tuple(n for n in names if n in LINKED_LISTS)
    rows = [linked_worklists(T, s, shared)] if shared else []
    return rows + [_tagged(n, T, s) for n in names if n not in shared]


def outreach_all(T: Tables, s: Setting, names=tuple(OUTREACH)) -> DataFrame:
    """All worklists, tagged with their condition."""
    return reduce(DataFrame.unionByName, outreach_parts(T, s, names))
