"""Batch jobs that write the marts.

``refresh_all`` writes all of them and publishes them in one step; the functions ``write_*`` replace a
single table in a folder. Marts of many indicators or worklists are written in several jobs, one per pass
over the events, so no job plans the union of all of them. Load dates are the as-of date of the run.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carespan.functions.scalars import blank, display_date, flag, ratio
from carespan.operators.cohorts import foreigner_cohort
from carespan.operators.outreach import OUTREACH
from carespan.operators.population import latest_registration, live_persons, valid_links
from carespan.operators.practice_indicators import (
    PERSON_PRACTICES, PRACTICES, WOMEN_AGES, YEARLY, practice_columns, yearly_people,
)
from carespan.operators.quality import document_flags, inconsistencies, stale_pregnancies
from carespan.operators.units import facility_names, team_names
from carespan.plans.catalog import INDICATORS, indicator_parts, outreach_parts
from carespan.plans.mart_tables import MART_COLUMNS, declared
from carespan.session import files_of
from carespan.setting import Setting
from carespan.sources.lake import gathered, within
from carespan.sources.published import Published, Run
from carespan.sources.tables import Tables


def _month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def _absent(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _loaded(s: Setting, name: str = "dt_carga") -> Column:
    return F.lit(s.as_of).alias(name)


def _publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a written folder in the place of a table.

    Folders are renamed: the old table stays whole until the new one is complete, and is put back if the
    new one can't take its place.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    new, table, old = jvm.Path(staged), jvm.Path(path), jvm.Path(f"{staged}-old")
    files = table.getFileSystem(spark._jsc.hadoopConfiguration())
    had = files.exists(table)
    if had and not files.rename(table, old):
        raise OSError(f"{path} can't be moved aside")
    if not files.rename(new, table):
        if had:
            files.rename(old, table)
        raise OSError(f"{staged} can't take the place of {path}")
    if had:
        files.delete(old, True)
    spark.catalog.refreshByPath(path)


def _restore(spark: SparkSession, parent: str, prefix: str, path: str) -> None:
    """Put a table back that a run moved aside and never replaced, as it ended between the two renames."""
    table, files = files_of(spark, path)
    folder, _ = files_of(spark, parent)
    if files.exists(table) or not files.exists(folder):
        return
    aside = [f.getPath() for f in files.listStatus(folder)]
    aside = [p for p in aside if p.getName().startswith(prefix) and p.getName().endswith("-old")]
    if aside:
        files.rename(aside[0], table)


def _replace(path: str, parts: list[DataFrame], *partitions: str) -> None:
    """Replace a table by the given parts, which are written beside it and published in one step.

    If a part fails, the table is as it was; names with a leading underscore are not read as data.
    """
    spark = parts[0].sparkSession
    parent, _, name = path.rstrip("/").rpartition("/")
    prefix = f"_staged_{name.replace('=', '-')}_"
    _restore(spark, parent, prefix, path)
    staged = f"{parent}/{prefix}{uuid.uuid4().hex}"
    try:
        for rows in parts:
            writer = rows.write.mode("append")
            (writer.partitionBy(*partitions) if partitions else writer).parquet(staged)
        _publish(spark, staged, path)
    except Exception:
        where = spark._jvm.org.apache.hadoop.fs.Path(staged)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        raise


def _of_month(path: str, s: Setting) -> str:
    """Folder of the month of the period's end; read at ``path``, it is the column competencia."""
    return f"{path}/competencia={s.period.end:%Y%m}"


def foreigner_rows(T: Tables, s: Setting) -> DataFrame:
    return foreigner_cohort(T, s, detail=True).withColumn("dt_carga", _loaded(s))


def write_foreigners(T: Tables, s: Setting, path: str) -> str:
    """Foreigners with their checks, by load date."""
    _replace(path, [foreigner_rows(T, s)], "dt_carga")
    return path


def indicator_mart_parts(T: Tables, s: Setting, names=tuple(INDICATORS)) -> list[DataFrame]:
    return [
        part.select(
            "nu_ine", "cnes", F.upper("indicador").alias("cd_indicador"),
            F.col("numerator").cast("decimal(12,4)").alias("numerador"),
            F.col("denominator").cast("decimal(12,4)").alias("denominador"),
            F.col("value").cast("decimal(10,4)").alias("vl_indicador"), "classificacao", _loaded(s),
        )
        for part in indicator_parts(T, s, names)
    ]


def write_indicators(T: Tables, s: Setting, path: str, names=tuple(INDICATORS)) -> str:
    """Indicators in long form by month of the period's end; the month is replaced as a whole."""
    _replace(_of_month(path, s), indicator_mart_parts(T, s, names), "cd_indicador")
    return path


def _score(name: str, practices: list[Column]) -> Column:
    """Points of one person, of 100."""
    if name == "c7":
        weights = [w for _, _, w in WOMEN_AGES.values()]
    elif name == "c3":
        weights = [10] + [9] * 10
    else:
        return ratio(sum(practices[1:], practices[0]), F.lit(len(practices)))
    return sum((p * w for p, w in zip(practices, weights)), F.lit(0)).cast("double")


def _scored(name: str, letters, practices: list[Column]) -> list[Column]:
    marks = [x for letter, p in zip(letters, practices) for x in (F.lit(letter.upper()), p == 1)]
    return [_score(name, practices).cast("decimal(5,2)").alias("pontuacao"), F.create_map(*marks).alias("boas_praticas")]


def person_practice_rows(name: str, T: Tables, s: Setting) -> DataFrame:
    """Score and practice map of one indicator's people."""
    practices = [F.col(p) for p in practice_columns(name)]
    scores = _scored(name, PRACTICES[name], practices)
    return PERSON_PRACTICES[name](T, s).select(F.lit(name).alias("indicador"), "person_id", "team_id", *scores)


def yearly_practice_rows(T: Tables, s: Setting) -> DataFrame:
    """The same for C4, C5 and C6 in one pass over the events."""
    score, done = F.lit(None).cast("decimal(5,2)"), F.lit(None).cast("map<string,boolean>")
    for name, kinds in YEARLY.items():
        own, own_map = _scored(name, kinds, [F.col(k) for k in kinds.values()])
        mine = F.col("indicador") == name
        score, done = F.when(mine, own).otherwise(score), F.when(mine, own_map).otherwise(done)
    return yearly_people(T, s).select(
        "indicador", "person_id", "team_id", score.alias("pontuacao"), done.alias("boas_praticas")
    )


def person_practice_parts(T: Tables, s: Setting, names=tuple(PERSON_PRACTICES)) -> list[DataFrame]:
    people = T["person"].select("person_id", "cns")
    if set(YEARLY) <= set(names):
        parts = [person_practice_rows(n, T, s) for n in names if n not in YEARLY] + [yearly_practice_rows(T, s)]
    else:
        parts = [person_practice_rows(n, T, s) for n in names]
    return [
        part.join(people, "person_id").join(team_names(T), "team_id", "left").select(
            F.col("person_id").alias("paciente_id"), "cns", "nu_ine",
            F.upper("indicador").alias("cd_indicador"), "pontuacao", "boas_praticas", _loaded(s),
        )
        for part in parts
    ]


def write_person_practices(T: Tables, s: Setting, path: str, names=tuple(PERSON_PRACTICES)) -> str:
    """Person, team and indicator with the score and a map of practice to done or not."""
    _replace(_of_month(path, s), person_practice_parts(T, s, names), "cd_indicador")
    return path


def outreach_mart_parts(T: Tables, s: Setting, names=tuple(OUTREACH)) -> list[DataFrame]:
    areas = latest_registration(
        T, s, registrations=T["registration"].select("registration_id", "person_id", "micro_area")
    ).select(F.col("person_id").alias("paciente_id"), "micro_area")
    return [
        part.join(areas, "paciente_id", "left").select(
            "paciente_id", "cns", "cpf", "nome", "condicao", "nu_ine", "micro_area", _absent("telefone"),
            _absent("acs_responsavel"), F.lit(0).alias("prioridade"), _loaded(s, "dt_geracao"),
        )
        for part in outreach_parts(T, s, names)
    ]


def write_outreach(T: Tables, s: Setting, path: str, names=tuple(OUTREACH)) -> str:
    """Worklists by condition, with the micro-area of the newest registration."""
    _replace(path, outreach_mart_parts(T, s, names), "condicao")
    return path


def inconsistency_rows(T: Tables, s: Setting) -> DataFrame:
    """One row per person or registration and finding."""

    def shaped(df, kind, text):
        return df.select(
            blank(F.col("cns")).alias("cns"), blank(F.col("cpf")).alias("cpf"),
            kind.alias("tp_inconsistencia"), text.alias("descricao"), _loaded(s, "dt_deteccao"),
        )

    names = inconsistencies(T, s)
    stale = stale_pregnancies(T, s)
    papers = document_flags(T).join(
        T["registration"].select("registration_id", "person_id", "cns", "cpf"), "registration_id"
    ).join(live_persons(T).select("person_id"), "person_id", "left_semi")
    number = F.concat(F.lit("cadastro "), F.col("registration_id").cast("string"))
    return (
        shaped(names, F.col("tipo"), F.concat_ws(" ", "nome", "data_nascimento"))
        .unionByName(shaped(
            stale, F.lit("gestante_dum_antiga"),
            F.concat(F.lit("DUM "), display_date(F.to_date("dum_formatado"))),
        ))
        .unionByName(shaped(papers.where(F.col("flag_cpf_presente") == 0), F.lit("cpf_ausente"), number))
        .unionByName(shaped(papers.where(F.col("flag_cns_valido") == 0), F.lit("cns_invalido"), number))
    )


def write_inconsistencies(T: Tables, s: Setting, path: str) -> str:
    _replace(path, [inconsistency_rows(T, s)])
    return path


# ---- conformed dimensions and facts ----


def dim_paciente(T: Tables, s: Setting) -> DataFrame:
    newest = latest_registration(T, s, registrations=T["registration"].select(
        "registration_id", "person_id", "birth_date", "nationality_id", "country_id", "micro_area", "ethnicity_id",
    ))
    return T["person"].join(newest, "person_id", "left").select(
        F.col("person_id").alias("paciente_id"), "cns", "cpf", F.col("name").alias("nome"),
        F.col("birth_date").alias("data_nascimento"),
        F.when(F.col("sex_id") == s.codes.female_sex, "F").when(F.col("sex_id") == s.codes.male_sex, "M").alias("sexo"),
        _absent("nome_mae"),
        F.col("nationality_id").alias("nacionalidade"), F.col("country_id").alias("pais_nascimento"),
        "micro_area", F.col("ethnicity_id").alias("etnia"), flag(F.col("deceased") == 0).alias("st_vivo"),
        _loaded(s),
    )


def dim_equipe(T: Tables, s: Setting) -> DataFrame:
    """Teams with the facility that most of their links in force name."""
    links = valid_links(T, s.as_of).where(F.col("facility_id").isNotNull())
    counts = links.groupBy("team_id", "facility_id").agg(F.count("*").alias("links"))
    home = counts.groupBy("team_id").agg(F.max(F.struct("links", "facility_id")).alias("home"))
    home = home.select("team_id", "home.facility_id").join(facility_names(T), "facility_id", "left")
    return team_names(T).join(home, "team_id", "left").select(
        "nu_ine", "no_equipe", _absent("tp_equipe"), "cnes", F.col("unidade_saude").alias("no_unidade"),
        _loaded(s),
    )


def dim_unidade(T: Tables, s: Setting) -> DataFrame:
    return facility_names(T).select("cnes", F.col("unidade_saude").alias("no_unidade"), _absent("tp_unidade"), _loaded(s))


def dim_sigtap(T: Tables, s: Setting) -> DataFrame:
    return T["procedure_code"].select(F.col("code").alias("co_sigtap"), _absent("no_procedimento"), _absent("categoria"), _loaded(s))


def _with_cns(events: DataFrame, T: Tables, name: str = "cns") -> DataFrame:
    return events.join(T["person"].select("person_id", F.col("cns").alias(name)), "person_id", "left")


def fato_atendimento(T: Tables, s: Setting, since: date | None = None) -> DataFrame:
    events = within(T["encounter"], since).select("person_id", "event_date", "visit_type_id", "facility_id", "team_id")
    events = _with_cns(events, T, "cns_paciente").join(facility_names(T), "facility_id", "left").join(team_names(T), "team_id", "left")
    return events.select(
        F.col("person_id").alias("paciente_id"), "cns_paciente", _absent("cns_profissional"), "nu_ine",
        F.col("cnes").alias("cnes_unidade"), F.col("visit_type_id").cast("string").alias("tp_atendimento"),
        _absent("ds_tipo_demanda"), _absent("co_sigtap"), _month(F.col("event_date")).alias("competencia"),
        F.col("event_date").alias("dt_atendimento"), _loaded(s),
    )


def fato_vacinacao(T: Tables, s: Setting) -> DataFrame:
    return _with_cns(T["vaccination"], T).select(
        "cns", _absent("co_sigtap"), F.col("vaccine_codes").alias("ds_vacina"), _absent("dose"),
        F.col("event_date").alias("dt_aplicacao"), _absent("fonte"), _loaded(s),
    )


def fato_visita_domiciliar(T: Tables, s: Setting) -> DataFrame:
    return _with_cns(T["home_visit"].select("person_id", "event_date"), T).select(
        "cns", _absent("cns_acs"), _absent("nu_ine"), F.col("event_date").alias("dt_visita"),
        _absent("tp_visita"), _loaded(s),
    )


CONFORMED = {
    "dim_paciente": dim_paciente, "dim_equipe": dim_equipe, "dim_unidade": dim_unidade,
    "dim_sigtap": dim_sigtap, "fato_atendimento": fato_atendimento, "fato_vacinacao": fato_vacinacao,
    "fato_visita_domiciliar": fato_visita_domiciliar,
}


def write_encounters(T: Tables, s: Setting, path: str, since: date | None = None) -> str:
    """Encounters by month. With ``since``, only the months from its own on are replaced.

    Such a refresh reads no earlier month of the lake. Months of the new rows are put in place when all
    of them are written, and a month from ``since`` on that has no rows any more is dropped.
    """
    if since is None:
        _replace(path, [gathered(fato_atendimento(T, s), "competencia")], "competencia")
        return path
    spark = T["encounter"].sparkSession
    rows = gathered(fato_atendimento(T, s, since.replace(day=1)), "competencia")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("competencia").parquet(path)
    left = {f"competencia={r[0]}" for r in rows.select("competencia").distinct().collect()}  # one row a month
    table, files = files_of(spark, path)
    for folder in [f.getPath() for f in files.listStatus(table)]:
        name = folder.getName()
        if name.startswith("competencia=") and name >= f"competencia={since:%Y%m}" and name not in left:
            files.delete(folder, True)
    spark.catalog.refreshByPath(path)
    return path


def write_conformed(T: Tables, s: Setting, path: str, names=tuple(CONFORMED), since: date | None = None) -> str:
    """Dimension and fact tables, each in its own folder; encounters by month."""
    for name in names:
        if name == "fato_atendimento":
            write_encounters(T, s, f"{path}/{name}", since)
        else:
            _replace(f"{path}/{name}", [CONFORMED[name](T, s)])
    return path


def _refreshed(name: str, T: Tables, s: Setting, run: Run, since: date | None) -> None:
    """One mart of a run."""
    month = f"{s.period.end:%Y%m}"
    if name == "fato_estrangeiros":
        run.whole(name, [foreigner_rows(T, s)], "dt_carga")
    elif name == "fato_indicadores":
        run.one_month(name, month, indicator_mart_parts(T, s), "cd_indicador")
    elif name == "fato_boas_praticas":
        run.one_month(name, month, person_practice_parts(T, s), "cd_indicador")
    elif name == "busca_ativa":
        run.whole(name, outreach_mart_parts(T, s), "condicao")
    elif name == "inconsistencias":
        run.whole(name, [inconsistency_rows(T, s)])
    elif name == "fato_atendimento":
        first = since and since.replace(day=1)
        run.months(
            name, fato_atendimento(T, s, first), f"{since:%Y%m}" if since else None, besides=("dt_carga",),
            gather=lambda rows: gathered(rows, "competencia"),
        )
    else:
        run.whole(name, [CONFORMED[name](T, s)])


def refresh_all(T: Tables, s: Setting, root: str, since: date | None = None, names=tuple(MART_COLUMNS)) -> Published:
    """The nightly run: the named marts, all of them if none are named, published in one step.

    If one fails, readers stay on the marts of the run before, all of one state. Of the encounters the
    months that differ from the index are written, and months without rows dropped; with ``since`` earlier
    months are neither read nor looked at. Indicators and practices replace the month of the period's end.
    """
    published = Published(T["person"].sparkSession, root)
    with published.refresh() as run:
        for name in names:
            _refreshed(name, T, s, run, since)
    return published


def read_mart(published: Published, name: str) -> DataFrame:
    """A published mart with its declared columns and those it carries beside them."""
    return published.read(name, declared(name))
