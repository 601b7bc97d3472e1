"""Marts are replaced, not added to."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.plans import marts
from carespan.plans.mart_tables import MART_COLUMNS, create_tables, declared, load_partitions, switch_catalog
from carespan.setting import Period
from carespan.sources.derived import SETTING, open_derived
from tests.golden import S, linked, make

SF = "/root/testdata/sf0.001"


def test_month_is_replaced_and_other_months_stay(spark, tmp_path):
    T, path = open_derived(spark, SF), str(tmp_path)
    names = ("c1", "m1")
    marts.write_indicators(T, SETTING, path, names)
    first = spark.read.parquet(path).count()
    marts.write_indicators(T, SETTING, path, names)
    assert spark.read.parquet(path).count() == first
    earlier = SETTING.but(period=Period(date(2000, 6, 1), date(2001, 5, 31)))
    marts.write_indicators(T, earlier, path, names)
    months = spark.read.parquet(path).groupBy("competencia").count().collect()
    assert {r["competencia"] for r in months} == {200105, 200107}


def test_a_list_that_became_empty_leaves_no_rows(spark, tmp_path):
    older = {"person_id": 1, "birth_date": date(1950, 1, 1)}
    path = str(tmp_path / "lists")
    T = make(spark, **linked(older))
    marts.write_outreach(T, S, path, ("c6", "b1"))
    assert {r["condicao"] for r in spark.read.parquet(path).collect()} == {"c6", "b1"}
    T = make(spark, **linked(older), encounter=[{"person_id": 1, "event_date": date(2024, 1, 1)}])
    marts.write_outreach(T, S, path, ("c6", "b1"))
    assert {r["condicao"] for r in spark.read.parquet(path).collect()} == {"b1"}


def test_a_failing_part_leaves_the_old_table_whole(spark, tmp_path):
    path = str(tmp_path / "mart" / "table")
    good = spark.range(3).withColumn("k", F.lit("a"))
    marts._replace(path, [good], "k")
    bad = spark.range(3).select("id", F.raise_error(F.lit("no")).cast("string").alias("k"))
    with pytest.raises(Exception, match="no"):
        marts._replace(path, [spark.range(5).withColumn("k", F.lit("b")), bad], "k")
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in (tmp_path / "mart").iterdir()] == ["table"]
    marts._replace(path, [spark.range(5).withColumn("k", F.lit("b"))], "k")
    assert {r["k"] for r in spark.read.parquet(path).collect()} == {"b"}


def test_only_the_months_from_a_date_on_are_replaced(spark, tmp_path):
    T, path = open_derived(spark, SF), str(tmp_path / "encounters")
    marts.write_encounters(T, SETTING, path)
    whole = spark.read.parquet(path)
    first = {tuple(r) for r in whole.groupBy("competencia").count().collect()}
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "encounters").glob("competencia=*")}
    marts.write_encounters(T, SETTING, path, since=date(2001, 5, 20))
    assert {tuple(r) for r in spark.read.parquet(path).groupBy("competencia").count().collect()} == first
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "encounters").glob("competencia=*")}
    changed = {n for n in after if after[n] != before[n]}
    assert changed and min(changed) == "competencia=200105"


def test_unknown_sex_is_not_male(spark):
    T = make(spark, **linked(*[{"person_id": i, "sex_id": x} for i, x in enumerate((1, 2, 3, None))]))
    assert {r["paciente_id"]: r["sexo"] for r in marts.dim_paciente(T, S).collect()} == {0: "M", 1: "F", 2: None, 3: None}


def test_a_month_without_rows_is_dropped(spark, tmp_path):
    """A refresh from a month on leaves no row of a month whose encounters were all removed."""
    T, path = open_derived(spark, SF), str(tmp_path / "encounters")
    marts.write_encounters(T, SETTING, path)
    less = T.replacing(encounter=T["encounter"].where("date_format(event_date, 'yyyyMM') <> '200106'"))
    marts.write_encounters(less, SETTING, path, since=date(2001, 5, 1))
    months = {r["competencia"] for r in spark.read.parquet(path).select("competencia").distinct().collect()}
    assert 200106 not in months and {200105, 200107, 200101} <= months


def test_a_table_left_aside_is_put_back(spark, tmp_path):
    """A run that ended between moving the old table aside and putting the new one in its place."""
    path = str(tmp_path / "mart" / "table")
    marts._replace(path, [spark.range(3)])
    (tmp_path / "mart" / "table").rename(tmp_path / "mart" / "_staged_table_0-old")
    bad = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("k"))
    with pytest.raises(Exception, match="no"):
        marts._replace(path, [bad])
    assert spark.read.parquet(path).count() == 3


def test_nightly_run(spark, tmp_path):
    T = make(
        spark, **linked({"person_id": 1, "birth_date": date(1950, 1, 1), "nationality_id": 3}),
        encounter=[{"person_id": 1, "event_date": date(2024, 1, 1), "visit_type_id": 2}],
        home_visit=[{"person_id": 1, "event_date": date(2024, 1, 2)}],
    )
    spark.sql(f"CREATE DATABASE marts LOCATION '{tmp_path}/db'")
    root = tmp_path / "marts"
    try:
        published = marts.refresh_all(T, S, str(root))
        switch_catalog(spark, "marts", published)
        for name in MART_COLUMNS:
            columns = dict(spark.createDataFrame([], declared(name)).dtypes)
            assert dict(spark.read.table(f"marts.{name}").dtypes) == columns, name
            assert dict(marts.read_mart(published, name).dtypes) == columns, name
            rows = sorted(map(repr, marts.read_mart(published, name).collect()))
            assert sorted(map(repr, spark.read.table(f"marts.{name}").collect())) == rows, name
        assert spark.read.table("marts.busca_ativa").where("condicao = 'b1'").count() == 1

        # a second run that fails at its last mart: the catalog, and a reader of files, see the first one
        more = T.replacing(person=T["person"].withColumn("name", F.lit("other")))
        broken = more.replacing(home_visit=T["home_visit"].withColumn("event_date", F.raise_error(F.lit("no")).cast("date")))
        before = sorted(map(repr, spark.read.table("marts.busca_ativa").collect()))
        some = ("busca_ativa", "dim_paciente", "fato_visita_domiciliar")
        with pytest.raises(Exception, match="no"):
            marts.refresh_all(broken, S, str(root), names=some)
        switch_catalog(spark, "marts", published)
        assert sorted(map(repr, marts.read_mart(published, "busca_ativa").collect())) == before
        assert len(published.runs()) == 1 and len(list((root / "busca_ativa").iterdir())) == 1

        # one that succeeds is seen by all readers once the index is switched
        marts.refresh_all(more, S, str(root), names=some)
        assert sorted(map(repr, spark.read.table("marts.busca_ativa").collect())) == before
        switch_catalog(spark, "marts", published)
        assert {r["nome"] for r in spark.read.table("marts.busca_ativa").collect()} == {"other"}
        assert {r["nome"] for r in spark.read.table("marts.dim_paciente").collect()} == {"other"}
    finally:
        spark.sql("DROP DATABASE marts CASCADE")
    tables = {p.name for p in root.iterdir()}
    assert tables == {
        "fato_estrangeiros", "fato_indicadores", "fato_boas_praticas", "busca_ativa", "inconsistencias", "indice", *marts.CONFORMED,
    }
    row = marts.read_mart(published, "fato_boas_praticas").where("cd_indicador = 'C6'").collect()[0]
    assert row["boas_praticas"] == {"A": True, "B": False, "C": False, "D": False} and float(row["pontuacao"]) == 25.0


def test_tables_declared_over_single_folders(spark, tmp_path):
    T = make(spark, **linked({"person_id": 1, "birth_date": date(1950, 1, 1), "nationality_id": 3}))
    spark.sql(f"CREATE DATABASE single LOCATION '{tmp_path}/db'")
    try:
        create_tables(spark, "single", str(tmp_path))
        create_tables(spark, "single", str(tmp_path))  # nothing to do the second time
        marts.write_foreigners(T, S, f"{tmp_path}/fato_estrangeiros")
        marts.write_outreach(T, S, f"{tmp_path}/busca_ativa", ("c6", "b1"))
        load_partitions(spark, "single", ("fato_estrangeiros", "busca_ativa"))
        for name in ("fato_estrangeiros", "busca_ativa"):
            assert dict(spark.read.table(f"single.{name}").dtypes) == dict(spark.read.parquet(f"{tmp_path}/{name}").dtypes)
        assert spark.read.table("single.busca_ativa").where("condicao = 'b1'").count() == 1
    finally:
        spark.sql("DROP DATABASE single CASCADE")
