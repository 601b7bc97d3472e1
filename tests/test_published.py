"""Sets of tables that are published together, and refreshes by month."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from carespan.sources import published as module
from carespan.sources.published import Published

ROW = "k int, v string, competencia int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def refreshed(published, df, **options):
    with published.refresh() as run:
        return run.months("t", df, **options)


@pytest.mark.parametrize("seed", range(4))
def test_months_follow_the_source(spark, tmp_path, seed):
    """After any changes the table equals its source, and only months that differ are written."""
    rng = random.Random(seed)
    published = Published(spark, str(tmp_path))
    rows = [(rng.randint(0, 9), rng.choice("ab"), rng.choice([None, 202301, 202302, 202312, 202401])) for _ in range(60)]
    for _ in range(4):
        df = spark.createDataFrame(rows, ROW).repartition(rng.randint(1, 4))
        before = {m: sorted(r for r in rows_of(published.read("t", ROW)) if r[2] == m) for m in {r[2] for r in rows}}
        told = refreshed(published, df)
        assert rows_of(published.read("t", ROW)) == sorted(rows, key=repr)
        same = {m for m in before if before[m] == sorted(r for r in rows if r[2] == m)}
        assert {None if m is None else int(m) for m in told["kept"]} == same
        change = rng.choice(["late", "removed", "changed", "doubled", "month"])
        month = rng.choice(rows)[2]
        if change == "late":
            rows = rows + [(1, "late", month)]
        elif change == "removed":
            rows = rows[1:]
        elif change == "changed":
            rows = [(rows[0][0], "x", rows[0][2]), *rows[1:]]
        elif change == "doubled":
            rows = rows + [rows[0]] * 2
        else:
            rows = [r for r in rows if r[2] != month] or rows[:1]


MONTHS = [100 * y + m for y in range(1990, 2000) for m in range(1, 13)]


@pytest.mark.parametrize("changed", [[None], [199005], MONTHS[1:], [None, *MONTHS[1:]], [None, *MONTHS]])
def test_many_months_are_chosen(spark, tmp_path, changed):
    published = Published(spark, str(tmp_path))
    rows = [(m or 0, "a", m) for m in (None, *MONTHS)]
    refreshed(published, spark.createDataFrame(rows, ROW))
    rows = [(k, "b" if m in changed else v, m) for k, v, m in rows]
    told = refreshed(published, spark.createDataFrame(rows, ROW))
    assert {None if m is None else int(m) for m in told["written"]} == set(changed)
    assert len(told["kept"]) == len(rows) - len(changed)
    assert rows_of(published.read("t", ROW)) == sorted(rows, key=repr)


def test_changed_months_are_looked_up(spark, tmp_path, monkeypatch):
    """A row's month is made out once, not once per changed month: the plan doesn't grow with these."""
    seen = []
    write = module.Run._write
    monkeypatch.setattr(module.Run, "_write", lambda run, table, parts, *rest: (seen.extend(parts), write(run, table, parts, *rest))[1])
    published = Published(spark, str(tmp_path))
    days = [(i, "a", i) for i in range(1, 121)]

    def by_month(word):
        made = F.expr("competencia % 120 + 199000").cast("int")
        df = spark.createDataFrame([(k, v if k == 7 else word, c) for k, v, c in days], ROW)
        return df.withColumn("competencia", made)

    refreshed(published, by_month("a"))
    told = refreshed(published, by_month("b"))
    assert len(told["written"]) == 119
    plan = seen[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("% 120") <= 4


def test_pairs_of_equal_rows_show(spark, tmp_path):
    """Two pairs of equal rows have the same number and the same XOR; their sum tells them apart."""
    published = Published(spark, str(tmp_path))
    refreshed(published, spark.createDataFrame([(1, "a", 1), (1, "a", 1)], ROW))
    told = refreshed(published, spark.createDataFrame([(2, "b", 1), (2, "b", 1)], ROW))
    assert told["written"] == ["1"] and rows_of(published.read("t", ROW)) == [(2, "b", 1)] * 2


def test_from_a_month_on(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    refreshed(published, spark.createDataFrame([(1, "a", 202301), (2, "a", 202302), (3, "a", 202303)], ROW))
    changed = spark.createDataFrame([(9, "a", 202301), (3, "a", 202303), (4, "a", 202304)], ROW)
    told = refreshed(published, changed, since="202302")
    assert told == {"written": ["202304"], "dropped": ["202302"], "kept": ["202303"]}
    assert rows_of(published.read("t", ROW)) == [(1, "a", 202301), (3, "a", 202303), (4, "a", 202304)]


def test_load_columns_do_not_count(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    schema = "k int, loaded date, competencia int"
    for day in (1, 2):
        told = refreshed(published, spark.createDataFrame([(1, date(2024, 1, day), 5)], schema), besides=("loaded",))
    assert told["kept"] == ["5"] and rows_of(published.read("t", schema)) == [(1, date(2024, 1, 1), 5)]


def test_a_failing_run_changes_nothing(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    with published.refresh() as run:
        run.whole("a", [spark.range(3)])
        run.whole("b", [spark.range(4)])
        run.one_month("c", "202301", [spark.range(5)])
    with pytest.raises(Exception, match="no"):
        with published.refresh() as run:
            run.whole("a", [spark.range(30)])
            run.one_month("c", "202302", [spark.range(50)])
            run.whole("b", [spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))])
    assert [published.read(t, "id bigint").count() for t in "abc"] == [3, 4, 5]
    assert len(list((tmp_path / "a").iterdir())) == 1
    # an index that was never finished is not read
    (tmp_path / "indice" / "carga=0000000009").mkdir()
    assert published.read("a", "id bigint").count() == 3 and len(published.runs()) == 1


def test_empty_tables_and_old_runs(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    schema = "id bigint, p int"
    empty = spark.createDataFrame([], schema)
    assert published.read("a", schema).count() == 0
    for n in (0, 1, 2, 3):
        with published.refresh() as run:
            run.whole("a", [spark.range(n).withColumn("p", F.lit(1)) if n else empty], "p")
            if n == 1:
                run.whole("kept", [spark.range(7)])
        assert published.read("a", schema).count() == n
    published.drop_old_runs(keep=2)
    assert len(published.runs()) == 2 and len(list((tmp_path / "a").iterdir())) == 2
    assert published.read("a", schema).count() == 3 and published.read("kept", "id bigint").count() == 7


def test_only_named_folders_are_opened(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    refreshed(published, spark.createDataFrame([(1, "a", 202301), (2, "a", 202302)], ROW))
    refreshed(published, spark.createDataFrame([(1, "b", 202301), (2, "a", 202302)], ROW))
    df = published.read("t", ROW)
    assert len({f.rsplit("/", 1)[0] for f in df.inputFiles()}) == 2
    plan = df.where("competencia = 202302")._jdf.queryExecution().executedPlan().toString()
    assert "competencia" in plan.split("PartitionFilters")[1]
