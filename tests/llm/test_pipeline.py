"""The corpus pipeline, each stage held against a plain version over its own input."""

import collections

import pytest

import corpus_pipeline
from carespan.llm.common import settle
from carespan.llm import mixing, quality_rules, sharding
from tests.llm.conftest import documents, rows_by
from tests.llm.test_sets import check_mix, check_shards, plain_classes, plain_leaks, plain_quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before the first stage and after each."""
    found = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        found.append(settle(stage(spark, found[-1], SF)))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(steps):
    for df in steps[:-1]:
        assert df.columns == COLUMNS
    assert steps[-1].columns == [*COLUMNS, "shard", "slot"]


def test_quality_stage(steps):
    before, after = steps[0].collect(), texts(steps[1])
    failed = {r["doc_id"] for r in before if plain_quality(r["text"])[5]}
    verdicts = rows_by(quality_rules.judged(steps[0]))
    assert set(after) == {i for i, v in verdicts.items() if v["kept"]} and not failed & set(after)
    assert len(after) >= 0.9 * (len(before) - len(failed))


def test_near_duplicate_stage(steps):
    want = {least for _, least in plain_classes(steps[1].collect()).values()}
    assert [r["doc_id"] for r in steps[2].orderBy("doc_id").collect()] == sorted(want)


def test_decontamination_stage(spark, steps):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    leaks = {d for d, _ in plain_leaks(steps[2].collect(), items)}
    assert leaks and set(texts(steps[3])) == set(texts(steps[2])) - leaks


def test_mixing_stage(steps):
    before = steps[3].collect()
    copies = collections.Counter(r["doc_id"] for r in steps[4].collect())
    sizes = rows_by(mixing.mixed(steps[3]))
    got = {i: {**g, "taken": copies[i] * g["size"]} for i, g in sizes.items()}
    check_mix(before, got, 0.05)


def test_sharding_stage(steps):
    rows = [r.asDict() for r in steps[5].collect()]
    sizes = {r["doc_id"]: r for r in sharding.sharded(steps[4]).collect()}
    got = [{**sizes[r["doc_id"]].asDict(), "shard": r["shard"], "slot": r["slot"]} for r in rows]
    loads = check_shards(rows, got)
    assert len(rows) == steps[4].count() and max(loads) - min(loads) <= 0.05 * sum(loads) / 8


def test_run(spark, steps):
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect())
    assert got == sorted(tuple(r) for r in steps[-1].select("doc_id", "shard", "slot").collect())


def test_registered(spark):
    from carespan.llm.registry import QUERIES

    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert "pipeline" in QUERIES and numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] and corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_stay(spark):
    """Ordinary prose with a note, a quote or numbers in it is kept."""
    good = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 1000 and text not like '%###%'").limit(20).collect()
    extra = ["\nLicensed under the Apache License, Version 2.0.", "\nSee 12, 14 and 99 (p. 3).", "", "\nShe said: \"yes\"!"]
    docs = documents(spark, [(r["text"] + extra[i % 4], r["source"], r["lang"]) for i, r in enumerate(good)])
    failed = {r["doc_id"] for r in docs.collect() if plain_quality(r["text"])[5]}
    kept = {r["doc_id"] for r in quality_rules.quality_filter(docs).collect()}
    assert kept == set(range(len(good))) - failed


def test_null_and_repeated_ids_keep_their_documents(spark):
    """Distinct texts stay whole where their ids are null or the same; near copies among them go."""
    from carespan.llm import decontamination, ngram_join

    def text(name):
        return " ".join(f"{name}{i}" for i in range(40))

    names = ("a", "b", "c", "d")
    rows = [(None, text(n)) for n in names] + [(7, text(n + "x")) for n in names]
    copies = [(None, text("a") + " end"), (7, text("cx") + " end"), (3, text("b") + " end"), (None, text("a"))]
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows + copies], documents(spark, []).schema).repartition(3)
    left = ngram_join.one_per_class(docs).collect()
    assert len(left) == 8 and {r["text"].split()[0] for r in left} == {r[1].split()[0] for r in rows}
    assert (3, text("b") + " end") in {(r["doc_id"], r["text"]) for r in left}
    bench = spark.createDataFrame([(1, text("a")), (2, text("bx"))], "item_id bigint, text string")
    clean = {(r["doc_id"], r["text"]) for r in decontamination.decontaminated(docs, bench).collect()}
    assert clean == {r for r in rows + copies if r[1].split()[0] not in ("a0", "bx0")}
