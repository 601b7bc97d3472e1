"""Search by trigrams beside a scan."""

import random

import pytest

from carespan.operators import listing
from carespan.plans import search_index

WORDS = ["ana", "Anã", "AÇÃO", "maria", "Mariana", "x", "", "José da Silva", "%_\\", "ß", "İstanbul", "aaaa", "🙂ab", " "]


@pytest.fixture(scope="module", params=[1, 2])
def written(request, spark, tmp_path_factory):
    rng = random.Random(request.param)

    def text():
        return None if rng.random() < 0.1 else " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 4)))

    rows = [(i, text(), text(), rng.choice([None, *range(2000)])) for i in range(300)] + [(7, "hot", "hot", 1)] * 50
    df = spark.createDataFrame(rows, "id int, nome string, bairro string, numero int").repartition(3)
    path = str(tmp_path_factory.mktemp("search") / "list")
    columns = ("nome", "bairro", "numero")
    return search_index.write_search_list(df, path, "id", columns, block_rows=40), df, columns


TEXTS = ["ana", "ANA", "anã", "ação", "ria", "mariana jos", "da silva x", "%_\\", "ss", "ß", "istanbul", "İst", "aaa", "aaaaa", "🙂ab", "123", "19",
         "a", "", "  ", "   ", "hot", "nowhere", "maria a"]


@pytest.mark.parametrize("text", TEXTS)
def test_equals_a_scan(written, text):
    paged, df, columns = written
    expected = listing.search_rows(df, text, columns)
    got = paged.search(text)
    assert got.columns == df.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))


def test_only_candidates_are_tested(written):
    paged, df, columns = written
    for text in ("mariana", "istanbul", "da silva"):
        places = {r["_lugar"] for r in paged.candidates(text).collect()}
        hits = listing.search_rows(df, text, columns).count()
        assert hits <= len(places) < df.count()
    plan = paged.search("hot")._jdf.queryExecution().executedPlan().toString()
    assert "bloco" in plan.split("PartitionFilters")[1][:60]
    assert "In(trigrama" in paged.candidates("mariana")._jdf.queryExecution().executedPlan().toString()


def test_an_empty_list(spark, tmp_path):
    df = spark.createDataFrame([], "id int, nome string")
    found = search_index.write_search_list(df, str(tmp_path / "l"), "id", ("nome",))
    assert found.search("abc").count() == found.search("a").count() == 0
