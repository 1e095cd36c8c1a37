"""Search by posting lists equals a scan, and reads the rarest list only."""

import random

import pytest

from ledgerline.operators import boards, postings


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    pick = random.Random(4)
    names = ["".join(pick.choice("abcAB é-") for _ in range(pick.randrange(12))) for _ in range(300)] + ["common name"] * 40 + ["rarely common", None, "", "%_x", "a"]
    index = spark.createDataFrame([(n, f"s{k}", pick.choice(["ref", "team"]), None) for k, n in enumerate(names)], "n string, s string, t string, u string")
    path = str(tmp_path_factory.mktemp("postings") / "index")
    postings.written(index, path)
    return index, path


@pytest.mark.parametrize("text", ["a", "AB", "abc", "é-", "b é", "common", "RARELY c", "zzz", "", "  ", "%_", "-", "commonx", "a b"])
def test_equal_to_a_scan(spark, made, text):
    index, path = made
    assert postings.search(spark, path, text, 1000).collect() == boards.search(index, text, 1000).collect()
    key = lambda df: sorted(map(str, df.collect()))
    assert key(postings.directory(spark, path, text)) == key(boards.directory(index, text))


def test_the_rarest_list_is_read(spark, made):
    _, path = made
    hits = postings.candidates(spark, path, "rarely common")
    assert hits.count() == 1 and len(hits.inputFiles()) >= 1
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "PushedFilters: [IsNotNull(_gram), EqualTo(_gram" in plan


def test_an_empty_index(spark, tmp_path):
    index = spark.createDataFrame([], "n string, s string, t string")
    postings.written(index, str(tmp_path / "p"))
    assert postings.search(spark, str(tmp_path / "p"), "abc").collect() == []
