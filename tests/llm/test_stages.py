"""The pipeline's stages row by row, and every registered query on small tables."""

import random

import pytest

import __spark_entry__
import corpus_pipeline
from ledgerline.llm import common, mixing, ngram_join, token_store

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


def docs(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


def words(draw, n, of=400):
    return [f"w{draw.randrange(of)}" for _ in range(n)]


def test_copies_go_row_by_row(spark):
    df = docs(spark, (3, "a b c d e f"), (5, "A b c d e f"), (5, "quite another text that nothing copies"), (None, None), (None, ""))
    got = sorted((r["doc_id"] or 0, r["text"]) for r in ngram_join.stage(spark, df, "").collect() if r["text"])
    assert got == [(3, "a b c d e f"), (5, "quite another text that nothing copies")]
    assert ngram_join.stage(spark, df, "").count() == 4


@pytest.mark.parametrize("doc_id", [9, None])
def test_equal_rows_keep_one(spark, doc_id):
    df = docs(spark, *[(doc_id, "a b c d e f")] * 40, (doc_id, "some other words are here"))
    got = ngram_join.stage(spark, df, "").collect()
    assert sorted(r["text"] for r in got) == ["a b c d e f", "some other words are here"]


def test_rows_without_doc_id_link(spark):
    draw = random.Random(1)
    base = words(draw, 30)
    near, far = list(base), list(base)
    near[0] = "x0"
    far[0], far[29] = "x0", "x1"
    rows = ngram_join.joined(docs(spark, (4, " ".join(base)), (None, " ".join(near)), (8, " ".join(far)), (9, "no copy of it at all"))).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(4, 4), (None, 4), (8, 4), (9, 9)}


def test_a_doc_id_with_two_texts(spark):
    rows = ngram_join.joined(docs(spark, (3, "a b c d e f"), (5, "a b c d e f"), (5, "g h i j k l"), (7, "g h i j k l"))).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in rows) == [(3, 3), (5, 3), (5, 5), (7, 5)]


def test_large_tiles_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 50)
    draw = random.Random(2)
    passage = words(draw, 60, 10**6)
    rows, pairs = [], []
    for k in range(260):  # all have the passage, and less than 0.8 in common but for some pairs
        own = passage + words(draw, 60, 10**6)
        rows.append((2 * k, " ".join(own)))
        if k % 4 == 0:
            own[100] = "changed"
            rows.append((2 * k + 1, " ".join(own)))
            pairs.append((2 * k + 1, 2 * k))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(docs(spark, *rows)).collect()}
    assert got == {k: k for k, _ in rows} | dict(pairs)


def test_mix_comes_in_the_order_of_its_slots(spark):
    draw = random.Random(3)
    rows = [(k, " ".join(words(draw, draw.randint(20, 400))), None, "abc"[k % 3]) for k in range(3000)]
    df = docs(spark, *rows)
    out = common.saved(mixing.stage(spark, df, ""), "mixed")
    size = {k: len(t.split()) for k, t, *_ in rows}
    shares = mixing.shares({s: sum(size[k] for k, _, _, x in rows if x == s) for s in "abc"})
    got = [r["doc_id"] for r in out.select("doc_id", "_metadata.file_name", "_metadata.row_index").orderBy("file_name", "row_index").collect()]
    taken = {s: sum(size[k] for k in got if "abc"[k % 3] == s) for s in "abc"}
    assert all(abs(taken[x.source] - x.target) < 0.06 * x.target for x in shares)
    half = got[: len(got) // 2]
    for s in "abc":  # the first half has the sources nearly in the shares of the whole
        own = sum(size[k] for k in half if "abc"[k % 3] == s) / sum(size[k] for k in half)
        assert abs(own - taken[s] / sum(taken.values())) < 0.1
    assert max(got.count(k) for k in set(got)) <= 4
    stored = token_store.stage(spark, out, "").orderBy("start").collect()
    assert [r["doc_id"] for r in stored] == got


def test_every_operator_runs(spark):
    for name, query in __spark_entry__.queries().items():
        if name.startswith("op"):
            assert query(spark, SMALL).count() >= 0, name


def test_pipeline_runs(spark):
    docs = common.documents(spark, SMALL)
    found = corpus_pipeline.run(spark, SMALL)
    rows = sorted(found.collect(), key=lambda r: r["start"])
    assert 0 < len({r["doc_id"] for r in rows}) <= docs.count()
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
