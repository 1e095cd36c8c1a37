"""Decontamination: templates, words replaced at every step, clean documents, recall."""

import time

import numpy as np
import pytest

from ledgerline.llm import common, decontaminate

TEMPLATE = "which of the following statements is true about".split()


def frame(spark, texts, name):
    return spark.createDataFrame(list(enumerate(" ".join(t) for t in texts)), f"{name} long, text string")


def brute(item, weights, text):
    """Smith-Waterman in which what befalls a word of the item counts by its weight."""
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i in range(1, len(item) + 1):
        w = weights[i - 1]
        for j in range(1, len(text) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + w * (2 if item[i - 1] == text[j - 1] else -1), h[i - 1, j] - w, h[i, j - 1] - 1)
    return h.max() / (2 * sum(weights))


def found(spark, docs, items):
    docs, items = frame(spark, docs, "doc_id"), frame(spark, items, "item_id")
    return {(r["doc_id"], r["item_id"]): r["score"] for s in decontaminate.blocks(items) for r in decontaminate.leaks(docs, s).collect()}


@pytest.mark.parametrize("edit", ["replace", "drop", "double"])
@pytest.mark.parametrize("step", [2, 3, 4, 5])
def test_recall_at_every_step(spark, step, edit):
    """Natural frequencies: words by Zipf's law, so that items and documents share many runs."""
    draw = np.random.default_rng(step)
    word = lambda n: [f"w{k}" for k in np.minimum(draw.zipf(1.3, n), 5000)]
    items = [word(n) for n in (16, 30, 40, 60) for _ in range(5)]
    change = {"replace": lambda w: word(1), "drop": lambda w: [], "double": lambda w: [w, *word(1)]}[edit]
    texts = [word(80) + [x for k, w in enumerate(item) for x in (change(w) if k % step == step - 1 else [w])] + word(80) for item in items]
    got = found(spark, [*texts, *(word(200) for _ in range(20))], items)
    want = {(d, i): s for d, t in enumerate(texts) for i, item in enumerate(items) if (s := brute(item, [1] * len(item), t)) >= decontaminate.MIN_SCORE}
    assert all(got[key] == pytest.approx(want[key]) for key in got)
    assert not want or len(got) >= 0.9 * len(want)


def test_words_replaced_at_random(spark):
    draw = np.random.default_rng(1)
    items = [[f"i{k}x{j}" for j in range(40)] for k in range(60)]
    texts = [["noise"] * 30 + [w if draw.random() > 0.3 else "other" for w in item] + ["noise"] * 30 for item in items]
    want = {(k, k) for k in range(60) if brute(items[k], [1] * 40, texts[k]) >= decontaminate.MIN_SCORE}
    got = found(spark, texts, items)
    assert set(got) <= want and len(got) >= 0.95 * len(want) > 30


def templated(n):
    return [[*TEMPLATE, *(f"own{k}n{j}" for j in range(8))] for k in range(n)]


def test_a_template_is_no_copy(spark):
    items = templated(200)
    texts = [["some", "words", *TEMPLATE, "cats", "and", "dogs", "in", "the", "rain", "today", "again"], ["x", *items[7], "y"],
        [w if k % 4 else "other" for k, w in enumerate(items[9])], [*TEMPLATE, *items[3][8:11], "then", "else"], [*items[5][8:], "end"]]
    got = found(spark, texts, items)
    assert set(got) == {(1, 7), (2, 9), (4, 5)} and got[1, 7] == 1.0
    docs = frame(spark, texts, "doc_id")
    for seeds in decontaminate.blocks(frame(spark, items, "item_id")):
        docs = decontaminate.clean(docs, seeds)
    assert sorted(r["doc_id"] for r in docs.collect()) == [0, 3]


def test_a_template_of_many_items_costs_little(spark):
    (seeds,) = decontaminate.blocks(frame(spark, templated(20_000), "item_id"))
    ids = common.spoken(" ".join(["w"] * 500 + TEMPLATE + ["v"] * 500))
    decontaminate.copies(ids, seeds)
    began = time.perf_counter()
    assert decontaminate.copies(ids, seeds) == []
    assert time.perf_counter() - began < 0.1
    ids = common.spoken(" ".join(templated(20_000)[777]))
    ((item, score, _, _),) = decontaminate.copies(ids, seeds)
    assert seeds.names[item] == 777 and score == 1.0


def test_an_item_of_common_runs_only_keeps_them(spark):
    items = [[*TEMPLATE, f"own{k}"] for k in range(40)] + [TEMPLATE]
    got = found(spark, [["so", *TEMPLATE, "it"], ["no", "such", "thing"]], items)
    assert got[0, 40] == 1.0 and not any(d == 1 for d, _ in got)


def test_repeated_items_are_not_common(spark):
    item = [f"r{k}" for k in range(20)]
    got = found(spark, [["a", *item, "b"]], [item] * 50)
    assert got == {(0, k): 1.0 for k in range(50)}


def test_blocks_find_the_same(spark):
    items = templated(60)
    docs = frame(spark, [items[3], items[50], TEMPLATE], "doc_id")
    bench = frame(spark, items, "item_id")
    whole = [sorted((r["doc_id"], r["item_id"], r["score"]) for s in decontaminate.blocks(bench, size) for r in decontaminate.leaks(docs, s).collect())
        for size in (10**6, 100)]
    assert whole[0] == whole[1] == [(0, 3, 1.0), (1, 50, 1.0)] and len(list(decontaminate.blocks(bench, 100))) > 5


def test_the_stage_keeps_clean_documents_and_all_columns(spark, tmp_path):
    frame(spark, templated(30), "item_id").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = [" ".join(templated(30)[4]), None, "", "clean words only", " ".join(TEMPLATE), "x " * 5000 + " ".join(templated(30)[5])]
    docs = spark.createDataFrame([(k, t, "item", 1) for k, t in enumerate(texts)], "doc_id long, text string, item_id string, score int")
    left = decontaminate.stage(spark, docs, str(tmp_path))
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2, 3, 4]
