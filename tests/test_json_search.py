"""The search in JSON texts against a walk in plain Python."""

import json
import random

import pytest

from ledgerline.sources import feed, json_search

KEYS = ["officials", "Officials", "name", "fullName", "a", "b.c", "it's", 'say "x"', "é", "", "z[0]", "$"]
WORDS = ["text", 'a "quoted", one: yes', '{"officials": [{"a": 1}]}', "[1, 2]", "", "back\\slash", "é, ü", "null"]


def made(r, depth):
    kind = r.random()
    if depth == 0 or kind < 0.15:
        return r.choice([*WORDS, 1, -2.5, 0, True, False, None, 12345678901])
    if kind < 0.7:
        return {k: made(r, depth - 1) for k in r.sample(KEYS, r.randint(0, 4))}
    return [made(r, depth - 1) for _ in range(r.randint(1, 3))]


def lists(x, path, key):
    if isinstance(x, dict):
        for k, v in x.items():
            if k.lower() == key and isinstance(v, list) and v and isinstance(v[0], dict):
                yield f"{path}.{k}", v
            yield from lists(v, f"{path}.{k}", key)
    elif isinstance(x, list):
        for i, v in enumerate(x):
            yield from lists(v, f"{path}[{i}]", key)


def snippets(x, path, words, width):
    if isinstance(x, dict):
        for k, v in x.items():
            if any(w in k.lower() for w in words):
                yield f"{path}.{k}", json.dumps(v, ensure_ascii=False)[:width]
            else:
                yield from snippets(v, f"{path}.{k}", words, width)
    elif isinstance(x, list):
        for i, v in enumerate(x):
            yield from snippets(v, f"{path}[{i}]", words, width)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    made_up = [made(r, r.randint(0, 6)) for _ in range(600)]
    return [(n, x, json.dumps(x, ensure_ascii=n % 2 == 0, indent=1 if n % 5 == 0 else None)) for n, x in enumerate(made_up)]


def frame(spark, texts):
    odd = [(-1, None), (-2, ""), (-3, "broken"), (-4, '{"officials": [{"a": 1}]'), (-5, "null"), (-6, '{"a": 1, "a": 2}')]
    return spark.createDataFrame([(n, t) for n, _, t in texts] + odd, "id long, json string")


def test_lists_as_a_walk_finds_them(spark, texts):
    found = json_search.found_lists(frame(spark, texts), "officials").collect()
    ours = sorted((r.id, tuple(r.at), r.path, json.dumps(json.loads(r.value))) for r in found)
    there = [(n, p, json.dumps(v)) for n, x, _ in texts for p, v in lists(x, "root", "officials")]
    assert [(n, p, v) for n, _, p, v in ours] == there and len(there) > 20


def test_keys_as_a_walk_finds_them(spark, texts):
    found = json_search.found_keys(frame(spark, texts), ["name", "say"], 30).collect()
    there = sorted((n, p, s) for n, x, _ in texts for p, s in snippets(x, "root", ["name", "say"], 30))
    assert sorted(tuple(r) for r in found) == there and len(there) > 50


def test_depth(spark):
    cases = {"1": 0, "[]": 1, '{"a": [{}]}': 3, '{"a}]": "[[[{"}': 1, '["\\"[[", [[]]]': 3, "[": 1, "": 0, '{"a": [{"b': 3}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert {r.t: r.d for r in df.select("t", json_search.depth("t").alias("d")).collect()} == cases


def test_deep_and_long_texts(spark):
    text = json.dumps({"a": [{"b": {"c": [[{"officials": [{"name": "x" * 100000 + '"' * 20000}]}]]}}]})
    df = spark.createDataFrame([(1, text)], "id int, json string")
    (one,) = json_search.found_lists(df, "officials").collect()
    assert one.path == "root.a[0].b.c[0][0].officials" and json.loads(one.value) == [{"name": "x" * 100000 + '"' * 20000}]
    (key,) = json_search.found_keys(df, ["name"], 100010).collect()
    assert key.snippet == json.dumps("x" * 100000 + '"' * 20000)[:100010]


def test_empty_table(spark):
    df = spark.createDataFrame([], "id int, json string")
    assert json_search.found_lists(df, "officials").collect() == [] and json_search.found_keys(df, ["a"], 3).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([("1", '{"gameInfo": {"officials": [{"id": 4}]}}')], "game_id string, json string").cache()
    df.count()
    plan = feed.official_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "UDTF" not in plan
    df.unpersist()


def test_the_first_list_as_written_counts(spark):
    person = lambda n: [{"displayName": n}]
    cases = {"1": {"z": {"officials": person("A")}, "b": {"officials": person("B")}},
        "2": {"z": {"officials": person("A")}, "gameInfo": {"officials": person("B")}}, "3": {"officials": [{"name": "C"}, "odd", None, {"id": 7}]}}
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "game_id string, json string")
    told = {(r.game_id, r.row_order, r.official_name, r.official_id) for r in feed.official_rows(df).collect()}
    assert told == {("1", 1, "A", "espn:a"), ("2", 1, "B", "espn:b"), ("3", 1, "C", "espn:c"), ("3", 4, "", "espn-athlete:7")}


def test_few_brackets_are_counted_and_many_followed(spark):
    """No text is searched less deep than its last marker stands; texts that aren't JSON ask for no levels."""
    cases = {'{"a": {"officials": [{"b": 1}]}}': 2, '{"a": {"officials": 1}, "b": [[[{"officials": [{}]}]]]}': 5, '{"a": "[[[", "officials": [{}]}': 1,
        "[" * 900 + '"officials"': 0, '{"a": [[[[{"\\u006ffficials": [{}]}]]]]}': 8}
    for text, least in cases.items():
        df = spark.createDataFrame([(text,)], "t string")
        got = json_search._levels(df, df.t, ['"officials"'])
        assert least <= got <= least + json_search.FEW_LEVELS, (text, got)


def test_persons_are_parsed_once_and_no_variant_is_made_for_plain_texts(spark):
    df = spark.createDataFrame([("1", '{"gameInfo": {"officials": [{"id": 4}]}}')], "game_id string, json string")
    told = feed.official_rows(df).groupBy("game_id").count()._jdf.queryExecution().optimizedPlan().toString()
    assert told.count("displayName,StringType") <= 1
    assert "CASE WHEN ((Contains" in told or "CASE WHEN (((Contains" in told
