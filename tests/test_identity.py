"""Names two edits apart, and entities by sweep, against brute force."""

import random

import duckdb
import pytest

from ledgerline.operators import identity


def apart(names):
    c = duckdb.connect()
    c.execute("CREATE TABLE n AS SELECT DISTINCT unnest(?::VARCHAR[]) AS k", [list(names)])
    return set(c.sql("SELECT x.k, y.k FROM n x JOIN n y ON x.k < y.k AND abs(length(x.k) - length(y.k)) <= 2 AND levenshtein(x.k, y.k) <= 2").fetchall())


def found(spark, names):
    return {tuple(r) for r in identity.within_two_edits(spark.createDataFrame([(n,) for n in names], "k string")).collect()}


@pytest.mark.parametrize("letters,longest", [("ab", 7), ("abc", 10), ("aab-", 14), ("é∂a", 5)])
def test_within_two_edits_equals_all_pairs(spark, letters, longest):
    pick = random.Random(len(letters) * longest)
    # DuckDB counts bytes, so letters of several bytes are held against a plain rule
    names = {"".join(pick.choice(letters) for _ in range(pick.randrange(longest))) for _ in range(120)}
    if letters.isascii():
        assert found(spark, names) == apart(names)
    else:
        plain = {n: n.translate({ord("é"): "b", ord("∂"): "c"}) for n in names}
        back = {v: k for k, v in plain.items()}
        assert {tuple(sorted(p)) for p in found(spark, names)} == {tuple(sorted((back[a], back[b]))) for a, b in apart(plain.values())}


def test_a_common_prefix_gives_no_more_candidates_than_pairs(spark):
    names = [f"supplier-x-{k * 7919 % 100000:05}" for k in range(2000)]
    keys = spark.createDataFrame([(n,) for n in names], "k string")
    want = apart(names)
    one, two = identity._shortened(keys)
    # what meets, before anything is verified: each pair as often as it has ways, and no other
    met = one.join(one.withColumnsRenamed({"k": "b", "g": "h"}), "s").where("k < b").select("k", "b").union(
        two.join(two.withColumnsRenamed({"k": "b"}), ["s", "g", "h"]).where("k < b").select("k", "b"))
    assert {tuple(r) for r in met.distinct().collect()} == want == found(spark, names)


def test_long_keys_nulls_and_repeated_keys(spark):
    long = "x" * 150
    rows = [(long,), (long[:-2] + "yz",), (long + "q",), (None,), ("",), ("ab",), ("ab",), ("abc",), ("J R Smith",)]
    got = {tuple(r) for r in identity.near_duplicates(spark.createDataFrame(rows, "ref_key string")).collect()}
    near = "edit-distance<=2"
    assert {p for p in got if p[2] == near} == {("", "ab", near), ("ab", "abc", near), (long, long[:-2] + "yz", near), (long, long + "q", near)}


def test_what_is_left_of_the_keys_never_goes_through_the_driver(spark, tmp_path):
    spark.createDataFrame([("ab",), ("abc",)], "k string").write.parquet(f"{tmp_path}/keys")
    keys = spark.read.parquet(f"{tmp_path}/keys")  # a file's size is known, and small
    assert "BroadcastExchange" not in identity.within_two_edits(keys)._jdf.queryExecution().executedPlan().toString()
