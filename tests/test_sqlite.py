"""SQLite files: the catalog, ranges, columns and filters."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import readers, sqlite


@pytest.fixture(scope="module")
def path(tmp_path_factory):
    own = str(tmp_path_factory.mktemp("db") / "a b%20c.sqlite")
    c = sqlite3.connect(own)
    c.execute('CREATE TABLE game ("game id" TEXT, pts INTEGER, ratio REAL, raw BLOB, any, name VARCHAR(9) COLLATE NOCASE)')
    c.executemany("INSERT INTO game VALUES (?, ?, ?, ?, ?, ?)", [(f"00{k:04}", k, k / 4, bytes([k % 256]), k, "Ab" if k % 2 else "aB") for k in range(1000)])
    c.executemany("INSERT INTO game VALUES (?, ?, ?, ?, ?, ?)", [(None, "n/a", "x", "text", b"blob", None), (b"\xff12", None, None, None, None, "é"), ("z", 2**62, 1e300, None, "t", 5)])
    c.execute("DELETE FROM game WHERE pts BETWEEN 100 AND 300")
    c.execute("CREATE TABLE empty (a INTEGER)")
    c.execute("CREATE TABLE keyed (k TEXT PRIMARY KEY, v INTEGER) WITHOUT ROWID")
    c.executemany("INSERT INTO keyed VALUES (?, ?)", [("a", 1), ("b", 2)])
    c.execute('CREATE VIEW "v iew" AS SELECT pts FROM game WHERE pts < 10')
    c.commit()
    c.close()
    return own


def test_the_catalog(spark, path):
    got = {r["table"]: (r["columns"], r["rows"]) for r in readers.database_tables(spark, path=path).collect()}
    assert got == {"game": (["game id", "pts", "ratio", "raw", "any", "name"], 802), "empty": (["a"], 0), "keyed": (["k", "v"], 2), "v iew": (["pts"], 10)}


def test_ranges_hold_every_row_once(spark, path):
    for n in (1, 3, 16):
        df = readers.database_table(spark, "game", path=path, partitions=n)
        assert df.rdd.getNumPartitions() == n and df.count() == 802
        assert df.agg(F.sum("pts")).first()[0] == sum(k for k in range(1000) if not 100 <= k <= 300) + 2**62
    assert [readers.database_table(spark, t, path=path).count() for t in ("empty", "keyed", "v iew")] == [0, 2, 10]


def test_values_of_another_kind(spark, path):
    rows = readers.database_table(spark, "game", path=path).where("`game id` IS NULL OR `game id` LIKE '%12' AND length(`game id`) = 3 OR `game id` = 'z'").collect()
    by = {r["game id"]: r for r in rows}
    assert by[None]["pts"] is None and by[None]["ratio"] is None and by[None]["raw"] == b"text" and by[None]["any"] == "blob"
    assert by["z"]["pts"] == 2**62 and by["z"]["name"] == "5" and by["z"]["any"] == "t" and by["�12"]["pts"] is None


CONDITIONS = ["pts > 990", "pts >= 5 AND pts <= 7", "ratio < 1.5", "pts IN (1, 2, 500)", "`game id` = '000007'", "`game id` > '000990'", "name = 'Ab'", "name > 'aA'",
    "`game id` IS NULL", "pts IS NULL", "pts IS NOT NULL", "name IS NOT NULL AND pts < 3", "any = '7'", "NOT pts > 3", "name LIKE 'é%'", "ratio = 1", "raw = X'07'"]


@pytest.mark.parametrize("condition", CONDITIONS)
def test_filters_change_no_result(spark, path, condition):
    whole = spark.createDataFrame(
        readers.database_table(spark, "game", path=path).collect(), readers.database_table(spark, "game", path=path).schema)
    key = lambda df: sorted(map(str, df.where(condition).collect()))
    assert key(readers.database_table(spark, "game", path=path)) == key(whole)


def test_filters_and_columns_reach_the_file(path):
    from pyspark.sql import types as T
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNotNull, StringContains

    reader = sqlite.SqliteReader(path, "game", T.StructType([T.StructField("pts", T.LongType()), T.StructField("name", T.StringType())]), 2)
    filters = [GreaterThan(("pts",), 990), IsNotNull(("name",)), EqualTo(("name",), "Ab"), StringContains(("name",), "b")]
    left = list(reader.pushFilters(filters))
    assert left == [filters[0], filters[2], filters[3]] and len(reader.conditions) == 3
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert {r for r in rows if isinstance(r[0], int)} == {(k, "Ab") for k in range(991, 1000, 2)}  # and what has other kinds of values


def test_pushed_filters_are_in_the_plan(spark, path):
    df = readers.database_table(spark, "game", ["pts", "name"], path=path).where("pts > 990 AND name IS NOT NULL")
    assert df.columns == ["pts", "name"] and df.count() == 10  # the last has a number as its name
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(name" not in plan.lower()  # the source has taken it


def test_an_unknown_table(spark, path):
    with pytest.raises(Exception, match="no table"):
        readers.database_table(spark, "nothing", path=path)


def test_locating_tables_of_a_file(spark, path):
    found = {r["table"]: r["columns"] for r in readers.database_tables(spark, path=path).collect()}
    assert readers.locate(found, [["gameid"], ["pts"]], 2) == "game"
