"""Tables in partitions: what a merge touches, lost drivers, writers at once."""

import pathlib

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import merge
from ledgerline.sources import tables

KIND = "game_id string, season string, season_type string, v int"


def frame(spark, *rows):
    return spark.createDataFrame(rows, KIND)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet")}


@pytest.fixture
def games(spark, tmp_path):
    path = str(tmp_path / "games")
    tables.upserted(spark, path, frame(spark, *((f"{s}{k:03}", f"20{s}-x", kind, k) for s in ("01", "02", "03") for kind in ("RS", "PO") for k in range(4))), ["game_id", "season_type"])
    return path


def test_a_merge_leaves_other_seasons_alone(spark, games):
    before = files(games)
    tables.upserted(spark, games, frame(spark, ("02001", "2002-x", "RS", 100), ("02900", "2002-x", "RS", 101)), ["game_id", "season_type"], "v")
    after = files(games)
    kept = {f for f in before if "season=2002-x" not in f}
    assert kept and all(after.get(f) == before[f] for f in kept)
    got = {(g, t): v for g, _, t, v in rows(tables.stored(spark, games))}
    # the game is replaced in the other kind, too, where it had a row
    assert got[("02001", "RS")] == 100 and got[("02900", "RS")] == 101 and ("02001", "PO") not in got and len(got) == 24


def test_a_game_moves_to_another_season(spark, games):
    before = files(games)
    tables.upserted(spark, games, frame(spark, ("01002", "2003-x", "PO", 7)), ["game_id"])
    assert [r for r in rows(tables.stored(spark, games)) if r[0] == "01002"] == [("01002", "2003-x", "PO", 7)]
    assert all(files(games).get(f) == t for f, t in before.items() if "2002-x" in f or "2003-x/season_type=RS" in f)


def test_equal_to_the_plain_merges(spark, tmp_path):
    stored = [(f"g{k % 7}", f"s{k % 3}", "RS" if k % 2 else None, k) for k in range(14)] + [(None, None, "RS", 50)]
    more = [("g1", "s1", "RS", 90), ("g1", "s2", None, 91), ("new", "s9", "a/b =%", 92), (None, "s1", "RS", 93), (None, None, None, 94)]
    for first in (True, False):
        for name, plain in (("up", lambda o, n: merge.upsert(o, n, "game_id", ["game_id", "season"], "v")), ("app", lambda o, n, f=first: merge.appended(o, n, ["game_id", "season"], "v", first=f))):
            path = str(tmp_path / f"{name}{first}")
            tables.merged(spark, path, frame(spark, *stored), lambda o, n: o.unionByName(n))
            tables.merged(spark, path, frame(spark, *more), plain)
            assert rows(tables.stored(spark, path)) == rows(plain(frame(spark, *stored), frame(spark, *more)))


def test_flushes_lose_no_row(spark, tmp_path):
    path = str(tmp_path / "t")
    own = frame(spark, *((f"{k:03}", "s", "RS", k) for k in range(60)), (None, "s", "RS", 1))
    tables.appended(spark, path, own, ["game_id"], "v", flush=25)
    tables.appended(spark, path, own, ["game_id"], "v", flush=25)
    assert rows(tables.stored(spark, path)) == rows(own) and tables.manifest(spark, path).version > 2


@pytest.mark.parametrize("at", ["_written", "_commit", "vacuum"])
def test_a_lost_driver_leaves_the_table_before_or_after(spark, games, monkeypatch, at):
    before = rows(tables.stored(spark, games))
    whole = getattr(tables, at)

    def lost(*args):
        if at == "_written":
            whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, at, lost)
    with pytest.raises(RuntimeError):
        tables.upserted(spark, games, frame(spark, ("03001", "2003-x", "RS", 55)), ["game_id"])
    monkeypatch.setattr(tables, at, whole)
    now = rows(tables.stored(spark, games))
    assert (now == before) == (at != "vacuum")
    tables.upserted(spark, games, frame(spark, ("03001", "2003-x", "RS", 55)), ["game_id"])
    assert [r[3] for r in rows(tables.stored(spark, games)) if r[0] == "03001"] == [55]
    monkeypatch.setattr(tables, "ORPHAN_HOURS", 0)
    tables.vacuum(spark, games)
    used = {p.folder for v in tables._versions(spark, games) for p in tables._read(spark, games, v).parts}
    assert {f.rsplit("/", 1)[0] for f in files(games)} == used


def test_two_writers_lose_no_merge(spark, games, monkeypatch):
    whole, calls = tables._written, []

    def slower(df, path, now):
        if not calls:
            calls.append(1)
            tables.upserted(spark, path, frame(spark, ("03003", "2003-x", "RS", 77)), ["game_id"])
        return whole(df, path, now)

    monkeypatch.setattr(tables, "_written", slower)
    tables.upserted(spark, games, frame(spark, ("03002", "2003-x", "RS", 66)), ["game_id"])
    got = {r[0]: r[3] for r in rows(tables.stored(spark, games))}
    assert got["03002"] == 66 and got["03003"] == 77


def test_a_batch_is_merged_once(spark, games):
    add = lambda o, n: o.unionByName(n)
    for number in (0, 0, 1, 0):
        tables.merged(spark, games, frame(spark, ("x", "2001-x", "RS", number)), add, batch=("stream", number))
    assert [r[3] for r in rows(tables.stored(spark, games)) if r[0] == "x"] == [0, 1]


def test_stale_rows_go_from_their_seasons_only(spark, tmp_path):
    path = str(tmp_path / "t")
    own = [("0022300001", "2012-13", "RS", 1), ("401", "2012-13", "RS", 1), ("0022300001", "2013-14", "RS", 1), ("400", "2012-13", "PO", 1)]
    tables.merged(spark, path, frame(spark, *own), lambda o, n: n)
    before = files(path)
    assert tables.without_stale(spark, path, ["2012-13"]) == 1 and tables.without_stale(spark, path, ["2012-13"]) == 0
    assert rows(tables.stored(spark, path)) == sorted([own[1], own[2], own[3]], key=str)
    assert all(files(path)[f] == t for f, t in before.items() if "2013-14" in f or "PO" in f)
    assert tables.removed(spark, path, F.col("v") == 1) == 3 and rows(tables.stored(spark, path)) == []


def test_columns_may_be_added(spark, games):
    wide = frame(spark, ("01000", "2001-x", "RS", 5)).withColumn("more", F.lit("m"))
    tables.merged(spark, games, wide, lambda o, n: merge.upsert(o, n, "game_id", ["game_id"]))
    got = tables.stored(spark, games)
    assert {r["more"] for r in got.collect()} == {None, "m"}
    assert tables.stored(spark, games, lambda p: p.values[0] == "2001-x").where("more = 'm'").count() == 1
