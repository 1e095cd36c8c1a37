"""Columns by name, broken swaps, payload shapes, folding, sweeps, reports and nested checks."""

import itertools
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import scalars as X
from ledgerline.operators import boards, documents, identity, quality, reports, serve
from ledgerline.sources import feed, readers, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_columns_come_by_name_in_each_file(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs/2000-01_RS.csv").write_text("game_id,player_id,min,pts\n1,5,7,10\n")
    (tmp_path / "logs/2001-02_RS.csv").write_text("game_id,player_id,pts,min,reb\n2,5,10,7,3\n")
    got = rows(readers.player_logs(spark, str(tmp_path / "logs")).select("game_id", "min", "pts", "reb"))
    assert got == [("1", 7.0, 10.0, 0.0), ("2", 7.0, 10.0, 3.0)]
    assert rows(readers.player_logs(spark, str(tmp_path / "logs/*_RS.csv")).select("min", "pts")) == [(7.0, 10.0)] * 2


def test_byte_order_mark(spark, tmp_path):
    import gzip
    import pathlib

    sinks.text_csv(spark.createDataFrame([("0022300001", "é")], "game_id string, name string").coalesce(1), str(tmp_path / "o"))
    (part,) = pathlib.Path(tmp_path / "o").glob("part-*.gz")
    assert gzip.decompress(part.read_bytes()).startswith(b"\xef\xbb\xbfgame_id,name")
    assert rows(readers.text_csv(spark, str(tmp_path / "o"))) == [("0022300001", "é")]


@pytest.mark.parametrize("lost", ["before the new one is in place", "while the new one is written"])
def test_a_lost_driver_loses_no_table(spark, tmp_path, lost):
    path = tmp_path / "t"
    kind = "game_id string, v int"
    sinks.upserted(spark, str(path), spark.createDataFrame([("a", 1), ("b", 1)], kind), ["game_id"], "v")
    if lost.startswith("before"):
        spark.createDataFrame([("a", 1), ("b", 2)], kind).write.parquet(f"{path}.new")
        path.rename(f"{path}.old")
    else:
        (tmp_path / "t.new/_temporary").mkdir(parents=True)
    sinks.upserted(spark, str(path), spark.createDataFrame([("c", 3)], kind), ["game_id"], "v")
    assert rows(spark.read.parquet(str(path))) == [("a", 1), ("b", 2 if lost.startswith("before") else 1), ("c", 3)]
    assert not (tmp_path / "t.old").exists() and not (tmp_path / "t.new").exists()


def test_append_in_flushes(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "game_id string, official_id string, v int"
    for flush in (None, 25):
        sinks.appended(spark, path, spark.createDataFrame([(f"{k:03}", "x", flush or 0) for k in range(40 if flush else 30)], kind),
            ["game_id", "official_id"], "v", flush=flush)
    got = rows(spark.read.parquet(path))
    assert len(got) == 40 and [r[2] for r in got] == [0] * 30 + [25] * 10


def test_one_file_a_document_and_arrays(spark, tmp_path):
    import pathlib

    df = spark.createDataFrame([("b", 2, None), ("a", 1, "é")], "slug string, n int, t string")
    docs = df.withColumn("document", documents.as_json(df, "slug", "n", "t"))
    for _ in range(2):
        sinks.documents(docs, str(tmp_path / "d"))
    (one,) = pathlib.Path(tmp_path / "d/slug=a").glob("part-*")
    assert json.loads(one.read_text()) == {"slug": "a", "n": 1, "t": "é"}
    many = spark.range(1000).select(F.format_string("s%04d", "id").alias("slug"), F.lit(None).cast("string").alias("x"))
    for table, want in ((many, 1000), (many.limit(0), 0), (many.limit(1), 1)):
        sinks.json_array(table, str(tmp_path / "i"), ["slug"], "slug", "x")
        text = "\n".join(p.read_text() for p in sorted(pathlib.Path(tmp_path / "i").glob("part-*")))
        found = json.loads(text)
        assert [r["slug"] for r in found] == [f"s{k:04}" for k in range(want)] and all(r["x"] is None for r in found)


def test_catalog_tables(spark):
    spark.createDataFrame([("1", "2", 3)], "GAME_ID string, PLAYER_ID string, PTS int").createOrReplaceTempView("boxes")
    got = {r["table"]: r for r in readers.database_tables(spark).collect()}["boxes"]
    assert got["columns"] == ["GAME_ID", "PLAYER_ID", "PTS"] and got["rows"] == 1
    assert readers.database_table(spark, "boxes", ["PTS"]).columns == ["PTS"]
    assert readers.locate_box({"boxes": ["GAME_ID", "PLAYER_ID", "PTS", "REB", "MIN", "FTA"], "x": ["a"]}) == "boxes"
    assert readers.locate_officials({"people": ["OFFICIAL_ID"], "bridge": ["GAME_ID", "OFFICIAL_ID", "FIRST_NAME", "JERSEY_NUM"]}) == "bridge"


def test_extracted_logs(spark):
    df = spark.createDataFrame([("22300001.0", "7.0", " A B ", "34:12", "x", "5"), ("", "8", "C", "", "1", "2")],
        "GAME_ID string, PERSON_ID string, PLAYER_NAME string, MIN string, PTS string, REB string")
    got = readers.extracted_logs(df)
    assert got.columns == list(readers.BOX_COLUMNS)
    assert rows(got.select("game_id", "player_id", "player_name", "min", "pts", "reb", "ast")) == [("0022300001", "7", "A B", "34:12", None, 5.0, None)]


def test_officials_of_the_other_payload(spark):
    person = {"personId": 7, "firstName": "Ed", "familyName": "Rush", "jerseyNum": "12 "}
    table = {"name": "Officials", "headers": ["OFFICIAL_ID", "FIRST_NAME", "LAST_NAME", "JERSEY_NUM"],
        "rowSet": [["9", "Al", "B", "3"], ["10", "Cy", "D", None]]}
    payloads = [
        ("22300001", {"boxScoreSummary": {"officials": [person, {"name": "No Id"}, {"personId": "8", "name": "Whole Name"}]}, "resultSets": [table]}),
        ("22300002", {"boxScoreSummary": {"officials": []}, "resultSets": [{"name": "Other", "headers": ["A"], "rowSet": [["1"]]}, table]}),
        ("22300003", {"BoxScoreSummary": {"Officials": [{"PERSON_ID": "5", "name": "Up"}]}}), ("22300004", {}),
    ]
    df = spark.createDataFrame([(g, json.dumps(p)) for g, p in payloads] + [("22300005", "broken")], "game_id string, json string")
    assert rows(feed.summary_official_rows(df).select("game_id", "row_order", "official_id", "official_name", "jersey_num")) == [
        ("0022300001", 0, "7", "Ed Rush", "12"), ("0022300001", 2, "8", "Whole Name", ""), ("0022300002", 0, "9", "Al B", "3"),
        ("0022300002", 1, "10", "Cy D", ""), ("0022300003", 0, "5", "Up", ""),
    ]


def test_league_logs(spark):
    payload = {"resultSets": [{"name": "LeagueGameLog", "headers": ["GAME_ID", "PLAYER_ID", "TEAM_ABBREVIATION", "PTS"],
        "rowSet": [["22300001", 7, "GSW", 10], ["22300002", 8, "BOS", None]]}]}
    df = spark.createDataFrame([("2023-24", "RS", json.dumps(payload)), ("2023-24", "PO", '{"resultSets": []}')], "season string, kind string, json string")
    got = feed.league_log_rows(df)
    assert rows(got.select("season", "kind", "game_id", "player_id", "team_abbr", "pts", "stl")) == [("2023-24", "RS", "0022300001", "7",
        "GSW", "10", ""), ("2023-24", "RS", "0022300002", "8", "BOS", "", "")]
    seasons = spark.createDataFrame([("2022-23",), ("2023-24",)], "season string")
    assert rows(feed.wanted_logs(seasons, got)) == [("2022-23", "PO"), ("2022-23", "RS"), ("2023-24", "PO")]


def test_feed_days_are_utc_in_any_zone(spark):
    board = spark.createDataFrame([(json.dumps({"events": [{"id": "1", "date": "2001-11-02T01:00Z", "season": {"type": 2},
        "competitions": [{"competitors": [{"homeAway": "home", "team": {}}, {"homeAway": "away", "team": {}}]}]}]}),)], "json string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert feed.game_rows(feed.events(board), F.lit("2001-02")).first()["game_date"] == "2001-11-02"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_folding_is_unicode_s(spark):
    names = ["Nikola Đurišić", "Vlade Divać", "José ﬁn", "𝐁old Ⅻ½", "plain", "王", "", "Ǆ ŉ", "áë", None, "Ångström ①"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", X.without_accents("n").alias("f"))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    for n, f in df.collect():
        assert f == (None if n is None else unicodedata.normalize("NFKD", n).encode("ascii", "ignore").decode())


def test_entities_are_those_of_brute_force(spark):
    draw = random.Random(12)
    table, label = [], {}
    for key in range(400):
        segs = []
        for k in range(draw.randint(1, 9)):
            a = draw.randint(2000, 2020)
            segs.append((a, f"{key}-s{k}", draw.choice(["nba", "espn", "third"][: 2 + key % 2]), a + draw.randint(0, 5)))
        own = {s[1]: s[1] for s in segs}
        for _ in segs:
            for (a, p, e, b), (c, q, f, d) in itertools.combinations(segs, 2):
                meet = c <= b + 2 if a <= c else a <= d + 2
                if e != f and meet:
                    low, old = min(own[p], own[q]), {own[p], own[q]}
                    own = {k: low if v in old else v for k, v in own.items()}
        label |= own
        table += [(seg, f"key{key}", era, a, b) for a, seg, era, b in segs]
    df = spark.createDataFrame([*table, ("x", None, "nba", 2000, 2001), ("y", None, "espn", 2000, 2001), ("z", "key1", "nba", None, None)],
        "seg_id string, name_key string, era string, smin int, smax int")
    found = identity.entity_of(df)
    assert dict(found.collect()) == label | {"x": "x", "y": "y", "z": "z"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan


def test_a_name_with_very_many_segments(spark):
    table = [(f"s{k:05}", "one", "nba" if k % 2 else "espn", 1950 + k % 60, 1950 + k % 60 + k % 3) for k in range(20_000)]
    df = spark.createDataFrame(table, "seg_id string, name_key string, era string, smin int, smax int")
    assert {c for _, c in identity.entity_of(df).collect()} == {"s00000"}


def test_chains_of_segments(spark):
    kind = "seg_id string, name_key string, era string, smin int, smax int"
    df = spark.createDataFrame([("a", "k", "nba", 2000, 2001), ("b", "k", "espn", 2003, 2004), ("c", "k", "nba", 2006, 2007),
        ("d", "k", "nba", 2010, 2011), ("e", "k2", "espn", 2010, 2011)], kind)
    assert rows(identity.entity_of(df)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d"), ("e", "e")]


def test_reports(spark):
    df = spark.createDataFrame([(v,) for v in ["GS", " GS", "BOS", "", None, "zz"]], "code string")
    assert reports.value_report(df, "code").collect() == [("BOS", None), ("GS", None), ("zz", None)]
    assert reports.value_report(df, "code", 2).collect() == [("GS", 2), ("BOS", 1), ("zz", 1)]
    assert rows(reports.team_code_report(df, "code")) == [("BOS", "BOS", True, False), ("GS", "GSW", True, True), ("zz", "ZZ", False, False)]
    games = spark.createDataFrame([("1", "2000-01", "P"), ("2", "2000-01", "P"), ("3", None, "R")], "game_id string, season string, season_type string")
    officials, logs = (spark.createDataFrame([(g,) for g in ids], "game_id string") for ids in ("112", "1223"))
    assert sorted(str(tuple(r)) for r in reports.run_counters(games, officials, logs).collect()) == sorted(map(str,
        [("2000-01", "P", 2, 3, 3), (None, "R", 1, 0, 1)]))
    assert rows(reports.without_seasons(games, ["2000-01"])) == [("3", None, "R")] and reports.without_seasons(games, []).count() == 3
    many = spark.range(1000)
    one, two, other = (sorted(r[0] for r in reports.seeded_sample(many.repartition(n), 20, seed).collect()) for n, seed in ((3, 0), (7, 0), (3, 1)))
    assert one == two != other and len(one) == 20
    logs = spark.createDataFrame([("0022300001",), ("0042200001",), ("0012200001",), ("0022200002",), ("",)], "game_id string")
    assert rows(reports.converted_logs(logs, ["2023-24"]).select("game_id", "season", "kind")) == [("0022200002", "2022-23", "RS"),
        ("0042200001", "2022-23", "PO")]


def test_nan_at_any_depth(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, [1.0, nan], (nan, [{"k": nan}, {"k": 2.0}]), {"a": [nan, None]}), (None, None, None, None)],
        "a double, b array<double>, c struct<x:double,y:array<map<string,double>>>, d map<string,array<float>>")
    assert quality.nan_count(df).first()[0] == 5
    assert quality.nan_count(df.limit(0)).first()[0] == 0


def test_views_are_compared(spark):
    swing = {"slug": "p", "n_games": 20, "pts_with_ref": 1.0, "pts_baseline": 0.5, "pts_swing": 0.5}
    record = {"games": 12, "wins": 5, "avg_margin_for_team": -1.25}
    doc = lambda slug, d: (slug, json.dumps(d))
    kind = "slug string, document string"
    refs = spark.createDataFrame([doc("r", {"player_swings": [swing], "team_records": [record | {"team_abbr": "T01"}]})], kind)
    for change, want in ((0.0, [("player_splits", 1, 0), ("team_records", 1, 0)]), (0.25, [("player_splits", 1, 1), ("team_records", 1, 1)])):
        players = spark.createDataFrame([doc("p", {"ref_splits": [swing | {"ref_slug": "r", "pts_swing": 0.5 + change}]})], kind)
        teams = spark.createDataFrame([doc("t01",
            {"summary": {"tricode": "T01"}, "ref_records": [record | {"ref_slug": "r", "avg_margin_for_team": -1.25 + change}]})], kind)
        assert rows(quality.view_mismatches(refs, players, teams)) == want


def test_gap_phrases(spark):
    df = spark.createDataFrame([(["2001-02"],), (["2005-06", "2012-13"],), (["2000-01", "2012-13", "2024-25"],), (["2010-11"],)], "s array<string>")
    assert [r[0] for r in df.select(serve.gap_phrase("s")).collect()] == [
        "the 2000-01 to 2002-03 seasons", "the 2012-13 season", "the 2000-01 to 2002-03 seasons, the 2012-13 season, and the 2023-24 season onward", None,
    ]


def test_pages(spark):
    kind = "slug string, name string, games_total long, first_season string, last_season string, seasons array<string>, ref_records array<struct<ref_name:string,games:long,wins:long,losses:long,win_pct:double,avg_margin_for_team:double>>"
    df = spark.createDataFrame([("ed", "Ed <R>", 1234, "2000-01", "2003-04", ["2001-02"], [("Al & B", 3, 2, 1, 0.67, -1.5)])], kind)
    (html,) = serve.person_pages(df, {"Teams": serve.record_table("ref_records", "ref_name")}, "seasons").select("html").first()
    for part in ("<title>Ed &lt;R&gt;</title>", "1,234 g · 2000-2004", "Labels are incomplete in the 2000-01 to 2002-03 seasons.",
            "<h2>Teams</h2>", "Al &amp; B", "67.0%", 'class="sw s-neg-2"'):
        assert part in html, part
    made = spark.createDataFrame([("most", "b", 5.0), ("most", "a", 9.0)], "board string, ref_key string, value double")
    (html,) = serve.index_page(made).first()
    assert html.index(">a<") < html.index(">b<") and "<h2>most</h2>" in html
    cover = spark.createDataFrame([("2000-01", "nba", 3, 66.67)], "season string, era string, games long, coverage double")
    assert "2000-01" in serve.sources_page(cover).first()[0] and "66.7" in serve.sources_page(cover).first()[0]


def test_board_document(spark):
    made = spark.createDataFrame([("most_x", "a", 5.0, None), ("most_x", "b", 9.0, None), ("lowest_y", "a", 2.0, 7),
        ("lowest_y", "b", 1.0, 8)], "board string, ref_key string, value double, n long")
    names = spark.createDataFrame([("a", "A"), ("b", "B")], "ref_key string, display string")
    found = json.loads(boards.board_document(made, names, 200, "2025-26").first()[0])
    assert found["_meta"] == {"min_games_for_rate_leaderboards": 200, "current_season": "2025-26"}
    assert [r["official_id"] for r in found["most_x"]] == [r["official_id"] for r in found["lowest_y"]] == ["b", "a"]
    assert json.loads(boards.board_document(made.limit(0), names).first()[0])["_meta"]["current_season"]
