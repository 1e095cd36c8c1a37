import gzip
import json

from pyspark.sql import functions as F

from ledgerline.sources import feed, readers, sinks, tables
from ledgerline.streaming import ingest


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def write(path, text, packed=True):
    path.write_bytes(gzip.compress(text.encode("utf-8-sig")) if packed else text.encode())
    return str(path)


def test_csv_keeps_zeros_and_order(spark, tmp_path):
    p = write(tmp_path / "games.csv.gz", "game_id,season,season_type,home_team_abbr,away_team_abbr,home_pts,away_pts,home_win\n0022300001,2023-24,Regular Season,gs,BOS,100,x,1\n0029900001,1999-00,Playoffs,NY,BOS,1,2,0\n")
    g = readers.games(spark, p)
    assert rows(g.select("game_id", "home_team_abbr", "home_pts", "away_pts", "era")) == [("0022300001", "GSW", 100.0, None, "nba")]
    o = write(tmp_path / "off.csv.gz", "game_id,official_id,official_name\n0022300001,b,B\n0022300001,a,A\n9,c,C\n")
    assert [r["official_id"] for r in readers.officials(spark, o, g).orderBy("row_order").collect()] == ["b", "a"]
    sinks.text_csv(g.select("game_id", "season"), str(tmp_path / "out"))
    assert rows(readers.text_csv(spark, str(tmp_path / "out"))) == [("0022300001", "2023-24")]


def test_logs_and_overrides(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    write(tmp_path / "logs/2000-01_RS.csv.gz", "game_id,player_id,min,pts,team_abbr\n1,1018.0,34:12,7,SA\n1,,1,1,SA\n")
    write(tmp_path / "logs/2001-02_RS.csv.gz", "game_id,player_id,min,pts,team_abbr\n2,5,10,oops,SA\n")
    assert rows(readers.player_logs(spark, str(tmp_path / "logs")).select("player_id", "min", "pts", "team_abbr")) == [("1018", 0.0, 7.0,
        "SAS"), ("5", 10.0, 0.0, "SAS")]
    p = write(tmp_path / "ov.csv", "# note\nraw_name_or_id,canonical_ref_key,canonical_display_name\n Ed Rush ,ed-rush,\n,x,y\n", packed=False)
    assert rows(readers.overrides(spark, p).select("probe", "to_key", "to_display")) == [("ed rush", "ed-rush", "")]


def test_widened_and_renamed(spark, tmp_path):
    a, b, c = (write(tmp_path / n, t, packed=False) for n, t in (("a.csv", "playerId,PTS\n1,2\n"), ("b.csv", "playerid,reb\n3,4\n"), ("c.csv", "team\nx\n")))
    df, skipped = readers.widened(spark, [a, b, c], ["playerid"])
    assert skipped == [c] and df.count() == 2 and "reb" in df.columns
    assert readers.renamed(df, {"pts": ["pts"], "none": ["zzz"]}).columns == ["pts", "none"]


def test_extracted_games(spark):
    df = spark.createDataFrame([("22300001.0", "2023-11-01", "22023", "", "1", "2", "W", 5.0, 9.0),
        ("22300002", "x", "", "", "1", "2", None, 5.0, 9.0)],
        "GAME_ID string, GAME_DATE string, SEASON_ID string, SEASON_TYPE string, HOME_TEAM_ID string, AWAY_TEAM_ID string, WL_HOME string, PTS_HOME double, PTS_AWAY double")
    got = rows(readers.extracted_games(df).select("game_id", "season", "season_type", "home_win"))
    assert got == [("0022300001", "2023-24", "Regular Season", 1), ("0022300002", "2023-24", "Regular Season", 0)]
    teams = spark.createDataFrame([("1", "ATL"), ("2", "BOS")], "team_id string, team_abbr string")
    assert rows(readers.with_team_codes(readers.extracted_games(df), teams).select("home_team_abbr", "away_team_abbr"))[0] == ("ATL", "BOS")


def test_calendar(spark):
    s = spark.createDataFrame([("2000-01", "2000-10-30", "2000-11-02")], "season string, first string, last string")
    done = spark.createDataFrame([("2000-10-31",)], "d string").select(F.to_date("d").alias("day"))
    assert readers.season_days(spark, s, done, F.lit("2000-11-01").cast("date")).count() == 2
    assert [r[0] for r in readers.season_labels(spark, 1999, F.lit("2001-09-30").cast("date")).collect()] == ["1999-00", "2000-01"]


def test_swap_and_stale(spark, tmp_path):
    path = str(tmp_path / "t")
    kind = "game_id string, season string, v int"
    sinks.upserted(spark, path, spark.createDataFrame([("0022300001", "2012-13", 1), ("x", "2012-13", 1)], kind), ["game_id"], "v")
    sinks.upserted(spark, path, spark.createDataFrame([("x", "2012-13", 2)], kind), ["game_id"], "v")
    assert rows(spark.read.parquet(path).select("game_id", "v")) == [("0022300001", 1), ("x", 2)]
    assert sinks.without_stale(spark, path, ["2012-13"]) == 1 and sinks.without_stale(spark, path, ["2012-13"]) == 0


EVENT = {
    "id": "401", "date": "2001-11-02T01:00Z", "name": "X at Y", "season": {"type": 2}, "status": {"type": {"completed": True}},
    "competitions": [{"competitors": [{"homeAway": "home", "score": "99", "winner": True, "team": {"id": "1", "abbreviation": "GS"}},
    {"homeAway": "away", "score": "90", "team": {"id": "2", "abbreviation": "BOS"}}]}],
}
SUMMARY = {
    "gameInfo": {"officials": [{"displayName": "Ed F. Rush"}, {"fullName": "Al B", "id": "7", "jersey": "12.0"}]}, "officials": [{"name": "other"}],
    "boxscore": {"players": [{"team": {"id": "1", "abbreviation": "GS"},
    "statistics": [{"names": ["MIN", "FG", "PTS", "+/-"],
    "athletes": [{"athlete": {"id": "5", "displayName": "P"}, "stats": ["30", "4-9", "11", "-3"]},
    {"didNotPlay": True, "athlete": {"id": "6"}, "stats": ["1"]}]}]}]},
    "header": {"competitions": [{"notes": [{"headline": "Finals - Game 7"}]}]},
}


def test_feed_parsing(spark):
    board = spark.createDataFrame([(json.dumps({"events": [EVENT, EVENT | {"id": "402", "name": "Play-In Game"},
        EVENT | {"id": "403", "season": {"type": 1}}]}),)], "json string")
    g = feed.game_rows(feed.events(board), F.lit("2001-02"))
    assert rows(g.select("game_id", "season_type", "home_team_abbr", "home_pts", "home_win", "completed")) == [("401", "Regular Season",
        "GSW", "99", "1", True), ("402", "Play-In", "GSW", "99", "1", True)]
    s = spark.createDataFrame([("401", json.dumps(SUMMARY)), ("402", "{}"), ("403", "broken")], "game_id string, json string")
    assert rows(feed.player_rows(s).select("player_id", "team_abbr", "min", "pts", "fgm", "fga", "plus_minus", "reb")) == [("5", "GSW",
        "30", "11", "4", "9", "-3", "")]
    assert rows(feed.official_rows(s).select("official_id", "official_name", "jersey_num")) == [("espn-athlete:7", "Al B", "12"),
        ("espn:ed-f-rush", "Ed F. Rush", "")]
    assert rows(feed.notes(s))[0] == ("401", "Finals - Game 7")
    assert rows(feed.presence(s)) == [("401", 2, 1), ("402", 0, 0), ("403", 0, 0)]


def test_feed_source_reads_urls(spark, tmp_path):
    p = tmp_path / "a.json"
    p.write_text('{"x": 1}')
    feed.register(spark)
    df = spark.read.format("feed").option("urls", json.dumps([p.as_uri(), (tmp_path / "none").as_uri()])).option("retries", "1").load()
    assert sorted((r["json"] or "") for r in df.collect()) == ["", '{"x": 1}']


def test_stream_of_payloads(spark, tmp_path):
    (tmp_path / "in").mkdir()
    out, check = str(tmp_path / "games"), str(tmp_path / "check")
    for n, score in (("1", "99"), ("2", "101")):
        event = json.loads(json.dumps(EVENT))
        event["competitions"][0]["competitors"][0]["score"] = score
        (tmp_path / f"in/{n}.json").write_text(json.dumps({"events": [event]}))
        q = ingest.run(ingest.payloads(spark, str(tmp_path / "in")), ingest.merge_games(out, "2001-02"), check)
        q.awaitTermination(120)
        assert q.exception() is None
    assert rows(tables.stored(spark, out).select("game_id", "home_pts")) == [("401", "101")]
