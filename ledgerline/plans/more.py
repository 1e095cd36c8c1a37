"""Further registered queries: scalar rules, reports, payload parsing, documents row by row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import boards, crew, documents, identity, merge, playoffs, profiles, quality, reports, serve
from ..sources import feed, json_search, readers, shared
from .analog import Analog

CURRENT, LEAST = "2000-01", 20


def _pick(key: Column, *values: str | None) -> Column:
    """One of the values, by key modulo their number."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (key % len(values) + 1).cast("int"))


def _names(t: Analog) -> DataFrame:
    return identity.display_names(t.crew, "ref_key", "official_name")


def _careers(t: Analog) -> DataFrame:
    return profiles.careers(t.crew, t.schedule, CURRENT)


# scalar rules --------------------------------------------------------------------


def text_rules(t: Analog) -> DataFrame:
    """The feed's slugs, names without initials, accents and blanks."""
    name, k = F.col("p_name"), F.col("p_partkey")
    return t.table("part").select(
        "p_partkey", X.feed_slug(F.concat(F.lit("--R.J. "), name, F.lit(", Jr.!"))).alias("slug"),
        X.without_initials(F.concat_ws("-", F.lit("j"), F.replace(name, F.lit(" "), F.lit("-")), F.lit("b"))).alias("plain"),
        X.without_accents(F.concat(F.lit("José "), name, F.lit(" Đurić ﬁ王"))).alias("folded"),
        X.full_name(_pick(k, " Al ", "", None), _pick(k, "B", " C ", "D", "")).alias("whole"),
    )


def number_rules(t: Analog) -> DataFrame:
    raw = _pick(F.col("o_orderkey"), "12", "x", "1.5e2", " 7 ", "", None, "34:12", "-0.5")
    return t.table("orders").select("o_orderkey", X.number(raw).alias("number"), X.zero_filled(raw).alias("filled"), X.number_id(raw).alias("id"))


def code_names(t: Analog) -> DataFrame:
    code = _pick(F.col("o_orderkey"), "BOS", "van", " GSW ", "XXX", "", None)
    return t.table("orders").select("o_orderkey", X.team_name(code).alias("name"), X.is_allowed_team(code).alias("known"))


def word_lists(t: Analog) -> DataFrame:
    items = F.slice(F.array(F.col("c_name"), F.lit("b"), F.lit("c"), F.lit("d")), F.lit(1), (F.col("c_custkey") % 5).cast("int"))
    return t.table("customer").select("c_custkey", X.in_words(items).alias("words"))


def date_rules(t: Analog) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderkey") % 3 == 0, day).when(F.col("o_orderkey") % 3 == 1, F.concat(day, F.lit("T05:30"))).otherwise("soon")
    return t.table("orders").select("o_orderkey", X.iso_date(raw).alias("day"), F.coalesce(X.iso_date(raw), F.lit("")).alias("shown"))


def season_calendar(t: Analog) -> DataFrame:
    """The seasons up to a day in September, and their days up to then that aren't games' days."""
    today = F.lit("1998-09-30").cast("date")
    labels = readers.season_labels(t.spark, 1996, today)
    spans = labels.select("season", F.concat(X.season_start("season").cast("string"), F.lit("-10-01")).alias("first"),
        F.concat((X.season_start("season") + 1).cast("string"), F.lit("-06-30")).alias("last"))
    done = t.games.where("home_team_abbr = 'T00'").select(F.to_date("game_date").alias("day")).distinct()
    return readers.season_days(t.spark, spans, done, today).select("season", F.date_format("day", "yyyy-MM-dd").alias("day"))


def formatted_gaps(t: Analog) -> DataFrame:
    per = profiles.seasons(t.crew, t.schedule).groupBy("ref_key").agg(F.array_sort(F.collect_set("season")).alias("s"))
    more = F.when(F.col("ref_key").cast("int") % 2 == 0, F.array(F.lit("2012-13"))).otherwise(F.array().cast("array<string>"))
    return per.select("ref_key", serve.gap_phrase(F.concat("s", more)).alias("phrase"))


# merging and reports -------------------------------------------------------------


def _incoming(t: Analog) -> tuple[DataFrame, DataFrame]:
    stored = t.officials.where("row_order = 1").select("game_id", "official_id", F.col("row_order").cast("long").alias("v"))
    again = t.officials.where("row_order <= 2").select("game_id", "official_id", F.lit(100).cast("long").alias("v"))
    return stored, merge.keep_first(again, ["game_id", "official_id"], "v")


def stale_rows(t: Analog) -> DataFrame:
    stale = merge.is_stale(F.col("game_id"), F.col("season"), ["1996-97", "1997-98"])
    return t.games.groupBy("season").agg(F.count_if(stale).alias("stale"), F.count_if(~stale).alias("kept"))


def seeded_sample(t: Analog) -> DataFrame:
    return reports.seeded_sample(profiles.team_records(t.crew, t.games).select("ref_key", "team_abbr", "games"), 20, 0, "ref_key", "team_abbr")


def spot_check(t: Analog) -> DataFrame:
    return quality.spot_check(_careers(t), _names(t), ["#00000000", "SUPPLIER#000000010"]).select("ref_key", "display", "games_total",
        "games_po", "first_season")


def nan_check(t: Analog) -> DataFrame:
    bad = F.when(F.col("l_partkey") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return quality.nan_count(t.table("lineitem").select(bad.alias("a"),
        F.struct(F.array(bad, F.col("l_tax")).alias("x"), F.create_map(F.lit("k"), bad).alias("m")).alias("s"), "l_shipdate"))


def excluded_seasons(t: Analog) -> DataFrame:
    return reports.without_seasons(t.games, ["1996-97", "1998-99"]).select("game_id", "season")


def converted_logs(t: Analog) -> DataFrame:
    gid = F.concat(F.lit("00"), _pick(F.col("o_orderkey"), "1", "2", "4", "5", "9"),
        F.substring(F.date_format("o_orderdate", "yyyy"), 3, 2), F.lpad((F.col("o_orderkey") % 100000).cast("string"), 5, "0"))
    rows = t.table("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(gid).alias("game_id"))
    return reports.converted_logs(rows, ["1997-98"], 1995, 1999).select("o_orderkey", "season", "kind")


# sources -------------------------------------------------------------------------


def extracted_games(t: Analog) -> DataFrame:
    """A source with its own column names."""
    rows = t.games.select(
        F.concat(F.substring("game_id", 2, 9), F.lit(".0")).alias("GAME_ID"), F.concat("game_date", F.lit(" 00:00:00")).alias("GAME_DATE"),
        F.concat(F.lit("2"), F.substring("season", 1, 4)).alias("SEASON_ID"),
        F.col("season_type").alias("SEASON_TYPE"), F.substring("home_team_abbr", 2, 2).alias("HOME_TEAM_ID"),
        F.substring("away_team_abbr", 2, 2).alias("AWAY_TEAM_ID"), F.col("home_pts").alias("PTS_HOME"), F.col("away_pts").alias("PTS_AWAY"),
        _pick(F.col("o_orderkey"), "W", "L", None).alias("WL_HOME"),
    )
    teams = t.table("nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("team_id"), F.col("n_name").alias("team_abbr"))
    out = readers.with_team_codes(readers.extracted_games(rows), teams)
    return out.select("game_id", "game_date", "season", "season_type", "home_team_abbr", "away_team_abbr", "home_pts", "home_win")


def extracted_logs(t: Analog) -> DataFrame:
    rows = t.loose_logs.select(F.col("game_id").alias("GAME_ID"),
        F.concat_ws(".", F.regexp_extract("player_id", "([0-9]+)", 1), F.lit("0")).alias("PLAYER_ID"),
        F.concat(F.lit(" "), "player_name").alias("PLAYER_NAME"), F.col("min").cast("string").alias("MIN"),
        F.col("pts").cast("string").alias("PTS"), F.when(F.col("reb") > 2, F.col("reb").cast("string")).otherwise("none").alias("REB"))
    return readers.extracted_logs(rows).groupBy("player_id", "player_name").agg(F.count("*").alias("rows"), F.sum("pts").alias("pts"),
        F.sum("reb").alias("reb"), F.count("ast").alias("asts"))


def bridge_officials(t: Analog) -> DataFrame:
    people = t.table("supplier").select(F.concat(F.col("s_suppkey").cast("string"), F.lit(".0")).alias("official_id"),
        F.lit("Al ").alias("first_name"), F.col("s_name").alias("last_name"), F.col("s_nationkey").cast("string").alias("jersey_num"))
    return readers.official_rows(t.officials.select("game_id", "official_id"), people)


def _boards_json(t: Analog) -> DataFrame:
    """A scoreboard for each game, as the feed gives it."""
    side = lambda where, team, pts, won: F.struct(F.lit(where).alias("homeAway"), pts.cast("long").cast("string").alias("score"),
        won.alias("winner"), F.struct(F.lit("1").alias("id"), team.alias("abbreviation")).alias("team"))
    k = F.col("o_orderkey")
    told = F.when(k % 3 == 0, F.lit(None).cast("boolean"))
    sides = F.array(side("home", _pick(k, "BOS", "gs", "XXX"), F.col("home_pts"), told.otherwise(F.col("home_win") == 1)),
        side("away", _pick(k, "NY", "VAN", "LAL", "SEA"), F.col("away_pts"), told.otherwise(F.col("home_win") == 0)))
    kind = F.when(F.col("kind") == "PO", 3).when(F.col("kind") == "PI", F.when(k % 2 == 0, 5).otherwise(2)).otherwise(F.when(k % 13 == 0, 1).otherwise(2))
    name = F.when((F.col("kind") == "PI") & (k % 2 == 1), "X at Y: Play-In").otherwise("X at Y")
    status = F.struct(F.struct((k % 3 != 0).alias("completed"), _pick(k, "pre", "post").alias("state")).alias("type"))
    event = F.struct(F.col("game_id").alias("id"), F.concat("game_date", F.lit("T01:00Z")).alias("date"), name.alias("name"),
        F.struct(kind.alias("type")).alias("season"), status.alias("status"),
        F.array(F.struct(sides.alias("competitors"))).alias("competitions"))
    return t.games.where("away_pts is not null").select(F.to_json(F.struct(F.array(event).alias("events"))).alias("json"))


def feed_games(t: Analog) -> DataFrame:
    rows = feed.game_rows(feed.events(_boards_json(t)), F.lit("1995-96"))
    strange = feed.exhibitions(rows).select("game_id", F.lit(True).alias("exhibition"))
    return rows.join(strange, "game_id", "left").select("game_id", "game_date", "season_type", "home_team_abbr", "away_team_abbr",
        "home_pts", "home_win", "completed", F.coalesce("exhibition", F.lit(False)).alias("exhibition"))


def _summaries(t: Analog) -> DataFrame:
    """game_id, json: officials in written order, and box scores, as the feed gives them. A game is a row with its lists
    from the start; none is taken apart and collected again."""
    person = lambda x: F.struct(x["official_name"].alias("displayName"), F.when(x["row_order"] % 2 == 0, x["official_id"]).alias("id"),
        F.concat(x["row_order"].cast("string"), F.lit(".0")).alias("jersey"))
    whole = lambda c: c.cast("long").cast("string")
    athlete = lambda x: F.struct((x["pts"] % 7 == 0).alias("didNotPlay"),
        F.struct(x["p_brand"].alias("id"), x["p_brand"].alias("displayName")).alias("athlete"),
        F.array(whole(x["pts"] * 4), F.concat_ws("-", whole(x["fta"]), whole(x["pf"])), whole(x["pts"]), whole(x["reb"])).alias("stats"))
    heads = F.array(*[F.lit(h) for h in ("MIN", "FG", "PTS", "REB")])
    team = lambda scores: lambda k: F.struct(F.struct(t._team(k).alias("id"), t._team(k).alias("abbreviation")).alias("team"),
        F.array(F.struct(heads.alias("names"), F.transform(F.filter(scores, lambda x: x["s_nationkey"].eqNullSafe(k)), athlete).alias("athletes"))).alias("statistics"))
    scores = F.col("scores")
    rows = t.boxes.where("size(scores) > 0").select("game_id", F.transform(F.array_sort("officials"), person).alias("officials"),
        F.transform(F.array_distinct(scores["s_nationkey"]), team(scores)).alias("players"))
    return rows.select("game_id", F.to_json(F.struct(F.struct("officials").alias("gameInfo"), F.struct("players").alias("boxscore"))).alias("json"))


def _stored_summaries(t: Analog) -> DataFrame:
    """The same, written first as the feed's answers are: the search for keys reads them twice."""
    path = shared.new_path(t.spark, "summaries")
    _summaries(t).write.parquet(path)
    return t.spark.read.parquet(path)


def feed_players(t: Analog) -> DataFrame:
    return feed.player_rows(_summaries(t)).groupBy("player_id", "team_abbr").agg(
        F.count("*").alias("rows"), *[F.sum(F.col(c).cast("long")).alias(c) for c in ("min", "pts", "reb", "fgm", "fga")],
        F.count_if(F.col("ast") == "").alias("no_ast"),
    )


def feed_officials(t: Analog) -> DataFrame:
    return feed.official_rows(_stored_summaries(t)).select("game_id", "row_order", "official_id", "official_name", "jersey_num")


def feed_presence(t: Analog) -> DataFrame:
    return feed.presence(_stored_summaries(t))


def summary_officials(t: Analog) -> DataFrame:
    """Even games by the nested list, odd ones by the table."""
    person = F.struct(F.col("official_id").alias("personId"), F.lit("Al").alias("firstName"), F.col("official_name").alias("familyName"),
        F.col("row_order").cast("string").alias("jerseyNum"))
    row = F.array("official_id", "official_name")
    both = t.officials.groupBy("game_id").agg(F.array_sort(F.collect_list(F.struct("row_order", person.alias("p"), row.alias("r")))).alias("x"))
    nested = F.to_json(F.struct(F.struct(F.transform("x", lambda x: x["p"]).alias("officials")).alias("boxScoreSummary")))
    table = F.struct(F.lit("Officials").alias("name"), F.array(F.lit("OFFICIAL_ID"), F.lit("NAME")).alias("headers"),
        F.transform("x", lambda x: x["r"]).alias("rowSet"))
    other = F.struct(F.lit("Game").alias("name"), F.array(F.lit("A")).alias("headers"), F.array(F.array(F.lit("1"))).alias("rowSet"))
    even = F.substring("game_id", -1, 1).cast("int") % 2 == 0
    return feed.summary_official_rows(both.select("game_id",
        F.when(even, nested).otherwise(F.to_json(F.struct(F.array(other, table).alias("resultSets")))).alias("json")))


def league_logs(t: Analog) -> DataFrame:
    rows = t.logs.join(t.schedule.select("game_id", "season", "kind"), "game_id")
    cells = F.array(F.col("game_id"), F.col("player_id"), F.col("team_abbr"), F.col("pts").cast("long").cast("string"))
    tables = rows.groupBy("season", "kind", "game_id").agg(F.collect_list(cells).alias("rowSet"))
    table = F.struct(F.lit("LeagueGameLog").alias("name"),
        F.array(*[F.lit(h) for h in ("GAME_ID", "PLAYER_ID", "TEAM_ABBREVIATION", "PTS")]).alias("headers"), "rowSet")
    payloads = tables.select("season", "kind", F.to_json(F.struct(F.array(table).alias("resultSets"))).alias("json"))
    found = feed.league_log_rows(payloads)
    per = found.groupBy("season", "kind", "player_id", "game_id").agg(F.count("*").alias("rows"), F.sum(F.col("pts").cast("long")).alias("pts"),
        F.count_if(F.col("stl") == "").alias("no_stl"))
    return per.groupBy("season", "kind", "player_id").agg(F.sum("rows").alias("rows"), F.count("game_id").alias("games"), F.sum("pts").alias("pts"),
        F.sum("no_stl").alias("no_stl"))


def wanted_logs(t: Analog) -> DataFrame:
    seasons = t.games.select("season").distinct()
    return feed.wanted_logs(seasons, t.games.where("kind = 'PO' and season < '1998-99'").select("season", "kind"))


def key_search(t: Analog) -> DataFrame:
    rows = t.table("events").select("event_id",
        F.to_json(F.struct(F.struct(F.col("event_type").alias("theName"),
        F.struct(F.col("user_id").alias("nameless")).alias("in")).alias("a"))).alias("json"))
    return json_search.found_keys(rows, ["name"], 5)


# people, series, documents -------------------------------------------------------


def entity_swings(t: Analog) -> DataFrame:
    """Brands of one maker as one player of several ids."""
    ids = t.logs.join(t.schedule.select("game_id", "era"), "game_id").select(F.concat_ws(":", "era", "player_id").alias("seg_id"),
        F.substring("player_id", 1, 7).alias("slug")).distinct()
    return profiles.swings(t.crew, t.logs, t.schedule, ids.withColumn("display", F.upper("slug"))).select("ref_key", "slug", "name",
        "player_id", "n_games", "pts_with_ref", "pts_baseline", "pts_swing")


def series_changes(t: Analog) -> DataFrame:
    before = playoffs.series_audit(t.games.where("o_orderkey % 5 <> 0"))
    return playoffs.series_changes(before, playoffs.series_audit(t.games))


def label_agreement(t: Analog) -> DataFrame:
    notes = t.games.where(F.col("o_orderkey") % 2 == 0).select("game_id",
        F.when(F.col("o_orderkey") % 4 == 0, "East First Round - Game 1").otherwise("no note").alias("note"))
    return playoffs.label_agreement(playoffs.structural_labels(t.games), notes)


def probe_days(t: Analog) -> DataFrame:
    days = t.spark.range(60).select(F.date_add(F.lit("1996-03-01").cast("date"), F.col("id").cast("int")).alias("day"))
    found = playoffs.probe_days(days, t.games.where("home_team_abbr in ('T00', 'T07')"))
    return found.select(F.date_format("day", "yyyy-MM-dd").alias("day"), F.date_format("probe", "yyyy-MM-dd").alias("probe"))


def linked_partners(t: Analog) -> DataFrame:
    pages = t.table("supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").cast("string").alias("slug"))
    return serve.linked(crew.partners(t.crew, _names(t)), "partner", pages, "../ref", "partner_name").select("ref_key", "partner", "partner_link")


def directory_rows(t: Analog) -> DataFrame:
    index = t.table("supplier").select(F.col("s_name").alias("n"), F.col("s_suppkey").cast("string").alias("s"))
    return boards.directory(index, " IER#00000000")


def players_without_splits(t: Analog) -> DataFrame:
    players = t.logs.select(F.col("player_id").alias("slug")).distinct().unionByName(t.table("customer").select(F.col("c_name").alias("slug")))
    swing = profiles.swings(t.crew, t.logs, t.schedule)
    return quality.without_splits(players, profiles.player_splits(swing).select("slug").distinct())


def _flat(df: DataFrame, key: str, section: str, item: Callable[[Column], Column], first: Column | None = None) -> DataFrame:
    """first: the place of the list's first item, 0 if None."""
    before = F.lit(0) if first is None else first
    rows = df.select(key, F.lit(section).alias("section"), before.alias("before"), F.posexplode(f"d.{section}").alias("place", "x"))
    return rows.select(key, "section", (F.col("before") + F.col("place")).alias("place"), item(F.col("x")).alias("item"))


def _told(*parts: Column) -> Column:
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def ref_document_rows(t: Analog) -> DataFrame:
    """The lists of the officials' documents, read back from their JSON: where each row stands."""
    from . import catalog

    kind = """summary struct<name:string,games_total:long,finals_games:long,first_season:string,per_season:map<string,struct<rs:long,total:long>>>, team_records array<struct<team_abbr:string,games:long,wins:long,losses:long,win_pct:double,home_games:long,home_wins:long,avg_margin_for_team:double>>,
    whistle_profile struct<rs:struct<n:long,n_boxscore:long>,po:struct<n:long,n_boxscore:long>>, top_performances array<struct<player_id:string,pts:long,game_id:string>>, player_swings array<struct<slug:string,n_games:long,pts_with_ref:double,pts_baseline:double,pts_swing:double,fta_swing:double,pf_swing:double>>,
    notable_games array<struct<game_id:string,round:string>>, top_partners array<struct<partner:string,games:long>>"""
    df = catalog.ref_document(t).select("ref_key", F.from_json("document", kind).alias("d"))
    s, w = F.col("d.summary"), F.col("d.whistle_profile")
    top = df.select("ref_key", F.lit("summary").alias("section"), F.lit(0).alias("place"),
        _told(s["name"], s["games_total"], s["finals_games"], s["first_season"], F.size(s["per_season"]), w["rs"]["n"],
        w["po"]["n_boxscore"]).alias("item"))
    return boards.union([
        top, _flat(df, "ref_key", "team_records", lambda x: _told(*[x[c] for c in ("team_abbr", "games", "wins", "losses", "win_pct", "home_games",
            "home_wins", "avg_margin_for_team")])),
        _flat(df, "ref_key", "top_performances", lambda x: _told(x["player_id"], x["pts"], x["game_id"])),
        _flat(df, "ref_key", "player_swings", lambda x: _told(*[x[c] for c in ("slug", "n_games", "pts_with_ref", "pts_baseline", "pts_swing",
            "fta_swing", "pf_swing")])),
        _flat(df, "ref_key", "notable_games", lambda x: _told(x["game_id"], x["round"])),
        _flat(df, "ref_key", "top_partners", lambda x: _told(x["partner"], x["games"])),
    ])


def player_document_rows(t: Analog) -> DataFrame:
    """The lists of the players' documents, read back from the JSON of the parts that a document is put together from, so that
    no task parses a player's whole document."""
    from . import catalog

    splits = [f"{c}_{x}" for c in ("pts", "reb", "ast") for x in ("with_ref", "baseline", "swing")]
    split = f"array<struct<ref_slug:string,ref_name:string,n_games:long,{','.join(f'{c}:double' for c in splits)}>>"
    game = "array<struct<pts:long,game_id:string,opp_abbr:string,crew:array<struct<name:string,slug:string>>>>"
    parts = catalog.player_parts(t)
    told = lambda section, text, kind: parts.where(F.col("section") == section).select("slug", "piece", F.from_json(text, kind).alias(section))
    s = F.col("summary")
    top = told("summary", "text", "name string, games_total long, first_season string, last_season string, teams array<string>, eras array<string>").select(
        "slug", F.lit("summary").alias("section"), F.lit(0).alias("place"),
        _told(s["name"], s["games_total"], s["first_season"], s["last_season"], F.array_join(s["teams"], ","),
        F.array_join(s["eras"], ",")).alias("item"))
    crew_of = lambda x: F.array_join(F.transform(x["crew"], lambda c: c["slug"]), ",")
    items = lambda section, text, kind: told(section, text, kind).select("slug", "piece", F.struct(section).alias("d"))
    own = _flat(items("ref_splits", F.concat(F.lit("["), "text", F.lit("]")), split), "slug", "ref_splits",
        lambda x: _told(*[x[c] for c in ("ref_slug", "ref_name", "n_games", *splits)]), F.col("piece") * documents.PIECE)
    return boards.union([top, own, _flat(items("top_games", F.col("text"), game), "slug", "top_games", lambda x: _told(x["game_id"], x["pts"], crew_of(x)))])


def team_document_rows(t: Analog) -> DataFrame:
    """The teams' documents, read back from their JSON."""
    from . import catalog

    kind = "summary struct<tricode:string,name:string,slug:string,games_total:long,historical:boolean>, ref_records array<struct<ref_slug:string,ref_name:string,games:long,away_wins:long>>"
    df = catalog._team_documents(t).select(F.from_json("document", kind).alias("d")).withColumn("team", F.col("d.summary.tricode"))
    s = F.col("d.summary")
    top = df.select("team", F.lit("summary").alias("section"), F.lit(0).alias("place"),
        _told(s["name"], s["slug"], s["games_total"], s["historical"]).alias("item"))
    return top.unionByName(_flat(df, "team", "ref_records", lambda x: _told(x["ref_slug"], x["ref_name"], x["games"], x["away_wins"])))


def leaderboard_document(t: Analog) -> DataFrame:
    """The boards' document, those of counts and those of rates (in hundredths), read back from its JSON."""
    from . import catalog

    counts = boards.count_boards(_careers(t), profiles.seasons(t.crew, t.schedule), CURRENT)
    rows = counts.unionByName(boards.rate_boards(catalog._whistle(t), LEAST))
    document = boards.board_document(rows, _names(t), LEAST, CURRENT)
    of_counts = [*boards.COUNTS, "most_career_games_active", "most_games_current_season"]
    of_rates = ["highest_home_win_pct", "lowest_home_win_pct", "highest_avg_total_fta_rs", "lowest_avg_total_fta_rs"]
    kind = ", ".join(f"{b} array<struct<official_id:string,name:string,value:double,n:long>>" for b in [*of_counts, *of_rates])
    d = F.from_json("document", f"{kind}, _meta struct<min_games_for_rate_leaderboards:int,current_season:string>").alias("d")
    every = document.select(d).withColumn("k", F.lit("board"))
    lists = boards.union([_flat(every, "k", b, lambda x: _told(x["official_id"], x["name"], x["value"].cast("long"))) for b in of_counts])
    rates = boards.union([_flat(every, "k", b, lambda x: _told(x["official_id"], x["name"], F.round(x["value"] * 100).cast("long"),
        x["n"])) for b in of_rates])
    meta = every.select("k", F.lit("_meta").alias("section"), F.lit(0).alias("place"),
        _told(F.col("d._meta.min_games_for_rate_leaderboards"), F.col("d._meta.current_season")).alias("item"))
    return lists.unionByName(rates).unionByName(meta).drop("k")


def person_page_texts(t: Analog) -> DataFrame:
    """Officials' pages with their table of team records: head, lengths of the table, first cell."""
    lists = documents.listed(profiles.team_records(t.crew, t.games).withColumn("ref_name", F.col("team_abbr")), "ref_key", "records",
        ["ref_name", "games", "wins", "losses", "win_pct", "avg_margin_for_team"], [-F.col("games"), F.col("team_abbr")])
    rows = _careers(t).join(_names(t), "ref_key").join(lists, "ref_key").select(F.col("ref_key").alias("slug"),
        F.col("display").alias("name"), "games_total", "first_season", "last_season", "records")
    html = F.col("html")
    return serve.person_pages(rows, {"Teams": serve.record_table("records", "ref_name")}).select(
        "slug", F.regexp_extract(html, "<h1>(.*?)</h1>", 1).alias("name"),
        F.regexp_extract(html, "<h1>.*?</h1><p>(.*?)</p>", 1).alias("line"),
        F.regexp_count(html, F.lit("<tr>")).cast("long").alias("lines"),
        F.regexp_extract(html, "<tbody><tr><td>(.*?)</td>", 1).alias("first"), F.regexp_extract(html, '<td data-v="[0-9.]+">([0-9.]+%)</td>', 1).alias("share"),
    )


QUERIES: dict[str, Callable[[Analog], DataFrame]] = {
    "text_rules": text_rules,
    "number_rules": number_rules,
    "code_names": code_names,
    "word_lists": word_lists,
    "date_rules": date_rules,
    "season_calendar": season_calendar,
    "formatted_gaps": formatted_gaps,
    "appended_first": lambda t: merge.appended(*_incoming(t), ["game_id", "official_id"], "v"),
    "appended_last": lambda t: merge.appended(*_incoming(t), ["game_id", "official_id"], "v", first=False),
    "stale_rows": stale_rows,
    "value_report": lambda t: reports.value_report(t.table("part"), "p_type"),
    "value_report_few": lambda t: reports.value_report(t.table("orders"), "o_orderpriority"),
    "team_code_report": lambda t: reports.team_code_report(t.table("orders").select(_pick(F.col("o_orderkey"), "GS", "BOS", "", "zz", "no").alias("c")), "c"),
    "run_counters": lambda t: reports.run_counters(t.games, t.officials, t.loose_logs),
    "seeded_sample": seeded_sample,
    "spot_check": spot_check,
    "nan_check": nan_check,
    "excluded_seasons": excluded_seasons,
    "converted_logs": converted_logs,
    "extracted_games": extracted_games,
    "extracted_logs": extracted_logs,
    "bridge_officials": bridge_officials,
    "feed_games": feed_games,
    "feed_players": feed_players,
    "feed_officials": feed_officials,
    "feed_presence": feed_presence,
    "summary_officials": summary_officials,
    "league_logs": league_logs,
    "wanted_logs": wanted_logs,
    "key_search": key_search,
    "entity_swings": entity_swings,
    "series_changes": series_changes,
    "label_agreement": label_agreement,
    "probe_days": probe_days,
    "linked_partners": linked_partners,
    "directory_rows": directory_rows,
    "players_without_splits": players_without_splits,
    "era_spans": lambda t: identity.era_spans(identity.aliases(t.crew)),
    "ref_document_rows": ref_document_rows,
    "player_document_rows": player_document_rows,
    "team_document_rows": team_document_rows,
    "leaderboard_document": leaderboard_document,
    "person_page_texts": person_page_texts,
}
