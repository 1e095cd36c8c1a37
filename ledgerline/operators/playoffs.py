"""Playoff structure: rounds and game numbers from ids, from series, and from notes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as X


def id_round(game_id: Column | str = "game_id") -> Column:
    return F.substring(X.col(game_id), 8, 1).try_cast("int")


def id_game(game_id: Column | str = "game_id") -> Column:
    return F.substring(X.col(game_id), 10, 1).try_cast("int")


def id_verdict(games: DataFrame) -> DataFrame:
    """One row, ok: rounds 1 to 4 and games 1 to 7 throughout, and 4 to 7 last-round games in
    each season that has any, of which there is one at least."""
    po = games.where((F.col("season_type") == "Playoffs") & (F.col("era") == "nba")).select("season", id_round().alias("r"), id_game().alias("g"))
    finals = po.where("r = 4").groupBy("season").agg(F.count("*").alias("n")).agg(F.count("*").alias("seasons"),
        F.count_if(~F.col("n").between(4, 7)).alias("odd"))
    bad = po.agg(F.count_if(~F.coalesce(F.col("r").between(1, 4) & F.col("g").between(1, 7), F.lit(False))).alias("bad"))
    return bad.crossJoin(finals).select((F.col("bad").eqNullSafe(0) & (F.col("seasons") > 0) & F.col("odd").eqNullSafe(0)).alias("ok"))


def label_from_ids(games: DataFrame) -> DataFrame:
    """games with po_round and po_game_num, all or none: null unless the whole table passes."""
    own = (F.col("season_type") == "Playoffs") & (F.col("era") == "nba") & F.col("ok")
    return games.crossJoin(F.broadcast(id_verdict(games))).withColumn("po_round", F.when(own, id_round())).withColumn("po_game_num",
        F.when(own, id_game())).drop("ok")


def winner() -> Column:
    """The away team unless the home team is known to have won."""
    return F.when(F.col("home_win") == 1, F.col("home_team_abbr")).otherwise(F.col("away_team_abbr"))


def clinch(rnd: Column | str, year: Column | str) -> Column:
    return F.when((X.col(rnd) == 1) & (X.col(year) <= 2001), 3).otherwise(4)


def longest(rnd: Column | str, year: Column | str) -> Column:
    return F.when((X.col(rnd) == 1) & (X.col(year) <= 2001), 5).otherwise(7)


def playoff_games(games: DataFrame) -> DataFrame:
    """Playoff games with series, the two teams' codes in order."""
    pair = F.array_sort(F.array("home_team_abbr", "away_team_abbr"))
    return games.where(F.col("season_type") == "Playoffs").withColumn("series", F.array_join(pair, "/"))


def series_rounds(po: DataFrame) -> DataFrame:
    """season, series, round, agreed: a series is so many-th of a team's season; of its two
    teams the lesser number counts."""
    first = po.groupBy("season", "series").agg(F.min("game_date").alias("first"))
    order = Window.partitionBy("season", "team").orderBy("first", "series")
    teams = first.select("season", "series", "first", F.explode(F.array_distinct(F.split("series", "/"))).alias("team"))
    claims = teams.withColumn("n", F.row_number().over(order))
    return claims.groupBy("season", "series").agg(F.min("n").alias("round"), (F.countDistinct("n") == 1).alias("agreed"))


def structural_labels(games: DataFrame) -> DataFrame:
    """game_id, season, series, round, game_num."""
    po = playoff_games(games)
    number = F.row_number().over(Window.partitionBy("season", "series").orderBy("game_date", "game_id"))
    return po.withColumn("game_num", number).join(series_rounds(po), ["season", "series"]).select("game_id", "season", "series", "round", "game_num")


def series_audit(games: DataFrame) -> DataFrame:
    """Each series: season, series, round, agreed, games, top_wins, first_date, last_date, flag."""
    po = playoff_games(games).withColumn("w", winner())
    wins = po.groupBy("season", "series", "w").agg(F.count("*").alias("n"), F.min("game_date").alias("a"), F.max("game_date").alias("b"))
    per = wins.groupBy("season", "series").agg(F.sum("n").alias("games"), F.max("n").alias("top_wins"), F.min("a").alias("first_date"),
        F.max("b").alias("last_date"))
    year = X.season_start("season")
    flag = F.when(F.col("top_wins") < clinch("round", year), "INCOMPLETE").when(F.col("games") > longest("round", year), "OVER-LONG").otherwise("OK")
    return per.join(series_rounds(po), ["season", "series"]).withColumn("flag", flag)


def bracket_check(audit: DataFrame) -> DataFrame:
    """Each season: series, first_round, finals, disagreements, flagged, ok."""
    per = audit.groupBy("season").agg(
        F.count("*").alias("series"), F.count_if(F.col("round") == 1).alias("first_round"), F.count_if(F.col("round") == 4).alias("finals"),
        F.count_if(~F.col("agreed")).alias("disagreements"), F.count_if(F.col("flag") != "OK").alias("flagged"),
    )
    return per.withColumn("ok", (F.col("first_round") == 8) & (F.col("finals") == 1) & (F.col("disagreements") == 0) & (F.col("flagged") == 0))


def note_round(note: Column | str) -> Column:
    """The round that a note tells; the tests' order matters."""
    t = F.lower(X.col(note))
    has = t.contains
    return F.when(has("first round") | has("1st round"), 1).when(has("semifinal"), 2).when(has("conference final"), 3).when(has("final"), 4)


def note_game(note: Column | str) -> Column:
    return F.nullif(F.regexp_extract(F.lower(X.col(note)), r"game\s+(\d+)", 1), F.lit("")).try_cast("int")


def preferred_labels(derived: DataFrame, notes: DataFrame) -> DataFrame:
    """game_id, round, game_num, source: a note that tells both wins over what was derived."""
    told = notes.select("game_id", note_round("note").alias("r"), note_game("note").alias("g")).where("r is not null and g is not null")
    both = derived.join(told, "game_id", "left")
    noted = F.col("r").isNotNull()
    return both.select("game_id", F.coalesce("r", "round").alias("round"), F.coalesce("g", "game_num").alias("game_num"),
        F.when(noted, "gamenote").otherwise("derived").alias("source"))


def label_agreement(derived: DataFrame, notes: DataFrame) -> DataFrame:
    """One row: noted, agree, differ."""
    told = notes.select("game_id", note_round("note").alias("r"), note_game("note").alias("g")).where("r is not null and g is not null")
    same = (F.col("r") == F.col("round")) & (F.col("g") == F.col("game_num"))
    return derived.join(told, "game_id").agg(F.count("*").alias("noted"), F.count_if(same).alias("agree"), F.count_if(~same).alias("differ"))


def gap_days(audit: DataFrame, low: str, high: str, pad: int = 12) -> DataFrame:
    """day: all days near an incomplete series' games, inside [low, high]."""
    a = F.greatest(F.date_sub(F.to_date("first_date"), pad), F.lit(low).cast("date"))
    b = F.least(F.date_add(F.to_date("last_date"), pad), F.lit(high).cast("date"))
    return audit.where("flag = 'INCOMPLETE'").select(a.alias("a"), b.alias("b")).where("a <= b").select(F.explode(F.sequence("a", "b")).alias("day")).distinct()


def probe_days(days: DataFrame, games: DataFrame) -> DataFrame:
    """day, probe: a day without any game is looked for one day before and after, too."""
    seen = games.select(F.to_date("game_date").alias("day")).distinct().withColumn("has", F.lit(True))
    both = days.join(seen, "day", "left")
    return both.select("day", F.explode(F.when(F.col("has"),
        F.array("day")).otherwise(F.array("day", F.date_sub("day", 1), F.date_add("day", 1)))).alias("probe"))


def series_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """season, series, games_before, games_after of two audits."""
    x = before.select("season", "series", F.col("games").alias("games_before"))
    y = after.select("season", "series", F.col("games").alias("games_after"))
    return x.join(y, ["season", "series"], "full").select("season", "series", F.coalesce("games_before", F.lit(0)).alias("games_before"),
        F.coalesce("games_after", F.lit(0)).alias("games_after"))


def notable_games(crew: DataFrame, games: DataFrame) -> DataFrame:
    """ref_key, game_id, game_date, matchup, result, round, game_num: finals and seventh games."""
    rows = crew.select("ref_key", "game_id").join(games, "game_id").where("po_round = 4 or po_game_num = 7")
    name = F.when(F.col("po_round") == 4, "Finals").when(F.col("po_round").isNotNull(), F.concat(F.lit("Round "), F.col("po_round").cast("string")))
    return rows.select(
        "ref_key", "game_id", "game_date", X.matchup("away_team_abbr", "home_team_abbr").alias("matchup"),
        X.result("home_team_abbr", "home_pts", "away_team_abbr", "away_pts").alias("result"), name.alias("round"), F.col("po_game_num").alias("game_num"),
    )
