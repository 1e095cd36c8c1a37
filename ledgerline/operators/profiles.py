"""Career aggregates. Frames: games (with era, kind, po_round, po_game_num), crew (ref_key,
game_id), logs (game_id, player_id, player_name, team_abbr, min, pts, fta, pf, reb, ast)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X


def with_measures(games: DataFrame) -> DataFrame:
    return games.withColumn("abs_margin", F.abs(F.col("home_pts") - F.col("away_pts"))).withColumn("total_pts", F.col("home_pts") + F.col("away_pts"))


def sides(games: DataFrame) -> DataFrame:
    """Each game as a home row and an away row: game_id, season, team, opponent, is_home, won,
    margin. A game without a result is a loss for both; its margin adds nothing."""
    side = lambda team, other, home, won, margin: F.struct(F.col(team).alias("team"), F.col(other).alias("opponent"),
        F.lit(home).alias("is_home"), F.coalesce(won, F.lit(False)).alias("won"),
        F.coalesce(margin, F.lit(0.0)).alias("margin"))
    both = F.array(
        side("home_team_abbr", "away_team_abbr", True, F.col("home_win") == 1, F.col("home_pts") - F.col("away_pts")),
        side("away_team_abbr", "home_team_abbr", False, F.col("home_win") == 0, F.col("away_pts") - F.col("home_pts")),
    )
    return games.select("game_id", "season", F.explode(both).alias("s")).select("game_id", "season", "s.*").where("team is not null and team <> ''")


def team_game_totals(logs: DataFrame) -> DataFrame:
    return logs.groupBy("game_id", "team_abbr").agg(*[F.sum(c).alias(f"team_{c}") for c in ("pts", "fta", "pf", "min")])


def game_totals(logs: DataFrame) -> DataFrame:
    """box_fta, box_pf, box_min, n_teams and is_ot of each game; its second grouping reuses
    what the first summed."""
    per = team_game_totals(logs).groupBy("game_id").agg(*[F.sum(f"team_{c}").alias(f"box_{c}") for c in ("fta", "pf", "min")],
        F.countDistinct("team_abbr").alias("n_teams"))
    return per.withColumn("is_ot", F.col("box_min") >= S.OVERTIME_MINUTES)


def careers(crew: DataFrame, games: DataFrame, current: str = S.CURRENT_SEASON) -> DataFrame:
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    rows = crew.select("ref_key", "game_id").join(games.select("game_id", "season", "kind", "po_round", "po_game_num"), "game_id")
    return rows.groupBy("ref_key").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"), F.count("*").alias("games_total"),
        *[n(F.col("kind") == k).alias(f"games_{k.lower()}") for k in ("RS", "PO", "PI")], n(F.col("po_round") == 4).alias("finals_games"),
        n(F.col("po_game_num") == 7).alias("game7s"), F.max(F.col("season") == current).alias("active"),
    )


def seasons(crew: DataFrame, games: DataFrame) -> DataFrame:
    """ref_key, season, rs, po, pi, total."""
    rows = crew.select("ref_key", "game_id").join(games.select("game_id", "season", "kind"), "game_id")
    return rows.groupBy("ref_key", "season").agg(*[F.count_if(F.col("kind") == k).alias(k.lower()) for k in ("RS", "PO", "PI")], F.count("*").alias("total"))


def season_maps(crew: DataFrame, games: DataFrame) -> DataFrame:
    """ref_key, per_season: season -> counts."""
    entry = F.struct("season", F.struct("rs", "po", "pi", "total"))
    return seasons(crew, games).groupBy("ref_key").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("per_season"))


def team_records(crew: DataFrame, games: DataFrame) -> DataFrame:
    """Each official and team: games, wins, losses, at home and away, mean margin. The sides of
    a game meet its crew once, by game."""
    rows = crew.select("ref_key", "game_id").join(sides(games), "game_id")
    home = F.col("is_home")
    per = rows.groupBy("ref_key", F.col("team").alias("team_abbr")).agg(
        F.count("*").alias("games"), F.count_if("won").alias("wins"), F.count_if(home).alias("home_games"),
        F.count_if(home & F.col("won")).alias("home_wins"), F.sum("margin").alias("margins"),
    )
    return per.select(
        "ref_key", "team_abbr", "games", "wins", (F.col("games") - F.col("wins")).alias("losses"),
        X.round2(F.col("wins") / F.col("games")).alias("win_pct"), "home_games", "home_wins",
        (F.col("games") - F.col("home_games")).alias("away_games"), (F.col("wins") - F.col("home_wins")).alias("away_wins"),
        X.round2(F.col("margins") / F.col("games")).alias("avg_margin_for_team"),
    )


def team_totals(games: DataFrame) -> DataFrame:
    return sides(games).groupBy(F.col("team").alias("team_abbr")).agg(F.countDistinct("game_id").alias("games_total"),
        F.min("season").alias("first_season"), F.max("season").alias("last_season"))


def whistle_profiles(crew: DataFrame, games: DataFrame, totals: DataFrame) -> DataFrame:
    """Each official, for RS and PO alike even without games: averages over games, and, over
    games with both teams' box scores, over those."""
    rows = crew.select("ref_key", "game_id").join(with_measures(games), "game_id")
    rows = rows.where(F.col("kind").isin("RS", "PO")).join(totals, "game_id", "left")
    boxed = F.coalesce(F.col("n_teams") == 2, F.lit(False))
    in_box = lambda c: F.avg(F.when(boxed, c))
    per = rows.groupBy("ref_key", "kind").agg(
        F.count("*").alias("n"), F.count_if(boxed).alias("n_boxscore"), X.round2(F.avg("total_pts")).alias("avg_total_points"),
        X.round2(in_box(F.col("box_fta"))).alias("avg_total_fta"),
        X.round2(in_box(F.col("box_pf"))).alias("avg_total_pf"),
        X.round2(F.avg(F.coalesce(F.col("home_win") == 1, F.lit(False)).cast("int"))).alias("home_win_pct"),
        X.round2(F.avg("abs_margin")).alias("avg_abs_margin"), F.sum(F.when(boxed, F.col("is_ot").cast("int"))).alias("ot_games"),
        X.round2(in_box(F.col("is_ot").cast("int"))).alias("ot_rate"),
    )
    every = crew.join(games.select("game_id"), "game_id", "left_semi").select("ref_key").distinct().select("ref_key",
        F.explode(F.array(F.lit("RS"), F.lit("PO"))).alias("kind"))
    return every.join(per, ["ref_key", "kind"], "left").fillna(0, ["n", "n_boxscore"])


def baselines(logs: DataFrame, games: DataFrame) -> DataFrame:
    """player_id, season, kind, base_<stat> (means, not rounded) and base_n."""
    rows = logs.join(games.select("game_id", "season", "kind"), "game_id").where(F.col("kind").isin("RS", "PO"))
    return rows.groupBy("player_id", "season", "kind").agg(*[F.avg(c).alias(f"base_{c}") for c in S.STATS], F.count("*").alias("base_n"))


def swings(crew: DataFrame, logs: DataFrame, games: DataFrame, entity: DataFrame | None = None, least: int = S.SWING_MIN_GAMES,
        send_means: bool = False, tasks: int | None = None) -> DataFrame:
    """Each official and player: means of the player's games under the official, of the same
    games' season means, and their difference, rounded once. entity maps seg_id to slug and
    display; without it a player is a player_id.

    The three tables meet by game alone, so in buckets by game nothing is shuffled for it, and the tripled
    rows are summed by official, player, season and kind before they go anywhere. These sums meet the
    season means, as a mean counts once for each game: a player with a third of all rows is then one
    row for each official, season and kind. send_means: the means, a row for each player, season and kind, are
    sent to all tasks and meet the rows where these are, and one sum by official and player is all that is shuffled.

    tasks: the rows are dealt by official over so many tasks before they are summed, and with send_means that is the
    only time they are shuffled. Where an official has few games in one task, sums are hardly fewer than rows."""
    meta = games.select("game_id", "season", "kind", "era").where(F.col("kind").isin("RS", "PO"))
    own = logs.select("game_id", "player_id", *S.STATS).join(meta, "game_id")
    under = crew.select("ref_key", "game_id").join(own, "game_id")
    means, keys = baselines(logs, games), ["player_id", "season", "kind"]
    if tasks:
        under = under.select("ref_key", *keys, "era", *S.STATS).repartition(tasks, "ref_key")
    if send_means and not tasks:
        rows = under.join(F.broadcast(means), keys).withColumn("k", F.lit(1).cast("long"))
    else:
        sums = under.groupBy("ref_key", *keys, "era").agg(F.count("*").alias("k"), *[F.sum(c).alias(c) for c in S.STATS])
        rows = sums.join(F.broadcast(means) if send_means else means, keys).withColumns({f"base_{c}": F.col(f"base_{c}") * F.col("k") for c in S.STATS})
    rows = rows.where((F.col("kind") != "PO") | (F.col("base_n") >= S.PLAYOFF_BASELINE_GAMES))
    if entity is None:
        rows = rows.withColumn("slug", F.col("player_id")).withColumn("display", F.col("player_id"))
    else:
        rows = rows.withColumn("seg_id", F.concat_ws(":", "era", "player_id")).join(entity.select("seg_id", "slug", "display"), "seg_id")
    cells = [x for c in S.STATS for x in (c, f"base_{c}")]
    by_id = rows.groupBy("ref_key", "slug", "player_id").agg(F.sum("k").alias("k"), F.max("display").alias("name"),
        F.collect_set("season").alias("s"), *[F.sum(x).alias(x) for x in cells])
    per = by_id.groupBy("ref_key", "slug").agg(
        F.max("name").alias("name"), F.sum("k").alias("n_games"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))).alias("seasons"),
        F.min_by("player_id", F.struct(-F.col("k"), "player_id")).alias("player_id"), *[(F.sum(x) / F.sum("k")).alias(x) for x in cells],
    )
    out = per.where(F.col("n_games") >= least)
    shown = [x for c in S.STATS for x in (X.round2(F.col(c)).alias(f"{c}_with_ref"), X.round2(F.col(f"base_{c}")).alias(f"{c}_baseline"),
        X.round2(F.col(c) - F.col(f"base_{c}")).alias(f"{c}_swing"))]
    return out.select("ref_key", "slug", "name", "player_id", "n_games", *shown, "seasons")


def ranked(df: DataFrame, by: list[str], order: list, top: int) -> DataFrame:
    """The first rows of each group, numbered; the cut is taken before the shuffle too."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)


def referee_swings(swing: DataFrame, top: int = S.SWING_TOP) -> DataFrame:
    """The page's view of swings(): the largest by size."""
    return ranked(swing, ["ref_key"], [F.desc(F.abs("pts_swing")), "slug"], top).select("ref_key", "slug", "n_games", "pts_with_ref",
        "pts_baseline", "pts_swing", "fta_swing", "pf_swing", "rank")


def player_splits(swing: DataFrame) -> DataFrame:
    """The player's view of the same rows."""
    return swing.select("slug", "ref_key", "player_id", "n_games",
        *[f"{c}_{x}" for c in ("pts", "reb", "ast") for x in ("with_ref", "baseline", "swing")], "seasons")


def player_games(logs: DataFrame, games: DataFrame) -> DataFrame:
    meta = games.select("game_id", "game_date", "season", "era", "home_team_abbr", "away_team_abbr")
    opponent = F.when(F.col("team_abbr") == F.col("home_team_abbr"), F.col("away_team_abbr")).otherwise(F.col("home_team_abbr"))
    return logs.join(meta, "game_id").withColumn("opp_abbr", opponent).withColumn("seg_id", F.concat_ws(":", "era", "player_id"))


def top_performances(crew: DataFrame, logs: DataFrame, games: DataFrame, top: int = S.TOP_PERFORMANCES, send_bounds: bool = False) -> DataFrame:
    """The best scores under each official, play-in games too. A game's rows are cut to the
    best of each game before the crew triples them: no more can count.

    send_bounds: of an official's games, those with the highest best scores are looked for first; as each
    best score is a row of its own, no row below the last of these can count, and it isn't shuffled. That
    bound, a row for each official, is sent to all tasks."""
    own, whose = player_games(logs, games), crew.select("ref_key", "game_id")
    rows = ranked(own, ["game_id"], [F.desc("pts"), "player_id", "team_abbr", "reb", "ast", "pf", "fta"], top).drop("rank")
    under = whose.join(rows, "game_id")
    if send_bounds:
        highest = whose.join(own.groupBy("game_id").agg(F.max("pts").alias("least")), "game_id")
        bounds = ranked(highest, ["ref_key"], [F.desc("least")], top).where(F.col("rank") == top).select("ref_key", "least")
        under = under.join(F.broadcast(bounds), "ref_key", "left").where("least is null or pts >= least").drop("least")
    best = ranked(under, ["ref_key"], [F.desc("pts"), "game_date", "game_id", "player_id", "team_abbr", "reb", "ast", "pf", "fta"], top)
    return best.select("ref_key", "rank", "player_id", F.col("pts").cast("long").alias("pts"), "team_abbr", "opp_abbr", "game_date", "game_id", "seg_id")


def player_top_games(logs: DataFrame, games: DataFrame, key: str = "player_id", top: int = S.PLAYER_TOP_GAMES) -> DataFrame:
    best = ranked(player_games(logs, games), [key], [F.desc("pts"), "game_date", "game_id", "team_abbr", "reb", "ast", "pf", "fta"], top)
    return best.select(key, "rank", *[F.col(c).cast("long").alias(c) for c in ("pts", "reb", "ast")], "team_abbr", "opp_abbr", "game_date", "game_id")
