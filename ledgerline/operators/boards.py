"""Leaderboards, search and directory order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X

COUNTS = {"most_career_games": "games_total", "most_playoff_games": "games_po", "most_finals_games": "finals_games", "most_game7s": "game7s"}


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def boards(rows: DataFrame, entries: dict[str, tuple[Column, Column, Column | None, bool]], top: int = S.BOARD_SIZE) -> DataFrame:
    """board, ref_key, value, n: the highest (or lowest) rows of several boards, from one reading of
    rows. entries: board -> (value, who may be on it, n, whether low ones lead). A board's rows are
    cut in each task before they meet."""
    none = F.lit(None).cast("long")
    told = [F.when(where, F.struct(F.lit(name).alias("board"), value.cast("double").alias("value"),
        (none if n is None else n.cast("long")).alias("n"), (value if low else -value).cast("double").alias("by"))) for name,
        (value, where, n, low) in entries.items()]
    own = rows.select("ref_key", F.explode(F.filter(F.array(*told), lambda x: x.isNotNull())).alias("b")).select("ref_key", "b.*")
    rank = F.row_number().over(Window.partitionBy("board").orderBy("by", "ref_key"))
    return own.withColumn("rank", rank).where(F.col("rank") <= top).select("board", "ref_key", "value", "n")


def count_boards(careers: DataFrame, seasons: DataFrame, current: str = S.CURRENT_SEASON) -> DataFrame:
    """Six boards of counts; zeros may be listed."""
    now = seasons.where(F.col("season") == current).select("ref_key", F.col("total").alias("games_current"))
    rows = careers.join(now, "ref_key", "left").fillna(0, ["games_current"])
    every, active = F.lit(True), F.coalesce(F.col("active"), F.lit(False))
    entries = {name: (F.col(value), every, None, False) for name, value in COUNTS.items()}
    entries |= {"most_career_games_active": (F.col("games_total"), active, None, False),
        "most_games_current_season": (F.col("games_current"), active, None, False)}
    return boards(rows, entries)


def home_win_rates(whistle: DataFrame, least: int = S.RATE_MIN_GAMES) -> DataFrame:
    """ref_key, home_win_pct, n over RS and PO: the mean of the rounded shares by games."""
    per = whistle.groupBy("ref_key").agg(F.sum("n").alias("n"), F.sum(F.coalesce(F.col("home_win_pct") * F.col("n"), F.lit(0.0))).alias("w"))
    return per.where(F.col("n") >= least).select("ref_key", X.round2(F.col("w") / F.col("n")).alias("home_win_pct"), "n")


def rate_boards(whistle: DataFrame, least: int = S.RATE_MIN_GAMES) -> DataFrame:
    """Highest and lowest home win share, and highest and lowest free throws in regular games."""
    regular = lambda c: F.max(F.when(F.col("kind") == "RS", F.col(c)))
    per = whistle.groupBy("ref_key").agg(
        F.sum("n").alias("n"), F.sum(F.coalesce(F.col("home_win_pct") * F.col("n"), F.lit(0.0))).alias("w"),
        regular("n_boxscore").alias("boxed"), regular("avg_total_fta").alias("shots"),
    )
    home, shots, n, boxed = X.round2(F.col("w") / F.col("n")), F.col("shots"), F.col("n"), F.col("boxed")
    often, shown = n >= least, F.coalesce((boxed >= least) & shots.isNotNull(), F.lit(False))
    return boards(per, {
        "highest_home_win_pct": (home, often, n, False), "lowest_home_win_pct": (home, often, n, True),
        "highest_avg_total_fta_rs": (shots, shown, boxed, False), "lowest_avg_total_fta_rs": (shots, shown, boxed, True),
    })


def board_document(rows: DataFrame, names: DataFrame, least: int = S.RATE_MIN_GAMES, current: str = S.CURRENT_SEASON) -> DataFrame:
    """One row, document: all boards as one JSON object, each with its rows in order (of a board's 25
    rows at most), and _meta with the least games and the current season. names: ref_key, display."""
    low = F.col("board").startswith("lowest")
    item = F.struct(F.when(low, F.col("value")).otherwise(-F.col("value")).alias("by"), "ref_key",
        F.struct(F.col("ref_key").alias("official_id"), F.col("display").alias("name"), "value", "n").alias("row"))
    per = rows.join(names, "ref_key").groupBy("board").agg(F.array_sort(F.collect_list(item)).alias("items"))
    entry = F.struct("board", F.transform("items", lambda x: x["row"]).alias("rows"))
    one = per.groupBy().agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("boards"))
    meta = F.struct(F.lit(least).alias("min_games_for_rate_leaderboards"), F.lit(current).alias("current_season"))
    told = F.to_json("boards", {"ignoreNullFields": "false"})
    return one.select(F.concat(F.regexp_replace(told, r"\}$", ""), F.when(F.size("boards") > 0, ",").otherwise(""), F.lit('"_meta":'),
        F.to_json(meta), F.lit("}")).alias("document"))


def search_index(refs: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """n (name), s (slug), t (type), u (subtitle). Each frame: name, slug, games_total,
    first_season, last_season."""
    entry = lambda df, t: df.select(F.col("name").alias("n"), F.col("slug").alias("s"), F.lit(t).alias("t"),
        X.subtitle("games_total", "first_season", "last_season").alias("u"))
    return entry(refs, "ref").unionByName(entry(teams, "team")).unionByName(entry(players, "player"))


def search(index: DataFrame, text: str, top: int = 12) -> DataFrame:
    """Names that hold the text, whatever its case: first those that start with it, then shorter ones."""
    q, name = text.strip().lower(), F.lower("n")
    hits = index.where(name.contains(q)) if q else index.limit(0)
    return hits.orderBy(F.when(name.startswith(q), 0).otherwise(1), F.length("n"), "n", "s", "t").limit(top)


def directory(index: DataFrame, text: str = "") -> DataFrame:
    """All entries whose name holds the text, by name whatever its case."""
    return index.where(F.lower("n").contains(text.strip().lower())).orderBy(F.lower("n"), "n", "s")


def column_sorted(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Rows by a shown column: by number where it is one, else by lower-case text."""
    number = F.regexp_replace(F.col(column).cast("string"), "[,%+]", "").try_cast("double")
    keys = [number, F.lower(F.col(column).cast("string"))]
    return df.orderBy(*[k.desc_nulls_last() if descending else k.asc_nulls_last() for k in keys])
