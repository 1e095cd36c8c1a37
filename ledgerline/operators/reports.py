"""Reports on what was ingested: distinct values, counters, seeded samples, excluded seasons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X


def value_report(df: DataFrame, column: str, most: int = 40) -> DataFrame:
    """value, rows of a column's different texts, trimmed, blanks left out. Up to most values are
    only named (rows is null); of more, each is counted. Sorted by value, or by count."""
    text = F.trim(F.col(column).cast("string"))
    counts = df.select(text.alias("value")).where("value <> ''").groupBy("value").agg(F.count("*").alias("rows"))
    kinds = counts.agg((F.count("*") > most).alias("many"))  # one row
    rows = F.when(F.col("many"), F.col("rows"))
    return counts.crossJoin(F.broadcast(kinds)).select("value", rows.alias("rows")).orderBy(F.desc_nulls_last("rows"), "value")


def team_code_report(df: DataFrame, column: str) -> DataFrame:
    """value, code, known (is the code a team's?), changed (was it another spelling?) of each
    different team code of a source."""
    own = value_report(df, column).select("value", X.tricode("value").alias("code"))
    return own.select("value", "code", X.is_allowed_team("code").alias("known"), (F.col("code") != F.upper("value")).alias("changed"))


def run_counters(games: DataFrame, officials: DataFrame, logs: DataFrame) -> DataFrame:
    """season, season_type, games, officials, player_rows: what a run brought in. Each table is
    counted by game before it meets the games."""
    per = lambda df, name: df.groupBy("game_id").agg(F.count("*").alias(name))
    rows = games.select("game_id", "season", "season_type").join(per(officials, "o"), "game_id", "left").join(per(logs, "p"), "game_id", "left")
    return rows.groupBy("season", "season_type").agg(F.count("*").alias("games"), F.coalesce(F.sum("o"), F.lit(0)).alias("officials"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("player_rows"))


def seeded_sample(df: DataFrame, n: int = 20, seed: int = 0, *keys: str) -> DataFrame:
    """n rows in an order shuffled by seed, the same in every run whatever the partitions: by the
    digest of the seed and the keys (all columns if none are given), then the keys."""
    by = keys or tuple(df.columns)
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in by]))
    return df.orderBy(digest, *by).limit(n)


def without_seasons(df: DataFrame, excluded: list[str], column: str = "season") -> DataFrame:
    """Rows of seasons that aren't excluded; a row without a season stays."""
    return df.where(~F.coalesce(F.col(column).isin(*excluded), F.lit(False))) if excluded else df


def converted_logs(logs: DataFrame, excluded: list[str], first: int = 2000, last: int = 2022) -> DataFrame:
    """Box scores with season and kind from their game ids, regular seasons, playoffs and play-ins of
    the given years, without the excluded seasons."""
    year, kind = X.id_season("game_id"), X.id_season_type("game_id", 0)
    own = logs.where(F.col("game_id") != "").withColumn("season", X.season_label(year)).withColumn("kind", kind)
    return without_seasons(own.where(year.between(first, last) & F.col("kind").isin("RS", "PO", "PI")), excluded)
