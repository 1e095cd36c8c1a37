"""Merging rows into tables that exist. Each takes and gives DataFrames; sources.sinks writes
the result to a new place and swaps it in, since Spark can't overwrite what it is reading."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _one(df, keys, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return _one(df, keys, [F.col(c).desc() for c in order])


def stacked(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a frame lacks are empty text there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna("")


def upsert(stored: DataFrame, incoming: DataFrame, game: str, keys: list[str], *order: str) -> DataFrame:
    """Stored rows of games that come in are all replaced, even by fewer; of rows with one key
    the last stays. order: columns that say which is later."""
    old = stored.join(incoming.select(game).distinct(), game, "left_anti").withColumn("_late", F.lit(0))
    return _one(old.unionByName(incoming.withColumn("_late", F.lit(1)), allowMissingColumns=True), keys,
        [F.desc("_late"), *[F.desc(c) for c in order]]).drop("_late")


def appended(stored: DataFrame, incoming: DataFrame, keys: list[str], *order: str, first: bool = True) -> DataFrame:
    """Both tables' rows; of rows with one key the stored (first) or the incoming one stays."""
    both = stored.withColumn("_late", F.lit(0)).unionByName(incoming.withColumn("_late", F.lit(1)), allowMissingColumns=True)
    late = F.col("_late").asc() if first else F.col("_late").desc()
    return _one(both, keys, [late, *[F.col(c) for c in order]]).drop("_late")


def in_blocks(df: DataFrame, key: str, size: int | None) -> Iterator[DataFrame]:
    """The rows in blocks of about so many keys, by the keys' hash; null is a key like others. None: all
    at once."""
    n = 1 if size is None else max(1, -(-df.select(key).distinct().count() // size))
    for k in range(n):
        yield df if n == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(n)) == k)


def purged(tables: dict[str, DataFrame], gone: DataFrame, key: str = "game_id") -> dict[str, DataFrame]:
    """Every table without the rows of the given keys."""
    keys = gone.select(key).distinct()
    return {name: df.join(keys, key, "left_anti") for name, df in tables.items()}


def missing(games: DataFrame, officials: DataFrame) -> DataFrame:
    """Games that have no officials yet."""
    return games.join(officials.select("game_id").distinct(), "game_id", "left_anti")


def is_stale(game_id: Column, season: Column, seasons: list[str]) -> Column:
    """A row of the older scheme in a season that the other scheme has taken over."""
    return (F.length(game_id) == 10) & game_id.startswith("00") & season.isin(*seasons)
