"""Crews: who officiated a game, and with whom. Frames: officials (game_id, official_id,
official_name, row_order), crew (the same with ref_key, alternates gone)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CREW_SIZE = 3


def keep_first(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row for each key: the first in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def without_alternates(officials: DataFrame) -> DataFrame:
    """Repeated (game, official) rows go, then all beyond the first three of a game as written.
    One shuffle by game serves both windows, since the first is by game and official within."""
    once = keep_first(officials, ["game_id", "official_id"], "row_order")
    rank = F.row_number().over(Window.partitionBy("game_id").orderBy("row_order", "official_id"))
    return once.withColumn("rank_in_game", rank - 1).where(F.col("rank_in_game") < CREW_SIZE)


def size_histogram(crew: DataFrame) -> DataFrame:
    """n_officials, games."""
    per = crew.groupBy("game_id").agg(F.count("*").alias("n_officials"))
    return per.groupBy("n_officials").agg(F.count("*").alias("games"))


def crew_arrays(crew: DataFrame) -> DataFrame:
    """game_id, crew: its officials (name, slug), each once, in written order."""
    once = keep_first(crew, ["game_id", "ref_key"], "row_order")
    rows = F.array_sort(F.collect_list(F.struct("row_order", F.col("display").alias("name"), F.col("ref_key").alias("slug"))))
    return once.groupBy("game_id").agg(F.transform(rows, lambda x: F.struct(x["name"].alias("name"), x["slug"].alias("slug"))).alias("crew"))


def pair_counts(crew: DataFrame) -> DataFrame:
    """ref_key, partner, games, for every pair in both directions."""
    own = crew.select("game_id", "ref_key").distinct()
    pairs = own.join(own.withColumnRenamed("ref_key", "partner"), "game_id").where("ref_key < partner").groupBy("ref_key",
        "partner").agg(F.count("*").alias("games"))
    return pairs.unionByName(pairs.select(F.col("partner").alias("ref_key"), F.col("ref_key").alias("partner"), "games"))


def partners(crew: DataFrame, names: DataFrame, top: int = 5) -> DataFrame:
    """ref_key, partner, games, rank: the commonest partners. Those without a name are dropped
    after the cut, so there may be fewer. names: ref_key, display."""
    named = pair_counts(crew).join(names.select(F.col("ref_key").alias("partner"), F.col("display").alias("partner_name")), "partner", "left")
    order = Window.partitionBy("ref_key").orderBy(F.desc("games"), F.coalesce("partner_name", "partner"), "partner")
    return named.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= top)
        & F.col("partner_name").isNotNull()).select("ref_key", "partner", "partner_name", "games", "rank")
