"""Incremental ingest: payload files as a stream, each micro-batch merged into the tables.

The stream's checkpoint remembers which files were read; a batch that is run again after a failure
replaces the same games, so the tables end up the same. A batch reads and rewrites the seasons that
its games are in, and no others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import scalars as X
from ..operators import merge
from ..sources import feed, shared, tables


def payloads(spark: SparkSession, path: str, per_batch: int = 100) -> DataFrame:
    """json, path and time (of the last change) of files as they come."""
    return spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger",
        per_batch).schema("value string").load(path).select(F.col("value").alias("json"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("time"))


def days(spark: SparkSession, url: str, types: list[str], first: str, **options: str) -> DataFrame:
    """The feed's answers day by day, as they can be merged: json, path, time and day. Later runs go on
    where the checkpoint stands."""
    feed.register(spark)
    reader = spark.readStream.format("feed_days").options(url=url, types=",".join(types), first=first, **options)
    return reader.load().select("json", F.col("url").alias("path"), F.current_timestamp().alias("time"), "day", "type")


def merge_games(path: str, season: str | None = None):
    """A foreachBatch function: completed league games of a batch of scoreboards go to path. Of a
    game that several files tell of, the file changed last counts, so a replay gives the same. Without a
    season it is that of the scoreboard's day; a new one begins in October."""

    def merged(batch: DataFrame, _number: int) -> None:
        # written first, so that each file is read, and the feed asked, once
        staged = shared.new_path(batch.sparkSession, "batch")
        batch.write.parquet(staged)
        own = batch.sparkSession.read.schema(batch.schema).parquet(staged).where("json IS NOT NULL")
        day = F.col("day").cast("date") if "day" in own.columns else None
        label = F.lit(season) if season or day is None else X.season_label(F.year(day) - F.when(F.month(day) >= 10, 0).otherwise(1))
        found = feed.events(own.withColumn("own_season", label), "time", "path", "own_season")
        rows = feed.game_rows(found, F.col("own_season"), "time", "path", "own_season").where("completed").drop("completed", "own_season")
        rows = rows.join(feed.exhibitions(rows).select("game_id").distinct(), "game_id", "left_anti")
        rows = merge.keep_last(rows, ["game_id"], "time", "path").drop("time", "path")
        if not rows.isEmpty():
            tables.upserted(batch.sparkSession, path, rows, ["game_id"], "game_date")
        shared.delete(batch.sparkSession, staged)

    return merged


def run(stream: DataFrame, each, checkpoint: str) -> StreamingQuery:
    """Reads all that is there, and stops; the next run goes on from there."""
    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def day_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """Beyond batch ingest: counts of a stream of events by type and time window; rows later
    than the watermark are left out, and state older than it is dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
