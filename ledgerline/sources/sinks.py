"""Writers. What a table is merged into is written beside it and then swapped in; tables in
partitions, of which a merge touches few, are in tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import merge


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def recovered(spark: SparkSession, path: str) -> bool:
    """Is there a table at path? One that a driver was lost over while swapping is put right first:
    if the new one was written whole it takes its place, else the old one gets its place back."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        for beside, whole in ((".new", "/_SUCCESS"), (".old", "")):
            if fs.exists(_fs(spark, path.rstrip("/") + beside + whole)[0]):
                fs.rename(_fs(spark, path.rstrip("/") + beside)[0], p)
                break
    return fs.exists(p)


def swapped(df: DataFrame, path: str, form: str = "parquet", **options: str) -> None:
    """Writes df to path even if df reads from path: to a new folder first, then in its place. At
    every moment the table or its whole successor is there; recovered() finds which."""
    spark, path = df.sparkSession, path.rstrip("/")
    (new, fs), (own, _), (old, _) = _fs(spark, f"{path}.new"), _fs(spark, path), _fs(spark, f"{path}.old")
    recovered(spark, path)
    df.write.format(form).mode("overwrite").options(**options).save(f"{path}.new")
    fs.delete(old, True)
    if fs.exists(own) and not fs.rename(own, old) or not fs.rename(new, own):
        raise OSError(f"{path} can't be swapped")
    fs.delete(old, True)


def text_csv(df: DataFrame, path: str, mark: bool = True) -> None:
    """Compressed CSV with a header, and a byte order mark before it, as the reference's files have:
    it is part of the first column's name, which readers strip."""
    shown = [F.col(c).cast("string").alias(("\ufeff" if mark and k == 0 else "") + c) for k, c in enumerate(df.columns)]
    df.select(shown).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def by_season(df: DataFrame, path: str, form: str = "parquet") -> None:
    """A folder for each season and kind; rows of one folder are brought together first, so
    that it has few files. Later reads of some seasons skip the others."""
    df.repartition("season", "kind").write.mode("overwrite").partitionBy("season", "kind").format(form).save(path)


def merged(spark: SparkSession, path: str, incoming: DataFrame, how, form: str = "parquet") -> None:
    """how(stored, incoming), or incoming alone where nothing is stored, becomes the table."""
    swapped(how(spark.read.format(form).load(path), incoming) if recovered(spark, path) else incoming, path, form)


def upserted(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], *order: str) -> None:
    merged(spark, path, incoming, lambda old, new: merge.upsert(old, new, "game_id", keys, *order))


def appended(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], *order: str, flush: int | None = None) -> None:
    """New keys are added, stored ones stay. With flush, the games that come in are merged about so
    many at a time, so that what a broken run has fetched is kept: each flush is a swap of its own."""
    for block in merge.in_blocks(incoming, "game_id", flush):
        merged(spark, path, block, lambda old, new: merge.appended(old, new, keys, *order))


def without_stale(spark: SparkSession, path: str, seasons: list[str], form: str = "parquet") -> int:
    """Deletes rows of the older scheme in the given seasons; a table without any isn't touched.
    Returns how many there were; read again, there are none."""
    recovered(spark, path)
    df = spark.read.format(form).load(path)
    stale = merge.is_stale(F.col("game_id"), F.col("season"), seasons)
    n = df.where(stale).count()
    if n:
        swapped(df.where(~F.coalesce(stale, F.lit(False))), path, form)
    return n


def documents(df: DataFrame, path: str) -> None:
    """slug and document: a folder slug=<slug> with one JSON file for each; a new run replaces them
    all, so none is left over."""
    df.select("slug", F.col("document").alias("value")).repartition("slug").write.mode("overwrite").partitionBy("slug").text(path)


def json_array(df: DataFrame, path: str, order: list[str], *fields: str) -> None:
    """Rows as one JSON array in text files that follow each other: an object a line, in order. No
    task holds more than its range of the rows. order must be a total one."""
    row = F.to_json(F.struct(*(fields or df.columns)), {"ignoreNullFields": "false"})
    by = F.struct(*order).alias("_by")
    rows = df.select(by, row.alias("_row"))
    if rows.isEmpty():
        df.sparkSession.createDataFrame([("[]",)], "value string").write.mode("overwrite").text(path)
        return
    ends = rows.agg(F.min("_by").alias("_first"), F.max("_by").alias("_last"))  # one row
    line = F.concat(F.when(F.col("_by") == F.col("_first"), "[").otherwise(""), "_row", F.when(F.col("_by") == F.col("_last"), "]").otherwise(","))
    rows.crossJoin(F.broadcast(ends)).orderBy("_by").select(line.alias("value")).write.mode("overwrite").text(path)


def report(df: DataFrame, path: str, *columns: str) -> None:
    """A text report: one line for each row."""
    shown = F.concat_ws("  ", *[F.coalesce(F.col(c).cast("string"), F.lit(X.DASH)) for c in (columns or df.columns)])
    df.select(shown.alias("value")).write.mode("overwrite").text(path)


def pages(df: DataFrame, path: str) -> None:
    """slug and html: a folder slug=<slug> for each page, those of a run before gone."""
    df.select("slug", F.col("html").alias("value")).repartition("slug").write.mode("overwrite").partitionBy("slug").text(path)
