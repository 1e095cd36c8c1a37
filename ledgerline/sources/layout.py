"""Tables written once, in the layout that the joins after them need."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from . import shared


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None, placed: bool = False) -> DataFrame:
    """df as a table of sorted buckets by the hash of key. Tables with as many buckets join on the key,
    and group and window by it, with no shuffle.

    buckets: how many; by default spark.sql.shuffle.partitions. Choose so many that one bucket of the
    largest table is some 200 MB. placed: df's rows are where their buckets are already, as when it
    comes from such tables by joins, groups or windows on key; then nothing is shuffled here, either.
    Null keys share a bucket."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"ledgerline_{name}_{uuid.uuid4().hex}"
    rows = df if placed else df.repartition(n, key)
    rows.write.bucketBy(n, key).sortBy(key).option("path", shared.new_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: what uses it more than once computes it once, and
    its lineage ends there."""
    path = shared.new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
