"""Substring search by posting lists of letter triples.

A name that holds a text holds each of the text's triples of letters (texts of one or two letters are
looked up as they are). The index keeps, under every triple, pair and letter of a name in lower case, the
entry itself, in folders by the hash of these, sorted, and how many entries each has. A search reads the
counts of the text's own triples, then the list of the rarest one only, and looks for the text in the
names there. Entries are short; each is kept about three times for every letter of its name.

Entries without a name aren't found. An empty text finds nothing in search(); directory() then reads
the entries themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boards

LETTERS, BUCKETS = 3, 64


def grams(name: Column) -> Column:
    """The different runs of one to three letters."""
    def runs(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(1), F.length(name) - (k - 1)), lambda i: F.substring(name, i, F.lit(k)))
        return F.when(F.length(name) >= k, every).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[runs(k) for k in range(1, LETTERS + 1)]))


def written(index: DataFrame, path: str) -> None:
    """The index (n and further columns) as posting lists at path. A list too long for a task is cut by
    Spark into several files."""
    lists = index.where(F.length("n") > 0).select(F.explode(grams(F.lower("n"))).alias("_gram"), "*")
    lists = lists.withColumn("_bucket", F.pmod(F.xxhash64("_gram"), F.lit(BUCKETS)))
    lists.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", "_gram").write.partitionBy("_bucket").parquet(f"{path}/lists")
    lists.groupBy("_bucket", "_gram").agg(F.count("*").alias("_n")).sort("_gram").write.parquet(f"{path}/counts")
    index.write.parquet(f"{path}/entries")


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """The entries in the list of the text's rarest run, those that hold the text among them."""
    own = {text[k : k + LETTERS] for k in range(max(1, len(text) - LETTERS + 1))}
    counts = spark.read.parquet(f"{path}/counts").where(F.col("_gram").isin(*own)).collect()  # one row for each run of the text
    fields = [T.StructField("_gram", T.StringType()), *spark.read.parquet(f"{path}/entries").schema, T.StructField("_bucket", T.IntegerType())]
    lists = spark.read.schema(T.StructType(fields)).parquet(f"{path}/lists")
    if len(counts) < len(own):
        return lists.limit(0).drop("_gram", "_bucket")
    rare = min(counts, key=lambda r: (r["_n"], r["_gram"]))
    return lists.where((F.col("_bucket") == rare["_bucket"]) & (F.col("_gram") == rare["_gram"])).drop("_gram", "_bucket")


def search(spark: SparkSession, path: str, text: str, top: int = 12) -> DataFrame:
    """As boards.search() over the index."""
    q = text.strip().lower()
    return boards.search(candidates(spark, path, q) if q else spark.read.parquet(f"{path}/entries"), text, top)


def directory(spark: SparkSession, path: str, text: str = "") -> DataFrame:
    """As boards.directory() over the index."""
    q = text.strip().lower()
    return boards.directory(candidates(spark, path, q) if q else spark.read.parquet(f"{path}/entries"), text)
