"""Tables in partitions, merged partition by partition.

A table is a folder of write generations, gen=<id>/<partition>/part files, and a list of manifests,
_manifest/<version>.json. A manifest names the folder of each partition with the least and the
greatest key in it, and the schema. The last one is the table. A merge reads and rewrites only the
partitions that its keys touch: those of the incoming rows, and of the others only where a stored row
has an incoming key, which is looked for where the key lies between least and greatest, in the key
column alone. Files of other partitions stay as they are. The rows are written as a new generation;
then the next manifest is put in place by a rename that fails if another writer was faster, in
which case the merge is done again over what that one left. So a driver or executor may be lost at any
moment: readers see the table before or after a merge, never between.

Partitions of old manifests are removed once KEPT newer ones exist, and what a lost writer left
behind once it is ORPHAN_HOURS old."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote, urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge

KEPT, ORPHAN_HOURS, ATTEMPTS = 2, 24, 5


@dataclass(frozen=True)
class Part:
    """A partition: its values, where it is, its rows, those with a null key, and the least and greatest key."""

    values: tuple
    folder: str
    rows: int
    nulls: int
    least: str | None
    greatest: str | None


@dataclass
class Manifest:
    version: int
    by: list[str]
    key: str
    schema: str | None = None
    parts: list[Part] = field(default_factory=list)
    #: writer -> the last batch of its that is in the table
    batches: dict[str, int] = field(default_factory=dict)


class Conflict(Exception):
    """Another writer has put its manifest in place first."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    p, fs = _fs(spark, path)
    return [(f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(p)] if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n, _ in _names(spark, f"{path}/_manifest") if n.endswith(".json") and n[0] != ".")


def _read(spark: SparkSession, path: str, version: int) -> Manifest:
    text = spark.read.text(f"{path}/_manifest/{version:012}.json", wholetext=True).first()[0]
    found = json.loads(text)
    return Manifest(**{**found, "parts": [Part(**{**p, "values": tuple(p["values"])}) for p in found["parts"]]})


def manifest(spark: SparkSession, path: str) -> Manifest | None:
    """The table as it is now; None if there is none."""
    versions = _versions(spark, path)
    return _read(spark, path, versions[-1]) if versions else None


def _commit(spark: SparkSession, path: str, new: Manifest) -> None:
    """Puts a manifest in place, unless there is one of its version."""
    sc = spark.sparkContext
    folder, fs = _fs(spark, f"{path}/_manifest")
    fs.mkdirs(folder)
    own, _ = _fs(spark, f"{path}/_manifest/.{uuid.uuid4().hex}")
    out = fs.create(own)
    out.write(bytearray(json.dumps(asdict(new)).encode()))
    out.close()
    hadoop = sc._jvm.org.apache.hadoop.fs
    options = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(own.toUri(), sc._jsc.hadoopConfiguration()).rename(own, _fs(spark, f"{path}/_manifest/{new.version:012}.json")[0], options)
    except Py4JJavaError as e:
        fs.delete(own, False)
        if "FileAlreadyExists" in str(e.java_exception.getClass()):
            raise Conflict(path) from e
        raise


def _loaded(spark: SparkSession, path: str, now: Manifest, parts: list[Part]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(now.schema))
    if not parts:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{p.folder}" for p in parts))
    return found.select(*schema.names)


def stored(spark: SparkSession, path: str, only: Callable[[Part], bool] = lambda part: True) -> DataFrame:
    """The table, or those of its partitions that only() picks."""
    now = manifest(spark, path)
    if now is None:
        raise FileNotFoundError(path)
    return _loaded(spark, path, now, [p for p in now.parts if only(p)])


def _written(df: DataFrame, path: str, now: Manifest) -> list[Part]:
    """Writes a generation. Spark brings the rows of a partition together, and cuts large ones."""
    spark, gen = df.sparkSession, f"gen={uuid.uuid4().hex}"
    df.hint("rebalance", *now.by).write.partitionBy(*now.by).parquet(f"{path}/{gen}")
    fields = [f for f in df.schema.fields if f.name in now.by]
    own = spark.read.schema(T.StructType([df.schema[now.key], *fields])).parquet(f"{path}/{gen}")
    of = own.select("*", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder"))
    found = of.groupBy("_folder", *now.by).agg(F.count("*").alias("_n"), F.count_if(F.col(now.key).isNull()).alias("_z"), F.min(now.key).cast("string").alias("_a"), F.max(now.key).cast("string").alias("_b"))
    at = f"/{gen}/"
    return [Part(tuple(r[c] for c in now.by), f"{gen}/" + unquote(urlsplit(r["_folder"]).path).split(at, 1)[1], r["_n"], r["_z"], r["_a"], r["_b"])
        for r in found.collect()]  # one row for each partition


def _holding(spark: SparkSession, path: str, now: Manifest, keys: DataFrame, parts: list[Part]) -> set[tuple]:
    """Which of the partitions hold one of the keys (key, string)."""
    zones = spark.createDataFrame([(k, p.nulls > 0, p.least, p.greatest) for k, p in enumerate(parts)], "k int, nulls boolean, a string, b string")
    near = keys.join(F.broadcast(zones), F.col("key").between(F.col("a"), F.col("b")) | (F.col("key").isNull() & F.col("nulls")))
    probed = [parts[r["k"]] for r in near.select("k").distinct().collect()]  # one row for each partition
    if not probed:
        return set()
    own = _loaded(spark, path, now, probed).select(*now.by, F.col(now.key).cast("string").alias("_key"))
    return {tuple(r) for r in own.join(keys, F.col("_key").eqNullSafe(F.col("key")), "left_semi").select(*now.by).distinct().collect()}


def vacuum(spark: SparkSession, path: str) -> None:
    """Removes manifests and partitions that nothing newer than KEPT manifests uses."""
    versions = _versions(spark, path)
    kept = [_read(spark, path, v) for v in versions[-KEPT:]]
    used = {p.folder for m in kept for p in m.parts}
    for v in versions[:-KEPT]:
        for p in _read(spark, path, v).parts:
            if p.folder not in used:
                own, fs = _fs(spark, f"{path}/{p.folder}")
                fs.delete(own, True)
        own, fs = _fs(spark, f"{path}/_manifest/{v:012}.json")
        fs.delete(own, False)
    gens = {f.split("/")[0] for f in used}
    for name, changed in _names(spark, path):
        if name.startswith("gen=") and name not in gens and time.time() - changed / 1000 > ORPHAN_HOURS * 3600:
            own, fs = _fs(spark, f"{path}/{name}")
            fs.delete(own, True)


def merged(spark: SparkSession, path: str, incoming: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame], by: tuple[str, ...] = ("season", "season_type"),
    key: str = "game_id", batch: tuple[str, int] | None = None) -> int:
    """how(stored, incoming) becomes the table, where stored are the partitions that incoming touches.
    incoming's rows are written first, so that they are computed once. batch: writer and number; a
    batch that is in the table already is left out. Returns the version of the table."""
    path = path.rstrip("/")
    staged = f"{path}/gen={uuid.uuid4().hex}"  # an orphan, should the driver be lost
    incoming.write.parquet(staged)
    rows = spark.read.schema(incoming.schema).parquet(staged)
    try:
        for _ in range(ATTEMPTS):
            now = manifest(spark, path) or Manifest(0, list(by), key)
            if batch and now.batches.get(batch[0], -1) >= batch[1]:
                return now.version
            old, touched = now.parts, set()
            if now.schema is not None:
                touched = {tuple(r) for r in rows.select(*now.by).distinct().collect()}  # one row for each partition
                keys = rows.select(F.col(key).cast("string").alias("key")).distinct()
                touched |= _holding(spark, path, now, keys, [p for p in old if p.values not in touched])
                result = how(_loaded(spark, path, now, [p for p in old if p.values in touched]), rows)
            else:
                result = how(spark.createDataFrame([], incoming.schema), rows)
            parts = [p for p in old if p.values not in touched] + _written(result, path, now)
            batches = now.batches | ({batch[0]: batch[1]} if batch else {})
            try:
                _commit(spark, path, Manifest(now.version + 1, now.by, key, result.schema.json(), parts, batches))
            except Conflict:
                continue
            vacuum(spark, path)
            return now.version + 1
        raise Conflict(path)
    finally:
        own, fs = _fs(spark, staged)
        fs.delete(own, True)


def upserted(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], *order: str, **more) -> int:
    """Stored rows of games that come in are replaced, wherever they are."""
    return merged(spark, path, incoming, lambda old, new: merge.upsert(old, new, "game_id", keys, *order), **more)


def appended(spark: SparkSession, path: str, incoming: DataFrame, keys: list[str], *order: str, flush: int | None = None, first: bool = True, **more) -> int:
    """New keys are added; of rows with one key the stored one stays (first) or goes. With flush,
    about so many games are merged at a time, so that a broken run keeps what it has done."""
    how = lambda old, new: merge.appended(old, new, keys, *order, first=first)
    version = -1
    for block in merge.in_blocks(incoming, "game_id", flush):
        version = merged(spark, path, block, how, **more)
    return version


def removed(spark: SparkSession, path: str, gone: Column, only: Callable[[Part], bool] = lambda part: True) -> int:
    """Deletes the rows for which gone is true, in the partitions that only() picks; those without
    any aren't touched. Returns how many there were."""
    for _ in range(ATTEMPTS):
        now = manifest(spark, path)
        if now is None:
            raise FileNotFoundError(path)
        picked = [p for p in now.parts if only(p)]
        counts = {tuple(r[c] for c in now.by): r["_n"] for r in _loaded(spark, path, now, picked).where(gone).groupBy(*now.by).agg(F.count("*").alias("_n")).collect()}
        if not counts:
            return 0
        touched = [p for p in picked if p.values in counts]
        left = _loaded(spark, path, now, touched).where(~F.coalesce(gone, F.lit(False)))
        parts = [p for p in now.parts if p not in touched] + _written(left, path, now)
        try:
            _commit(spark, path, Manifest(now.version + 1, now.by, now.key, now.schema, parts, now.batches))
        except Conflict:
            continue
        vacuum(spark, path)
        return sum(counts.values())
    raise Conflict(path)


def without_stale(spark: SparkSession, path: str, seasons: list[str]) -> int:
    """Deletes rows of the older scheme in seasons that the other scheme has taken over. Partitions
    of other seasons, and those whose keys are all beyond that scheme's, aren't read."""
    by = manifest(spark, path).by
    may = lambda p: ("season" not in by or p.values[by.index("season")] in seasons) and p.least is not None and p.least < "01" and p.greatest >= "00"
    return removed(spark, path, merge.is_stale(F.col("game_id"), F.col("season"), seasons), may)
