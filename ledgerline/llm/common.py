"""What the operators share: the shared folder, batches, word ids and shingles."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import re
import shutil
import string
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A worker forgets its word ids beyond so many, so that its memory stays bounded.
WORD_CACHE = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, where it is unset
    and all runs in this one process (tests), a temporary folder that the process removes at
    its end. On a cluster the setting must be there, as executors don't see such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        own = tempfile.TemporaryDirectory(prefix="ledgerline-")
        atexit.register(own.cleanup)
        found = f"file://{own.name}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that their Python
    finds it wherever the driver was started."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    top = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="ledgerline-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    spark.sparkContext.addPyFile(archive)


#: Between two trims of the driver's native memory, seconds at least.
TRIM_EVERY = 15
_trimmed = 0.0


def trim(spark: SparkSession) -> None:
    """Gives back to the system what the driver's JVM has freed outside its heap. The hundreds of
    threads of a driver each keep such memory for themselves: 220 MB in a pipeline over 0.5 GB.
    Where the JVM has no such command, nothing happens."""
    global _trimmed
    if time.monotonic() - _trimmed < TRIM_EVERY:
        return
    _trimmed = time.monotonic()
    sc = spark.sparkContext
    jvm, array = sc._jvm, sc._gateway.new_array
    named = jvm.java.lang.Class.forName
    kinds = ["javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"]
    values = [jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap",
        array(jvm.java.lang.Object, 0), array(jvm.java.lang.String, 0)]
    types, args = array(jvm.java.lang.Class, 4), array(jvm.java.lang.Object, 4)
    for k in range(4):
        types[k], args[k] = named(kinds[k]), values[k]
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    with contextlib.suppress(Py4JJavaError):
        named("javax.management.MBeanServer").getMethod("invoke", types).invoke(server, args)


def release(spark: SparkSession) -> None:
    """Lets go of what earlier work left behind: Spark removes broadcasts and shuffle files once
    nothing refers to them, but only when the driver collects garbage, which a driver with little
    to do of its own would not do for half an hour (spark.cleaner.periodicGC.interval)."""
    global _trimmed
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trimmed = 0.0
    trim(spark)


def shipped(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """run(spark, ...) after ship(spark) and release(spark)."""

    @functools.wraps(run)
    def with_package(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        release(spark)
        return run(spark, *rest)

    return with_package


def new_path(spark: SparkSession, name: str) -> str:
    """A path for a table or a file that no other run uses."""
    return f"{shared_dir(spark)}/ledgerline/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Rows in an Arrow batch while an intermediate table is written. Spark's default, 10,000, keeps as
#: many texts in the JVM and in the Python worker of each task, more than once.
SAVED_ROWS = 2_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: it cuts the lineage, and a
    lost executor costs no more than the step that is running."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with batch_rows(spark, SAVED_ROWS):
        df.write.option("compression", "zstd").parquet(path)
    trim(spark)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for what runs inside, so that a task holds fewer texts at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before) if int(before) > 0 else rows)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def forget(*tables: DataFrame) -> None:
    """Deletes the files of tables from saved() that nothing will read any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            if "/ledgerline/" in f:
                path.getFileSystem(conf).delete(path, True)


def rows_of(df: DataFrame) -> list[tuple]:
    """The rows of a table of known small size, by Arrow."""
    table = df.toArrow()
    return list(zip(*(c.to_pylist() for c in table.columns), strict=True))


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(texts: Iterable[str | None], limit: int = 1 << 20) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    """The texts as UTF-8 in slices of whole texts with about limit bytes at most: (positions
    of the texts, their joined bytes, where each begins and the end). Null is empty."""
    at: list[int] = []
    parts: list[bytes] = []
    held = 0
    for k, t in enumerate(texts):
        b = (t or "").encode("utf-8", "replace")
        if parts and held + len(b) > limit:
            yield at, b"".join(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))
            at, parts, held = [], [], 0
        at.append(k)
        parts.append(b)
        held += len(b)
    if parts:
        yield at, b"".join(parts), np.concatenate(([0], np.cumsum([len(x) for x in parts])))


class WordIds(dict):
    """word (bytes) -> its 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_words = WordIds()


def split_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: what bytes.split() and
    bytes.lower() do on UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def ids_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def word_ids(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the text, in order."""
    return ids_of(split_words(text))


#: ASCII signs separate words here, so that a copy with other punctuation has the same words.
_SIGNS = bytes(32 if chr(b) in string.punctuation else b for b in range(256))


def spoken(text: str | None) -> np.ndarray:
    """A hash for each word of the text, whatever its case and punctuation."""
    return ids_of((text or "").lower().encode("utf-8", "replace").translate(_SIGNS).split())


_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xFF51AFD7ED558CCD)
_S33 = np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _S33)) * _MUL
    return x ^ (x >> _S33)


def ngram_ids(ids: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash for each run of n words; for fewer words, one for the whole sequence;
    for none, none."""
    if not len(ids):
        return ids
    size = min(n, len(ids))
    out = np.zeros(len(ids) - size + 1, np.uint64)
    for k in range(size):
        out = mixed(out + ids[k : k + len(out)] + _MIX)
    return out if size == n else mixed(out + np.uint64(size))


def run_ids(words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash for the words at each place of several arrays, in this order."""
    out = np.zeros(len(words[0]), np.uint64)
    for w in words:
        out = mixed(out + w + _MIX)
    return out


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that few texts are Python objects at once; at
    the end, what the task has freed goes back to the system, as workers live on."""
    try:
        for table in batches:
            for a in range(0, table.num_rows, rows):
                yield table.slice(a, rows)
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def batches_of(table: pa.RecordBatch, *names: str) -> list[list]:
    return [table.column(n).to_pylist() for n in names]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def hash_sample(df: DataFrame, limit: int, seed: int, *by: str) -> DataFrame:
    """The limit rows whose columns by hash lowest. Their share is known from the count, so no task
    sends, and none receives, many rows more than these."""
    n = df.count()
    h = F.xxhash64(*(F.col(c) for c in by), F.lit(seed))
    few = df.where(F.pmod(h, F.lit(1 << 30)) < F.lit(int(min(1.0, (2 * limit + 100) / max(1, n)) * (1 << 30))))
    return few.orderBy(F.pmod(h, F.lit(1 << 30)), h, *by).limit(limit)


def crc_of(column: str):
    """crc32 of a column as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
