"""Quality by importance resampling (operator 5).

Two generative models are fitted over hashed n-grams, of four bytes and of one word: one of the
target text (labelled good: quality 1 and not toxic), one of the raw text (every document). From
their ratio a document gets a score, the mean log ratio over its four-byte grams, and a lapse: the
sum over those of its words that the target text lacks so clearly that chance can't be the reason
(a log ratio below LAPSE). The score tells junk, which is odd all over; the lapse tells insults,
which a mean over a long text hides. Cuts for both are what best tells labelled good from labelled
bad documents, among those that neither model's target sample holds.

The log weight is the summed log ratio above the cut of the score; a document whose lapse is below
its cut has no weight. k documents are drawn without replacement in proportion to their weights,
by adding Gumbel noise to the log weights and taking the k largest. k is the budget: a share of
the documents, or, where none is given, as many as weigh more than one.

Nulls and odd input: a document with null or empty text has no weight and is never drawn. Rows
that repeat a doc_id with the same text share their noise and fate. Without labelled bad
documents nothing tells what to reject, and every document with text is drawn. Rows of labels
with a null or an unknown doc_id teach nothing; of several for one document, the worst counts.
Documents that tie with the k-th stay, too. Texts are scored whole, however long; an empty table
gives no rows. Columns of a caller may have any names but those beginning with __ledgerline.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Hash buckets of the four-grams, as a power of two.
BUCKETS_LOG2 = 17
#: Hash buckets of the words, as a power of two.
WORDS_LOG2 = 18
#: Log ratios of words below this count as lapses: with SMOOTHING, the raw text leads to expect 13
#: or more in the target text where there is none, or 20 where there is one.
LAPSE = -2.0
#: At most so many labelled documents of each kind (good, bad) are used, those whose doc_id
#: hashes lowest: half for the target model, half for the cut.
LABELLED = 20_000
#: Added to the counts of every bucket, found and expected.
SMOOTHING = 2.0
#: Each cut leaves at least this share of the labelled good documents.
KEEP_GOOD = 0.99
_PARTS = 16


#: Names, for columns beside those of the caller, that a caller's columns don't have.
_GRAMS, _SCORE, _LAPSE, _KEY, _TEXT, _GOOD, _PART = (f"__ledgerline_{x}" for x in ("grams", "score", "lapse", "key", "text", "good", "part"))


@dataclass
class Resampler:
    ratio: np.ndarray  # bucket of four bytes -> log of target over raw
    words: np.ndarray  # bucket of a word -> the same, 0 where above LAPSE
    cut: float = -np.inf
    lapse_cut: float = -np.inf
    threshold: float = -np.inf


def buckets(joined: bytes) -> np.ndarray:
    """The bucket of the four bytes that start at each place but the last three."""
    b = np.frombuffer(joined, np.uint8).astype(np.uint32)
    g = (b[:-3] << np.uint32(24)) | (b[1:-2] << np.uint32(16)) | (b[2:-1] << np.uint32(8)) | b[3:]
    return (g * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS_LOG2)


#: Bytes as words are told apart: A-Z in lower case, ASCII signs and white space as spaces.
_PLAIN = bytes(32 if chr(b) in string.punctuation + string.whitespace else b for b in range(256)).lower()
#: Powers of an odd number modulo 2 ** 64, for a byte's place in its word; far bytes share the last.
_POWERS = np.multiply.accumulate(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def word_buckets(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(where each word starts, its bucket), whatever its case and the signs around it."""
    b = np.frombuffer(joined.translate(_PLAIN), np.uint8)
    inside = b != 32
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    at = np.flatnonzero(start)
    if not len(at):
        return at, at
    edges = np.concatenate(([0], at, [len(b)])).astype(np.int32)
    place = np.arange(len(b), dtype=np.int32) - np.repeat(edges[:-1], np.diff(edges))
    values = _POWERS[np.minimum(place, 255)] * b
    values[~inside] = 0
    return at, (common.mixed(np.add.reduceat(values, at)) >> np.uint64(64 - WORDS_LOG2)).astype(np.int64)


def sampled_labels(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """doc_id, good boolean, part (0: target model, 1: cut), at most limit of either kind."""
    good = F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1).otherwise(0)
    worst = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg((F.min(good) == 1).alias(_GOOD))
    kinds = [common.hash_sample(worst.where(F.col(_GOOD) == g), limit, 5, "doc_id") for g in (True, False)]
    return kinds[0].unionByName(kinds[1]).withColumn(_PART, F.pmod(F.xxhash64("doc_id", F.lit(55)), F.lit(2)).cast("int"))


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(sample), "doc_id", "left")  # bounded by LABELLED


def model_counts(rows: DataFrame) -> dict[int, np.ndarray]:
    """Bucket counts of raw text (0) and of the target (1) over rows (text, good, part): those of
    four bytes, then those of words. Each task sends one vector for each model, in slices, which
    are summed slice by slice."""
    size, more = 1 << BUCKETS_LOG2, 1 << WORDS_LOG2
    schema = pa.schema([("model", pa.int32()), ("slice", pa.int32()), ("counts", pa.binary())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size + more), np.int64)
        for table in common.sliced(batches):
            texts, good, part = common.batches_of(table, "text", _GOOD, _PART)
            for model in (0, 1):
                own = [t for t, g, p in zip(texts, good, part, strict=True) if t and (model == 0 or g and p == 0)]
                for _, joined, edges in common.text_slices(" \n " + t for t in own):
                    found = buckets(joined)
                    inside = np.ones(len(found), bool)
                    for k in (1, 2, 3):  # runs that begin in one text and end in the next
                        inside[edges[1:-1] - k] = False
                    sums[model, :size] += np.bincount(found[inside], minlength=size)
                    sums[model, size:] += np.bincount(word_buckets(joined)[1], minlength=more)
        for model in (0, 1):
            if sums[model].any():
                cut = sums[model].reshape(_PARTS, -1)
                yield common.batch(schema, [model] * _PARTS, range(_PARTS), [x.tobytes() for x in cut])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for table in common.sliced(batches):
            for x in table.to_pylist():
                key = x["model"], x["slice"]
                sums[key] = sums.get(key, 0) + np.frombuffer(x["counts"], np.int64)
        if sums:
            yield common.batch(schema, [k[0] for k in sums], [k[1] for k in sums], [v.tobytes() for v in sums.values()])

    kind = "model int, slice int, counts binary"
    parts = rows.select("text", _GOOD, _PART).mapInArrow(counted, kind).repartition("model", "slice").mapInArrow(summed, kind)
    out = np.zeros((2, _PARTS, (size + more) // _PARTS), np.int64)
    for model, k, counts in common.rows_of(parts):
        out[model, k] += np.frombuffer(counts, np.int64)
    return {m: x.reshape(-1) for m, x in enumerate(out)}


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log of target over raw for each bucket. The target count is held against the count that
    raw text leads to expect in as much text, so that what is rare in both tells little."""
    if not target.any():
        return np.zeros(len(raw), np.float32)
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + SMOOTHING) / (expected + SMOOTHING)).astype(np.float32)


def fitted(counts: dict[int, np.ndarray]) -> Resampler:
    size = 1 << BUCKETS_LOG2
    ratio, words = (log_ratio(counts[0][part], counts[1][part]) for part in (slice(size), slice(size, None)))
    return Resampler(ratio, np.where(words < LAPSE, words, 0).astype(np.float32))


def scored(rows: DataFrame, model: Resampler, keep: list[str]) -> DataFrame:
    """The columns keep, and of the whole text: grams long, score and lapse double (null if empty)."""
    shared = rows.sparkSession.sparkContext.broadcast((model.ratio, model.words))  # 2 ** BUCKETS_LOG2 and 2 ** WORDS_LOG2 floats
    own = rows.select(*keep, F.col("text").alias(_TEXT))
    out = own.drop(_TEXT).schema.add(_GRAMS, "long").add(_SCORE, "double").add(_LAPSE, "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, words = shared.value
        for table in common.sliced(batches):
            texts = table.column(_TEXT).to_pylist()
            n, sums, lapses = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.zeros(len(texts))
            for at, joined, edges in common.text_slices(" \n " + t if t else "    " for t in texts):
                w = ratio[buckets(joined)]
                for k in (1, 2, 3):
                    w[edges[1:-1] - k] = 0
                sums[at] = np.add.reduceat(w, edges[:-1], dtype=np.float64)
                n[at] = np.diff(edges) - 3
                starts, found = word_buckets(joined)
                lapses[at] = np.bincount(np.searchsorted(edges, starts, "right") - 1, words[found], len(at))
            none = np.array([not t for t in texts], bool)
            n[none] = 0
            added = [pa.array(n), pa.array(sums / np.maximum(n, 1), mask=none), pa.array(lapses, mask=none)]
            yield pa.RecordBatch.from_arrays([*table.drop_columns([_TEXT]).columns, *added], names=[*keep, _GRAMS, _SCORE, _LAPSE])

    return own.mapInArrow(score, out)


def best_cut(good: np.ndarray, bad: np.ndarray) -> float:
    """The score midway between two neighbours at which the shares of good documents kept and
    of bad ones rejected have the largest sum, among those that keep KEEP_GOOD of the good;
    -inf if one kind is missing."""
    if not len(good) or not len(bad):
        return -np.inf
    at = np.unique(np.concatenate((good, bad)))
    kept = 1 - np.searchsorted(np.sort(good), at) / len(good)
    rejected = np.searchsorted(np.sort(bad), at) / len(bad)
    k = int(np.argmax(np.where(kept >= KEEP_GOOD, kept + rejected, 0)))
    return float(at[k] + at[k - 1]) / 2 if k else -np.inf


def noised(model: Resampler) -> Column:
    """The log weight of a document with a Gumbel variate, drawn from its doc_id, added; null if it
    has no weight."""
    u = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(555)), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))
    weight = F.col(_GRAMS) * (F.col(_SCORE) - F.lit(float(model.cut) if np.isfinite(model.cut) else 0.0))
    return F.when(F.col(_LAPSE) >= F.lit(float(model.lapse_cut)), weight - F.log(-F.log(u)))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest number of a column, by counting into ever finer bins. At the end few
    enough are left in one bin to be sorted by the driver, or all in it are alike."""
    lo, hi, above = *values.agg(F.min(column), F.max(column)).first(), 0
    if lo is None:
        return np.inf
    while True:
        inside = values.where(F.col(column).between(lo, hi))
        n = inside.count()
        if n <= 10_000 or lo == hi:
            rest = sorted((r[0] for r in inside.select(column).limit(10_001).collect()), reverse=True)
            return rest[min(k - above, len(rest)) - 1] if n <= 10_000 else lo
        bins = 1024
        width = (hi - lo) / bins
        counts = dict(inside.groupBy(F.least(F.floor((F.col(column) - lo) / width), F.lit(bins - 1)).alias("b")).agg(F.struct(F.count("*"),
            F.min(column), F.max(column))).collect())
        for b in sorted(counts, reverse=True):
            if above + counts[b][0] >= k:
                lo, hi = counts[b][1], counts[b][2]
                break
            above += counts[b][0]


def fit(docs: DataFrame, labels: DataFrame, keep: list[str], budget: float | None = None) -> tuple[Resampler, DataFrame]:
    """The fitted model, and what it found of the documents that have a weight: the columns keep
    (doc_id among them), grams, score, lapse and key (the log weight with its noise). The texts are
    read twice, to count and to score. budget: the share of the documents to draw."""
    sample = common.saved(sampled_labels(labels), "labelled")
    counts = model_counts(with_labels(docs.select("doc_id", "text"), sample))
    model = fitted(counts)
    found = common.saved(with_labels(scored(docs, model, keep), sample), "scores")
    cutting = common.rows_of(found.where((F.col(_PART) == 1) & F.col(_SCORE).isNotNull()).select(_GOOD, _SCORE, _LAPSE))  # bounded by LABELLED
    good, score, lapse = (np.array(x) for x in zip(*cutting, strict=True)) if cutting else (np.zeros(0, bool), np.zeros(0), np.zeros(0))
    model.cut, model.lapse_cut = (best_cut(x[good], x[~good]) for x in (score, lapse))
    keyed = found.where(F.col(_SCORE).isNotNull()).withColumn(_KEY, noised(model)).where(F.col(_KEY).isNotNull()).drop(_GOOD, _PART)
    if budget is not None or np.isfinite(model.cut):
        worth = keyed if budget is not None else keyed.where(F.col(_SCORE) >= model.cut)
        k = round(budget * found.count()) if budget is not None else worth.count()
        model.threshold = kth_largest(keyed, _KEY, min(k, keyed.count())) if k else np.inf
    return model, keyed


def drawn(docs: DataFrame, labels: DataFrame, keep: list[str], budget: float | None = None) -> DataFrame:
    """The documents that are drawn: the columns keep, grams, score, lapse and key."""
    model, keyed = fit(docs, labels, keep, budget)
    return keyed.where(F.col(_KEY) >= F.lit(float(model.threshold)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents drawn: doc_id, score, lapse, log_weight (with its noise)."""
    docs, labels = common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drawn(docs.select("doc_id", "text"), labels, ["doc_id"]).select("doc_id", F.col(_SCORE).alias("score"),
        F.col(_LAPSE).alias("lapse"), F.col(_KEY).alias("log_weight"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drawn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), docs.columns).select(*docs.columns)
