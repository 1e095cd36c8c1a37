"""Benchmark decontamination (operator 9).

Seeds are triples of words in order, with at most one word left out between them, on either side:
so an item and an edited copy of it share seeds even if every third word is another one, or words
were put in. A seed that more than COMMON_ITEMS different items have, such as a run of a question's
template, is left to the rarer seeds of the same item; only an item without any rarer keeps its common
ones. Documents join the items on the seeds' hashes, which are sent in blocks of about BLOCK_WORDS
words of items, so that what is sent has a bound; every block meets all documents.

Where seeds of an item fall in a document, the stretch around them is aligned with the item's words by
Smith-Waterman (match 2, mismatch -1, gap -1). Words of an item's common runs weigh nothing, as they
say nothing about a copy: neither their matches nor their changes count. The score is
the best alignment's share of what a verbatim copy gets; from MIN_SCORE on, the document holds a copy,
paraphrased or edited. Before aligning, stretches are left out that no alignment can bring there: those
that hold too few of the item's words, and for items of LONG words or more those with one seed only.

Nulls and odd input: null or empty texts and items match nothing. An item of two or three words is
found verbatim only; a single word is no passage, and matches nothing. Of items that repeat an item_id,
each is looked for; an item without an item_id is looked for, and reported without one. Items that
repeat a text count as one for how common a seed is. Repeated documents repeat their result. Very long
texts are searched whole. Empty tables on either side give no rows and remove nothing. Other columns
are ignored, and kept by clean().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SEED_WORDS = 3
#: The words of a seed, from its first on.
WAYS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: Seeds of more different items are common.
COMMON_ITEMS = 20
MIN_SCORE = 0.5
#: Shorter items are found verbatim only; a copy of one of LONG words has more seeds than one.
SHORT, LONG = 4, 12
#: Words of the items that are sent at once, about; each is in three seeds of 16 bytes.
BLOCK_WORDS = 1_500_000
MATCH, MISMATCH, GAP = 2, -1, -1


def seeds_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the seeds of a text's words; two words are one seed."""
    if len(ids) < SEED_WORDS:
        return (common.ngram_ids(ids, 2), np.zeros(1, np.int64)) if len(ids) == 2 else (ids[:0], np.zeros(0, np.int64))
    grams, places = [], []
    for way in WAYS:
        n = len(ids) - way[-1]
        if n > 0:
            grams.append(common.run_ids([ids[k : k + n] for k in way]))
            places.append(np.arange(n))
    return np.concatenate(grams), np.concatenate(places)


@dataclass
class Seeds:
    """grams: sorted hashes of seeds; of gram k, the places first[k] to first[k + 1] - 1 in item
    and offset tell where it is. words: the word ids of each item; weights: 0 for those in
    common runs, 1 for others."""

    names: list[int | None]
    words: list[np.ndarray]
    weights: list[np.ndarray]
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    def __post_init__(self):
        self.shift = np.uint64(64 - min(26, max(16, len(self.grams).bit_length() + 3)))
        self.near = np.zeros(1 << (64 - int(self.shift)), bool)
        self.near[(self.grams >> self.shift).astype(np.int64)] = True
        self.sizes = np.array([len(w) for w in self.words])
        self.pairs = bool((self.sizes == 2).any())

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in the document, the numbers of the grams there)."""
        found = [seeds_of(ids)]
        if self.pairs and len(ids) > 2:
            found.append((common.ngram_ids(ids, 2), np.arange(len(ids) - 1)))
        places, numbers = [], []
        for grams, where in found:
            at = np.flatnonzero(self.near[(grams >> self.shift).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.grams, grams[at]), len(self.grams) - 1)
            same = self.grams[k] == grams[at]
            places.append(where[at[same]])
            numbers.append(k[same])
        return np.concatenate(places), np.concatenate(numbers)


def weighed(words: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, seeds, places) of an item, given the common seeds."""
    grams, places = seeds_of(words)
    weights = np.ones(len(words), np.int64)
    often = np.isin(grams, hot)
    for k in np.flatnonzero(often[: max(0, len(words) - SEED_WORDS + 1)]):  # the seeds without a gap are first
        weights[k : k + SEED_WORDS] = 0
    if often.all() or not weights.any():
        return np.ones(len(words), np.int64), grams, places
    return weights, grams[~often], places[~often]


def common_seeds(rows: DataFrame) -> DataFrame:
    """The seeds (gram, signed) that more than COMMON_ITEMS items of different words have."""
    schema = pa.schema([("gram", pa.int64()), ("own", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches, 200):
            for text in table.column("text").to_pylist():
                words = common.spoken(text)
                grams = np.unique(seeds_of(words)[0])
                if len(grams):
                    own = common.ngram_ids(words, len(words)).astype(np.int64)
                    yield common.batch(schema, grams.astype(np.int64), np.repeat(own, len(grams)))

    return rows.select("text").mapInArrow(found, "gram long, own long").distinct().groupBy("gram").count().where(F.col("count") > COMMON_ITEMS).select("gram")


def _grams(rows: DataFrame) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches, 200):
            own = [seeds_of(common.spoken(t))[0] for t in table.column("text").to_pylist()]
            yield common.batch(pa.schema([("gram", pa.int64())]), np.unique(np.concatenate([*own, np.zeros(0, np.uint64)])).astype(np.int64))

    return rows.select("text").mapInArrow(found, "gram long").distinct()


def blocks(benchmark: DataFrame, size: int = BLOCK_WORDS) -> Iterator[Seeds]:
    """The seeds of the items, block by block."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = -(-(rows.agg(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0] or 0) // size)
    often = common.saved(common_seeds(rows), "seeds") if n else None
    for k in range(n):
        block = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        own = sorted(common.rows_of(block), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        # no more than the block has seeds
        hot = np.array([g for (g,) in common.rows_of(often.join(_grams(block), "gram", "left_semi"))], np.int64).astype(np.uint64)
        words = [common.spoken(text) for _, text in own]
        found = [weighed(w, hot) for w in words]
        grams, offset = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.uint64) for i in (1, 2))
        if len(grams):
            item = np.repeat(np.arange(len(own)), [len(f[1]) for f in found])
            order = np.lexsort((offset, item, grams))
            each, first = np.unique(grams[order], return_index=True)
            yield Seeds([name for name, _ in own], words, [f[0] for f in found], each, np.append(first, len(grams)), item[order].astype(np.int32), offset[order].astype(np.int32))


def best_alignments(item: np.ndarray, stretches: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of an item with several stretches at once: the best score of each, and
    the place after its last word. A row of the matrix is filled for all stretches together;
    the gaps along it are a running maximum. What befalls a word of the item counts by its weight."""
    width = max(map(len, stretches))
    words = np.zeros((len(stretches), width), np.uint64)
    real = np.zeros((len(stretches), width), bool)
    for k, s in enumerate(stretches):
        words[k, : len(s)], real[k, : len(s)] = s, True
    slope = -GAP * np.arange(width + 1)
    row = np.zeros((len(stretches), width + 1), np.int32)
    best, last = np.zeros(len(stretches), np.int32), np.zeros(len(stretches), np.int64)
    for w, weight in zip(item, np.ones(len(item), int) if weights is None else weights, strict=True):
        own = np.maximum(row + GAP * weight, 0)
        own[:, 1:] = np.maximum(own[:, 1:], row[:, :-1] + np.where(real & (words == w), MATCH * weight, MISMATCH * weight))
        row = np.maximum.accumulate(own + slope, axis=1) - slope
        top = row.argmax(1)
        value = row[np.arange(len(stretches)), top]
        better = value > best
        best[better], last[better] = value[better], top[better]
    return best, last


def copies(ids: np.ndarray, seeds: Seeds, one: bool = False) -> list[tuple[int, float, int, int]]:
    """(item, score, end word, seeds) of each item that the words hold a copy of: its best. Items
    with the most seeds come first; with one, the first copy found is enough."""
    at, gram = seeds.hits(ids)
    if not len(at):
        return []
    n = seeds.first[gram + 1] - seeds.first[gram]
    k = np.repeat(seeds.first[gram], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item, start = seeds.item[k].astype(np.int64), np.repeat(at, n) - seeds.offset[k]
    order = np.lexsort((start, item))
    item, start = item[order], start[order]
    # seeds of an item that are more than its length apart are of different stretches
    new = np.concatenate(([True], (np.diff(item) != 0) | (np.diff(start) > seeds.sizes[item[1:]])))
    first, count = np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(item)))
    enough = (count > 1) | (seeds.sizes[item[first]] < LONG)
    first, count = first[enough], count[enough]
    stretches: dict[int, list[tuple[int, int, int]]] = {}
    for a, c, i in zip(first.tolist(), count.tolist(), item[first].tolist(), strict=True):
        stretches.setdefault(i, []).append((int(start[a]), int(start[a + c - 1]), c))
    out = []
    for i, own in sorted(stretches.items(), key=lambda x: -max(c for _, _, c in x[1])):
        words, weights = seeds.words[i], seeds.weights[i]
        size, total = len(words), int(weights.sum())
        least = MIN_SCORE if size >= SHORT else 1.0
        spans = [(max(0, a - size // 2), b + size + size // 2) for a, b, _ in own]
        # each match takes a word of the item that the stretch has, so fewer can't reach the least score
        spans = [(x, y) for x, y in spans if np.isin(words, ids[x:y]) @ weights >= least * total]
        found = []
        for a in range(0, len(spans), 64):
            best, last = best_alignments(words, [ids[x:y] for x, y in spans[a : a + 64]], weights)
            found += [(b / (MATCH * total), x + int(e)) for b, e, (x, _) in zip(best.tolist(), last.tolist(), spans[a : a + 64], strict=True)]
        score, end = max(found, default=(0.0, 0))
        if score >= least:
            out.append((i, score, end, sum(c for _, _, c in own)))
            if one:
                break
    return out


def leaks(docs: DataFrame, seeds: Seeds) -> DataFrame:
    """doc_id, item_id, score, end_word and n_seeds for each document and item it copies."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)  # one block of items
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64()), ("n_seeds", pa.int64())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            rows = []
            for name, text in zip(*common.batches_of(table, "doc_id", "text"), strict=True):
                rows += [(name, shared.value.names[i], s, e, n) for i, s, e, n in copies(common.spoken(text), shared.value)]
            if rows:
                yield common.batch(schema, *map(list, zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(found,
        "doc_id long, item_id long, score double, end_word long, n_seeds long")


def clean(docs: DataFrame, seeds: Seeds) -> DataFrame:
    """The rows of docs, with all their columns, that copy none of the items."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)  # one block of items

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            texts = table.column("text").to_pylist()
            yield table.filter(pa.array([not copies(common.spoken(t), shared.value, one=True) for t in texts], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = spark.createDataFrame([], "doc_id long, item_id long, score double, end_word long, n_seeds long")
    for seeds in blocks(benchmark):
        out = out.unionByName(leaks(docs, seeds))
    return out


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    for seeds in blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet")):
        docs = clean(docs, seeds)
    return docs
