"""Ranked lexical search by the threshold algorithm (operator 13).

The terms of all queries are looked for in every document, once: a document's forward entry holds
its number of terms and, of each query term in it, how often it occurs. What the entries sum
up to (documents, terms, documents for a term) gives the terms' weights, and with these each
occurrence an integer impact. Entries are searched shard by shard, a shard being some thousand
entries that a task holds as arrays: impact-sorted lists for sorted access, entries sorted by
document for random access. For each query its terms' lists are read round-robin, a few ranks of
every list at a time; each new document's whole score comes from the forward entries; once the
sum of the last impacts read falls strictly below the kth score, no unseen document can come in, not
even by a tie. A task carries its k best from shard to shard, so later shards stop early. The
tasks' lists of k are merged by a window.

All is integer arithmetic but the logarithm in a term's weight, which is taken in doubles.

The queries' terms are taken in blocks of about BLOCK_TERMS, whole queries at a time, so that what
is sent to the executors has a bound; each further block is another pass over the documents.

Nulls and odd input: a null text has no terms and doesn't count as a document; a query without
terms finds nothing. Of documents that repeat a doc_id, each row is one and may be listed; a null
doc_id comes after others of its score. Queries that repeat an item_id are answered row by row.
Ties go to the smaller doc_id. Very long texts count whole. Empty tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Documents that a query lists.
TOP = 10
#: Terms of the queries that are sent at once, about.
BLOCK_TERMS = 1_000_000
#: Forward entries of a shard hold so many postings, about (24 bytes each, three times over).
SHARD_POSTINGS = 500_000
#: Ranks of each list that one round of sorted access reads.
RANKS = 16

#: ASCII but letters and digits parts terms; A-Z becomes a-z; other characters are parts of terms.
_TERMS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()

FORWARD = "doc_id long, n long, terms array<int>, counts array<int>"
_FORWARD = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
FOUND = "query long, doc_id long, score long"
_FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_TERMS).split()


def forward(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """The forward entry of each document with terms."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # one block of terms

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for table in common.sliced(batches):
            rows = []
            for doc, text in zip(*common.batches_of(table, "doc_id", "text"), strict=True):
                words = terms_of(text)
                if words:
                    own = np.fromiter((k for k in map(number, words) if k is not None), np.int32)
                    rows.append((doc, len(words), *np.unique(own, return_counts=True)))
            if rows:
                yield common.batch(_FORWARD, *map(list, zip(*rows, strict=True)))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(entries, FORWARD)


@dataclass
class Statistics:
    """documents with terms, their terms with repeats, and the documents that hold each term."""

    documents: int
    terms: int
    holding: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        return np.floor(1000 * np.log((2.0 * self.documents + 2) / (2.0 * self.holding + 1))).astype(np.int64)


def statistics(entries: DataFrame, n_terms: int) -> Statistics:
    n, total = entries.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = np.zeros(n_terms, np.int64)
    for term, docs in common.rows_of(entries.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*"))):  # one block of terms
        held[term] = docs
    return Statistics(n, total, held)


class Shard:
    """Some forward entries, with their impacts."""

    def __init__(self, docs: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray, stats: Statistics, weights: np.ndarray):
        self.docs, self.n_terms = docs, len(weights)
        of = np.repeat(np.arange(len(docs)), sizes)
        m = 100 - 75 + (75 * lengths * stats.documents) // max(1, stats.terms)
        tf = counts.astype(np.int64)
        impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[of]))
        # random access: entries by document, terms in order
        self.keys, self.impacts = of * self.n_terms + terms, impact
        # sorted access: each term's documents, the greatest impact first
        order = np.lexsort((of, -impact, terms))
        self.list_docs, self.list_impacts = of[order], impact[order]
        self.first = np.searchsorted(terms[order], np.arange(self.n_terms + 1))

    def scores(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Random access: the whole scores of documents."""
        wanted = docs[:, None] * self.n_terms + terms[None, :]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (np.where(self.keys[at] == wanted, self.impacts[at], 0) * times).sum(1)

    def search(self, terms: np.ndarray, times: np.ndarray, best: list[tuple], k: int) -> list[tuple]:
        """The k best of best and of this shard: (-score, doc_id is null, doc_id)."""
        here = self.first[terms + 1] > self.first[terms]
        terms, times = terms[here], times[here]
        if not len(terms):
            return best
        first, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        seen = np.zeros(len(self.docs), bool)
        for depth in range(0, int(size.max()), RANKS):
            at = depth + np.arange(RANKS)
            there = at[None, :] < size[:, None]
            new = np.unique(self.list_docs[(first[:, None] + at[None, :])[there]])
            new = new[~seen[new]]
            seen[new] = True
            if len(new):
                score = self.scores(new, terms, times)
                least = -best[k - 1][0] if len(best) >= k else 1
                good = score >= least
                if good.any():
                    more = [(-s, d is None, d or 0) for s, d in zip(score[good].tolist(), (self.docs[i] for i in new[good]), strict=True)]
                    best = sorted(best + more)[:k]
            # what an unseen document can reach: the last impact read of each list, none of one that is read to its end
            last = np.where(depth + RANKS < size, self.list_impacts[first + np.minimum(depth + RANKS, size) - 1], 0)
            threshold = int((last * times).sum())
            if threshold <= 0 or (len(best) >= k and threshold < -best[k - 1][0]):
                break
        return best


def searched(entries: DataFrame, queries: list[tuple[int, np.ndarray, np.ndarray]], stats: Statistics, k: int) -> DataFrame:
    """The k best of every task for each query (number, terms, times): query, doc_id, score."""
    shared = entries.sparkSession.sparkContext.broadcast((queries, stats, stats.weights))  # one block of terms

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, postings = [], 0
        for table in common.sliced(batches):
            held.append(table)
            postings += len(table.column("terms").flatten())
            if postings >= SHARD_POSTINGS:
                yield held
                held, postings = [], 0
        if held:
            yield held

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, stats, weights = shared.value
        best: dict[int, list[tuple]] = {q: [] for q, _, _ in queries}
        for tables in shards(batches):
            join = lambda name: np.concatenate([t.column(name).flatten().to_numpy() for t in tables])
            docs = np.array(list(chain.from_iterable(t.column("doc_id").to_pylist() for t in tables)), object)
            lengths = np.concatenate([t.column("n").to_numpy() for t in tables])
            sizes = np.concatenate([np.diff(t.column("terms").offsets.to_numpy()) for t in tables])
            shard = Shard(docs, lengths, sizes, join("terms").astype(np.int64), join("counts"), stats, weights)
            for q, terms, times in queries:
                best[q] = shard.search(terms, times, best[q], k)
        rows = [(q, None if null else doc, -score) for q, own in best.items() for score, null, doc in own]
        if rows:
            yield common.batch(_FOUND, *map(list, zip(*rows, strict=True)))

    return entries.mapInArrow(found, FOUND)


def blocks(items: DataFrame, size: int) -> Iterator[tuple[dict[bytes, int], list[tuple], list[tuple]]]:
    """The items block by block: (term -> number, queries, (query, item_id))."""
    rows = items.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    n = -(-(rows.agg(F.sum(F.length("text"))).first()[0] or 0) // (2 * size))  # a term takes two characters at least
    for k in range(n):
        own = sorted(common.rows_of(rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        numbers: dict[bytes, int] = {}
        queries, names = [], []
        for q, (name, text) in enumerate(own):
            terms = [numbers.setdefault(t, len(numbers)) for t in terms_of(text)]
            if terms:
                queries.append((q, *np.unique(np.array(terms, np.int64), return_counts=True)))
                names.append((q, name))
        if queries:
            yield numbers, queries, names


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP, size: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score: each item's k best documents."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for numbers, queries, names in blocks(items, size):
        entries = common.saved(forward(docs, numbers), "forward")
        lists = searched(entries, queries, statistics(entries, len(numbers)), k)
        best = lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = spark.createDataFrame(names, "query long, item_id long")
        out = out.unionByName(best.join(named, "query").select("item_id", "rank", "doc_id", "score"))
    return out


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(common.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
