"""Language identification by prediction by partial matching (operator 2).

For each language a context tree over bytes, of orders 0 to 3, is fitted and then frozen. The
code length of a byte comes from the longest context that the language has seen: a byte seen
there costs -log2(count / (total + distinct)), any other byte costs the escape
-log2(distinct / (total + distinct)) and then what it costs one order lower; below order 0 all
256 bytes are alike. A text's language is the one that codes the whole text in the fewest
bits; the score is that language's share when every language is as likely beforehand.

Because the statistics are frozen, the cost of a byte depends on at most three bytes before
it. The trees of all languages share one set of contexts. A context holds only the bytes that some
language has seen there, as a bitmap with the place of their costs; any other byte goes on to the
next shorter context. So the model's size is that of what was seen, and the table that leads from
three bytes to their context is bounded by 257 ** 3 numbers.

Contexts of order 3 seen fewer than LEAST_CONTEXT times, in all languages together, are left out:
code lengths are exactly those of trees without these contexts.

Nulls and odd input: a null text, or one without any letter, is ``und`` with score 0; so is
every text if nothing could be learned. Rows with a null language or text teach nothing. A
null doc_id counts as not held out. Ties go to the language first in code point order. Texts are
coded whole, however long; an empty table gives no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: The models are fitted on so many documents of each language at most: those whose doc_id
#: hashes lowest. Their texts are used whole.
DOCS_PER_LANGUAGE = 400
#: Contexts of order 3 seen less often than this, in all languages together, are not kept.
LEAST_CONTEXT = 4


@dataclass
class Model:
    languages: list[str]
    symbol: np.ndarray  # byte -> symbol; bytes never seen share the last symbol
    row: np.ndarray  # three symbols -> their longest kept context; context 0 is the empty one
    parent: np.ndarray  # context -> the next shorter one, -1 for the empty one
    seen: np.ndarray  # (context, word) -> bitmap of the symbols seen there by any language
    first: np.ndarray  # (context, word) -> place of the costs of the word's first symbol
    costs: np.ndarray  # (place, language) -> code length
    escape: np.ndarray  # (context, language) -> code length of going on to the parent

    def lengths(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """(symbol, language) -> code length of each symbol in its context."""
        width = self.seen.shape[1]
        word, bit = context * width + (symbol >> 6), (symbol & 63).astype(np.uint64)
        own = self.seen.reshape(-1)[word]
        place = self.first.reshape(-1)[word] + np.bitwise_count(own & ((np.uint64(1) << bit) - np.uint64(1)))
        known = (own >> bit & np.uint64(1)).astype(bool)
        out = self.costs.take(np.where(known, place, 0), axis=0)
        rest = np.flatnonzero(~known)
        if len(rest):
            out[rest] = self.escape[context[rest]] + self.below(self.parent[context[rest]], symbol[rest])
        return out

    def below(self, parent: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        out = np.full((len(parent), self.costs.shape[1]), 8.0, np.float32)
        inside = np.flatnonzero(parent >= 0)
        if len(inside):
            out[inside] = self.lengths(parent[inside], symbol[inside])
        return out


def training_rows(docs: DataFrame, limit: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """At most limit rows (lang, text) of each language. The share to keep is known from the
    counts, so few rows more than these reach the window that settles the exact number."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text", F.xxhash64(F.col("doc_id"), F.lit(2)).alias("h"))
    counts = rows.groupBy("lang").count().collect()  # one row for each language
    if not counts:
        return rows.select("lang", "text").limit(0)
    share = F.lit(None)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2 * limit / r["count"]))).otherwise(share)
    few = rows.where(F.pmod(F.col("h"), F.lit(1 << 20)) < share * (1 << 20))
    order = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    return few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= limit).select("lang", "text")


def fit(docs: DataFrame, limit: int = DOCS_PER_LANGUAGE) -> Model:
    """docs: doc_id, text, lang. The counts of four-byte runs are taken on the executors; what
    reaches the driver is bounded by limit and the number of languages."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(*common.batches_of(table, "lang", "text"), strict=True):
                by.setdefault(lang, []).append(b"\n\n\n" + text.encode("utf-8", "replace"))
            for lang, texts in by.items():
                grams = []
                for t in texts:
                    b = np.frombuffer(t, np.uint8).astype(np.int64)
                    grams.append((b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:])
                g, n = np.unique(np.concatenate(grams), return_counts=True)
                yield common.batch(schema, [lang] * len(g), g, n)

    rows = training_rows(docs, limit).mapInArrow(counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    return built(np.array(rows["lang"].to_pylist(), object), rows["gram"].to_numpy().astype(np.int64), rows["n"].to_numpy().astype(np.int64))


def built(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Model:
    """The model from the counts of four-byte runs of each language: contexts order by order, each
    order's costs from those one order lower."""
    languages = sorted(set(lang))
    number = np.searchsorted(languages, lang) if languages else np.zeros(0, np.int64)
    known = np.zeros(256, bool)
    for shift in (24, 16, 8, 0):
        known[(gram >> shift) & 255] = True
    known[10] = True
    a = int(known.sum()) + 1
    symbol = np.full(256, a - 1, np.int64)
    symbol[known] = np.arange(a - 1)
    s = [symbol[(gram >> shift) & 255] for shift in (24, 16, 8, 0)]
    context, last = (s[0] * a + s[1]) * a + s[2], s[3]
    width = -(-a // 64)
    empty = lambda kind, *shape: np.zeros((0, *shape), kind)
    model = Model(languages, symbol, np.zeros(1, np.int32), empty(np.int64), empty(np.uint64, width), empty(np.int64, width),
        empty(np.float32, len(languages)), empty(np.float32, len(languages)))
    row = np.full(1, -1)  # context of the last order -> its number
    for order in range(4):
        pairs, at = np.unique((context % a**order) * a + last, return_inverse=True)
        counts = np.zeros((len(pairs), len(languages)))
        np.add.at(counts, (at, number), n)
        own, of = np.unique(pairs // a, return_inverse=True)
        if order == 3:
            many = np.bincount(of, counts.sum(1), len(own)) >= LEAST_CONTEXT
            keep = many[of]
            pairs, counts = pairs[keep], counts[keep]
            own, of = np.unique(pairs // a, return_inverse=True)
        base = len(model.parent)
        shorter = row[own % a ** (order - 1)] if order else np.full(len(own), -1)
        total, kinds = np.zeros((len(own), len(languages))), np.zeros((len(own), len(languages)))
        np.add.at(total, of, counts)
        np.add.at(kinds, of, counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2(total + kinds) - np.log2(kinds), 0)
            seen_cost = np.log2(total + kinds)[of] - np.log2(counts)
        below = model.below(shorter[of], pairs % a)
        costs = np.where(counts > 0, seen_cost, escape[of] + below)
        bits, first = np.zeros((len(own), width), np.uint64), np.zeros((len(own), width), np.int64)
        y = pairs % a
        np.bitwise_or.at(bits, (of, y >> 6), np.uint64(1) << (y & 63).astype(np.uint64))
        in_word = np.bitwise_count(bits).astype(np.int64)  # pairs are in order of context and symbol
        first[:] = (np.cumsum(in_word.reshape(-1)) - in_word.reshape(-1)).reshape(first.shape) + len(model.costs)
        longer = np.tile(row, a) if order else np.full(1, -1)  # a longer context begins as its last symbols' number
        longer[own] = base + np.arange(len(own))
        row = longer
        model.parent = np.append(model.parent, shorter)
        model.seen, model.first = np.concatenate((model.seen, bits)), np.concatenate((model.first, first))
        model.costs = np.concatenate((model.costs, costs.astype(np.float32)))
        model.escape = np.concatenate((model.escape, escape.astype(np.float32)))
    model.row = row.astype(np.int32)
    return model


def code_lengths(model: Model, texts: list[str | None]) -> np.ndarray:
    """(text, language) -> bits for the whole text."""
    out = np.zeros((len(texts), len(model.languages)))
    a = round(len(model.row) ** (1 / 3))
    lead = "\n\n\n"
    for at, joined, edges in common.text_slices(lead + (t or "") for t in texts):
        s = model.symbol[np.frombuffer(joined, np.uint8)]
        context = np.zeros(len(s), np.int64)
        context[3:] = (s[:-3] * a + s[1:-2]) * a + s[2:-1]
        bits = model.lengths(model.row[context].astype(np.int64), s)
        starts = edges[:-1]
        for k in range(len(lead)):
            bits[starts + k] = 0
        out[at] = np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
    return out


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns keep, lang_pred string and score double, for the whole text of each row."""
    spark = docs.sparkSession
    told = docs.select(*keep, F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("_text"))
    if not model.languages:
        return told.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # bounded: symbols, kept contexts and languages
    out = told.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for table in common.sliced(batches):
            texts = table.column("_text").to_pylist()
            bits = code_lengths(m, texts)
            best = bits.argmin(1)
            score = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
            none = [t is None for t in texts]
            names = [None if x else m.languages[b] for x, b in zip(none, best, strict=True)]
            columns = [*table.drop_columns(["_text"]).columns, pa.array(["und" if x is None else x for x in names], pa.string()),
                pa.array(np.where(none, 0.0, score))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    return told.mapInArrow(scored, out)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).withColumn("held_out", F.coalesce(F.pmod(common.crc_of("doc_id"), F.lit(3)) == 1, F.lit(False)))
    model = fit(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"])
