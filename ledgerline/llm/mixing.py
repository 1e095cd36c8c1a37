"""Mixing sources to target weights (operator 1).

Each source's documents are put in an order that hashing gives and cut, across documents, into
blocks of nearly equal size. The schedule is a low-discrepancy sequence: slot i gets the
van der Corput point of i, which falls into the stretch of the source's share of all slots, and
the k-th slot of a source takes its k-th block, beginning anew after the last one. So every
stretch of the schedule has the sources in nearly the wanted shares. Slots past a source's
target are dropped and slots that it lacks follow at the end, so the words taken are exactly
the target, rounded; the last slot of a source may take part of a block.

Targets: the sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3 and so on, and
share all words by weight; no target exceeds MOST_REPEATS times its source's words, and what
is cut off is shared by weight among the others until none exceeds it.

Nulls and odd input: a null or empty text has no words, and nothing is taken from it; a null
source is a source; rows that repeat a doc_id are mixed as documents of their own; an empty
table, or one without words, gives targets of 0. A very long text is cut into many blocks like
any other. Other columns are ignored, and kept by resampled(). What the driver holds is one row
for each source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

BLOCK_WORDS = 4096
MOST_REPEATS = 3
WEIGHTS = (1, 2, 3)
#: Slots and documents are numbered in groups of about so many, so no source's rows have to
#: meet in one task.
GROUP = 4096
_HASH = 1 << 40


@dataclass
class Share:
    """What the mix takes from one source."""

    number: int
    source: str | None
    size: int
    target: float
    blocks: int = 0
    slots: int = 0

    @property
    def words(self) -> int:
        return round(self.target)

    def plan(self, block_words: int) -> None:
        if self.size and self.words:
            self.blocks = -(-self.size // block_words)
            whole, rest = divmod(self.words, self.size)
            self.slots = whole * self.blocks + (self.block_of(rest - 1) + 1 if rest else 0)

    def block_of(self, word: int) -> int:
        least, longer = divmod(self.size, self.blocks)
        edge = longer * (least + 1)
        return word // (least + 1) if word < edge else longer + (word - edge) // least


def shares(sizes: dict[str | None, int], block_words: int = BLOCK_WORDS) -> list[Share]:
    """The targets of the sources, and how many slots each needs."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), list(order)
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if per * weight[s] > MOST_REPEATS * sizes[s]]
        if not full:
            target |= {s: per * weight[s] for s in open_}
            break
        for s in full:
            target[s] = float(MOST_REPEATS * sizes[s])
            left -= target[s]
        open_ = [s for s in open_ if s not in target]
    found = [Share(k, s, sizes[s], max(0.0, target[s])) for k, s in enumerate(order)]
    for x in found:
        x.plan(block_words)
    return found


def words_of(column: str) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size of each document, and key: a hash of its text, so that rows that
    repeat a doc_id, or have none, are dealt out like others."""
    doc_id, source = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source")
    return docs.select(doc_id, source, words_of("text").alias("size"), F.xxhash64("text").alias("key"))


def plan_rows(spark: SparkSession, found: list[Share]) -> DataFrame:
    """One row for each source, with its stretch of the unit interval by slots."""
    total, at, rows = max(1, sum(x.slots for x in found)), 0, []
    for x in found:
        rows.append((x.number, x.source, x.size, x.target, x.words, x.blocks, x.slots, at / total, (at + x.slots) / total))
        at += x.slots
    return spark.createDataFrame(rows, "number int, source string, source_size long, target double, words long, blocks long, slots long, lo double, hi double")


def block_start(k: Column) -> Column:
    """The first word of block k of a source of source_size words in blocks blocks."""
    return k * F.expr("source_size div blocks") + F.least(k, F.expr("source_size % blocks"))


def schedule(spark: SparkSession, plan: DataFrame, found: list[Share]) -> DataFrame:
    """slot, number, block, take: the mix in order; take words from the start of the block."""
    total = sum(x.slots for x in found)
    cells = 1 << max(4, (4 * len(found)).bit_length())
    point = F.conv(F.reverse(F.lpad(F.bin("id"), 52, "0")), 2, 10).cast("double") / float(1 << 52)
    slots = spark.range(total).select(F.col("id").alias("slot"), point.alias("u")).withColumn("cell", F.floor(F.col("u") * cells))
    stretches = plan.where("slots > 0").select("number", "slots", "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    dealt = slots.join(stretches, "cell").where("u >= lo and u < hi").select("slot", "number", "slots", F.expr(f"slot div {GROUP}").alias("g"))
    before = dealt.groupBy("number", "g").agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.partitionBy("number").orderBy("g")) - F.col("n"))
    inside = F.row_number().over(Window.partitionBy("number", "g").orderBy("slot")) - 1
    ranked = dealt.withColumn("rank", inside).join(before.drop("n"), ["number", "g"]).select("slot", "number",
        (F.col("before") + F.col("rank")).alias("rank"), "slots")
    counts = dealt.groupBy("number").agg(F.count("*").alias("n"))
    lacking = plan.join(counts, "number", "left").withColumn("n", F.coalesce("n", F.lit(0))).where("slots > n")
    late = lacking.select("number", F.explode(F.sequence(F.col("n"),
        F.col("slots") - 1)).alias("rank")).select((total + F.col("rank") * len(found) + F.col("number")).alias("slot"), "number", "rank")
    every = ranked.where("rank < slots").drop("slots").unionByName(late).join(plan.select("number", "source_size", "words", "blocks"), "number")
    epoch, k = F.expr("rank div blocks"), F.expr("rank % blocks")
    left = F.col("words") - epoch * F.col("source_size") - block_start(k)
    return every.select("slot", "number", k.alias("block"), F.least(block_start(k + 1) - block_start(k), left).alias("take"))


def pieces(rows: DataFrame, plan: DataFrame, n_rows: int) -> DataFrame:
    """The documents cut at the blocks' edges: number, block, at (where in the block), words,
    and offset, the document's first word in its source, which names the row, doc_id and size."""
    groups = max(1, n_rows // GROUP)
    h = F.pmod(F.xxhash64(F.col("doc_id"), F.col("key"), F.lit(1)), F.lit(_HASH))
    own = rows.where("size > 0").join(plan.select("number", "source", "source_size", "blocks"), rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    own = own.withColumn("h", h).withColumn("g", F.floor(F.col("h") / F.lit(_HASH) * groups))
    sums = own.groupBy("number", "g").agg(F.sum("size").alias("n"))
    sums = sums.withColumn("before", F.sum("n").over(Window.partitionBy("number").orderBy("g")) - F.col("n")).drop("n")
    inside = F.sum("size").over(Window.partitionBy("number", "g").orderBy("h", "doc_id", "key",
        "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = own.withColumn("inside", inside).join(sums, ["number", "g"]).withColumn("offset", F.col("before") + F.col("inside"))
    edge = F.expr("(source_size % blocks) * (source_size div blocks + 1)")
    block_of = lambda w: F.when(w < edge,
        F.floor(w / F.expr("source_size div blocks + 1"))).otherwise(F.expr("source_size % blocks") + F.floor((w - edge) / F.expr("source_size div blocks")))
    cut = placed.select("number", "doc_id", "size", "offset", "source_size", "blocks",
        F.explode(F.sequence(block_of(F.col("offset")), block_of(F.col("offset") + F.col("size") - 1))).alias("block"))
    start, stop = F.greatest("offset", block_start(F.col("block"))), F.least(F.col("offset") + F.col("size"), block_start(F.col("block") + 1))
    return cut.select("number", "block", "doc_id", "size", "offset", (start - block_start(F.col("block"))).alias("at"),
        (stop - start).alias("words"), (start - F.col("offset")).alias("first_word"))


@dataclass
class Mix:
    rows: DataFrame  # doc_id, source, size, key of every document
    plan: DataFrame
    taken: DataFrame  # slot, number, doc_id, size, offset, first_word, words: the mix in order of slot


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS) -> Mix:
    """docs: doc_id, source, text."""
    spark = docs.sparkSession
    rows = common.saved(sized(docs), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    found = shares({r["source"]: r["size"] for r in sums}, block_words)
    plan = plan_rows(spark, found)
    slots = schedule(spark, plan, found)
    joined = pieces(rows, plan, sum(r["n"] for r in sums)).join(slots, ["number", "block"]).where(F.col("at") < F.col("take"))
    words = F.least("words", F.col("take") - F.col("at")).alias("words")
    return Mix(rows, plan, joined.select("slot", "number", "doc_id", "size", "offset", "first_word", words))


def takings(found: Mix) -> DataFrame:
    """Of every document: doc_id, source, size, source_size, target and taken."""
    sums = found.taken.groupBy("number", "doc_id", "size", "offset").agg(F.sum("words").alias("taken"))
    # Rows alike in doc_id, source and size are matched in any order; each gets one sum.
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0)))
    every = found.rows.join(found.plan, found.rows["source"].eqNullSafe(found.plan["source"])).drop(found.plan["source"])
    every = every.withColumn("nth", nth("number", "doc_id", "size"))
    sums = sums.withColumn("nth", nth("number", "doc_id", "size"))
    both = every.alias("a").join(sums.alias("b"),
        (F.col("a.number") == F.col("b.number")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.size") == F.col("b.size"))
        & (F.col("a.nth") == F.col("b.nth")), "left")
    return both.select("a.doc_id", "a.source", "a.size", "a.source_size", "a.target", F.coalesce("b.taken", F.lit(0)).cast("long").alias("taken"))


#: Names for columns beside a caller's.
_KEY, _SHARE, _SLOT, _PERIOD, _COPY = (f"__ledgerline_{x}" for x in ("key", "share", "slot", "period", "copy"))


def resampled(docs: DataFrame) -> DataFrame:
    """The rows of docs in the order of the mix, each as often as the mix takes its words: a whole
    number of times, rounded up with the probability of what is left over, so that the words of a
    source come near its target and short shares don't all vanish. A row's first copy comes where
    its first block has its slot, and the next ones a round of its source's blocks later each.

    Rows are known by a hash of doc_id, source and text; equal rows share their slots."""
    own = docs.withColumn(_KEY, F.xxhash64(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text")))
    found = mix(own.select(F.col(_KEY).alias("doc_id"), "source", "text"))
    sizes = found.rows.groupBy("doc_id").agg(F.sum("size").alias("all_words"))
    total = F.sum("slots").over(Window.partitionBy())  # over the plan: one row for each source
    period = found.plan.where("blocks > 0").select("number", (total * F.col("blocks") / F.col("slots")).alias("period"))
    taken = found.taken.groupBy("number", "doc_id").agg(F.sum("words").alias("words"), F.min("slot").alias("first"))
    per = taken.join(sizes, "doc_id").join(period, "number")
    per = per.select(F.col("doc_id").alias(_KEY), (F.col("words") / F.col("all_words")).alias(_SHARE), F.col("first").alias(_SLOT),
        F.col("period").alias(_PERIOD))
    luck = F.pmod(F.xxhash64(F.col(_KEY), F.lit(11)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    times = F.floor(F.col(_SHARE) + luck).cast("int")
    rows = own.join(per, _KEY).where(times > 0).withColumn(_COPY, F.explode(F.sequence(F.lit(0), times - 1)))
    rows = rows.withColumn(_SLOT, F.col(_SLOT) + F.col(_COPY) * F.col(_PERIOD))
    parts = common.shuffle_parts(docs.sparkSession)
    return rows.repartitionByRange(parts, _SLOT, _KEY).sortWithinPartitions(_SLOT, _KEY).select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return takings(mix(common.documents(spark, sf_dir)))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resampled(docs)
