"""Conversation structure repair by error-correcting Earley parsing (operator 11).

The roles of a conversation have to be a sentence of a small grammar. An Earley chart reads
the turns one by one; error productions let it delete a turn, give it another role or insert an
empty one, each at its cost, and blank or repeated turns can only be deleted. An item of the chart
keeps the least (cost, audit), the audit being the edits' initials in order; the least completed
item at the end is the repair. Rules end in their only nonterminal, so an item that predicts needs
nothing back from what it predicts: it hands its value on (a tail call), and a chart set holds
one item for each place in a rule, however long the conversation is.

That also lets a conversation be read in segments: rows are sorted by range, so a conversation
with a large share of all rows is spread over partitions, each of which is parsed from every item
that can be live where it begins; the few tables that this gives are then joined from left to right.
Rows that are the same in all columns are one row with a count until they are parsed. Only the
digest of a repaired conversation has to read it in one task, row by row.

Nulls and odd input: a null role or text is one space. Turns come by turn, null first, then role
and text. A conversation with a null conv_id is one like others; without rows it isn't there.
Roles that the grammar doesn't know are rerolled or deleted. Very long texts are never copied by
the parser, which sees roles and faults. An empty table gives empty tables. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: role initials: an optional system turn, then pairs of a user's and an assistant's turn. A rule
#: is a tuple of terminals that may end in one nonterminal.
ROLES = {"dialogue": [(), ("s", "turns"), ("turns",)], "turns": [("u", "a", "more")], "more": [(), ("turns",)]}
#: The roles that a turn can be given, or be inserted with, by their initials.
GIVEN = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
NONE, BLANK, REPEATED, CUT = 0, 1, 2, 3
#: Letters of an audit that a chart item holds itself; older ones are in a list that items share.
TAIL = 512


class Grammar:
    """Items are (rule, dot), numbered; those in the chart have a terminal next or are complete."""

    def __init__(self, rules: dict[str, list[tuple[str, ...]]], start: str):
        self.rules, self.terminal, self._numbers, self._after = rules, [], {}, {}
        self.start = self._predicted(start, 0, None)

    def _predicted(self, head: str, k: int, dot: int | None) -> list[int]:
        """The items with a terminal next, or complete, that an item leads to. dot None: all
        rules of head from their beginning."""
        if dot is None:
            return [i for j in range(len(self.rules[head])) for i in self._predicted(head, j, 0)]
        rule = self.rules[head][k]
        if dot < len(rule) and rule[dot] in self.rules:
            if dot + 1 < len(rule):
                raise ValueError("a nonterminal must end its rule")
            return self._predicted(rule[dot], 0, None)
        key = (head, k, dot) if dot < len(rule) else "complete"  # complete items differ in nothing
        if key not in self._numbers:
            self._numbers[key] = len(self.terminal)
            self.terminal.append(rule[dot] if dot < len(rule) else None)
            number = self._numbers[key]
            self._after[number] = self._predicted(head, k, dot + 1) if dot < len(rule) else []
        return [self._numbers[key]]

    def after(self, item: int) -> list[int]:
        return self._after[item]

    @property
    def complete(self) -> int:
        return self._numbers["complete"]


class Chart:
    """The current set of the chart: item -> (cost, rank, tail). The audit is the frozen letters
    at rank and then the tail. All frozen audits are of one length, so ranks order them."""

    def __init__(self, grammar: Grammar, items: Iterable[int]):
        self.grammar = grammar
        self.frozen: list[tuple] = [()]
        self.items = self._inserted({i: (0, 0, "") for i in items})

    def _inserted(self, items: dict) -> dict:
        agenda = list(items)
        while agenda:
            item = agenda.pop()
            cost, rank, tail = items[item]
            if self.grammar.terminal[item] in GIVEN:
                value = (cost + INSERT, rank, tail + "I")
                for i in self.grammar.after(item):
                    if i not in items or value < items[i]:
                        items[i] = value
                        agenda.append(i)
        return items

    def read(self, initial: str, fault: int) -> None:
        """One turn more."""
        new: dict[int, tuple] = {}
        for item, (cost, rank, tail) in self.items.items():
            offers = [(item, (cost + DELETE, rank, tail + "D"))]
            if fault not in (BLANK, REPEATED):
                terminal, more = self.grammar.terminal[item], cost + (TRUNCATED if fault == CUT else 0)
                if terminal == initial:
                    offers += [(i, (more, rank, tail + "K")) for i in self.grammar.after(item)]
                if terminal in GIVEN:
                    offers += [(i, (more + REROLE, rank, tail + "R")) for i in self.grammar.after(item)]
            for i, value in offers:
                if i not in new or value < new[i]:
                    new[i] = value
        self.items = self._inserted(new)
        if len(next(iter(self.items.values()))[2]) > 2 * TAIL:
            self._freeze()

    def _freeze(self) -> None:
        size = min(len(tail) for _, _, tail in self.items.values())
        heads = sorted({(rank, tail[:size]) for _, rank, tail in self.items.values()})
        ranks = {head: k for k, head in enumerate(heads)}
        self.items = {i: (cost, ranks[rank, tail[:size]], tail[size:]) for i, (cost, rank, tail) in self.items.items()}
        self.frozen = [(self.frozen[rank], letters) for rank, letters in heads]

    def found(self) -> dict[int, tuple[int, str]]:
        """item -> (cost, audit)."""
        out = {}
        for item, (cost, rank, tail) in self.items.items():
            letters, node = [tail], self.frozen[rank]
            while node:
                node, own = node
                letters.append(own)
            out[item] = (cost, "".join(reversed(letters)))
        return out


GRAMMAR = Grammar(ROLES, "dialogue")


class Way:
    """Follows an audit over the turns of a segment, from the items on that are live where it begins."""

    def __init__(self, conv, seg, items: list[int], audit: str):
        self.conv, self.seg, self.items, self.audit, self.step = conv, seg, items, audit, 0

    def _over(self, *terminals: str) -> str:
        terminal = next(t for t in (GRAMMAR.terminal[i] for i in self.items) if t in terminals)
        self.items = [j for i in self.items if GRAMMAR.terminal[i] == terminal for j in GRAMMAR.after(i)]
        return terminal

    def inserted(self) -> Iterator[tuple]:
        """The turns that are inserted here: conv_id, seg, step, edit, role, text."""
        while self.step < len(self.audit) and self.audit[self.step] == "I":
            self.step += 1
            yield self.conv, self.seg, self.step, "I", GIVEN[self._over(*GIVEN)], ""

    def read(self, role: str, text: str) -> Iterator[tuple]:
        """What becomes of the next turn, after the insertions before it."""
        yield from self.inserted()
        edit = self.audit[self.step]
        self.step += 1
        if edit == "K":
            self._over(role[:1])
        elif edit == "R":
            role = GIVEN[self._over(*GIVEN)]
        yield self.conv, self.seg, self.step, edit, role, text


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


_TABLE = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("split", pa.bool_()), ("illegal", pa.int64()), ("first", pa.string()),
    ("last", pa.string()), ("found", _TABLE)])
SEGMENT = ("conv_id long, seg long, split boolean, illegal long, first string, last string, "
    "found array<struct<entry:int,exit:int,cost:long,audit:string>>")
PIECE = "conv_id long, seg long, entry int, illegal long, cost long, audit string"


def faults(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text), equal rows as one with their number (copies), with the
    fault of the first copy. A row repeats another if one with its role and text is earlier; further
    copies of a row are blank or repeated."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", F.sha2("text", 256))
    rows = rows.withColumn("end", F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1))
    at = F.struct(F.col("turn").isNotNull().alias("k"), "turn")
    first = rows.where("end <> ''").groupBy("conv_id", "role", "digest").agg(F.min(at)["turn"].alias("turn"))
    first = first.select(*(F.col(c).alias(f"_{c}") for c in first.columns))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("conv_id", "turn")] + [F.col(c) == F.col(f"_{c}") for c in ("role", "digest")]
    fault = F.when(F.col("end") == "", BLANK).when(F.col("_digest").isNull(), REPEATED).when(~F.col("end").isin(".", "!", "?"), CUT).otherwise(NONE)
    return rows.join(first, same, "left").select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


def ordered(rows: DataFrame) -> DataFrame:
    """The rows with their place in the order of all rows, and their segment: the partition in
    which they were sorted. Saved, so that both stay."""
    at = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(32))).sortWithinPartitions("conv_id", "turn", "role", "text")
    at = at.withColumn("place", F.monotonically_increasing_id())
    return common.saved(at.withColumn("seg", F.shiftrightunsigned("place", 33)), "turns")


def _stream(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for table in common.sliced(batches):
        yield from zip(*common.batches_of(table, *names), strict=True)


def segments(rows: DataFrame) -> DataFrame:
    """Each segment of a conversation, parsed from the start or, if it isn't the conversation's
    first, from every item. One that is whole is completed."""
    narrow = rows.select("conv_id", "seg", "place", F.left("role", F.lit(1)).alias("initial"), "fault", "copies")
    ends = narrow.groupBy("conv_id").agg(F.min("seg").alias("lo"), F.max("seg").alias("hi")).where("lo < hi").withColumnRenamed("conv_id", "_c")
    own = narrow.join(ends, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")

    def told(key, charts, illegal, first, last, split):
        if not split:
            cost, audit = charts[-1].found()[GRAMMAR.complete]
            found = [(-1, GRAMMAR.complete, cost, audit)]
        else:
            found = [(entry, item, *value) for entry, chart in charts.items() for item, value in chart.found().items()]
        rows = [dict(zip(("entry", "exit", "cost", "audit"), x, strict=True)) for x in found]
        return common.batch(_SEGMENT, [key[0]], [key[1]], [split], [illegal], [first], [last], [rows])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        for conv, seg, initial, fault, copies, lo in _stream(batches, "conv_id", "seg", "initial", "fault", "copies", "lo"):
            if key != (conv, seg):
                if key is not None:
                    yield told(key, charts, illegal, first, last, split)
                key, split, illegal, first, last = (conv, seg), lo is not None, 0, initial, None
                entries = range(len(GRAMMAR.terminal)) if split and seg != lo else [-1]
                charts = {e: Chart(GRAMMAR, GRAMMAR.start if e < 0 else [e]) for e in entries}
            for k in range(copies):
                illegal += last is not None and not legal(last, initial)
                last = initial
                for chart in charts.values():
                    chart.read(initial, (BLANK if fault == BLANK else REPEATED) if k else fault)
        if key is not None:
            yield told(key, charts, illegal, first, last, split)

    return own.repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "place").mapInArrow(parsed, SEGMENT)


def joined(parts: pd.DataFrame) -> pd.DataFrame:
    """The segments of one conversation, in order: the least way through their tables."""
    parts = parts.sort_values("seg")
    live, illegal, last, back = {-1: (0, ())}, [], None, []
    for own in parts.itertuples():
        now: dict[int, tuple] = {}
        for row in own.found:
            if row["entry"] in live:
                cost, before = live[row["entry"]]
                value, old = (cost + row["cost"], (*before, row["audit"])), now.get(row["exit"])
                # audits are only written out where costs tie
                if old is None or (value[0], "".join(value[1]) if value[0] == old[0] else "") < (old[0], "".join(old[1]) if value[0] == old[0] else ""):
                    now[row["exit"]] = value
                    back.append((own.Index, row["exit"], row))
        illegal.append(own.illegal + (last is not None and not legal(last, own.first)))
        live, last = now, own.last
    chosen = {(at, item): row for at, item, row in back}
    rows, item = [], GRAMMAR.complete
    for own, n in zip(reversed(list(parts.itertuples())), reversed(illegal), strict=True):
        row = chosen[own.Index, item]
        rows.append((own.conv_id, own.seg, row["entry"], n, row["cost"], row["audit"]))
        item = row["entry"]
    out = pd.DataFrame(rows, columns=["conv_id", "seg", "entry", "illegal", "cost", "audit"])
    return out.astype({"conv_id": "Int64"})


@dataclass
class Repair:
    """rows: the turns as read, in order, with their faults. pieces: of each segment the least
    edits. conversations: illegal, cost and audit of each."""

    rows: DataFrame
    pieces: DataFrame

    @property
    def conversations(self) -> DataFrame:
        in_order = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seg", "audit"))), lambda x: x["audit"]), "")
        return self.pieces.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"), in_order.alias("audit"))

    @property
    def turns(self) -> DataFrame:
        """conv_id, seg, step (their order), edit, role and text of every edit; a deleted turn
        has its own role and text."""
        rows = self.rows.select("conv_id", "seg", "place", "role", "text", "copies", F.lit(None).cast("int").alias("entry"), F.lit(None).cast("string").alias("audit"))
        heads = self.pieces.select("conv_id", "seg", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"),
            F.lit(1).cast("long").alias("copies"), "entry", "audit")
        schema = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

        def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            held = 0
            for row in _edits(_stream(batches, "conv_id", "seg", "role", "text", "copies", "entry", "audit")):
                out.append(row)
                held += len(row[5])
                if len(out) >= 1000 or held > 1 << 22:
                    yield common.batch(schema, *map(list, zip(*out, strict=True)))
                    out, held = [], 0
            if out:
                yield common.batch(schema, *map(list, zip(*out, strict=True)))

        both = rows.unionByName(heads).repartition("conv_id", "seg").sortWithinPartitions("conv_id", "seg", "place")
        return both.mapInArrow(edited, "conv_id long, seg long, step long, edit string, role string, text string")


def _edits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows of segments, each after its head (entry, audit): conv_id, seg, step, edit, role, text."""
    way = None
    for conv, seg, role, text, copies, entry, audit in rows:
        if audit is not None:
            if way is not None:
                yield from way.inserted()
            way = Way(conv, seg, GRAMMAR.start if entry < 0 else [entry], audit)
        else:
            for _ in range(copies):
                yield from way.read(role, text)
    if way is not None:
        yield from way.inserted()


def repair(turns: DataFrame) -> Repair:
    """turns: conv_id, turn, role, text."""
    rows = ordered(faults(turns))
    own = common.saved(segments(rows), "segments")
    whole = own.where("not split").select("conv_id", "seg", F.col("found")[0]["entry"].alias("entry"), "illegal", F.col("found")[0]["cost"].alias("cost"),
        F.col("found")[0]["audit"].alias("audit"))
    # as many rows as the conversation has segments
    parts = own.where("split").groupBy("conv_id").applyInPandas(joined, PIECE)
    return Repair(rows, common.saved(whole.unionByName(parts), "pieces"))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and the hash of its ``role:text`` lines, read in order as they come."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = [], None
        for conv, role, text in _stream(batches, "conv_id", "role", "text"):
            if state is None or own[-1] != conv:
                if state is not None:
                    yield common.batch(schema, own, [state.hexdigest()])
                own, state = [conv], hashlib.sha256(f"{role}:{text}".encode())
            else:
                state.update(f"\n{role}:{text}".encode())
        if state is not None:
            yield common.batch(schema, own, [state.hexdigest()])

    kept = turns.where("edit <> 'D'").repartition("conv_id").sortWithinPartitions("conv_id", "seg", "step")
    return kept.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults to mend, by the hash of conversation and turn."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), shown("role").alias("role"),
        shown("text").alias("text"), (F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20).alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    return rows.where("k <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repaired_digests(conversations: DataFrame, found: Repair) -> DataFrame:
    """A row for each conv_id of conversations: its gaps, faults, edits and the hash of the repair."""
    n = lambda fault, more: F.sum(F.when(F.col("fault") == fault, 1).otherwise(0) + more)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0))
    again = F.when(F.col("fault") == BLANK, 0).otherwise(F.col("copies") - 1)
    blank_again = F.when(F.col("fault") == BLANK, F.col("copies") - 1).otherwise(0)
    counts = found.rows.groupBy("conv_id").agg(gaps.alias("gaps"), n(BLANK, blank_again).alias("blank"), n(REPEATED, again).alias("duplicate"),
        n(CUT, F.lit(0)).alias("truncated"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for side in (counts, found.conversations, digests(found.turns)):
        side = side.withColumnRenamed("conv_id", "_c")
        out = out.join(side, F.col("conv_id").eqNullSafe(F.col("_c")), "left").drop("_c")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256",
        F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op11_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired_digests(conversations, repair(damaged(conversations)))
