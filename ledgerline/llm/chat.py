"""Chat formatting with offset-aligned loss masks (operator 3).

A conversation is rendered whole, as ``<|turn|>role<|text|>text<|end|>`` for each turn. The
three marks are special tokens, so no token spans a mark and a text. Control strings inside
roles and texts, of this template and of other common ones, get a backslash after their first
character (one more if they have some already), which is undone when the text is read back.
The rendered text is encoded once, with offsets; the sorted spans of the assistant's texts
meet the sorted token spans by binary search, and those tokens bear the loss.

Nulls and odd input: null texts and roles are empty; rows are ordered by turn, null first, and
then by role and text, so ties and repeated rows have a place; rows with a null conv_id form
one conversation. An empty table gives no rows. A conversation is one row of the result, so
one that holds very much text needs as much memory in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .token_store import groups

# The marks of the template, and control strings that texts mustn't hold.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
_CONTROL = r"\||s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>"
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_CONTROL})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_CONTROL})")

FORMATTED = "conv_id long, n_turns long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()), ("ids", pa.list_(pa.int32())),
    ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("loss", pa.list_(pa.bool_()))]
)


def escaped(text: str) -> str:
    return _PLAIN.sub(r"\1\\\2", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation, and where in it the assistant's texts are."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        at += len(head)
        if role == "assistant":
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for turn in formatted.split(TURN)[1:]:
        role, _, text = turn.partition(TEXT)
        out.append((unescaped(role), unescaped(text.removesuffix(END))))
    return out


def loss_mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens share a character with one of the spans; all are in order."""
    mask = np.zeros(len(starts), bool)
    if spans:
        a, b = np.array(spans).T
        for i, k in zip(np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left"), strict=True):
            mask[i:k] = True
    return mask


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The text under each run of masked tokens, unescaped. Tokens that share a character (its
    bytes are in several) have the same span, so a run goes from its first start to its last
    end."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], loss, [False])).astype(np.int8)))
    return [unescaped(formatted[starts[i] : ends[k - 1]]) for i, k in zip(edges[::2], edges[1::2], strict=True)]


_tokenizers: dict[str, object] = {}


def marked_tokenizer(path: str):
    """The tokenizer with the marks as special tokens, whose ids follow its vocabulary's."""
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.add_special_tokens([TURN, TEXT, END])
        _tokenizers[path] = own
    return _tokenizers[path]


def formatted(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Each conversation rendered and encoded: text, token ids, their offsets and loss mask."""
    turns = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))).alias("turns")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = marked_tokenizer(tokenizer_path)
        for table in common.sliced(batches):
            names, turns = common.batches_of(table, "conv_id", "turns")
            whole = [rendered([(t["role"], t["text"]) for t in own]) for own in turns]
            for a, b in groups([x[0] for x in whole]):
                found = tokenizer.encode_batch([x[0] for x in whole[a:b]], add_special_tokens=False)
                rows = []
                for (_, spans), e in zip(whole[a:b], found, strict=True):
                    starts, ends = np.array(e.offsets, np.int32).reshape(-1, 2).T
                    rows.append((np.array(e.ids, np.int32), starts, ends, loss_mask(spans, starts, ends)))
                yield common.batch(_FORMATTED, names[a:b], [len(t) for t in turns[a:b]], [x[0] for x in whole[a:b]], *map(list, zip(*rows, strict=True)))

    return turns.mapInArrow(encoded, FORMATTED)


def digested(found: DataFrame) -> DataFrame:
    """What is read back from the formatted conversations, as digests."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            rows = []
            for name, text, starts, ends, loss in zip(*common.batches_of(table, "conv_id", "formatted", "starts", "ends", "loss"), strict=True):
                turns = read_turns(text)
                under = "".join(loss_texts(text, np.array(starts, np.int64), np.array(ends, np.int64), np.array(loss, bool)))
                rows.append((name, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(under), sha(under), len(text)))
            if rows:
                yield common.batch(schema, *map(list, zip(*rows, strict=True)))

    return found.mapInArrow(told, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    own = "</s>[INST] ok [/INST]"
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"), "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return digested(formatted(rows.unionByName(more), public_tokenizers.path("byte_bpe_50k.json")))
