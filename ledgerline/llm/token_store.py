"""Token ids in fixed-width bit packing (operator 7).

A store is a folder of Parquet files. A row is a block: whole documents, in ascending order,
whose ids are packed in the fewest bits that hold the vocabulary. Beside the packed bytes a
block carries its documents' ids and the offset of each one's first id within the block, and
the number of ids before it in its shard. A document is thus found by its doc_id range
(min_doc, max_doc are plain columns with Parquet statistics) and unpacked without reading its
neighbours; a whole block is unpacked by a fixed number of numpy operations.

Nulls and odd input: a null or empty text has only the end id; rows with a null doc_id come
first; rows that repeat a doc_id are kept, in order of a hash of their text; a very long text is
one block of its own size; an empty table gives an empty store, and reading that gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: A block is closed once it holds so many ids.
BLOCK_IDS = 1 << 16
#: A worker remembers the ids of about so many pieces that it met in two groups of texts, and
#: for a while those of so many that it met in one.
PIECE_CACHE, RECENT_CACHE = 200_000, 150_000
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 3 << 20

STORE = "shard int, block int, bits int, before long, n_ids long, min_doc long, max_doc long, doc_ids array<long>, starts array<long>, packed binary"
_STORE = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("bits", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
    ("min_doc", pa.int64()), ("max_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ("packed", pa.binary())]
)


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids in ``bits`` bits each, least significant first, padded to 64 ids. 64 ids fill
    exactly ``bits`` 64-bit words, so the k-th id of every such group sits at the same place."""
    n = -(-len(ids) // 64)
    x = np.zeros(n * 64, np.uint64)
    x[: len(ids)] = ids
    x = x.reshape(n, 64).T
    out = np.zeros((bits, n), np.uint64)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        out[word] |= x[k] << np.uint64(shift)
        if shift + bits > 64:
            out[word + 1] |= x[k] >> np.uint64(64 - shift)
    return out.T.astype("<u8").tobytes()


def unpack(packed: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """The ids at start to stop - 1; only the groups of 64 that hold them are read."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    first, last = start // 64, -(-stop // 64)
    words = np.frombuffer(packed, "<u8", (last - first) * bits, first * bits * 8).reshape(last - first, bits).T
    mask = np.uint64((1 << bits) - 1)
    out = np.empty((64, last - first), np.uint32)
    for k in range(64):
        word, shift = divmod(k * bits, 64)
        x = words[word] >> np.uint64(shift)
        if shift + bits > 64:
            x = x | (words[word + 1] << np.uint64(64 - shift))
        out[k] = x & mask
    return out.T.reshape(-1)[start - first * 64 : stop - first * 64]


#: A stop or comma that was cut off, but not from a letter or digit: signs in a row stay together.
_RUN_OF_SIGNS = re.compile(r"\x00[.,](?<=[\W_]\x00.)")


class Pieces:
    """Pieces of texts and their ids: those of piece k are the size[k] ids of flat from start[k]."""

    def __init__(self, texts: list[str] | pa.Array = (), flat: np.ndarray | None = None, size: np.ndarray | None = None):
        self.texts = pa.array(texts, pa.string()) if isinstance(texts, (list, tuple)) else texts
        self.flat = np.zeros(0, "<u4") if flat is None else flat
        self.size = np.zeros(0, np.int64) if size is None else size
        self.start = np.cumsum(self.size) - self.size

    def __len__(self) -> int:
        return len(self.size)

    def find(self, texts: pa.Array) -> np.ndarray:
        """The number of each text, -1 for those that aren't here."""
        return pc.fill_null(pc.index_in(texts, value_set=self.texts), -1).to_numpy(zero_copy_only=False)

    def take(self, k: np.ndarray) -> Pieces:
        return Pieces(self.texts.take(pa.array(k)), spread(self.flat, self.start[k], self.size[k]), self.size[k])

    def plus(self, other: Pieces) -> Pieces:
        return Pieces(pa.concat_arrays([self.texts, other.texts]), np.concatenate((self.flat, other.flat)), np.concatenate((self.size, other.size)))


def spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches of flat that begin at start, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """The ids of texts, as the tokenizer file gives them, in little-endian 32 bits.

    A byte-level pre-tokenizer never joins two letters, digits or signs across a single space
    or a single line feed between them: the space opens the next piece and the line feed is a
    piece of its own. So texts without other white space are cut there and put together from
    the ids of their pieces. The tokenizer encodes the pieces that are not remembered, many at
    a time as lines of one text. Any other text goes to it whole, and so does a text that holds an
    added token of the file, which the tokenizer takes for that token.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        self.size = self.tokenizer.get_vocab_size()
        kind = self.tokenizer.pre_tokenizer
        plain = type(kind).__name__ == "ByteLevel" and not kind.add_prefix_space and getattr(kind, "use_regex", True) and self.tokenizer.normalizer is None
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.cuts = plain and len(line) == 1 and not any("\n" in x for x in self.added)
        self.line = line[0] if self.cuts else None
        if self.cuts:
            from tokenizers import pre_tokenizers

            self.letters = Tokenizer.from_file(path)
            self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            space = self.tokenizer.id_to_token(self.tokenizer.encode(" ", add_special_tokens=False).ids[0])
            self.spaced = np.array([str(self.tokenizer.id_to_token(k)).startswith(space) for k in range(self.size)])
        self.recent, self.known = Pieces(), Pieces(["", "\n"], np.array(line, "<u4"), np.array([0, len(line)]))

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def marked(text: str) -> str | None:
        """The text with its pieces parted by a null character: at single spaces and line feeds,
        and before a full stop or comma at the end of a word; None if it has other white space."""
        if text[:1] in " \n" or text[-1:] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return None
        if not text.replace("\n", "").isprintable():
            return None
        marked = text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ") + "\x00"
        finer = marked.replace(".\x00", "\x00.\x00").replace(",\x00", "\x00,\x00")
        return (marked if _RUN_OF_SIGNS.search(finer) else finer)[:-1]

    def learned(self, pieces: list[str]) -> Pieces:
        """The ids of different pieces, in another order. A run of letters stays whole in the
        pre-tokenizer, so such pieces do without its regular expression, which takes most of the
        time; those with a space before them are told apart by their first ids, which have it. The
        rest are encoded as the lines of one text."""
        letters = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        rest = [p for p in pieces if not (p[0] == " " and p[1:].isalpha())]
        flat, size = [], []
        for k in range(0, len(letters), 1024):
            own = letters[k : k + 1024]
            ids = np.array(self.letters.encode_batch_fast([own], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(own):
                raise ValueError("the tokenizer joins pieces")
            flat.append(ids)
            size.append(np.diff(np.append(at, len(ids))))
        for k in range(0, len(rest), 4096):
            own = rest[k : k + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(own)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ids == self.line)
            if len(at) != len(own) - 1:
                raise ValueError("the tokenizer joins lines")
            flat.append(ids[ids != self.line])
            size.append(np.diff(np.concatenate(([-1], at, [len(ids)]))) - 1)
        return Pieces(letters + rest, np.concatenate(flat), np.concatenate(size)) if flat else Pieces()

    def of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where in them each of the different pieces begins, how many it has), remembered or
        learned now."""
        start, size = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        left, before, flat, again = np.arange(len(pieces)), 0, [], np.zeros(0, np.int64)
        new = None
        for held in (self.known, self.recent, None):
            if held is None:
                held = new = self.learned(pieces.to_pylist())
            k = held.find(pieces)
            hit = k >= 0
            start[left[hit]], size[left[hit]] = before + held.start[k[hit]], held.size[k[hit]]
            again = k[hit] if held is self.recent else again
            flat.append(held.flat)
            before += len(held.flat)
            left, pieces = left[~hit], pieces.filter(pa.array(~hit))
        if len(again) and len(self.known) < PIECE_CACHE:
            self.known = self.known.plus(self.recent.take(again))
        if len(self.recent) >= RECENT_CACHE:
            self.recent = Pieces()
        if len(new):
            self.recent = self.recent.plus(new.take(np.flatnonzero(pc.utf8_length(new.texts).to_numpy() < 32)))
        return np.concatenate(flat), start, size

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Arrow cuts the texts and numbers the different pieces; numpy
        lays their ids out in the order of the texts."""
        marked = [self.marked(t) if self.cuts and t and not any(x in t for x in self.added) else None for t in texts]
        out = [b""] * len(texts)
        plain = [k for k, m in enumerate(marked) if m is not None]
        if plain:
            lists = pc.split_pattern(pa.array([marked[k] for k in plain]), "\x00")
            coded = pc.dictionary_encode(lists.values)
            flat, start, size = self.of_pieces(coded.dictionary)
            codes = coded.indices.to_numpy()
            whole = spread(flat, start[codes], size[codes]).tobytes()
            edges = (np.concatenate(([0], np.cumsum(size[codes])))[lists.offsets.to_numpy()] * 4).tolist()
            for k, i, j in zip(plain, edges, edges[1:], strict=False):
                out[k] = whole[i:j]
        odd = [k for k, m in enumerate(marked) if m is None and texts[k]]
        for k, ids in zip(odd, self.whole([texts[k] for k in odd]), strict=True):
            out[k] = ids.tobytes()
        return out


def groups(texts: list[str | None], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts with about limit characters together."""
    first = held = 0
    for k, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_of(spark: SparkSession, tokenizer_path: str) -> int:
    """The size of a tokenizer's vocabulary, found by a task: the driver loads no tokenizer."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            yield pa.RecordBatch.from_pydict({"n": [encoder(tokenizer_path).size] * table.num_rows})

    return spark.range(1, numPartitions=1).mapInArrow(told, "n long").first()[0]


def write(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, vocabulary: int | None = None, block_ids: int = BLOCK_IDS,
        order: tuple[str, ...] = ("doc_id", "text")) -> None:
    """Encodes each document's whole text, appends end_id, and writes the store to path.

    docs: doc_id long, text string and the columns of order. One range shuffle of the texts puts
    the documents in order; each task then streams its range into blocks. Rows that repeat a
    doc_id are dealt out by a hash of their text, so no range has to hold them all.
    """
    bits = bits_for(vocabulary or max(vocabulary_of(docs.sparkSession, tokenizer_path), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = encoder(tokenizer_path), TaskContext.get().partitionId()
        ids: list[bytes] = []
        names: list[int] = []
        starts: list[int] = []
        held = before = block = 0

        def closed() -> pa.RecordBatch:
            known = [n for n in names if n is not None]
            packed = pack(np.frombuffer(b"".join(ids), "<u4"), bits)
            return common.batch(_STORE, [shard], [block], [bits], [before], [held], [min(known, default=None)], [max(known, default=None)],
                [names], [starts], [packed])

        for table in common.sliced(batches):
            found, texts = common.batches_of(table, "doc_id", "text")
            for a, b in groups(texts):
                for name, one in zip(found[a:b], encode([t or "" for t in texts[a:b]]), strict=True):
                    names.append(name)
                    starts.append(held)
                    ids.append(one + end)
                    held += len(one) // 4 + 1
                    if held >= block_ids:
                        yield closed()
                        before, block, held = before + held, block + 1, 0
                        ids, names, starts = [], [], []
        if names:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *(c for c in order if c not in ("doc_id", "text")))
    ranges = [F.xxhash64("text") if c == "text" else F.col(c) for c in order]
    ordered = rows.repartitionByRange(common.shuffle_parts(docs.sparkSession), *ranges).sortWithinPartitions(*ranges)
    with common.batch_rows(docs.sparkSession, 1000):
        ordered.mapInArrow(blocks, STORE).write.option("compression", "none").parquet(path)


def shard_starts(store: DataFrame) -> DataFrame:
    """shard, base: the ids in the shards before it. Shards follow the order of doc_id, so the
    running sum is taken over one row for each shard (as many as the write had tasks)."""
    sums = store.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    rows = sorted((r["shard"], r["n"]) for r in sums.collect())
    at, out = 0, []
    for shard, n in rows:
        out.append((shard, at))
        at += n
    return store.sparkSession.createDataFrame(out, "shard int, base long")


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The documents of a store: doc_id, start (ids of all documents before it), n_tokens, and
    ids (array<int>), or, with digest, ids_crc32 of the ids as unsigned 32-bit integers."""
    store = spark.read.schema(STORE).parquet(path)
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.list_(pa.int32()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            for x in table.to_pylist():
                ids = unpack(x["packed"], x["bits"], 0, x["n_ids"])
                edges = [*x["starts"], x["n_ids"]]
                each = [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)]
                kept = [zlib.crc32(e.astype("<u4").tobytes()) for e in each] if digest else [e.astype(np.int32) for e in each]
                yield common.batch(schema, x["doc_ids"], [x["base"] + x["before"] + s for s in x["starts"]], [len(e) for e in each], kept)

    found = store.join(F.broadcast(shard_starts(store)), "shard")  # a row for each task of the write
    return found.mapInArrow(rows, "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digest else "ids array<int>"))


def lookup(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """The ids of one document, by random access: only blocks whose range holds it are read."""
    rows = spark.read.schema(STORE).parquet(path).where((F.col("min_doc") <= doc_id) & (F.col("max_doc") >= doc_id)).where(F.array_contains("doc_ids", doc_id))
    out = []
    for x in rows.toLocalIterator():
        edges = [*x["starts"], x["n_ids"]]
        out += [unpack(bytes(x["packed"]), x["bits"], a, b) for d, a, b in zip(x["doc_ids"], edges, edges[1:], strict=False) if d == doc_id]
    return out


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, common.documents(spark, sf_dir))


def encoded(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Writes all documents to a new store in the shared folder and reads them back."""
    import public_tokenizers

    path = common.new_path(spark, "tokens")
    write(docs, public_tokenizers.path("byte_bpe_50k.json"), path, end_id=0, **options)
    return read(spark, path, digest=True)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The store is in the order of the rows of docs: that of the mix, which they were written in.
    Where docs are no files, their rows have no order, and doc_id gives it."""
    try:
        placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException:
        return encoded(spark, docs)
    return encoded(spark, placed, order=("file", "row"))
