"""Personal data: patterns, and terms that give it away (operator 12).

Fixed patterns find e-mail addresses, IP addresses, card and telephone numbers; the values found are
the protected entities. The corpus then says which other terms reveal them. What a term t tells of an
entity e is their pointwise mutual information over documents, ln(N * n(t near e) / (n(t) * n(e))), near
being within WINDOW terms of a mention; what there is to tell is e's information, ln(N / n(e)). A
term that tells SHARE of it or more, at least LEAST nats, and does so in SUPPORT different
surroundings (copies of a text are one), discloses the entity wherever it stands. It is generalised
to its first letters, if all terms with these letters together disclose nothing, and removed
otherwise. Patterns' values are replaced by their kind.

Pairs of term and entity come from the surroundings of mentions only, so there are at most
2 * WINDOW for a mention; pairs are summed before they are shuffled. Candidates and disclosing terms
are sent to the executors in blocks of BLOCK_TERMS; each further block of candidates is another pass
over the documents.

Nulls and odd input: a null text is empty. Documents that repeat a doc_id, or have none, are rows of
their own. Very long texts are searched whole, in linear time. Without documents, or where
nothing is disclosed, only the patterns' spans are left. Other columns are ignored, and kept by
sanitised(). Terms inside a pattern's span aren't candidates.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .ranked_search import _TERMS, terms_of

# The kinds in their order, and the patterns.
KINDS = ["email", "ip", "card", "phone"]
TERM = "term"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PART = re.compile(r"[0-9]+")

#: Terms on either side of a mention that are near it.
WINDOW = 10
#: Different surroundings, and documents, in which a term has to be near an entity.
SUPPORT = 3
#: The share of an entity's information that a term mustn't tell, and what it has to tell at least, in nats.
SHARE, LEAST = 0.8, 3.0
#: Letters that are left of a generalised term; shorter terms can't be generalised.
LETTERS = 3
#: Terms that are sent at once.
BLOCK_TERMS = 200_000

_PLAIN = {b: chr(_TERMS[b]) for b in range(128) if _TERMS[b] != b}
_WORD = re.compile(r"[^ ]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ is looked at once, back over what may stand before it and on over the domain."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        domain = _DOMAIN.match(text, at + 1) if a < at else None
        if domain:
            end = domain.end()
            out.append((a, end))
        at = text.find("@", max(at + 1, end))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    out = []
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") >= 3:
            parts = list(_PART.finditer(text, chain.start(), chain.end()))
            for four in (parts[k : k + 4] for k in range(0, len(parts) - 3, 4)):
                if all(len(p.group().lstrip("0")) <= 3 and int(p.group().lstrip("0") or 0) <= 255 for p in four):
                    out.append((four[0].start(), four[3].end()))
    return out


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_PART.findall(text))


def cards(text: str) -> list[tuple[int, int]]:
    found = ((m.span(), _digits(m.group())) for m in _CARD.finditer(text) if m.end() - m.start() >= 14)
    return [span for span, digits in found if 14 <= len(digits) <= 19 and luhn(digits)]


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' values, in order."""
    if not text:
        return []
    return sorted((a, kind, b) for kind, find in enumerate((emails, addresses, cards, phones)) for a, b in find(text))


def entity(kind: int, value: str) -> int:
    """A hash for a value, however it is written."""
    plain = value.lower() if kind == 0 else ".".join(p.lstrip("0") or "0" for p in value.split(".")) if kind == 1 else _digits(value)
    return xxhash.xxh64_intdigest(f"{KINDS[kind]}:{plain}") >> 1


def placed_terms(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, term) of the terms that no span touches."""
    starts, out = [a for a, _, _ in spans], []
    ends = np.maximum.accumulate([b for _, _, b in spans]).tolist() if spans else []
    for m in _WORD.finditer(text.translate(_PLAIN)):
        k = bisect_left(starts, m.end())
        if k == 0 or ends[k - 1] <= m.start():
            out.append((m.start(), m.end(), m.group()))
    return out


def general(term: str) -> str | None:
    """The first letters of a term, as terms with the same."""
    return f"{term[:LETTERS]}*" if len(term) > LETTERS else None


def surroundings(text: str) -> Iterator[tuple[str, int, int, int]]:
    """(term, entity, hash of the surroundings, 1 if this is the text's first of the pair). The
    general forms of terms come, too; the entity itself has the empty term."""
    spans = base_spans(text)
    if not spans:
        return
    terms = placed_terms(text, spans)
    starts, seen = [a for a, _, _ in terms], set()
    for a, kind, b in spans:
        who, k = entity(kind, text[a:b]), bisect_left(starts, a)
        near = [t for _, _, t in terms[max(0, k - WINDOW) : k + WINDOW]]
        where = xxhash.xxh64_intdigest(" ".join(near)) >> 1
        forms = dict.fromkeys(near) | dict.fromkeys(g for g in map(general, near) if g)
        for t in ("", *forms):
            yield t, who, where if t else 0, int((t, who) not in seen)
            seen.add((t, who))


PAIRS = "term string, entity long, place long, docs long"
_PAIRS = pa.schema([("term", pa.string()), ("entity", pa.int64()), ("place", pa.int64()), ("docs", pa.int64())])


def pairs(docs: DataFrame) -> DataFrame:
    """term, entity, places (different surroundings) and docs of every pair that is near."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches, 200):
            rows = [row for t in table.column("text").to_pylist() if t for row in surroundings(t)]
            if rows:
                yield common.batch(_PAIRS, *map(list, zip(*rows, strict=True)))

    places = docs.select("text").mapInArrow(found, PAIRS).groupBy("term", "entity", "place").agg(F.sum("docs").alias("docs"))
    return places.groupBy("term", "entity").agg(F.count("*").alias("places"), F.sum("docs").alias("docs"))


def _blocks(terms: DataFrame, size: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """The rows of a table of distinct terms, so many at once."""
    n = -(-terms.count() // size)
    for k in range(n):
        yield common.rows_of(terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == k))


class Forms(dict):
    """term (bytes) -> its general form or None."""

    def __missing__(self, term: bytes) -> str | None:
        if len(self) >= common.WORD_CACHE:
            self.clear()
        found = self[term] = general(term.decode())
        return found


def frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n: in how many documents each of the terms is, and of general ones any of theirs."""
    schema = pa.schema([("term", pa.string()), ("n", pa.int64())])
    out = docs.sparkSession.createDataFrame([], "term string, n long")
    for block in _blocks(terms):
        whole = frozenset(t.encode() for (t,) in block if not t.endswith("*"))
        heads = frozenset(t for (t,) in block if t.endswith("*"))
        shared = docs.sparkSession.sparkContext.broadcast((whole, heads))  # one block of terms

        def counted(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            (whole, heads), form = shared.value, Forms()
            for table in common.sliced(batches):
                n: Counter[str] = Counter()
                for text in table.column("text").to_pylist():
                    words = set(terms_of(text))
                    n.update(w.decode() for w in words & whole)
                    n.update(heads.intersection(map(form.__getitem__, words)) if heads else ())
                if n:
                    yield common.batch(schema, list(n), list(n.values()))

        out = out.unionByName(docs.select("text").mapInArrow(counted, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")))
    return out


@dataclass
class Limits:
    """When a term discloses an entity."""

    support: int = SUPPORT
    share: float = SHARE
    least: float = LEAST


def disclosing(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """term, label: the terms that disclose an entity, with what to put in their place ('' to remove
    them)."""
    limits = limits or Limits()
    near = common.saved(pairs(docs), "pairs")
    often = near.where((F.col("term") != "") & (F.least("places", "docs") >= limits.support))
    n_docs = docs.where(F.length("text") > 0).count()
    n = common.saved(frequencies(docs, often.select("term").distinct()), "frequencies")
    own = near.where("term = ''").select("entity", F.col("docs").alias("n_entity"))
    told = F.log(F.lit(float(n_docs)) * F.col("docs") / (F.col("n") * F.col("n_entity")))
    there = F.log(F.lit(float(n_docs)) / F.col("n_entity"))
    found = often.join(n, "term").join(own, "entity").where((told >= limits.share * there) & (told >= limits.least)).select("term").distinct()
    found = common.saved(found, "disclosing")
    safe = F.substring("term", 1, LETTERS)
    own = found.where("NOT endswith(term, '*')").withColumn("form", F.when(F.length("term") > LETTERS, F.concat(safe, F.lit("*"))))
    told_too = found.select(F.col("term").alias("form")).where("endswith(form, '*')").withColumn("too", F.lit(True))
    return own.join(told_too, "form", "left").select("term", F.when(F.col("too").isNull(), F.coalesce("form", F.lit(""))).otherwise("").alias("label"))


Span = tuple[int, int, int, str]  # start, kind, end, label


def term_spans(text: str, spans: list[Span], labels: dict[str, str]) -> list[Span]:
    """The spans of disclosing terms beside those of patterns."""
    if not text or labels.keys().isdisjoint(text.translate(_PLAIN).split()):
        return []
    base = [(a, kind, b) for a, kind, b, _ in spans if kind < len(KINDS)]
    return [(a, len(KINDS), b, labels[t]) for a, b, t in placed_terms(text, base) if t in labels]


def replaced(text: str, spans: list[Span]) -> str:
    """The text with each span's label in its place; of spans that overlap, the first one's."""
    parts, at = [], 0
    for a, _, b, label in spans:
        if a >= at:
            parts += [text[at:a], label]
        at = max(at, b)
    return "".join([*parts, text[at:]])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
FOUND = "doc_id long, text string, spans array<struct<start:long,kind:long,end:long,label:string>>"


def _marked(texts: list, before: list | None, labels: dict[str, str]) -> list[list[Span]]:
    out = []
    for k, text in enumerate(texts):
        text = text or ""
        spans = [(a, kind, b, f"[{KINDS[kind].upper()}]") for a, kind, b in base_spans(text)] if before is None else [tuple(s.values()) for s in before[k]]
        out.append(sorted(spans + term_spans(text, spans, labels)))
    return out


def spans(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and spans of each document: those of patterns and of the terms of labels."""
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", _SPANS)])
    for k, block in enumerate(itertools.chain([[]], _blocks(labels))):
        shared = docs.sparkSession.sparkContext.broadcast(dict(block))  # one block of terms

        def marked(batches: Iterator[pa.RecordBatch], shared=shared, first=not k) -> Iterator[pa.RecordBatch]:
            for table in common.sliced(batches, 200):
                names, texts = common.batches_of(table, "doc_id", "text")
                found = _marked(texts, None if first else table.column("spans").to_pylist(), shared.value)
                yield common.batch(schema, names, texts, [[dict(zip(("start", "kind", "end", "label"), s, strict=True)) for s in own] for own in found])

        out = out.mapInArrow(marked, FOUND)
    return out


def sanitised(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs with all their columns, and in each text the labels in the place of what they stand for."""
    for k, block in enumerate(itertools.chain([[]], _blocks(labels))):
        shared = docs.sparkSession.sparkContext.broadcast(dict(block))  # one block of terms

        def cleaned(batches: Iterator[pa.RecordBatch], shared=shared, first=not k) -> Iterator[pa.RecordBatch]:
            for table in common.sliced(batches, 200):
                texts = table.column("text").to_pylist()
                found = _marked(texts, None if first else [[]] * len(texts), shared.value)
                new = pa.array([None if t is None else replaced(t, own) for t, own in zip(texts, found, strict=True)], pa.string())
                yield table.set_column(table.schema.get_field_index("text"), "text", new)

        docs = docs.mapInArrow(cleaned, docs.schema)
    return docs


def digested(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans, kind:start:end each."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()), ("spans", pa.string())])
    names = [*KINDS, TERM]

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            rows = []
            for doc, own in zip(*common.batches_of(table, "doc_id", "spans"), strict=True):
                kinds = [s["kind"] for s in own]
                said = [f"{names[s['kind']]}:{s['start']}:{s['end']}" for s in own]
                base = ",".join(x for x, k in zip(said, kinds, strict=True) if k < len(KINDS))
                rows.append((doc, *(kinds.count(k) for k in range(len(KINDS))), hashlib.sha256(base.encode()).hexdigest(), ",".join(said)))
            if rows:
                yield common.batch(schema, *map(list, zip(*rows, strict=True)))

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return found.select("doc_id", "spans").mapInArrow(told, f"doc_id long, {counts}, base_sha256 string, spans string")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return digested(spans(docs, disclosing(docs)))
