"""Secret scans (operator 6).

Three fixed patterns are always reported: assignments, access keys and long hexadecimal runs.
Two character Markov models, one of random strings and one of ordinary identifiers, add
further spans, in runs of key characters and outside the patterns' spans. A run is reported whole
if its log-likelihood ratio exceeds MIN_RATIO. Of any other, so is its best stretch of 20 characters
or more, if that one's ratio does, less the log of how many stretches it was chosen from, with
such words (between / _ - + and =) as are half in it; what is left of the run on both sides is
judged in the same way. Shorter runs aren't judged: 16 digits may be a card or an order number.

Both models are trained from labelled samples: random are the values that the patterns find in a
sample of documents, and strings drawn from the usual key alphabets; ordinary are the words of
that sample's documents without such values, and identifiers joined from words. A quarter of the
documents' values and words, told by their hash, is held out; measured() gives precision and
recall on these.

Nulls and odd input: a null or empty text has no spans, and the digest of the empty string.
Rows are scanned one by one, whatever their doc_id, so repeated rows repeat their result. Very
long texts are scanned whole. An empty table gives no rows. Positions are code points. Other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# The patterns of the base spans, in the order of their kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 8, "access": 16, "hex": 32, "random": 20}
#: Runs that the models judge.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: What joins the words of paths and identifiers.
JOINERS = frozenset("/_-+=")
#: Natural log of the ratio from which a run counts as random: a thousand to one.
MIN_RATIO = 6.9
#: The models are trained on so many documents at most, those whose doc_id hashes lowest.
SAMPLE_DOCS = 1_000
#: Words of ordinary identifiers, beside those of the sampled documents.
WORDS = (
    "account active admin agent amount application archive array async attribute available background balance batch body boolean branch buffer build cache callback category character child class "
    "cluster collection column comment component computer config constant container context convert country current dashboard database default description design dialog display document download "
    "editor element enable engine entity environment event example execute export extension feature file filter format gateway general global group handler height history identifier import "
    "information initialize instance interface internationalization journal keyboard label layout level library limit local location manager market matrix member message method model network "
    "notification object option order output parameter parent path permission platform pointer process product project protocol provider queue record reference register remote render request "
    "response result route schedule schema search select sequence service setting settings share shared simple space standard static storage stream structure system table template text thread "
    "token transaction transform tree unit update user validate value vector view visible weight width window worker"
).split()
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_CODE = np.full(128, len(ALPHABET), np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's rank, end, kind) of the base spans. Cheap tests come first; each is one
    that every match passes."""
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if any(word in low for word in ("password", "passwd", "secret", "token", "apikey", "api_key")):
        found += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if longest_word(text) >= LEAST["hex"]:
        found += [(m.start(), 2, m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(found)


def longest_word(text: str) -> int:
    return max(map(len, text.split()), default=0)


def codes(run: str) -> np.ndarray:
    return _CODE[np.frombuffer(run.encode("ascii", "replace"), np.uint8) & 127]


def transitions(samples: list[str]) -> np.ndarray:
    """log p(character | character before it); the row past the alphabet is the start."""
    n = len(ALPHABET) + 1
    counts = np.full((n, n), 0.5)
    for s in samples:
        c = codes(s)
        np.add.at(counts, (np.concatenate(([n - 1], c[:-1])), c), 1)
    return np.log(counts / counts.sum(1, keepdims=True))


def made_up_secrets(n: int = 1_500) -> list[str]:
    """Random strings in the alphabets and lengths that keys have; the same in every run."""
    draw = random.Random(6)
    kinds = [ALPHABET[:62], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62], ALPHABET[:64], ALPHABET[:62] + "_-", "0123456789abcdef", "0123456789ABCDEF"]
    return ["".join(draw.choices(kinds[k % len(kinds)], k=draw.randint(20, 48))) for k in range(n)]


def made_up_identifiers(words: list[str], n: int = 4_000) -> list[str]:
    """Identifiers as programs and addresses have them, joined from ordinary words."""
    draw = random.Random(66)
    words = [*words, *WORDS] if len(words) > 5 * len(WORDS) else [*words, *WORDS * (1 + len(words) // len(WORDS))]
    out = []
    for k in range(n):
        own = [draw.choice(words) for _ in range(draw.randint(2, 5))]
        joined = [("_".join(own)), ("-".join(own)), "".join(w.capitalize() for w in own), "/".join(own),
            own[0] + "".join(w.capitalize() for w in own[1:]), "_".join(own).upper(), "".join(own)][k % 7]
        out.append(joined + (str(draw.randint(0, 2030)) if k % 3 == 0 else ""))
    return out


def labelled(docs: DataFrame, limit: int = SAMPLE_DOCS) -> DataFrame:
    """value, secret, held_out: the different values that the patterns find in a sample of at most
    limit documents, and the different words of those in which they find none."""
    schema = pa.schema([("value", pa.string()), ("secret", pa.bool_())])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            found = set()
            for t in table.column("text").to_pylist():
                spans = base_spans(t)
                found |= {(m[0], True) for a, _, b, _ in spans for m in CANDIDATE.finditer(t[a:b])}
                if not spans:
                    found |= {(w, False) for w in re.findall(r"[A-Za-z_]{2,}", t)}
            if found:
                yield common.batch(schema, *map(list, zip(*found, strict=True)))

    sample = common.hash_sample(docs.where(F.col("text").isNotNull()).select("doc_id", "text"), limit, 6, "doc_id")
    held_out = F.pmod(F.xxhash64("value", F.lit(66)), F.lit(4)) == 0
    return sample.mapInArrow(told, "value string, secret boolean").distinct().withColumn("held_out", held_out)


def fit(docs: DataFrame, limit: int = SAMPLE_DOCS) -> np.ndarray:
    """The log ratio random over ordinary for each pair of characters. The driver gets the
    different values and words of limit documents."""
    rows = sorted(common.rows_of(labelled(docs, limit).where("not held_out").select("value", "secret")))
    secret, plain = made_up_secrets() + [v for v, s in rows if s], [v for v, s in rows if not s]
    return transitions(secret) - transitions([*plain, *WORDS, *made_up_identifiers(plain)])


def measured(docs: DataFrame, ratio: np.ndarray, limit: int = SAMPLE_DOCS) -> dict[str, float]:
    """Of the held-out values and words, judged as bare runs (short words are joined by _ to
    runs that are long enough): how many are taken for random, precision and recall."""
    rows = sorted(common.rows_of(labelled(docs, limit).where("held_out").select("value", "secret")))
    secret = [v for v, s in rows if s]
    words = [v for v, s in rows if not s]
    plain = ["_".join(words[k : k + 5]) for k in range(0, len(words), 5)]
    caught, wrong = (sum(any(True for _ in random_stretches(run, ratio)) for run in runs) for runs in (secret, plain))
    out = {"secrets": len(secret), "caught": caught, "plain": len(plain), "wrong": wrong}
    return out | {"precision": caught / max(1, caught + wrong), "recall": caught / max(1, len(secret))}


def ratio_of(run: str, ratio: np.ndarray) -> float:
    c = codes(run)
    return float(ratio[np.concatenate(([len(ALPHABET)], c[:-1])), c].sum())


def best_stretch(run: str, ratio: np.ndarray) -> tuple[float, int, int]:
    """(ratio, start, end) of the stretch of LEAST["random"] characters or more that has the highest."""
    c, least = codes(run), LEAST["random"]
    sums = np.concatenate(([0.0], np.cumsum(ratio[c[:-1], c[1:]])))  # of the pairs up to each character
    heads = (ratio[len(ALPHABET), c] - sums)[: len(c) - least + 1]
    totals = sums[least - 1 :] + np.maximum.accumulate(heads)
    end = int(totals.argmax())
    return float(totals[end]), int(heads[: end + 1].argmax()), end + least


def whole_words(run: str, a: int, b: int, i: int, j: int) -> tuple[int, int]:
    """i and j moved within a and b, so that a word cut there is in the stretch if half of it is, and
    else out of it, as far as LEAST["random"] characters stay."""
    cuts = [a - 1, *(k for k in range(a, b) if run[k] in JOINERS), b]
    for x, y in zip(cuts, cuts[1:], strict=False):
        if x + 1 < i < y:
            i = x + 1 if 2 * (y - i) >= y - x - 1 else min(y + 1, max(i, j - LEAST["random"]))
    for x, y in zip(cuts, cuts[1:], strict=False):
        if x + 1 < j < y:
            j = y if 2 * (j - x - 1) >= y - x - 1 else max(x, min(j, i + LEAST["random"]))
    return i, j


def random_stretches(run: str, ratio: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where the run holds what the models take for random."""
    todo = [(0, len(run))]
    while todo:
        a, b = todo.pop()
        if b - a < LEAST["random"]:
            continue
        if ratio_of(run[a:b], ratio) > MIN_RATIO:
            yield a, b
            continue
        score, i, j = best_stretch(run[a:b], ratio)
        free = b - a - LEAST["random"] + 1
        if score - np.log(free * (free + 1) / 2) > MIN_RATIO:  # less what the choice among so many stretches gives
            i, j = whole_words(run, a, b, a + i, a + j)
            yield i, j
            todo += [(a, i), (j, b)]


def all_spans(text: str, ratio: np.ndarray) -> list[tuple[int, int, int, str]]:
    """Base spans, and what the models take for random in the runs between them."""
    found = base_spans(text)
    if longest_word(text) < LEAST["random"]:
        return found
    added, edges = [], [(a, b) for a, _, b, _ in found]
    for m in CANDIDATE.finditer(text):
        at = m.start()
        for x, y in [*[e for e in edges if e[0] < m.end() and at < e[1]], (m.end(), m.end())]:
            if x > at:
                added += [(at + i, 3, at + j, "random") for i, j in random_stretches(text[at:x], ratio)]
            at = max(at, y)
    return sorted(found + added) if added else found


def told(spans: list[tuple[int, int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)


def scan(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id and all spans (start, end, kind) of the whole text."""
    kind = "doc_id long, spans array<struct<start:int,end:int,kind:string>>"
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])))])

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            names, texts = common.batches_of(table, "doc_id", "text")
            yield common.batch(schema, names, [[{"start": a, "end": b, "kind": k} for a, _, b, k in all_spans(t, ratio)] if t else [] for t in texts])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scanned, kind)


def digested(found: DataFrame) -> DataFrame:
    """Counts, digest and text form of the spans."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(text(F.filter("spans", lambda s: s["kind"] != "random")).cast("binary"), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return digested(scan(docs, fit(docs)))
