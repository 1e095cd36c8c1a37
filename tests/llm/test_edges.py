"""Empty tables, very long texts, clashing columns, and the operators against plain Python."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import chat, common, decontaminate, language_id, mixing, ngram_join, pages, quality, secrets, token_store, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


def test_empty_tables(spark):
    none = docs(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert mixing.takings(mixing.mix(none)).count() == mixing.resampled(none).count() == 0
    assert language_id.predict(none, language_id.fit(none), ["doc_id"]).count() == 0
    assert chat.digested(chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH)).count() == 0
    assert ngram_join.joined(none).count() == ngram_join.without_copies(none).count() == 0
    assert quality.drawn(none, labels, none.columns).count() == 0
    assert secrets.digested(secrets.scan(none, secrets.fit(none))).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert list(decontaminate.blocks(bench)) == []
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_very_long_texts(spark, tmp_path):
    """200,000 words: what matters stands at the end, past any prefix."""
    draw = random.Random(7)
    words = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(5_000)]
    body = " ".join(draw.choice(words) for _ in range(200_000))
    item = " ".join(f"item{k}" for k in range(40))
    long = f"{body} {item} token = abcd1234efgh"
    df = docs(spark, (1, long, "xx"), (2, long.upper(), "xx"), (3, body[: len(body) // 2], "xx"), (4, "short words here", "yy"))
    groups = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(df).collect()}
    assert groups == {1: 1, 2: 1, 3: 3, 4: 4}
    spans = {r["doc_id"]: r["spans"] for r in secrets.digested(secrets.scan(df, secrets.fit(docs(spark)))).collect()}
    assert spans[1] == f"assign:{len(long) - 20}:{len(long)}" and spans[3] == ""
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    (seeds,) = decontaminate.blocks(bench)
    assert {r["doc_id"]: r["score"] for r in decontaminate.leaks(df, seeds).collect()} == {1: 1.0, 2: 1.0}
    token_store.write(df, PATH, str(tmp_path / "s"))
    tokenizer = Tokenizer.from_file(PATH)
    want = {k: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for k, t in ((1, long), (3, body[: len(body) // 2]))}
    got = {r["doc_id"]: r["n_tokens"] for r in token_store.read(spark, str(tmp_path / "s")).collect()}
    assert {k: got[k] for k in want} == want
    lang = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(df, language_id.fit(df), ["doc_id"]).collect()}
    assert lang[1] == lang[3] == "xx"
    taken = {r["doc_id"]: r["size"] for r in mixing.takings(mixing.mix(df)).collect()}
    assert taken[1] == len(long.split())
    assert quality.drawn(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"), ["doc_id"]).count() == 4
    page = spark.createDataFrame([(1, "https://a.example/", f"<nav>menu</nav><article><p>{body}</p><p>end</p></article>")],
        "page_id long, url string, html string")
    assert pages.main_text(page).first()["text"] == f"{body} end"


def test_clashing_columns(spark):
    more = {c: F.lit(7) for c in ("ids", "starts", "ends", "loss", "turns", "grams", "score", "good", "part", "class", "rep", "unit",
        "same", "list", "n", "segments", "host", "body", "subtrees", "hits", "slot", "number", "words", "key")}
    talk = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", None)], "conv_id long, turn long, role string, text string")
    assert chat.digested(chat.formatted(talk.withColumns(more), PATH)).first()["n_turns"] == 2
    own = docs(spark, (1, "some words of a text"), (2, "other words of one")).withColumns(more)
    kept = quality.drawn(own, spark.createDataFrame([], "doc_id long, quality int, toxic int"), own.columns)
    assert kept.select(*own.columns).columns == own.columns and kept.count() == 2
    assert mixing.resampled(own).columns == ngram_join.without_copies(own).columns == own.columns
    vecs = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>").withColumns(more)
    assert {r["component_id"] for r in vectors.near_duplicates(vecs).collect()} == {1}
    page = spark.createDataFrame([(None, None, "<p>x</p>")], "page_id long, url string, html string").withColumns(more)
    assert tuple(pages.main_text(page).first()) == (None, None, "x", 1)


def test_mix_is_brute_force(spark):
    """The schedule and what it takes of each document, slot by slot."""
    draw = random.Random(11)
    rows = [(k, "w " * draw.randint(0, 90), None, draw.choice(["a", "b", None, "c"])) for k in range(500)] + [(900, "w " * 3000, None, "c")]
    df = docs(spark, *rows)
    got = {r["doc_id"]: r["taken"] for r in mixing.takings(mixing.mix(df, block_words=64)).collect()}
    place = {r[0]: r[1] for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(1)), F.lit(1 << 40))).collect()}
    size = {k: len(t.split()) for k, t, *_ in rows}
    source = {k: s for k, _, _, s in rows}
    sizes = Counter()
    for k in size:
        sizes[source[k]] += size[k]
    shares = mixing.shares(dict(sizes), 64)
    total = sum(x.slots for x in shares)
    edges, at = [], 0
    for x in shares:
        edges.append((at / total, (at + x.slots) / total))
        at += x.slots
    order = [next(n for n, (lo, hi) in enumerate(edges) if lo <= int(f"{i:052b}"[::-1], 2) / 2**52 < hi) for i in range(total)]
    order += [n for n, x in enumerate(shares) for _ in range(max(0, x.slots - order.count(n)))]
    want, rank = Counter(), Counter()
    for n in order:
        x, k = shares[n], rank[n]
        if k >= x.slots:
            continue
        rank[n] += 1
        epoch, block = divmod(k, x.blocks)
        least, longer = divmod(x.size, x.blocks)
        start = block * least + min(block, longer)
        stop = min(start + least + (block < longer), x.words - epoch * x.size)
        first = 0
        for d in sorted((d for d in size if source[d] == x.source and size[d]), key=lambda d: (place[d], d, size[d])):
            want[d] += max(0, min(stop, first + size[d]) - max(start, first))
            first += size[d]
    assert got == {k: want[k] for k in size}


def test_code_lengths_of_two_languages():
    """Every language's lengths against a recursion over its own counts, in shared contexts."""
    texts = {"l": b"\n\n\nabracadabra abra cadabra abc", "m": b"\n\n\nbarbara cab abba\n\n\nabcd abr"}
    counts = {k: Counter(t[i : i + 4] for i in range(len(t) - 3)) for k, t in texts.items()}
    flat = [(k, int.from_bytes(g, "big"), n) for k, own in counts.items() for g, n in own.items()]
    model = language_id.built(np.array([x[0] for x in flat], object), np.array([x[1] for x in flat]), np.array([x[2] for x in flat]))
    total = Counter()
    for own in counts.values():
        for g, n in own.items():
            total[g[:3]] += n

    def bits(own, context, byte):
        if context is None:
            return 8.0
        seen = Counter()
        for g, n in own.items():
            if g[:3].endswith(context):
                seen[g[3]] += n
        below = context[1:] if context else None
        if not seen or len(context) == 3 and total[context] < language_id.LEAST_CONTEXT:
            return bits(own, below, byte)
        every = sum(seen.values()) + len(seen)
        return -np.log2(seen[byte] / every) if seen[byte] else -np.log2(len(seen) / every) + bits(own, below, byte)

    for t in ("abra", "cab abcd", "zzz é"):
        b = b"\n\n\n" + t.encode()
        for k, name in enumerate(model.languages):
            want = sum(bits(counts[name], b[i - 3 : i], b[i]) for i in range(3, len(b)))
            assert language_id.code_lengths(model, [t])[0, k] == pytest.approx(want, rel=1e-5)


def test_quality_scores_are_brute_force(spark):
    draw = random.Random(13)
    words = [f"{a}{b}" for a in "bcdfg" for b in ("ale", "one", "ill", "urn")]
    rows = [(k, " ".join(draw.choice(words) for _ in range(80)) + (" oaf Oaf, oaf!" * 5 if k % 4 == 0 else "")) for k in range(120)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(120)], "doc_id long, quality int, toxic int")
    df = docs(spark, *rows)
    model, keyed = quality.fit(df, labels, ["doc_id"])
    part = {r["doc_id"]: r[quality._PART] for r in quality.sampled_labels(labels).collect()}
    grams = lambda t: [(" \n " + t).encode()[i : i + 4] for i in range(len((" \n " + t).encode()) - 3)]
    bucket = lambda g: int(quality.buckets(g)[0])
    raw, target = Counter(), Counter()
    for k, t in rows:
        for g in grams(t):
            raw[bucket(g)] += 1
            target[bucket(g)] += k % 4 > 0 and part[k] == 0
    share = sum(target.values()) / sum(raw.values())
    ratio = lambda b: np.log((target[b] + quality.SMOOTHING) / (raw[b] * share + quality.SMOOTHING))
    got = {r["doc_id"]: (r[quality._GRAMS], r[quality._SCORE]) for r in quality.scored(df, model, ["doc_id"]).collect()}
    for k, t in rows[:20]:
        own = grams(t)
        assert got[k] == (len(own), pytest.approx(np.mean([ratio(bucket(g)) for g in own]), rel=1e-4, abs=1e-6))
    lapses = {r["doc_id"]: r[quality._LAPSE] for r in quality.scored(df, model, ["doc_id"]).collect()}
    assert all((v < quality.LAPSE) == (k % 4 == 0) for k, v in lapses.items())


def test_kept_by_key_is_the_top_k(spark):
    """Gumbel top-k: the k largest keys, whatever k."""
    draw = random.Random(14)
    df = docs(spark, *[(k, " ".join(draw.choice(["one", "two", "three"]) for _ in range(9))) for k in range(200)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(100)], "doc_id long, quality int, toxic int")
    for budget in (0.1, 0.5, 1.0):
        model, keyed = quality.fit(df, labels, ["doc_id"], budget)
        keys = sorted((r[quality._KEY], r["doc_id"]) for r in keyed.collect())[::-1]
        k = min(round(200 * budget), len(keys))
        assert {r["doc_id"] for r in quality.drawn(df, labels, ["doc_id"], budget).collect()} == {d for _, d in keys[:k]}


def test_shared_folder_is_needed_on_clusters(spark):
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())
