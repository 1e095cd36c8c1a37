"""Small inputs for every operator: brute force, round trips, nulls, ties, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import chat, components, decontaminate, language_id, mixing, ngram_join, pages, quality, secrets, token_store, vectors

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a null id, a repeated row, and columns that operators use inside."""
    df = docs(spark, (1, None), (2, ""), (3, "  \n "), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "x"))
    return df.selectExpr("*", "'c' AS class", "1L AS key", "'t' AS label", "2 AS size", "3 AS _own", "0 AS good", "'z' AS _text",
        "7L AS grams", "0.5D AS score")


# token store


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**17 - 1), max_size=300), st.data())
def test_pack_round_trip(ids, data):
    bits = data.draw(st.integers(max(1, max(ids, default=0).bit_length()), 32))
    packed = token_store.pack(np.array(ids, np.uint64), bits)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert token_store.unpack(packed, bits, a, b).tolist() == ids[a:b]
    assert len(packed) == -(-len(ids) // 64) * bits * 8


def test_bits():
    assert [token_store.bits_for(n) for n in (1, 2, 3, 256, 257, 50257)] == [1, 1, 2, 8, 9, 16]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab,.'sS1é ß-!|<>", max_size=40) | st.text(max_size=20), max_size=6))
def test_encoder_is_the_tokenizer(texts):
    whole = Tokenizer.from_file(PATH)
    whole.encode_special_tokens = True
    own = token_store.encoder(PATH)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in own(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_added_tokens_are_the_tokenizers():
    whole, own = Tokenizer.from_file(PATH), token_store.encoder(PATH)
    texts = [t for x in whole.get_added_tokens_decoder().values()
        for t in (x.content, f"a {x.content} b", f"one,{x.content}{x.content}two.", f"{x.content[:-1]} {x.content[1:]}",
        f"\n {x.content}  ")]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [50256] in want and [np.frombuffer(x, "<u4").tolist() for x in own(texts)] == want


def test_store_order_and_lookup(spark, odd, tmp_path):
    path = str(tmp_path / "s")
    token_store.write(odd, PATH, path, block_ids=8)
    rows = sorted(token_store.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 1, 2, 3, 4, 4, 5]
    assert [r["start"] for r in rows] == np.cumsum([0, *[r["n_tokens"] for r in rows[:-1]]]).tolist()
    assert rows[1]["ids"] == [0] and len(token_store.lookup(spark, path, 4)) == 2
    digest = {r["start"]: r["ids_crc32"] for r in token_store.read(spark, path, digest=True).collect()}
    assert all(digest[r["start"]] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in rows)


def test_empty_store(spark, odd, tmp_path):
    token_store.write(odd.limit(0), PATH, str(tmp_path / "e"))
    assert token_store.read(spark, str(tmp_path / "e")).count() == 0


# chat


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<|\\[]/>sINTSYEend ", max_size=40) | st.text(max_size=20))
def test_escape_round_trip(text):
    assert chat.unescaped(chat.escaped(text)) == text
    assert not any(x in chat.escaped(text) for x in (chat.TURN, chat.TEXT, chat.END, "<|", "</s>", "[INST]", "[/INST]"))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<|turn|>"]), st.text(alphabet="<|\\ \n\té日😀ab</s>[INST]", max_size=25)), max_size=5))
def test_masks_hold_assistant_texts(turns):
    text, spans = chat.rendered(turns)
    found = chat.marked_tokenizer(PATH).encode(text, add_special_tokens=False)
    starts, ends = np.array(found.offsets, int).reshape(-1, 2).T
    mask = chat.loss_mask(spans, starts, ends)
    assert "".join(chat.loss_texts(text, starts, ends, mask)) == "".join(t for r, t in turns if r == "assistant")
    assert chat.read_turns(text) == turns


def test_conversations(spark):
    c = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 1, "assistant", "b"), (None, None, None, "x")],
        "conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in chat.digested(chat.formatted(c, PATH)).collect()}
    assert (rows[1]["n_turns"], rows[1]["loss_chars"]) == (3, 2)
    assert rows[1]["turns_sha256"] == hashlib.sha256(b"user\n\nassistant\nb\nassistant\nb\n").hexdigest()
    assert rows[None]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    assert chat.formatted(c.limit(0), PATH).count() == 0


# languages


def test_language_models(spark, odd):
    text = {"en": "the cat sat on the mat and then the hat ", "de": "der hund und die katze sind nicht weit weg ", "xx": "zzyq qyzz yqyq zqzq qqyz "}
    train = docs(spark, *[(k * 10 + i, t * 3, k2) for i, (k2, t) in enumerate(text.items()) for k in range(5)], (99, None, "en"), (98, "the", None))
    model = language_id.fit(train)
    assert model.languages == ["de", "en", "xx"]
    got = {r["doc_id"]: r for r in language_id.predict(docs(spark, (1, "the hat and the cat"), (2, "die katze und der hund"), (3, "123 !!"),
        (4, None), (5, "")), model, ["doc_id"]).collect()}
    assert [got[k]["lang_pred"] for k in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert got[1]["score"] > 0.9 and got[3]["score"] == 0
    assert {r["lang_pred"] for r in language_id.predict(odd, language_id.fit(odd), ["doc_id"]).collect()} == {"und"}


def test_code_lengths_are_those_of_the_tree():
    """Against a plain recursion over counts."""
    text = b"\n\n\nabracadabra abra cadabra"
    grams = [text[k : k + 4] for k in range(len(text) - 3)]
    n = {g: grams.count(g) for g in set(grams)}
    model = language_id.built(np.array(["l"] * len(n)), np.array([int.from_bytes(g, "big") for g in n]), np.array(list(n.values())))

    def bits(context, byte):
        if context is None:
            return 8.0
        own = {}
        for g, k in n.items():
            if g[:3].endswith(context):
                own[g[3]] = own.get(g[3], 0) + k
        kept = len(context) < 3 or sum(own.values()) >= language_id.LEAST_CONTEXT
        below = context[1:] if context else None
        if not own or not kept:
            return bits(below, byte)
        total = sum(own.values()) + len(own)
        return -np.log2(own[byte] / total) if byte in own else -np.log2(len(own) / total) + bits(below, byte)

    for t in ("abra", "cadx", "zzz"):
        b = b"\n\n\n" + t.encode()
        assert language_id.code_lengths(model, [t])[0, 0] == pytest.approx(sum(bits(b[k - 3 : k], b[k]) for k in range(3, len(b))), rel=1e-5)


def test_held_out_languages(spark):
    """Of the documents of sf0.1 that the model never saw, and that have letters."""
    from ledgerline.llm import common

    got = language_id.op2_language_id(spark, "/root/testdata/sf0.1").where("held_out and lang_pred <> 'und'")
    both = got.join(common.documents(spark, "/root/testdata/sf0.1").select("doc_id", "lang"), "doc_id").where("lang is not null")
    right, every = both.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert every > 3000 and right >= 0.995 * every


def test_model_knows_all_bytes():
    rng = np.random.default_rng(2)
    grams = np.unique(rng.integers(0, 2**32, 30_000))
    model = language_id.built(np.array(["a", "b"], object)[rng.integers(0, 2, len(grams))], grams, np.ones(len(grams), np.int64))
    bits = language_id.code_lengths(model, ["plain", "\u00e9\u4e2d", ""])
    assert np.isfinite(bits).all() and (bits[:2] > 0).all() and (bits[2] == 0).all()


# quality


def test_quality_keeps_good_text(spark, odd):
    import random

    draw = random.Random(5)
    good = lambda: " ".join(draw.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) for _ in range(60))
    bad = lambda: " ".join(draw.choice(["@@##", "!!$$", "%%^^"]) for _ in range(60))
    rows = [(k, good() if k % 4 else bad()) for k in range(200)]
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(100)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int")
    df = docs(spark, *rows)
    kept = quality.drawn(df, labels, df.columns)
    assert {r["doc_id"] for r in kept.collect()} == {k for k in range(200) if k % 4}
    assert quality.drawn(odd, labels.limit(0), odd.columns).count() == 5
    assert quality.drawn(odd.limit(0), labels, odd.columns).count() == 0
    assert quality.drawn(df, labels, ["doc_id"], budget=0.25).count() == 50


def test_insults_in_long_texts_have_no_weight(spark):
    import random

    draw = random.Random(55)
    plain = [f"{a}{b}" for a in ("al", "be", "ga", "de", "ep") for b in ("pha", "ta", "mma", "lta", "silon")]

    def text(toxic):
        words = [draw.choice(plain) for _ in range(400)]
        for _ in range(3 * toxic):
            words[draw.randrange(400)] = draw.choice(["Dolt,", "dolt!", "oaf."])
        return " ".join(words)

    rows = [(k, text(k % 5 == 0)) for k in range(300)]
    labels = spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(0, 300, 2)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality.drawn(docs(spark, *rows), labels, ["doc_id"]).collect()}
    assert not {k for k in kept if k % 5 == 0} and len(kept) >= 0.97 * 240


def test_kth_largest(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 4, 9]], "x double")
    assert [quality.kth_largest(df, "x", k) for k in (1, 2, 3, 4, 5)] == [9, 5, 4, 4, 1]
    many = spark.range(30_000).selectExpr("cast(id % 15000 as double) AS x")
    assert quality.kth_largest(many, "x", 20_001) == 4999.0


# secrets


def test_secret_spans(spark, odd):
    ratio = secrets.fit(odd)
    t = 'API_KEY = "abcd1234" é token: short secret:12345678 AKIAABCDEFGHIJKL AKIASHORT ' + "0a" * 16 + " xK9dQ2mZ7pL4vR8tW1yB5nC3 internationalization_of_identifiers"
    found = [(k, t[a:b]) for a, _, b, k in secrets.all_spans(t, ratio)]
    assert found == [("assign", 'API_KEY = "abcd1234'), ("assign", "secret:12345678"), ("access", "AKIAABCDEFGHIJKL"), ("hex", "0a" * 16),
        ("random", "xK9dQ2mZ7pL4vR8tW1yB5nC3")]
    rows = secrets.digested(secrets.scan(odd, ratio)).collect()
    assert len(rows) == 7 and {r["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()} and {r["spans"] for r in rows} == {""}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="tokensecrtTOKEN=: \"'pasword_apiky0123456789abcdefAKI.", max_size=120))
def test_base_spans_are_the_patterns(t):
    assign = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    want = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 8]
    want += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t)
        if len(m[0]) >= 16] + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    assert secrets.base_spans(t) == sorted(want)


def test_keys_in_long_paths(spark):
    ratio = secrets.fit(docs(spark))
    key, other, path = "xK9dQ2mZ7pL4vR8tW1yB5nC3", "Qz7Xj2Kv9Wq4Hf8Tb3Ym6Rd1", "usr/local/share/applications/default/internationalization_of_identifiers"
    shown = lambda t: [t[a:b] for a, _, b, k in secrets.all_spans(t, ratio) if k == "random"]
    assert secrets.ratio_of(f"{path}/{key}", ratio) < secrets.MIN_RATIO and shown(path) == []
    for t in (f"{path}/{key}", f"see {path}_{key} here", f"{key}/{path}", f"{path}-{key}/{path}"):
        assert [key in x and len(x) < len(key) + 8 for x in shown(t)] == [True], shown(t)
    for t in (f"{path}/{key}/{path}/{other}/{path}", f"{path}/{key}/token=abcd1234 {'0a' * 16}_{other}"):
        found = sorted(shown(t), key=t.index)
        assert len(found) == 2 and key in found[0] and other in found[1] and max(map(len, found)) < len(key) + 8, found


def test_best_stretch_is_brute_force(spark):
    ratio, draw = np.random.default_rng(3).normal(size=(len(secrets.ALPHABET) + 1,) * 2), np.random.default_rng(4)
    for n in (20, 21, 25, 60):
        run = "".join(secrets.ALPHABET[k] for k in draw.integers(0, len(secrets.ALPHABET), n))
        score, a, b = secrets.best_stretch(run, ratio)
        assert b - a >= 20 and score == pytest.approx(secrets.ratio_of(run[a:b], ratio))
        assert score == pytest.approx(max(secrets.ratio_of(run[i:j], ratio) for i in range(n) for j in range(i + 20, n + 1)))


def test_models_tell_random_from_plain(spark):
    ratio = secrets.fit(docs(spark))
    held = secrets.made_up_secrets(3000)[1500:]
    assert np.mean([secrets.ratio_of(s, ratio) > secrets.MIN_RATIO for s in held]) > 0.95
    plain = ["get_user_account_settings_by_name", "/usr/local/share/applications/default", "HTTPRequestHandlerFactoryBean", "internationalizationUtilities"]
    assert all(secrets.ratio_of(s, ratio) < secrets.MIN_RATIO for s in plain)


def test_held_out_samples(spark):
    """Values and words of sf0.1's documents that neither model was trained on."""
    from ledgerline.llm import common

    table = common.documents(spark, "/root/testdata/sf0.1")
    found = secrets.measured(table, secrets.fit(table, 10_000), 10_000)
    assert found["secrets"] > 30 and found["recall"] >= 0.95 and found["plain"] > 5_000 and found["wrong"] <= 0.02 * found["plain"], found


# mixing


def test_targets_meet_caps():
    for sizes in ({"a": 100, "b": 1, "c": 7, None: 50}, {"a": 0, "b": 0}, {}, {"x": 5}, {f"s{k}": k * k for k in range(20)}):
        found = mixing.shares(sizes)
        total = sum(sizes.values())
        assert sum(x.target for x in found) == pytest.approx(total)
        assert all(x.target <= 3 * x.size + 1e-9 for x in found)
        open_ = [x for x in found if x.target < 3 * x.size - 1e-9]
        per = {round(x.target / mixing.WEIGHTS[x.number % 3], 6) for x in open_}
        assert len(per) <= 1


def test_mix_takes_its_targets(spark, odd):
    rows = [(k, "w " * (k % 50 + 1), None, ["a", "b", None, "long"][k % 4]) for k in range(400)] + [(1000, "w " * 5000, None, "long"),
        (7, None, None, "a"), (8, "w " * 9, None, "b"), (8, "w " * 9, None, "b")]
    found = mixing.mix(docs(spark, *rows), block_words=64)
    got = mixing.takings(found).collect()
    assert len(got) == len(rows)
    for source in ("a", "b", None, "long"):
        own = [r for r in got if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"] and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    assert sorted(map(str, got)) == sorted(map(str, mixing.takings(mixing.mix(docs(spark, *rows), block_words=64)).collect()))
    order = found.taken.select("slot", "number").distinct().orderBy("slot").collect()
    half = order[: len(order) // 2]
    for number in range(3):  # every stretch of the schedule has nearly the sources' shares
        assert abs(sum(r["number"] == number for r in half) / len(half) - sum(r["number"] == number for r in order) / len(order)) < 0.08
    assert {r["taken"] for r in mixing.takings(mixing.mix(odd.limit(0))).collect()} == set()
    again = mixing.resampled(odd)
    assert again.columns == odd.columns and {r["_own"] for r in again.collect()} == {3}


# n-gram join


def brute_groups(texts):
    sets = []
    for t in texts:
        w = ngram_join.common.split_words(t)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y) and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = [lo if v == hi else v for v in label]
    return [len(s) for s in sets], label


def test_join_is_brute_force(spark):
    import random

    draw = random.Random(4)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(40)]
    texts = ["", None, "one two", "One  TWO", "a b c d e", "A b\tc d e"]
    for _ in range(40):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([6, 12, 60, 200]))]
        if draw.random() < 0.4:
            base = passage + base
        for _ in range(draw.randint(1, 5)):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 6])):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            texts.append(" ".join(own))
    sizes, label = brute_groups(texts)
    rows = sorted(ngram_join.joined(docs(spark, *enumerate(texts))).collect(), key=lambda r: r["doc_id"])
    assert [r["n_shingles"] for r in rows] == sizes
    assert [r["component_id"] for r in rows] == label


def test_join_odd_input(spark, odd):
    rows = sorted(tuple(r) for r in ngram_join.joined(odd.where("doc_id is not null")).collect())
    assert rows == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (4, 2, 4), (5, 1, 5)]
    assert ngram_join.joined(odd.limit(0)).count() == 0
    assert ngram_join.stage(spark, odd, "").columns == odd.columns


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=60))
def test_bitmaps_bound_the_difference(a, b):
    x, y = (np.array(sorted(s), np.uint64) for s in (a | {1}, b | {1}))
    assert ngram_join.bits_apart(ngram_join.bitmap(x), ngram_join.bitmap(y)) <= len((a | {1}) ^ (b | {1}))


def test_bands_hold_similar_sizes():
    for n in range(1, 3000):
        low = np.searchsorted(ngram_join.EDGES, n, "right")
        assert np.searchsorted(ngram_join.EDGES, n * 5 // 4, "right") - low <= 1


def test_components(spark):
    import random

    draw = random.Random(3)
    pairs = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(100, 130)]
    label = {}
    for a, b in pairs:
        label.setdefault(a, a), label.setdefault(b, b)
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    linked = {v for p in pairs if p[0] != p[1] for v in p}
    got = {r["vertex"]: r["component"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {v: label[v] for v in linked}


# vectors


def test_vectors_are_brute_force(spark):
    draw = np.random.default_rng(8)
    base = draw.normal(size=(300, 24))
    close = base[:60] + 0.12 * draw.normal(size=(60, 24))
    x = np.concatenate([base, close, base[:5], base[:3] * 4])
    rows = [(k, [float(v) for v in r], 1) for k, r in enumerate(x)] + [(900, None, 1), (901, [], 1), (902, [0.0] * 24, 1),
        (903, [float("nan")] * 24, 1), (904, [None] * 24, 1), (905, [1.0], 1)]
    got = {r["vec_id"]: r for r in vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    sure = np.abs(u @ u.T - 0.9).min() > 1e-12
    assert sure and len(got) == len(rows)
    found = sum(got[k]["n_links"] for k in range(len(x)))
    assert all(got[k]["n_links"] <= link[k].sum() for k in range(len(x))) and found >= 0.9 * link.sum()
    assert all((got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True) for k in range(900, 906))
    assert all(got[k]["component_id"] == got[360 + k]["component_id"] for k in range(5))


def test_recall_where_lists_are_skipped(spark, monkeypatch):
    """187 lists, of which a vector visits 12, against all pairs."""
    monkeypatch.setattr(vectors, "PER_LIST", 16)
    draw = np.random.default_rng(88)
    base = draw.normal(size=(2400, 32))
    x = np.concatenate([base, base[:600] + 0.42 * draw.normal(size=(600, 32))])
    assert vectors.lists_for(len(x)) > 10 * vectors.PROBES
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    got = vectors.near_duplicates(spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "vec_id long, embedding array<double>"))
    links = {r["vec_id"]: r["n_links"] for r in got.collect()}
    assert link.sum() > 400 and all(links[k] <= link[k].sum() for k in links)
    assert sum(links.values()) >= 0.95 * link.sum()


def test_vectors_without_id(spark):
    rows = [(None, [1.0, 0.0]), (7, [1.0, 0.1]), (3, [0.0, 1.0]), (None, [1.0, 0.0]), (None, None), (None, [-1.0, 0.0])]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str,
        [(None, 2, 7, False), (None, 2, 7, False), (7, 2, 7, True), (3, 0, 3, True), (None, 0, None, False), (None, 0, None, False)]))


# decontamination


def test_copies_and_clean_text(spark, odd):
    import random

    draw = random.Random(9)
    words = [f"word{k}" for k in range(2000)]
    item = [draw.choice(words) for _ in range(40)]
    edited = [w if k % 8 else draw.choice(words) for k, w in enumerate(item)]
    gap = item[:20] + ["extra", "words"] + item[20:]
    noise = lambda n: [draw.choice(words) for _ in range(n)]
    texts = [noise(100) + item + noise(50), noise(30) + edited + noise(30), gap, [w.upper() + "!!" for w in item], noise(300), item[:6] + noise(100)]
    df = docs(spark, *[(k, " ".join(t)) for k, t in enumerate(texts)])
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (9, None)], "item_id long, text string")
    seeds = list(decontaminate.blocks(bench))
    got = {(r["doc_id"], r["item_id"]): r["score"] for s in seeds for r in decontaminate.leaks(df, s).collect()}
    assert set(got) == {(0, 7), (1, 7), (2, 7), (3, 7)} and got[0, 7] == 1.0 and got[1, 7] < 1
    assert [r["doc_id"] for r in decontaminate.clean(df, seeds[0]).orderBy("doc_id").collect()] == [4, 5]
    assert decontaminate.clean(odd, seeds[0]).count() == 7
    assert list(decontaminate.blocks(bench.limit(0))) == []


def test_short_items_and_null_ids(spark):
    df = docs(spark, (1, "far East of here"), (2, "east, far of"), (3, "word " * 5000 + "FAR east of " + "word " * 5000), (None, "far east of"))
    bench = spark.createDataFrame([(None, "Far east of!"), (2, "word"), (3, "")], "item_id long, text string")
    (seeds,) = decontaminate.blocks(bench)
    got = decontaminate.leaks(df, seeds).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["score"]) for r in got) == [(0, None, 1.0), (1, None, 1.0), (3, None, 1.0)]
    assert [r["doc_id"] for r in decontaminate.clean(df, seeds).collect()] == [2]


@pytest.mark.parametrize("beside_verbatim", [False, True])
def test_edited_copies_are_brute_force(spark, beside_verbatim):
    """Items of 30, 40 and 50 words with every 5th, 6th or 7th word replaced, left out or doubled:
    one edited copy of each, alone or beside a verbatim one."""
    draw = np.random.default_rng(5)
    noise = lambda n: [f"noise{k}" for k in draw.integers(0, 10**6, n)]
    change = [lambda w: ["other"], lambda w: [], lambda w: [w, "more"]]
    items, texts = [], []
    for size in (30, 40, 50):
        for step in (5, 6, 7):
            for new in change:
                items.append([f"i{len(items)}w{k}" for k in range(size)])
                texts.append(noise(60) + [x for k, w in enumerate(items[-1]) for x in (new(w) if k % step == step - 1 else [w])] + noise(60))
    own = [*range(len(items))] * (2 if beside_verbatim else 1)
    texts += [noise(9) + item for item in items] if beside_verbatim else []
    df = docs(spark, *[(k, " ".join(t)) for k, t in enumerate([*texts, *[noise(30) + item[:5] + noise(30) for item in items]])])
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for s in decontaminate.blocks(bench) for r in decontaminate.leaks(df, s).collect()}

    def brute(item, text):
        h = np.zeros((len(item) + 1, len(text) + 1), int)
        for i in range(1, len(item) + 1):
            for j in range(1, len(text) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if item[i - 1] == text[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        return h.max() / (2 * len(item))

    want = {(k, i): brute(items[i], texts[k]) for k, i in enumerate(own)}
    assert min(want.values()) >= decontaminate.MIN_SCORE
    assert got == pytest.approx(want)


def test_alignment_is_smith_waterman():
    draw = np.random.default_rng(2)
    for _ in range(40):
        a, b = draw.integers(0, 4, draw.integers(1, 9)).astype(np.uint64), draw.integers(0, 4, draw.integers(1, 15)).astype(np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        assert decontaminate.best_alignments(a, [b, b[:1]])[0][0] == h.max()


# pages


PAGE = '<html><head><title>T</title><script>var a="<p>x</p>";</script></head><body><header>Site</header><nav><a>Menu</a></nav><div class="cookie-notice">ok?</div><article><h1>A &amp; B</h1><p>one<p>two <b>bo</b>ld&nbsp;!<br>next<div class="box">SHARED {n}</div><section id="comments"><p>nice</p></section><form>f</form></article><aside>side</aside><div class="ad">buy</div><footer>foot</footer></body></html>'


def own_text(source):
    return " ".join(t for t, _, why in pages.Page(source).segments() if why == pages.KEPT)


@pytest.mark.parametrize(
    "source, text",
    [
        ('<article><h1>T</h1><section id="related-work">..real text..</section><p>end</p></article>', "T ..real text.. end"),
        ('<article><h2 id="comments-on-the-method">On it</h2><p class="social-history">old</p><section id="comments-of-the-court">c</section></article>',
        "On it old c"),
        ('<article><p>a</p><div class="comment-list"><p>I think</p></div><div id="comments">x</div><ul class="share-buttons"><li>tweet</li></ul><p>b</p></article>',
        "a b"),
        ('<body><div class="site-header">S</div><div class="cookie notice">C</div><p>text</p><form>f</form></body>', "text"),
        ("<main><p>m</p><article class='teaser'>no</article></main>", "m"),
    ],
)
def test_lists_cut_no_sections(source, text):
    assert own_text(source) == text


def test_templates_are_counted_by_brute_force(spark):
    """Sites without telling names: only counts can find the menus (other words on each page), the
    slots beside the article and what repeats inside it."""
    import random

    draw = random.Random(10)
    word = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    rows, want = [], {}
    for k in range(60):
        host = k % 3
        body = word(30)
        menu = "".join(f'<li><a href="/{k}">{word(1)}</a></li>' for _ in range(draw.randint(2, 6)))
        article = f"<p>{body}</p><div>said on {'all' if host else k}</div>"
        rows.append((k, f"https://h{host}.example/{k}",
            f'<div class="x7"><ul>{menu}</ul></div><article>{article}</article><div class="q2">{word(5)}</div>' if host < 2
            else f"<div><ul>{menu}</ul></div><div>{article}</div><div>all the same here</div>"))
        want[k] = body + (f" said on {k}" if host == 0 else "")
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.main_text(table).collect()} == want
    took = {r["why"]: r["words"] for r in pages.removed(table).collect()}
    assert took["template"] >= 60 * 2 + 40 * 5 and not took.get("listed") and not took.get("outside")


def test_page_text():
    assert own_text(PAGE.replace("{n}", "1")) == "A & B one two bold ! next SHARED 1"
    for broken in ("", "<", "<p", "</p></div>", "<!-- open", "<script>never", "a < b > c", "<div class='x>y'>t</div>", "<" * 1000, "<p>" * 3000):
        pages.Page(broken).segments()


def test_templates_go(spark):
    own = [(k, f"https://User@Site.example:80/{k}", PAGE.replace("{n}", "everywhere").replace("one", f"one{k}")) for k in range(10)]
    other = [(100, "https://else.example/", PAGE.replace("{n}", "everywhere")), (101, None, None), (102, "", ""),
        (103, "https://site.example/x", PAGE.replace("{n}", "once"))]
    got = {r["page_id"]: r for r in pages.main_text(spark.createDataFrame(own + other, "page_id long, url string, html string")).collect()}
    assert got[3]["text"] == "A & B one3 two bold ! next" and got[100]["text"].endswith("SHARED everywhere") and got[103]["text"].endswith("SHARED once")
    assert got[101]["text"] == got[102]["text"] == "" and got[3]["n_chars"] == len(got[3]["text"])
    same = [(k, "https://copy.example/", PAGE.replace("{n}", "same")) for k in range(20)]
    assert {r["text"] for r in pages.main_text(spark.createDataFrame(same,
        "page_id long, url string, html string")).collect()} == {"A & B one two bold ! next SHARED same"}
