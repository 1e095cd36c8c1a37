"""Role repair, personal data and ranked search against brute force, on odd input and hot groups."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from ledgerline.llm import pii, ranked_search, role_repair

SF = "/root/testdata/sf0.001"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ROLE = {"u": "user", "a": "assistant"}


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# ---- role repair


def least(rows, faults):
    """(cost, audit, turns) of the cheapest repair, by trying all."""
    memo = {}

    def best(i, state, inserted):
        key = (i, state, inserted)
        if key not in memo:
            found = [(0, "", ())] if i == len(rows) and state in (0, 3) else []
            if inserted < 2:
                for t, s in NEXT[state].items():
                    if t in ROLE:
                        c, a, o = best(i, s, inserted + 1)
                        found.append((c + 2, "I" + a, ((ROLE[t], ""), *o)))
            if i < len(rows):
                c, a, o = best(i + 1, state, 0)
                found.append((c + 3, "D" + a, o))
                more = faults[i] == "truncated"
                for t, s in NEXT[state].items() if faults[i] not in ("blank", "duplicate") else ():
                    c, a, o = best(i + 1, s, 0)
                    if rows[i][1][:1] == t:
                        found.append((c + more, "K" + a, (rows[i][1:], *o)))
                    if t in ROLE:
                        found.append((c + more + 2, "R" + a, ((ROLE[t], rows[i][2]), *o)))
            memo[key] = min(found, default=(10**9, "", ()))
        return memo[key]

    for i in range(len(rows), 0, -1):  # from the end, so that calls don't nest
        for state in NEXT:
            best(i, state, 0)
    return best(0, 0, 0)


def repaired(rows):
    """What the query returns for the rows (conv_id, turn, role, text), conversation by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
            faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in own if r[0] is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = least(own, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        k, role, text = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20, shown[2], shown[3]
        if k:
            text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
TURNS = "conv_id long, turn long, role string, text string"
EMPTY = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def told(df):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_role_repair_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: EMPTY for r in rows} | repaired(damaged(rows))
    assert told(role_repair.op11_role_repair(spark, SF)) == want


def odd_turns(seed, n_conv, n):
    pick = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["One.", "Two!", "cut off", " \t", "", None, "Three?\n", "user", "ö…"]
    return [(pick.choice([None, *range(n_conv)]), pick.choice([None, *range(6)]), pick.choice(roles), pick.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_role_repair_of_odd_rows(spark, seed):
    rows = odd_turns(seed, 60, 300)
    df = frame(spark, rows, TURNS).selectExpr("*", "text AS place", "1 AS seg", "turn AS copies")
    found = role_repair.repaired_digests(df, role_repair.repair(df))
    shown = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert told(found) == repaired(shown)


def test_one_conversation_over_many_segments(spark):
    pick = random.Random(5)
    rows = [(7, t, pick.choice(["user", "assistant", "system", "user"]), f"{pick.choice(['a', 'b', 'c'])}{pick.randrange(40)}{pick.choice(['.', ''])}") for t in range(600)]
    rows += [(8, 0, "user", "Hi."), (8, 1, "assistant", "Hello.")]
    df = frame(spark, rows, TURNS)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        done = role_repair.repair(df)
        assert done.rows.where("conv_id = 7").select("seg").distinct().count() > 1
        assert told(role_repair.repaired_digests(df, done)) == repaired(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_joined_segments_equal_one_chart():
    pick = random.Random(3)
    for _ in range(60):
        turns = [(pick.choice("suatx"), pick.choice([0, 0, 1, 2, 3])) for _ in range(pick.randrange(1, 30))]
        whole = role_repair.Chart(role_repair.GRAMMAR, role_repair.GRAMMAR.start)
        for turn in turns:
            whole.read(*turn)
        cuts = sorted({0, len(turns), *(pick.randrange(len(turns) + 1) for _ in range(3))})
        parts = []
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            found = []
            for entry in range(len(role_repair.GRAMMAR.terminal)) if k else [-1]:
                chart = role_repair.Chart(role_repair.GRAMMAR, role_repair.GRAMMAR.start if entry < 0 else [entry])
                for turn in turns[a:b]:
                    chart.read(*turn)
                found += [{"entry": entry, "exit": i, "cost": c, "audit": x} for i, (c, x) in chart.found().items()]
            parts.append((1, k, 0, turns[a][0], turns[b - 1][0], found))
        out = role_repair.joined(pd.DataFrame(parts, columns=["conv_id", "seg", "illegal", "first", "last", "found"])).sort_values("seg")
        assert (out["cost"].sum(), "".join(out["audit"])) == whole.found()[role_repair.GRAMMAR.complete]


def test_long_audits_are_frozen_without_a_change(monkeypatch):
    pick = random.Random(9)
    turns = [(pick.choice("suax"), pick.choice([0, 0, 0, 3, 1])) for _ in range(300)]
    found = []
    for tail in (3, 10**6):
        monkeypatch.setattr(role_repair, "TAIL", tail)
        chart = role_repair.Chart(role_repair.GRAMMAR, role_repair.GRAMMAR.start)
        for turn in turns:
            chart.read(*turn)
        found.append(chart.found())
    assert found[0] == found[1]


def test_many_equal_turns_and_empty_tables(spark):
    rows = [(1, 0, "user", "Same.")] * 500 + [(2, None, "user", "   ")] * 50
    df = frame(spark, rows, TURNS)
    assert told(role_repair.repaired_digests(df, role_repair.repair(df))) == repaired(rows)
    none = frame(spark, [], TURNS)
    assert told(role_repair.repaired_digests(none, role_repair.repair(none))) == {}
    # all rows of a conversation are gone
    assert told(role_repair.repaired_digests(df, role_repair.repair(none))) == {1: EMPTY, 2: EMPTY}


def test_repaired_turns_are_given_back(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", " "), (1, 3, "tool", "x" * 300_000)]
    got = role_repair.repair(frame(spark, rows, TURNS)).turns.orderBy("seg", "step").collect()
    assert [(r["edit"], r["role"], len(r["text"])) for r in got] == [("K", "system", 8), ("K", "user", 3), ("D", "user", 1), ("R", "assistant", 300_000)]


# ---- personal data


def plain_spans(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        doubled = [x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(reversed(digits))]
        if 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return sorted(out)


def test_patterns_as_written():
    pick = random.Random(1)
    pieces = ["a", ".", "@", "-", "1", "2", "25", ".", "+", "(", ")", " ", "é", "b.c", "4111111111111111", "7", "300", "_", "%", "\n"]
    for _ in range(20_000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randrange(40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_patterns_take_linear_time():
    for one in ("a", "1", "1.", "+", "@", "a@", "1 ", "+1", "+1 ", "a@b.", "9-", "."):
        pii.base_spans(one * 200_000)


DOCS = "doc_id long, text string, lang string"


def texts_that_tell():
    """zorbax is only ever near one address, in surroundings that differ; quelle is near it as often,
    and everywhere else, too."""
    pick = random.Random(2)
    word = lambda: "".join(pick.choice("bcdfglmnprst") + pick.choice("aeiou") for _ in range(3))
    rows = [(k, " ".join([*(word() for _ in range(30)), "quelle"]), "en") for k in range(200)]
    rows += [(200 + k, f"{word()} {word()} Zorbax quelle {word()} wrote from ana.q@mail.example.org {word()} {word()}", "en") for k in range(5)]
    rows += [(300, f"here {word()} ZORBAX is named alone", "en"), (301, None, None), (302, "", None), (None, "x@y.zz", None), (300, "again, ip 10.0.0.1", "fr")]
    # copies of one text are one piece of evidence
    rows += [(400 + k, "the copied mumbletext was sent by bob@copy.example.org last week", "en") for k in range(40)]
    return rows


def test_terms_that_disclose(spark):
    docs = frame(spark, texts_that_tell(), DOCS)
    labels = {r["term"]: r["label"] for r in pii.disclosing(docs).collect()}
    # by the definition, with plain Python
    rows = [t for _, t, _ in texts_that_tell() if t]
    near, n, entities = defaultdict(set), Counter(), Counter()
    docs_near = Counter()
    for t in rows:
        here = list(pii.surroundings(t))
        for term, who, where, first in here:
            near[term, who].add(where)
            docs_near[term, who] += first
            entities[who] += first if not term else 0
        words = {w.decode() for w in ranked_search.terms_of(t)}
        n.update(words | {g for g in map(pii.general, words) if g})
    want = set()
    for (term, who), places in near.items():
        if term and min(len(places), docs_near[term, who]) >= pii.SUPPORT:
            told_nats = math.log(len(rows) * docs_near[term, who] / (n[term] * entities[who]))
            if told_nats >= pii.LEAST and told_nats >= pii.SHARE * math.log(len(rows) / entities[who]):
                want.add(term)
    assert set(labels) == {t for t in want if not t.endswith("*")} and "zorbax" in labels
    assert "quelle" not in labels and "mumbletext" not in labels
    for term, label in labels.items():
        form = pii.general(term)
        assert label == ("" if form is None or form in want else form)


def test_spans_and_sanitised_texts(spark):
    docs = frame(spark, texts_that_tell(), DOCS).selectExpr("*", "lang AS spans", "1 AS n")
    labels = frame(spark, [("zorbax", "zor*"), ("quelle", "")], "term string, label string")
    found = pii.spans(docs, labels).collect()
    assert len(found) == len(texts_that_tell())
    for r in found:
        text = r["text"] or ""
        own = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
        assert [s for s in own if s[1] < 4] == plain_spans(text)
        assert [text[a:b].lower() for a, k, b in own if k == 4] == re.findall(r"zorbax|quelle", text.lower())
    clean = {(r["doc_id"], r["lang"]): r for r in pii.sanitised(docs, labels).collect()}
    assert clean[300, "en"]["text"].split()[2] == "zor*" and clean[300, "fr"]["text"] == "again, ip [IP]"
    assert clean[301, None]["text"] is None and clean[None, None]["text"] == "[EMAIL]" and clean[200, "en"]["n"] == 1
    assert not any("ana.q@" in (r["text"] or "") or "quelle" in (r["text"] or "") for r in clean.values())


def test_blocks_of_terms_change_nothing(spark, monkeypatch):
    docs = frame(spark, texts_that_tell(), DOCS)
    key = lambda df: sorted((str(r["doc_id"]), r["text"] or "", str(r["spans"])) for r in df.collect())
    labels = pii.disclosing(docs)
    whole = key(pii.spans(docs, labels))
    assert any("zor" in str(r["label"]) or r["label"] == "" for r in labels.collect())
    monkeypatch.setattr(pii._blocks, "__defaults__", (2,))
    assert key(pii.spans(docs, pii.disclosing(docs))) == whole


def test_personal_data_over_the_table(spark):
    got = {r["doc_id"]: r for r in pii.op12_personal_data(spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        own = plain_spans(d["text"])
        said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in own)
        r = got.pop(d["doc_id"])
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == k for x in own) for k in range(4)]
        assert set(said.split(",")) <= set(r["spans"].split(","))
    assert not got


def test_personal_data_of_no_documents(spark):
    none = frame(spark, [], DOCS)
    assert pii.digested(pii.spans(none, pii.disclosing(none))).count() == 0
    assert pii.sanitised(none, pii.disclosing(none)).columns == ["doc_id", "text", "lang"]


# ---- ranked search


def terms(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [t.translate(lower) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranks(docs, items, k=10):
    own = [(d, Counter(t := terms(x)), len(t)) for d, x in docs]
    own = [x for x in own if x[2]]
    n_docs, total = len(own), sum(x[2] for x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c, n in own:
            m = 25 + (75 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def listed(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_ranked_search_by_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(ranked_search, "RANKS", 3)
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", 40)
    pick = random.Random(seed)
    words = [f"w{k}" for k in range(25)] + ["Ünï", "a1", "É"]
    text = lambda n: " ".join(pick.choice(words[: pick.randrange(3, 28)]) for _ in range(pick.randrange(n)))
    docs = [(k, text(30)) for k in range(150)] + [(None, "w1 W1, w2"), (None, "w1 w1 w2"), (3, "w1"), (900, None), (901, " .,;"), (902, "w3 " * 5000)]
    docs += [(1000 + k, "w5 w6 w7") for k in range(60)]  # ties
    items = [(k, text(12)) for k in range(20)] + [(50, "w5 w6"), (50, "w5 w6 w5"), (None, "w1"), (51, None), (52, "unseen"), (53, "")]
    got = ranked_search.ranked(frame(spark, docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS terms"), frame(spark, items, "item_id long, text string"))
    assert listed(got) == ranks(docs, items)
    few = ranked_search.ranked(frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string"), k=3, size=20)
    assert listed(few) == ranks(docs, items, 3)


def test_sorted_access_stops_early(monkeypatch):
    monkeypatch.setattr(ranked_search, "RANKS", 4)
    n = 1000
    np = ranked_search.np
    stats = ranked_search.Statistics(n, 100 * n, np.array([n // 2]))
    counts = np.arange(n, 0, -1)
    shard = ranked_search.Shard(np.array(range(n), object), np.full(n, 100), np.ones(n, np.int64), np.zeros(n, np.int64), counts, stats, stats.weights)
    asked = []
    scores = shard.scores
    shard.scores = lambda docs, *rest: asked.extend(docs.tolist()) or scores(docs, *rest)
    best = shard.search(np.array([0]), np.array([1]), [], 10)
    assert [d for _, _, d in best] == list(range(10)) and len(asked) <= 16


def test_ranked_search_of_nothing(spark):
    none, some = frame(spark, [], "item_id long, text string"), frame(spark, [(1, "w")], "doc_id long, text string")
    assert ranked_search.ranked(some, none).count() == 0
    assert ranked_search.ranked(some.limit(0), none.union(some)).count() == 0
