from pyspark.sql import functions as F

from ledgerline.operators import boards, crew, documents, identity, merge, playoffs, profiles, quality, serve
from ledgerline.plans import catalog


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


OFF = "game_id string, official_id string, official_name string, row_order long"


def test_alternates_and_repeats(spark):
    off = frame(spark, OFF, ("g", "a", "A", 1), ("g", "a", "A", 2), ("g", "d", "D", 3), ("g", "b", "B", 4), ("g", "c", "C", 5), ("h", "a", "A", 1))
    kept = crew.without_alternates(off)
    assert rows(kept.select("game_id", "official_id", "rank_in_game")) == [("g", "a", 0), ("g", "b", 2), ("g", "d", 1), ("h", "a", 0)]
    assert rows(crew.size_histogram(kept)) == [(1, 1), (3, 1)]


def test_partners_are_cut_before_unknown_names_go(spark):
    c = frame(spark, "game_id string, ref_key string, display string, row_order long",
        *[(f"g{k}", r, r.upper(), i) for k in range(2) for i, r in enumerate("abc")], ("g9", "a", "A", 0), ("g9", "b", "B", 1))
    names = frame(spark, "ref_key string, display string", ("a", "A"), ("c", "C"))
    assert rows(crew.partners(c, names, top=1).select("ref_key", "partner", "games")) == [("b", "a", 3), ("c", "a", 2)]
    assert crew.crew_arrays(c).where("game_id = 'g9'").first()["crew"][1]["slug"] == "b"


def test_override_by_name_before_id(spark):
    people = frame(spark, "official_id string, official_name string, ref_key string", ("1", " Ann ", "x"), ("2", "Bob", "y"), ("3", "Cy", "z"))
    ov = frame(spark, "probe string, to_key string, to_display string, line long", ("ann", "n", "Anne", 1), ("1", "i", "", 2), ("2", "j", "", 3))
    found = identity.with_overrides(people, ov, "official_name", "official_id", "ref_key")
    assert rows(found.select("official_id", "ref_key", "override_display")) == [("1", "n", "Anne"), ("2", "j", None), ("3", "z", None)]


def test_display_name_ties(spark):
    r = frame(spark, "ref_key string, official_name string", ("k", "Al"), ("k", "Ali"), ("k", "Alf"), ("m", "B"), ("m", "B"), ("m", "Bbbb"))
    assert rows(identity.display_names(r, "ref_key", "official_name")) == [("k", "Alf"), ("m", "B")]


def test_near_duplicates(spark):
    keys = frame(spark, "ref_key string", ("eddie-rush",), ("eddie-f-rush",), ("edie-rush",), ("bob-lee",), ("bob-leeabc",), ("x",), ("xyz",))
    found = {(a, b): r for a, b, r in rows(identity.near_duplicates(keys))}
    assert found[("eddie-f-rush", "eddie-rush")] == "same-after-dropping-initials"
    assert found[("eddie-rush", "edie-rush")] == "edit-distance<=2"
    assert ("bob-lee", "bob-leeabc") not in found and ("x", "xyz") in found


def test_near_duplicates_miss_none(spark):
    import random

    draw = random.Random(1)
    base = ["".join(draw.choice("abc") for _ in range(draw.randint(1, 7))) for _ in range(60)]
    keys = sorted(set(base))
    found = {(a, b) for a, b, _ in rows(identity.near_duplicates(frame(spark, "ref_key string", *[(k,) for k in keys])))}

    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
        return d[-1]

    assert found == {(a, b) for a in keys for b in keys if a < b and distance(a, b) <= 2}


def test_near_duplicates_query_takes_all_suppliers(spark, tmp_path):
    names = {k: f"Supplier#{k:09d}" for k in (*range(1, 12), *range(55, 75), 100, 999, 1000, 1001, 1011, 123456)}
    frame(spark, "s_suppkey long, s_name string", *names.items()).write.parquet(str(tmp_path / "supplier.parquet"))
    found = {(r["a"], r["b"]): r["reason"] for r in catalog.queries()["near_duplicates"](spark, str(tmp_path)).collect()}

    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
        return d[-1]

    keys = sorted({n.replace("#", "-").replace("000", "-x-").lower() for n in names.values()})
    plain = {k: "-".join(t for t in k.split("-") if len(t) > 1) for k in keys}
    want = {(a, b): "same-after-dropping-initials" if plain[a] and plain[a] == plain[b] else "edit-distance<=2" for a in keys for b in keys
        if a < b and (plain[a] and plain[a] == plain[b] or distance(a, b) <= 2)}
    assert found == want and set(want.values()) == {"same-after-dropping-initials", "edit-distance<=2"}


SEG = "seg_id string, era string, player_id string, display string, name_key string, smin int, smax int, seasons array<string>, teams array<string>, games long"


def seg(i, era, lo, hi, key="k", games=1):
    return (i, era, i, i.upper(), key, lo, hi, [str(lo)], ["T"], games)


def test_entities_gap_chain_and_slugs(spark):
    s = frame(spark, SEG, seg("a", "espn", 2000, 2001), seg("b", "nba", 2003, 2005, games=9), seg("c", "espn", 2007, 2008), seg("d", "nba", 2018, 2019))
    assert rows(identity.entity_of(s)) == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "d")]
    ents = {r["component"]: r for r in identity.entities(s).collect()}
    assert (ents["a"]["slug"], ents["a"]["display"], ents["d"]["slug"]) == ("k", "B", "k-2")
    split = frame(spark, SEG, seg("a", "espn", 2000, 2002), seg("b", "nba", 2018, 2019))
    assert rows(identity.entity_of(split)) == [("a", "a"), ("b", "b")]


GAME = "game_id string, game_date string, season string, season_type string, home_team_abbr string, away_team_abbr string, home_pts double, away_pts double, home_win int, era string, kind string, po_round int, po_game_num int"


def game(i, season="2001-02", kind="RS", home="A", away="B", hp=10.0, ap=9.0, won=1, era="espn", date="2001-11-01", rnd=None, num=None):
    return (i, date, season, {"RS": "Regular Season", "PO": "Playoffs", "PI": "Play-In"}[kind], home, away, hp, ap, won, era, kind, rnd, num)


def test_no_result_is_a_loss_for_both(spark):
    g = frame(spark, GAME, game("1"), game("2", hp=None, ap=None, won=None))
    c = frame(spark, "game_id string, ref_key string", ("1", "r"), ("2", "r"))
    found = {r["team_abbr"]: r for r in profiles.team_records(c, g).collect()}
    assert (found["A"]["wins"], found["A"]["losses"], found["A"]["avg_margin_for_team"]) == (1, 1, 0.5)
    assert (found["B"]["wins"], found["B"]["losses"]) == (0, 2)
    assert quality.unbalanced_records(profiles.careers(c, g), profiles.team_records(c, g)).count() == 0


LOG = "game_id string, player_id string, player_name string, team_abbr string, min double, pts double, fta double, pf double, reb double, ast double"


def log(g, p="p", pts=10.0, team="A", minutes=252.5):
    return (g, p, p, team, minutes, pts, 1.0, 1.0, 1.0, 1.0)


def test_overtime_and_boxes(spark):
    logs = frame(spark, LOG, log("1"), log("1", "q", team="B", minutes=252.5), log("2", minutes=504.0))
    assert rows(profiles.game_totals(logs).select("game_id", "n_teams", "is_ot")) == [("1", 2, True), ("2", 1, False)]
    g = frame(spark, GAME, game("1"), game("2"), game("3"))
    c = frame(spark, "game_id string, ref_key string", ("1", "r"), ("2", "r"), ("3", "r"))
    w = {r["kind"]: r for r in profiles.whistle_profiles(c, g, profiles.game_totals(logs)).collect()}
    assert (w["RS"]["n"], w["RS"]["n_boxscore"], w["RS"]["ot_games"], w["RS"]["ot_rate"], w["PO"]["n"], w["PO"]["avg_total_points"]) == (3, 1, 1, 1.0, 0, None)


def test_swing_gates(spark):
    g = [game(f"r{k}") for k in range(15)] + [game(f"p{k}", kind="PO") for k in range(5)] + [game("i", kind="PI")]
    logs = [log(f"r{k}", pts=10.0 + k) for k in range(15)] + [log(f"p{k}", pts=50.0)
        for k in range(5)] + [log("i", pts=99.0)] + [log(f"r{k}", "q") for k in range(14)]
    c = [(x[0], "r") for x in g]
    games, crews = frame(spark, GAME, *g), frame(spark, "game_id string, ref_key string", *c)
    out = profiles.swings(crews, frame(spark, LOG, *logs), games).collect()
    assert [(r["slug"], r["n_games"], r["pts_swing"]) for r in out] == [("p", 20, 0.0)]
    four = [x for x in logs if x[0] != "p4"]
    assert profiles.swings(crews, frame(spark, LOG, *four), games).first()["n_games"] == 15
    best = profiles.top_performances(crews, frame(spark, LOG, *logs), games, top=2)
    assert [r["game_id"] for r in best.orderBy("rank").collect()] == ["i", "p0"]


def test_round_gate_is_all_or_nothing(spark):
    good = [game(f"004230040{k}", kind="PO", era="nba") for k in range(1, 5)]
    ids = [g[0] for g in good]
    assert all(i[7] == "4" for i in ids), ids
    base = frame(spark, GAME, *good).drop("po_round", "po_game_num")
    assert {tuple(r) for r in playoffs.label_from_ids(base).select("po_round").distinct().collect()} == {(4,)}
    more = [game(f"004230040{k}", kind="PO", era="nba") for k in (5, 6, 7, 8)]
    bad = frame(spark, GAME, *good, *more).drop("po_round", "po_game_num")
    assert {tuple(r) for r in playoffs.label_from_ids(bad).select("po_round").distinct().collect()} == {(None,)}


def test_series(spark):
    po = lambda k, date, a, b, won=1: game(f"{k}", kind="PO", home=a, away=b, date=date, won=won)
    g = frame(spark, GAME, po(1, "2002-04-01", "A", "B"), po(2, "2002-04-03", "B", "A", 0), po(3, "2002-04-05", "A", "B"),
        po(4, "2002-05-01", "A", "C"), po(5, "2002-05-03", "C", "A"))
    labels = {r["game_id"]: (r["round"], r["game_num"]) for r in playoffs.structural_labels(g).collect()}
    assert labels == {"1": (1, 1), "2": (1, 2), "3": (1, 3), "4": (1, 1), "5": (1, 2)}
    audit = {r["series"]: (r["agreed"], r["flag"], r["top_wins"]) for r in playoffs.series_audit(g).collect()}
    assert audit == {"A/B": (True, "OK", 3), "A/C": (False, "INCOMPLETE", 1)}
    days = playoffs.gap_days(playoffs.series_audit(g), "2002-05-02", "2002-05-04")
    assert days.count() == 3 and playoffs.probe_days(days, g).count() == 7


def test_notes(spark):
    n = frame(spark, "note string", ("West First Round - Game 3",), ("East Semifinals - Game 12",), ("East Conference Finals",),
        ("The Finals - game 7",), ("All-Star",))
    assert [tuple(r) for r in n.select(playoffs.note_round("note"), playoffs.note_game("note")).collect()] == [(1, 3), (2, 12), (3, None), (4, 7), (None, None)]


def test_merges(spark):
    kind = "game_id string, id string, v int"
    old, new = frame(spark, kind, ("g", "a", 1), ("g", "b", 1), ("h", "a", 1)), frame(spark, kind, ("g", "a", 2))
    assert rows(merge.upsert(old, new, "game_id", ["game_id", "id"], "v")) == [("g", "a", 2), ("h", "a", 1)]
    assert rows(merge.appended(old, new, ["game_id", "id"], "v")) == [("g", "a", 1), ("g", "b", 1), ("h", "a", 1)]
    assert rows(merge.appended(old, new, ["game_id", "id"], "v", first=False))[0] == ("g", "a", 2)
    assert merge.purged({"x": old}, new)["x"].count() == 1
    assert rows(merge.stacked(frame(spark, "a string", ("1",)), frame(spark, "b string", ("2",)))) == [("", "2"), ("1", "")]


def test_checks_can_fail(spark):
    g = frame(spark, GAME, game("1"), game("1"), game("2", era="nba", home="ATL", away="BOS"))
    off = frame(spark, OFF, ("9", "a", "A", 1), ("1", "a", "A", 1))
    c = frame(spark, "game_id string, ref_key string", ("1", "r"))
    report = quality.gate(off, g, c, profiles.careers(c, g), profiles.team_records(c, g))
    found = {r["check"]: r["failures"] for r in report.collect()}
    assert (found["orphan_officials"], found["duplicate_games"], found["mixed_seasons"], found["unknown_teams"]) == (1, 1, 1, 2)
    try:
        quality.enforce(report)
    except ValueError as error:
        assert "orphan_officials: 1" in str(error)
    else:
        raise AssertionError
    assert quality.nan_count(spark.range(2).select((F.lit(0.0) / F.lit(1.0)).alias("x"), F.lit(float("nan")).alias("y"))).first()[0] == 2


def test_documents_keep_nulls_and_empty_lists(spark):
    totals = frame(spark, "team_abbr string, games_total long, first_season string, last_season string", ("VAN", 5, "2000-01", None))
    records = frame(spark, "ref_key string, team_abbr string, games long, wins long, losses long, win_pct double, home_games long, home_wins long, away_games long, away_wins long, avg_margin_for_team double",
        ("r", "VAN", 3, 1, 2, 0.33, 1, 1, 2, 0, 0.5))
    names = frame(spark, "ref_key string, display string", ("r", "R"))
    doc = documents.team_documents(totals, records, names).first()
    assert doc["document"] == '{"summary":{"tricode":"VAN","name":"Vancouver Grizzlies","slug":"van","first_season":"2000-01","last_season":null,"games_total":5,"historical":true},"ref_records":[]}'
    html = serve.team_pages(documents.team_documents(totals, records, names, least=1)).first()["html"]
    assert "Vancouver Grizzlies" in html and 's-pos-1' in html


def test_search(spark):
    index = frame(spark, "n string, s string, t string", ("Ann Lee", "1", "ref"), ("Joann", "2", "ref"), ("Annabel Long", "3", "player"), ("Bob", "4", "team"))
    assert [r["s"] for r in boards.search(index, " ANN").collect()] == ["1", "3", "2"]
    assert boards.search(index, "").count() == 0
    assert [r["n"] for r in boards.directory(index).collect()][0] == "Ann Lee"


def test_search_index_query_has_every_document(spark):
    import json

    made = lambda name: catalog.queries()[name](spark, "/root/testdata/sf0.001")
    index: dict = {"ref": {}, "team": {}, "player": {}}
    for r in made("search_index").collect():
        assert r["s"] not in index[r["t"]]
        index[r["t"]][r["s"]] = (r["n"], r["u"])
    shown = lambda s: (s["name"], f"{s['games_total']:,} g · {s['first_season'][:4]}-{int(s['last_season'][:4]) + 1}")
    people = {kind: {s["slug"]: shown(s) for r in made(f"{kind}_document").select("document").collect()
        for s in [json.loads(r[0])["summary"]]} for kind in ("ref", "player")}
    teams = {r["team_abbr"].lower(): shown({"name": r["team_abbr"], **r.asDict()}) for r in made("team_document").collect()}
    assert index == {**people, "team": teams} and all(index.values())
