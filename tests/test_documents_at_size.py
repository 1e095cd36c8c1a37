"""Players' documents are put together from texts."""

import json

from pyspark.sql import functions as F

from ledgerline.operators import documents
from ledgerline.plans import catalog

SF = "/root/testdata/sf0.001"


def test_a_long_list_is_put_together_from_pieces(spark, monkeypatch):
    """Order, commas and brackets at the pieces' borders; a player without top games."""
    monkeypatch.setattr(documents, "PIECE", 7)
    splits = spark.range(40).selectExpr("if(id < 21, 'a', 'b') slug", "cast(id as string) ref_key", "id % 5 n_games", "if(id = 3, null, id / 7) pts_swing")
    games = spark.createDataFrame([("a", "S", "T", "1", "nba", "A"), ("b", "S", "T", "1", "nba", "B")], "slug string, season string, team_abbr string, game_id string, era string, player_name string")
    top = spark.createDataFrame([("a", 1, 9, 8, 7, "T", "U", "1999-01-01", "1")],
        "player_id string, rank int, pts long, reb long, ast long, team_abbr string, opp_abbr string, game_date string, game_id string")
    crews = spark.createDataFrame([("1", [("n", "s")])], "game_id string, crew array<struct<name:string,slug:string>>")
    names = splits.select("ref_key", F.concat(F.lit('"n,'), "ref_key").alias("display"))
    found = {r.slug: json.loads(r.document) for r in documents.player_documents(games, splits, top, crews, names).collect()}
    rows = splits.collect()
    for slug in ("a", "b"):
        want = sorted((r for r in rows if r.slug == slug), key=lambda r: (-r.n_games, r.ref_key))
        assert [(x["ref_slug"], x["ref_name"], x["n_games"], x["pts_swing"]) for x in found[slug]["ref_splits"]] == [
            (r.ref_key, f'"n,{r.ref_key}', r.n_games, r.pts_swing) for r in want]
        assert found[slug]["summary"]["slug"] == slug
    assert [g["crew"] for g in found["a"]["top_games"]] == [[{"name": "n", "slug": "s"}]] and found["b"]["top_games"] == []
    texts = documents.player_parts(games, splits, top, crews, names).where("section = 'ref_splits'").collect()
    assert max(len(json.loads(f"[{r.text}]")) for r in texts) == 7 and len(texts) == 6


def test_player_rows_parse_no_whole_document(spark):
    told = catalog.queries()["player_document_rows"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "ref_splits" in told and '{"summary":' not in told
