"""Writers, whole-file readers, table order and team pages."""

import json
import pathlib

from pyspark.sql import functions as F

from ledgerline.operators import boards, documents, serve
from ledgerline.plans.analog import Analog
from ledgerline.sources import readers, sinks

SMALL = "/root/testdata/sf0.001"


def parts(path, form=""):
    return sorted(p for p in pathlib.Path(path).rglob(f"part-*{form}") if ".crc" not in p.name)


def test_one_folder_a_season_and_kind(spark, tmp_path):
    df = spark.createDataFrame([(k, f"200{k % 3}-0{k % 3 + 1}", "RS" if k % 2 else "PO") for k in range(60)], "v int, season string, kind string")
    for _ in range(2):
        sinks.by_season(df, str(tmp_path / "t"))
    assert len(parts(tmp_path / "t")) == 6
    assert spark.read.parquet(str(tmp_path / "t")).where("season = '2001-02' and kind = 'RS'").count() == 10


def test_reports_pages_and_documents(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b", 2, "x")], "slug string, n int, t string")
    sinks.report(df.coalesce(1), str(tmp_path / "r"))
    assert sorted(line for p in parts(tmp_path / "r") for line in p.read_text().splitlines()) == ["a  1  —", "b  2  x"]
    for slugs in (["a", "b"], ["b"]):
        sinks.pages(spark.createDataFrame([(s, f"<p>{s}</p>") for s in slugs], "slug string, html string"), str(tmp_path / "p"))
    assert [p.parent.name for p in parts(tmp_path / "p")] == ["slug=b"]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x.json").write_text('{"a": {"b": [1, 2]},\n "c": null}')
    assert readers.json_documents(spark, str(tmp_path / "d"), "a struct<b:array<int>>, c string").first()["a"]["b"] == [1, 2]
    (row,) = readers.raw_json(spark, str(tmp_path / "d")).collect()
    assert json.loads(row["json"])["a"] == {"b": [1, 2]} and row["path"].endswith("x.json")


def test_search_index_file(spark, tmp_path):
    index = spark.createDataFrame([("Ed R", "ed-r", "ref", "3 g"), ("Al", "al", "player", "4 g")], "n string, s string, t string, u string")
    sinks.json_array(index, str(tmp_path / "i"), ["n", "s", "t"])
    found = json.loads("".join(p.read_text() for p in parts(tmp_path / "i")))
    assert found == [{"n": "Al", "s": "al", "t": "player", "u": "4 g"}, {"n": "Ed R", "s": "ed-r", "t": "ref", "u": "3 g"}]


def test_columns_sort_by_number_else_text(spark):
    df = spark.createDataFrame([("1,200",), ("90",), ("-3.5",), ("+7%",), ("b",), ("A",), (None,)], "c string")
    assert [r[0] for r in boards.column_sorted(df, "c").collect()] == ["-3.5", "+7%", "90", "1,200", "A", "b", None]
    assert [r[0] for r in boards.column_sorted(df, "c", True).collect()][:4] == ["1,200", "90", "+7%", "-3.5"]


def test_team_pages_of_a_table(spark):
    from ledgerline.plans import catalog

    docs = catalog._team_documents(Analog(spark, SMALL))
    pages = {r["slug"]: r["html"] for r in serve.team_pages(docs).collect()}
    rows = {r["slug"]: len(r["ref_records"]) for r in docs.collect()}
    assert set(pages) == set(rows) and all(html.count("<tr>") == (rows[s] + 1 if rows[s] else 0) for s, html in pages.items())


def test_index_documents(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "slug string, games int")
    (text,) = documents.index_of(df, ["slug", "games"], [F.col("slug")]).first()
    assert json.loads(text) == [{"slug": "a", "games": 1}, {"slug": "b", "games": 2}]
