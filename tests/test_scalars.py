import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as names
from ledgerline.functions import scalars as X


def values(spark, rows, *exprs, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [tuple(r) if len(exprs) > 1 else r[0] for r in df.select(*exprs).collect()]


def test_schemes_and_kinds(spark):
    ids = ["0022300001", "401752955", "201101002", "00223000x1", ""]
    assert values(spark, ids, X.era("x")) == ["nba", "espn", "espn", "nba", "espn"]
    assert values(spark, ids, X.era("x", strict=True)) == ["nba", "espn", "espn", "espn", "espn"]
    assert values(spark, ["Playoffs", "Play-In", "Regular Season", "In-Season", None], X.kind("x")) == ["PO", "PI", "RS", "RS", "RS"]


def test_seasons(spark):
    assert values(spark, ["0022300001", "0049900405", "00x", "004"], X.id_season("x"), X.id_season_type("x"),
        X.id_season_type("x", 0)) == [(2023, "Regular Season", "RS"), (1999, "Playoffs", "PO"), (None, "Unknown", "??"),
        (None, "Playoffs", "PO")]
    assert values(spark, ["2023", "22023", "2023-24", " ", None, "1999"], X.season_normal("x", F.lit("?"))) == ["2023-24", "2023-24",
        "2023-24", "?", "?", "1999-00"]


def test_ids(spark):
    assert values(spark, ["1018.0", " 7 ", "nan", "", None, "12345678901"], X.clean_id("x", 10)) == ["0000001018", "0000000007", "", "", "", "12345678901"]
    assert values(spark, ["1018.0", "x", None], X.number_id("x")) == ["1018", None, None]


def test_names(spark):
    rows = ["J.B. DeRosa", "Amar'e Stoudemire", "Gary Payton II", "Nikola Đurišić", "Søren  Hansen-Jr. Smith", None]
    assert values(spark, rows, X.name_key("x", keep_suffixes=False)) == ["j-b-derosa", "amare-stoudemire", "gary-payton", "nikola-urisic",
        "sren-hansen-smith", None]
    assert values(spark, rows[2:3], X.name_key("x", keep_suffixes=True)) == ["gary-payton-ii"]
    assert values(spark, [" --Ed Rush!! "], X.feed_slug("x")) == ["ed-rush"]
    assert values(spark, ["eddie-f-rush", "a-b"], X.without_initials("x")) == ["eddie-rush", ""]


def test_team_codes(spark):
    assert values(spark, [" gs", "UTAH", "nj", "van", "zzz", "", None], X.tricode("x")) == ["GSW", "UTA", "NJN", "VAN", "ZZZ", "", ""]
    assert values(spark, ["gsw", "CHH", "zz"], X.team_name("x")) == ["Golden State Warriors", "Charlotte Hornets (1988-2002)", "zz"]


@pytest.mark.parametrize("x", [0.125, 2.675, 1.005, 4.605, -0.125, 0.375, 61.625, -2.5, 1 / 3])
def test_rounding_is_that_of_the_exact_number(spark, x):
    assert values(spark, [(x,)], X.round2(F.col("x")), schema="x double") == [round(x, 2)]


def test_numbers(spark):
    assert values(spark, ["34:12", "12.5", None, "nan"], X.zero_filled("x")) == [0.0, 12.5, 0.0, 0.0]
    assert values(spark, ["10-18", "7", "", None], X.made("x"), X.attempted("x")) == [("10", "18"), ("7", None), (None, None), (None, None)]
    assert values(spark, [(0.4,), (-0.5,), (1.5,), (-3.0,), (7.0,), (None,)], X.heat("x"), schema="x double") == ["sw s-zero", "sw s-neg-1",
        "sw s-pos-2", "sw s-neg-3", "sw s-pos-4", "sw s-zero"]


def test_display(spark):
    one = spark.range(1)
    row = one.select(X.thousands(F.lit(1234567)), X.percent(F.lit(0.605)), X.signed(F.lit(1.25)), X.decimal(F.lit(None).cast("double")),
        X.html_escaped(F.lit("<a & 'b'>")), X.career_span(F.lit("2015-16"), F.lit("2025-26"))).first()
    assert list(row) == ["1,234,567", "60.5%", "+1.3", "—", "&lt;a &amp; &#x27;b&#x27;&gt;", "2015-2026"]
    words = [one.select(X.in_words(F.array(*[F.lit(w) for w in ws]))).first()[0] if ws else None for ws in ([], ["a"], ["a", "b"], ["a", "b", "c"])]
    assert words == [None, "a", "a, and b", "a, b, and c"]


def test_utc_day(spark):
    assert values(spark, ["2001-01-02T01:30:00Z", "2001-01-01T20:30:00-05:00", "soon"],
        F.date_format(F.try_to_timestamp("x"), "yyyy-MM-dd")) == ["2001-01-02", "2001-01-02", None]


def test_columns_by_pattern():
    cols = ["GAME_ID", "Team ID", "FTM", "+/-"]
    assert names.find_column(cols, ["gameid"]) == "GAME_ID"
    assert names.find_column(cols, ["teamid"], exclude=["team"]) is None
    assert names.find_column(cols, ["plusminus"]) is None and names.find_column(cols, ["plusminus"], signs=True) == "+/-"
    assert names.find_column(["x_min_y"], ["min"], exact_only=["min"]) is None
    assert names.best_table({"a": ["gameid"], "b": ["gameid", "pts"]}, [["gameid"], ["pts"]], 1) == "b"
    assert names.best_table({"a": ["x"]}, [["gameid"]], 1) is None
