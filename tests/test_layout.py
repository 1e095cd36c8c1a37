"""Tables in buckets by game: joins and groups by game shuffle nothing, and rows are the same."""

import re

from ledgerline.operators import profiles
from ledgerline.plans import catalog
from ledgerline.plans.analog import Analog, Laid
from ledgerline.sources import layout

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def by_game(text):
    return re.findall(r"Exchange hashpartitioning\(game_id#\d+, \d+\)", text)


def test_swings_shuffle_nothing_by_game(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        told = plan(catalog.queries()["bucketed_swings"](spark, SF))
        assert "Bucketed: true" in told and not by_game(told)
        plainly = Analog(spark, SF)
        assert by_game(plan(profiles.swings(plainly.crew, plainly.logs, plainly.games)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_laid_out_hold_the_same_rows(spark):
    plainly, laid = Analog(spark, SF), Laid(spark, SF)
    for name in ("games", "crew", "officials", "logs"):
        x, y = getattr(plainly, name), getattr(laid, name)
        assert x.columns == y.columns
        assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty(), name


def test_null_keys_empty_tables_and_one_file_a_bucket(spark):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("a", 3), (None, 4)], "k string, v int")
    back = layout.bucketed(rows, "k", "small", buckets=3)
    assert sorted(r.v for r in back.collect()) == [1, 2, 3, 4]
    assert len(back.inputFiles()) <= 3
    assert layout.bucketed(rows.where("v > 9"), "k", "none").isEmpty()
    assert layout.written(rows, "small").exceptAll(rows).isEmpty()


def test_lines_are_dealt_over_more_tasks_the_more_there_are(spark, monkeypatch):
    """Totals by game and team meet by game alone, with as many tasks as the lines call for."""
    monkeypatch.setattr("ledgerline.plans.analog.LINES_A_TASK", 250, raising=False)
    tasks = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 250)
    t = Analog(spark, SF)
    told = t.crew.join(profiles.game_totals(t.logs), "game_id")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"hashpartitioning\(game_id#\d+, {tasks}\)", told)) == 2 and "team_abbr#" in told
    assert not re.search(r"hashpartitioning\(game_id#\d+, team_abbr", told)
