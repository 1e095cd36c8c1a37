"""What queries over lines shuffle, and over how many tasks, as the tables grow."""

import re

from ledgerline.operators import crew, profiles
from ledgerline.plans import analog, catalog
from ledgerline.plans.analog import Analog

SF = "/root/testdata/sf0.001"


def final_plan(df):
    df.collect()
    told = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return told.split("== Initial Plan ==")[0]


def shuffles_of_lines(df):
    lines = [x for x in final_plan(df).splitlines() if "ReusedExchange" not in x]
    return sum("Exchange hashpartitioning(l_orderkey" in x for x in lines)


def test_lines_are_shuffled_once_whatever_is_made_of_them(spark):
    for name in ("player_swings", "top_performances"):
        assert shuffles_of_lines(catalog.queries()[name](spark, SF)) == 1, name
    assert shuffles_of_lines(Analog(spark, SF).schedule) == 0


def test_schedule_is_games_without_boxes(spark):
    t = Analog(spark, SF)
    same = t.games.select(t.schedule.columns)
    assert same.exceptAll(t.schedule).isEmpty() and t.schedule.exceptAll(same).isEmpty()


def test_groups_get_tasks_by_the_number_of_lines(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(analog, "LINES_A_TASK", 250)
    tasks = -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 250)
    try:
        told = catalog.queries()["league_logs"](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(season#\d+, kind#\d+, player_id#\d+, game_id#\d+, {tasks}\)", told)
        told = catalog.queries()["players_without_splits"](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"hashpartitioning\(ref_key#\d+, player_id#\d+, season#\d+, kind#\d+, era#\d+, {tasks}\)", told)
    finally:
        monkeypatch.undo()
        catalog.queries()["league_logs"](spark, SF)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_bounds_keep_every_best_performance(spark):
    """Ties at the bound, scores that are null, officials with fewer games than the list is long."""
    games = spark.range(60).selectExpr("lpad(id, 3, '0') game_id", "'1999-01-01' game_date", "'1998-99' season", "'nba' era", "'H' home_team_abbr", "'A' away_team_abbr")
    logs = spark.range(60 * 4).selectExpr("lpad(id div 4, 3, '0') game_id", "concat('p', id % 7) player_id", "concat('p', id % 7) player_name",
        "if(id % 2 = 0, 'H', 'A') team_abbr", "if(id % 11 = 0, null, double((id * 7919) % 13)) pts", "1d min", "double(id % 5) reb", "0d ast", "0d fta", "0d pf")
    crew = spark.range(60 * 3).selectExpr("lpad(id div 3, 3, '0') game_id", "if(id < 9, 'few', concat('r', id % 3)) ref_key").distinct()
    plainly = profiles.top_performances(crew, logs, games, top=5)
    bound = profiles.top_performances(crew, logs, games, top=5, send_bounds=True)
    assert sorted(bound.collect()) == sorted(plainly.collect()) and plainly.count() == 20
    assert "least#" in bound._jdf.queryExecution().optimizedPlan().toString()


def test_parts_that_are_many_missing_or_doubled(spark, monkeypatch, tmp_path):
    """Brands that aren't sent give the same rows; a line counts once for each row of its part, and not without one."""
    for name in ("orders", "lineitem", "supplier", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey % 5 <> 0")
    part.union(part.where("p_partkey % 7 = 0")).write.parquet(f"{tmp_path}/part.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_partkey % 5 <> 0").selectExpr("if(l_partkey % 7 = 0, 2, 1) n").groupBy().sum().first()[0]
    sent = Analog(spark, str(tmp_path)).logs
    monkeypatch.setattr(analog, "PARTS_SENT", 0)
    met = Analog(spark, str(tmp_path)).logs
    assert sent.count() == met.count() == lines
    assert sent.exceptAll(met).isEmpty() and met.exceptAll(sent).isEmpty()


def test_swings_shuffle_one_sum_and_one_row_of_each_game(spark):
    """Crews and logs travel by game as one; means that are few meet the rows where these are."""
    told = final_plan(catalog.queries()["player_swings"](spark, SF))
    own = [x for x in told.splitlines() if "ReusedExchange" not in x]
    assert sum("Exchange hashpartitioning(game_id" in x and "REPARTITION" in x for x in own) == 1
    assert not any("Exchange hashpartitioning(ref_key" in x and "season" in x for x in own)


def test_crews_cut_before_they_travel_are_the_same(spark):
    """Of each order's lines only its first officials are dealt by game; a game's first ones are among them."""
    t = Analog(spark, SF)
    plainly = crew.without_alternates(t.officials).select("game_id", "official_id", "official_name", "row_order", "rank_in_game")
    cut = t.crew.select(plainly.columns)
    assert cut.exceptAll(plainly).isEmpty() and plainly.exceptAll(cut).isEmpty()
    told = t.crew._jdf.queryExecution().optimizedPlan().toString()
    assert "array_distinct" in told
