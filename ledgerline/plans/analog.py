"""The domain's tables, made from the star-schema tables that queries run on.

An order is a game, its lines are the officials' rows in written order and the players' box
score, a supplier an official, a part's brand a player, a nation a team. Orders up to 1996 have
the one id scheme, later ones the other.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import crew as crews
from ..operators import profiles
from ..sources import layout

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
#: What the tables in buckets keep of a line.
LINE_FIELDS = ("l_suppkey", "s_name", "s_nationkey", "l_partkey", "l_quantity", "l_discount", "l_tax", "l_linenumber", "brands")
#: So many lines a task holds at most, about, when they meet by order or game.
LINES_A_TASK = 500_000
#: Of more officials, no row for each is sent to all tasks.
OFFICIALS_SENT = 2_000_000
#: Of more parts, brands aren't sent to all tasks, but meet the lines by part.
PARTS_SENT = 3_000_000
#: Of more season means, no row for each is sent to all tasks.
MEANS_SENT = 500_000


class Analog:
    #: What lines are sorted by, and so what all of them bring to their order.
    line_order = LINE_ORDER

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @staticmethod
    def _id(key):
        return F.concat(F.when(F.year("o_orderdate") <= 1996, "4").otherwise("00"), F.lpad(F.col(key).cast("string"), 8, "0"))

    @staticmethod
    def _team(key):
        return F.concat(F.lit("T"), F.lpad(X.col(key).cast("string"), 2, "0"))

    @cached_property
    def tasks(self) -> int:
        """Over how many tasks lines are dealt, so that what a task holds doesn't grow with the tables. Their
        number is in the files' footers."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-self.table("lineitem").count() // LINES_A_TASK))

    def deal(self) -> None:
        """Lets joins and groups have as many tasks as the lines call for, too: with the session's number alone
        what a task holds would grow with the tables. A number that was set here before doesn't count as the session's."""
        conf = self.spark.conf
        now, (ours, before) = conf.get("spark.sql.shuffle.partitions"), conf.get("ledgerline.partitions", ",").split(",")
        if now == ours:
            conf.set("spark.sql.shuffle.partitions", before)
        before = conf.get("spark.sql.shuffle.partitions")
        if self.tasks > int(before):
            conf.set("ledgerline.partitions", f"{self.tasks},{before}")
            conf.set("spark.sql.shuffle.partitions", str(self.tasks))

    @cached_property
    def few_means(self) -> bool:
        """Can a row for each player, season and kind be sent to all tasks? Brands and years bound their number."""
        brands = self.table("part").select("p_brand").distinct().count()
        return brands * self.table("orders").select(F.year("o_orderdate")).distinct().count() * 3 <= MEANS_SENT

    @cached_property
    def few_officials(self) -> bool:
        """Can a row for each official be sent to all tasks?"""
        return self.table("supplier").count() <= OFFICIALS_SENT

    def by_game(self, df: DataFrame) -> DataFrame:
        """df dealt by game: what groups or joins it by game next shuffles it no more."""
        return df.repartition(self.tasks, "game_id")

    @cached_property
    def orders(self) -> DataFrame:
        """Orders with their game id."""
        return self.table("orders").withColumn("game_id", self._id("o_orderkey"))

    def _by_order(self, branded: bool) -> DataFrame:
        """Each order's lines as one array in written order, and their box score; with branded, each line has the
        brands of its part, too. All columns of line_order meet here, whatever is made of them, so a query that
        needs lines for several tables shuffles them once (twice, if there are too many parts to send)."""
        rows, parts = self.table("lineitem"), self.table("part")
        brands = parts.groupBy("p_partkey").agg(F.collect_list(F.struct("p_brand")).alias("brands"))
        few = branded and parts.count() <= PARTS_SENT
        if branded and not few:
            rows = rows.repartition(self.tasks, "l_partkey").join(brands, F.col("l_partkey") == F.col("p_partkey"), "left")
        rows = rows.repartition(self.tasks, "l_orderkey").join(self.table("supplier").select("s_suppkey", "s_name", "s_nationkey"),
            F.col("l_suppkey") == F.col("s_suppkey"))
        if few:
            rows = rows.join(F.broadcast(brands), F.col("l_partkey") == F.col("p_partkey"), "left")
        own = [F.coalesce("brands", F.array().cast(brands.schema["brands"].dataType)).alias("brands")] if branded else []
        line = F.struct(*self.line_order, "s_name", "s_nationkey", *own)
        return rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines"),
            F.floor(F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))).cast("double").alias("away_pts"))

    def _rounds(self, branded: bool) -> DataFrame:
        rows = self.orders.join(self._by_order(branded), F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
        return rows.withColumn("away", F.get("lines", F.lit(0))["s_nationkey"])

    @cached_property
    def rounds(self) -> DataFrame:
        """Orders with their lines' array (null without lines) and box score."""
        return self._rounds(branded=False)

    @cached_property
    def branded(self) -> DataFrame:
        """The same with the lines' brands."""
        return self._rounds(branded=True)

    @staticmethod
    def _firsts(lines: str, names: bool) -> Column:
        """Of an order's lines those that a game's crew can come from: the first ones, if their officials are different, for no
        other line's official can be among the first of the whole game; else all."""
        fields = ("l_suppkey", "s_name") if names else ("l_suppkey",)
        some = lambda xs: F.transform(xs, lambda x, i: F.struct((i + 1).alias("row_order"), *[x[f].alias(f) for f in fields]))
        first = F.slice(lines, 1, crews.CREW_SIZE)
        return F.when(F.size(F.array_distinct(first["l_suppkey"])) == F.size(first), some(first)).otherwise(some(F.col(lines)))

    @staticmethod
    def _scores(lines: str) -> Column:
        """An order's box score, a struct for each line and brand of its part: what players' rows are made of."""
        whole = lambda c: F.round(c * 100).cast("double")
        of = lambda x: lambda b: F.struct(b["p_brand"].alias("p_brand"), x["s_nationkey"].alias("s_nationkey"), x["l_quantity"].alias("pts"),
            whole(x["l_discount"]).alias("reb"), whole(x["l_tax"]).alias("ast"), (x["l_partkey"] % 11).cast("int").alias("fta"), x["l_linenumber"].alias("pf"))
        return F.flatten(F.transform(lines, lambda x: F.transform(x["brands"], of(x))))

    def _dealt(self, rounds: DataFrame, crew: bool = False, names: bool = False, scores: bool = False, officials: bool = False) -> DataFrame:
        """game_id and one, an array of one struct: what is asked for of an order's lines, dealt by game. An array, as
        columns and structs would be pruned for each use, and each use would shuffle its own."""
        rows = rounds.where("lines is not null and game_id is not null")
        own = [self._firsts("lines", names).alias("crew")] if crew else []
        if officials:
            own = [F.col("lines")["l_suppkey"].alias("l_suppkey"), F.col("lines")["s_name"].alias("s_name")]
        one = F.struct(*own, *([self._scores("lines").alias("scores")] if scores else []))
        return self.by_game(rows.select("game_id", F.array(one).alias("one")))

    @staticmethod
    def _each(dealt: DataFrame, field: str) -> DataFrame:
        """A row for each item of the given list."""
        items = F.get(F.transform("one", lambda o: o[field]), F.lit(0))
        return dealt.select("game_id", F.explode_outer(items).alias("x")).where("x is not null").select("game_id", "x.*")  # plain explode asks for the array's size before the shuffle

    @cached_property
    def games(self) -> DataFrame:
        return self._games(self.rounds)

    @cached_property
    def schedule(self) -> DataFrame:
        """Games without what their lines decide: no line is read."""
        return self._games(self.orders.withColumns({"away": F.lit(None).cast("int"), "away_pts": F.lit(None).cast("double")})).drop(
            "away_team_abbr", "away_pts", "home_win")

    def _games(self, rounds: DataFrame) -> DataFrame:
        rows = rounds.join(self.table("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        kind = F.when(F.col("o_orderpriority") == "1-URGENT", "Playoffs").when(F.col("o_orderpriority") == "2-HIGH", "Play-In").otherwise("Regular Season")
        rows = rows.withColumn("home_pts", F.floor("o_totalprice").cast("double"))
        out = rows.select(
            "game_id", F.date_format("o_orderdate", "yyyy-MM-dd").alias("game_date"), X.season_label(F.year("o_orderdate")).alias("season"),
            kind.alias("season_type"),
            self._team("c_nationkey").alias("home_team_abbr"), self._team("away").alias("away_team_abbr"), F.col("home_pts"), "away_pts",
            F.when(F.col("home_pts") > F.col("away_pts"), 1).when(F.col("home_pts") <= F.col("away_pts"), 0).alias("home_win"), "o_orderkey", "o_custkey",
        )
        out = out.withColumn("era", X.era("game_id")).withColumn("kind", X.kind("season_type"))
        own = (F.col("kind") == "PO") & (F.col("era") == "nba")
        return out.withColumn("po_round", F.when(own, (F.col("o_custkey") % 4 + 1).cast("int"))).withColumn("po_game_num",
            F.when(own, (F.col("o_orderkey") % 7 + 1).cast("int")))

    @staticmethod
    def _officials(lines: DataFrame) -> DataFrame:
        return lines.select("game_id", F.col("l_suppkey").cast("string").alias("official_id"), F.col("s_name").alias("official_name"), "row_order")

    @cached_property
    def officials(self) -> DataFrame:
        lines = F.transform("lines", lambda x, i: F.struct((i + 1).alias("row_order"), x["l_suppkey"].alias("l_suppkey"), x["s_name"].alias("s_name")))
        rows = self.rounds.where("lines is not null and game_id is not null").select("game_id", F.explode_outer(lines).alias("x"))
        return self._officials(rows.where("x is not null").select("game_id", "x.*"))

    @cached_property
    def crew(self) -> DataFrame:
        return self._crew(self._each(self._dealt(self.rounds, crew=True, names=True), "crew"))

    def _crew(self, lines: DataFrame) -> DataFrame:
        if "s_name" in lines.columns:
            own = crews.without_alternates(self._officials(lines)).withColumn("display", F.col("official_name"))
        else:
            own = crews.without_alternates(lines.select("game_id", F.col("l_suppkey").cast("string").alias("official_id"), "row_order"))
        return own.withColumn("era", X.era("game_id")).withColumn("ref_key", F.col("official_id"))

    @cached_property
    def logs(self) -> DataFrame:
        return self._logs(self._each(self._dealt(self.branded, scores=True), "scores"))

    @cached_property
    def loose_logs(self) -> DataFrame:
        """The same, not dealt by game."""
        rows = self.branded.where("lines is not null and game_id is not null").select("game_id", F.explode_outer(self._scores("lines")).alias("x"))
        return self._logs(rows.where("x is not null").select("game_id", "x.*"))

    def _logs(self, scores: DataFrame) -> DataFrame:
        return scores.select(
            "game_id", F.col("p_brand").alias("player_id"), F.col("p_brand").alias("player_name"), self._team("s_nationkey").alias("team_abbr"),
            (F.col("pts") * 4).alias("min"), "pts", "reb", "ast", F.col("fta").cast("double").alias("fta"), F.col("pf").cast("double").alias("pf"),
        )

    @cached_property
    def boxes(self) -> DataFrame:
        """One row for each game with officials: officials (row_order, official_id, official_name) and scores, both in no
        order among the orders of a game."""
        dealt = self._dealt(self.branded, officials=True, scores=True)
        people = F.transform("one", lambda o: F.transform(F.arrays_zip(o["l_suppkey"], o["s_name"]), lambda x, i: F.struct((i + 1).alias("row_order"),
            x["l_suppkey"].cast("string").alias("official_id"), x["s_name"].alias("official_name"))))
        scores = F.transform("one", lambda o: o["scores"])
        rows = dealt.groupBy("game_id").agg(F.flatten(F.collect_list("one")).alias("one"))
        return rows.select("game_id", F.flatten(people).alias("officials"), F.flatten(scores).alias("scores"))

    @cached_property
    def swings(self) -> DataFrame:
        return profiles.swings(self.crew, self.logs, self.schedule)

    @cached_property
    def histories(self) -> DataFrame:
        """Customers as players whose ids change from year to year, over all games, so that one
        name has several segments in either scheme."""
        rows = self.orders.join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        ident = F.concat_ws("-", F.col("o_custkey").cast("string"), (F.year("o_orderdate") % 4).cast("string"))
        return rows.select("game_id", ident.alias("player_id"), F.col("c_name").alias("player_name"), F.col("c_mktsegment").alias("team_abbr"))

    @cached_property
    def owner_logs(self) -> DataFrame:
        """Customers as players of both id schemes, over playoff games."""
        rows = self.orders.where("o_orderpriority = '1-URGENT'").join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        return rows.select("game_id", F.col("o_custkey").cast("string").alias("player_id"), F.col("c_name").alias("player_name"),
            F.col("c_mktsegment").alias("team_abbr"))


class LogsOnly(Analog):
    """The same for queries that need of all that is made of lines nothing but logs, which have no order: fewer columns travel."""

    line_order = ["l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_tax"]


class Joint(Analog):
    """The same for queries that need crews, without their names, and logs: both travel by game as one."""

    @cached_property
    def met(self) -> DataFrame:
        return self._dealt(self.branded, crew=True, scores=True)

    @cached_property
    def crew(self) -> DataFrame:
        return self._crew(self._each(self.met, "crew"))

    @cached_property
    def logs(self) -> DataFrame:
        return self._logs(self._each(self.met, "scores"))


class Laid(Analog):
    """The same tables for queries that read them many times: lines, games and crews are written once, in
    buckets by game, so that whatever joins them by game or groups them by it needs no shuffle."""

    @cached_property
    def rounds(self) -> DataFrame:
        line = F.transform("lines", lambda x: F.struct(*[x[f].alias(f) for f in LINE_FIELDS]))
        rows = self._rounds(branded=True).select("game_id", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice", "away", "away_pts", line.alias("lines"))
        return layout.bucketed(rows, "game_id", "rounds", self.tasks)

    def _exploded(self, items: Column) -> DataFrame:
        return self.rounds.where("game_id is not null").select("game_id", F.explode_outer(items).alias("x")).where("x is not null").select("game_id", "x.*")

    @cached_property
    def games(self) -> DataFrame:
        return layout.bucketed(super().games, "game_id", "games", self.tasks)

    @property
    def schedule(self) -> DataFrame:
        return self.games

    @cached_property
    def crew(self) -> DataFrame:
        return layout.bucketed(self._crew(self._exploded(self._firsts("lines", names=True))), "game_id", "crew", self.tasks, placed=True)

    @cached_property
    def logs(self) -> DataFrame:
        of = lambda x: lambda b: F.struct(b["p_brand"].alias("p_brand"), *[x[f].alias(f) for f in LINE_FIELDS[2:-1]])
        rows = self._exploded(F.flatten(F.transform("lines", lambda x: F.transform(x["brands"], of(x)))))
        whole = lambda c: F.round(F.col(c) * 100).cast("double")
        return self._logs(rows.select("game_id", "p_brand", "s_nationkey", F.col("l_quantity").alias("pts"), whole("l_discount").alias("reb"),
            whole("l_tax").alias("ast"), (F.col("l_partkey") % 11).alias("fta"), F.col("l_linenumber").alias("pf")))

    @cached_property
    def swings(self) -> DataFrame:
        rows = profiles.swings(self.crew, self.logs, self.schedule, send_means=self.few_means, tasks=self.tasks)
        return layout.bucketed(rows, "ref_key", "swings", self.tasks, placed=self.few_means)
