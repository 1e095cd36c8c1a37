"""Readers. Ids are text throughout: no schema is inferred where an id is read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import columns as names
from ..functions import scalars as X
from . import sqlite


#: Headers of so many files are read at once.
PROBES = 16


def files_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files that paths, folders and globs name, in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: list[str] = []
    for one in [path] if isinstance(path, str) else path:
        p = jvm.org.apache.hadoop.fs.Path(one)
        fs = p.getFileSystem(conf)
        for found in fs.globStatus(p) or []:
            inside = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
            out += [f.getPath().toString() for f in inside if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def text_csv(spark: SparkSession, path: str | list[str], schema: str | None = None, comment: str | None = None, number: str | None = None) -> DataFrame:
    """CSV with a header, all text, plain or compressed; nulls are empty text. Columns come by
    their names in each file, whatever their order there (Spark alone goes by the first file's
    order): files are read in groups of one header. With a schema, columns that a file lacks are
    empty; without, those that any file has are there. number: a further column with the row's place
    among all rows of all files, 0, 1, 2 ..., files by name, rows as written."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", False)
    reader = reader.option("comment", comment) if comment else reader
    files = files_of(spark, path)
    if len(files) <= 1:
        frames = [reader.csv(path)]
    else:
        with ThreadPoolExecutor(PROBES) as pool:
            heads = list(pool.map(lambda f: tuple(reader.csv(f).columns), files))
        frames = [reader.csv([f for f, h in zip(files, heads, strict=True) if h == head]) for head in dict.fromkeys(heads)]
    place = [F.col(f"_metadata.{c}").alias(f"_{c}") for c in ("file_path", "file_block_start")] if number else []
    frames = [f.select(*[F.col(f"`{c}`").alias(c.lstrip("﻿")) for c in f.columns], *place) for f in frames]
    if number:
        frames = [f.withColumn("_at", F.monotonically_increasing_id()) for f in frames]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f, allowMissingColumns=True)
    if schema:
        wanted = [c.name for c in T._parse_datatype_string(schema)]
        df = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in wanted], *[c for c in ("_file_path", "_file_block_start", "_at") if number])
    return numbered(df, number).fillna("") if number else df.fillna("")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Rows with the file, block and id (_file_path, _file_block_start, _at) that they were read with: their
    place among all, as name. A task reads a block from its first row to its last, so a row's place
    in its block is the distance of its id from the block's least one; blocks begin where those before
    them end. The window sees one row for each block."""
    blocks = df.groupBy("_file_path", "_file_block_start").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_file_path", "_file_block_start").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("_file_path", "_file_block_start", "_first", F.coalesce(before, F.lit(0)).alias("_start"))
    found = df.join(starts, ["_file_path", "_file_block_start"]).withColumn(name, F.col("_start") + F.col("_at") - F.col("_first"))
    return found.drop("_file_path", "_file_block_start", "_at", "_first", "_start")


def games(spark: SparkSession, path: str, floor: int = S.SEASON_FLOOR) -> DataFrame:
    """Games from a season on, with their scheme, kind, one spelling of team codes, and numbers."""
    df = text_csv(spark, path, S.GAMES)
    df = df.where(X.season_start("season") >= floor).withColumn("era", X.era("game_id")).withColumn("kind", X.kind("season_type"))
    return df.withColumns({c: X.tricode(c) for c in ("home_team_abbr", "away_team_abbr")} | {c: X.number(c) for c in ("home_pts", "away_pts", "home_win")})


def officials(spark: SparkSession, path: str, valid: DataFrame | None = None) -> DataFrame:
    """Officials' rows with their written order over all files, of the valid games only if these are
    given."""
    df = text_csv(spark, path, S.OFFICIALS, number="row_order").withColumn("era", X.era("game_id"))
    return df if valid is None else df.join(valid.select("game_id"), "game_id", "left_semi")


def player_logs(spark: SparkSession, path: str | list[str], valid: DataFrame | None = None) -> DataFrame:
    """All seasons' box scores: what isn't a number counts as 0, rows without a player go."""
    df = text_csv(spark, path, S.PLAYER_LOGS)
    df = df if valid is None else df.join(valid.select("game_id"), "game_id", "left_semi")
    df = df.withColumn("player_id", X.number_id("player_id")).where(F.col("player_id").isNotNull())
    return df.withColumn("team_abbr", X.tricode("team_abbr")).withColumns({c: X.zero_filled(c) for c in S.ZERO_FILLED})


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """probe, to_key, to_display, line of a hand-kept file with # comments."""
    df = text_csv(spark, path, S.OVERRIDES, comment="#", number="line")
    rows = df.select(F.lower(F.trim("raw_name_or_id")).alias("probe"), F.trim("canonical_ref_key").alias("to_key"),
        F.trim("canonical_display_name").alias("to_display"), "line")
    return rows.where("probe <> ''")


def no_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "probe string, to_key string, to_display string, line long")


def widened(spark: SparkSession, paths: Iterable[str], must_have: Iterable[str]) -> tuple[DataFrame | None, list[str]]:
    """The union of CSV files whose headers have a column that fits; the paths that don't."""
    frames, skipped = [], []
    for p in sorted(paths):
        df = text_csv(spark, p)
        if names.find_column(df.columns, must_have) is None:
            skipped.append(p)
        else:
            frames.append(df)
    out = None
    for df in frames:
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return (out.fillna("") if out is not None else None), skipped


def renamed(df: DataFrame, wanted: Mapping[str, Iterable[str]], **how) -> DataFrame:
    """df's columns under the wanted names, found by pattern; '' for those that aren't there."""
    found = names.mapping(df.columns, wanted, **how)
    return df.select(*[F.col(f"`{c}`").alias(n) if c else F.lit("").alias(n) for n, c in found.items()])


def json_documents(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def raw_json(spark: SparkSession, path: str) -> DataFrame:
    """path and text of whole JSON files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))


def database_tables(spark: SparkSession, database: str | None = None, path: str | None = None) -> DataFrame:
    """table, columns and rows of the catalog or, with a path, of a SQLite file."""
    if path is not None:
        return sqlite.catalog(spark, path)
    rows = []
    for t in spark.catalog.listTables(database):
        name = f"{database}.{t.name}" if database and not t.isTemporary else t.name
        rows.append((t.name, [c.name for c in spark.catalog.listColumns(name)], spark.table(name).count()))
    return spark.createDataFrame(rows, "table string, columns array<string>, rows long")


def database_table(spark: SparkSession, table: str, columns: list[str] | None = None, path: str | None = None, partitions: int = 8) -> DataFrame:
    """A table of the catalog or, with a path, of a SQLite file, of which only the columns are read."""
    if path is not None:
        return sqlite.table(spark, path, table, columns, partitions)
    return spark.table(table).select(*columns) if columns else spark.table(table)


# Which tables hold games and officials.
GAME_SIGNALS = [["gameid"], ["gamedate", "date"], ["hometeamid", "teamidhome"], ["ptshome", "homepts", "homescore"], ["ptsaway", "awaypts", "awayscore"]]
OFFICIAL_SIGNALS = [["gameid"], ["officialid"], ["firstname", "officialname"], ["jersey"]]


def locate(tables: Mapping[str, Iterable[str]], signals: Iterable[Iterable[str]], least: int, rows: Mapping[str, int] | None = None) -> str | None:
    """The table that holds games, officials or box scores, by its columns."""
    return names.best_table(tables, signals, least, rows)


def extracted_games(df: DataFrame) -> DataFrame:
    """The target columns of games from a source's own: ids padded, seasons from the source or
    the id, winners from the flag or the points."""
    c = names.mapping(df.columns, {
        "id": ["gameid"], "date": ["gamedate", "date"], "season": ["season"], "type": ["seasontype"], "hid": ["hometeamid", "teamidhome"],
        "aid": ["awayteamid", "teamidaway"], "ha": ["teamabbreviationhome", "homeabbr"],
        "aa": ["teamabbreviationaway", "awayabbr"], "hp": ["ptshome", "homepts"], "ap": ["ptsaway", "awaypts"], "wl": ["wlhome"],
    })
    if c["season"] and "type" in names.plain(c["season"]):
        c["season"] = next((x for x in df.columns if names.plain(x) in ("season", "seasonid")), None)
    text = lambda k: F.trim(F.col(c[k]).cast("string")) if c[k] else F.lit("")
    gid = X.clean_id(c["id"], 10)
    out = df.select(
        gid.alias("game_id"), (X.iso_date(F.col(c["date"]).cast("string")) if c["date"] else F.lit("")).alias("game_date"),
        X.season_normal(text("season"), X.season_label(X.id_season(gid))).alias("season"),
        F.coalesce(F.nullif(text("type"), F.lit("")), X.id_season_type(gid)).alias("season_type"),
        X.clean_id(text("hid")).alias("home_team_id"), X.clean_id(text("aid")).alias("away_team_id"),
        text("ha").alias("home_team_abbr"), text("aa").alias("away_team_abbr"), X.number(text("hp")).alias("home_pts"),
        X.number(text("ap")).alias("away_pts"), (text("wl") if c["wl"] else F.lit(None).cast("string")).alias("wl"),
    )
    return out.withColumn("home_win", X.home_win("wl", F.col("home_pts"), F.col("away_pts"))).drop("wl").where("game_id <> ''").dropDuplicates(["game_id"])


# They decide which column of a source is taken. Earlier words win, whole names before parts.
BOX_COLUMNS = {
    "game_id": ["gameid", "gamekey", "gamesk", "gameidfk", "gid", "gmeid"],
    "player_id": ["playerid", "personid"],
    "player_name": ["playername", "player", "displayname", "name"],
    "team_id": ["teamid"],
    "team_abbr": ["teamabbreviation", "teamabbr", "tricode", "teamcode", "team"],
    "min": ["min", "minutes"],
    "pts": ["pts", "points"],
    "reb": ["reb", "totreb", "treb", "rebounds"],
    "ast": ["ast", "assists"],
    "stl": ["stl", "steals"],
    "blk": ["blk", "blocks"],
    "tov": ["tov", "to", "turnovers"],
    "fga": ["fga", "fieldgoalsattempted"],
    "fgm": ["fgm", "fieldgoalsmade"],
    "fg3a": ["fg3a", "fg3pa", "tpa", "threepa", "threepointersattempted", "3pa"],
    "fg3m": ["fg3m", "fg3pm", "tpm", "threepm", "threepointersmade", "3pm"],
    "fta": ["fta", "freethrowsattempted"],
    "ftm": ["ftm", "freethrowsmade"],
    "pf": ["pf", "personalfouls", "fouls"],
    "plus_minus": ["plusminus", "plusminuspoints"],
}
#: Words that count as whole names only.
BOX_WHOLE = ["team", "3pa", "3pm"]
#: A table of box scores names a game and a player, and has at least BOX_LEAST of these.
BOX_SIGNALS = ["pts", "reb", "ast", "fta", "fga", "min"]
BOX_LEAST = 4


def locate_box(tables: Mapping[str, Iterable[str]], rows: Mapping[str, int] | None = None) -> str | None:
    """The table that has box scores: a game and a player, and most of the numbers; the larger one of equals."""
    has = lambda columns, name: names.find_column(columns, BOX_COLUMNS[name], exact_only=BOX_WHOLE)
    fit = {t: list(c) for t, c in tables.items()}
    fit = {t: c for t, c in fit.items() if has(c, "game_id") and has(c, "player_id")}
    return locate(fit, [BOX_COLUMNS[n] for n in BOX_SIGNALS], BOX_LEAST, rows)


def locate_officials(tables: Mapping[str, Iterable[str]], rows: Mapping[str, int] | None = None) -> str | None:
    """The table that has officials of games: a game and an official, and a name or a number."""
    return locate(tables, OFFICIAL_SIGNALS, 3, rows)


def extracted_logs(df: DataFrame) -> DataFrame:
    """The target columns of a source's box scores: ids cleaned, game ids padded, texts trimmed,
    numbers or null; rows without a game go. What the source lacks is null."""
    found = names.mapping(df.columns, BOX_COLUMNS, exact_only=BOX_WHOLE)

    def value(name: str) -> Column:
        if not found[name]:
            return F.lit(None).cast("string" if name in ("game_id", "player_id", "player_name", "team_id", "team_abbr", "min") else "double")
        c = F.col(f"`{found[name]}`")
        if name.endswith("_id"):
            return X.clean_id(c, 10 if name == "game_id" else None)
        return F.trim(c.cast("string")) if name in ("player_name", "team_abbr", "min") else X.number(c)

    return df.select(*[value(n).alias(n) for n in BOX_COLUMNS]).where("game_id <> ''")


def with_team_codes(games: DataFrame, teams: DataFrame) -> DataFrame:
    """Codes for teams that have only ids. teams: team_id, team_abbr, of one row a team."""
    one = teams.select(X.clean_id("team_id").alias("_id"), F.trim("team_abbr").alias("_abbr")).dropDuplicates(["_id"])
    for side in ("home", "away"):
        games = games.join(one, F.col(f"{side}_team_id") == F.col("_id"), "left").withColumn(f"{side}_team_abbr",
            F.coalesce(F.nullif(F.col(f"{side}_team_abbr"), F.lit("")), "_abbr", F.lit(""))).drop("_id", "_abbr")
    return games


def official_rows(facts: DataFrame, people: DataFrame) -> DataFrame:
    """game_id, official_id, official_name, jersey_num from a bridge table and its people."""
    one = people.select(X.clean_id("official_id").alias("official_id"), X.full_name("first_name", "last_name").alias("official_name"),
        X.clean_id("jersey_num").alias("jersey_num")).dropDuplicates(["official_id"])
    rows = facts.select(X.clean_id("game_id", 10).alias("game_id"), X.clean_id("official_id").alias("official_id"))
    return rows.join(one, "official_id", "left").fillna("").select("game_id", "official_id", "official_name",
        "jersey_num").dropDuplicates(["game_id", "official_id"])


def season_days(spark: SparkSession, seasons: DataFrame, done: DataFrame | None = None, today: Column | None = None) -> DataFrame:
    """season, day: the days of the seasons (season, first, last) up to today that aren't done."""
    last = F.least(F.col("last").cast("date"), F.current_date() if today is None else today)
    days = seasons.where(F.col("first").cast("date") <= last).select("season", F.explode(F.sequence(F.col("first").cast("date"), last)).alias("day"))
    return days if done is None else days.join(done.select("day"), "day", "left_anti")


def season_labels(spark: SparkSession, first: int, today: Column | None = None) -> DataFrame:
    """season: all from a start year to the one that runs; a new one begins in October."""
    t = F.current_date() if today is None else today
    year = F.when(F.month(t) >= 10, F.year(t)).otherwise(F.year(t) - 1)
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), year)).alias("y")).select(X.season_label(F.col("y")).alias("season"))
