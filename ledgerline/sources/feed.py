"""The REST feed: data sources of JSON payloads, in a batch or day by day, and what is parsed from them."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .. import schemas as S
from ..functions import scalars as X
from . import json_search


def fetched(url: str, retries: int = 4, wait: float = 2.0, timeout: float = 30.0) -> str:
    """The text at a url; after a failure the wait doubles."""
    for k in range(retries):
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                return r.read().decode("utf-8")
        except (urllib.error.URLError, TimeoutError):
            if k + 1 == retries:
                raise
            time.sleep(wait * 2**k)
    raise ValueError("retries must be positive")


@dataclass
class Lane(InputPartition):
    """Urls (with further values of their rows) that one task asks for, one after the other: the first
    after a wait, each at least pace seconds after the one before. Lanes begin one delay after the other
    and keep a pace of as many delays as there are lanes, so all of them together keep the delay,
    whatever the number of tasks that run at once."""

    urls: list[tuple]
    wait: float
    pace: float


def lanes(urls: list[tuple], delay: float, n: int) -> list[Lane]:
    if not delay:
        return [Lane([u], 0, 0) for u in urls]
    n = min(n, len(urls))
    return [Lane(urls[k::n], delay * (k + 1), delay * n) for k in range(n)]


def answers(lane: Lane, retries: int, wait: float) -> Iterator[tuple]:
    """The values of each url's row and what it answers, null where it fails. Another try waits for the
    lane's pace, too."""
    due = time.monotonic() + lane.wait
    for url, *more in lane.urls:
        time.sleep(max(0.0, due - time.monotonic()))
        due = time.monotonic() + lane.pace
        try:
            found = fetched(url, retries, max(wait, lane.pace))
        except (urllib.error.URLError, TimeoutError):
            found = None
            due = time.monotonic() + lane.pace
        yield (*more, url, found)


class FeedSource(DataSource):
    """spark.read.format("feed").option("urls", "<json array>"): url, json. A url that fails gives a
    null json, so that it can be asked for again. Option delay: seconds between any two requests, of
    whatever task; lanes: so many tasks share it (without delay, each url is a task)."""

    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return "url string, json string"

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self.options)


class FeedReader(DataSourceReader):
    def __init__(self, options):
        self.urls = json.loads(options.get("urls", "[]"))
        self.delay, self.lanes = float(options.get("delay", "0")), int(options.get("lanes", "4"))
        self.retries, self.wait = int(options.get("retries", "4")), float(options.get("wait", "2"))

    def partitions(self) -> list[InputPartition]:
        return lanes([(u,) for u in self.urls], self.delay, self.lanes)

    def read(self, partition: Lane) -> Iterator[tuple]:
        yield from answers(partition, self.retries, self.wait)


class DaysSource(DataSource):
    """spark.readStream.format("feed_days"): the answers to one request a day and type, as type, day, url
    and json. Options: url, with {type} and {day} in it (a day is yyyymmdd there); types, with commas;
    first and last day; today (the days before it are finished); delay, lanes, retries and wait as
    above. The offset is, for each type, the last day that was asked for, so a query that is started
    again goes on after it, and a type that is new begins at the first day."""

    @classmethod
    def name(cls) -> str:
        return "feed_days"

    def schema(self) -> str:
        return "type string, day string, url string, json string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return DaysReader(self.options)


class DaysReader(DataSourceStreamReader):
    def __init__(self, options):
        day = lambda name: date.fromisoformat(options[name]) if name in options else None
        self.url, self.types = options["url"], options["types"].split(",")
        self.first, self.last, self.today = day("first"), day("last"), day("today")
        self.delay, self.lanes = float(options.get("delay", "1")), int(options.get("lanes", "4"))
        self.retries, self.wait = int(options.get("retries", "4")), float(options.get("wait", "2"))

    def _before_first(self) -> date:
        return self.first - timedelta(days=1)

    def initialOffset(self) -> dict:
        return {t: self._before_first().isoformat() for t in self.types}

    def latestOffset(self) -> dict:
        finished = (self.today or datetime.now(UTC).date()) - timedelta(days=1)
        end = max(self._before_first(), min(finished, self.last or finished))
        return {t: end.isoformat() for t in self.types}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        urls = []
        for t, last in end.items():
            day = date.fromisoformat(start[t]) if t in start else self._before_first()
            while (day := day + timedelta(days=1)) <= date.fromisoformat(last):
                urls.append((self.url.format(type=t, day=day.strftime("%Y%m%d")), t, day.isoformat()))
        return lanes(sorted(urls, key=lambda u: (u[2], u[1])), self.delay, self.lanes)

    def read(self, partition: Lane) -> Iterator[tuple]:
        yield from answers(partition, self.retries, self.wait)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the offsets; there is nothing else to let go of."""


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FeedSource)
    spark.dataSource.register(DaysSource)


EVENT = """struct<id:string,date:string,name:string,shortName:string,season:struct<type:int,slug:string>,status:struct<type:struct<completed:boolean,state:string>>,
competitions:array<struct<date:string,notes:array<struct<headline:string>>,competitors:array<struct<homeAway:string,score:string,winner:boolean,team:struct<id:string,abbreviation:string>>>>>>"""


def is_completed(event: Column | str = "event") -> Column:
    kind = X.col(event)["status"]["type"]
    return F.coalesce(kind["completed"], F.lit(False)) | F.coalesce(kind["state"] == "post", F.lit(False))


def is_play_in(event: Column | str = "event") -> Column:
    """Season type 5, or the words for it in a name, slug or note."""
    e = X.col(event)
    notes = F.array_join(F.transform(F.coalesce(F.get(e["competitions"], F.lit(0))["notes"], F.array()), lambda n: n["headline"]), " ")
    text = F.lower(F.concat_ws(" ", e["name"], e["shortName"], e["season"]["slug"], notes))
    return F.coalesce(e["season"]["type"] == 5, F.lit(False)) | text.contains("play-in") | text.contains("play in tournament")


def events(scoreboards: DataFrame, *keep: str) -> DataFrame:
    """event: one row for each event of the scoreboards (json), and the columns keep."""
    return scoreboards.select(F.explode(F.from_json("json", f"events array<{EVENT}>")["events"]).alias("event"), *keep)


def game_rows(found: DataFrame, season: Column, *keep: str) -> DataFrame:
    """Games from events: regular season and playoffs, with both teams; dates are UTC days, whatever
    the session's time zone. keep: further columns of found."""
    e, c = F.col("event"), F.get(F.col("event")["competitions"], F.lit(0))
    side = lambda s: F.get(F.filter(c["competitors"], lambda x: x["homeAway"] == s), F.lit(0))
    whole = lambda x: X.clean_id(x)
    df = found.select(e.alias("event"), side("home").alias("h"), side("away").alias("a"), c.alias("c"), *keep)
    df = df.where(F.col("h").isNotNull() & F.col("a").isNotNull() & (F.coalesce(F.col("event")["id"], F.lit("")) != "")
        & F.col("event")["season"]["type"].isin(2, 3, 5))
    hp, ap = whole(F.col("h")["score"]), whole(F.col("a")["score"])
    label = F.when(is_play_in(), "Play-In").when(F.col("event")["season"]["type"] == 3, "Playoffs").otherwise("Regular Season")
    won = F.when(F.col("h")["winner"], "1").when(F.col("a")["winner"], "0").when((hp != "") & (ap != ""),
        F.when(hp.try_cast("int") > ap.try_cast("int"), "1").otherwise("0")).otherwise("")
    return df.select(
        F.trim(F.col("event")["id"]).alias("game_id"),
        F.coalesce(X.utc_date(F.coalesce(F.col("event")["date"], F.col("c")["date"])), F.lit("")).alias("game_date"),
        season.alias("season"), label.alias("season_type"),
        F.coalesce(F.col("h")["team"]["id"], F.lit("")).alias("home_team_id"),
        F.coalesce(F.col("a")["team"]["id"], F.lit("")).alias("away_team_id"),
        X.tricode(F.col("h")["team"]["abbreviation"]).alias("home_team_abbr"),
        X.tricode(F.col("a")["team"]["abbreviation"]).alias("away_team_abbr"), hp.alias("home_pts"), ap.alias("away_pts"),
        won.alias("home_win"), is_completed().alias("completed"), *keep,
    )


def exhibitions(games: DataFrame) -> DataFrame:
    """Games of a team that isn't in the league."""
    return games.where(~X.is_allowed_team("home_team_abbr") | ~X.is_allowed_team("away_team_abbr"))


BOX = "struct<boxscore:struct<players:array<struct<team:struct<id:string,abbreviation:string>,statistics:array<struct<names:array<string>,labels:array<string>,keys:array<string>,athletes:array<struct<didNotPlay:boolean,athlete:struct<id:string,displayName:string,shortName:string>,stats:array<string>>>>>>>>>"
#: Column of the box score -> the headings it goes by.
HEADINGS = {"min": ["min", "minutes"], "fg": ["fg"], "3pt": ["3pt", "3p", "3ptm-a"], "ft": ["ft"], "reb": ["reb"], "ast": ["ast"],
    "stl": ["stl"], "blk": ["blk"], "tov": ["to", "tov"], "pf": ["pf"], "plus_minus": ["+/-", "plusminus"], "pts": ["pts"]}


def player_rows(summaries: DataFrame) -> DataFrame:
    """Box scores from summaries (game_id, json): team, group and athlete are unnested; a
    number's place comes from the group's own headings."""
    teams = summaries.select("game_id", F.explode(F.from_json("json", BOX)["boxscore"]["players"]).alias("t"))
    groups = teams.select("game_id", "t.team", F.explode("t.statistics").alias("g"))
    first = lambda *xs: F.coalesce(*[F.when(F.size(x) > 0, x) for x in xs])
    people = groups.select("game_id", "team",
        F.transform(first(F.col("g.names"), F.col("g.labels"), F.col("g.keys")), lambda h: F.lower(F.trim(h))).alias("heads"),
        F.explode("g.athletes").alias("p"))
    people = people.where(~F.coalesce(F.col("p.didNotPlay"), F.lit(False)) & (F.size("p.stats") > 0))

    def value(name: str) -> Column:
        at = F.array_max(F.transform(F.array(*[F.lit(h) for h in HEADINGS[name]]), lambda h: F.array_position("heads", h)))
        return F.when(at > 0, F.get("p.stats", (at - 1).cast("int")))

    whole = lambda n: X.clean_id(F.coalesce(value(n), F.lit(""))).alias(n)
    shots = [f(value(n)).alias(c) for n, pair in (("fg", ("fgm", "fga")), ("3pt", ("fg3m", "fg3a")), ("ft", ("ftm", "fta"))) for f,
        c in zip((X.made, X.attempted), pair, strict=True)]
    return people.select(
        "game_id", F.coalesce("p.athlete.id", F.lit("")).alias("player_id"),
        F.trim(F.coalesce(F.nullif(F.col("p.athlete.displayName"), F.lit("")), F.col("p.athlete.shortName"),
        F.lit(""))).alias("player_name"),
        F.coalesce("team.id", F.lit("")).alias("team_id"), X.tricode("team.abbreviation").alias("team_abbr"),
        *[whole(n) for n in HEADINGS if n not in ("fg", "3pt", "ft")], *shots,
    ).fillna("")


def official_rows(summaries: DataFrame) -> DataFrame:
    """Officials from summaries (game_id, json), in written order (row_order, from 1): of several lists
    the first under gameInfo, else the first. The id is the person's, else made from the name."""
    lists = json_search.found_lists(summaries.select("game_id", "json"), "officials")
    first = F.struct((~F.lower("path").contains("gameinfo")).alias("other"), "at", "value")
    best = lists.groupBy("game_id").agg(F.min(first)["value"].alias("value"))
    # parsed within the list, so that what asks for a person's values later doesn't parse the person again
    own = lambda item: F.from_json(item, "displayName string, fullName string, name string, id string, personId string, jersey string, jerseyNum string")
    rows = best.select("game_id", F.posexplode_outer(F.transform(F.from_json("value", "array<string>"), own)).alias("place", "p"))
    rows = rows.select("game_id", (F.col("place") + 1).alias("n"), "p")
    full = lambda *cs: F.trim(F.coalesce(*[F.nullif(F.col(f"p.{c}"), F.lit("")) for c in cs], F.lit("")))
    rows = rows.select("game_id", F.col("n").alias("row_order"), full("displayName", "fullName", "name").alias("official_name"),
        full("id", "personId").alias("pid"), X.clean_id(full("jersey", "jerseyNum")).alias("jersey_num"))
    ident = F.when(F.col("pid") != "", F.concat(F.lit("espn-athlete:"), "pid")).when(F.col("official_name") != "",
        F.concat(F.lit("espn:"), X.feed_slug("official_name"))).otherwise("")
    return rows.where("pid <> '' or official_name <> ''").withColumn("official_id", ident).select("game_id", "official_id",
        "official_name", "jersey_num", "row_order")


#: A person in the other payload's list of officials, and a table of its answers.
PERSON = "struct<personId:string,PERSON_ID:string,official_id:string,name:string,firstName:string,familyName:string,lastName:string,jerseyNum:string,JERSEY_NUM:string>"
TABLES = "resultSets array<struct<name:string,headers:array<string>,rowSet:array<array<string>>>>"


def summary_official_rows(summaries: DataFrame) -> DataFrame:
    """Officials from the other payload (game_id, json): the people under boxScoreSummary.officials;
    where there are none, the first table of resultSets with an official's or person's id and a name.
    Columns as official_rows gives them, in written order."""
    under = [F.from_json("json", f"{top} struct<{key}:array<{PERSON}>>")[top][key] for top,
        key in (("boxScoreSummary", "officials"), ("BoxScoreSummary", "Officials"))]
    listed = F.coalesce(*[F.when(F.size(x) > 0, x) for x in under])
    some = lambda *xs: F.coalesce(*[F.nullif(F.trim(x), F.lit("")) for x in xs], F.lit(""))
    people = summaries.select("game_id", F.posexplode(listed).alias("row_order", "p"))
    p = F.col("p")
    told = people.select(
        "game_id", X.clean_id(some(p["personId"], p["PERSON_ID"], p["official_id"])).alias("official_id"),
        some(p["name"], X.full_name(F.coalesce(p["firstName"], F.lit("")), some(p["familyName"], p["lastName"]))).alias("official_name"),
        X.clean_id(some(p["jerseyNum"], p["JERSEY_NUM"])).alias("jersey_num"), "row_order",
    ).where("official_id <> ''")
    rest = summaries.join(told.select("game_id").distinct(), "game_id", "left_anti")
    return told.unionByName(_table_officials(rest)).withColumn("game_id", X.clean_id("game_id", 10))


def _table_officials(summaries: DataFrame) -> DataFrame:
    tables = summaries.select("game_id", F.posexplode(F.from_json("json", TABLES)["resultSets"]).alias("place", "t"))
    heads = F.transform("t.headers", lambda h: F.regexp_replace(F.lower(h), "[^a-z0-9]", ""))
    at = lambda test: F.array_position(F.transform("heads", lambda h: F.coalesce(test(h), F.lit(False))), True)
    tables = tables.withColumn("heads", heads).withColumns({
        "ident": at(lambda h: h.contains("officialid") | h.contains("personid")), "whole": at(lambda h: h.isin("name", "officialname")),
        "first": at(lambda h: h.contains("firstname")),
        "last": at(lambda h: h.contains("lastname") | h.contains("familyname")), "number": at(lambda h: h.contains("jersey")),
    })
    fitting = tables.where("ident > 0 and (whole > 0 or first > 0 and last > 0)")
    best = fitting.groupBy("game_id").agg(F.min_by(F.struct("t", "ident", "whole", "first", "last", "number"), "place").alias("b"))
    rows = best.select("game_id", "b", F.posexplode("b.t.rowSet").alias("row_order", "r"))
    cell = lambda c: F.trim(F.coalesce(F.when(F.col(f"b.{c}") > 0, F.get("r", (F.col(f"b.{c}") - 1).cast("int"))), F.lit("")))
    name = F.when(F.col("b.whole") > 0, cell("whole")).otherwise(F.trim(F.concat_ws(" ", cell("first"), cell("last"))))
    return rows.select("game_id", X.clean_id(cell("ident")).alias("official_id"), name.alias("official_name"),
        X.clean_id(cell("number")).alias("jersey_num"), "row_order")


def league_log_rows(payloads: DataFrame) -> DataFrame:
    """Box scores from league game logs (season, kind, json): the first table of each, its columns by
    their headings; what a season's table lacks is empty text. season and kind are kept."""
    first = F.get(F.from_json("json", TABLES)["resultSets"], F.lit(0))
    rows = payloads.select("season", "kind", first["headers"].alias("heads"), F.explode(first["rowSet"]).alias("r"))
    wanted = [c.name for c in T._parse_datatype_string(S.PLAYER_LOGS)]

    def value(name: str) -> Column:
        heading = "TEAM_ABBREVIATION" if name == "team_abbr" else name.upper()
        at = F.array_position("heads", F.lit(heading))
        found = F.coalesce(F.when(at > 0, F.get("r", (at - 1).cast("int"))), F.lit(""))
        return X.clean_id(found, 10 if name == "game_id" else None) if name.endswith("_id") else found

    return rows.select("season", "kind", *[value(n).alias(n) for n in wanted])


def wanted_logs(seasons: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """season, kind: what league game logs are still to be asked for, regular seasons and playoffs,
    but for those of which something is stored."""
    every = seasons.select("season", F.explode(F.array(F.lit("RS"), F.lit("PO"))).alias("kind"))
    return every if stored is None else every.join(stored.select("season", "kind").distinct(), ["season", "kind"], "left_anti")


def notes(summaries: DataFrame) -> DataFrame:
    """game_id, note: the header's note, else the first competition's headline."""
    kind = "struct<header:struct<gameNote:string,competitions:array<struct<notes:array<struct<headline:string>>>>>>"
    h = F.from_json("json", kind)["header"]
    return summaries.select("game_id", F.coalesce(F.nullif(h["gameNote"], F.lit("")),
        F.get(F.get(h["competitions"], F.lit(0))["notes"], F.lit(0))["headline"]).alias("note"))


def presence(summaries: DataFrame) -> DataFrame:
    """game_id, officials, athletes: how many of each a summary holds."""
    people = player_rows(summaries).groupBy("game_id").agg(F.count("*").alias("athletes"))
    crew = official_rows(summaries).groupBy("game_id").agg(F.count("*").alias("officials"))
    return summaries.select("game_id").join(crew, "game_id", "left").join(people, "game_id", "left").fillna(0)
