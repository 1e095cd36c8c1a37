"""Registered queries that write a table or files and give back what is read from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import boards, documents, postings, profiles
from ..sources import named_files, shared, tables
from .analog import Analog


def season_upsert(t: Analog) -> DataFrame:
    """All games stored by season and type; then some of one season come in again as playoff games."""
    games, path = t.games.select("game_id", "season", "season_type", "home_pts"), shared.new_path(t.spark, "games")
    tables.upserted(t.spark, path, games, ["game_id"])
    again = games.where((F.substring("game_id", 3, 10).cast("bigint") % 10 == 0) & (F.col("season") == "1996-97"))
    tables.upserted(t.spark, path, again.withColumns({"season_type": F.lit("Playoffs"), "home_pts": F.col("home_pts") + 1}), ["game_id"])
    return tables.stored(t.spark, path)


def season_delete(t: Analog) -> DataFrame:
    """Rows of the older scheme gone from two seasons."""
    path = shared.new_path(t.spark, "games")
    tables.upserted(t.spark, path, t.games.select("game_id", "season", "season_type"), ["game_id"])
    tables.without_stale(t.spark, path, ["1997-98", "1995-96"])
    return tables.stored(t.spark, path)


def team_files(t: Analog) -> DataFrame:
    """A file for each team, as read again."""
    totals, path = profiles.team_totals(t.games), shared.new_path(t.spark, "teams")
    named_files.documents(totals.select(F.col("team_abbr").alias("slug"), documents.as_json(totals, *totals.columns).alias("document")), path)
    return named_files.read(t.spark, path)


#: Texts that are looked for: rare and common runs, one letter, none that is there.
SOUGHT = [" ER#0000", "9", "00077", "mer#", "#00000001", "nobody"]


def search_postings(t: Analog) -> DataFrame:
    """Officials and owners, found by posting lists: the first of each search."""
    name = lambda table, c, key, kind: t.table(table).select(F.col(c).alias("n"), F.col(key).cast("string").alias("s"), F.lit(kind).alias("t"))
    path = shared.new_path(t.spark, "postings")
    postings.written(name("supplier", "s_name", "s_suppkey", "ref").unionByName(name("customer", "c_name", "c_custkey", "owner")), path)
    return boards.union([postings.search(t.spark, path, q).select(F.lit(q).alias("q"), "n", "s", "t") for q in SOUGHT])


QUERIES: dict[str, Callable[[Analog], DataFrame]] = {"season_upsert": season_upsert, "season_delete": season_delete, "team_files": team_files, "search_postings": search_postings}

_FOUND = """SELECT '{raw}' AS q, n, s, t FROM (SELECT *, row_number() OVER (ORDER BY CASE WHEN starts_with(lower(n),'{q}') THEN 0 ELSE 1 END, length(n), n, s, t) AS k
  FROM (SELECT s_name AS n, CAST(s_suppkey AS VARCHAR) AS s, 'ref' AS t FROM supplier UNION ALL SELECT c_name, CAST(c_custkey AS VARCHAR), 'owner' FROM customer)
  WHERE contains(lower(n),'{q}')) WHERE k<=12"""

ORACLES = {
    "search_postings": " UNION ALL ".join(_FOUND.format(raw=q, q=q.strip().lower()) for q in SOUGHT),
    "season_upsert": """SELECT game_id, season, CASE WHEN again THEN 'Playoffs' ELSE season_type END AS season_type, CASE WHEN again THEN home_pts+1 ELSE home_pts END AS home_pts
  FROM (SELECT *, CAST(game_id[3:] AS BIGINT)%10=0 AND season='1996-97' AS again
  FROM games)""",
    "season_delete": """SELECT game_id, season, season_type
  FROM games
  WHERE NOT (length(game_id)=10 AND game_id LIKE '00%' AND season IN ('1997-98','1995-96'))""",
    "team_files": """SELECT team AS name, '{"team_abbr":"'||team||'","games_total":'||count(DISTINCT game_id)||',"first_season":"'||min(season)||'","last_season":"'||max(season)||'"}' AS value
  FROM sides
  GROUP BY team""",
}
