"""Pages of the documents, as HTML made by column expressions: no document leaves the executors
to be rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X

# The blocks of seasons whose labels are incomplete, and how they are told of.
GAPS = [
    (("2000-01", "2001-02", "2002-03"), "the 2000-01 to 2002-03 seasons"),
    (("2012-13",), "the 2012-13 season"),
    (("2023-24", "2024-25", "2025-26"), "the 2023-24 season onward"),
]


def gap_phrase(seasons: Column | str) -> Column:
    """The incomplete blocks that a career meets, in words; null for none."""
    met = F.array(*[F.when(F.arrays_overlap(X.col(seasons), F.array(*[F.lit(s) for s in block])), label) for block, label in GAPS])
    return X.in_words(F.filter(met, lambda x: x.isNotNull()))


def linked(rows: DataFrame, column: str, pages: DataFrame, prefix: str, shown: str | None = None) -> DataFrame:
    """rows with <column>_link: a link if there is a page of that slug, else the text alone."""
    known = pages.select(F.col("slug").alias("_slug"), F.lit(True).alias("_has")).distinct()
    text = X.html_escaped(shown or column)
    link = F.concat(F.lit(f'<a href="{prefix}/'), X.html_escaped(column), F.lit('/">'), text, F.lit("</a>"))
    return rows.join(known, F.col(column) == F.col("_slug"), "left").withColumn(f"{column}_link",
        F.when(F.col("_has"), link).otherwise(text)).drop("_slug", "_has")


def cell(text: Column, key: Column | None = None, css: Column | None = None) -> Column:
    key = F.lit("") if key is None else F.concat(F.lit(' data-v="'), F.coalesce(X.html_escaped(key), F.lit("")), F.lit('"'))
    css = F.lit("") if css is None else F.concat(F.lit(' class="'), css, F.lit('"'))
    return F.concat(F.lit("<td"), key, css, F.lit(">"), F.coalesce(text, F.lit(X.DASH)), F.lit("</td>"))


def table(rows: str, heads: list[str], cells) -> Column:
    """A table of an array column; cells(row, index) gives a row's cells."""
    head = "<table><thead><tr>" + "".join(f"<th>{h}</th>" for h in heads) + "</tr></thead><tbody>"
    body = F.array_join(F.transform(rows, lambda r, i: F.concat(F.lit("<tr>"), *cells(r, i), F.lit("</tr>"))), "")
    return F.when(F.size(rows) > 0, F.concat(F.lit(head), body, F.lit("</tbody></table>"))).otherwise("")


def page(title: Column, body: Column) -> Column:
    return F.concat(F.lit('<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>'), X.html_escaped(title),
        F.lit("</title></head><body><main>"), body, F.lit("</main></body></html>"))


def hero(name: Column, games: Column, first: Column, last: Column) -> Column:
    return F.concat(F.lit("<h1>"), X.html_escaped(name), F.lit("</h1><p>"), X.subtitle(games, first, last), F.lit("</p>"))


def record_table(rows: str, name: str) -> Column:
    return table(rows, ["", "G", "W", "L", "Win%", "Margin"], lambda r, i: [
        cell(X.html_escaped(r[name])), cell(X.thousands(r["games"]), r["games"]), cell(X.thousands(r["wins"]), r["wins"]),
        cell(X.thousands(r["losses"]), r["losses"]),
        cell(X.percent(r["win_pct"]), r["win_pct"]), cell(X.signed(r["avg_margin_for_team"]), r["avg_margin_for_team"], X.heat(r["avg_margin_for_team"])),
    ])


def split_table(rows: str, name: str) -> Column:
    return table(rows, ["#", "", "G", "With", "Usual", "Swing"], lambda r, i: [
        cell((i + 1).cast("string")), cell(X.html_escaped(r[name])), cell(X.thousands(r["n_games"]), r["n_games"]),
        cell(X.decimal(r["pts_with_ref"]), r["pts_with_ref"]),
        cell(X.decimal(r["pts_baseline"]), r["pts_baseline"]), cell(X.signed(r["pts_swing"]), r["pts_swing"], X.heat(r["pts_swing"])),
    ])


def team_pages(docs: DataFrame) -> DataFrame:
    """slug, html. docs: as documents.team_documents gives them."""
    body = F.concat(hero(F.col("name"), F.col("games_total"), F.col("first_season"), F.col("last_season")), record_table("ref_records", "ref_name"))
    return docs.select("slug", page(F.col("name"), body).alias("html"))


def person_pages(rows: DataFrame, lists: dict[str, Column], seasons: str | None = None) -> DataFrame:
    """slug, html. rows: slug, name, games_total, first_season, last_season and the arrays that
    the given tables are made of; with seasons, gaps in them are told."""
    parts = [F.concat(F.lit(f"<section><h2>{title}</h2>"), t, F.lit("</section>")) for title, t in lists.items()]
    gap = F.lit("") if seasons is None else F.coalesce(F.concat(F.lit("<p>Labels are incomplete in "), gap_phrase(seasons), F.lit(".</p>")), F.lit(""))
    body = F.concat(hero(F.col("name"), F.col("games_total"), F.col("first_season"), F.col("last_season")), gap, *parts)
    return rows.select("slug", page(F.col("name"), body).alias("html"))


def index_page(boards: DataFrame) -> DataFrame:
    """One row, html: each board as a ranked list. boards: board, ref_key, value; a board has
    25 rows at most, so the page is one row of bounded size."""
    items = F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("o"), "ref_key", "value")))
    per = boards.groupBy("board").agg(items.alias("rows"))
    shown = F.concat(F.lit("<section><h2>"), X.html_escaped("board"), F.lit("</h2>"),
        table("rows", ["#", "", ""], lambda r, i: [cell((i + 1).cast("string")), cell(X.html_escaped(r["ref_key"])),
        cell(X.decimal(r["value"], 2), r["value"])]), F.lit("</section>"))
    return per.groupBy().agg(page(F.lit("Officials"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("board", shown.alias("h")))), lambda x: x["h"]), "")).alias("html"))


def sources_page(coverage: DataFrame) -> DataFrame:
    """One row, html: the coverage of each season (season, era, games, coverage)."""
    rows = coverage.groupBy().agg(F.array_sort(F.collect_list(F.struct("season", "era", "games", "coverage"))).alias("rows"))
    body = table("rows", ["Season", "Scheme", "Games", "Coverage"], lambda r,
        i: [cell(r["season"]), cell(r["era"]), cell(X.thousands(r["games"]), r["games"]), cell(X.decimal(r["coverage"]), r["coverage"])])
    return rows.select(page(F.lit("Sources"), body).alias("html"))
