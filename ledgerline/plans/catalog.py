"""The registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import boards, crew, documents, identity, merge, playoffs, profiles, quality
from ..sources import named_files, shared
from . import more, more_oracles, oracles, stored
from .analog import Analog, Joint, Laid, LogsOnly

CURRENT = "2000-01"
#: The rate boards' least games, at the scale of the test tables.
LEAST = 20


def _text(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, so that rows compare by value."""
    return df.withColumns({c: F.array_join(c, ",") for c in arrays})


def _swings(t: Analog) -> DataFrame:
    """For queries that show neither seasons nor names: numbers alone are summed, so means that are few meet the rows first."""
    return profiles.swings(t.crew, t.logs, t.schedule, send_means=t.few_means)


def _segments(t: Analog) -> DataFrame:
    return identity.segments(t.histories, t.games)


def _entities(t: Analog) -> DataFrame:
    return identity.entities(_segments(t))


def _careers(t: Analog) -> DataFrame:
    return profiles.careers(t.crew, t.schedule, CURRENT)


def _whistle(t: Analog) -> DataFrame:
    return profiles.whistle_profiles(t.crew, t.games, profiles.game_totals(t.logs))


def _player_games(t: Analog) -> DataFrame:
    return profiles.player_games(t.logs, t.games).withColumn("slug", F.col("player_id"))


def _names(t: Analog) -> DataFrame:
    return identity.display_names(t.crew, "ref_key", "official_name")


def id_decode(t: Analog) -> DataFrame:
    digits = lambda c, n, w: F.lpad((F.col(c) % n).cast("string"), w, "0")
    gid = F.concat(F.lit("00"), (F.col("o_orderkey") % 7).cast("string"), digits("o_custkey", 100, 2), digits("o_orderkey", 100000, 5))
    return t.table("orders").select(gid.alias("gid")).select("gid", X.id_season("gid").alias("start_year"),
        X.id_season_type("gid", 0).alias("suffix"), playoffs.id_round("gid").alias("round"), playoffs.id_game("gid").alias("game"))


def season_normalize(t: Analog) -> DataFrame:
    year, k = F.year("o_orderdate"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, year.cast("string")).when(k == 1, F.concat(F.lit("2"), year.cast("string"))).when(k == 2, F.lit(" none ")).otherwise(F.lit("  "))
    return t.table("orders").select("o_orderkey", X.season_normal(raw, X.season_label(year)).alias("season"))


def home_win_derive(t: Analog) -> DataFrame:
    flag = F.when(F.col("o_orderkey") % 3 == 0, " w").when(F.col("o_orderkey") % 3 == 1, "L").otherwise("-")
    return t.games.withColumn("wl", flag).select("game_id", X.home_win("wl", F.col("home_pts"), F.col("away_pts")).alias("home_win"))


def id_clean_pad(t: Analog) -> DataFrame:
    k, key = F.col("o_orderkey") % 4, F.col("o_orderkey").cast("string")
    raw = F.when(k == 0, key).when(k == 1, F.concat(key, F.lit(".0"))).when(k == 2, F.concat(F.lit(" "), key, F.lit(" "))).otherwise("nan")
    return t.table("orders").select("o_orderkey", X.clean_id(raw, 10).alias("id"))


def made_att_split(t: Analog) -> DataFrame:
    raw = F.when(F.col("l_partkey") % 5 == 0,
        F.col("l_linenumber").cast("string")).otherwise(F.concat_ws("-", F.col("l_linenumber").cast("string"),
        F.col("l_quantity").cast("int").cast("string")))
    return t.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", X.made(raw).alias("made"), X.attempted(raw).alias("attempted"))


def ref_name_key(t: Analog) -> DataFrame:
    k, n = F.col("p_partkey") % 4, F.col("p_name")
    raw = F.when(k == 0, F.concat(n, F.lit(" Jr."))).when(k == 1, F.concat(F.lit("R.J. "), n)).when(k == 2,
        F.concat(F.lit("O'Neil-"), n, F.lit(" III"))).otherwise(n)
    return t.table("part").select("p_partkey", X.name_key(raw, keep_suffixes=False).alias("ref_key"), X.name_key(raw, keep_suffixes=True).alias("player_key"))


def tricode_normalize(t: Analog) -> DataFrame:
    codes = [" gs ", "no", "UTAH", "nj", "van", "", "xyz"]
    raw = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return t.table("orders").select(raw.alias("raw")).groupBy("raw").agg(F.count("*").alias("n")).withColumn("code", X.tricode("raw"))


def override_apply(t: Analog) -> DataFrame:
    rows = t.officials.select("official_id", "official_name").distinct().withColumn("ref_key", F.col("official_id"))
    table = [("supplier#000000001", "by-name", "By Name", 1), ("1", "never", "", 2), ("2", "by-id", "", 3), ("3", "by-id", "Third", 4)]
    overrides = t.spark.createDataFrame(table, "probe string, to_key string, to_display string, line int")
    return identity.with_overrides(rows, overrides, "official_name", "official_id", "ref_key")


def near_duplicates(t: Analog) -> DataFrame:
    k = F.lower(F.replace(F.replace(F.col("s_name"), F.lit("#"), F.lit("-")), F.lit("000"), F.lit("-x-")))
    return identity.near_duplicates(t.table("supplier").select(k.alias("ref_key")))


def round_gate(t: Analog) -> DataFrame:
    return playoffs.label_from_ids(t.games.drop("po_round", "po_game_num")).where((F.col("season_type") == "Playoffs")
        & (F.col("era") == "nba")).select("game_id", "po_round", "po_game_num")


def round_gate_passed(t: Analog) -> DataFrame:
    """Ids as the gate wants them: in each season five games of the last round, the rest in others."""
    games = t.games.drop("po_round", "po_game_num").where((F.col("season_type") == "Playoffs") & (F.col("era") == "nba"))
    n = F.row_number().over(Window.partitionBy("season").orderBy("o_orderkey"))
    digits = F.when(F.col("n") <= 5, F.concat(F.lit("40"),
        F.col("n").cast("string"))).otherwise(F.concat((F.col("n") % 3 + 1).cast("string"), F.lit("0"),
        (F.col("n") % 7 + 1).cast("string")))
    own = games.withColumn("n", n).withColumn("game_id", F.concat(F.lit("0040000"), digits))
    return playoffs.label_from_ids(own).select("o_orderkey", "po_round", "po_game_num")


def note_parse(t: Analog) -> DataFrame:
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "East First Round").when(k == 1, "West Semifinals").when(k == 2, "East Conference Finals").when(k == 3,
        "The Finals").otherwise("Exhibition")
    note = F.when(k < 4, F.concat(text, F.lit(" - Game "), (F.col("o_custkey") % 7 + 1).cast("string"))).otherwise(text)
    return t.table("orders").select("o_orderkey", playoffs.note_round(note).alias("round"), playoffs.note_game(note).alias("game"))


def label_precedence(t: Analog) -> DataFrame:
    notes = t.games.where(F.col("o_orderkey") % 2 == 0).select("game_id", F.lit("Finals - Game 7").alias("note"))
    return playoffs.preferred_labels(playoffs.structural_labels(t.games), notes)


def leaderboard_counts(t: Analog) -> DataFrame:
    return boards.count_boards(_careers(t), profiles.seasons(t.crew, t.schedule), CURRENT)


def upsert_rows(t: Analog) -> DataFrame:
    stored = t.officials.where("row_order = 1").select("game_id", "official_id", "row_order")
    again = F.substring("game_id", 3, 10).cast("bigint") % 10 == 0
    incoming = t.officials.where(again).select("game_id", F.lit("new").alias("official_id"), F.lit(99).alias("row_order"))
    return merge.upsert(stored, incoming, "game_id", ["game_id", "official_id"], "row_order")


def purge_cascade(t: Analog) -> DataFrame:
    gone = t.games.where("home_team_abbr = 'T00'")
    left = merge.purged({"games": t.games, "officials": t.officials, "logs": t.logs}, gone)
    return boards.union([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in left.items()])


def union_widen(t: Analog) -> DataFrame:
    nations = t.table("nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").cast("string").alias("region"))
    return merge.stacked(nations, t.table("region").select(F.col("r_name").alias("name"), F.lit("region").alias("note")))


def quality_gate(t: Analog) -> DataFrame:
    teams = t.table("nation").select(t._team("n_nationkey").alias("team_abbr"))
    return quality.gate(t.officials, t.games, t.crew, _careers(t), profiles.team_records(t.crew, t.games), teams)


def ref_view_reconcile(t: Analog) -> DataFrame:
    """What officials' documents show, against what players' and teams' documents show: all three are
    published as files, and the files compared."""

    def published(df: DataFrame, slug: str, name: str) -> DataFrame:
        path = shared.new_path(t.spark, name)
        named_files.documents(df.select(F.col(slug).alias("slug"), "document"), path)
        return named_files.read(t.spark, path).select(F.col("name").alias("slug"), F.col("value").alias("document"))

    return quality.view_mismatches(published(ref_document(t), "ref_key", "referees"), published(player_document(t), "slug", "players"),
        published(_team_documents(t), "slug", "teams"))


def json_flatten(t: Analog) -> DataFrame:
    props = F.from_json("props", "k long, name string, label string")
    return t.table("events").select("event_id", props.alias("p")).select("event_id", "p.k",
        F.coalesce("p.name", "p.label", F.concat(F.lit("k"), F.col("p.k").cast("string"))).alias("label"))


def utc_dates(t: Analog) -> DataFrame:
    whole, short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    k = F.col("event_id") % 4
    iso = F.when(k == 0, F.concat(whole, F.lit("Z"))).when(k == 1, F.concat(short, F.lit("Z"))).when(k == 2,
        F.concat(short, F.lit("+05:30"))).otherwise("no time")
    return t.table("events").select("event_id", X.utc_date(iso).alias("day"))


def _team_documents(t: Analog) -> DataFrame:
    return documents.team_documents(profiles.team_totals(t.games), profiles.team_records(t.crew, t.games), _names(t))


def team_document(t: Analog) -> DataFrame:
    docs = _team_documents(t)
    return docs.select("team_abbr", "games_total", "first_season", "last_season", F.size("ref_records").cast("long").alias("refs"),
        F.coalesce(F.array_max(F.transform("ref_records", lambda r: r["games"])), F.lit(0)).cast("long").alias("most"))


def search_index(t: Analog) -> DataFrame:
    refs = _careers(t).join(_names(t), "ref_key").select(F.col("display").alias("name"), F.col("ref_key").alias("slug"), "games_total",
        "first_season", "last_season")
    players = documents.player_summaries(_player_games(t), profiles.player_splits(_swings(t)))
    return boards.search_index(refs, documents.team_summaries(profiles.team_totals(t.games)), players)


def search_rank(t: Analog) -> DataFrame:
    index = t.table("supplier").select(F.col("s_name").alias("n"), F.col("s_suppkey").cast("string").alias("s"), F.lit("ref").alias("t"))
    return boards.search(index, " ER#0000").select("n", "s")


def display_formats(t: Analog) -> DataFrame:
    size = F.col("p_size").cast("double")
    return t.table("part").select(
        "p_partkey", X.thousands("p_partkey").alias("whole"), X.decimal("p_retailprice").alias("tenths"),
        X.percent(size / 50).alias("share"), X.signed(size - 25).alias("signed"),
        X.heat(size - 25).alias("heat"), X.html_escaped(F.concat("p_name", F.lit("<&>"))).alias("escaped"),
    )


def ref_document(t: Analog) -> DataFrame:
    """One JSON document for each official."""
    return documents.referee_documents(
        _careers(t), _names(t), identity.aliases(t.crew), profiles.season_maps(t.crew, t.schedule), profiles.team_records(t.crew, t.games), _whistle(t),
        profiles.top_performances(t.crew, t.logs, t.games, send_bounds=t.few_officials), profiles.referee_swings(t.swings), playoffs.notable_games(t.crew, t.games),
        crew.partners(t.crew, _names(t)),
    )


def _players(t: Analog) -> tuple[DataFrame, ...]:
    return (_player_games(t), profiles.player_splits(t.swings), profiles.player_top_games(t.logs, t.games), crew.crew_arrays(t.crew), _names(t))


def player_parts(t: Analog) -> DataFrame:
    return documents.player_parts(*_players(t))


def player_document(t: Analog) -> DataFrame:
    return documents.player_documents(*_players(t))


_QUERIES: dict[str, Callable[[Analog], DataFrame]] = {
    "player_swings": lambda t: _swings(t).drop("name", "player_id", "seasons"),
    "bucketed_swings": lambda t: _swings(t).drop("name", "player_id", "seasons"),
    "referee_swings": lambda t: profiles.referee_swings(_swings(t)),
    "player_splits": lambda t: _text(profiles.player_splits(t.swings), "seasons"),
    "crew_first3": lambda t: t.crew.select("game_id", "official_id", "rank_in_game"),
    "crew_distribution": lambda t: crew.size_histogram(t.crew),
    "crew_arrays": lambda t: crew.crew_arrays(t.crew).select("game_id",
    F.array_join(F.transform("crew", lambda x: F.concat_ws("=", x["name"], x["slug"])), ",").alias("crew")),
    "crewmates": lambda t: crew.partners(t.crew, _names(t)),
    "season_kind": lambda t: t.games.select("game_id", "era", "kind", X.season_start("season").alias("start_year")),
    "id_decode": id_decode,
    "season_normalize": season_normalize,
    "home_win_derive": home_win_derive,
    "id_clean_pad": id_clean_pad,
    "made_att_split": made_att_split,
    "team_game_totals": lambda t: profiles.team_game_totals(t.logs),
    "game_totals_ot": lambda t: profiles.game_totals(t.logs),
    "player_baselines": lambda t: profiles.baselines(t.logs, t.schedule).select("player_id", "season", "kind",
    *[X.round2(F.col(f"base_{c}")).alias(c) for c in ("pts", "fta", "pf", "reb", "ast")], "base_n"),
    "ref_career_counts": _careers,
    "ref_season_map": lambda t: profiles.season_maps(t.crew, t.schedule).select("ref_key",
    F.explode("per_season").alias("season", "c")).select("ref_key", "season", "c.*"),
    "ref_team_records": lambda t: profiles.team_records(t.crew, t.games),
    "team_totals": lambda t: profiles.team_totals(t.games),
    "whistle_profile": _whistle,
    "top_performances": lambda t: profiles.top_performances(t.crew, t.logs, t.games, send_bounds=t.few_officials),
    "player_top_games": lambda t: profiles.player_top_games(t.logs, t.games),
    "notable_games": lambda t: playoffs.notable_games(t.crew, t.games),
    "ref_name_key": ref_name_key,
    "tricode_normalize": tricode_normalize,
    "override_apply": override_apply,
    "display_mode": lambda t: identity.display_names(t.table("part").select(F.col("p_size").alias("k"), "p_name"), "k", "p_name"),
    "near_duplicates": near_duplicates,
    "player_segments": lambda t: _text(_segments(t), "seasons", "teams"),
    "entity_components": lambda t: identity.entity_of(_segments(t)),
    "entity_slugs": lambda t: _text(_entities(t), "eras").select("component", "key", "display", "slug", "eras", "smin"),
    "merge_audit": lambda t: identity.merge_audit(_segments(t), _entities(t)),
    "round_gate": round_gate,
    "series_labels": lambda t: playoffs.structural_labels(t.games),
    "series_audit": lambda t: playoffs.series_audit(t.games),
    "bracket_check": lambda t: playoffs.bracket_check(playoffs.series_audit(t.games)),
    "round_gate_passed": round_gate_passed,
    "note_parse": note_parse,
    "label_precedence": label_precedence,
    "gap_windows": lambda t: playoffs.gap_days(playoffs.series_audit(t.games), "1995-03-01", "1995-06-30"),
    "leaderboard_counts": leaderboard_counts,
    "leaderboard_rates": lambda t: boards.rate_boards(_whistle(t), LEAST),
    "upsert_rows": upsert_rows,
    "keep_last": lambda t: merge.keep_last(t.officials, ["game_id", "official_id"], "row_order").select("game_id", "official_id", "row_order"),
    "keep_first": lambda t: merge.keep_first(t.officials, ["game_id", "official_id"], "row_order").select("game_id", "official_id", "row_order"),
    "purge_cascade": purge_cascade,
    "missing_officials": lambda t: merge.missing(t.games, t.officials).select("game_id"),
    "union_widen": union_widen,
    "set_diff": lambda t: t.table("orders").select(F.col("o_custkey").cast("string").alias("k")).subtract(t.owner_logs.select("player_id")),
    "set_intersect": lambda t: t.table("customer").select(F.col("c_nationkey").cast("int").alias("k")).intersect(t.table("supplier").select(F.col("s_nationkey").cast("int"))),
    
    "coverage_soft": lambda t: quality.coverage(t.games, t.crew),
    "coverage_exact3": lambda t: quality.exact_coverage(t.games, t.officials),
    "freshness": lambda t: quality.freshness(t.games),
    "quality_gate": quality_gate,
    "ref_view_reconcile": ref_view_reconcile,
    "json_flatten": json_flatten,
    "utc_dates": utc_dates,
    "team_document": team_document,
    "search_index": search_index,
    "search_rank": search_rank,
    "display_formats": display_formats,
    "ref_document": ref_document,
    "player_document": player_document,
}


#: Queries that read lines, games and crews several times, and so lay them out by game first.
_LAID = {"bucketed_swings", "ref_view_reconcile", "search_index", "ref_document", "player_document", "ref_document_rows", "player_document_rows"}
#: Queries over crews and box scores that show no official's name.
_JOINT = {"player_swings", "referee_swings", "player_splits", "entity_swings", "players_without_splits", "top_performances"}
#: Queries that read no lines but as box scores.
_LOGS = {"league_logs", "team_game_totals", "game_totals_ot", "player_baselines", "extracted_logs"}
#: Others whose groups grow with the lines.
_DEALT = {"player_swings", "referee_swings", "player_splits", "entity_swings", "players_without_splits", "top_performances", "league_logs", "team_document",
    "team_document_rows", "person_page_texts", "ref_team_records", "feed_officials", "feed_presence"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(f: Callable[[Analog], DataFrame], tables: type[Analog]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = tables(spark, sf_dir)
            if f in dealt:
                t.deal()
            return f(t)

        return run

    every = _QUERIES | more.QUERIES
    dealt = {every[name] for name in _LAID | _DEALT}
    kinds = {Laid: _LAID, Joint: _JOINT, LogsOnly: _LOGS}
    return {name: bound(f, next((k for k, names in kinds.items() if name in names), Analog)) for name, f in (_QUERIES | more.QUERIES | stored.QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracles.sql(body) for name, body in (oracles.ORACLES | more_oracles.ORACLES | stored.ORACLES).items()}
