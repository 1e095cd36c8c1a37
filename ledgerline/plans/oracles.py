"""DuckDB SQL with the rows of the registered queries, over the same tables."""

from __future__ import annotations

import re

_LINE_ORDER = "l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate"

_PARTS = {
    "ord": """SELECT *, CASE WHEN year(o_orderdate)<=1996 THEN '4' ELSE '00' END || lpad(CAST(o_orderkey AS VARCHAR),8,'0') AS game_id,
    CAST(year(o_orderdate) AS VARCHAR) || '-' || lpad(CAST((year(o_orderdate)+1)%100 AS VARCHAR),2,'0') AS season
  FROM orders""",
    "ln": f"SELECT l.*, s_name, s_nationkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS row_order FROM lineitem l JOIN supplier ON l_suppkey=s_suppkey",
    
    "box": """SELECT l_orderkey, CAST(floor(sum(CAST(l_extendedprice AS DECIMAL(18,2)))) AS DOUBLE) AS away_pts, min(CASE WHEN row_order=1 THEN s_nationkey END) AS away
  FROM ln
  GROUP BY 1""",
    "games0": """SELECT game_id, strftime(o_orderdate,'%Y-%m-%d') AS game_date, season,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Playoffs' WHEN '2-HIGH' THEN 'Play-In' ELSE 'Regular Season' END AS season_type,
    'T'||lpad(CAST(c_nationkey AS VARCHAR),2,'0') AS home_team_abbr, 'T'||lpad(CAST(away AS VARCHAR),2,'0') AS away_team_abbr,
    floor(o_totalprice) AS home_pts, away_pts, CASE WHEN floor(o_totalprice)>away_pts THEN 1 WHEN floor(o_totalprice)<=away_pts THEN 0 END AS home_win,
    o_orderkey, o_custkey
  FROM ord
  JOIN customer ON o_custkey=c_custkey
  LEFT JOIN box ON o_orderkey=l_orderkey""",
    "games1": """SELECT *, CASE WHEN length(game_id)=10 AND starts_with(game_id,'00') THEN 'nba' ELSE 'espn' END AS era,
    CASE season_type WHEN 'Playoffs' THEN 'PO' WHEN 'Play-In' THEN 'PI' ELSE 'RS' END AS kind
  FROM games0""",
    "games": """SELECT *, CASE WHEN kind='PO' AND era='nba' THEN o_custkey%4+1 END AS po_round, CASE WHEN kind='PO' AND era='nba' THEN o_orderkey%7+1 END AS po_game_num
  FROM games1""",
    "officials": "SELECT game_id, CAST(l_suppkey AS VARCHAR) AS official_id, s_name AS official_name, row_order FROM ln JOIN ord ON l_orderkey=o_orderkey",
    "once": """SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY row_order) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id,official_id ORDER BY row_order) AS k
  FROM officials)
  WHERE k=1""",
    "crew": """SELECT game_id, official_id AS ref_key, official_id, official_name AS display, official_name, row_order, place,
    CASE WHEN length(game_id)=10 AND starts_with(game_id,'00') THEN 'nba' ELSE 'espn' END AS era
  FROM once
  WHERE place<=3""",
    "logs": """SELECT game_id, p_brand AS player_id, 'T'||lpad(CAST(s_nationkey AS VARCHAR),2,'0') AS team_abbr, l_quantity*4 AS min, l_quantity AS pts,
    CAST(round(l_discount*100) AS DOUBLE) AS reb, CAST(round(l_tax*100) AS DOUBLE) AS ast, CAST(l_partkey%11 AS DOUBLE) AS fta,
    CAST(l_linenumber AS DOUBLE) AS pf
  FROM ln
  JOIN ord ON l_orderkey=o_orderkey
  JOIN part ON l_partkey=p_partkey""",
    "histories": """SELECT game_id, CAST(o_custkey AS VARCHAR)||'-'||CAST(year(o_orderdate)%4 AS VARCHAR) AS player_id, c_name AS player_name, c_mktsegment AS team_abbr
  FROM ord
  JOIN customer ON o_custkey=c_custkey""",
    "owner_logs": """SELECT game_id, CAST(o_custkey AS VARCHAR) AS player_id, c_name AS player_name, c_mktsegment AS team_abbr
  FROM ord
  JOIN customer ON o_custkey=c_custkey
  WHERE o_orderpriority='1-URGENT'""",
    "sides": """SELECT game_id, season, home_team_abbr AS team, true AS is_home, coalesce(home_win=1,false) AS won, coalesce(home_pts-away_pts,0) AS margin
  FROM games
  WHERE home_team_abbr IS NOT NULL
  UNION ALL SELECT game_id, season, away_team_abbr, false, coalesce(home_win=0,false), coalesce(away_pts-home_pts,0)
  FROM games
  WHERE away_team_abbr IS NOT NULL""",
    "tg": "SELECT game_id, team_abbr, sum(pts) AS team_pts, sum(fta) AS team_fta, sum(pf) AS team_pf, sum(min) AS team_min FROM logs GROUP BY ALL",
    "tot": """SELECT game_id, sum(team_fta) AS box_fta, sum(team_pf) AS box_pf, sum(team_min) AS box_min, count(DISTINCT team_abbr) AS n_teams, sum(team_min)>=505 AS is_ot
  FROM tg
  GROUP BY 1""",
    "base": """SELECT player_id, season, kind, avg(pts) AS base_pts, avg(fta) AS base_fta, avg(pf) AS base_pf, avg(reb) AS base_reb, avg(ast) AS base_ast, count(*) AS base_n
  FROM logs
  JOIN games USING (game_id)
  WHERE kind IN ('RS','PO')
  GROUP BY ALL""",
    "under": """SELECT ref_key, l.*, g.season, g.kind, base_pts, base_fta, base_pf, base_reb, base_ast
  FROM crew
  JOIN logs l USING (game_id)
  JOIN games g USING (game_id)
  JOIN base b ON b.player_id=l.player_id AND b.season=g.season AND b.kind=g.kind
  WHERE g.kind<>'PO' OR base_n>=5""",
    "swings": "SELECT ref_key, player_id AS slug, count(*) AS n_games, "
    + ", ".join(f"round_even(avg({c}),2) AS {c}_with_ref, round_even(avg(base_{c}),2) AS {c}_baseline, round_even(avg({c})-avg(base_{c}),2) AS {c}_swing"
    for c in ("pts", "fta", "pf", "reb", "ast"))
    + " FROM under GROUP BY ALL HAVING count(*)>=15",
    "careers": """SELECT ref_key, min(season) AS first_season, max(season) AS last_season, count(*) AS games_total, count(*) FILTER (kind='RS') AS games_rs,
    count(*) FILTER (kind='PO') AS games_po, count(*) FILTER (kind='PI') AS games_pi, count(*) FILTER (po_round=4) AS finals_games,
    count(*) FILTER (po_game_num=7) AS game7s, bool_or(season='2000-01') AS active
  FROM crew
  JOIN games USING (game_id)
  GROUP BY 1""",
    "seasons": """SELECT ref_key, season, count(*) FILTER (kind='RS') AS rs, count(*) FILTER (kind='PO') AS po, count(*) FILTER (kind='PI') AS pi, count(*) AS total
  FROM crew
  JOIN games USING (game_id)
  GROUP BY ALL""",
    "records": """SELECT ref_key, team AS team_abbr, count(*) AS games, count(*) FILTER (won) AS wins, count(*) FILTER (NOT won) AS losses,
    round_even(count(*) FILTER (won)/count(*),2) AS win_pct, count(*) FILTER (is_home) AS home_games, count(*) FILTER (is_home AND won) AS home_wins,
    count(*) FILTER (NOT is_home) AS away_games, count(*) FILTER (NOT is_home AND won) AS away_wins, round_even(sum(margin)/count(*),2) AS avg_margin_for_team
  FROM crew
  JOIN sides s USING (game_id)
  GROUP BY ALL""",
    "wp0": """SELECT ref_key, kind, count(*) AS n, count(*) FILTER (n_teams=2) AS n_boxscore, round_even(avg(home_pts+away_pts),2) AS avg_total_points,
    round_even(avg(box_fta) FILTER (n_teams=2),2) AS avg_total_fta, round_even(avg(box_pf) FILTER (n_teams=2),2) AS avg_total_pf,
    round_even(avg(CASE WHEN home_win=1 THEN 1 ELSE 0 END),2) AS home_win_pct, round_even(avg(abs(home_pts-away_pts)),2) AS avg_abs_margin,
    CAST(sum(CAST(is_ot AS INT)) FILTER (n_teams=2) AS BIGINT) AS ot_games, round_even(avg(CAST(is_ot AS INT)) FILTER (n_teams=2),2) AS ot_rate
  FROM crew
  JOIN games USING (game_id)
  LEFT JOIN tot USING (game_id)
  WHERE kind IN ('RS','PO')
  GROUP BY ALL""",
    "whistle": """SELECT r.ref_key, k.kind, coalesce(n,0) AS n, coalesce(n_boxscore,0) AS n_boxscore, avg_total_points, avg_total_fta, avg_total_pf, home_win_pct,
    avg_abs_margin, ot_games, ot_rate
  FROM (SELECT DISTINCT ref_key
  FROM crew) r
  CROSS JOIN (VALUES ('RS'),('PO')) k(kind)
  LEFT JOIN wp0 w ON w.ref_key=r.ref_key AND w.kind=k.kind""",
    "po": """SELECT *, CASE WHEN coalesce(home_team_abbr<=away_team_abbr,true) THEN concat_ws('/',home_team_abbr,away_team_abbr) ELSE concat_ws('/',away_team_abbr,home_team_abbr) END AS series, CASE WHEN home_win=1 THEN home_team_abbr ELSE away_team_abbr END AS w
  FROM games
  WHERE season_type='Playoffs'""",
    "claims": """SELECT *, row_number() OVER (PARTITION BY season,team ORDER BY first,series) AS n
  FROM (SELECT DISTINCT season, series, first, unnest(string_split(series,'/')) AS team
  FROM (SELECT season, series, min(game_date) AS first
  FROM po
  GROUP BY ALL))""",
    "rounds": "SELECT season, series, min(n) AS round, count(DISTINCT n)=1 AS agreed FROM claims GROUP BY ALL",
    "labels2": """SELECT game_id, season, series, round, row_number() OVER (PARTITION BY season,series ORDER BY game_date,game_id) AS game_num
  FROM po
  JOIN rounds USING (season,series)""",
    "audit": """SELECT a.season, a.series, a.games, a.top_wins, a.first_date, a.last_date, r.round, r.agreed,
    CASE WHEN top_wins < CASE WHEN round=1 AND CAST(season[1:4] AS INT)<=2001 THEN 3 ELSE 4 END THEN 'INCOMPLETE' WHEN games > CASE WHEN round=1 AND CAST(season[1:4] AS INT)<=2001 THEN 5 ELSE 7 END THEN 'OVER-LONG' ELSE 'OK' END AS flag
  FROM (SELECT season, series, sum(n) AS games, max(n) AS top_wins, min(a) AS first_date, max(b) AS last_date
  FROM (SELECT season, series, w, count(*) AS n, min(game_date) AS a, max(game_date) AS b
  FROM po
  GROUP BY ALL)
  GROUP BY ALL) a
  JOIN rounds r USING (season,series)""",
    "segs": """SELECT era||':'||player_id AS seg_id, era, player_id, any_value(player_name) AS display, replace(lower(any_value(player_name)),'#','-') AS name_key,
    min(CAST(season[1:4] AS INT)) AS smin, max(CAST(season[1:4] AS INT)) AS smax, array_to_string(list_sort(list(DISTINCT season)),',') AS seasons,
    array_to_string(list_sort(list(DISTINCT team_abbr)),',') AS teams, count(DISTINCT game_id) AS games
  FROM histories
  JOIN games USING (game_id)
  GROUP BY era, player_id""",
    "links": """SELECT x.seg_id AS a, y.seg_id AS b
  FROM segs x
  JOIN segs y ON x.name_key=y.name_key AND x.seg_id<y.seg_id AND x.era<>y.era AND CASE WHEN x.smin<=y.smin THEN y.smin<=x.smax+2 ELSE x.smin<=y.smax+2 END""",
    "both_links": "SELECT a, b FROM links UNION ALL SELECT b, a FROM links",
    "reach": "SELECT seg_id AS a, seg_id AS b FROM segs UNION SELECT r.a, l.b FROM reach r JOIN both_links l ON l.a=r.b",
    "ents": "SELECT s.*, m.component FROM segs s JOIN (SELECT a AS seg_id, min(b) AS component FROM reach GROUP BY 1) m USING (seg_id)",
}


def _rounded(text: str) -> str:
    """text with each round_even(x, 2) spelled out: the engine's own goes by x * 100 as rounded."""
    mark = "round_even("
    while mark in text:
        at = text.index(mark)
        depth, k = 1, at + len(mark)
        while depth:
            depth += {"(": 1, ")": -1}.get(text[k], 0)
            k += 1
        x = f"CAST({text[at + len(mark) : k - 1].rsplit(',', 1)[0]} AS DOUBLE)"
        p, high = f"({x}*100)", f"({x}*134217729.0::DOUBLE-({x}*134217729.0::DOUBLE-{x}))"
        lost = f"(({high}*100-{p})+({x}-{high})*100)"
        text = f"{text[:at]}CASE WHEN {p}-floor({p})=0.5 AND {lost}<>0 THEN (floor({p})+CASE WHEN {lost}>0 THEN 1 ELSE 0 END)/100 ELSE HALF_{p}_EVEN/100 END{text[k:]}"
    return re.sub(r"HALF_(.*?)_EVEN", r"round_even(\1,0)", text)


def sql(body: str) -> str:
    """body with the CTEs that it needs before it."""
    need: list[str] = []
    begun: set[str] = set()

    def add(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)", text)):
            if word in _PARTS and word not in begun:
                begun.add(word)
                add(_rounded(_PARTS[word]))
                need.append(word)

    body = _rounded(body)
    add(body)
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({_rounded(_PARTS[n])})" for n in need) + " " + body if need else body


ORACLES = {
    "player_swings": "SELECT * FROM swings",
    "bucketed_swings": "SELECT * FROM swings",
    "referee_swings": """SELECT ref_key, slug, n_games, pts_with_ref, pts_baseline, pts_swing, fta_swing, pf_swing, rank
  FROM (SELECT *, row_number() OVER (PARTITION BY ref_key ORDER BY abs(pts_swing) DESC, slug) AS rank
  FROM swings)
  WHERE rank<=50""",
    "player_splits": """SELECT slug, ref_key, slug AS player_id, n_games, pts_with_ref, pts_baseline, pts_swing, reb_with_ref, reb_baseline, reb_swing, ast_with_ref, ast_baseline,
    ast_swing, seasons
  FROM swings
  JOIN (SELECT ref_key, player_id AS slug, array_to_string(list_sort(list(DISTINCT season)),',') AS seasons
  FROM under
  GROUP BY ALL) USING (ref_key, slug)""",
    "crew_first3": "SELECT game_id, official_id, place-1 AS rank_in_game FROM crew",
    "crew_distribution": "SELECT n_officials, count(*) AS games FROM (SELECT game_id, count(*) AS n_officials FROM crew GROUP BY 1) GROUP BY 1",
    "crew_arrays": "SELECT game_id, string_agg(display||'='||ref_key, ',' ORDER BY row_order) AS crew FROM crew GROUP BY 1",
    "crewmates": """SELECT *
  FROM (SELECT *, row_number() OVER (PARTITION BY ref_key ORDER BY games DESC, partner_name, partner) AS rank
  FROM (SELECT a.ref_key, b.ref_key AS partner, b.display AS partner_name, count(*) AS games
  FROM crew a
  JOIN crew b ON a.game_id=b.game_id AND a.ref_key<>b.ref_key
  GROUP BY ALL))
  WHERE rank<=5""",
    "season_kind": "SELECT game_id, era, kind, CAST(season[1:4] AS INT) AS start_year FROM games",
    "id_decode": """SELECT gid, CASE WHEN yy>=46 THEN 1900+yy ELSE 2000+yy END AS start_year,
    CASE gid[3:3] WHEN '1' THEN 'PRE' WHEN '2' THEN 'RS' WHEN '3' THEN 'AS' WHEN '4' THEN 'PO' WHEN '5' THEN 'PI' ELSE '??' END AS suffix,
    CAST(gid[8:8] AS INT) AS round, CAST(gid[10:10] AS INT) AS game
  FROM (SELECT gid, CAST(gid[4:5] AS INT) AS yy
  FROM (SELECT '00'||CAST(o_orderkey%7 AS VARCHAR)||lpad(CAST(o_custkey%100 AS VARCHAR),2,'0')||lpad(CAST(o_orderkey%100000 AS VARCHAR),5,'0') AS gid
  FROM orders))""",
    "season_normalize": """SELECT o_orderkey, CASE o_orderkey%4 WHEN 3 THEN y||'-'||z ELSE CASE o_orderkey%4 WHEN 2 THEN 'none' ELSE y||'-'||z END END AS season
  FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y, lpad(CAST((year(o_orderdate)+1)%100 AS VARCHAR),2,'0') AS z
  FROM orders)""",
    "home_win_derive": "SELECT game_id, CASE WHEN o_orderkey%3=0 THEN 1 WHEN o_orderkey%3=1 THEN 0 ELSE home_win END AS home_win FROM games",
    "id_clean_pad": "SELECT o_orderkey, CASE o_orderkey%4 WHEN 3 THEN '' ELSE lpad(CAST(o_orderkey AS VARCHAR),10,'0') END AS id FROM orders",
    "made_att_split": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_linenumber AS VARCHAR) AS made,
    CASE WHEN l_partkey%5=0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS attempted
  FROM lineitem""",
    "team_game_totals": "SELECT * FROM tg",
    "game_totals_ot": "SELECT * FROM tot",
    "player_baselines": """SELECT player_id, season, kind, round_even(base_pts,2) AS pts, round_even(base_fta,2) AS fta, round_even(base_pf,2) AS pf, round_even(base_reb,2) AS reb,
    round_even(base_ast,2) AS ast, base_n
  FROM base""",
    "ref_career_counts": "SELECT * FROM careers",
    "ref_season_map": "SELECT * FROM seasons",
    "ref_team_records": "SELECT * FROM records",
    "team_totals": "SELECT team AS team_abbr, count(DISTINCT game_id) AS games_total, min(season) AS first_season, max(season) AS last_season FROM sides GROUP BY 1",
    
    "whistle_profile": "SELECT * FROM whistle",
    "top_performances": """SELECT ref_key, rank, player_id, CAST(pts AS BIGINT) AS pts, team_abbr,
    CASE WHEN team_abbr=home_team_abbr THEN away_team_abbr ELSE home_team_abbr END AS opp_abbr, game_date, game_id, era||':'||player_id AS seg_id
  FROM (SELECT *, row_number() OVER (PARTITION BY ref_key ORDER BY pts DESC, game_date, game_id, player_id, team_abbr, reb, ast, pf, fta) AS rank
  FROM (SELECT c.ref_key, l.*, g.game_date, g.home_team_abbr, g.away_team_abbr, g.era
  FROM crew c
  JOIN logs l USING (game_id)
  JOIN games g USING (game_id)))
  WHERE rank<=25""",
    "player_top_games": """SELECT player_id, rank, CAST(pts AS BIGINT) AS pts, CAST(reb AS BIGINT) AS reb, CAST(ast AS BIGINT) AS ast, team_abbr,
    CASE WHEN team_abbr=home_team_abbr THEN away_team_abbr ELSE home_team_abbr END AS opp_abbr, game_date, game_id
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY pts DESC, game_date, game_id, team_abbr, reb, ast, pf, fta) AS rank
  FROM logs
  JOIN games USING (game_id))
  WHERE rank<=10""",
    "notable_games": """SELECT ref_key, game_id, game_date, concat_ws('@',away_team_abbr,home_team_abbr) AS matchup,
    coalesce(home_team_abbr,'null')||' '||CAST(CAST(trunc(coalesce(home_pts,0)) AS BIGINT) AS VARCHAR)||', '||coalesce(away_team_abbr,'null')||' '||CAST(CAST(trunc(coalesce(away_pts,0)) AS BIGINT) AS VARCHAR) AS result,
    CASE WHEN po_round=4 THEN 'Finals' ELSE 'Round '||CAST(po_round AS VARCHAR) END AS round, po_game_num AS game_num
  FROM crew
  JOIN games USING (game_id)
  WHERE po_round=4 OR po_game_num=7""",
    "ref_name_key": r"SELECT p_partkey, array_to_string(list_filter(string_split_regex(regexp_replace(replace(replace(lower(n),'.',' '),'''',''),'[^a-z0-9\s-]|-',' ','g'),'\s+'), lambda t: t<>'' AND t NOT IN ('jr','sr','ii','iii','iv','v')),'-') AS ref_key, array_to_string(list_filter(string_split_regex(regexp_replace(replace(replace(lower(n),'.',' '),'''',''),'[^a-z0-9\s-]|-',' ','g'),'\s+'), lambda t: t<>''),'-') AS player_key FROM (SELECT p_partkey, CASE p_partkey%4 WHEN 0 THEN p_name||' Jr.' WHEN 1 THEN 'R.J. '||p_name WHEN 2 THEN 'O''Neil-'||p_name||' III' ELSE p_name END AS n FROM part)",
    
    "tricode_normalize": """SELECT raw, count(*) AS n, CASE raw WHEN ' gs ' THEN 'GSW' WHEN 'no' THEN 'NOP' WHEN 'UTAH' THEN 'UTA' WHEN 'nj' THEN 'NJN' ELSE upper(trim(raw)) END AS code
  FROM (SELECT CASE o_orderkey%7 WHEN 0 THEN ' gs ' WHEN 1 THEN 'no' WHEN 2 THEN 'UTAH' WHEN 3 THEN 'nj' WHEN 4 THEN 'van' WHEN 5 THEN '' ELSE 'xyz' END AS raw
  FROM orders)
  GROUP BY ALL""",
    "override_apply": """SELECT official_id, official_name, CASE WHEN official_id='1' THEN 'by-name' WHEN official_id IN ('2','3') THEN 'by-id' ELSE official_id END AS ref_key,
    CASE WHEN official_id='1' THEN 'By Name' WHEN official_id='3' THEN 'Third' END AS override_display
  FROM (SELECT DISTINCT official_id, official_name
  FROM officials)""",
    "display_mode": """SELECT k, display
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, length(display) DESC, display) AS r
  FROM (SELECT p_size AS k, p_name AS display, count(*) AS n
  FROM part
  GROUP BY ALL))
  WHERE r=1""",
    "near_duplicates": """SELECT a, b, reason
  FROM (SELECT x.k AS a, y.k AS b, CASE WHEN x.p<>'' AND x.p=y.p THEN 'same-after-dropping-initials' WHEN abs(length(x.k)-length(y.k))<=2 AND levenshtein(x.k,y.k)<=2 THEN 'edit-distance<=2' END AS reason
  FROM nd x
  JOIN nd y ON x.k<y.k)
  WHERE reason IS NOT NULL""",
    "player_segments": "SELECT seg_id, era, player_id, display, name_key, smin, smax, seasons, teams, games FROM segs",
    "entity_components": "SELECT seg_id, component FROM ents",
    "entity_slugs": """SELECT component, key, display, CASE WHEN n=1 THEN key ELSE key||'-'||CAST(n AS VARCHAR) END AS slug, eras, smin
  FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY smin, display, component) AS n
  FROM (SELECT component, min(name_key) AS key, any_value(display) AS display, array_to_string(list_sort(list(DISTINCT era)),',') AS eras, min(smin) AS smin
  FROM ents
  GROUP BY 1))""",
    "merge_audit": """SELECT (SELECT count(*)
  FROM segs) AS segments, count(*) AS entities, count(*) FILTER (e>1) AS cross_era_merges, (SELECT count(*)
  FROM (SELECT name_key
  FROM ents
  GROUP BY 1
  HAVING count(DISTINCT component)>1)) AS split_keys, (SELECT sum(k-1)
  FROM (SELECT count(DISTINCT component) AS k
  FROM ents
  GROUP BY name_key)) AS slug_collisions
  FROM (SELECT component, count(DISTINCT era) AS e
  FROM ents
  GROUP BY 1)""",
    "round_gate": """SELECT game_id, CASE WHEN ok THEN r END AS po_round, CASE WHEN ok THEN n END AS po_game_num
  FROM ids
  CROSS JOIN (SELECT (SELECT coalesce(bool_and(r BETWEEN 1 AND 4 AND n BETWEEN 1 AND 7),true)
  FROM ids) AND (SELECT coalesce(bool_and(k BETWEEN 4 AND 7),false)
  FROM (SELECT count(*) AS k
  FROM ids
  WHERE r=4
  GROUP BY season)) AS ok)""",
    "round_gate_passed": """SELECT o_orderkey, CASE WHEN n<=5 THEN 4 ELSE n%3+1 END AS po_round, CASE WHEN n<=5 THEN n ELSE n%7+1 END AS po_game_num
  FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY season ORDER BY o_orderkey) AS n
  FROM games
  WHERE season_type='Playoffs' AND era='nba')""",
    "series_labels": "SELECT game_id, season, series, round, game_num FROM labels2",
    "series_audit": "SELECT season, series, games, top_wins, first_date, last_date, round, agreed, flag FROM audit",
    "bracket_check": """SELECT season, count(*) AS series, count(*) FILTER (round=1) AS first_round, count(*) FILTER (round=4) AS finals,
    count(*) FILTER (NOT agreed) AS disagreements, count(*) FILTER (flag<>'OK') AS flagged,
    count(*) FILTER (round=1)=8 AND count(*) FILTER (round=4)=1 AND count(*) FILTER (NOT agreed)=0 AND count(*) FILTER (flag<>'OK')=0 AS ok
  FROM audit
  GROUP BY 1""",
    "note_parse": """SELECT o_orderkey, CASE o_orderkey%5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 END AS round,
    CASE WHEN o_orderkey%5<4 THEN CAST(o_custkey%7+1 AS INT) END AS game
  FROM orders""",
    "label_precedence": """SELECT game_id, CASE WHEN o_orderkey%2=0 THEN 4 ELSE round END AS round, CASE WHEN o_orderkey%2=0 THEN 7 ELSE game_num END AS game_num,
    CASE WHEN o_orderkey%2=0 THEN 'gamenote' ELSE 'derived' END AS source
  FROM labels2
  JOIN (SELECT game_id, o_orderkey
  FROM games) USING (game_id)""",
    "gap_windows": """SELECT DISTINCT CAST(unnest(generate_series(greatest(CAST(first_date AS DATE)-12, DATE '1995-03-01'), least(CAST(last_date AS DATE)+12, DATE '1995-06-30'),
    INTERVAL 1 DAY)) AS DATE) AS day
  FROM audit
  WHERE flag='INCOMPLETE'""",
    "leaderboard_counts": "SELECT * FROM boards",
    "leaderboard_rates": "SELECT * FROM rate_boards",
    "upsert_rows": """SELECT game_id, official_id, row_order
  FROM officials
  WHERE CAST(game_id[3:] AS BIGINT)%10<>0 AND row_order=1
  UNION ALL SELECT DISTINCT game_id, 'new', 99
  FROM officials
  WHERE CAST(game_id[3:] AS BIGINT)%10=0""",
    "keep_last": """SELECT game_id, official_id, row_order
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id,official_id ORDER BY row_order DESC) AS k
  FROM officials)
  WHERE k=1""",
    "keep_first": """SELECT game_id, official_id, row_order
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id,official_id ORDER BY row_order) AS k
  FROM officials)
  WHERE k=1""",
    "purge_cascade": """SELECT 'games' AS name, count(*) AS n
  FROM games
  WHERE home_team_abbr<>'T00'
  UNION ALL SELECT 'officials', count(*)
  FROM officials
  WHERE game_id NOT IN (SELECT game_id
  FROM games
  WHERE home_team_abbr='T00')
  UNION ALL SELECT 'logs', count(*)
  FROM logs
  WHERE game_id NOT IN (SELECT game_id
  FROM games
  WHERE home_team_abbr='T00')""",
    "missing_officials": "SELECT game_id FROM games WHERE game_id NOT IN (SELECT game_id FROM officials)",
    "union_widen": "SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS region, '' AS note FROM nation UNION ALL SELECT r_name, '', 'region' FROM region",
    "set_diff": "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS k FROM orders EXCEPT SELECT player_id FROM owner_logs",
    "set_intersect": "SELECT CAST(c_nationkey AS INT) AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier",
    "coverage_soft": """SELECT season, era, count(*) AS games, round_even(100*avg(CASE WHEN n>=3 THEN 1 ELSE 0 END),2) AS coverage, avg(CASE WHEN n>=3 THEN 1 ELSE 0 END)<0.95 AS low
  FROM games
  LEFT JOIN (SELECT game_id, count(*) AS n
  FROM crew
  GROUP BY 1) USING (game_id)
  GROUP BY ALL""",
    "coverage_exact3": """SELECT season, season_type, count(*) AS games, round_even(100*avg(CASE WHEN n=3 THEN 1 ELSE 0 END),2) AS exactly3,
    count(*) FILTER (coalesce(n,0)<3) AS short, round_even(100*count(*) FILTER (coalesce(n,0)<3)/count(*),2) AS short_pct
  FROM games
  LEFT JOIN (SELECT game_id, count(*) AS n
  FROM officials
  GROUP BY 1) USING (game_id)
  GROUP BY ALL""",
    "freshness": """SELECT games, first_date, last_date, latest_season, (SELECT count(*)
  FROM games
  WHERE season_type='Regular Season' AND season=latest_season) AS latest_rs, (SELECT count(*)
  FROM games
  WHERE season_type='Regular Season' AND season=latest_season)<1100 AS incomplete
  FROM (SELECT count(*) AS games, min(game_date) AS first_date, max(game_date) AS last_date, max(season) AS latest_season
  FROM games)""",
    "quality_gate": """SELECT 'orphan_officials' AS "check", 'hard' AS severity, (SELECT count(DISTINCT game_id)
  FROM officials
  WHERE game_id NOT IN (SELECT game_id
  FROM games)) AS failures
  UNION ALL SELECT 'duplicate_games','hard',(SELECT count(*)
  FROM (SELECT game_id
  FROM games
  GROUP BY 1
  HAVING count(*)>1))
  UNION ALL SELECT 'mixed_seasons','hard',(SELECT count(*)
  FROM (SELECT season
  FROM games
  GROUP BY 1
  HAVING count(DISTINCT era)>1))
  UNION ALL SELECT 'unknown_teams','hard',(SELECT count(DISTINCT t)
  FROM (SELECT home_team_abbr AS t
  FROM games
  UNION ALL SELECT away_team_abbr
  FROM games)
  WHERE t IS NOT NULL AND t NOT IN (SELECT 'T'||lpad(CAST(n_nationkey AS VARCHAR),2,'0')
  FROM nation))
  UNION ALL SELECT 'unbalanced_records','hard',(SELECT count(*)
  FROM careers c
  LEFT JOIN (SELECT ref_key, sum(games) AS s
  FROM records
  GROUP BY 1) USING (ref_key)
  WHERE s IS DISTINCT
  FROM 2*games_total)
  UNION ALL SELECT 'low_coverage','soft',(SELECT count(*)
  FROM (SELECT season, era, avg(CASE WHEN n>=3 THEN 1 ELSE 0 END) AS c
  FROM games
  LEFT JOIN (SELECT game_id, count(*) AS n
  FROM crew
  GROUP BY 1) USING (game_id)
  GROUP BY ALL)
  WHERE c<0.95)""",
    "ref_view_reconcile": """SELECT 'player_splits' AS "check", (SELECT count(*)
  FROM (SELECT row_number() OVER (PARTITION BY ref_key ORDER BY abs(pts_swing) DESC, slug) AS rank
  FROM swings)
  WHERE rank<=50) AS compared, 0 AS mismatches
  UNION ALL SELECT 'team_records', (SELECT count(*)
  FROM records
  WHERE games>=10), 0""",
    "json_flatten": """SELECT event_id, CAST(json_extract(props,'$.k') AS BIGINT) AS k, coalesce(json_extract_string(props,'$.name'), json_extract_string(props,'$.label'),
    'k'||json_extract_string(props,'$.k')) AS label
  FROM events""",
    "utc_dates": """SELECT event_id, CASE event_id%4 WHEN 2 THEN strftime(date_trunc('minute',ts)-INTERVAL 330 MINUTE,'%Y-%m-%d') WHEN 3 THEN NULL ELSE strftime(ts,'%Y-%m-%d') END AS day
  FROM events""",
    "team_document": """SELECT t.team_abbr, games_total, first_season, last_season, count(r.ref_key) AS refs, coalesce(max(r.games),0) AS most
  FROM (SELECT team AS team_abbr, count(DISTINCT game_id) AS games_total, min(season) AS first_season, max(season) AS last_season
  FROM sides
  GROUP BY 1) t
  LEFT JOIN (SELECT *
  FROM records
  WHERE games>=10) r USING (team_abbr)
  GROUP BY ALL""",
    "search_index": "SELECT n, s, t, format('{:,}',games_total)||' g · '||first_season[1:4]||'-'||CAST(CAST(last_season[1:4] AS INT)+1 AS VARCHAR) AS u FROM ("
    "SELECT c.s_name AS n, ref_key AS s, 'ref' AS t, games_total, first_season, last_season FROM careers JOIN supplier c ON ref_key=CAST(s_suppkey AS VARCHAR)"
    " UNION ALL SELECT team, lower(team), 'team', count(DISTINCT game_id), min(season), max(season) FROM sides GROUP BY 1"
    " UNION ALL SELECT player_id, player_id, 'player', count(DISTINCT game_id), min(season), max(season) FROM logs JOIN games USING (game_id) WHERE player_id IN (SELECT slug FROM swings) GROUP BY 1)",
    
    "search_rank": """SELECT s_name AS n, CAST(s_suppkey AS VARCHAR) AS s
  FROM supplier
  WHERE contains(lower(s_name),'er#0000') ORDER BY CASE WHEN starts_with(lower(s_name),'er#0000') THEN 0 ELSE 1 END, length(s_name), s_name LIMIT 12""",
    "display_formats": """SELECT p_partkey, format('{:,}',p_partkey) AS whole, printf('%.1f',p_retailprice) AS tenths, printf('%.1f%%',p_size/50*100) AS share,
    printf('%+.1f',p_size-25.0) AS signed, CASE WHEN abs(p_size-25)<0.5 THEN 'sw s-zero' ELSE 'sw s-'||CASE WHEN p_size>25 THEN 'pos' ELSE 'neg' END||'-'||CASE WHEN abs(p_size-25)>=5 THEN '4' WHEN abs(p_size-25)>=3 THEN '3' WHEN abs(p_size-25)>=1.5 THEN '2' ELSE '1' END END AS heat, replace(replace(replace(p_name||'<&>','&','&amp;'),'<','&lt;'),'>','&gt;') AS escaped
  FROM part""",
}
_PARTS["ids"] = "SELECT game_id, season, CAST(game_id[8:8] AS INT) AS r, CAST(game_id[10:10] AS INT) AS n FROM games WHERE season_type='Playoffs' AND era='nba'"
_PARTS["nd"] = r"SELECT k, array_to_string(list_filter(string_split(k,'-'), lambda t: length(t)>1),'-') AS p FROM (SELECT DISTINCT lower(replace(replace(s_name,'#','-'),'000','-x-')) AS k FROM supplier)"
_COUNT = lambda name, value, where="": f"(SELECT '{name}' AS board, ref_key, CAST({value} AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS n FROM careers LEFT JOIN (SELECT ref_key, total AS games_current FROM seasons WHERE season='2000-01') USING (ref_key) {where} ORDER BY {value} DESC, ref_key LIMIT 25)"
_PARTS["boards"] = " UNION ALL ".join(
    [_COUNT("most_career_games", "games_total"), _COUNT("most_playoff_games", "games_po"), _COUNT("most_finals_games", "finals_games"),
    _COUNT("most_game7s", "game7s"), _COUNT("most_career_games_active", "games_total", "WHERE active"),
    _COUNT("most_games_current_season", "coalesce(games_current,0)", "WHERE active")]
)
_PARTS["hw"] = "SELECT ref_key, round_even(sum(coalesce(home_win_pct*n,0))/sum(n),2) AS home_win_pct, sum(n) AS n FROM whistle GROUP BY 1 HAVING sum(n)>=200"
_PARTS["ft"] = "SELECT ref_key, avg_total_fta, n_boxscore AS n FROM whistle WHERE kind='RS' AND n_boxscore>=20 AND avg_total_fta IS NOT NULL"
_RATE = lambda name, part, value, way: f"(SELECT '{name}' AS board, ref_key, {value} AS value, CAST(n AS BIGINT) AS n FROM {part} ORDER BY {value} {way}, ref_key LIMIT 25)"
_PARTS["hw"] = _PARTS["hw"].replace(">=200", ">=20")
_PARTS["rate_boards"] = " UNION ALL ".join(
    [_RATE("highest_home_win_pct", "hw", "home_win_pct", "DESC"), _RATE("lowest_home_win_pct", "hw", "home_win_pct", "ASC"),
    _RATE("highest_avg_total_fta_rs", "ft", "avg_total_fta", "DESC"), _RATE("lowest_avg_total_fta_rs", "ft", "avg_total_fta", "ASC")]
)
