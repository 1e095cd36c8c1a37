"""DuckDB SQL with the rows of the queries in ``more``; tables by name come from ``oracles``."""

from __future__ import annotations

from .oracles import ORACLES as _FIRST

_PLACED = "row_number() OVER (PARTITION BY {by} ORDER BY {order})-1 AS place"


def _list(table: str, key: str, section: str, order: str, item: str) -> str:
    place = _PLACED.format(by=key, order=order)
    return f"SELECT {key}, '{section}' AS section, {place}, {item} AS item FROM {table}"


_REF_ROWS = " UNION ALL ".join(
    [
        "SELECT c.ref_key, 'summary' AS section, 0 AS place, concat_ws('|',s_name,games_total,finals_games,first_season,n_seasons,rs_n,po_n) AS item FROM careers c"
        " JOIN supplier ON c.ref_key=CAST(s_suppkey AS VARCHAR)"
        " JOIN (SELECT ref_key, count(DISTINCT season) AS n_seasons FROM seasons GROUP BY 1) n USING (ref_key)"
        " JOIN (SELECT ref_key, max(n) FILTER (kind='RS') AS rs_n, max(n_boxscore) FILTER (kind='PO') AS po_n FROM whistle GROUP BY 1) w USING (ref_key)",
        _list("records", "ref_key", "team_records", "games DESC, team_abbr", "concat_ws('|',team_abbr,games,wins,losses,win_pct,home_games,home_wins,avg_margin_for_team)"),
        _list(f"({_FIRST['top_performances']})", "ref_key", "top_performances", "rank", "concat_ws('|',player_id,pts,game_id)"),
        _list(f"({_FIRST['referee_swings']})", "ref_key", "player_swings", "rank",
        "concat_ws('|',slug,n_games,pts_with_ref,pts_baseline,pts_swing,fta_swing,pf_swing)"),
        _list(f"({_FIRST['notable_games']})", "ref_key", "notable_games", "game_date DESC, game_id", "concat_ws('|',game_id,round)"),
        _list(f"({_FIRST['crewmates']})", "ref_key", "top_partners", "rank", "concat_ws('|',partner,games)"),
    ]
)

_PLAYER_ROWS = " UNION ALL ".join(
    [
        "SELECT player_id AS slug, 'summary' AS section, 0 AS place, concat_ws('|',player_id,count(DISTINCT game_id),min(season),max(season),array_to_string(list_sort(list(DISTINCT team_abbr)),','),array_to_string(list_sort(list(DISTINCT era)),',')) AS item"
        " FROM logs JOIN games USING (game_id) WHERE player_id IN (SELECT slug FROM swings) GROUP BY 1",
        _list("swings JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR)", "slug", "ref_splits", "n_games DESC, ref_key",
        "concat_ws('|',ref_key,s_name,n_games," + ",".join(f"{c}_{x}" for c in ("pts", "reb", "ast") for x in ("with_ref", "baseline", "swing")) + ")"),
        "SELECT slug, 'top_games', rank-1, concat_ws('|',game_id,pts,crew) FROM (SELECT *, player_id AS slug FROM (" + _FIRST["player_top_games"] + ")) JOIN (SELECT game_id, string_agg(ref_key,',' ORDER BY row_order) AS crew FROM crew GROUP BY 1) USING (game_id) WHERE slug IN (SELECT slug FROM swings)",
        
    ]
)

_TEAM_ROWS = " UNION ALL ".join(
    [
        "SELECT team, 'summary' AS section, 0 AS place, concat_ws('|',team,lower(team),count(DISTINCT game_id),'false') AS item FROM sides GROUP BY 1",
        _list("(SELECT *, team_abbr AS team FROM records JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR) WHERE games>=10)", "team",
        "ref_records", "games DESC, ref_key", "concat_ws('|',ref_key,s_name,games,away_wins)"),
    ]
)

ORACLES = {
    "text_rules": """SELECT p_partkey, trim(regexp_replace(lower('--R.J. '||p_name||', Jr.!'),'[^a-z0-9]+','-','g'),'-') AS slug,
  array_to_string(list_filter(string_split('j-'||replace(p_name,' ','-')||'-b','-'), lambda t: length(t)>1),'-') AS plain, 'Jose '||p_name||' uric fi' AS folded,
  trim(concat_ws(' ', CASE p_partkey%3 WHEN 0 THEN ' Al ' WHEN 1 THEN '' END, CASE p_partkey%4 WHEN 0 THEN 'B' WHEN 1 THEN ' C ' WHEN 2 THEN 'D' ELSE '' END)) AS whole FROM part""",
    "number_rules": """SELECT o_orderkey, n AS number, coalesce(n,0) AS filled, CAST(CAST(trunc(n) AS BIGINT) AS VARCHAR) AS id
  FROM (SELECT o_orderkey, CAST(CASE o_orderkey%8 WHEN 0 THEN 12 WHEN 2 THEN 150 WHEN 3 THEN 7 WHEN 7 THEN -0.5 END AS DOUBLE) AS n FROM orders)""",
    "code_names": """SELECT o_orderkey, CASE o_orderkey%6 WHEN 0 THEN 'Boston Celtics' WHEN 1 THEN 'Vancouver Grizzlies' WHEN 2 THEN 'Golden State Warriors' WHEN 3 THEN 'XXX' ELSE '' END AS name, o_orderkey%6=0 AS known FROM orders""",
    
    "word_lists": "SELECT c_custkey, CASE c_custkey%5 WHEN 1 THEN c_name WHEN 2 THEN c_name||', and b' WHEN 3 THEN c_name||', b, and c' WHEN 4 THEN c_name||', b, c, and d' END AS words FROM customer",
    
    "date_rules": "SELECT o_orderkey, d AS day, coalesce(d,'') AS shown FROM (SELECT o_orderkey, CASE WHEN o_orderkey%3<2 THEN strftime(o_orderdate,'%Y-%m-%d') END AS d FROM orders)",
    
    "season_calendar": """SELECT season, strftime(day,'%Y-%m-%d') AS day FROM (
  SELECT '1996-97' AS season, unnest(generate_series(DATE '1996-10-01', DATE '1997-06-30', INTERVAL 1 DAY)) AS day UNION ALL SELECT '1997-98', unnest(generate_series(DATE '1997-10-01', DATE '1998-06-30', INTERVAL 1 DAY))
) WHERE strftime(day,'%Y-%m-%d') NOT IN (SELECT game_date FROM games WHERE home_team_abbr='T00')""",
    "formatted_gaps": """SELECT ref_key, CASE WHEN a AND b THEN 'the 2000-01 to 2002-03 seasons, and the 2012-13 season' WHEN a THEN 'the 2000-01 to 2002-03 seasons' WHEN b THEN 'the 2012-13 season' END AS phrase
  FROM (SELECT ref_key, bool_or(season IN ('2000-01','2001-02','2002-03')) AS a, CAST(ref_key AS INT)%2=0 AS b FROM seasons GROUP BY 1)""",
    "appended_first": "SELECT game_id, official_id, min(v) AS v FROM (SELECT game_id, official_id, CASE WHEN row_order=1 THEN 1 ELSE 100 END AS v FROM officials WHERE row_order<=2) GROUP BY ALL",
    
    "appended_last": "SELECT DISTINCT game_id, official_id, 100 AS v FROM officials WHERE row_order<=2",
    "stale_rows": "SELECT season, count(*) FILTER (s) AS stale, count(*) FILTER (NOT s) AS kept FROM (SELECT season, era='nba' AND season IN ('1996-97','1997-98') AS s FROM games) GROUP BY 1",
    
    "value_report": "SELECT p_type AS value, CASE WHEN (SELECT count(DISTINCT p_type) FROM part)>40 THEN count(*) END AS rows FROM part GROUP BY 1",
    "value_report_few": "SELECT DISTINCT o_orderpriority AS value, CAST(NULL AS BIGINT) AS rows FROM orders",
    "team_code_report": "SELECT * FROM (VALUES ('GS','GSW',true,true),('BOS','BOS',true,false),('zz','ZZ',false,false),('no','NOP',true,true)) v(value,code,known,changed)",
    
    "run_counters": """SELECT season, season_type, count(*) AS games, coalesce(sum(o),0) AS officials, coalesce(sum(p),0) AS player_rows FROM games
  LEFT JOIN (SELECT game_id, count(*) AS o FROM officials GROUP BY 1) USING (game_id) LEFT JOIN (SELECT game_id, count(*) AS p FROM logs GROUP BY 1) USING (game_id) GROUP BY ALL""",
    "seeded_sample": "SELECT ref_key, team_abbr, games FROM records ORDER BY md5('0|'||ref_key||'|'||team_abbr), ref_key, team_abbr LIMIT 20",
    "spot_check": "SELECT ref_key, s_name AS display, games_total, games_po, first_season FROM careers JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR) WHERE contains(lower(s_name),'#00000000') OR contains(lower(s_name),'supplier#000000010')",
    
    "nan_check": "SELECT 3*count(*) AS nans FROM lineitem WHERE l_partkey%5=0",
    "excluded_seasons": "SELECT game_id, season FROM games WHERE season NOT IN ('1996-97','1998-99')",
    "converted_logs": """SELECT o_orderkey, CAST(y AS VARCHAR)||'-'||lpad(CAST((y+1)%100 AS VARCHAR),2,'0') AS season, CASE o_orderkey%5 WHEN 1 THEN 'RS' WHEN 2 THEN 'PO' ELSE 'PI' END AS kind
  FROM (SELECT o_orderkey, year(o_orderdate) AS y FROM orders) WHERE o_orderkey%11<>0 AND o_orderkey%5 IN (1,2,3) AND y BETWEEN 1995 AND 1999 AND y<>1997""",
    "extracted_games": """SELECT '00'||lpad(CAST(o_orderkey AS VARCHAR),8,'0') AS game_id, game_date, season, season_type, h.n_name AS home_team_abbr, coalesce(a.n_name,'') AS away_team_abbr, home_pts,
  CASE o_orderkey%3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE home_win END AS home_win
  FROM games JOIN nation h ON h.n_nationkey=CAST(home_team_abbr[2:] AS INT) LEFT JOIN nation a ON a.n_nationkey=CAST(away_team_abbr[2:] AS INT)""",
    "extracted_logs": "SELECT regexp_extract(player_id,'[0-9]+') AS player_id, player_id AS player_name, count(*) AS rows, sum(pts) AS pts, sum(CASE WHEN reb>2 THEN reb END) AS reb, 0 AS asts FROM logs GROUP BY 1, 2",
    
    "bridge_officials": "SELECT DISTINCT lpad(game_id,10,'0') AS game_id, official_id, 'Al  '||official_name AS official_name, CAST(s_nationkey AS VARCHAR) AS jersey_num FROM officials JOIN supplier ON official_id=CAST(s_suppkey AS VARCHAR)",
    
    "feed_games": """SELECT game_id, game_date, CASE kind WHEN 'PO' THEN 'Playoffs' WHEN 'PI' THEN 'Play-In' ELSE 'Regular Season' END AS season_type, CASE o_orderkey%3 WHEN 0 THEN 'BOS' WHEN 1 THEN 'GSW' ELSE 'XXX' END AS home_team_abbr,
  CASE o_orderkey%4 WHEN 0 THEN 'NYK' WHEN 1 THEN 'VAN' WHEN 2 THEN 'LAL' ELSE 'SEA' END AS away_team_abbr, CAST(CAST(home_pts AS BIGINT) AS VARCHAR) AS home_pts, CASE WHEN home_pts>away_pts THEN '1' ELSE '0' END AS home_win,
  o_orderkey%3<>0 OR o_orderkey%2=1 AS completed, o_orderkey%3=2 AS exhibition FROM games WHERE away_pts IS NOT NULL AND NOT (kind='RS' AND o_orderkey%13=0)""",
    "feed_players": "SELECT player_id, team_abbr, count(*) AS rows, CAST(sum(min) AS BIGINT) AS min, CAST(sum(pts) AS BIGINT) AS pts, CAST(sum(reb) AS BIGINT) AS reb, CAST(sum(fta) AS BIGINT) AS fgm, CAST(sum(pf) AS BIGINT) AS fga, count(*) AS no_ast FROM logs WHERE CAST(pts AS BIGINT)%7<>0 GROUP BY ALL",
    
    "feed_officials": "SELECT game_id, row_order, CASE WHEN row_order%2=0 THEN 'espn-athlete:'||official_id ELSE 'espn:'||replace(lower(official_name),'#','-') END AS official_id, official_name, CAST(row_order AS VARCHAR) AS jersey_num FROM officials",
    
    "feed_presence": """SELECT game_id, officials, coalesce(athletes,0) AS athletes FROM (SELECT game_id, count(*) AS officials FROM officials GROUP BY 1)
  LEFT JOIN (SELECT game_id, count(*) AS athletes FROM logs WHERE CAST(pts AS BIGINT)%7<>0 GROUP BY 1) USING (game_id)""",
    "summary_officials": "SELECT lpad(game_id,10,'0') AS game_id, official_id, CASE WHEN e THEN 'Al '||official_name ELSE official_name END AS official_name, CASE WHEN e THEN CAST(row_order AS VARCHAR) ELSE '' END AS jersey_num, row_order-1 AS row_order FROM (SELECT *, CAST(game_id[-1:] AS INT)%2=0 AS e FROM officials)",
    
    "league_logs": "SELECT season, kind, player_id, count(*) AS rows, count(DISTINCT game_id) AS games, CAST(sum(pts) AS BIGINT) AS pts, count(*) AS no_stl FROM logs JOIN games USING (game_id) GROUP BY ALL",
    
    "wanted_logs": "SELECT season, kind FROM (SELECT DISTINCT season FROM games) CROSS JOIN (VALUES ('RS'),('PO')) k(kind) WHERE NOT (kind='PO' AND season<'1998-99' AND season IN (SELECT season FROM games WHERE kind='PO'))",
    
    "key_search": """SELECT event_id, 'root.a.theName' AS path, substr('"'||event_type||'"',1,5) AS snippet FROM events UNION ALL SELECT event_id, 'root.a.in.nameless', substr(CAST(user_id AS VARCHAR),1,5) FROM events""",
    
    "entity_swings": """SELECT ref_key, slug, upper(slug) AS name, player_id, n_games, pts_with_ref, pts_baseline, pts_swing FROM
  (SELECT ref_key, substr(player_id,1,7) AS slug, count(*) AS n_games, round_even(avg(pts),2) AS pts_with_ref, round_even(avg(base_pts),2) AS pts_baseline, round_even(avg(pts)-avg(base_pts),2) AS pts_swing FROM under GROUP BY ALL HAVING count(*)>=15)
  JOIN (SELECT ref_key, slug, player_id FROM (SELECT *, row_number() OVER (PARTITION BY ref_key, slug ORDER BY k DESC, player_id) AS r FROM (SELECT ref_key, substr(player_id,1,7) AS slug, player_id, count(*) AS k FROM under GROUP BY ALL)) WHERE r=1) USING (ref_key, slug)""",
    "series_changes": """SELECT season, series, coalesce(b,0) AS games_before, a AS games_after FROM (SELECT season, series, count(*) AS a FROM po GROUP BY ALL) LEFT JOIN (SELECT season, series, count(*) AS b FROM po WHERE o_orderkey%5<>0 GROUP BY ALL) USING (season, series)""",
    
    "label_agreement": "SELECT count(*) AS noted, count(*) FILTER (round=1 AND game_num=1) AS agree, count(*) FILTER (NOT (round=1 AND game_num=1)) AS differ FROM labels2 JOIN (SELECT game_id, o_orderkey FROM games) USING (game_id) WHERE o_orderkey%4=0",
    
    "probe_days": """SELECT strftime(day,'%Y-%m-%d') AS day, strftime(day+INTERVAL (p) DAY,'%Y-%m-%d') AS probe FROM (SELECT unnest(generate_series(DATE '1996-03-01', DATE '1996-04-29', INTERVAL 1 DAY)) AS day) CROSS JOIN (VALUES (0),(-1),(1)) v(p)
  WHERE p=0 OR strftime(day,'%Y-%m-%d') NOT IN (SELECT game_date FROM games WHERE home_team_abbr IN ('T00','T07'))""",
    "linked_partners": f"""SELECT ref_key, partner, CASE WHEN CAST(partner AS INT)%3<>0 THEN '<a href="../ref/'||partner||'/">'||partner_name||'</a>' ELSE partner_name END AS partner_link FROM ({_FIRST["crewmates"]})""",
    
    "directory_rows": "SELECT s_name AS n, CAST(s_suppkey AS VARCHAR) AS s FROM supplier WHERE contains(lower(s_name),'ier#00000000')",
    "players_without_splits": "SELECT DISTINCT player_id AS slug FROM logs WHERE player_id NOT IN (SELECT slug FROM swings) UNION ALL SELECT c_name FROM customer",
    
    "era_spans": "SELECT count(*) FILTER (n=2) AS both_eras, count(*) FILTER (n=1) AS one_era FROM (SELECT ref_key, count(DISTINCT era) AS n FROM crew GROUP BY 1)",
    
    "ref_document_rows": _REF_ROWS,
    "player_document_rows": _PLAYER_ROWS,
    "team_document_rows": _TEAM_ROWS,
    "leaderboard_document": """SELECT board AS section, row_number() OVER (PARTITION BY board ORDER BY value DESC, ref_key)-1 AS place, concat_ws('|',ref_key,s_name,CAST(value AS BIGINT)) AS item FROM boards JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR)
  UNION ALL SELECT board, row_number() OVER (PARTITION BY board ORDER BY CASE WHEN starts_with(board,'lowest') THEN value ELSE -value END, ref_key)-1, concat_ws('|',ref_key,s_name,CAST(round(value*100) AS BIGINT),CAST(n AS BIGINT)) FROM rate_boards JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR)
  UNION ALL SELECT '_meta', 0, '20|2000-01'""",
    
    "person_page_texts": """SELECT ref_key AS slug, s_name AS name, format('{:,}',games_total)||' g · '||first_season[1:4]||'-'||CAST(CAST(last_season[1:4] AS INT)+1 AS VARCHAR) AS line, 1+n AS lines, top AS first, printf('%.1f%%',w*100) AS share
  FROM careers JOIN supplier ON ref_key=CAST(s_suppkey AS VARCHAR) JOIN (SELECT ref_key, count(*) AS n, first(team_abbr ORDER BY games DESC, team_abbr) AS top, first(win_pct ORDER BY games DESC, team_abbr) AS w FROM records GROUP BY 1) USING (ref_key)""",
}
