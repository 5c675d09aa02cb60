"""Oracle SQL (DuckDB dialect) for the query catalog.

Each statement re-derives its inputs relationally from the same parquet tables — no
JSON — and computes the expected result. It shares with the Spark side only the scenario's
constants and the list of declared quality tests. Rates use
exact integer half-up arithmetic emitted as DOUBLE; every integer is cast explicitly
(DuckDB SUM is HUGEINT). ``with_ctes`` prepends only the CTEs a statement uses.
"""

from __future__ import annotations

import re

from crease.plans.scenarios import BATCH_BYTES, BATCH_FILES
from crease.plans.world import PLANT_KEYS, REPORT_EVENT, REPORT_YEAR, SEEDED_NATIONS

# fixed value: what a surrogate key holds for NULL
SK_NULL = "'_dbt_utils_surrogate_key_null_'"


def sk(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), {SK_NULL})" for c in cols]
    return "md5(" + " || '-' || ".join(parts) + ")"


def half_up(num: str, den: str, factor: int = 1, scale: int = 2) -> str:
    m = 10 ** scale
    return (f"CASE WHEN ({den}) > 0 THEN CAST((({num}) * {2 * factor * m} + ({den})) // "
            f"(2 * ({den})) AS DOUBLE) / {m}.0 END")


def overs(balls: str) -> str:
    return f"CAST(({balls}) // 6 AS VARCHAR) || '.' || CAST(({balls}) % 6 AS VARCHAR)"


CTES: dict[str, str] = {}

CTES["fd_pos"] = """
SELECT *, count(*) OVER (PARTITION BY l_suppkey, l_linestatus
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount,
             l_tax, l_returnflag, l_shipdate) - 1 AS i
FROM lineitem"""

CTES["fd_raw"] = """
SELECT CAST(l_suppkey AS INTEGER) AS match_id,
       md5(CAST(CAST(l_suppkey AS INTEGER) AS VARCHAR)) AS hash_id,
       CAST(CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS INTEGER) AS innings_number,
       CAST(i // 6 AS INTEGER) AS over_number,
       CAST(i % 6 AS INTEGER) AS ball_in_over,
       'T' || CAST((l_suppkey + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END) % 10 AS VARCHAR) AS team,
       CAST(NULL AS BOOLEAN) AS super_over,
       'P' || CAST(l_partkey % 11 AS VARCHAR) AS batter,
       'P' || CAST((l_partkey + 1 + l_linenumber) % 11 AS VARCHAR) AS non_striker,
       'B' || CAST(l_orderkey % 7 AS VARCHAR) AS bowler,
       CAST(CASE WHEN l_partkey % 17 = 0 THEN 0 ELSE CAST(l_quantity AS INTEGER) % 7 END AS INTEGER) AS batter_runs,
       CASE WHEN l_partkey % 17 = 0 THEN 1 END AS wides_raw,
       CASE WHEN l_partkey % 29 = 0 THEN 1 END AS noballs_raw,
       CASE WHEN l_orderkey % 23 = 0 AND l_partkey % 17 <> 0 THEN 1 END AS byes_raw,
       CASE WHEN l_orderkey % 31 = 0 AND l_partkey % 17 <> 0 THEN 1 END AS legbyes_raw,
       CASE WHEN l_orderkey % 19 = 0 THEN 'P' || CAST(l_partkey % 11 AS VARCHAR) END AS player_out,
       CASE WHEN l_orderkey % 19 = 0 THEN
         ['bowled', 'caught', 'lbw', 'run out', 'stumped', 'retired hurt', 'hit wicket'][l_linenumber]
       END AS dismissal_mode
FROM fd_pos"""

CTES["fd"] = """
SELECT match_id, hash_id, innings_number, team, over_number, ball_in_over, super_over,
       CAST(batter_runs + coalesce(wides_raw, 0) + coalesce(noballs_raw, 0)
            + coalesce(byes_raw, 0) + coalesce(legbyes_raw, 0) AS INTEGER) AS runs,
       batter_runs,
       CAST(coalesce(wides_raw, 0) AS INTEGER) AS wides,
       CAST(coalesce(noballs_raw, 0) AS INTEGER) AS noballs,
       CAST(coalesce(byes_raw, 0) AS INTEGER) AS byes,
       CAST(coalesce(legbyes_raw, 0) AS INTEGER) AS legbyes,
       CAST(coalesce(wides_raw, 0) + coalesce(noballs_raw, 0) + coalesce(byes_raw, 0)
            + coalesce(legbyes_raw, 0) AS INTEGER) AS extras,
       batter, non_striker, bowler,
       (wides_raw IS NULL AND noballs_raw IS NULL) AS is_legal,
       player_out, dismissal_mode
FROM fd_raw"""

CTES["fm0"] = """
SELECT s_suppkey AS k, s_nationkey, n_name, r_name,
       'T' || CAST(s_suppkey % 10 AS VARCHAR) AS team_a,
       'T' || CAST((s_suppkey + 1) % 10 AS VARCHAR) AS team_b
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

CTES["fm"] = """
SELECT CAST(k AS INTEGER) AS match_id,
       md5(CAST(CAST(k AS INTEGER) AS VARCHAR)) AS hash_id,
       n_name AS venue, r_name AS city, team_a, team_b,
       ['T20', 'ODI', 'Test'][s_nationkey % 3 + 1] AS format,
       CASE WHEN k % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
       CAST(DATE '2024-01-01' + CAST(k * 37 % 730 AS INTEGER) AS DATE) AS start_date,
       r_name AS event_name,
       CAST(k % 60 + 1 AS INTEGER) AS event_match_number,
       CASE WHEN k % 60 = 59 THEN 'Final' END AS event_stage,
       CASE WHEN k % 13 <> 0 THEN CASE WHEN k % 2 = 0 THEN team_a ELSE team_b END END AS toss_winner,
       CASE WHEN k % 13 <> 0 THEN CASE WHEN k % 3 = 0 THEN 'field' ELSE 'bat' END END AS toss_decision,
       CASE WHEN k % 11 <> 0 THEN CASE WHEN k % 4 % 2 = 0 THEN team_a ELSE team_b END END AS winner,
       CASE WHEN k % 11 = 0 THEN CASE WHEN k % 2 = 0 THEN 'tie' ELSE 'no result' END END AS result,
       CAST(CASE WHEN k % 11 <> 0 AND k % 4 < 2 THEN k % 50 + 1 END AS INTEGER) AS margin_runs,
       CAST(CASE WHEN k % 11 <> 0 AND k % 4 >= 2 THEN k % 10 + 1 END AS INTEGER) AS margin_wickets,
       CAST(CASE WHEN k % 11 <> 0 AND k % 8 = 0 THEN 1 END AS INTEGER) AS margin_innings,
       CASE WHEN k % 11 <> 0 THEN 'P' || CAST(k % 11 AS VARCHAR) END AS player_of_match_0
FROM fm0"""

CTES["vc"] = """
SELECT n_name AS venue_name, r_name AS city
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 15"""

CTES["cc"] = """
SELECT r_name AS city, r_name || ' LAND' AS country FROM region WHERE r_regionkey < 3
UNION ALL
SELECT r_name AS city, 'UNKNOWN' AS country FROM region"""

CTES["iv"] = f"""
SELECT DISTINCT ON (venue_name) {sk('venue_name')} AS venue_id, venue_name, city, country
FROM (SELECT n_name AS venue_name, r_name AS city
      FROM nation JOIN region ON n_regionkey = r_regionkey) JOIN cc USING (city)
ORDER BY venue_name, (country = 'UNKNOWN'), country, city"""

CTES["im"] = """
SELECT fm.match_id, fm.hash_id, iv.venue_id, fm.start_date, fm.format, fm.gender,
       fm.event_name, fm.event_match_number, fm.event_stage, fm.toss_winner, fm.toss_decision,
       CASE WHEN fm.winner IS NOT NULL THEN 'winner' ELSE fm.result END AS outcome_type,
       fm.margin_runs, fm.margin_wickets, fm.margin_innings, fm.winner,
       '["' || fm.player_of_match_0 || '"]' AS player_of_match
FROM fm LEFT JOIN iv ON fm.venue = iv.venue_name"""

CTES["seq"] = """
SELECT match_id, innings_number,
       count(*) OVER (PARTITION BY match_id, innings_number ORDER BY over_number, ball_in_over) AS ball_in_innings,
       batter, non_striker, bowler
FROM fd"""

CTES["roles"] = """
SELECT match_id, innings_number, ball_in_innings,
       unnest([{'player': batter, 'priority': 1},
               {'player': non_striker, 'priority': 2}]) AS r
FROM seq"""

CTES["bo_first"] = """
SELECT match_id, innings_number, r.player AS player, r.priority AS priority,
       min(ball_in_innings) AS first_appearance
FROM roles
GROUP BY match_id, innings_number, r.player, r.priority"""

CTES["bo"] = """
SELECT match_id, innings_number, player AS player_name,
       count(*) OVER (PARTITION BY match_id, innings_number
                      ORDER BY earliest, priority) AS batting_position
FROM (SELECT *, min(first_appearance) OVER (PARTITION BY match_id, innings_number, player)
                AS earliest
      FROM bo_first) t
WHERE first_appearance = earliest"""

CTES["wo"] = """
SELECT match_id, innings_number, bowler,
       count(*) OVER (PARTITION BY match_id, innings_number ORDER BY first_appearance) AS bowling_position
FROM (SELECT match_id, innings_number, bowler, min(ball_in_innings) AS first_appearance
      FROM seq GROUP BY match_id, innings_number, bowler) t"""

CTES["dp"] = """
SELECT DISTINCT match_id, innings_number, player_out FROM fd WHERE player_out IS NOT NULL"""

CTES["batter_tally"] = """
SELECT match_id, innings_number, team, batter AS player_name,
       coalesce(bool_or(super_over), FALSE) AS is_super_over,
       CAST(sum(batter_runs) AS BIGINT) AS runs, count(*) FILTER (WHERE wides = 0) AS balls
FROM fd GROUP BY match_id, innings_number, team, batter"""

CTES["bs"] = """
SELECT match_id, innings_number, batting_position, is_super_over, team, player_name, runs, balls,
       (match_id, innings_number, player_name) IN (SELECT (match_id, innings_number, player_out)
                                                   FROM dp) AS is_dismissed
FROM batter_tally JOIN bo USING (match_id, innings_number, player_name)"""

CTES["bowler_tally"] = """
SELECT match_id, innings_number, bowler, coalesce(bool_or(super_over), FALSE) AS is_super_over,
       count(*) FILTER (WHERE is_legal) AS balls,
       CAST(sum(batter_runs + wides + noballs) AS BIGINT) AS runs,
       count(player_out) FILTER (WHERE dismissal_mode NOT IN ('run out', 'retired hurt')) AS wickets,
       count(*) FILTER (WHERE is_legal AND batter_runs = 0) AS dots,
       count(*) FILTER (WHERE wides > 0) AS wides,
       count(*) FILTER (WHERE noballs > 0) AS noballs
FROM fd GROUP BY match_id, innings_number, bowler"""

CTES["ws"] = f"""
SELECT match_id, innings_number, is_super_over, bowling_position, bowler, balls, runs, wickets,
       dots, {half_up('runs', 'balls', 6)} AS economy, wides, noballs
FROM bowler_tally JOIN wo USING (match_id, innings_number, bowler)"""

CTES["ii"] = """
SELECT match_id, innings_number,
       min(hash_id) AS hash_id, min(team) AS team, any_value(super_over) AS super_over,
       CAST(sum(runs) AS BIGINT) AS runs_scored,
       CAST(count(player_out) AS BIGINT) AS wickets_lost,
       CAST(count(*) FILTER (WHERE is_legal) AS BIGINT) AS legal_deliveries,
       CAST(sum(wides) AS BIGINT) AS wides, CAST(sum(noballs) AS BIGINT) AS noballs,
       CAST(sum(byes) AS BIGINT) AS byes, CAST(sum(legbyes) AS BIGINT) AS legbyes,
       CAST(sum(extras) AS BIGINT) AS extras
FROM fd GROUP BY match_id, innings_number"""

# one text per innings; the innings of a team stand together, teams by their first innings
CTES["innings_score"] = f"""
SELECT match_id, team, innings_number,
       min(innings_number) OVER (PARTITION BY match_id, team) AS team_from,
       innings_number > min(innings_number) OVER (PARTITION BY match_id, team) AS again,
       format('{{}}/{{}} ({{}})', runs_scored, wickets_lost, {overs('legal_deliveries')}) AS score
FROM ii"""

CTES["scorelines"] = """
SELECT match_id, substr(string_agg(CASE WHEN again THEN ' & ' || score
                                       ELSE ' vs ' || team || ' ' || score END, ''
                                  ORDER BY team_from, innings_number), 5) AS scoreline
FROM innings_score GROUP BY match_id"""

CTES["summary"] = """
SELECT match_id, start_date, scoreline,
       winner || ' won by ' || coalesce(margin_runs || ' runs', margin_wickets || ' wickets', '')
           AS result
FROM im LEFT JOIN scorelines USING (match_id)"""


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it references (transitively, in dependency order)."""
    names = list(CTES)
    pattern = {n: re.compile(rf"\b{n}\b") for n in names}
    needed: list[str] = []

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and pattern[n].search(text):
                visit(CTES[n])
                if n not in needed:
                    needed.append(n)

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{body.strip()}"


SQL: dict[str, str] = {}

SQL["stg_deliveries"] = "SELECT * FROM fd"
SQL["int_deliveries"] = "SELECT * FROM fd"
SQL["fct_deliveries_sequence"] = "SELECT * FROM seq"
SQL["fct_batting_order"] = "SELECT * FROM bo"
SQL["fct_bowling_order"] = "SELECT * FROM wo"
SQL["fct_dismissed_players"] = "SELECT * FROM dp"
SQL["fct_batting_scorecard"] = "SELECT * FROM bs"
SQL["fct_bowling_scorecard"] = "SELECT * FROM ws"
SQL["int_innings"] = "SELECT * FROM ii"
SQL["fct_match_summary"] = "SELECT * FROM summary"
SQL["int_venues"] = "SELECT * FROM iv"
SQL["int_matches"] = "SELECT * FROM im"

CTES["event_matches"] = f"""
SELECT match_id FROM fm
WHERE event_name = '{REPORT_EVENT}' AND year(start_date) = {REPORT_YEAR}"""

CTES["event_batters"] = """
SELECT player_name AS batter, count(*) AS innings, count(*) FILTER (WHERE is_dismissed) AS outs,
       CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(balls) AS BIGINT) AS balls
FROM bs SEMI JOIN event_matches USING (match_id) GROUP BY player_name"""

SQL["q_top_batters"] = f"""
SELECT batter, innings, innings - outs AS not_outs, runs, {half_up('runs', 'outs')} AS average,
       {half_up('runs', 'balls', 100)} AS strike_rate
FROM event_batters
QUALIFY row_number() OVER (ORDER BY runs DESC NULLS FIRST, batter ASC NULLS LAST) <= 10"""

CTES["event_bowlers"] = """
SELECT bowler, count(*) AS innings, CAST(sum(wickets) AS BIGINT) AS wickets,
       CAST(sum(balls) AS BIGINT) AS balls, CAST(sum(runs) AS BIGINT) AS runs,
       CAST(sum(dots) AS BIGINT) AS dots
FROM ws SEMI JOIN event_matches USING (match_id) GROUP BY bowler"""

SQL["q_top_bowlers"] = f"""
SELECT bowler, innings, wickets, {overs('balls')} AS overs, {half_up('runs', 'wickets')} AS average,
       {half_up('runs', 'balls', 6)} AS economy, dots, {half_up('dots', 'balls', 100)} AS dot_ball_pct
FROM event_bowlers
QUALIFY row_number() OVER (ORDER BY dots DESC NULLS FIRST, dot_ball_pct DESC NULLS FIRST,
                                    bowler ASC NULLS LAST) <= 10"""


# --- junctions and dimensions -------------------------------------------------------------
CTES["squad"] = """
SELECT 'P' || CAST(i AS VARCHAR) AS pa, 'Q' || CAST(i AS VARCHAR) AS pb FROM range(11) t(i)"""

CTES["listed"] = """
SELECT fm.match_id, fm.hash_id, fm.format, fm.team_a AS team, squad.pa AS player_name FROM fm, squad
UNION ALL
SELECT fm.match_id, fm.hash_id, fm.format, fm.team_b AS team, squad.pb AS player_name FROM fm, squad"""

CTES["listed_ids"] = """
SELECT *, CASE WHEN player_name LIKE '%10' THEN NULL ELSE 'id_' || player_name END AS player_id
FROM listed"""

CTES["imp"] = f"""
SELECT DISTINCT ON (match_id, player_id)
       {sk('match_id', 'player_name')} AS match_player_id, match_id, hash_id, player_id,
       player_name, team, format
FROM listed_ids
ORDER BY match_id, player_id, team, player_name"""

CTES["team_rows"] = """
SELECT match_id, hash_id, format, team_a AS team, 1 AS position, team_b AS opponent,
       toss_winner, toss_decision, winner FROM fm
UNION ALL
SELECT match_id, hash_id, format, team_b AS team, 2 AS position, team_a AS opponent,
       toss_winner, toss_decision, winner FROM fm"""

CTES["imt"] = f"""
SELECT DISTINCT ON (match_id, team)
       {sk('match_id', 'team')} AS match_team_id, hash_id, match_id, format, team, opponent,
       CASE WHEN toss_winner = team THEN toss_decision = 'bat'
            ELSE toss_decision = 'field' END AS batted_first,
       (winner = team) AS won_match
FROM team_rows
WHERE match_id IN (SELECT fm.match_id FROM fm JOIN iv ON fm.venue = iv.venue_name)
ORDER BY match_id, team, position"""

CTES["it"] = f"""
SELECT DISTINCT ON (team, format) {sk('team', 'format')} AS team_id, hash_id, team, format
FROM imt ORDER BY team, format, match_id DESC, hash_id DESC"""

CTES["ip"] = """
SELECT DISTINCT ON (it.team_id, imp.player_id)
       it.team_id, imp.player_id, imp.hash_id, imp.player_name, imp.team, imp.format
FROM imp JOIN it ON imp.team = it.team AND imp.format = it.format
ORDER BY it.team_id, imp.player_id, imp.match_id DESC, imp.player_name DESC"""

SQL["stg_match_info"] = """
SELECT match_id, hash_id, format, venue, city, strftime(start_date, '%Y-%m-%d') AS first_date,
       team_a, team_b, toss_winner
FROM fm"""
SQL["int_match_teams"] = "SELECT * FROM imt"
SQL["int_match_players"] = "SELECT * FROM imp"
SQL["int_teams"] = "SELECT * FROM it"
SQL["int_players"] = "SELECT * FROM ip"

# --- operators on model data ---------------------------------------------------------------
SQL["outcome_type_case"] = "SELECT match_id, outcome_type FROM im"
SQL["count_filter"] = """
SELECT match_id, innings_number, CAST(count(*) FILTER (WHERE is_legal) AS BIGINT) AS legal_deliveries
FROM fd GROUP BY match_id, innings_number"""
SQL["conditional_sums"] = """
SELECT match_id, innings_number, bowler,
       CAST(sum(CASE WHEN is_legal THEN 1 ELSE 0 END) AS BIGINT) AS balls,
       CAST(sum(CASE WHEN is_legal AND batter_runs = 0 THEN 1 ELSE 0 END) AS BIGINT) AS dots,
       CAST(sum(CASE WHEN wides > 0 THEN 1 ELSE 0 END) AS BIGINT) AS wide_balls,
       CAST(sum(CASE WHEN noballs > 0 THEN 1 ELSE 0 END) AS BIGINT) AS noball_balls,
       CAST(sum(CASE WHEN wides = 0 THEN 1 ELSE 0 END) AS BIGINT) AS faced
FROM fd GROUP BY match_id, innings_number, bowler"""
SQL["first_appearance"] = """
SELECT match_id, innings_number, batter, min(ball_in_innings) AS first_appearance
FROM seq GROUP BY match_id, innings_number, batter"""
SQL["first_value_window"] = """
SELECT match_id, innings_number, player, priority, first_appearance,
       first_value(first_appearance) OVER (PARTITION BY match_id, innings_number, player
                                           ORDER BY first_appearance) AS min_first_appearance
FROM bo_first"""
SQL["union_distinct"] = "SELECT * FROM bo_first"
SQL["match_scoreline"] = "SELECT match_id, scoreline FROM summary"
SQL["match_result_text"] = "SELECT match_id, result FROM summary"
SQL["overs_display"] = f"""
SELECT match_id, innings_number, legal_deliveries, {overs('legal_deliveries')} AS overs FROM ii"""
SQL["economy_rate"] = "SELECT match_id, innings_number, bowler, balls, runs, economy FROM ws"
SQL["surrogate_key"] = f"""
SELECT match_id, player_name, match_player_id, {sk('player_id', 'team')} AS player_team_key
FROM imp"""
SQL["distinct_on"] = """
SELECT DISTINCT ON (user_id) user_id, event_id, event_type, value
FROM events ORDER BY user_id, ts DESC, event_id DESC"""
SQL["running_count_ties"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       count(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS n
FROM lineitem"""
SQL["lateral_map_explode"] = """
SELECT match_id, team_a AS team, 11 AS n_listed FROM fm
UNION ALL SELECT match_id, team_b AS team, 11 AS n_listed FROM fm"""
SQL["map_dynamic_lookup"] = "SELECT match_id, player_name, player_id FROM listed_ids"
SQL["opponent_lookup"] = "SELECT match_id, team, opponent FROM team_rows"
SQL["lateral_with_ordinality"] = "SELECT match_id, team, CAST(position AS BIGINT) AS position FROM team_rows"

# --- sources, files, registry, seeds ---------------------------------------------------------
CTES["docs"] = """
SELECT doc_id, CAST(doc_id AS VARCHAR) || '.txt' AS filename, md5(text) AS file_hash FROM documents"""
CTES["known"] = "SELECT filename, file_hash FROM docs WHERE doc_id % 2 = 0"

SQL["content_fingerprint"] = "SELECT doc_id, file_hash FROM docs"
SQL["new_files_anti_join"] = """
SELECT doc_id, file_hash FROM docs WHERE file_hash NOT IN (SELECT file_hash FROM known)"""
SQL["registry_append"] = """
SELECT filename, file_hash FROM known
UNION ALL
SELECT filename, file_hash FROM docs WHERE file_hash NOT IN (SELECT file_hash FROM known)"""
SQL["not_in_null_semantics"] = """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM docs
        WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.file_hash = docs.file_hash)) AS n_left_anti,
       (SELECT CAST(count(*) AS BIGINT) FROM docs
        WHERE file_hash NOT IN (SELECT file_hash FROM known
                                UNION ALL SELECT CAST(NULL AS VARCHAR))) AS n_not_in"""
SQL["match_id_try_cast"] = """
SELECT page_id, regexp_extract(url, '([^/]+)$', 1) AS filename,
       TRY_CAST(regexp_replace(regexp_extract(url, '([^/]+)$', 1), '[.]json$', '') AS INTEGER) AS match_id
FROM pages"""
SQL["to_date_parse"] = """
SELECT o_orderkey,
       CAST(TRY_STRPTIME(CASE WHEN o_orderkey % 10 = 0 THEN 'not-a-date'
                              ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS start_date
FROM orders"""
SQL["json_path_extract"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"""

CTES["inc"] = """
SELECT CAST(fm.match_id AS VARCHAR) || '.json' AS filename, fm.venue AS venue_name,
       CASE WHEN nation.n_nationkey % 4 = 0 THEN NULL
            WHEN nation.n_nationkey % 4 = 1 THEN ''
            ELSE fm.city || ' ' || CAST(fm.match_id % 3 AS VARCHAR) END AS city
FROM fm JOIN nation ON fm.venue = nation.n_name"""
CTES["inc_first"] = """
SELECT DISTINCT ON (venue_name) venue_name, city FROM inc ORDER BY venue_name, filename"""
CTES["new_names"] = "SELECT venue_name FROM inc EXCEPT SELECT venue_name FROM vc"
CTES["vc_new"] = """
SELECT venue_name, city FROM vc
UNION ALL
SELECT venue_name, coalesce(nullif(city, ''), venue_name || '-CITY') AS city
FROM inc_first WHERE venue_name IN (SELECT venue_name FROM inc_first EXCEPT SELECT venue_name FROM vc)"""

SQL["venue_insert_if_absent"] = """
SELECT venue_name, city FROM vc
UNION ALL
SELECT venue_name, city FROM inc_first WHERE venue_name NOT IN (SELECT venue_name FROM vc)"""
SQL["seed_new_venues"] = "SELECT * FROM vc_new"
SQL["seed_new_cities"] = """
SELECT city, country FROM cc
UNION ALL
SELECT DISTINCT city, 'UNKNOWN' AS country FROM vc_new
WHERE city IS NOT NULL AND city <> '' AND city NOT IN (SELECT city FROM cc)"""
SQL["seeds_edited_by_hand"] = f"""
SELECT venue_name, CASE WHEN n_nationkey >= 20 THEN 'BY HAND'
                        WHEN n_nationkey < {SEEDED_NATIONS} AND n_nationkey % 5 = 0 THEN 'EDITED ' || venue_name
                        ELSE city END AS city
FROM vc_new JOIN nation ON n_name = venue_name
WHERE n_nationkey >= {SEEDED_NATIONS} OR n_nationkey % 5 <> 1
UNION ALL
SELECT n_name, 'BY HAND' FROM nation WHERE n_nationkey >= 20 AND n_name NOT IN (SELECT venue_name FROM vc_new)"""
SQL["except_distinct"] = "SELECT venue_name FROM new_names"
SQL["venue_semi_join"] = """
SELECT filename, venue_name, city FROM inc WHERE venue_name IN (SELECT venue_name FROM new_names)"""

SQL["running_count_hot_keys"] = """
SELECT l_orderkey, l_linenumber, l_partkey, flag, count(*) OVER (PARTITION BY flag ORDER BY l_orderkey) AS n
FROM (SELECT *, nullif(l_returnflag, 'R') AS flag FROM lineitem)"""
SQL["raw_roundtrip_flatten"] = "SELECT * FROM fd"
CTES["per_match"] = """
SELECT fm.match_id, fm.venue, fm.format, fm.start_date,
       count(DISTINCT fd.innings_number) AS n_inn, count(fd.match_id) AS n_balls
FROM fm LEFT JOIN fd ON fm.match_id = fd.match_id
GROUP BY fm.match_id, fm.venue, fm.format, fm.start_date"""
SQL["match_doc_load"] = """
SELECT match_id, venue, format, strftime(start_date, '%Y-%m-%d') AS first_date,
       CAST(n_inn AS INTEGER) AS n_innings
FROM per_match"""
SQL["malformed_innings_quarantine"] = """
SELECT CASE WHEN match_id % 13 = 5 THEN 'm' ELSE '' END || CAST(match_id AS VARCHAR) || '.json' AS filename,
       CASE WHEN match_id % 13 = 5 THEN 'match id not integer'
            WHEN match_id % 7 = 3 AND n_inn >= 2 THEN 'innings without overs'
            ELSE 'loaded' END AS status,
       CAST(CASE WHEN match_id % 13 = 5 OR (match_id % 7 = 3 AND n_inn >= 2) THEN 0
                 ELSE n_balls END AS BIGINT) AS n_balls
FROM per_match"""
SQL["first_wicket"] = """
SELECT match_id, innings_number, over_number, ball_in_over, player_out, dismissal_mode
FROM fd WHERE player_out IS NOT NULL"""
SQL["legal_ball_predicate"] = """
SELECT match_id, innings_number, over_number, ball_in_over,
       (wides_raw IS NULL AND noballs_raw IS NULL AND byes_raw IS NULL) AS is_legal,
       CAST(coalesce(wides_raw, 0) AS INTEGER) AS wides,
       CAST(coalesce(noballs_raw, 0) AS INTEGER) AS noballs,
       CAST(coalesce(byes_raw, 0) AS INTEGER) AS byes
FROM fd_raw"""
# hashes are never NULL, so NOT IN is an anti join; the balls are laid out once
CTES["balls_once"] = "SELECT match_id, innings_number, over_number, ball_in_over, hash_id FROM fd"
SQL["anti_join_new_hash"] = """
SELECT b.* FROM balls_once b
ANTI JOIN (SELECT DISTINCT md5(CAST(CAST(l_suppkey AS INTEGER) AS VARCHAR)) AS hash_id
           FROM lineitem WHERE l_suppkey % 2 = 0) loaded USING (hash_id)"""
SQL["append_new_only"] = "SELECT * FROM fd"
SQL["upsert_by_key"] = "SELECT * FROM fd"
SQL["replace_by_match"] = "SELECT * FROM fd"


# --- data-quality suite ------------------------------------------------------------------
CTES["dq_iv"] = "SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS last_update FROM iv"
CTES["dq_it"] = "SELECT *, TIMESTAMP '2025-01-01 00:00:00' AS last_update FROM it"
MODEL_CTE = {
    "int_venues": "dq_iv", "int_matches": "im", "int_deliveries": "fd", "int_innings": "ii",
    "int_teams": "dq_it", "int_players": "ip", "int_match_teams": "imt",
    "int_match_players": "imp", "fct_batting_scorecard": "bs", "fct_bowling_scorecard": "ws",
    "fct_batting_order": "bo", "fct_deliveries_sequence": "seq", "fct_dismissed_players": "dp",
    "fct_bowling_order": "wo", "fct_match_summary": "summary",
}
#: Reference columns whose value is made to point nowhere.
STRAY = {"match_id": "-match_id", "venue_id": "'?' || venue_id", "team_id": "'?' || team_id",
         "start_date": "CAST(start_date + INTERVAL 100 YEAR AS DATE)"}


def _planted(model: str) -> str:
    """The model with one fifth of its keys nulled, one made stray and one doubled."""
    from crease.operators.quality import DECLARED
    part = f"({PLANT_KEYS.get(model, 'match_id')}) % 5"
    cte = MODEL_CTE[model]
    changed: dict[str, list[str]] = {}
    for m, cols in DECLARED.not_null:
        for c in cols if m == model else []:
            changed.setdefault(c, []).append(f"WHEN {part} = 1 THEN NULL")
    for m, c, _, _ in DECLARED.relationships:
        if m == model:
            changed.setdefault(c, []).append(f"WHEN {part} = 2 THEN {STRAY[c]}")
    cases = ", ".join(f"CASE {' '.join(w)} ELSE {c} END AS {c}" for c, w in changed.items())
    star = f"* REPLACE ({cases})" if cases else "*"
    return f"SELECT {star} FROM {cte} UNION ALL SELECT * FROM {cte} WHERE {part} = 0"


for _model in MODEL_CTE:
    CTES[f"planted_{_model}"] = _planted(_model)


def _dq_sql(kind: str) -> str:
    from crease.operators.quality import DECLARED
    parts = []

    def head(test, model, col):
        return f"SELECT '{test}' AS test, '{model}' AS model, '{col}' AS column_name, "

    if kind == "unique":
        for m, c in DECLARED.unique:
            parts.append(head("unique", m, c) + f"CAST(count(*) AS BIGINT) AS failures FROM "
                         f"(SELECT {c} FROM planted_{m} WHERE {c} IS NOT NULL "
                         f"GROUP BY {c} HAVING count(*) > 1) t")
    if kind == "not_null":
        for m, cols in DECLARED.not_null:
            for c in cols:
                parts.append(head("not_null", m, c) + f"CAST(count(*) FILTER (WHERE {c} IS NULL) "
                             f"AS BIGINT) AS failures FROM planted_{m}")
    if kind == "relationships":
        for m, c, pm, f in DECLARED.relationships:
            parts.append(head(f"relationships:{pm}.{f}", m, c)
                         + f"CAST(count(*) AS BIGINT) AS failures FROM planted_{m} ch "
                         f"WHERE ch.{c} IS NOT NULL AND ch.{c} NOT IN "
                         f"(SELECT {f} FROM planted_{pm} WHERE {f} IS NOT NULL)")
    if kind == "unique_combination":
        for m, cols in DECLARED.unique_combination:
            cl = ", ".join(cols)
            parts.append(head("unique_combination", m, ",".join(cols))
                         + f"CAST(count(*) AS BIGINT) AS failures FROM (SELECT {cl} FROM "
                         f"planted_{m} GROUP BY {cl} HAVING count(*) > 1) t")
    if kind == "singular":
        for name, m, cond in DECLARED.singular:
            parts.append(head(name, m, "") + f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) "
                         f"AS failures FROM planted_{m}")
    return "\nUNION ALL\n".join(parts)


SQL["dq_unique"] = _dq_sql("unique")
SQL["dq_not_null"] = _dq_sql("not_null")
SQL["dq_relationships"] = _dq_sql("relationships")
SQL["dq_unique_combination"] = _dq_sql("unique_combination")
SQL["dq_country_not_null"] = _dq_sql("singular")

# --- incremental pipeline -----------------------------------------------------------------
SQL["incremental_two_batches"] = """
SELECT match_id, innings_number, team, super_over, runs_scored, wickets_lost, legal_deliveries,
       wides, noballs, byes, legbyes, extras
FROM ii"""
SQL["mart_incremental_equals_full"] = "SELECT * FROM bs"
SQL["catch_up_after_interruption"] = "SELECT * FROM ws"
SQL["corrections_merged_on_read"] = "SELECT * EXCLUDE (hash_id) FROM fd"
SQL["stream_two_micro_batches"] = SQL["incremental_two_batches"]
SQL["batting_scorecard_from_buckets"] = "SELECT * FROM bs"
SQL["bowling_scorecard_from_buckets"] = "SELECT * FROM ws"

# --- whole documents, names, batches --------------------------------------------------------
SQL["raw_whole_balls"] = """
SELECT match_id, innings_number, over_number, ball_in_over,
       CASE WHEN batter_runs = 6 THEN batter END AS review_by,
       CASE WHEN batter_runs = 6 THEN 'upheld' END AS decision,
       CASE WHEN dismissal_mode = 'caught' THEN bowler END AS fielder
FROM fd WHERE batter_runs = 6 OR dismissal_mode = 'caught'"""
SQL["raw_schema_drift"] = """
SELECT '$.info' AS level, 'officials' AS key, count(*) AS n_objects, count(*) AS n_documents,
       'OBJECT<umpires: ARRAY<STRING>>' AS value_type FROM fm HAVING count(*) > 0
UNION ALL
SELECT '$.innings[].overs[].deliveries[]', 'review', count(*), count(DISTINCT match_id),
       'OBJECT<by: STRING, decision: STRING>' FROM fd WHERE batter_runs = 6 HAVING count(*) > 0
UNION ALL
SELECT '$.innings[].overs[].deliveries[].wickets[]', 'fielders', count(*), count(DISTINCT match_id),
       'ARRAY<OBJECT<name: STRING>>' FROM fd WHERE dismissal_mode = 'caught' HAVING count(*) > 0"""
# the file with the lesser path holds what the document holds
SQL["registry_double_names"] = SQL["registry_append"]
SQL["files_to_batches"] = f"""
WITH f AS (SELECT 'f' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS filename,
                  CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n FROM documents),
s AS (SELECT *, sum(n) OVER (ORDER BY filename) - n AS before,
             row_number() OVER (ORDER BY filename) - 1 AS place, max(n) OVER () AS most
      FROM f WHERE n <= {BATCH_BYTES} // 2),
d AS (SELECT filename, CAST(before // greatest(1, {BATCH_BYTES} - most) + place // {BATCH_FILES - 1} AS BIGINT) AS batch FROM s)
SELECT * FROM d
UNION ALL
SELECT filename, CAST(row_number() OVER (ORDER BY filename) + (SELECT coalesce(max(batch), -1) FROM d) AS BIGINT)
FROM f WHERE n > {BATCH_BYTES} // 2"""


def oracle_sql() -> dict[str, str]:
    return {k: with_ctes(v) for k, v in SQL.items()}
