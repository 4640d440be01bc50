"""DuckDB SQL twins of the catalogued queries.

Written from the rules, not from the Spark code: the adapter rules of FIXTURES.md §2 as
CTEs over the driver's raw tables (tag membership as boolean flags, minutes and
record fields from their closed formulas, ratings from their closed form
r_n = 0.5 * 2^-n + sum_i perf_i * 2^(i-1-n)), then one SELECT per query.
Doubles are rounded with ``round(x + 1e-9, 6)`` exactly as the Spark catalogue does.
"""

from __future__ import annotations


def R(x: str, digits: int = 6) -> str:
    return f"(round(CAST({x} AS DOUBLE) + 1e-9, {digits}) + 0.0)"


ADAPTER = """
ev_raw AS (
  SELECT event_id AS seq, user_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS dn,
         CAST(user_id // 15 AS BIGINT) AS g,
         CASE event_type WHEN 'view' THEN 8 WHEN 'click' THEN 1 WHEN 'error' THEN 2
                         WHEN 'purchase' THEN 3 WHEN 'signup' THEN 10 END AS et
  FROM events
),
ev AS (
  SELECT CAST(g * 100000 + dn AS VARCHAR) AS match_id, seq, dn, g, k,
         CASE WHEN k = 97 THEN '0' ELSE CAST(user_id + 1 AS VARCHAR) END AS player_id,
         et AS event_id,
         CASE WHEN et = 3 AND k % 5 = 0 THEN 35 ELSE et * 10 + 1 END AS sub_event_id,
         (k <> 98 AND et = 8 AND k % 10 = 0) AS t302,
         (k <> 98 AND ((et = 8 AND k < 70) OR (et = 3 AND k < 60) OR (et = 10 AND k < 50))) AS t1801,
         (k <> 98 AND ((et = 8 AND k >= 70) OR (et = 3 AND k >= 60) OR (et = 10 AND k >= 50))) AS t1802,
         (k <> 98 AND et = 1 AND k < 33) AS t701,
         (k <> 98 AND et = 1 AND k >= 33 AND k <= 65) AS t702,
         (k <> 98 AND et = 1 AND k > 65) AS t703,
         (k <> 98 AND ((et = 10 AND k < 15) OR (et = 3 AND k % 5 = 0 AND k < 30))) AS t101,
         (k = 99) AS t102
  FROM ev_raw
),
evt AS (
  SELECT *, (CAST(t302 AS INT) + CAST(t1801 AS INT) + CAST(t1802 AS INT) + CAST(t701 AS INT)
             + CAST(t702 AS INT) + CAST(t703 AS INT) + CAST(t101 AS INT) + CAST(t102 AS INT)) AS n_tags
  FROM ev WHERE player_id <> '0'
),
pl AS (
  SELECT c_custkey AS uid, CAST(c_custkey + 1 AS VARCHAR) AS player_id, c_name AS name,
         CAST(c_custkey // 15 AS BIGINT) AS g, CAST(c_custkey % 15 AS INTEGER) AS pos,
         CASE WHEN c_custkey % 15 IN (0, 1) THEN 'GK' WHEN c_custkey % 15 IN (2, 3, 4, 5, 11) THEN 'DF'
              WHEN c_custkey % 15 IN (6, 7, 8, 12, 13) THEN 'MD'
              WHEN c_custkey % 15 = 14 AND (c_custkey // 15) % 4 = 1 THEN 'DF'
              WHEN c_custkey % 15 = 14 AND (c_custkey // 15) % 4 = 2 THEN 'GK' ELSE 'FW' END AS role,
         CASE c_custkey % 3 WHEN 0 THEN 'right' WHEN 1 THEN 'left' ELSE 'both' END AS foot,
         CASE WHEN c_custkey % 97 = 12 THEN NULL
              ELSE CAST(DATE '1985-01-01' + CAST((c_custkey * 37) % 5000 AS INTEGER) AS DATE) END AS birth_date,
         n_name AS birth_area, n_name AS passport_area,
         CAST(c_custkey % 30 + 165 AS INTEGER) AS height, CAST(c_custkey % 25 + 60 AS INTEGER) AS weight
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
tm AS (
  SELECT DISTINCT CAST(g * 2 + pos % 2 + 1 AS VARCHAR) AS team_id FROM pl
),
mt0 AS (SELECT DISTINCT dn, g FROM ev_raw),
pa AS (
  SELECT CAST(mt0.g * 100000 + mt0.dn AS VARCHAR) AS match_id, mt0.dn, mt0.g,
         CAST(DATE '2024-01-01' + CAST(mt0.dn AS INTEGER) AS DATE) AS match_date,
         pl.uid, pl.player_id, pl.pos, pl.name, pl.role, pl.birth_date,
         CAST(pl.pos % 2 AS INTEGER) AS team_pos,
         CAST(mt0.g * 2 + pl.pos % 2 + 1 AS VARCHAR) AS team_id,
         CASE WHEN pl.pos < 11 THEN 'lineup' ELSE 'bench' END AS squad,
         CAST(CASE WHEN pl.pos IN (0, 1) THEN 45 + (mt0.dn * 3) % 50
                   WHEN pl.pos IN (11, 12) THEN 90 - (45 + (mt0.dn * 3) % 50)
                   WHEN pl.pos < 11 THEN 90 ELSE 0 END AS INTEGER) AS minutes_played,
         CAST(((pl.uid + mt0.dn) % 7 = 0) AS INTEGER) AS goals,
         CAST(((pl.uid * 3 + mt0.dn) % 41 = 0) AS INTEGER) AS own_goals,
         CAST(((pl.uid + 2 * mt0.dn) % 11 = 0) AS INTEGER) AS yellow_cards,
         CAST(((pl.uid + 5 * mt0.dn) % 53 = 0) AS INTEGER) AS red_cards
  FROM mt0 JOIN pl ON mt0.g = pl.g
),
mt AS (
  SELECT match_id, any_value(dn) AS dn, any_value(g) AS g, any_value(match_date) AS match_date,
         sum(CASE WHEN team_pos = 0 THEN goals ELSE 0 END) + sum(CASE WHEN team_pos = 1 THEN own_goals ELSE 0 END) AS score0,
         sum(CASE WHEN team_pos = 1 THEN goals ELSE 0 END) + sum(CASE WHEN team_pos = 0 THEN own_goals ELSE 0 END) AS score1
  FROM pa GROUP BY match_id
),
mtx AS (
  SELECT match_id, dn, g, match_date,
         'T' || CAST(2 * g + 1 AS VARCHAR) || ' - T' || CAST(2 * g + 2 AS VARCHAR) || ' #' || CAST(dn AS VARCHAR) AS label,
         'Regular' AS duration, 'V' || CAST(g AS VARCHAR) AS venue, CAST(dn + 1 AS INTEGER) AS gameweek,
         CASE WHEN score0 > score1 THEN CAST(2 * g + 1 AS VARCHAR)
              WHEN score1 > score0 THEN CAST(2 * g + 2 AS VARCHAR) ELSE '0' END AS winner
  FROM mt
),
cnt AS (
  SELECT match_id, player_id,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 8) AS n_pass_events,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 8 AND t302 AND t1801) AS n_key_accurate,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 8 AND t302 AND NOT t1801 AND t1802) AS n_key_inaccurate,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 8 AND NOT t302 AND t1801) AS n_accurate,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 8 AND NOT t302 AND NOT t1801 AND t1802) AS n_inaccurate,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 1) AS n_duel_events,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 1 AND t703) AS n_duels_won,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 1 AND t702) AS n_duels_neutral,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 1 AND t701) AS n_duels_lost,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 3) AS n_free_kick_events,
    2 * count(*) FILTER (WHERE n_tags > 0 AND event_id = 3 AND t1801 AND sub_event_id <> 35)
      + count(*) FILTER (WHERE n_tags > 0 AND event_id = 3 AND t1801 AND sub_event_id = 35) AS n_free_kicks_effective,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 3 AND t1802) AS n_free_kicks_not_effective,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 3 AND t1801 AND sub_event_id = 35 AND t101) AS n_penalties_scored,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 10) AS n_shot_events,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 10 AND t101) AS n_shot_goals,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 10 AND t1801 AND NOT t101) AS n_shots_on_target_no_goal,
    count(*) FILTER (WHERE n_tags > 0 AND event_id = 10 AND t1802) AS n_shots_off_target,
    count(*) FILTER (WHERE event_id = 2) AS n_fouls,
    count(*) FILTER (WHERE n_tags > 0 AND t102) AS n_own_goals
  FROM evt GROUP BY match_id, player_id
),
mm AS (
  SELECT match_id, player_id,
    CASE WHEN 2 * (n_key_accurate + n_key_inaccurate) + n_accurate + n_inaccurate = 0 THEN 0.0
         ELSE CAST(2 * n_key_accurate + n_accurate AS DOUBLE)
              / CAST(2 * (n_key_accurate + n_key_inaccurate) + n_accurate + n_inaccurate AS DOUBLE) END AS pass_accuracy,
    CASE WHEN n_duels_won + n_duels_neutral + n_duels_lost = 0 THEN 0.0
         ELSE (CAST(n_duels_won AS DOUBLE) + CAST(n_duels_neutral AS DOUBLE) * CAST(0.5 AS DOUBLE))
              / CAST(n_duels_won + n_duels_neutral + n_duels_lost AS DOUBLE) END AS duel_effectiveness,
    CASE WHEN n_free_kicks_effective + n_free_kicks_not_effective = 0 THEN 0.0
         ELSE CAST(n_free_kicks_effective + n_penalties_scored AS DOUBLE)
              / CAST(n_free_kicks_effective + n_free_kicks_not_effective AS DOUBLE) END AS free_kick_effectiveness,
    CASE WHEN n_shot_goals + n_shots_on_target_no_goal + n_shots_off_target = 0 THEN 0.0
         ELSE (CAST(n_shot_goals AS DOUBLE) + CAST(n_shots_on_target_no_goal AS DOUBLE) * CAST(0.5 AS DOUBLE))
              / CAST(n_shot_goals + n_shots_on_target_no_goal + n_shots_off_target AS DOUBLE) END AS shot_effectiveness,
    n_fouls AS number_of_fouls, n_own_goals AS number_of_own_goals,
    n_shot_goals + n_shots_on_target_no_goal AS no_of_shots_on_target,
    n_shot_goals + n_penalties_scored AS number_of_goals
  FROM cnt
),
mf0 AS (
  SELECT pa.match_id, pa.match_date, pa.player_id, pa.team_pos, pa.squad, pa.minutes_played,
         coalesce(mm.pass_accuracy, 0.0) AS pass_accuracy, coalesce(mm.duel_effectiveness, 0.0) AS duel_effectiveness,
         coalesce(mm.free_kick_effectiveness, 0.0) AS free_kick_effectiveness,
         coalesce(mm.shot_effectiveness, 0.0) AS shot_effectiveness,
         coalesce(mm.number_of_fouls, 0) AS number_of_fouls, coalesce(mm.number_of_own_goals, 0) AS number_of_own_goals,
         coalesce(mm.no_of_shots_on_target, 0) AS no_of_shots_on_target, coalesce(mm.number_of_goals, 0) AS number_of_goals
  FROM pa LEFT JOIN mm ON pa.match_id = mm.match_id AND pa.player_id = mm.player_id
),
mf1 AS (
  SELECT *, pass_accuracy + duel_effectiveness + free_kick_effectiveness + CAST(no_of_shots_on_target AS DOUBLE) AS s
  FROM mf0
),
mf2 AS (
  SELECT *, CASE WHEN minutes_played = 90 THEN CAST(1.05 AS DOUBLE) * s / 4.0
                 WHEN minutes_played <> 0 THEN CAST(minutes_played AS DOUBLE) / 90.0 * s / 4.0
                 ELSE 0.0 END AS player_contribution
  FROM mf1
),
mf AS (
  SELECT *, player_contribution - CAST(0.0005 AS DOUBLE) * CAST(number_of_fouls AS DOUBLE)
            - CAST(0.05 AS DOUBLE) * CAST(number_of_own_goals AS DOUBLE) AS player_performance
  FROM mf2
),
rt0 AS (
  SELECT player_id, match_date, match_id, player_performance,
         row_number() OVER (PARTITION BY player_id ORDER BY match_date, match_id) AS n
  FROM mf
),
rt AS (
  SELECT player_id, match_date, match_id, n,
         0.5 * pow(2.0, -n) + sum(player_performance * pow(2.0, n - 1)) OVER w * pow(2.0, -n) AS rating,
         0.5 * pow(2.0, -(n - 1)) + coalesce(sum(player_performance * pow(2.0, n - 1)) OVER wp, 0.0) * pow(2.0, -(n - 1)) AS old_rating
  FROM rt0
  WINDOW w AS (PARTITION BY player_id ORDER BY match_date, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wp AS (PARTITION BY player_id ORDER BY match_date, match_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
sp AS (
  SELECT player_id, match_id, seq,
         CASE WHEN t302 AND t1801 THEN 2 WHEN NOT t302 AND t1801 THEN 1 ELSE 0 END AS wn,
         CASE WHEN t302 AND (t1801 OR t1802) THEN 2 WHEN NOT t302 AND (t1801 OR t1802) THEN 1 ELSE 0 END AS wd
  FROM evt WHERE n_tags > 0 AND event_id = 8
),
spr AS (
  SELECT player_id, sum(wn) OVER w AS rn, sum(wd) OVER w AS rd FROM sp
  WINDOW w AS (PARTITION BY match_id, player_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
spa AS (
  SELECT player_id, CAST(sum(rn) AS BIGINT) AS numerator, CAST(sum(rd) AS BIGINT) AS denominator,
         CASE WHEN sum(rd) = 0 THEN 0.0 ELSE CAST(sum(rn) AS DOUBLE) / CAST(sum(rd) AS DOUBLE) END AS pass_accuracy
  FROM spr GROUP BY player_id
),
tot AS (
  SELECT player_id, sum(number_of_fouls) AS number_of_fouls, sum(number_of_goals) AS number_of_goals,
         sum(number_of_own_goals) AS number_of_own_goals, sum(no_of_shots_on_target) AS number_of_shots_on_target,
         count(*) FILTER (WHERE minutes_played > 0) AS number_of_matches
  FROM mf GROUP BY player_id
),
pt AS (
  SELECT pl.player_id, pl.name, pl.role, pl.foot, pl.birth_date, pl.birth_area, pl.passport_area, pl.height, pl.weight,
         CAST(coalesce(tot.number_of_fouls, 0) AS BIGINT) AS number_of_fouls,
         CAST(coalesce(tot.number_of_goals, 0) AS BIGINT) AS number_of_goals,
         CAST(coalesce(tot.number_of_own_goals, 0) AS BIGINT) AS number_of_own_goals,
         CAST(coalesce(tot.number_of_matches, 0) AS BIGINT) AS number_of_matches,
         CAST(coalesce(tot.number_of_shots_on_target, 0) AS BIGINT) AS number_of_shots_on_target,
         coalesce(spa.pass_accuracy, 0.0) AS pass_accuracy
  FROM pl LEFT JOIN tot ON pl.player_id = tot.player_id LEFT JOIN spa ON pl.player_id = spa.player_id
),
chem_sq AS (
  SELECT pa.match_id, pa.player_id, pa.team_pos, rt.rating - rt.old_rating AS d
  FROM pa JOIN rt ON pa.match_id = rt.match_id AND pa.player_id = rt.player_id
  WHERE pa.squad IN ('lineup', 'bench')
),
ch AS (
  SELECT a.player_id AS player_id_1, b.player_id AS player_id_2,
         0.5 + sum(CASE WHEN (a.team_pos = b.team_pos) = ((a.d >= 0) = (b.d >= 0)) THEN abs((a.d + b.d) / 2)
                        ELSE -abs((a.d + b.d) / 2) END) AS chemistry
  FROM chem_sq a JOIN chem_sq b ON a.match_id = b.match_id AND a.player_id <> b.player_id
  GROUP BY a.player_id, b.player_id
),
md AS (
  SELECT mtx.match_id, any_value(mtx.label) AS label, CAST(any_value(mtx.match_date) AS VARCHAR) AS date,
         any_value(mtx.duration) AS duration,
         CASE WHEN any_value(mtx.winner) = '0' THEN 'DRAW' ELSE 'Team ' || any_value(mtx.winner) END AS winner,
         any_value(mtx.venue) AS venue, any_value(mtx.gameweek) AS gameweek,
         coalesce(string_agg(pa.name || '|Team ' || pa.team_id || '|' || CAST(pa.goals AS VARCHAR), ';'
                             ORDER BY pa.team_pos, pa.pos) FILTER (WHERE pa.goals > 0), '') AS goals,
         coalesce(string_agg(pa.name || '|Team ' || pa.team_id || '|' || CAST(pa.own_goals AS VARCHAR), ';'
                             ORDER BY pa.team_pos, pa.pos) FILTER (WHERE pa.own_goals > 0), '') AS own_goals,
         coalesce(string_agg(pa.name, ';' ORDER BY pa.team_pos, pa.pos) FILTER (WHERE pa.yellow_cards > 0), '') AS yellow_cards,
         coalesce(string_agg(pa.name, ';' ORDER BY pa.team_pos, pa.pos) FILTER (WHERE pa.red_cards > 0), '') AS red_cards
  FROM mtx JOIN pa ON mtx.match_id = pa.match_id
  GROUP BY mtx.match_id
)
"""


def _with(body: str) -> str:
    return "WITH " + ADAPTER.strip() + "\n" + body


ORACLE: dict[str, str] = {}

ORACLE["match_metrics"] = _with(f"""
SELECT match_id, player_id, {R('pass_accuracy')} AS pass_accuracy, {R('duel_effectiveness')} AS duel_effectiveness,
       {R('free_kick_effectiveness')} AS free_kick_effectiveness, {R('shot_effectiveness')} AS shot_effectiveness,
       CAST(number_of_fouls AS BIGINT) AS number_of_fouls, CAST(number_of_own_goals AS BIGINT) AS number_of_own_goals,
       CAST(no_of_shots_on_target AS BIGINT) AS no_of_shots_on_target, CAST(number_of_goals AS BIGINT) AS number_of_goals
FROM mm""")

ORACLE["participants"] = _with("""
SELECT match_id, CAST(match_date AS VARCHAR) AS match_date, CAST(team_pos AS INTEGER) AS team_pos, team_id, player_id,
       squad, CAST(minutes_played AS INTEGER) AS minutes_played, CAST(goals AS INTEGER) AS goals,
       CAST(own_goals AS INTEGER) AS own_goals, CAST(yellow_cards AS INTEGER) AS yellow_cards,
       CAST(red_cards AS INTEGER) AS red_cards
FROM pa""")

ORACLE["match_facts"] = _with(f"""
SELECT match_id, player_id, CAST(minutes_played AS INTEGER) AS minutes_played,
       {R('pass_accuracy')} AS pass_accuracy, {R('duel_effectiveness')} AS duel_effectiveness,
       {R('free_kick_effectiveness')} AS free_kick_effectiveness,
       CAST(no_of_shots_on_target AS BIGINT) AS no_of_shots_on_target,
       CAST(number_of_fouls AS BIGINT) AS number_of_fouls, CAST(number_of_own_goals AS BIGINT) AS number_of_own_goals,
       CAST(number_of_goals AS BIGINT) AS number_of_goals,
       {R('player_contribution')} AS player_contribution, {R('player_performance')} AS player_performance
FROM mf""")

ORACLE["player_ratings"] = _with(f"""
SELECT player_id, CAST(match_date AS VARCHAR) AS match_date, match_id, {R('rating')} AS rating
FROM rt""")

ORACLE["rating_change"] = _with(f"""
SELECT player_id, CAST(match_date AS VARCHAR) AS match_date, match_id, {R('old_rating')} AS old_rating,
       {R('rating')} AS rating, {R('rating - old_rating')} AS change_in_rating
FROM rt""")

_TAG_TEXT = ("concat_ws(',', CASE WHEN t302 THEN '302' END, CASE WHEN t1801 THEN '1801' END, "
             "CASE WHEN t1802 THEN '1802' END, CASE WHEN t701 THEN '701' END, CASE WHEN t702 THEN '702' END, "
             "CASE WHEN t703 THEN '703' END, CASE WHEN t101 THEN '101' END, CASE WHEN t102 THEN '102' END)")

ORACLE["event_filter"] = _with(f"""
SELECT match_id, CAST(seq AS BIGINT) AS seq, player_id, CAST(event_id AS INTEGER) AS event_id,
       CAST(sub_event_id AS INTEGER) AS sub_event_id, CAST(n_tags AS BIGINT) AS n_tags, {_TAG_TEXT} AS tag_ids
FROM evt""")

ORACLE["tag_membership"] = _with("""
SELECT match_id, CAST(seq AS BIGINT) AS seq, player_id, CAST(event_id AS INTEGER) AS event_id,
       CAST(n_tags AS BIGINT) AS n_tags,
       CAST(t101 AS INTEGER) AS has_101, CAST(t102 AS INTEGER) AS has_102, CAST(t302 AS INTEGER) AS has_302,
       CAST(t701 AS INTEGER) AS has_701, CAST(t702 AS INTEGER) AS has_702, CAST(t703 AS INTEGER) AS has_703,
       CAST(t1801 AS INTEGER) AS has_1801, CAST(t1802 AS INTEGER) AS has_1802
FROM evt""")

ORACLE["event_type_counts"] = _with("""
SELECT match_id, player_id,
       CAST(count(*) FILTER (WHERE event_id = 8) AS BIGINT) AS n_passes,
       CAST(count(*) FILTER (WHERE event_id = 1) AS BIGINT) AS n_duels,
       CAST(count(*) FILTER (WHERE event_id = 3) AS BIGINT) AS n_free_kicks,
       CAST(count(*) FILTER (WHERE event_id = 2) AS BIGINT) AS n_fouls,
       CAST(count(*) FILTER (WHERE event_id = 10) AS BIGINT) AS n_shots,
       CAST(count(*) FILTER (WHERE event_id NOT IN (1, 2, 3, 8, 10) OR event_id IS NULL) AS BIGINT) AS n_other,
       CAST(count(*) AS BIGINT) AS n_events
FROM evt GROUP BY match_id, player_id""")


def _component(events_col: str, counts: list[str], value_col: str) -> str:
    cols = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in counts)
    return _with(f"""
SELECT cnt.match_id, cnt.player_id, {cols}, {R('mm.' + value_col)} AS {value_col}
FROM cnt JOIN mm ON cnt.match_id = mm.match_id AND cnt.player_id = mm.player_id
WHERE {events_col} > 0""")


ORACLE["pass_accuracy"] = _component(
    "n_pass_events", ["n_key_accurate", "n_key_inaccurate", "n_accurate", "n_inaccurate"], "pass_accuracy")
ORACLE["duel_effectiveness"] = _component(
    "n_duel_events", ["n_duels_won", "n_duels_neutral", "n_duels_lost"], "duel_effectiveness")
ORACLE["free_kick_effectiveness"] = _component(
    "n_free_kick_events", ["n_free_kicks_effective", "n_free_kicks_not_effective", "n_penalties_scored"],
    "free_kick_effectiveness")
ORACLE["shot_effectiveness"] = _component(
    "n_shot_events", ["n_shot_goals", "n_shots_on_target_no_goal", "n_shots_off_target"], "shot_effectiveness")

ORACLE["stream_pass_accuracy"] = _with(f"""
SELECT player_id, numerator, denominator, {R('pass_accuracy')} AS pass_accuracy FROM spa""")

_PT_COLS = ("player_id, name, role, foot, CAST(birth_date AS VARCHAR) AS birth_date, birth_area, passport_area, "
            "CAST(height AS INTEGER) AS height, CAST(weight AS INTEGER) AS weight, number_of_fouls, number_of_goals, "
            "number_of_own_goals, number_of_matches, number_of_shots_on_target")

ORACLE["player_totals"] = _with(f"""
SELECT {_PT_COLS}, {R('pass_accuracy')} AS pass_accuracy FROM pt""")

ORACLE["player_chemistry"] = _with(f"""
SELECT player_id_1, player_id_2, {R('chemistry')} AS chemistry FROM ch""")

ORACLE["match_winner"] = _with("""
SELECT mtx.match_id, CASE WHEN mtx.winner = '0' THEN 'DRAW' ELSE 'Team ' || tm.team_id END AS winner,
       CAST(sum(pa.goals) AS BIGINT) AS total_goals, CAST(sum(pa.own_goals) AS BIGINT) AS total_own_goals,
       CAST(sum(pa.yellow_cards) AS BIGINT) AS total_yellow_cards, CAST(sum(pa.red_cards) AS BIGINT) AS total_red_cards
FROM mtx LEFT JOIN tm ON mtx.winner = tm.team_id JOIN pa ON mtx.match_id = pa.match_id
GROUP BY mtx.match_id, mtx.winner, tm.team_id""")

_MD_COLS = ("md.match_id, md.label, md.date, md.duration, md.winner, md.venue, CAST(md.gameweek AS INTEGER) AS gameweek, "
            "md.goals, md.own_goals, md.yellow_cards, md.red_cards")

ORACLE["match_details"] = _with(f"SELECT {_MD_COLS} FROM md")

ORACLE["match_lookup"] = _with(f"""
, rq AS (
  SELECT CAST(match_id AS BIGINT) * 10 + 6 AS request_id, label AS q FROM mtx
  UNION ALL
  SELECT CAST(match_id AS BIGINT) * 10 + 7, label || ' (replay)' FROM mtx
)
SELECT rq.request_id, {_MD_COLS}, CASE WHEN md.match_id IS NULL THEN 'Invalid' END AS error
FROM rq LEFT JOIN md ON rq.q = md.label""")

ORACLE["player_profile"] = _with(f"""
, rq AS (SELECT CAST(c_custkey * 10 + 4 AS BIGINT) AS request_id, c_name AS q FROM customer
        UNION ALL SELECT DISTINCT CAST(g * 10 + 5 AS BIGINT), 'Nobody ' || CAST(g AS VARCHAR) FROM pl)
SELECT rq.request_id, {_PT_COLS.replace('player_id,', 'pt.player_id,', 1)}, {R('pass_accuracy')} AS pass_accuracy,
       CASE WHEN pt.player_id IS NULL THEN 'Invalid' END AS error
FROM rq LEFT JOIN pt ON rq.q = pt.name""")


# --- models: least squares over the points that have an age (a player without a birth date
# gives no points), requests with both sides whether or not they name players --------------

def _det3(a, b, c, d, e, f, g, h, i) -> str:
    return f"(({a}) * (({e}) * ({i}) - ({f}) * ({h})) - ({b}) * (({d}) * ({i}) - ({f}) * ({g})) + ({c}) * (({d}) * ({h}) - ({e}) * ({g})))"


def _fit(name: str, source: str, key: str) -> str:
    """CTEs ``{name}`` with columns gk, n_points, degree, mean_age, b0, b1, b2."""
    det = _det3("n", "s1", "s2", "s1", "s2", "s3", "s2", "s3", "s4")
    q0 = _det3("t0", "s1", "s2", "t1", "s2", "s3", "t2", "s3", "s4")
    q1 = _det3("n", "t0", "s2", "s1", "t1", "s3", "s2", "t2", "s4")
    q2 = _det3("n", "s1", "t0", "s1", "s2", "t1", "s2", "s3", "t2")
    return f"""
{name}_1 AS (
  SELECT {key} AS gk, count(*) AS cnt, avg(CAST(age AS DOUBLE)) AS mean_age, min(age) AS lo, max(age) AS hi
  FROM {source} WHERE age IS NOT NULL AND rating IS NOT NULL GROUP BY {key}
),
{name}_2 AS (
  SELECT f.gk, any_value(f.cnt) AS cnt, any_value(f.mean_age) AS mean_age, any_value(f.lo) AS lo, any_value(f.hi) AS hi,
         sum(s.u) AS s1, sum(s.u * s.u) AS s2, sum(s.u * s.u * s.u) AS s3, sum(s.u * s.u * s.u * s.u) AS s4,
         sum(s.y) AS t0, sum(s.u * s.y) AS t1, sum(s.u * s.u * s.y) AS t2,
         count(*) FILTER (WHERE s.age > f.lo AND s.age < f.hi) AS interior
  FROM (SELECT {key} AS gk, age, CAST(rating AS DOUBLE) AS y FROM {source} WHERE age IS NOT NULL AND rating IS NOT NULL) s0
  JOIN {name}_1 f ON s0.gk = f.gk
  CROSS JOIN LATERAL (SELECT s0.age AS age, CAST(s0.age AS DOUBLE) - f.mean_age AS u, s0.y AS y) s
  GROUP BY f.gk
),
{name}_3 AS (
  SELECT gk, cnt AS n_points, CAST(cnt AS DOUBLE) AS n, mean_age, s1, s2, s3, s4, t0, t1, t2,
         CASE WHEN lo = hi THEN 0 WHEN interior = 0 THEN 1 ELSE 2 END AS degree
  FROM {name}_2
),
{name} AS (
  SELECT gk, n_points, degree, mean_age,
         CASE WHEN degree = 0 THEN t0 / n WHEN degree = 1 THEN (t0 * s2 - s1 * t1) / (n * s2 - s1 * s1)
              ELSE {q0} / {det} END AS b0,
         CASE WHEN degree = 0 THEN 0.0 WHEN degree = 1 THEN (n * t1 - s1 * t0) / (n * s2 - s1 * s1)
              ELSE {q1} / {det} END AS b1,
         CASE WHEN degree = 2 THEN {q2} / {det} ELSE 0.0 END AS b2
  FROM {name}_3
)"""


def _models(groups: str) -> str:
    """CTEs of the models and forecasts; ``groups``: SQL of (player_id, grp)."""
    return f""",
grp AS ({groups}),
af AS (
  SELECT rt.player_id, rt.match_date, rt.match_id, rt.rating, pl.role, grp.grp,
         CAST(date_diff('day', pl.birth_date, rt.match_date) AS BIGINT) AS age
  FROM rt JOIN pl ON rt.player_id = pl.player_id JOIN grp ON rt.player_id = grp.player_id
),
af_young AS (
  SELECT af.* FROM af JOIN pt ON af.player_id = pt.player_id WHERE pt.number_of_matches < 5
),{_fit("pfit", "af", "player_id")},{_fit("gfit", "af_young", "grp")},
pred AS (
  SELECT pl.player_id, grp.grp, CASE WHEN pt.number_of_matches < 5 THEN 'group' ELSE 'player' END AS route,
         CAST(date_diff('day', pl.birth_date, DATE '2024-02-15') AS DOUBLE) AS age,
         pt.number_of_matches
  FROM pl JOIN pt ON pl.player_id = pt.player_id JOIN grp ON pl.player_id = grp.player_id
),
pred2 AS (
  SELECT pred.player_id, pred.route,
         CASE WHEN pred.route = 'group' THEN gfit.b0 + gfit.b1 * (pred.age - gfit.mean_age)
                                        + gfit.b2 * (pred.age - gfit.mean_age) * (pred.age - gfit.mean_age)
              ELSE pfit.b0 + pfit.b1 * (pred.age - pfit.mean_age)
                   + pfit.b2 * (pred.age - pfit.mean_age) * (pred.age - pfit.mean_age) END AS predicted_rating
  FROM pred LEFT JOIN pfit ON pred.player_id = pfit.gk LEFT JOIN gfit ON pred.grp = gfit.gk
),
ga AS (
  SELECT grp.grp, avg(ch.chemistry) AS avg_chemistry, count(*) AS n_pairs
  FROM ch JOIN grp ON ch.player_id_1 = grp.player_id GROUP BY grp.grp
),
lu AS (
  SELECT CAST(g * 10 + kind AS BIGINT) AS request_id, CASE WHEN pos % 2 = 0 THEN 1 ELSE 2 END AS side,
         'p' || lpad(CAST(pos AS VARCHAR), 2, '0') AS slot, player_id, role
  FROM pl CROSS JOIN (VALUES (0), (1), (2), (3), (9)) AS kinds(kind)
  WHERE kind IN (3, 9) OR (kind = 0 AND pos <> 12) OR (kind = 1 AND pos < 9) OR (kind = 2 AND pos % 2 = 0)
  UNION ALL
  SELECT DISTINCT CAST(g * 10 + 3 AS BIGINT), 1, 'p99', NULL, NULL FROM pl
  UNION ALL
  SELECT CAST(g * 10 + 8 AS BIGINT), CASE WHEN pos IN (1, 11, 13, 14) THEN 2 ELSE 1 END, 'p' || lpad(CAST(pos AS VARCHAR), 2, '0'), player_id, role
  FROM pl WHERE g + 1 IN (SELECT g FROM pl)
  UNION ALL
  SELECT CAST((g - 1) * 10 + 8 AS BIGINT), 2, 'n' || lpad(CAST(pos AS VARCHAR), 2, '0'), player_id, role
  FROM pl WHERE pos IN (2, 3, 6, 7, 8, 9, 10) AND g - 1 IN (SELECT g FROM pl)
),
rqs AS (
  SELECT DISTINCT g, CAST(g * 10 + kind AS BIGINT) AS request_id, side
  FROM pl CROSS JOIN (VALUES (0), (1), (2), (3), (8), (9)) AS kinds(kind) CROSS JOIN (VALUES (1), (2)) AS sides(side)
  WHERE kind <> 8 OR g + 1 IN (SELECT g FROM pl)
),
lr AS (
  SELECT rqs.request_id, rqs.side, count(*) FILTER (WHERE role = 'GK') AS gk, count(*) FILTER (WHERE role = 'DF') AS df,
         count(*) FILTER (WHERE role = 'MD') AS md, count(*) FILTER (WHERE role = 'FW') AS fw,
         count(*) FILTER (WHERE slot IS NOT NULL AND player_id IS NULL) AS unknown
  FROM rqs LEFT JOIN lu ON rqs.request_id = lu.request_id AND rqs.side = lu.side
  GROUP BY rqs.request_id, rqs.side
),
lr2 AS (
  SELECT *, (gk = 1 AND df >= 2 AND md >= 2 AND fw >= 1 AND unknown = 0) AS side_valid FROM lr
),
lr3 AS (
  SELECT lr2.*, min(CAST(side_valid AS INTEGER)) OVER (PARTITION BY request_id) = 1 AS request_valid FROM lr2
),
lcp AS (
  SELECT lu.*, grp.grp, coalesce(pt.number_of_matches, 0) AS nm FROM lu LEFT JOIN pt ON lu.player_id = pt.player_id
  LEFT JOIN grp ON lu.player_id = grp.player_id
  WHERE lu.player_id IS NOT NULL
),
lcv AS (
  SELECT a.request_id, a.side, a.slot,
         CASE WHEN (a.nm >= 5 AND b.nm >= 5) OR (a.nm <= 5 AND b.nm <= 5) THEN coalesce(ch.chemistry, 0.5)
              ELSE (ga.avg_chemistry + ga.avg_chemistry) / 2 END AS v
  FROM lcp a JOIN lcp b ON a.request_id = b.request_id AND a.side = b.side AND a.player_id <> b.player_id
  LEFT JOIN ch ON ch.player_id_1 = a.player_id AND ch.player_id_2 = b.player_id
  LEFT JOIN ga ON ga.grp = a.grp
),
lc AS (
  SELECT lcp.request_id, lcp.side, lcp.slot, lcp.player_id, avg(lcv.v) AS chemistry_coefficient
  FROM lcp LEFT JOIN lcv ON lcp.request_id = lcv.request_id AND lcp.side = lcv.side AND lcp.slot = lcv.slot
  GROUP BY lcp.request_id, lcp.side, lcp.slot, lcp.player_id
),
fs AS (
  SELECT lc.request_id, count(*) = count(lc.chemistry_coefficient * pred2.predicted_rating) AS rated,
         sum(CASE WHEN lc.side = 1 THEN lc.chemistry_coefficient * pred2.predicted_rating ELSE 0.0 END) / 11.0 AS s1,
         sum(CASE WHEN lc.side = 2 THEN lc.chemistry_coefficient * pred2.predicted_rating ELSE 0.0 END) / 11.0 AS s2
  FROM lc LEFT JOIN pred2 ON lc.player_id = pred2.player_id GROUP BY lc.request_id
),
fc AS (
  SELECT rq.request_id, 'Team ' || CAST(2 * rq.g + 1 AS VARCHAR) AS team1_name,
         'Team ' || CAST(2 * rq.g + 2 AS VARCHAR) AS team2_name, v.ok = 1 AND rq.request_id % 10 <> 9 AS valid,
         v.ok = 1 AND rq.request_id % 10 <> 9 AND fs.rated AS ok, fs.s1, fs.s2
  FROM (SELECT DISTINCT g, request_id FROM rqs) rq
  LEFT JOIN (SELECT request_id, min(CAST(request_valid AS INTEGER)) AS ok FROM lr3 GROUP BY request_id) v
         ON rq.request_id = v.request_id
  LEFT JOIN fs ON rq.request_id = fs.request_id
)"""


BY_ROLE = "SELECT player_id, role AS grp FROM pl"


def _with_models(body: str, groups: str = BY_ROLE, before: str = "") -> str:
    return _with(before + _models(groups) + "\n" + body)


_COEF = (f"CAST(n_points AS BIGINT) AS n_points, CAST(degree AS INTEGER) AS degree, {R('mean_age')} AS mean_age, "
         f"{R('b0')} AS b0, {R('b1', 9)} AS b1, {R('b2', 12)} AS b2")

ORACLE["age_features"] = _with_models(f"""
SELECT player_id, CAST(match_date AS VARCHAR) AS match_date, match_id, age, CAST(age * age AS BIGINT) AS age_sq,
       {R('rating')} AS rating FROM af""")

ORACLE["rating_regression_player"] = _with_models(f"SELECT gk AS player_id, {_COEF} FROM pfit")

ORACLE["rating_regression_group"] = _with_models(f"SELECT gk AS role, {_COEF} FROM gfit")

ORACLE["rating_prediction"] = _with_models(f"""
SELECT player_id, route, {R('predicted_rating')} AS predicted_rating FROM pred2""")

ORACLE["chemistry_group_avg"] = _with_models(f"""
SELECT grp AS role, {R('avg_chemistry')} AS avg_chemistry, CAST(n_pairs AS BIGINT) AS n_pairs FROM ga""")

ORACLE["lineup_roles"] = _with_models("""
SELECT request_id, CAST(side AS INTEGER) AS side, CAST(gk AS BIGINT) AS gk, CAST(df AS BIGINT) AS df,
       CAST(md AS BIGINT) AS md, CAST(fw AS BIGINT) AS fw, CAST(unknown AS BIGINT) AS unknown,
       CAST(side_valid AS INTEGER) AS side_valid, CAST(request_valid AS INTEGER) AS request_valid
FROM lr3""")

ORACLE["lineup_chemistry"] = _with_models(f"""
SELECT request_id, CAST(side AS INTEGER) AS side, slot, player_id,
       {R('chemistry_coefficient')} AS chemistry_coefficient FROM lc""")

FORECASTS = f"""
SELECT request_id, team1_name, team2_name, CASE WHEN ok THEN 'ok' WHEN valid THEN 'Unrated' ELSE 'Invalid' END AS result,
       CASE WHEN ok THEN {R('s1')} END AS strength1, CASE WHEN ok THEN {R('s2')} END AS strength2,
       CASE WHEN ok THEN {R('(0.5 + s1 - (s1 + s2) / 2) * 100')} END AS chance1,
       CASE WHEN ok THEN {R('100.0 - (0.5 + s1 - (s1 + s2) / 2) * 100')} END AS chance2
FROM fc"""
ORACLE["match_forecast"] = _with_models(FORECASTS)

# --- clusters: Lloyd's rounds as one CTE each ------------------------------------------------

FEATURES = ("pass_accuracy", "number_of_goals", "number_of_own_goals", "number_of_fouls", "number_of_shots_on_target")


def _clusters(k: int = 5, rounds: int = 20) -> str:
    """CTEs ``points``, ``c0`` to ``c{rounds}`` (centres), ``near`` (player_id, prediction): the
    first centres are the profiles with the smallest md5 of a player id, an empty cluster
    keeps its centre, the first of equally near centres counts."""
    cols = ", ".join(FEATURES)

    def nearest(centres: str) -> str:
        away = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in FEATURES)
        return (f"SELECT p.player_id, {', '.join(f'any_value(p.{f}) AS {f}' for f in FEATURES)}, arg_min(c.i, round({away}, 6) * 1000 + c.i) AS i\n"
                f"  FROM points p CROSS JOIN {centres} c GROUP BY p.player_id")

    steps = [f""",
points AS MATERIALIZED (SELECT player_id, {', '.join(f'CAST({f} AS DOUBLE) AS {f}' for f in FEATURES)} FROM pt),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS i, {cols}
  FROM (SELECT min(md5(player_id)) AS h, {cols} FROM points GROUP BY {cols} ORDER BY h LIMIT {k}))"""]
    for r in range(rounds):
        steps.append(f""",
c{r + 1} AS MATERIALIZED (
  SELECT c.i, {', '.join(f'coalesce(m.{f}, c.{f}) AS {f}' for f in FEATURES)}
  FROM c{r} c LEFT JOIN (SELECT i, {', '.join(f'avg({f}) AS {f}' for f in FEATURES)} FROM ({nearest(f'c{r}')}) GROUP BY i) m ON m.i = c.i)""")
    steps.append(f""",
near AS MATERIALIZED (SELECT player_id, i AS prediction FROM ({nearest(f'c{rounds}')}))""")
    return "".join(steps)


CLUSTERS = _clusters()
BY_CLUSTER = "SELECT player_id, prediction AS grp FROM near"

ORACLE["cluster_features"] = _with(f"""
SELECT player_id, {R('pass_accuracy')} AS pass_accuracy, CAST(number_of_goals AS DOUBLE) AS number_of_goals,
       CAST(number_of_own_goals AS DOUBLE) AS number_of_own_goals, CAST(number_of_fouls AS DOUBLE) AS number_of_fouls,
       CAST(number_of_shots_on_target AS DOUBLE) AS number_of_shots_on_target FROM pt""")

ORACLE["player_clusters"] = _with(CLUSTERS + """
SELECT pt.player_id, pt.number_of_matches, CAST(pt.birth_date AS VARCHAR) AS birth_date, CAST(near.prediction AS INTEGER) AS prediction
FROM pt JOIN near ON pt.player_id = near.player_id""")

ORACLE["cluster_centres"] = _with(CLUSTERS + f"""
SELECT CAST(i AS INTEGER) AS prediction, {', '.join(f'{R(f)} AS {f}' for f in FEATURES)} FROM c20""")

_AWAY = " + ".join(f"(p.{f} - c.{f}) * (p.{f} - c.{f})" for f in FEATURES)
ORACLE["cluster_invariants"] = _with(CLUSTERS + f"""
, away AS (SELECT p.player_id, c.i, {_AWAY} AS d FROM points p CROSS JOIN c20 c),
best AS (SELECT player_id, min(d) AS least FROM away GROUP BY player_id)
SELECT count(*) AS players, count(near.prediction) AS assigned,
       count(*) FILTER (WHERE near.prediction < 0 OR near.prediction >= 5) AS out_of_range,
       count(*) FILTER (WHERE away.d > best.least * (1 + 1e-9) + 1e-6) AS not_nearest
FROM pt LEFT JOIN near ON pt.player_id = near.player_id
LEFT JOIN away ON away.player_id = near.player_id AND away.i = near.prediction
LEFT JOIN best ON best.player_id = near.player_id""")

ORACLE["cluster_chemistry"] = _with(CLUSTERS + f"""
SELECT CAST(near.prediction AS INTEGER) AS prediction, {R('avg(ch.chemistry)')} AS avg_chemistry, CAST(count(*) AS BIGINT) AS n_pairs
FROM ch JOIN near ON ch.player_id_1 = near.player_id GROUP BY near.prediction""")

ORACLE["rating_regression_cluster"] = _with_models(f"SELECT CAST(gk AS INTEGER) AS prediction, {_COEF} FROM gfit", BY_CLUSTER, CLUSTERS)

ORACLE["match_forecast_clusters"] = _with_models(FORECASTS, BY_CLUSTER, CLUSTERS)

ORACLE["cluster_chemistry_totals"] = _with(f"""
SELECT CAST(count(*) AS BIGINT) AS n_pairs, {R('sum(chemistry)', 4)} AS sum_chemistry FROM ch""")
