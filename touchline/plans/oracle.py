"""DuckDB SQL for every registered query (the independent oracle).

The CTEs restate ``plans/bindings.py`` in SQL; each query is ``WITH <ctes> SELECT ...``. Doubles
are rounded to 6 decimals and integers cast to BIGINT on both sides.
"""

from __future__ import annotations

FIXTURES_CTE = """
fx0 AS (
  SELECT o.o_orderkey AS id, o.o_orderdate AS kickoff, o.o_custkey AS home_team,
         (o.o_orderkey * 31 + 7) % nc.n AS away_team,
         CAST(floor(o.o_totalprice) AS BIGINT) AS p
  FROM orders o CROSS JOIN (SELECT count(*) AS n FROM customer) nc
),
fx AS (
  SELECT id, kickoff, home_team, away_team,
         (id * 7 + p) % 5 AS fthg, (id * 3 + p) % 4 AS ftag,
         CASE WHEN id % 97 = 0 THEN NULL ELSE id % 23 END AS referee,
         (id * 11) % 5 AS hy, (id * 13 + 1) % 6 AS ay, (id * 17) % 15 + 5 AS hf, (id * 19 + 3) % 15 + 5 AS af,
         (id * 23 + p) % 20 + 2 AS hs, (id * 29 + p) % 18 + 1 AS as_, (id * 7 + p) % 8 AS hst, (id * 5 + p) % 7 AS ast,
         (id * 17) % 11 AS hc, (id * 19) % 10 AS ac, CASE WHEN id % 41 = 0 THEN 1 ELSE 0 END AS hr,
         CASE WHEN id % 43 = 0 THEN 1 ELSE 0 END AS ar,
         1.2 + CAST((id * 37 + p) % 40 AS DOUBLE) / 10 AS b365h,
         2.5 + CAST((id * 41) % 20 AS DOUBLE) / 10 AS b365d,
         1.5 + CAST((id * 43 + p) % 50 AS DOUBLE) / 10 AS b365a,
         1.25 + CAST((id * 47 + p) % 38 AS DOUBLE) / 10 AS bwh,
         2.6 + CAST((id * 53) % 18 AS DOUBLE) / 10 AS bwd,
         1.45 + CAST((id * 59 + p) % 48 AS DOUBLE) / 10 AS bwa
  FROM fx0 WHERE home_team <> away_team
),
fixtures AS (
  SELECT *, greatest(b365h, bwh) + 0.1 AS maxh, greatest(b365d, bwd) + 0.1 AS maxd, greatest(b365a, bwa) + 0.1 AS maxa,
         (b365h + bwh) / 2 AS avgh, (b365d + bwd) / 2 AS avgd, (b365a + bwa) / 2 AS avga,
         CASE WHEN fthg > ftag THEN 'H' WHEN fthg = ftag THEN 'D' ELSE 'A' END AS ftr,
         CAST(fthg + ftag AS DOUBLE) AS total_goals,
         CASE WHEN fthg > ftag THEN 1 ELSE 0 END AS home_win
  FROM fx
)"""

TEAM_LONG_CTE = """
team_long AS (
  SELECT id, kickoff, ftr, CAST(home_team AS BIGINT) AS team, CAST(fthg AS DOUBLE) AS goals_for, CAST(ftag AS DOUBLE) AS goals_against, 1 AS is_home,
         CAST(CASE WHEN ftr = 'H' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) AS points
  FROM fixtures
  UNION ALL
  SELECT id, kickoff, ftr, CAST(away_team AS BIGINT), CAST(ftag AS DOUBLE), CAST(fthg AS DOUBLE), 0,
         CAST(CASE WHEN ftr = 'A' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE)
  FROM fixtures
)"""

EVENTS_CTE = """
ev0 AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type AS et, e.value,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS k
  FROM events e
),
play_events AS (
  SELECT ev0.event_id AS id, ev0.user_id AS match_id, ev0.ts,
         CAST(minute(ev0.ts) AS INTEGER) AS minute, CAST(second(ev0.ts) AS INTEGER) AS second,
         CASE WHEN et = 'click' THEN 'Pass' WHEN et = 'view' THEN 'BallTouch' WHEN et = 'signup' THEN 'Tackle'
              WHEN et = 'purchase' AND value >= 150.0 THEN 'Goal' WHEN et = 'purchase' THEN 'SavedShot'
              ELSE 'MissedShots' END AS event_type,
         CASE WHEN value >= 20 THEN 'Successful' ELSE 'Unsuccessful' END AS outcome,
         CAST(CASE WHEN ev0.event_id % 2 = 0 THEN f.home_team ELSE f.away_team END AS VARCHAR) AS team_name,
         CASE WHEN ev0.event_id % 13 = 0 THEN NULL
              ELSE CAST(CASE WHEN ev0.event_id % 2 = 0 THEN f.home_team ELSE f.away_team END AS VARCHAR) || '_' || CAST(ev0.event_id % 7 AS VARCHAR) END AS player_name,
         CAST(k AS DOUBLE) AS x,
         CAST((k * 37 + ev0.event_id) % 101 AS DOUBLE) AS y,
         CASE WHEN et = 'click' AND k % 3 <> 0 THEN least(CAST(k + ev0.event_id % 40 AS DOUBLE), 100.0) END AS end_x,
         CASE WHEN et IN ('click', 'view', 'purchase', 'error') THEN 1 ELSE 0 END AS is_touch,
         CASE WHEN et IN ('purchase', 'error') THEN 1 ELSE 0 END AS is_shot,
         CASE WHEN et = 'purchase' AND value >= 150.0 THEN 1 ELSE 0 END AS is_goal,
         k
  FROM ev0 LEFT JOIN fixtures f ON ev0.user_id = f.id
),
qual AS (
  SELECT event_id AS id, lower(concat_ws(' ',
      CASE WHEN k % 5 = 0 THEN 'BigChance' END,
      CASE WHEN k % 7 = 1 THEN 'Head' END,
      CASE WHEN k % 2 = 0 AND k % 7 <> 1 THEN 'RightFoot' END,
      CASE WHEN k % 2 = 1 AND k % 7 <> 1 THEN 'LeftFoot' END,
      CASE WHEN k % 23 = 3 THEN 'Penalty' END,
      CASE WHEN k % 11 = 2 THEN 'FastBreak' END,
      CASE WHEN k % 13 = 4 THEN 'FromCorner' END,
      CASE WHEN k % 17 = 5 THEN 'Volley' END,
      CASE WHEN k % 3 = 0 THEN 'FirstTouch' END,
      CASE WHEN k % 8 = 6 THEN 'SmallBoxCentre' END,
      CASE WHEN k % 4 = 1 THEN 'BoxCentre' END,
      CASE WHEN k % 4 = 3 THEN 'OutOfBoxCentre' END,
      CASE WHEN event_id % 3 = 0 THEN 'Assisted' END,
      CASE WHEN event_id % 6 = 0 THEN 'IntentionalAssist' END,
      CASE WHEN event_id % 3 = 1 THEN 'IndividualPlay' END,
      CASE WHEN event_id % 5 <> 0 THEN 'RegularPlay' END,
      CASE WHEN event_id % 5 = 0 THEN 'SetPiece' END,
      CASE WHEN event_id % 10 = 5 THEN 'DirectFreekick' END,
      CASE WHEN event_id % 20 = 0 THEN 'ThrowinSetPiece' END,
      'Zone', CASE WHEN k % 3 = 0 THEN 'Center' WHEN k % 3 = 1 THEN 'Left' ELSE 'Right' END,
      CASE WHEN event_id % 2 = 0 THEN 'GoalMouthY' END,
      CASE WHEN event_id % 2 = 0 THEN CAST((k * 37 + event_id) % 101 AS VARCHAR) END,
      CASE WHEN k % 9 = 0 THEN 'Angle' END)) AS qualifier_text
  FROM ev0 WHERE et IN ('purchase', 'error') AND event_id % 19 <> 0
)"""

POINTS_CTE = """
points AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity * 2 AS x, l_discount * 1000 AS y FROM lineitem
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)
