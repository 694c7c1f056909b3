"""Registered queries over the fixture binding (orders): windows, reshape, market features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import odds as O
from touchline.operators import features, windows
from touchline.plans import bindings
from touchline.plans.oracle import FIXTURES_CTE, TEAM_LONG_CTE, with_ctes
from touchline.plans.registry import normalise, query

_FORM = ["goals_for", "goals_against", "points"]
_REF = list(features.REFEREE_TARGETS.values())
_MARKET = ["b365_home_prob", "b365_draw_prob", "b365_away_prob", "implied_prob_sum_b365", "market_favorite_strength",
           "market_entropy_b365", "odds_gap_home_away", "home_odds_dispersion", "away_odds_dispersion"]

_FLAGSHIP_SQL = with_ctes(FIXTURES_CTE, TEAM_LONG_CTE, """
hist AS (
  SELECT id, is_home,
         avg(goals_for) OVER w AS goals_for_last5, avg(goals_against) OVER w AS goals_against_last5,
         avg(points) OVER w AS points_last5
  FROM team_long WINDOW w AS (PARTITION BY team ORDER BY kickoff, id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
),
wide AS (
  SELECT id,
         max(CASE WHEN is_home = 1 THEN goals_for_last5 END) AS home_goals_for_last5,
         max(CASE WHEN is_home = 0 THEN goals_for_last5 END) AS away_goals_for_last5,
         max(CASE WHEN is_home = 1 THEN goals_against_last5 END) AS home_goals_against_last5,
         max(CASE WHEN is_home = 0 THEN goals_against_last5 END) AS away_goals_against_last5,
         max(CASE WHEN is_home = 1 THEN points_last5 END) AS home_points_last5,
         max(CASE WHEN is_home = 0 THEN points_last5 END) AS away_points_last5
  FROM hist GROUP BY id
),
ref AS (
  SELECT id,
         CASE WHEN referee IS NULL THEN NULL ELSE avg(CAST(hy + ay AS DOUBLE)) OVER r END AS ref_avg_yellows_last10,
         CASE WHEN referee IS NULL THEN NULL ELSE avg(CAST(hf + af AS DOUBLE)) OVER r END AS ref_avg_fouls_last10,
         CASE WHEN referee IS NULL THEN NULL ELSE avg(total_goals) OVER r END AS ref_avg_goals_last10,
         CASE WHEN referee IS NULL THEN NULL ELSE avg(CAST(home_win AS DOUBLE)) OVER r END AS ref_home_win_rate_last10
  FROM fixtures WINDOW r AS (PARTITION BY referee ORDER BY kickoff, id ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
),
mk AS (
  SELECT id, 1 / b365h AS ph, 1 / b365d AS pd, 1 / b365a AS pa FROM fixtures
),
mk2 AS (
  SELECT id, ph, pd, pa, ph / greatest(ph + pd + pa, 1e-9) AS nh, pd / greatest(ph + pd + pa, 1e-9) AS nd,
         pa / greatest(ph + pd + pa, 1e-9) AS na FROM mk
)
SELECT f.id, f.home_team, f.away_team, f.ftr,
       CAST(CASE f.ftr WHEN 'H' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS BIGINT) AS result_code,
       round(w.home_goals_for_last5, 6) AS home_goals_for_last5, round(w.away_goals_for_last5, 6) AS away_goals_for_last5,
       round(w.home_goals_against_last5, 6) AS home_goals_against_last5, round(w.away_goals_against_last5, 6) AS away_goals_against_last5,
       round(w.home_points_last5, 6) AS home_points_last5, round(w.away_points_last5, 6) AS away_points_last5,
       round(w.home_goals_for_last5 - w.away_goals_for_last5, 6) AS goals_for_diff_last5,
       round(w.home_goals_against_last5 - w.away_goals_against_last5, 6) AS goals_against_diff_last5,
       round(w.home_points_last5 - w.away_points_last5, 6) AS points_diff_last5,
       round(r.ref_avg_yellows_last10, 6) AS ref_avg_yellows_last10, round(r.ref_avg_fouls_last10, 6) AS ref_avg_fouls_last10,
       round(r.ref_avg_goals_last10, 6) AS ref_avg_goals_last10, round(r.ref_home_win_rate_last10, 6) AS ref_home_win_rate_last10,
       round(m.ph, 6) AS b365_home_prob, round(m.pd, 6) AS b365_draw_prob, round(m.pa, 6) AS b365_away_prob,
       round(m.ph + m.pd + m.pa, 6) AS implied_prob_sum_b365,
       round(greatest(m.nh, m.nd, m.na), 6) AS market_favorite_strength,
       round(-(m.nh * ln(least(greatest(m.nh, 1e-9), 1.0)) + m.nd * ln(least(greatest(m.nd, 1e-9), 1.0))
               + m.na * ln(least(greatest(m.na, 1e-9), 1.0))), 6) AS market_entropy_b365,
       round(f.b365a - f.b365h, 6) AS odds_gap_home_away,
       round(sqrt(((f.b365h - (f.b365h + f.bwh + f.maxh + f.avgh) / 4) ^ 2 + (f.bwh - (f.b365h + f.bwh + f.maxh + f.avgh) / 4) ^ 2
                  + (f.maxh - (f.b365h + f.bwh + f.maxh + f.avgh) / 4) ^ 2 + (f.avgh - (f.b365h + f.bwh + f.maxh + f.avgh) / 4) ^ 2) / 3), 6) AS home_odds_dispersion,
       round(sqrt(((f.b365a - (f.b365a + f.bwa + f.maxa + f.avga) / 4) ^ 2 + (f.bwa - (f.b365a + f.bwa + f.maxa + f.avga) / 4) ^ 2
                  + (f.maxa - (f.b365a + f.bwa + f.maxa + f.avga) / 4) ^ 2 + (f.avga - (f.b365a + f.bwa + f.maxa + f.avga) / 4) ^ 2) / 3), 6) AS away_odds_dispersion
FROM fixtures f LEFT JOIN wide w ON f.id = w.id LEFT JOIN ref r ON f.id = r.id LEFT JOIN mk2 m ON f.id = m.id
""")


def fixture_form_features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = bindings.fixtures(spark, sf_dir)
    feats = features.fixture_features(fx, None, 5, _FORM)
    cols = (["id", "home_team", "away_team", "ftr", "result_code"]
            + [f"{s}_{c}_last5" for c in _FORM for s in ("home", "away")]
            + [f"{c}_diff_last5" for c in _FORM] + _REF + _MARKET)
    return normalise(feats.select(*cols))


@query("fixture_form_features", _FLAGSHIP_SQL)
def fixture_form_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: R1 + W9 + J6 + R3 + W10 + X7-X9 on the fixture binding."""
    return fixture_form_features_df(spark, sf_dir)
