"""Registered queries over the play-event binding (events): shot enrichment and team-match stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators import shots as S
from touchline.operators.features import DIFF_BASES, TEAM_FORM_COLUMNS
from touchline.plans import bindings
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, with_ctes
from touchline.plans.registry import normalise, query

SHOTS_CTE = """
shots0 AS (
  SELECT e.id, e.match_id, e.minute, e.second, e.event_type, e.is_goal, e.x AS x0, e.y AS y0,
         trim(coalesce(e.team_name, '')) AS team_name,
         coalesce(nullif(e.player_name, ''), 'Jugador no identificado') AS player_name,
         coalesce(q.qualifier_text, '') AS qualifier_text,
         f.kickoff, CAST(f.home_team AS VARCHAR) AS home_team
  FROM play_events e LEFT JOIN qual q ON e.id = q.id LEFT JOIN fixtures f ON e.match_id = f.id
  WHERE e.is_shot = 1
),
g1 AS (
  SELECT *, CASE WHEN x0 < 50 THEN 100 - x0 ELSE x0 END AS x, CASE WHEN x0 < 50 THEN 100 - y0 ELSE y0 END AS y,
         CASE WHEN x0 < 50 THEN 1 ELSE 0 END AS was_normalized
  FROM shots0
),
g2 AS (SELECT *, (100 - x) / 100 * 105.0 AS lon, (y - 50) / 100 * 68.0 AS slat FROM g1),
g3 AS (
  SELECT *, sqrt(lon * lon + abs(slat) * abs(slat)) AS distance_to_goal_m,
         sqrt(lon * lon + (slat - 3.66) * (slat - 3.66)) AS lp, sqrt(lon * lon + (slat + 3.66) * (slat + 3.66)) AS rp
  FROM g2
),
g4 AS (
  SELECT *, acos(greatest(least(CASE WHEN 2 * lp * rp > 0 THEN (lp * lp + rp * rp - 7.32 * 7.32) / (2 * lp * rp) ELSE 1.0 END, 1.0), -1.0)) AS goal_frame_angle,
         CASE WHEN strpos(qualifier_text, 'bigchance') > 0 THEN 1 ELSE 0 END AS is_big_chance,
         CASE WHEN strpos(qualifier_text, 'head') > 0 THEN 1 ELSE 0 END AS is_header,
         CASE WHEN strpos(qualifier_text, 'rightfoot') > 0 THEN 1 ELSE 0 END AS is_right_foot,
         CASE WHEN strpos(qualifier_text, 'leftfoot') > 0 THEN 1 ELSE 0 END AS is_left_foot,
         CASE WHEN strpos(qualifier_text, 'penalty') > 0 THEN 1 ELSE 0 END AS is_penalty,
         CASE WHEN strpos(qualifier_text, 'assisted') > 0 THEN 1 ELSE 0 END AS is_assisted,
         CASE WHEN strpos(qualifier_text, 'setpiece') > 0 THEN 1 ELSE 0 END AS is_set_piece,
         CASE WHEN strpos(qualifier_text, 'throwinsetpiece') > 0 THEN 1 ELSE 0 END AS is_throwin_set_piece,
         CASE WHEN event_type IN ('SavedShot', 'Goal') THEN 1 ELSE 0 END AS shot_on_target,
         minute * 60 + second AS game_clock_s,
         greatest(least(minute / 95.0, 1.25), 0.0) AS game_minute_normalized,
         CASE WHEN team_name = home_team THEN 1 ELSE 0 END AS is_home_team
  FROM g3
),
g5 AS (
  SELECT *, CASE WHEN is_home_team = 1 AND is_goal = 1 THEN 1 ELSE 0 END AS hge,
         CASE WHEN is_home_team = 0 AND is_goal = 1 THEN 1 ELSE 0 END AS age
  FROM g4
),
shots AS (
  SELECT *,
    row_number() OVER wm AS shot_number_in_match,
    game_clock_s - coalesce(lag(game_clock_s) OVER wm, 0) AS time_since_prev_match_shot_s,
    coalesce(sum(hge) OVER (wm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS home_goals_before_shot,
    coalesce(sum(age) OVER (wm ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS away_goals_before_shot,
    row_number() OVER wt AS team_shot_number_in_match,
    game_clock_s - coalesce(lag(game_clock_s) OVER wt, 0) AS time_since_prev_team_shot_s,
    row_number() OVER wp AS player_shot_number_in_match,
    row_number() OVER pl - 1 AS player_shots_before,
    sum(CAST(is_goal AS DOUBLE)) OVER (pl ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS player_goals_last20,
    avg(CAST(is_goal AS DOUBLE)) OVER (pl ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS player_conversion_last20,
    avg(distance_to_goal_m) OVER (pl ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS player_avg_distance_last20,
    row_number() OVER tm - 1 AS team_shots_before,
    sum(CAST(is_goal AS DOUBLE)) OVER (tm ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS team_goals_last40,
    avg(CAST(is_big_chance AS DOUBLE)) OVER (tm ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS team_big_chance_rate_last40,
    avg(distance_to_goal_m) OVER (tm ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS team_avg_distance_last40
  FROM g5
  WINDOW wm AS (PARTITION BY match_id ORDER BY kickoff, match_id, minute, second, id),
         wt AS (PARTITION BY match_id, team_name ORDER BY kickoff, match_id, minute, second, id),
         wp AS (PARTITION BY match_id, player_name ORDER BY kickoff, match_id, minute, second, id),
         pl AS (PARTITION BY player_name ORDER BY kickoff, match_id, minute, second, id),
         tm AS (PARTITION BY team_name ORDER BY kickoff, match_id, minute, second, id)
)"""

_SHOT_COLS = ["id", "match_id", "team_name", "player_name", "is_goal", "qualifier_text", "x", "y", "was_normalized",
              "distance_to_goal_m", "goal_frame_angle", "is_big_chance", "is_header", "is_penalty", "is_set_piece",
              "is_throwin_set_piece", "shot_on_target", "game_clock_s", "game_minute_normalized", "is_home_team",
              "shot_number_in_match", "time_since_prev_match_shot_s", "team_shot_number_in_match",
              "time_since_prev_team_shot_s", "player_shot_number_in_match", "home_goals_before_shot",
              "away_goals_before_shot", "score_diff_before_shot", "leading_before_shot", "trailing_before_shot",
              "player_shots_before", "player_goals_last20", "player_conversion_last20", "player_avg_distance_last20",
              "team_shots_before", "team_goals_last40", "team_big_chance_rate_last40", "team_avg_distance_last40", "date"]

_ENRICHED_SQL = with_ctes(FIXTURES_CTE, EVENTS_CTE, SHOTS_CTE) + """
SELECT id, match_id, team_name, player_name, CAST(is_goal AS BIGINT) AS is_goal, qualifier_text,
       round(x, 6) AS x, round(y, 6) AS y, CAST(was_normalized AS BIGINT) AS was_normalized,
       round(distance_to_goal_m, 6) AS distance_to_goal_m, round(goal_frame_angle, 6) AS goal_frame_angle,
       CAST(is_big_chance AS BIGINT) AS is_big_chance, CAST(is_header AS BIGINT) AS is_header,
       CAST(is_penalty AS BIGINT) AS is_penalty, CAST(is_set_piece AS BIGINT) AS is_set_piece,
       CAST(is_throwin_set_piece AS BIGINT) AS is_throwin_set_piece, CAST(shot_on_target AS BIGINT) AS shot_on_target,
       CAST(game_clock_s AS BIGINT) AS game_clock_s, round(game_minute_normalized, 6) AS game_minute_normalized,
       CAST(is_home_team AS BIGINT) AS is_home_team,
       CAST(shot_number_in_match AS BIGINT) AS shot_number_in_match,
       CAST(time_since_prev_match_shot_s AS BIGINT) AS time_since_prev_match_shot_s,
       CAST(team_shot_number_in_match AS BIGINT) AS team_shot_number_in_match,
       CAST(time_since_prev_team_shot_s AS BIGINT) AS time_since_prev_team_shot_s,
       CAST(player_shot_number_in_match AS BIGINT) AS player_shot_number_in_match,
       CAST(home_goals_before_shot AS BIGINT) AS home_goals_before_shot,
       CAST(away_goals_before_shot AS BIGINT) AS away_goals_before_shot,
       CAST(CASE WHEN is_home_team = 1 THEN home_goals_before_shot - away_goals_before_shot
                 ELSE away_goals_before_shot - home_goals_before_shot END AS BIGINT) AS score_diff_before_shot,
       CAST(CASE WHEN (CASE WHEN is_home_team = 1 THEN home_goals_before_shot - away_goals_before_shot
                 ELSE away_goals_before_shot - home_goals_before_shot END) > 0 THEN 1 ELSE 0 END AS BIGINT) AS leading_before_shot,
       CAST(CASE WHEN (CASE WHEN is_home_team = 1 THEN home_goals_before_shot - away_goals_before_shot
                 ELSE away_goals_before_shot - home_goals_before_shot END) < 0 THEN 1 ELSE 0 END AS BIGINT) AS trailing_before_shot,
       CAST(player_shots_before AS BIGINT) AS player_shots_before,
       round(player_goals_last20, 6) AS player_goals_last20, round(player_conversion_last20, 6) AS player_conversion_last20,
       round(player_avg_distance_last20, 6) AS player_avg_distance_last20,
       CAST(team_shots_before AS BIGINT) AS team_shots_before, round(team_goals_last40, 6) AS team_goals_last40,
       round(team_big_chance_rate_last40, 6) AS team_big_chance_rate_last40,
       round(team_avg_distance_last40, 6) AS team_avg_distance_last40,
       strftime(kickoff, '%Y-%m-%d') AS date
FROM shots
"""


def enriched_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = bindings.fixtures(spark, sf_dir)
    ev = bindings.play_events(spark, sf_dir, fx)
    q = bindings.shot_qualifiers(spark, sf_dir)
    return S.enrich_shots(ev, bindings.match_context(fx), q)


@query("shots_enriched", _ENRICHED_SQL)
def shots_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J2 + X1-X5 + F1 + F5 + F7 + F8 + W3-W8 + W13 + F10."""
    return normalise(enriched_shots(spark, sf_dir).select(*_SHOT_COLS))


_TEAM_MATCH_SQL = with_ctes(FIXTURES_CTE, EVENTS_CTE, SHOTS_CTE, """
ev AS (
  SELECT e.id, e.match_id, trim(coalesce(e.team_name, '')) AS team_name, coalesce(e.event_type, '') AS event_type,
         coalesce(e.outcome, '') AS outcome, e.x, e.end_x, e.is_shot, e.is_goal, e.is_touch,
         coalesce(s.is_big_chance, 0) AS is_big_chance, coalesce(s.is_penalty, 0) AS is_penalty,
         coalesce(s.shot_on_target, 0) AS shot_on_target, coalesce(s.is_assisted, 0) AS is_assisted,
         s.distance_to_goal_m, s.goal_frame_angle,
         CASE WHEN s.id IS NULL THEN NULL WHEN s.is_home_team = 1 THEN s.home_goals_before_shot - s.away_goals_before_shot
              ELSE s.away_goals_before_shot - s.home_goals_before_shot END AS score_diff_before_shot
  FROM play_events e LEFT JOIN shots s ON e.id = s.id
),
g AS (
  SELECT match_id, team_name,
    CAST(sum(CASE WHEN event_type = 'Pass' THEN 1 ELSE 0 END) AS BIGINT) AS passes_attempted,
    CAST(sum(CASE WHEN event_type = 'Pass' AND outcome = 'Successful' THEN 1 ELSE 0 END) AS BIGINT) AS passes_completed,
    CAST(sum(CASE WHEN event_type = 'Pass' AND coalesce(end_x, x) - coalesce(x, 0.0) >= 15 THEN 1 ELSE 0 END) AS BIGINT) AS progressive_passes,
    CAST(sum(CASE WHEN event_type = 'Pass' AND coalesce(end_x, 0.0) >= 66 THEN 1 ELSE 0 END) AS BIGINT) AS final_third_passes,
    CAST(sum(is_shot) AS BIGINT) AS shots, CAST(sum(shot_on_target) AS BIGINT) AS shots_on_target,
    CAST(sum(is_big_chance) AS BIGINT) AS big_chances, CAST(sum(is_penalty) AS BIGINT) AS penalties,
    CAST(sum(is_assisted) AS BIGINT) AS assisted_shots, CAST(sum(is_goal) AS BIGINT) AS goals,
    CAST(sum(is_touch) AS BIGINT) AS touches,
    coalesce(avg(distance_to_goal_m), 0.0) AS avg_shot_distance, coalesce(avg(goal_frame_angle), 0.0) AS avg_shot_angle,
    coalesce(avg(score_diff_before_shot), 0.0) AS avg_score_diff_before_shot
  FROM ev GROUP BY match_id, team_name
)""") + """
SELECT g.match_id, g.team_name, passes_attempted, passes_completed, progressive_passes, final_third_passes, shots,
       shots_on_target, big_chances, penalties, assisted_shots, goals, touches,
       round(avg_shot_distance, 6) AS avg_shot_distance, round(avg_shot_angle, 6) AS avg_shot_angle,
       round(avg_score_diff_before_shot, 6) AS avg_score_diff_before_shot,
       round(CASE WHEN passes_attempted > 0 THEN passes_completed / passes_attempted ELSE 0.0 END, 6) AS pass_accuracy,
       round(CASE WHEN passes_attempted > 0 THEN progressive_passes / passes_attempted ELSE 0.0 END, 6) AS progressive_pass_rate,
       round(CASE WHEN shots > 0 THEN shots_on_target / shots ELSE 0.0 END, 6) AS shot_accuracy,
       round(CASE WHEN shots > 0 THEN goals / shots ELSE 0.0 END, 6) AS conversion_rate,
       round(CASE WHEN shots > 0 THEN big_chances / shots ELSE 0.0 END, 6) AS big_chance_rate,
       round(CASE WHEN shots > 0 THEN assisted_shots / shots ELSE 0.0 END, 6) AS assisted_shot_rate,
       round(CASE WHEN shots > 0 THEN touches / shots ELSE CAST(touches AS DOUBLE) END, 6) AS touches_per_shot,
       CAST(CASE WHEN g.team_name = CAST(f.home_team AS VARCHAR) THEN f.away_team ELSE f.home_team END AS VARCHAR) AS opponent,
       CAST(CASE WHEN g.team_name = CAST(f.home_team AS VARCHAR) THEN 1 ELSE 0 END AS BIGINT) AS is_home
FROM g LEFT JOIN fixtures f ON g.match_id = f.id
"""


@query("team_match_stats", _TEAM_MATCH_SQL)
def team_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A4 + J3 + J4 over all play events."""
    fx = bindings.fixtures(spark, sf_dir)
    ev = bindings.play_events(spark, sf_dir, fx)
    q = bindings.shot_qualifiers(spark, sf_dir)
    ctx = bindings.match_context(fx)
    shots = S.enrich_shots(ev, ctx, q)
    res = S.team_match_stats(ev, shots, ctx)
    cols = ["match_id", "team_name"] + [o for o, _ in S.TEAM_MATCH_SUMS] + [o for o, _ in S.TEAM_MATCH_MEANS] + [
        "pass_accuracy", "progressive_pass_rate", "shot_accuracy", "conversion_rate", "big_chance_rate",
        "assisted_shot_rate", "touches_per_shot", "opponent", "is_home"]
    return normalise(res.select(*cols).withColumn("opponent", F.col("opponent").cast("string")))


_FORM_EVENT_COLS = TEAM_FORM_COLUMNS
_EVENT_FORM_COLS = [c for c in TEAM_FORM_COLUMNS if c not in ("goals_for", "goals_against", "points")]

_FORM_EVENTS_SQL = _TEAM_MATCH_SQL.split("\nSELECT g.match_id")[0] + """,
tm AS (
  SELECT g.*, CAST(g.team_name AS BIGINT) AS team,
         CASE WHEN passes_attempted > 0 THEN passes_completed / passes_attempted ELSE 0.0 END AS pass_accuracy,
         CASE WHEN passes_attempted > 0 THEN progressive_passes / passes_attempted ELSE 0.0 END AS progressive_pass_rate,
         CASE WHEN shots > 0 THEN shots_on_target / shots ELSE 0.0 END AS shot_accuracy,
         CASE WHEN shots > 0 THEN goals / shots ELSE 0.0 END AS conversion_rate,
         CASE WHEN shots > 0 THEN big_chances / shots ELSE 0.0 END AS big_chance_rate,
         CASE WHEN shots > 0 THEN assisted_shots / shots ELSE 0.0 END AS assisted_shot_rate,
         CASE WHEN shots > 0 THEN touches / shots ELSE CAST(touches AS DOUBLE) END AS touches_per_shot
  FROM g
),
tl AS (
  SELECT id, kickoff, CAST(home_team AS BIGINT) AS team, 1 AS is_home, CAST(fthg AS DOUBLE) AS goals_for, CAST(ftag AS DOUBLE) AS goals_against,
         CAST(CASE WHEN ftr = 'H' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) AS points FROM fixtures
  UNION ALL
  SELECT id, kickoff, CAST(away_team AS BIGINT), 0, CAST(ftag AS DOUBLE), CAST(fthg AS DOUBLE),
         CAST(CASE WHEN ftr = 'A' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) FROM fixtures
),
h AS (
  SELECT tl.id, tl.is_home, avg(tl.goals_for) OVER w AS goals_for_last5, avg(tl.goals_against) OVER w AS goals_against_last5,
         avg(tl.points) OVER w AS points_last5""" + "".join(f", avg(CAST(tm.{c} AS DOUBLE)) OVER w AS {c}_last5" for c in _EVENT_FORM_COLS) + """
  FROM tl LEFT JOIN tm ON tm.match_id = tl.id AND tm.team = tl.team
  WINDOW w AS (PARTITION BY tl.team ORDER BY tl.kickoff, tl.id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
),
wd AS (
  SELECT id,""" + ",".join(
    f"\n         max(CASE WHEN is_home = 1 THEN {c}_last5 END) AS home_{c}_last5, max(CASE WHEN is_home = 0 THEN {c}_last5 END) AS away_{c}_last5"
    for c in _FORM_EVENT_COLS) + """
  FROM h GROUP BY id
)
SELECT f.id,""" + ",".join(
    f"\n       round(home_{c}_last5, 6) AS home_{c}_last5, round(away_{c}_last5, 6) AS away_{c}_last5"
    + (f", round(home_{c}_last5 - away_{c}_last5, 6) AS {c}_diff_last5" if c in DIFF_BASES else "") for c in _FORM_EVENT_COLS) + """
FROM fixtures f LEFT JOIN wd ON f.id = wd.id
"""


@query("fixture_form_with_events", _FORM_EVENTS_SQL)
def fixture_form_with_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feature pipeline: play events -> shot enrichment -> team-match stats (A1-A4) ->
    left join into the team history (J5) -> trailing means (W9) -> fold to fixtures (J6) -> differences (R3)."""
    from touchline.operators import features
    fx = bindings.fixtures(spark, sf_dir)
    ev = bindings.play_events(spark, sf_dir, fx)
    ctx = bindings.match_context(fx)
    stats = S.team_match_stats(ev, S.enrich_shots(ev, ctx, bindings.shot_qualifiers(spark, sf_dir)), ctx)
    stats = stats.withColumn("team_name", F.col("team_name").cast("long"))
    res = features.fixture_features(fx, stats)
    cols = ["id"] + [f"{side}_{c}_last5" for c in _FORM_EVENT_COLS for side in ("home", "away")] + [f"{c}_diff_last5" for c in DIFF_BASES]
    return normalise(res.select(*cols))


_FORM_STATE_SQL = _FORM_EVENTS_SQL.split(",\nh AS (")[0] + """,
sp AS (SELECT *, row_number() OVER (ORDER BY kickoff, id) - 1 AS i, count(*) OVER () AS rows FROM fixtures),
tt AS (SELECT *, i < greatest(CAST(floor(rows * 0.8) AS BIGINT), 1) AS is_train FROM sp),
st AS (SELECT tl.team, tl.kickoff, tl.id, tl.goals_for, tl.goals_against, tl.points""" + "".join(f", CAST(tm.{c} AS DOUBLE) AS {c}" for c in _EVENT_FORM_COLS) + """
       FROM tl JOIN tt ON tt.id = tl.id AND tt.is_train LEFT JOIN tm ON tm.match_id = tl.id AND tm.team = tl.team),
ff AS (SELECT team""" + "".join(f", avg({c}) AS {c}" for c in _FORM_EVENT_COLS) + """
       FROM (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY team ORDER BY kickoff DESC, id DESC) <= 5) GROUP BY team),
rf AS (SELECT referee, avg(hy + ay) AS y, avg(hf + af) AS fo, avg(total_goals) AS g, avg(home_win) AS hw
       FROM (SELECT * FROM tt WHERE is_train AND referee IS NOT NULL QUALIFY row_number() OVER (PARTITION BY referee ORDER BY kickoff DESC, id DESC) <= 10) GROUP BY referee)
SELECT n.id""" + "".join(f", round(h.{c}, 6) AS home_{c}_last5, round(a.{c}, 6) AS away_{c}_last5"
                         + (f", round(h.{c} - a.{c}, 6) AS {c}_diff_last5" if c in DIFF_BASES else "") for c in _FORM_EVENT_COLS) + """,
       round(y, 6) AS ref_avg_yellows_last10, round(fo, 6) AS ref_avg_fouls_last10, round(g, 6) AS ref_avg_goals_last10, round(hw, 6) AS ref_home_win_rate_last10
FROM tt n LEFT JOIN ff h ON h.team = n.home_team LEFT JOIN ff a ON a.team = n.away_team LEFT JOIN rf USING (referee) WHERE NOT n.is_train
"""


@query("future_fixture_state", _FORM_STATE_SQL)
def future_fixture_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 + W9 + W10: the holdout fixtures as requests, all 18 form bases and the referee read from states that are
    built from the first training fixtures and updated with the others."""
    from touchline.operators import features, form_state
    fx = bindings.fixtures(spark, sf_dir)
    ev, ctx = bindings.play_events(spark, sf_dir, fx), bindings.match_context(fx)
    stats = S.team_match_stats(ev, S.enrich_shots(ev, ctx, bindings.shot_qualifiers(spark, sf_dir)), ctx)
    stats = stats.withColumn("team_name", F.col("team_name").cast("long"))
    both = bindings.with_time_split(fx).checkpoint(eager=True)
    train, asked = both.filter("is_train"), both.filter("not is_train").select("id", "kickoff", "home_team", "away_team", "referee")
    rows, columns = form_state.team_rows(train, stats)
    rows = rows.checkpoint(eager=True)  # read twice: first part and update
    older = F.pmod(F.col("id"), F.lit(3)) > 0  # any split gives the same state
    teams = form_state.merge(form_state.build(rows.filter(older), "team", columns, 5), form_state.build(rows.filter(~older), "team", columns, 5), "team", 5)
    referees = form_state.merge(form_state.referee_state(train.filter(older)), form_state.referee_state(train.filter(~older)), "referee", 10)
    res = form_state.request_features(asked, teams, referees)
    cols = [f"{side}_{c}_last5" for c in _FORM_EVENT_COLS for side in ("home", "away")] + [f"{c}_diff_last5" for c in DIFF_BASES]
    return normalise(res.select("id", *cols, *features.REFEREE_TARGETS.values()))


@query("team_profile_inputs", _TEAM_MATCH_SQL.split("\nSELECT g.match_id")[0] + """,
hm AS (SELECT CAST(home_team AS VARCHAR) AS team, avg(fthg) AS goals_home, avg(ftag) AS ga_home FROM fixtures GROUP BY 1),
aw AS (SELECT CAST(away_team AS VARCHAR) AS team, avg(ftag) AS goals_away, avg(fthg) AS ga_away FROM fixtures GROUP BY 1),
ex AS (SELECT team_name AS team, avg(CASE WHEN passes_attempted > 0 THEN passes_completed / passes_attempted ELSE 0.0 END) AS pass_accuracy,
              avg(big_chances) AS big_chances FROM g GROUP BY 1),
k AS (SELECT team FROM hm UNION SELECT team FROM aw UNION SELECT team FROM ex)
SELECT k.team, round((coalesce(goals_home, 0) + coalesce(goals_away, 0)) / 2, 6) AS goals_scored_avg,
       round((coalesce(ga_home, 0) + coalesce(ga_away, 0)) / 2, 6) AS goals_conceded_avg, round(coalesce(pass_accuracy, 0), 6) AS pass_accuracy,
       round(coalesce(big_chances, 0), 6) AS big_chances
FROM k LEFT JOIN hm ON hm.team = k.team LEFT JOIN aw ON aw.team = k.team LEFT JOIN ex ON ex.team = k.team
""")
def team_profile_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21 + J9 (all three tables): home, away and event aggregates per team by full outer joins."""
    from touchline.operators import aggregate as A
    fx = bindings.fixtures(spark, sf_dir)
    ev, ctx = bindings.play_events(spark, sf_dir, fx), bindings.match_context(fx)
    stats = S.team_match_stats(ev, S.enrich_shots(ev, ctx, bindings.shot_qualifiers(spark, sf_dir)), ctx)
    side = lambda s: fx.withColumn("team", F.col(f"{s}_team").cast("string"))
    res = A.outer_totals([
        (side("home"), {"goals_home": F.avg("fthg"), "ga_home": F.avg("ftag")}), (side("away"), {"goals_away": F.avg("ftag"), "ga_away": F.avg("fthg")}),
        (stats.withColumnRenamed("team_name", "team"), {"pass_accuracy": F.avg("pass_accuracy"), "big_chances": F.avg("big_chances")})], "team")
    return normalise(res.select("team", ((F.col("goals_home") + F.col("goals_away")) / 2).alias("goals_scored_avg"),
                                ((F.col("ga_home") + F.col("ga_away")) / 2).alias("goals_conceded_avg"), "pass_accuracy", "big_chances"))


@query("team_series", with_ctes(FIXTURES_CTE) + """
, tl AS (SELECT id, kickoff, home_team AS team, fthg AS gf, ftag AS ga FROM fixtures UNION ALL SELECT id, kickoff, away_team, ftag, fthg FROM fixtures)
SELECT id, team, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS result,
       round(CASE WHEN count(*) OVER w >= 5 THEN avg(CAST(gf AS DOUBLE)) OVER w END, 6) AS goals_ma5
FROM tl WINDOW w AS (PARTITION BY team ORDER BY kickoff, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
""")
def team_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per team its results as W, D or L and the moving average of goals, null until five fixtures."""
    from touchline.operators import features, windows
    long = features.team_long(bindings.fixtures(spark, sf_dir)).withColumnRenamed("match_id", "id").withColumn("goals_for", F.col("goals_for").cast("double"))
    out = windows.moving_average_complete(long, "team", ["kickoff", "id"], "goals_for", 5, out="goals_ma5")
    result = F.when(F.col("goals_for") > F.col("goals_against"), "W").when(F.col("goals_for") == F.col("goals_against"), "D").otherwise("L")
    return normalise(out.select("id", "team", result.alias("result"), "goals_ma5"))
