"""Shot enrichment and event-to-team-match aggregation.

``enrich_shots`` follows the reference's order of steps; all columns that share a partitioning are
computed by one window job (one shuffle per partitioning: match, (match, team), (match, player),
player, team).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import clean, geometry, text
from touchline.operators import windows
from touchline.operators.windows import WindowJob

SHOT_ORDER = ["kickoff", "match_id", "minute", "second", "id"]


def enrich_shots(events: DataFrame, matches: DataFrame, qualifiers: DataFrame | None,
                 player_window: int = 20, team_window: int = 40, normalise_teams: bool = True) -> DataFrame:
    """Shots with qualifier text, fixture context, geometry, flags, zones, sequence, score state and
    shot history.

    ``events``: play-by-play (FIXTURES A2). ``matches``: ``id, kickoff, home_team, away_team, fthg,
    ftag``. ``qualifiers``: ``id, qualifiers`` (array of structs) or None.
    """
    shots = events.filter(F.col("is_shot") == 1).withColumns({
        "match_id": F.col("match_id").cast("long"), "is_goal": F.col("is_goal").cast("int")})
    # Qualifier text by event id (left join; missing -> "")
    if qualifiers is not None:
        raw_text = dict(qualifiers.dtypes).get("qualifiers") == "string"   # JSON / Python-literal text cache
        to_text = text.qualifiers_text_lenient if raw_text else text.qualifiers_to_text
        q = qualifiers.select(F.col("id").cast("long").alias("id"), to_text("qualifiers").alias("qualifier_text"))
        shots = shots.join(q, "id", "left")
        shots = shots.withColumn("qualifier_text", F.coalesce(F.col("qualifier_text"), F.lit("")))
    else:
        shots = shots.withColumn("qualifier_text", F.lit(""))
    if normalise_teams:
        shots = shots.withColumn("team_name", clean.canonical_name("team_name"))
    shots = shots.withColumn("player_name", clean.default_name("player_name"))
    # Fixture context; key names differ, the duplicate key is not carried
    ctx = matches.select(F.col("id").alias("match_id"), "kickoff", "home_team", "away_team", "fthg", "ftag")
    shots = shots.join(ctx, "match_id", "left")

    shots = shots.withColumns(geometry.shot_geometry("x", "y"))
    shots = shots.withColumns(text.keyword_flags("qualifier_text"))
    shots = shots.withColumn("shot_on_target", text.in_set("event_type", text.ON_TARGET_TYPES))
    shots = shots.withColumn("shot_type_key", text.shot_type_key("is_penalty", "is_header", "is_left_foot", "is_right_foot"))
    shots = shots.withColumn("shot_type", text.label_map("shot_type_key", text.SHOT_TYPE_LABELS))
    shots = shots.withColumn("zone_key", geometry.zone_key("x", "y"))
    shots = shots.withColumn("zone_name", geometry.zone_name("zone_key"))
    shots = shots.withColumns(geometry.game_clock("minute", "second"))
    shots = shots.withColumn("is_home_team", (F.col("team_name") == F.col("home_team")).cast("int"))
    shots = shots.withColumns({
        "home_goal_event": ((F.col("is_home_team") == 1) & (F.col("is_goal") == 1)).cast("int"),
        "away_goal_event": ((F.col("is_home_team") == 0) & (F.col("is_goal") == 1)).cast("int"),
    })

    # One pass finds hot keys of all five partitionings (match, match+team, match+player, player, team).
    hot = windows.hot_key_rows(shots, [("match_id",), ("match_id", "team_name"), ("match_id", "player_name"),
                                       ("player_name",), ("team_name",)])

    # Per match: ordinal (W3), gap (W5), score state before the shot (W6, restarted per match).
    def per_match(w: Window):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        return {
            "shot_number_in_match": F.row_number().over(w),
            "time_since_prev_match_shot_s": F.col("game_clock_s") - F.coalesce(F.lag("game_clock_s").over(w), F.lit(0)),
            "home_goals_before_shot": F.coalesce(F.sum("home_goal_event").over(before), F.lit(0)),
            "away_goals_before_shot": F.coalesce(F.sum("away_goal_event").over(before), F.lit(0)),
        }
    shots = windows.apply_window(shots, "match_id", SHOT_ORDER, WindowJob(
        per_match, lookback=1, row_number_cols=["shot_number_in_match"],
        running_cols={"home_goals_before_shot": "home_goal_event", "away_goals_before_shot": "away_goal_event"}),
        hot_rows=hot[("match_id",)])

    def per_match_team(w: Window):
        return {
            "team_shot_number_in_match": F.row_number().over(w),
            "time_since_prev_team_shot_s": F.col("game_clock_s") - F.coalesce(F.lag("game_clock_s").over(w), F.lit(0)),
        }
    shots = windows.apply_window(shots, ["match_id", "team_name"], SHOT_ORDER, WindowJob(
        per_match_team, lookback=1, row_number_cols=["team_shot_number_in_match"]), hot_rows=hot[("match_id", "team_name")])
    shots = windows.ordinal(shots, ["match_id", "player_name"], SHOT_ORDER, "player_shot_number_in_match",
                            hot_rows=hot[("match_id", "player_name")])

    # W7
    team_goals = F.when(F.col("is_home_team") == 1, F.col("home_goals_before_shot")).otherwise(F.col("away_goals_before_shot"))
    opp_goals = F.when(F.col("is_home_team") == 1, F.col("away_goals_before_shot")).otherwise(F.col("home_goals_before_shot"))
    shots = shots.withColumns({"team_goals_before_shot": team_goals, "opponent_goals_before_shot": opp_goals})
    shots = shots.withColumn("score_diff_before_shot", F.col("team_goals_before_shot") - F.col("opponent_goals_before_shot"))
    shots = shots.withColumns({
        "leading_before_shot": (F.col("score_diff_before_shot") > 0).cast("int"),
        "drawing_before_shot": (F.col("score_diff_before_shot") == 0).cast("int"),
        "trailing_before_shot": (F.col("score_diff_before_shot") < 0).cast("int"),
    })

    # Shot history per player (window 20) and per team (window 40)
    shots = shots.withColumns({"_g": F.col("is_goal").cast("double"), "_bc": F.col("is_big_chance").cast("double")})
    shots = windows.apply_window(shots, "player_name", SHOT_ORDER, WindowJob(
        _history_job("player", player_window), lookback=player_window, row_number_cols=["player_shots_before"]),
        hot_rows=hot[("player_name",)])
    shots = windows.apply_window(shots, "team_name", SHOT_ORDER, WindowJob(
        _history_job("team", team_window), lookback=team_window, row_number_cols=["team_shots_before"]),
        hot_rows=hot[("team_name",)])
    shots = shots.drop("_g", "_bc")
    return shots.withColumn("date", text.date_text("kickoff"))


def _history_job(prefix: str, n: int):
    def build(w: Window):
        frame = w.rowsBetween(-n, -1)
        goals = F.sum("_g").over(frame)
        return {
            f"{prefix}_shots_before": F.row_number().over(w) - 1,
            f"{prefix}_goals_last{n}": F.when(F.count("_g").over(frame) > 0, goals),
            f"{prefix}_conversion_last{n}": F.avg("_g").over(frame),
            f"{prefix}_big_chance_rate_last{n}": F.avg("_bc").over(frame),
            f"{prefix}_avg_distance_last{n}": F.avg("distance_to_goal_m").over(frame),
        }
    return build


# The team-match aggregates (output, source flag or value, aggregate).
TEAM_MATCH_SUMS = [
    ("passes_attempted", "is_pass"), ("passes_completed", "successful_pass"), ("progressive_passes", "progressive_pass"),
    ("final_third_passes", "final_third_pass"), ("shots", "is_shot"), ("shots_on_target", "shot_on_target"),
    ("big_chances", "is_big_chance"), ("penalties", "is_penalty"), ("assisted_shots", "is_assisted"),
    ("goals", "is_goal"), ("touches", "is_touch"),
]
SHOT_FLAGS = ("shot_on_target", "is_big_chance", "is_penalty", "is_assisted")
TEAM_MATCH_MEANS = [("avg_shot_distance", "distance_to_goal_m"), ("avg_shot_angle", "goal_frame_angle"),
                    ("avg_score_diff_before_shot", "score_diff_before_shot")]


def safe_ratio(num, den):
    """A3: 0 when the denominator is null or <= 0."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(F.coalesce(d, F.lit(0)) > 0, n / d).otherwise(F.lit(0.0))


def safe_div_zero(num, den):
    """A5: 0 only when the denominator is 0; null stays null."""
    n = F.col(num) if isinstance(num, str) else num
    d = F.col(den) if isinstance(den, str) else den
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def team_match_stats(events: DataFrame, shots: DataFrame, matches: DataFrame, normalise_teams: bool = True) -> DataFrame:
    """A1-A4 + J3 + J4: one row per (match, team) with 11 sums, 3 means, 7 ratios, opponent and side.

    J3 without its self-join: the shot columns are aggregated on the shot frame and the event flags on the
    events, and the two small per-team tables are joined.
    """
    ev = events.withColumns({
        "match_id": F.col("match_id").cast("long"),
        "event_type": F.coalesce(F.col("event_type"), F.lit("")),
        "outcome": F.coalesce(F.col("outcome"), F.lit("")),
        "x": clean.lenient_number("x"),
        "end_x": clean.lenient_number("end_x"),
    })
    own_shots = shots.withColumn("match_id", F.col("match_id").cast("long"))
    if normalise_teams:
        ev, own_shots = (df.withColumn("team_name", clean.canonical_name("team_name")) for df in (ev, own_shots))
    is_pass = F.col("event_type") == "Pass"
    ev = ev.withColumns({
        "is_pass": is_pass.cast("int"),
        "successful_pass": (is_pass & (F.col("outcome") == "Successful")).cast("int"),
        # null end_x falls back to x, null x counts as 0; a null difference compares false
        "progressive_pass": (is_pass & ((F.coalesce(F.col("end_x"), F.col("x")) - F.coalesce(F.col("x"), F.lit(0.0))) >= 15)).cast("int"),
        "final_third_pass": (is_pass & (F.coalesce(F.col("end_x"), F.lit(0.0)) >= 66)).cast("int"),
    })
    ev = ev.withColumn("progressive_pass", F.coalesce(F.col("progressive_pass"), F.lit(0)))
    total = lambda pairs: [F.sum(F.col(src).cast("long")).alias(out) for out, src in pairs]
    of_shots = [p for p in TEAM_MATCH_SUMS if p[1] in SHOT_FLAGS]
    by_team = own_shots.groupBy(F.col("match_id").alias("_m"), F.col("team_name").alias("_t")).agg(
        *total(of_shots), *[F.avg(src).alias(out) for out, src in TEAM_MATCH_MEANS])
    g = ev.groupBy("match_id", "team_name").agg(*total([p for p in TEAM_MATCH_SUMS if p[1] not in SHOT_FLAGS]))
    g = g.join(by_team, F.col("match_id").eqNullSafe(F.col("_m")) & F.col("team_name").eqNullSafe(F.col("_t")), "left").drop("_m", "_t")
    g = g.fillna(0, subset=[out for out, _ in of_shots])
    g = g.withColumns({
        "pass_accuracy": safe_ratio("passes_completed", "passes_attempted"),
        "progressive_pass_rate": safe_ratio("progressive_passes", "passes_attempted"),
        "shot_accuracy": safe_ratio("shots_on_target", "shots"),
        "conversion_rate": safe_ratio("goals", "shots"),
        "big_chance_rate": safe_ratio("big_chances", "shots"),
        "assisted_shot_rate": safe_ratio("assisted_shots", "shots"),
        "touches_per_shot": F.when(F.col("shots") > 0, F.col("touches") / F.col("shots")).otherwise(F.col("touches").cast("double")),
    })
    g = g.fillna(0.0, subset=[o for o, _ in TEAM_MATCH_MEANS])
    # Side and opponent from the fixture
    ctx = matches.select(F.col("id").alias("match_id"), "home_team", "away_team", "kickoff")
    g = g.join(ctx, "match_id", "left")
    return g.withColumns({
        "opponent": F.when(F.col("team_name") == F.col("home_team"), F.col("away_team")).otherwise(F.col("home_team")),
        "is_home": (F.col("team_name") == F.col("home_team")).cast("int"),
    })


def normalise_for_report(shots: DataFrame) -> DataFrame:
    """Drop rows with non-finite x/y, fill missing labels, keep stored distance/angle and
    recompute them when missing, infer shot type and zone."""
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != float("inf"))
    s = shots.filter(finite("x") & finite("y"))
    geo = geometry.shot_geometry("x", "y")
    fills = {}
    for c in ("distance_to_goal_m", "goal_frame_angle"):
        fills[c] = F.coalesce(F.col(c), geo[c]) if c in s.columns else geo[c]
    s = s.withColumns(fills)
    flags = [c for c in ("is_penalty", "is_header", "is_left_foot", "is_right_foot") if c in s.columns]
    if len(flags) == 4:
        s = s.withColumn("shot_type_key", F.coalesce(F.col("shot_type_key") if "shot_type_key" in s.columns else F.lit(None),
                                                     text.shot_type_key("is_penalty", "is_header", "is_left_foot", "is_right_foot")))
    s = s.withColumn("zone_key", geometry.zone_key("x", "y"))
    if "player_name" in s.columns:
        s = s.withColumn("player_name", clean.default_name("player_name"))
    if "xg" in s.columns:
        s = s.withColumn("xg", clean.finite_or("xg", 0.0))
    return s


def coalescing_merge(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], suffix: str = "_api") -> DataFrame:
    """Left join; each listed column prefers the local value, else the joined one."""
    r = right.select(key, *[F.col(c).alias(f"{c}{suffix}") for c in columns if c in right.columns])
    j = left.join(r, key, "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.col(f"{c}{suffix}")) if c in left.columns else F.col(f"{c}{suffix}")
                          for c in columns if f"{c}{suffix}" in j.columns}).drop(*[f"{c}{suffix}" for c in columns if f"{c}{suffix}" in j.columns])
