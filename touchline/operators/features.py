"""Fixture-level feature builders.

Inputs follow the reference's fixture schema: ``id``, ``kickoff``, ``home_team``, ``away_team``,
``fthg``, ``ftag``, ``ftr``, ``referee``, ``hy``/``ay``/``hf``/``af``, ``home_win``, ``total_goals`` and
the 12 bookmaker prices. Every function takes and returns DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import odds as O
from touchline.operators import reshape, windows

BOOKS = ("b365", "bw", "max", "avg")
SIDE_NAMES = {"h": "home", "d": "draw", "a": "away"}

# The 18 trailing team-form columns (from the fixture itself and the event aggregates).
TEAM_FORM_COLUMNS = [
    "goals_for", "goals_against", "points", "pass_accuracy", "progressive_passes", "progressive_pass_rate",
    "shots", "shots_on_target", "shot_accuracy", "conversion_rate", "big_chances", "big_chance_rate",
    "assisted_shot_rate", "touches", "touches_per_shot", "avg_shot_distance", "avg_shot_angle",
    "avg_score_diff_before_shot",
]

# The 16 bases of the home-minus-away differences.
DIFF_BASES = [
    "goals_for", "goals_against", "points", "pass_accuracy", "progressive_pass_rate", "shots", "shots_on_target",
    "shot_accuracy", "conversion_rate", "big_chances", "big_chance_rate", "assisted_shot_rate", "touches_per_shot",
    "avg_shot_distance", "avg_shot_angle", "avg_score_diff_before_shot",
]

# Referee history outputs (source column -> output), window 10.
REFEREE_TARGETS = {
    "total_yellows": "ref_avg_yellows_last10",
    "total_fouls": "ref_avg_fouls_last10",
    "total_goals": "ref_avg_goals_last10",
    "home_win": "ref_home_win_rate_last10",
}

ORDER = ("kickoff", "id")


def team_long(fixtures: DataFrame) -> DataFrame:
    """One row per (fixture, side) with goals for/against and 3/1/0 points."""
    long = reshape.two_sided_to_long(
        fixtures, "id", ["kickoff", "ftr"],
        {"team": {"home": "home_team", "away": "away_team"},
         "goals_for": {"home": "fthg", "away": "ftag"},
         "goals_against": {"home": "ftag", "away": "fthg"}},
    )
    return long.withColumnRenamed("id", "match_id")


def fixture_hot_rows(fixtures: DataFrame) -> tuple[int, int]:
    """Rows held by hot teams (in the long, two-rows-per-fixture form) and hot referees, from ONE
    pass over the fixture table: ``GROUPING SETS ((home_team), (away_team), (referee))``; a team's
    long-form count is its home count plus its away count (a small second aggregation)."""
    limit = windows.rows_per_task(fixtures)
    cols = ["home_team", "away_team", "referee"]
    g = (fixtures.groupingSets([[F.col("home_team")], [F.col("away_team")], [F.col("referee")]], *[F.col(c) for c in cols])
                 .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid")))
    # grouping_id bits (home, away, referee): home set = 0b011, away set = 0b101, referee set = 0b110
    teams = (g.filter(F.col("_gid").isin(3, 5)).groupBy(F.coalesce("home_team", "away_team").alias("_t"))
              .agg(F.sum("_n").alias("_n")).filter(F.col("_n") > limit).agg(F.sum("_n").alias("_team_rows")))
    refs = g.filter((F.col("_gid") == 6) & (F.col("_n") > limit)).agg(F.sum("_n").alias("_ref_rows"))
    r = teams.crossJoin(refs).first()
    return int(r["_team_rows"] or 0), int(r["_ref_rows"] or 0)


def team_history(fixtures: DataFrame, event_stats: DataFrame | None = None, window: int = 5,
                 columns: Sequence[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Trailing means of the team-form columns over the team's previous ``window`` fixtures.

    ``event_stats`` (one row per ``match_id``, ``team_name``; see ``aggregate.team_match_stats``) is
    left-joined on both keys (J5); columns it lacks are skipped. All trailing columns share one window.
    """
    long = team_long(fixtures)
    if event_stats is not None:
        stats = event_stats.drop("kickoff", "home_team", "away_team", "opponent", "is_home")
        stats = stats.withColumnRenamed("team_name", "team")
        long = long.join(stats, on=["match_id", "team"], how="left")
    cols = [c for c in (columns or TEAM_FORM_COLUMNS) if c in long.columns]
    long = long.withColumns({c: F.col(c).cast("double") for c in cols})
    return windows.trailing(long.withColumnRenamed("match_id", "id"), "team", ORDER, cols, window,
                            hot_rows=hot_rows).withColumnRenamed("id", "match_id")


REFEREE_SOURCES = ("referee", "hy", "ay", "hf", "af", "total_goals", "home_win")


def referee_totals(fixtures: DataFrame) -> DataFrame:
    """The per-fixture values that the referee history averages."""
    return fixtures.withColumns({
        "total_yellows": F.col("hy").cast("double") + F.col("ay").cast("double"),
        "total_fouls": F.col("hf").cast("double") + F.col("af").cast("double"),
        "total_goals": F.col("total_goals").cast("double"),
        "home_win": F.col("home_win").cast("double"),
    })


def referee_history(fixtures: DataFrame, window: int = 10, hot_rows: int | None = None) -> DataFrame:
    """Referee trailing means; rows with a null referee get null."""
    frame = referee_totals(fixtures)
    out = windows.trailing_guarded(frame, "referee", ORDER, list(REFEREE_TARGETS), window, out="_tl_ref_{c}", hot_rows=hot_rows)
    return out.withColumns({tgt: F.col(f"_tl_ref_{src}") for src, tgt in REFEREE_TARGETS.items()}).drop(
        *[f"_tl_ref_{s}" for s in REFEREE_TARGETS])


def market_features(df: DataFrame) -> DataFrame:
    """Implied probabilities per book and side, overround, normalised favourite strength,
    entropy, home/away odds gap, and dispersion of home and away prices across books."""
    cols: dict[str, Column] = {}
    for book in BOOKS:
        for s, name in SIDE_NAMES.items():
            cols[f"{book}_{name}_prob"] = O.implied_prob(f"{book}{s}")
    df = df.withColumns(cols)
    b365 = [f"b365_{n}_prob" for n in SIDE_NAMES.values()]
    norm = O.normalised(b365)
    return df.withColumns({
        "odds_gap_home_away": F.col("b365a") - F.col("b365h"),
        "implied_prob_sum_b365": O.overround(b365),
        "market_favorite_strength": F.greatest(*norm),
        "market_entropy_b365": O.entropy(norm),
        "home_odds_dispersion": O.row_std([f"{b}h" for b in BOOKS]),
        "away_odds_dispersion": O.row_std([f"{b}a" for b in BOOKS]),
    })


def normalised_market_probs(df: DataFrame, book: str = "b365") -> DataFrame:
    """Normalised probabilities of one book, nulls skipped in the sum."""
    probs = [O.implied_prob(f"{book}{s}") for s in SIDE_NAMES]
    norm = O.normalised(probs)
    return df.withColumns({f"{book}_{n}_prob_norm": p for n, p in zip(SIDE_NAMES.values(), norm)})


def fixture_features(fixtures: DataFrame, event_stats: DataFrame | None = None, window: int = 5,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """The fixture feature table: team form for both sides (R1 + W9 + J6), referee history (W10),
    market features (X7-X9), home-minus-away differences (R3) and ``result_code``.

    Shuffles: one for the team window (by team), one for the fold back to fixtures (by id, with
    partial aggregation), one for the referee window, one to join (by id). No broadcast of anything
    that grows with the data.
    """
    team_hot, ref_hot = fixture_hot_rows(fixtures)
    hist = team_history(fixtures, event_stats, window, columns, hot_rows=team_hot)
    suffix = f"_last{window}"
    rolled = [c for c in hist.columns if c.endswith(suffix)]
    wide = reshape.long_to_wide(hist, "match_id", "is_home", rolled).withColumnRenamed("match_id", "id")
    base = referee_history(fixtures, hot_rows=ref_hot)
    feats = base.join(wide, on="id", how="left")
    feats = market_features(feats)
    bases = [b for b in DIFF_BASES if f"{b}{suffix}" in rolled]
    feats = reshape.side_differences(feats, bases, suffix)
    return feats.withColumn("result_code", F.when(F.col("ftr") == "H", 0).when(F.col("ftr") == "D", 1)
                            .when(F.col("ftr") == "A", 2))


def notebook_form_features(fixtures: DataFrame, window: int = 5) -> DataFrame:
    """The notebook's form pack: trailing means of goals for/against, trailing points *sum*,
    trailing win rate, then home-away differences of the four."""
    long = team_long(fixtures).withColumn("win", (F.col("points") == 3).cast("double")).withColumnRenamed("match_id", "id")
    long = long.withColumns({"goals_for": F.col("goals_for").cast("double"), "goals_against": F.col("goals_against").cast("double"),
                             "points": F.col("points").cast("double")})

    def build(w):
        frame = w.rowsBetween(-window, -1)
        return {
            f"gf_avg_last{window}": F.avg("goals_for").over(frame),
            f"ga_avg_last{window}": F.avg("goals_against").over(frame),
            f"points_sum_last{window}": F.when(F.count("points").over(frame) > 0, F.sum("points").over(frame)),
            f"win_rate_last{window}": F.avg("win").over(frame),
        }

    hist = windows.apply_window(long, "team", ORDER, windows.WindowJob(build, lookback=window),
                                hot_rows=fixture_hot_rows(fixtures)[0])
    outs = [f"gf_avg_last{window}", f"ga_avg_last{window}", f"points_sum_last{window}", f"win_rate_last{window}"]
    wide = reshape.long_to_wide(hist, "id", "is_home", outs)
    res = fixtures.select("id", "kickoff", "home_team", "away_team", "ftr").join(wide, "id", "left")
    return res.withColumns({f"{o}_diff": F.col(f"home_{o}") - F.col(f"away_{o}") for o in outs})


def _as_of_means(history: DataFrame, new: DataFrame, key: str, columns: Sequence[str], window: int, out: str) -> DataFrame:
    """Rows of ``new`` (id, kickoff, ``key``, ...) with the mean of each column over the key's last ``window``
    earlier rows of ``history``: every history row carries its inclusive mean, and a new row takes the value of
    the latest earlier one. New rows never see each other and use up no window slots."""
    history = history.withColumns({c: F.col(c).cast("double") for c in columns})

    def inclusive(w):
        frame = w.rowsBetween(-(window - 1), 0)
        return {f"_inc_{c}": F.avg(c).over(frame) for c in columns}
    rolled = windows.apply_window(history.select("id", "kickoff", key, *columns), key, ORDER, windows.WindowJob(inclusive, lookback=window - 1))
    # a mean over rows without a value is null and still the latest: a flag tells rows from absent rows
    past = rolled.select("id", "kickoff", key, *[F.struct(F.col(f"_inc_{c}").alias("v")).alias(f"_inc_{c}") for c in columns], F.lit(False).alias("_new"))
    both = past.unionByName(new.withColumn("_new", F.lit(True)), allowMissingColumns=True)

    def as_of(w):
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        return {f"_of_{c}": F.last(f"_inc_{c}", ignorenulls=True).over(before) for c in columns}
    seen = windows.apply_window(both, key, ORDER, windows.WindowJob(as_of, carry_cols={f"_of_{c}": f"_inc_{c}" for c in columns}))
    return (seen.filter("_new").withColumns({out.format(c=c): F.col(f"_of_{c}")["v"] for c in columns})
                .drop("_new", *[f"_of_{c}" for c in columns], *[f"_inc_{c}" for c in columns]))


def future_fixture_features(history: DataFrame, new_rows: DataFrame, event_stats: DataFrame | None = None, window: int = 5) -> DataFrame:
    """J8 (fixed form): the whole feature row for fixtures that have not been played: team form of all bases
    that ``history`` and ``event_stats`` give, differences, referee history (when ``new_rows`` names the
    referee) and market features (when it has prices).

    History is pruned to the teams and referees in the request by semi joins (J13), so the work grows with
    what is asked. New rows never see each other's placeholder scores.
    """
    teams = (new_rows.select(F.col("home_team").alias("team"))
             .union(new_rows.select(F.col("away_team").alias("team"))).distinct())
    hist_long = team_long(history).join(teams, "team", "left_semi")
    if event_stats is not None:
        stats = event_stats.drop("kickoff", "home_team", "away_team", "opponent", "is_home").withColumnRenamed("team_name", "team")
        hist_long = hist_long.join(stats, on=["match_id", "team"], how="left")
    cols = [c for c in TEAM_FORM_COLUMNS if c in hist_long.columns]
    new_long = team_long(new_rows.withColumns({"ftr": F.lit(None).cast("string"), "fthg": F.lit(None).cast("long"), "ftag": F.lit(None).cast("long")}))
    new_long = new_long.withColumnRenamed("match_id", "id").select("id", "kickoff", "team", "is_home")
    rolled = _as_of_means(hist_long.withColumnRenamed("match_id", "id"), new_long, "team", cols, window, f"{{c}}_last{window}")
    wide = reshape.long_to_wide(rolled, "id", "is_home", [f"{c}_last{window}" for c in cols])
    res = new_rows.join(wide, "id", "left")
    res = reshape.side_differences(res, [b for b in DIFF_BASES if b in cols], f"_last{window}")
    if "referee" in new_rows.columns and set(REFEREE_SOURCES) <= set(history.columns):
        asked = new_rows.filter(F.col("referee").isNotNull()).select("id", "kickoff", "referee")
        past = referee_totals(history).join(asked.select("referee").distinct(), "referee", "left_semi")
        refs = _as_of_means(past, asked, "referee", list(REFEREE_TARGETS), 10, "_tl_ref_{c}")
        res = res.join(refs.select("id", *[F.col(f"_tl_ref_{src}").alias(tgt) for src, tgt in REFEREE_TARGETS.items()]), "id", "left")
    if all(f"{b}{s}" in new_rows.columns for b in BOOKS for s in SIDE_NAMES):
        res = market_features(res)
    return res


# ---------------------------------------------------------------------------------------------
# Composite indices
# ---------------------------------------------------------------------------------------------

def zscore_params(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population std of each column as one row (fit step of X15 / M4)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def weighted_indices(df: DataFrame, params: DataFrame, weights: dict[str, dict[str, float]]) -> DataFrame:
    """Each index is a fixed-weight sum of z-scores. ``params`` is the one-row output of
    ``zscore_params`` (fit on the training part; pass the whole table for the reference's behaviour);
    zero std counts as 1. The one-row params table is cross-joined (bounded: one row)."""
    joined = df.crossJoin(F.broadcast(params))
    cols = {}
    for name, w in weights.items():
        expr = F.lit(0.0)
        for c, coef in w.items():
            std = F.col(f"{c}__std")
            z = (F.col(c) - F.col(f"{c}__mean")) / F.when((std == 0) | std.isNull(), F.lit(1.0)).otherwise(std)
            expr = expr + coef * z
        cols[name] = expr
    drop = [c for c in params.columns]
    return joined.withColumns(cols).drop(*drop)


# ---------------------------------------------------------------------------------------------
# Feature-set selection on the schema (driver metadata only)
# ---------------------------------------------------------------------------------------------

# Fixture metadata, observed match statistics and targets, which are never features.
META_COLUMNS = {"id", "date", "time", "kickoff", "home_team", "away_team", "ftr", "htr", "referee"}
OBSERVED_COLUMNS = {"hthg", "htag", "hs", "as_", "hst", "ast", "hf", "af", "hc", "ac", "hy", "ay", "hr", "ar"}
TARGET_COLUMNS = {"fthg", "ftag", "total_goals", "goal_diff", "home_win", "result_code"}
#: Columns that our own operators add and that are not features either.
OWN_COLUMNS = {"match_id", "row_idx", "is_train"}

# The targets of the approximation models and the five composite indices.
APPROXIMATION_TARGETS = ["hthg", "htag", "hs", "as_", "hst", "ast", "hf", "af", "hc", "ac", "hy", "ay", "hr", "ar"]
INDEX_COLUMNS = ["threat_index", "dominance_index", "efficiency_control_index", "territorial_pressure_index", "clean_dominance_index"]

# The named feature presets of the goals and the winner stage.
GOALS_PRESETS = {
    "goals_default": [
        "b365h", "b365d", "b365a", "b365_home_prob", "b365_draw_prob", "b365_away_prob", "implied_prob_sum_b365",
        "market_favorite_strength", "market_entropy_b365", "home_goals_for_last5", "away_goals_for_last5", "home_goals_against_last5",
        "away_goals_against_last5", "home_points_last5", "away_points_last5", "points_diff_last5", "home_shots_last5", "away_shots_last5",
        "home_shots_on_target_last5", "away_shots_on_target_last5", "home_shot_accuracy_last5", "away_shot_accuracy_last5",
        "shot_accuracy_diff_last5", "home_conversion_rate_last5", "away_conversion_rate_last5", "conversion_rate_diff_last5",
        "home_big_chance_rate_last5", "away_big_chance_rate_last5", "big_chance_rate_diff_last5", "home_assisted_shot_rate_last5",
        "away_assisted_shot_rate_last5", "assisted_shot_rate_diff_last5", "home_avg_shot_angle_last5", "away_avg_shot_angle_last5",
        "avg_shot_angle_diff_last5", "ref_avg_goals_last10", "ref_avg_fouls_last10"],
    "goals_compact": [
        "b365h", "b365d", "b365a", "points_diff_last5", "home_shots_on_target_last5", "away_shots_on_target_last5",
        "conversion_rate_diff_last5", "big_chance_rate_diff_last5", "market_entropy_b365"],
}
WINNER_PRESETS = {
    "winner_default": [
        "b365h", "b365d", "b365a", "home_goals_for_last5", "home_goals_against_last5", "away_goals_for_last5", "away_goals_against_last5",
        "home_shots_on_target_last5", "away_shots_on_target_last5", "away_big_chances_last5", "points_diff_last5",
        "pass_accuracy_diff_last5", "conversion_rate_diff_last5", "big_chance_rate_diff_last5", "market_entropy_b365"],
    "winner_full": [
        "b365h", "b365d", "b365a", "b365_home_prob", "b365_draw_prob", "b365_away_prob", "market_favorite_strength",
        "market_entropy_b365", "odds_gap_home_away", "home_odds_dispersion", "away_odds_dispersion", "home_goals_for_last5",
        "home_goals_against_last5", "away_goals_for_last5", "away_goals_against_last5", "home_points_last5", "away_points_last5",
        "points_diff_last5", "home_shots_last5", "away_shots_last5", "home_shots_on_target_last5", "away_shots_on_target_last5",
        "home_shot_accuracy_last5", "away_shot_accuracy_last5", "shot_accuracy_diff_last5", "home_conversion_rate_last5",
        "away_conversion_rate_last5", "conversion_rate_diff_last5", "home_big_chances_last5", "away_big_chances_last5",
        "home_big_chance_rate_last5", "away_big_chance_rate_last5", "big_chance_rate_diff_last5", "home_progressive_pass_rate_last5",
        "away_progressive_pass_rate_last5", "progressive_pass_rate_diff_last5", "home_assisted_shot_rate_last5",
        "away_assisted_shot_rate_last5", "assisted_shot_rate_diff_last5", "home_avg_shot_distance_last5", "away_avg_shot_distance_last5",
        "avg_shot_distance_diff_last5", "home_avg_shot_angle_last5", "away_avg_shot_angle_last5", "avg_shot_angle_diff_last5",
        "home_avg_score_diff_before_shot_last5", "away_avg_score_diff_before_shot_last5", "avg_score_diff_before_shot_diff_last5",
        "ref_avg_yellows_last10", "ref_avg_fouls_last10", "ref_avg_goals_last10", "ref_home_win_rate_last10"],
}
FEATURE_MODES = ("normal", "extra", "lasso_selected", "poly2_lasso")


def available_numeric_features(df: DataFrame, exclude_indices: bool = True) -> list[str]:
    """C1 (+ C4 fix): numeric, not metadata, observed-in-match or target; index columns excluded."""
    from touchline.schemas import numeric_columns
    banned = META_COLUMNS | OBSERVED_COLUMNS | TARGET_COLUMNS | OWN_COLUMNS | (set(INDEX_COLUMNS) if exclude_indices else set())
    return [c for c in numeric_columns(df) if c not in banned]


def historical_features(df: DataFrame) -> list[str]:
    """Only trailing (ex-ante) features."""
    return [c for c in available_numeric_features(df) if "_last" in c or (c.startswith("ref_") and "last" in c)]


def resolve_features(df: DataFrame, preset: str | Sequence[str], stage: str = "classification") -> list[str]:
    """A preset's columns, or an explicit list, without absent names. ``stage`` picks the goals presets
    (``regression``) or the winner presets (``classification``)."""
    if stage not in ("regression", "classification"):
        raise ValueError(f"unknown stage {stage!r}")
    named = {"all_numeric": lambda: available_numeric_features(df), "history_only": lambda: historical_features(df),
             "approximation_targets": lambda: APPROXIMATION_TARGETS, "candidate_indices": lambda: INDEX_COLUMNS}
    if not isinstance(preset, str):
        wanted = list(preset)
    elif preset in named:
        wanted = named[preset]()
    else:
        presets = GOALS_PRESETS if stage == "regression" else WINNER_PRESETS
        if preset not in presets:
            raise ValueError(f"unknown preset {preset!r} of stage {stage}: expected one of {sorted(named) + sorted(presets)}")
        wanted = presets[preset]
    return [c for c in wanted if c in df.columns]


def mode_features(df: DataFrame, preset: str | Sequence[str], stage: str, mode: str = "normal", generated: Sequence[str] = ()) -> list[str]:
    """C4: the columns of a feature mode. ``normal`` and ``poly2_lasso`` use the preset and the generated
    columns of earlier stages, ``extra`` and ``lasso_selected`` all numeric features."""
    if mode not in FEATURE_MODES:
        raise ValueError(f"unknown feature mode {mode!r}: expected one of {FEATURE_MODES}")
    if mode in ("normal", "poly2_lasso"):
        return [*resolve_features(df, preset, stage), *generated]
    return available_numeric_features(df)


def fill_with_history_medians(df: DataFrame, history: DataFrame, columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Missing inference features take the historical median (one aggregate row, cross-joined): by
    ``percentile_approx`` (rank error 1/10000, bounded memory). ``exact=True`` keeps every distinct value of a
    column in one task; use it where the history is known to be small."""
    agg = history.agg(*[(F.median(c) if exact else F.percentile_approx(c, 0.5, 10000)).alias(f"_tl_med_{c}") for c in columns])
    return (df.crossJoin(F.broadcast(agg))
              .withColumns({c: F.coalesce(F.col(c), F.col(f"_tl_med_{c}")) for c in columns})
              .drop(*[f"_tl_med_{c}" for c in columns]))


def prepare_matches(raw: DataFrame) -> DataFrame:
    """Canonical team names (P1), day-first kickoff from date + time (P3), total goals, home-win
    flag; rows without kickoff or result are dropped. Order is not materialised (windows order by
    ``(kickoff, id)`` themselves)."""
    from touchline.functions import clean
    return (raw.withColumns({"home_team": clean.canonical_name("home_team"), "away_team": clean.canonical_name("away_team"),
                             "kickoff": clean.kickoff("date", "time")})
               .withColumns({"total_goals": clean.lenient_number("fthg") + clean.lenient_number("ftag"),
                             "home_win": (F.col("ftr") == "H").cast("int")})
               .filter(F.col("kickoff").isNotNull() & F.col("ftr").isNotNull()))


# Placeholder values of post-match columns for a fixture not yet played.
RAW_MATCH_PLACEHOLDERS = {
    "fthg": 0, "ftag": 0, "ftr": "D", "hthg": 0, "htag": 0, "htr": "D", "hs": 0, "as_": 0, "hst": 0, "ast": 0, "hf": 0, "af": 0,
    "hc": 0, "ac": 0, "hy": 0, "ay": 0, "hr": 0, "ar": 0, "total_goals": 0.0, "goal_diff": 0.0}


def complete_features(frame: DataFrame, required: Sequence[str], history: DataFrame, event_stats: DataFrame | None = None,
                      window: int = 5) -> DataFrame:
    """Use the frame when it already has every required column (a schema test, no job);
    otherwise rebuild the features from history (J8) and join them on ``id``. A required column that
    cannot be built is an error."""
    from touchline.schemas import SchemaError
    if all(c in frame.columns for c in required):
        return frame
    base = [c for c in ("id", "kickoff", "home_team", "away_team", "referee", *[f"{b}{s}" for b in BOOKS for s in SIDE_NAMES]) if c in frame.columns]
    built = future_fixture_features(history, frame.select(*base), event_stats, window)
    keep = [c for c in built.columns if c not in frame.columns or c == "id"]
    out = frame.join(built.select(*keep), "id", "left")
    if missing := [c for c in required if c not in out.columns]:
        raise SchemaError(f"cannot build the required features {missing} from the given history")
    return out
