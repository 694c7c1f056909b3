"""Batch scoring with fallbacks.

A batch is a DataFrame of requests; every source of a prediction (ensemble, single model, stored
predictions, market odds, league average) is a DataFrame keyed like the requests. The cascade stacks the
sources' answers and keeps the first level of each row, so each row falls back on its own (the reference
falls back for the whole batch); ``source``, ``mode`` and ``fallback_reason`` record which level
answered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import clean
from touchline.functions import odds as O
from touchline.schemas import SchemaError, require_columns

# Default prices and probabilities of the market fallback, league-average goals.
DEFAULT_ODDS = {"h": 2.4, "d": 3.4, "a": 3.0}
DEFAULT_PROBS = {"h": 0.42, "d": 0.26, "a": 0.32}
DEFAULT_GOALS = 2.7

# Batch tasks, their required columns, and aliases.
TASKS = {
    "xg": ["x", "y"],
    "match_result": ["home_team", "away_team"],
    "match_goals": ["home_team", "away_team"],
    "match_full": ["home_team", "away_team"],
}
TASK_ALIASES = {"match": "match_full"}
MODE_RANK = {"fallback": 0, "model": 1, "ensemble": 2}
LEVELS = ["ensemble", "model", "stored", "market", "league"]


def market_probabilities(df: DataFrame, h: str = "b365h", d: str = "b365d", a: str = "b365a") -> DataFrame:
    """The market's probabilities and expected goals. Supplied normalised probabilities
    (``b365_home_prob_norm`` and so on) come first; else the normalised inverse prices, where a missing or bad
    price uses the default price and prices below 0.001 are floored. Expected goals are the row's own
    ``total_goals``, else 2.7, and never negative."""
    supplied = {"h": "b365_home_prob_norm", "d": "b365_draw_prob_norm", "a": "b365_away_prob_norm"}
    value = {}
    for side, c in (("h", h), ("d", d), ("a", a)):
        if set(supplied.values()) <= set(df.columns):
            value[side] = clean.finite_or(F.col(supplied[side]).cast("double"), DEFAULT_PROBS[side])
        else:
            price = clean.finite_or(F.col(c).cast("double"), DEFAULT_ODDS[side]) if c in df.columns else F.lit(DEFAULT_ODDS[side])
            value[side] = 1 / F.greatest(price, F.lit(0.001))
    total = value["h"] + value["d"] + value["a"]
    goals = clean.finite_or(F.col("total_goals").cast("double"), DEFAULT_GOALS) if "total_goals" in df.columns else F.lit(DEFAULT_GOALS)
    return df.withColumns({"mk_home": F.try_divide(value["h"], total), "mk_draw": F.try_divide(value["d"], total),
                           "mk_away": F.try_divide(value["a"], total), "mk_goals": F.greatest(goals, F.lit(0.0))})


def stored_predictions(requests: DataFrame, stored: DataFrame, row_col: str = "row_id") -> DataFrame:
    """Stored predictions looked up by normalised (home, away) names (P2): (row_id, p_home,
    p_draw, p_away, goals). ``stored`` has home, away, prob_home, prob_draw, prob_away (percent), est_goals
    and ``position``; of several rows of a pair the last one wins."""
    keyed = stored.withColumns({"_hk": clean.lookup_key("home"), "_ak": clean.lookup_key("away")})
    last = keyed.groupBy("_hk", "_ak").agg(F.max_by(F.struct("prob_home", "prob_draw", "prob_away", "est_goals"), "position").alias("_s"))
    asked = requests.select(row_col, clean.lookup_key("home_team").alias("_hk"), clean.lookup_key("away_team").alias("_ak"))
    share = lambda c: F.greatest(F.lit(0.001), F.least(F.lit(0.999), clean.finite_or(F.col(f"_s.{c}").cast("double"), 0.0) / 100))
    return asked.join(last, ["_hk", "_ak"]).select(
        row_col, share("prob_home").alias("p_home"), share("prob_draw").alias("p_draw"), share("prob_away").alias("p_away"),
        F.greatest(clean.finite_or(F.col("_s.est_goals").cast("double"), DEFAULT_GOALS), F.lit(0.0)).alias("goals"))


def league_average(fixtures: DataFrame) -> DataFrame:
    """One-row result rates of the history (defaults when empty), normalised."""
    r = fixtures.agg(F.avg((F.col("ftr") == "H").cast("double")).alias("h"), F.avg((F.col("ftr") == "D").cast("double")).alias("d"),
                     F.avg((F.col("ftr") == "A").cast("double")).alias("a"))
    r = r.select(*[F.coalesce(F.col(s), F.lit(DEFAULT_PROBS[s])).alias(s) for s in "hda"])
    t = F.col("h") + F.col("d") + F.col("a")
    return r.select((F.col("h") / t).alias("lg_home"), (F.col("d") / t).alias("lg_draw"), (F.col("a") / t).alias("lg_away"))


def latest_pair_rows(history: DataFrame, home: str = "home_team", away: str = "away_team", order: str = "kickoff",
                     tiebreak: str = "id") -> DataFrame:
    """The latest history row per (home, away) pair, keys compared case and space
    insensitively (P2). ``max_by`` keeps partial aggregation (no single-task group)."""
    keyed = history.withColumns({"_hk": clean.lookup_key(home), "_ak": clean.lookup_key(away)})
    cols = [c for c in history.columns]
    latest = keyed.groupBy("_hk", "_ak").agg(F.max_by(F.struct(*cols), F.struct(order, tiebreak)).alias("_r"))
    return latest.select("_hk", "_ak", "_r.*")


def cascade(requests: DataFrame, sources: dict[str, DataFrame], league: DataFrame, row_col: str = "row_id") -> DataFrame:
    """Per request row, the first level that answered among ensemble, model, stored, market;
    league average otherwise. Each source: (row_id, p_home, p_draw, p_away, goals[, model]), a row an id.

    The answers of all sources are stacked as (row, level, values); one aggregate by row keeps the first level's
    values and notes which levels answered, and meets the requests in one join, however many sources there are.
    Probabilities are clipped to [0.001, 0.999] and renormalised (E26); goals default to 2.7.
    """
    present = [lvl for lvl in LEVELS[:-1] if lvl in sources]
    stacked = None
    for level, lvl in enumerate(present):
        total = F.col("p_home") + F.col("p_draw") + F.col("p_away")  # null if any is
        rows = sources[lvl].filter(total > 0).select(row_col, F.struct(F.lit(level).alias("level"), "p_home", "p_draw", "p_away", F.col("goals").cast("double").alias("goals")).alias("_a"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    if stacked is None:
        out = requests.withColumns({"_a": F.lit(None).cast("struct<level:int,p_home:double,p_draw:double,p_away:double,goals:double>"), "_levels": F.lit(0)})
    else:
        found = stacked.groupBy(row_col).agg(F.min("_a").alias("_a"), F.bit_or(F.call_function("shiftleft", F.lit(1), F.col("_a.level"))).alias("_levels"))
        out = requests.join(found, row_col, "left")
    out = out.crossJoin(F.broadcast(league))  # one row
    level = F.col("_a.level")
    source = F.lit("league_average_fallback")
    for i, lvl in reversed(list(enumerate(present))):
        source = F.when(level == i, lvl).otherwise(source)
    out = out.withColumns({"source": source, "_ph": F.coalesce("_a.p_home", "lg_home"), "_pd": F.coalesce("_a.p_draw", "lg_draw"), "_pa": F.coalesce("_a.p_away", "lg_away"),
                           "expected_goals": F.greatest(F.coalesce("_a.goals", F.lit(DEFAULT_GOALS)), F.lit(0.0))})
    ph, pd_, pa = O.clip_renormalise("_ph", "_pd", "_pa")
    out = out.withColumns({"home_win_probability": ph, "draw_probability": pd_, "away_win_probability": pa})
    mode = F.when(F.col("source") == "ensemble", "ensemble").when(F.col("source") == "model", "model").otherwise("fallback")
    absent = [F.when(F.coalesce(F.col("_levels"), F.lit(0)).bitwiseAND(1 << i) == 0, F.lit(lvl)) for i, lvl in enumerate(present)]
    reason = (F.when(F.col("source") == "ensemble", F.lit(None).cast("string"))
               .otherwise(F.concat(F.lit("no "), F.concat_ws(", no ", *absent), F.lit(" prediction"))))
    out = out.withColumns({"mode": mode, "fallback_reason": reason,
                           "predicted_result": O.argmax_label("home_win_probability", "draw_probability", "away_win_probability")})
    return out.drop("_a", "_levels", "_ph", "_pd", "_pa", "lg_home", "lg_draw", "lg_away")


def overall_mode(scored: DataFrame) -> DataFrame:
    """The strongest mode seen in the batch."""
    r = F.max(F.when(F.col("mode") == "ensemble", 2).when(F.col("mode") == "model", 1).otherwise(0))
    return scored.agg(r.alias("_m")).select(F.when(F.col("_m") == 2, "ensemble").when(F.col("_m") == 1, "model").otherwise("fallback").alias("mode"))


def resolve_task(task: str) -> str:
    t = TASK_ALIASES.get(task, task)
    if t not in TASKS:
        raise SchemaError(f"unknown task {task!r}: expected one of {sorted(TASKS) + sorted(TASK_ALIASES)}")
    return t


XG_FLAGS = ("is_big_chance", "is_header", "is_right_foot", "is_left_foot", "is_penalty", "is_volley", "first_touch", "from_corner", "is_counter")


def score_xg_batch(batch: DataFrame) -> DataFrame:
    """E27 xg task + E29 + X16 + X18: heuristic xG per row, input columns pass through (P20).

    A null or blank x or y fails the whole batch (one probe). A row that breaks a limit (x or y not a number
    or outside 0 to 100, a negative or non-numeric supplied distance or angle, a flag that is not 0 or 1)
    gets 0 and source ``fallback``. Missing flags count as 0; supplied ``shot_distance`` and ``shot_angle``
    replace the ones computed from the location.
    """
    require_columns(batch, TASKS["xg"], "xg batch")
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    if not batch.filter(blank("x") | blank("y")).limit(1).isEmpty():
        raise SchemaError("every row of an xg batch needs a value in x and y")
    x, y = clean.lenient_number("x"), clean.lenient_number("y")
    ok = x.between(0, 100) & y.between(0, 100)
    flags, supplied = {}, {}
    for c in XG_FLAGS:
        given = F.lit(False) if c not in batch.columns else ~blank(c)
        value = clean.lenient_number(c) if c in batch.columns else F.lit(0.0)
        ok = ok & (~given | F.coalesce(value.isin(0.0, 1.0), F.lit(False)))
        flags[c] = F.when(given, value).otherwise(F.lit(0.0))
    for c in ("shot_distance", "shot_angle"):
        supplied[c] = None
        if c in batch.columns:
            value = clean.lenient_number(c)
            ok = ok & (blank(c) | F.coalesce(value >= 0, F.lit(False)))
            supplied[c] = F.when(~blank(c), value)
    xg = O.heuristic_xg(x, y, flags["is_big_chance"], flags["is_penalty"], flags["is_header"], flags["first_touch"],
                        flags["is_volley"], flags["is_counter"], flags["from_corner"],
                        distance=supplied["shot_distance"], angle=supplied["shot_angle"])
    ok = F.coalesce(ok, F.lit(False))
    out = batch.withColumns({"xg_prediction": F.when(ok, xg).otherwise(F.lit(0.0)),
                             "source": F.when(ok, F.lit("heuristic_fallback")).otherwise(F.lit("fallback"))})
    return out.withColumn("shot_quality_label", O.shot_quality_label("xg_prediction"))


def score_match_batch(batch: DataFrame, task: str, sources: dict[str, DataFrame], league: DataFrame,
                      row_col: str = "row_id") -> DataFrame:
    """Match tasks through the cascade; the output projection depends on the task. Missing
    team names fail the whole batch (one count query), before any scoring job."""
    t = resolve_task(task)
    require_columns(batch, TASKS[t], f"{t} batch")
    bad = batch.filter(F.trim(F.coalesce(F.col("home_team").cast("string"), F.lit(""))) == "").limit(1).count()
    if bad:
        raise SchemaError("home_team/away_team must be non-empty in every row")
    scored = cascade(batch, sources, league, row_col)
    base = list(batch.columns)
    if t == "match_result":
        return scored.select(*base, "home_win_probability", "draw_probability", "away_win_probability", "predicted_result", "source", "mode")
    if t == "match_goals":
        return scored.select(*base, "expected_goals", "source", "mode")
    return scored


def batch_summary_xg(scored: DataFrame) -> DataFrame:
    """A33 for the xg task."""
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.avg("xg_prediction").alias("mean_xg"), F.max("xg_prediction").alias("max_xg"),
                      F.sum((F.col("shot_quality_label") == "alta").cast("long")).alias("high_quality"))


def batch_summary_match(scored: DataFrame) -> DataFrame:
    """A33 for match tasks: H/D/A counts and mean expected goals."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if "predicted_result" in scored.columns:
        aggs += [F.sum((F.col("predicted_result") == s).cast("long")).alias(f"predicted_{s}") for s in ("H", "D", "A")]
    if "expected_goals" in scored.columns:
        aggs.append(F.avg("expected_goals").alias("mean_expected_goals"))
    return scored.agg(*aggs)


def preview(scored: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in request order (a top-n report)."""
    return scored.orderBy(*order).limit(n)


def fallback_rows(frame: DataFrame, reason: str) -> DataFrame:
    """Market class probabilities for a frame the model could not score; goals 2.7."""
    m = market_probabilities(frame)
    return m.withColumns({"p_home": F.col("mk_home"), "p_draw": F.col("mk_draw"), "p_away": F.col("mk_away"),
                          "predicted_total_goals": F.lit(DEFAULT_GOALS),
                          "predicted_result": O.argmax_label("mk_home", "mk_draw", "mk_away"),
                          "fallback_reason": F.lit(reason)}).drop("mk_home", "mk_draw", "mk_away", "mk_goals")


def clean_labels(df: DataFrame, col: str) -> DataFrame:
    """E38."""
    return df.withColumn(col, O.clean_label(col))


def validity(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One boolean per named constraint and a row-level ``is_valid``; invalid rows are
    kept (marked), never dropped."""
    out = df.withColumns({f"ok_{n}": F.coalesce(c, F.lit(False)) for n, c in checks.items()})
    all_ok = None
    for n in checks:
        all_ok = F.col(f"ok_{n}") if all_ok is None else all_ok & F.col(f"ok_{n}")
    return out.withColumn("is_valid", all_ok)


def violation_counts(checked: DataFrame, names: Sequence[str]) -> DataFrame:
    """One aggregate counting failures per constraint."""
    return checked.agg(*[F.sum((~F.col(f"ok_{n}")).cast("long")).alias(n) for n in names])
