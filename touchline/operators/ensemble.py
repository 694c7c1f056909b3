"""Run ranking and weighted ensembles.

Runs and ensemble members are rows of small tables (one row per trained model); member predictions
are a long table ``(row_id, model_id, p_home, p_draw, p_away, goals, label)`` that grows with the
data. Combining is one ``groupBy(row_id)`` after a join to the member table, so at most one row per
member reaches a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.odds import argmax_label

# The default weights of the four classifier ranking metrics.
RANK_WEIGHTS = {"cv_accuracy": 0.25, "cv_f1_weighted": 0.25, "test_accuracy": 0.25, "test_f1_weighted": 0.25}
MIN_SCORE = 0.49
SIDES = ("home", "draw", "away")


def rank_runs(runs: DataFrame, weights: dict[str, float] | None = None, top_k: int | None = None,
              name_col: str = "run_name") -> DataFrame:
    """E11 + T5: weighted score of the ranking metrics; runs missing any metric are dropped; order by
    score, then the test metrics, then the cv metrics descending, then name; 1-based rank; optional top-k."""
    w = weights or RANK_WEIGHTS
    ok = None
    for m in w:
        c = F.col(m).isNotNull() & ~F.isnan(m)
        ok = c if ok is None else ok & c
    scored = runs.filter(ok).withColumn("rank_score", sum(F.col(m) * v for m, v in w.items()))
    order = [F.col("rank_score").desc()] + [F.col(m).desc() for m in sorted(w, key=lambda m: not m.startswith("test_"))] + [F.col(name_col)]
    # the run table has one row per trained model: a global window over it is bounded
    ranked = scored.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    return ranked.filter(F.col("rank") <= top_k) if top_k else ranked


def rank_regressors(runs: DataFrame, metric: str | None = None, min_test_r2: float | None = None,
                    top_k: int | None = None, name_col: str = "run_name") -> DataFrame:
    """score = 0.5 cv R2 + 0.5 test R2, optional target filter and minimum test R2; ties by test R2,
    cv R2, smaller test RMSE, name."""
    r = runs.filter(F.col("cv_r2").isNotNull() & F.col("test_r2").isNotNull())
    if metric:
        r = r.filter(F.col("target") == metric)
    if min_test_r2 is not None:
        r = r.filter(F.col("test_r2") >= min_test_r2)
    r = r.withColumn("rank_score", 0.5 * F.col("cv_r2") + 0.5 * F.col("test_r2"))
    ties = [F.coalesce(F.col("test_rmse"), F.lit(0.0)).asc()] if "test_rmse" in runs.columns else []
    order = Window.orderBy(F.col("rank_score").desc(), F.col("test_r2").desc(), F.col("cv_r2").desc(), *ties, F.col(name_col))
    ranked = r.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top_k) if top_k else ranked


def best_per_group(ranked: DataFrame, group: str, rank_col: str = "rank") -> DataFrame:
    """The lowest-rank row per group (``min_by``), ordered by group."""
    cols = [c for c in ranked.columns if c != group]
    best = ranked.groupBy(group).agg(F.min_by(F.struct(*cols), F.col(rank_col)).alias("_b"))
    return best.select(group, "_b.*").orderBy(group)


def retention_report(runs: DataFrame, metric: str, min_value: float, name_col: str = "run_name") -> DataFrame:
    """Keep / delete / skip per run by a minimum metric (report only; nothing is deleted)."""
    m = F.col(metric)
    return runs.withColumn("action", F.when(m.isNull(), F.lit("skip")).when(m < min_value, F.lit("delete")).otherwise(F.lit("keep")))


def model_score(explicit: Sequence[str], cv_acc: str, cv_f1: str, test_acc: str, test_f1: str) -> Column:
    """Explicit score, else the mean of the four metrics when all exist, else the first available
    of test accuracy, test F1, cv accuracy, cv F1. Null-only logic (a metric of 0 counts)."""
    four = [F.col(c) for c in (cv_acc, cv_f1, test_acc, test_f1)]
    all_present = None
    for c in four:
        all_present = c.isNotNull() if all_present is None else all_present & c.isNotNull()
    mean4 = F.when(all_present, (four[0] + four[1] + four[2] + four[3]) / 4)
    return F.coalesce(*[F.col(c) for c in explicit], mean4, F.col(test_acc), F.col(test_f1), F.col(cv_acc), F.col(cv_f1))


def discover(candidates: DataFrame, top_k: int | None = 10, min_score: float | None = MIN_SCORE,
             score_col: str = "score", name_col: str = "name") -> DataFrame:
    """Require an artifact, minimum score (a null score passes), order by (has score, score,
    name) descending, top-k; ``skip_reason`` explains dropped rows (returned with ``selected``)."""
    s = F.col(score_col)
    reason = (F.when(~F.coalesce(F.col("has_artifact"), F.lit(False)), F.lit("missing artifact"))
               .when(s.isNotNull() & F.lit(min_score is not None) & (s < F.lit(min_score if min_score is not None else 0.0)),
                     F.lit("score below minimum")))
    c = candidates.withColumn("skip_reason", reason)
    order = Window.orderBy(s.isNotNull().desc(), s.desc_nulls_last(), F.col(name_col).desc())
    ok = c.filter(F.col("skip_reason").isNull()).withColumn("_pos", F.row_number().over(order))
    ok = ok.withColumn("skip_reason", F.when(F.lit(top_k is not None) & (F.col("_pos") > F.lit(top_k or 0)), F.lit("beyond top-k")))
    out = c.filter(F.col("skip_reason").isNotNull()).withColumn("_pos", F.lit(None).cast("int")).unionByName(ok)
    return out.withColumn("selected", F.col("skip_reason").isNull())


def assign_weights(members: DataFrame, score_col: str = "score") -> DataFrame:
    """Weights proportional to score when every score is positive, else equal."""
    allw = Window.partitionBy()   # member table: one row per model (bounded)
    all_pos = F.min(F.when(F.col(score_col).isNotNull() & (F.col(score_col) > 0), F.lit(1)).otherwise(F.lit(0))).over(allw) == 1
    total = F.sum(score_col).over(allw)
    n = F.count(F.lit(1)).over(allw)
    return members.withColumn("weight", F.when(all_pos & (total > 0), F.col(score_col) / total).otherwise(F.lit(1.0) / n))


def sized_ensembles(members: DataFrame, sizes: Sequence[int], score_col: str = "score", name_col: str = "model_id") -> DataFrame:
    """The members of the top-k ensemble of every size, each with its own weights."""
    best = Window.orderBy(F.col(score_col).desc_nulls_last(), F.col(name_col).desc())  # one row per model
    ranked = members.withColumn("_r", F.row_number().over(best)).withColumn("size", F.explode(F.array(*[F.lit(k) for k in sizes]))).filter(F.col("_r") <= F.col("size"))
    own = Window.partitionBy("size")
    total = F.sum(score_col).over(own)
    all_pos = F.min((F.coalesce(F.col(score_col), F.lit(0)) > 0).cast("int")).over(own) == 1
    return ranked.withColumn("weight", F.when(all_pos, F.col(score_col) / total).otherwise(F.lit(1.0) / F.count(F.lit(1)).over(own))).drop("_r")


def member_probabilities(preds: DataFrame, ph: str = "p_home", pd_: str = "p_draw", pa: str = "p_away",
                         label: str = "label") -> DataFrame:
    """E19 per member row: negative probabilities clamp to 0; when nothing positive is left, a H/D/A
    label becomes one-hot; then normalise. Rows with neither are dropped (the member failed).

    Written so each clamped value is referenced once per output: nested ``withColumns`` chains that
    reuse earlier outputs get inlined by the optimizer and multiply the expression size."""
    clamp = {n: F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for n, c in (("_h", ph), ("_d", pd_), ("_a", pa))}
    p = preds.withColumns(clamp)
    p = p.withColumns({"_t": F.col("_h") + F.col("_d") + F.col("_a"), "_lab": F.upper(F.coalesce(F.col(label), F.lit("")))})
    valid = (F.col("_t") > 0) | F.col("_lab").isin("H", "D", "A")
    out = {q: F.when(F.col("_t") > 0, F.col(src) / F.col("_t")).otherwise((F.col("_lab") == side).cast("double"))
           for q, src, side in (("q_home", "_h", "H"), ("q_draw", "_d", "D"), ("q_away", "_a", "A"))}
    return p.filter(valid).withColumns(out).drop("_h", "_d", "_a", "_t", "_lab")


def soft_vote(preds: DataFrame, members: DataFrame, row_col: str = "row_id", model_col: str = "model_id",
              goals_col: str = "goals", carry: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """E18 + E19: per row, weights renormalised over the members that produced the row, weighted
    probabilities summed and normalised, argmax label (first of H, D, A on ties), weighted mean of
    goals over members that gave one, and the number of members used.

    ``members`` (model_id, weight) has one row per model: joining it is a broadcast of a bounded
    table. ``groupBy(row_id)`` sees at most one row per member. ``carry`` columns depend on the row
    only (e.g. its label) and pass through with ``first``.
    """
    q = member_probabilities(preds).join(F.broadcast(members.select(model_col, "weight", *by)), model_col)
    q = q.withColumn("weight", F.greatest(F.col("weight"), F.lit(0.0)))
    has_goals = F.col(goals_col).isNotNull()
    g = q.groupBy(row_col, *by).agg(
        F.sum("weight").alias("_w"), F.count(F.lit(1)).alias("ensemble_size"),
        *[F.sum(F.col("weight") * F.col(f"q_{s}")).alias(f"_{s}") for s in SIDES], *[F.sum(f"q_{s}").alias(f"_e{s}") for s in SIDES],
        F.sum(F.when(has_goals, F.col("weight") * F.col(goals_col))).alias("_gs"), F.sum(F.when(has_goals, F.col("weight"))).alias("_gw"),
        F.sum(goals_col).alias("_egs"), F.count(goals_col).alias("_egw"),
        *[F.first(c).alias(c) for c in carry])
    # a zero total weight falls back to equal weights
    equal = F.col("_w") <= 0
    picked = {s: F.when(equal, F.col(f"_e{s}")).otherwise(F.col(f"_{s}")) for s in SIDES}
    g = g.withColumns({f"_p{s}": c for s, c in picked.items()} | {
        "_gs": F.when(equal, F.col("_egs")).otherwise(F.col("_gs")), "_gw": F.when(equal, F.col("_egw").cast("double")).otherwise(F.col("_gw"))})
    total = F.col("_phome") + F.col("_pdraw") + F.col("_paway")
    g = g.withColumns({f"p_{s}": F.col(f"_p{s}") / total for s in SIDES})
    return g.select(row_col, *by, "p_home", "p_draw", "p_away",
                    argmax_label("p_home", "p_draw", "p_away").alias("predicted_result"),
                    F.when(F.col("_gw") > 0, F.col("_gs") / F.col("_gw")).alias("predicted_total_goals"),
                    "ensemble_size", *carry)


def ensemble_info(members: DataFrame, found: int | None = None, discovered: DataFrame | None = None) -> DataFrame:
    """Loaded count, min/max/avg score, members ordered by weight, and (from the rows of ``discover``) the
    ignored candidates with their reasons."""
    agg = members.agg(F.count(F.lit(1)).alias("loaded"), F.min("score").alias("min_score"), F.max("score").alias("max_score"),
                      F.avg("score").alias("avg_score"),
                      F.sort_array(F.collect_list(F.struct(-F.col("weight"), F.col("model_id"))), True).alias("_m"))
    res = agg.withColumn("top_models", F.transform("_m", lambda x: x["model_id"])).drop("_m")
    if discovered is not None:
        skipped = discovered.filter(~F.col("selected")).agg(F.sort_array(F.collect_list(F.struct("name", "skip_reason"))).alias("ignored"))
        res = res.crossJoin(F.broadcast(skipped))  # one row
    return res.withColumn("found", F.lit(found)) if found is not None else res


def model_cards(runs: DataFrame) -> DataFrame:
    """One card per run: id, name, stage, feature mode, target and the headline metrics."""
    return runs.select("model_id", F.coalesce("run_name", "model_id").alias("name"), "stage", "model", "feature_mode", "target",
                       F.col("test_metrics")["accuracy"].alias("test_accuracy"), F.col("test_metrics")["f1_weighted"].alias("test_f1_weighted"),
                       F.col("cv_metrics")["accuracy"].alias("cv_accuracy"), F.col("test_metrics")["r2"].alias("test_r2"))


def payload(tables: dict[str, DataFrame]) -> DataFrame:
    """A one-row document with one array-of-structs field per report table (grids, top-k lists,
    per-class summaries). Data-sized tables are written as tables (``io.write_table``)."""
    out = None
    for name, df in tables.items():
        folded = df.agg(F.collect_list(F.struct(*df.columns)).alias(name))
        out = folded if out is None else out.crossJoin(folded)
    return out
