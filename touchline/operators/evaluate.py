"""Evaluation over prediction tables.

Every metric is an aggregation over (label, prediction) rows, grouped by an optional ``by`` column
(system, fold, threshold), so many systems are scored in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.windows import running_totals

LABELS = ("H", "D", "A")


OTHER = "(other)"


def outcome_counts(df: DataFrame, label: str, pred: str, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Counts of (actual, predicted) per ``by`` group, one pass; a null or a value outside ``labels``
    counts as ``(other)``, so no row is lost."""
    known = lambda c: F.when(F.col(c).isin(*labels), F.col(c)).otherwise(F.lit(OTHER))
    return df.groupBy(*by, known(label).alias("actual"), known(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def zero_filled(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """The ``labels x labels`` grid of ``outcome_counts`` with zero cells, as one aggregate per group."""
    cells = [F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
                      F.coalesce(F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("count"))), F.lit(0)).alias("count"))
             for a in labels for p in labels]
    grid = counts.groupBy(*by).agg(F.array(*cells).alias("_c"))
    return grid.select(*by, F.explode("_c").alias("_c")).select(*by, "_c.*")


def confusion(df: DataFrame, label: str, pred: str, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts on the fixed ``labels x labels`` grid (zero cells kept), per ``by`` group."""
    return zero_filled(outcome_counts(df, label, pred, labels, by), labels, by)


def class_metrics(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Per-class precision, recall, F1 and support (zero division -> 0) from ``outcome_counts`` or
    ``confusion``; one aggregate per group."""
    sums = []
    for c in labels:
        actual, predicted = F.col("actual") == c, F.col("predicted") == c
        sums.append(F.struct(F.lit(c).alias("cls"), *[F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0)).alias(name)
                                                     for name, cond in (("tp", actual & predicted), ("support", actual), ("predicted_n", predicted))]))
    m = counts.groupBy(*by).agg(F.array(*sums).alias("_c")).select(*by, F.explode("_c").alias("_c")).select(*by, "_c.*")
    prec = F.when(F.col("predicted_n") > 0, F.col("tp") / F.col("predicted_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    m = m.withColumns({"precision": prec, "recall": rec})
    f1 = F.when((F.col("precision") + F.col("recall")) > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return m.withColumn("f1", f1).select(*by, "cls", "tp", "support", "predicted_n", "precision", "recall", "f1")


def summary_metrics(counts: DataFrame, labels: Sequence[str] = LABELS, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted precision/recall/F1 per group. Rows of ``(other)`` in
    ``outcome_counts`` are wrong predictions: they count in ``n`` and in the accuracy's denominator."""
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0))
    aggs = [F.sum("count").alias("n")]
    for i, c in enumerate(labels):
        actual, predicted = F.col("actual") == c, F.col("predicted") == c
        aggs += [total(actual & predicted).alias(f"_tp{i}"), total(actual).alias(f"_s{i}"), total(predicted).alias(f"_p{i}")]
    g = counts.groupBy(*by).agg(*aggs)
    k = range(len(labels))
    prec = [F.when(F.col(f"_p{i}") > 0, F.col(f"_tp{i}") / F.col(f"_p{i}")).otherwise(F.lit(0.0)) for i in k]
    rec = [F.when(F.col(f"_s{i}") > 0, F.col(f"_tp{i}") / F.col(f"_s{i}")).otherwise(F.lit(0.0)) for i in k]
    g = g.withColumns({f"_pr{i}": prec[i] for i in k} | {f"_re{i}": rec[i] for i in k})
    g = g.withColumns({f"_f{i}": F.when(F.col(f"_pr{i}") + F.col(f"_re{i}") > 0,
                                        2 * F.col(f"_pr{i}") * F.col(f"_re{i}") / (F.col(f"_pr{i}") + F.col(f"_re{i}"))).otherwise(F.lit(0.0)) for i in k})
    support = sum(F.col(f"_s{i}") for i in k)
    out = {"accuracy": F.try_divide(sum(F.col(f"_tp{i}") for i in k), F.col("n"))}
    for name, col in (("precision", "_pr"), ("recall", "_re"), ("f1", "_f")):
        out[f"{name}_macro"] = sum(F.col(f"{col}{i}") for i in k) / len(labels)
        out[f"{name}_weighted"] = F.try_divide(sum(F.col(f"{col}{i}") * F.col(f"_s{i}") for i in k), support)
    order = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted"]
    return g.select(*by, *[out[c].alias(c) for c in order], "n")


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 = 1 - SSE/SST in one aggregate (SST = n x population variance); R2 is null when
    the actual values do not vary."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    base = df.select(*by, y.alias("_y"), p.alias("_p")).filter(F.col("_y").isNotNull() & F.col("_p").isNotNull())
    error = F.col("_y") - F.col("_p")
    agg = [F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error ** 2)).alias("rmse"),
           (1 - F.try_divide(F.sum(error ** 2), F.var_pop("_y") * F.count(F.lit(1)))).alias("r2"), F.count(F.lit(1)).alias("n")]
    return base.groupBy(*by).agg(*agg)


def _scored(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    rows = df.select(*by, F.col(score).cast("double").alias("score"), F.col(label).cast("long").alias("_y"))
    return rows.filter(F.col("score").isNotNull() & F.col("_y").isNotNull())


def roc_points(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """ROC curve: one point per distinct score (descending), cumulative TPR/FPR.

    Positives and negatives per distinct score come from one aggregation; their running totals are
    distributed prefix sums over (group, score), so neither a group nor the whole curve is one task.
    """
    g = _scored(df, label, score, by).groupBy(*by, "score").agg(F.sum("_y").alias("pos"), F.sum(1 - F.col("_y")).alias("neg"))
    run = running_totals(g, [*by, F.col("score").desc()], {"pos": "_cp", "neg": "_cn"})
    groups = run.groupBy(*[F.col(c).alias(f"_g_{c}") for c in by]).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.min(F.col("_cp") - F.col("pos")).alias("_bp"), F.min(F.col("_cn") - F.col("neg")).alias("_bn"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    j = run.join(groups, same) if by else run.crossJoin(F.broadcast(groups))  # one row
    j = j.withColumns({"tp": F.col("_cp") - F.col("_bp"), "fp": F.col("_cn") - F.col("_bn")})
    return j.select(*by, "score", "pos", "neg", "tp", "fp", "P", "N", F.try_divide("tp", "P").alias("tpr"), F.try_divide("fp", "N").alias("fpr"))


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over distinct scores: a negative counts the positives above it
    and half of those beside it. Rows of an equal score are counted before anything is ordered, so ties, however
    many, never share a task; null when a class is absent."""
    points = roc_points(df, label, score, by)
    won = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    return points.groupBy(*by).agg(won.alias("_w"), F.max("P").alias("_p"), F.max("N").alias("_n")).select(
        *by, F.try_divide("_w", F.col("_p").cast("double") * F.col("_n")).alias("auc"))


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: Sequence[float] = (0.3, 0.5, 0.7)) -> DataFrame:
    """E5: binary metrics at each threshold (predict 1 when score >= t), all thresholds in one aggregate."""
    y, score = F.col(label).cast("int"), F.col(score).cast("double")
    per = []
    for t in thresholds:
        p = (score >= F.lit(float(t))).cast("int")
        per.append(F.struct(F.lit(float(t)).alias("threshold"), F.avg((p == y).cast("double")).alias("accuracy"),
                            F.sum(p * y).alias("tp"), F.sum(p).alias("pred_pos"), F.sum(y).alias("pos")))
    g = df.agg(F.array(*per).alias("_t")).select(F.explode("_t").alias("_t")).select("_t.*")
    prec = F.when(F.col("pred_pos") > 0, F.col("tp") / F.col("pred_pos")).otherwise(F.lit(0.0))
    rec = F.when(F.col("pos") > 0, F.col("tp") / F.col("pos")).otherwise(F.lit(0.0))
    g = g.withColumns({"precision": prec, "recall": rec})
    return g.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                     2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))


def naive_baseline(df: DataFrame, label: str) -> DataFrame:
    """Accuracy of always predicting the negative class."""
    return df.agg((1 - F.avg(F.col(label).cast("double"))).alias("naive_accuracy"), F.count(F.lit(1)).alias("n"))


def fold_summary(per_fold: DataFrame, metric: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of a metric over folds."""
    agg = [F.avg(metric).alias(f"cv_{metric}_mean"), F.stddev_pop(metric).alias(f"cv_{metric}_std"), F.count(F.lit(1)).alias("folds")]
    return per_fold.groupBy(*by).agg(*agg) if by else per_fold.agg(*agg)


def compare(metrics: DataFrame, system_col: str, metric_cols: Sequence[str], baseline: str) -> DataFrame:
    """Each system's metrics minus the baseline system's. The metric table has one row per
    system, so a global window over it is bounded and the table is computed once."""
    every = Window.partitionBy()
    return metrics.withColumns({
        f"{m}_gap": F.col(m) - F.max(F.when(F.col(system_col) == baseline, F.col(m))).over(every) for m in metric_cols})


def residuals(df: DataFrame, actual: str, predicted: str, keep: Sequence[str] = ()) -> DataFrame:
    """Actual, predicted, residual."""
    return df.select(*keep, F.col(actual).cast("double").alias("actual"), F.col(predicted).cast("double").alias("predicted"),
                     (F.col(actual).cast("double") - F.col(predicted).cast("double")).alias("residual"))

