"""AUC and quantiles when half of all rows share one value."""

import numpy as np
from pyspark.sql import functions as F

from touchline.operators import evaluate as EV
from touchline.operators import profile as PR


def test_auc_and_quantiles_with_half_the_rows_equal(spark):
    rng = np.random.default_rng(6)
    n = 4000
    score = np.where(np.arange(n) % 2 == 0, 0.5, rng.integers(0, 40, n) / 40)
    label = (rng.random(n) < 0.2 + 0.5 * score).astype(int)
    group = np.where(rng.random(n) < 0.8, "a", "b")
    rows = [(str(g), float(s), int(y)) for g, s, y in zip(group, score, label)] + [(None, 0.5, 1), (None, 0.25, 0), (None, None, 1), ("c", None, 0)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(8)
    got = {r.g: r.auc for r in EV.auc(df, "y", "s", ["g"]).collect()}
    for g in ("a", "b"):
        p, q = score[(group == g) & (label == 1)], score[(group == g) & (label == 0)]
        assert abs(got[g] - ((p[:, None] > q).sum() + 0.5 * (p[:, None] == q).sum()) / (len(p) * len(q))) < 1e-12
    assert got[None] == 1.0
    found = {r.g: r for r in PR.describe_by(df, "g", "s").collect()}
    for g in ("a", "b"):
        own = score[group == g]
        assert np.allclose([found[g][c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")],
                           [len(own), own.mean(), own.std(ddof=1), own.min(), *np.quantile(own, [0.25, 0.5, 0.75]), own.max()])
    assert (found["c"]["count"], found["c"].q50, found[None]["count"], found[None].q50) == (0, None, 2, 0.375)
    whole = PR.ranked_quantiles(df, "s", {"m": 0.5}, None, [F.count("_v").alias("n")]).first()
    assert whole.n == n + 2 and whole.m == np.quantile([*score, 0.5, 0.25], 0.5)


def test_ties_are_counted_before_they_are_ordered(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0.5).otherwise(F.col("id") % 97 / 97).alias("s"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    points = EV.roc_points(df, "y", "s")
    assert points.count() <= 98 and points.agg(F.max(F.col("pos") + F.col("neg"))).first()[0] >= 10_000
