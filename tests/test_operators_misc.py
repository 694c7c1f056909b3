"""Cleaning, merging, ranking, scoring and persistence helpers on hand-made frames."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from touchline.functions import clean
from touchline.ml import models as M
from touchline.operators import ensemble as EN
from touchline.operators import features, reshape
from touchline.operators import scoring as SC
from touchline.operators import shots as S
from touchline.schemas import SchemaError


def test_strict_numeric_names_bad_columns(spark):
    df = spark.createDataFrame([("1.0", "x")], "a string, b string")
    with pytest.raises(SchemaError, match="b"):
        clean.strict_numeric(df, ["a", "b"])
    with pytest.raises(SchemaError, match="c"):
        clean.strict_numeric(df, ["a", "c"])
    assert clean.strict_numeric(df, ["a"]).first().a == 1.0


def test_prepare_matches_and_placeholders(spark):
    raw = spark.createDataFrame([(1, "01/02/2024", "15:00", " Spurs", "Arsenal FC", "2", "1", "H"),
                                 (2, "bad", "15:00", "A", "B", "0", "0", "D"), (3, "02/02/2024", "15:00", "A", "B", "1", "1", None)],
                                "id long, date string, time string, home_team string, away_team string, fthg string, ftag string, ftr string")
    out = features.prepare_matches(raw).collect()
    assert [r.id for r in out] == [1] and out[0].home_team == "Tottenham" and out[0].away_team == "Arsenal" and out[0].total_goals == 3.0
    filled = clean.fill_placeholders(raw.select("id", "ftr"), features.RAW_MATCH_PLACEHOLDERS)
    assert {"hs", "fthg"} <= set(filled.columns) and filled.filter("id = 3").first().ftr == "D"


def test_coalescing_merge_and_valid_location(spark):
    left = spark.createDataFrame([(1, None), (2, "a")], "id long, q string")
    right = spark.createDataFrame([(1, "b"), (2, "c")], "id long, q string")
    got = {r.id: r.q for r in S.coalescing_merge(left, right, "id", ["q"]).collect()}
    assert got == {1: "b", 2: "a"}
    pts = spark.createDataFrame([(0.0, 0.0), (None, 3.0), (10.0, 0.0)], "x double, y double")
    assert pts.filter(clean.valid_location("x", "y")).count() == 1


def test_rank_best_and_retention(spark):
    runs = spark.createDataFrame([("a", "goals", 0.2, 0.3), ("b", "goals", 0.4, 0.1), ("c", "idx", 0.5, 0.5), ("d", "goals", None, 0.9)],
                                 "run_name string, target string, cv_r2 double, test_r2 double")
    ranked = EN.rank_regressors(runs)
    assert [r.run_name for r in ranked.orderBy("rank").collect()] == ["c", "a", "b"]
    best = {r.target: r.run_name for r in EN.best_per_group(ranked, "target").collect()}
    assert best == {"goals": "a", "idx": "c"}
    acts = {r.run_name: r.action for r in EN.retention_report(runs, "cv_r2", 0.3).collect()}
    assert acts == {"a": "delete", "b": "keep", "c": "keep", "d": "skip"}


def test_model_score_chain_null_only(spark):
    df = spark.createDataFrame([(None, 0.0, 0.5, 0.5, 0.5), (None, None, None, 0.0, 0.7), (0.9, 0.1, 0.1, 0.1, 0.1)],
                               "score double, cv_acc double, cv_f1 double, test_acc double, test_f1 double")
    got = [r.s for r in df.select(EN.model_score(["score"], "cv_acc", "cv_f1", "test_acc", "test_f1").alias("s")).collect()]
    assert got == [0.375, 0.0, 0.9]   # a metric of 0 counts (null-only logic)


def test_batch_tasks_and_modes(spark):
    batch = spark.createDataFrame([(1, "A", "B"), (2, "C", "D")], "row_id long, home_team string, away_team string")
    league = spark.createDataFrame([(0.5, 0.3, 0.2)], "lg_home double, lg_draw double, lg_away double")
    ens = spark.createDataFrame([(1, 0.6, 0.3, 0.1, 2.5)], "row_id long, p_home double, p_draw double, p_away double, goals double")
    res = SC.score_match_batch(batch, "match_result", {"ensemble": ens}, league).collect()
    by = {r.row_id: r for r in res}
    assert by[1].source == "ensemble" and by[2].source == "league_average_fallback" and "expected_goals" not in res[0].asDict()
    goals = SC.score_match_batch(batch, "match_goals", {"ensemble": ens}, league)
    assert "predicted_result" not in goals.columns and "expected_goals" in goals.columns
    assert SC.overall_mode(SC.score_match_batch(batch, "match", {"ensemble": ens}, league)).first().mode == "ensemble"
    with pytest.raises(SchemaError, match="task"):
        SC.score_match_batch(batch, "nope", {}, league)
    with pytest.raises(SchemaError, match="x"):
        SC.score_xg_batch(spark.createDataFrame([(1, 2)], "a int, b int"))


def test_persistence_importance_export(spark):
    df = spark.range(0, 60).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"),
                                   (F.col("id") % 2).cast("double").alias("label"))
    model = M.build_pipeline(["a", "b"], M.estimator("logistic", "classifier"), scale=False).fit(df)
    d = tempfile.mkdtemp(prefix="tl-model-", dir="/tmp")
    M.save(model, os.path.join(d, "m"))
    again = M.load(os.path.join(d, "m"))
    assert again.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()
    imp = M.coefficient_importance(model, ["a", "b"])
    assert [n for n, _ in imp] and all(v >= 0 for _, v in imp) and imp[0][1] >= imp[1][1]
    pred = M.probabilities(model.transform(df), names=("p0", "p1"))
    exp = M.prediction_export(pred.withColumn("id", F.lit(1)), probs=("p0", "p1")).first()
    assert abs(exp.p0_pct + exp.p1_pct - 100) < 0.02


def test_new_ids_and_payload(spark):
    existing = spark.createDataFrame([(5,), (9,)], "id long")
    new = spark.createDataFrame([("b", 2), ("a", 1)], "name string, t long")
    got = sorted((r.t, r.id) for r in reshape.assign_new_ids(existing, new, "id", ["t"]).collect())
    assert got == [(1, 10), (2, 11)]
    doc = EN.payload({"grid": spark.createDataFrame([("H", 1)], "k string, n long"), "top": spark.range(3)})
    row = doc.first()
    assert len(row.grid) == 1 and len(row.top) == 3


def test_metrics_count_rows_outside_the_list_as_wrong(spark):
    from touchline.operators import evaluate as EV
    df = spark.createDataFrame([("H", "H"), ("D", "X"), ("A", None)], "l string, p string")
    m = EV.summary_metrics(EV.outcome_counts(df, "l", "p")).first()
    assert m.n == 3 and abs(m.accuracy - 1 / 3) < 1e-12
    assert EV.confusion(df, "l", "p").agg(F.sum("count")).first()[0] == 1 and EV.confusion(df, "l", "p").count() == 9


def test_auc_by_ranks_equals_the_curve(spark):
    from touchline.operators import evaluate as EV
    rows = [(i % 3, (i * 7 % 11) / 11, int(i * 5 % 13 < 5 + i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, s double, y int")
    got = {r.g: r.auc for r in EV.auc(df, "y", "s", by=["g"]).collect()}
    for g in range(3):
        pos, neg = ([s for a, s, y in rows if a == g and y == k] for k in (1, 0))
        want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
        assert abs(got[g] - want) < 1e-12
    assert EV.auc(df.filter("y = 1"), "y", "s").first().auc is None
    last = EV.roc_points(df, "y", "s", by=["g"]).groupBy("g").agg(F.max("tpr").alias("t"), F.max("fpr").alias("f")).collect()
    assert all(r.t == 1.0 and r.f == 1.0 for r in last)
