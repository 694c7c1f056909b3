"""ML operators: invariants and brute-force checks on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from touchline.ml import knn as K
from touchline.ml import models as M
from touchline.ml.split import expanding_folds, holdout_split
from touchline.operators import ensemble as EN
from touchline.sources.tables import table


def test_knn_matches_brute_force(spark):
    emb = table(spark, SF001, "embeddings")
    pdf = emb.toPandas()
    ref, qry = pdf[pdf.vec_id % 4 != 0], pdf[pdf.vec_id % 4 == 0]
    # small blocks force several (query block, reference block) groups
    nb = K.knn_neighbours(spark.createDataFrame(qry), spark.createDataFrame(ref), "vec_id", "embedding", "label", 3,
                          cell_rows=40).toPandas()
    R = np.stack(ref.embedding.to_numpy()).astype(float)
    for _, q in qry.head(15).iterrows():
        d = np.sqrt(((R - np.asarray(q.embedding, dtype=float)) ** 2).sum(1))
        order = np.lexsort((ref.vec_id.to_numpy(), d))[:3]
        got = nb[nb.qid == q.vec_id].sort_values("rank").rid.tolist()
        assert got == ref.vec_id.to_numpy()[order].tolist()


def test_smote_balances_classes(spark):
    emb = table(spark, SF001, "embeddings")
    out = K.smote(emb, "vec_id", "embedding", "label")
    counts = {r.label: r.n for r in out.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(set(counts.values())) == 1
    # synthetic points lie on the segment between a point and a same-class neighbour: norms stay bounded
    assert out.filter(F.size("embedding") != 64).count() == 0


def test_holdout_and_folds(spark):
    df = spark.range(0, 103).withColumn("t", F.col("id") * 7 % 103)
    split = holdout_split(df, ["t", "id"])
    assert split.filter("is_train").count() == int(103 * 0.8)
    folds = expanding_folds(split, "row_idx", 5)
    sizes = {r.fold: r.n for r in folds.filter("role = 'test'").groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sizes == {i: 103 // 6 for i in range(5)}
    # every training row of a fold precedes its test block
    bad = folds.groupBy("fold").agg(F.max(F.when(F.col("role") == "train", F.col("row_idx"))).alias("a"),
                                    F.min(F.when(F.col("role") == "test", F.col("row_idx"))).alias("b")).filter("a >= b")
    assert bad.count() == 0


def test_weights_sum_to_one_and_equal_fallback(spark):
    m = spark.createDataFrame([("a", 0.5), ("b", 0.6)], "model_id string, score double")
    w = {r.model_id: r.weight for r in EN.assign_weights(m).collect()}
    assert abs(sum(w.values()) - 1) < 1e-12 and abs(w["b"] - 0.6 / 1.1) < 1e-12
    m2 = spark.createDataFrame([("a", 0.5), ("b", None)], "model_id string, score double")
    assert {r.weight for r in EN.assign_weights(m2).collect()} == {0.5}


def test_soft_vote_rules(spark):
    members = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "model_id string, weight double")
    preds = spark.createDataFrame([
        (1, "a", 0.6, 0.2, 0.2, 2.0, None), (1, "b", None, None, None, None, "A"),       # label only -> one-hot
        (2, "a", -0.5, 0.5, 0.5, None, None),                                              # one member missing; negative clamps
    ], "row_id long, model_id string, p_home double, p_draw double, p_away double, goals double, label string")
    out = {r.row_id: r for r in EN.soft_vote(preds, members).collect()}
    assert abs(out[1].p_home - 0.3) < 1e-12 and abs(out[1].p_away - 0.6) < 1e-12 and out[1].predicted_result == "A"
    assert out[1].predicted_total_goals == 2.0 and out[1].ensemble_size == 2
    assert out[2].p_home == 0.0 and out[2].predicted_result == "D"   # tie D/A: first wins


def test_class_weights_and_population_scaler(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0), (1.0, 5.0)], "y double, v double")
    w = {r.y: r.weight for r in M.class_weights(df, "y").collect()}
    assert abs(w[0.0] - 3 / (2 * 2)) < 1e-12 and abs(w[1.0] - 3 / (2 * 1)) < 1e-12
    stats = M.population_scaler_stats(df, ["v"])
    out = sorted(r.v for r in M.population_scale(df, stats, ["v"]).collect())
    assert abs(out[0] + np.sqrt(1.5)) < 1e-9   # (1 - 3) / sqrt(8/3)


def test_out_of_fold_stage1_and_multi_target(spark):
    from touchline.ml import search as S
    df = spark.range(0, 120).select(F.col("id").alias("row_idx"), (F.col("id") % 10).cast("double").alias("a"),
                                     ((F.col("id") * 7) % 11).cast("double").alias("b"))
    df = df.withColumns({"y": 2 * F.col("a") + F.col("b"), "z": F.col("a") - F.col("b"),
                         "cls": (F.col("row_idx") % 3).cast("double")})
    oof = S.out_of_fold_stage1(df, "row_idx", ["a", "b"], "y")
    first_test = 120 - 5 * (120 // 6)
    assert oof.filter(F.col("row_idx") < first_test).filter(F.col("stage1_pred_total_goals").isNotNull()).count() == 0
    assert oof.filter(F.col("row_idx") >= first_test).filter(F.col("stage1_pred_total_goals").isNull()).count() == 0
    pred = S.two_stage(df.filter("row_idx < 100"), df.filter("row_idx >= 100"), ["a", "b"], "y", "cls", out_of_fold=True)
    assert pred.count() == 20
    runs = S.multi_target_fits(df.filter("row_idx < 100"), df.filter("row_idx >= 100"), ["a", "b"], ["y", "z"], [("linear", {})])
    r = {x.target: x.test_r2 for x in runs.collect()}
    assert set(r) == {"y", "z"} and r["y"] > 0.99   # y is linear in the features


def test_knn_of_exact_copies_has_zero_distance(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(50, 8)).round(3) + 1000.0
    ref = [(i, [float(x) for x in base[i % 50]], float(i % 2)) for i in range(200)]
    df = spark.createDataFrame(ref, "id long, vec array<double>, label double")
    for metric in ("l2", "l1"):
        nb = K.knn_neighbours(df, df, "id", "vec", "label", 4, metric, cell_rows=33).toPandas()
        assert (nb.dist == 0).all()
        assert nb.sort_values(["qid", "rank"]).rid.tolist() == [q % 50 + 50 * j for q in range(200) for j in range(4)]


def test_smote_ids_are_distinct_and_single_rows_are_copied(spark):
    rows = [(i, [float(i), 1.0], 0.0) for i in range(3000)] + [(5000, [7.0, 7.0], 1.0), (5001, [1.0, 2.0], 2.0), (5002, [2.0, 2.0], 2.0)]
    out = K.smote(spark.createDataFrame(rows, "id long, v array<double>, y double"), "id", "v", "y").toPandas()
    assert out.id.is_unique and out.groupby("y").size().tolist() == [3000, 3000, 3000]
    assert set(map(tuple, out[out.y == 1.0].v)) == {(7.0, 7.0)}


def _brute(rows, queries, k, metric, before=False):
    out = []
    for q in queries:
        pool = [r for r in rows if not before or r[3] < q[3]]
        gap = [np.asarray(r[1]) - np.asarray(q[1]) for r in pool]
        dist = [float(np.abs(g).sum() if metric == "l1" else np.sqrt((g ** 2).sum())) for g in gap]
        out += [(q[0], pool[i][0], round(dist[i], 9)) for i in sorted(range(len(pool)), key=lambda i: (dist[i], pool[i][0]))[:k]]
    return sorted(out)


def _clustered(n, seed=4, size=6, centres=40, spread=0.02):
    rng = np.random.default_rng(seed)
    at = rng.normal(size=(centres, size))
    return [(i, (at[rng.integers(0, centres)] + spread * rng.normal(size=size)).round(3).tolist(), float(i % 3), int(i % 5)) for i in range(n)]


KNN = "id long, vec array<double>, label double, fold int"


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_pivot_cells_spare_the_shuffle_and_stay_exact(spark, metric):
    """Below a tenth of the rows that blocks against blocks of the same size would shuffle."""
    rows = _clustered(4000)
    queries = [(100_000 + r[0], *r[1:]) for r in _clustered(2000, seed=4)[::2]]
    work = {}
    found = K.knn_neighbours(spark.createDataFrame(queries, KNN), spark.createDataFrame(rows, KNN), "id", "vec", "label", 5, metric, cell_rows=40, work=work)
    got = sorted((r.qid, r.rid, round(r.dist, 9)) for r in found.collect())
    assert got == _brute(rows, queries, 5, metric)
    blocks = 2 * len(queries) * len(rows) // 40
    assert work["rows"] < blocks / 10


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_pivot_knn_with_folds_parts_spans_ties_and_odd_rows(spark, metric):
    rng = np.random.default_rng(9)
    rows = [(i, rng.integers(0, 3, 3).astype(float).tolist(), 1.0, int(rng.integers(0, 4))) for i in range(300)] + [(900, None, 1.0, 0)]
    frame = spark.createDataFrame(rows, KNN)
    found = K.knn_neighbours(frame, frame, "id", "vec", "label", 7, metric, before_col="fold", cell_rows=20, part_rows=6, query_rows=9)
    got = sorted((r.qid, r.rid, round(r.dist, 9)) for r in found.collect())
    assert got == _brute(rows[:-1], rows[:-1], 7, metric, before=True)
    empty = frame.filter("false")
    assert K.knn_neighbours(frame, empty, "id", "vec", "label", 3, metric).count() == 0 == K.knn_neighbours(empty, frame, "id", "vec", "label", 3, metric).count()
    few = K.knn_neighbours(frame, frame.limit(2), "id", "vec", "label", 5, metric)
    assert few.filter("qid < 900").groupBy("qid").count().select("count").distinct().collect()[0][0] == 2


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_leaves_of_a_cell_lose_no_neighbour(metric):
    rng = np.random.default_rng(3)
    r, q = rng.integers(0, 6, (900, 3)).astype(float), rng.normal(3, 2, (400, 3))  # many copies and ties
    parts = K.leaves(r)
    assert sorted(np.concatenate(parts)) == list(range(900)) and max(map(len, parts)) <= K.LEAF
    pivot, limit = r.mean(axis=0), np.inf
    away, q_away = K.from_pivots(r, pivot[None], metric)[:, 0], K.from_pivots(q, pivot[None], metric)[:, 0]
    rows = pd.DataFrame({"id": np.arange(900), "vec": list(r), "label": 0.0, "before": np.arange(900) % 4, "away": away})
    asked = pd.DataFrame({"qid": np.arange(400), "q_vec": list(q), "q_before": np.arange(400) % 5, "limit": limit, "q_away": q_away})
    found = K.nearest_in_cell(4, metric, True)(asked, rows).groupby("qid")["rid"].apply(list).to_dict()
    for i in range(400):
        gap = np.abs(r - q[i])
        dist = gap.sum(1) if metric == "l1" else np.sqrt((gap ** 2).sum(1))
        dist[(rows["before"] >= i % 5) | (rows["id"] == i)] = np.inf
        best = [int(j) for j in np.lexsort((np.arange(900), dist))[:4] if np.isfinite(dist[j])]
        assert found.get(i, []) == best


def test_least_squares_of_all_folds_equal_single_fits(spark):
    import json

    from touchline.ml import search as S
    from touchline.operators.evaluate import regression_metrics
    rng = np.random.default_rng(4)
    data = [(i, float(x), float(3 * x + z), 1.0, float(x + z + rng.normal()), float(z)) for i, (x, z) in enumerate(rng.normal(size=(90, 2)))]
    df = spark.createDataFrame(data, "i long, a double, b double, same double, y double, t double").checkpoint()
    reg = M.ridge_reg_param(df, "y", 5.0)
    got = {(r["params"], r["fold"]): r["score"] for r in S.search(df, "i", ["a", "b", "same"], "y", "ridge", "regressor", {"regParam": [0.0, reg]}, n_splits=2, impute=None).collect()}
    for p in (0.0, reg):
        fit = M.build_pipeline(["a", "b", "same"], M.estimator("ridge", "regressor", label="y", regParam=p), impute=None).fit(df.filter("i < 60"))
        want = regression_metrics(fit.transform(df.filter("i >= 60")), "y", "prediction").first()["r2"]
        assert got[json.dumps({"regParam": p}), 1] == pytest.approx(want, abs=1e-7)
    assert len(got) == 4
    run = S.multi_target_fits(df.filter("i < 60"), df.filter("i >= 60"), ["a", "b", "same"], ["y", "t"], [("linear", {})], idx_col="i", n_splits=2).collect()
    fit = M.build_pipeline(["a", "b", "same"], M.estimator("linear", "regressor", label="y"), impute=None).fit(df.filter("i < 60"))
    want = regression_metrics(fit.transform(df.filter("i >= 60")), "y", "prediction").first()
    assert [r["run_name"] for r in run] == ["y:linear", "t:linear"]
    assert (run[0]["test_r2"], run[0]["test_rmse"]) == (pytest.approx(want["r2"], abs=1e-7), pytest.approx(want["rmse"], abs=1e-7))
    assert run[1]["test_r2"] == pytest.approx(1.0) and run[1]["cv_r2"] == pytest.approx(1.0)


@pytest.mark.parametrize("metric", ["l1", "l2"])
def test_queries_move_once_to_a_run_of_cells(spark, metric):
    """Without structure every query meets every cell: 100 cells here, of which a run holds several."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(2500, 12)).astype(np.float32)
    x[40:60] = x[40]  # ties go by id
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], float(i % 3)) for i in range(2500)], "id long, vec array<float>, label double").checkpoint()
    work = {}
    found = K.knn_neighbours(df.filter("id >= 2000"), df.filter("id < 2000"), "id", "vec", "label", 4, metric, cell_rows=20, work=work).toPandas()
    assert work["rows"] < 20_000  # 500 queries at about 100 cells: above 50,000 before
    wide = x.astype(np.float64)
    for q in range(2000, 2500, 7):
        gap = wide[:2000] - wide[q]
        d = np.abs(gap).sum(1) if metric == "l1" else np.sqrt((gap ** 2).sum(1))
        want = np.lexsort((np.arange(2000), d))[:4]
        own = found[found["qid"] == q].sort_values("rank")
        assert own["rid"].tolist() == want.tolist() and np.allclose(own["dist"], d[want], rtol=1e-12)
    assert K.runs_of_cells(np.array([5, 5, 30, 4, 7]), 20, 11).tolist() == [0, 0, 1, 2, 2]
