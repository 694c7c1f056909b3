"""Regression and logistic grids against plain numpy solutions."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.ml import gram as G
from touchline.ml import logistic_grid as L

POINTS = [G.Point("linear"), G.Point("ridge", 5.0), G.Point("elasticnet", 0.05, 0.5), G.Point("elasticnet", 0.5, 0.9), G.Point("elasticnet", 0.001, 0.05)]


def table(n=600, size=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size)) * [1, 10, 0.1, 3] + [0, 1e4, 5, 0]
    x[:, 3] = x[:, 0] + 0.3 * x[:, 3]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=n)
    s = x[:, 0] + 0.2 * (x[:, 1] - 1e4) + rng.normal(size=n)
    fold = np.repeat([-1, 0, 1, 2], [n - 3 * (n // 4)] + [n // 4] * 3)
    return x, y, np.where(s > 0.7, 0, np.where(s < -0.7, 2, 1)), fold


def frame(spark, x, y, label, fold, parts=5):
    rows = [(*map(float, r), float(t), int(k), int(f)) for r, t, k, f in zip(x, y, label, fold)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, label int, fold int").repartition(parts)


def plain_elastic(x, y, point):
    """By proximal gradient on the standardised rows."""
    mean, std = x.mean(0), x.std(0)
    z, t, n = (x - mean) / std, y - y.mean(), len(y)
    l1, l2 = point.penalties(n)
    w, v, k, step = np.zeros(x.shape[1]), np.zeros(x.shape[1]), 1.0, 1 / (np.linalg.eigvalsh(z.T @ z).max() + l2)
    for _ in range(20_000):
        moved = v - step * (z.T @ (z @ v - t) + l2 * v)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
        k, last = (1 + np.sqrt(1 + 4 * k * k)) / 2, k
        v, w = new + (last - 1) / k * (new - w), new
    return w / std, y.mean() - (w / std) @ mean


def test_moments_merge_to_those_of_all_rows(spark):
    x, y, label, fold = table()
    moments = G.block_moments(frame(spark, x, y, label, fold, 7), ["a", "b", "c", "d", "y"], "fold")
    rows = np.column_stack([x, y])
    assert sorted(moments) == [-1, 0, 1, 2]
    for f, train in G.expanding(moments, [0, 1, 2]).items():
        want = G.Moments.of(rows[fold < f])
        assert train.n == want.n and np.allclose(train.mean, want.mean, rtol=1e-12) and np.allclose(train.cross, want.cross, rtol=1e-9, atol=1e-6)


def test_regression_grid_equals_plain_solutions(spark):
    x, y, label, fold = table()
    got = {(r.model, r.alpha, r.l1_ratio, r.fold): r for r in G.grid_scores(frame(spark, x, y, label, fold), ["a", "b", "c", "d"], "y", "fold", POINTS).collect()}
    assert len(got) == len(POINTS) * 3
    for f in range(3):
        for p in POINTS:
            w, b = plain_elastic(x[fold < f], y[fold < f], p)
            gap, own = y[fold == f] - x[fold == f] @ w - b, got[p.model, p.alpha, p.l1_ratio, f]
            assert own.n == (fold == f).sum()
            assert np.allclose([own.rmse, own.mae, own.r2], [np.sqrt((gap ** 2).mean()), np.abs(gap).mean(), 1 - (gap ** 2).mean() / y[fold == f].var()], atol=1e-6)


def test_constant_columns_empty_folds_and_means(spark):
    x, y, label, fold = table(80)
    x[:, 2] = 3.0
    scores = G.grid_scores(frame(spark, x, y, label, np.where(fold == 1, 2, fold)), ["a", "b", "c", "d"], "y", "fold", POINTS)
    assert sorted({r.fold for r in scores.collect()}) == [0, 2]
    best = G.fold_means(scores).orderBy("model", "rank").collect()
    assert len(best) == len(POINTS) and all(r.folds == 2 for r in best)
    elastic = [r.mean_r2 for r in best if r.model == "elasticnet"]
    assert elastic == sorted(elastic, reverse=True) and [r.rank for r in best if r.model == "elasticnet"] == [1, 2, 3]


def softmax(logits):
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def plain_logistic(x, label, c, l1_ratio, classes=3):
    """One point by proximal gradient with momentum."""
    mean, std = x.mean(0), x.std(0)
    z, n = np.column_stack([(x - mean) / std, np.ones(len(x))]), len(x)
    one = np.eye(classes)[label]
    l1, l2 = np.append(np.full(x.shape[1], l1_ratio / c / n), 0), np.append(np.full(x.shape[1], (1 - l1_ratio) / c / n), 0)
    w = v = np.zeros((z.shape[1], classes))
    k, step = 1.0, 1 / (np.linalg.eigvalsh(z.T @ z / n).max() / 2 + l2.max())
    for _ in range(30_000):
        moved = v - step * (z.T @ (softmax(z @ v) - one) / n + l2[:, None] * v)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * l1[:, None], 0)
        if ((v - new) * (new - w)).sum() > 0:
            k, v = 1.0, new
        else:
            k, last = (1 + np.sqrt(1 + 4 * k * k)) / 2, k
            v = new + (last - 1) / k * (new - w)
        done, w = np.abs(new - w).max() < 1e-12, new
        if done:
            break
    return w[:-1], w[-1] - w[-1].mean()


def test_logistic_grid_equals_single_fits(spark):
    x, y, label, fold = table(500)
    points = [(0.05, 0.95), (0.5, 0.5), (5.0, 0.05)]
    data = frame(spark, x, y, label, fold)
    tensor, scans = L.fit_grid(data, ["a", "b", "c", "d"], "label", "fold", points)
    assert scans < 30  # one scan a round for all points and folds
    for i, f in enumerate(tensor.folds):
        for j, (c, l1) in enumerate(points):
            w, b = plain_logistic(x[fold < f], label[fold < f], c, l1)
            assert np.abs(tensor.w[i, j, :-1] - w).max() < 1e-6 and np.abs(tensor.w[i, j, -1] - b).max() < 1e-6
    rows, every = L.selected(data, ["a", "b", "c", "d"], "label", "fold"), np.ones(tensor.w.shape[:2], dtype=bool)
    assert tensor.violation(tensor.sums(rows, tensor.w, every)[1]).max() < 1e-6
    tensor.w = tensor.w + 0.01 * np.arange(3)
    assert tensor.violation(tensor.sums(rows, tensor.w, every)[1]).min() > 1e-4


def test_logistic_scores_equal_plain_counts(spark):
    x, y, label, fold = table(400)
    data = frame(spark, x, y, label, fold)
    tensor, _ = L.fit_grid(data, ["a", "b", "c", "d"], "label", "fold", [(1.0, 0.3)])
    got = {r.fold: r for r in L.class_scores(L.confusion(data, ["a", "b", "c", "d"], "label", "fold", tensor)).collect()}
    for i, f in enumerate(tensor.folds):
        own = fold == f
        best = (tensor.scaled(x[own], i) @ tensor.w[i, 0]).argmax(1)
        true = label[own]
        f1 = [2 * ((best == k) & (true == k)).sum() / max((best == k).sum() + (true == k).sum(), 1) for k in range(3)]
        assert got[f].n == own.sum() and got[f].accuracy == pytest.approx((best == true).mean())
        assert got[f].f1_weighted == pytest.approx(sum(s * (true == k).mean() for k, s in enumerate(f1)))


def test_grid_scans_do_not_grow_with_the_points(spark):
    x, y, label, fold = table(200)
    moments = frame(spark, x, y, label, fold).select(F.col("fold").cast("int"), "a", "b", "c", "d", "y")
    data = G.block_moments(moments, ["a", "b", "c", "d", "y"], "fold")
    few, many = (G.solve(G.expanding(data, [2])[2], pts) for pts in (POINTS, POINTS * 3))
    assert {p: round(v[1], 9) for p, v in few.items()} == {p: round(v[1], 9) for p, v in many.items()}


def test_shared_class_products_equal_the_plain_curvature(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = pd.DataFrame({"_f": rng.integers(-1, 2, 300), "_y": rng.integers(0, 3, 300), "_0": rng.normal(size=300), "_1": rng.normal(size=300)})
    train = {f: G.Moments.of(rows.loc[rows["_f"] < f, ["_0", "_1", "_y"]].to_numpy(float)) for f in (0, 1)}
    tensor = L.Tensor(train, [(1.0, 0.5), (2.0, 0.1)], 3)
    w = rng.normal(size=tensor.w.shape)
    shapes = []
    monkeypatch.setattr(L, "summed", lambda _, task: shapes.append(task([pa.RecordBatch.from_pandas(rows)])) or shapes[-1])
    loss, slope, curve = tensor.sums(None, w, np.ones((2, 2), dtype=bool))
    assert len(shapes[0]) == 2 * 2 * (1 + 9 + 6 * 3)  # three products of classes a feature pair, not six
    for i, f in enumerate(tensor.folds):
        own = rows[rows["_f"] < f]
        z, y = tensor.scaled(own[["_0", "_1"]].to_numpy(float), i), own["_y"].to_numpy()
        for j in range(2):
            e = np.exp(z @ w[i, j])
            p, hot = e / e.sum(axis=1, keepdims=True), np.eye(3)[y]
            assert np.isclose(loss[i, j], -np.log(p[np.arange(len(y)), y]).mean())
            assert np.allclose(slope[i, j], z.T @ (p - hot) / len(y))
            plain = np.einsum("rj,rk,rab->jakb", z, z, np.eye(3) * p[:, :, None] - p[:, :, None] * p[:, None, :]) / len(y)
            assert np.allclose(curve[i, j], plain.reshape(9, 9))


def test_weak_penalties_take_few_scans(spark):
    """A weak penalty alone fixes the shift of a feature's weights over the classes, as on large tables."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 4))
    y = (x @ rng.normal(size=(4, 3)) + rng.gumbel(size=(900, 3)) * 2).argmax(axis=1)
    rows = [(int(i // 300) - 1, int(y[i]), *map(float, x[i])) for i in range(900)]
    df = spark.createDataFrame(rows, "fold int, y int, a double, b double, c double, d double").repartition(4).checkpoint()
    tensor, scans = L.fit_grid(df, ["a", "b", "c", "d"], "y", "fold", [(c, r) for c in (1000.0, 20000.0) for r in (0.05, 0.5, 0.95)])
    slope = tensor.sums(L.selected(df, ["a", "b", "c", "d"], "y", "fold"), tensor.w, np.ones(tensor.w.shape[:2], dtype=bool))[1]
    assert scans <= 14 and tensor.violation(slope).max() < 1e-12  # still moving after 200 scans before
