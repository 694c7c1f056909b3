"""Forests and boosting on shared histograms against plain loops."""

import numpy as np

from touchline.ml import trees as T

FEATURES = ["a", "b", "c"]


def table(n=400, seed=3, classes=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(0, 6, n)]).astype(float)
    y = np.clip(((x[:, 0] + 2 * x[:, 1] + rng.normal(size=n)) / 5).astype(int), 0, classes - 1)
    return x, y


def frame(spark, x, y, parts=4):
    return spark.createDataFrame([(i * 7, int(k), *map(float, r)) for i, (r, k) in enumerate(zip(x, y))], "id long, label int, a double, b double, c double").repartition(parts)


def gini_tree(x, y, w, depth, min_split, min_leaf, features, classes):
    """Leaves (rows, class weights) of a tree that looks at all features."""
    rows = np.flatnonzero(w.sum(axis=1) > 0)

    def purity(own):
        t = w[own].sum(axis=0)
        return (t ** 2).sum() / t.sum() if t.sum() else 0.0

    def grow(own, level):
        best = None
        if level < depth and len(own) >= min_split and (w[own].sum(axis=0) > 0).sum() > 1:
            for f in features:
                for v in np.unique(x[:, f])[:-1]:
                    left, right = own[x[own, f] <= v], own[x[own, f] > v]
                    if len(left) >= min_leaf and len(right) >= min_leaf:
                        gain = round(purity(left) + purity(right) - purity(own), 9)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, left, right)
        return [(own, w[own].sum(axis=0))] if best is None else grow(best[1], level + 1) + grow(best[2], level + 1)

    return grow(rows, 0)


def test_forest_equals_plain_trees_on_its_bootstrap_samples(spark):
    x, y = table()
    ids = np.arange(len(y)) * 7
    forest = T.fit_forest(frame(spark, x, y), "id", "label", FEATURES, 3, trees=4, depth=4, min_split=20, min_leaf=6, max_features=None, seed=5, at_once=3)
    copies = T.bootstrap(ids, np.arange(4), 5)
    for t, tree in enumerate(forest.trees):
        totals = np.array([copies[y == k, t].sum() for k in range(3)])
        assert (forest.totals[t] == totals).all()
        weight = copies[:, t] * (totals.sum() / (3 * totals))[y]
        want = sorted((np.eye(3)[y[own]] * weight[own, None]).sum(axis=0).round(6).tolist() for own, _ in
                      gini_tree(x, y, np.eye(3)[y] * weight[:, None], 4, 20, 6, range(3), 3))
        leaves = [v for f, v in zip(tree.feature, tree.value) if f < 0]
        assert sorted(v.round(6).tolist() for v in leaves) == want and len(want) > 4


def test_bootstrap_is_poisson_and_the_same_again():
    draws = T.bootstrap(np.arange(20_000), np.arange(5), 1)
    assert (draws == T.bootstrap(np.arange(20_000), np.arange(5), 1)).all() and (draws[:100] == T.bootstrap(np.arange(100), np.arange(5), 1)).all()
    assert np.abs(draws.mean(axis=0) - 1).max() < 0.03 and np.abs(draws.var(axis=0) - 1).max() < 0.06
    assert np.abs(np.corrcoef(draws.T) - np.eye(5)).max() < 0.03


def test_forest_does_not_depend_on_partitions_and_learns(spark):
    x, y = table(900)
    kept = []
    for parts in (1, 7):
        data = frame(spark, x, y, parts)
        forest = T.fit_forest(data, "id", "label", FEATURES, 3, trees=12, depth=6, seed=9)
        kept.append([(t.feature, t.cut) for t in forest.trees])
    assert kept[0] == kept[1]
    scored = T.forest_probabilities(data, "id", "label", FEATURES, forest).collect()
    p = np.array([r.probabilities for r in scored])
    label = np.array([r.label for r in scored])
    assert np.allclose(p.sum(axis=1), 1) and (p.argmax(axis=1) == label).mean() > np.bincount(y).max() / len(y) + 0.15
    assert any(set(t.feature) - {-1} for t in forest.trees) and T.wanted_features(17, "sqrt") == 4 and T.wanted_features(10, 0.6) == 6


def plain_boost(x, y, rounds, depth, rate, l1, l2, gamma, min_child, classes=3):
    margins, losses = np.zeros((len(y), classes)), []
    for _ in range(rounds):
        p = T.softmax(margins)
        losses.append(-np.log(p[np.arange(len(y)), y]).mean())
        for k in range(classes):
            g, h = p[:, k] - (y == k), p[:, k] * (1 - p[:, k])

            def score(own):
                return max(abs(g[own].sum()) - l1, 0) ** 2 / (h[own].sum() + l2) / 2

            def grow(own, level):
                best = None
                if level < depth:
                    for f in range(x.shape[1]):
                        for v in np.unique(x[:, f])[:-1]:
                            left, right = own[x[own, f] <= v], own[x[own, f] > v]
                            if len(left) and len(right) and min(h[left].sum(), h[right].sum()) >= min_child:
                                gain = round(score(left) + score(right) - score(own) - gamma, 9)
                                if gain > 0 and (best is None or gain > best[0]):
                                    best = (gain, left, right)
                if best:
                    grow(best[1], level + 1)
                    grow(best[2], level + 1)
                elif level:
                    total = g[own].sum()
                    margins[own, k] -= rate * np.sign(total) * max(abs(total) - l1, 0) / (h[own].sum() + l2)

            grow(np.arange(len(y)), 0)
    return margins, losses


def test_boosting_equals_a_plain_loop(spark):
    x, y = table(300)
    options = dict(rounds=4, depth=2, rate=0.3, l1=0.2, l2=1.5, gamma=0.05, min_child=2.0)
    want, losses = plain_boost(x, y, **options)
    data = frame(spark, x, y)
    for refresh in (10, 2):
        model = T.fit_boosted(data, "id", "label", FEATURES, 3, refresh=refresh, **options)
        assert np.allclose(model.losses[:-1], losses, atol=1e-9)
        got = {r.id: r.probabilities for r in T.boosted_probabilities(data, "id", "label", FEATURES, model, 3).collect()}
        assert np.allclose([got[i * 7] for i in range(len(y))], T.softmax(want), atol=1e-9)


def test_boosting_with_drawn_rows_and_columns_keeps_learning(spark):
    x, y = table(500)
    model = T.fit_boosted(frame(spark, x, y), "id", "label", FEATURES, 3, rounds=5, depth=2, rate=0.3, subsample=0.7, columns=0.67)
    assert all(a > b for a, b in zip(model.losses, model.losses[1:])) and abs(model.losses[0] - np.log(3)) < 1e-9
    assert len({f for trees in model.rounds for t in trees for f in t.feature if f >= 0}) >= 2
    for trees in model.rounds:
        assert len({f for t in trees for f in t.feature if f >= 0}) <= 2


def test_missing_values_lie_above_every_cut(spark):
    rows = [(i, int(i % 2), None if i % 2 else 1.0 + i % 3, 0.0, 0.0) for i in range(60)]
    data = spark.createDataFrame(rows, "id long, label int, a double, b double, c double")
    forest = T.fit_forest(data, "id", "label", FEATURES, 2, trees=3, depth=1, max_features=None)
    scored = T.forest_probabilities(data, "id", "label", FEATURES, forest).collect()
    assert all(np.argmax(r.probabilities) == r.label for r in scored)
