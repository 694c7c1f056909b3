"""Forests with balanced bootstrap samples and multi-class boosting on shared histograms.

Features are cut into bins once, at quantiles of all rows. Trees grow level by level: a task walks its rows to their
nodes and adds them to a histogram by (tree, node, feature, bin); histograms are merged in groups and then by tree,
where the best cut of every node is chosen. One scan serves a level of ``at_once`` trees, and only the cuts reach the
driver. A histogram has a fixed size, whatever the rows.

**Forest.** Every (row, tree) draws its bootstrap count from a Poisson distribution with mean 1 by a hash of the row's id and the
tree, so a lost task draws the same again. Class weights are computed inside each tree's sample, n / (classes x n of the
class). Cuts lower the weighted Gini impurity; a node needs ``min_split`` distinct rows to be cut and each side
``min_leaf``; every node looks at its own random features. The forest's probabilities are the mean of its leaves' class shares.

**Boosting.** Softmax loss with first and second derivatives. Every round grows one regression tree for each class on sums of
both; rows and columns are drawn by hash. A leaf adds ``rate`` times its Newton step to the class's margin, so probabilities
are the softmax of the margins.

A missing value is above every cut. Ids are unique and labels are 0 to ``classes`` - 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.ml.gram import MERGE_GROUPS

MASK = 0xFFFFFFFF
#: A 32-bit draw u gives as many copies of a row as there are numbers here that do not exceed it.
POISSON_CUTS = [int(c * 2 ** 32) for c in np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])]
#: Rows that are walked at a time.
CHUNK = 4096


def mixed(ids: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    """32 well mixed bits of (id, salt)."""
    ids = ids.astype(np.uint64)
    x = ((ids & np.uint64(MASK)) + (ids >> np.uint64(32)) * np.uint64(2654435761) + np.asarray(salt, dtype=np.uint64) * np.uint64(2246822519)) & np.uint64(MASK)
    for _ in range(2):
        x = ((x ^ (x >> np.uint64(16))) * np.uint64(73244475)) & np.uint64(MASK)
    return (x ^ (x >> np.uint64(16))).astype(np.int64)


def bootstrap(ids: np.ndarray, trees: np.ndarray, seed: int) -> np.ndarray:
    """Copies of every row in every tree's sample: rows x trees."""
    return np.searchsorted(POISSON_CUTS, mixed(ids[:, None], trees[None, :] + seed), side="right")


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = 64) -> list[np.ndarray]:
    """Values at which a feature may be cut (rows up to the value go left): its quantiles over all rows."""
    at = [(i + 1) / bins for i in range(bins - 1)]
    found = df.agg(*[F.percentile_approx(F.col(f).cast("double"), at, 10_000).alias(f"_{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(v if v is not None else [], dtype=np.float64)) for v in found]


def binned(df: DataFrame, id_col: str, label: str, features: Sequence[str], edges: list[np.ndarray]) -> DataFrame:
    """(id, label, bins): a byte for each feature, its place among the edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.empty((batch.num_rows, len(edges)), dtype=np.uint8)
            for i, edge in enumerate(edges):
                x = batch.column(i + 2).to_numpy(zero_copy_only=False).astype(np.float64)
                rows[:, i] = np.where(np.isnan(x), len(edge), np.searchsorted(edge, x, side="left"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in rows], pa.binary())], names=["id", "label", "bins"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label"), *[F.col(f).cast("double").alias(f"_{i}") for i, f in enumerate(features)])
    return rows.mapInArrow(run, "id long, label int, bins binary").checkpoint(eager=True)


@dataclass
class Tree:
    """Nodes in the order in which they were made; the children of a cut node are two in a row."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[np.ndarray] = field(default_factory=lambda: [np.zeros(1)])

    def split(self, node: int, feature: int, cut: int, values: Sequence[np.ndarray]) -> list[int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for v in values:
            self.feature.append(-1)
            self.cut.append(0)
            self.left.append(0)
            self.value.append(np.asarray(v, dtype=np.float64))
        return [self.left[node], self.left[node] + 1]

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.cut), np.array(self.left)


def walked(rows: np.ndarray, arrays: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """The leaf of every row."""
    feature, cut, left = arrays
    node = np.zeros(len(rows), dtype=np.int64)
    going = np.flatnonzero(feature[node] >= 0)
    while len(going):
        at = node[going]
        node[going] = left[at] + (rows[going, feature[at]] > cut[at])
        going = going[feature[node[going]] >= 0]
    return node


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Ids, labels, bins and the batch, chunk by chunk."""
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            some = batch.slice(start, CHUNK)
            bins = np.frombuffer(b"".join(some.column(2).to_pylist()), dtype=np.uint8).reshape(some.num_rows, -1)
            yield some.column(0).to_numpy(), some.column(1).to_numpy(), bins, some


def merged_by_key(rows: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], dict[int, np.ndarray]], choose: Callable[[int, np.ndarray], list[tuple]], schema: str) -> list:
    """``choose(key, sum)`` of the arrays that all tasks return by key, merged in groups of tasks first."""
    partial = "key int, part int, sums array<double>"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % MERGE_GROUPS
        for key, sums in task(batches).items():
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.ravel()], pa.list_(pa.float64()))],
                                             names=["key", "part", "sums"])

    def total(pdf: pd.DataFrame) -> np.ndarray:
        return np.sum(np.stack(sorted(map(tuple, pdf["sums"]))), axis=0)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "part": [0], "sums": [total(pdf)]})

    names = [c.split()[0] for c in schema.split(", ")]

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(choose(int(pdf["key"].iloc[0]), total(pdf)), columns=names)

    found = rows.mapInArrow(own, partial).groupBy("key", "part").applyInPandas(merge, partial).groupBy("key").applyInPandas(decide, schema)
    return found.collect()  # a row for each node of a level of the trees grown at once


def histogram(bins: np.ndarray, slot: np.ndarray, features: np.ndarray, size: int, channels: Sequence[np.ndarray], out: np.ndarray) -> None:
    """Add rows to ``out`` (slot, chosen feature, bin, channel). ``features``: those of every slot."""
    at = np.flatnonzero(slot >= 0)
    if not len(at):
        return
    chosen = features[slot[at]]
    place = (slot[at, None] * features.shape[1] + np.arange(features.shape[1])) * size + bins[at[:, None], chosen]
    for c, weight in enumerate(channels):
        out[..., c] += np.bincount(place.ravel(), np.repeat(weight[at], features.shape[1]), minlength=out[..., 0].size).reshape(out.shape[:-1])


def random_features(tree: int, node: int, n: int, wanted: int, seed: int) -> np.ndarray:
    """``wanted`` of ``n`` features for a node, ascending."""
    return np.sort(np.argsort(mixed(np.arange(n), (tree * 1_000_003 + node) * 31 + seed + 7), kind="stable")[:wanted])


def wanted_features(n: int, rule) -> int:
    share = {"sqrt": n ** 0.5, "log2": np.log2(n) if n > 1 else 1, None: n}.get(rule, rule if isinstance(rule, int) else None)
    return int(min(n, max(1, share if share is not None else rule * n)))


SPLITS = "key int, slot int, feature int, cut int, gain double, left array<double>, right array<double>"


@dataclass
class Forest:
    edges: list[np.ndarray]
    trees: list[Tree]
    totals: np.ndarray  # bootstrap rows by tree and class

    def arrays(self):
        return [(t.arrays(), np.stack([v / v.sum() if v.sum() else v for v in t.value])) for t in self.trees]


def fit_forest(df: DataFrame, id_col: str, label: str, features: Sequence[str], classes: int, trees: int = 300, depth: int = 7, min_split: int = 2,
               min_leaf: int = 1, max_features="sqrt", balanced: bool = True, bins: int = 64, seed: int = 42, at_once: int = 50) -> Forest:
    """A forest; ``max_features`` is "sqrt", "log2", a share, a number or None for all."""
    edges = bin_edges(df, features, bins)
    rows = binned(df, id_col, label, features, edges)
    n, wanted, every = len(features), wanted_features(len(features), max_features), np.arange(trees)

    def count(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        held = np.zeros((trees, classes))
        for ids, y, _, _ in chunks(batches):
            copies = bootstrap(ids, every, seed)
            for k in range(classes):
                held[:, k] += copies[y == k].sum(axis=0)
        return dict(enumerate(held))

    totals = np.zeros((trees, classes))
    for r in merged_by_key(rows, count, lambda key, sums: [(key, sums)], "key int, sums array<double>"):
        totals[r["key"]] = r["sums"]
    weights = totals.sum(axis=1, keepdims=True) / (classes * np.maximum(totals, 1)) if balanced else np.ones_like(totals)
    grown = [Tree(value=[totals[t] * weights[t]]) for t in range(trees)]
    size = max(len(e) for e in edges) + 1

    for first in range(0, trees, at_once):
        own = list(range(first, min(first + at_once, trees)))
        frontier = {t: [0] for t in own if (totals[t] > 0).sum() > 1}
        for _ in range(depth):
            if not frontier:
                break
            chosen = {t: np.stack([random_features(t, node, n, wanted, seed) for node in nodes]) for t, nodes in frontier.items()}
            shapes = {t: grown[t].arrays() for t in frontier}

            def grow(batches: Iterator[pa.RecordBatch], frontier=frontier, chosen=chosen, shapes=shapes) -> dict[int, np.ndarray]:
                slots = {t: np.full(len(shapes[t][0]), -1) for t in frontier}
                for t, nodes in frontier.items():
                    slots[t][nodes] = np.arange(len(nodes))
                out = {t: np.zeros((len(nodes), wanted, size, classes + 1)) for t, nodes in frontier.items()}
                named = np.array(list(frontier))
                for ids, y, rows_, _ in chunks(batches):
                    copies = bootstrap(ids, named, seed)
                    for i, t in enumerate(named.tolist()):
                        slot = np.where(copies[:, i] > 0, slots[t][walked(rows_, shapes[t])], -1)
                        histogram(rows_, slot, chosen[t], size, [*(copies[:, i] * (y == k) for k in range(classes)), np.ones(len(y))], out[t])
                return out

            def choose(t: int, sums: np.ndarray, chosen=chosen) -> list[tuple]:
                return gini_cuts(t, sums.reshape(-1, wanted, size, classes + 1), weights[t], chosen[t], min_split, min_leaf)

            following: dict[int, list[int]] = {}
            for r in sorted(merged_by_key(rows, grow, choose, SPLITS), key=lambda r: (r["key"], r["slot"])):
                t = r["key"]
                kids = grown[t].split(frontier[t][r["slot"]], r["feature"], r["cut"], [r["left"], r["right"]])
                following.setdefault(t, []).extend(k for k in kids if (grown[t].value[k] > 0).sum() > 1)
            frontier = {t: nodes for t, nodes in following.items() if nodes}
    return Forest(edges, grown, totals)


def gini_cuts(key: int, sums: np.ndarray, weights: np.ndarray, features: np.ndarray, min_split: int, min_leaf: int) -> list[tuple]:
    """The cut of every node that lowers the weighted Gini impurity most; ties go to the first feature and bin."""
    classes = len(weights)
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums.sum(axis=2, keepdims=True)
    right = whole - left

    def purity(x: np.ndarray) -> np.ndarray:  # weight less impurity: sum of squared class weights over the weight
        w = x[..., :classes] * weights
        total = w.sum(axis=-1)
        return np.divide((w ** 2).sum(axis=-1), total, out=np.zeros_like(total), where=total > 0)

    gain = purity(left) + purity(right) - purity(whole)
    fits = (left[..., -1] >= min_leaf) & (right[..., -1] >= min_leaf) & (whole[..., -1] >= min_split)
    gain = np.where(fits, gain, -1.0)
    out = []
    for slot in range(len(sums)):
        flat = np.round(gain[slot], 9).ravel()
        best = int(flat.argmax()) if flat.size else 0
        if flat.size and flat[best] > 0:
            j, b = divmod(best, gain.shape[2])
            out.append((key, slot, int(features[slot, j]), b, float(gain[slot, j, b]), (left[slot, j, b, :classes] * weights).tolist(),
                        (right[slot, j, b, :classes] * weights).tolist()))
    return out


def forest_probabilities(df: DataFrame, id_col: str, label: str, features: Sequence[str], forest: Forest) -> DataFrame:
    """(id, label, probabilities): the soft vote of the trees."""
    arrays = forest.arrays()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, rows, batch in chunks(batches):
            votes = sum(shares[walked(rows, shape)] for shape, shares in arrays) / len(arrays)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(votes), pa.list_(pa.float64()))], names=["id", "label", "probabilities"])

    return binned(df, id_col, label, features, forest.edges).mapInArrow(run, "id long, label int, probabilities array<double>")


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Boosted:
    edges: list[np.ndarray]
    rounds: list[list[Tree]]  # a tree for each class
    losses: list[float]  # mean training loss before each round, and after the last

    def margins(self, rows: np.ndarray, start: np.ndarray, first: int = 0) -> np.ndarray:
        out = start.copy()
        for trees in self.rounds[first:]:
            for k, tree in enumerate(trees):
                out[:, k] += np.concatenate(tree.value)[walked(rows, tree.arrays())]
        return out


def leaf_step(g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> np.ndarray:
    return -np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) / np.maximum(h + l2, 1e-300)


def newton_cuts(key: int, sums: np.ndarray, features: np.ndarray, rate: float, gamma: float, l1: float, l2: float, min_child: float) -> list[tuple]:
    """The cut of every node that lowers the second-order loss most."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums.sum(axis=2, keepdims=True)
    right = whole - left

    def score(x: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(x[..., 0]) - l1, 0.0) ** 2 / np.maximum(x[..., 1] + l2, 1e-300) / 2

    gain = score(left) + score(right) - score(whole) - gamma
    fits = (left[..., 1] >= min_child) & (right[..., 1] >= min_child) & (left[..., 2] > 0) & (right[..., 2] > 0)
    gain = np.where(fits, gain, -1.0)
    out = []
    for slot in range(len(sums)):
        flat = np.round(gain[slot], 9).ravel()
        best = int(flat.argmax()) if flat.size else 0
        if flat.size and flat[best] > 0:
            j, b = divmod(best, gain.shape[2])
            sides = [[float(rate * leaf_step(x[slot, j, b, 0], x[slot, j, b, 1], l1, l2))] for x in (left, right)]
            out.append((key, slot, int(features[slot, j]), b, float(gain[slot, j, b]), *sides))
    return out


def fit_boosted(df: DataFrame, id_col: str, label: str, features: Sequence[str], classes: int, rounds: int = 100, depth: int = 3, rate: float = 0.1,
                subsample: float = 1.0, columns: float = 1.0, min_child: float = 1.0, gamma: float = 0.0, l1: float = 0.0, l2: float = 1.0, bins: int = 64,
                seed: int = 42, refresh: int = 10) -> Boosted:
    """Softmax boosting. Margins are written every ``refresh`` rounds, so that a scan walks at most that many
    rounds of trees."""
    model = Boosted(bin_edges(df, features, bins), [], [])
    n, wanted = len(features), max(1, int(round(columns * len(features))))
    size, stored = max(len(e) for e in model.edges) + 1, 0
    rows = binned(df, id_col, label, features, model.edges).withColumn("margins", F.array(*[F.lit(0.0)] * classes))

    def known(batch: pa.RecordBatch, bins_: np.ndarray, first: int) -> np.ndarray:
        start = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)
        return model.margins(bins_, start, first)

    def losses(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total = np.zeros(2)
        for _, y, bins_, batch in chunks(batches):
            p = softmax(known(batch, bins_, stored))
            total += [-np.log(np.maximum(p[np.arange(len(y)), y], 1e-300)).sum(), len(y)]
        return {0: total}

    def loss() -> float:
        (row,) = merged_by_key(rows, losses, lambda key, sums: [(key, float(sums[0] / max(sums[1], 1)))], "key int, loss double")
        return row["loss"]

    for number in range(rounds):
        model.losses.append(loss())
        drawn = random_features(number, 0, n, wanted, seed)
        trees = [Tree() for _ in range(classes)]
        frontier = {k: [0] for k in range(classes)}
        for level in range(depth):
            if not frontier:
                break
            shapes = [t.arrays() for t in trees]
            chosen = {k: np.tile(drawn, (len(nodes), 1)) for k, nodes in frontier.items()}

            def grow(batches: Iterator[pa.RecordBatch], frontier=frontier, chosen=chosen, shapes=shapes, number=number) -> dict[int, np.ndarray]:
                slots = {k: np.full(len(shapes[k][0]), -1) for k in frontier}
                for k, nodes in frontier.items():
                    slots[k][nodes] = np.arange(len(nodes))
                out = {k: np.zeros((len(nodes), wanted, size, 3)) for k, nodes in frontier.items()}
                for ids, y, bins_, batch in chunks(batches):
                    p = softmax(known(batch, bins_, stored))
                    taken = mixed(ids, number + seed * 1009) < subsample * 2 ** 32
                    for k in frontier:
                        slot = np.where(taken, slots[k][walked(bins_, shapes[k])], -1)
                        histogram(bins_, slot, chosen[k], size, [p[:, k] - (y == k), p[:, k] * (1 - p[:, k]), np.ones(len(y))], out[k])
                return out

            def choose(k: int, sums: np.ndarray, chosen=chosen) -> list[tuple]:
                return newton_cuts(k, sums.reshape(-1, wanted, size, 3), chosen[k], rate, gamma, l1, l2, min_child)

            following: dict[int, list[int]] = {}
            for r in sorted(merged_by_key(rows, grow, choose, SPLITS), key=lambda r: (r["key"], r["slot"])):
                kids = trees[r["key"]].split(frontier[r["key"]][r["slot"]], r["feature"], r["cut"], [r["left"], r["right"]])
                following.setdefault(r["key"], []).extend(kids)
            frontier = following
        model.rounds.append(trees)
        if len(model.rounds) - stored >= refresh and number + 1 < rounds:
            rows, stored = margins_of(rows, model, classes, stored).checkpoint(eager=True), len(model.rounds)
    model.losses.append(loss())
    return model


def margins_of(rows: DataFrame, model: Boosted, classes: int, first: int) -> DataFrame:
    """``rows`` with the margins of all rounds, of which those before ``first`` are in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, bins_, batch in chunks(batches):
            start = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, classes)
            found = model.margins(bins_, start, first)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(list(found), pa.list_(pa.float64()))], names=["id", "label", "bins", "margins"])

    return rows.mapInArrow(run, "id long, label int, bins binary, margins array<double>")


def boosted_probabilities(df: DataFrame, id_col: str, label: str, features: Sequence[str], model: Boosted, classes: int) -> DataFrame:
    """(id, label, probabilities)."""
    rows = binned(df, id_col, label, features, model.edges).withColumn("margins", F.array(*[F.lit(0.0)] * classes))
    found = margins_of(rows, model, classes, 0)
    highest = F.array_max("margins")
    e = F.transform("margins", lambda m: F.exp(m - highest))
    total = F.aggregate(e, F.lit(0.0), lambda a, v: a + v)
    return found.select("id", "label", F.transform(e, lambda v: v / total).alias("probabilities"))
