"""Regression grids from sufficient statistics.

One scan sums, for each time block, the number of rows, the means and the centred cross products of features and
label. Those moments merge exactly (pairwise update of means and cross products), so prefixes over the blocks are the
training sets of all expanding folds. Every ridge and elastic-net point of every fold is then solved on its p x p
matrix; R2 and RMSE of a fold follow from the moments of its test block. Only the absolute error needs the rows
again: a second scan scores all points of all folds at once.

Work on the rows does not depend on the number of points. Features have no nulls here (fill them before).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Groups that the tasks' moments of one block are merged in first.
MERGE_GROUPS = 64
SWEEPS, TOLERANCE = 20_000, 1e-13


@dataclass
class Moments:
    """Rows, means, and centred cross products of the columns; the label is the last one."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
        gap = rows - mean
        return cls(float(len(rows)), mean, gap.T @ gap)

    def merged(self, other: Moments) -> Moments:
        n = self.n + other.n
        if not n:
            return self
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * other.n / n, self.cross + other.cross + np.outer(gap, gap) * self.n * other.n / n)

    @classmethod
    def empty(cls, size: int) -> Moments:
        return cls(0.0, np.zeros(size), np.zeros((size, size)))

    def deviations(self) -> np.ndarray:
        """Population deviations, 1 for constant columns."""
        std = np.sqrt(np.maximum(np.diag(self.cross), 0.0) / max(self.n, 1.0))
        return np.where(std > 1e-12 * np.maximum(np.abs(self.mean), 1.0), std, 1.0)

    def squared_error(self, weights: np.ndarray, intercept: float) -> float:
        """Sum of (label - rows @ weights - intercept) squared, from the moments alone."""
        full = np.append(-weights, 1.0)
        return float(full @ self.cross @ full + self.n * (full @ self.mean - intercept) ** 2)


def block_moments(df: DataFrame, columns: Sequence[str], block: str) -> dict[int, Moments]:
    """Moments of ``columns`` by ``block`` in one scan: each task sums its rows, the tasks' moments are merged in
    groups and then by block. One matrix a block reaches the driver."""
    size = len(columns)
    schema = "block int, part int, n double, mean array<double>, cross array<double>"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        part = TaskContext.get().partitionId() % MERGE_GROUPS
        for batch in batches:
            blocks = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(size)])
            for b in np.unique(blocks):
                held[int(b)] = held.get(int(b), Moments.empty(size)).merged(Moments.of(rows[blocks == b]))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([part] * len(held), pa.int32()), pa.array([m.n for m in held.values()]),
                                              pa.array([m.mean for m in held.values()]), pa.array([m.cross.ravel() for m in held.values()])],
                                             names=["block", "part", "n", "mean", "cross"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = Moments.empty(size)
        for n, mean, cross in sorted(zip(pdf["n"], pdf["mean"], pdf["cross"]), key=lambda r: (r[0], tuple(r[1]))):
            total = total.merged(Moments(n, np.asarray(mean), np.asarray(cross).reshape(size, size)))
        return pd.DataFrame({"block": [pdf["block"].iloc[0]], "part": [0], "n": [total.n], "mean": [total.mean], "cross": [total.cross.ravel()]})

    rows = df.select(F.col(block).cast("int").alias("_b"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    merged = rows.mapInArrow(own, schema).groupBy("block", "part").applyInPandas(merge, schema).groupBy("block").applyInPandas(merge, schema)
    return {r["block"]: Moments(r["n"], np.array(r["mean"]), np.array(r["cross"]).reshape(size, size)) for r in merged.collect()}  # one row a block


def expanding(moments: dict[int, Moments], folds: Sequence[int]) -> dict[int, Moments]:
    """Moments of all blocks before each fold."""
    size = len(next(iter(moments.values())).mean)
    out, total = {}, Moments.empty(size)
    for block in sorted(set(moments) | set(folds)):
        if block in folds:
            out[block] = total
        total = total.merged(moments.get(block, Moments.empty(size)))
    return out


@dataclass(frozen=True)
class Point:
    """A point of the grid. ``ridge``: alpha on the sum of squares; ``elasticnet``: alpha and the share of L1 on
    the mean of squares, halved; ``linear``: no penalty."""

    model: str
    alpha: float = 0.0
    l1_ratio: float = 0.0

    def penalties(self, n: float) -> tuple[float, float]:
        """L1 and L2 penalty beside half the sum of squares."""
        if self.model == "elasticnet":
            return n * self.alpha * self.l1_ratio, n * self.alpha * (1 - self.l1_ratio)
        return 0.0, self.alpha


def descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    """Minimise w'Gw/2 - t'w + l1 |w| + l2 w'w/2 by coordinate descent."""
    w, fit = start.copy(), gram @ start
    scale = max(float(np.abs(target).max(initial=0.0)), 1e-300)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            if gram[j, j] + l2 <= 0:
                continue
            rest = target[j] - fit[j] + gram[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - l1, 0.0) / (gram[j, j] + l2)
            if new != w[j]:
                fit += gram[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]) * (gram[j, j] + l2))
                w[j] = new
        if moved <= TOLERANCE * scale:
            break
    return w


def solve(train: Moments, points: Sequence[Point]) -> dict[Point, tuple[np.ndarray, float]]:
    """Weights (of the plain features) and intercept of every point, fitted on standardised features. Elastic-net
    points of one L1 share start from the solution of the next larger alpha."""
    std = train.deviations()[:-1]
    gram, target = train.cross[:-1, :-1] / np.outer(std, std), train.cross[:-1, -1] / std
    out: dict[Point, tuple[np.ndarray, float]] = {}
    warm: dict[float, np.ndarray] = {}
    for point in sorted(points, key=lambda p: (p.model, p.l1_ratio, -p.alpha)):
        l1, l2 = point.penalties(train.n)
        if l1:
            w = warm[point.l1_ratio] = descend(gram, target, l1, l2, warm.get(point.l1_ratio, np.zeros(len(target))))
        elif l2:
            w = np.linalg.solve(gram + l2 * np.eye(len(target)), target)
        else:
            w = np.linalg.lstsq(gram, target, rcond=None)[0]
        out[point] = w / std, float(train.mean[-1] - (w / std) @ train.mean[:-1])
    return out


def absolute_errors(df: DataFrame, columns: Sequence[str], fold: str, weights: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Sum of |label - prediction| by fold for all points: ``weights`` has a column a point, the intercept last.
    One scan; a task returns one row a fold."""
    size = len(columns)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(size)])
            for f in np.unique(folds):
                if int(f) in weights:
                    some, w = rows[folds == f], weights[int(f)]
                    gap = np.abs(some[:, -1:] - some[:, :-1] @ w[:-1] - w[-1]).sum(axis=0)
                    held[int(f)] = held.get(int(f), 0.0) + gap
        for f, gap in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([f] * len(gap), pa.int32()), pa.array(np.arange(len(gap)), pa.int32()), pa.array(gap)], names=["f", "point", "gap"])

    rows = df.select(F.col(fold).cast("int").alias("_f"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]).filter("_f >= 0")
    sums = rows.mapInArrow(own, "f int, point int, gap double").groupBy("f", "point").agg(F.sum("gap").alias("gap"))
    out = {f: np.zeros(w.shape[1]) for f, w in weights.items()}
    for r in sums.collect():  # a number for each fold and point
        out[r["f"]][r["point"]] = r["gap"]
    return out


def grid_scores(df: DataFrame, features: Sequence[str], label: str, fold: str, points: Sequence[Point]) -> DataFrame:
    """(model, alpha, l1_ratio, fold, n, r2, rmse, mae) of every point on every expanding fold: ``fold`` is the
    test block of a row (-1: before the first), as ``split.fold_of`` gives it. Two scans of ``df`` for any grid."""
    columns = [*features, label]
    moments = block_moments(df, columns, fold)
    folds = sorted(b for b in moments if b >= 0)
    train = expanding(moments, folds)
    fitted = {f: solve(train[f], points) for f in folds if train[f].n}
    weights = {f: np.column_stack([np.append(*fitted[f][p]) for p in points]) for f in fitted}
    gaps = absolute_errors(df, columns, fold, weights)
    out = []
    for f in fitted:
        test = moments[f]
        spread = float(test.cross[-1, -1])
        for i, p in enumerate(points):
            sse = max(test.squared_error(*fitted[f][p]), 0.0)
            out.append((p.model, p.alpha, p.l1_ratio, f, int(test.n), 1 - sse / spread if spread else 0.0, float(np.sqrt(sse / test.n)), float(gaps[f][i] / test.n)))
    return df.sparkSession.createDataFrame(out, "model string, alpha double, l1_ratio double, fold int, n long, r2 double, rmse double, mae double")


def fold_means(scores: DataFrame, by: Sequence[str] = ("model", "alpha", "l1_ratio"), metrics: Sequence[str] = ("r2", "rmse", "mae"), refit: str = "r2",
               largest: bool = True, digits: int = 12) -> DataFrame:
    """The mean over the folds of every metric and the rank by ``refit`` (to ``digits``) within the first of ``by``; ties go by
    the grid's order."""
    means = scores.groupBy(*by).agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics], F.count(F.lit(1)).alias("folds"))
    first = F.round(f"mean_{refit}", digits)
    order = Window.partitionBy(by[0]).orderBy(first.desc() if largest else first.asc(), *by[1:])  # a row a point
    return means.withColumn("rank", F.row_number().over(order))
