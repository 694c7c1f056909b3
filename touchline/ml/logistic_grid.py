"""Elastic-net multinomial logistic regression: a whole grid on all expanding folds, one scan a round (SURVEY M15,
M2, M21, M22).

All points of all folds are one weight tensor. In a round every task multiplies its rows with the weights of the
folds that train on them, as one stacked matrix product, and adds up loss, gradient and curvature of every point
(the curvature as a product of feature pairs with class weights); the sums are merged in groups. The driver then
minimises every point's quadratic model plus the penalty by coordinate descent, all points at once: a Newton step.
A step that does not lower the objective is halved in the next round. A point that no longer moves leaves the tensor.

The objective is that of the usual ``C`` form: C times the sum of the losses, plus l1_ratio |w| and half (1 -
l1_ratio) w'w, on features standardised in each training set, intercepts free. The sums have ``classes`` x
features squared numbers a point, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.ml.gram import MERGE_GROUPS, Moments, block_moments, expanding

#: Coordinate sweeps before the weights that are not zero are solved for, tries of both, and rows that a task
#: multiplies at a time.
SWEEPS, ROUNDS, CHUNK = 10, 200, 512
#: Rounding of a mean loss, as a share of it, and of a mean gradient: a smaller rise, or distance from the optimum, is none.
NOISE, FLAT = 1e-13, 1e-14


def selected(df: DataFrame, columns: Sequence[str], label: str, fold: str) -> DataFrame:
    return df.select(F.col(fold).cast("int").alias("_f"), F.col(label).cast("int").alias("_y"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])


def parts_of(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(fold, label, rows) of a batch, chunk by chunk."""
    folds, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    x = np.column_stack([batch.column(i + 2).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(size)])
    for f in np.unique(folds):
        at = np.flatnonzero(folds == f)
        for start in range(0, len(at), CHUNK):
            some = at[start:start + CHUNK]
            yield int(f), y[some], x[some]


def summed(rows: DataFrame, task, merged: bool = True) -> np.ndarray:
    """The sum over all tasks of the array that ``task`` makes of its batches, merged in groups. Of ``MERGE_GROUPS`` tasks at
    most, whose groups would be single tasks, the arrays may come as they are (``merged`` False)."""
    schema = "part int, sums array<double>"

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = task(batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % MERGE_GROUPS], pa.int32()), pa.array([sums.ravel()])], names=["part", "sums"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [0], "sums": [np.sum(np.stack(sorted(map(tuple, pdf["sums"]))), axis=0)]})

    found = rows.mapInArrow(own, schema)
    found = (found.groupBy("part").applyInPandas(merge, schema) if merged else found).collect()  # at most MERGE_GROUPS rows
    return np.sum([r["sums"] for r in sorted(found, key=lambda r: r["sums"])], axis=0)


class Tensor:
    """Weights of all points of all folds, on standardised features: (fold, point, feature, class); the intercept is
    the last feature."""

    def __init__(self, train: dict[int, Moments], points: Sequence[tuple[float, float]], classes: int):
        self.folds, self.points, self.classes = sorted(train), list(points), classes
        moments = [train[f] for f in self.folds]
        self.std = np.array([m.deviations()[:-1] for m in moments])
        self.mean = np.array([m.mean[:-1] for m in moments])
        self.n = np.array([m.n for m in moments])
        self.size = self.std.shape[1] + 1
        self.w = np.zeros((len(self.folds), len(self.points), self.size, classes))
        c, share = np.array(self.points, dtype=np.float64).T
        free = np.append(np.ones(self.size - 1), 0.0)[None, None, :, None]  # the intercept has no penalty
        self.l1 = ((share / c)[None, :] / self.n[:, None])[..., None, None] * free  # beside the mean loss
        self.l2 = (((1 - share) / c)[None, :] / self.n[:, None])[..., None, None] * free

    def scaled(self, x: np.ndarray, fold: int) -> np.ndarray:
        return np.column_stack([(x - self.mean[fold]) / self.std[fold], np.ones(len(x))])

    def sums(self, rows: DataFrame, w: np.ndarray, moving: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Mean loss, gradient (as ``w``) and curvature (point, feature x class squared) of the points that move at
        ``w``; one scan of ``rows``."""
        size, classes, folds = self.size, self.classes, self.folds
        wanted = [np.flatnonzero(m) for m in moving]
        weights = [[np.ascontiguousarray(w[i, p, :, k].T) for k in range(classes)] for i, p in enumerate(wanted)]
        first, second = np.triu_indices(size)
        ka, kb = np.triu_indices(classes, 1)  # p (1 - p) of a class is the sum of its products with the others
        pairs, blocks = len(first), len(ka)
        each = 1 + size * classes + pairs * blocks
        starts = np.cumsum([0] + [len(p) * each for p in wanted])

        def task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(starts[-1])
            for batch in batches:
                for block, y, x in parts_of(batch, size - 1):
                    for i, f in enumerate(folds):
                        if block >= f or not len(wanted[i]):
                            continue
                        z, n = self.scaled(x, i), len(wanted[i])
                        p = [z @ own for own in weights[i]]
                        top = p[0].copy()
                        for own in p[1:]:
                            np.maximum(top, own, out=top)
                        held = out[starts[i]:starts[i + 1]]
                        held[:n] += top.sum(axis=0)
                        for k, own in enumerate(p):
                            held[:n] -= own[y == k].sum(axis=0)
                            own -= top
                            np.exp(own, out=own)
                        total = sum(p)
                        held[:n] += np.log(total).sum(axis=0)
                        slopes = held[n:n + n * size * classes].reshape(size, n, classes)
                        for k, own in enumerate(p):
                            own /= total
                            slopes[:, :, k] += z.T @ own - z[y == k].sum(axis=0)[:, None]
                        products, curves = (z[:, first] * z[:, second]).T, held[n + n * size * classes:].reshape(blocks, pairs, n)
                        for r, (c, d) in enumerate(zip(ka, kb)):
                            curves[r] += products @ (p[c] * p[d])
            return out

        found = summed(rows, task) if starts[-1] else np.zeros(0)
        shape = self.w.shape[:2]
        loss, slope, curve = np.zeros(shape), np.zeros_like(w), np.zeros((*shape, size, classes, size, classes))
        for i, p in enumerate(wanted):
            own, n = found[starts[i]:starts[i + 1]] / self.n[i], len(p)
            loss[i, p] = own[:n]
            slope[i, p] = np.moveaxis(own[n:n + n * size * classes].reshape(size, n, classes), 0, 1)
            parts = own[n + n * size * classes:].reshape(blocks, pairs, n)
            for q, (j, k) in enumerate(zip(first, second)):
                for r, (a, b) in enumerate(zip(ka, kb)):
                    curve[i, p, j, a, k, b] = curve[i, p, j, b, k, a] = curve[i, p, k, a, j, b] = curve[i, p, k, b, j, a] = -parts[r, q]
                for a in range(classes):
                    curve[i, p, j, a, k, a] = curve[i, p, k, a, j, a] = parts[(ka == a) | (kb == a), q].sum(axis=0)
        return loss, slope, curve.reshape(*shape, size * classes, size * classes)

    def objective(self, loss: np.ndarray, w: np.ndarray) -> np.ndarray:
        return loss + (self.l1 * np.abs(w) + self.l2 * w * w / 2).sum(axis=(2, 3))

    def newton(self, w: np.ndarray, slope: np.ndarray, curve: np.ndarray, moving: np.ndarray) -> np.ndarray:
        """The step to the minimum of the quadratic model and the penalty: a few coordinate sweeps over all points at
        once find which weights are zero, then each point's other weights are solved for; a point whose solution
        keeps its signs is done, the others go on."""
        at = np.nonzero(moving)
        start, l1, l2 = (np.broadcast_to(v, w.shape)[at].reshape(len(at[0]), -1) for v in (w, self.l1, self.l2))
        q, g = curve[at] + np.eye(start.shape[1]) * 1e-11, slope[at].reshape(len(at[0]), -1)
        new, left = start.copy(), np.arange(len(start))
        for _ in range(ROUNDS):
            own, some, first, pull, ridge = new[left], q[left], start[left], l1[left], l2[left]
            fit = g[left] + np.einsum("pij,pj->pi", some, own - first)
            for _ in range(SWEEPS):
                for j in range(own.shape[1]):
                    h = some[:, j, j]
                    rest = h * own[:, j] - fit[:, j]
                    step = np.sign(rest) * np.maximum(np.abs(rest) - pull[:, j], 0.0) / (h + ridge[:, j]) - own[:, j]
                    fit += some[:, j] * step[:, None]
                    own[:, j] += step
            new[left], done = self.solved(some, g[left], first, pull, ridge, own)
            left = left[~done]
            if not len(left):
                break
        out = np.zeros_like(w)
        out[at] = (new - start).reshape(-1, *w.shape[2:])
        out[:, :, -1] -= out[:, :, -1].mean(axis=-1, keepdims=True)  # the loss does not see a shift of all intercepts
        return out

    @staticmethod
    def solved(q: np.ndarray, g: np.ndarray, start: np.ndarray, l1: np.ndarray, l2: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Solve, for all points at once, for the weights that are not zero, given their signs: the better weights of
        each point, and whether they are its minimum. Towards a solution that changes signs the objective falls up to the
        first weight that reaches zero; the point goes on from there, or with all those weights at zero if that is lower.
        (A shift of a feature's weights in all classes leaves the loss alone, so single coordinates hardly move along it.)"""
        free = (w != 0) | (l1 == 0)
        sign = np.where(l1 > 0, np.sign(w), 0.0)  # weights without an L1 penalty may change theirs
        own = np.where(free[:, :, None] & free[:, None, :], q, 0.0)
        at = np.arange(w.shape[1])
        own[:, at, at] += np.where(free, l2, 1.0)
        target = np.where(free, np.einsum("pij,pj->pi", q, start) - g - l1 * sign, 0.0)
        found = np.linalg.solve(own, target[:, :, None])[:, :, 0]
        rest = g + np.einsum("pij,pj->pi", q, found - start) + l2 * found
        done = ~((found * sign < 0) | (~free & (np.abs(rest) > l1 + 1e-12))).any(axis=1)

        def objective(v: np.ndarray) -> np.ndarray:
            gap = v - start
            return (g * gap + np.einsum("pij,pj->pi", q, gap) * gap / 2 + l1 * np.abs(v) + l2 * v * v / 2).sum(axis=1)

        turned = found * sign < 0
        share = np.where(turned, w / np.where(turned, w - found, 1.0), np.inf)
        first = share.min(axis=1, keepdims=True)
        edge = np.where(share <= first, 0.0, w + np.minimum(first, 1.0) * (found - w))
        kept = np.where(turned, 0.0, found)
        straight = done | ~turned.any(axis=1) | (objective(kept) < objective(edge))
        return np.where(straight[:, None], kept, edge), done

    def violation(self, slope: np.ndarray) -> np.ndarray:
        """How far each point is from its optimum: the least norm of a subgradient of the objective at its weights."""
        whole = slope + self.l2 * self.w
        gap = np.where(self.w != 0, np.abs(whole + self.l1 * np.sign(self.w)), np.maximum(np.abs(whole) - self.l1, 0.0))
        return gap.max(axis=(2, 3))

    def fit(self, rows: DataFrame, tolerance: float = 1e-8, rounds: int = 200) -> int:
        """Move all points to their optimum; the number of scans."""
        moving = np.ones(self.w.shape[:2], dtype=bool)
        step, length = np.zeros_like(self.w), np.ones(self.w.shape[:2])
        best = np.full(self.w.shape[:2], np.inf)
        for scan in range(1, rounds + 1):
            trial = self.w + length[..., None, None] * step
            loss, slope, curve = self.sums(rows, trial, moving)
            value = self.objective(loss, trial)
            better = moving & (value <= best + NOISE * np.abs(value))
            self.w[better], best[better] = trial[better], value[better]
            stuck = moving & ~better
            length[stuck] /= 2
            if better.any():
                step[better], length[better] = self.newton(self.w, slope, curve, better)[better], 1.0
                moving &= ~(better & (self.violation(slope) <= FLAT))
            moving &= (length[..., None, None] * np.abs(step)).max(axis=(2, 3)) > tolerance
            if not moving.any():
                self.w[:, :, -1] -= self.w[:, :, -1].mean(axis=-1, keepdims=True)  # intercepts are free up to a constant
                return scan
        raise RuntimeError(f"{int(moving.sum())} points still move after {rounds} scans")


def fit_grid(df: DataFrame, features: Sequence[str], label: str, fold: str, points: Sequence[tuple[float, float]], classes: int = 3) -> tuple[Tensor, int]:
    """All (C, l1_ratio) ``points`` on every expanding fold of ``df`` (``fold``: the test block of a row, -1 before the
    first); the tensor of weights and the number of scans. Labels are 0 to ``classes`` - 1, features without nulls."""
    moments = block_moments(df, [*features, label], fold)
    train = {f: m for f, m in expanding(moments, [b for b in sorted(moments) if b >= 0]).items() if m.n}
    tensor = Tensor(train, points, classes)
    return tensor, tensor.fit(selected(df, features, label, fold))


def confusion(df: DataFrame, features: Sequence[str], label: str, fold: str, tensor: Tensor) -> DataFrame:
    """(c, l1_ratio, fold, actual, predicted, n) of every point on its fold's test block; one scan for all points."""
    size, classes, folds = len(features), tensor.classes, tensor.folds
    points = len(tensor.points)
    weights = [np.moveaxis(w, 0, 1).reshape(size + 1, -1) for w in tensor.w]

    def task(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros((len(folds), points, classes, classes))
        for batch in batches:
            for block, y, x in parts_of(batch, size):
                if block in folds:
                    i = folds.index(block)
                    best = (tensor.scaled(x, i) @ weights[i]).reshape(len(x), points, classes).argmax(axis=2)
                    for k in range(classes):
                        own = best[y == k]
                        counts[i, :, k] += np.stack([(own == c).sum(axis=0) for c in range(classes)], axis=1)
        return counts

    counts = summed(selected(df, features, label, fold), task).reshape(len(folds), points, classes, classes)
    out = [(float(c), float(l1), f, a, p, int(counts[i, j, a, p])) for i, f in enumerate(folds) for j, (c, l1) in enumerate(tensor.points)
           for a in range(classes) for p in range(classes)]
    return df.sparkSession.createDataFrame(out, "c double, l1_ratio double, fold int, actual int, predicted int, n long")


def class_scores(counts: DataFrame, by: Sequence[str] = ("c", "l1_ratio", "fold")) -> DataFrame:
    """Accuracy and F1 weighted by class size from confusion counts."""
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    true = counts.groupBy(*by, F.col("actual").alias("class")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    given = counts.groupBy(*by, F.col("predicted").alias("class")).agg(F.sum("n").alias("given"))
    f1 = F.coalesce(F.try_divide(2 * F.col("hits"), F.col("support") + F.col("given")), F.lit(0.0))
    return (true.join(given, [*by, "class"]).groupBy(*by)
            .agg(F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1_weighted")))
