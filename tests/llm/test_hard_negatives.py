"""Hard-negative mining (op11) against a plain loop over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, positives=5, negatives=5, scale=256):
    sizes = [len(e) for _, label, e in rows if e is not None and label is not None]
    length = max(set(sizes), key=lambda n: (sizes.count(n), -n)) if sizes else 0
    rows = [(i, label, [math.floor(x * scale) for x in e]) for i, label, e in rows
            if i is not None and label is not None and e is not None and len(e) == length and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for i, label, e in rows:
        if i % 100:
            continue
        ranked = sorted((-sum(a * b for a, b in zip(e, other)), j, theirs) for j, theirs, other in rows if j != i)
        for p, pos, _ in [r for r in ranked if r[2] == label][:positives]:
            own = [(-n, neg) for n, neg, theirs in ranked if theirs != label and 80 * -p <= 100 * -n <= 100 * -p]
            out += [(i, pos, rank, neg, -p, n) for rank, (n, neg) in enumerate(own[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 100 == 0, **options).collect()))


def clustered(n, seed=1, step=25, size=8, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    at = rng.integers(0, 6, n)
    x = centres[at] + spread * rng.normal(size=(n, size))
    return [(i * step, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(x)]


def test_equals_a_plain_loop_over_many_blocks_and_parts(spark, monkeypatch):
    rows = clustered(700)
    want = plain(rows)
    assert len(want) > 1000 and mined(spark, rows) == want
    monkeypatch.setattr(hard_negatives, "FIRST_BLOCK", 20)
    assert mined(spark, rows, clusters=9, member_rows=7, part_rows=16) == want


def test_certificates_spare_entries(spark):
    """On clustered vectors a member stops long before the end of its list, with the same result."""
    rows = clustered(1500, seed=3, step=100, spread=0.05)
    scored = []
    frame = spark.createDataFrame(rows, SCHEMA)
    kept, _, dtype, longest = hard_negatives.compact(hard_negatives.scaled(frame, 256))
    pdf = kept.toPandas()
    points, norm = hard_negatives.directions(hard_negatives.matrix(pdf["vec"], dtype))
    found = hard_negatives.centres(points, 6)
    angle = np.arccos(np.clip(points @ found.T, -1, 1))
    near = angle.argmin(axis=1)
    lists = hard_negatives.Lists(found, np.array([angle[near == c, c].max() for c in range(6)]), longest, dtype)
    bounds = lists.bounds(hard_negatives.matrix(pdf["vec"], dtype))
    for c in range(6):
        members = pdf[near == c].assign(anchor=np.flatnonzero(near == c), norm=norm[near == c], low=[[hard_negatives.LOWEST]] * (near == c).sum(),
                                        high=[[hard_negatives.HIGHEST]] * (near == c).sum(), kept=[[hard_negatives.LOWEST]] * (near == c).sum())
        entries = pdf.assign(bound=bounds[:, c]).sort_values("bound", ascending=False)
        whole = hard_negatives.walk(members, entries, True, 5, hard_negatives.ROOM * longest, dtype)
        for size in (150, 400, 800):
            part = hard_negatives.walk(members, entries[:size], True, 5, hard_negatives.ROOM * longest, dtype)
            fifth = part.groupby("anchor").score.agg(["size", "min"])
            if len(fifth) == len(members) and (fifth["size"] == 5).all() and (fifth["min"] > norm[fifth.index] * entries.bound.iloc[size]).all():
                assert part.sort_values(["anchor", "score", "found"]).values.tolist() == whole.sort_values(["anchor", "score", "found"]).values.tolist()
                scored.append(size)
                break
    assert len(scored) >= 4


def test_bounds_are_never_exceeded():
    rng = np.random.default_rng(5)
    x = rng.integers(-200, 200, (300, 5)).astype(float)
    x[:20] = 0
    x[20:60] *= 10
    points, norm = hard_negatives.directions(x)
    found = hard_negatives.centres(points[::3], 7)
    angle = np.where(norm[:, None] > 0, np.arccos(np.clip(points @ found.T, -1, 1)), 0.0)
    near = angle.argmin(axis=1)
    widest = np.array([angle[near == c, c].max(initial=0) for c in range(len(found))])
    lists = hard_negatives.Lists(found, widest, norm.max(), np.dtype("<i4"))
    bounds = lists.bounds(x)
    assert (x @ x.T <= norm[:, None] * (bounds[:, near].T + hard_negatives.ROOM * norm.max())).all()
    bins = lists.bins(bounds)
    lists.cut(np.stack([np.bincount(bins[:, c], minlength=hard_negatives.BINS) for c in range(len(found))]))
    inside = np.stack([lists.inside(bins, k) for k in range(lists.blocks())])
    assert (inside.sum(axis=0) == 1).all() and (inside.sum(axis=1) == lists.entries.T).all()


def test_ties_zero_vectors_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, i % 3, (rng.integers(-2, 3, 4) / 256).tolist()) for i in range(0, 3000, 10)]
    rows += [(100, 1, [0.0] * 4), (200, 2, [0.0] * 4), (200, 2, [1.0, 0.5, 0.0, -0.5]), (200, 1, [1.0, 0.5, 0.0, -0.5])] * 2
    rows += [(1, None, [1.0] * 4), (300, 1, None), (400, 1, [1.0, None, 0.0, 0.0]), (500, 1, [math.nan, 0.0, 0.0, 0.0]), (600, 1, [math.inf, 0.0, 0.0, 0.0]),
             (None, 1, [1.0] * 4), (700, 1, [1.0] * 3), (800, 2, [])]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, clusters=1, part_rows=10) == plain(rows)


def test_large_components_stay_exact_or_are_refused(spark):
    rng = np.random.default_rng(3)
    rows = [(i * 20, i % 2, (rng.normal(size=3) * 2 ** 18).tolist()) for i in range(60)]
    assert mined(spark, rows) == plain(rows)
    with pytest.raises(ValueError, match="beyond 64 bits"):
        mined(spark, [(0, 1, [1e30, 0.0]), (1, 1, [1.0, 0.0])])


def test_few_rows_empty_table_and_clashing_columns(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1.0, 0.0])]) == mined(spark, [(1, 1, [1.0, 0.0]), (2, 2, [1.0, 0.0])]) == []
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.9, 0.0]), (3, 2, [0.1, 0.0]), (4, 1, [-1.0, 0.0])]
    assert mined(spark, rows) == plain(rows) == [(0, 1, 1, 2, 65536, 58880)]
    frame = spark.createDataFrame([(*r, 7, "x", 0) for r in rows], SCHEMA + ", anchor int, vec string, cluster int")
    assert list(map(tuple, hard_negatives.mine(frame, F.col("vec_id") % 100 == 0).collect())) == plain(rows)
