"""Hard-negative mining with candidate lists that a cluster of anchors shares.

Every anchor wants its best candidates by inner product: first the best of its own label (its positives), then
for each positive the best of other labels within a band below the positive's score (its hard negatives).

1. **Clusters.** Anchors are clustered by direction (k-means on a bounded sample of anchors; every anchor is
   assigned). A cluster has a centre and the largest angle t of a member to it.
2. **One list a cluster.** A candidate at angle p to the centre scores at most |anchor| * bound with any member,
   bound = |candidate| * cos(max(0, p - t)). A cluster's list is all candidates in falling order of bound. The
   order is fixed once, for both uses: a pass over the candidates counts bounds in ``BINS`` bins for each cluster,
   and the bins are cut into blocks that double in size. Only the blocks that are walked are ever shuffled.
3. **Walks.** Block by block, the members that still run meet the entries of their cluster's block. Entries are
   sorted by bound and scored a chunk at a time, as a product of two matrices. A member stops when |member| * bound
   of the next entry is below what its worst kept candidate scores, or below its band: no later entry can enter
   its results, so they are exact. A member that never gets such a certificate walks the whole list.

Scores are exact integers. A cluster of many anchors is dealt to several tasks (``member_rows``), and so is a
block of many entries (``part_rows``); each keeps its best, which are ranked once more. The driver holds the
centres, the bin counts (``clusters`` x ``BINS``) and the block table, none of which grows with the rows.

Defined results: rows with a null id, label or vector, with null or non-finite components, or of another length than
the most common one take no part; a zero vector takes part; a repeated id counts as separate rows, but no row is
a candidate of an anchor of its own id, and each row of a repeated anchor id gives the rows of that anchor; equal
scores go by smaller id; fewer candidates give fewer rows; an empty table gives an empty table; other columns are
ignored, whatever their names. Vectors whose scores could exceed 64 bits are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import materialise

#: Bins of a cluster's bounds.
BINS = 512
#: Entries that are scored at a time, and entries of the first block at least.
CHUNK, FIRST_BLOCK = 1024, 4096
#: Rounding room of the bounds, as a share of the longest vector. Angles near 0 are exact to about 1e-8.
ROOM = 1e-6
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, vec being floor(scale * x) of every component."""
    x = F.col("embedding").cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & whole)
    rows = rows.select("vec_id", "label", F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double")).alias("vec"))
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).select("n")
    return rows.join(F.broadcast(common), F.size("vec") == F.col("n")).select("vec_id", "label", "vec")


def compact(rows: DataFrame) -> tuple[DataFrame, int, np.dtype, float]:
    """The rows with vec as bytes of the smallest integer type that holds all, their number, that type, and the
    longest norm."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v))
    count, size, largest, longest = rows.agg(F.count("*"), F.max(F.size("vec")), F.max(F.array_max(F.transform("vec", F.abs))), F.max(norm)).first()
    largest = largest or 0.0
    if (size or 0) * largest ** 2 >= float(1 << 62):
        raise ValueError(f"components up to {largest} give scores beyond 64 bits")
    dtype = np.dtype(next(t for t in ("<i2", "<i4", "<i8") if largest <= np.iinfo(t).max))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vec], pa.binary())], names=["vec_id", "label", "vec"])

    return materialise(rows.mapInArrow(run, "vec_id long, label long, vec binary"), "vectors"), count, dtype, longest or 0.0


def matrix(vec, dtype: np.dtype) -> np.ndarray:
    """Vectors as rows: 64-bit floats while every score is exact in them, else 64-bit integers."""
    vec = list(vec)
    plain = np.frombuffer(b"".join(vec), dtype=dtype).reshape(len(vec), -1)
    exact = not plain.size or plain.shape[1] * float(np.abs(plain.astype(np.float64)).max()) ** 2 < float(1 << 52)
    return plain.astype(np.float64 if exact else np.int64)


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = x.astype(np.float64)
    norm = np.sqrt((x ** 2).sum(axis=1))
    return x / np.where(norm, norm, 1.0)[:, None], norm


def centres(points: np.ndarray, clusters: int, rounds: int = 10, seed: int = 11) -> np.ndarray:
    """Unit centres by k-means on directions; an empty cluster keeps its centre."""
    points = np.unique(points, axis=0)
    found = points[np.random.default_rng(seed).permutation(len(points))[:clusters]]
    for _ in range(rounds):
        near = (points @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        unit, norm = directions(sums)
        found = np.where(norm[:, None] > 0, unit, found)
    return found


class Lists:
    """The order of every cluster's list: bounds of candidates, their bins, and the blocks of bins."""

    def __init__(self, centres: np.ndarray, widest: np.ndarray, longest: float, dtype: np.dtype):
        self.centres, self.widest, self.longest, self.dtype = centres, widest, longest, dtype
        self.low: np.ndarray = np.zeros((len(centres), 0), dtype=np.int64)
        self.entries: np.ndarray = self.low

    def angles(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unit, norm = directions(x)
        return np.where(norm[:, None] > 0, np.arccos(np.clip(unit @ self.centres.T, -1.0, 1.0)), 0.0), norm

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Row by cluster; a cluster without members has bounds too, which nobody asks for."""
        angle, norm = self.angles(x)
        return norm[:, None] * np.cos(np.maximum(angle - self.widest[None, :], 0.0))

    def bins(self, bounds: np.ndarray) -> np.ndarray:
        share = (bounds + self.longest) / (2 * self.longest) if self.longest else np.zeros_like(bounds)
        return np.clip((share * BINS).astype(np.int64), 0, BINS - 1)

    def highest(self, block: int) -> np.ndarray:
        """What no bound after this block exceeds, by cluster."""
        return self.low[:, block] / BINS * 2 * self.longest - self.longest

    def cut(self, counts: np.ndarray) -> None:
        """Blocks from the numbers of entries by cluster and bin: each goes on to a lower bin, and holds about
        twice as many entries as the one before."""
        total = int(counts.sum(axis=1).max())
        first, lows = max(FIRST_BLOCK, -(-total // 64)), []
        from_top = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # entries in this bin and above
        target = first
        while not lows or lows[-1].any():
            lows.append((from_top >= target).sum(axis=1).clip(1) - 1 if target < total else np.zeros(len(counts), dtype=np.int64))
            target = 2 * target + first
        self.low = np.stack(lows, axis=1)
        above = np.concatenate([from_top, np.zeros((len(counts), 1), dtype=np.int64)], axis=1)
        high = np.concatenate([np.full((len(counts), 1), BINS), self.low[:, :-1]], axis=1)
        at = np.arange(len(counts))[:, None]
        self.entries = above[at, self.low] - above[at, high]

    def blocks(self) -> int:
        return self.low.shape[1]

    def inside(self, bins: np.ndarray, block: int) -> np.ndarray:
        high = self.low[:, block - 1] if block else BINS
        return (bins >= self.low[:, block]) & (bins < high)


def count_bins(rows: DataFrame, lists: Lists) -> np.ndarray:
    """Entries by cluster and bin, counted in every task and then summed."""
    clusters = len(lists.centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(clusters * BINS, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                bins = lists.bins(lists.bounds(matrix(batch.column(0).to_pylist(), lists.dtype)))
                held += np.bincount((bins + np.arange(clusters)[None, :] * BINS).ravel(), minlength=len(held))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["at", "n"])

    out = np.zeros(clusters * BINS, dtype=np.int64)
    for r in rows.select("vec").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # clusters x BINS rows at most
        out[r["at"]] = r["n"]
    return out.reshape(clusters, BINS)


def best_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of every owner, ties by smaller id, in that order."""
    order = np.lexsort((ids, -score, owner))
    own = owner[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < k]


def walk(members: pd.DataFrame, entries: pd.DataFrame, same: bool, k: int, room: float, dtype: np.dtype) -> pd.DataFrame:
    """The best ``k`` entries of every member and band (anchor, band, score, found), each member walking the
    entries in falling order of bound until nothing that follows can enter its results."""
    entries = entries.sort_values("bound", ascending=False, kind="stable")
    bound, ids, labels = (entries[c].to_numpy() for c in ("bound", "vec_id", "label"))
    x, y = matrix(members["vec"], dtype), matrix(entries["vec"], dtype)
    if x.dtype != y.dtype or x.dtype == np.int64 or x.shape[1] * float(np.abs(x).max(initial=0)) * float(np.abs(y).max(initial=0)) >= float(1 << 52):
        x, y = x.astype(np.int64), y.astype(np.int64)
    own, label, norm = (members[c].to_numpy() for c in ("vec_id", "label", "norm"))
    bands = max(map(len, members["low"]))
    low, high, kept = (np.full((len(members), bands), fill, dtype=np.int64) for fill in (HIGHEST, LOWEST, LOWEST))
    for target, column in ((low, "low"), (high, "high"), (kept, "kept")):
        for i, values in enumerate(members[column]):
            target[i, :len(values)] = values
    owner, score, found = (np.empty(0, dtype=np.int64) for _ in range(3))
    running = np.arange(len(members))
    for at in range(0, len(ids), CHUNK):
        need = np.maximum(kept, low)[running].min(axis=1)
        running = running[norm[running] * (bound[at] + room) >= need]
        if not len(running):
            break
        some = slice(at, at + CHUNK)
        scores = (x[running] @ y[some].T).astype(np.int64)  # floats hold whole numbers here
        fits = ((label[running, None] == labels[None, some]) == same) & (own[running, None] != ids[None, some])
        for band in range(bands):
            inside = fits & (scores >= np.maximum(low, kept)[running, band, None]) & (scores <= high[running, band, None])
            wanted = np.where(inside, scores, LOWEST)
            if wanted.shape[1] > k:
                inside &= wanted >= np.partition(wanted, wanted.shape[1] - k, axis=1)[:, wanted.shape[1] - k, None]
            row, column = np.nonzero(inside)
            if len(row):
                owner = np.concatenate([owner, running[row] * bands + band])
                score, found = np.concatenate([score, scores[row, column]]), np.concatenate([found, ids[some][column]])
        best = best_of(owner, score, found, k)
        owner, score, found = owner[best], score[best], found[best]
        if len(owner):
            last = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
            full = last[np.bincount(owner, minlength=len(members) * bands)[owner[last]] == k]
            flat = kept.reshape(-1)
            flat[owner[full]] = np.maximum(flat[owner[full]], score[full])
    return pd.DataFrame({"anchor": members["anchor"].to_numpy()[owner // bands], "band": (owner % bands).astype(np.int32), "score": score, "found": found})


def walked(rows: DataFrame, anchors: DataFrame, lists: Lists, same: bool, k: int, part_rows: int) -> DataFrame:
    """(anchor, band, score, found, rank): the best ``k`` rows for every band (``low``, ``high``) of every anchor,
    of the anchor's label or of another one."""
    spark, room, dtype = rows.sparkSession, ROOM * lists.longest, lists.dtype
    spans = [r["spans"] for r in anchors.groupBy("cluster").agg((F.max("span") + 1).alias("spans")).orderBy("cluster").collect()]
    named = [r["cluster"] for r in anchors.select("cluster").distinct().orderBy("cluster").collect()]  # one row a cluster, as above
    copies = np.zeros(len(lists.centres), dtype=np.int64)
    copies[named] = spans
    active, found = anchors.withColumn("kept", F.transform("low", lambda _: F.lit(LOWEST).cast("long"))), None
    order = Window.partitionBy("anchor", "band").orderBy(F.desc("score"), "found")
    schema = "anchor long, band int, score long, found long"

    for block in range(lists.blocks()):
        parts = np.maximum(-(-lists.entries[:, block] // part_rows), 1)
        wanted = np.zeros(len(copies), dtype=bool)
        wanted[[r["cluster"] for r in active.select("cluster").distinct().collect()]] = True

        def emit(batches: Iterator[pa.RecordBatch], block=block, parts=parts, wanted=wanted) -> Iterator[pa.RecordBatch]:
            names = ["cluster", "span", "part", "vec_id", "label", "vec", "bound"]
            for batch in batches:
                if not batch.num_rows:
                    continue
                bounds = lists.bounds(matrix(batch.column(2).to_pylist(), dtype))
                row, cluster = np.nonzero(lists.inside(lists.bins(bounds), block) & wanted[None, :])
                times = copies[cluster]
                span = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, cluster = np.repeat(row, times), np.repeat(cluster, times)
                # neighbours by id may be alike, so entries are dealt by a mixed id
                mixed = (batch.column(0).to_numpy()[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                part = mixed.astype(np.int64) % parts[cluster]
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(span), pa.array(part), *(batch.column(i).take(take) for i in range(3)),
                                                  pa.array(bounds[row, cluster])], names=names)

        def meet(members: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
            if not len(members) or not len(entries):
                return pd.DataFrame({"anchor": [], "band": [], "score": [], "found": []}).astype({"anchor": int, "band": np.int32, "score": int, "found": int})
            return walk(members, entries, same, k, room, dtype)

        entries = rows.select("vec_id", "label", "vec").mapInArrow(emit, "cluster long, span long, part long, vec_id long, label long, vec binary, bound double")
        dealt = spark.createDataFrame([(c, int(p)) for c, p in enumerate(parts)], "cluster long, parts long")  # one row a cluster
        members = (active.join(F.broadcast(dealt), "cluster")
                   .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
                   .select(F.col("cluster").alias("m_cluster"), F.col("span").alias("m_span"), F.col("part").alias("m_part"), "anchor", "vec_id", "label", "vec",
                           "norm", "low", "high", "kept"))
        new = members.groupBy("m_cluster", "m_span", "m_part").cogroup(entries.groupBy("cluster", "span", "part")).applyInPandas(meet, schema)
        union = new if found is None else found.select("anchor", "band", "score", "found").unionByName(new)
        found = materialise(union.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k), "walked")
        if block + 1 == lists.blocks():
            break
        last = found.groupBy("anchor", "band").agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(LOWEST).cast("long")).alias("last"))
        last = last.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("band", "last"))).alias("last"))
        unseen = spark.createDataFrame([(c, float(b) + room, bool(lists.low[c, block])) for c, b in enumerate(lists.highest(block))],
                                       "cluster long, unseen double, more boolean")
        kept = F.transform("low", lambda _, i: F.coalesce(F.try_element_at("last", i), F.lit(LOWEST).cast("long")))
        need = F.array_min(F.transform(F.arrays_zip("kept", "low"), lambda z: F.greatest(z["kept"], z["low"])))
        active = (active.drop("kept").join(last, "anchor", "left").withColumn("kept", kept).join(F.broadcast(unseen), "cluster")
                  .filter(F.col("more") & (F.col("norm") * F.col("unseen") >= need)).drop("last", "unseen", "more"))
        active = materialise(active, "active")
        if active.isEmpty():
            break
    return found


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, band: tuple[int, int] = (80, 100), scale: int = 256,
         clusters: int | None = None, sample: int = 20_000, member_rows: int = 2048, part_rows: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row of ``vectors``
    (vec_id, label, embedding) for which ``is_anchor`` (of vec_id and label) holds and each of its best
    ``positives`` of its own label, the best ``negatives`` of other labels that score from ``band[0]`` to
    ``band[1]`` per cent of the positive's score."""
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows, count, dtype, longest = compact(scaled(vectors, scale))
    chosen = rows.filter(F.coalesce(is_anchor, F.lit(False)))
    picked = chosen.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").toPandas()  # at most ``sample``
    if not len(picked):
        return rows.sparkSession.createDataFrame([], result)
    n_anchors = chosen.count()
    points = directions(matrix(picked["vec"], dtype))[0]
    lists = Lists(centres(points, clusters or min(max(1, -(-n_anchors // 64)), 256)), np.zeros(1), longest, dtype)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angle, norm = lists.angles(matrix(batch.column(2).to_pylist(), dtype))
                near = angle.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near), pa.array(angle[np.arange(len(near)), near]), pa.array(norm)],
                                                 names=["vec_id", "label", "vec", "cluster", "angle", "norm"])

    anchors = chosen.select("vec_id", "label", "vec").mapInArrow(assign, "vec_id long, label long, vec binary, cluster long, angle double, norm double")
    anchors = materialise(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    widest, spans = np.zeros(len(lists.centres)), np.ones(len(lists.centres), dtype=np.int64)
    for r in anchors.groupBy("cluster").agg(F.max("angle").alias("angle"), F.count("*").alias("n")).collect():  # one row a cluster
        widest[r["cluster"]], spans[r["cluster"]] = r["angle"], -(-r["n"] // member_rows)
    lists = Lists(lists.centres, widest, longest, dtype)
    lists.cut(count_bins(rows, lists))
    dealt = rows.sparkSession.createDataFrame([(c, int(n)) for c, n in enumerate(spans)], "cluster long, spans int")
    anchors = anchors.join(F.broadcast(dealt), "cluster").withColumn("span", F.pmod(F.xxhash64("anchor"), F.col("spans"))).drop("spans", "angle")

    any_score = {"low": F.array(F.lit(LOWEST).cast("long")), "high": F.array(F.lit(HIGHEST).cast("long"))}
    best = walked(rows, anchors.withColumns(any_score), lists, True, positives, part_rows)
    best = best.select("anchor", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("place"))
    score = F.col("positive_score")
    bottom, top = (F.expr(f"(positive_score * {share}) div 100") for share in band)
    # div cuts towards zero, which is not always the ceiling or the floor
    bottom = bottom + (score * band[0] > bottom * 100).cast("long")
    top = top - (score * band[1] < top * 100).cast("long")
    bounded = best.select("*", bottom.alias("bottom"), top.alias("top")).filter("bottom <= top")
    asked = bounded.groupBy("anchor").agg(F.array_sort(F.collect_set(F.struct("bottom", "top"))).alias("asked"))  # at most ``positives`` bands
    bands = anchors.join(asked, "anchor").select("*", F.col("asked.bottom").alias("low"), F.col("asked.top").alias("high")).drop("asked")
    bands = materialise(bands, "bands")
    if bands.isEmpty():
        return rows.sparkSession.createDataFrame([], result)
    worst = walked(rows, bands, lists, False, negatives, part_rows)
    known = bands.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode(F.arrays_zip("low", "high")).alias("band", "z"))
    known = known.select("anchor", "anchor_id", "band", F.col("z.low").alias("bottom"), F.col("z.high").alias("top"))
    out = bounded.join(known, ["anchor", "bottom", "top"]).join(worst, ["anchor", "band"])
    return out.select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
