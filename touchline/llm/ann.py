"""Approximate nearest neighbours: inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; a vector's cell is its pair of centroids.
For a query the distances to each codebook are sorted, and a heap walks the centroid pairs in order of their
summed distance until the cells visited hold enough vectors. Those are reranked by the exact inner product.

Nearness is the largest inner product. Every vector gets one more component, sqrt(R^2 - |x|^2) with R the
largest norm, so that the nearest by Euclidean distance (query component 0) is the largest inner product; for
unit vectors it is 0.

Distribution: codebooks are fitted on a bounded sample (``sample`` rows by hash of the id); every vector is
indexed. The table of cell sizes has at most ``centroids`` squared rows. Cells are packed in runs of ``part_rows``
to ``run_rows`` vectors; a cell above ``part_rows`` is a run of its own, dealt in parts of about that many (by hash
of the id), so a hot cell, such as one of equal vectors, is many tasks. A query goes once to each run of which it
visits a cell, with a bit for each of the run's cells, and meets their vectors in a cogroup of at most about
``query_rows`` queries. Each returns a query's best k, and a query's parts are ranked once more.

Recall: the walk stops at ``share`` of all vectors and at least ``least`` of them. Measured recall is in the
README; share = 1 visits every cell and is exact.

Defined results: vectors that are null, zero, of another length than the most common one, or hold a null or
non-finite component take no part; a repeated id counts as separate rows; equal scores go by smaller id; fewer
candidates than k give shorter lists; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.common import materialise
from touchline.session import spread

#: Queries whose cells are chosen at a time, (query, run) rows of a batch, and scores held at a time.
SLICE, PAIRS, SCORES = 256, 4096, 2_000_000
#: Rounding room of the matrix product when candidates are short-listed before the exact scores.
ROOM = 1e-6


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec) of the vectors that take part."""
    vec = F.col("vec").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")).filter(
        F.col("vec_id").isNotNull() & vec.isNotNull() & finite & F.exists(vec, lambda x: x != 0.0))
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").limit(1).select("n")
    return rows.join(F.broadcast(common), F.size("vec") == F.col("n")).select("vec_id", "vec")


def norm2(vec: str) -> Column:
    return F.aggregate(F.col(vec).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def codebook(points: np.ndarray, centroids: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """k-means on the sample; empty clusters move to the points that lie worst."""
    rng = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    centres = points[rng.permutation(len(points))[:centroids]].copy()
    for _ in range(rounds):
        apart = ((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :])
        near = apart.argmin(1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
        if (empty := np.flatnonzero(count == 0)).size:
            centres[empty] = points[np.argsort(-apart.min(1), kind="stable")[:empty.size]]
    return centres


def distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :]


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, enough: int) -> list[int]:
    """Cells (first * n + second) in order of summed distance, until those visited hold ``enough`` vectors.
    Empty cells are passed over."""
    order_a, order_b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    da, db = first[order_a], second[order_b]
    heap, seen, cells, held = [(da[0] + db[0], 0, 0)], {(0, 0)}, [], 0
    while heap and held < enough:
        _, i, j = heapq.heappop(heap)
        cell = int(order_a[i]) * len(second) + int(order_b[j])
        if sizes[cell]:
            cells.append(cell)
            held += int(sizes[cell])
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(da) and b < len(db) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (da[a] + db[b], a, b))
    return cells


class Codebooks:
    """Two codebooks over the halves of the extended vectors."""

    def __init__(self, sample: np.ndarray, radius2: float, centroids: int):
        self.radius2, self.half = radius2, sample.shape[1] // 2
        self.books = [codebook(h, centroids) for h in self.halves(self.extended(sample))]

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.radius2 - (x ** 2).sum(1), 0.0)
        return np.concatenate([x, np.sqrt(np.where(rest < 1e-9 * self.radius2, 0.0, rest))[:, None]], axis=1)

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (distances(h, book).argmin(1) for h, book in zip(self.halves(self.extended(x)), self.books))
        return a.astype(np.int64) * len(self.books[1]) + b

    def visits(self, x: np.ndarray, sizes: np.ndarray, enough: int) -> list[list[int]]:
        plain = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        a, b = (distances(h, book) for h, book in zip(self.halves(plain), self.books))
        return [walk(a[i], b[i], sizes, enough) for i in range(len(x))]


def runs_of_cells(sizes: np.ndarray, part_rows: int, run_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """First cell and number of parts of each run: neighbouring cells that hold at most ``run_rows`` vectors together,
    and every cell above ``part_rows`` for itself."""
    firsts, parts, held = [0], [1], 0
    for cell, n in enumerate(sizes.tolist()):
        alone = n > part_rows
        if cell and (alone or parts[-1] > 1 or held + n > run_rows):
            firsts.append(cell)
            parts.append(1)
            held = 0
        held += n
        if alone:
            parts[-1] = -(-n // part_rows)
    return np.array(firsts), np.array(parts)


def top_k(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, places: np.ndarray | None = None) -> pd.DataFrame:
    """The best k of ``vectors`` for each of ``queries`` by exact inner product, ties by smaller id. With ``places``, the
    bit of each vector's cell, only among vectors whose bit is set in the query's ``visited``."""
    q, v = matrix(queries["vec"]), matrix(vectors["vec"])
    asked, ids, out = queries["query_id"].to_numpy(), vectors["vec_id"].to_numpy(), []
    longest, step = np.sqrt((v ** 2).sum(1).max()), max(1, min(SLICE, SCORES // len(v)))
    for at in range(0, len(q), step):
        some, own = q[at:at + step], asked[at:at + step]
        rough = some @ v.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        if places is not None:
            bits = np.stack([np.frombuffer(b, dtype=np.uint8) for b in queries["visited"].iloc[at:at + step]])
            seen = np.unpackbits(bits, axis=1).astype(bool)
            if not seen[:, places].all():
                rough[~seen[:, places]] = -np.inf
        if len(v) > k:
            # the matrix product rounds by place, so all that may belong to the best k are scored exactly
            room = ROOM * np.sqrt((some ** 2).sum(1)) * longest
            rough[rough < (np.partition(rough, len(v) - k, axis=1)[:, len(v) - k] - room)[:, None]] = -np.inf
        row, col = np.nonzero(rough > -np.inf)
        score = (v[col] * some[row]).sum(axis=1)
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < k
        out.append(pd.DataFrame({"query_id": own[row[best]], "vec_id": ids[col[best]], "score": score[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def visits_of_runs(batches: Iterator[pa.RecordBatch], books: Codebooks, layout: tuple[np.ndarray, np.ndarray, np.ndarray], enough: int) -> Iterator[pa.RecordBatch]:
    """A row for each part of each run of which a query (id, vec) visits a cell, with the bits of the cells that it visits.
    A batch of answers stays small, however many runs are met."""
    sizes, firsts, parts = layout
    ends = np.append(firsts[1:], len(sizes))
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            some = batch.slice(at, SLICE)
            seen = np.zeros((some.num_rows, len(sizes)), dtype=bool)
            for i, cells in enumerate(books.visits(matrix(some.column(1).to_pandas()), sizes, enough)):
                seen[i, cells] = True
            row, run = np.nonzero(np.logical_or.reduceat(seen, firsts, axis=1))
            bits = [np.packbits(seen[:, a:b], axis=1) for a, b in zip(firsts, ends)]
            times = parts[run]
            part = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, run = np.repeat(row, times), np.repeat(run, times)
            for a in range(0, len(row), PAIRS):
                r, c = row[a:a + PAIRS], run[a:a + PAIRS]
                own = some.take(pa.array(r))
                visited = pa.array([bits[y][x].tobytes() for x, y in zip(r, c)], pa.binary())
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(c, pa.int64()), pa.array(part[a:a + PAIRS], pa.int64()), visited],
                                                 names=["query_id", "vec", "q_run", "q_part", "visited"])


def search(vectors: DataFrame, is_query: Column, k: int = 20, centroids: int | None = None, share: float = 0.65, least: int = 2000,
           sample: int = 20_000, part_rows: int = 4000, run_rows: int = 20_000, query_rows: int = 20_000) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of ``vectors`` (vec_id, embedding) for each
    row for which ``is_query`` holds, without the query's own id. ``centroids`` per codebook default to the
    fourth root of the number of vectors, 16 at least."""
    rows = materialise(usable(vectors).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    fitted = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").toPandas()  # at most ``sample``
    count, radius2, queries = rows.agg(F.count("*"), F.max(norm2("vec")), F.count_if("is_query")).first()
    result = "query_id long, vec_id long, score double"
    if not count:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    centroids = centroids or max(16, int(np.ceil(count ** 0.25)))
    books = Codebooks(matrix(fitted["vec"]), radius2, centroids)
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(books)
    vec = f"vec {rows.schema['vec'].dataType.simpleString()}"

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=shared.value.cells(matrix(pdf["vec"])))

    indexed = materialise(rows.mapInPandas(assign, f"vec_id long, {vec}, is_query boolean, cell long"), "indexed")
    sizes = np.zeros(len(books.books[0]) * len(books.books[1]), dtype=np.int64)
    for r in indexed.groupBy("cell").count().collect():  # at most centroids squared rows
        sizes[r["cell"]] = r["count"]
    enough = max(least, int(np.ceil(share * count)))
    # larger runs send a query to fewer places, but every core has a few
    firsts, parts = runs_of_cells(sizes, part_rows, max(part_rows, min(run_rows, count // (4 * context.defaultParallelism))))
    layout = context.broadcast((sizes, firsts, parts))
    spans = max(1, -(-queries // query_rows))

    def visit(batches):
        yield from visits_of_runs(batches, shared.value, layout.value, enough)

    def deal(batches):
        _, firsts, parts = layout.value
        for pdf in batches:
            cell = pdf["cell"].to_numpy(dtype=np.int64)
            run = np.searchsorted(firsts, cell, side="right") - 1
            yield pdf.assign(cell=cell - firsts[run], run=run, parts=parts[run])

    asked = spread(indexed.filter("is_query").select("vec_id", "vec")).mapInArrow(visit, f"query_id long, {vec}, q_run long, q_part long, visited binary")
    asked = asked.withColumn("q_span", F.pmod(F.xxhash64("query_id"), F.lit(spans)))
    held = (indexed.select("vec_id", "vec", "cell").mapInPandas(deal, f"vec_id long, {vec}, cell long, run long, parts long")
            .select("vec_id", "vec", "cell", "run", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spans - 1).cast("long"))).alias("span")))

    def rerank(keys, queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return top_k(queries, found, k, found["cell"].to_numpy(dtype=np.int64))

    best = asked.groupBy("q_run", "q_part", "q_span").cogroup(held.groupBy("run", "part", "span")).applyInPandas(rerank, result)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
