"""Sharding: global byte-size prefix sums cut at equal targets into contiguous balanced shards.

Rows are range-partitioned and sorted by ``order``; each partition streams its running size, the
per-partition totals give each partition its offset, and a row's shard follows from its global prefix.
One shuffle of the rows, no single-task window over them; only one row per partition and per cut is
handled centrally.

Defined results: sizes that are null count 0; ties of the order are broken by scan order; an empty table
gives an empty table; input columns keep their names and values, also when they clash with helper names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.common import fresh, materialise

#: Cuts move to the edge of a group of equal ``group`` values when that shifts them by at most this share
#: of a shard's target size, so that small groups stay whole and shards stay balanced.
GROUP_TOLERANCE = 0.002


def with_prefix(df: DataFrame, size: str, order: list[str]) -> DataFrame:
    """``df`` plus ``start`` (global size before the row) and ``index`` (global row number from 0), in
    ``order``. Returns the written table."""
    part, pos, before, tie = fresh(df, "_part", "_pos", "_before", "_tie")
    ranged = (df.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(*order, tie).sortWithinPartitions(*order, tie).drop(tie))
    schema = T.StructType(ranged.schema.fields + [T.StructField(part, T.LongType()), T.StructField(pos, T.LongType()),
                                                  T.StructField(before, T.LongType())])

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = np.asarray(batch.column(batch.schema.get_field_index(size)).cast(pa.int64()).fill_null(0))
            ends = total + np.cumsum(sizes, dtype=np.int64)
            extra = [pa.array(np.full(n, task, dtype=np.int64)), pa.array(np.arange(rows, rows + n, dtype=np.int64)),
                     pa.array(ends - sizes)]
            yield pa.RecordBatch.from_arrays(batch.columns + extra, names=batch.schema.names + [part, pos, before])
            if n:
                rows, total = rows + n, int(ends[-1])

    placed = materialise(ranged.mapInArrow(running, schema), "prefix")
    in_order = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = (placed.groupBy(part).agg(F.sum(F.coalesce(F.col(size), F.lit(0))).cast("long").alias("_bytes"), F.count("*").alias("_rows"))
               .select(F.col(part).alias("_p"), F.coalesce(F.sum("_bytes").over(in_order), F.lit(0)).alias("_b0"),
                       F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_r0")))
    start, index = fresh(df, "start", "index")
    return (placed.join(F.broadcast(offsets), F.col(part) == F.col("_p"))
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_b0") + F.col(before)).alias(start),
                    (F.col("_r0") + F.col(pos)).alias(index)))


def cut_points(placed: DataFrame, size: str, shards: int, group: str | None = None) -> list[int]:
    """The ``shards - 1`` cut positions: equal targets, moved to a group's edge where that is near."""
    total = placed.agg(F.max(F.col("start") + F.coalesce(F.col(size), F.lit(0)))).first()[0] or 0
    cuts = [total * k // shards for k in range(1, shards)]
    if not group or not total:
        return cuts
    inside = None
    for cut in cuts:
        hit = (F.col("start") < cut) & (F.col("start") + F.coalesce(F.col(size), F.lit(0)) >= cut)
        inside = hit if inside is None else inside | hit
    if inside is None:
        return cuts
    groups = placed.filter(inside).select(F.col(group).alias("_g")).distinct()  # a group per cut at most
    edges = (placed.join(F.broadcast(groups), F.col(group).eqNullSafe(F.col("_g"))).groupBy("_g")
             .agg(F.min("start").alias("lo"), F.max(F.col("start") + F.coalesce(F.col(size), F.lit(0))).alias("hi")).collect())
    reach = total / shards * GROUP_TOLERANCE
    out = []
    for cut in cuts:
        near = [e for r in edges if r["lo"] < cut <= r["hi"] for e in (r["lo"], r["hi"]) if abs(e - cut) <= reach]
        out.append(min(near, key=lambda e: abs(e - cut)) if near else cut)
    return out


def balanced_shards(df: DataFrame, size: str, order: list[str], shards: int = 16, group: str | None = None) -> DataFrame:
    """``df`` plus ``shard`` (0 to ``shards - 1``) and ``slot`` (row number within the shard, from 0).

    A row belongs to the shard whose byte range holds the row's start, so shard sizes differ from the
    target by less than one row (plus ``GROUP_TOLERANCE`` where a cut moved to a group's edge).
    """
    placed = with_prefix(df.toDF(*[f"c{i}" for i in range(len(df.columns))]),
                         f"c{df.columns.index(size)}", [f"c{df.columns.index(c)}" for c in order])
    group = None if group is None else f"c{df.columns.index(group)}"
    cuts = cut_points(placed, f"c{df.columns.index(size)}", shards, group)
    shard = sum((F.when(F.col("start") >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0))
    placed = placed.withColumn("shard", shard.cast("int"))
    firsts = placed.groupBy(F.col("shard").alias("_s")).agg(F.min("index").alias("_first"))
    out = (placed.join(F.broadcast(firsts), F.col("shard") == F.col("_s"))
           .withColumn("slot", F.col("index") - F.col("_first")))
    shard_name, slot_name = fresh(df, "shard", "slot")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns)],
                      F.col("shard").alias(shard_name), F.col("slot").alias(slot_name))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard under ``path``; large shards are written by many tasks."""
    sharded.write.partitionBy("shard").parquet(path)
