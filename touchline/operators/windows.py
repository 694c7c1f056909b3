"""Order-dependent operators over entity histories.

Every operator takes the entity key columns, the ordering columns (the last one must make the order
unique, e.g. ``(kickoff, id)``) and column names, and returns the input DataFrame with new columns.
All columns computed by one call share one ``WindowSpec`` so the plan has one Exchange, one Sort and
one Window node.

Skew. A window partitioned by entity sends every row of an entity to one task. When one entity holds
a large share of the table (the design assumes up to a third), that task would hold it all. The
``_SegmentedPlan`` below splits such *hot* keys: their rows are range-partitioned on
``(key, order)`` into contiguous segments of about ``rows_per_task`` rows, each segment receives the
``lookback`` rows that precede it (halo rows, taken from the small table of segment tails), the window
runs per ``(key, segment)``, and halo rows are dropped. Row numbers and running totals get exact
offsets from a small per-segment count/sum table. Cold keys use the plain window. Results are
identical to the plain window; only the physical layout differs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_TASK_CONF = "touchline.skew.rowsPerTask"
DEFAULT_ROWS_PER_TASK = 4_000_000

_SEG = "_tl_seg"
_HALO = "_tl_halo"


def _names(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _order_cols(order: Sequence[str], descending: bool = False) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def rows_per_task(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(ROWS_PER_TASK_CONF, None)
    return int(value) if value else DEFAULT_ROWS_PER_TASK


@dataclass
class WindowJob:
    """What one shared window computes.

    ``build(w)`` returns ``{name: Column}`` using the window ``w`` (already partitioned and ordered).
    ``lookback`` is how many preceding rows any output needs (0 = only the row itself).
    ``row_number_cols`` are outputs that count rows from the start of the entity; ``running_cols``
    maps an output to the source column whose running total from the entity start it holds. Both
    need exact offsets when an entity is split.
    """

    build: Callable[[Window], dict[str, Column]]
    lookback: int = 0
    row_number_cols: list[str] = field(default_factory=list)
    running_cols: dict[str, str] = field(default_factory=dict)
    # output -> source: "last non-null source value before this row" outputs (as-of); a split key
    # fills a null output from the last non-null value of earlier segments
    carry_cols: dict[str, str] = field(default_factory=dict)


def hot_key_rows(df: DataFrame, key_sets: Sequence[str | Sequence[str]], rows_per_segment: int | None = None) -> dict[tuple[str, ...], int]:
    """Rows held by hot keys (more than ``rows_per_segment`` rows) for several key sets, in one pass.

    One ``GROUPING SETS`` aggregation (a single scan, expanded per key set) counts rows per key; the
    per-set totals of hot keys come back as a handful of scalars.
    """
    limit = rows_per_segment or rows_per_task(df)
    sets = [tuple(_names(k)) for k in key_sets]
    cols: list[str] = []
    for ks in sets:
        cols += [c for c in ks if c not in cols]
    gid_of = {ks: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in ks) for ks in sets}
    counts = (df.groupingSets([[F.col(c) for c in ks] for ks in sets], *[F.col(c) for c in cols])
                .agg(F.count(F.lit(1)).alias("_tl_n"), F.grouping_id().alias("_tl_gid")))
    found = {r["_tl_gid"]: r["_tl_rows"] for r in
             counts.filter(F.col("_tl_n") > limit).groupBy("_tl_gid").agg(F.sum("_tl_n").alias("_tl_rows")).collect()}
    return {ks: int(found.get(gid, 0) or 0) for ks, gid in gid_of.items()}


def apply_window(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], job: WindowJob,
                 skew: str = "auto", rows_per_segment: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Run ``job`` per entity. ``skew``: ``auto`` splits entities above ``rows_per_segment`` rows,
    ``off`` always uses the plain window (only for inputs whose entity size is bounded).
    ``hot_rows`` (from ``hot_key_rows``) skips the detection pass when already known."""
    keys = _names(keys)
    order = list(order)
    if skew == "off":
        return _plain(df, keys, order, job)
    limit = rows_per_segment or rows_per_task(df)
    if hot_rows is None:
        hot_rows = hot_key_rows(df, [keys], limit)[tuple(keys)]
    if hot_rows == 0:
        return _plain(df, keys, order, job)
    # A split reads its input three times and a following window would repeat all of that: the input is
    # written once, so a chain of windows stays linear in its scans.
    df = df.checkpoint(eager=True)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tl_n"))
    # At most rows/limit hot keys exist, so broadcasting this table is bounded by construction.
    hot = F.broadcast(counts.filter(F.col("_tl_n") > limit).select(*[F.col(k).alias(f"_tl_hk_{k}") for k in keys], F.lit(True).alias("_tl_hot")))
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(hot[f"_tl_hk_{k}"])   # a hot null key is split too
        cond = c if cond is None else cond & c
    marked = df.join(hot, cond, "left")
    cold = marked.filter(F.col("_tl_hot").isNull()).select(*df.columns)
    hot_df = marked.filter(F.col("_tl_hot").isNotNull()).select(*df.columns)
    segments = max(2, -(-hot_rows // limit))
    return _plain(cold, keys, order, job).unionByName(_segmented(hot_df, keys, order, job, segments))


def _join_null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str = "left") -> DataFrame:
    """Join on ``cols`` with ``<=>`` so a null entity key (e.g. a missing referee) matches itself."""
    r = right.select(*[F.col(c).alias(f"_tl_r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        x = left[c].eqNullSafe(r[f"_tl_r_{c}"])
        cond = x if cond is None else cond & x
    return left.join(r, cond, how).drop(*[f"_tl_r_{c}" for c in cols])


def _plain(df: DataFrame, keys: list[str], order: list[str], job: WindowJob) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumns(job.build(w))


def _segmented(df: DataFrame, keys: list[str], order: list[str], job: WindowJob, segments: int) -> DataFrame:
    spark = df.sparkSession
    # Contiguous (key, order) ranges; checkpoint fixes the segment id so a lost executor recomputes
    # the same assignment, and cuts the lineage of the hot part.
    tagged = (df.repartitionByRange(segments, *[F.col(k) for k in keys], *_order_cols(order))
                .withColumn(_SEG, F.spark_partition_id()))
    tagged = tagged.checkpoint(eager=True)
    kseg = keys + [_SEG]

    pieces = tagged.withColumn(_HALO, F.lit(False))
    halos = None
    if job.lookback > 0:
        # Last `lookback` rows of every (key, segment): a table of lookback x segments rows.
        tail_w = Window.partitionBy(*kseg).orderBy(*_order_cols(order, descending=True))
        tails = tagged.withColumn("_tl_r", F.row_number().over(tail_w)).filter(F.col("_tl_r") <= job.lookback)
        # A tail row is needed by every later segment of its key until `lookback` newer tail rows exist.
        pos_w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
        last_w = Window.partitionBy(*keys)
        tails = (tails.withColumn("_tl_upto", F.coalesce(F.lead(_SEG, job.lookback).over(pos_w),
                                                         F.max(_SEG).over(last_w)))
                      .filter(F.col("_tl_upto") > F.col(_SEG)))
        halos = (tails.withColumn(_SEG, F.explode(F.sequence(F.col(_SEG) + 1, F.col("_tl_upto"))))
                      .drop("_tl_r", "_tl_upto")
                      .withColumn(_HALO, F.lit(True)))
        pieces = pieces.unionByName(halos)

    w = Window.partitionBy(*kseg).orderBy(*_order_cols(order))
    out = pieces.withColumns(job.build(w)).filter(~F.col(_HALO))

    if job.row_number_cols or job.running_cols:
        # Offsets from earlier segments of the same key: one row per (key, segment).
        sums = [F.count(F.lit(1)).alias("_tl_cnt")] + [
            F.sum(F.coalesce(F.col(src), F.lit(0))).alias(f"_tl_sum_{i}")
            for i, src in enumerate(job.running_cols.values())
        ]
        per_seg = tagged.groupBy(*kseg).agg(*sums)
        before = Window.partitionBy(*keys).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
        offs = per_seg.select(*kseg, F.coalesce(F.sum("_tl_cnt").over(before), F.lit(0)).alias("_tl_off"),
                              *[F.coalesce(F.sum(f"_tl_sum_{i}").over(before), F.lit(0)).alias(f"_tl_base_{i}")
                                for i in range(len(job.running_cols))])
        if halos is not None:
            # halo rows precede every real row of the segment, so in-segment row numbers and running
            # totals already include them once: remove them before adding the earlier segments
            hstats = halos.groupBy(*kseg).agg(F.count(F.lit(1)).alias("_tl_hcnt"), *[
                F.sum(F.coalesce(F.col(src), F.lit(0))).alias(f"_tl_hsum_{i}")
                for i, src in enumerate(job.running_cols.values())])
            offs = _join_null_safe(offs, hstats, kseg).select(
                *kseg, (F.col("_tl_off") - F.coalesce("_tl_hcnt", F.lit(0))).alias("_tl_off"),
                *[(F.col(f"_tl_base_{i}") - F.coalesce(F.col(f"_tl_hsum_{i}"), F.lit(0))).alias(f"_tl_base_{i}")
                  for i in range(len(job.running_cols))])
        out = _join_null_safe(out, offs, kseg)
        types = {f.name: f.dataType for f in out.schema.fields}
        # keep the plain path's types so the schema does not depend on whether a key was split
        adj = {c: (F.col(c) + F.col("_tl_off")).cast(types[c]) for c in job.row_number_cols}
        for i, name in enumerate(job.running_cols):
            adj[name] = (F.col(name) + F.col(f"_tl_base_{i}")).cast(types[name])
        out = out.withColumns(adj).drop("_tl_off", *[f"_tl_base_{i}" for i in range(len(job.running_cols))])
    if job.carry_cols:
        ordered = F.struct(*[F.col(c) for c in order])
        last_vals = tagged.groupBy(*kseg).agg(*[
            F.max_by(F.col(src), F.when(F.col(src).isNotNull(), ordered)).alias(f"_tl_last_{i}")
            for i, src in enumerate(job.carry_cols.values())])
        before = Window.partitionBy(*keys).orderBy(_SEG).rowsBetween(Window.unboundedPreceding, -1)
        carried = last_vals.select(*kseg, *[F.last(f"_tl_last_{i}", ignorenulls=True).over(before).alias(f"_tl_carry_{i}")
                                            for i in range(len(job.carry_cols))])
        out = _join_null_safe(out, carried, kseg)
        out = out.withColumns({name: F.coalesce(F.col(name), F.col(f"_tl_carry_{i}"))
                               for i, name in enumerate(job.carry_cols)}).drop(*[f"_tl_carry_{i}" for i in range(len(job.carry_cols))])
    return out.drop(_SEG, _HALO)


# ---------------------------------------------------------------------------------------------
# Operators
# ---------------------------------------------------------------------------------------------

def trailing(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], columns: Sequence[str], n: int,
             how: str = "mean", out: str = "{c}_last{n}", skew: str = "auto",
             rows_per_segment: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """Statistic of the previous ``n`` rows of the entity, current row excluded
    (``shift(1).rolling(n, min_periods=1)``). Null when no earlier non-null value exists."""
    fn = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[how]

    def build(w: Window) -> dict[str, Column]:
        frame = w.rowsBetween(-n, -1)
        result = {}
        for c in columns:
            value = fn(F.col(c)).over(frame)
            if how == "sum":
                # pandas rolling sum with min_periods=1 is null when the frame has no non-null value
                value = F.when(F.count(F.col(c)).over(frame) > 0, value)
            result[out.format(c=c, n=n)] = value
        return result

    return apply_window(df, keys, order, WindowJob(build, lookback=n), skew, rows_per_segment, hot_rows)


def trailing_guarded(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], columns: Sequence[str], n: int,
                     out: str = "{c}_last{n}", skew: str = "auto", rows_per_segment: int | None = None,
                     hot_rows: int | None = None) -> DataFrame:
    """Like ``trailing`` mean, but rows whose key is null get null (pandas drops null group keys;
    Spark would group all null keys together)."""
    keys_l = _names(keys)
    res = trailing(df, keys_l, order, columns, n, "mean", out, skew, rows_per_segment, hot_rows)
    key_ok = None
    for k in keys_l:
        cond = F.col(k).isNotNull()
        key_ok = cond if key_ok is None else key_ok & cond
    return res.withColumns({out.format(c=c, n=n): F.when(key_ok, F.col(out.format(c=c, n=n))) for c in columns})


def moving_average_complete(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], column: str, n: int,
                            out: str | None = None, skew: str = "auto", rows_per_segment: int | None = None,
                            hot_rows: int | None = None) -> DataFrame:
    """Inclusive moving average over the last ``n`` rows (current row included) that is null
    until ``n`` rows exist."""
    name = out or f"{column}_ma{n}"

    def build(w: Window) -> dict[str, Column]:
        frame = w.rowsBetween(-(n - 1), 0)
        return {name: F.when(F.count(F.lit(1)).over(frame) >= n, F.avg(column).over(frame))}

    return apply_window(df, keys, order, WindowJob(build, lookback=n - 1), skew, rows_per_segment, hot_rows)


def ordinal(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], name: str, base: int = 1,
            skew: str = "auto", rows_per_segment: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """W3 (``cumcount()+1``, base 1) and W4 (``cumcount()``, base 0)."""

    def build(w: Window) -> dict[str, Column]:
        return {name: F.row_number().over(w) - (1 - base)}

    return apply_window(df, keys, order, WindowJob(build, row_number_cols=[name]), skew, rows_per_segment, hot_rows)


def gap(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], clock: str, name: str,
        skew: str = "auto", rows_per_segment: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """``clock.diff().fillna(clock)`` per entity: first row gets its own clock value."""

    def build(w: Window) -> dict[str, Column]:
        return {name: F.col(clock) - F.coalesce(F.lag(clock, 1).over(w), F.lit(0))}

    return apply_window(df, keys, order, WindowJob(build, lookback=1), skew, rows_per_segment, hot_rows)


def running_before(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], columns: Sequence[str],
                   out: str = "{c}_before", skew: str = "auto", rows_per_segment: int | None = None,
                   hot_rows: int | None = None) -> DataFrame:
    """W6 (fixed form): total of ``columns`` over the earlier rows of the entity, 0 at the first row.

    The reference shifts over the whole table, so a match's first shot inherits the previous match's
    tally (SURVEY W6 quirk). Here the frame restarts per entity.
    """
    names = {out.format(c=c): c for c in columns}

    def build(w: Window) -> dict[str, Column]:
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        return {name: F.coalesce(F.sum(F.col(src)).over(frame), F.lit(0)) for name, src in names.items()}

    job = WindowJob(build, running_cols=names)
    return apply_window(df, keys, order, job, skew, rows_per_segment, hot_rows)


def _placed(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` in a global order, written to the checkpoint folder with the partition (``_tl_pid``) and the
    position in it (``_tl_inpart``): one range shuffle, no window."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c).asc() if isinstance(c, str) else c for c in order]
    at = F.monotonically_increasing_id()
    return (df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
              .withColumn("_tl_at", at).checkpoint(eager=True)
              .withColumns({"_tl_pid": F.shiftright("_tl_at", 33), "_tl_inpart": F.col("_tl_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_tl_at"))


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_idx", partitions: int | None = None) -> DataFrame:
    """0-based position of every row in a global order, computed without a single-task window.

    Range-partition and sort (Spark samples the bounds), write the rows with their position in the
    partition, and add the count of all earlier partitions (one row per partition, broadcast).
    """
    placed = _placed(df, order, partitions)
    counts = placed.groupBy("_tl_pid").agg(F.count(F.lit(1)).alias("_tl_cnt"))
    offsets = counts.select("_tl_pid", F.coalesce(F.sum("_tl_cnt").over(
        Window.orderBy("_tl_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_tl_off"))
    return (placed.join(F.broadcast(offsets), "_tl_pid")
                  .withColumn(name, (F.col("_tl_off") + F.col("_tl_inpart")).cast("long"))
                  .drop("_tl_pid", "_tl_inpart", "_tl_off"))


def running_totals(df: DataFrame, order: Sequence[str | Column], columns: dict[str, str], partitions: int | None = None) -> DataFrame:
    """Inclusive running total of each column (``columns``: source -> output) in a global order: totals
    within each range partition plus the totals of all earlier partitions (one row per partition)."""
    placed = _placed(df, order, partitions)
    local = Window.partitionBy("_tl_pid").orderBy("_tl_inpart").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("_tl_pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_tl_pid").agg(*[F.sum(c).alias(f"_tl_s_{o}") for c, o in columns.items()])
    offsets = sums.select("_tl_pid", *[F.coalesce(F.sum(f"_tl_s_{o}").over(before), F.lit(0)).alias(f"_tl_o_{o}") for o in columns.values()])
    out = placed.withColumns({o: F.sum(c).over(local) for c, o in columns.items()}).join(F.broadcast(offsets), "_tl_pid")
    return (out.withColumns({o: F.col(o) + F.col(f"_tl_o_{o}") for o in columns.values()})
               .drop("_tl_pid", "_tl_inpart", *[f"_tl_o_{o}" for o in columns.values()]))
