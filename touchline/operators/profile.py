"""Exploratory profiles.

Each profile is one or two aggregation passes; results are small report tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import geometry
from touchline.operators.windows import running_totals


def quality_summary(df: DataFrame, name: str, date_cols: Sequence[str] = ()) -> DataFrame:
    """Rows, columns, duplicate rows, missing cells, missing percent, invalid dates.

    Null counts for every column come from one aggregate. Duplicates = rows - distinct rows, where
    distinct rows are counted by grouping on all columns (hash-partitioned on the whole row, partial
    counts map-side), never by collecting rows.
    """
    cols = df.columns
    nulls = [F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"_n{i}") for i, c in enumerate(cols)]
    bad_dates = [F.sum((F.col(f"`{c}`").isNotNull() & F.try_to_timestamp(F.col(f"`{c}`").cast("string")).isNull()).cast("long"))
                 for c in date_cols]
    base = df.agg(F.count(F.lit(1)).alias("rows"), *nulls,
                  (sum(bad_dates) if bad_dates else F.lit(0).cast("long")).alias("invalid_dates"))
    distinct = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.count(F.lit(1)).alias("_c")).agg(F.count(F.lit(1)).alias("distinct_rows"))
    missing = sum(F.col(f"_n{i}") for i in range(len(cols))) if cols else F.lit(0)
    return base.crossJoin(distinct).select(
        F.lit(name).alias("table"), "rows", F.lit(len(cols)).alias("columns"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"), missing.alias("missing_cells"),
        F.when(F.col("rows") > 0, missing * 100.0 / (F.col("rows") * len(cols))).otherwise(F.lit(0.0)).alias("missing_pct"),
        "invalid_dates")


def null_counts(df: DataFrame, top: int = 10) -> DataFrame:
    """Per-column null counts (one aggregate, unpivoted), top-n by count (column name breaks ties)."""
    cols = df.columns
    agg = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols])
    long = agg.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "nulls")
    return long.orderBy(F.col("nulls").desc(), F.col("column")).limit(top)


def overview(df: DataFrame, name: str) -> DataFrame:
    """Rows, column count and the type list."""
    types = ", ".join(f"{n}:{t}" for n, t in df.dtypes)
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows",
                                                          F.lit(len(df.columns)).alias("columns"), F.lit(types).alias("dtypes"))


def ranked_quantiles(df: DataFrame, value: str, probs: dict[str, float], by: str | None = None, more: Sequence[Column] = (),
                     places: dict[str, Column] | None = None) -> DataFrame:
    """Exact quantiles (linear interpolation): rows are counted by (group, value), the counts are summed up in that
    order by distributed prefix sums, and each quantile reads the one or two values whose places cover its own.
    ``probs`` maps output to probability; ``more`` are further aggregates over ``_v`` (the value as double), ``places`` outputs
    that read the value at a place, an expression of the number of values ``_n``. Equal and
    null values are one row each before anything is ordered, so neither they nor a group meet in one task."""
    keys = [by] if by else []
    values = df.select(*keys, F.col(value).cast("double").alias("_v"))
    rows = running_totals(values.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_rows")), [*keys, "_v"], {"_rows": "_upto"})
    known = F.col("_v").isNotNull()
    groups = rows.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(
        F.min(F.when(known, F.col("_upto") - F.col("_rows"))).alias("_b"), F.coalesce(F.sum(F.when(known, F.col("_rows"))), F.lit(0)).alias("_n"))
    totals = values.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_v").groupBy(*[f"_g_{k}" for k in keys]).agg(F.count("_v").alias("_m"), *more)

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        if not keys:
            return left.crossJoin(F.broadcast(right))  # one row
        return left.join(right, F.col(keys[0]).eqNullSafe(F.col(f"_g_{keys[0]}"))).drop(f"_g_{keys[0]}")

    at = beside(rows, groups)
    last = F.col("_upto") - F.col("_b") - 1

    def value_at(place: Column) -> Column:
        return F.max(F.when((place <= last) & (place > last - F.col("_rows")), F.col("_v")))

    aggs = [value_at(place).alias(name) for name, place in (places or {}).items()]
    for name, p in probs.items():
        h = (F.col("_n") - 1) * p
        for part, edge in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            aggs.append(value_at(edge).alias(f"_{part}_{name}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_w_{name}"))
    out = beside(at.groupBy(*keys).agg(*aggs), totals).drop("_m")
    return out.withColumns({name: F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_w_{name}") for name in probs}).drop(
        *[f"_{part}_{name}" for name in probs for part in ("lo", "hi", "w")])


def describe_by(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation, like pandas) and max
    per class, exact."""
    out = ranked_quantiles(df, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, group, [
        F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"), F.min("_v").alias("min"), F.max("_v").alias("max")])
    return out.select(group, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_by_approx(df: DataFrame, group: str, value: str, accuracy: int = 10000) -> DataFrame:
    v = F.col(value).cast("double")
    q = F.percentile_approx(v, [0.25, 0.5, 0.75], accuracy)
    return df.groupBy(group).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                 F.min(v).alias("min"), q.alias("_q"), F.max(v).alias("max")).select(
        group, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"), F.col("_q")[1].alias("q50"),
        F.col("_q")[2].alias("q75"), "max")


def class_means(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Mean of each feature per class."""
    return df.groupBy(group).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def calibration_bins(df: DataFrame, prob: str, outcome: str, n: int = 8) -> DataFrame:
    """Equal-width probability buckets, last closed; mean predicted, mean observed, count;
    empty buckets dropped; label ``low-high%``."""
    b = df.select(F.col(prob).cast("double").alias("_p"), F.col(outcome).cast("double").alias("_o"))
    b = b.filter(F.col("_o").isNotNull() & ~F.isnan("_o")).withColumn("bin", geometry.probability_bucket("_p", n)).filter(F.col("bin").isNotNull())
    g = b.groupBy("bin").agg(F.avg("_p").alias("predicted"), F.avg("_o").alias("observed"), F.count(F.lit(1)).alias("count"))
    return g.withColumn("label", F.concat(F.round(F.col("bin") * 100.0 / n).cast("long").cast("string"), F.lit("-"),
                                          F.round((F.col("bin") + 1) * 100.0 / n).cast("long").cast("string"), F.lit("%")))


def density2d(df: DataFrame, x: str, y: str, nx: int, ny: int, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """2-D histogram over fixed edges with each cell's share of all points."""
    cells = df.select(geometry.grid_cell(x, lo, hi, nx).alias("xbin"), geometry.grid_cell(y, lo, hi, ny).alias("ybin"))
    cells = cells.filter(F.col("xbin").isNotNull() & F.col("ybin").isNotNull())
    g = cells.groupBy("xbin", "ybin").agg(F.count(F.lit(1)).alias("count"))
    total = cells.agg(F.count(F.lit(1)).alias("_t"))
    return g.crossJoin(F.broadcast(total)).withColumn("share", F.col("count") / F.col("_t")).drop("_t")


def hexbin(df: DataFrame, x: str, y: str, gridsize: int = 18, mincnt: int = 1) -> DataFrame:
    """Hexagonal bin counts over the extent of the data (cells with at least ``mincnt`` points)."""
    points = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    extent = points.agg(*[f(c).alias(f"_{n}{c}") for c in ("_x", "_y") for n, f in (("lo", F.min), ("hi", F.max))])
    at = points.crossJoin(F.broadcast(extent))  # one row
    cells = geometry.hex_cell("_x", "_y", (F.col("_lo_x"), F.col("_hi_x")), (F.col("_lo_y"), F.col("_hi_y")), gridsize)
    h = at.select(*[c.alias(n) for n, c in cells.items()])
    return h.groupBy("hex_lattice", "hex_cx", "hex_cy").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= mincnt)


def histogram(df: DataFrame, value: str, lo: float, hi: float, n: int, by: str | None = None, density: bool = False) -> DataFrame:
    """Fixed-edge histogram, optionally per class; density = count / (class rows x width)."""
    cols = [geometry.grid_cell(value, lo, hi, n).alias("bin")] + ([F.col(by)] if by else [])
    cells = df.select(*cols).filter(F.col("bin").isNotNull())
    keys = ["bin"] + ([by] if by else [])
    g = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    g = g.withColumns({"bin_left": lo + F.col("bin") * ((hi - lo) / n), "bin_right": lo + (F.col("bin") + 1) * ((hi - lo) / n)})
    if density:
        tot = cells.groupBy(*([by] if by else [])).agg(F.count(F.lit(1)).alias("_t"))
        g = (g.join(tot, by) if by else g.crossJoin(tot)).withColumn("density", F.col("count") / (F.col("_t") * ((hi - lo) / n))).drop("_t")
    return g


def mean_median(df: DataFrame, value: str, by: str | None = None) -> DataFrame:
    """Mean, the interpolated median, and the upper-middle median the dashboard shows (element
    ``floor(n/2)`` of the ascending order), exact by counts of values."""
    out = ranked_quantiles(df, value, {"median": 0.5}, by, [F.avg("_v").alias("mean"), F.count("_v").alias("n")], {"upper_median": F.floor(F.col("_n") / 2)})
    return out.select(*([by] if by else []), "mean", "median", "upper_median", "n")


def residual_summary(df: DataFrame, actual: str, predicted: str, bins: int = 24) -> tuple[DataFrame, DataFrame]:
    """Mean residual and RMSE (one row) plus a residual histogram with ``bins`` equal bins over
    [min, max] of the residuals."""
    r = df.select((F.col(actual).cast("double") - F.col(predicted).cast("double")).alias("residual"))
    summary = r.agg(F.avg("residual").alias("mean_residual"), F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"))
    rng = r.agg(F.min("residual").alias("_lo"), F.max("residual").alias("_hi"))
    h = (r.crossJoin(F.broadcast(rng))
          .withColumn("bin", F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("residual") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)).cast("int"), F.lit(bins - 1))).otherwise(F.lit(0)))
          .groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
          .withColumn("bin_left", F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).drop("_lo", "_hi"))
    return summary, h


def eda_summary(fixtures: DataFrame, shots: DataFrame | None = None) -> DataFrame:
    """One-row summary: fixture count, result rates, market accuracy; shot, goal counts and
    conversion when shots are given. One global aggregate per table."""
    from touchline.functions.odds import shortest_price_pick
    fx = fixtures.agg(
        F.count(F.lit(1)).alias("fixtures"),
        F.avg((F.col("ftr") == "H").cast("double")).alias("home_win_rate"),
        F.avg((F.col("ftr") == "D").cast("double")).alias("draw_rate"),
        F.avg((F.col("ftr") == "A").cast("double")).alias("away_win_rate"),
        F.avg((shortest_price_pick("b365h", "b365d", "b365a") == F.col("ftr")).cast("double")).alias("market_accuracy"),
        F.avg("total_goals").alias("avg_goals"))
    if shots is None:
        return fx
    sh = shots.agg(F.count(F.lit(1)).alias("shots"), F.sum(F.col("is_goal").cast("long")).alias("goals"),
                   F.avg(F.col("is_goal").cast("double")).alias("shot_conversion_rate"))
    return fx.crossJoin(sh)


def nan_safe(df: DataFrame) -> DataFrame:
    """Report tables to JSON: NaN/inf -> null in every double column."""
    fix = {f.name: F.when(F.isnan(f.name) | (F.abs(f.name) == float("inf")), F.lit(None).cast("double")).otherwise(F.col(f.name))
           for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(fix) if fix else df
