"""Aggregations and conversion tables.

Every aggregation is a ``groupBy`` with algebraic aggregates (count, sum, avg, min, max), so Spark
combines map-side before the shuffle: a group holding a third of the rows costs one partial row per
input partition, not a third of the data in one task. Top-n results use ``orderBy().limit()``
(TakeOrderedAndProject), the feature being a top-k report.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import geometry
from touchline.functions.text import token_set


def _outcome(c: str) -> Column:
    return F.coalesce(F.col(c).try_cast("int"), F.lit(0))


def conversion_by_flag(df: DataFrame, flag: str, outcome: str, labels: dict[int, str] | None = None) -> DataFrame:
    """Rows, successes and rate per 0/1 flag (non-numeric flag -> 0), with a label."""
    g = (df.select(F.coalesce(F.col(flag).try_cast("int"), F.lit(0)).alias("value"), _outcome(outcome).alias("_o"))
           .groupBy("value").agg(F.count(F.lit(1)).alias("shots"), F.sum("_o").alias("goals"), F.avg("_o").alias("conversion_rate")))
    lab = F.col("value").cast("string")
    if labels:
        pairs = []
        for k, v in labels.items():
            pairs += [F.lit(k), F.lit(v)]
        lab = F.coalesce(F.create_map(*pairs)[F.col("value")], lab)
    return g.withColumn("label", lab)


def conversion_by_category(df: DataFrame, column: str, outcome: str, top_n: int | None = None) -> DataFrame:
    """Per category (null -> "Unknown"), ordered by rows desc then rate desc (label asc breaks
    remaining ties), optional top-n."""
    g = (df.select(F.coalesce(F.col(column).cast("string"), F.lit("Unknown")).alias("label"), _outcome(outcome).alias("_o"))
           .groupBy("label").agg(F.count(F.lit(1)).alias("shots"), F.sum("_o").alias("goals"), F.avg("_o").alias("conversion_rate")))
    g = g.orderBy(F.col("shots").desc(), F.col("conversion_rate").desc(), F.col("label").asc())
    return g.limit(top_n) if top_n else g


def conversion_table(df: DataFrame, column: str, outcome: str, min_count: int = 1) -> DataFrame:
    """Per value (nulls form their own group) with minimum support (HAVING)."""
    return (df.groupBy(F.col(column).alias(column))
              .agg(F.count(F.lit(1)).alias("shots"), F.sum(_outcome(outcome)).alias("goals"),
                   F.avg(_outcome(outcome)).alias("conversion_rate"))
              .filter(F.col("shots") >= min_count))


def conversion_by_bins(df: DataFrame, column: str, outcome: str, bins: int = 8) -> DataFrame:
    """A9 + X6: equal-width ``pd.cut`` bins over [min, max]; mean value, rows, successes and rate per
    bin; empty bins dropped; label ``left-right`` with one decimal.

    Two passes: a one-row min/max aggregate (cross-joined, bounded), then ``groupBy(bin)``.
    """
    vals = df.select(F.col(column).try_cast("double").alias("_v"), _outcome(outcome).alias("_o")).filter(F.col("_v").isNotNull())
    rng = vals.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    binned = vals.crossJoin(F.broadcast(rng)).withColumn("bin", geometry.cut_bin("_v", "_lo", "_hi", bins))
    g = binned.groupBy("bin").agg(F.avg("_v").alias("mean_value"), F.count(F.lit(1)).alias("shots"),
                                  F.sum("_o").alias("goals"), F.avg("_o").alias("conversion_rate"),
                                  F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    left, right = geometry.cut_edges("_lo", "_hi", bins, "bin")
    g = g.withColumns({"bin_left": left, "bin_right": right})
    g = g.withColumn("label", F.format_string("%.1f-%.1f", F.col("bin_left"), F.col("bin_right")))
    return g.drop("_lo", "_hi")


def profile_linspace(df: DataFrame, column: str, outcome: str, k: int) -> DataFrame:
    """A10: profile over ``linspace(0, max, k)`` edges (first edge inclusive)."""
    vals = df.select(F.col(column).cast("double").alias("_v"), _outcome(outcome).alias("_o"))
    top = vals.agg(F.max("_v").alias("_hi"))
    b = vals.crossJoin(F.broadcast(top)).withColumn("bin", geometry.linspace_bin("_v", "_hi", k)).filter(F.col("bin").isNotNull())
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("shots"), F.sum("_o").alias("goals"), F.avg("_o").alias("conversion_rate"))


def counts_in_order(df: DataFrame, column: str, order: Sequence, labels: dict | None = None) -> DataFrame:
    """Counts reindexed to a fixed label list (missing -> 0), with the share of all rows.
    The label table is a literal of ``len(order)`` rows (bounded)."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, str(v)) for i, v in enumerate(order)], "pos int, key string")
    counts = df.groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    res = (F.broadcast(grid).join(counts, "key", "left").crossJoin(F.broadcast(total))
           .select("pos", "key", F.coalesce(F.col("_n"), F.lit(0)).alias("value"),
                   F.when(F.col("_total") > 0, F.coalesce(F.col("_n"), F.lit(0)) / F.col("_total")).alias("share")))
    if labels:
        pairs = []
        for k, v in labels.items():
            pairs += [F.lit(str(k)), F.lit(v)]
        res = res.withColumn("label", F.coalesce(F.create_map(*pairs)[F.col("key")], F.col("key")))
    else:
        res = res.withColumn("label", F.col("key"))
    return res


def crosstab_grid(df: DataFrame, row_col: str, col_col: str, labels: Sequence[str] = ("H", "D", "A"),
                  row_name: str = "predicted", col_name: str = "actual", count_name: str = "matches") -> DataFrame:
    """Counts on a fixed ``labels x labels`` grid, zero-filled, long form."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels], f"{row_name} string, {col_name} string")
    counts = df.groupBy(F.col(row_col).alias(row_name), F.col(col_col).alias(col_name)).agg(F.count(F.lit(1)).alias("_n"))
    return (F.broadcast(grid).join(counts, [row_name, col_name], "left")
            .select(row_name, col_name, F.coalesce(F.col("_n"), F.lit(0)).alias(count_name)))


def token_stats(df: DataFrame, id_col: str, text_col: str, outcome: str, min_support: int = 20,
                top: int | None = 15, by: str = "rate", unique_ids: bool = False) -> DataFrame:
    """A13 + F9: per token, distinct rows containing it, successes and rate.

    Tokens are distinct per row (``array_distinct``). When ids may repeat, ``(id, token)`` pairs are
    deduplicated by a ``groupBy`` on both (hash-partitioned on the pair, so a frequent token is spread over
    all tasks); with ``unique_ids`` that shuffle is left out. Then they are counted with partial aggregation: ``countDistinct(id)`` per token without a single-task
    group. ``by="rate"``: support >= ``min_support``, order by rate desc, rows desc; ``by="rows"``: the
    frequency table ordered by rows desc. Token ascending breaks remaining ties.
    """
    pairs = (df.select(F.col(id_col).alias("_id"), F.explode(token_set(text_col)).alias("qualifier"), _outcome(outcome).alias("_o")))
    if not unique_ids:
        pairs = pairs.groupBy("qualifier", "_id").agg(F.max("_o").alias("_o"))
    g = pairs.groupBy("qualifier").agg(F.count(F.lit(1)).alias("shots"), F.sum("_o").alias("goals"), F.avg("_o").alias("conversion_rate"))
    if by == "rate":
        g = g.filter(F.col("shots") >= min_support).orderBy(F.col("conversion_rate").desc(), F.col("shots").desc(), F.col("qualifier"))
    else:
        g = g.select("qualifier", "shots").orderBy(F.col("shots").desc(), F.col("qualifier"))
    return g.limit(top) if top else g


def exploded_frequency(df: DataFrame, list_col: str, out: str = "item") -> DataFrame:
    """Frequency of list elements without per-row dedupe; null elements dropped."""
    return (df.select(F.explode_outer(list_col).alias(out)).filter(F.col(out).isNotNull())
              .groupBy(out).agg(F.count(F.lit(1)).alias("count")))


def two_sided_totals(left: DataFrame, right: DataFrame, key: str, left_cols: dict[str, Column],
                     right_cols: dict[str, Column]) -> DataFrame:
    """A21 + J9: per-key aggregates of two tables combined by a full outer join, nulls to 0."""
    lg = left.groupBy(key).agg(*[c.alias(n) for n, c in left_cols.items()])
    rg = right.groupBy(key).agg(*[c.alias(n) for n, c in right_cols.items()])
    return lg.join(rg, key, "full").fillna(0, subset=list(left_cols) + list(right_cols))


def outer_totals(tables: Sequence[tuple[DataFrame, dict[str, Column]]], key: str) -> DataFrame:
    """A21 + J9: per-key aggregates of any number of tables combined by full outer joins, nulls to 0."""
    out, names = None, []
    for df, cols in tables:
        own = df.groupBy(key).agg(*[c.alias(n) for n, c in cols.items()])
        out = own if out is None else out.join(own, key, "full")
        names += list(cols)
    return out.fillna(0, subset=names)


def zone_summary(df: DataFrame, zone_col: str, zones: Sequence[str], outcome: str, prob_col: str) -> DataFrame:
    """Fixed zone list with shots, goals, mean probability, conversion and share; empty zones
    give 0. ``best_zone`` flags the highest conversion (first in list order on ties)."""
    spark = df.sparkSession
    grid = spark.createDataFrame([(i, z) for i, z in enumerate(zones)], "pos int, zone string")
    g = df.groupBy(F.col(zone_col).alias("zone")).agg(F.count(F.lit(1)).alias("_n"), F.sum(_outcome(outcome)).alias("_g"),
                                                      F.avg(prob_col).alias("_p"))
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    res = (F.broadcast(grid).join(g, "zone", "left").crossJoin(F.broadcast(total)).select(
        "pos", "zone", F.coalesce("_n", F.lit(0)).alias("shots"), F.coalesce("_g", F.lit(0)).alias("goals"),
        F.coalesce("_p", F.lit(0.0)).alias("mean_xg"),
        F.when(F.coalesce("_n", F.lit(0)) > 0, F.col("_g") / F.col("_n")).otherwise(F.lit(0.0)).alias("conversion"),
        F.when(F.col("_t") > 0, F.coalesce("_n", F.lit(0)) / F.col("_t")).otherwise(F.lit(0.0)).alias("share")))
    best = Window.orderBy(F.col("conversion").desc(), F.col("pos"))  # at most len(zones) rows: bounded
    return res.withColumn("best_zone", (F.row_number().over(best) == 1).cast("int"))


def filter_summary(df: DataFrame, outcome: str, prob_col: str) -> DataFrame:
    """Shots, goals, mean probability, conversion of a (filtered) frame; one row."""
    return df.agg(F.count(F.lit(1)).alias("shots"), F.coalesce(F.sum(_outcome(outcome)), F.lit(0)).alias("goals"),
                  F.avg(prob_col).alias("mean_xg"), F.avg(_outcome(outcome)).alias("conversion"))


def dominant_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value (ties: smallest value), as a one-row frame."""
    return (df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col("value")).limit(1))


def market_accuracy(df: DataFrame, pick_col: str, result_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows where the pick equals the result (optionally per fold)."""
    acc = F.avg((F.col(pick_col) == F.col(result_col)).cast("double")).alias("accuracy")
    n = F.count(F.lit(1)).alias("rows")
    return df.groupBy(*by).agg(acc, n) if by else df.agg(acc, n)


def facet_values(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Distinct sorted values of a facet, optionally restricted by the other filters."""
    base = df.filter(where) if where is not None else df
    return base.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


def rate_from_parts(df: DataFrame, group: str, outcome: str) -> DataFrame:
    """Count and sum per group, rate = sum / count, ordered by rate."""
    return (df.groupBy(group).agg(F.count(F.lit(1)).alias("shots"), F.sum(_outcome(outcome)).alias("goals"))
              .withColumn("rate", F.col("goals") / F.col("shots")).orderBy(F.col("rate").desc(), F.col(group)))


def cluster_profile(df: DataFrame, cluster_col: str, value_cols: Sequence[str], name_col: str, rank_col: str,
                    top: int = 3) -> DataFrame:
    """Size and means per cluster, label against the overall mean (above/below on the first
    value column), and the top examples by ``rank_col``.

    The examples come from ``row_number <= top`` per cluster (a window partitioned by cluster is
    split by ``windows.apply_window`` when a cluster is hot), so ``collect_list`` holds at most
    ``top`` names per cluster.
    """
    from touchline.operators import windows as W
    means = df.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"mean_{c}") for c in value_cols])
    overall = df.agg(*[F.avg(c).alias(f"_all_{c}") for c in value_cols])
    first = value_cols[0]
    means = means.crossJoin(F.broadcast(overall)).withColumn(
        "label", F.when(F.col(f"mean_{first}") >= F.col(f"_all_{first}"), F.lit("above")).otherwise(F.lit("below")))
    ranked = W.apply_window(df.withColumn("_neg", -F.col(rank_col)), cluster_col, ["_neg", name_col], W.WindowJob(
        lambda w: {"_r": F.row_number().over(w)}, row_number_cols=["_r"]))
    tops = (ranked.filter(F.col("_r") <= top).groupBy(cluster_col)
                  .agg(F.sort_array(F.collect_list(F.struct("_r", F.col(name_col).alias("n")))).alias("_t")))
    tops = tops.select(cluster_col, F.transform("_t", lambda x: x["n"]).alias("examples"))
    return means.join(tops, cluster_col, "left").drop(*[f"_all_{c}" for c in value_cols])
