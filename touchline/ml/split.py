"""Time-ordered splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.windows import row_index


def boundary_rows(df: DataFrame, order: Sequence[str], positions: Column) -> DataFrame:
    """One row with ``n`` (rows of ``df``) and ``cuts``: the order keys of the rows at the given 0-based
    positions (an array expression over ``_n``), ascending. Only the order columns are sorted; rows then
    compare their own keys with the cuts, so no index is joined back."""
    idx = row_index(df.select(*order), order, "_idx")
    at = df.agg(F.count(F.lit(1)).alias("_n")).withColumn("_at", positions)
    cuts = (idx.join(F.broadcast(at), F.array_contains("_at", F.col("_idx")))
               .agg(F.max("_n").alias("n"), F.array_sort(F.collect_list(F.struct(*order))).alias("cuts")))
    return cuts.checkpoint(eager=True)


def holdout_flag(df: DataFrame, order: Sequence[str], holdout: float = 0.2) -> DataFrame:
    """M1: ``df`` with ``is_train`` for the first ``max(int(n * (1 - holdout)), 1)`` rows in time order
    (``order`` must be unique)."""
    cut = boundary_rows(df, order, F.array(F.greatest(F.floor(F.col("_n") * (1 - holdout)).cast("long"), F.lit(1).cast("long"))))
    one = cut.select(F.try_element_at("cuts", F.lit(1)).alias("_cut"))
    return (df.crossJoin(F.broadcast(one))
              .withColumn("is_train", F.coalesce(F.struct(*order) < F.col("_cut"), F.lit(True))).drop("_cut"))


def fold_of(df: DataFrame, order: Sequence[str], n_splits: int = 5) -> DataFrame:
    """M2: ``df`` with ``fold``: the test block (0 to ``n_splits - 1``) a row lies in, -1 before the first.
    Fold i trains on all rows of lower folds. Blocks hold ``n // (n_splits + 1)`` rows each."""
    block = F.floor(F.col("_n") / (n_splits + 1)).cast("long")
    cuts = boundary_rows(df, order, F.array(*[F.col("_n") - (n_splits - i) * block for i in range(n_splits)]))
    before = F.size(F.filter("cuts", lambda c: c <= F.struct(*order)))
    return df.crossJoin(F.broadcast(cuts.select("cuts"))).withColumn("fold", (before - 1).cast("int")).drop("cuts")


def holdout_split(df: DataFrame, order: Sequence[str], holdout: float = 0.2, idx_col: str | None = "row_idx") -> DataFrame:
    """M1 with the row index kept (for folds over it): the first ``max(int(n * (1 - holdout)), 1)`` rows in
    time order train, the rest test (``is_train``). The rows themselves are indexed, nothing is joined back.

    Without ``idx_col`` only the order columns are sorted and every row compares its own keys with the cut. If rows
    that share the cut's keys lie on both sides of it, all rows are indexed as above, so repeated keys split alike."""
    if idx_col is None:
        wanted = F.greatest(F.floor(F.col("_n") * (1 - holdout)).cast("long"), F.lit(1).cast("long"))
        cut = boundary_rows(df, order, F.array(wanted - 1, wanted))
        last_train, first_test = [F.try_element_at("cuts", F.lit(i)) for i in (1, 2)]
        tied = cut.select(F.coalesce(last_train == first_test, F.lit(False))).first()
        if tied is None or not tied[0]:
            one = cut.select(first_test.alias("_cut"))
            return (df.crossJoin(F.broadcast(one))
                      .withColumn("is_train", F.coalesce(F.struct(*order) < F.col("_cut"), F.lit(True))).drop("_cut"))
    name = idx_col or "_row_idx"
    idx = row_index(df, order, name)
    n = idx.agg(F.count(F.lit(1)).alias("_n"))
    cut = F.greatest(F.floor(F.col("_n") * (1 - holdout)).cast("long"), F.lit(1))
    split = idx.crossJoin(F.broadcast(n)).withColumn("is_train", F.col(name) < cut).drop("_n")
    return split if idx_col else split.drop(name)


def fold_bounds(df: DataFrame, idx_col: str, n_splits: int = 5) -> DataFrame:
    """M2 bounds: fold i tests ``[n - (k - i) * m, n - (k - i - 1) * m)`` with ``m = n // (k + 1)``
    and trains on everything before its test block (expanding window). ``k`` rows: bounded."""
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    spark = df.sparkSession
    folds = spark.range(n_splits).select(F.col("id").cast("int").alias("fold"))
    m = F.floor(F.col("_n") / (n_splits + 1)).cast("long")
    return folds.crossJoin(n).select(
        "fold", (F.col("_n") - (n_splits - F.col("fold")) * m).alias("test_start"),
        (F.col("_n") - (n_splits - F.col("fold") - 1) * m).alias("test_end"))


def expanding_folds(indexed: DataFrame, idx_col: str, n_splits: int = 5) -> DataFrame:
    """M2 long form: every (row, fold) pair with ``role`` train or test. ``CrossValidator`` is not used
    because it would also train on later folds."""
    n = indexed.agg(F.count(F.lit(1)).alias("_n"))
    i, m = F.col(idx_col), F.floor(F.col("_n") / (n_splits + 1)).cast("long")
    roles = []
    for fold in range(n_splits):
        start = F.col("_n") - (n_splits - fold) * m
        roles.append(F.when(i < start + m, F.struct(F.lit(fold).alias("fold"), F.when(i < start, F.lit("train")).otherwise(F.lit("test")).alias("role"))))
    # only the (fold, role) pairs that a row takes part in are made
    pairs = F.explode(F.array_compact(F.array(*roles)))
    return indexed.crossJoin(F.broadcast(n)).withColumn("_r", pairs).select(*indexed.columns, "_r.fold", "_r.role")
