"""Reshape operators.

Fixture tables are two-sided (home and away columns in one row); team histories are long (one row
per team and fixture). Both directions are single-pass: long rows come from ``explode`` of a
two-element array (one scan, no union), and wide rows come back through one conditional aggregation
keyed by the fixture id (partial aggregation map-side, no self-join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def two_sided_to_long(df: DataFrame, id_col: str, keep: Sequence[str], sides: dict[str, dict[str, str]],
                      result_col: str | None = "ftr", side_col: str = "is_home",
                      points_col: str | None = "points") -> DataFrame:
    """One row per side.

    ``sides`` maps each output column to its (home source, away source), e.g.
    ``{"team": {"home": "home_team", "away": "away_team"}, "goals_for": {"home": "fthg", "away": "ftag"}}``.
    Points are 3/1/0 from ``result_col`` (H for home, A for away, D = 1).
    """
    out_cols = list(sides)

    def side_struct(which: str, flag: int) -> Column:
        return F.struct(*[F.col(sides[c][which]).alias(c) for c in out_cols], F.lit(flag).alias(side_col))

    exploded = df.select(F.col(id_col), *[F.col(c) for c in keep],
                         F.explode(F.array(side_struct("home", 1), side_struct("away", 0))).alias("_tl_side"))
    res = exploded.select(id_col, *keep, *[F.col(f"_tl_side.{c}").alias(c) for c in out_cols + [side_col]])
    if points_col and result_col:
        r = F.col(result_col)
        won = ((F.col(side_col) == 1) & (r == "H")) | ((F.col(side_col) == 0) & (r == "A"))
        res = res.withColumn(points_col, F.when(won, F.lit(3)).when(r == "D", F.lit(1)).otherwise(F.lit(0)))
    return res


def long_to_wide(long_df: DataFrame, id_col: str, side_col: str, columns: Sequence[str],
                 prefixes: tuple[str, str] = ("home_", "away_")) -> DataFrame:
    """Fold (id, side) rows back to one row per id with ``home_``/``away_`` prefixes.

    One ``groupBy(id)`` with ``max(when(side = 1, c))``: exact because (id, side) is unique.
    """
    aggs = []
    for c in columns:
        aggs.append(F.max(F.when(F.col(side_col) == 1, F.col(c))).alias(prefixes[0] + c))
        aggs.append(F.max(F.when(F.col(side_col) == 0, F.col(c))).alias(prefixes[1] + c))
    return long_df.groupBy(id_col).agg(*aggs)


def side_differences(df: DataFrame, bases: Sequence[str], suffix: str, prefixes: tuple[str, str] = ("home_", "away_"),
                     out: str = "{base}_diff{suffix}") -> DataFrame:
    """Home minus away for each base name."""
    return df.withColumns({out.format(base=b, suffix=suffix): F.col(f"{prefixes[0]}{b}{suffix}") - F.col(f"{prefixes[1]}{b}{suffix}")
                           for b in bases})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing from a frame become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def explode_list(df: DataFrame, column: str, out: str | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per element (``explode_outer`` keeps rows with an empty or null list)."""
    fn = F.explode_outer if keep_empty else F.explode
    return df.withColumn(out or column, fn(F.col(column)))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every unordered pair (upper triangle), pairwise complete.

    One aggregation pass computes all ``corr(a, b)``; the pairs are generated from the column list
    (metadata), and the single result row is unpivoted with ``stack``.
    """
    cols = list(columns)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        raise ValueError("need at least two columns")
    # corr skips rows where either side is null (pairwise complete)
    agg = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_tl_p{i}") for i, (a, b) in enumerate(pairs)])
    stack_args = ", ".join(f"'{a}', '{b}', _tl_p{i}" for i, (a, b) in enumerate(pairs))
    return agg.selectExpr(f"stack({len(pairs)}, {stack_args}) as (feature_a, feature_b, corr)")


def correlation_with_target(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Correlation of each feature with the target; order by magnitude with ``abs_corr``."""
    agg = df.agg(*[F.corr(F.col(f).cast("double"), F.col(target).cast("double")).alias(f"_tl_c{i}") for i, f in enumerate(features)])
    stack_args = ", ".join(f"'{f}', _tl_c{i}" for i, f in enumerate(features))
    res = agg.selectExpr(f"stack({len(features)}, {stack_args}) as (feature, corr)")
    return res.withColumn("abs_corr", F.abs("corr")).orderBy(F.col("abs_corr").desc_nulls_last(), "feature")  # one row per feature


def redundant_pairs(df: DataFrame, columns: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """Pairs with |corr| >= threshold."""
    return correlation_pairs(df, columns).filter(F.abs("corr") >= threshold)


def assign_new_ids(existing: DataFrame, new_rows: DataFrame, id_col: str, order: Sequence[str],
                   out: str | None = None) -> DataFrame:
    """Ids after the current maximum, in the given order of the new rows (W14 index, no single-task window)."""
    from touchline.operators.windows import row_index
    top = existing.agg(F.coalesce(F.max(id_col), F.lit(-1)).cast("long").alias("_tl_max"))
    indexed = row_index(new_rows, order, "_tl_pos")
    return (indexed.crossJoin(F.broadcast(top))  # one-row aggregate: bounded
                   .withColumn(out or id_col, F.col("_tl_max") + 1 + F.col("_tl_pos"))
                   .drop("_tl_max", "_tl_pos"))
