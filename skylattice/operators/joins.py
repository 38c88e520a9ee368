"""Joins and alignment of tables and grids.

Sizes of join sides are left to Spark, which broadcasts only what it has
measured to be small, except where a side has a fixed small size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import attach, index_rows, join_null_safe, salted_join


def join_inner(left: DataFrame, right: DataFrame, on: Sequence[str], hot: bool = True) -> DataFrame:
    """Inner join; ``left`` is the larger side and may have hot keys."""
    cols = list(on)
    left, right = left.dropna(subset=cols), right.dropna(subset=cols)
    return salted_join(left, right, cols) if hot else left.join(right, cols)


def join_natural(*tables: DataFrame) -> DataFrame:
    """Merge on all shared column names, table after table."""

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in a.columns if c in set(b.columns)]
        if not shared:
            raise ValueError("tables share no column")
        return a.join(b, shared, "inner")

    return reduce(merge, tables)


def join_outer_common(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer merge on all shared column names.

    Made of a left join, which can be salted, and the right rows without a
    partner: a full join cannot split a hot key.
    """
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("tables share no column")
    matched = salted_join(left, right, shared, "left")
    alone = join_null_safe(right, left.select(*shared).distinct(), shared, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def join_outer_many(long: DataFrame, key: str, site: str, value: str, sites: Sequence) -> DataFrame:
    """Full outer join of one table per site, from the union of them.

    One aggregation with a column per site instead of a join per site. Where a
    site has several rows for a key, their sum is taken.
    """
    cols = [F.sum(F.when(F.col(site) == F.lit(s), F.col(value))).alias(f"{value}_{s}") for s in sites]
    return long.groupBy(key).agg(*cols)


def align_add(left: DataFrame, right: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Two series side by side on the union of their keys, and their sum.

    A key missing on one side gives a null sum; several rows of a key are
    summed. One aggregation of both, as a full join cannot split a hot key.
    """
    a = left.select(*key, F.col(value).alias("a"))
    b = right.select(*key, F.col(value).alias("b"))
    sides = a.unionByName(b, allowMissingColumns=True).groupBy(*key).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return sides.withColumn("total", F.col("a") + F.col("b"))


def group_by_mapping(df: DataFrame, mapping: DataFrame, on: Sequence[str], by: Sequence[str], aggs: Sequence[Column]):
    """Aggregate by keys held in another table of one row per ``on``."""
    return attach(df, mapping, on, "inner").groupBy(*by).agg(*aggs)


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def with_dimension(df: DataFrame, coordinate: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Bring a lower-dimensional coordinate on to every cell of a grid."""
    return attach(df, coordinate, dims, "inner")


def grid_difference(a: DataFrame, b: DataFrame, dims: Sequence[str], value: str = "value") -> DataFrame:
    """``a - b`` where both grids have the cell."""
    left = a.select(*dims, F.col(value).alias("__a"))
    right = b.select(*dims, F.col(value).alias("__b"))
    return left.join(right, list(dims)).select(*dims, (F.col("__a") - F.col("__b")).alias("difference"))


def mesh(bounds: DataFrame, step_x: float, step_y: float) -> DataFrame:
    """All points of two regular axes.

    ``bounds`` has the columns x_min, x_max, y_min, y_max (one row per mesh);
    axes run from the minimum up to, not including, the maximum, like the
    usual half-open range. Rows are made by two counters, without a join.
    """

    def steps(lo: str, hi: str, step: float) -> Column:
        return F.ceil((F.col(hi) - F.col(lo)) / F.lit(step))

    others = [c for c in bounds.columns if c not in ("x_min", "x_max", "y_min", "y_max")]
    xs = index_rows(bounds, steps("x_min", "x_max", step_x), "__i")
    return index_rows(xs, steps("y_min", "y_max", step_y), "__j").select(
        *others,
        (F.col("x_min") + F.col("__i") * F.lit(step_x)).alias("x"),
        (F.col("y_min") + F.col("__j") * F.lit(step_y)).alias("y"),
    )


def nearest_cells(df: DataFrame, cells: DataFrame, on: Sequence[str]) -> DataFrame:
    """Grid cells picked by a table of row and column indices."""
    return df.join(cells, list(on), "inner")
