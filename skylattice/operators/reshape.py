"""Sorting, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import OrderedRows


def sort_values(df: DataFrame, *order: str | Column) -> DataFrame:
    return df.orderBy(*order)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; each task keeps only its own best ``k``."""
    return df.orderBy(*order).limit(k)


def stack_rows(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; a column a table lacks is null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def with_row_index(df: DataFrame, order: Sequence[str], out: str = "row_index") -> DataFrame:
    """Fresh 0-based index in ``order``, without gathering the table."""
    return OrderedRows(df, [], order).row_number("__pos").finish().withColumn(out, F.col("__pos") - 1).drop("__pos")


def merge_dimension(parts: dict, dim: str) -> DataFrame:
    """Sub-grids become one grid with a new dimension; one key per part."""
    tables = [t.withColumn(dim, F.lit(k)) for k, t in parts.items()]
    return stack_rows(*tables)


def concat_dimension(parts: Sequence[DataFrame], dims: Sequence[str]) -> DataFrame:
    """Join grids along an existing dimension. A coordinate held twice is an
    error, raised while the job runs."""
    value_cols = [c for c in parts[0].columns if c not in dims]
    whole = stack_rows(*parts)
    firsts = [F.first(c).alias(c) for c in value_cols]
    checked = whole.groupBy(*dims).agg(F.count(F.lit(1)).alias("__n"), *firsts)
    message = F.concat(F.lit("duplicate coordinate at "), F.to_json(F.struct(*dims)))
    ok = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.where(ok).select(*dims, *value_cols)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def pivot_mean(df: DataFrame, rows: Sequence[str], column: str, labels: Sequence, value: str) -> DataFrame:
    """Mean by row and column label; labels are given, so no extra pass.

    A row key without any of the labels stays, with nulls.
    """
    cols = [F.avg(F.when(F.col(column) == F.lit(v), F.col(value))).alias(f"mean_{v}") for v in labels]
    return df.groupBy(*rows).agg(*cols)


def pivot_count(df: DataFrame, rows: Sequence[str], column: str, labels: Sequence) -> DataFrame:
    """Row counts by row and column label; null where there is no row.

    A row key without any of the labels stays, with nulls.
    """
    cols = [F.sum(F.when(F.col(column) == F.lit(v), F.lit(1))).alias(f"n_{v}") for v in labels]
    return df.groupBy(*rows).agg(*cols)


def columns_to_rows(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Stack columns into rows; null values leave no row."""
    return df.unpivot(list(ids), list(columns), name, value).where(F.col(value).isNotNull())


def rows_to_columns(df: DataFrame, ids: Sequence[str], name: str, labels: Sequence[str], value: str) -> DataFrame:
    """Inverse of :func:`columns_to_rows`."""
    cols = [F.max(F.when(F.col(name) == F.lit(v), F.col(value))).alias(v) for v in labels]
    return df.groupBy(*ids).agg(*cols)


def flatten_dimensions(
    df: DataFrame, sample_dims: Sequence[str], level: str, variable: str, features: Sequence[str], value: str
) -> DataFrame:
    """(variable, dims..., level) cells to rows of (sample, level, features)."""
    sample = F.concat_ws("/", *[F.col(d).cast("string") for d in sample_dims]).alias("sample")
    cols = [F.max(F.when(F.col(variable) == F.lit(f), F.col(value))).alias(f) for f in features]
    return df.groupBy(*sample_dims, level).agg(*cols).select(sample, level, *features)


def training_rows(
    profiles: DataFrame, sample: Sequence[str], level: str, levels: Sequence[int], inputs: Sequence[str], targets: Sequence[str], surface: DataFrame, fields: Sequence[str]
) -> DataFrame:
    """One row per sample: ``inputs`` (all levels of the first profile, then of
    the next, then the surface fields) and ``targets`` (all levels of each).

    ``profiles`` has a row per sample and level, ``surface`` one per sample.
    A sample without one of ``levels``, with a null in a profile or a surface
    field, or without a surface row has no training row; other levels are not
    looked at. Of repeated levels the greatest value counts.
    """
    at = [F.max(F.when(F.col(level) == F.lit(n), F.col(c).cast("double"))).alias(f"__{c}_{n}") for c in [*inputs, *targets] for n in levels]
    wide = profiles.where(F.col(level).isin(list(levels))).groupBy(*sample).agg(*at)
    row = wide.join(surface.select(*sample, *[F.col(f).cast("double").alias(f"__f_{f}") for f in fields]), list(sample))
    inside = [*(f"__{c}_{n}" for c in inputs for n in levels), *(f"__f_{f}" for f in fields)]
    outside = [f"__{c}_{n}" for c in targets for n in levels]
    whole = row.dropna(subset=[*inside, *outside])
    return whole.select(*sample, F.array(*inside).alias("inputs"), F.array(*outside).alias("targets"))


def one_hot_levels(label: Column, n: int) -> Column:
    """Class label to an array of ``n`` zeros with one 1."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (i == label).cast("int"))


def shuffled(df: DataFrame, ids: Sequence[str], seed: int, out: str = "place") -> DataFrame:
    """A repeatable random order: rows numbered by a hash of their id."""
    hashed = df.withColumn("__h", F.xxhash64(*ids, F.lit(seed)))
    numbered = OrderedRows(hashed, [], ["__h", *ids]).row_number(out).finish()
    return numbered.withColumn(out, F.col(out) - 1).drop("__h")
