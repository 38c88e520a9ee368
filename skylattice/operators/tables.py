"""Projection, filters and row selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import OrderedRows


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def choose(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """Keep the columns in ``keep`` (all, if None) and then drop ``drop``."""
    out = df if keep is None else df.select(*keep)
    return out.drop(*drop)


def insert_column(df: DataFrame, position: int, name: str, value: Column) -> DataFrame:
    """Add a column so that it stands at ``position``."""
    cols = [F.col(c) for c in df.columns]
    cols.insert(position, value.alias(name))
    return df.select(*cols)


def keep_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows meeting all conditions; native predicates reach the file scan."""
    for c in conditions:
        df = df.where(c)
    return df


def row_with_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def row_at_position(df: DataFrame, order: Sequence[str], position: int) -> DataFrame:
    """The row at a 0-based position of the whole table in ``order``."""
    numbered = OrderedRows(df, [], order).row_number("__pos").finish()
    return numbered.where(F.col("__pos") == position + 1).drop("__pos")


def between_open(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Strictly after ``start`` and strictly before ``end``."""
    return df.where((F.col(ts) > F.lit(start)) & (F.col(ts) < F.lit(end)))


def at_time_of_day(df: DataFrame, ts: str, clock: str) -> DataFrame:
    """Rows whose clock time, to the minute, is ``HH:mm``."""
    hh, mm = clock.split(":")
    return df.where((F.hour(ts) == int(hh)) & (F.minute(ts) == int(mm)))


def on_partial_date(df: DataFrame, ts: str, date: str) -> DataFrame:
    """Rows in a year (``2024``), month (``2024-01``) or day (``2024-01-15``).

    A half-open range on the column itself, so it is pushed to the scan.
    """
    parts = [int(p) for p in date.split("-")]
    year, month, day = (parts + [None, None])[:3]
    start = f"{year:04d}-{month or 1:02d}-{day or 1:02d}"
    step = {1: "12 month", 2: "1 month", 3: "1 day"}[len(parts)]
    dtype = df.schema[ts].dataType
    first = F.lit(start).cast(dtype)
    return df.where((F.col(ts) >= first) & (F.col(ts) < first + F.expr(f"interval {step}")))


def in_list(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def where_coordinate(df: DataFrame, coordinate: str, test: Callable[[Column], Column]) -> DataFrame:
    """Constraint given as a function of the coordinate column."""
    return df.where(test(F.col(coordinate)))


def slice_steps(df: DataFrame, slices: dict[str, tuple[int | None, int | None, int]]) -> DataFrame:
    """``start:stop:step`` on integer dimension indices counted from 0."""
    for dim, (start, stop, step) in slices.items():
        i, lo = F.col(dim), start or 0
        cond = i >= lo
        if stop is not None:
            cond = cond & (i < stop)
        if step != 1:
            cond = cond & (F.pmod(i - lo, F.lit(step)) == 0)
        df = df.where(cond)
    return df


def region_box(df: DataFrame, lat: str, lon: str, south: float, north: float, west: float, east: float) -> DataFrame:
    """Box with both ends included; longitudes are taken to [-180, 180)."""
    wrapped = F.pmod(F.col(lon) + 180.0, F.lit(360.0)) - 180.0
    across_dateline = west > east
    in_lon = (wrapped >= west) | (wrapped <= east) if across_dateline else wrapped.between(west, east)
    return df.where(F.col(lat).between(south, north) & in_lon)


def assign_where(df: DataFrame, column: str, condition: Column, value) -> DataFrame:
    """Set ``column`` where the condition holds, leave it elsewhere."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, new).otherwise(F.col(column)))


def fill_null(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.fillna(values)


def drop_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every one of the columns (all, if None)."""
    return df.dropna(subset=list(columns) if columns else None)


def cast_bool(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("boolean"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Drop duplicate keys, keeping the first row in ``order``.

    An aggregate rather than a window: each task first reduces its own rows,
    so a key that holds most of the table is never gathered in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*keys).agg(first).select(*keys, "__row.*").select(*df.columns)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def count_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    fn = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[fn(c).alias(f"n_{c}") for c in columns])
