"""Time-series operators.

A series is named by key columns and ordered by a time column (plus tie
breakers). None of these gather a whole series in one task; see ``ordered``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import OrderedRows, attach, bounded_frame, index_rows, join_null_safe, quantile_columns


def resample_month(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    """Monthly mean, exact median and sample standard deviation."""
    months = df.withColumn("month", F.to_date(F.date_trunc("month", ts)))
    by = [*keys, "month"]
    base = months.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    return join_null_safe(base, quantile_columns(months, by, value, {"median": 0.5}), by)


def business_day(ts: Column) -> Column:
    """The date, with Saturday and Sunday put back to Friday."""
    date = F.to_date(ts)
    weekday = F.weekday(date)  # Monday is 0
    return F.date_sub(date, F.greatest(weekday - 4, F.lit(0)))


def resample_business_day(df: DataFrame, keys: Sequence[str], ts: str, value: str) -> DataFrame:
    return df.groupBy(*keys, business_day(F.col(ts)).alias("bday")).agg(F.avg(value).alias("mean"))


def shift_return(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, fill_first: bool = False, out: str = "change"
) -> DataFrame:
    """``x / previous x - 1``. With ``fill_first`` gaps are filled forward
    before the change is taken, so a gap reads as no change."""
    known = F.col(value).isNotNull() if fill_first else F.lit(True)
    rows = OrderedRows(df, keys, order).nearest_known({"__before": (F.col(value), known, False)}, strict=True).finish()
    now = F.coalesce(value, "__before") if fill_first else F.col(value)
    change = F.when(F.col("__before") != 0, now / F.col("__before") - 1)
    return rows.withColumn(out, change).drop("__before")


def rolling_std(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int, out: str = "rolling_std"
) -> DataFrame:
    """Sample standard deviation of the last ``rows`` rows, null until full."""

    def make(w):
        frame = w.rowsBetween(-rows + 1, 0)
        return F.when(F.count(value).over(frame) == rows, F.stddev_samp(value).over(frame))

    return bounded_frame(df, keys, order, rows - 1, {out: make})


def rolling_mean_along(
    df: DataFrame, others: Sequence[str], dim: str, value: str, length: int, out: str = "rolling_mean"
) -> DataFrame:
    """Mean of ``length`` neighbouring cells along a dimension, at the last
    of them; windows that do not fit are left out."""

    def mean(w):
        return F.avg(value).over(w.rowsBetween(-length + 1, 0))

    def full(w):
        return F.count(F.lit(1)).over(w.rowsBetween(-length + 1, 0))

    rolled = bounded_frame(df, others, [dim], length - 1, {out: mean, "__full": full})
    return rolled.where(F.col("__full") == length).drop("__full")


def as_frequency(
    df: DataFrame, keys: Sequence[str], ts: str, seconds: int, values: Sequence[str], steps_per_row: int = 10_000
) -> DataFrame:
    """Every series on a regular time axis from its first to its last time.

    A time without a row of its own gets nulls. Axes are made in pieces of
    ``steps_per_row`` steps that are spread before they are written out.
    """
    epoch = F.unix_micros(F.col(ts).cast("timestamp"))
    step = seconds * 1_000_000
    ends = df.groupBy(*keys).agg(F.min(epoch).alias("__lo"), F.max(epoch).alias("__hi"))
    n = F.floor((F.col("__hi") - F.col("__lo")) / step) + 1
    axis = index_rows(ends, n, "__i", steps_per_row).select(
        *keys, F.timestamp_micros(F.col("__lo") + F.col("__i") * step).cast(df.schema[ts].dataType).alias(ts)
    )
    return axis.join(df.select(*keys, ts, *values), [*keys, ts], "left")


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], limit: int
) -> DataFrame:
    """Fill gaps with the last value, for at most ``limit`` rows."""
    made = {
        f"__f_{v}": (lambda w, v=v: F.last(v, ignorenulls=True).over(w.rowsBetween(-limit, 0))) for v in values
    }
    filled = bounded_frame(df, keys, order, limit, made)
    for v in values:
        filled = filled.withColumn(v, F.col(f"__f_{v}"))
    return filled.drop(*made)


def fill_both(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Fill forward, then what is still empty backward, within each series."""
    spec = {}
    for v in values:
        known = F.col(v).isNotNull()
        spec[f"__b_{v}"] = (F.col(v), known, False)
        spec[f"__a_{v}"] = (F.col(v), known, True)
    rows = OrderedRows(df, keys, order).nearest_known(spec).finish()
    for v in values:
        rows = rows.withColumn(v, F.coalesce(f"__b_{v}", f"__a_{v}"))
    return rows.drop(*spec)


def interpolate(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "filled"
) -> DataFrame:
    """Linear gap fill by row position within each series.

    Rows count as equally spaced. A gap at the end holds the last value, a gap
    at the start stays null.
    """
    known = F.col(value).isNotNull()
    spec = {"__lo": (F.col(value), known, False), "__hi": (F.col(value), known, True)}
    rows = OrderedRows(df, keys, order).row_number("__pos")
    both = rows.nearest_known(spec, {"__lo": "__lo_at", "__hi": "__hi_at"}).finish()
    lo, hi, lo_at, hi_at = (F.col(c) for c in ("__lo", "__hi", "__lo_at", "__hi_at"))
    share = (F.col("__pos") - lo_at) / (hi_at - lo_at)
    filled = F.when(known, F.col(value)).when(lo.isNotNull() & hi.isNotNull(), lo + (hi - lo) * share).when(lo.isNotNull(), lo)
    return both.withColumn(out, filled).drop("__pos", "__lo", "__hi", "__lo_at", "__hi_at")


def zscore_within(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``(x - mean) / std`` of the row's group, with the sample std."""
    aggs = []
    for v in values:
        aggs += [F.avg(v).alias(f"__m_{v}"), F.stddev_samp(v).alias(f"__s_{v}")]
    rows = attach(df, df.groupBy(*keys).agg(*aggs), keys)
    for v in values:
        z = F.when(F.col(f"__s_{v}") != 0, (F.col(v) - F.col(f"__m_{v}")) / F.col(f"__s_{v}"))
        rows = rows.withColumn(f"z_{v}", z)
    return rows.drop(*[f"__m_{v}" for v in values], *[f"__s_{v}" for v in values])


def lagged(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, rows: int = 1, out: str | None = None
) -> DataFrame:
    """The value ``rows`` rows earlier in the series."""
    name = out or f"lag_{value}"
    if rows == 1:
        return OrderedRows(df, keys, order).previous({value: name}).finish()
    return bounded_frame(df, keys, order, rows, {name: lambda w: F.lag(value, rows).over(w)})
