"""Watermarked aggregates for unbounded input.

The same expressions as the batch operators, with state bounded by a
watermark. Operators that look ahead in time are batch only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.verification import event


def windowed_counts(df: DataFrame, ts: str, keys: Sequence[str], width: str, lateness: str) -> DataFrame:
    """Counts per key and time window; late rows up to ``lateness`` count."""
    return (
        df.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")
    )


def windowed_means(df: DataFrame, ts: str, keys: Sequence[str], value: str, width: str, lateness: str) -> DataFrame:
    """Mean and sample std per key and time window."""
    return (
        df.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("w"), *keys)
        .agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("n"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "mean", "std", "n")
    )


def windowed_contingency(
    df: DataFrame, ts: str, observed: str, forecast: str, width: str, lateness: str
) -> DataFrame:
    """Contingency counts per time window; a null side counts as no event, as
    in the batch tables."""
    o, f = event(F.col(observed) == 1), event(F.col(forecast) == 1)
    return (
        df.withWatermark(ts, lateness)
        .groupBy(F.window(ts, width).alias("w"))
        .agg(
            F.count_if(o & f).alias("tp"),
            F.count_if(~o & f).alias("fp"),
            F.count_if(o & ~f).alias("fn"),
            F.count_if(~o & ~f).alias("tn"),
        )
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "tp", "fp", "fn", "tn")
    )
