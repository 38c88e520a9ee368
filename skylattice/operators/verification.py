"""Scores of forecasts against observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds from 0.001 in steps of 0.005, and tested levels.
FIRST_THRESHOLD = 0.001
THRESHOLD_STEP = 0.005
N_THRESHOLDS = 199
TESTED_LEVELS = 53


def ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def event(condition: Column) -> Column:
    """The rule for nulls in all tables of events: not known is no event."""
    return F.coalesce(condition, F.lit(False))


def with_category(df: DataFrame, observed: str, forecast: str) -> DataFrame:
    """Hit, miss, false alarm or correct rejection of each row; a null
    observation or forecast counts as no event."""
    obs = F.coalesce(F.col(observed), F.lit(0)) == 1
    fcst = F.coalesce(F.col(forecast), F.lit(0)) == 1
    return (
        df.withColumn("truePositive", obs & fcst)
        .withColumn("falsePositive", ~obs & fcst)
        .withColumn("trueNegative", ~obs & ~fcst)
        .withColumn("falseNegative", obs & ~fcst)
        .withColumn(
            "result_category",
            F.when(obs & fcst, "truePositive")
            .when(~obs & fcst, "falsePositive")
            .when(obs & ~fcst, "falseNegative")
            .otherwise("trueNegative"),
        )
    )


def confusion(df: DataFrame, observed: str, forecast: str) -> DataFrame:
    """Counts per (observed, forecast) and their share of the observed class."""
    n = df.groupBy(F.col(observed).alias("observed"), F.col(forecast).alias("forecast")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # one row per pair of classes is left here
    whole = F.sum("n").over(Window.partitionBy("observed"))
    return n.withColumn("share", F.col("n") / whole)


def contingency(df: DataFrame, observed: Column, forecast: Column, keys: Sequence[str | Column] = ()) -> DataFrame:
    """tp, fp, fn, tn in one aggregation; a null observation or forecast
    counts as no event."""
    observed, forecast = event(observed), event(forecast)
    return df.groupBy(*keys).agg(
        F.count_if(observed & forecast).alias("tp"),
        F.count_if(~observed & forecast).alias("fp"),
        F.count_if(observed & ~forecast).alias("fn"),
        F.count_if(~observed & ~forecast).alias("tn"),
    )


def precision_recall(df: DataFrame, observed: str, forecast: str) -> DataFrame:
    """Precision, recall and F1 of every class: precision over the forecasts
    of the class, recall over its observations."""
    pairs = df.groupBy(observed, forecast).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col(observed).alias("label"),
                    F.col("n").alias("n_obs"),
                    F.lit(0).cast("long").alias("n_fcst"),
                    F.when(F.col(observed) == F.col(forecast), F.col("n")).otherwise(F.lit(0)).alias("n_hit"),
                ),
                F.struct(
                    F.col(forecast).alias("label"),
                    F.lit(0).cast("long").alias("n_obs"),
                    F.col("n").alias("n_fcst"),
                    F.lit(0).cast("long").alias("n_hit"),
                ),
            )
        )
    )
    s = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("n_obs", "n_fcst", "n_hit")])
    return s.select(
        "label",
        ratio(F.col("n_hit"), F.col("n_fcst")).alias("precision"),
        ratio(F.col("n_hit"), F.col("n_obs")).alias("recall"),
        ratio(F.col("n_hit") * 2.0, F.col("n_fcst") + F.col("n_obs")).alias("f1"),
        F.col("n_obs").alias("support"),
    )


def hit_rate(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def false_alarm_rate(fp: Column, tn: Column) -> Column:
    return ratio(fp, fp + tn)


def hit_and_false_alarm(df: DataFrame, observed: Column, forecast: Column) -> DataFrame:
    c = contingency(df, observed, forecast)
    return c.withColumn("hit_rate", hit_rate(F.col("tp"), F.col("fn"))).withColumn(
        "false_alarm_rate", false_alarm_rate(F.col("fp"), F.col("tn"))
    )


def score_table(df: DataFrame, observed: Column, forecasts: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """Scores of several classifiers, one row per classifier and ``keys``.

    All are counted in the same pass: a classifier adds four counters, not a
    copy of the rows. ``_1`` is the class of events, ``_0`` that of the rest.
    A null observation or forecast counts as no event.
    """
    o = event(observed)

    def counts(name: str, forecast: Column) -> Column:
        f = event(forecast)
        cells = {"tp": o & f, "fp": ~o & f, "fn": o & ~f, "tn": ~o & ~f}
        return F.struct(F.lit(name).alias("classifier"), *[F.count_if(c).alias(k) for k, c in cells.items()])

    tables = df.groupBy(*keys).agg(*[counts(n, f).alias(f"__t{i}") for i, (n, f) in enumerate(forecasts.items())])
    rows = tables.select(*keys, F.inline(F.array(*[f"__t{i}" for i in range(len(forecasts))])))
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    h, f = hit_rate(tp, fn), false_alarm_rate(fp, tn)
    return rows.select(
        "*",
        ratio(tp, tp + fp).alias("precision_1"),
        h.alias("recall_1"),
        ratio(tp * 2.0, tp * 2 + fp + fn).alias("f1_1"),
        ratio(tn, tn + fn).alias("precision_0"),
        ratio(tn, tn + fp).alias("recall_0"),
        ratio(tn * 2.0, tn * 2 + fp + fn).alias("f1_0"),
        h.alias("hit_rate"),
        f.alias("false_alarm_rate"),
        sedi(h, f).alias("sedi"),
    )


def balanced_accuracy(df: DataFrame, observed: str, forecast: str) -> DataFrame:
    """Mean recall over the observed classes."""
    return (
        precision_recall(df, observed, forecast)
        .where(F.col("support") > 0)
        .agg(F.avg("recall").alias("balanced_accuracy"))
    )


def sedi(h: Column, f: Column) -> Column:
    """Symmetric extremal dependence index; null when a rate is 0 or 1."""
    inside = (h > 0) & (h < 1) & (f > 0) & (f < 1)
    top = F.ln(f) - F.ln(h) - F.ln(1 - f) + F.ln(1 - h)
    bottom = F.ln(f) + F.ln(h) + F.ln(1 - f) + F.ln(1 - h)
    return F.when(inside, top / bottom)


def seds(a: Column, b: Column, c: Column, n: Column) -> Column:
    """Symmetric extreme dependency score; null where it is not defined."""
    expected = (a + b) * (a + c) / n
    return F.when((a > 0) & (a < n), F.ln(expected / a) / F.ln(a / n))


def threshold_sweep(df: DataFrame, observed: Column, score: Column) -> DataFrame:
    """Hit rate, false alarm rate and SEDI at every threshold.

    Each score is put in the interval between two thresholds, the intervals
    are counted once, and running sums over the 200 counts give the table for
    every threshold. An event is forecast when the score is above it. A null
    observation is no event, a null score is above no threshold.
    """
    observed = event(observed)
    # index of the last threshold strictly below the score; -1 if none is
    guess = F.floor((score - FIRST_THRESHOLD) / THRESHOLD_STEP).cast("long")
    at = lambda i: F.lit(FIRST_THRESHOLD) + i * F.lit(THRESHOLD_STEP)
    exact = (
        F.when(score > at(guess + 1), guess + 1).when(score > at(guess), guess).otherwise(guess - 1)
    )
    place = F.least(F.greatest(exact, F.lit(-1)), F.lit(N_THRESHOLDS - 1))
    counts = df.groupBy(place.cast("int").alias("i")).agg(
        F.count_if(observed).alias("__p"), F.count_if(~observed).alias("__n")
    )
    frame = df.sparkSession.range(-1, N_THRESHOLDS).select(F.col("id").cast("int").alias("i"))
    filled = frame.join(F.broadcast(counts), "i", "left").fillna(0, ["__p", "__n"])  # at most 200 rows
    above = Window.orderBy("i").rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = filled.select(
        "i",
        F.sum("__p").over(above).alias("tp"),
        F.sum("__n").over(above).alias("fp"),
        F.sum("__p").over(whole).alias("__pp"),
        F.sum("__n").over(whole).alias("__nn"),
    ).where(F.col("i") >= 0)
    h, f = ratio(F.col("tp"), F.col("__pp")), ratio(F.col("fp"), F.col("__nn"))
    return table.select(
        at(F.col("i")).alias("threshold"), h.alias("hit_rate"), f.alias("false_alarm_rate"), sedi(h, f).alias("sedi")
    )


def level_contingency(df: DataFrame, observed: str, forecast: str, levels: int = TESTED_LEVELS) -> DataFrame:
    """Contingency of "base at or below level k" for every level k.

    Rows are first counted per (observed, forecast) base, so the levels
    multiply only that small table. Where hits or false alarms are missing at
    a level, 1 is added to both.
    """
    pairs = df.groupBy(F.col(observed).alias("o"), F.col(forecast).alias("f")).agg(F.count(F.lit(1)).alias("n"))
    at_levels = pairs.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))))
    p, q = F.col("o") <= F.col("level"), F.col("f") <= F.col("level")
    zero = F.lit(0).cast("long")

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(zero))

    raw = at_levels.groupBy("level").agg(
        total(p & q).alias("a"), total(~p & q).alias("b"), total(p & ~q).alias("c"), total(~p & ~q).alias("d")
    )
    extra = ((F.col("a") == 0) | (F.col("b") == 0)).cast("long")
    return raw.select("level", (F.col("a") + extra).alias("a"), (F.col("b") + extra).alias("b"), "c", "d")


def level_scores(table: DataFrame) -> DataFrame:
    """SEDI and SEDS of every level of a contingency table."""
    a, b, c, d = (F.col(k) for k in "abcd")
    n = a + b + c + d
    return table.withColumn("sedi", sedi(ratio(a, a + c), ratio(b, b + d))).withColumn("seds", seds(a, b, c, n))


def error_summary(df: DataFrame, observed: Column, forecast: Column, keys: Sequence[str] = ()) -> DataFrame:
    diff = forecast - observed
    return df.groupBy(*keys).agg(
        F.avg((diff == 0).cast("double")).alias("accuracy"),
        F.avg(diff).alias("mean_error"),
        F.avg(F.abs(diff)).alias("mean_absolute_error"),
        F.sqrt(F.avg(diff * diff)).alias("root_mean_squared_error"),
    )


def direction(df: DataFrame, observed: Column, forecast: Column) -> DataFrame:
    return df.agg(
        F.count_if(forecast > observed).alias("too_high"),
        F.count_if(forecast < observed).alias("too_low"),
        F.count_if(forecast == observed).alias("correct"),
    )


def r2_mse(df: DataFrame, observed: Column, forecast: Column, keys: Sequence[str] = ()) -> DataFrame:
    err = (observed - forecast) * (observed - forecast)
    return df.groupBy(*keys).agg(
        ratio(F.sum(err), F.var_pop(observed) * F.count(observed)).alias("__u"), F.avg(err).alias("mse")
    ).select(*keys, (1 - F.col("__u")).alias("r2"), "mse")


def map_difference(
    forecast: DataFrame, observed: DataFrame, cell: Sequence[str], value: str
) -> DataFrame:
    """Forecast minus observation of every cell both have."""
    f = forecast.select(*cell, F.col(value).alias("forecast"))
    o = observed.select(*cell, F.col(value).alias("observed"))
    return f.join(o, list(cell)).withColumn("error", F.col("forecast") - F.col("observed"))
