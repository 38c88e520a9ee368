"""Time-series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import timeseries as ops
from .catalog import Tables, in_cents, query, rounded, stamp
from .derived import FIELDS_SQL, READINGS_SQL, model_fields, readings

ORDER = ["ts", "event_id"]


@query(
    "ts_resample",
    """SELECT c_nationkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean,
              median(CAST(round(o_totalprice * 100) AS BIGINT)) AS median, round(stddev_samp(CAST(round(o_totalprice * 100) AS BIGINT)), 3) AS std
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def ts_resample(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("price", in_cents("o_totalprice"))
    got = ops.resample_month(rows, ["c_nationkey"], "o_orderdate", "price")
    return rounded(got.withColumn("month", F.col("month").cast("string")), 3, exact=("mean", "median"))


@query(
    "ts_resample_bday",
    """SELECT event_type, strftime(CAST(ts AS DATE) - CAST(greatest(isodow(ts) - 5, 0) AS INTEGER), '%Y-%m-%d') AS bday, avg(CAST(round(value * 100) AS BIGINT)) AS mean
       FROM events GROUP BY 1, 2""",
)
def ts_resample_bday(t: Tables):
    rows = t.events.withColumn("cents", in_cents("value"))
    got = ops.resample_business_day(rows, ["event_type"], "ts", "cents")
    return got.withColumn("bday", F.col("bday").cast("string"))


@query(
    "ts_shift_return",
    """SELECT event_id, CASE WHEN p <> 0 THEN value / p - 1 END AS change FROM (
         SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)""",
)
def ts_shift_return(t: Tables):
    return ops.shift_return(t.events, ["user_id"], ORDER, "value").select("event_id", "change")


@query(
    "ts_pct_change",
    f"""WITH {READINGS_SQL}, f AS (SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v FROM readings)
        SELECT event_id, CASE WHEN p <> 0 THEN v / p - 1 END AS change FROM (
          SELECT event_id, v, lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM f)""",
)
def ts_pct_change(t: Tables):
    return ops.shift_return(readings(t), ["user_id"], ORDER, "value", fill_first=True).select("event_id", "change")


@query(
    "ts_rolling_std",
    """SELECT event_id, round(CASE WHEN n = 20 THEN s END, 7) AS rolling_std FROM (
         SELECT event_id, count(value) OVER w AS n, stddev_samp(value) OVER w AS s FROM events
         WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""",
)
def ts_rolling_std(t: Tables):
    return rounded(ops.rolling_std(t.events, ["event_type"], ORDER, "value", 20).select("event_id", "rolling_std"), 7)


@query(
    "ts_rolling_grid",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, round(m, 6) AS rolling_mean FROM (
          SELECT level, y, x, avg(q) OVER w AS m, count(*) OVER w AS n FROM fields
          WINDOW w AS (PARTITION BY level, y ORDER BY x ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)) WHERE n = 5""",
)
def ts_rolling_grid(t: Tables):
    fields = model_fields(t).select("level", "y", "x", "q")
    got = ops.rolling_mean_along(fields, ["level", "y"], "x", "q", 5)
    return rounded(got.select("level", "y", "x", "rolling_mean"), 6)


_DAILY_SQL = """daily AS (SELECT user_id, date_trunc('day', ts) AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
  FROM events GROUP BY 1, 2)"""


def _daily(t: Tables):
    return t.events.groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        (F.sum(F.round(F.col("value") * 100).cast("long")) / 100).alias("total")
    )


@query(
    "ts_asfreq",
    f"""WITH {_DAILY_SQL}, axis AS (
          SELECT user_id, unnest(generate_series(min(day), max(day), INTERVAL 4 HOUR)) AS day FROM daily GROUP BY user_id)
        SELECT axis.user_id, strftime(axis.day, '%Y-%m-%d %H:%M:%S') AS day, total
        FROM axis LEFT JOIN daily ON axis.user_id = daily.user_id AND axis.day = daily.day""",
)
def ts_asfreq(t: Tables):
    got = ops.as_frequency(_daily(t), ["user_id"], "day", 4 * 3600, ["total"])
    return got.select("user_id", stamp("day"), "total")


@query(
    "ts_ffill_limit",
    f"""WITH {READINGS_SQL} SELECT event_id, last_value(value IGNORE NULLS) OVER (
          PARTITION BY event_type IN ('error', 'click') ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS value FROM readings""",
)
def ts_ffill_limit(t: Tables):
    rows = readings(t).withColumn("sensor", F.col("event_type").isin("error", "click"))
    return ops.fill_forward(rows, ["sensor"], ORDER, ["value"], 3).select("event_id", "value")


@query(
    "ts_fill_both",
    f"""WITH {READINGS_SQL} SELECT event_id, coalesce(
          last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value
        FROM readings""",
)
def ts_fill_both(t: Tables):
    return ops.fill_both(readings(t), ["user_id"], ORDER, ["value"]).select("event_id", "value")


@query(
    "ts_interpolate",
    f"""WITH {READINGS_SQL},
          r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM readings),
          k AS (SELECT *, CASE WHEN value IS NOT NULL THEN p END AS kp FROM r),
          b AS (SELECT event_id, p, value,
            last_value(value IGNORE NULLS) OVER b AS v0, last_value(kp IGNORE NULLS) OVER b AS p0,
            first_value(value IGNORE NULLS) OVER a AS v1, first_value(kp IGNORE NULLS) OVER a AS p1
            FROM k WINDOW b AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                          a AS (PARTITION BY user_id ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
        SELECT event_id, round(CASE WHEN value IS NOT NULL THEN value WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * (p - p0) / (p1 - p0)
                                    WHEN v0 IS NOT NULL THEN v0 END, 8) AS filled FROM b""",
)
def ts_interpolate(t: Tables):
    return rounded(ops.interpolate(readings(t), ["user_id"], ORDER, "value").select("event_id", "filled"), 8)


@query(
    "ts_zscore_group",
    """SELECT event_id, round(CASE WHEN s <> 0 THEN (value - m) / s END, 7) AS z_value FROM (
         SELECT event_id, value, avg(value) OVER (PARTITION BY event_type) AS m, stddev_samp(value) OVER (PARTITION BY event_type) AS s FROM events)""",
)
def ts_zscore_group(t: Tables):
    return rounded(ops.zscore_within(t.events, ["event_type"], ["value"]).select("event_id", "z_value"), 7)


@query(
    "ts_lag_feature",
    """SELECT event_id, lag(value) OVER w AS lag_value, lag(value, 7) OVER w AS lag_7 FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def ts_lag_feature(t: Tables):
    one = ops.lagged(t.events, ["user_id"], ORDER, "value")
    return ops.lagged(one, ["user_id"], ORDER, "value", 7, "lag_7").select("event_id", "lag_value", "lag_7")
