"""Inputs the operators need, as Spark derives them from the given tables.

The SQL texts give the same tables for the comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import Tables, in_cents


def cents(column: str):
    return F.sum(in_cents(column))


def model_fields(t: Tables) -> DataFrame:
    """A grid (level, y, x): line number, supplier and quantity of the line
    items, with the mean of several fields in each cell. Sums are taken over
    whole cents, so they are exact in any order."""
    n = F.count(F.lit(1))
    return (
        t.lineitem.groupBy(
            F.col("l_linenumber").alias("level"), F.col("l_suppkey").alias("y"), F.col("l_quantity").cast("int").alias("x")
        )
        .agg(
            (cents("l_extendedprice") / n / 100).alias("q"),
            (cents("l_discount") / n).alias("disc"),
            (cents("l_tax") / n).alias("tax"),
            cents("l_extendedprice").alias("total"),
            n.alias("n"),
        )
        .select(
            "level",
            "y",
            "x",
            "q",
            (F.col("disc") - 5).alias("u"),
            (F.col("tax") - 4).alias("v"),
            (F.col("disc") - F.col("tax")).alias("w"),
            (F.col("disc") / 25).alias("cloud"),
            (F.col("disc") + 270).alias("temperature"),
            (F.col("tax") / 1000).alias("humidity"),
            (F.col("disc") + F.col("level") * 3 + 280).alias("theta"),
            "total",
            "n",
        )
    )


FIELDS_SQL = """
fields AS (
  SELECT level, y, x, q, disc - 5 AS u, tax - 4 AS v, disc - tax AS w, disc / 25 AS cloud,
         disc + 270 AS temperature, tax / 1000 AS humidity, disc + level * 3 + 280 AS theta, total, n
  FROM (
    SELECT l_linenumber AS level, l_suppkey AS y, CAST(l_quantity AS INTEGER) AS x,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS q,
           CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) AS disc,
           CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS DOUBLE) / count(*) AS tax,
           CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total,
           count(*) AS n
    FROM lineitem GROUP BY 1, 2, 3))
"""


def readings(t: Tables) -> DataFrame:
    """Events as a time series per user; a failed reading (an ``error`` event)
    has no value."""
    return t.events.select(
        "user_id", "ts", "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )


READINGS_SQL = """
readings AS (
  SELECT user_id, ts, event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
"""


def hourly_stations(t: Tables) -> DataFrame:
    """One row per hour and station (event type) with the mean reading."""
    return (
        t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time"), F.col("event_type").alias("station_id"))
        .agg(
            (cents("value") / F.count(F.lit(1)) / 100).alias("value"),
            F.count(F.lit(1)).cast("double").alias("reports"),
        )
    )


STATIONS_SQL = """
stations AS (
  SELECT date_trunc('hour', ts) AS time, event_type AS station_id,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS value,
         CAST(count(*) AS DOUBLE) AS reports
  FROM events GROUP BY 1, 2)
"""

# The event types of the given tables, which SQL must list as columns.
STATIONS = ["click", "error", "purchase", "signup", "view"]
#: More stations than this cannot be laid side by side as columns.
MOST_STATIONS = 1000


def station_ids(t: Tables) -> list[str]:
    """The stations that report, in their order."""
    found = t.events.where(F.col("event_type").isNotNull()).select("event_type").distinct()
    ids = sorted(r[0] for r in found.limit(MOST_STATIONS + 1).collect())
    if len(ids) > MOST_STATIONS:
        raise ValueError(f"more than {MOST_STATIONS} stations")
    return ids


def number_sql(*ids: str, seed: int = 0) -> str:
    """SQL for ``functions.scalar.keyed_number``."""
    parts = ", ".join(f"CAST({i} AS VARCHAR)" for i in ids)
    return f"CAST('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 15) AS BIGINT)"


def unit_sql(*ids: str, seed: int = 0) -> str:
    """SQL for ``operators.sampling.hash_unit``."""
    return f"({number_sql(*ids, seed=seed)} / {2**60}::DOUBLE)"


def buoys(t: Tables) -> DataFrame:
    """One node per user with a mean place, made from whole numbers."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("long")
    n = F.count(F.lit(1))
    return t.events.groupBy(F.col("user_id").alias("id")).agg(
        (F.sum(k) / n).alias("longitude"), (cents("value") / n / 100).alias("latitude"), F.sum(k).cast("double").alias("load")
    )


BUOYS_SQL = r"""
buoys AS (
  SELECT user_id AS id,
         CAST(sum(CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT)) AS DOUBLE) / count(*) AS longitude,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100 AS latitude,
         CAST(sum(CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT)) AS DOUBLE) AS load
  FROM events GROUP BY 1)
"""
