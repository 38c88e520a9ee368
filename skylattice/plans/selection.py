"""Projection, filters and row selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tables as ops
from .catalog import Tables, query, stamp
from .derived import FIELDS_SQL, READINGS_SQL, model_fields, readings


@query("rename", "SELECT doc_id, quality AS rotors, toxic AS forecast FROM labels")
def rename(t: Tables):
    return ops.rename(t.labels, {"quality": "rotors", "toxic": "forecast"})


@query("select_drop", "SELECT o_orderkey, o_totalprice FROM orders")
def select_drop(t: Tables):
    return ops.choose(t.orders, ["o_orderkey", "o_custkey", "o_totalprice"], drop=["o_custkey"])


@query("insert_col", "SELECT s_suppkey, s_acctbal * 2 AS doubled, s_name, s_nationkey, s_acctbal FROM supplier")
def insert_col(t: Tables):
    return ops.insert_column(t.supplier, 1, "doubled", F.col("s_acctbal") * 2)


@query("filter_cmp", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def filter_cmp(t: Tables):
    return ops.keep_where(t.customer, F.col("c_acctbal") >= 0).select("c_custkey", "c_acctbal")


@query(
    "filter_row_key",
    """SELECT 'key' AS how, o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 42
       UNION ALL
       SELECT 'position', o_orderkey, o_totalprice FROM
         (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS r FROM orders) WHERE r = 101""",
)
def filter_row_key(t: Tables):
    by_key = ops.row_with_key(t.orders, "o_orderkey", 42).withColumn("how", F.lit("key"))
    at = ops.row_at_position(t.orders, ["o_totalprice", "o_orderkey"], 100).withColumn("how", F.lit("position"))
    return by_key.unionByName(at).select("how", "o_orderkey", "o_totalprice")


@query(
    "filter_time_open",
    """SELECT o_orderkey FROM orders
       WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1996-02-01'""",
)
def filter_time_open(t: Tables):
    kind = t.orders.schema["o_orderdate"].dataType
    start, end = F.lit("1996-01-01").cast(kind), F.lit("1996-02-01").cast(kind)
    return ops.between_open(t.orders, "o_orderdate", start, end).select("o_orderkey")


@query("filter_time_of_day", "SELECT event_id, user_id FROM events WHERE hour(ts) = 15 AND minute(ts) = 0")
def filter_time_of_day(t: Tables):
    return ops.at_time_of_day(t.events, "ts", "15:00").select("event_id", "user_id")


@query(
    "filter_partial_date",
    """SELECT 'day' AS part, event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'
       UNION ALL SELECT 'year', event_id FROM events WHERE year(ts) = 2024""",
)
def filter_partial_date(t: Tables):
    day = ops.on_partial_date(t.events, "ts", "2024-01-15").select(F.lit("day").alias("part"), "event_id")
    year = ops.on_partial_date(t.events, "ts", "2024").select(F.lit("year").alias("part"), "event_id")
    return day.unionByName(year)


@query("filter_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view', 'signup')")
def filter_in(t: Tables):
    return ops.in_list(t.events, "event_type", ["click", "view", "signup"]).select("event_id", "event_type")


@query("filter_udf_coord", "SELECT l_linenumber AS level, count(*) AS n FROM lineitem WHERE l_linenumber > 1 AND l_linenumber <= 5 GROUP BY 1")
def filter_udf_coord(t: Tables):
    return (
        ops.where_coordinate(t.lineitem, "l_linenumber", lambda level: (level > 1) & (level <= 5))
        .groupBy(F.col("l_linenumber").alias("level"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "filter_and",
    "SELECT p_partkey FROM part WHERE p_type = 'ECONOMY' AND p_size IN (3, 5, 7) AND p_retailprice < 950",
)
def filter_and(t: Tables):
    return ops.keep_where(
        t.part, F.col("p_type") == "ECONOMY", F.col("p_size").isin(3, 5, 7), F.col("p_retailprice") < 950
    ).select("p_partkey")


@query(
    "slice_step",
    f"""WITH {FIELDS_SQL} SELECT level, y, x, q FROM fields
        WHERE level >= 1 AND level < 6 AND (level - 1) % 2 = 0 AND x >= 10 AND x < 40 AND (x - 10) % 5 = 0""",
)
def slice_step(t: Tables):
    cut = ops.slice_steps(model_fields(t), {"level": (1, 6, 2), "x": (10, 40, 5)})
    return cut.select("level", "y", "x", "q")


@query(
    "region_box",
    """SELECT c_custkey FROM customer
       WHERE c_acctbal / 100 BETWEEN 10 AND 60
         AND ((c_nationkey * 15 + 180) % 360) - 180 BETWEEN -60 AND 45""",
)
def region_box(t: Tables):
    """Customers placed by balance (latitude) and nation (longitude)."""
    placed = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 100).alias("lat"), (F.col("c_nationkey") * 15).alias("lon")
    )
    return ops.region_box(placed, "lat", "lon", 10, 60, -60, 45).select("c_custkey")


@query(
    "conditional_assign",
    """SELECT l.doc_id, CASE WHEN toxic = 1 THEN 0 ELSE quality END AS quality, coalesce(k.n, 0) AS n_turns
       FROM labels l LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) k ON l.doc_id = k.conv_id""",
)
def conditional_assign(t: Tables):
    turns = t.conversations.groupBy(F.col("conv_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("n_turns"))
    rows = t.labels.join(turns, "doc_id", "left")
    masked = ops.assign_where(rows, "quality", F.col("toxic") == 1, 0)
    return ops.fill_null(masked, {"n_turns": 0}).select("doc_id", "quality", "n_turns")


@query(
    "drop_null",
    f"WITH {READINGS_SQL} SELECT event_id, user_id, value FROM readings WHERE value IS NOT NULL",
)
def drop_null(t: Tables):
    return ops.drop_null(readings(t), ["value", "user_id"]).select("event_id", "user_id", "value")


@query("cast_bool", "SELECT doc_id, CAST(quality AS BOOLEAN) AS quality FROM labels")
def cast_bool(t: Tables):
    return ops.cast_bool(t.labels, "quality").select("doc_id", "quality")


@query(
    "dedup_key",
    """SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderkey, o_totalprice FROM
       (SELECT *, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1""",
)
def dedup_key(t: Tables):
    return ops.first_per_key(t.orders, ["o_orderdate"], ["o_orderkey"]).select(
        stamp("o_orderdate"), "o_orderkey", "o_totalprice"
    )


@query(
    "distinct_values",
    """SELECT p_brand AS value, (SELECT count(DISTINCT p_brand) FROM part) AS n FROM (SELECT DISTINCT p_brand FROM part)""",
)
def distinct_values(t: Tables):
    n = ops.count_distinct(t.part, ["p_brand"]).scalar()
    return ops.distinct_values(t.part, "p_brand").select(F.col("p_brand").alias("value"), n.alias("n"))
