"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as ops
from .catalog import Tables, in_cents, query, rounded, stamp
from .derived import FIELDS_SQL, STATIONS_SQL, hourly_stations, model_fields, readings, station_ids


def _profiles_sql(extra: str = "") -> str:
    return f"WITH {FIELDS_SQL} {extra}"


@query("agg_count_by", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def agg_count_by(t: Tables):
    return ops.count_by(t.events, "event_type")


@query("agg_year_label", "SELECT year(o_orderdate) AS year, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def agg_year_label(t: Tables):
    return ops.count_by(t.orders, F.year("o_orderdate").alias("year"), "o_orderstatus")


@query(
    "agg_month_hour",
    """SELECT event_type, 'month' AS part, month(ts) AS at, count(*) AS n FROM events GROUP BY 1, 3
       UNION ALL SELECT event_type, 'hour', hour(ts), count(*) FROM events GROUP BY 1, 3""",
)
def agg_month_hour(t: Tables):
    return ops.count_by_month_hour(t.events, "ts", "event_type")


@query(
    "agg_group_mean",
    """SELECT l_returnflag, l_linestatus, avg(l_quantity) AS mean_l_quantity,
              avg(CAST(round(l_extendedprice * 100) AS BIGINT)) AS mean_price FROM lineitem GROUP BY 1, 2""",
)
def agg_group_mean(t: Tables):
    rows = t.lineitem.withColumn("price", in_cents("l_extendedprice"))
    return ops.mean_by(rows, ["l_returnflag", "l_linestatus"], ["l_quantity", "price"])


@query(
    "agg_multi",
    """SELECT user_id, round(avg(value), 8) AS mean_value, round(stddev_samp(value), 8) AS std_value FROM events GROUP BY 1""",
)
def agg_multi(t: Tables):
    return rounded(ops.mean_std_by(t.events, ["user_id"], ["value"]), 8)


@query(
    "agg_having_top",
    """SELECT c_nationkey, count(*) AS n, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean_value FROM orders JOIN customer ON o_custkey = c_custkey
       GROUP BY 1 HAVING count(*) > 50 ORDER BY mean_value DESC, c_nationkey LIMIT 20""",
)
def agg_having_top(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("price", in_cents("o_totalprice"))
    return ops.frequent_top(rows, "c_nationkey", "price", 50, 20)


_DESCRIBE = """count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
  round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.75), 4) AS p75,
  max(value) AS max FROM events"""


@query("agg_describe", f"SELECT 'all' AS event_type, {_DESCRIBE} UNION ALL SELECT event_type, {_DESCRIBE} GROUP BY event_type")
def agg_describe(t: Tables):
    whole = ops.describe(t.events, "value").withColumn("event_type", F.lit("all"))
    return rounded(whole.unionByName(ops.describe(t.events, "value", ["event_type"])))


@query(
    "agg_nonnull",
    """WITH r AS (SELECT CASE WHEN event_type <> 'error' THEN value END AS value, user_id FROM events)
       SELECT 'value' AS column_name, count(value) AS n_value, count(*) - count(value) AS n_null FROM r
       UNION ALL SELECT 'user_id', count(user_id), count(*) - count(user_id) FROM r""",
)
def agg_nonnull(t: Tables):
    return ops.null_counts(readings(t), ["value", "user_id"])


@query(
    "agg_colsum_rowmean",
    """WITH s AS (SELECT sum(quality)::BIGINT AS q, sum(toxic)::BIGINT AS x FROM labels)
       SELECT d.doc_id, round(CASE WHEN l.doc_id IS NULL THEN d.n_chars ELSE (d.n_chars + l.quality + l.toxic) / 3.0 END, 4) AS row_mean,
              s.q AS sum_quality, s.x AS sum_toxic
       FROM documents d LEFT JOIN labels l USING (doc_id), s""",
)
def agg_colsum_rowmean(t: Tables):
    sums = ops.column_sums(t.labels, ["quality", "toxic"])
    rows = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id", "left")
    means = ops.row_mean(rows, ["n_chars", "quality", "toxic"], "row_mean")
    return rounded(
        means.select("doc_id", "row_mean", sums.select("sum_quality").scalar().alias("sum_quality"), sums.select("sum_toxic").scalar().alias("sum_toxic"))
    )


@query(
    "agg_hist",
    """WITH g AS (SELECT 'all' AS event_type, value FROM events UNION ALL SELECT event_type, value FROM events),
            e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM g GROUP BY 1),
            c AS (SELECT g.event_type, least(CAST(floor((value - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin, count(*) AS n
                  FROM g JOIN e ON g.event_type = e.event_type GROUP BY 1, 2)
       SELECT e.event_type, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 20), 4) AS bin_start, coalesce(c.n, 0) AS n
       FROM e CROSS JOIN range(20) AS b(bin) LEFT JOIN c ON c.event_type = e.event_type AND c.bin = b.bin""",
)
def agg_hist(t: Tables):
    whole = ops.histogram(t.events, "value", 20).withColumn("event_type", F.lit("all"))
    return rounded(whole.unionByName(ops.histogram(t.events, "value", 20, ["event_type"])))


@query(
    "agg_hist2d",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)
       SELECT CAST(least(greatest(ceil((l_quantity - 1) / 5), 0), 10) AS INTEGER) AS x_bin,
              CAST(least(greatest(ceil((l_extendedprice - 900) / 10000), 0), 11) AS INTEGER) AS y_bin, count(*) AS n,
              (SELECT round(slope, 4) FROM f) AS slope, (SELECT round(intercept, 2) FROM f) AS intercept
       FROM lineitem GROUP BY 1, 2""",
)
def agg_hist2d(t: Tables):
    fit = ops.linear_fit(t.lineitem, "l_quantity", "l_extendedprice")
    counts = ops.histogram_2d(t.lineitem, "l_quantity", "l_extendedprice", (1, 50), 5, (900, 105000), 10000)
    return counts.select(
        "x_bin",
        "y_bin",
        "n",
        F.round(fit.select("slope").scalar(), 4).alias("slope"),
        F.round(fit.select("intercept").scalar(), 2).alias("intercept"),
    )


@query(
    "agg_collapse",
    f"""{_profiles_sql()} SELECT level, round(avg(q), 4) AS mean, round(min(q), 4) AS min, round(max(q), 4) AS max,
        round(sum(q), 2) AS sum, round(stddev_samp(q), 4) AS std FROM fields GROUP BY level""",
)
def agg_collapse(t: Tables):
    got = ops.collapse(model_fields(t), ["level"], "q", ["mean", "min", "max", "sum", "std"])
    return rounded(got.withColumn("sum", F.round("sum", 2)))


@query(
    "agg_by_category",
    """SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'djf' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'mam'
                   WHEN month(o_orderdate) IN (6, 7, 8) THEN 'jja' ELSE 'son' END AS category, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean, count(o_totalprice) AS n
       FROM orders GROUP BY 1
       UNION ALL SELECT CAST(CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS VARCHAR), avg(CAST(round(o_totalprice * 100) AS BIGINT)), count(o_totalprice) FROM orders GROUP BY 1""",
)
def agg_by_category(t: Tables):
    orders = t.orders.withColumn("price", in_cents("o_totalprice"))
    seasons = ops.aggregate_by_season(orders, "o_orderdate", "price").withColumnRenamed("season", "category")
    decades = ops.aggregate_by_decade(orders, "o_orderdate", "price").select(
        F.col("decade").cast("string").alias("category"), "mean", "n"
    )
    return seasons.unionByName(decades)


@query(
    "agg_collapse_diff",
    """WITH a AS (SELECT year(o_orderdate) AS year, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS m FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
            b AS (SELECT year(o_orderdate) AS year, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS m FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1)
       SELECT a.year, a.m AS mean_a, b.m AS mean_b, a.m - b.m AS difference FROM a JOIN b ON a.year = b.year""",
)
def agg_collapse_diff(t: Tables):
    rows = t.orders.select("o_orderstatus", F.year("o_orderdate").alias("year"), in_cents("o_totalprice").alias("price"))
    a, b = rows.where(F.col("o_orderstatus") == "O"), rows.where(F.col("o_orderstatus") != "O")
    return ops.collapsed_difference(a, b, ["year"], "price")


@query(
    "agg_level_stats",
    f"""{_profiles_sql()} SELECT 'q' AS feature, level, round(avg(q), 4) AS mean, round(stddev_pop(q), 4) AS std FROM fields GROUP BY level
        UNION ALL SELECT 'w', level, round(avg(w), 4), round(stddev_pop(w), 4) FROM fields GROUP BY level
        UNION ALL SELECT 'temperature', level, round(avg(temperature), 4), round(stddev_pop(temperature), 4) FROM fields GROUP BY level
        UNION ALL SELECT 'q', NULL, round(avg(q), 4), round(stddev_pop(q), 4) FROM fields
        UNION ALL SELECT 'w', NULL, round(avg(w), 4), round(stddev_pop(w), 4) FROM fields
        UNION ALL SELECT 'temperature', NULL, round(avg(temperature), 4), round(stddev_pop(temperature), 4) FROM fields""",
)
def agg_level_stats(t: Tables):
    return rounded(ops.level_statistics(model_fields(t), "level", ["q", "w", "temperature"]))


@query("agg_minmax_running", "SELECT l_linenumber, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1")
def agg_minmax_running(t: Tables):
    """Two batches of rows, the second merged with the result of the first."""
    early = F.col("l_linestatus").eqNullSafe("F")
    old, new = t.lineitem.where(early), t.lineitem.where(~early)
    first = ops.level_min_max(old, "l_linenumber", "l_extendedprice")
    return ops.level_min_max(new, "l_linenumber", "l_extendedprice", first)


@query(
    "agg_corrmatrix",
    "\nUNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS r FROM lineitem"
        for a in ("l_quantity", "l_extendedprice", "l_discount")
        for b in ("l_quantity", "l_extendedprice", "l_discount")
    ),
)
def agg_corrmatrix(t: Tables):
    return rounded(ops.correlation_matrix(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]))


@query(
    "agg_first_index",
    f"""{_profiles_sql()} SELECT y, x, coalesce(min(CASE WHEN cloud > 0.25 THEN level - 1 END), 69) AS base FROM fields GROUP BY y, x""",
)
def agg_first_index(t: Tables):
    fields = model_fields(t).withColumn("height", F.col("level") - 1)
    return ops.first_level_above(fields, ["y", "x"], "height", "cloud", 0.25, 69)


@query(
    "agg_first_index_array",
    """SELECT vec_id, coalesce((SELECT min(i) - 1 FROM (SELECT unnest(range(1, 65)) AS i) WHERE embedding[i] > CAST(0.25 AS FLOAT)), 69)::INTEGER AS base FROM embeddings""",
)
def agg_first_index_array(t: Tables):
    return t.embeddings.select(
        "vec_id", ops.first_index_above(F.col("embedding"), F.lit(0.25).cast("float"), 69).alias("base")
    )


@query("agg_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings")
def agg_argmax(t: Tables):
    return t.embeddings.select("vec_id", ops.index_of_max(F.col("embedding")).alias("best"))


@query(
    "agg_event_share",
    f"""{_profiles_sql(", b AS (SELECT y, x, coalesce(min(CASE WHEN cloud > 0.25 THEN level - 1 END), 69) AS base FROM fields GROUP BY y, x)")}
        SELECT round(avg(CASE WHEN base < 69 THEN 1.0 ELSE 0 END), 6) AS share_with, round(avg(CASE WHEN base < 69 THEN 0.0 ELSE 1 END), 6) AS share_without FROM b""",
)
def agg_event_share(t: Tables):
    return rounded(ops.event_share(agg_first_index(t), F.col("base") < 69), 6)


@query(
    "agg_trapz",
    """SELECT user_id, round(coalesce(sum(CASE WHEN px IS NOT NULL THEN (x - px) * (value + py) / 2 END), 0), 2) AS integral FROM (
         SELECT user_id, value, epoch_us(ts) / 1e6 / 3600 AS x, lag(epoch_us(ts) / 1e6 / 3600) OVER w AS px, lag(value) OVER w AS py
         FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY 1""",
)
def agg_trapz(t: Tables):
    rows = t.events.withColumn("hours", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 / 3600)
    return rounded(ops.trapezoid(rows, ["user_id"], "hours", "value", ["event_id"]), 2)


@query("agg_quantile", "SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS quantile FROM lineitem")
def agg_quantile(t: Tables):
    return rounded(ops.quantile(t.lineitem, "l_extendedprice", 0.95), 6)


@query(
    "agg_percentile_band",
    """SELECT user_id, round(quantile_cont(value, 0.025), 8) AS p025, round(quantile_cont(value, 0.95), 8) AS p95,
              round(quantile_cont(value, 0.975), 8) AS p975, max(value) AS max FROM events GROUP BY 1""",
)
def agg_percentile_band(t: Tables):
    return rounded(ops.percentile_band(t.events, "value", ["user_id"]), 8)


@query(
    "agg_mean_band",
    """SELECT year(o_orderdate) AS year, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
              round(avg(o_totalprice) - stddev_samp(o_totalprice), 4) AS lower, round(avg(o_totalprice) + stddev_samp(o_totalprice), 4) AS upper
       FROM orders GROUP BY 1""",
)
def agg_mean_band(t: Tables):
    return rounded(ops.mean_band(t.orders, [F.year("o_orderdate").alias("year")], "o_totalprice"))


@query(
    "agg_complete_groups",
    f"""WITH {STATIONS_SQL} SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time, station_id, value FROM stations
        WHERE time IN (SELECT time FROM stations GROUP BY time HAVING count(DISTINCT station_id) = (SELECT count(DISTINCT event_type) FROM events))""",
)
def agg_complete_groups(t: Tables):
    full = ops.complete_groups(hourly_stations(t), ["time"], "station_id", len(station_ids(t)))
    return full.select(stamp("time"), "station_id", "value")


@query(
    "agg_collect",
    f"""WITH {STATIONS_SQL} SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time,
          string_agg(station_id, ',' ORDER BY station_id) AS station_id,
          string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY station_id) AS value
        FROM stations GROUP BY time HAVING count(DISTINCT station_id) = (SELECT count(DISTINCT event_type) FROM events)""",
)
def agg_collect(t: Tables):
    stations = station_ids(t)
    full = ops.complete_groups(hourly_stations(t), ["time"], "station_id", len(stations))
    lists = ops.collect_members(full, ["time"], "station_id", stations, ["value"])
    whole = F.transform("value", lambda v: F.round(v * 100).cast("long").cast("string"))
    return lists.select(stamp("time"), F.concat_ws(",", "station_id").alias("station_id"), F.concat_ws(",", whole).alias("value"))
