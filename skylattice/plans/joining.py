"""Joins, alignment, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grid, joins, neighbours, reshape
from .catalog import Tables, in_cents, query, rounded, stamp
from .derived import BUOYS_SQL, FIELDS_SQL, STATIONS, STATIONS_SQL, buoys, hourly_stations, model_fields, station_ids


@query(
    "join_inner",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, o_orderpriority
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey")
    orders = t.orders.select(F.col("o_orderkey").alias("key"), "o_custkey", "o_orderpriority")
    return joins.join_inner(lines, orders, ["key"]).withColumnRenamed("key", "l_orderkey")


@query(
    "join_natural",
    """SELECT o_orderkey, c_mktsegment, n_name FROM orders
       JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def join_natural(t: Tables):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_mktsegment", F.col("c_nationkey").alias("nationkey"))
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), "n_name")
    return joins.join_natural(orders, customers, nations).select("o_orderkey", "c_mktsegment", "n_name")


@query(
    "join_outer_common",
    "SELECT doc_id, quality, n_chars FROM labels FULL JOIN documents USING (doc_id)",
)
def join_outer_common(t: Tables):
    return joins.join_outer_common(t.labels.select("doc_id", "quality"), t.documents.select("doc_id", "n_chars"))


@query(
    "join_outer_reduce",
    f"""WITH {STATIONS_SQL} SELECT strftime(time, '%Y-%m-%d %H:%M:%S') AS time,
        {', '.join(f"sum(CASE WHEN station_id = '{s}' THEN value END) AS value_{s}" for s in STATIONS)}
        FROM stations GROUP BY time""",
)
def join_outer_reduce(t: Tables):
    wide = joins.join_outer_many(hourly_stations(t), "time", "station_id", "value", station_ids(t))
    return wide.withColumn("time", stamp("time"))


@query(
    "join_align_index",
    """WITH a AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2),
            b AS (SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1, 2)
       SELECT coalesce(a.day, b.day)::VARCHAR AS day, coalesce(a.user_id, b.user_id) AS user_id, a.n AS a, b.n AS b, a.n + b.n AS total
       FROM a FULL JOIN b ON a.day = b.day AND a.user_id = b.user_id""",
)
def join_align_index(t: Tables):
    """Daily counts of looking at things, and of all other events."""
    looked = F.col("event_type").isin("click", "view")
    daily = t.events.groupBy(F.to_date("ts").cast("string").alias("day"), "user_id", looked.alias("looked")).agg(F.count(F.lit(1)).alias("n"))
    return joins.align_add(daily.where("looked"), daily.where("NOT looked"), ["day", "user_id"], "n")


@query(
    "join_group_map",
    """SELECT r_name, c_mktsegment, avg(CAST(round(c_acctbal * 100) AS BIGINT)) AS mean_acctbal, count(*) AS n
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def join_group_map(t: Tables):
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), "r_name"
    )
    aggs = [F.avg(in_cents("c_acctbal")).alias("mean_acctbal"), F.count(F.lit(1)).alias("n")]
    return joins.group_by_mapping(t.customer, mapping, ["c_nationkey"], ["r_name", "c_mktsegment"], aggs)


@query("join_semi", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def join_semi(t: Tables):
    owing = t.customer.where(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return joins.keep_matching(t.orders, owing, ["o_custkey"]).select("o_orderkey")


@query("join_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def join_anti(t: Tables):
    return joins.keep_missing(t.documents, t.labels, ["doc_id"]).select("doc_id")


@query(
    "join_broadcast_dim",
    f"""WITH {FIELDS_SQL}, m AS (SELECT level, avg(q) AS level_mean FROM fields GROUP BY level)
        SELECT fields.level, y, x, round(q - level_mean, 5) AS anomaly FROM fields JOIN m ON fields.level = m.level""",
)
def join_broadcast_dim(t: Tables):
    fields = model_fields(t)
    means = fields.groupBy("level").agg(F.avg("q").alias("level_mean"))
    return joins.with_dimension(fields, means, ["level"]).select(
        "level", "y", "x", F.round(F.col("q") - F.col("level_mean"), 5).alias("anomaly")
    )


@query(
    "join_grid_diff",
    f"""WITH {FIELDS_SQL} SELECT a.level, a.y, a.x, a.q - b.q AS difference
        FROM fields a JOIN fields b ON a.y = b.y AND a.x = b.x AND a.level = b.level + 1""",
)
def join_grid_diff(t: Tables):
    """Every level against the one below it."""
    fields = model_fields(t).select("level", "y", "x", "q")
    return joins.grid_difference(fields, fields.withColumn("level", F.col("level") + 1), ["level", "y", "x"], "q")


@query(
    "cross_mesh",
    """WITH b AS (SELECT CAST(min(l_suppkey) AS DOUBLE) AS x0, CAST(max(l_suppkey) AS DOUBLE) AS x1,
                         min(l_quantity) AS y0, max(l_quantity) AS y1 FROM lineitem)
       SELECT x0 + i * 2 AS x, y0 + j * 0.5 AS y FROM b,
         unnest(range(CAST(ceil((x1 - x0) / 2) AS BIGINT))) AS u(i), unnest(range(CAST(ceil((y1 - y0) / 0.5) AS BIGINT))) AS w(j)""",
)
def cross_mesh(t: Tables):
    bounds = t.lineitem.agg(
        F.min("l_suppkey").cast("double").alias("x_min"),
        F.max("l_suppkey").cast("double").alias("x_max"),
        F.min("l_quantity").alias("y_min"),
        F.max("l_quantity").alias("y_max"),
    )
    return joins.mesh(bounds, 2.0, 0.5)


@query(
    "join_knn",
    f"""WITH {BUOYS_SQL}, d AS (
          SELECT a.id AS id, b.id AS neighbour, sqrt((a.longitude - b.longitude) ** 2 + (a.latitude - b.latitude) ** 2) AS distance
          FROM buoys a, buoys b)
        SELECT id, neighbour, round(distance, 7) AS distance, CAST(r AS INTEGER) AS rank FROM
          (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS r FROM d) WHERE r <= 3""",
)
def join_knn(t: Tables):
    nodes = buoys(t).select("id", F.array("longitude", "latitude").alias("features"))
    return rounded(neighbours.nearest(nodes, nodes, 3), 7)


@query(
    "join_interp_grid",
    f"""WITH {FIELDS_SQL},
        sites AS (SELECT event_id, user_id + 0.25 AS py, floor(value * 192 / 500) / 4 + 1 AS px, 1 + hour(ts) / 4 AS pz FROM events),
        placed AS (SELECT *, CAST(floor(py) AS BIGINT) AS iy, CAST(floor(px) AS BIGINT) AS ix, CAST(floor(pz) AS BIGINT) AS iz FROM sites),
        corners AS (SELECT event_id, f.total,
            (CASE WHEN f.y = iy THEN 1 - (py - iy) ELSE py - iy END) * (CASE WHEN f.x = ix THEN 1 - (px - ix) ELSE px - ix END)
            * (CASE WHEN f.level = iz THEN 1 - (pz - iz) ELSE pz - iz END) AS wt
          FROM placed JOIN fields f ON f.y IN (iy, iy + 1) AND f.x IN (ix, ix + 1) AND f.level IN (iz, iz + 1)),
        ok AS (SELECT event_id, sum(total * wt) AS v, sum(wt) AS s FROM corners WHERE wt <> 0 GROUP BY 1)
        SELECT s.event_id, CASE WHEN abs(ok.s - 1) < 1e-6 THEN ok.v END AS interpolated
        FROM sites s LEFT JOIN ok ON s.event_id = ok.event_id""",
)
def join_interp_grid(t: Tables):
    """The grid's value at points made from the events. Values and weights are
    multiples of 1/64, so the sums are exact."""
    sites = t.events.select(
        "event_id",
        (F.col("user_id") + F.lit(0.25)).alias("py"),
        (F.floor(F.col("value") * 192 / 500) / 4 + 1).alias("px"),
        (F.lit(1) + F.hour("ts") / 4).alias("pz"),
    )
    axes = {"pz": ("level", 0.0, 1.0), "py": ("y", 0.0, 1.0), "px": ("x", 0.0, 1.0)}
    got = grid.interpolate_sites(sites, model_fields(t).select("level", "y", "x", "total"), axes, "total")
    return got.select("event_id", "interpolated")


@query(
    "join_nearest_grid",
    f"""WITH {FIELDS_SQL}, pick AS (
          SELECT DISTINCT CAST(round(s_suppkey) AS BIGINT) AS y, 1 + s_nationkey * 2 AS x FROM supplier)
        SELECT level, fields.y, fields.x, q FROM fields JOIN pick ON fields.y = pick.y AND fields.x = pick.x""",
)
def join_nearest_grid(t: Tables):
    pick = t.supplier.select(F.col("s_suppkey").alias("y"), (F.lit(1) + F.col("s_nationkey") * 2).alias("x")).distinct()
    return joins.nearest_cells(model_fields(t), pick, ["y", "x"]).select("level", "y", "x", "q")


# --- sorting, set operations, reshaping ---------------------------------


@query("sort_values", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def sort_values(t: Tables):
    return reshape.sort_values(t.customer, F.desc("c_acctbal"), F.asc("c_custkey")).select("c_custkey", "c_acctbal")


@query(
    "topk",
    """SELECT l_partkey, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total FROM lineitem
       GROUP BY 1 ORDER BY total DESC, l_partkey LIMIT 10""",
)
def topk(t: Tables):
    totals = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("total"))
    return reshape.top_k(totals, 10, F.desc("total"), F.asc("l_partkey"))


@query(
    "union_all",
    """SELECT row_number() OVER (ORDER BY balance, kind, key) - 1 AS row_index, kind, key, balance, segment FROM (
         SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
         UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL FROM supplier)""",
)
def union_all(t: Tables):
    c = t.customer.select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    s = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return reshape.with_row_index(reshape.stack_rows(c, s), ["balance", "kind", "key"])


@query(
    "union_merge_dim",
    f"WITH {FIELDS_SQL} SELECT CASE WHEN level <= 3 THEN 10 ELSE 20 END AS height, level, y, x, q FROM fields",
)
def union_merge_dim(t: Tables):
    """The lower and the upper half of the levels, merged along a new dimension."""
    fields = model_fields(t).select("level", "y", "x", "q")
    parts = {10: fields.where(F.col("level") <= 3), 20: fields.where(F.col("level") > 3)}
    return reshape.merge_dimension(parts, "height")


@query("union_concat_dim", f"WITH {FIELDS_SQL} SELECT level, y, x, q FROM fields")
def union_concat_dim(t: Tables):
    fields = model_fields(t).select("level", "y", "x", "q")
    low, high = fields.where(F.col("level") <= 3), fields.where(F.col("level") > 3)
    return reshape.concat_dimension([low, high], ["level", "y", "x"])


@query("set_diff", "SELECT user_id AS id FROM events EXCEPT SELECT conv_id FROM conversations")
def set_diff(t: Tables):
    return reshape.set_difference(t.events.select(F.col("user_id").alias("id")), t.conversations.select(F.col("conv_id").alias("id")))


@query(
    "pivot_mean",
    """SELECT l_partkey, avg(CASE WHEN l_returnflag = 'A' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS "mean_A",
              avg(CASE WHEN l_returnflag = 'N' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS "mean_N",
              avg(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS "mean_R" FROM lineitem GROUP BY 1""",
)
def pivot_mean(t: Tables):
    rows = t.lineitem.withColumn("price", in_cents("l_extendedprice"))
    return reshape.pivot_mean(rows, ["l_partkey"], "l_returnflag", ["A", "N", "R"], "price")


@query(
    "pivot_count",
    """SELECT c_mktsegment, sum(CASE WHEN o_orderstatus = 'F' THEN 1 END)::BIGINT AS "n_F",
              sum(CASE WHEN o_orderstatus = 'O' THEN 1 END)::BIGINT AS "n_O", sum(CASE WHEN o_orderstatus = 'P' THEN 1 END)::BIGINT AS "n_P"
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def pivot_count(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return reshape.pivot_count(rows, ["c_mktsegment"], "o_orderstatus", ["F", "O", "P"])


@query(
    "stack",
    """SELECT l_orderkey, l_partkey, l_linenumber, k AS name, v AS value FROM (
         SELECT l_orderkey, l_partkey, l_linenumber, unnest(['l_discount', 'l_tax']) AS k, unnest([l_discount, l_tax]) AS v FROM lineitem)""",
)
def stack(t: Tables):
    return reshape.columns_to_rows(
        t.lineitem, ["l_orderkey", "l_partkey", "l_linenumber"], ["l_discount", "l_tax"], "name", "value"
    )


@query(
    "unstack",
    "SELECT l_suppkey, avg(CAST(round(l_discount * 100) AS BIGINT)) AS disc, avg(CAST(round(l_tax * 100) AS BIGINT)) AS tax FROM lineitem GROUP BY 1",
)
def unstack(t: Tables):
    means = t.lineitem.groupBy("l_suppkey").agg(F.avg(in_cents("l_discount")).alias("disc"), F.avg(in_cents("l_tax")).alias("tax"))
    long = reshape.columns_to_rows(means, ["l_suppkey"], ["disc", "tax"], "name", "value")
    return reshape.rows_to_columns(long, ["l_suppkey"], "name", ["disc", "tax"], "value")


@query(
    "flatten_dims",
    f"WITH {FIELDS_SQL} SELECT y || '/' || x AS sample, level, q, w FROM fields",
)
def flatten_dims(t: Tables):
    long = reshape.columns_to_rows(model_fields(t), ["level", "y", "x"], ["q", "w"], "variable", "value")
    return reshape.flatten_dimensions(long, ["y", "x"], "level", "variable", ["q", "w"], "value")


@query(
    "ft_training_rows",
    f"""WITH {FIELDS_SQL}, p AS (SELECT y, x, list(humidity ORDER BY level) AS h, list(temperature ORDER BY level) AS c, list(cloud ORDER BY level) AS o
            FROM fields WHERE level <= 3 GROUP BY 1, 2 HAVING count(*) = 3),
          r AS (SELECT y, x, list_concat(h, list_concat(c, [s_acctbal, s_nationkey::DOUBLE])) AS i, o FROM p JOIN supplier ON s_suppkey = y)
        SELECT y, x, len(i) AS n_inputs, round(list_sum(list_transform(range(1, 9), lambda k: k * i[k])), 6) AS inputs, round(o[1] + 10 * o[2] + 100 * o[3], 6) AS targets FROM r""",
)
def ft_training_rows(t: Tables):
    """Three levels of two profiles and two surface fields, with the cloud of all three levels; elements weighed by their place."""
    surface = t.supplier.select(F.col("s_suppkey").alias("y"), "s_acctbal", "s_nationkey")
    places = model_fields(t).select("y", "x").distinct()
    rows = reshape.training_rows(model_fields(t), ["y", "x"], "level", [1, 2, 3], ["humidity", "temperature"], ["cloud"], places.join(surface, "y"), ["s_acctbal", "s_nationkey"])
    weigh = lambda c: F.aggregate(F.transform(c, lambda v, k: v * (k + 1)), F.lit(0.0), lambda s, v: s + v)
    targets = F.aggregate(F.transform("targets", lambda v, k: v * F.pow(F.lit(10.0), k)), F.lit(0.0), lambda s, v: s + v)
    return rows.select("y", "x", F.size("inputs").cast("long").alias("n_inputs"), F.round(weigh(F.col("inputs")), 6).alias("inputs"), F.round(targets, 6).alias("targets"))


@query(
    "onehot_rows",
    f"""SELECT vec_id, {', '.join(f"CASE WHEN label = {i} THEN 1 ELSE 0 END AS c{i}" for i in range(10))}, 10 AS size FROM embeddings""",
)
def onehot_rows(t: Tables):
    hot = t.embeddings.select("vec_id", reshape.one_hot_levels(F.col("label"), 10).alias("h"))
    return hot.select("vec_id", *[F.col("h")[i].alias(f"c{i}") for i in range(10)], F.size("h").alias("size"))


@query(
    "shuffle_rows",
    """SELECT 'row' AS kind, event_id AS number, user_id FROM events
       UNION ALL SELECT 'place', row_number() OVER (ORDER BY event_id) - 1, NULL FROM events""",
)
def shuffle_rows(t: Tables):
    """All rows, and all places, each once: a permutation."""
    mixed = reshape.shuffled(t.events.select("event_id", "user_id"), ["event_id"], 17)
    both = F.array(
        F.struct(F.lit("row").alias("kind"), F.col("event_id").alias("number"), F.col("user_id").alias("user_id")),
        F.struct(F.lit("place").alias("kind"), F.col("place").alias("number"), F.lit(None).cast("long").alias("user_id")),
    )
    return mixed.select(F.inline(both))
