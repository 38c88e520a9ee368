"""Readers and writers: the given tables written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources as io
from ..operators import aggregates, sampling
from ..session import scratch_path
from ..sources import zorder
from .catalog import Tables, query, rounded
from .derived import FIELDS_SQL, model_fields, unit_sql

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"


def _orders(t: Tables):
    return t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("src_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE)::VARCHAR AS o_orderdate FROM orders")
def src_csv(t: Tables):
    path = scratch_path(t.spark, "csv")
    io.write_csv(_orders(t), path)
    return io.read_csv(t.spark, path, ORDERS).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate")
    )


@query("src_csv_names", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_names(t: Tables):
    path = scratch_path(t.spark, "names")
    io.write_csv(t.customer, path, header=False)
    names = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return io.read_csv(t.spark, path, names, header=False)


@query("src_multichar_delim", "SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def src_multichar_delim(t: Tables):
    path = scratch_path(t.spark, "delim")
    io.write_csv(t.part.select("p_partkey", "p_name", "p_size", "p_retailprice"), path, header=False, sep="::")
    names = "p_partkey long, p_name string, p_size int, p_retailprice double"
    return io.read_csv(t.spark, path, names, header=False, sep="::")


@query(
    "src_yearly_union",
    "SELECT year(o_orderdate) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def src_yearly_union(t: Tables):
    path = scratch_path(t.spark, "yearly")
    rows = _orders(t)
    io.write_csv(rows.withColumn("year", F.year("o_orderdate")), path, partition_by=["year"])
    # as many rows as there are years; rows without a date have a folder of their own
    years = [r[0] for r in rows.select(F.year("o_orderdate")).distinct().collect()]
    paths = [f"{path}/year={'__HIVE_DEFAULT_PARTITION__' if y is None else y}" for y in years]
    return (
        io.read_csv(t.spark, paths, ORDERS)
        .groupBy(F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query("src_csv_glob", "SELECT doc_id, quality, toxic FROM labels")
def src_csv_glob(t: Tables):
    path = scratch_path(t.spark, "glob")
    good = F.col("quality").eqNullSafe(1)
    for part, rows in enumerate((~good, good)):
        io.write_csv(t.labels.where(rows), f"{path}/labels_{part}")
    return io.read_csv(t.spark, f"{path}/labels_*/*.csv", "doc_id long, quality int, toxic int")


@query(
    "src_csv_defaults",
    """SELECT c_custkey, c_acctbal, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment
       FROM customer WHERE c_acctbal >= 0""",
)
def src_csv_defaults(t: Tables):
    """Overdrawn customers are written with an unreadable balance, machinery
    ones without a segment."""
    path = scratch_path(t.spark, "defaults")
    raw = t.customer.select(
        "c_custkey",
        "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit("overdrawn")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    io.write_csv(raw, path)
    schema = "c_custkey long, c_name string, c_acctbal double, c_mktsegment string"
    return io.read_csv_lenient(t.spark, path, schema, ["c_custkey", "c_acctbal", "c_mktsegment"], {"c_mktsegment": "NONE"})


@query("src_parquet", "SELECT p_partkey, p_brand, p_size FROM part")
def src_parquet(t: Tables):
    return io.read_parquet(t.spark, f"{t.folder}/part.parquet", ["p_partkey", "p_brand", "p_size"])


@query(
    "src_regex_text",
    """SELECT n_nationkey + 1000 AS site_id, 50 + n_nationkey AS latitude, CAST(-0.5 - n_nationkey AS DOUBLE) AS longitude,
              strftime(o_orderdate, '%Y-%m-%d %H:%M') AS timestamp, CAST(floor(o_totalprice) AS BIGINT) AS volume
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def src_regex_text(t: Tables):
    """One folder of site files per nation: three header lines, a line per
    order and one unreadable line per cancelled-looking order status."""
    path = scratch_path(t.spark, "sites")
    site = F.col("c_nationkey").alias("site")
    rows = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            site,
            F.concat(
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                F.lit(" Total Volume: "),
                F.floor("o_totalprice").cast("string"),
            ).alias("value"),
        )
    )
    broken = t.customer.select(site, F.lit("no reading Total Volume: -").alias("value"))
    k = F.col("n_nationkey")
    head = t.nation.select(
        k.alias("site"),
        F.explode(
            F.array(
                F.concat(F.lit("Site Id: "), (k + 1000).cast("string")),
                F.concat(F.lit("Site Lat/Long: "), (k + 50).cast("string"), F.lit(" "), (-0.5 - k).cast("string")),
                F.lit(""),
            )
        ).alias("value"),
    )
    head.unionByName(rows).unionByName(broken).write.partitionBy("site").text(path)
    return io.read_site_text(t.spark, f"{path}/site=*/").select(
        "site_id",
        F.col("latitude").cast("int").alias("latitude"),
        "longitude",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm").alias("timestamp"),
        "volume",
    )


@query(
    "src_filename_coord",
    """SELECT CASE WHEN o_orderstatus = 'O' THEN 3 WHEN o_orderstatus = 'F' THEN 6 ELSE 15 END AS realization,
              count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""",
)
def src_filename_coord(t: Tables):
    """Three members in files named by their number; one also has it as data."""
    path = scratch_path(t.spark, "members")
    opened, filled = (F.col("o_orderstatus").eqNullSafe(s) for s in ("O", "F"))
    for rows, member in ((opened, 3), (filled, 6), (~opened & ~filled, 15)):
        part = t.orders.where(rows).select(
            "o_totalprice", F.when(F.lit(member == 15), F.lit(15)).cast("int").alias("realization")
        )
        part.write.parquet(f"{path}/run_{member:03d}")
    rows = t.spark.read.parquet(*[f"{path}/run_{m:03d}" for m in (3, 6, 15)])
    named = io.with_realization(rows, pattern=r"/run_(\d+)/")
    return named.groupBy("realization").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "src_constraint",
    "SELECT l_linenumber AS level, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total FROM lineitem WHERE l_linenumber IN (1, 3) GROUP BY 1",
)
def src_constraint(t: Tables):
    rows = io.read_parquet(
        t.spark, f"{t.folder}/lineitem.parquet", ["l_linenumber", "l_quantity"], F.col("l_linenumber").isin(1, 3)
    )
    return rows.groupBy(F.col("l_linenumber").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("total")
    )


@query(
    "src_places",
    """SELECT l_linenumber, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total FROM lineitem
       WHERE l_quantity BETWEEN 10 AND 14 AND l_extendedprice BETWEEN 12000 AND 20000 GROUP BY 1""",
)
def src_places(t: Tables):
    """Written in the order of two coordinates; a box of them is read."""
    path = scratch_path(t.spark, "places")
    zorder.write_places(t.lineitem.select("l_linenumber", "l_quantity", "l_extendedprice"), path, ["l_quantity", "l_extendedprice"])
    rows = zorder.read_box(t.spark, path, {"l_quantity": (10.0, 14.0), "l_extendedprice": (12000.0, 20000.0)})
    return rows.groupBy("l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("total"))


@query(
    "snk_table",
    """SELECT l_returnflag, year(l_shipdate) AS year, count(*) AS n, round(sum(l_extendedprice), 2) AS total
       FROM lineitem GROUP BY 1, 2""",
)
def snk_table(t: Tables):
    path = scratch_path(t.spark, "table")
    io.write_table(t.lineitem.withColumn("year", F.year("l_shipdate")), path, ["l_returnflag"], spread=8)
    return (
        t.spark.read.parquet(path)
        .groupBy("l_returnflag", "year")
        .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))
    )


@query(
    "snk_text",
    "SELECT vec_id, label, len(embedding) + 2 AS n_fields, round(list_sum(embedding::DOUBLE[]), 3) AS total FROM embeddings",
)
def snk_text(t: Tables):
    path = scratch_path(t.spark, "tsv")
    io.write_tsv(t.embeddings, path, ["vec_id", "label", "embedding"])
    parts = F.split("value", "\t")
    numbers = F.transform(F.slice(parts, 3, F.size(parts) - 2), lambda v: v.cast("float").cast("double"))
    return t.spark.read.text(path).select(
        parts[0].cast("long").alias("vec_id"),
        parts[1].cast("int").alias("label"),
        F.size(parts).alias("n_fields"),
        F.round(F.aggregate(numbers, F.lit(0.0), lambda s, v: s + v), 3).alias("total"),
    )


@query(
    "snk_stats",
    f"""WITH {FIELDS_SQL}
    SELECT 'q' AS feature, level, round(avg(q), 4) AS mean, round(stddev_pop(q), 4) AS std FROM fields GROUP BY level
    UNION ALL SELECT 'q', NULL, round(avg(q), 4), round(stddev_pop(q), 4) FROM fields
    UNION ALL SELECT 'w', level, round(avg(w), 4), round(stddev_pop(w), 4) FROM fields GROUP BY level
    UNION ALL SELECT 'w', NULL, round(avg(w), 4), round(stddev_pop(w), 4) FROM fields""",
)
def snk_stats(t: Tables):
    path = scratch_path(t.spark, "stats")
    io.write_statistics(aggregates.level_statistics(model_fields(t), "level", ["q", "w"]), path)
    return rounded(io.read_statistics(t.spark, path))


@query(
    "snk_labels",
    f"SELECT doc_id, quality, toxic, CASE WHEN {unit_sql('doc_id', seed=11)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM labels",
)
def snk_labels(t: Tables):
    """Both written sets together are the labels, each row once."""
    path = scratch_path(t.spark, "labels")
    io.write_label_sets(sampling.split_random(t.labels, ["doc_id"], 0.8, 11), path)
    train, test = (
        io.read_csv(t.spark, f"{path}/{part}", "doc_id long, quality int, toxic int").withColumn("part", F.lit(part)) for part in ("train", "test")
    )
    return train.unionByName(test)
