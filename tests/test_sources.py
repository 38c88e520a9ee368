"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from skylattice import sources
from skylattice.session import scratch_path
from skylattice.sources import readers


def test_site_text(spark):
    path = scratch_path(spark, "site")
    lines = [
        (7, "Site Id: 42"),
        (7, "Site Lat/Long: 50.5 -3.25"),
        (7, ""),
        (7, "2018-04-01T00:15:00 Total Volume: 12"),
        (7, "2018-04-01T00:30:00 Total Volume: none"),
        (7, "2018-13-01T00:30:00 Total Volume: 9"),
        (7, "garbage"),
    ]
    spark.createDataFrame(lines, "site int, value string").write.partitionBy("site").text(path)
    got = readers.read_site_text(spark, f"{path}/site=*/").collect()
    assert [(r.site_id, r.latitude, r.longitude, str(r.timestamp), r.volume) for r in got] == [
        (42, 50.5, -3.25, "2018-04-01 00:15:00", 12)
    ]


def test_filter_and_columns_reach_the_scan(spark):
    df = sources.read_parquet(spark, "/root/testdata/sf0.001/lineitem.parquet", ["l_linenumber"], F.col("l_quantity") > 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,10.0)" in plan
    assert "ReadSchema: struct<l_linenumber:int,l_quantity:double>" in plan


def test_partitioned_table(spark):
    path = scratch_path(spark, "parts")
    sources.write_table(spark.range(100).withColumn("k", F.col("id") % 3), path, ["k"], spread=2)
    back = spark.read.parquet(path)
    assert back.count() == 100
    plan = back.where("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan


def test_existing_output_is_not_overwritten(spark):
    path = scratch_path(spark, "once")
    sources.write_table(spark.range(3).toDF("id"), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sources.write_table(spark.range(3).toDF("id"), path)


def test_realization_prefers_the_data(spark):
    path = scratch_path(spark, "runs") + "_014"
    spark.createDataFrame([(None,), (3,)], "realization int").coalesce(1).write.parquet(path)
    got = sources.with_realization(spark.read.parquet(path), pattern=r"_(\d+)/[^/]*$").collect()
    assert sorted(r.realization for r in got) == [3, 14]
