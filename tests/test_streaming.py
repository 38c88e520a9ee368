"""Streaming forms against the batch result on the same rows."""

from pyspark.sql import functions as F

from skylattice.session import scratch_path
from skylattice.streaming import windows

FOLDER = "/root/testdata/sf0.001"


def run(spark, make, name):
    """Rows of the events table as a stream, driven to its end."""
    source = scratch_path(spark, "stream")
    batch = spark.read.parquet(f"{FOLDER}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    query = (
        make(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", scratch_path(spark, "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    return spark.table(name), batch


def test_counts(spark):
    got, batch = run(spark, lambda s: windows.windowed_counts(s, "ts", ["event_type"], "1 day", "1 hour"), "counts")
    want = batch.groupBy(F.date_trunc("day", "ts").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    assert got.select("start", "event_type", "n").exceptAll(want).count() == 0
    assert got.count() == want.count()


def test_means(spark):
    got, batch = run(spark, lambda s: windows.windowed_means(s, "ts", ["event_type"], "value", "7 days", "1 hour"), "means")
    total = got.agg(F.sum("n")).first()[0]
    assert total == batch.count()


def test_contingency(spark):
    make = lambda s: windows.windowed_contingency(
        s.withColumn("o", (F.col("event_type") == "purchase").cast("int")).withColumn("f", (F.col("value") > 50).cast("int")),
        "ts",
        "o",
        "f",
        "30 days",
        "1 hour",
    )
    got, batch = run(spark, make, "contingency")
    r = got.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).first()
    assert sum(r) == batch.count()
    assert r.tp == batch.where("event_type = 'purchase' AND value > 50").count()


def test_contingency_counts_nulls_as_no_event(spark):
    """The rule of the batch tables."""
    from skylattice.operators import verification

    rows = spark.createDataFrame([("2024-01-01", 1, 1), ("2024-01-02", None, 1), ("2024-01-03", 1, None)], "ts string, o int, f int").withColumn("ts", F.col("ts").cast("timestamp"))
    got = windows.windowed_contingency(rows, "ts", "o", "f", "30 days", "1 hour").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]).first()
    want = verification.contingency(rows, F.col("o") == 1, F.col("f") == 1).first()
    assert tuple(got) == tuple(want[c] for c in ("tp", "fp", "fn", "tn")) == (1, 1, 1, 0)


def test_fills_and_lags_with_late_rows(spark):
    """Files that come out of order, through a watermark, against the batch operators."""
    import numpy as np

    from skylattice.operators import timeseries
    from skylattice.streaming import series

    rng = np.random.default_rng(0)
    base = 1_700_000_000
    rows = []
    for i in range(240):
        # in files of 40, each up to 300 seconds out of order
        rows.append((i, ["a", "b"][int(rng.random() < 0.3)], base + 60 * i + int(rng.integers(-300, 300)), None if rng.random() < 0.5 else float(i)))
    rows.append((998, "a", base - 900_000, 1.0))  # in the last file: far too late
    rows.append((999, "a", base + 10_000_000, 9.0))  # moves the watermark past all others
    raw = "id long, k string, t long, v double"
    typed = lambda d: d.withColumn("t", F.timestamp_seconds("t"))
    source = scratch_path(spark, "late")
    for n in range(0, len(rows), 40):
        spark.createDataFrame(rows[n : n + 40], raw).coalesce(1).write.mode("append").parquet(source)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = typed(spark.readStream.schema(raw).option("maxFilesPerTrigger", 1).parquet(source))
        out = series.filled_and_lagged(stream, "k", "t", ["id"], "v", 2, 3, "15 minutes")
        query = out.writeStream.format("memory").queryName("filled").option("checkpointLocation", scratch_path(spark, "state")).trigger(availableNow=True).start()
        query.awaitTermination(300)
        got = {r["id"]: (r["filled"], r["lagged"]) for r in spark.table("filled").collect()}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    batch = typed(spark.createDataFrame([r for r in rows if r[0] < 998], raw))
    filled = timeseries.fill_forward(batch, ["k"], ["t", "id"], ["v"], 2).select("id", "v")
    lagged = timeseries.lagged(batch, ["k"], ["t", "id"], "v", 3, "before").select("id", "before")
    want = {r["id"]: (r["v"], r["before"]) for r in filled.join(lagged, "id").collect()}
    assert got == want
