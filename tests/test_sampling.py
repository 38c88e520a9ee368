"""Samples and splits: sizes, disjointness and repeatability."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skylattice.operators import features, reshape, sampling


@pytest.fixture(scope="module")
def df(spark):
    return spark.range(2000).select(
        "id", F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("label"), (F.col("id") % 37).alias("group")
    )


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(test=st.floats(0.01, 0.45), validation=st.floats(0.01, 0.45), seed=st.integers(0, 1000))
def test_stratified_sizes(df, test, validation, seed):
    sets = sampling.stratified_sets(df, "label", ["id"], test, validation, seed)
    got = {(r.label, r.part): r["count"] for r in sets.groupBy("label", "part").count().collect()}
    for label, n in (("rare", 200), ("common", 1800)):
        assert got.get((label, "test"), 0) == int(test * n)
        assert got.get((label, "validation"), 0) == int(validation * n)
        assert sum(v for (c, _), v in got.items() if c == label) == n


def test_choices_do_not_depend_on_partitioning(df):
    a = sampling.split_random(df, ["id"], 0.8, 3)
    b = sampling.split_random(df.repartition(3, "label"), ["id"], 0.8, 3)
    assert a.exceptAll(b).count() == 0
    share = a.where("part = 'train'").count() / 2000
    assert 0.76 < share < 0.84


def test_groups_stay_together(df):
    parts = sampling.split_by_group(df, ["group"], 0.7, 1).groupBy("group").agg(F.count_distinct("part").alias("n"))
    assert parts.where("n <> 1").count() == 0


def test_folds_cover_all(df):
    folds = sampling.with_fold(df, ["id"], 5, 2).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == set(range(5)) and sum(r["count"] for r in folds) == 2000


def test_replacement_draws(df):
    got = sampling.sample_with_replacement(df, ["id"], 500, 4)
    assert got.count() == 500 and got.select("draw").distinct().count() == 500
    assert got.select("id").distinct().count() < 500


def test_undersample_keeps_the_minority(df):
    got = sampling.undersample(df, "label", "rare", ["id"], 0.1, 7)
    n = {r.label: r["count"] for r in got.groupBy("label").count().collect()}
    assert n["rare"] == 200 and 100 < n["common"] < 260


def test_shuffle_is_a_permutation(df):
    got = reshape.shuffled(df, ["id"], 5)
    rows = got.select("id", "place").collect()
    assert sorted(r.place for r in rows) == list(range(2000))
    assert sum(r.id == r.place for r in rows) < 50


def test_masked_station(spark):
    stations = ["a", "b", "c"]
    df = spark.range(300).select(F.col("id").alias("time"), F.explode(F.array(*[F.lit(s) for s in stations])).alias("s")).withColumn("v", F.lit(2.0))
    got = features.mask_one_station(df, ["time"], "s", stations, ["v"], 1)
    assert got.groupBy("time").agg(F.sum(F.col("hidden").cast("int")).alias("n")).where("n <> 1").count() == 0
    assert got.where("hidden AND (v <> 0 OR target_v <> 2)").count() == 0
    assert got.where("hidden").select("s").distinct().count() == 3


def test_hash_buckets(df):
    b = df.select("id", features.hash_bucket(F.col("id")).alias("b"))
    assert {r.b for r in b.select("b").distinct().collect()} == set(range(10))


def test_known_words_far_from_the_end(spark):
    """The last known words of a text count wherever they stand."""
    far = "sun, moon " + "x " * 1000 + "star"
    df = spark.createDataFrame([(1, far), (2, "Moon!!sun  star " * 300), (3, "nothing"), (4, ""), (5, "x " * 600)], "id long, text string")
    vocab = spark.createDataFrame([("sun", 1), ("moon", 2), ("star", 3)], "word string, word_id int")
    got = {r.id: r.ids for r in features.bag_of_ids(df, "text", vocab, 4).collect()}
    assert got == {1: [1, 2, 3, 0], 2: [3, 2, 1, 3], 3: [0] * 4, 4: [0] * 4, 5: [0] * 4}
