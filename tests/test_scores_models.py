"""Scores against loops, models against known coefficients."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.functions import scalar, units
from skylattice.operators import models, splines, verification


def test_sweep_is_the_loop(spark):
    rng = np.random.default_rng(5)
    score = np.concatenate([rng.random(400), [0.001, 0.006, 0.001 + 0.005 * 57, 0.0, 1.0]])
    obs = rng.random(len(score)) < score
    df = spark.createDataFrame([(float(s), bool(o)) for s, o in zip(score, obs)], "s double, o boolean")
    got = verification.threshold_sweep(df, F.col("o"), F.col("s")).orderBy("threshold").collect()
    assert len(got) == 199
    for i, r in enumerate(got):
        above = score > 0.001 + i * 0.005
        h, f = (above & obs).sum() / obs.sum(), (above & ~obs).sum() / (~obs).sum()
        assert r.hit_rate == pytest.approx(h) and r.false_alarm_rate == pytest.approx(f)
        if 0 < h < 1 and 0 < f < 1:
            top = math.log(f) - math.log(h) - math.log(1 - f) + math.log(1 - h)
            assert r.sedi == pytest.approx(top / (math.log(f) + math.log(h) + math.log(1 - f) + math.log(1 - h)))
        else:
            assert r.sedi is None


def test_level_table_is_the_loop(spark):
    rng = np.random.default_rng(6)
    o, f = rng.integers(5, 70, 200), rng.integers(5, 70, 200)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(o, f)], "o int, f int")
    for r in verification.level_contingency(df, "o", "f").collect():
        p, q = o <= r.level, f <= r.level
        want = [(p & q).sum(), (~p & q).sum(), (p & ~q).sum(), (~p & ~q).sum()]
        if want[0] == 0 or want[1] == 0:
            want[0] += 1
            want[1] += 1
        assert [r.a, r.b, r.c, r.d] == want


def test_null_counts_as_no_event(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None)], "o int, f int")
    got = [r.result_category for r in verification.with_category(df, "o", "f").collect()]
    assert sorted(got) == ["falseNegative", "falsePositive", "trueNegative"]


def test_known_coefficients(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 2))
    y = 3 + 2 * x[:, 0] - 5 * x[:, 1]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    model = models.linear_regression(df, ["a", "b"], "y")
    got = {r.term: r.estimate for r in models.coefficients(spark, model, ["a", "b"]).collect()}
    assert got == pytest.approx({"intercept": 3.0, "a": 2.0, "b": -5.0}, abs=1e-6)


def test_student_t():
    # published table values
    assert models.student_t(0.975, 5) == pytest.approx(2.5706, abs=1e-4)
    assert models.student_t(0.975, 30) == pytest.approx(2.0423, abs=1e-4)
    assert models.student_t(0.975, 2000) == pytest.approx(1.9612, abs=1e-4)


def test_smooth_terms_follow_a_curve(spark):
    df = spark.range(300).select((F.col("id") / 50).alias("x"), (F.col("id") % 7 * 1.0).alias("z"))
    df = df.withColumn("y", F.sin("x") + 0.1 * F.col("z"))
    model = splines.additive(df, [splines.Smooth("x", 7)], "y", {"product": F.col("x") * F.col("z")})
    r2 = verification.r2_mse(df.withColumn("prediction", model.predicted()), F.col("y"), F.col("prediction")).first().r2
    assert r2 > 0.9


def test_partial_pooling_pulls_to_the_centre(spark):
    rng = np.random.default_rng(8)
    rows = [(g, float(v)) for g, m, n in ((0, 0.0, 100), (1, 5.0, 100), (2, 10.0, 3)) for v in rng.normal(m, 4, n)]
    got = {r.g: r for r in models.partial_pool(spark.createDataFrame(rows, "g int, v double"), "g", "v").collect()}
    centre = np.mean([r["mean"] for r in got.values()])
    for r in got.values():
        assert abs(r.pooled - centre) <= abs(r["mean"] - centre)


def test_bootstrap_weights_average_one(spark):
    w = spark.range(5000).select(models.bootstrap_weight(["id"], 3).alias("w")).agg(F.avg("w"), F.var_pop("w")).first()
    assert w[0] == pytest.approx(1, abs=0.05) and w[1] == pytest.approx(1, abs=0.1)


def test_permutation_ranks_the_used_column_first(spark):
    rng = np.random.default_rng(10)
    rows = [(i, float(a), float(b), float(4 * a)) for i, (a, b) in enumerate(rng.random((500, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double")
    model = models.linear_regression(df, ["a", "b"], "y")
    got = models.permutation_importance(df, model, ["a", "b"], "y", ["id"], 3).collect()
    assert [r.feature for r in got] == ["a", "b"] and got[0].importance > 0.5 and abs(got[1].importance) < 1e-6


def test_unlike_units_do_not_add(spark):
    df = spark.createDataFrame([(280.0, 1000.0)], "t double, p double")
    df = units.set_unit(units.set_unit(df, "t", "K"), "p", "Pa")
    with pytest.raises(ValueError, match="units differ"):
        units.combine(df, "t", "p", "+", "x")
    with pytest.raises(ValueError, match="cannot convert"):
        units.convert_unit(df, "t", "Pa")
    out = units.convert_unit(df, "t", "celsius")
    assert units.unit_of(out, "t") == "celsius" and out.first().t == pytest.approx(6.85)


def test_label_needs_two_parts(spark):
    df = spark.createDataFrame([("a.jpg_Fish",)], "s string")
    image, label = scalar.split_label(F.col("s"))
    assert tuple(df.select(image, label).first()) == ("a.jpg", "Fish")
    bad = spark.createDataFrame([("a_b_c",)], "s string")
    with pytest.raises(Exception, match="two parts"):
        bad.select(image, label).collect()


def test_dates_far_away_wrap(spark):
    from skylattice.operators import tables

    df = spark.createDataFrame([(0.0, 190.0), (0.0, -170.0), (0.0, 10.0)], "lat double, lon double")
    assert tables.region_box(df, "lat", "lon", -1, 1, -175, -165).count() == 2
    assert tables.region_box(df, "lat", "lon", -1, 1, 170, -165).count() == 2


def test_replicas_carry_what_a_fit_reads(spark):
    from pyspark.ml import Pipeline

    from skylattice.operators import models

    tree = models.regressor("tree", "y", "__w", maxDepth=2)
    columns = ["id", "features", "y", "flag", "more"]
    assert models._read_by(tree, columns, ["id"]) == ["id", "features", "y"]
    assert models._read_by(Pipeline(stages=[tree]), columns, ["id"]) == columns
