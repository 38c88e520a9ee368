"""Trees of all folds at once against MLlib's, one by one."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from skylattice.operators import models, trees
from skylattice.operators.sampling import with_fold

SETS = {"one": ["a"], "several": ["a", "b", "zero", "c", "flat"]}


def _rows(spark, n, seed):
    """Many and few values, zeros of both signs, constants, rows that come twice; in one partition."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n) // 2, "a": rng.integers(1, 60, n) * 1.0, "b": rng.normal(size=n).round(3), "zero": 0.0, "flat": 4})
    pdf["c"] = np.where(rng.random(n) < 0.4, rng.choice([0.0, -0.0], n), rng.integers(-3, 4, n))
    pdf["y"] = 1000 + np.where(pdf.a > 20, 5.0, 0.0) + pdf.b * pdf.c + rng.normal(size=n)
    return spark.createDataFrame(pd.concat([pdf, pdf.iloc[::3]]), "id long, a double, b double, zero double, flat int, c double, y double").coalesce(1)


def _one_by_one(df, makes, folds, seed):
    rows = with_fold(df, ["id"], folds, seed, "__fold").toPandas()
    whole = df.sparkSession.createDataFrame(rows).coalesce(1)
    out = {}
    for s, columns in SETS.items():
        vec = models.with_vector(whole, columns)
        for m, make in makes.items():
            for f in range(folds):
                scored = make().fit(vec.where(F.col("__fold") != f)).transform(vec.where(F.col("__fold") == f))
                out[s, m, f] = RegressionEvaluator(labelCol="y", metricName="r2").evaluate(scored)
    return out


@pytest.mark.parametrize(("n", "cells"), [(300, trees.MOST_CELLS), (300, 1), (30_000, trees.MOST_CELLS)])
def test_all_folds_are_mllib_trees(spark, monkeypatch, n, cells):
    """Below and above the size of the sample for thresholds; one open node a pass."""
    makes = {
        "plain": lambda: models.regressor("tree", "y", maxDepth=3),
        "deep": lambda: models.regressor("tree", "y", maxDepth=5, maxBins=8, minInstancesPerNode=9, seed=3),
        "bound": lambda: models.regressor("tree", "y", maxDepth=4, minInfoGain=0.02, minWeightFractionPerNode=0.1),
        "stump": lambda: models.regressor("tree", "y", maxDepth=0),
    }
    df = _rows(spark, n, 5)
    want = _one_by_one(df, makes, 3, 8)
    monkeypatch.setattr(trees, "MOST_CELLS", cells)
    # a fit per fold, as it was
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda *_: pytest.fail("a tree is fitted by itself"))
    got = models.cross_validate(df, SETS, makes, "y", ["id"], 3, 8).collect()
    assert {(r.features, r.model, r.fold): r.r2 for r in got} == pytest.approx(want, abs=1e-9)


def test_passes_do_not_grow_with_folds(spark, monkeypatch):
    passes, added_up = [], trees._added_up
    monkeypatch.setattr(trees, "_added_up", lambda *a: passes.append(1) or added_up(*a))
    for folds in (2, 6):
        models.cross_validate(_rows(spark, 200, 6), SETS, {"tree": lambda: models.regressor("tree", "y", maxDepth=2)}, "y", ["id"], folds, 8)
    assert len(passes) == 4


def test_missing_numbers_are_errors(spark):
    df = _rows(spark, 100, 7)
    for bad in (None, float("nan"), float("inf")):
        for column in ("a", "y"):
            with pytest.raises(ValueError, match="null, NaN or infinity"):
                rows = df.withColumn(column, F.when(F.col("id") == 3, F.lit(bad)).otherwise(F.col(column)))
                models.cross_validate(rows, SETS, {"tree": lambda: models.regressor("tree", "y")}, "y", ["id"], 2, 8)


def test_weighted_trees_are_fitted_by_fold(spark):
    df = _rows(spark, 200, 9).withColumn("w", F.col("id") % 3 + 1.0)
    got = models.cross_validate(df, SETS, {"tree": lambda: models.regressor("tree", "y", "w", maxDepth=2)}, "y", ["id"], 2, 8)
    assert got.count() == 4
