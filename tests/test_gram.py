"""Gram sums, intervals, Student's t and penalised splines against numpy."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from skylattice.operators import gram, models, splines


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(0)
    n = 400
    x, z = rng.normal(50, 10, n), rng.uniform(0, 1, n)
    y = 3 + 0.5 * x - 0.02 * x * x + 4 * z + rng.normal(0, 2, n)
    return x, z, y


@pytest.fixture(scope="module")
def df(spark, table):
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(*table))]
    rows += [(1000, None, 1.0, 2.0), (1001, 1.0, float("nan"), 2.0), (1002, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "id long, x double, z double, y double").repartition(5)


def terms():
    return {"x": F.col("x"), "squared": F.col("x") * F.col("x"), "z": F.col("z")}


def design(x, z):
    return np.column_stack([np.ones(len(x)), x, x * x, z])


def test_coefficients_and_intervals(df, table):
    """Estimates, errors, leverage and both intervals, by the matrices of the rows."""
    x, z, y = table
    a = design(x, z)
    inverse = np.linalg.inv(a.T @ a)
    b = inverse @ a.T @ y
    dof = len(y) - 4
    s2 = ((y - a @ b) ** 2).sum() / dof
    t = gram.student_t(0.975, dof)
    coefficients, rows = models.linear_terms(df, terms(), "y")
    for r, e, v in zip(coefficients.collect(), b, np.diag(inverse) * s2):
        assert (r["estimate"], r["se"], r["upper"]) == pytest.approx((e, math.sqrt(v), e + t * math.sqrt(v)), rel=1e-7)
    got = {r["id"]: r for r in rows.collect()}
    lever = np.einsum("ij,jk,ik->i", a, inverse, a)
    for i in range(0, 400, 7):
        fit = a[i] @ b
        want = (fit, y[i] - fit, lever[i], (y[i] - fit) / math.sqrt(s2 * (1 - lever[i])), fit - t * math.sqrt(s2 * lever[i]), fit + t * math.sqrt(s2 * (1 + lever[i])))
        assert tuple(got[i][c] for c in ("fit", "residual", "leverage", "standardised", "conf_lower", "pred_upper")) == pytest.approx(want, rel=1e-6)
    assert got[1000]["fit"] is None and got[1002]["residual"] is None and got[1002]["fit"] is not None


def test_sums_merge_and_part(df):
    """Folds add up to the whole, and the whole less a fold is the rest."""
    parted = df.withColumn("fold", (F.col("id") % 3).cast("int"))
    grams = gram.gram_sums(parted, terms(), F.col("y"), "fold")
    whole = gram.gram_sums(df, terms(), F.col("y"))[None]
    assert sorted(grams) == [0, 1, 2]
    assert (grams[0] + grams[1] + grams[2]).sums == pytest.approx(whole.sums, abs=1e-8)
    rest = gram.gram_sums(parted.where("fold <> 1"), terms(), F.col("y"))[None].fit().coefficients()[0]
    assert (whole - grams[1]).fit().coefficients()[0] == pytest.approx(rest, rel=1e-6)
    alone = gram.gram_sums(df.where("id < 1000"), {"z": F.col("z")}, F.col("y"))[None]
    assert whole.of(["z"]).fit().coefficients()[0] == pytest.approx(alone.fit().coefficients()[0], rel=1e-6)


def test_terms_that_others_make_up(df):
    double = gram.gram_sums(df, {"x": F.col("x"), "twice": 2 * F.col("x")}, F.col("y"))[None].fit()
    single = gram.gram_sums(df, {"x": F.col("x")}, F.col("y"))[None].fit()
    assert double.rest == pytest.approx(single.rest) and double.used == pytest.approx(2.0)
    with pytest.raises(ValueError):
        gram.gram_sums(df.limit(0), terms(), F.col("y"))


def test_folds_by_subtraction_are_single_fits(df):
    """The same r2 as a model fitted fold by fold."""
    clean = df.dropna().where(~F.isnan("z"))
    sets = {"one": ["x"], "two": ["x", "z"]}
    fast = models.cross_validate(clean, sets, {"linear": lambda: LinearRegression(labelCol="y", featuresCol="features")}, "y", ["id"], 4, 3)
    slow = models.cross_validate(clean, sets, {"linear": lambda: LinearRegression(labelCol="y", featuresCol="features", regParam=1e-12)}, "y", ["id"], 4, 3)
    key = lambda t: {(r["features"], r["fold"]): r["r2"] for r in t.collect()}
    assert key(fast) == pytest.approx(key(slow), rel=1e-6) and len(key(fast)) == 8


@pytest.mark.parametrize(
    "prob, dof, value",
    [(0.975, 1, 12.706204736), (0.975, 10, 2.2281388520), (0.95, 5, 2.0150483727), (0.9999999, 3, 222.5719), (0.995, 30, 2.7499956536), (0.5, 4, 0.0), (0.025, 10, -2.2281388520)],
)
def test_student_t(prob, dof, value):
    assert gram.student_t(prob, dof) == pytest.approx(value, rel=1e-5 if dof == 3 else 1e-9)


def test_student_t_near_the_normal():
    z = NormalDist().inv_cdf(0.975)
    for dof in (999, 1000, 1001, 10_000, 1e6, 1e8):
        assert gram.student_t(0.975, dof) == pytest.approx(z + (z**3 + z) / 4 / dof + (5 * z**5 + 16 * z**3 + 3 * z) / 96 / dof**2, abs=2e-7)
    for bad in ((0.0, 3), (1.0, 3), (0.5, 0)):
        with pytest.raises(ValueError):
            gram.student_t(*bad)


def test_normal_quantiles(spark):
    df = spark.createDataFrame([(i, float(v) if v is not None else None) for i, v in enumerate([3, 1, None, 2, 2])], "id long, v double")
    got = {r["id"]: r["normal"] for r in gram.with_normal_quantile(df, "v", ["id"]).collect()}
    q = lambda k: NormalDist().inv_cdf((k - 0.5) / 4)
    assert got == {0: pytest.approx(q(4)), 1: pytest.approx(q(1)), 2: None, 3: pytest.approx(q(2)), 4: pytest.approx(q(3))}


# --- penalised splines ---------------------------------------------------


def cardinal(u):
    near = abs(u - 2)
    return (4 - 6 * near**2 + 3 * near**3) / 6 if near < 1 else (2 - near) ** 3 / 6 if near < 2 else 0.0


@pytest.mark.parametrize("cyclic", [False, True])
def test_basis(spark, cyclic):
    """Columns add up to one, are B-splines, and a cyclic basis meets itself."""
    s = splines.Smooth("v", 7, cyclic)
    values = [0.0, 0.1, 2.5, 3.99, 4.0, -0.4 + 4.0] + ([4.1, -3.9] if cyclic else [])
    cols = splines.basis(s, 0.0, 4.0)
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", *[c.alias(n) for n, c in cols.items()]).collect()
    for r in rows:
        got = [r[n] for n in cols]
        assert sum(got) == pytest.approx(1)
        if cyclic:
            at = r["v"] / 4 * 7 % 7
            assert got == pytest.approx([cardinal((at - j) % 7) for j in range(7)])
        else:
            assert got == pytest.approx([cardinal(r["v"] / 4 * 4 - (j - 3)) for j in range(7)])
    if cyclic:
        by = {round(r["v"], 6): [r[n] for n in cols] for r in rows}
        assert by[0.0] == pytest.approx(by[4.0]) and by[0.1] == pytest.approx(by[4.1]) and by[0.1] == pytest.approx(by[-3.9])


@pytest.fixture(scope="module")
def waves(spark):
    rng = np.random.default_rng(3)
    n = 600
    x, day = rng.uniform(0, 10, n), rng.uniform(0, 365, n)
    y = np.sin(x) + 2 * np.cos(2 * np.pi * day / 365) + rng.normal(0, 0.3, n)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, day, y)], "x double, day double, y double").repartition(3)
    return df, x, day, y


SMOOTHS = [splines.Smooth("x", 12), splines.Smooth("day", 10, cyclic=True, low=0.0, high=365.0)]


def test_fixed_penalty_is_the_ridge_of_the_rows(waves):
    """The same fitted values as the penalised normal equations of all rows, solved whole."""
    df, x, day, y = waves
    model = splines.additive(df, SMOOTHS, "y", penalties=[0.7, 5.0])
    lo, hi = x.min(), x.max()
    b = [[cardinal((v - lo) / (hi - lo) * 9 - (j - 3)) for j in range(12)] + [cardinal((d / 365 * 10 - j) % 10) for j in range(10)] for v, d in zip(x, day)]
    a = np.column_stack([np.ones(len(y)), b])
    p = np.zeros((23, 23))
    p[1:13, 1:13], p[13:, 13:] = 0.7 * splines.roughness(SMOOTHS[0]), 5.0 * splines.roughness(SMOOTHS[1])
    want = a @ (np.linalg.pinv(a.T @ a + p, rcond=1e-12) @ a.T @ y)
    got = df.select("x", "day", model.predicted().alias("p")).collect()
    by = {(r["x"], r["day"]): r["p"] for r in got}
    assert [by[float(v), float(d)] for v, d in zip(x, day)] == pytest.approx(list(want), abs=1e-6)
    hat = a @ np.linalg.pinv(a.T @ a + p, rcond=1e-12) @ a.T
    assert model.fit.used == pytest.approx(np.trace(hat), abs=1e-5)
    assert model.fit.gcv() * model.gram.scale[-1] ** 2 == pytest.approx(len(y) * ((y - want) ** 2).sum() / (len(y) - np.trace(hat)) ** 2, rel=1e-5)


def test_chosen_penalty(waves):
    """No penalty of the list has a better score, the waves are found, and a straight line is taken for one."""
    df, x, day, y = waves
    model = splines.additive(df, SMOOTHS, "y")
    best = model.fit.gcv()
    for k in range(2):
        for p in splines.PENALTIES:
            other = [*model.penalties]
            other[k] = p
            assert model.gram.fit(splines.penalty_matrix(model.gram, SMOOTHS, other)).gcv() >= best - 1e-12
    scored = df.select("x", "day", model.predicted().alias("p")).collect()
    error = [(r["p"] - math.sin(r["x"]) - 2 * math.cos(2 * math.pi * r["day"] / 365)) ** 2 for r in scored]
    assert np.mean(error) < 0.02
    assert all(2 < f < 11 for _, _, f in model.freedom())
    line = splines.additive(df.withColumn("y", 3 * F.col("x") + F.pmod(F.xxhash64("x"), F.lit(1000)) / 500), [SMOOTHS[0]], "y")
    assert line.freedom()[0][2] < 2.5
