"""Draws with replacement down a tree, and expectation-maximisation over groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import pooling, sampling


def counts(df, n, seed, rows):
    got = sampling.draw_counts(df, ["id"], n, seed, "drawn", rows).collect()
    return {r["id"]: r["drawn"] for r in got}


@pytest.mark.parametrize("rows", [10_000, 60, 3])
def test_exact_size_under_any_partitioning(spark, rows):
    """One chunk, a few chunks, and a tree of several levels."""
    df = spark.range(700).withColumn("kind", F.col("id") % 3)
    a = counts(df, 900, 5, rows)
    assert sum(a.values()) == 900 and all(v > 0 for v in a.values()) and set(a) <= set(range(700))
    assert counts(df.repartition(5, "kind"), 900, 5, rows) == a
    assert counts(df, 900, 6, rows) != a
    copies = sampling.resample(df, ["id"], 900, 5, rows)
    assert copies.columns == df.columns and {r["id"]: r["count"] for r in copies.groupBy("id").count().collect()} == a


def test_draws_are_even(spark):
    """Chi-square over rows and over chunks: neither too far off nor too near."""
    df, n = spark.range(400), 40_000
    got = counts(df, n, 1, 20)
    each = np.array([got.get(i, 0) for i in range(400)])
    chi = ((each - n / 400) ** 2 / (n / 400)).sum()
    # 399 degrees of freedom: five deviations to either side
    assert 399 - 5 * np.sqrt(2 * 399) < chi < 399 + 5 * np.sqrt(2 * 399)
    # variance over seeds of one row's count is that of a binomial
    first = [counts(df, 400, s, 20).get(7, 0) for s in range(12)]
    assert 0 < np.var(first) < 6


def test_awkward_draws(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (2, None)], "id long, v string")
    got = sampling.draw_counts(df, ["id"], 50, 3, "drawn", 1).collect()
    assert sum(r["drawn"] for r in got) == 50 and len(got) == 4
    assert sampling.draw_counts(df, ["id"], 0, 3).count() == 0
    assert sampling.draw_counts(df.limit(0), ["id"], 5, 3).count() == 0


def planted(seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(60):
        centre, spread = rng.normal(20, 3), rng.uniform(0.5, 4)
        rows += [(g, float(v)) for v in rng.normal(centre, spread, rng.integers(3, 40))]
    return [*rows, (100, 5.0), (101, 2.0), (101, 2.0), (102, None), (None, 20.0), (None, 21.0)]


def plain_rounds(rows, tolerance):
    """The same model by a loop over the groups."""
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    groups = {g: np.array(v) for g, v in groups.items() if len(v) > 1 and np.var(v) > 0}
    means = [v.mean() for v in groups.values()]
    centre, scatter = np.mean(means), np.var(means, ddof=1)
    unit, own = np.sqrt(scatter), {g: v.var(ddof=1) for g, v in groups.items()}
    for _ in range(500):
        state = {}
        for g, v in groups.items():
            unsure = 1 / (1 / scatter + len(v) / own[g])
            state[g] = (unsure * len(v) / own[g] * (v.mean() - centre), unsure)
        weights = {g: len(v) / own[g] for g, v in groups.items()}
        new = sum(weights[g] * (v.mean() - state[g][0]) for g, v in groups.items()) / sum(weights.values())
        spread = np.mean([m * m + u for m, u in state.values()])
        own = {g: np.mean((v - new - state[g][0]) ** 2) + state[g][1] for g, v in groups.items()}
        moved = max(abs(new - centre), abs(np.sqrt(spread) - np.sqrt(scatter)))
        centre, scatter = new, spread
        if moved <= tolerance * unit:
            break
    out = {}
    for g, v in groups.items():
        unsure = 1 / (1 / scatter + len(v) / own[g])
        out[g] = centre + unsure * len(v) / own[g] * (v.mean() - centre)
    return out, centre, np.sqrt(scatter)


def test_rounds_agree_with_a_plain_loop_and_find_what_was_planted(spark):
    rows = planted()
    got, rounds = pooling.pooled_means(spark.createDataFrame(rows, "g int, v double").repartition(4), "g", "v", 1e-3)
    want, centre, scatter = plain_rounds(rows, 1e-3)
    found = {r["g"]: r for r in got.collect()}
    assert {g: r["pooled"] for g, r in found.items()} == pytest.approx(want, rel=1e-6)
    assert rounds[-1] == pytest.approx((centre, scatter**2), rel=1e-6)
    assert abs(centre - 20) < 1.5 and abs(scatter - 3) < 1
    assert all(abs(r["pooled"] - centre) <= abs(r["mean"] - centre) + 1e-9 for r in found.values())
    empty, _ = pooling.pooled_means(spark.createDataFrame([(1, 1.0)], "g int, v double"), "g", "v")
    assert empty.count() == 0
