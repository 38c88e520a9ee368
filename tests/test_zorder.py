"""Tables in the order of their places."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.session import scratch_path
from skylattice.sources import zorder


def plain_key(steps, bits):
    key = 0
    for b in range(bits):
        for k, s in enumerate(steps):
            key |= (s >> b & 1) << (b * len(steps) + k)
    return key


def test_keys(spark):
    rng = random.Random(0)
    rows = [(rng.randrange(2**20), rng.randrange(2**20), rng.randrange(2**20)) for _ in range(50)]
    got = spark.createDataFrame(rows, "a long, b long, c long").select(zorder.interleaved([F.col(c) for c in "abc"]).alias("k"), "a", "b", "c").collect()
    assert all(r["k"] == plain_key((r["a"], r["b"], r["c"]), 20) for r in got)
    with pytest.raises(ValueError):
        zorder.interleaved([F.lit(1)] * 4)


@pytest.mark.parametrize("most", [1, 3, 10, 1000])
def test_ranges_hold_the_box(most):
    """All places of the box; exactly those if ranges are not limited."""
    rng = random.Random(most)
    for _ in range(60):
        n = rng.choice((1, 2, 3))
        box = [tuple(sorted((rng.randrange(16), rng.randrange(16)))) for _ in range(n)]
        inside = {plain_key(p, 4) for p in itertools.product(*[range(a, b + 1) for a, b in box])}
        got = zorder.ranges(box, 4, most)
        held = {k for a, b in got for k in range(a, b + 1)}
        assert inside <= held and len(got) <= most and all(b < c - 1 for (_, b), (c, _) in zip(got, got[1:]))
        if most == 1000:
            assert held == inside


def rows_scanned(df):
    """Rows that the scan handed on, as its own counter has it."""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return n, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_small_box_reads_few_row_groups(spark):
    rng = np.random.default_rng(1)
    n = 120_000
    table = [(i, float(a), float(b), "x" * 20) for i, (a, b) in enumerate(zip(rng.uniform(-90, 90, n), rng.uniform(0, 360, n)))]
    table += [(n, None, 5.0, "no latitude"), (n + 1, 90.0, 360.0, "corner")]
    df = spark.createDataFrame(table, "id long, lat double, lon double, note string")
    path = scratch_path(spark, "places")
    zorder.write_places(df, path, ["lat", "lon"], files=4, row_group_bytes=60_000)
    for box, share in (({"lat": (10.0, 14.0), "lon": (100.0, 108.0)}, 0.1), ({"lat": (-90.0, 90.0)}, 1.0), ({"lon": (359.9, 400.0)}, 0.3)):
        got = zorder.read_box(spark, path, box)
        want = df
        for c, (a, b) in box.items():
            want = want.where(F.col(c).between(a, b))
        found, scanned = rows_scanned(got)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect()) and found
        assert found <= scanned <= share * n + 2, (box, found, scanned)
    plan = zorder.read_box(spark, path, {"lat": (10.0, 14.0)})._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and zorder.KEY in plan.split("PushedFilters")[1]
    with pytest.raises(ValueError):
        zorder.read_box(spark, path, {"height": (0.0, 1.0)})
    assert got.columns == df.columns


def test_key_is_short(spark):
    """Few operations a row: an operation per bit made code that was not compiled."""
    steps = [F.col("a"), F.col("b")]
    assert str(zorder.interleaved(steps)).count("shiftright") <= 12
    df = spark.createDataFrame([(2**20 - 1, 0), (0, 2**20 - 1), (5, 9), (699050, 349525)], "a long, b long")
    plain = lambda p: sum((v >> i & 1) << 2 * i + k for k, v in enumerate(p) for i in range(20))
    got = df.select("a", "b", zorder.interleaved(steps).alias("key")).collect()
    assert [r.key for r in got] == [plain((r.a, r.b)) for r in got]
