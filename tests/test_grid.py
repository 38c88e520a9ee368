"""Stencils, tiles and interpolation against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import grid, reshape, sampling


def table(spark, arrays, first=0):
    """Dense arrays (level, y, x) as a long table."""
    names = list(arrays)
    shape = arrays[names[0]].shape
    rows = [
        (first + k, j, i, *[float(arrays[n][k, j, i]) for n in names])
        for k in range(shape[0])
        for j in range(shape[1])
        for i in range(shape[2])
    ]
    return spark.createDataFrame(rows, "level int, y int, x int, " + ", ".join(f"{n} double" for n in names))


def dense(rows, column, shape, first=0):
    out = np.full(shape, np.nan)
    for r in rows:
        out[r["level"] - first, r["y"], r["x"]] = np.nan if r[column] is None else r[column]
    return out


@pytest.mark.parametrize("size", [1, 3, 64])
def test_halo_neighbours(spark, size):
    rng = np.random.default_rng(2)
    q = rng.normal(size=(3, 8, 9))
    df = table(spark, {"q": q}).where(~((F.col("level") == 1) & (F.col("y") == 4) & (F.col("x") == 4)))
    halo = grid.Halo(df, [], "y", "x", "level", size)
    halo.neighbour("x", {"q": "west"}, -1).neighbour("x", {"q": "east"}, 1)
    halo.neighbour("y", {"q": "south"}, -1).neighbour("level", {"q": "up"}, 1)
    rows = halo.finish("level", "y", "x", "west", "east", "south", "up").collect()
    assert len(rows) == q.size - 1
    hole = q.copy()
    hole[1, 4, 4] = np.nan

    def at(k, j, i):
        inside = 0 <= k < 3 and 0 <= j < 8 and 0 <= i < 9
        return hole[k, j, i] if inside else np.nan

    for r in rows:
        k, j, i = r["level"], r["y"], r["x"]
        for name, want in (("west", at(k, j, i - 1)), ("east", at(k, j, i + 1)), ("south", at(k, j - 1, i)), ("up", at(k + 1, j, i))):
            assert (r[name] is None and np.isnan(want)) or r[name] == want


def test_advection_against_a_loop(spark):
    rng = np.random.default_rng(3)
    shape = (6, 7, 8)
    q, u, v, w = (rng.normal(size=shape) for _ in range(4))
    h = grid.theta_level_heights(6)
    rows = grid.advection(table(spark, {"q": q, "u": u, "v": v, "w": w}), [], "level", "y", "x", h).collect()
    got = dense(rows, "advection", shape)
    want = np.zeros(shape)
    top = shape[0] - 1
    for k in range(shape[0]):
        for j in range(1, shape[1] - 1):
            for i in range(1, shape[2] - 1):
                up = min(k + 1, top)
                face_u = lambda a: (u[k, j, a] + u[up, j, a]) / 2
                face_v = lambda b: (v[k, b, i] + v[up, b, i]) / 2
                net = (face_u(i) * (q[k, j, i] - q[k, j, i - 1]) - face_u(i + 1) * (q[k, j, i + 1] - q[k, j, i])) / 1500
                net += (face_v(j) * (q[k, j, i] - q[k, j - 1, i]) - face_v(j + 1) * (q[k, j + 1, i] - q[k, j, i])) / 1500
                if 0 < k < top:
                    net += (w[k, j, i] + w[k - 1, j, i]) / 2 * (q[k, j, i] - q[k - 1, j, i]) / (h[k] - h[k - 1])
                if k < top - 1:
                    net -= (w[k, j, i] + w[k + 1, j, i]) / 2 * (q[k + 1, j, i] - q[k, j, i]) / (h[k + 1] - h[k])
                want[k, j, i] = net
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_constant_tiles(spark):
    q = np.zeros((1, 4, 4))
    q[0, 2:, 2:] = [[1, 2], [3, 9]]
    df = table(spark, {"q": q, "w": q * 2})
    got = {(r.tile_y, r.tile_x): r for r in grid.block_moments(df, ["level"], "y", "x", 2, "q").collect()}
    assert got[0, 0]["std"] == 0 and got[0, 0]["skew"] == 0
    cut = q[0, 2:, 2:]
    assert got[1, 1]["std"] == pytest.approx(cut.std())
    assert got[1, 1]["skew"] == pytest.approx((((cut - cut.mean()) / cut.std()) ** 3).mean())
    r = {(r.tile_y, r.tile_x): r.r for r in grid.block_correlation(df, ["level"], "y", "x", 2, "q", "w").collect()}
    assert r[0, 1] == 0.0 and r[1, 1] == pytest.approx(1.0)


def test_interpolation_is_linear_and_null_outside(spark):
    k, j, i = np.meshgrid(np.arange(3), np.arange(4), np.arange(5), indexing="ij")
    cells = table(spark, {"value": 2.0 * k - 3.0 * j + 0.5 * i + 1})
    points = [(0, 0.25, 1.5, 2.75), (1, 2.0, 3.0, 4.0), (2, 1.0, 2.0, 4.5), (3, -0.5, 1.0, 1.0), (4, 1.99, 0.0, 0.0)]
    sites = spark.createDataFrame(points, "id int, pz double, py double, px double")
    axes = {"pz": ("level", 0, 1), "py": ("y", 0, 1), "px": ("x", 0, 1)}
    got = {r.id: r.interpolated for r in grid.interpolate_sites(sites, cells, axes, "value").collect()}
    for n, z, y, x in points:
        if n in (2, 3):
            assert got[n] is None
        else:
            assert got[n] == pytest.approx(2 * z - 3 * y + 0.5 * x + 1)


def test_concatenation_refuses_equal_coordinates(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "x int, v double")
    assert reshape.concat_dimension([a.where("x = 1"), a.where("x = 2")], ["x"]).count() == 2
    with pytest.raises(Exception, match="duplicate coordinate"):
        reshape.concat_dimension([a, a], ["x"]).collect()


def test_run_lengths_against_numpy(spark):
    runs = [(3, 5), (20, 1), (31, 30)]
    text = " ".join(f"{s} {n}" for s, n in runs)
    df = spark.createDataFrame([("im", text, 10), ("empty", None, 10)], "image string, rle string, h int")
    for piece in (1, 7, 1000):
        got = {(r.x, r.y) for r in sampling.rle_pixels(df, "rle", "h", ["image"], piece).collect()}
        flat = np.zeros(70)
        for s, n in runs:
            flat[s - 1 : s - 1 + n] = 1
        assert got == {(int(x), int(y)) for x, y in np.argwhere(flat.reshape(7, 10) == 1)}


def test_pure_tiles(spark):
    pixels = spark.createDataFrame([("im", "a", x, y) for x in range(5) for y in range(4)], "image string, label string, x long, y long")
    got = {(r.tile_x, r.tile_y) for r in sampling.pure_tiles(pixels, "image", "label", 2).collect()}
    assert got == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_tiles_are_dealt_by_cells(spark, monkeypatch):
    """A partition of tiles holds about as many cells however many there are."""
    monkeypatch.setattr(grid, "CELLS", 1000)
    cells = spark.range(20_000).select(F.lit(0).alias("k"), (F.col("id") % 200).cast("int").alias("y"), F.floor(F.col("id") / 200).cast("int").alias("x"))
    halo = grid.Halo(cells, [], "y", "x", "k", 8)
    assert halo.df.rdd.getNumPartitions() == 20 and halo.finish("y", "x").distinct().count() == 20_000
