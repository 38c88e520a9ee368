"""Tiles from run lengths against pixels."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skylattice.operators import tiles
from skylattice.session import materialise

HEIGHT = 23


def mask_of(runs):
    flat = np.zeros(HEIGHT * 40, dtype=bool)
    for start, n in runs:
        flat[start - 1 : start - 1 + n] = True
    return flat.reshape(40, HEIGHT)


def masks(seed):
    rng = np.random.default_rng(seed)
    out = {}
    for image in ("a", "b"):
        for label in ("fish", "sugar"):
            runs = [(int(rng.integers(1, 500)), int(rng.integers(1, 160))) for _ in range(rng.integers(1, 7))]
            out[image, label] = [*runs, (runs[0][0] + 2, runs[0][1])]
    out["whole", "fish"] = [(1, HEIGHT * 40)]
    out["thin", "fish"] = [(5, 3)]
    return out


def frame(spark, found, parts=1):
    rows = [(i, l, " ".join(f"{s} {n}" for s, n in runs), HEIGHT) for (i, l), runs in found.items()]
    rows += [("null", "fish", None, HEIGHT), ("empty", "fish", "", HEIGHT), (None, "fish", "1 500", HEIGHT), ("flat", "fish", "1 50", 0)]
    return spark.createDataFrame(rows, "image string, label string, rle string, h int").repartition(parts)


def legal(mask, size):
    n, m = mask.shape
    return {(x, y) for x in range(n - size + 1) for y in range(m - size + 1) if mask[x : x + size, y : y + size].all()}


@pytest.mark.parametrize("size", [1, 2, 3, 5, 8])
def test_origins(spark, size):
    """Erosion of the runs against looking at all pixels of all tiles."""
    found = masks(size)
    got = {}
    for r in tiles.origins(tiles.columns_of_runs(frame(spark, found), "rle", "h", "image", "label"), size).collect():
        got.setdefault((r.image, r.label), []).extend((r.x, y) for y in range(r.a, r.b + 1))
    for key, runs in found.items():
        mine = got.pop(key, [])
        assert len(mine) == len(set(mine)) and set(mine) == legal(mask_of(runs), size), key
    assert not got
    with pytest.raises(ValueError):
        tiles.origins(tiles.columns_of_runs(frame(spark, found), "rle", "h", "image", "label"), 0)


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def plain_choice(key, intervals, size, seed):
    """The rounds of one mask, origin by origin: cells propose, the least number wins."""
    out, turn = [], 0
    while intervals:
        s, proposals = seed + 3 * turn, []
        cells = {}
        for x, a, b in intervals:
            cells.setdefault((x // size, a // size), []).append((number(*key, x, a, b, s), x, a, b))
        for cell, found in cells.items():
            _, x, a, b = min(found)
            proposals.append((number(*key, *cell, s + 2), x, a + number(*key, *cell, s + 1) % (b - a + 1)))
        near = lambda p, q: abs(p[1] - q[1]) < size and abs(p[2] - q[2]) < size
        taken = [p for p in proposals if not any(q < p and near(p, q) for q in proposals)]
        out += [p[1:] for p in taken]
        rest = []
        for x, a, b in intervals:
            free = [y for y in range(a, b + 1) if not any(near((0, x, y), t) for t in taken)]
            for y in free:
                if rest and rest[-1][0] == x and rest[-1][2] == y - 1 and y - 1 in free:
                    rest[-1][2] = y
                else:
                    rest.append([x, y, y])
        intervals, turn = [tuple(r) for r in rest], turn + 1
    return out


@pytest.mark.parametrize("size, seed", [(4, 0), (5, 9)])
def test_tiles_anywhere(spark, size, seed):
    """Pure, apart, none can be added, the same for any partitioning, and those of the plain version."""
    found = masks(20 + seed)
    got = {}
    for r in tiles.place_tiles(frame(spark, found), "rle", "h", "image", "label", size, seed).collect():
        got.setdefault((r.image, r.label), []).append((r.x, r.y))
    again = tiles.place_tiles(frame(spark, found, 7), "rle", "h", "image", "label", size, seed).collect()
    assert sorted(map(tuple, again)) == sorted((*k, *p) for k, ps in got.items() for p in ps)
    assert ("thin", "fish") not in got and len(got) >= 3
    for key, runs in found.items():
        can, used = legal(mask_of(runs), size), np.zeros((40, HEIGHT), dtype=int)
        for x, y in got.get(key, []):
            assert (x, y) in can
            used[x : x + size, y : y + size] += 1
        assert used.max(initial=0) <= 1
        assert all(used[x : x + size, y : y + size].any() for x, y in can)
        columns = {}
        for x, y in sorted(can):
            columns.setdefault(x, []).append(y)
        intervals = []
        for x, ys in columns.items():
            for y in ys:
                if intervals and intervals[-1][0] == x and intervals[-1][2] == y - 1 and y % size:
                    intervals[-1][2] = y
                else:
                    intervals.append([x, y, y])
        assert sorted(plain_choice(key, [tuple(i) for i in intervals], size, seed)) == sorted(got.get(key, []))


def test_grid_tiles_count_pixels_once(spark):
    """Two runs over the same pixels do not fill a tile."""
    df = spark.createDataFrame([("im", "a", "1 2 1 2", 2), ("full", "a", "1 4", 2)], "image string, label string, rle string, h int")
    rows = tiles.columns_of_runs(df, "rle", "h", "image", "label")
    assert [tuple(r) for r in tiles.grid_tiles(rows, 2).collect()] == [("full", "a", 0, 0)]
    from skylattice.operators import sampling

    pixels = sampling.rle_pixels(df, "rle", "h", ["image", "label"])
    assert [r.image for r in sampling.pure_tiles(pixels, "image", "label", 2).collect()] == ["full"]


def test_no_masks(spark):
    none = frame(spark, {}).where(F.lit(False))
    assert tiles.place_tiles(none, "rle", "h", "image", "label", 3).count() == 0


def test_columns_are_dealt_and_cells_not_sent_to_all(spark):
    """A few bytes of runs stand for many columns, and a few of tiles for nine rows each."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    few = spark.createDataFrame([(i, "a", "1 4000", 4) for i in range(3)], "image long, label string, rle string, h int").repartition(1, "image", "label")
    columns = tiles.columns_of_runs(few, "rle", "h", "image", "label")
    assert columns.rdd.getNumPartitions() == n and columns.count() == 3000
    place = "image long, label string, cx long, cy long, x long, y long, n long"
    one = materialise(spark.createDataFrame([(1, "a", 0, 0, 0, 0, 5)], place))
    rows = materialise(spark.createDataFrame([(1, "a", 0, 0, 2, 0, 3)], place.replace("y long, n long", "a long, b long")))
    for met in (tiles._taken(one, 4), tiles._without(rows, one.drop("n"), 4)):
        met.collect()
        assert "Broadcast" not in met._jdf.queryExecution().executedPlan().toString()
