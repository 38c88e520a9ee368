"""Labelled grids in long form: one row per cell, dimensions as columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import correlation, virtual_potential_temperature
from ..ordered import attach
from ..session import materialise

# Normalised heights of the 70 theta levels and the model top.
ETA_THETA_LEVELS = [
    0.0002500, 0.0006667, 0.0012500, 0.0020000, 0.0029167, 0.0040000, 0.0052500, 0.0066667, 0.0082500, 0.0100000,
    0.0119167, 0.0140000, 0.0162500, 0.0186667, 0.0212500, 0.0240000, 0.0269167, 0.0300000, 0.0332500, 0.0366667,
    0.0402500, 0.0440000, 0.0479167, 0.0520000, 0.0562500, 0.0606667, 0.0652500, 0.0700000, 0.0749167, 0.0800000,
    0.0852500, 0.0906668, 0.0962505, 0.1020017, 0.1079213, 0.1140113, 0.1202745, 0.1267154, 0.1333406, 0.1401592,
    0.1471838, 0.1544313, 0.1619238, 0.1696895, 0.1777643, 0.1861929, 0.1950307, 0.2043451, 0.2142178, 0.2247466,
    0.2360480, 0.2482597, 0.2615432, 0.2760868, 0.2921094, 0.3098631, 0.3296378, 0.3517651, 0.3766222, 0.4046373,
    0.4362943, 0.4721379, 0.5127798, 0.5589045, 0.6112759, 0.6707432, 0.7382500, 0.8148403, 0.9016668, 1.0000000,
]
MODEL_TOP_M = 80000.0
CELL_SIZE_M = 1500.0
#: Cells of a partition of tiles, about.
CELLS = 50_000


def theta_level_heights(n: int = len(ETA_THETA_LEVELS)) -> list[float]:
    return [eta * MODEL_TOP_M for eta in ETA_THETA_LEVELS[:n]]


def tile_of(coordinate: str, size: int) -> Column:
    return F.floor(F.col(coordinate) / F.lit(size)).cast("int")


def with_tiles(df: DataFrame, y: str, x: str, size: int) -> DataFrame:
    return df.withColumn("tile_y", tile_of(y, size)).withColumn("tile_x", tile_of(x, size))


def block_moments(df: DataFrame, keys: Sequence[str], y: str, x: str, size: int, value: str) -> DataFrame:
    """Mean, population std and skewness per tile; no spread means skewness 0."""
    std = F.stddev_pop(value)
    return (
        with_tiles(df, y, x, size)
        .groupBy(*keys, "tile_y", "tile_x")
        .agg(
            F.avg(value).alias("mean"),
            std.alias("std"),
            F.when(std > 0, F.skewness(value)).otherwise(F.lit(0.0)).alias("skew"),
        )
    )


def block_correlation(df: DataFrame, keys: Sequence[str], y: str, x: str, size: int, a: str, b: str) -> DataFrame:
    """Correlation of two fields per tile, 0 where either is constant."""
    flat = (F.stddev_pop(a) == 0) | (F.stddev_pop(b) == 0)
    return (
        with_tiles(df, y, x, size)
        .groupBy(*keys, "tile_y", "tile_x")
        .agg(F.when(flat, F.lit(0.0)).otherwise(correlation(a, b)).alias("r"))
    )


def buoyant_rain(
    df: DataFrame,
    keys: Sequence[str],
    level: str,
    y: str,
    x: str,
    size: int,
    buoyancy: float = 0.0,
    cloud: float = 0.0,
    updraught: float = 0.0,
) -> DataFrame:
    """Tile mean of the rain that falls below buoyant cloudy updraughts.

    Columns: temperature, humidity, theta, cloud, w, rain. A column of air
    counts when any of its levels is more buoyant than the tile mean of that
    level, cloudy and rising, each by more than its threshold.
    """
    tiles = with_tiles(df, y, x, size).withColumn(
        "__tv", virtual_potential_temperature(F.col("temperature"), F.col("humidity"), F.col("theta"))
    )
    # at most size x size cells per tile and level
    mean_tv = F.avg("__tv").over(Window.partitionBy(*keys, "tile_y", "tile_x", level))
    event = (F.col("__tv") - mean_tv > buoyancy) & (F.col("cloud") > cloud) & (F.col("w") > updraught)
    columns = (
        tiles.withColumn("__event", event.cast("int"))
        .groupBy(*keys, "tile_y", "tile_x", y, x)
        .agg(F.max("__event").alias("__event"), F.max("rain").alias("__rain"))
    )
    return columns.groupBy(*keys, "tile_y", "tile_x").agg(F.avg(F.col("__event") * F.col("__rain")).alias("rain"))


def per_slice(df: DataFrame, dims: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Work on every sub-grid at once: one group per slice, no loop."""
    return df.groupBy(*dims).agg(*aggs)


class Halo:
    """Neighbour access on tiles that carry a one-cell border.

    Cells are copied to the tiles next to them (a few per cent of the rows),
    and then one shuffle by tile serves the neighbours along every axis. A
    long row of cells is never gathered in one task.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], y: str, x: str, level: str | None = None, size: int = 64):
        self.keys, self.y, self.x, self.level = list(keys), y, x, level

        def tiles(c: str) -> Column:
            spans = [F.floor((F.col(c) + d) / F.lit(size)).cast("int") for d in (0, -1, 1)]
            return F.array_distinct(F.array(*spans))

        self.home = (F.col("__ty") == tile_of(y, size)) & (F.col("__tx") == tile_of(x, size))
        df = materialise(df)
        spread = df.withColumn("__ty", F.explode(tiles(y))).withColumn("__tx", F.explode(tiles(x)))
        self.tile = [*self.keys, "__ty", "__tx"]
        # by cells and not by bytes: a task sorts its cells once per axis and way, and holds all of these
        parts = max(1, math.ceil(df.count() / CELLS))
        self.df = spread.repartition(parts, *self.tile)

    def neighbour(self, axis: str, columns: dict[str, str], step: int) -> "Halo":
        """Values one cell back (-1) or ahead (+1) along ``axis``; null when
        that cell is missing."""
        others = [c for c in (self.level, self.y, self.x) if c and c != axis]
        w = Window.partitionBy(*self.tile, *others).orderBy(axis)
        move = F.lag if step < 0 else F.lead
        there = move(F.struct(F.col(axis).alias("at"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])).over(w)
        df = self.df.withColumn("__n", there)
        close = F.col("__n.at") == F.col(axis) + step
        for i, out in enumerate(columns.values()):
            df = df.withColumn(out, F.when(close, F.col(f"__n._{i}")))
        self.df = df.drop("__n")
        return self

    def column(self, name: str, value: Column) -> "Halo":
        self.df = self.df.withColumn(name, value)
        return self

    def finish(self, *columns: str | Column) -> DataFrame:
        """The cells themselves, each once."""
        return self.df.where(self.home).select(*columns)


def gradient(
    df: DataFrame, keys: Sequence[str], level: str, y: str, x: str, value: str, heights: Sequence[float], first_level: int = 0
) -> DataFrame:
    """Differences to the cell before, per metre, along x, y and height."""
    halo = Halo(df, keys, y, x, level)
    for axis in (x, y, level):
        halo.neighbour(axis, {value: f"__b_{axis}"}, -1)
    h = F.array(*[F.lit(float(v)) for v in heights])
    here = F.col(level) - first_level
    dz = F.get(h, here) - F.get(h, here - 1)
    v = F.col(value)
    return halo.finish(
        *keys,
        level,
        y,
        x,
        ((v - F.col(f"__b_{x}")) / CELL_SIZE_M).alias("d_dx"),
        ((v - F.col(f"__b_{y}")) / CELL_SIZE_M).alias("d_dy"),
        ((v - F.col(f"__b_{level}")) / dz).alias("d_dz"),
    )


def advection(
    df: DataFrame,
    keys: Sequence[str],
    level: str,
    y: str,
    x: str,
    heights: Sequence[float],
    first_level: int = 0,
    field: str = "q",
    u: str = "u",
    v: str = "v",
    w: str = "w",
) -> DataFrame:
    """Net flux of a field carried by the wind: flux in minus flux out.

    Horizontal winds stand on the lower cell face half a level down; the face
    wind is the mean of this and the next level (the top level stands alone).
    Vertical faces use the mean of the two levels: the lower face counts for
    levels 1 to top-1, the upper face for levels 0 to top-2. Cells without all
    four horizontal neighbours get 0.
    """
    top = first_level + len(heights) - 1
    q = F.col(field)
    halo = Halo(df, keys, y, x, level)
    halo.neighbour(level, {field: "__q_up", u: "__u_up", v: "__v_up", w: "__w_up"}, 1)
    halo.neighbour(level, {field: "__q_dn", w: "__w_dn"}, -1)
    halo.column("__uf", (F.col(u) + F.coalesce("__u_up", u)) * 0.5)
    halo.column("__vf", (F.col(v) + F.coalesce("__v_up", v)) * 0.5)
    halo.neighbour(x, {field: "__q_w"}, -1).neighbour(x, {field: "__q_e", "__uf": "__uf_e"}, 1)
    halo.neighbour(y, {field: "__q_s"}, -1).neighbour(y, {field: "__q_n", "__vf": "__vf_n"}, 1)
    along_x = F.col("__uf") * (q - F.col("__q_w")) - F.col("__uf_e") * (F.col("__q_e") - q)
    along_y = F.col("__vf") * (q - F.col("__q_s")) - F.col("__vf_n") * (F.col("__q_n") - q)
    h = F.array(*[F.lit(float(m)) for m in heights])
    k = F.col(level)
    at = k - first_level
    below = (F.col(w) + F.col("__w_dn")) * 0.5 * (q - F.col("__q_dn")) / (F.get(h, at) - F.get(h, at - 1))
    above = (F.col(w) + F.col("__w_up")) * 0.5 * (F.col("__q_up") - q) / (F.get(h, at + 1) - F.get(h, at))
    flux_in = F.when((k > first_level) & (k < top), F.coalesce(below, F.lit(0.0))).otherwise(F.lit(0.0))
    flux_out = F.when(k < top - 1, F.coalesce(above, F.lit(0.0))).otherwise(F.lit(0.0))
    net = along_x / CELL_SIZE_M + along_y / CELL_SIZE_M + flux_in - flux_out
    return halo.finish(*keys, level, y, x, F.coalesce(net, F.lit(0.0)).alias("advection"))


def interpolate_sites(
    sites: DataFrame,
    grid: DataFrame,
    axes: dict[str, tuple[str, float, float]],
    value: str,
    out: str = "interpolated",
) -> DataFrame:
    """Value of a gridded field at given points, linear along every axis.

    ``axes`` maps a point column to (integer grid index column, origin, step).
    The cells that hold a point are asked for their corners, which are joined
    to the grid and laid side by side, so the points need a single equi-join on
    the cell they lie in and grid rows are never multiplied. A point outside
    the grid, or beside a missing corner, gets null.
    """
    names = list(axes)
    dims = [axes[n][0] for n in names]
    shifts: list[tuple[int, ...]] = [()]
    for _ in names:
        shifts = [(*s, d) for s in shifts for d in (0, 1)]

    cell_keys = [f"__c{i}" for i in range(len(dims))]
    corner_keys = [f"__d{i}" for i in range(len(dims))]
    placed = sites
    for i, n in enumerate(names):
        _, origin, step = axes[n]
        at = (F.col(n).cast("double") - F.lit(float(origin))) / F.lit(float(step))
        placed = placed.withColumn(f"__c{i}", F.floor(at).cast("long")).withColumn(f"__w{i}", at - F.floor(at))
    asked = F.array(
        *[
            F.struct(
                F.lit("".join(map(str, s))).alias("corner"),
                *[(F.col(c) + F.lit(o)).alias(d) for c, d, o in zip(cell_keys, corner_keys, s)],
            )
            for s in shifts
        ]
    )
    wanted = placed.select(*cell_keys).distinct().select(*cell_keys, F.inline(asked))
    values = grid.select(F.col(value).alias("__v"), *[F.col(d).cast("long").alias(k) for d, k in zip(dims, corner_keys)])
    corners = wanted.join(values, corner_keys).groupBy(*cell_keys).agg(
        *[F.max(F.when(F.col("corner") == "".join(map(str, s)), F.col("__v"))).alias(f"__v{''.join(map(str, s))}") for s in shifts]
    )
    # the corner table has one row per cell; a cell may hold most of the points
    joined = attach(placed, corners, cell_keys)
    total: Column = F.lit(0.0)
    for s in shifts:
        weight: Column = F.lit(1.0)
        for i, d in enumerate(s):
            weight = weight * (F.col(f"__w{i}") if d else 1.0 - F.col(f"__w{i}"))
        # a corner of weight 0 need not exist (points on the last grid line)
        total = total + F.when(weight == 0, F.lit(0.0)).otherwise(weight * F.col(f"__v{''.join(map(str, s))}"))
    return joined.withColumn(out, total).select(*sites.columns, out)
