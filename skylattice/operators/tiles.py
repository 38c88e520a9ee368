"""Tiles of one label, placed anywhere in an image, from run lengths.

A mask is a list of runs down the columns of an image. Runs are kept as
intervals per column and never written out as pixels:

1. *Erosion.* A tile of side s can begin at the rows of a column interval but
   its last s - 1; and at column x only if it can in s columns from x on. The
   intersection over s columns is built by doubling: over two, four, eight
   columns, and last over two overlapping stretches.
2. *Choice.* Origins are seen in cells of side s. In a round every cell
   proposes one of its origins and the proposal of the least keyed number among
   all it would overlap is taken. Origins that would overlap a taken tile are
   cut out of the intervals. Rounds go on until no origin is left, so no tile
   can be added to the result.

All numbers are keyed by image, label, place and round: the tiles do not
depend on how the rows are spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import keyed_number, run_lengths
from ..session import materialise

KEY = ["image", "label"]


def columns_of_runs(df: DataFrame, encoded: str, height: str, image: str, label: str) -> DataFrame:
    """Run-length masks ("start length ...", 1-based, down the columns) as
    intervals (image, label, x, a, b) of rows a to b. Runs that overlap or
    touch become one, so every pixel counts once. A null image or label has no
    interval."""
    runs = df.select(F.col(image).alias("image"), F.col(label).alias("label"), F.col(height).cast("long").alias("h"), F.explode(run_lengths(F.col(encoded))).alias("r"))
    runs = runs.where((F.col("r.length") > 0) & (F.col("h") > 0) & F.col("image").isNotNull() & F.col("label").isNotNull())
    first, last = F.col("r.start") - 1, F.col("r.start") + F.col("r.length") - 2
    runs = runs.withColumns({"first": first, "last": last})
    runs = runs.withColumn("x", F.explode(F.sequence(F.floor(F.col("first") / F.col("h")), F.floor(F.col("last") / F.col("h")))))
    a = F.greatest(F.col("first") - F.col("x") * F.col("h"), F.lit(0).cast("long"))
    b = F.least(F.col("last") - F.col("x") * F.col("h"), F.col("h") - 1)
    columns = runs.select(*KEY, F.col("x").cast("long").alias("x"), a.alias("a"), b.alias("b"))
    # a few bytes of runs can be very many columns: these are dealt, not the masks
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return merged(columns.repartition(n, *KEY, "x"))


def merged(rows: DataFrame) -> DataFrame:
    """Intervals of a column that overlap or touch, as one."""
    along = Window.partitionBy(*KEY, "x").orderBy("a", "b")
    reach = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.coalesce(F.col("a") <= reach + 1, F.lit(False)), 0).otherwise(1)
    part = F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0))
    numbered = rows.withColumn("new", new).withColumn("part", part)
    return numbered.groupBy(*KEY, "x", "part").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("part")


def _both(rows: DataFrame, step: int) -> DataFrame:
    """Intervals at x that hold at x and at x + step."""
    pairs = rows.unionByName(rows.withColumn("x", F.col("x") - step))
    edge = F.array(F.struct(F.col("a").alias("y"), F.lit(1).alias("d")), F.struct((F.col("b") + 1).alias("y"), F.lit(-1).alias("d")))
    edges = pairs.select(*KEY, "x", F.inline(edge))
    along = Window.partitionBy(*KEY, "x").orderBy("y", "d")
    # intervals of one column are apart, so two at a place are of both columns
    seen = edges.withColumns({"n": F.sum("d").over(along.rowsBetween(Window.unboundedPreceding, 0)), "next": F.lead("y").over(along)})
    return seen.where((F.col("n") == 2) & (F.col("y") < F.col("next"))).select(*KEY, "x", F.col("y").alias("a"), (F.col("next") - 1).alias("b"))


def origins(intervals: DataFrame, size: int) -> DataFrame:
    """Where tiles of side ``size`` can begin, as intervals (image, label, x, a, b)."""
    if size < 1:
        raise ValueError("a tile has a side of one pixel or more")
    rows = intervals.withColumn("b", F.col("b") - (size - 1)).where(F.col("a") <= F.col("b"))
    width = 1
    while 2 * width <= size:
        rows, width = _both(rows, width), 2 * width
    return _both(rows, size - width) if width < size else rows


def grid_tiles(intervals: DataFrame, size: int) -> DataFrame:
    """Tiles (image, label, tile_x, tile_y) of a fixed grid that one label
    fills, from the lengths of the intervals in them."""
    cells = _in_cells(intervals, size)
    pixels = F.sum(F.col("b") - F.col("a") + 1)
    full = cells.groupBy(*KEY, F.col("cx").alias("tile_x"), F.col("cy").alias("tile_y")).agg(pixels.alias("n"))
    return full.where(F.col("n") == size * size).drop("n")


def _in_cells(rows: DataFrame, size: int) -> DataFrame:
    """Intervals cut at the borders of cells, with the cell (cx, cy)."""
    cells = rows.withColumn("cy", F.explode(F.sequence(F.floor(F.col("a") / size), F.floor(F.col("b") / size))))
    low, high = F.greatest("a", F.col("cy") * size), F.least(F.col("b"), F.col("cy") * size + (size - 1))
    return cells.withColumns({"a": low, "b": high, "cx": F.floor(F.col("x") / size)})


def _around(rows: DataFrame, names: tuple[str, str] = ("cx", "cy")) -> DataFrame:
    """Each row in its own cell and the eight around it."""
    near = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = rows.withColumn("near", F.explode(near))
    return spread.withColumns({c: F.col(c) + F.col(f"near.{d}") for c, d in zip(names, ("dx", "dy"))}).drop("near")


def _by_cell(rows: DataFrame, near: DataFrame, how: str = "inner") -> DataFrame:
    """Rows beside what is near their cell. The written rows of ``near`` take
    few bytes and stand for nine each, so Spark would send them to all tasks
    through the driver; both sides are shuffled instead."""
    return rows.join(near.hint("merge"), [*KEY, "cx", "cy"], how)


def _overlap(x: Column, y: Column, other_x: Column, other_y: Column, size: int) -> Column:
    return (F.abs(x - other_x) < size) & (F.abs(y - other_y) < size)


def _proposals(rows: DataFrame, size: int, seed: int) -> DataFrame:
    """One origin of each cell: an interval by keyed number, a row of it by another."""
    number = keyed_number(*KEY, "x", "a", "b", seed=seed)
    pick = F.min(F.struct(number.alias("n"), F.col("x").alias("x"), F.col("a").alias("a"), F.col("b").alias("b"))).alias("p")
    cells = rows.groupBy(*KEY, "cx", "cy").agg(pick).select(*KEY, "cx", "cy", "p.x", "p.a", "p.b")
    y = F.col("a") + keyed_number(*KEY, "cx", "cy", seed=seed + 1) % (F.col("b") - F.col("a") + 1)
    return cells.select(*KEY, "cx", "cy", "x", y.alias("y"), keyed_number(*KEY, "cx", "cy", seed=seed + 2).alias("n"))


def _taken(proposals: DataFrame, size: int) -> DataFrame:
    """Proposals that come before all others that they overlap."""
    others = _around(proposals.select(*KEY, "cx", "cy", F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("n").alias("on")))
    met = _by_cell(proposals, others)
    # cells are different where numbers are equal, so the place decides
    before = F.struct("on", "ox", "oy") < F.struct("n", "x", "y")
    lost = F.max((_overlap(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"), size) & before).cast("int"))
    return met.groupBy(*KEY, "cx", "cy", "x", "y").agg(lost.alias("lost")).where(F.col("lost") == 0).drop("lost")


def _without(rows: DataFrame, taken: DataFrame, size: int) -> DataFrame:
    """Intervals less the origins that would overlap a taken tile."""
    near = _around(taken.select(*KEY, "cx", "cy", F.col("x").alias("tx"), F.col("y").alias("ty")))
    # at most nine tiles are near a cell
    gathered = near.groupBy(*KEY, "cx", "cy").agg(F.array_sort(F.collect_set(F.struct("ty", "tx"))).alias("tiles"))
    met = _by_cell(rows, gathered, "left")
    close = F.filter("tiles", lambda t: F.abs(t["tx"] - F.col("x")) < size)
    close = F.coalesce(close, F.array().cast("array<struct<ty:bigint,tx:bigint>>"))
    # between one tile's reach and the next one's, in the order of rows
    starts = F.concat(F.array(F.col("a")), F.transform("close", lambda t: F.greatest(F.col("a"), t["ty"] + size)))
    ends = F.concat(F.transform("close", lambda t: F.least(F.col("b"), t["ty"] - size)), F.array(F.col("b")))
    left = met.withColumn("close", close).withColumn("part", F.explode(F.arrays_zip(starts.alias("a"), ends.alias("b"))))
    return left.where(F.col("part.a") <= F.col("part.b")).select(*KEY, "cx", "cy", "x", F.col("part.a").alias("a"), F.col("part.b").alias("b"))


def place_tiles(df: DataFrame, encoded: str, height: str, image: str, label: str, size: int, seed: int = 0) -> DataFrame:
    """Tiles (image, label, x, y) of side ``size`` that are wholly of one
    label and do not overlap; none can be added. x is the column and y the row
    of the first pixel.

    Rows of one image and label are one mask. A null mask, an empty one and
    one too narrow for a tile have none.
    """
    left = materialise(_in_cells(origins(columns_of_runs(df, encoded, height, image, label), size), size))
    found, turn = [], 0
    while not left.isEmpty():
        taken = materialise(_taken(materialise(_proposals(left, size, seed + 3 * turn)), size))
        found.append(taken.select(*KEY, "x", "y"))
        left = materialise(_without(left, taken, size))
        turn += 1
    if not found:
        return left.select(*KEY, "x", F.col("a").alias("y")).limit(0).withColumnsRenamed({"image": image, "label": label})
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnsRenamed({"image": image, "label": label})
