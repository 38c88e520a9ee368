"""Exact nearest neighbours through a tree of pivots.

Reference rows lie in cells of bounded size, the leaves of a tree. A node with
too many rows is split among pivots, rows of its own: each row goes to the
nearest one. All distances are over all dimensions, so the tree works in many
as in few. Of every node the least and the greatest distance of its rows to
its pivot are kept (a ring); by the triangle inequality a point that is d away
from the pivot has no row of the node nearer than ``d - greatest`` or
``least - d``, and because the rows are nearer to their own pivot than to its
siblings, none nearer than the plane between the two.

A point first searches the cell it falls in, which bounds its k-th distance,
then goes down the tree again into all nodes that the bound does not rule out.
The cells found are searched best first in growing rounds, and the bound falls
with each round.

Nothing is sent to all tasks or to the driver: points meet pivots and cells by
a shuffle on the node, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..ordered import attach
from ..session import materialise

#: Children of a node at most.
FAN = 32
#: Pairs of a point and a reference row that distances are held of at a time.
PAIRS = 2_000_000
#: Bytes of features in a block of rows, where all rows meet all.
BLOCK_BYTES = 16_000_000
#: Points, about, that show how much of a tree is searched.
PROBES = 500
#: All rows meet all in blocks where the cells to be searched hold more than this share of the pairs.
MOST_SEARCHED = 0.1

PAIR_SCHEMA = "id long, neighbour long, distance double"


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype="float64") for v in column]) if len(column) else np.empty((0, 1))


def distances(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """All Euclidean distances, from the differences themselves."""
    out = np.empty((len(points), len(others)))
    step = max(1, PAIRS // max(1, others.size))
    for at in range(0, len(points), step):
        diff = points[at : at + step, None, :] - others[None, :, :]
        out[at : at + step] = np.sqrt((diff * diff).sum(axis=2))
    return out


def nearest_pairs(ids: np.ndarray, points: np.ndarray, ref_ids: np.ndarray, refs: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest refs of each point; equal distances keep the order of ``refs``."""
    if not len(ids) or not len(ref_ids):
        return pd.DataFrame({"id": pd.Series(dtype="int64"), "neighbour": pd.Series(dtype="int64"), "distance": pd.Series(dtype="float64")})
    take, near, dist = min(k, len(refs)), [], []
    norms, sizes = (refs * refs).sum(axis=1), (points * points).sum(axis=1)
    step = max(1, PAIRS // len(refs))
    for lo in range(0, len(points), step):
        some = points[lo : lo + step]
        if np.isfinite(norms).all() and np.isfinite(sizes[lo : lo + step]).all():
            at, far = _through_products(some, sizes[lo : lo + step], refs, norms, take)
        else:
            d = distances(some, refs)
            at = np.argsort(d, axis=1, kind="stable")[:, :take]
            far = np.take_along_axis(d, at, axis=1)
        near.append(at)
        dist.append(far)
    at, far = np.vstack(near), np.vstack(dist)
    return pd.DataFrame({"id": np.repeat(ids, take), "neighbour": ref_ids[at.ravel()], "distance": far.ravel()})


def _through_products(points: np.ndarray, sizes: np.ndarray, refs: np.ndarray, norms: np.ndarray, take: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the ``take`` nearest refs of each point.

    Squares of distances from a product of matrices are off by rounding. All
    refs that can be among the nearest within twice that error are measured
    again from the differences, so the result is that of ``distances``.
    """
    squares = norms - 2.0 * (points @ refs.T)
    error = 4 * (refs.shape[1] + 4) * np.finfo("float64").eps * (sizes + norms.max()) + np.finfo("float64").tiny
    last = np.partition(squares, take - 1, axis=1)[:, take - 1]
    i, j = np.nonzero(squares <= (last + 2 * error)[:, None])
    d, step = np.empty(len(i)), max(1, PAIRS // refs.shape[1])
    for lo in range(0, len(i), step):
        diff = points[i[lo : lo + step]] - refs[j[lo : lo + step]]
        d[lo : lo + step] = np.sqrt((diff * diff).sum(axis=1))
    order = np.lexsort((j, d, i))
    first = np.searchsorted(i, np.arange(len(points)))
    kept = order[first[:, None] + np.arange(take)]
    return j[kept], d[kept]


def meet(left: DataFrame, right: DataFrame, rows: int, each: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``each`` on the rows of both tables with one ``node``, at most about
    ``rows`` of the left ones at a time; the right ones are copied to each block.
    """
    crowd = materialise(left.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("copies")))
    salted = attach(left, crowd, ["node"], "inner").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("copies")).cast("int"))
    copied = attach(right, crowd, ["node"], "inner").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    one, two = salted.drop("copies").groupBy("node", "salt"), copied.drop("copies").groupBy("node", "salt")
    return one.cogroup(two).applyInPandas(lambda a, b: each(a, b) if len(a) and len(b) else each(a.iloc[:0], b.iloc[:0]), schema)


def best(pairs: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "neighbour"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


@dataclass
class Tree:
    """``cells`` (id, features, node) and the nodes (parent, node, pivot, low, high) above them."""

    cells: DataFrame
    nodes: DataFrame | None
    depth: int
    rows: int
    #: All rows in it (id, features, node of the root).
    refs: DataFrame | None = None
    #: (point, cell) pairs searched, and how many there are.
    visited: int = 0
    possible: int = 0
    rounds: list[int] = field(default_factory=list)


def grow(refs: DataFrame, k: int, rows: int) -> Tree:
    """A tree over ``refs`` (id, features, node); ``node`` names the root of each.

    Of refs at one place only the k of the lowest ids can be among anyone's k
    nearest; the others are left out, so a crowded place cannot keep a cell
    from being split.
    """
    place = F.row_number().over(Window.partitionBy("node", "features").orderBy("id"))
    # a limit per place, which Spark also applies before the shuffle
    members = whole = materialise(refs.withColumn("at", place).where(F.col("at") <= k))
    leaves, nodes, depth = [], [], 0
    while True:
        sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        big = materialise(sizes.where(F.col("n") > rows))
        if big.isEmpty():
            leaves.append(members)
            break
        split = attach(members, big, ["node"])
        leaves.append(split.where(F.col("n").isNull()).drop("n"))
        inner = split.where(F.col("n").isNotNull())
        wanted = F.least(F.greatest(F.ceil(2 * F.col("n") / rows), F.lit(2)), F.lit(FAN))
        pick = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("id", F.lit(depth)), "id"))
        # pivots at places of their own; again limited before the shuffle
        chosen = inner.where(F.col("at") == 1).withColumn("number", pick).where(F.col("number") <= FAN).where(F.col("number") <= wanted)
        pivots = materialise(chosen.select("node", "number", F.col("features").alias("pivot")))
        members = materialise(meet(inner.drop("n"), pivots, rows, _to_nearest, "id long, features array<double>, at int, parent string, node string, distance double"))
        ring = members.groupBy("parent", "node").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
        named = pivots.select(F.concat_ws("/", "node", "number").alias("node"), "pivot")
        nodes.append(materialise(ring.join(named, "node").select(F.col("parent").alias("above"), "node", "pivot", "low", "high")))
        members, depth = members.drop("parent", "distance"), depth + 1
    cells = leaves[0]
    for more in leaves[1:]:
        cells = cells.unionByName(more)
    above = None
    for level in nodes:
        above = level if above is None else above.unionByName(level)
    return Tree(materialise(cells.drop("at")), above, depth, rows, whole.drop("at"))


def _to_nearest(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    pivots = pivots.sort_values("number")
    d = distances(matrix(rows["features"]), matrix(pivots["pivot"])) if len(rows) else np.empty((0, 1))
    at = d.argmin(axis=1)
    child = rows["node"] + "/" + pivots["number"].astype(str).to_numpy()[at] if len(rows) else rows["node"]
    return pd.DataFrame(
        {"id": rows["id"], "features": rows["features"], "at": rows["at"], "parent": rows["node"], "node": child, "distance": d[np.arange(len(rows)), at]}
    )


def lower_bounds(points: np.ndarray, pivots: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to the pivots, and the least distance that a row of each child can have."""
    d = distances(points, pivots)
    bound = np.maximum(np.maximum(d - high, low - d), 0.0)
    apart = distances(pivots, pivots)
    for j in range(len(pivots)):
        # how far behind the plane between pivot j and the others a point is
        with np.errstate(divide="ignore", invalid="ignore"):
            behind = np.where(apart[j] > 0, (d * d - d[:, j : j + 1] ** 2) / (2 * apart[j]), 0.0)
        bound = np.maximum(bound, behind)
    # rounding must not rule a row out
    return d, bound * (1 - 1e-9) - 1e-12


def _down(bounded: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Children to go on to: the nearest pivot's, or all within the bound."""

    def run(rows: pd.DataFrame, children: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return rows[["id", "features", "node", "bound", "least"]]
        children = children.sort_values("child")
        pivots = matrix(children["pivot"])
        names, low, high = (children[c].to_numpy() for c in ("child", "low", "high"))
        parts = []
        step = max(1, PAIRS // pivots.size)
        for at in range(0, len(rows), step):
            some = rows.iloc[at : at + step]
            d, least = lower_bounds(matrix(some["features"]), pivots, low, high)
            least = np.maximum(least, some["least"].to_numpy()[:, None])
            if bounded:
                i, j = np.nonzero(least <= some["bound"].to_numpy()[:, None])
            else:
                i, j = np.arange(len(some)), d.argmin(axis=1)
            parts.append(some.iloc[i][["id", "features", "bound"]].assign(node=names[j], least=least[i, j]))
        return pd.concat(parts)[["id", "features", "node", "bound", "least"]]

    return run


_FRONT = "id long, features array<double>, node string, bound double, least double"


def _leaves(tree: Tree, front: DataFrame, bounded: bool) -> DataFrame:
    """Where the points of ``front`` (id, features, node, bound, least) come to at the leaves."""
    if tree.nodes is None:
        return front
    children = tree.nodes.withColumnsRenamed({"node": "child", "above": "node"})
    inner = materialise(children.select("node").distinct().withColumn("inner", F.lit(True)))
    there = None
    for level in range(tree.depth + 1):
        marked = attach(front, inner, ["node"])
        leaf = marked.where(F.col("inner").isNull()).drop("inner")
        there = leaf if there is None else there.unionByName(leaf)
        if level < tree.depth:
            front = materialise(meet(marked.where(F.col("inner").isNotNull()).drop("inner"), children, tree.rows, _down(bounded), _FRONT))
    return materialise(there)


def _searched(tree: Tree, front: DataFrame) -> float:
    """The share of all pairs that is in the cells a few of the points reach."""
    every = max(1, tree.visited // PROBES)
    few = materialise(front.where(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(every)) == 0))
    sizes = tree.cells.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    found = attach(_leaves(tree, few, True).select("node"), sizes, ["node"], "inner").agg(F.sum("n")).first()[0]
    roots = tree.refs.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    pairs = attach(few.select("node"), roots, ["node"], "inner").agg(F.sum("n")).first()[0]
    return found / pairs if found and pairs else 0.0


def search(tree: Tree, points: DataFrame, k: int) -> DataFrame:
    """The k nearest rows of each point (id, features, node of its root):
    (id, neighbour, distance, rank). ``tree`` counts the cells visited."""

    def in_cell(rows: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("id")
        return nearest_pairs(rows["id"].to_numpy("int64"), matrix(rows["features"]), cell["id"].to_numpy("int64"), matrix(cell["features"]), k)

    def look(visits: DataFrame) -> DataFrame:
        return meet(visits.select("id", "features", "node"), tree.cells, tree.rows, in_cell, PAIR_SCHEMA)

    def all_pairs() -> DataFrame:
        """Blocks of rows of one root, each with each."""
        width = tree.refs.agg(F.max(F.size("features"))).first()[0]
        block = max(tree.rows, BLOCK_BYTES // (8 * max(1, width)))
        parts = materialise(tree.refs.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts")))
        named = F.concat_ws("/", "node", "part")
        mine = attach(points.select("id", "features", "node"), parts, ["node"], "inner")
        mine = mine.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        theirs = attach(tree.refs, parts, ["node"], "inner").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        columns = [F.col("id"), F.col("features"), named.alias("node")]
        mine = materialise(mine.select(*columns))
        # blocks of points are less where they would be fewer than the tasks
        tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        most = min(block, max(tree.rows, mine.count() // tasks))
        return meet(mine, theirs.select(*columns), most, in_cell, PAIR_SCHEMA)

    start = points.select("id", "features", "node", F.lit(float("inf")).alias("bound"), F.lit(0.0).alias("least"))
    home = materialise(_leaves(tree, start, False).select("id", "features", F.col("node").alias("home")))
    found = materialise(best(look(home.withColumnRenamed("home", "node")), k))
    tree.visited = home.count()
    tree.possible = tree.visited * tree.cells.select("node").distinct().count()
    if tree.nodes is None:
        return found

    def bounds(pairs: DataFrame) -> DataFrame:
        full = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d"))
        return full.select("id", F.when(F.col("n") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("bound"))

    again = start.drop("bound").join(bounds(found), "id").select(*[F.col(c) for c in ("id", "features", "node", "bound", "least")])
    if _searched(tree, again) > MOST_SEARCHED:
        tree.visited = tree.possible
        return materialise(best(all_pairs(), k))
    reached = _leaves(tree, again, True).join(home.select("id", "home"), "id").where(F.col("node") != F.col("home"))
    left = materialise(reached.select("id", "features", "node", "least"))
    size = 1
    while not left.isEmpty():
        order = F.row_number().over(Window.partitionBy("id").orderBy("least", "node"))
        ordered = materialise(left.withColumn("turn", order))
        now = ordered.where(F.col("turn") <= size).drop("turn")
        tree.rounds.append(now.count())
        tree.visited += tree.rounds[-1]
        found = materialise(best(found.drop("rank").unionByName(look(now)), k))
        rest = ordered.where(F.col("turn") > size).drop("turn").join(bounds(found), "id")
        left = materialise(rest.where(F.col("least") <= F.col("bound")).drop("bound"))
        size *= 2
    return found
