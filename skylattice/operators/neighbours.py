"""Nearest neighbours, and what is made of them.

Rows have an integer id and a feature array. A reference table of proven
small size is sent to every task. A larger one is searched through a tree of
pivots (``pivot_tree``), with the same result, or approximately through
hashed projections (``projections``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..ordered import OrderedRows, attach, index_rows
from ..session import materialise
from . import pivot_tree, projections
from .pivot_tree import PAIR_SCHEMA, matrix, nearest_pairs
from .sampling import hash_unit

#: Reference rows that are sent to every task, and bytes of their features.
MAX_BROADCAST_REFS = 20_000
MAX_BROADCAST_BYTES = 16_000_000
CELL_ROWS = 4_000


def _rooted(df: DataFrame, within: str | None) -> DataFrame:
    node = F.lit("all") if within is None else F.concat(F.lit("="), F.col(within).cast("string"))
    kept = df if within is None else df.where(F.col(within).isNotNull())
    return kept.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("features"), node.alias("node"))


def nearest(
    points: DataFrame,
    refs: DataFrame,
    k: int,
    exclude_self: bool = False,
    max_broadcast: int = MAX_BROADCAST_REFS,
    cell_rows: int = CELL_ROWS,
    within: str | None = None,
    method: str = "exact",
    **options,
) -> DataFrame:
    """The k nearest ``refs`` of each point: (id, neighbour, distance, rank).

    Both tables have columns ``id`` and ``features``, all of one length; ids
    are unique. Equal distances go to the smaller id. ``exclude_self`` leaves
    out the pair of equal ids. With ``within``, a column of both tables, only
    rows of equal values meet; a null meets nothing. ``method`` "hashed" looks
    only where projections fall together (``options`` are those of
    ``projections.approximate_nearest``): what it returns has true distances,
    but a neighbour can be missed.
    """
    if method not in ("exact", "hashed"):
        raise ValueError(f"method must be exact or hashed, not {method}")
    points, refs = _rooted(points, within), materialise(_rooted(refs, within))
    wanted, rows = k + 1 if exclude_self else k, max(cell_rows, 4 * (k + 1))
    if method == "hashed":
        pairs = projections.approximate_nearest(points, refs, wanted, rows, **options)
    else:
        size = refs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("features")), F.lit(0)).alias("numbers")).first()
        if size["n"] <= max_broadcast and 8 * size["numbers"] <= MAX_BROADCAST_BYTES:
            return _by_broadcast(points, refs, k, exclude_self)
        pairs = pivot_tree.search(pivot_tree.grow(refs, wanted, rows), materialise(points), wanted)
    if not exclude_self:
        return pairs
    return pivot_tree.best(pairs.drop("rank").where(F.col("id") != F.col("neighbour")), k)


def _by_broadcast(points: DataFrame, refs: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """Every task holds the refs; its points leave it with their final ranks,
    so nothing is shuffled."""
    held = refs.orderBy("node", "id").toPandas()  # bounded in rows and bytes by the caller
    parts = {node: (part["id"].to_numpy("int64"), matrix(part["features"])) for node, part in held.groupby("node")}
    sent = points.sparkSession.sparkContext.broadcast(parts)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, pdf in batch.groupby("node"):
                if node not in sent.value:
                    continue
                ids = pdf["id"].to_numpy("int64")
                pairs = nearest_pairs(ids, matrix(pdf["features"]), *sent.value[node], k + int(exclude_self))
                # the pairs of a point are together, nearest first
                pairs["__at"] = np.repeat(np.arange(len(ids)), len(pairs) // max(1, len(ids)))
                if exclude_self:
                    pairs = pairs[pairs["id"] != pairs["neighbour"]]
                pairs["rank"] = pairs.groupby("__at").cumcount().to_numpy("int32") + np.int32(1)
                yield pairs.loc[pairs["rank"] <= k, ["id", "neighbour", "distance", "rank"]]

    return points.mapInPandas(search, PAIR_SCHEMA + ", rank int")


def predict_by_neighbours(
    points: DataFrame, refs: DataFrame, label: str, k: int, classify: bool = True, exclude_self: bool = False
) -> DataFrame:
    """Distance-weighted vote (or mean) of the k nearest labelled refs.

    A neighbour at distance 0 counts alone. Equal votes go to the smaller
    label.
    """
    pairs = nearest(points, refs, k, exclude_self)
    # one ref may be near to most of the points
    near = attach(pairs, refs.select(F.col("id").alias("neighbour"), F.col(label).alias("label")), ["neighbour"], "inner")
    same = F.max((F.col("distance") == 0).cast("int")).over(Window.partitionBy("id"))  # k rows
    weight = F.when(same == 1, (F.col("distance") == 0).cast("double")).otherwise(1.0 / F.col("distance"))
    near = near.withColumn("weight", weight)
    if not classify:
        return near.groupBy("id").agg((F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("prediction"))
    votes = near.groupBy("id", "label").agg(F.sum("weight").alias("vote"))
    best = F.max_by("label", F.struct(F.round("vote", 9), -F.col("label")))
    return votes.groupBy("id").agg(best.alias("prediction"))


def smote(df: DataFrame, label: str, k: int, seed: int) -> DataFrame:
    """New minority rows between neighbours, until all classes are as large as
    the largest one. ``df`` has ``id``, ``features`` and an integer label; the
    new rows have (draw, label, features).

    A class's draws are numbered from 0. Numbers keyed by label and draw say
    which of its rows, in the order of ids, is taken, to which neighbour the
    new row goes, and how far. All classes are searched and drawn together.
    """
    rows = materialise(df.where(F.col(label).isNotNull()).select("id", F.col("features").cast("array<double>").alias("features"), label))
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    sizes = materialise(sizes.withColumn("need", F.max("size").over(Window.partitionBy(F.lit(0))) - F.col("size")))  # one row per class
    small = sizes.where(F.col("need") > 0)
    if alone := [r[label] for r in small.where(F.col("size") == 1).limit(20).collect()]:
        raise ValueError(f"no neighbour to go towards in classes of one row: {sorted(alone)}")
    members = materialise(attach(rows, small, [label], "inner"))
    pairs = materialise(nearest(members, members, k, exclude_self=True, within=label))
    numbered = OrderedRows(members.select("id", "features", label), [label], ["id"]).row_number("row_no").finish()
    unit = lambda n: hash_unit([label, "draw"], seed + n)
    draw = index_rows(small, F.col("need"), "draw").select(
        label, "draw",
        (F.floor(unit(0) * F.col("size")) + 1).alias("row_no"),
        (F.floor(unit(1) * F.least(F.lit(k), F.col("size") - 1)) + 1).cast("int").alias("rank"),
        unit(2).alias("u"),
    )
    based = draw.join(numbered, [label, "row_no"]).join(pairs.select("id", "rank", "neighbour"), ["id", "rank"])
    other = members.select(F.col("id").alias("neighbour"), F.col("features").alias("there"))
    towards = F.zip_with("features", "there", lambda a, b: a + F.col("u") * (b - a))
    return attach(based, other, ["neighbour"], "inner").select("draw", label, towards.alias("features"))


def edges(nodes: DataFrame, k: int, removed: DataFrame | None = None) -> DataFrame:
    """Directed edges to the k-1 nearest other nodes (a node is its own first
    neighbour), without removed (src, dst) pairs; weights have two decimals."""
    pairs = nearest(nodes, nodes, k).where(F.col("id") != F.col("neighbour"))
    out = pairs.select(F.col("id").alias("src"), F.col("neighbour").alias("dst"), F.round("distance", 2).alias("weight"))
    return out if removed is None else out.join(removed.select("src", "dst"), ["src", "dst"], "left_anti")


def sum_messages(edge: DataFrame, nodes: DataFrame, values: Sequence[str]) -> DataFrame:
    """One round of messages: each source node gets the sum of the features of
    the nodes its edges lead to; 0 for a node without edges."""
    sent = attach(edge, nodes.select(F.col("id").alias("dst"), *values), ["dst"], "inner")
    got = sent.groupBy(F.col("src").alias("id")).agg(*[F.sum(v).alias(f"sum_{v}") for v in values])
    return nodes.select("id").join(got, "id", "left").fillna(0.0, [f"sum_{v}" for v in values])


def distance_columns(features: Column, centres: Sequence[Sequence[float]]) -> list[Column]:
    """Distance of a feature array to each of a few fixed centres."""
    out = []
    for i, c in enumerate(centres):
        centre = F.array(*[F.lit(float(v)) for v in c])
        square = F.aggregate(F.zip_with(features, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
        out.append(F.sqrt(square).alias(f"distance_{i}"))
    return out
