"""Approximate nearest neighbours by p-stable hashing.

Each table hashes a row to the cell of a few random projections, cut in steps
of one width. Rows that are near fall in the same cell, or in a neighbouring
one, so a point also looks at the cells across the borders that it is nearest
to. What shares a cell in any table is compared exactly.

A cell with many reference rows is cut in blocks; a point looks at all of
them, so no task holds a cell of unbounded size and no row is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..ordered import attach
from ..session import materialise
from .pivot_tree import PAIR_SCHEMA, best, distances, matrix, meet, nearest_pairs

TABLES = 10
PROJECTIONS = 4
PROBES = 6
#: Rows that the width of a step is estimated from; they come to the driver.
SAMPLE = 400


class Projections:
    """Cells of all tables for a matrix of rows."""

    def __init__(self, dims: int, width: float, tables: int, projections: int, seed: int):
        rng = np.random.default_rng(seed)
        self.directions = rng.normal(size=(dims, tables * projections))
        self.offsets = rng.uniform(0, width, tables * projections)
        self.width, self.shape = width, (tables, projections)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """In steps: (row, table, projection)."""
        return ((rows @ self.directions + self.offsets) / self.width).reshape(len(rows), *self.shape)

    def cells(self, rows: np.ndarray) -> np.ndarray:
        return np.floor(self.places(rows)).astype(np.int64)

    def probes(self, rows: np.ndarray, probes: int) -> np.ndarray:
        """The own cell and those over the nearest borders: (row, table, probe, projection)."""
        places = self.places(rows)
        own = np.floor(places).astype(np.int64)
        below = places - own
        gaps = np.concatenate([below, 1 - below], axis=2)
        order = np.argsort(gaps, axis=2, kind="stable")[:, :, :probes]
        n = self.shape[1]
        out = np.repeat(own[:, :, None, :], order.shape[2] + 1, axis=2)
        row, table, probe = np.indices(order.shape)
        out[row, table, probe + 1, order % n] += np.where(order < n, -1, 1)
        return out


def step_width(refs: DataFrame, k: int, sample: int = SAMPLE) -> float:
    """Twice the median distance of sampled rows to the k-th of the sample,
    which is more than to the k-th of all; one for rows at a single place."""
    some = refs.orderBy(F.xxhash64("id")).limit(sample).select("features").toPandas()
    rows = matrix(some["features"])
    if len(rows) < 2:
        return 1.0
    d = np.sort(distances(rows, rows), axis=1)
    width = 2 * float(np.median(d[:, min(k, len(rows) - 1)]))
    return width or float(d.max()) or 1.0


def approximate_nearest(
    points: DataFrame, refs: DataFrame, k: int, rows: int, tables: int = TABLES, projections: int = PROJECTIONS, probes: int = PROBES, width: float | None = None, seed: int = 0
) -> DataFrame:
    """(id, neighbour, distance, rank) of the nearest refs found for each point
    (id, features, node); nodes of both tables must be equal. Distances are
    exact; with more ``tables`` or ``probes`` fewer neighbours are missed."""
    # of one place only the k lowest ids can matter
    place = F.row_number().over(Window.partitionBy("node", "features").orderBy("id"))
    refs = materialise(refs.withColumn("at", place).where(F.col("at") <= k).drop("at"))
    first = refs.select(F.size("features").alias("n")).first()
    if first is None:
        return points.sparkSession.createDataFrame([], PAIR_SCHEMA + ", rank int")
    tool = Projections(first["n"], width or step_width(refs, k), tables, projections, seed)

    def named(node: np.ndarray, cells: np.ndarray) -> list[str]:
        """Names of cells (row, table, ..., projection), the table in front."""
        flat = cells.reshape(len(cells), cells.shape[1], -1, cells.shape[-1])
        return [f"{n}|{t}|" + ",".join(map(str, c)) for n, row in zip(node, flat.tolist()) for t, probes in enumerate(row) for c in probes]

    def spread(probed: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for at in range(0, len(batch), 1000):
                    pdf = batch.iloc[at : at + 1000]
                    x = matrix(pdf["features"])
                    cells = tool.probes(x, probed) if probed else tool.cells(x)
                    each = cells.shape[1] * (cells.shape[2] if probed else 1)
                    again = pdf.iloc[np.repeat(np.arange(len(pdf)), each)]
                    yield pd.DataFrame({"id": again["id"].to_numpy(), "features": again["features"].to_numpy(), "node": named(pdf["node"].to_numpy(), cells)})

        return run

    shape = "id long, features array<double>, node string"
    held = materialise(refs.mapInPandas(spread(0), shape))
    crowd = materialise(held.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks")))
    block = lambda c: F.concat_ws("#", "node", c)
    held = attach(held, crowd, ["node"], "inner").withColumn("node", block(F.pmod(F.xxhash64("id"), F.col("blocks")))).drop("blocks")
    asked = attach(points.mapInPandas(spread(probes), shape), crowd, ["node"], "inner")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("node", block(F.col("block"))).drop("block", "blocks")

    def in_cell(some: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("id")
        return nearest_pairs(some["id"].to_numpy("int64"), matrix(some["features"]), cell["id"].to_numpy("int64"), matrix(cell["features"]), k)

    found = meet(materialise(asked), materialise(held), rows, in_cell, PAIR_SCHEMA)
    return best(found.distinct(), k)
