"""Hard negatives by threshold joins over inner products.

Anchors are compared with all rows in cells: a block of anchors and a block of
rows, both of bounded size. In a cell the rows have an inverted index: under
each group of dimensions stand the rows and their components in it, the
dimensions of most energy first. At a threshold a row is listed only as long
as the norm of its dimensions from there on reaches it; the rest is covered by
that bound, and a row that is short altogether is not listed at all. A search
adds up partial scores group by group, drops pairs that cannot reach the
threshold with the norms that remain, and scores what is left with whole
vectors. The threshold is lowered, and the index filled up, until every window
of an anchor is full or the threshold has passed its end. A cell reports at
most as many rows per window as are wanted; the best of all cells are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Components that a block of rows or anchors holds.
BLOCK = 1 << 18
#: Pairs of a cell that partial scores are held of at a time.
PAIRS = 1 << 20
#: Dimensions under one entry of the index.
GROUP = 16
#: Thresholds, as shares of the longest row; after the last one every row is taken.
LEVELS = [*(0.9 * 0.6**k for k in range(6)), -np.inf]


class Index:
    """Inverted index over the rows of a block, filled up as thresholds fall."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-np.square(vectors, dtype=np.float64).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order].astype(np.float64)
        self.groups = [slice(at, at + GROUP) for at in range(0, vectors.shape[1], GROUP)]
        #: norm of what a row has from each group on
        self.rest = self.norms(self.vectors)
        self.longest = float(self.rest[:, 0].max(initial=0.0))
        self.lists: list[tuple[np.ndarray, np.ndarray]] = []

    def norms(self, vectors: np.ndarray) -> np.ndarray:
        """Column k has the norms over group k and those behind it; the last one is zero."""
        parts = [np.square(vectors[:, g]).sum(axis=1) for g in self.groups]
        behind = np.cumsum(np.stack([*parts, np.zeros(len(vectors))], axis=1)[:, ::-1], axis=1)[:, ::-1]
        # a little longer, so that rounding cannot make a bound too small
        return np.sqrt(behind) * (1 + 1e-9)

    def lower(self, level: float) -> None:
        """List what can matter to a partner of norm one that has to reach ``level``."""
        self.lists = []
        rows = np.arange(len(self.vectors))
        for k, group in enumerate(self.groups):
            rows = rows[self.rest[rows, k] >= level]
            self.lists.append((rows, self.vectors[rows, group]))

    def candidates(self, queries: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row), by query, without any that cannot reach the
        query's threshold. No threshold may be below the level of the index
        times the query's norm."""
        queries = queries[:, self.order].astype(np.float64)
        mine = self.norms(queries)
        score = np.zeros((len(queries), len(self.vectors)))
        alive = mine[:, :1] * self.rest[:, 0] >= least[:, None]
        # scores carry the rounding of sums of this size
        spare = 1e-9 * mine[:, 0] * self.longest
        for k, (rows, values) in enumerate(self.lists):
            # a slice where all are listed, which spares copies
            at = slice(None) if len(rows) == len(self.vectors) else rows
            if not len(rows) or not alive[:, at].any():
                break
            score[:, at] += queries[:, self.groups[k]] @ values.T
            # rows that are not listed any more stay with the bound that they have met
            reach = mine[:, k + 1, None] * self.rest[rows, k + 1] + spare[:, None]
            alive[:, at] &= score[:, at] + reach >= least[:, None]
        return np.nonzero(alive)


def exact(one: np.ndarray, two: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of rows i of one with rows j of two, in whole numbers."""
    step = max(1, (1 << 22) // max(1, one.shape[1]))
    parts = [np.einsum("ij,ij->i", one[i[at : at + step]], two[j[at : at + step]]) for at in range(0, len(i), step)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


def best_in_windows(
    queries: np.ndarray, rows: np.ndarray, allowed, first: np.ndarray, windows: list[list[tuple[float, float]]], wanted: int
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each query and each of its windows (low, high): the first ``wanted``
    rows with a score from low to high, as (query, window, rows, scores).

    ``allowed(i, j)`` says which pairs count; higher scores come first, then
    the lower place in ``first``.
    """
    index = Index(rows)
    norms = np.sqrt(np.square(queries, dtype=np.float64).sum(axis=1))
    ends = np.array([min((low for low, _ in w), default=np.inf) for w in windows])
    tops = np.array([max((high for _, high in w), default=-np.inf) for w in windows])
    open_ = np.array([bool(w) for w in windows], dtype=bool)
    step = max(1, PAIRS // max(1, len(rows)))
    for share in LEVELS:
        if not open_.any():
            return
        least = np.maximum(share * index.longest * norms, ends) if share > 0 else ends
        # above the highest window there is nothing to find
        asked = np.flatnonzero(open_ & (least <= tops))
        index.lower(share * index.longest if share > 0 else -np.inf)
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            q, j = index.candidates(queries[some], least[some])
            i = some[q]
            right = allowed(i, j)
            i, j = i[right], j[right]
            scores = exact(queries, rows, i, j)
            right = scores >= least[i]
            i, j, scores = i[right], j[right], scores[right]
            starts = np.searchsorted(i, [*some, some[-1] + 1])
            for one, a, b in zip(some, starts, starts[1:]):
                found = [_first_in(j[a:b], scores[a:b], first, low, high, wanted) for low, high in windows[one]]
                if all(len(f[0]) == wanted or least[one] <= low for f, (low, _) in zip(found, windows[one])):
                    open_[one] = False
                    for k, (places, values) in enumerate(found):
                        yield int(one), k, places, values


def _first_in(rows, scores, first, low, high, wanted) -> tuple[np.ndarray, np.ndarray]:
    inside = np.flatnonzero((scores >= low) & (scores <= high))
    order = inside[np.lexsort((first[rows[inside]], -scores[inside]))][:wanted]
    return rows[order], scores[order]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lists = column.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _order(ids: pa.ChunkedArray, rows: np.ndarray) -> np.ndarray:
    """Place of each row by identifier, nulls last, then by row number."""
    known = ids.is_valid().to_numpy()
    number = ids.fill_null(0).to_numpy()
    order = np.lexsort((rows, number, ~known))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place


def _in_cell(width: int, wanted: int, negatives: bool):
    """The search of one cell, as a function of its anchors and its rows."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        number = rows["row"].to_numpy()
        one, two = (t["label"].to_numpy() for t in (anchors, rows))
        mine = anchors["row"].to_numpy()
        same = lambda i, j: (one[i] == two[j]) & (mine[i] != number[j])
        different = lambda i, j: one[i] != two[j]
        if negatives:
            slots = anchors["positives"].to_pylist()
            # 80 p <= 100 n <= 100 p in whole numbers
            windows = [[(-(-4 * s["score"] // 5), s["score"]) for s in x if s["score"] >= 0] for x in slots]
            names = [[s["slot"] for s in x if s["score"] >= 0] for x in slots]
        else:
            windows, names = [[(-np.inf, np.inf)]] * len(mine), [[0]] * len(mine)
        found = best_in_windows(
            _matrix(anchors["vector"], width), _matrix(rows["vector"], width), different if negatives else same,
            _order(rows["vec_id"], number), windows, wanted,
        )
        anchor, slot, place, score = [], [], [], []
        for i, k, places, values in found:
            anchor += [mine[i]] * len(places)
            slot += [names[i][k]] * len(places)
            place.append(places)
            score.append(values)
        at = np.concatenate([np.empty(0, dtype=np.int64), *place])
        columns = [
            pa.array(np.array(anchor, dtype=np.int64)), pa.array(np.array(slot, dtype=np.int32)), pa.array(number[at]),
            rows["vec_id"].combine_chunks().take(pa.array(at)), pa.array(np.concatenate([np.empty(0, dtype=np.int64), *score])),
        ]
        return pa.Table.from_arrays(columns, names=["anchor", "slot", "row", "vec_id", "score"])

    return run


def _blocks(n: int, width: int) -> int:
    return max(1, -(-n * max(1, width) // BLOCK))


def _search(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int, width: int, wanted: int, negatives: bool) -> DataFrame:
    """The first ``wanted`` rows of each (anchor, slot) over all cells."""
    a, b = _blocks(n_anchors, width), _blocks(n_rows, width)
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = anchors.withColumn("block", block(a)).withColumn("other", each(b)).withColumn("cell", F.col("block") * b + F.col("other"))
    right = rows.withColumn("block", block(b)).withColumn("other", each(a)).withColumn("cell", F.col("other") * b + F.col("block"))
    left, right = left.drop("block", "other"), right.drop("block", "other")
    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(
        lambda x, y: _in_cell(width, wanted, negatives)(x, y), "anchor long, slot int, row long, vec_id long, score long"
    )
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)


def whole_numbers(vector: Column) -> Column:
    """floor(256 x) of every component."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")).cast("long"))


def complete(vector: Column, label: Column) -> Column:
    """A label, a vector, and no component that is null, infinite or not a number."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return label.isNotNull() & vector.isNotNull() & ~F.exists(vector, odd)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has ``vec_id`` (long), ``label`` (int) and ``vector`` (array of
    whole numbers); incomplete rows must be gone. The positives of an anchor
    are its first other rows of the same label, by inner product, then by
    identifier (nulls last). For each, the first rows of other labels with a
    score between 80 % of the positive's and the positive's are the negatives.

    Repeated rows are rows of their own: they are each other's positives and
    come once each. Vectors of different lengths are filled up with zeros.
    Sums must stay below 2^63. An empty table gives no rows; an anchor without
    positives, and a positive without negatives, gives none.
    """
    rows = cut(vectors.select("vec_id", "label", "vector", is_anchor.alias("asked")).withColumn("row", F.monotonically_increasing_id()))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("a"), F.max(F.size("vector")).alias("width")).first()
    n, a, width = sizes["n"], sizes["a"], sizes["width"] or 0
    anchors = rows.where("asked").drop("asked")
    rows = rows.drop("asked")
    near = cut(_search(anchors, rows, a, n, width, positives, False))
    slots = near.groupBy(F.col("anchor").alias("row")).agg(
        F.collect_list(F.struct(F.col("rank").cast("int").alias("slot"), F.col("vec_id").alias("positive_id"), "score")).alias("positives")
    )
    asking = cut(anchors.join(slots, "row"))
    found = _search(asking, rows, a, n, width, negatives, True)
    # one row per anchor and positive
    named = asking.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.inline("positives")).withColumnRenamed("score", "positive_score")
    joined = found.join(named, ["anchor", "slot"])
    return joined.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
