"""Regression trees of all feature sets and folds, grown together.

MLlib fits one tree at a time and goes through the rows several times for each.
Cross-validation fits a tree per feature set, model and fold to nearly the same
rows. Here all of them grow level by level, and a level costs one pass: every
task adds up count, sum and sum of squares of the answer by open node, fold and
interval between thresholds. What a tree learns from is all folds but its own;
its own fold is scored from the same sums. Trees that are split alike so far
are counted once.

Thresholds, gains and stops follow MLlib's ``DecisionTreeRegressor``; so does
the sample that the thresholds come from, at most the larger of 10,000 rows and
the square of ``maxBins`` on average, whatever the size of the table.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Hashable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that MLlib draws for the thresholds at least.
THRESHOLD_ROWS = 10_000
#: Cells of sums that a task holds in a pass; more open nodes take more passes.
MOST_CELLS = 1 << 20
#: Rows that are added up at a time.
BLOCK = 1 << 16
EPSILON = float(np.finfo("float64").eps)


@dataclass
class Tree:
    """A tree so far. Node i goes on to ``child[i]``, or the node after it where
    column ``feature[i]`` is above ``cut[i]``; -1 has no split."""

    key: Hashable
    held: int
    columns: list[int]
    model: DecisionTreeRegressor
    cuts: list[np.ndarray]
    n: int
    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[float] = field(default_factory=lambda: [0.0])
    child: list[int] = field(default_factory=lambda: [-1])
    open: list[int] = field(default_factory=lambda: [0])
    #: Squared errors of the rows held out, as far as they are in leaves.
    rest: float = 0.0

    def shape(self) -> tuple:
        return tuple(self.feature), tuple(self.cut), tuple(self.open)

    def close(self, seen: np.ndarray, held: np.ndarray) -> None:
        """Score the held-out rows of a leaf by the mean of those seen."""
        mean = seen[1] / seen[0]
        self.rest += held[2] - 2 * mean * held[1] + mean * mean * held[0]

    def grow(self, node: int, level: int, sums: dict[int, np.ndarray], union: list[np.ndarray]) -> None:
        """Split a node, or make it a leaf. ``sums`` are by column: (count, sum, squares) by fold by interval."""
        last = self.model.getMaxDepth()
        whole = sums[self.columns[0]].sum(axis=2)
        held, seen = whole[:, self.held], np.delete(whole, self.held, axis=1).sum(axis=1)
        best = self._best_split(sums, union) if level < last else None
        if best is None:
            self.close(seen, held)
            return
        at, threshold, left, left_held = best
        first = len(self.feature)
        self.feature[node], self.cut[node], self.child[node] = at, threshold, first
        for side, (part, part_held) in enumerate([(left, left_held), (seen - left, held - left_held)]):
            self.feature.append(-1)
            self.cut.append(0.0)
            self.child.append(-1)
            if level + 1 == last or abs(_variance(part)) < EPSILON:
                self.close(part, part_held)
            else:
                self.open.append(first + side)

    def _best_split(self, sums: dict[int, np.ndarray], union: list[np.ndarray]):
        """(column, threshold, sums of the left side, those of the rows held out); the first of equal gains."""
        found, most = None, -np.inf
        for at, cuts in zip(self.columns, self.cuts):
            if not len(cuts):
                continue
            held, seen = sums[at][:, self.held], np.delete(sums[at], self.held, axis=1).sum(axis=1)
            place = np.searchsorted(union[at], cuts)
            left = np.cumsum(seen, axis=1)[:, place]
            whole = seen.sum(axis=1)[:, None]
            right = whole - left
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = _variance(whole) - left[0] / whole[0] * _variance(left) - right[0] / whole[0] * _variance(right)
            least = max(self.model.getMinInstancesPerNode(), self.model.getMinWeightFractionPerNode() * self.n)
            valid = (left[0] >= least) & (right[0] >= least) & (gain >= self.model.getMinInfoGain())
            gain = np.where(valid, gain, -np.inf)
            i = int(np.argmax(gain))
            if gain[i] > most:
                most = gain[i]
                found = at, float(cuts[i]), left[:, i], held[:, : place[i] + 1].sum(axis=1)
        return found if most > 0 else None


def _variance(sums: np.ndarray) -> np.ndarray:
    return (sums[2] - sums[1] * sums[1] / sums[0]) / sums[0]


def grown_alike(model, df: DataFrame, columns: Sequence[str], label: str) -> bool:
    """Whether a model is a tree that this module grows: on plain numbers, without weights."""
    if not isinstance(model, DecisionTreeRegressor) or model.isSet("weightCol") or model.getLabelCol() != label:
        return False
    plain = (T.NumericType, T.BooleanType)
    return all(isinstance(df.schema[c].dataType, plain) and "ml_attr" not in (df.schema[c].metadata or {}) for c in columns)


# --- thresholds ----------------------------------------------------------


def thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds between values of a sample, about evenly many
    rows apart. Zeros are what is missing to the ``expected`` number of rows."""
    seen, counts = np.unique(values[values != 0], return_counts=True)
    zeros, n = expected - counts.sum(), counts.sum()
    if not len(seen):
        return seen
    if zeros > EPSILON * n * 100:
        at = int(np.searchsorted(seen, 0.0))
        seen, counts = np.insert(seen, at, 0.0), np.insert(counts.astype("float64"), at, zeros)
    middle = (seen[:-1] + seen[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = expected / (most + 1)
    target, so_far, kept = stride, float(counts[0]), []
    for i in range(1, len(seen)):
        before, so_far = so_far, so_far + float(counts[i])
        if abs(before - target) < abs(so_far - target):
            kept.append(i - 1)
            target += stride
    return middle[kept]


def _drawn(seen: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows that MLlib's trees draw for their thresholds: drawn by its seed from its partitions."""
    spark = seen.sparkSession
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    kept = seen._jdf.javaRDD().sample(False, fraction, draw)
    return DataFrame(spark._jsparkSession.createDataFrame(kept, seen._jdf.schema()), spark)


def _planted(rows: DataFrame, width: int, counts: dict[int, int], wanted: dict[Hashable, tuple[list[int], DecisionTreeRegressor]]) -> list[Tree]:
    """Trees without a split, with their thresholds."""
    total = sum(counts.values())
    draws, samples = {}, []
    for _, model in wanted.values():
        for held, n in counts.items():
            seen = total - n
            bins = min(model.getMaxBins(), seen)
            asked = max(bins * bins, THRESHOLD_ROWS)
            draw = (held, bins, model.getSeed())
            if draw not in draws:
                draws[draw] = asked / seen if asked < seen else 1.0
                part = _drawn(rows.where(F.col("fold") != held).select(*[f"x{i}" for i in range(width)]), draws[draw], model.getSeed())
                samples.append(part.withColumn("draw", F.lit(len(draws) - 1)))
    # as many rows as the thresholds ask for, not a share of the table
    drawn = reduce(DataFrame.unionAll, samples).toPandas()
    values = {draw: drawn[drawn["draw"] == i] for i, draw in enumerate(draws)}
    trees = []
    for key, (columns, model) in wanted.items():
        for held, n in counts.items():
            draw = (held, min(model.getMaxBins(), total - n), model.getSeed())
            expected = draws[draw] * (total - n)
            cuts = [thresholds(values[draw][f"x{c}"].to_numpy("float64"), expected, draw[1] - 1) for c in columns]
            trees.append(Tree(key, held, columns, model, cuts, total - n))
    return trees


# --- sums ----------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _added_up(rows: DataFrame, union: list[np.ndarray], folds: int, centre: float, walks: list[tuple]) -> dict[tuple[int, int], dict[int, np.ndarray]]:
    """Sums by walk and open node: for every column of the walk, (count, sum,
    squares) by fold by interval. A walk is (features, cuts, children, open nodes, columns)."""
    wide = [len(u) + 1 for u in union]
    starts = [np.cumsum([0, *(len(w[3]) * folds * wide[c] for c in w[4])]) for w in walks]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros((3, s[-1])) for s in starts]
        for block in _blocks(batches):
            x = np.vstack([block.column(f"x{i}").to_numpy() for i in range(len(union))])
            y = block.column("y").to_numpy() - centre
            fold, squares = block.column("fold").to_numpy().astype("int64"), y * y
            intervals = [np.searchsorted(u, v) for u, v in zip(union, x)]
            every = np.arange(len(y))
            for (feature, cut, child, nodes, columns), start, total in zip(walks, starts, sums):
                node = np.zeros(len(y), dtype="int64")
                slot = np.full(len(feature), -1)
                slot[nodes] = np.arange(len(nodes))
                on = every
                while len(on := on[feature[node[on]] >= 0]):
                    at = node[on]
                    node[on] = child[at] + (x[feature[at], on] > cut[at])
                place = slot[node]
                on = slice(None) if (place >= 0).all() else np.flatnonzero(place >= 0)
                base, answer, square = place[on] * folds + fold[on], y[on], squares[on]
                for c, low, high in zip(columns, start[:-1], start[1:]):
                    cell = base * wide[c] + intervals[c][on]
                    total[0, low:high] += np.bincount(cell, minlength=high - low)
                    total[1, low:high] += np.bincount(cell, answer, high - low)
                    total[2, low:high] += np.bincount(cell, square, high - low)
        for w, total in enumerate(sums):
            cells = np.flatnonzero(total[0])
            yield pa.RecordBatch.from_pydict(
                {"walk": np.full(len(cells), w, dtype="int32"), "cell": cells, "n": total[0, cells], "s": total[1, cells], "q": total[2, cells]}
            )

    parts = rows.mapInArrow(add_up, "walk int, cell long, n double, s double, q double")
    # as many rows as there are cells
    merged = parts.groupBy("walk", "cell").agg(*[F.sum(v).alias(v) for v in "nsq"]).toPandas()
    out = {}
    for w, (_, _, _, nodes, columns) in enumerate(walks):
        total = np.zeros((3, starts[w][-1]))
        mine = merged[merged["walk"] == w]
        total[:, mine["cell"].to_numpy("int64")] = mine[["n", "s", "q"]].to_numpy("float64").T
        by_column = {c: total[:, low:high].reshape(3, len(nodes), folds, wide[c]) for c, low, high in zip(columns, starts[w][:-1], starts[w][1:])}
        for i, node in enumerate(nodes):
            out[w, node] = {c: part[:, i] for c, part in by_column.items()}
    return out


def _passes(trees: list[Tree], room: int) -> list[list[tuple[list[Tree], tuple]]]:
    """What the passes of a level count, ``room`` open nodes in each at most:
    the trees that are split alike so far, and their walk."""
    alike: dict[tuple, list[Tree]] = defaultdict(list)
    for tree in trees:
        if tree.open:
            alike[tree.shape()].append(tree)
    passes, left = [[]], room
    for group in alike.values():
        splits = [np.array(v) for v in (group[0].feature, group[0].cut, group[0].child)]
        columns, nodes = sorted({c for t in group for c in t.columns}), group[0].open
        while nodes:
            if not left:
                passes.append([])
                left = room
            passes[-1].append((group, (*splits, nodes[:left], columns)))
            nodes, left = nodes[left:], left - len(nodes[:left])
    return passes


def fold_scores(
    rows: DataFrame, label: str, fold: str, folds: int, wanted: dict[Hashable, tuple[Sequence[str], DecisionTreeRegressor]]
) -> list[tuple[Hashable, int, float]]:
    """(key, fold, r2) of every wanted (columns, model), each fold scored by the tree of all others."""
    names = list(dict.fromkeys(c for columns, _ in wanted.values() for c in columns))
    values = [f"x{i}" for i in range(len(names))] + ["y"]
    columns = [F.col(c).cast("double").alias(v) for c, v in zip([*names, label], values)]
    rows = rows.select(*columns, F.col(fold).cast("int").alias("fold"))
    bad = reduce(lambda a, b: a | b, [F.col(v).isNull() | F.isnan(v) | (F.abs(v) == float("inf")) for v in values])
    about = rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.var_pop("y").alias("spread"), F.count_if(bad).alias("bad")
    )
    about = {r["fold"]: r for r in about.collect()}
    if any(r["bad"] for r in about.values()):
        raise ValueError(f"null, NaN or infinity in {', '.join([*names, label])}")
    if len(about) < folds or len(about) < 2:
        raise ValueError("a fold has no rows to score, or none to learn from")
    counts = {f: about[f]["n"] for f in range(folds)}
    centre = sum(r["mean"] * (r["n"] / sum(counts.values())) for r in about.values())
    trees = _planted(rows, len(names), counts, {k: ([names.index(c) for c in cs], m) for k, (cs, m) in wanted.items()})
    union = [np.unique(np.concatenate([cuts for t in trees for c, cuts in zip(t.columns, t.cuts) if c == i])) for i in range(len(names))]
    room = max(1, MOST_CELLS // (folds * sum(len(u) + 1 for u in union)))
    level = 0
    while any(t.open for t in trees):
        passes = _passes(trees, room)
        for tree in trees:
            tree.open = []
        for walks in passes:
            sums = _added_up(rows, union, folds, centre, [walk for _, walk in walks])
            for (w, node), by_column in sums.items():
                for tree in walks[w][0]:
                    tree.grow(node, level, by_column, union)
        level += 1
    with np.errstate(divide="ignore", invalid="ignore"):
        return [(t.key, t.held, float(1 - np.float64(t.rest) / np.float64(about[t.held]["spread"] * counts[t.held]))) for t in trees]
