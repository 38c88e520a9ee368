"""Quality scores by gradient-boosted trees over statistics of a document.

A text becomes a row of statistics: lengths, shares of kinds of bytes,
repetition of words and lines. The trees are grown on histograms: every
statistic is cut in bins at quantiles of a bounded sample, and a level of a
tree needs only the sums of gradients per node, statistic and bin. Fitted
trees are flattened into arrays, and a batch of rows goes down all of them a
level at a time in numpy.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Labelled rows that are learned from, by the order of a hash.
SAMPLE_ROWS = 20_000
BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
#: Least sum of second derivatives in a leaf, and the ridge on leaf values.
LEAST_WEIGHT = 3.0
RIDGE = 1.0
#: Words of a window whose repetition is counted.
SPAN = 4
#: Rows that go down the trees at a time.
ROWS = 4096

_KINDS = {
    "digit": b"0123456789", "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "blank": b" \t\n\x0b\x0c\r",
    "stop": b".?!", "comma": b",;:", "symbol": b"#*$%&|<>@^~_=+{}[]\\", "quote": b"\"'()", "slash": b"/",
    "bang": b"!", "pipe": b"|", "wide": bytes(range(128, 256)),
}
_MASKS = np.array([[b in bytes_ for b in range(256)] for bytes_ in map(set, _KINDS.values())], dtype=np.float64)
NAMES = (
    "bytes", "words", "lines", *_KINDS, "other", "entropy", "word_length", "longest_word", "distinct_words", "commonest_word", "repeated_spans",
    "repeated_neighbours", "distinct_lines", "commonest_line", "words_a_line", "longest_line", "words_without_letters", "upper_words", "ended_lines",
)


def statistics(text: str | None) -> list[float]:
    """One number per name; a null text is like an empty one."""
    raw = (text or "").encode()
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256).astype(np.float64)
    shares = _MASKS @ counts / max(1, n)
    p = counts[counts > 0] / max(1, n)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    w, k = max(1, len(words)), max(1, len(lines))
    sizes = [*map(len, words)]
    found, same = Counter(words), Counter(lines)
    spans = Counter(zip(*[words[i:] for i in range(SPAN)])) if len(words) >= SPAN else Counter()
    n_spans = max(1, len(words) - SPAN + 1)
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), *shares, 1.0 - shares[[0, 1, 2, 3, 4, 5, 6, 7, 8, 11]].sum(),
        float(-(p * np.log2(p)).sum()) if n else 0.0,
        sum(sizes) / w, max(sizes, default=0), len(found) / w, max(found.values(), default=0) / w,
        (n_spans - len(spans)) / n_spans if spans else 0.0, sum(map(bytes.__eq__, words, words[1:])) / w,
        len(same) / k, max(same.values(), default=0) / k, len(words) / k, np.log1p(max(map(len, lines), default=0)),
        sum(not x.lower().islower() for x in found) / max(1, len(found)), sum(map(bytes.isupper, words)) / w,
        sum(line.rstrip().endswith((b".", b"!", b"?", b":")) for line in lines) / k,
    ]


def table(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(NAMES))


@dataclass
class Trees:
    """All trees, node after node: a leaf points to itself, so that a row that
    is there stays."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of the label 1 for each row of statistics."""
        out = np.full(len(x), self.start)
        for at in range(0, len(x), ROWS):
            part = x[at : at + ROWS]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.limit[node], self.left[node], self.right[node])
            out[at : at + ROWS] += self.value[node].sum(axis=1)
        return 1.0 / (1.0 + np.exp(-out))


def edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of all bins but the last, by statistic: distinct quantiles,
    halfway to the next value that occurs."""
    found = []
    for column in x.T:
        values = np.unique(column)
        at = np.unique(np.searchsorted(values, np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")))
        at = at[at < len(values) - 1]
        found.append((values[at] + values[at + 1]) / 2)
    return found


def histograms(binned: np.ndarray, node: np.ndarray, n_nodes: int, weights: np.ndarray) -> np.ndarray:
    """Sums of ``weights`` by node, statistic and bin."""
    place = node * BINS
    return np.stack([np.bincount(place + binned[:, f], weights, n_nodes * BINS).reshape(n_nodes, BINS) for f in range(binned.shape[1])], axis=1)


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Trees for the logistic loss, each level grown from histograms.

    Without rows the score is one half; with one label only there are no trees.
    """
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1.0)
    start = float(np.log(share / (1 - share)))
    feature, limit, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < y.sum() < n:
        cuts = edges(x)
        binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1).astype(np.int64)
        usable = np.array([[b < len(c) for b in range(BINS)] for c in cuts])
        score = np.full(n, start)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-score))
            gradient, weight = p - y, p * (1 - p)
            root = len(feature)
            roots.append(root)
            # nodes of a level, numbered from 0; -1 for rows that have come to a leaf
            at, level = np.zeros(n, dtype=np.int64), [root]
            _add_leaf(feature, limit, left, right, value, gradient.sum(), weight.sum(), rate)
            place = np.full(n, root)
            for _ in range(depth):
                live = np.flatnonzero(at >= 0)
                g = histograms(binned[live], at[live], len(level), gradient[live])
                h = histograms(binned[live], at[live], len(level), weight[live])
                g_low, h_low = g.cumsum(axis=2), h.cumsum(axis=2)
                g_all, h_all = g_low[:, :, -1:], h_low[:, :, -1:]
                g_high, h_high = g_all - g_low, h_all - h_low
                gain = g_low**2 / (h_low + RIDGE) + g_high**2 / (h_high + RIDGE) - g_all**2 / (h_all + RIDGE)
                gain[(h_low < LEAST_WEIGHT) | (h_high < LEAST_WEIGHT) | ~usable[None]] = 0
                flat = gain.reshape(len(level), -1)
                pick = flat.argmax(axis=1)
                below: list[int] = []
                moved = np.full(n, -1, dtype=np.int64)
                for k, node in enumerate(level):
                    if flat[k, pick[k]] <= 1e-6:
                        continue
                    f, b = divmod(int(pick[k]), BINS)
                    feature[node], limit[node] = f, float(cuts[f][b])
                    rows = live[at[live] == k]
                    low = binned[rows, f] <= b
                    for side, chosen, gs, hs in ((left, rows[low], g_low, h_low), (right, rows[~low], g_high, h_high)):
                        side[node] = len(feature)
                        moved[chosen], place[chosen] = len(below), len(feature)
                        below.append(len(feature))
                        _add_leaf(feature, limit, left, right, value, gs[k, f, b], hs[k, f, b], rate)
                at, level = moved, below
                if not level:
                    break
            score += np.array(value)[place]
    whole = lambda a: np.array(a, dtype=np.int64)
    return Trees(start, whole(roots), whole(feature), np.array(limit, dtype=np.float64), whole(left), whole(right), np.array(value, dtype=np.float64), depth)


def _add_leaf(feature, limit, left, right, value, gradient: float, weight: float, rate: float) -> None:
    node = len(feature)
    feature.append(0)
    limit.append(np.inf)
    left.append(node)
    right.append(node)
    value.append(float(-rate * gradient / (weight + RIDGE)))


def sample(labels: DataFrame, docs: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """Documents (h, k, y, text) of at most ``rows`` labels by the order of a hash."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    known = known.distinct().withColumn("h", F.xxhash64("k", "y"))
    # no more than this many, so it may be sent to all tasks
    some = F.broadcast(cut(known.orderBy("h", "k", "y").limit(rows)))
    return docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(some, "k").select("h", "k", "y", "text")


def fit(labels: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS, **options) -> Trees:
    """Trees that learn the label (0 or 1) of documents from their texts.

    ``labels`` and ``docs`` meet on ``key``. Other labels, nulls and documents
    without a label are left out; a document with both labels counts once with
    each. Only statistics of at most ``rows`` rows come to the driver.
    """
    seen = sample(labels, docs, key, text, label, rows).withColumn("k", F.xxhash64("k", "text"))
    known = seen.mapInPandas(_with_statistics, "h long, k long, y int, x array<double>")
    # a key may stand on more than one document
    found = known.orderBy("h", "k", "y").limit(rows).toArrow()
    x = np.array(found["x"].to_pylist(), dtype=np.float64).reshape(len(found), len(NAMES))
    # rows come in no fixed order; sums should
    order = np.lexsort((*x.T, found["y"].to_numpy()))
    return fit_trees(x[order], found["y"].to_numpy()[order].astype(np.float64), **options)


def _with_statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({**{c: batch[c] for c in ("h", "k", "y")}, "x": [statistics(t) for t in batch["text"]]})


def score(df: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of the label 1 for each whole text.

    Null and empty texts have a score too. Equal texts get equal scores; a
    column named ``out`` is replaced, an empty table stays empty.
    """

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(trees.scores(table(batch.tolist())), dtype="float64")

    return df.withColumn(out, run(F.col(text)))
