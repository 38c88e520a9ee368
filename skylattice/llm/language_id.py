"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions, gives every position a
distribution over the languages, and a text gets the mean over all of its
positions. It is written in numpy and trained by backpropagation through time
on pieces of a bounded sample of labelled rows. Texts are read whole, as
windows that lie side by side; each direction starts anew at a window, so of
the two states at a position at least one has read half a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spare

UNKNOWN = "und"
HIDDEN = 8
WINDOW = 256
#: Windows read at a time.
LANES = 1024
#: Row of the input table for places behind the end of a text: the state stays.
PAD = 256
#: Labelled rows per language, and characters of each, that are learned from.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 1500
#: More languages than this are taken for an error in the labels.
MOST_LANGUAGES = 500


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Direction:
    """A gated recurrent unit that reads windows one way.

    ``inputs`` has a row per byte with its share in the update gate, the reset
    gate and the candidate; ``recurrent`` and ``bias`` are those of the state.
    """

    def __init__(self, inputs: np.ndarray, recurrent: np.ndarray, bias: np.ndarray):
        self.inputs, self.recurrent, self.bias = inputs, recurrent, bias

    def read(self, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each step; ``steps`` is (time, lane)."""
        size = len(self.recurrent)
        states = np.empty((*steps.shape, size), dtype=np.float32)
        h = np.zeros((steps.shape[1], size), dtype=np.float32)
        gates_bias = self.bias[2 * size :]
        for t, bytes_ in enumerate(steps):
            x = self.inputs[bytes_]
            u = h @ self.recurrent
            gates = sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
            z, r = gates[:, :size], gates[:, size:]
            inner = u[:, 2 * size :] + gates_bias
            n = np.tanh(x[:, 2 * size :] + r * inner)
            if keep is not None:
                keep.append((h, z, r, n, inner))
            h = n + z * (h - n)
            states[t] = h
        return states

    def learn(self, steps: np.ndarray, keep: list, upstream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of ``inputs``, ``recurrent`` and ``bias``, back through time."""
        size = len(self.recurrent)
        d_recurrent, d_bias = np.zeros_like(self.recurrent), np.zeros_like(self.bias)
        d_gates = np.empty((*steps.shape, 3 * size), dtype=np.float32)
        dh = np.zeros(upstream.shape[1:], dtype=np.float32)
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, n, inner = keep[t]
            dh = dh + upstream[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            d_gates[t] = np.concatenate([dz, dr, dn], axis=1)
            d_recurrent += h.T @ du
            d_bias[2 * size :] += du[:, 2 * size :].sum(axis=0)
            dh = dh * z + du @ self.recurrent.T
        d_inputs = np.zeros_like(self.inputs)
        np.add.at(d_inputs, steps.ravel(), d_gates.reshape(-1, 3 * size))
        d_inputs[PAD] = 0
        return d_inputs, d_recurrent, d_bias


@dataclass
class Network:
    """Parameters by name, and the languages in the order of the outputs."""

    languages: list[str]
    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> "Network":
        rng = np.random.default_rng(seed)
        weights = {}
        for way in ("f", "b"):
            inputs = rng.normal(0, 0.3, (257, 3 * hidden))
            inputs[PAD] = 0
            # the update gate stands at one, which leaves the state alone
            inputs[PAD, :hidden] = 30
            weights |= {f"{way}_inputs": inputs, f"{way}_recurrent": rng.normal(0, 0.3, (hidden, 3 * hidden)), f"{way}_bias": np.zeros(3 * hidden)}
        weights |= {"out": rng.normal(0, 0.3, (2 * hidden, len(languages))), "out_bias": np.zeros(len(languages))}
        return cls(languages, {k: v.astype(np.float32) for k, v in weights.items()})

    def direction(self, way: str) -> Direction:
        return Direction(*[self.weights[f"{way}_{k}"] for k in ("inputs", "recurrent", "bias")])

    def label(self, windows: np.ndarray) -> np.ndarray:
        """Probabilities (lane, time, language) of every position."""
        steps = windows.T
        states = np.concatenate([self.direction("f").read(steps), self.direction("b").read(steps[::-1])[::-1]], axis=2)
        logits = states @ self.weights["out"] + self.weights["out_bias"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        return (p / p.sum(axis=2, keepdims=True)).transpose(1, 0, 2)

    def gradients(self, windows: np.ndarray, languages: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of the positions that are text."""
        steps = windows.T
        kept: dict[str, list] = {"f": [], "b": []}
        forward = self.direction("f").read(steps, kept["f"])
        backward = self.direction("b").read(steps[::-1], kept["b"])[::-1]
        states = np.concatenate([forward, backward], axis=2)
        logits = states @ self.weights["out"] + self.weights["out_bias"]
        logits -= logits.max(axis=2, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=2, keepdims=True)
        text = (steps != PAD)[:, :, None]
        p[:, np.arange(len(languages)), languages] -= 1
        delta = (p * text / max(1, int(text.sum()))).astype(np.float32)
        flat = delta.reshape(-1, delta.shape[2])
        found = {"out": states.reshape(len(flat), -1).T @ flat, "out_bias": flat.sum(axis=0)}
        upstream = delta @ self.weights["out"].T
        size = upstream.shape[2] // 2
        ways = {"f": (steps, upstream[:, :, :size]), "b": (steps[::-1], upstream[::-1, :, size:])}
        for way, (order, up) in ways.items():
            names = [f"{way}_{k}" for k in ("inputs", "recurrent", "bias")]
            found |= dict(zip(names, self.direction(way).learn(order, kept[way], up)))
        return found


def windows_of(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of the texts, padded, and the text each belongs to."""
    counts = np.array([-(-len(t) // width) for t in texts], dtype=np.int64)
    windows = np.full((int(counts.sum()), width), PAD, dtype=np.int16)
    flat, at = windows.reshape(-1), 0
    for t, n in zip(texts, counts):
        flat[at : at + len(t)] = np.frombuffer(t, dtype=np.uint8)
        at += int(n) * width
    return windows, np.repeat(np.arange(len(texts)), counts)


def train(pieces: list[bytes], languages: list[str], steps: int = 250, lanes: int = 128, width: int = 64, rate: float = 0.02, seed: int = 0) -> Network:
    """Fit a network to labelled pieces of text with Adam.

    Every language is drawn equally often, so that a frequent one does not win
    by its number.
    """
    names = sorted(set(languages))
    network = Network.fresh(names, seed=seed)
    windows, owner = windows_of(pieces, width)
    labels = np.array([names.index(x) for x in languages], dtype=np.int64)[owner]
    pools = [np.flatnonzero(labels == k) for k in range(len(names))]
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    for step in range(1, steps + 1):
        lane = np.concatenate([rng.choice(p, -(-lanes // len(pools))) for p in pools if len(p)])
        grads = network.gradients(windows[lane], labels[lane])
        pace = rate * (1 - step / (steps + 1)) / (1 - 0.9**step) * np.sqrt(1 - 0.999**step)
        for k, g in grads.items():
            np.clip(g, -1, 1, out=g)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            network.weights[k] -= (pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
    return network


def sample(labelled: DataFrame, key: str, text: str, lang: str, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[bytes], list[str]]:
    """At most ``rows`` rows per language by the order of a hash, and of each at
    most ``chars`` characters from a hashed place on."""
    known = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key), F.col(text)).alias("h")
    )
    counts = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages among the labels")
    if not counts:
        return [], []
    # about twice the rows wanted pass the hash, then the first are taken
    share = F.lit(2.0 * rows) / F.element_at(F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], float(r["count"]))]), F.col("lang"))
    at = F.pmod(F.col("h"), F.greatest(F.length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    some = known.where(F.pmod(F.col("h"), F.lit(1_000_003)) / 1_000_003.0 < share).select("lang", "h", F.substring("text", at, F.lit(chars)).alias("piece"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "piece"))
    taken = some.withColumn("place", place).where(F.col("place") <= rows).orderBy("lang", "place").collect()
    return [r["piece"].encode() for r in taken], [r["lang"] for r in taken]


def pooled(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all positions of each text; zeros for none."""
    windows, owner = windows_of(texts, WINDOW)
    # full windows first, so that the rest share lanes with their like
    order = np.argsort((windows != PAD).sum(axis=1), kind="stable")[::-1]
    sums = np.zeros((len(texts), len(network.languages)))
    for at in range(0, len(order), LANES):
        lane = order[at : at + LANES]
        chosen = windows[lane]
        width = int((chosen != PAD).sum(axis=1).max())
        p = network.label(chosen[:, :width]) * (chosen[:, :width] != PAD)[:, :, None]
        np.add.at(sums, owner[lane], p.sum(axis=1))
    return sums / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def predict(df: DataFrame, network: Network, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the language of each whole text and its probability.

    A null text, one without a letter, or any text if nothing was learned is
    ``und`` with score 0. Equal texts get equal results; columns with these
    two names are replaced.
    """
    kinds = f"{out} string, {score} double"

    @F.pandas_udf(kinds)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.tolist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            asked = [i for i, t in enumerate(texts) if t and network.languages and any(map(str.isalpha, t))]
            # some megabytes of text at a time; a longer text alone
            at = 0
            while at < len(asked):
                group, size = [], 0
                while at < len(asked) and (not group or size + len(texts[asked[at]]) <= 2_000_000):
                    group.append(asked[at])
                    size += len(texts[asked[at]])
                    at += 1
                p = pooled(network, [texts[i].encode() for i in group])
                best = p.argmax(axis=1)
                for i, k, x in zip(group, best, p[np.arange(len(group)), best]):
                    langs[i], scores[i] = network.languages[k], min(1.0, float(x))
            yield pd.DataFrame({out: langs, score: scores})

    both = spare(df, "language")
    done = df.withColumn(both, run(F.col(text)))
    return done.withColumns({out: F.col(both)[out], score: F.col(both)[score]}).drop(both)


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **options) -> Network:
    """A network for the languages of ``labelled``; rows without text or
    language are left out. Without any row it has no language."""
    pieces, languages = sample(labelled, key, text, lang)
    return train(pieces, languages, **options) if pieces else Network([], {})
