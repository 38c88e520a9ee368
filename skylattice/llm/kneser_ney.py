"""Language-model scores by an interpolated modified Kneser-Ney bigram model.

Counting runs in Spark: tasks sum what they read, the sums are shuffled by
hash range and merged. The model is a set of sorted hash arrays in the shared
folder, one file set per hash range: words with their counts, pairs with
theirs, and per word what the smoothing needs. Scoring tasks memory-map the
files, so a model of any size costs a worker only the pages it touches.

Words get the number of their hash's place in the sorted word arrays. A pair's
hash is that of its two numbers.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut, spare

#: A word holds no blank, so no word has this hash's text.
END = xxhash.xxh64_intdigest(b" end")
#: Words whose numbers a worker keeps; beyond that it starts anew.
KEPT_WORDS = 300_000
#: Tokens worked on at a time.
TOKENS = 250_000
#: Texts of a batch that are taken out of it at a time.
TEXTS = 1_000
_PRIME = [np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def words_of(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def pair_hash(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two numbers."""
    with np.errstate(over="ignore"):
        x = u.astype(np.uint64) * _PRIME[0] ^ ((v.astype(np.uint64) + _PRIME[2]) * _PRIME[1])
        for shift in (33, 29, 32):
            x = (x ^ (x >> np.uint64(shift))) * _PRIME[1]
        return x ^ (x >> np.uint64(32))


def mounted(path: str) -> str:
    """The folder as workers open it."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a shared folder that is mounted on every worker, not {path}")
    return parts.path


def save(folder: str, name: str, values: np.ndarray) -> str:
    """Write one array; the name becomes visible when the file is whole, and
    every attempt of a task has its own."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}-{uuid.uuid4().hex}.npy"
    with open(f"{path}.part", "wb") as file:
        np.save(file, values)
    os.replace(f"{path}.part", path)
    return path


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns of non-negative numbers in as few bytes as hold them."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for c in columns:
        width = 8 if len(c) and int(c.max()) >= 2**32 else 4
        parts += [bytes([width]), c.astype(f"<u{width}").tobytes()]
    raw = b"".join(parts)
    return parts[0] + len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[16:], decompressed_size=int.from_bytes(blob[8:16], "little"), codec="zstd", asbytes=True)
    n, at, columns = int.from_bytes(raw[:8], "little"), 8, []
    while at < len(raw):
        width = raw[at]
        columns.append(np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=at + 1).astype(np.int64))
        at += 1 + n * width
    return columns


def unpacked_size(blob: pa.Scalar) -> int:
    """Rows of packed columns, from the head alone."""
    return int.from_bytes(blob.as_buffer()[:8].to_pybytes(), "little")


def by_range(which: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of each range, in order."""
    if not len(which):
        return
    order = np.argsort(which, kind="stable")
    which = which[order]
    starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
    for start, end in zip(starts, [*starts[1:], len(which)]):
        yield int(which[start]), [c[order[start:end]] for c in columns]


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sums of ``values`` per distinct key, ordered by key."""
    if not len(keys[0]):
        return keys, values
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    change = np.zeros(len(order), dtype=bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(change)
    return [k[starts] for k in keys], [np.add.reduceat(v[order], starts) for v in values]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all."""

    bits: int
    words: list = field(default_factory=list)  # per range: (hashes, counts) files or None
    bases: list = field(default_factory=list)  # number of the first word of each range
    pairs: list = field(default_factory=list)  # per range: (hashes, counts)
    nodes: list = field(default_factory=list)  # per range: (pairs begun, by count 1, 2, more; pairs ended)
    n_docs: int = 0
    n_tokens: int = 0
    n_words: int = 0
    n_pairs: int = 0
    pair_discounts: tuple = (0.0, 0.0, 0.0)
    word_discounts: tuple = (0.0, 0.0, 0.0)
    words_by_ends: tuple = (0, 0, 0)
    start_node: list = field(default_factory=lambda: [0, 0, 0, 0])

    @property
    def start(self) -> int:
        """The number that stands for the start of a text."""
        return self.n_words

    def range_of(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from how many counts are 1, 2, 3 and 4;
    where one of these is missing, 0.5, 1 and 1.5."""
    if min(n) <= 0:
        return (0.5, 1.0, 1.5)
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return found if min(found) > 0 and all(d <= k for d, k in zip(found, (1, 2, 3))) else (0.5, 1.0, 1.5)


def discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


class Reader:
    """Memory-mapped look-ups of a model."""

    def __init__(self, model: Model):
        self.model = model
        self.open = lru_cache(maxsize=None)(lambda path: np.load(path, mmap_mode="r"))
        self.numbers: dict[bytes, int] = {}
        self.end = int(self.find(np.array([END], dtype=np.uint64), model.words)[0][0])

    def find(self, hashes: np.ndarray, files: list) -> tuple[np.ndarray, np.ndarray]:
        """Number (place over all ranges for words, -1 if unknown) and count of each hash."""
        place, count = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        order = np.argsort(hashes)
        ordered = hashes[order]
        cuts = np.searchsorted(ordered, np.arange(1, len(files), dtype=np.uint64) << np.uint64(64 - self.model.bits))
        for r, part in enumerate(np.split(order, cuts)):
            if files[r] is None or not len(part):
                continue
            keys, values = map(self.open, files[r])
            at = np.minimum(np.searchsorted(keys, hashes[part]), len(keys) - 1)
            hit = keys[at] == hashes[part]
            place[part[hit]] = at[hit] + (self.model.bases[r] if files is self.model.words else 0)
            count[part[hit]] = values[at[hit]]
        return place, count

    def number(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        if len(self.numbers) > KEPT_WORDS:
            self.numbers.clear()
        new = [*{w for w in words if w not in self.numbers}]
        if new:
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, new), dtype=np.uint64, count=len(new))
            self.numbers.update(zip(new, self.find(hashes, self.model.words)[0].tolist()))
        return np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int64, count=len(words))

    def pairs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(before, word, tokens per text): every text's words and its end,
        each with the number of what stands before."""
        found = [words_of(t) for t in texts]
        sizes = np.array([len(w) + 1 for w in found], dtype=np.int64)
        ends = np.cumsum(sizes) - 1
        word = np.full(int(sizes.sum()), self.end, dtype=np.int64)
        inner = np.ones(len(word), dtype=bool)
        inner[ends] = False
        word[inner] = self.number([w for ws in found for w in ws])
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[ends - sizes + 1] = self.model.start
        return before, word, sizes

    def of_words(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, and the four columns of ``nodes``, of each number (ordered)."""
        m = self.model
        counts, nodes = np.zeros(len(numbers), dtype=np.int64), np.zeros((len(numbers), 4), dtype=np.int64)
        bounds = np.searchsorted(numbers, [*m.bases, m.n_words])
        for r in range(len(m.words)):
            part = slice(bounds[r], bounds[r + 1])
            inside = numbers[part] - m.bases[r]
            if m.words[r] is not None and len(inside):
                counts[part] = self.open(m.words[r][1])[inside]
                nodes[part] = self.open(m.nodes[r])[inside]
        if len(numbers) and numbers[-1] == m.start:
            counts[-1] = m.n_docs
            nodes[-1] = m.start_node
        return counts, nodes

    def score(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        m = self.model
        before, word, sizes = self.pairs(texts)
        numbers, place = np.unique(np.r_[before, word], return_inverse=True)
        counts, nodes = self.of_words(np.maximum(numbers, 0))
        counts[numbers < 0] = 0
        nodes[numbers < 0] = 0
        left, right = place[: len(before)], place[len(before) :]
        # unigrams: how many kinds of words a word follows, interpolated with the uniform distribution
        rest = float(np.dot(m.word_discounts, m.words_by_ends))
        ends = nodes[:, 3]
        if m.n_pairs:
            low = (ends - discount(ends, m.word_discounts) + rest / (m.n_words + 1)) / m.n_pairs
        else:
            low = np.full(len(numbers), 1.0 / (m.n_words + 1))
        total = counts[left]
        spread = (nodes[:, :3] @ np.array(m.pair_discounts))[left]
        _, both = self.find(pair_hash(before, word), m.pairs)
        both[(before < 0) | (word < 0)] = 0
        safe = np.maximum(total, 1)
        p = np.where(total > 0, (both - discount(both, m.pair_discounts) + spread * low[right]) / safe, low[right])
        seen = counts[right]
        base = np.log10((seen + 1.0) / (m.n_tokens + m.n_words + 1.0))
        starts = np.cumsum(sizes) - sizes
        return {
            "n_tokens": sizes,
            "n_known": np.add.reduceat((seen > 0).astype(np.int64), starts),
            "base_score": np.add.reduceat(base, starts),
            "score": np.add.reduceat(np.log10(p), starts),
        }


def token_groups(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts in order, about ``TOKENS`` words at a time; a longer one alone."""
    group, size = [], 0
    for t in texts:
        n = len(t) // 6 if t else 1
        if group and size + n > TOKENS:
            yield group
            group, size = [], 0
        group.append(t)
        size += n
    if group:
        yield group


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    for at in range(0, len(batch), TEXTS):
        yield from batch.column(0).slice(at, TEXTS).to_pylist()


def _manifest(rows: list[dict], schema: str) -> pa.Table:
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names = [part.split() for part in schema.split(", ")]
    return pa.table({n: pa.array([r.get(n) for r in rows], types[t]) for n, t in names})


def _count_words(texts: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in token_groups(_texts(batch)):
                counts = Counter()
                for t in group:
                    counts.update(words_of(t))
                hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in counts), dtype=np.uint64, count=len(counts))
                hashes, sums = np.r_[hashes, np.uint64(END)], np.r_[np.fromiter(counts.values(), dtype=np.int64, count=len(counts)), len(group)]
                rows = [{"range": r, "sums": packed([h.view(np.int64) >> 32 & 0xFFFFFFFF, h.view(np.int64) & 0xFFFFFFFF, c])} for r, (h, c) in by_range((hashes >> np.uint64(64 - bits)).astype(np.uint16), [hashes, sums])]
                yield from _manifest(rows, "range long, sums binary").to_batches()

    return texts.mapInArrow(run, "range long, sums binary")


def _joined(table: pa.Table) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*[unpacked(b) for b in table.column("sums").to_pylist()])]


def _unpacked_pairs(blobs: pa.ChunkedArray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and their counts, one blob after another put in place: all of them
    in 64 bits beside their joined copies would take several times as much."""
    number = np.uint32 if n_words < 2**32 - 1 else np.int64
    sizes = [unpacked_size(b) for b in blobs]
    u, v = (np.empty(sum(sizes), dtype=number) for _ in range(2))
    c, at = np.empty(sum(sizes), dtype=np.int64), 0
    for blob, n in zip(blobs, sizes):
        steps, v[at : at + n], c[at : at + n] = unpacked(blob.as_py())
        u[at : at + n] = np.cumsum(steps)
        at += n
    return u, v, c


def train(texts: DataFrame, text: str = "text", bits: int | None = None) -> Model:
    """Fit the model to all rows of ``texts``; a null text is an empty one.

    ``bits`` sets the number of hash ranges, 2 to that power; by default as
    many as the session has shuffle partitions.
    """
    spark = texts.sparkSession
    if bits is None:
        bits = min(16, max(3, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    path = scratch_path(spark, "ngrams")
    folder = mounted(path)
    texts = texts.select(F.col(text).alias("text"))
    n_ranges = 1 << bits
    schema = "range long, n long, tokens long, hashes string, counts string"

    def write_words(table: pa.Table) -> pa.Table:
        high, low, c = _joined(table)
        (h,), (c,) = summed([(high.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)], [c])
        files = {"hashes": save(folder, "word", h), "counts": save(folder, "count", c)}
        return _manifest([{"range": table.column("range")[0].as_py(), "n": len(h), "tokens": int(c.sum()), **files}], schema)

    # one row per range
    made = cut(_count_words(texts, bits).groupBy("range").applyInArrow(write_words, schema)).collect()
    model = Model(bits, [None] * n_ranges, [0] * n_ranges, [None] * n_ranges, [None] * n_ranges)
    sizes = np.zeros(n_ranges, dtype=np.int64)
    for r in made:
        model.words[r["range"]] = (r["hashes"], r["counts"])
        sizes[r["range"]] = r["n"]
    model.bases = (np.cumsum(sizes) - sizes).tolist()
    model.n_words, model.n_tokens = int(sizes.sum()), sum(r["tokens"] for r in made)
    model.n_docs = texts.count()
    _count_pairs(texts, model, folder, sizes)
    return model


def _count_pairs(texts: DataFrame, model: Model, folder: str, sizes: np.ndarray) -> None:
    """Pairs, and from them what the smoothing needs of each word."""
    bits, bases, n_words = model.bits, np.array(model.bases), model.n_words

    def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for group in token_groups(_texts(batch)):
                u, v, _ = reader.pairs(group)
                (u, v), (c,) = summed([u, v], [np.ones(len(u), dtype=np.int64)])
                where = (pair_hash(u, v) >> np.uint64(64 - bits)).astype(np.uint16)
                # of the left word, which rows are ordered by, only the steps are kept
                rows = [{"range": r, "sums": packed([np.diff(a, prepend=0), b, n])} for r, (a, b, n) in by_range(where, [u, v, c])]
                yield from _manifest(rows, "range long, sums binary").to_batches()

    schema = "kind long, range long, sums binary, hashes string, counts string, n long, n1 long, n2 long, n3 long, n4 long"

    def write_pairs(table: pa.Table) -> pa.Table:
        u, v, c = _unpacked_pairs(table.column("sums"), n_words)
        (u, v), (c,) = summed([u, v], [c])
        keys = pair_hash(u, v)
        order = np.argsort(keys)
        files = {"hashes": save(folder, "pair", keys[order]), "counts": save(folder, "times", c[order].astype(np.uint32 if c.max() < 2**32 else np.int64))}
        ones = [(c == k).astype(np.int64) for k in (1, 2)] + [(c > 2).astype(np.int64)]
        (begun,), kinds = summed([u], ones)
        (ended,), (times,) = summed([v], [np.ones(len(v), dtype=np.int64)])
        numbers = np.r_[begun, ended]
        zeros = lambda n: np.zeros(n, dtype=np.int64)
        columns = [np.r_[k, zeros(len(ended))] for k in kinds] + [np.r_[zeros(len(begun)), times]]
        (numbers,), columns = summed([numbers], columns)
        home = np.searchsorted(bases, np.minimum(numbers, n_words - 1), side="right") - 1
        rows = [{"kind": 0, "range": table.column("range")[0].as_py(), "n": len(c), **{f"n{k}": int((c == k).sum()) for k in (1, 2, 3, 4)}, **files}]
        rows += [{"kind": 1, "range": r, "sums": packed([np.diff(x[0], prepend=0), *x[1:]])} for r, x in by_range(home.astype(np.uint16), [numbers, *columns])]
        return _manifest(rows, schema)

    written = cut(texts.mapInArrow(pair_sums, "range long, sums binary").groupBy("range").applyInArrow(write_pairs, schema))
    # one row per range
    made = written.where("kind = 0").drop("sums").collect()
    for r in made:
        model.pairs[r["range"]] = (r["hashes"], r["counts"])
    model.n_pairs = sum(r["n"] for r in made)
    model.pair_discounts = discounts([sum(r[f"n{k}"] for r in made) for k in (1, 2, 3, 4)])
    node_schema = "range long, file string, n1 long, n2 long, n3 long, n4 long, more long, s1 long, s2 long, s3 long"

    def write_nodes(table: pa.Table) -> pa.Table:
        r = table.column("range")[0].as_py()
        parts = [unpacked(b) for b in table.column("sums").to_pylist()]
        numbers, *columns = (np.concatenate(x) for x in zip(*[(np.cumsum(s), *rest) for s, *rest in parts]))
        (numbers,), columns = summed([numbers], columns)
        nodes = np.zeros((int(sizes[r]), 4), dtype=np.int64)
        own = numbers < n_words
        nodes[numbers[own] - bases[r]] = np.stack(columns, axis=1)[own]
        start = [int(c[~own].sum()) for c in columns]
        ends = nodes[:, 3]
        row = {"range": r, "file": save(folder, "node", nodes), "more": int((ends > 2).sum()), **{f"n{k}": int((ends == k).sum()) for k in (1, 2, 3, 4)}}
        return _manifest([row | {f"s{k + 1}": start[k] for k in range(3)}], node_schema)

    made = cut(written.where("kind = 1").select("range", "sums").groupBy("range").applyInArrow(write_nodes, node_schema)).collect()
    for r in made:
        model.nodes[r["range"]] = r["file"]
    n = [sum(r[f"n{k}"] for r in made) for k in (1, 2, 3, 4)]
    model.word_discounts = discounts(n)
    model.words_by_ends = (n[0], n[1], sum(r["more"] for r in made))
    model.start_node = [sum(r[f"s{k}"] for r in made) for k in (1, 2, 3)] + [0]


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``perplexity``.

    Tokens are the words and one end. ``n_known`` counts tokens seen in
    training, ``base_score`` is by add-one counts, ``score`` is the model's
    log10 probability. A null text is an empty one: its end alone is scored.
    With no training text, the distribution is uniform over one unknown word.
    Equal texts get equal scores; columns with these names are replaced.
    """

    @F.pandas_udf("n_tokens long, n_known long, base_score double, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for batch in batches:
            for group in token_groups(batch.tolist()):
                yield pd.DataFrame(reader.score(group))

    s = spare(df, "scores")
    done = df.withColumn(s, run(F.col(text)))
    names = ("n_tokens", "n_known", "base_score", "score")
    done = done.withColumns({n: F.col(s)[n] for n in names}).withColumn("train_tokens", F.lit(model.n_tokens).cast("long"))
    return done.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))).drop(s)
