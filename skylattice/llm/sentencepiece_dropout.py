"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding starts from single characters and keeps an agenda of adjacent pairs
whose join is a piece, best score first, the leftmost of equal ones. A pair
that comes up is skipped when the keyed hash of (seed, variant, left, right)
falls below the dropout: the same merge type is then skipped everywhere in
that variant, and another seed or variant gives other segmentations. What no
piece covers is written as byte pieces, and so is a literal U+2581, which the
pieces use for the blank; decoding therefore gives every text back exactly.
Whether a merge type is skipped is looked up once for each variant.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from .common import spare

BLANK = "▁"
#: Segmentations over which rows are dealt.
VARIANTS = 4
#: Chunks whose identifiers a worker keeps, over all variants, in each of two
#: generations: what is asked for again in the younger one outlives the older one.
KEPT_CHUNKS = 300_000
#: Chunks up to this length are merged with a list for an agenda, longer ones with a heap.
SHORT = 64
#: A symbol is a piece's identifier, or for a character without one its code
#: point above all identifiers; two symbols make one number.
BITS = 22
MASK = (1 << BITS) - 1
NONE = 1 << 62
#: Rows whose identifiers are held at a time.
ROWS = 500
#: Kinds of character; the pieces of a vocabulary seldom mix them.
KINDS = {"space": r"[\t\n\r]", "mark": r"[!-/:-@\[-`{-~]", "other": rf"[^\t\n\r!-/:-@\[-`{{-~{BLANK}]"}


@lru_cache(maxsize=None)
def kind(character: str) -> str:
    return next((k for k, p in KINDS.items() if re.match(p, character)), "blank")


class Symbols(dict):
    """Character to symbol."""

    def __init__(self, ids: dict[str, int], base: int):
        super().__init__((c, i) for c, i in ids.items() if len(c) == 1)
        self.base = base

    def __missing__(self, character: str) -> int:
        # one entry for a code point at most
        symbol = self[character] = self.base + ord(character)
        return symbol


class Pieces:
    """The pieces of a model file and the places no merge can cross."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        byte = [i for i in ids if model.is_byte(i)]
        self.byte_ids = sorted(byte, key=lambda i: int(model.id_to_piece(i)[3:5], 16))
        self.names = [model.id_to_piece(i) for i in ids]
        self.ids = {self.names[i]: i for i in ids if i not in special and i not in set(byte)}
        order = sorted(self.ids, key=lambda p: (-model.get_score(self.ids[p]), self.ids[p]))
        self.ordered = order
        self.ranks = {p: rank for rank, p in enumerate(order)}
        self.surface = [n.replace(BLANK, " ") if n in self.ids else "" for n in self.names]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.spelled = [bytes([self.byte_of[i]]) if i in self.byte_of else x.encode() for i, x in enumerate(self.surface)]
        self.base = len(self.names)
        self.symbols = Symbols(self.ids, self.base)
        self.merges = [*self._merge_types()]
        if len(self.byte_ids) != 256:
            raise ValueError("a model with byte pieces is needed to decode every text")
        self.chunks = re.compile(self._chunk_pattern(), re.DOTALL).findall

    def _merge_types(self) -> Iterator[tuple[str, str, int, int]]:
        """Every piece cut in two symbols: both parts, the number of the pair,
        and the rank of the piece above its identifier."""
        for rank, piece in enumerate(self.ordered):
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if (len(left) == 1 or left in self.ids) and (len(right) == 1 or right in self.ids):
                    one, two = (self.symbols[x] if len(x) == 1 else self.ids[x] for x in (left, right))
                    yield left, right, one << BITS | two, rank << BITS | self.ids[piece]

    def _chunk_pattern(self) -> str:
        """Matches stretches that can be encoded one by one.

        Two neighbouring characters may be parted if no piece has a character
        of the first kind just before one of the second.
        """
        mixed = {(kind(a), kind(b)) for p in self.ids for a, b in zip(p, p[1:])}
        joined = [(a, b) for a, b in mixed if a != b and "blank" not in (a, b)]
        if any(b == "blank" and a != "blank" for a, b in mixed):
            return ".+"
        if not joined:
            runs = "|".join(f"{p}+" for p in KINDS.values())
            return f"{BLANK}+(?:{runs})?|{runs}"
        return f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+"


def allowed_merges(pieces: Pieces, key: str, dropout: float) -> dict[int, int]:
    """Pairs of symbols that may be merged, with the rank of the joined piece
    above its identifier. A merge type is left out, and so skipped whenever it
    comes up, if the keyed hash of its two pieces falls below the dropout."""
    limit = int(dropout * 2**64)
    if not limit:
        return {k: v for _, _, k, v in pieces.merges}
    kept = {}
    for left, right, k, v in pieces.merges:
        if xxhash.xxh64_intdigest(f"{key}\0{left}\0{right}".encode()) >= limit:
            kept[k] = v
    return kept


class Encoder(dict):
    """Chunk to identifiers in one variant, as packed 32-bit numbers, filled
    when first asked for. Long chunks are worked out each time, so what is
    kept is bounded in bytes too."""

    def __init__(self, pieces: Pieces, key: str, dropout: float, kept: int):
        super().__init__()
        self.kept, self.older = kept, {}
        self.pieces = pieces
        self.merges = allowed_merges(pieces, key, dropout)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = self._encode(chunk)
        if len(chunk) <= SHORT:
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[chunk] = ids
        return ids

    def _encode(self, chunk: str) -> bytes:
        symbols = self._merged(chunk) if len(chunk) <= SHORT else self._merged_by_heap(chunk)
        if max(symbols) >= self.pieces.base:
            spelled, base = self.pieces.byte_ids, self.pieces.base
            symbols = [i for s in symbols for i in ([s] if s < base else [spelled[b] for b in chr(s - base).encode()])]
        return array("i", symbols).tobytes()

    def _merged(self, chunk: str) -> list[int]:
        """The agenda is a list of merges by place, which is quick to search
        while it is short; the first of the least ranks is taken."""
        merge_of = self.merges.get
        symbols = [*map(self.pieces.symbols.__getitem__, chunk)]
        agenda = [merge_of(a << BITS | b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda and (merge := min(agenda)) != NONE:
            i = agenda.index(merge)
            joined = symbols[i] = merge & MASK
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = merge_of(joined << BITS | symbols[i + 1], NONE)
            if i:
                agenda[i - 1] = merge_of(symbols[i - 1] << BITS | joined, NONE)
        return symbols

    def _merged_by_heap(self, chunk: str) -> list[int]:
        """The same with a heap and a linked list, for chunks of any length.
        Agenda entries are the merge and the place of its left symbol in one
        number."""
        merge_of, n = self.merges.get, len(chunk)
        symbols = [*map(self.pieces.symbols.__getitem__, chunk)]
        agenda = []
        for i in range(n - 1):
            if (m := merge_of(symbols[i] << BITS | symbols[i + 1])) is not None:
                agenda.append(m << 32 | i)
        heapify(agenda)
        after, before = [*range(1, n + 1)], [*range(-1, n)]
        while agenda:
            entry = heappop(agenda)
            merge, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            # stale when a neighbour has merged since it was put on the agenda
            if j == n or symbols[i] < 0 or merge_of(symbols[i] << BITS | symbols[j]) != merge:
                continue
            joined = symbols[i] = merge & MASK
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := merge_of(joined << BITS | symbols[k])) is not None:
                    heappush(agenda, m << 32 | i)
            h = before[i]
            if h >= 0 and (m := merge_of(symbols[h] << BITS | joined)) is not None:
                heappush(agenda, m << 32 | h)
        return [s for s in symbols if s >= 0]


class Codec:
    """Encodes in each variant and decodes."""

    def __init__(self, path: str, seed: int, dropout: float, variants: int):
        self.pieces = Pieces(path)
        self.encoders = [Encoder(self.pieces, f"{seed}/{v}", dropout, KEPT_CHUNKS // variants) for v in range(variants)]
        self.literal = array("i", [self.pieces.byte_ids[b] for b in BLANK.encode("utf-8")]).tobytes()

    def packed(self, text: str | None, variant: int) -> bytes:
        """Identifiers as 32-bit numbers one behind the other."""
        if not text:
            return b""
        lookup, chunks = self.encoders[variant].__getitem__, self.pieces.chunks
        parts = f" {text}".split(BLANK)
        return self.literal.join([b"".join(map(lookup, chunks(part.replace(" ", BLANK)))) for part in parts])

    def encode(self, text: str | None, variant: int) -> list[int]:
        return np.frombuffer(self.packed(text, variant), dtype=np.int32).tolist()

    def decode(self, ids: Sequence[int]) -> str:
        numbers = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join(map(self.pieces.spelled.__getitem__, numbers)).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def codec(path: str, seed: int, dropout: float, variants: int) -> Codec:
    return Codec(path, seed, dropout, variants)


def _texts(texts: pa.Array) -> Iterator[str | None]:
    """The texts of a batch, some at a time."""
    for at in range(0, len(texts), ROWS):
        yield from texts.slice(at, ROWS).to_pylist()


def _encoded(tool: Codec, texts: pa.Array, which: pa.Array) -> Iterator[bytes | None]:
    for text, variant in zip(_texts(texts), which.to_pylist()):
        yield None if text is None else tool.packed(text, variant)


def lists(packed: Iterable[bytes | None]) -> pa.Array:
    """A list column of 32-bit numbers from their bytes."""
    parts = [*packed]
    ends = np.cumsum([0, *(len(p) // 4 if p else 0 for p in parts)])
    offsets = pa.array(ends.astype(np.int32), mask=np.array([*(p is None for p in parts), False]))
    values = np.frombuffer(b"".join(p for p in parts if p), dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def encode(df: DataFrame, path: str, variant_of: Column, text: str = "text", out: str = "ids", seed: int = 0, dropout: float = 0.1, variants: int = VARIANTS) -> DataFrame:
    """``df`` with the piece identifiers of ``text`` in an array column ``out``.

    ``variant_of`` is any column expression; its hash picks one of
    ``variants`` segmentations for the row, a null picks one like any value.
    ``path`` must be a file that all workers have. A null text has null
    identifiers and an empty text an empty array. Equal rows get equal
    identifiers. Texts are encoded whole, one at a time.
    """

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tool = codec(path, seed, dropout, variants)
        for texts, which in batches:
            yield lists(_encoded(tool, texts, which))

    variant = F.pmod(F.xxhash64(variant_of, F.lit(seed)), F.lit(variants)).cast("int")
    return df.withColumn(out, run(F.col(text), variant))


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of the identifiers in ``ids``; null for null."""

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tool = codec(path, 0, 0.0, 1)
        for batch in batches:
            yield pd.Series([None if i is None else tool.decode(i) for i in batch], dtype="object")

    return df.withColumn(out, run(F.col(ids)))


def encode_checked(df: DataFrame, path: str, variant_of: Column, text: str = "text", seed: int = 0, dropout: float = 0.1, variants: int = VARIANTS) -> DataFrame:
    """``df`` with ``ids``, ``n_pieces`` and ``lossless``: whether decoding the
    identifiers gave the text back. Both are null for a null text.

    Columns of ``df`` with these names are replaced.
    """

    @F.arrow_udf("struct<ids: array<int>, lossless: boolean>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        tool = codec(path, seed, dropout, variants)
        for texts, which in batches:
            ids, same = [], []
            for text, found in zip(_texts(texts), _encoded(tool, texts, which)):
                ids.append(found)
                same.append(None if found is None else tool.decode(np.frombuffer(found, dtype=np.int32)) == text)
            yield pa.StructArray.from_arrays([lists(ids), pa.array(same, type=pa.bool_())], names=["ids", "lossless"])

    variant = F.pmod(F.xxhash64(variant_of, F.lit(seed)), F.lit(variants)).cast("int")
    both = spare(df, "encoded")
    done = df.withColumn(both, run(F.col(text), variant))
    return done.withColumns(
        {"ids": F.col(both)["ids"], "n_pieces": F.size(F.col(both)["ids"]).cast("long"), "lossless": F.col(both)["lossless"]}
    ).withColumn("n_pieces", F.when(F.col("ids").isNotNull(), F.col("n_pieces"))).drop(both)
