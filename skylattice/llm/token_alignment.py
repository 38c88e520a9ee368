"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

The bytes of a text are the columns of two incidence matrices, one row per
token: A for the first tokenizer, B for the second. In compressed sparse rows
a row's entries are the bytes that the token covers. Gustavson's product
A.Bt goes over the entries (token, byte) of A, looks up the row of Bt for that
byte, and adds up per row of A: its entries are the overlap links, their
values the numbers of shared bytes. Where a token of A and one of B end at the
same byte the text is cut into groups; the product of the two token-by-group
matrices has an entry for every pair of tokens that share a group.

Texts are put side by side, so that one product serves many of them.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import SentencePieceProcessor

from .common import cut, spare
from .token_counts import byte_characters

BLANK = "▁"
#: Bytes of text whose matrices are held at a time; a longer text alone.
SIDE_BY_SIDE = 1 << 20
#: Entries that one step of a product expands; a longer row alone.
EXPANDED = 1 << 21
#: Rows of a batch that texts and results are held of at a time.
ROWS = 2000
#: Places of bytes and tokens; a text has fewer than 2^31 of them.
INDEX = np.int32


def runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... counts[0] numbers, and so on, in one array."""
    ends = np.cumsum(counts, dtype=INDEX)
    return np.arange(ends[-1] if len(ends) else 0, dtype=INDEX) + np.repeat((starts - ends + counts).astype(INDEX), counts)


def counted(lengths: np.ndarray) -> np.ndarray:
    """Where each row starts, and where the last one ends."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(INDEX)


@dataclass
class Rows:
    """A matrix in compressed sparse rows: row i has its entries at starts[i] up to starts[i + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def spans(cls, lengths: np.ndarray) -> "Rows":
        """Token by byte: row i covers the next lengths[i] columns."""
        starts = counted(lengths)
        return cls(starts, np.arange(starts[-1], dtype=INDEX), np.ones(starts[-1], dtype=INDEX), int(starts[-1]))

    @classmethod
    def members(cls, groups: np.ndarray, width: int) -> "Rows":
        """Token by group: one entry a row."""
        return cls(np.arange(len(groups) + 1, dtype=INDEX), groups.astype(INDEX), np.ones(len(groups), dtype=INDEX), width)

    def transposed(self) -> "Rows":
        rows = np.repeat(np.arange(len(self.starts) - 1, dtype=INDEX), np.diff(self.starts))
        starts = counted(np.bincount(self.columns, minlength=self.width))
        if (self.columns[1:] < self.columns[:-1]).any():
            order = np.argsort(self.columns, kind="stable")
            return Rows(starts, rows[order], self.values[order], len(self.starts) - 1)
        return Rows(starts, rows, self.values, len(self.starts) - 1)

    def times(self, other: "Rows") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Entries (row, column, value) of self.other, some rows at a time.

        A product's row i is the sum of the rows of ``other`` named by the
        entries of row i, each times its entry.
        """
        reach = np.diff(other.starts)[self.columns]
        upto = np.concatenate([[0], np.cumsum(reach, dtype=np.int64)])[self.starts]
        first, n = 0, len(self.starts) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(upto, upto[first] + EXPANDED, side="right")) - 1)
            entries = slice(self.starts[first], self.starts[last])
            counts = reach[entries]
            at = runs(other.starts[self.columns[entries]], counts)
            row = np.repeat(np.repeat(np.arange(first, last, dtype=INDEX), np.diff(self.starts[first : last + 1])), counts)
            column = other.columns[at]
            value = np.repeat(self.values[entries], counts) * other.values[at]
            first = last
            if not len(row):
                continue
            again = row[1:] == row[:-1]
            if (again & (column[1:] < column[:-1])).any():
                order = np.lexsort((column, row))
                row, column, value = row[order], column[order], value[order]
            # entries of one row and column stand side by side now
            new = np.flatnonzero(np.concatenate([[True], ~(again & (column[1:] == column[:-1]))]))
            yield row[new], column[new], np.add.reduceat(value, new)


def gathered(entries: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [*entries]
    if not parts:
        return (np.empty(0, dtype=INDEX),) * 3
    return tuple(np.concatenate(column) for column in zip(*parts))


class ByteLevel:
    """A byte-level vocabulary: identifiers and bytes of each entry.

    The merges are run by the ranks of the entries; that is right as long as
    the identifiers follow the merges, which is looked at first.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        added = {t["content"] for t in spec["added_tokens"]}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        joined = [vocabulary[left + right] for left, right in merges]
        if joined != sorted(joined):
            raise ValueError("identifiers do not follow the merges")
        ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items()}
        self.bytes = [b""] * (1 + max(spec["model"]["vocab"].values()))
        for token, i in ranks.items():
            self.bytes[i] = token
        self.encoding = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)


class WithBlank:
    """A SentencePiece model, which puts a blank in front of every text."""

    def __init__(self, path: str):
        self.model = SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(BLANK, " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


def names(n: int, *after: str) -> np.ndarray:
    """Decimal numbers below n, followed by each of the endings in turn."""
    return np.array([f"{i}{end}" for end in after for i in range(n)], dtype=object)


class Aligner:
    """Tokens of both vocabularies for many texts, and the links between them."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), WithBlank(b_path)
        self.lengths = [np.array([len(x) for x in t.bytes], dtype=np.int64) for t in (self.a, self.b)]
        # an A identifier is followed by "," or "|", a B identifier by ",", ";" or nothing
        self.size_a, self.size_b = len(self.a.bytes), len(self.b.bytes)
        self.names = np.concatenate([names(self.size_a, ",", "|"), names(self.size_b, ",", ";", "")])

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both lists of identifiers; empty if one does not spell out the text."""
        none = np.empty(0, dtype=np.int64)
        if not text:
            return none, none
        whole = f" {text}"
        spelled = whole.encode()
        b = self.b.encode(text)
        if b"".join(map(self.b.bytes.__getitem__, b)) != spelled:
            return none, none
        a = self.a.encode(whole)
        if b"".join(map(self.a.bytes.__getitem__, a)) != spelled:
            return none, none
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def align(self, texts: list[str | None], links: bool = False) -> dict[str, list]:
        """For each text its numbers of tokens, groups, overlap and shared-group
        links, the groups in writing, and ``pairs``: a * size_b + b of the
        links whose tokens end together. With ``links`` also the overlap links
        (place in A, place in B, shared bytes) and the shared-group links
        (place in A, place in B)."""
        both = [self.tokens(t) for t in texts]
        n = len(texts)
        n_a, n_b = (np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1))
        ids_a, ids_b = (np.concatenate([np.empty(0, dtype=np.int64), *(x[k] for x in both)]) for k in (0, 1))
        text_a, text_b = np.repeat(np.arange(n, dtype=INDEX), n_a), np.repeat(np.arange(n, dtype=INDEX), n_b)
        a, b = Rows.spans(self.lengths[0][ids_a]), Rows.spans(self.lengths[1][ids_b])
        i, j, shared = gathered(a.times(b.transposed()))
        together = a.starts[i + 1] == b.starts[j + 1]
        ends_a, ends_b = i[together], j[together]
        # a token belongs to the group of the first common end at or behind its own
        group_a = np.searchsorted(ends_a, np.arange(len(ids_a), dtype=INDEX))
        group_b = np.searchsorted(ends_b, np.arange(len(ids_b), dtype=INDEX))
        n_groups = np.bincount(text_a[ends_a], minlength=n)
        in_groups = Rows.members(group_a, len(ends_a)), Rows.members(group_b, len(ends_b)).transposed()
        same = np.zeros(n, dtype=np.int64)
        shares: list[tuple[np.ndarray, np.ndarray]] = []
        for x, y, _ in in_groups[0].times(in_groups[1]):
            same += np.bincount(text_a[x], minlength=n)
            if links:
                shares.append((x, y))
        pairs = ids_a[ends_a] * self.size_b + ids_b[ends_b]
        cuts = np.cumsum(n_groups)[:-1]
        written = self._written(ids_a, ids_b, group_a, group_b, text_a, text_b, n_groups)
        at = np.cumsum(n_a + n_b)[:-1]
        found = {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_overlaps": np.bincount(text_a[i], minlength=n), "n_shared": same,
            "groups": ["".join(part) for part in np.split(written, at)] if n else [],
            "pairs": np.split(pairs, cuts) if n else [],
        }
        if links:
            before_a, before_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
            x, y = (np.concatenate(s) for s in zip(*shares)) if shares else (i[:0], i[:0])
            for name, one, two, *rest in (("overlaps", i, j, shared), ("shares", x, y)):
                place = [one - before_a[text_a[one]], two - before_b[text_b[two]], *rest]
                found[name] = [[*zip(*(p[text_a[one] == t].tolist() for p in place))] for t in range(n)]
        return found

    def _written(self, ids_a, ids_b, group_a, group_b, text_a, text_b, n_groups) -> np.ndarray:
        """Identifiers with their separators, group after group, A before B."""
        size_a, size_b = self.size_a, self.size_b
        last_a, last_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        end_b = np.diff(text_b, append=-1) != 0
        out = np.empty(len(ids_a) + len(ids_b), dtype=object)
        # behind the B tokens of earlier groups, and behind the A tokens of its own
        first_b = np.searchsorted(group_b, np.arange(len(group_b) + 1))
        upto_a = np.searchsorted(group_a, np.arange(len(group_b) + 1), side="right")
        out[np.arange(len(ids_a)) + first_b[group_a]] = self.names[ids_a + size_a * last_a]
        out[np.arange(len(ids_b)) + upto_a[group_b]] = self.names[2 * size_a + ids_b + size_b * (last_b.astype(np.int64) + end_b)]
        return out


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def side_by_side(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in lists of bounded size, a longer text alone."""
    some: list[str | None] = []
    size = 0
    for t in texts:
        if some and size + len(t or "") > SIDE_BY_SIDE:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t or "")
    if some:
        yield some


_COUNTS = ("n_a", "n_b", "n_groups", "n_overlaps", "n_shared")


def align(df: DataFrame, a_path: str, b_path: str, text: str = "text", links: bool = False) -> DataFrame:
    """``df`` with a struct column ``alignment``.

    Fields: ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_overlaps`` and
    ``n_shared`` links, ``groups_sha256`` (of the groups in writing; '' without
    tokens), and ``pairs``: a number for the two identifiers of each link whose
    tokens end together. With ``links`` also ``groups`` in writing, ``overlaps``
    and ``shares``.

    A null or empty text, and one that a vocabulary does not spell out, has no
    tokens: zeros and empty lists. Equal texts get equal results; a column
    named ``alignment`` is replaced. Both files must be there for all workers.
    """
    wide = spare_type(a_path, b_path)
    fields = [*(f"{c}: bigint" for c in _COUNTS), "groups_sha256: string", f"pairs: array<{wide}>"]
    if links:
        fields += ["groups: string", "overlaps: array<struct<a: int, b: int, bytes: int>>", "shares: array<struct<a: int, b: int>>"]
    kind = pa.list_(pa.int32() if wide == "int" else pa.int64())
    shape = T.StructType.fromDDL(", ".join(fields))

    @F.arrow_udf(shape)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tool = aligner(a_path, b_path)
        for batch in batches:
            parts: list[pa.Array] = []
            for at in range(0, max(1, len(batch)), ROWS):
                for some in side_by_side(batch.slice(at, ROWS).to_pylist()):
                    parts.append(_as_struct(tool.align(some, links), kind, links))
            yield pa.concat_arrays(parts) if parts else _as_struct(tool.align([], links), kind, links)

    return df.withColumn("alignment", run(F.col(text)))


def _as_struct(found: dict, kind: pa.DataType, links: bool) -> pa.StructArray:
    digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
    flat = np.concatenate(found["pairs"]) if found["pairs"] else np.empty(0, dtype=np.int64)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in found["pairs"]])]).astype(np.int32)
    columns = {c: pa.array(found[c], type=pa.int64()) for c in _COUNTS}
    columns |= {"groups_sha256": pa.array(digest, type=pa.string()), "pairs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind.value_type))}
    if links:
        number = pa.int32()
        columns["groups"] = pa.array(found["groups"], type=pa.string())
        for name, keys in (("overlaps", ("a", "b", "bytes")), ("shares", ("a", "b"))):
            rows = [[dict(zip(keys, x)) for x in part] for part in found[name]]
            columns[name] = pa.array(rows, type=pa.list_(pa.struct([(k, number) for k in keys])))
    return pa.StructArray.from_arrays([*columns.values()], names=[*columns])


@lru_cache(maxsize=4)
def spare_type(a_path: str, b_path: str) -> str:
    """The smaller type that holds a number for every pair of identifiers."""
    tool = aligner(a_path, b_path)
    return "int" if tool.size_a * tool.size_b < 2**31 else "bigint"


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): in how many links of all texts the pair is linked, and
    whether no pair of the same B identifier has more.

    Two tokens that end together have one's bytes at the end of the other's,
    so there are at most as many pairs as both vocabularies have bytes (a
    byte may be spelled by two entries: twice as many), however long the texts.
    """
    pairs = aligned.select(F.explode("alignment.pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    pairs = cut(pairs.withColumn("b", F.col("pair") % size_b))
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def link_statistics(df: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``df`` without the text, with the counts of :func:`align`, ``n_links``
    (links whose tokens end together), ``n_best`` (those whose pair of
    identifiers is linked as often in all texts as any of its B identifier)
    and ``count_sum`` (over the links, how often their pair is linked).

    Columns of these names are replaced. Repeated rows count as texts of
    their own; an empty table stays empty.
    """
    row = spare(df, "row")
    tool = aligner(a_path, b_path)
    aligned = cut(align(df, a_path, b_path, text).drop(text).withColumn(row, F.monotonically_increasing_id()))
    # at most as many rows as the vocabularies have bytes
    counts = F.broadcast(cut(pair_counts(aligned, tool.size_b)))
    linked = aligned.select(F.col(row), F.explode("alignment.pairs").alias("pair")).join(counts, "pair")
    sums = linked.groupBy(row).agg(F.count(F.lit(1)).alias("n_links"), F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))
    lasting = [*(F.col("alignment")[c].alias(c) for c in (*_COUNTS, "groups_sha256"))]
    out = {*_COUNTS, "groups_sha256", "n_links", "n_best", "count_sum"}
    kept = [F.col(c) for c in aligned.columns if c != "alignment" and c not in out]
    found = aligned.select(*kept, *lasting).join(sums, row, "left").drop(row)
    return found.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_links", "n_best", "count_sum")})
