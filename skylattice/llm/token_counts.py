"""Token counts by byte-pair merging with a heap and a linked list.

A word starts as one symbol per byte. The adjacent pair of the lowest rank
(the leftmost of equal ones) is merged until no pair has a rank. The count is
the number of symbols at the start less the number of merges; no identifier
is ever looked up.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words, and chunks between blanks, whose counts a worker keeps; beyond that it starts anew.
KEPT_WORDS = 400_000
#: White space for Python, but not for the vocabulary's pattern.
SEPARATORS = re.compile("[\x1c-\x1f]").search


def byte_characters() -> list[str]:
    """The printable stand-in for each byte: itself where it is printable in
    Latin-1, else the next free character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(free)) for b in range(256)]


def count_after_merges(symbols: list[str], ranks: dict[str, dict[str, int]]) -> int:
    """How many symbols are left when all merges are done.

    ``ranks`` leads from the left symbol of a pair to the right one to the
    rank. An agenda entry is the rank and the place of the left symbol in one
    number, so that the heap orders by rank and then from left to right.
    """
    n = len(symbols)
    none: dict[str, int] = {}
    agenda = []
    for i in range(n - 1):
        if (r := ranks.get(symbols[i], none).get(symbols[i + 1])) is not None:
            agenda.append(r << 32 | i)
    heapify(agenda)
    after, before = [*range(1, n + 1)], [*range(-1, n)]
    merges = 0
    while agenda:
        entry = heappop(agenda)
        i = entry & 0xFFFFFFFF
        j = after[i]
        # an entry is stale when one of its symbols has changed since
        if j == n or ranks.get(symbols[i], none).get(symbols[j]) != entry >> 32:
            continue
        merges += 1
        joined = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = ""
        k = after[i] = after[j]
        following = ranks.get(joined, none)
        if k < n:
            before[k] = i
            if (r := following.get(symbols[k])) is not None:
                heappush(agenda, r << 32 | i)
        h = before[i]
        if h >= 0 and (r := ranks.get(symbols[h], none).get(joined)) is not None:
            heappush(agenda, r << 32 | h)
    return n - merges


class WordCounts(dict):
    """Word to number of tokens, filled when a word is first asked for."""

    def __init__(self, ranks: dict[str, dict[str, int]], suffix: str):
        super().__init__()
        self.ranks, self.suffix = ranks, suffix
        self.bytes = byte_characters()

    def __missing__(self, word: str) -> int:
        symbols = [self.bytes[b] for b in word.encode()]
        symbols[-1] += self.suffix
        if len(self) >= KEPT_WORDS:
            self.clear()
        n = self[word] = count_after_merges(symbols, self.ranks)
        return n


class ChunkCounts(dict):
    """Count of a chunk without blanks: the sum over its words."""

    def __init__(self, pieces, counts: WordCounts):
        super().__init__()
        self.pieces, self.counts = pieces, counts

    def __missing__(self, chunk: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        n = self[chunk] = sum(map(self.counts.__getitem__, self.pieces(chunk)))
        return n


class Counter:
    """Counts of whole texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        ranks: dict[str, dict[str, int]] = {}
        for i, (left, right) in enumerate(spec["model"]["merges"]):
            ranks.setdefault(left, {})[right] = i
        self.pieces = regex.compile(pattern).findall
        self.counts = WordCounts(ranks, spec["model"]["end_of_word_suffix"] or "")
        self.chunks = ChunkCounts(self.pieces, self.counts)
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special)))
        self.mark = min((s[:2] for s in special), default="")

    def plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # a capital sigma is lowered without regard to its place in the word
        text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
        if SEPARATORS(text):
            return sum(map(self.counts.__getitem__, self.pieces(text)))
        return sum(map(self.chunks.__getitem__, text.split()))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.mark and self.mark in text:
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_count(text: Column, path: str) -> Column:
    """Number of tokens of ``text`` under the vocabulary at ``path``.

    ``path`` is read by every worker, so it must be a file that all of them
    have. A null or empty text has 0 tokens. Texts are worked on one at a
    time, whole; besides them a worker holds at most ``KEPT_WORDS`` counts.
    """

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = counter(path)
        for batch in batches:
            yield pd.Series([tokens(t) for t in batch], dtype="int64")

    return count(text)


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``df`` with the token count of each row; a column named ``out`` is replaced.

    Equal rows get equal counts, an empty table stays empty, all other columns
    are left as they are.
    """
    return df.withColumn(out, token_count(F.col(text), path))
