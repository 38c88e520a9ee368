"""Reproducible shuffle and sharding by a Feistel permutation of row numbers.

Row ``i`` of ``n`` goes to position ``permute(i)``: a balanced-enough Feistel
network over the smallest even number of bits that holds ``n``, walked along
its cycle until the value is below ``n``. Position ``p`` is slot ``p // shards``
of shard ``p % shards``, so shard and slot of any row, and the row of any
slot, can be computed without a table, and shard sizes differ by at most one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import number_rows, spare

ROUNDS = 6
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Permutation:
    """A permutation of 0..n-1, given by ``n`` and ``seed`` alone."""

    def __init__(self, n: int, seed: int = 0):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        with np.errstate(over="ignore"):
            start = mixed(np.array([seed % 2**64], dtype=np.uint64))
            self.keys = [mixed(start + np.uint64(r + 1) * _ODD)[0] for r in range(ROUNDS)]

    def _once(self, x: np.ndarray, keys: list) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        with np.errstate(over="ignore"):
            for key in keys:
                left, right = right, left ^ (mixed(right + key) & self.mask)
        # the halves are handed back swapped, so that the same network with the keys turned round undoes it
        return (right << self.half) | left

    def _walk(self, values: np.ndarray, keys: list) -> np.ndarray:
        x = self._once(np.asarray(values, dtype=np.uint64), keys)
        while (outside := x >= np.uint64(self.n)).any():
            x[outside] = self._once(x[outside], keys)
        return x.astype(np.int64)

    def position(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, self.keys)

    def row(self, positions: np.ndarray) -> np.ndarray:
        return self._walk(positions, self.keys[::-1])

    def place(self, rows: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each row number."""
        at = self.position(rows)
        return at % shards, at // shards

    def row_at(self, shard: int, slot: int, shards: int) -> int:
        """The row number in a slot of a shard."""
        return int(self.row(np.array([slot * shards + shard]))[0])


def shard_rows(df: DataFrame, order: list[Column], shards: int, seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` and ``slot``.

    Rows are numbered along ``order`` (nulls first); rows equal in it are
    numbered in any order, so include all that tells rows apart. An empty
    table gives an empty result. Columns of these three names are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    number = spare(df, "number")
    rows = number_rows(df.drop("row_number", "shard", "slot"), order, number)
    total = spare(df, "total")
    n = rows.agg(F.count(F.lit(1)).alias(total)).first()[0]
    permutation = Permutation(max(n, 1), seed)

    @F.pandas_udf(T.LongType())
    def position(numbers: pd.Series) -> pd.Series:
        return pd.Series(permutation.position(numbers.to_numpy()))

    at = spare(df, "at")
    placed = rows.withColumn(at, position(F.col(number)))
    return placed.withColumns(
        {"row_number": F.col(number), "shard": (F.col(at) % shards).cast("int"), "slot": F.floor(F.col(at) / shards).cast("long")}
    ).drop(number, at)
