"""Group means that share what they know: expectation-maximisation.

Each value is its group's mean plus noise of the group's own spread; the group
means scatter about a common centre. The expectation of a group's offset needs
its count, mean and sum of squares alone, so the rows are read once. A round
goes over the table of groups in place: a task works out the state of its
groups again from the centres and scatters of the rounds before, which are two
numbers each, and returns four sums. Nothing is kept between rounds that a
lost executor could take along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise


def replay(n: np.ndarray, mean: np.ndarray, squares: np.ndarray, rounds: list[tuple[float, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, their variances and the groups' own variances under the last
    of ``rounds`` of (centre, scatter)."""
    own = squares / (n - 1)
    for k, (centre, scatter) in enumerate(rounds):
        if k:
            # maximisation of the round before, with its own centre
            own = (squares + n * ((mean - centre - offset) ** 2 + unsure)) / n
        total = own + n * scatter
        offset, unsure = scatter * n * (mean - centre) / total, scatter * own / total
    return offset, unsure, own


def group_sums(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n, mean, squares); groups of one value or of equal values have
    no spread of their own and are left out."""
    sums = df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("v"))
    known = sums.where((F.col("n") > 1) & (F.col("v") > 0))
    return known.select(group, "n", "mean", ((F.col("n") - 1) * F.col("v")).alias("squares"))


def pooled_means(df: DataFrame, group: str, value: str, tolerance: float = 1e-6, most: int = 200) -> tuple[DataFrame, list[tuple[float, float]]]:
    """(group, n, mean, sigma, offset, pooled) and the (centre, scatter) of all rounds.

    Rounds end when the centre and the root of the scatter move by less than
    ``tolerance`` of the means' deviation, or after ``most``. Without groups
    the table is empty.
    """
    groups = materialise(group_sums(df, group, value))
    first = groups.agg(F.avg("mean").alias("m"), F.var_samp("mean").alias("v")).first()
    if first["m"] is None:
        first = {"m": 0.0, "v": 0.0}
    rounds = [(float(first["m"]), float(first["v"] or 0.0))]
    unit = rounds[0][1] ** 0.5
    names = ("n", "mean", "squares")

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, mean, squares = (batch[c].to_numpy("float64") for c in names)
            offset, unsure, own = replay(n, mean, squares, rounds)
            weight = n / own
            yield pd.DataFrame({"w": [weight.sum()], "c": [(weight * (mean - offset)).sum()], "s": [(offset**2 + unsure).sum()], "g": [float(len(n))]})

    numbers = groups.select(*names)
    for _ in range(most):
        r = numbers.mapInPandas(sums, "w double, c double, s double, g double").agg(*[F.sum(c).alias(c) for c in "wcsg"]).first()
        if not r["g"]:
            break
        rounds.append((r["c"] / r["w"], r["s"] / r["g"]))
        (a, b), (c, d) = rounds[-2:]
        if max(abs(c - a), abs(d**0.5 - b**0.5)) <= tolerance * unit:
            break

    def result(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            offset, _, own = replay(*(batch[c].to_numpy("float64") for c in names), rounds)
            yield batch[[group, "n", "mean"]].assign(sigma=np.sqrt(own), offset=offset, pooled=rounds[-1][0] + offset)

    fields = [groups.schema[group], groups.schema["n"], groups.schema["mean"], *[T.StructField(c, T.DoubleType()) for c in ("sigma", "offset", "pooled")]]
    return groups.mapInPandas(result, T.StructType(fields)), rounds
