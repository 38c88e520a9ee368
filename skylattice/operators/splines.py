"""Additive models of penalised B-splines.

A smooth term is a sum of cubic B-splines on even knots, and its roughness
the sum of the squared second differences of their coefficients. How much
roughness costs is chosen by generalised cross-validation. Both the fits and
the choice need nothing but the Gram sums of the basis, so the rows are read
once, however many penalties are tried.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gram import Fit, Gram, gram_sums

#: Penalties tried for each smooth term, from almost none to a straight line.
PENALTIES = tuple(10.0**k for k in np.arange(-4, 8.5, 0.5))


@dataclass(frozen=True)
class Smooth:
    """A smooth term of a column; a cyclic one meets itself at the ends."""

    column: str
    splines: int = 10
    cyclic: bool = False
    low: float | None = None
    high: float | None = None


def bump(u: Column) -> Column:
    """The cubic B-spline on the knots 0 to 4."""
    near = F.abs(u - 2.0)
    inner = (4.0 - 6.0 * near * near + 3.0 * near * near * near) / 6.0
    outer = (2.0 - near) * (2.0 - near) * (2.0 - near) / 6.0
    return F.when(near < 1.0, inner).when(near < 2.0, outer).when(near.isNotNull(), F.lit(0.0))


def basis(smooth: Smooth, low: float, high: float) -> dict[str, Column]:
    """Columns of the basis between ``low`` and ``high``. Values outside are
    held at the end; of a cyclic term they are moved by whole periods."""
    n, width = smooth.splines, (high - low) or 1.0
    x = F.col(smooth.column).cast("double")
    if smooth.cyclic:
        at = (x - low) / width * n
        at = at - n * F.floor(at / n)
        # the bump of spline j begins at knot j and goes on at the beginning
        return {f"s_{smooth.column}_{j}": bump(F.pmod(at - j, F.lit(float(n)))) for j in range(n)}
    at = F.least(F.greatest((x - low) / width, F.lit(0.0)), F.lit(1.0)) * (n - 3)
    return {f"s_{smooth.column}_{j}": bump(at - (j - 3)) for j in range(n)}


def roughness(smooth: Smooth) -> np.ndarray:
    """Squared second differences of the coefficients, as a matrix."""
    n = smooth.splines
    step = np.eye(n)
    if smooth.cyclic:
        second = np.roll(step, -1, axis=0) - 2 * step + np.roll(step, 1, axis=0)
    else:
        second = np.diff(step, 2, axis=0)
    return second.T @ second


@dataclass
class Additive:
    """A fitted sum of smooth and plain terms."""

    smooths: list[Smooth]
    terms: dict[str, Column]
    gram: Gram
    penalties: list[float]
    fit: Fit

    def predicted(self) -> Column:
        return self.fit.predicted(self.terms)

    def freedom(self) -> list[tuple[str, float, float]]:
        """(column, penalty, effective degrees of freedom) of each smooth term."""
        xx, _, _, _ = self.gram.centred()
        share = np.diag(self.fit.inverse @ xx)
        names = self.gram.names
        return [(s.column, p, float(sum(share[names.index(n)] for n in names if n in _names(s)))) for s, p in zip(self.smooths, self.penalties)]


def _names(smooth: Smooth) -> set[str]:
    return {f"s_{smooth.column}_{j}" for j in range(smooth.splines)}


def penalty_matrix(gram: Gram, smooths: Sequence[Smooth], penalties: Sequence[float]) -> np.ndarray:
    """Roughness of all smooth terms, on the scaled coefficients that the sums are in."""
    out = np.zeros((len(gram.names), len(gram.names)))
    for s, p in zip(smooths, penalties):
        at = [gram.names.index(f"s_{s.column}_{j}") for j in range(s.splines)]
        own = 1.0 / gram.scale[at]
        out[np.ix_(at, at)] = p * roughness(s) * np.outer(own, own)
    return out


def choose(gram: Gram, smooths: Sequence[Smooth], penalties: Sequence[float] = PENALTIES) -> list[float]:
    """The penalties of the least generalised cross-validation, one term at a
    time in turn until none changes."""
    now = [1.0] * len(smooths)
    for _ in range(20):
        before = list(now)
        for k in range(len(smooths)):
            rated = [(gram.fit(penalty_matrix(gram, smooths, [*now[:k], p, *now[k + 1 :]])).gcv(), -p) for p in penalties]
            # of equal scores the smoother fit
            now[k] = -min(rated)[1]
        if now == before:
            break
    return now


def additive(
    df: DataFrame, smooths: Sequence[Smooth], label: str, plain: dict[str, Column] | None = None, penalties: Sequence[float] | None = None
) -> Additive:
    """Fit ``label`` by smooth terms and unpenalised ``plain`` ones.

    Without ``penalties`` (one per smooth term) they are chosen. Rows without
    a term or the label are left out.
    """
    ends = df.agg(*[f(F.col(s.column).cast("double")).alias(f"{i}{k}") for i, s in enumerate(smooths) for k, f in (("a", F.min), ("b", F.max))]).first()
    terms: dict[str, Column] = {}
    for i, s in enumerate(smooths):
        low, high = (v if v is not None else e for v, e in ((s.low, ends[f"{i}a"]), (s.high, ends[f"{i}b"])))
        if low is None or high is None:
            raise ValueError(f"{s.column} has no value")
        terms |= basis(s, float(low), float(high))
    terms |= plain or {}
    gram = gram_sums(df, terms, F.col(label))[None]
    chosen = list(penalties) if penalties is not None else choose(gram, smooths)
    return Additive(list(smooths), terms, gram, chosen, gram.fit(penalty_matrix(gram, smooths, chosen)))
