"""Linear models from sums that merge.

All that least squares needs from the rows are the sums of products of the
terms and the answer (a Gram matrix). Every partition adds up its own, by fold
if wanted; partitions, folds and tables merge by addition, and a fold is left
out by subtraction. So all folds and all sets of terms cost one pass, and what
reaches the driver is a matrix of terms by terms, not of rows.

Terms are shifted and scaled by rough means and deviations first, which keeps
the sums accurate; results are in the terms' own units.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ordered import OrderedRows


@dataclass
class Gram:
    """Sums of products of (1, terms, answer), all shifted and scaled."""

    names: list[str]
    sums: np.ndarray
    shift: np.ndarray
    scale: np.ndarray

    @property
    def n(self) -> float:
        return float(self.sums[0, 0])

    def __add__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.sums + other.sums, self.shift, self.scale)

    def __sub__(self, other: "Gram") -> "Gram":
        return Gram(self.names, self.sums - other.sums, self.shift, self.scale)

    def of(self, names: Sequence[str]) -> "Gram":
        """The sums of some of the terms."""
        at = [self.names.index(n) for n in names]
        rows = [0, *(i + 1 for i in at), len(self.names) + 1]
        kept = [*at, len(self.names)]
        return Gram(list(names), self.sums[np.ix_(rows, rows)], self.shift[kept], self.scale[kept])

    def centred(self) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
        """Products about the means (terms, terms with answer, answer), and the means."""
        means = self.sums[0] / self.n
        about = self.sums - self.n * np.outer(means, means)
        return about[1:-1, 1:-1], about[1:-1, -1], float(about[-1, -1]), means

    def fit(self, penalty: np.ndarray | None = None) -> "Fit":
        """Least squares with an intercept, which a penalty leaves alone.

        Terms that others make up get the solution of least norm.
        """
        xx, xy, yy, means = self.centred()
        full = xx if penalty is None else xx + penalty
        inverse = np.linalg.pinv(full, rcond=1e-12, hermitian=True)
        slopes = inverse @ xy
        rest = max(0.0, yy - 2 * slopes @ xy + slopes @ xx @ slopes)
        return Fit(self, slopes, float(means[-1] - means[1:-1] @ slopes), inverse, rest, 1.0 + float(np.trace(inverse @ xx)))

    def r2(self, fit: "Fit") -> float | None:
        """Of a fit to other rows with the same terms, on these rows."""
        b = np.concatenate([[fit.intercept], fit.slopes])
        rest = self.sums[-1, -1] - 2 * b @ self.sums[:-1, -1] + b @ self.sums[:-1, :-1] @ b
        about = self.sums[-1, -1] - self.sums[0, -1] ** 2 / self.n if self.n else 0.0
        return float(1 - rest / about) if about > 0 else None


@dataclass
class Fit:
    """Slopes and intercept in shifted and scaled units, and how sure they are."""

    gram: Gram
    slopes: np.ndarray
    intercept: float
    inverse: np.ndarray
    rest: float
    #: Parameters, the intercept included; fewer where a penalty binds them.
    used: float

    @property
    def variance(self) -> float:
        """Of the residuals."""
        return self.rest / (self.gram.n - self.used) * self.gram.scale[-1] ** 2

    def gcv(self) -> float:
        """Generalised cross-validation: mean square over the squared share of freedom left."""
        return self.gram.n * self.rest / max(self.gram.n - self.used, 1e-9) ** 2

    def coefficients(self) -> tuple[np.ndarray, np.ndarray]:
        """Intercept and slopes in the terms' units, and their covariance."""
        g, size = self.gram, len(self.slopes)
        means = g.sums[0, 1:-1] / g.n
        # covariance of (value at the means, slopes), then moved to a term value of zero
        cov = np.zeros((size + 1, size + 1))
        cov[0, 0], cov[1:, 1:] = 1 / g.n, self.inverse
        move = np.zeros((size + 1, size + 1))
        move[0, 0] = g.scale[-1]
        move[0, 1:] = -g.scale[-1] * (means + g.shift[:-1] / g.scale[:-1])
        move[1:, 1:] = np.diag(g.scale[-1] / g.scale[:-1])
        at_means = self.intercept + means @ self.slopes
        values = move @ np.concatenate([[at_means], self.slopes])
        values[0] += g.shift[-1]
        return values, move @ cov @ move.T * self.variance / g.scale[-1] ** 2

    def predicted(self, terms: dict[str, Column]) -> Column:
        values, _ = self.coefficients()
        out = F.lit(float(values[0]))
        for name, b in zip(self.gram.names, values[1:]):
            out = out + terms[name] * F.lit(float(b))
        return out

    def leverage(self, terms: dict[str, Column]) -> Column:
        """1/n plus the squared length of the row's terms in units of the fit."""
        g = self.gram
        means = g.sums[0, 1:-1] / g.n
        # rows of the Cholesky factor of the inverse
        values, vectors = np.linalg.eigh(self.inverse)
        half = vectors * np.sqrt(np.maximum(values, 0.0))
        x = [(terms[n] - F.lit(float(s))) / F.lit(float(c)) - F.lit(float(m)) for n, s, c, m in zip(g.names, g.shift, g.scale, means)]
        out = F.lit(1.0 / g.n)
        for k in range(half.shape[1]):
            if values[k] > 0:
                side = F.lit(0.0)
                for column, weight in zip(x, half[:, k]):
                    side = side + column * F.lit(float(weight))
                out = out + side * side
        return out


def gram_sums(df: DataFrame, terms: dict[str, Column], answer: Column, fold: str | None = None) -> dict[int | None, Gram]:
    """Sums of products by fold (an integer column of few values; without it
    the only key is None), in one pass after one for means and deviations.

    Rows with a null or NaN in a term or the answer are left out.
    """
    names = list(terms)
    columns = [c.cast("double").alias(f"x{i}") for i, c in enumerate([*terms.values(), answer])]
    rows = df.select(*columns, (F.col(fold).cast("int") if fold else F.lit(0)).alias("fold"))
    values = [f"x{i}" for i in range(len(columns))]
    for v in values:
        rows = rows.where(F.col(v).isNotNull() & ~F.isnan(v))
    rough = rows.agg(*[F.avg(v).alias(f"m_{v}") for v in values], *[F.stddev_pop(v).alias(f"s_{v}") for v in values]).first()
    if rough["m_x0"] is None:
        raise ValueError("no row has all terms and the answer")
    shift = np.array([rough[f"m_{v}"] for v in values])
    scale = np.array([rough[f"s_{v}"] or 1.0 for v in values])
    size = len(values) + 1

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), (batch[values].to_numpy("float64") - shift) / scale])
            folds = batch["fold"].to_numpy()
            for f in np.unique(folds):
                part = x[folds == f]
                sums[int(f)] = sums.get(int(f), 0.0) + part.T @ part
        for f, s in sums.items():
            yield pd.DataFrame({"fold": f, "place": np.arange(size * size), "total": s.ravel()})

    parts = rows.mapInPandas(add_up, "fold int, place int, total double")
    # terms by terms, for each fold
    merged = parts.groupBy("fold", "place").agg(F.sum("total").alias("total")).collect()
    out: dict[int | None, np.ndarray] = {}
    for r in merged:
        out.setdefault(r["fold"] if fold else None, np.zeros(size * size))[r["place"]] = r["total"]
    return {f: Gram(names, s.reshape(size, size), shift, scale) for f, s in sorted(out.items(), key=lambda x: (x[0] is None, x[0] or 0))}


# --- Student's t ---------------------------------------------------------


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_share(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    # Lentz's evaluation from the front
    tiny, c, d = 1e-300, 1.0, 1.0 / max(1e-300, 1 - (a + b) * x / (a + 1))
    value = d
    for m in range(1, 10_000):
        for even in (True, False):
            if even:
                step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
            else:
                step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
            d = 1 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return front * value


def student_t(prob: float, dof: float) -> float:
    """Quantile of Student's t, at every probability and freedom the same way."""
    if not 0 < prob < 1 or dof <= 0:
        raise ValueError("a probability between 0 and 1 and a positive freedom are needed")
    if prob < 0.5:
        return -student_t(1 - prob, dof)
    if prob == 0.5:
        return 0.0
    tail = 2 * (1 - prob)
    beyond = lambda t: beta_share(dof / 2, 0.5, dof / (dof + t * t))
    low, high = 0.0, 1.0
    while beyond(high) > tail:
        low, high = high, 2 * high
    while (middle := (low + high) / 2) not in (low, high):
        low, high = (middle, high) if beyond(middle) > tail else (low, middle)
    return high


# --- what is made of a fit -----------------------------------------------


def term_table(fit: Fit, level: float = 0.95) -> list[tuple[str, float, float, float, float]]:
    """(term, estimate, standard error, lower, upper), the intercept first."""
    values, cov = fit.coefficients()
    t = student_t(0.5 + level / 2, fit.gram.n - fit.used)
    errors = np.sqrt(np.maximum(np.diag(cov), 0.0))
    return [(n, float(v), float(e), float(v - t * e), float(v + t * e)) for n, v, e in zip(["intercept", *fit.gram.names], values, errors)]


def with_intervals(df: DataFrame, fit: Fit, terms: dict[str, Column], answer: Column, level: float = 0.95) -> DataFrame:
    """``df`` with ``fit``, ``residual``, ``leverage``, ``standardised`` (the
    residual over its own standard deviation), and the confidence and the
    prediction interval. A row without a term or answer has nulls."""
    t, spread = student_t(0.5 + level / 2, fit.gram.n - fit.used), math.sqrt(fit.variance)
    rows = df.withColumns({"fit": fit.predicted(terms), "leverage": fit.leverage(terms)})
    rows = rows.withColumn("residual", answer - F.col("fit"))
    lever, at = F.col("leverage"), F.col("fit")
    own = F.lit(spread) * F.sqrt(1 - lever)
    conf, pred = F.lit(t * spread) * F.sqrt(lever), F.lit(t * spread) * F.sqrt(1 + lever)
    return rows.withColumns(
        {
            "standardised": F.when(own > 0, F.col("residual") / own),
            "conf_lower": at - conf, "conf_upper": at + conf, "pred_lower": at - pred, "pred_upper": at + pred,
        }
    )


def with_normal_quantile(df: DataFrame, column: str, ids: Sequence[str], out: str = "normal") -> DataFrame:
    """``df`` with the normal quantile that belongs to the rank of ``column``:
    where the points of a quantile plot lie. Ties go by ``ids``; nulls get none."""
    known = F.col(column).isNotNull()
    n = df.where(known).count()

    @F.pandas_udf("double")
    def quantile(share: pd.Series) -> pd.Series:
        return share.map(NormalDist().inv_cdf, na_action="ignore").astype("float64")

    ranked = OrderedRows(df.where(known), [], [column, *ids]).row_number("__rank").finish()
    placed = ranked.withColumn(out, quantile((F.col("__rank") - 0.5) / F.lit(float(n)))).drop("__rank")
    return placed.unionByName(df.where(~known).withColumn(out, F.lit(None).cast("double")))


def fold_scores(grams: dict[int, Gram], sets: dict[str, Sequence[str]]) -> list[tuple[str, int, float | None]]:
    """(set, fold, r2) of every set of terms, each fold scored by the fit to all others."""
    whole = sum([*grams.values()][1:], [*grams.values()][0])
    out = []
    for name, terms in sets.items():
        for f, held in grams.items():
            out.append((name, f, held.of(terms).r2((whole - held).of(terms).fit())))
    return out
