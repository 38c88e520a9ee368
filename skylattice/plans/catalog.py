"""Registry of the queries."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUERIES: dict[str, Callable[["Tables"], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = ("sources", "selection", "joining", "aggregation", "series", "gridded", "scalars", "features", "models", "scores")


class Tables:
    """The given tables of one folder, read when first named."""

    NAMES = frozenset(
        "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Tables.NAMES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under an operator's name."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"skylattice.plans.{module}")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: (lambda spark, folder, fn=fn: fn(Tables(spark, folder))) for name, fn in _QUERIES.items()}


def oracle() -> dict[str, str]:
    _load()
    return dict(_SQL)


def rounded(df: DataFrame, digits: int = 4, exact: tuple[str, ...] = ()) -> DataFrame:
    """Doubles to a fixed number of decimals, so that the order in which a sum
    was taken does not show. Columns in ``exact`` are left as they are."""

    def cell(c: T.StructField):
        plain = c.name in exact or not isinstance(c.dataType, T.DoubleType)
        return F.col(c.name) if plain else F.round(c.name, digits).alias(c.name)

    return df.select(*[cell(c) for c in df.schema])


def in_cents(column: str):
    """Money as whole cents: sums of these are exact in any order."""
    return F.round(F.col(column) * 100).cast("long")


def stamp(column: str):
    """Timestamps as text."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)
