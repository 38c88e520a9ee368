"""Units of columns, kept in the column metadata and checked before a job
is planned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unit -> (base unit, factor, offset); base = value * factor + offset.
UNITS = {
    "K": ("K", 1.0, 0.0),
    "celsius": ("K", 1.0, 273.15),
    "fahrenheit": ("K", 5.0 / 9.0, 459.67 * 5.0 / 9.0),
    "m": ("m", 1.0, 0.0),
    "km": ("m", 1000.0, 0.0),
    "feet": ("m", 0.3048, 0.0),
    "Pa": ("Pa", 1.0, 0.0),
    "hPa": ("Pa", 100.0, 0.0),
    "s": ("s", 1.0, 0.0),
    "hours": ("s", 3600.0, 0.0),
    "m s-1": ("m s-1", 1.0, 0.0),
    "knots": ("m s-1", 1852.0 / 3600.0, 0.0),
    "1": ("1", 1.0, 0.0),
    "%": ("1", 0.01, 0.0),
}


def set_unit(df: DataFrame, column: str, unit: str) -> DataFrame:
    meta = dict(df.schema[column].metadata or {})
    return df.withMetadata(column, {**meta, "unit": unit})


def unit_of(df: DataFrame, column: str) -> str:
    return (df.schema[column].metadata or {}).get("unit", "1")


def conversion(value: Column, source: str, target: str) -> Column:
    """Affine conversion between two units of one kind."""
    base_a, factor_a, offset_a = UNITS[source]
    base_b, factor_b, offset_b = UNITS[target]
    if base_a != base_b:
        raise ValueError(f"cannot convert {source} to {target}")
    return (value * F.lit(factor_a) + F.lit(offset_a) - F.lit(offset_b)) / F.lit(factor_b)


def convert_unit(df: DataFrame, column: str, target: str) -> DataFrame:
    source = unit_of(df, column)
    return set_unit(df.withColumn(column, conversion(F.col(column), source, target)), column, target)


def combine(df: DataFrame, a: str, b: str, op: str, out: str) -> DataFrame:
    """Arithmetic on two columns with units.

    Sums and differences of unlike units are an error, raised here and not
    while the job runs. Products and quotients get a combined unit.
    """
    ua, ub = unit_of(df, a), unit_of(df, b)
    x, y = F.col(a), F.col(b)
    if op in "+-":
        if ua != ub:
            raise ValueError(f"units differ: {ua} {op} {ub}")
        return set_unit(df.withColumn(out, x + y if op == "+" else x - y), out, ua)
    if op == "*":
        unit = ub if ua == "1" else ua if ub == "1" else f"{ua}.{ub}"
        return set_unit(df.withColumn(out, x * y), out, unit)
    if op == "/":
        unit = "1" if ua == ub else ua if ub == "1" else f"{ua}/({ub})"
        return set_unit(df.withColumn(out, F.when(y != 0, x / y)), out, unit)
    raise ValueError(f"unknown operation {op}")
