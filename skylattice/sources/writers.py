"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), spread: int | None = None) -> None:
    """Compressed parquet, partitioned by column values.

    ``spread`` shuffles rows so that each partition value is written by that
    many tasks; without it every task writes the values it holds.
    """
    if spread and partition_by:
        df = df.withColumn("__s", F.pmod(F.xxhash64(*df.columns), F.lit(spread))).repartition(*partition_by, "__s").drop("__s")
    df.write.mode("errorifexists").option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def write_tsv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Tab-separated text; array columns give one field per element."""
    types = dict(df.dtypes)
    fields = [
        F.concat_ws("\t", F.transform(c, lambda v: v.cast("string"))) if types[c].startswith("array") else F.col(c).cast("string")
        for c in columns
    ]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("errorifexists").text(path)


def write_csv(df: DataFrame, path: str, header: bool = True, partition_by: Sequence[str] = (), sep: str = ",") -> None:
    df.write.mode("errorifexists").options(header=header, sep=sep).partitionBy(*partition_by).csv(path)


def write_statistics(stats: DataFrame, path: str) -> None:
    """Fitted statistics for later runs; one small file."""
    stats.coalesce(1).write.mode("errorifexists").parquet(path)


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_label_sets(labels: DataFrame, path: str, part: str = "part", header: bool = True) -> None:
    """Train and test label tables under ``path/train`` and ``path/test``."""
    for name in ("train", "test"):
        write_csv(labels.where(F.col(part) == name).drop(part), f"{path}/{name}", header)
