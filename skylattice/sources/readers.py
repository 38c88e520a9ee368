"""Readers. Schemas are declared; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ordered import attach

# The patterns of a traffic site file.
SITE_ID = r"Site Id: (\d+)"
SITE_LATITUDE = r"Site Lat/Long: ([-\d.]+)\s*[-\d.]+"
SITE_LONGITUDE = r"Site Lat/Long: [-\d.]+\s*([-\d.]+)"
SITE_ROW = r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}):\d{2} Total Volume: (\d+)"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    header: bool = True,
    sep: str = ",",
    **options,
) -> DataFrame:
    """Delimited files: one path, several paths or a glob, as one scan. The
    separator may have several characters; header-less files take the names
    of the schema."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.options(header=header, sep=sep, **options).schema(schema).csv(paths)


def read_csv_lenient(
    spark: SparkSession, path, schema, select: Sequence[str], defaults: dict[str, object], header: bool = True
) -> DataFrame:
    """Chosen columns with a default for empty fields; rows that do not parse
    are left out."""
    rows = read_csv(spark, path, schema, header=header, mode="DROPMALFORMED")
    return rows.select(*select).fillna(defaults)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None):
    """Parquet with the column list and the predicate put on the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_site_text(spark: SparkSession, path: str, site_of_path: str = r"site=([^/]+)/") -> DataFrame:
    """Traffic site files to (site_id, latitude, longitude, timestamp, volume).

    Files are read by line and may be split between tasks; a site's header
    lines are found wherever they stand among the files of its folder and are
    joined to its rows. Lines that are not observations are left out.
    """
    lines = spark.read.text(path).withColumn("__site", F.regexp_extract(F.input_file_name(), site_of_path, 1))

    def header(pattern: str, kind: str) -> Column:
        return F.max(F.regexp_extract("value", pattern, 1).try_cast(kind))

    sites = (
        lines.where(F.col("value").startswith("Site "))
        .groupBy("__site")
        .agg(
            header(SITE_ID, "long").alias("site_id"),
            header(SITE_LATITUDE, "double").alias("latitude"),
            header(SITE_LONGITUDE, "double").alias("longitude"),
        )
    )
    stamp = F.try_to_timestamp(F.regexp_extract("value", SITE_ROW, 1), F.lit("yyyy-MM-dd'T'HH:mm"))
    rows = lines.select(
        "__site", stamp.alias("timestamp"), F.regexp_extract("value", SITE_ROW, 2).try_cast("long").alias("volume")
    ).where(F.col("timestamp").isNotNull())
    return attach(rows, sites, ["__site"], "inner").select("site_id", "latitude", "longitude", "timestamp", "volume")


def with_realization(df: DataFrame, column: str = "realization", pattern: str = r"_(\d+)[^/]*$") -> DataFrame:
    """Member number from the file name where the data does not carry it."""
    from_name = F.regexp_extract(F.input_file_name(), pattern, 1).try_cast("int")
    value = F.coalesce(F.col(column), from_name) if column in df.columns else from_name
    return df.withColumn(column, value)
