"""Session helpers: configuration, shared scratch space and durable cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skylattice", cores: str = "*", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where nothing is
    named, as in tests, is a local temporary folder taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="skylattice-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and continue from it.

    A lost executor never repeats the work before this point, and Spark knows
    the size of what it reads, so it can choose the join for it.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the workers, once per application.

    They may start in any folder, so they cannot count on finding it by name.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    root = urlparse(shared_dir(spark))
    # where the shared folder is not mounted, the driver's own file server hands the archive out
    folder = root.path if root.scheme in ("", "file") else tempfile.mkdtemp()
    name = os.path.join(folder, f"library-{uuid.uuid4().hex}", os.path.basename(package))
    archive = shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
