"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffle partitions, splits skewed join partitions
# and turns a join into a broadcast only once the real size is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, also used for checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting a
    session on one machine (master ``local``) gets a local folder, and any other
    one is refused: its executors could not see each other's files.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path and not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="trackledger-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/trackledger/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder; never reused between runs."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has written with ``materialize``; for the end of a job."""
    _remove(spark, _scratch(spark))


def materialize(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Compute ``df`` once, as a Parquet table in the shared folder.

    For results that several later steps read: each reads only the columns it
    needs, the table has a known size, and it survives the loss of executors.
    ``folder`` is one that ``passing`` gives.
    """
    spark = df.sparkSession
    path = f"{folder}/{uuid.uuid4().hex}" if folder else scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(spark: SparkSession) -> Iterator[str]:
    """A folder for tables that nothing reads after this block; it is removed then."""
    folder = scratch_path(spark, "passing")
    try:
        yield folder
    finally:
        _remove(spark, folder)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """In this block a query's shuffle files are removed once it has ended, and not when the driver happens to collect its garbage.

    For results that are written, as ``materialize`` does; without the setting files stay longer.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep its partitions as they are."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
