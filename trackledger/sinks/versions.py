"""A versioned table of sheets: rows are added in version folders, a log says which count.

Below the root:

- ``version=<v>/sheet_id=<id>/`` rows, written once and never changed;
- ``_live/<v>/`` which version holds the rows of each sheet id, and how many;
- ``_log/`` one row per finished version.

Nothing that readers see changes until the last step, which adds one file of
one row to the log. A job that fails before leaves folders that the log does not
name; one that is run again writes a version of its own. Of two writers that
finish the same number, the one whose version comes first in the alphabet
counts, and the other is told.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = "version"
SHEET_ID = "sheet_id"
ROWS = "n_rows"
LIVE = T.StructType().add(SHEET_ID, T.StringType()).add(VERSION, T.StringType()).add(ROWS, T.LongType())
_LOG = T.StructType().add("number", T.LongType()).add(VERSION, T.StringType())


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(f"{path}/*.parquet")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _last(spark: SparkSession, root: str) -> tuple[int, str | None]:
    log = _read(spark, f"{root}/_log", _LOG)
    row = log and log.orderBy(F.desc("number"), VERSION).head()
    return (row["number"], row[VERSION]) if row else (0, None)


def live(spark: SparkSession, root: str) -> DataFrame:
    """``sheet_id, version, n_rows`` of every sheet id that the table holds now."""
    return live_and_next(spark, root)[0]


def live_and_next(spark: SparkSession, root: str) -> tuple[DataFrame, str]:
    """What the table holds now, and a name for the version after it."""
    number, version = _last(spark, root)
    held = _read(spark, f"{root}/_live/{version}", LIVE) if version else spark.createDataFrame([], LIVE)
    return held, f"{number + 1:08d}-{uuid.uuid4().hex[:12]}"


def add_rows(rows: DataFrame, root: str, version: str) -> None:
    """Write ``rows``, by their ``sheet_id``, as a version that does not count yet."""
    # Large sheets are written by several tasks, small ones share a task.
    rows.hint("rebalance", SHEET_ID).write.partitionBy(SHEET_ID).parquet(f"{root}/{VERSION}={version}")


def version_rows(spark: SparkSession, root: str, version: str, schema: T.StructType) -> DataFrame:
    """All rows of one version with their ``sheet_id``; ``schema`` is that of the rows."""
    full = T.StructType([*schema.fields, T.StructField(SHEET_ID, T.StringType())])
    return spark.read.schema(full).parquet(f"{root}/{VERSION}={version}")


def commit(state: DataFrame, root: str, version: str) -> None:
    """From now on the table holds what ``state`` (``sheet_id, version, n_rows``) says."""
    spark = state.sparkSession
    state.select(*LIVE.names).coalesce(1).write.parquet(f"{root}/_live/{version}")
    number = int(version.split("-")[0])
    entry = spark.range(0, 1, 1, 1).select(F.lit(number).cast("long").alias("number"), F.lit(version).alias(VERSION))
    entry.write.mode("append").parquet(f"{root}/_log")
    last, counts = _last(spark, root)
    if last == number and counts != version:
        raise RuntimeError(f"another job has published {counts} meanwhile; {version} does not count")


def live_rows(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of all sheet ids that the table holds now, with their ``sheet_id``.

    Only folders of versions that still hold a sheet are listed: as many as
    there are sheets at most.
    """
    full = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType()), T.StructField(SHEET_ID, T.StringType())])
    state = live(spark, root).where(F.col(ROWS) > 0)
    versions = [r[VERSION] for r in state.select(VERSION).distinct().collect()]
    names = [*schema.names, SHEET_ID]
    if not versions:
        return spark.createDataFrame([], full).select(*[f"`{n}`" for n in names])
    reader = spark.read.schema(full).option("basePath", root)
    rows = reader.parquet(*[f"{root}/{VERSION}={v}" for v in versions])
    return rows.join(state.select(VERSION, SHEET_ID), [VERSION, SHEET_ID], "left_semi").select(*[f"`{n}`" for n in names])
