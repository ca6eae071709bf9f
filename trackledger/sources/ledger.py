"""One table of input files: where each lies, how large it is and how many rows it has.

Guards, counts and folder reports all read this table. Files are found by their
listing, so a file without rows, and a folder of nothing but such files, is in
it; rows are counted without reading a column, for Parquet from the footers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.session import materialize
from trackledger.sources import text

FILE = "file"
BYTES = "n_bytes"
ROWS = "n_rows"
_EMPTY = f"{FILE} string, {BYTES} long, {ROWS} long"


def list_files(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """``file, n_bytes`` of every file below ``path``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        found = reader.load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{FILE} string, {BYTES} long")
    return found.select(F.col("_metadata.file_path").alias(FILE), F.col("length").alias(BYTES))


def file_ledger(
    spark: SparkSession, path: str | Sequence[str], format: str = "parquet", pattern: str | None = None
) -> DataFrame:
    """``file, n_bytes, n_rows`` of every file below ``path``."""
    listed = list_files(spark, path, pattern)
    if listed.isEmpty():
        return spark.createDataFrame([], _EMPTY)
    reader = spark.read.format(format).option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    if format == "csv":
        reader = reader.options(**text.read_options(text.has_broken_lines(spark, path, pattern)))
    if format in ("csv", "json"):
        reader = reader.schema("_any string")
    counted = reader.load(path).groupBy(F.col("_metadata.file_path").alias(FILE)).agg(F.count(F.lit(1)).alias(ROWS))
    return listed.join(counted, FILE, "left").na.fill(0, subset=[ROWS])


def require_files(files: DataFrame, exactly: int | None = None) -> None:
    """Raise unless ``list_files`` or ``file_ledger`` has files, or ``exactly`` so many."""
    found = files.count()
    if found == 0:
        raise ValueError("no input files found")
    if exactly is not None and found != exactly:
        raise ValueError(f"expected exactly {exactly} input file(s), found {found}")


def folder_rows(ledger: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Rows per fleet folder and kind, of files below ``<fleet>/<kind>/``.

    The ledger is written first: a filter on the path would otherwise be pushed
    to the scan that counts rows, and look at the path once a row.
    """
    pattern = rf"([^/]+)/({'|'.join(kinds)})/"
    of_file = materialize(ledger.select(FILE, ROWS)).select(
        F.regexp_extract(FILE, pattern, 1).alias("folder"), F.regexp_extract(FILE, pattern, 2).alias("kind"), ROWS
    )
    counts = [F.sum(F.when(F.col("kind") == k, F.col(ROWS)).otherwise(F.lit(0))).alias(f"{k.lower()}_rows") for k in kinds]
    return of_file.where(F.col("folder") != "").groupBy(F.url_decode("folder").alias("folder")).agg(*counts)
