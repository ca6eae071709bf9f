"""Extract files: scans, folder unions and input checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.functions.rules import name
from trackledger.sources import text
from trackledger.sources.ledger import FILE, ROWS, file_ledger

UNIT_SEPARATOR = chr(31)
SOURCE = "_source"


def read_us_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool | None = None,
    sep: str = UNIT_SEPARATOR,
) -> DataFrame:
    """Text with a header and the unit separator between fields.

    Large files are split over tasks unless a cell has a line break; without
    ``multi_line`` the lines are looked through for one first. Without a schema
    the types are inferred.
    """
    if multi_line is None:
        multi_line = text.has_broken_lines(spark, path)
    reader = spark.read.options(sep=sep, **text.read_options(multi_line))
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.csv(path, inferSchema=True)


def read_text_cells(spark: SparkSession, path: str | list[str], sep: str = ",", multi_line: bool | None = None) -> DataFrame:
    """Separated text with a header, every cell as text: the sheet says what type it takes."""
    if multi_line is None:
        multi_line = text.has_broken_lines(spark, path)
    return spark.read.options(sep=sep, **text.read_options(multi_line)).csv(path)


def read_extracts(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    format: str = "parquet",
    source: bool = False,
    multi_line: bool | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Every file of a folder as one DataFrame, united by column name.

    ``pattern`` picks files by name, such as ``*.csv``.

    With a schema nothing is inferred. Without one, the columns of all files
    are merged; a column a file lacks is null there. ``source`` adds the file
    path as ``_source``. Files without rows add none. Text is split over tasks
    unless a cell has a line break, see ``read_us_csv``.
    """
    reader = spark.read.format(format)
    if format == "csv":
        if multi_line is None:
            multi_line = text.has_broken_lines(spark, path, pattern)
        reader = reader.options(enforceSchema=False, **text.read_options(multi_line))
    if schema is not None:
        reader = reader.schema(schema)
    elif format == "csv":
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.option("mergeSchema", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    df = reader.load(path)
    return df.withColumn(SOURCE, F.col("_metadata.file_path")) if source else df


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def input_counts(
    spark: SparkSession, path: str | list[str], format: str = "parquet", schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows per input file; a file without rows shows 0."""
    return file_ledger(spark, path, format).select(F.col(FILE).alias(SOURCE), F.col(ROWS).alias("n"))


def last_worksheet(df: DataFrame, workbook: str = "workbook", ordinal: str = "worksheet") -> DataFrame:
    """Rows of the last worksheet of each workbook."""
    last = df.groupBy(name(workbook)).agg(F.max(name(ordinal)).alias(ordinal))
    return df.join(last, [workbook, ordinal], "left_semi")
