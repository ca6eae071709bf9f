"""Registry of sheets: ids, targets, sources and tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.model import REGISTRY, SHEET


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY).json(path)


def tagged(registry: DataFrame, tag: str) -> DataFrame:
    return registry.where(F.array_contains("tags", tag))


def select_by_tag(df: DataFrame, registry: DataFrame, tag: str) -> DataFrame:
    """Rows of the sheets that carry ``tag``."""
    return df.join(tagged(registry, tag).select(SHEET), SHEET, "left_semi")
