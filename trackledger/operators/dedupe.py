"""First-of-key selection and duplicate row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackledger.functions.rules import name
from trackledger.model import ROW_ID, SHEET
from trackledger.operators.keys import key_hash, with_key_hash

N_ROWS = "n_rows"
N_ALL = "n_all"


def keep_first(df: DataFrame, keys: Sequence[str], order: str = ROW_ID, keep_hash: bool = False) -> DataFrame:
    """The first row of each key within its sheet; null key parts are equal.

    ``order`` must tell the rows of a sheet apart. Spark limits every key to
    one row per map task before the shuffle, so a key that holds a large share
    of all rows costs no more than any other. With ``keep_hash`` the key hash
    stays, and ``reconcile`` then joins the rows as they are partitioned and
    sorted here.
    """
    hashed = with_key_hash(df, keys)
    by_key = Window.partitionBy(key_hash(keys), SHEET, *[name(k) for k in keys]).orderBy(name(order))
    ranked = hashed.withColumn("_rank", F.row_number().over(by_key))
    first = ranked.where(F.col("_rank") == 1).drop("_rank")
    return first if keep_hash else first.select(*[name(c) for c in df.columns])


def first_ids(df: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """``(sheet, _id)`` of the first row of each key, combined before the shuffle."""
    if order == ROW_ID:
        first = F.min(ROW_ID)
    else:
        first = F.min_by(ROW_ID, name(order))
    return df.groupBy(SHEET, *[name(k) for k in keys]).agg(first.alias(ROW_ID)).select(SHEET, ROW_ID)


def duplicate_rows(df: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """``sheet, _id, n_rows, n_all``: how many of the rows with an id are not the first of their key.

    Every row counts for its id, and every first row against it; what is left of
    an id are its duplicates. So rows that share an id, even equal ones, are told
    apart by number, and rows spread by id and not by key, which may be hot.
    """
    every = df.select(SHEET, ROW_ID, F.lit(1).alias("_here"), F.lit(0).alias("_first"))
    first = first_ids(df, keys, order).select(SHEET, ROW_ID, F.lit(0).alias("_here"), F.lit(1).alias("_first"))
    summed = every.unionByName(first).groupBy(SHEET, ROW_ID).agg(
        F.sum(F.col("_here") - F.col("_first")).alias(N_ROWS), F.sum("_here").alias(N_ALL)
    )
    return summed.where(F.col(N_ROWS) > 0)


def duplicate_ids(df: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """``(sheet, _id)`` of every row that is not the first of its key."""
    found = duplicate_rows(df, keys, order)
    return found.select(SHEET, ROW_ID, F.explode(F.sequence(F.lit(1), N_ROWS))).drop("col")
