"""Joins that stay even when one key, or null, holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name

# A key is hot when it holds more than this share of all rows, so there are at
# most 1 / HOT_SHARE hot keys, whatever the data.
HOT_SHARE = 1 / 1000

# Slot of rows that do take part in the join.
_MEETS = -1


def spread_slot(spread: Column) -> Column:
    """One more join key: the rows picked by ``spread`` go to many join tasks.

    Such rows find no partner in the join. Their slot is the partition index of
    the map task, which stays the same when a task is run again and differs
    between equal rows of different tasks.
    """
    return F.when(spread, F.spark_partition_id()).otherwise(F.lit(_MEETS))


def attach_by_key(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    value: str,
    count: str = "n",
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add ``keyed[value]`` to every row of ``rows`` with the same key.

    ``keyed`` has one row per key and the number of rows of that key in
    ``count``. Hot keys, of which there are few by definition, are broadcast.
    All other keys go through a shuffle join. Rows of hot keys have their
    value by then; they take part with a slot of their map task, so they
    spread evenly and meet nothing.
    """
    total = keyed.agg(F.sum(count)).scalar()
    is_hot = name(count) > total * F.lit(hot_share)
    hot = keyed.where(is_hot).select(*keys, name(value).alias("_hot_value"))
    # Not a plain literal: that would be folded into the join condition, and the
    # slot would no longer be part of what the rows are shuffled by.
    meets = F.when(name(count) >= 0, F.lit(_MEETS))
    cold = keyed.where(~is_hot).select(*keys, name(value).alias("_cold_value"), meets.alias("_slot"))
    marked = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_slot", spread_slot(F.col("_hot_value").isNotNull())
    )
    joined = marked.join(cold, [*keys, "_slot"], "left")
    return joined.select(
        *[name(c) for c in rows.columns], F.coalesce("_hot_value", "_cold_value").alias(value)
    )
