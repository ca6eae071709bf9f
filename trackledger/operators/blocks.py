"""Ordered blocks: a globally sorted DataFrame cut into bounded pieces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name
from trackledger.session import checkpoint, materialize

BLOCK = "_block"
POSITION = "_pos"

# A block has at most 2 ** 20 rows, however large a partition is.
_POSITION_BITS = 20


def ordered_blocks(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-sort ``df`` and add ``_block`` and ``_pos``, the place in the block.

    Blocks follow each other in the given order, rows in a block too. Range
    bounds come from a sample, so the result is checkpointed: every later use
    sees the same blocks, also after an executor is lost. Without
    ``partitions`` adaptive execution decides on their number.
    """
    by = [name(c).asc_nulls_last() for c in order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    # The partition index in the upper bits, the row in the partition below.
    numbered = ranged.sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    return checkpoint(
        numbered.select(
            *[name(c) for c in df.columns],
            F.shiftright("_at", _POSITION_BITS).alias(BLOCK),
            F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias(POSITION),
        )
    )


def rows_before(sizes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by, _block, _offset``: how many rows lie in the blocks before each one.

    ``sizes`` is ``by, _block, _n``. The blocks are the leaves of a tree in which
    two nodes make one of the next level. Every block adds its size to the nodes
    above it, and takes the sums of those nodes that end where it begins: the
    left neighbours of the right-hand nodes on its way up. Both steps are
    aggregates and a join on (level, node), so no task sees all blocks. ``by``
    columns must not be null.
    """
    by = list(by)
    level = F.explode(F.sequence(F.lit(0), F.lit(63 - _POSITION_BITS))).alias("_level")
    node = F.call_function("shiftright", F.col(BLOCK), F.col("_level"))
    above = sizes.select(*by, BLOCK, "_n", level).withColumn("_node", node)
    is_left = F.col("_node").bitwiseAND(F.lit(1)) == 0
    left = above.where(is_left).groupBy(*by, "_level", "_node").agg(F.sum("_n").alias("_sum"))
    wanted = above.where(~is_left).select(*by, BLOCK, "_level", (F.col("_node") - 1).alias("_node"))
    found = wanted.join(left, [*by, "_level", "_node"]).groupBy(*by, BLOCK).agg(F.sum("_sum").alias("_offset"))
    return sizes.select(*by, BLOCK).join(found, [*by, BLOCK], "left").na.fill(0, subset=["_offset"])


def block_sizes(cut: DataFrame) -> DataFrame:
    """``_block, _n``, written: two numbers per partition or million rows."""
    return materialize(cut.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n")))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    column: str,
    start: Column | int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """Number all rows ``start + 1, start + 2, ...`` in the given order.

    The rows are sorted by range and cut into blocks; ``rows_before`` says where
    the numbers of a block begin. Rows that are equal in ``order`` may be many;
    the partition they come from decides between them, so that they need not
    share one partition.
    """
    tied = df.withColumn("_tie", F.spark_partition_id())
    cut = ordered_blocks(tied, [*order, "_tie"], partitions)
    before = materialize(rows_before(block_sizes(cut)))
    start = start if isinstance(start, Column) else F.lit(start)
    return cut.join(before, BLOCK).select(
        *[name(c) for c in df.columns if c != column],
        (start + F.col("_offset") + F.col(POSITION) + 1).cast("long").alias(column),
    )
