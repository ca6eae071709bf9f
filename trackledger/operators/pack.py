"""Pack extracts into sheets under a row cap without splitting a unit.

Units (part numbers) of a group (fleet, category) are taken in ascending
order. A unit goes on the open sheet if it still fits, else it starts the next
one; a unit larger than the cap has a sheet to itself. Only the number of rows
per unit matters, so everything below works on one counted row per unit.

Each step depends on the sheet the previous unit went to, yet one group may
hold most units, so the walk over a group is cut into ordered blocks:

1. every block works out, in parallel, how it would end for any room left on
   the sheet that is open when the block begins (``_outcomes``);
2. outcomes are composed two by two, neighbour with neighbour, until one table
   tells how a whole group ends; on the way back down every table turns the
   begin of its right neighbour from unknown to known (``block_starts``). Each of
   these rounds is a grouped step over all pairs of all groups, as many as the
   number of blocks of the longest group has binary digits;
3. every block then assigns its own units, again in parallel (``_assign``).

An outcome table has at most ``cap + 1`` entries, as only that many units can
come before the first sheet change in a block. No task holds more than two
tables of a group, or the units of one block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.functions.rules import any_null, name
from trackledger.model import SHEET_ROW_CAP
from trackledger.operators.blocks import BLOCK, ordered_blocks, rows_before
from trackledger.operators.skew import attach_by_key
from trackledger.session import materialize

SHEET_NO = "sheet_no"
SHEET_NAME = "sheet_name"
GROUP = ("FLEET", "CATEGORY")
UNIT = "PN"
_NODE = "_node"
_UP = "_up"


def unit_counts(df: DataFrame, by: Sequence[str] = GROUP, unit: str = UNIT) -> DataFrame:
    """Rows per unit of a group; rows with a null group or unit are left out."""
    return (
        df.where(~any_null([*by, unit]))
        .groupBy(*[name(c) for c in by], name(unit))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pack_rejects(df: DataFrame, by: Sequence[str] = GROUP, unit: str = UNIT) -> DataFrame:
    """Rows that belong to no sheet, as their group or unit is null."""
    return df.where(any_null([*by, unit]))


def _outcomes(by: list[str], cap: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per block and group: how the block ends, by the room left when it begins.

    Entry ``reach`` covers room below ``reach`` and not below the entry before:
    the block then opens ``opens`` sheets and leaves ``used`` rows on the last.
    Room of at least the last ``reach`` takes the whole block.
    """

    def table(key: tuple, block: int, sizes: np.ndarray) -> pd.DataFrame:
        upto = np.cumsum(sizes)
        units = len(sizes)
        before = upto - sizes
        index = np.arange(units)
        # First unit of the next sheet, for a sheet that begins at each unit.
        following = np.maximum(np.searchsorted(upto, before + cap, side="right"), index + 1)
        following = np.append(following, units)
        opens = np.append(np.ones(units, dtype=np.int64), 0)
        last = np.arange(units + 1)
        # Double the number of sheets looked ahead until every chain has ended.
        while (following < units).any():
            last = np.where(following < units, last[following], last)
            opens = opens + opens[following]
            following = following[following]
        used = np.minimum(upto[-1] - before[last[:units]], cap)
        # Units that can be the first one that does not fit.
        first = min(int(np.searchsorted(upto, cap, side="right")) + 1, units)
        opens, used, reach = opens[:first], used[:first], upto[:first]
        # Neighbouring entries that end alike become one.
        keep = np.append((opens[1:] != opens[:-1]) | (used[1:] != used[:-1]), True)
        out = pd.DataFrame({"reach": reach[keep], "opens": opens[keep], "used": used[keep]})
        for column, value in zip(by, key):
            out[column] = value
        out["_block"] = block
        return out[[*by, "_block", "reach", "opens", "used"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held = None, []
        for batch in batches:
            for key, part in batch.groupby([*by, "_block"], sort=False):
                if held and key != held_key:
                    yield table(held_key[:-1], held_key[-1], np.concatenate(held))
                    held = []
                held_key = key
                held.append(part["n"].to_numpy(dtype=np.int64))
        if held:
            yield table(held_key[:-1], held_key[-1], np.concatenate(held))

    return run


def _composed(by: list[str], cap: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """How two neighbours end together, from how each of them ends."""

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values([_NODE, "reach"], ignore_index=True)
        key = {c: pair[c].iloc[0] for c in [*by, _UP]}
        is_left = (pair[_NODE] % 2 == 0).to_numpy()
        one, two = (pair.loc[at, ["reach", "opens", "used"]].to_numpy(dtype=np.int64) for at in (is_left, ~is_left))
        if len(one) and len(two):
            # What the right one makes of the room that the left one leaves.
            at = np.searchsorted(two[:, 0], cap - one[:, 2], side="right")
            fits = at == len(two)
            at = np.minimum(at, len(two) - 1)
            opens = one[:, 1] + np.where(fits, 0, two[at, 1])
            used = np.where(fits, np.minimum(one[:, 2] + two[-1, 0], cap), two[at, 2])
            # With more room than the left one needs, the right one begins on the same sheet.
            reach = np.concatenate([one[:, 0], two[:, 0] + one[-1, 0]])
            opens, used = np.concatenate([opens, two[:, 1]]), np.concatenate([used, two[:, 2]])
            # No sheet has more room than the cap: one entry beyond it is the last.
            last = int(np.searchsorted(reach, cap, side="right")) + 1
            reach, opens, used = reach[:last], opens[:last], used[:last]
            keep = np.append((opens[1:] != opens[:-1]) | (used[1:] != used[:-1]), True)
            table = np.column_stack([reach[keep], opens[keep], used[keep]])
        else:
            table = one if len(one) else two
        out = pd.DataFrame(table, columns=["reach", "opens", "used"])
        for column, value in key.items():
            out[_NODE if column == _UP else column] = value
        return out[[*by, _NODE, "reach", "opens", "used"]]

    return run


def _passed(begins: DataFrame, tables: DataFrame, by: list[str], cap: int) -> DataFrame:
    """``_used, _number`` behind the left-hand tables, from those before them."""
    left = tables.where(f"{_NODE} % 2 = 0").withColumn(_UP, F.shiftright(_NODE, 1)).drop(_NODE)
    room = F.lit(cap) - F.col("_used")
    entry = F.when(F.col("reach") > room, F.struct("reach", "opens", "used"))
    ends = (
        begins.join(left, [*by, _UP])
        .groupBy(*by, _UP, "_used", "_number")
        .agg(F.min(entry).alias("end"), F.max("reach").alias("all"))
    )
    return ends.select(
        *by,
        _UP,
        F.coalesce("end.used", F.least(F.col("_used") + F.col("all"), F.lit(cap))).alias("_used_after"),
        (F.col("_number") + F.coalesce("end.opens", F.lit(0))).alias("_number_after"),
    )


def block_starts(outcomes: DataFrame, by: Sequence[str], cap: int) -> DataFrame:
    """``by, _block, _used, _number``: rows on the open sheet, and its number, where each block begins.

    A full sheet number 0 makes the first unit of a group open sheet 1.
    """
    by = list(by)
    blocks = materialize(outcomes.select(*by, BLOCK).distinct())
    full = [F.lit(cap).cast("long").alias("_used"), F.lit(0).cast("long").alias("_number")]
    # Blocks in a row, without gaps, so that neighbours have neighbouring numbers.
    ranks = rows_before(materialize(blocks.select(BLOCK).distinct().withColumn("_n", F.lit(1))))
    placed = materialize(blocks.join(ranks.withColumnRenamed("_offset", _NODE), BLOCK))
    spans = placed.groupBy(*by).agg(F.min(_NODE).alias("first"), F.max(_NODE).alias("last")).where("first < last")
    spans = materialize(spans)
    digits = F.length(F.bin(F.col("first").bitwiseXOR(F.col("last"))))
    height = spans.agg(F.max(digits)).first()[0]
    if height is None:  # every group lies in one block
        return blocks.select(*by, BLOCK, *full)
    schema = T.StructType([outcomes.schema[c] for c in by])
    for column in (_NODE, "reach", "opens", "used"):
        schema = schema.add(column, T.LongType())
    open_ = outcomes.join(spans.select(*by), by, "left_semi").join(placed, [*by, BLOCK])
    levels = [materialize(open_.select(*schema.names))]
    for _ in range(height - 1):
        pairs = levels[-1].withColumn(_UP, F.shiftright(_NODE, 1)).groupBy(*by, _UP)
        levels.append(materialize(pairs.applyInPandas(_composed(by, cap), schema)))
    begins = spans.select(*by, F.shiftright("first", height).alias(_NODE), *full)
    for tables in reversed(levels):
        above = begins.withColumnRenamed(_NODE, _UP)
        nodes = tables.select(*by, _NODE).distinct().withColumn(_UP, F.shiftright(_NODE, 1))
        found = nodes.join(above, [*by, _UP]).join(_passed(above, tables, by, cap), [*by, _UP], "left")
        right = F.col(_NODE) % 2 == 1  # begins where its left neighbour, if there is one, ends
        used, number = (
            F.coalesce(F.when(right, F.col(f"{c}_after")), F.col(c)).alias(c) for c in ("_used", "_number")
        )
        begins = materialize(found.select(*by, _NODE, used, number))
    found = placed.join(begins, [*by, _NODE], "left")
    return found.select(*by, BLOCK, *[F.coalesce(F.col(c), full[k]).alias(c) for k, c in enumerate(("_used", "_number"))])


def _assign(cap: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Sheet numbers of the units of one block and group."""

    def run(units: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values("_pos", ignore_index=True)
        used, number = int(starts["_used"].iloc[0]), int(starts["_number"].iloc[0])
        upto = np.cumsum(units["n"].to_numpy(dtype=np.int64))
        sheet = np.empty(len(upto), dtype=np.int64)
        at = int(np.searchsorted(upto, cap - used, side="right"))
        sheet[:at] = number
        while at < len(upto):
            filled = upto[at - 1] if at else 0
            end = max(int(np.searchsorted(upto, filled + cap, side="right")), at + 1)
            number += 1
            sheet[at:end] = number
            at = end
        return units.drop(columns=["_block", "_pos"]).assign(sheet_no=sheet)

    return run


def pack_units(
    counts: DataFrame,
    by: Sequence[str] = GROUP,
    unit: str = UNIT,
    cap: int = SHEET_ROW_CAP,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``sheet_no`` to counted units (``by``, ``unit``, ``n``)."""
    by = list(by)
    cut = ordered_blocks(counts.select(*by, unit, "n"), [*by, unit], partitions)
    keys = [cut.schema[c] for c in by]
    at = [*keys, T.StructField(BLOCK, T.LongType())]

    def longs(*names: str) -> list[T.StructField]:
        return [T.StructField(n, T.LongType()) for n in names]

    outcomes = cut.select(*by, BLOCK, "n").mapInPandas(
        _outcomes(by, cap), T.StructType(at + longs("reach", "opens", "used"))
    )
    starts = block_starts(materialize(outcomes), by, cap)
    return (
        cut.groupBy(*by, BLOCK)
        .cogroup(starts.groupBy(*by, BLOCK))
        .applyInPandas(_assign(cap), T.StructType([*keys, cut.schema[unit], *longs("n", SHEET_NO)]))
    )


def name_sheets(df: DataFrame, by: Sequence[str] = GROUP) -> DataFrame:
    """Sheet name: the group values and the sheet number with two digits."""
    form = "_".join(["%s"] * len(by)) + "_%02d"
    return df.withColumn(SHEET_NAME, F.format_string(form, *[name(c) for c in by], F.col(SHEET_NO)))


def pack_assign(
    df: DataFrame,
    by: Sequence[str] = GROUP,
    unit: str = UNIT,
    cap: int = SHEET_ROW_CAP,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``sheet_no`` and ``sheet_name`` to every row that can be packed."""
    # Read three times below, so it is written once to the shared folder.
    units = materialize(pack_units(unit_counts(df, by, unit), by, unit, cap, partitions))
    rows = df.where(~any_null([*by, unit]))
    return name_sheets(attach_by_key(rows, units, [*by, unit], SHEET_NO), by)


def pack_sheets(
    df: DataFrame,
    by: Sequence[str] = GROUP,
    unit: str = UNIT,
    cap: int = SHEET_ROW_CAP,
    partitions: int | None = None,
) -> DataFrame:
    """One row per packed sheet: its name, units, rows, first and last unit."""
    units = pack_units(unit_counts(df, by, unit), by, unit, cap, partitions)
    sheets = units.groupBy(*[name(c) for c in by], SHEET_NO).agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("n").alias("rows"),
        F.min(unit).alias("first_unit"),
        F.max(unit).alias("last_unit"),
    )
    return name_sheets(sheets, by)
