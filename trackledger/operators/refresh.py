"""Refresh published summaries without changing their row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name
from trackledger.model import OP, ROW_ID, SHEET, system_columns
from trackledger.operators.reconcile import require_unique
from trackledger.operators.skew import spread_slot

_MATCH = "_match"
_SLOT = "_slot"


def single_row_sheets(current: DataFrame, new: DataFrame) -> DataFrame:
    """Sheets with exactly one row on both sides, such as totals."""
    rows = current.select(SHEET, F.lit(1).alias("_c"), F.lit(0).alias("_n")).unionByName(
        new.select(SHEET, F.lit(0).alias("_c"), F.lit(1).alias("_n"))
    )
    return (
        rows.groupBy(SHEET)
        .agg(F.sum("_c").alias("_c"), F.sum("_n").alias("_n"))
        .where((F.col("_c") == 1) & (F.col("_n") == 1))
        .select(SHEET, F.lit(True).alias("_single"))
    )


def refresh_summary(
    current: DataFrame, new: DataFrame, key: str = "AC", paired: DataFrame | None = None
) -> DataFrame:
    """New summary values under the row ids the sheet has.

    A sheet with one row on both sides pairs the two rows; any other sheet is
    joined on ``key``, where null matches nothing. ``paired`` (column ``sheet``)
    says instead which sheets are totals whose single rows are paired, so that
    others are joined on ``key`` even when they happen to have one row; a sheet
    it names that has several rows on a side is joined on ``key``, too. ``op`` says what happens:
    UPDATE for matched rows, BLANK for rows only the sheet has (their user
    columns become null), UNMATCHED_NEW for rows only the extract has, which
    have no row id and are reported, not written. A key that occurs twice in a
    sheet on either side is refused.
    """
    for df, side_name in ((current, "current"), (new, "new")):
        if key in df.columns:
            require_unique(df, [key], side=side_name)
    singles = single_row_sheets(current, new)
    if paired is not None:
        singles = singles.join(paired.select(SHEET).distinct(), SHEET, "left_semi")

    def with_match(df: DataFrame) -> DataFrame:
        keyed = name(key).cast("string") if key in df.columns else F.lit(None).cast("string")
        match = F.when(F.col("_single"), F.struct(F.lit(True).alias("one"), F.lit("").alias("key"))).when(
            keyed.isNotNull(), F.struct(F.lit(False).alias("one"), keyed.alias("key"))
        )
        # No hint: the sheet list is broadcast only when its size allows it.
        matched = df.join(singles, SHEET, "left").withColumn(_MATCH, match).drop("_single")
        return matched.withColumn(_SLOT, spread_slot(F.col(_MATCH).isNull()))

    left, right = with_match(new).alias("n"), with_match(current).alias("c")

    def side(alias: str, column: str) -> Column:
        return F.col(f"{alias}.`{column}`")

    condition = F.lit(True)
    for k in (SHEET, _MATCH, _SLOT):
        condition = condition & (side("n", k) == side("c", k))
    joined = left.join(right, condition, "full")
    in_new = side("n", SHEET).isNotNull()
    in_sheet = side("c", SHEET).isNotNull()
    columns = []
    for c in current.columns:
        if c == SHEET:
            columns.append(F.coalesce(side("n", c), side("c", c)).alias(c))
        elif c in system_columns(current):
            columns.append(side("c", c).alias(c))
        elif c in new.columns:
            columns.append(side("n", c).alias(c))
        else:
            columns.append(side("c", c).alias(c))
    op = (
        F.when(in_new & in_sheet, F.lit("UPDATE"))
        .when(in_sheet, F.lit("BLANK"))
        .otherwise(F.lit("UNMATCHED_NEW"))
    )
    return joined.select(*columns, op.alias(OP))


def refreshed_rows(refreshed: DataFrame) -> DataFrame:
    """The rows to write back: those that have a row id."""
    return refreshed.where(F.col(ROW_ID).isNotNull()).drop(OP)
