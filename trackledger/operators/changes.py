"""Change sets as data: update, insert and delete by ``(sheet, _id)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.functions.rules import name, some_of
from trackledger.model import OP, ROW_ID, ROW_ORDER, SHEET, user_columns
from trackledger.operators.blocks import number_rows
from trackledger.operators.dedupe import N_ALL, N_ROWS
from trackledger.operators.reconcile import UPDATE_OPS
from trackledger.session import materialize

_AT = [SHEET, ROW_ID]


def apply_update(
    target: DataFrame,
    changes: DataFrame,
    cols: Sequence[str] | None = None,
    rows: Column | None = None,
) -> DataFrame:
    """Write ``cols`` of the changed rows into the target; null blanks a cell.

    ``cols`` defaults to every user column both sides have, ``rows`` to all
    changes. Changes to unknown rows have no effect.
    """
    if rows is not None:
        changes = changes.where(rows)
    if cols is None:
        cols = [c for c in user_columns(target) if c in changes.columns]
    new = changes.select(
        *_AT, *[name(c).alias(f"_new_{i}") for i, c in enumerate(cols)], F.lit(True).alias("_hit")
    )
    at = {c: i for i, c in enumerate(cols)}
    joined = target.join(new, _AT, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{at[c]}")).otherwise(name(c)).alias(c) if c in at else name(c)
            for c in target.columns
        ]
    )


def apply_delete(target: DataFrame, ids: DataFrame, rows: Column | None = None) -> DataFrame:
    """Remove the rows named by ``(sheet, _id)``.

    Where ``ids`` says how many rows of an id go, out of how many
    (``duplicate_rows``), and some stay, those go that are last by their cells;
    equal rows can't be told apart, and need not be.
    """
    if rows is not None:
        ids = ids.where(rows)
    if not {N_ROWS, N_ALL} <= set(ids.columns):
        return target.join(ids.select(*_AT), _AT, "left_anti")
    ids = materialize(ids.select(*_AT, N_ROWS, N_ALL))
    kept = target.join(ids.select(*_AT), _AT, "left_anti")
    partly = ids.where(F.col(N_ROWS) < F.col(N_ALL)).withColumn("_stay", F.col(N_ALL) - F.col(N_ROWS)).drop(N_ROWS, N_ALL)
    if partly.isEmpty():
        return kept
    cells = [name(f.name) for f in target.schema.fields if not isinstance(f.dataType, T.MapType | T.VariantType)]
    ranked = target.join(partly, _AT).withColumn("_nth", F.row_number().over(Window.partitionBy(*_AT).orderBy(*cells)))
    return kept.unionByName(ranked.where(F.col("_nth") <= F.col("_stay")).select(*[name(c) for c in target.columns]))


def apply_insert(
    target: DataFrame,
    rows: DataFrame,
    order: Sequence[str],
    where: Column | None = None,
    last_id: Column | int | None = None,
) -> DataFrame:
    """Put new rows on top of their sheets.

    Only titles the target knows are taken. Row ids go on, in the given order,
    from ``last_id`` or else from the largest id in the target. Where the target keeps a row order, new rows
    come before the rows that are there.
    """
    if where is not None:
        rows = rows.where(where)
    known = [c for c in target.columns if c in rows.columns and c not in (ROW_ID, ROW_ORDER)]
    new = rows.select(*[name(c) for c in known])
    if last_id is None:
        top = target.agg(F.coalesce(F.max(ROW_ID), F.lit(0)).alias("m")).scalar()
    else:
        top = last_id if isinstance(last_id, Column) else F.lit(last_id)
    numbered = number_rows(new, order, "_number")
    numbered = numbered.withColumn(ROW_ID, (F.col("_number") + top).cast(target.schema[ROW_ID].dataType))
    if ROW_ORDER in target.columns:
        first = target.agg(F.coalesce(F.min(ROW_ORDER), F.lit(0)).alias("m")).scalar()
        count = numbered.agg(F.count(F.lit(1)).alias("m")).scalar()
        numbered = numbered.withColumn(
            ROW_ORDER, (first - count + F.col("_number") - 1).cast(target.schema[ROW_ORDER].dataType)
        )
    return target.unionByName(numbered.drop("_number"), allowMissingColumns=True)


def change_counts(reconciled: DataFrame) -> DataFrame:
    """Rows per sheet and op."""
    return reconciled.groupBy(SHEET, OP).agg(F.count(F.lit(1)).alias("n"))


def command_counts(reconciled: DataFrame) -> DataFrame:
    """Updated and inserted rows per sheet."""
    return reconciled.groupBy(SHEET).agg(
        F.count_if(F.col(OP).isin(*UPDATE_OPS)).alias("updated"),
        F.count_if(F.col(OP) == "INSERT").alias("inserted"),
    )


def _falsy(column: Column, data_type: T.DataType) -> Column:
    empty = column.isNull()
    if isinstance(data_type, T.StringType):
        return empty | (column == F.lit(""))
    if isinstance(data_type, T.NumericType):
        return empty | (column == F.lit(0))
    if isinstance(data_type, T.BooleanType):
        return empty | ~column
    return empty


def payload(df: DataFrame, cols: Sequence[str] | None = None, drop_falsy: bool = False) -> Column:
    """Row content as ``array<struct<title,value>>``.

    An update keeps nulls, which blank the cell. An insert drops null, empty,
    zero and false cells (``drop_falsy``), judged on the typed value.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    titles = user_columns(df) if cols is None else cols
    cells = [F.struct(F.lit(c).alias("title"), name(c).cast("string").alias("value")) for c in titles]
    if not drop_falsy:
        return F.array(*cells)
    kept = [~_falsy(name(c), types[c]) for c in titles]
    return some_of(list(zip(kept, cells)), "struct<title:string,value:string>")


def insert_payload(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(SHEET, payload(df, cols, drop_falsy=True).alias("cells"))


def update_payload(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.select(SHEET, ROW_ID, payload(df, cols).alias("cells"))


def change_set(reconciled: DataFrame, titles: Sequence[str], cols: Sequence[str] = ("Status",)) -> DataFrame:
    """``(sheet, op, _id, cells)`` of every row to update or insert.

    Updates carry ``cols`` only; inserts carry every known title.
    """
    cells = F.when(F.col(OP) == "INSERT", payload(reconciled, titles, drop_falsy=True)).otherwise(
        payload(reconciled, cols)
    )
    changed = reconciled.where(F.col(OP) != "KEEP")
    return changed.select(SHEET, OP, ROW_ID, cells.alias("cells"))


def with_column_ids(changes: DataFrame, columns: DataFrame) -> DataFrame:
    """Cells with the column ids of their sheet in place of titles.

    ``columns`` is ``(sheet, column_id, title)``, as ``sheet_columns`` gives
    it. Cells whose title the sheet does not have are left out.
    """
    entry = F.struct("title", "column_id")
    ids = columns.groupBy(SHEET).agg(F.map_from_entries(F.collect_list(entry)).alias("_ids"))
    joined = changes.join(ids, SHEET, "left")
    known = F.filter("cells", lambda c: F.col("_ids")[c["title"]].isNotNull())
    cells = F.transform(
        known, lambda c: F.struct(F.col("_ids")[c["title"]].alias("columnId"), c["value"].alias("value"))
    )
    return joined.select(*[cells.alias(c) if c == "cells" else name(c) for c in changes.columns])
