"""Reconcile the current sheets with a refresh extract by business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackledger.functions.rules import any_null, name, needs_action
from trackledger.model import CLOSABLE, NO_ACTION, OP, SHEET
from trackledger.operators.keys import key_hash, with_key_hash
from trackledger.operators.skew import spread_slot

UPDATE_OPS = ["REOPEN", "COMPLETE", "ERROR"]
OLD_STATUS = "_old_status"
NEW_ACTION = "_new_action"
REPEATS = "_repeats"


def key_violations(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Keys that occur more than once within a sheet, with their row count.

    Rows with a null key part match nothing and are left out unless
    ``null_safe``.
    """
    rows = df if null_safe else df.where(~any_null(keys))
    return (
        rows.groupBy(SHEET, *[name(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def require_unique(df: DataFrame, keys: Sequence[str], null_safe: bool = False, side: str = "table") -> None:
    """Raise when a key occurs more than once, showing a few of the keys.

    Rows are counted by key hash, which is one number to shuffle. Only rows
    whose hash occurs more than once are then counted by the key itself.
    """
    rows = with_key_hash(df if null_safe else df.where(~any_null(keys)), keys)
    hashed = key_hash(keys)
    counted = rows.groupBy(hashed).agg(F.count(F.lit(1)).alias("n"))
    repeated = counted.where(F.col("n") > 1).select(hashed)
    if repeated.isEmpty():
        return
    found = key_violations(rows.join(repeated, hashed, "left_semi"), keys, null_safe).take(3)
    if found:
        shown = "; ".join(str(row.asDict()) for row in found)
        raise ValueError(f"{side} is not one row per key ({', '.join(keys)}): {shown}")


def operation(is_new: Column, status: Column, new_action: Column) -> Column:
    """What happens to a row of the joined set; the first case that holds wins."""
    return (
        F.when(is_new, F.lit("INSERT"))
        .when((status == "Updated") & needs_action(new_action), F.lit("REOPEN"))
        .when(status.isin(*CLOSABLE) & (new_action == NO_ACTION), F.lit("COMPLETE"))
        .when(new_action.isNull(), F.lit("ERROR"))
        .otherwise(F.lit("KEEP"))
    )


def next_status(op: Column, status: Column) -> Column:
    return (
        F.when(op == "REOPEN", F.lit("Re-Opened"))
        .when(op == "COMPLETE", F.lit("Complete"))
        .when(op == "ERROR", F.lit("Error"))
        .otherwise(status)
    )


def reconcile(
    current: DataFrame,
    refresh: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    validate: bool = True,
    spread_nulls: bool = True,
    action: str = "PROPOSED_ACTION",
    status: str = "Status",
) -> DataFrame:
    """All current rows and the new ones, each with its ``op`` and next status.

    One full outer join on ``(sheet, *keys)``, led by their hash, finds what is
    in both, only in the sheet, or only in the refresh. Refresh rows that match
    nothing are inserts if they need an action, and are dropped otherwise. The
    op is worked out before the status is replaced; the status before that is
    kept in ``_old_status``.

    ``null_safe`` lets null key parts match each other. ``validate`` checks
    that both sides hold one row per key, in two small jobs. ``spread_nulls``
    spreads rows with null key parts over the join tasks. It is not needed
    after ``keep_first``, where each null key occurs once; leaving it out and
    keeping the key hash there saves another shuffle and sort of both sides.
    """
    if validate:
        require_unique(current, keys, null_safe, "current")
        require_unique(refresh, keys, null_safe, "refresh")
    left, right, on = _sides(current, refresh, keys, not null_safe and spread_nulls)
    return _matched(current, refresh, left, right, on, keys, null_safe, action, status)


def reconcile_once(
    current: DataFrame,
    refresh: DataFrame,
    keys: Sequence[str],
    null_safe: bool = False,
    action: str = "PROPOSED_ACTION",
    status: str = "Status",
) -> DataFrame:
    """As ``reconcile``, with the check of the keys in the same pass.

    The rows are numbered within their key where the join has partitioned and
    sorted them anyway. Only first rows go on to the join, so that a repeated
    key can't multiply; a first row that is not the only one of its key says so
    in the column ``_repeats``, which names the side, and is always returned.
    Whoever keeps the result asks ``require_no_repeats`` before using it.

    Rows with null key parts are spread over the join tasks, unless both sides
    bring their key hash: then ``keep_first`` left one row of each null key, and
    the rows are joined as they are partitioned and sorted.
    """
    deduped = key_hash(keys) in current.columns and key_hash(keys) in refresh.columns
    left, right, on = _sides(current, refresh, keys, not null_safe and not deduped)
    by_key = Window.partitionBy(*[name(c) for c in on]).orderBy(name(on[0]))
    # Rows with a null key part match nothing, also not each other.
    counts = F.lit(True) if null_safe else ~any_null(keys)

    def first_rows(df: DataFrame, side_name: str) -> DataFrame:
        more = F.lead(F.lit(side_name)).over(by_key)
        numbered = df.withColumns({"_nth": F.row_number().over(by_key), REPEATS: more})
        first = numbered.where((F.col("_nth") == 1) | ~counts).drop("_nth")
        return first.withColumn(REPEATS, F.when(counts, F.col(REPEATS)))

    left, right = first_rows(left, "current"), first_rows(right, "refresh")
    return _matched(current, refresh, left, right, on, keys, null_safe, action, status, [REPEATS])


def require_no_repeats(reconciled: DataFrame, keys: Sequence[str]) -> None:
    """Raise when ``reconcile_once`` met a key more than once, showing a few."""
    found = reconciled.where(F.col(REPEATS).isNotNull()).select(REPEATS, SHEET, *[name(k) for k in keys]).take(3)
    if found:
        shown = "; ".join(str({k: v for k, v in row.asDict().items() if k != REPEATS}) for row in found)
        raise ValueError(f"{found[0][REPEATS]} is not one row per key ({', '.join(keys)}): {shown}")


def _sides(
    current: DataFrame, refresh: DataFrame, keys: Sequence[str], spread_nulls: bool
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the columns they are joined on, and these columns."""
    left, right = with_key_hash(current, keys), with_key_hash(refresh, keys)
    on = [key_hash(keys), SHEET, *keys]
    if spread_nulls:
        left = left.withColumn("_slot", spread_slot(any_null(keys)))
        right = right.withColumn("_slot", spread_slot(any_null(keys)))
        on = [*on, "_slot"]
    return left, right, on


def _matched(
    current: DataFrame,
    refresh: DataFrame,
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    null_safe: bool,
    action: str,
    status: str,
    marks: Sequence[str] = (),
) -> DataFrame:
    """The full outer join of both sides, with op and next status, and the ``marks`` that either side has."""
    titles = [c for c in current.columns if not c.startswith("_key_hash_")]
    left, right = left.alias("c"), right.alias("r")

    def side(alias: str, column: str) -> Column:
        return F.col(f"{alias}.`{column}`")

    condition = F.lit(True)
    for k in on:
        l, r = side("c", k), side("r", k)
        if k in keys and current.schema[k].dataType != refresh.schema[k].dataType:
            l, r = l.cast("string"), r.cast("string")
        condition = condition & (l.eqNullSafe(r) if null_safe and k in keys else l == r)
    joined = left.join(right, condition, "full")

    is_new = side("c", SHEET).isNull()
    columns = []
    for c in titles:
        if c in refresh.columns and not c.startswith("_"):
            columns.append(F.when(is_new, side("r", c)).otherwise(side("c", c)).alias(c))
        else:
            columns.append(side("c", c).alias(c))
    wanted = ~is_new | needs_action(side("r", action))
    marked = {m: F.coalesce(side("c", m), side("r", m)) for m in marks}
    for mark in marked.values():
        wanted = wanted | mark.isNotNull()
    rows = joined.where(wanted).select(
        *columns,
        *[mark.alias(m) for m, mark in marked.items()],
        side("r", action).alias(NEW_ACTION),
        operation(is_new, side("c", status), side("r", action)).alias(OP),
    )
    old = name(status)
    return rows.select(
        *[next_status(F.col(OP), old).alias(c) if c == status else name(c) for c in titles],
        old.alias(OLD_STATUS),
        NEW_ACTION,
        OP,
        *marks,
    )


def inserts(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(F.col(OP) == "INSERT")


def updates(reconciled: DataFrame) -> DataFrame:
    return reconciled.where(F.col(OP).isin(*UPDATE_OPS))


def next_snapshot(reconciled: DataFrame) -> DataFrame:
    """The sheets after the reconcile; inserts still lack a row id."""
    return reconciled.drop(OP, OLD_STATUS, NEW_ACTION, REPEATS)
