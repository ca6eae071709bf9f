"""Jobs on tracker sheets: reconcile, dedupe, summary refresh, publish."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackledger.functions.conform import SHEET_TYPES, conform, conform_all
from trackledger.functions.rules import impose_schema, name, select_user_columns, user_schema
from trackledger.model import AIRFRAME_KEY, ENGINE_KEY, OP, ROW_ID, ROW_ORDER, SHEET, user_columns
from trackledger.operators.changes import apply_delete, apply_insert, change_set, command_counts
from trackledger.operators.dedupe import N_ALL, N_ROWS, duplicate_rows, keep_first
from trackledger.operators.keys import key_hash
from trackledger.operators.reconcile import inserts, next_snapshot, reconcile_once, require_no_repeats
from trackledger.operators.refresh import refresh_summary, refreshed_rows
from trackledger.session import materialize
from trackledger.sinks.publish import Published, export_sheets, publish_version, rows_per_group, with_source
from trackledger.sources.registry import select_by_tag


@dataclass(frozen=True)
class Outcome:
    """Sheets after a job, the changes that lead there, and counts per sheet."""

    sheets: DataFrame
    changes: DataFrame
    counts: DataFrame


def typed_refresh(current: DataFrame, refresh: DataFrame) -> DataFrame:
    """User columns of the extract, in the types the sheet has."""
    return impose_schema(select_user_columns(refresh), user_schema(current))


def _same_keys(current: DataFrame, refresh: DataFrame, keys: Sequence[str]) -> bool:
    """Whether both sides bring the hash of their keys, and of keys of the same types."""
    hashed = key_hash(keys)
    if hashed not in current.columns or hashed not in refresh.columns:
        return False
    return all(current.schema[k].dataType == refresh.schema[k].dataType for k in keys)


def feedback(
    current: DataFrame,
    refresh: DataFrame,
    registry: DataFrame | None = None,
    tag: str = "ac",
    keys: Sequence[str] = AIRFRAME_KEY,
    null_safe: bool = False,
) -> Outcome:
    """Reconcile the sheets with their extract.

    One pass over both finds the changes and checks that keys do not repeat. It
    is written once, with the rows that stay as they are: counts, changes and
    sheets all come from there, and no row is looked for again. New rows bring
    every title the sheet has, get the next row ids, and go on top. In
    ``changes`` they have no row id yet. Sides that ``keep_first`` left with
    their key hash are joined as they are partitioned there.
    """
    if registry is not None:
        current = select_by_tag(current, registry, tag)
        refresh = select_by_tag(refresh, registry, tag)
    typed, hashed = typed_refresh(current, refresh), key_hash(keys)
    if _same_keys(current, refresh, keys):
        typed = impose_schema(refresh.select(*[name(c) for c in [*typed.columns, hashed]]), user_schema(current))
    else:
        current = current.drop(hashed)
    rows = materialize(reconcile_once(current, typed, keys, null_safe))
    require_no_repeats(rows, keys)
    changed = rows.where(F.col(OP) != "KEEP")
    kept = next_snapshot(rows.where(F.col(OP) != "INSERT"))
    return Outcome(
        sheets=apply_insert(kept, next_snapshot(inserts(changed)), [SHEET, *keys]),
        changes=change_set(changed, user_columns(current)),
        counts=command_counts(rows),
    )


def feedback_engine(
    current: DataFrame, refresh: DataFrame, registry: DataFrame | None = None, null_safe: bool = False
) -> Outcome:
    return feedback(current, refresh, registry, "engine", ENGINE_KEY, null_safe)


def dedupe(
    current: DataFrame,
    registry: DataFrame | None = None,
    tag: str = "ac",
    keys: Sequence[str] = AIRFRAME_KEY,
    order: str | None = None,
) -> Outcome:
    """Delete every row that is not the first of its key.

    Rows are in sheet order: by ``_row`` where the data has it, else by id.
    Where rows share an id and only some of them go, the first rows are picked
    as whole rows, as the id does not say which.
    """
    order = order or (ROW_ORDER if ROW_ORDER in current.columns else ROW_ID)
    if registry is not None:
        current = select_by_tag(current, registry, tag)
    found = materialize(duplicate_rows(current, keys, order))
    shared = not found.where(F.col(N_ROWS) < F.col(N_ALL)).isEmpty()
    deleted = found.select(SHEET, ROW_ID, F.explode(F.sequence(F.lit(1), N_ROWS))).drop("col")
    return Outcome(
        sheets=keep_first(current, keys, order) if shared else apply_delete(current, found.select(SHEET, ROW_ID)),
        changes=deleted,
        counts=rows_per_group(deleted, [SHEET]),
    )


def dedupe_engine(current: DataFrame, registry: DataFrame | None = None, order: str | None = None) -> Outcome:
    return dedupe(current, registry, "engine", ENGINE_KEY, order)


def refresh_summaries(
    current: DataFrame, new: DataFrame, key: str = "AC", paired: DataFrame | None = None
) -> Outcome:
    """Make summary sheets match new summaries without changing row ids; ``paired`` names the totals."""
    refreshed = refresh_summary(current, typed_refresh(current, new), key, paired)
    return Outcome(
        sheets=refreshed_rows(refreshed), changes=refreshed, counts=rows_per_group(refreshed, [SHEET, OP])
    )


def set_sheets(df: DataFrame, registry: DataFrame, root: str, run_date: dt.date | str | None = None) -> Published:
    """Create or replace sheets; those with a source and without rows become empty."""
    return publish_version(df, registry, root, run_date, covers=with_source(registry))


def reformat_sheets(df: DataFrame, registry: DataFrame, root: str, run_date: dt.date | str | None = None) -> Published:
    """Replace the target sheets; targets of sheets with a source and without rows become empty."""
    return publish_version(df, registry, root, run_date, to_target=True, covers=with_source(registry))


def get_sheets(df: DataFrame, path: str, format: str = "parquet") -> None:
    export_sheets(df, path, format)


def update_sheets(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows in sheet types, flagged where a cell does not fit, and those cells."""
    return conform_all(df, SHEET_TYPES), conform(df, SHEET_TYPES)[1]
