"""Row rules: projections, filters and predicates without a shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.model import (
    FOLDED_CATEGORIES,
    NO_ACTION,
    NOT_OPEN,
    OTHER,
    SHEET,
    user_columns,
)


def name(column: str) -> Column:
    """Column reference that also works for titles with dots or spaces."""
    return F.col(f"`{column.replace('`', '``')}`")


def not_blank(column: Column) -> Column:
    """Neither null nor empty; a single space counts as content."""
    return column.isNotNull() & (column != F.lit(""))


def is_open(status: Column, not_open: Sequence[str] = NOT_OPEN) -> Column:
    """True unless the status is one of ``not_open``; a null status is open."""
    return ~F.coalesce(status.isin(*not_open), F.lit(False))


def needs_action(action: Column) -> Column:
    """An action other than NO_ACTION; null is not an action."""
    return action != F.lit(NO_ACTION)


def some_of(cells: Sequence[tuple[Column, Column]], item_type: str) -> Column:
    """Array of the cells whose condition holds, in order."""
    none = F.array().cast(f"array<{item_type}>")
    if not cells:
        return none
    return F.concat(*[F.when(keep, F.array(cell)).otherwise(none) for keep, cell in cells])


def any_null(columns: Iterable[str]) -> Column:
    test = F.lit(False)
    for column in columns:
        test = test | name(column).isNull()
    return test


def apply_feedback(df: DataFrame, feedback: str = "FEEDBACK", status: str = "Status") -> DataFrame:
    """Rows with feedback become Validated."""
    return df.withColumn(
        status, F.when(not_blank(name(feedback)), F.lit("Validated")).otherwise(name(status))
    )


def open_rows(df: DataFrame, status: str = "Status", not_open: Sequence[str] = NOT_OPEN) -> DataFrame:
    return df.where(is_open(name(status), not_open))


def action_rows(df: DataFrame, action: str = "PROPOSED_ACTION") -> DataFrame:
    return df.where(needs_action(name(action)))


def fold_category(
    df: DataFrame,
    fold: bool = True,
    column: str = "CATEGORY",
    folded: Sequence[str] = FOLDED_CATEGORIES,
    into: str = OTHER,
) -> DataFrame:
    """Count the small categories as one; ``fold=False`` keeps them apart."""
    if not fold:
        return df
    return df.withColumn(column, F.when(name(column).isin(*folded), F.lit(into)).otherwise(name(column)))


def fill_status(df: DataFrame, status: str = "Status", value: str = "Initial") -> DataFrame:
    return df.withColumn(status, F.coalesce(name(status), F.lit(value)))


def _run_date(run_date: dt.date | str | None) -> Column:
    return F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")


def stamp_dates(
    df: DataFrame,
    run_date: dt.date | str | None = None,
    columns: Sequence[str] = ("Created Date", "Modified Date"),
) -> DataFrame:
    """Set the date columns to the run date (today when none is given)."""
    return df.withColumns({c: _run_date(run_date) for c in columns})


def drop_first_column(df: DataFrame) -> DataFrame:
    return df.select(*[name(c) for c in df.columns[1:]])


def seed_columns(df: DataFrame, run_date: dt.date | str | None = None) -> DataFrame:
    """Turn an extract into a fresh tracker sheet.

    The first column goes. Status, Assignment, Notes and the two dates come in
    after the first remaining column. Rows with feedback start as Validated.
    """
    kept = df.columns[1:]
    seeded = df.select(
        name(kept[0]),
        F.lit("Initial").alias("Status"),
        F.lit("").alias("Assignment"),
        F.lit("").alias("Notes"),
        _run_date(run_date).alias("Created Date"),
        _run_date(run_date).alias("Modified Date"),
        *[name(c) for c in kept[1:]],
    )
    return apply_feedback(seeded)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raise when columns are missing, naming every one of them."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise KeyError(f"required columns not found: {', '.join(missing)}")
    return df


def select_user_columns(df: DataFrame, keep_sheet: bool = True) -> DataFrame:
    kept = [SHEET] if keep_sheet and SHEET in df.columns else []
    return df.select(*[name(c) for c in kept + user_columns(df)])


def user_schema(df: DataFrame) -> T.StructType:
    """Types an extract must take on, from the user columns of a sheet."""
    wanted = set(user_columns(df))
    return T.StructType([f for f in df.schema.fields if f.name in wanted])


def impose_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Cast the columns named in ``schema`` to its types; leave the others.

    ``strict`` fails on a value that does not fit; otherwise it becomes null.
    """
    types = {f.name: f.dataType for f in schema.fields}
    out = []
    for c in df.columns:
        column = name(c)
        if c in types:
            column = (column.cast(types[c]) if strict else column.try_cast(types[c])).alias(c)
        out.append(column)
    return df.select(*out)
