"""Reports: open actions, status matrices, totals and category counts.

Every report takes plain rows, or rows that were already counted together
(``tally``) with the count in the column named by ``weight``. Each is one hash
aggregate that combines on the map side, so a hot aircraft or fleet sends one
partial row per task. Rows with a null FLEET or CATEGORY grouping value belong
to no report.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackledger.functions.rules import name
from trackledger.model import AIRFRAME_ACTIONS, REPORTED

AC = "AC"
STATUS = "Status"
ACTION = "PROPOSED_ACTION"
CATEGORY = "CATEGORY"


def count_where(condition: Column, weight: str | None) -> Column:
    if weight is None:
        return F.count_if(condition)
    counted = F.sum(F.when(condition, name(weight)).otherwise(F.lit(0)))
    return F.coalesce(counted, F.lit(0)).cast("long")


def _rows(weight: str | None) -> Column:
    return F.count(F.lit(1)) if weight is None else F.sum(name(weight)).cast("long")


def _present(df: DataFrame, by: Sequence[str]) -> DataFrame:
    for column in by:
        df = df.where(name(column).isNotNull())
    return df


def tally(df: DataFrame, by: Sequence[str], weight: str | None = None) -> DataFrame:
    """Rows counted together by the columns the reports need, as ``n``."""
    return df.groupBy(*[name(c) for c in by]).agg(_rows(weight).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(name(column)).distinct()


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """Rows per value; null is not counted."""
    return tally(df.where(name(column).isNotNull()), [column], weight)


def open_actions(
    open_df: DataFrame,
    by: Sequence[str] = ("FLEET",),
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    weight: str | None = None,
) -> DataFrame:
    """Actions per aircraft over open rows; TOTAL is the sum of the action columns.

    A null aircraft keeps its row, with zeros.
    """
    counts = [
        count_where(name(AC).isNotNull() & (name(ACTION) == value), weight).alias(title)
        for title, value in actions.items()
    ]
    grouped = _present(open_df, by).groupBy(*[name(c) for c in by], AC).agg(*counts)
    total = sum((name(t) for t in list(actions)[1:]), name(list(actions)[0]))
    return grouped.withColumn("TOTAL", total)


def status_matrix(
    df: DataFrame,
    by: Sequence[str] = ("FLEET",),
    statuses: Sequence[str] = REPORTED,
    weight: str | None = None,
) -> DataFrame:
    """Rows per aircraft and status, one column per listed status.

    Null aircraft and null statuses are left out; an aircraft with unlisted
    statuses only stays, with zeros.
    """
    rows = _present(df, [*by, AC, STATUS])
    counts = [count_where(name(STATUS) == s, weight).alias(s) for s in statuses]
    return rows.groupBy(*[name(c) for c in by], AC).agg(*counts)


def total_columns(actions: Mapping[str, str], statuses: Sequence[str], weight: str | None) -> list[Column]:
    return [
        *[count_where(name(ACTION) == value, weight).alias(title) for title, value in actions.items()],
        *[count_where(name(STATUS) == s, weight).alias(s) for s in statuses],
    ]


def totals(
    df: DataFrame,
    by: Sequence[str] = ("FLEET",),
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    statuses: Sequence[str] = REPORTED,
    weight: str | None = None,
) -> DataFrame:
    """Actions and statuses over all rows, open or not; one row without ``by``."""
    columns = total_columns(actions, statuses, weight)
    if not by:
        return df.agg(*columns)
    return _present(df, by).groupBy(*[name(c) for c in by]).agg(*columns)


def category_counts(df: DataFrame, by: Sequence[str] = ("FLEET",), weight: str | None = None) -> DataFrame:
    """Rows per category, in long form; null categories are not counted."""
    return tally(_present(df, [*by, CATEGORY]), [*by, CATEGORY], weight)


def sorted_report(report: DataFrame, by: Sequence[str] = (AC,)) -> DataFrame:
    """Report rows in ascending order with nulls last."""
    return report.orderBy(*[name(c).asc_nulls_last() for c in by])
