"""Report jobs: fleet, fleet and category, and engine summaries.

The rows are read once and counted together by everything a report asks for.
That table is small, is written once to the shared folder, and gives all
reports.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from trackledger.functions.rules import apply_feedback, fold_category, open_rows
from trackledger.model import AIRFRAME_ACTIONS, ENGINE_ACTIONS, REPORTED
from trackledger.operators.dimension import FLEET, long_totals, pair_totals, totals_with_categories
from trackledger.operators.summary import (
    AC,
    ACTION,
    CATEGORY,
    STATUS,
    open_actions,
    sorted_report,
    status_matrix,
    tally,
    totals,
)
from trackledger.session import materialize
from trackledger.sinks.publish import export_by

_N = "n"

Reports = dict[str, DataFrame]


def _facts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return materialize(tally(apply_feedback(df), [*by, AC, STATUS, ACTION]))


def fleet_summaries(
    df: DataFrame,
    statuses: Sequence[str] = REPORTED,
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    categories: Sequence[str] | DataFrame | None = None,
    long: bool = False,
) -> Reports:
    """Per fleet: open actions, status matrix, and totals with category counts.

    ``categories`` declares those to list, as titles or as a dimension. With
    ``long`` the totals come as rows, for any number of categories.
    """
    facts = fold_category(_facts(df, [FLEET, CATEGORY]))
    if long:
        if categories is not None and not isinstance(categories, DataFrame):
            categories = df.sparkSession.createDataFrame([(c,) for c in categories], f"{CATEGORY} string")
        totals_of_fleets = long_totals(facts, categories, FLEET, actions, statuses, _N)
    else:
        totals_of_fleets = totals_with_categories(facts, [FLEET], actions, statuses, categories, _N)
    return {
        "ACTIONS": open_actions(open_rows(facts), [FLEET], actions, _N),
        "STATUS": status_matrix(facts, [FLEET], statuses, _N),
        "TOTALS": totals_of_fleets,
    }


def fleet_category_summaries(
    df: DataFrame,
    statuses: Sequence[str] = REPORTED,
    actions: Mapping[str, str] = AIRFRAME_ACTIONS,
    fold: bool = True,
    categories: DataFrame | None = None,
) -> Reports:
    """Per fleet and category: open actions, status matrix and totals of every pair.

    ``categories`` declares the categories, or with a fleet column the pairs, that
    have a row of totals even if nothing occurs.
    """
    facts = fold_category(_facts(df, [FLEET, CATEGORY]), fold)
    return {
        "ACTION": open_actions(open_rows(facts), [FLEET, CATEGORY], actions, _N),
        "STATUS": status_matrix(facts, [FLEET, CATEGORY], statuses, _N),
        "TOTALS": pair_totals(facts, categories, FLEET, actions, statuses, _N),
    }


def engine_summaries(
    df: DataFrame,
    statuses: Sequence[str] = REPORTED,
    actions: Mapping[str, str] = ENGINE_ACTIONS,
) -> Reports:
    """Over all rows: open actions and status matrix per aircraft, and totals."""
    facts = _facts(df, [])
    return {
        "all_action": open_actions(open_rows(facts), [], actions, _N),
        "all_status": status_matrix(facts, [], statuses, _N),
        "totals": totals(facts, [], actions, statuses, _N),
    }


def export_reports(reports: Reports, path: str, format: str = "parquet") -> None:
    """One folder per report, and in it one per fleet and category, sorted by aircraft."""
    for title, report in reports.items():
        by = [c for c in (FLEET, CATEGORY) if c in report.columns]
        sort = [AC] if AC in report.columns else []
        target = f"{path.rstrip('/')}/{title}"
        if by:
            export_by(report, by, target, format, sort)
        elif sort:
            sorted_report(report, sort).write.format(format).save(target)
        else:
            report.write.format(format).save(target)
