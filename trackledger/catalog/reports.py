"""Registered queries: row rules and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.catalog.base import Query
from trackledger.catalog.fixtures import view, with_views
from trackledger.functions import rules
from trackledger.model import ENGINE_ACTIONS, REPORTED
from trackledger.operators import dimension, summary

_RULE = "CASE WHEN FEEDBACK IS NOT NULL AND FEEDBACK <> '' THEN 'Validated' ELSE Status END"
_FOLD = "CASE WHEN CATEGORY IN ('KIT', 'GEN-CON', 'SOFTWARE') THEN 'OTHER' ELSE CATEGORY END"
_OPEN = "(Status IS NULL OR Status NOT IN ('Validated', 'Complete'))"


def _with(view_name: str) -> str:
    return f"""{with_views(view_name)},
fb AS (SELECT * EXCLUDE (Status), {_RULE} AS Status FROM {view_name}),
folded AS (SELECT * EXCLUDE (CATEGORY), {_FOLD} AS CATEGORY FROM fb)
""" if view_name == "tracker" else f"""{with_views(view_name)},
fb AS (SELECT * EXCLUDE (Status), {_RULE} AS Status FROM {view_name})
"""


def _n(condition: str, title: str) -> str:
    return f'count(*) FILTER (WHERE {condition}) AS "{title}"'


_ADD = _n("PROPOSED_ACTION = 'ADD_EFFECTIVITY'", "Add Effectivity")
_VALIDATE = _n("PROPOSED_ACTION = 'VALIDATE_EFFECTIVITY'", "Validate Effectivity")
_UPDATE = _n("PROPOSED_ACTION = 'UPDATE_EFFECTIVITY'", "Update Effectivity")
_STATUSES = ", ".join(_n(f"Status = '{s}'", s) for s in REPORTED)
_BOTH = "count(*) FILTER (WHERE PROPOSED_ACTION IN ('ADD_EFFECTIVITY', 'VALIDATE_EFFECTIVITY')) AS TOTAL"


def _validated(spark: SparkSession, sf: str, name: str = "tracker") -> DataFrame:
    return rules.apply_feedback(view(spark, sf, name))


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    return rules.fold_category(_validated(spark, sf))


def _wide_sql() -> str:
    categories = ["OTHER", "EXPENDABLE", "ROTABLE"]
    columns = ", ".join(_n(f"CATEGORY = '{c}'", c) for c in categories)
    return f"{_with('tracker')} SELECT FLEET, {_ADD}, {_VALIDATE}, {_STATUSES}, {columns} FROM folded GROUP BY FLEET"


_ZEROS = ", ".join(
    f'coalesce(s."{t}", 0) AS "{t}"' for t in ["Add Effectivity", "Validate Effectivity", *REPORTED]
)
_MISSING = "NOT (FLEET = 'F1' AND CATEGORY = 'ROTABLE') AND NOT (FLEET = 'F3' AND CATEGORY = 'EXPENDABLE')"
_SPARSE = f"{_with('tracker')}, sparse AS (SELECT * FROM folded WHERE {_MISSING})"


def _sparse(spark: SparkSession, sf: str) -> DataFrame:
    """Two fleets lack a category that others have."""
    return _folded(spark, sf).where(_MISSING)


def _declared(spark: SparkSession, sf: str) -> DataFrame:
    """Part types as a dimension; most are no category of any row."""
    return spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_type").alias("CATEGORY")).distinct()


def _all_pairs_sql(rows: str) -> str:
    return f"""{_SPARSE},
s AS (SELECT FLEET, CATEGORY, {_ADD}, {_VALIDATE}, {_STATUSES} FROM {rows} GROUP BY FLEET, CATEGORY)
SELECT f.FLEET, c.CATEGORY, {_ZEROS}
FROM (SELECT DISTINCT FLEET FROM {rows}) f CROSS JOIN (SELECT DISTINCT CATEGORY FROM {rows}) c
LEFT JOIN s ON s.FLEET = f.FLEET AND s.CATEGORY = c.CATEGORY"""


def _long_sql() -> str:
    titles = [("action", "Add Effectivity", "PROPOSED_ACTION = 'ADD_EFFECTIVITY'")]
    titles.append(("action", "Validate Effectivity", "PROPOSED_ACTION = 'VALIDATE_EFFECTIVITY'"))
    titles += [("status", status, f"Status = '{status}'") for status in REPORTED]
    counted = " UNION ALL ".join(
        f"SELECT FLEET, '{kind}' AS kind, '{title}' AS title, count(*) FILTER (WHERE {test}) AS n FROM sparse GROUP BY FLEET"
        for kind, title, test in titles
    )
    return f"""{_SPARSE}, f AS (SELECT DISTINCT FLEET FROM sparse),
wanted AS (SELECT DISTINCT FLEET, p_type AS title FROM f CROSS JOIN part UNION SELECT FLEET, 'OTHER' FROM f
  UNION SELECT FLEET, CATEGORY FROM sparse)
SELECT w.FLEET, 'category' AS kind, w.title, count(s.FLEET) AS n FROM wanted w
LEFT JOIN sparse s ON s.FLEET = w.FLEET AND s.CATEGORY = w.title GROUP BY w.FLEET, w.title
UNION ALL {counted}"""


QUERIES = {
    "feedback_rule": Query(
        lambda s, d: _validated(s, d).select("_id", "FEEDBACK", "Status"),
        f"{_with('tracker')} SELECT _id, FEEDBACK, Status FROM fb",
    ),
    "category_fold": Query(
        lambda s, d: _folded(s, d).select("_id", "CATEGORY"),
        f"{_with('tracker')} SELECT _id, CATEGORY FROM folded",
    ),
    "open_rows": Query(
        lambda s, d: rules.open_rows(_validated(s, d)).select("_id", "AC", "Status"),
        f"{_with('tracker')} SELECT _id, AC, Status FROM fb WHERE {_OPEN}",
    ),
    "action_rows": Query(
        lambda s, d: rules.action_rows(view(s, d, "tracker")).select("_id", "PROPOSED_ACTION"),
        f"{with_views('tracker')} SELECT _id, PROPOSED_ACTION FROM tracker WHERE PROPOSED_ACTION <> 'NO_ACTION'",
    ),
    "fill_status": Query(
        lambda s, d: rules.fill_status(view(s, d, "tracker")).select("_id", "Status"),
        f"{with_views('tracker')} SELECT _id, coalesce(Status, 'Initial') AS Status FROM tracker",
    ),
    "open_actions": Query(
        lambda s, d: summary.open_actions(rules.open_rows(_validated(s, d))),
        f"{_with('tracker')} SELECT FLEET, AC, {_ADD}, {_VALIDATE}, {_BOTH} FROM fb WHERE {_OPEN} GROUP BY FLEET, AC",
    ),
    "open_actions_by_category": Query(
        lambda s, d: summary.open_actions(rules.open_rows(_folded(s, d)), ["FLEET", "CATEGORY"]),
        f"""{_with('tracker')} SELECT FLEET, CATEGORY, AC, {_ADD}, {_VALIDATE}, {_BOTH}
        FROM folded WHERE {_OPEN} GROUP BY FLEET, CATEGORY, AC""",
    ),
    "engine_open_actions": Query(
        lambda s, d: summary.open_actions(
            rules.open_rows(_validated(s, d, "engine_tracker")), [], ENGINE_ACTIONS
        ),
        f"""{_with('engine_tracker')} SELECT AC, {_UPDATE},
        count(*) FILTER (WHERE PROPOSED_ACTION = 'UPDATE_EFFECTIVITY') AS TOTAL FROM fb WHERE {_OPEN} GROUP BY AC""",
    ),
    "status_matrix": Query(
        lambda s, d: summary.status_matrix(_validated(s, d)),
        f"{_with('tracker')} SELECT FLEET, AC, {_STATUSES} FROM fb WHERE Status IS NOT NULL GROUP BY FLEET, AC",
    ),
    "status_matrix_by_category": Query(
        lambda s, d: summary.status_matrix(_folded(s, d), ["FLEET", "CATEGORY"]),
        f"""{_with('tracker')} SELECT FLEET, CATEGORY, AC, {_STATUSES} FROM folded
        WHERE Status IS NOT NULL GROUP BY FLEET, CATEGORY, AC""",
    ),
    "engine_status_matrix": Query(
        lambda s, d: summary.status_matrix(_validated(s, d, "engine_tracker"), []),
        f"{_with('engine_tracker')} SELECT AC, {_STATUSES} FROM fb WHERE Status IS NOT NULL GROUP BY AC",
    ),
    "fleet_totals": Query(
        lambda s, d: summary.totals(_validated(s, d)),
        f"{_with('tracker')} SELECT FLEET, {_ADD}, {_VALIDATE}, {_STATUSES} FROM fb GROUP BY FLEET",
    ),
    "fleet_category_counts": Query(
        lambda s, d: summary.category_counts(_folded(s, d)),
        f"{_with('tracker')} SELECT FLEET, CATEGORY, count(*) AS n FROM folded GROUP BY FLEET, CATEGORY",
    ),
    "fleet_totals_with_categories": Query(
        lambda s, d: dimension.totals_with_categories(_folded(s, d)), _wide_sql()
    ),
    "fleet_category_totals": Query(lambda s, d: dimension.pair_totals(_folded(s, d)), _all_pairs_sql("folded")),
    "fleet_category_totals_sparse": Query(
        lambda s, d: dimension.pair_totals(_sparse(s, d)), _all_pairs_sql("sparse")
    ),
    "fleet_category_totals_declared": Query(
        lambda s, d: dimension.pair_totals(_sparse(s, d), _declared(s, d)),
        f"""{_SPARSE}, names AS (SELECT DISTINCT p_type AS CATEGORY FROM part UNION SELECT CATEGORY FROM sparse),
s AS (SELECT FLEET, CATEGORY, {_ADD}, {_VALIDATE}, {_STATUSES} FROM sparse GROUP BY FLEET, CATEGORY)
SELECT f.FLEET, c.CATEGORY, {_ZEROS} FROM (SELECT DISTINCT FLEET FROM sparse) f CROSS JOIN names c
LEFT JOIN s ON s.FLEET = f.FLEET AND s.CATEGORY = c.CATEGORY
WHERE s.FLEET IS NOT NULL OR c.CATEGORY IN (SELECT p_type FROM part)""",
    ),
    "fleet_totals_long": Query(lambda s, d: dimension.long_totals(_sparse(s, d), _declared(s, d)), _long_sql()),
    "engine_totals": Query(
        lambda s, d: summary.totals(_validated(s, d, "engine_tracker"), [], ENGINE_ACTIONS),
        f"{_with('engine_tracker')} SELECT {_UPDATE}, {_STATUSES} FROM fb",
    ),
    "distinct_aircraft": Query(
        lambda s, d: summary.distinct_values(view(s, d, "tracker"), "AC"),
        f"{with_views('tracker')} SELECT DISTINCT AC FROM tracker",
    ),
    "status_counts": Query(
        lambda s, d: summary.value_counts(_validated(s, d), "Status"),
        f"{_with('tracker')} SELECT Status, count(*) AS n FROM fb WHERE Status IS NOT NULL GROUP BY Status",
    ),
}
