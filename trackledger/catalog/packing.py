"""Registered queries: packing, preparation and type conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.catalog.base import Query
from trackledger.catalog.fixtures import view, with_views
from trackledger.functions import conform, rules
from trackledger.model import PACK_REQUIRED, SHEET_ROW_CAP
from trackledger.operators import pack

_SMALL_CAP = 200
_RUN_DATE = "2025-02-18"

def with_pack(cap: int, view_name: str = "tracker") -> str:
    """Greedy packing one unit after the other, all groups side by side."""
    return f"""{with_views(view_name)},
sizes AS (SELECT FLEET, CATEGORY, PN, count(*) AS n,
    row_number() OVER (PARTITION BY FLEET, CATEGORY ORDER BY PN) AS k
  FROM {view_name} WHERE FLEET IS NOT NULL AND CATEGORY IS NOT NULL AND PN IS NOT NULL
  GROUP BY FLEET, CATEGORY, PN),
walk AS (
  SELECT FLEET, CATEGORY, PN, k, n, CAST(1 AS BIGINT) AS sheet_no, n AS used FROM sizes WHERE k = 1
  UNION ALL
  SELECT s.FLEET, s.CATEGORY, s.PN, s.k, s.n,
    CASE WHEN w.used + s.n > {cap} THEN w.sheet_no + 1 ELSE w.sheet_no END,
    CASE WHEN w.used + s.n > {cap} THEN s.n ELSE w.used + s.n END
  FROM walk w JOIN sizes s ON s.FLEET = w.FLEET AND s.CATEGORY = w.CATEGORY AND s.k = w.k + 1)
"""


_NAME = "printf('%s_%s_%02d', FLEET, CATEGORY, sheet_no) AS sheet_name"


def _sheets_sql(cap: int) -> str:
    return f"""{with_pack(cap)} SELECT FLEET, CATEGORY, sheet_no, count(*) AS units, CAST(sum(n) AS BIGINT) AS rows,
    min(PN) AS first_unit, max(PN) AS last_unit, {_NAME} FROM walk GROUP BY FLEET, CATEGORY, sheet_no"""


def _assign_sql(view_name: str) -> str:
    return f"""{with_pack(_SMALL_CAP, view_name)} SELECT t._id, t.FLEET, t.CATEGORY, t.PN, w.sheet_no,
    printf('%s_%s_%02d', t.FLEET, t.CATEGORY, w.sheet_no) AS sheet_name
    FROM {view_name} t JOIN walk w ON t.FLEET = w.FLEET AND t.CATEGORY = w.CATEGORY AND t.PN = w.PN"""


def _assigned(spark: SparkSession, sf: str, name: str) -> DataFrame:
    packed = pack.pack_assign(view(spark, sf, name), cap=_SMALL_CAP)
    return packed.select("_id", "FLEET", "CATEGORY", "PN", "sheet_no", "sheet_name")


def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    extract = view(spark, sf, "tracker").select("sheet", "_id", "AC", "PN", "PROPOSED_ACTION", "FEEDBACK")
    return rules.seed_columns(extract, _RUN_DATE)


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    extract = view(spark, sf, "partial").withColumns(
        {"Created Date": F.lit(None).cast("date"), "Modified Date": F.lit(None).cast("date")}
    )
    return rules.stamp_dates(rules.fill_status(extract), _RUN_DATE)


QUERIES = {
    "pack_unit_counts": Query(
        lambda s, d: pack.unit_counts(view(s, d, "partial")),
        f"""{with_views('partial')} SELECT FLEET, CATEGORY, PN, count(*) AS n FROM partial
        WHERE FLEET IS NOT NULL AND CATEGORY IS NOT NULL AND PN IS NOT NULL GROUP BY FLEET, CATEGORY, PN""",
    ),
    "pack_sheets": Query(
        lambda s, d: pack.pack_sheets(view(s, d, "tracker"), cap=_SMALL_CAP), _sheets_sql(_SMALL_CAP)
    ),
    "pack_sheets_full_cap": Query(
        lambda s, d: pack.pack_sheets(view(s, d, "tracker")), _sheets_sql(SHEET_ROW_CAP)
    ),
    "pack_assign": Query(lambda s, d: _assigned(s, d, "tracker"), _assign_sql("tracker")),
    "pack_assign_partial": Query(lambda s, d: _assigned(s, d, "partial"), _assign_sql("partial")),
    "pack_rejects": Query(
        lambda s, d: pack.pack_rejects(view(s, d, "partial")),
        f"{with_views('partial')} SELECT * FROM partial WHERE FLEET IS NULL OR CATEGORY IS NULL OR PN IS NULL",
    ),
    "prepare_extract": Query(
        _prepared,
        f"""{with_views('partial')} SELECT * EXCLUDE (Status), coalesce(Status, 'Initial') AS Status,
        DATE '{_RUN_DATE}' AS "Created Date", DATE '{_RUN_DATE}' AS "Modified Date" FROM partial""",
    ),
    "required_columns": Query(
        lambda s, d: rules.require_columns(_prepared(s, d), PACK_REQUIRED).select(*PACK_REQUIRED),
        f"""{with_views('partial')} SELECT coalesce(Status, 'Initial') AS Status, DATE '{_RUN_DATE}' AS "Created Date",
        DATE '{_RUN_DATE}' AS "Modified Date", CATEGORY, PN, MAIN_PN, AC, FLEET FROM partial""",
    ),
    "seed_columns": Query(
        _seeded,
        f"""{with_views('tracker')} SELECT _id,
        CASE WHEN FEEDBACK IS NOT NULL AND FEEDBACK <> '' THEN 'Validated' ELSE 'Initial' END AS Status,
        '' AS Assignment, '' AS Notes, DATE '{_RUN_DATE}' AS "Created Date", DATE '{_RUN_DATE}' AS "Modified Date",
        AC, PN, PROPOSED_ACTION, FEEDBACK FROM tracker""",
    ),
    "conform_types": Query(
        lambda s, d: conform.conform(view(s, d, "dated"))[0],
        f"""{with_views('dated')} SELECT sheet, _id, AC, PN, Status,
        CAST("Created Date" AS DATE) AS "Created Date", CAST("Modified Date" AS DATE) AS "Modified Date",
        CAST(qty AS VARCHAR) AS qty
        FROM dated WHERE (Status IS NULL OR Status <> 'Error') AND ("Created Date" IS NULL OR "Created Date" <> 'n/a')""",
    ),
    "conform_accounts_for_all": Query(
        lambda s, d: conform.conform_all(view(s, d, "dated")),
        f"""{with_views('dated')} SELECT sheet, _id, AC, PN, Status,
        TRY_CAST("Created Date" AS DATE) AS "Created Date", CAST("Modified Date" AS DATE) AS "Modified Date",
        CAST(qty AS VARCHAR) AS qty, coalesce(Status, '') = 'Error' OR coalesce("Created Date", '') = 'n/a' AS _rejected
        FROM dated""",
    ),
    "conform_rejects": Query(
        lambda s, d: conform.conform(view(s, d, "dated"))[1],
        f"""{with_views('dated')}
        SELECT sheet, _id, 'Status' AS "column", Status AS value, 'not in picklist' AS reason
        FROM dated WHERE Status = 'Error'
        UNION ALL SELECT sheet, _id, 'Created Date' AS "column", "Created Date" AS value, 'not a date' AS reason
        FROM dated WHERE "Created Date" = 'n/a'""",
    ),
}
