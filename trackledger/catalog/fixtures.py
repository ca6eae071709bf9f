"""Tracker views over the test tables, in SQL that both engines run as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Name -> SQL; a view may use the ones above it.
VIEWS = {
    "tracker": """
SELECT concat('SHEET_', FLEET) AS sheet, * FROM (
  SELECT l_orderkey * 10000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS _id,
    concat('AC', cast(l_suppkey % 40 AS varchar(10))) AS AC,
    CASE (l_suppkey % 40) % 3 WHEN 0 THEN 'F1' WHEN 1 THEN 'F2' ELSE 'F3' END AS FLEET,
    concat('PN', cast(l_partkey AS varchar(20))) AS PN,
    p_brand AS MAIN_PN,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('V', cast(l_suppkey % 5 AS varchar(10))) END AS VENDOR,
    CASE p_type WHEN 'ECONOMY' THEN 'KIT' WHEN 'LARGE' THEN 'GEN-CON' WHEN 'SMALL' THEN 'SOFTWARE'
                WHEN 'MEDIUM' THEN 'ROTABLE' WHEN 'STANDARD' THEN 'EXPENDABLE' ELSE 'OTHER' END AS CATEGORY,
    CASE l_returnflag WHEN 'A' THEN 'ADD_EFFECTIVITY' WHEN 'N' THEN 'VALIDATE_EFFECTIVITY'
                      ELSE 'NO_ACTION' END AS PROPOSED_ACTION,
    CASE cast(round(l_discount * 100) AS int) WHEN 0 THEN 'ok' WHEN 10 THEN '' WHEN 5 THEN ' '
         ELSE NULL END AS FEEDBACK,
    CASE (l_orderkey + l_linenumber) % 10 WHEN 1 THEN 'Initial' WHEN 2 THEN 'Assigned' WHEN 3 THEN 'In-Work'
      WHEN 4 THEN 'Issue' WHEN 5 THEN 'Updated' WHEN 6 THEN 'Re-Opened' WHEN 7 THEN 'Validated'
      WHEN 8 THEN 'Complete' WHEN 9 THEN 'Error' ELSE NULL END AS Status
  FROM lineitem JOIN part ON l_partkey = p_partkey) t""",
    "refresh": """
SELECT sheet, AC, FLEET, CASE WHEN _id % 11 = 0 THEN concat('NEW', PN) ELSE PN END AS PN,
  MAIN_PN, VENDOR, CATEGORY,
  CASE PROPOSED_ACTION WHEN 'ADD_EFFECTIVITY' THEN 'NO_ACTION' WHEN 'NO_ACTION' THEN 'VALIDATE_EFFECTIVITY'
       ELSE PROPOSED_ACTION END AS PROPOSED_ACTION,
  _id AS src_id
FROM tracker WHERE _id % 10 <> 3""",
    "engine_tracker": """
SELECT sheet, _id, AC, FLEET, PN, MAIN_PN AS NHA, CATEGORY AS TOP, cast(_id % 4 AS varchar(10)) AS LEVEL,
  CASE WHEN PROPOSED_ACTION = 'NO_ACTION' THEN 'NO_ACTION' ELSE 'UPDATE_EFFECTIVITY' END AS PROPOSED_ACTION,
  FEEDBACK, Status
FROM tracker""",
    "engine_refresh": """
SELECT sheet, AC, FLEET, CASE WHEN _id % 11 = 0 THEN concat('NEW', PN) ELSE PN END AS PN, NHA, TOP, LEVEL,
  CASE WHEN _id % 3 = 0 THEN 'NO_ACTION' ELSE 'UPDATE_EFFECTIVITY' END AS PROPOSED_ACTION,
  _id AS src_id
FROM engine_tracker WHERE _id % 10 <> 3""",
    "summary_current": """
SELECT concat('SUMMARY_', FLEET) AS sheet, min(_id) AS _id, AC, count(*) AS n_rows
FROM tracker WHERE AC <> 'AC9' GROUP BY FLEET, AC""",
    "summary_new": """
SELECT concat('SUMMARY_', FLEET) AS sheet, AC, count(*) AS n_rows
FROM tracker WHERE AC <> 'AC7' AND Status IS NOT NULL GROUP BY FLEET, AC""",
    "totals_current": """
SELECT concat('TOTALS_', FLEET) AS sheet, min(_id) AS _id, count(*) AS n_rows FROM tracker GROUP BY FLEET""",
    "totals_new": """
SELECT concat('TOTALS_', FLEET) AS sheet, count(*) AS n_rows
FROM tracker WHERE Status IS NOT NULL GROUP BY FLEET""",
    "dated": """
SELECT sheet, _id, AC, PN, Status,
  CASE WHEN _id % 7 = 0 THEN 'n/a' WHEN _id % 5 = 0 THEN NULL ELSE '2025-02-18' END AS "Created Date",
  '2025-03-01' AS "Modified Date", _id % 9 AS qty
FROM tracker""",
    "partial": """
SELECT sheet, _id, CASE WHEN _id % 13 = 0 THEN NULL ELSE FLEET END AS FLEET,
  CASE WHEN _id % 17 = 0 THEN NULL ELSE CATEGORY END AS CATEGORY,
  CASE WHEN _id % 19 = 0 THEN NULL ELSE PN END AS PN, MAIN_PN, AC, Status
FROM tracker""",
}

_TABLES = ("lineitem", "part")


def _needed(name: str) -> list[str]:
    """The view and the views it uses, in order."""
    order = list(VIEWS)
    wanted = {name}
    for view in reversed(order[: order.index(name) + 1]):
        if view in wanted:
            words = set(VIEWS[view].replace("(", " ").replace(")", " ").split())
            wanted |= {v for v in order if v in words}
    return [v for v in order if v in wanted]


def with_views(*names: str) -> str:
    """The WITH list that defines the named views for an oracle."""
    wanted = {v for n in names for v in _needed(n)}
    return "WITH RECURSIVE " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in wanted)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a DataFrame over the Parquet tables."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES}
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in _needed(name)).replace('"', "`")
    sql = f"WITH {ctes} SELECT * FROM {name}"
    for t in _TABLES:
        sql = sql.replace(f" {t} ", f" {{{t}}} ")
    return spark.sql(sql, **tables)
