"""Registered queries: dedupe, reconcile, change sets and summary refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.catalog.base import Query
from trackledger.catalog.fixtures import view, with_views
from trackledger.model import AIRFRAME_KEY, ENGINE_KEY, OP, user_columns
from trackledger.operators import changes, refresh
from trackledger.operators.dedupe import duplicate_ids, duplicate_rows, keep_first
from trackledger.operators.reconcile import inserts, key_violations, reconcile, updates

_AIR = ", ".join(AIRFRAME_KEY)
_ENG = ", ".join(ENGINE_KEY)
_TRACKER_COLUMNS = [
    "AC", "FLEET", "PN", "MAIN_PN", "VENDOR", "CATEGORY", "PROPOSED_ACTION", "FEEDBACK", "Status",
]


def _reconcile(spark: SparkSession, sf: str, engine: bool = False, null_safe: bool = False) -> DataFrame:
    current, new, keys = (
        ("engine_tracker", "engine_refresh", ENGINE_KEY) if engine else ("tracker", "refresh", AIRFRAME_KEY)
    )
    return reconcile(
        keep_first(view(spark, sf, current), keys, keep_hash=True),
        keep_first(view(spark, sf, new), keys, "src_id", keep_hash=True),
        keys,
        null_safe=null_safe,
        # Both sides have one row per key already, null keys included.
        validate=False,
        spread_nulls=False,
    )


def with_reconcile(engine: bool = False, null_safe: bool = False) -> str:
    """Reconcile the long way: left join, anti join, union, then the rules."""
    current, new, keys = (
        ("engine_tracker", "engine_refresh", ENGINE_KEY) if engine else ("tracker", "refresh", AIRFRAME_KEY)
    )
    listed = ", ".join(keys)
    equal = "IS NOT DISTINCT FROM" if null_safe else "="
    match = " AND ".join(["c.sheet = r.sheet", *[f"c.{k} {equal} r.{k}" for k in keys]])
    # What an insert takes from the refresh, in the order of the tracker columns.
    taken = {c: f"r.{c}" for c in [*keys, "PROPOSED_ACTION"]}
    if not engine:
        taken["CATEGORY"] = "r.CATEGORY"
        columns = _TRACKER_COLUMNS
    else:
        columns = [*keys, "PROPOSED_ACTION", "FEEDBACK", "Status"]
    old = ", ".join(f"c.{c}" for c in columns)
    fresh = ", ".join(f"{taken.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in columns)
    return f"""{with_views(current, new)},
c AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sheet, {listed} ORDER BY _id) AS rn
      FROM {current}) WHERE rn = 1),
r AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY sheet, {listed} ORDER BY src_id) AS rn
      FROM {new}) WHERE rn = 1),
joined AS (
  SELECT c.sheet, c._id, {old}, r.PROPOSED_ACTION AS new_action FROM c LEFT JOIN r ON {match}
  UNION ALL
  SELECT r.sheet, NULL AS _id, {fresh}, NULL AS new_action FROM r
  WHERE r.PROPOSED_ACTION <> 'NO_ACTION' AND NOT EXISTS (SELECT 1 FROM c WHERE {match})),
marked AS (SELECT *, CASE
    WHEN _id IS NULL THEN 'INSERT'
    WHEN Status = 'Updated' AND new_action <> 'NO_ACTION' THEN 'REOPEN'
    WHEN Status IN ('Initial', 'Assigned', 'In-Work', 'Issue', 'Updated', 'Re-Opened')
         AND new_action = 'NO_ACTION' THEN 'COMPLETE'
    WHEN new_action IS NULL THEN 'ERROR' ELSE 'KEEP' END AS op FROM joined),
reconciled AS (SELECT * EXCLUDE (Status, new_action), Status AS _old_status,
    CASE op WHEN 'REOPEN' THEN 'Re-Opened' WHEN 'COMPLETE' THEN 'Complete' WHEN 'ERROR' THEN 'Error'
    ELSE Status END AS Status FROM marked)
"""


def _ops(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select("sheet", "_id", *keys, "_old_status", "Status", OP)


def _apply_update(spark: SparkSession, sf: str) -> DataFrame:
    changed = updates(_reconcile(spark, sf))
    return changes.apply_update(view(spark, sf, "tracker"), changed, ["Status"])


def _apply_delete(spark: SparkSession, sf: str) -> DataFrame:
    tracker = view(spark, sf, "tracker")
    return changes.apply_delete(tracker, duplicate_rows(tracker, AIRFRAME_KEY))


def _apply_insert(spark: SparkSession, sf: str) -> DataFrame:
    tracker = view(spark, sf, "tracker")
    target = keep_first(tracker, AIRFRAME_KEY)
    last_id = tracker.agg(F.max("_id").alias("m")).scalar()
    return changes.apply_insert(
        target, inserts(_reconcile(spark, sf)), ["sheet", *AIRFRAME_KEY], last_id=last_id
    )


def _insert_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker")
    cells = changes.payload(rows, drop_falsy=True)
    return rows.select("_id", F.inline(cells))


def _update_payload(spark: SparkSession, sf: str) -> DataFrame:
    rows = changes.update_payload(updates(_reconcile(spark, sf)), ["Status", "FEEDBACK"])
    return rows.select("sheet", "_id", F.inline("cells"))


def _column_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Change cells with column ids; the sheets number their columns differently."""
    rows = updates(_reconcile(spark, sf))
    columns = (
        rows.select("sheet", "FLEET")
        .distinct()
        .select(
            "sheet",
            F.expr(
                "inline(array(struct(10L * cast(substr(FLEET, 2) AS bigint) AS column_id, 'Status' AS title),"
                " struct(10L * cast(substr(FLEET, 2) AS bigint) + 1 AS column_id, 'Notes' AS title)))"
            ),
        )
    )
    cells = changes.with_column_ids(changes.update_payload(rows, ["Status", "FEEDBACK"]), columns)
    return cells.select("sheet", "_id", F.inline("cells"))


def _change_set(spark: SparkSession, sf: str) -> DataFrame:
    titles = user_columns(view(spark, sf, "tracker"))
    changed = changes.change_set(_reconcile(spark, sf), titles)
    return changed.select(
        "sheet", OP, "_id", F.size("cells").cast("long").alias("n_cells"), F.col("cells")[0]["value"].alias("first")
    )


KEY_ORDER = ", ".join(f"{k} NULLS LAST" for k in ["sheet", *AIRFRAME_KEY])
ROW = ["sheet", "_id", *_TRACKER_COLUMNS]
_UNPIVOT = " UNION ALL ".join(
    f"SELECT _id, '{c}' AS title, {c} AS value FROM tracker WHERE {c} IS NOT NULL AND {c} <> ''"
    for c in _TRACKER_COLUMNS
)
_FILLED = " + ".join(f"(CASE WHEN {c} IS NOT NULL AND {c} <> '' THEN 1 ELSE 0 END)" for c in _TRACKER_COLUMNS)


def _dup_sql(view_name: str, keys: str) -> str:
    return f"""{with_views(view_name)} SELECT sheet, _id FROM
(SELECT sheet, _id, row_number() OVER (PARTITION BY sheet, {keys} ORDER BY _id) AS rn FROM {view_name}) t WHERE rn > 1"""


def _refresh_sql(current: str, new: str, match: str, key: str) -> str:
    return f"""{with_views(current, new)}
SELECT coalesce(n.sheet, c.sheet) AS sheet, c._id, {key} n.n_rows,
  CASE WHEN n.sheet IS NOT NULL AND c.sheet IS NOT NULL THEN 'UPDATE'
       WHEN c.sheet IS NOT NULL THEN 'BLANK' ELSE 'UNMATCHED_NEW' END AS op
FROM {new} n FULL JOIN {current} c ON {match}"""


QUERIES = {
    "dup_ids": Query(
        lambda s, d: duplicate_ids(view(s, d, "tracker"), AIRFRAME_KEY), _dup_sql("tracker", _AIR)
    ),
    "engine_dup_ids": Query(
        lambda s, d: duplicate_ids(view(s, d, "engine_tracker"), ENGINE_KEY), _dup_sql("engine_tracker", _ENG)
    ),
    "dedupe_keep": Query(
        lambda s, d: keep_first(view(s, d, "tracker"), AIRFRAME_KEY),
        f"""{with_views('tracker')} SELECT * EXCLUDE (rn) FROM
        (SELECT *, row_number() OVER (PARTITION BY sheet, {_AIR} ORDER BY _id) AS rn FROM tracker) t WHERE rn = 1""",
    ),
    "key_violations": Query(
        lambda s, d: key_violations(view(s, d, "tracker"), AIRFRAME_KEY),
        f"""{with_views('tracker')} SELECT sheet, {_AIR}, count(*) AS n FROM tracker
        WHERE AC IS NOT NULL AND FLEET IS NOT NULL AND PN IS NOT NULL AND MAIN_PN IS NOT NULL AND VENDOR IS NOT NULL
        GROUP BY sheet, {_AIR} HAVING count(*) > 1""",
    ),
    "key_violations_null_safe": Query(
        lambda s, d: key_violations(view(s, d, "tracker"), AIRFRAME_KEY, null_safe=True),
        f"""{with_views('tracker')} SELECT sheet, {_AIR}, count(*) AS n FROM tracker
        GROUP BY sheet, {_AIR} HAVING count(*) > 1""",
    ),
    "reconcile_ops": Query(
        lambda s, d: _ops(_reconcile(s, d), AIRFRAME_KEY),
        f"{with_reconcile()} SELECT sheet, _id, {_AIR}, _old_status, Status, op FROM reconciled",
    ),
    "reconcile_status": Query(
        lambda s, d: _reconcile(s, d).select(*ROW),
        f"{with_reconcile()} SELECT {', '.join(ROW)} FROM reconciled",
    ),
    "reconcile_null_safe": Query(
        lambda s, d: _ops(_reconcile(s, d, null_safe=True), AIRFRAME_KEY),
        f"{with_reconcile(null_safe=True)} SELECT sheet, _id, {_AIR}, _old_status, Status, op FROM reconciled",
    ),
    "engine_reconcile_ops": Query(
        lambda s, d: _ops(_reconcile(s, d, engine=True), ENGINE_KEY),
        f"{with_reconcile(engine=True)} SELECT sheet, _id, {_ENG}, _old_status, Status, op FROM reconciled",
    ),
    "reconcile_inserts": Query(
        lambda s, d: inserts(_reconcile(s, d)).select("sheet", *_TRACKER_COLUMNS),
        f"{with_reconcile()} SELECT sheet, {', '.join(_TRACKER_COLUMNS)} FROM reconciled WHERE op = 'INSERT'",
    ),
    "change_counts": Query(
        lambda s, d: changes.change_counts(_reconcile(s, d)),
        f"{with_reconcile()} SELECT sheet, op, count(*) AS n FROM reconciled GROUP BY sheet, op",
    ),
    "command_counts": Query(
        lambda s, d: changes.command_counts(_reconcile(s, d)),
        f"""{with_reconcile()} SELECT sheet,
        count(*) FILTER (WHERE op IN ('REOPEN', 'COMPLETE', 'ERROR')) AS updated,
        count(*) FILTER (WHERE op = 'INSERT') AS inserted FROM reconciled GROUP BY sheet""",
    ),
    "change_set": Query(
        _change_set,
        f"""{with_reconcile()} SELECT sheet, op, _id,
        CAST(CASE WHEN op = 'INSERT' THEN {_FILLED} ELSE 1 END AS BIGINT) AS n_cells,
        CASE WHEN op = 'INSERT' THEN AC ELSE Status END AS first FROM reconciled WHERE op <> 'KEEP'""",
    ),
    "insert_payload": Query(_insert_payload, f"{with_views('tracker')} {_UNPIVOT}"),
    "update_payload": Query(
        _update_payload,
        f"""{with_reconcile()}, u AS (SELECT * FROM reconciled WHERE op IN ('REOPEN', 'COMPLETE', 'ERROR'))
        SELECT sheet, _id, 'Status' AS title, Status AS value FROM u
        UNION ALL SELECT sheet, _id, 'FEEDBACK' AS title, FEEDBACK AS value FROM u""",
    ),
    "payload_column_ids": Query(
        _column_ids,
        f"""{with_reconcile()} SELECT sheet, _id, 10 * CAST(substr(FLEET, 2) AS BIGINT) AS "columnId", Status AS value
        FROM reconciled WHERE op IN ('REOPEN', 'COMPLETE', 'ERROR')""",
    ),
    "apply_update": Query(
        _apply_update,
        f"""{with_reconcile()}, u AS (SELECT sheet, _id, Status FROM reconciled
          WHERE op IN ('REOPEN', 'COMPLETE', 'ERROR'))
        SELECT t.* EXCLUDE (Status), CASE WHEN u._id IS NOT NULL THEN u.Status ELSE t.Status END AS Status
        FROM tracker t LEFT JOIN u ON t.sheet = u.sheet AND t._id = u._id""",
    ),
    "apply_delete": Query(
        _apply_delete,
        f"""{with_views('tracker')} SELECT * EXCLUDE (rn) FROM
        (SELECT *, row_number() OVER (PARTITION BY sheet, {_AIR} ORDER BY _id) AS rn FROM tracker) t WHERE rn = 1""",
    ),
    "apply_insert": Query(
        _apply_insert,
        f"""{with_reconcile()} SELECT {', '.join(ROW)} FROM c
        UNION ALL SELECT sheet, (SELECT max(_id) FROM tracker) + row_number() OVER (ORDER BY {KEY_ORDER}) AS _id,
        {', '.join(_TRACKER_COLUMNS)} FROM reconciled WHERE op = 'INSERT'""",
    ),
    "refresh_summary_ops": Query(
        lambda s, d: refresh.refresh_summary(view(s, d, "summary_current"), view(s, d, "summary_new")),
        _refresh_sql("summary_current", "summary_new", "n.sheet = c.sheet AND n.AC = c.AC", "n.AC,"),
    ),
    "refresh_totals": Query(
        lambda s, d: refresh.refresh_summary(view(s, d, "totals_current"), view(s, d, "totals_new")),
        _refresh_sql("totals_current", "totals_new", "n.sheet = c.sheet", ""),
    ),
    "refresh_paired_by_choice": Query(
        lambda s, d: refresh.refresh_summary(
            view(s, d, "totals_current").withColumn("AC", F.lit("A")),
            view(s, d, "totals_new").withColumn("AC", F.lit("B")),
            paired=view(s, d, "totals_new").where("sheet <> 'TOTALS_F2'"),
        ),
        f"""{with_views('totals_current', 'totals_new')} SELECT n.sheet, c._id, n.n_rows, 'B' AS AC, 'UPDATE' AS op
        FROM totals_new n JOIN totals_current c ON c.sheet = n.sheet WHERE n.sheet <> 'TOTALS_F2'
        UNION ALL SELECT sheet, _id, CAST(NULL AS BIGINT) AS n_rows, CAST(NULL AS VARCHAR) AS AC, 'BLANK' AS op
        FROM totals_current WHERE sheet = 'TOTALS_F2'
        UNION ALL SELECT sheet, CAST(NULL AS BIGINT) AS _id, n_rows, 'B' AS AC, 'UNMATCHED_NEW' AS op
        FROM totals_new WHERE sheet = 'TOTALS_F2'""",
    ),
    "summary_key_violations": Query(
        lambda s, d: key_violations(view(s, d, "summary_new").unionByName(view(s, d, "summary_new").where("n_rows % 2 = 0")), ["AC"]),
        f"""{with_views('summary_new')} SELECT sheet, AC, CAST(2 AS BIGINT) AS n FROM summary_new WHERE n_rows % 2 = 0""",
    ),
}
