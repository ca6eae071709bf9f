"""Registered queries: whole jobs, from the tables to their results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.catalog import packing, reconciling, reports
from trackledger.catalog.base import Query
from trackledger.catalog.files import ROWS_PER_DOCUMENT, write_documents
from trackledger.catalog.fixtures import view, with_views
from trackledger.model import AIRFRAME_KEY, ENGINE_KEY
from trackledger.operators.dedupe import keep_first
from trackledger.operators.reconcile import reconcile
from trackledger.plans import extracts, sheets, summaries
from trackledger.session import materialize, scratch_path
from trackledger.sinks.publish import read_export
from trackledger.sources import text
from trackledger.sources.files import read_text_cells
from trackledger.sources.sheets import land_documents, read_landed

_CAP = 200
_RUN_DATE = "2025-02-18"


def _feedback(spark: SparkSession, sf: str, engine: bool = False) -> sheets.Outcome:
    keys = ENGINE_KEY if engine else AIRFRAME_KEY
    prefix = "engine_" if engine else ""
    current = keep_first(view(spark, sf, "engine_tracker" if engine else "tracker"), keys, keep_hash=True)
    refresh = keep_first(view(spark, sf, f"{prefix}refresh"), keys, "src_id", keep_hash=True)
    return sheets.feedback(current, refresh, keys=keys)


def _feedback_from_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The current sheets come from documents, a large one in parts, the extract from text."""
    current = keep_first(view(spark, sf, "tracker"), AIRFRAME_KEY)
    documents, landing, extract = (scratch_path(spark, n) for n in ("documents", "lines", "extract"))
    write_documents(current, documents, ROWS_PER_DOCUMENT, compression="gzip")
    land_documents(spark, documents, landing, named_by="folder")
    keep_first(view(spark, sf, "refresh"), AIRFRAME_KEY, "src_id").drop("src_id").write.options(**text.WRITE).csv(extract)
    outcome = sheets.feedback(read_landed(spark, landing), read_text_cells(spark, extract))
    return outcome.sheets.select(*reconciling.ROW)


def _mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """Ops per sheet where the sheet has a number and the extract its digits."""
    current = keep_first(view(spark, sf, "engine_tracker"), ENGINE_KEY).withColumn("LEVEL", F.col("LEVEL").cast("int"))
    refresh = keep_first(view(spark, sf, "engine_refresh"), ENGINE_KEY, "src_id")
    # Written, as both are read twice: to check their keys and to join them.
    reconciled = reconcile(materialize(current), materialize(refresh), ENGINE_KEY)
    return reconciled.groupBy("sheet", "op").agg(F.count("*").alias("n"))


def _refresh_job(spark: SparkSession, sf: str) -> DataFrame:
    """Summary rows after the job, which writes the values of the new summaries under the old ids."""
    outcome = sheets.refresh_summaries(view(spark, sf, "summary_current"), view(spark, sf, "summary_new"))
    return outcome.sheets.select("sheet", "_id", "AC", "n_rows")


def _split_worksheets(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select(
        F.col("FLEET").alias("base"), (F.col("_id") % 7).cast("int").alias("ws"), "AC", "_id", "PN"
    )
    path = scratch_path(spark, "split")
    extracts.split_job(rows, path, worksheet="ws")
    return read_export(spark, path, rows.drop("ws").schema)


def _fleet(spark: SparkSession, sf: str, report: str) -> DataFrame:
    return summaries.fleet_summaries(view(spark, sf, "tracker"))[report]


def _pairs(spark: SparkSession, sf: str, report: str) -> DataFrame:
    return summaries.fleet_category_summaries(view(spark, sf, "tracker"))[report]


def _engine(spark: SparkSession, sf: str, report: str) -> DataFrame:
    return summaries.engine_summaries(view(spark, sf, "engine_tracker"))[report]


def _report_export(spark: SparkSession, sf: str) -> DataFrame:
    made = summaries.fleet_summaries(view(spark, sf, "tracker"))
    path = scratch_path(spark, "reports")
    summaries.export_reports(made, path)
    return read_export(spark, f"{path}/STATUS", made["STATUS"].schema)


def _extract(spark: SparkSession, sf: str) -> DataFrame:
    dates = {"Created Date": F.lit(None).cast("date"), "Modified Date": F.lit(None).cast("date")}
    return view(spark, sf, "partial").withColumns(dates)


def _pack_export(spark: SparkSession, sf: str) -> DataFrame:
    extract = _extract(spark, sf)
    path = scratch_path(spark, "packed")
    extracts.pack_job(extract, path, _RUN_DATE, _CAP)
    packed = read_export(spark, path, extract.schema.add("sheet_name", "string"))
    return packed.select("sheet_name", "_id", "FLEET", "CATEGORY", "PN", "Status", "Created Date")


def _pack_left_out(spark: SparkSession, sf: str) -> DataFrame:
    return extracts.pack_extracts(_extract(spark, sf), _RUN_DATE, _CAP)[1].select("_id", "Status")


_SQL = {**reports.QUERIES, **reconciling.QUERIES, **packing.QUERIES}

QUERIES = {
    "job_fleet_actions": Query(lambda s, d: _fleet(s, d, "ACTIONS"), _SQL["open_actions"].sql),
    "job_fleet_status": Query(lambda s, d: _fleet(s, d, "STATUS"), _SQL["status_matrix"].sql),
    "job_fleet_totals": Query(lambda s, d: _fleet(s, d, "TOTALS"), _SQL["fleet_totals_with_categories"].sql),
    "job_category_actions": Query(lambda s, d: _pairs(s, d, "ACTION"), _SQL["open_actions_by_category"].sql),
    "job_category_status": Query(lambda s, d: _pairs(s, d, "STATUS"), _SQL["status_matrix_by_category"].sql),
    "job_category_totals": Query(lambda s, d: _pairs(s, d, "TOTALS"), _SQL["fleet_category_totals"].sql),
    "job_engine_actions": Query(lambda s, d: _engine(s, d, "all_action"), _SQL["engine_open_actions"].sql),
    "job_engine_status": Query(lambda s, d: _engine(s, d, "all_status"), _SQL["engine_status_matrix"].sql),
    "job_engine_totals": Query(lambda s, d: _engine(s, d, "totals"), _SQL["engine_totals"].sql),
    "job_report_export": Query(_report_export, _SQL["status_matrix"].sql),
    "job_feedback_sheets": Query(
        lambda s, d: _feedback(s, d).sheets.select(*reconciling.ROW),
        f"""{reconciling.with_reconcile()} SELECT {', '.join(reconciling.ROW)} FROM reconciled WHERE op <> 'INSERT'
        UNION ALL SELECT sheet, (SELECT max(_id) FROM c) + row_number() OVER (ORDER BY {reconciling.KEY_ORDER}) AS _id,
        {', '.join(reconciling.ROW[2:])} FROM reconciled WHERE op = 'INSERT'""",
    ),
    "job_feedback_from_documents": Query(
        _feedback_from_documents,
        f"""{reconciling.with_reconcile()} SELECT {', '.join(reconciling.ROW)} FROM reconciled WHERE op <> 'INSERT'
        UNION ALL SELECT sheet, (SELECT max(_id) FROM c) + row_number() OVER (ORDER BY {reconciling.KEY_ORDER}) AS _id,
        {', '.join(reconciling.ROW[2:])} FROM reconciled WHERE op = 'INSERT'""",
    ),
    "job_refresh_summary": Query(
        _refresh_job,
        f"""{with_views('summary_current', 'summary_new')} SELECT c.sheet, c._id, n.AC, n.n_rows
        FROM summary_current c LEFT JOIN summary_new n ON n.sheet = c.sheet AND n.AC = c.AC""",
    ),
    "job_split_worksheets": Query(
        _split_worksheets,
        f"""{with_views('tracker')}, w AS (SELECT FLEET AS base, CAST(_id % 7 AS INTEGER) AS ws, AC, _id, PN FROM tracker)
        SELECT base, AC, _id, PN FROM w WHERE ws = (SELECT max(m.ws) FROM w m WHERE m.base = w.base)""",
    ),
    "job_feedback_counts": Query(lambda s, d: _feedback(s, d).counts, _SQL["command_counts"].sql),
    "job_feedback_engine_counts": Query(
        lambda s, d: _feedback(s, d, engine=True).counts,
        f"""{reconciling.with_reconcile(engine=True)} SELECT sheet,
        count(*) FILTER (WHERE op IN ('REOPEN', 'COMPLETE', 'ERROR')) AS updated,
        count(*) FILTER (WHERE op = 'INSERT') AS inserted FROM reconciled GROUP BY sheet""",
    ),
    "job_dedupe_sheets": Query(
        lambda s, d: sheets.dedupe(view(s, d, "tracker")).sheets, _SQL["apply_delete"].sql
    ),
    "dedupe_sheet_order": Query(
        lambda s, d: sheets.dedupe(view(s, d, "tracker").withColumn("_row", -F.col("_id"))).changes,
        f"""{with_views('tracker')} SELECT sheet, _id FROM (SELECT sheet, _id, row_number() OVER
        (PARTITION BY sheet, AC, FLEET, PN, MAIN_PN, VENDOR ORDER BY _id DESC) AS rn FROM tracker) t WHERE rn > 1""",
    ),
    "reconcile_mixed_types": Query(
        _mixed_types,
        f"""SELECT sheet, op, count(*) AS n
        FROM ({reconciling.QUERIES["engine_reconcile_ops"].sql}) x GROUP BY sheet, op""",
    ),
    "job_pack_export": Query(
        _pack_export,
        f"""{packing.with_pack(_CAP, 'partial')}
        SELECT printf('%s_%s_%02d', t.FLEET, t.CATEGORY, w.sheet_no) AS sheet_name, t._id, t.FLEET, t.CATEGORY, t.PN,
        coalesce(t.Status, 'Initial') AS Status, DATE '{_RUN_DATE}' AS "Created Date"
        FROM partial t JOIN walk w ON t.FLEET = w.FLEET AND t.CATEGORY = w.CATEGORY AND t.PN = w.PN""",
    ),
    "job_pack_left_out": Query(
        _pack_left_out,
        f"""{with_views('partial')} SELECT _id, coalesce(Status, 'Initial') AS Status FROM partial
        WHERE FLEET IS NULL OR CATEGORY IS NULL OR PN IS NULL""",
    ),
}
