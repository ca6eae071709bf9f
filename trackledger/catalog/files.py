"""Registered queries that go through files: sources, exports and publishing.

Each writes data Spark derives from the tables to a new folder below the
shared folder and reads it back with the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.catalog.base import Query
from trackledger.catalog.fixtures import view, with_views
from trackledger.functions import rules
from trackledger.functions.rules import name
from trackledger.model import PACK_SORT, SHEET, SHEET_JSON, user_columns
from trackledger.operators import summary
from trackledger.plans import summaries
from trackledger.session import scratch_path
from trackledger.sinks import publish, versions
from trackledger.sources import files, registry, sheets, text
from trackledger.sources.sheets import PART

ROWS_PER_DOCUMENT = 10_000
_ROWS_PER_TASK = 1_000_000
_SIZED = f"ceil(count(*) / {ROWS_PER_DOCUMENT}.0)"


def write_documents(rows: DataFrame, path: str, part_rows: int | None = None, compression: str | None = None) -> None:
    """One document per sheet below ``path``, its rows by id and its columns numbered from 1.

    With ``part_rows`` a sheet of any size comes in parts of at most so many
    rows, each a document of its own in a numbered folder. Rows meet as they
    are, without the titles and stamps of their cells.
    """
    titles = user_columns(rows)
    stamp = F.lit("2025-02-18 08:00:00").cast("timestamp")
    columns = F.array(
        *[F.struct(F.lit(i + 1).cast("long").alias("id"), F.lit(t).alias("title")) for i, t in enumerate(titles)]
    )
    plain = rows.select(SHEET, "_id", *[name(t).alias(f"_{i}") for i, t in enumerate(titles)])
    by = [SHEET]
    if part_rows is None:
        met = plain.repartition(SHEET)
    else:
        ranged = plain.repartitionByRange(SHEET, "_id").sortWithinPartitions(*plain.columns)
        part = F.floor(F.monotonically_increasing_id() / part_rows)
        met, by = ranged.withColumn(PART, part), [SHEET, PART]

    def nested(row: Column) -> Column:
        cells = [
            F.struct(F.lit(i + 1).cast("long").alias("columnId"), row[f"_{i}"].alias("value")) for i in range(len(titles))
        ]
        return F.struct(
            row["_id"].alias("id"), stamp.alias("createdAt"), stamp.alias("modifiedAt"), F.array(*cells).alias("cells")
        )

    docs = (
        met.groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct(*plain.columns[1:]))).alias("rows"))
        .select(*by, columns.alias("columns"), F.transform("rows", nested).cast(SHEET_JSON["rows"].dataType).alias("rows"))
    )
    docs.write.partitionBy(*by).json(path, compression=compression)


def _tasks(rows: DataFrame, least: int) -> int:
    """Tasks that write ``rows``: ``least``, or as many as leave each a million rows."""
    return max(least, -(-rows.count() // _ROWS_PER_TASK))


def _sheet_documents(spark: SparkSession, sf: str) -> str:
    """The tracker as sheet documents of about ten thousand rows each."""
    rows = view(spark, sf, "tracker")
    documents = rows.agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_DOCUMENT).alias("n")).scalar()
    path = scratch_path(spark, "documents")
    dealt = rows.withColumn(SHEET, F.concat(F.lit("DOC "), (F.col("_id") % documents).cast("string")))
    write_documents(dealt, path, compression="gzip")
    return path


def _sheet_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    titles = user_columns(view(spark, sf, "tracker"))
    scanned = sheets.read_sheets(spark, _sheet_documents(spark, sf), titles, named_by="folder")
    return scanned.drop("_created", "_modified")


def _sheet_lines_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The same by way of landed lines, with the titles found in the documents."""
    landing = scratch_path(spark, "lines")
    sheets.land_documents(spark, _sheet_documents(spark, sf), landing, named_by="folder")
    return sheets.read_landed(spark, landing).drop("_created", "_modified")


def _sheet_columns(spark: SparkSession, sf: str) -> DataFrame:
    found = sheets.sheet_columns(spark, _sheet_documents(spark, sf), named_by="folder")
    return found.groupBy("title", "column_id").agg(F.count(F.lit(1)).alias("n_sheets"))


def _raw_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of all documents as they were kept."""
    landing = scratch_path(spark, "landing")
    sheets.snapshot_raw(spark, f"{_sheet_documents(spark, sf)}/*", landing)
    kept = sheets.read_snapshot(spark, landing)
    return kept.select(F.sha2("document", 256).alias("sha256"), F.length("document").alias("n_chars"))


def _us_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker")
    path = scratch_path(spark, "separated")
    rows.write.options(sep=files.UNIT_SEPARATOR, **text.WRITE).csv(path)
    return files.read_us_csv(spark, path, rows.schema)


def _extract_schema(spark: SparkSession, sf: str) -> DataFrame:
    """An extract written as text takes the types of the sheet."""
    current = view(spark, sf, "dated").withColumn("qty", F.col("qty").cast("int"))
    path = scratch_path(spark, "extract")
    rules.select_user_columns(current).write.options(**text.WRITE).csv(path)
    raw = spark.read.options(**text.READ).csv(path)
    return rules.impose_schema(raw, rules.user_schema(current))


def _two_folders(spark: SparkSession, sf: str) -> str:
    """Extract files of two shapes in one folder, and one file without rows."""
    rows = view(spark, sf, "tracker")
    path = scratch_path(spark, "extracts")
    rows.where("FLEET = 'F1'").select("_id", "AC", "PN").write.parquet(f"{path}/a")
    rows.where("FLEET <> 'F1'").select("_id", "AC", "VENDOR").write.parquet(f"{path}/b")
    rows.where("FLEET = 'none'").select("_id", "AC").coalesce(1).write.parquet(f"{path}/c")
    return path


def _union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    path = _two_folders(spark, sf)
    return files.read_extracts(spark, [f"{path}/a", f"{path}/b", f"{path}/c"])


def _union_frames(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker")
    return files.union_by_name(
        [
            rows.where("FLEET = 'F1'").select("_id", "AC", "PN"),
            rows.where("FLEET <> 'F1'").select("VENDOR", "_id", "AC"),
        ]
    )


def _input_counts(spark: SparkSession, sf: str) -> DataFrame:
    path = _two_folders(spark, sf)
    counted = files.input_counts(spark, [f"{path}/a", f"{path}/b", f"{path}/c"])
    folder = F.regexp_extract(files.SOURCE, "/([abc])/[^/]+$", 1)
    return counted.groupBy(folder.alias("folder")).agg(F.sum("n").cast("long").alias("n"))


def _last_worksheet(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select(
        F.col("AC").alias("workbook"), (F.col("_id") % 10).cast("int").alias("worksheet"), "_id"
    )
    return files.last_worksheet(rows)


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    """One entry per sheet, stored and read as JSON."""
    engine = F.when(F.col("FLEET") == "F3", F.array(F.lit("ac"))).otherwise(F.array(F.lit("ac"), F.lit("engine")))
    entries = (
        view(spark, sf, "tracker")
        .select(SHEET, "FLEET")
        .distinct()
        .select(
            SHEET,
            F.when(F.col("FLEET") == "F1", F.lit("1001")).alias("id"),
            F.concat(F.lit("200"), F.substring("FLEET", 2, 1)).alias("target_id"),
            F.lit("extract").alias("src"),
            F.lit("2025-01-01").alias("date"),
            engine.alias("tags"),
        )
    )
    path = scratch_path(spark, "registry")
    entries.coalesce(1).write.json(path)
    return registry.read_registry(spark, path)


def _registry_by_tag(spark: SparkSession, sf: str) -> DataFrame:
    chosen = registry.select_by_tag(view(spark, sf, "tracker"), _registry(spark, sf), "engine")
    return chosen.select("sheet", "_id", "AC")


def _split_by_ac(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select(
        F.col("FLEET").alias("base"), "_id", "PN", F.when(F.col("_id") % 23 != 0, F.col("AC")).alias("AC")
    )
    path = scratch_path(spark, "split")
    publish.split_by_ac(rows, path)
    return publish.read_export(spark, path, rows.schema).select("base", "AC", "_id", "PN")


def _export_sheets(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    path = scratch_path(spark, "export")
    publish.export_sheets(rows, path)
    return publish.read_export(spark, path, rows.schema).select("sheet", "_id", "Status")


def _export_order(spark: SparkSession, sf: str) -> DataFrame:
    """The place of every row in its sheet, by file and place in the file; a sheet has several files."""
    rows = view(spark, sf, "tracker").select("sheet", *PACK_SORT)
    path = scratch_path(spark, "ordered")
    publish.export_by(rows, [SHEET], path, sort=PACK_SORT, partitions=_tasks(rows, 8))
    return publish.in_order(spark, path, rows.schema, [SHEET])


def _report_order(spark: SparkSession, sf: str) -> DataFrame:
    report = summaries.engine_summaries(view(spark, sf, "engine_tracker"))["all_status"]
    path = scratch_path(spark, "ordered")
    summary.sorted_report(report).write.parquet(path)
    return publish.in_order(spark, path, report.schema).select("AC", "place")


def _inferred_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text without a schema: types come from the cells, over all files of the folder."""
    path = scratch_path(spark, "inferred")
    rows = view(spark, sf, "dated").select("_id", "AC", "Created Date", F.col("qty"), (F.col("qty") / 2).alias("half"))
    rows.repartition(_tasks(rows, 3), "_id").write.options(**text.WRITE).csv(path)
    return files.read_extracts(spark, path, format="csv")


def _publish_swap(spark: SparkSession, sf: str) -> DataFrame:
    """Publish all sheets, then publish one of them again with other rows."""
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    entries = publish.publish(rows, _registry(spark, sf), root, "2025-02-18")
    publish.publish(rows.where("sheet = 'SHEET_F1' AND Status = 'Issue'"), entries, root, "2025-02-19")
    published = publish.read_published(spark, root, rows.schema)
    return published.withColumn("sheet_id", F.when(F.col("sheet_id") == "1001", "1001").otherwise("new"))


def _publish_registry(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    entries = publish.publish(rows, _registry(spark, sf), root, "2025-02-18")
    return entries.select("sheet", (F.col("id") == "1001").alias("kept_id"), "date")


def _publish_target(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    entries = publish.publish_to_target(rows, _registry(spark, sf), root, "2025-02-18")
    published = publish.read_published(spark, root, rows.schema)
    return published.join(entries.select("sheet", "date"), "sheet")


def _partly_registered(spark: SparkSession, sf: str) -> DataFrame:
    """SHEET_F2 is not in the registry, SHEET_F3 has no target."""
    target = F.when(F.col("sheet") != "SHEET_F3", F.col("target_id"))
    return _registry(spark, sf).where("sheet <> 'SHEET_F2'").withColumn("target_id", target)


def _publish_left_out(spark: SparkSession, sf: str) -> DataFrame:
    """Every input row of a set and of a reformat, and where it went."""
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    entries, found = _partly_registered(spark, sf), []
    for job, to_target in (("set", False), ("reformat", True)):
        root = scratch_path(spark, "published")
        done = publish.publish_version(rows, entries, root, "2025-02-18", to_target)
        went = publish.read_published(spark, root, rows.schema).drop("sheet_id").withColumn("went", F.lit(True))
        stayed = done.left_out.withColumn("went", F.lit(False))
        found.append(went.unionByName(stayed).withColumn("job", F.lit(job)))
    return files.union_by_name(found)


def _publish_account(spark: SparkSession, sf: str) -> DataFrame:
    """Fates of all rows of a reformat over sheets that had been set before."""
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    entries = _partly_registered(spark, sf)
    known = publish.publish(rows, entries, root, "2025-02-18")
    done = publish.publish_version(rows.where("Status = 'Issue'"), known, root, "2025-02-19", to_target=True)
    return done.account.select("sheet", "fate", "reason", "n_rows")


def _publish_set_then_reformat(spark: SparkSession, sf: str) -> DataFrame:
    """Moved sheets are under their target only; one without a target stays as it was, with its date."""
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    target = F.when(F.col("sheet") != "SHEET_F3", F.col("target_id"))
    entries = publish.publish(rows, _registry(spark, sf).withColumn("target_id", target), root, "2025-02-18")
    moved = publish.publish_to_target(rows.where("Status = 'Issue'"), entries, root, "2025-02-19")
    published = publish.read_published(spark, root, rows.schema, moved)
    found = published.join(moved.select(F.col("id").alias("sheet_id"), "date"), "sheet_id")
    return found.withColumn("sheet_id", F.when(F.col("sheet_id").startswith("200"), F.col("sheet_id")).otherwise("own"))


def _publish_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A set of all sheets with rows for one: the others are there, empty."""
    rows = view(spark, sf, "tracker").select("sheet", "_id", "Status")
    root = scratch_path(spark, "published")
    entries = publish.publish(rows, _registry(spark, sf), root, "2025-02-18")
    some = rows.where("sheet = 'SHEET_F1'")
    kept = publish.publish_version(some, entries, root, "2025-02-19", covers=publish.with_source(entries)).registry
    left = publish.read_published(spark, root, rows.schema).groupBy("sheet_id").agg(F.count("*").alias("n"))
    held = versions.live(spark, root).join(left, "sheet_id", "left").join(kept, F.col("sheet_id") == F.col("id"))
    return held.select("sheet", "date", "n_rows", F.coalesce("n", F.lit(0)).alias("n_read"))


def _folder_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, "tracker").select("FLEET", "CATEGORY", "AC", "_id")
    path = scratch_path(spark, "folders")
    for fleet in ("F1", "F2", "F3"):
        of_fleet = rows.where(F.col("FLEET") == fleet)
        publish.export_by(of_fleet, ["CATEGORY"], f"{path}/{fleet}/Category")
        publish.export_by(of_fleet, ["AC"], f"{path}/{fleet}/AC")
    return publish.folder_counts(spark, path)


_TRACKER = with_views("tracker")

_DOCS_SQL = f"""{_TRACKER}, docs AS (SELECT 'DOC ' || cast(_id % (SELECT cast({_SIZED} AS BIGINT) FROM tracker) AS varchar)
  AS doc, * EXCLUDE (sheet) FROM tracker)
SELECT doc AS sheet, _id, row_number() OVER (PARTITION BY doc ORDER BY _id) - 1 AS _row,
AC, FLEET, PN, MAIN_PN, VENDOR, CATEGORY, PROPOSED_ACTION, FEEDBACK, Status FROM docs"""
_TITLES = ["AC", "FLEET", "PN", "MAIN_PN", "VENDOR", "CATEGORY", "PROPOSED_ACTION", "FEEDBACK", "Status"]
_COLUMNS_JSON = ",".join(f'{{"id":{i + 1},"title":"{t}"}}' for i, t in enumerate(_TITLES))
_CELLS_SQL = "concat_ws(',', " + ", ".join(
    f"""concat('{{"columnId":{i + 1}', CASE WHEN {t} IS NOT NULL THEN concat(',"value":"', {t}, '"') ELSE '' END, '}}')"""
    for i, t in enumerate(_TITLES)
) + ")"

QUERIES = {
    "sheet_json_scan": Query(_sheet_json_scan, _DOCS_SQL),
    "sheet_lines_scan": Query(_sheet_lines_scan, _DOCS_SQL),
    "sheet_columns": Query(
        _sheet_columns,
        f"""{_TRACKER}, n AS (SELECT count(DISTINCT _id % (SELECT cast({_SIZED} AS BIGINT) FROM tracker)) AS n_sheets
          FROM tracker)
        SELECT title, cast(column_id AS BIGINT) AS column_id, n_sheets FROM n, (VALUES ('AC', 1), ('FLEET', 2),
          ('PN', 3), ('MAIN_PN', 4), ('VENDOR', 5), ('CATEGORY', 6), ('PROPOSED_ACTION', 7), ('FEEDBACK', 8),
          ('Status', 9)) v(title, column_id)""",
    ),
    "raw_snapshot": Query(
        _raw_snapshot,
        f"""{_TRACKER}, docs AS (SELECT _id % (SELECT cast({_SIZED} AS BIGINT) FROM tracker) AS doc, * FROM tracker),
        lines AS (SELECT doc, _id, concat('{{"id":', _id, ',"createdAt":"2025-02-18T08:00:00.000Z",',
          '"modifiedAt":"2025-02-18T08:00:00.000Z","cells":[', {_CELLS_SQL}, ']}}') AS line FROM docs),
        texts AS (SELECT concat('{{"columns":[{_COLUMNS_JSON}],"rows":[', string_agg(line, ',' ORDER BY _id), ']}}',
          chr(10)) AS document FROM lines GROUP BY doc)
        SELECT sha256(document) AS sha256, CAST(length(document) AS INTEGER) AS n_chars FROM texts""",
    ),
    "us_csv_scan": Query(_us_csv_scan, f"{_TRACKER} SELECT * FROM tracker"),
    "extract_schema": Query(
        _extract_schema,
        f"""{with_views('dated')} SELECT sheet, AC, PN, Status, "Created Date", "Modified Date",
        CAST(qty AS INTEGER) AS qty FROM dated""",
    ),
    "union_by_name": Query(
        _union_by_name,
        f"""{_TRACKER} SELECT _id, AC, CASE WHEN FLEET = 'F1' THEN PN END AS PN,
        CASE WHEN FLEET <> 'F1' THEN VENDOR END AS VENDOR FROM tracker""",
    ),
    "union_frames": Query(
        _union_frames,
        f"""{_TRACKER} SELECT _id, AC, CASE WHEN FLEET = 'F1' THEN PN END AS PN,
        CASE WHEN FLEET <> 'F1' THEN VENDOR END AS VENDOR FROM tracker""",
    ),
    "input_counts": Query(
        _input_counts,
        f"""{_TRACKER} SELECT 'a' AS folder, count(*) AS n FROM tracker WHERE FLEET = 'F1'
        UNION ALL SELECT 'b' AS folder, count(*) AS n FROM tracker WHERE FLEET <> 'F1'
        UNION ALL SELECT 'c' AS folder, CAST(0 AS BIGINT) AS n""",
    ),
    "last_worksheet": Query(
        _last_worksheet,
        f"""{_TRACKER}, w AS (SELECT AC AS workbook, CAST(_id % 10 AS INTEGER) AS worksheet, _id FROM tracker)
        SELECT w.* FROM w WHERE worksheet = (SELECT max(m.worksheet) FROM w m WHERE m.workbook = w.workbook)""",
    ),
    "registry_by_tag": Query(
        _registry_by_tag, f"{_TRACKER} SELECT sheet, _id, AC FROM tracker WHERE FLEET IN ('F1', 'F2')"
    ),
    "split_by_ac": Query(
        _split_by_ac,
        f"{_TRACKER} SELECT FLEET AS base, CASE WHEN _id % 23 <> 0 THEN AC END AS AC, _id, PN FROM tracker",
    ),
    "export_sheets": Query(_export_sheets, f"{_TRACKER} SELECT sheet, _id, Status FROM tracker"),
    "export_order": Query(
        _export_order,
        f"""{_TRACKER} SELECT sheet, {', '.join(PACK_SORT)}, row_number() OVER (PARTITION BY sheet
        ORDER BY {', '.join(f'{c} NULLS LAST' for c in PACK_SORT)}) AS place FROM tracker""",
    ),
    "report_order": Query(
        _report_order,
        f"""{with_views('engine_tracker')} SELECT AC, row_number() OVER (ORDER BY AC NULLS LAST) AS place
        FROM (SELECT DISTINCT AC FROM engine_tracker WHERE AC IS NOT NULL
        AND CASE WHEN FEEDBACK IS NOT NULL AND FEEDBACK <> '' THEN 'Validated' ELSE Status END IS NOT NULL) x""",
    ),
    "inferred_text": Query(
        _inferred_text,
        f"""{with_views('dated')} SELECT _id, AC, "Created Date", CAST(qty AS INTEGER) AS qty, qty / 2 AS half FROM dated""",
    ),
    "rows_per_group": Query(
        lambda s, d: publish.rows_per_group(view(s, d, "tracker"), ["sheet", "CATEGORY"]),
        f"{_TRACKER} SELECT sheet, CATEGORY, count(*) AS n FROM tracker GROUP BY sheet, CATEGORY",
    ),
    "publish_swap": Query(
        _publish_swap,
        f"""{_TRACKER} SELECT sheet, _id, Status, CASE WHEN FLEET = 'F1' THEN '1001' ELSE 'new' END AS sheet_id
        FROM tracker WHERE FLEET <> 'F1' OR Status = 'Issue'""",
    ),
    "publish_registry": Query(
        _publish_registry,
        f"{_TRACKER} SELECT DISTINCT sheet, FLEET = 'F1' AS kept_id, '2025-02-18' AS date FROM tracker",
    ),
    "publish_target": Query(
        _publish_target,
        f"""{_TRACKER} SELECT sheet, _id, Status, concat('200', substr(FLEET, 2)) AS sheet_id, '2025-02-18' AS date
        FROM tracker""",
    ),
    "publish_left_out": Query(
        _publish_left_out,
        f"""{_TRACKER} SELECT sheet, _id, Status, sheet <> 'SHEET_F2' AS went, 'set' AS job FROM tracker
        UNION ALL SELECT sheet, _id, Status, sheet = 'SHEET_F1' AS went, 'reformat' AS job FROM tracker""",
    ),
    "publish_account": Query(
        _publish_account,
        f"""{_TRACKER}, i AS (SELECT sheet, count(*) AS n FROM tracker WHERE Status = 'Issue' GROUP BY sheet)
        SELECT sheet, CASE WHEN sheet = 'SHEET_F1' THEN 'moved' ELSE 'left_out' END AS fate,
          CASE sheet WHEN 'SHEET_F2' THEN 'not in the registry' WHEN 'SHEET_F3' THEN 'no target' END AS reason,
          n AS n_rows FROM i
        UNION ALL SELECT sheet, 'cleared' AS fate, CAST(NULL AS VARCHAR) AS reason, count(*) AS n_rows FROM tracker
        WHERE sheet = 'SHEET_F1' GROUP BY sheet""",
    ),
    "publish_set_then_reformat": Query(
        _publish_set_then_reformat,
        f"""{_TRACKER} SELECT sheet, _id, Status,
        CASE WHEN FLEET <> 'F3' THEN concat('200', substr(FLEET, 2)) ELSE 'own' END AS sheet_id,
        CASE WHEN FLEET <> 'F3' THEN '2025-02-19' ELSE '2025-02-18' END AS date
        FROM tracker WHERE FLEET = 'F3' OR Status = 'Issue'""",
    ),
    "publish_empty": Query(
        _publish_empty,
        f"""{_TRACKER} SELECT sheet, '2025-02-19' AS date, count(*) FILTER (WHERE FLEET = 'F1') AS n_rows,
        count(*) FILTER (WHERE FLEET = 'F1') AS n_read FROM tracker GROUP BY sheet""",
    ),
    "folder_counts": Query(
        _folder_counts,
        f"""{_TRACKER} SELECT FLEET AS folder, count(*) AS category_rows, count(*) AS ac_rows
        FROM tracker GROUP BY FLEET""",
    ),
}
