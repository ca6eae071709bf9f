import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trackledger.catalog.files import write_documents
from trackledger.model import REGISTRY, SHEET_JSON
from trackledger.plans import extracts, sheets as jobs
from trackledger.sinks import publish
from trackledger.__main__ import run
from trackledger.sources import files, ledger, registry, sheets, text


@pytest.fixture
def documents(tmp_path):
    def cells(*values):
        return [{"columnId": c, "value": v} if v is not ... else {"columnId": c} for c, v in values]

    stamps = {"createdAt": "2025-01-01T00:00:00Z", "modifiedAt": "2025-01-02T00:00:00Z"}
    one = {
        "columns": [{"id": 11, "title": "AC"}, {"id": 12, "title": "Qty"}, {"id": 13, "title": "a.b"}],
        "rows": [
            {"id": 5, **stamps, "cells": cells((11, "A"), (12, 5.0), (13, ...))},
            {"id": 4, **stamps, "cells": cells((12, "x"), (13, True))},
        ],
    }
    two = {
        "columns": [{"id": 21, "title": "AC"}, {"id": 22, "title": "Notes"}],
        "rows": [{"id": 5, **stamps, "cells": cells((21, "B"), (22, "é\n"))}],
    }
    empty = {"columns": [{"id": 31, "title": "AC"}], "rows": []}
    folder = tmp_path / "docs"
    folder.mkdir()
    for title, doc in {"One + 1": one, "two": two, "none": empty}.items():
        (folder / f"{title}.json").write_text(json.dumps(doc, indent=1))
    return str(folder)


def test_sheets_scan_to_rows_in_sheet_order(spark, documents):
    df = sheets.read_sheets(spark, documents)
    assert df.columns[:5] == ["sheet", "_id", "_created", "_modified", "_row"]
    assert set(df.columns[5:]) == {"AC", "Qty", "a.b", "Notes"}
    rows = df.orderBy("sheet", "_row").collect()
    assert [(r["sheet"], r["_id"], r["_row"], r["AC"], r["Qty"], r["a.b"], r["Notes"]) for r in rows] == [
        ("One + 1", 5, 0, "A", "5.0", None, None),
        ("One + 1", 4, 1, None, "x", "true", None),
        ("two", 5, 0, "B", None, None, "é\n"),
    ]
    assert rows[0]["_created"].year == 2025


def test_titles_and_types_can_be_given(spark, documents):
    df = sheets.read_sheets(spark, documents, {"AC": T.StringType()})
    assert df.columns[5:] == ["AC"]
    columns = sheets.sheet_columns(spark, documents)
    assert {(r["sheet"], r["column_id"], r["title"]) for r in columns.where("sheet = 'two'").collect()} == {
        ("two", 21, "AC"), ("two", 22, "Notes"),
    }


def _one_document(tmp_path, document, title="s"):
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / f"{title}.json").write_text(json.dumps(document))
    return str(tmp_path / "one")


def test_of_equal_titles_the_last_cell_counts(spark, tmp_path):
    stamps = {"createdAt": "2025-01-01T00:00:00Z", "modifiedAt": "2025-01-01T00:00:00Z"}
    columns = [{"id": 1, "title": "A"}, {"id": 2, "title": "B"}, {"id": 3, "title": "A"}]

    def row(i, *cells):
        return {"id": i, **stamps, "cells": [{"columnId": c, "value": v} if v != "none" else {"columnId": c} for c, v in cells]}

    rows = [
        row(1, (1, "a"), (2, "b"), (3, "c")), row(2, (1, "a"), (2, "b")), row(3, (3, "c")), row(4, (2, "b"), (3, "none")),
        row(5), row(6, (3, "c"), (1, "a")), row(7, (9, "?"), (2, "b")),
    ]
    path = _one_document(tmp_path, {"columns": columns, "rows": rows})
    want = [(1, "c", "b"), (2, "a", "b"), (3, "c", None), (4, None, "b"), (5, None, None), (6, "a", None), (7, None, "b")]
    sheets.land_documents(spark, path, str(tmp_path / "lines"))
    for df in (sheets.read_sheets(spark, path), sheets.read_landed(spark, str(tmp_path / "lines"))):
        assert [(r["_id"], r["A"], r["B"]) for r in df.orderBy("_row").collect()] == want


def test_landed_lines_are_the_documents(spark, documents, tmp_path):
    landing = str(tmp_path / "lines")
    sheets.land_documents(spark, documents, landing)
    direct, landed = sheets.read_sheets(spark, documents), sheets.read_landed(spark, landing)
    assert landed.dtypes == direct.dtypes
    assert sorted(map(tuple, landed.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    columns = sheets.landed_columns(spark, landing)
    assert sorted(map(tuple, columns.collect())) == sorted(map(tuple, sheets.sheet_columns(spark, documents).collect()))
    typed = sheets.read_landed(spark, landing, {"AC": T.StringType(), "none": T.LongType()})
    assert typed.columns[5:] == ["AC", "none"] and typed.count() == 3


def test_one_document_is_read_by_many_tasks(spark, tmp_path):
    stamps = {"createdAt": "2025-01-01T00:00:00Z", "modifiedAt": "2025-01-01T00:00:00Z"}
    rows = [{"id": k, **stamps, "cells": [{"columnId": 1, "value": hashlib.sha512(str(k).encode()).hexdigest()}]} for k in range(20_000)]
    path = _one_document(tmp_path, {"columns": [{"id": 1, "title": "A"}], "rows": rows})
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.files.maxPartitionBytes": "128k", "spark.sql.files.openCostInBytes": "0", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sheets.land_documents(spark, path, str(tmp_path / "lines"))
        landed = sheets.read_landed(spark, str(tmp_path / "lines"))
        tasks = landed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sum(r["count"] for r in tasks) == 20_000 and len(tasks) > 3
    assert landed.where("_row <> _id").isEmpty()


def test_snapshot_notices_a_changed_document(spark, documents, tmp_path):
    sheets.snapshot_raw(spark, documents, str(tmp_path / "kept"))
    assert sheets.read_snapshot(spark, str(tmp_path / "kept")).count() == 3
    kept = spark.read.parquet(str(tmp_path / "kept"))
    kept.withColumn("document", F.concat("document", F.lit(" "))).write.parquet(str(tmp_path / "changed"))
    with pytest.raises(Exception, match="differs from its digest"):
        sheets.read_snapshot(spark, str(tmp_path / "changed")).collect()


def test_text_is_split_unless_a_cell_has_a_line_break(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"say ""x"""\n2,\n')
    (tmp_path / "broken.csv").write_text('a,b\n1,"two\nlines"\n')
    assert not text.has_broken_lines(spark, str(tmp_path / "plain.csv"))
    assert text.has_broken_lines(spark, str(tmp_path / "broken.csv"))
    assert text.has_broken_lines(spark, str(tmp_path)) and not text.has_broken_lines(spark, str(tmp_path), "p*.csv")
    rows = files.read_text_cells(spark, [str(tmp_path / "plain.csv"), str(tmp_path / "broken.csv")]).collect()
    assert sorted((r["a"], r["b"] or "") for r in rows) == [("1", 'say "x"'), ("1", "two\nlines"), ("2", "")]
    df = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"))
    df.coalesce(1).write.options(**text.WRITE).csv(str(tmp_path / "big"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        assert files.read_extracts(spark, str(tmp_path / "big"), df.schema, "csv").rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_raw_snapshot_keeps_documents(spark, documents, tmp_path):
    landing = str(tmp_path / "landing")
    sheets.snapshot_raw(spark, documents, landing)
    kept = {r["file"]: json.loads(r["document"]) for r in spark.read.parquet(landing).collect()}
    assert len(kept) == 3 and kept["two.json"]["rows"][0]["id"] == 5


def test_unit_separated_text(spark, tmp_path):
    path = tmp_path / "a.txt"
    path.write_text('AC\x1fn\x1fNotes\nA\x1f1\x1f\nB\x1f2\x1f""\nC\x1f\x1f"line\nbreak ""q"""\n')
    rows = files.read_us_csv(spark, str(path)).orderBy("AC").collect()
    assert [tuple(r) for r in rows] == [("A", 1, None), ("B", 2, ""), ("C", None, 'line\nbreak "q"')]


def test_text_round_trip_keeps_every_cell(spark, tmp_path):
    cells = ["", " ", None, "a,b", 'q"q', "x\ny", "back\\", "\\", "é", "NULL", "\t"]
    df = spark.createDataFrame(list(enumerate(cells)), "i int, v string")
    df.coalesce(1).write.options(**text.WRITE).csv(str(tmp_path / "c"))
    back = spark.read.schema(df.schema).options(**text.read_options(True)).csv(str(tmp_path / "c"))
    assert [r["v"] for r in back.orderBy("i").collect()] == cells


def test_folder_union_counts_and_guards(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "i int, x string").coalesce(1).write.parquet(str(tmp_path / "in/1"))
    spark.createDataFrame([(2, "b")], "i int, y string").coalesce(1).write.parquet(str(tmp_path / "in/2"))
    spark.createDataFrame([], "i int").coalesce(1).write.parquet(str(tmp_path / "in/3"))
    paths = [str(tmp_path / f"in/{i}") for i in (1, 2, 3)]
    df = files.read_extracts(spark, paths, source=True)
    assert [(r["i"], r["x"], r["y"]) for r in df.orderBy("i").collect()] == [(1, "a", None), (2, None, "b")]
    assert sorted(r["n"] for r in files.input_counts(spark, paths).collect()) == [0, 1, 1]
    found = ledger.list_files(spark, paths)
    ledger.require_files(found)
    ledger.require_files(found, exactly=3)
    with pytest.raises(ValueError, match="exactly 1"):
        ledger.require_files(found, exactly=1)
    with pytest.raises(ValueError, match="no input files"):
        ledger.require_files(ledger.list_files(spark, str(tmp_path / "nowhere*")))


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_ledger_counts_rows_of_every_file(spark, tmp_path, format):
    for n, rows in {"a": 3, "b b": 2, "c": 0}.items():
        df = spark.range(rows).select(F.col("id").cast("string").alias("i"), F.lit("x\ny").alias("v"))
        writer = df.coalesce(1).write
        (writer.options(**text.WRITE) if format == "csv" else writer).format(format).save(str(tmp_path / "in" / n))
    book = ledger.file_ledger(spark, str(tmp_path / "in"), format)
    counts = {r["file"].split("/")[-2]: r["n_rows"] for r in book.collect()}
    assert counts["a"] == 3 and counts["b%20b"] == 2 and counts.get("c", 0) == 0
    assert book.where("n_bytes IS NULL").isEmpty()
    assert ledger.file_ledger(spark, str(tmp_path / "none*"), format).isEmpty()


def test_summary_commands_need_their_input(spark, tmp_path):
    rows = spark.createDataFrame([("F", "A", "C", "X", None, "Issue")], "FLEET string, AC string, CATEGORY string, PROPOSED_ACTION string, FEEDBACK string, Status string")
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    rows.union(rows).repartition(2).write.parquet(str(tmp_path / "two"))
    for job in ("fleet_summaries", "category_summaries", "engine_summaries"):
        run(spark, [job, "--sheets", str(tmp_path / "one"), "--single-input", "--out", str(tmp_path / f"out_{job}")])
        with pytest.raises(ValueError, match="exactly 1"):
            run(spark, [job, "--sheets", str(tmp_path / "two"), "--single-input", "--out", str(tmp_path / "no")])
        with pytest.raises(ValueError, match="no input files"):
            run(spark, [job, "--sheets", str(tmp_path / "none*"), "--out", str(tmp_path / "no")])


def test_last_worksheet_per_workbook(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "w")], "workbook string, worksheet int, v string")
    assert sorted(r["v"] for r in files.last_worksheet(df).collect()) == ["w", "y", "z"]


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame(
        [("a", "1", "9", None, "old", ["ac"]), ("b", "", None, None, "old", ["ac", "engine"]), ("c", None, "7", None, "old", None)],
        REGISTRY,
    )


def test_registry_round_trip_and_tags(spark, entries, tmp_path):
    entries.write.json(str(tmp_path / "r"))
    back = registry.read_registry(spark, str(tmp_path / "r"))
    assert sorted(back.collect()) == sorted(entries.collect())
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], "sheet string, _id long")
    assert [r["_id"] for r in registry.select_by_tag(rows, back, "engine").collect()] == [2]


ROWS = "sheet string, _id long, v string"


def published(spark, root):
    return sorted((r["sheet_id"], r["sheet"], r["_id"], r["v"]) for r in publish.read_published(spark, root, T._parse_datatype_string(ROWS)).collect())


def test_publish_creates_then_replaces_only_what_it_gets(spark, entries, tmp_path):
    root = str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 3, "x"), ("unknown", 4, "x")], ROWS)
    kept = publish.publish(first, entries, root, "2025-02-18")
    assert [r["_id"] for r in publish.unregistered_rows(first, entries).collect()] == [4]
    ids = {r["sheet"]: r["id"] for r in kept.collect()}
    dates = {r["sheet"]: r["date"] for r in kept.collect()}
    assert ids["a"] == "1" and ids["b"] and ids["b"] != ids["c"]
    assert dates == {"a": "2025-02-18", "b": "2025-02-18", "c": "old"}
    again = publish.publish(spark.createDataFrame([("a", 5, "y")], ROWS), kept, root, "2025-02-19")
    assert published(spark, root) == sorted([("1", "a", 5, "y"), (ids["b"], "b", 3, "x")])
    assert {r["sheet"]: r["id"] for r in again.collect()} == ids


def test_publish_that_fails_changes_nothing(spark, entries, tmp_path):
    root = str(tmp_path / "out")
    publish.publish(spark.createDataFrame([("a", 1, "x")], ROWS), entries, root)
    dates = publish.publish(spark.createDataFrame([("a", 1, "x")], ROWS), entries, root).where("sheet = 'a'")
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00", dates.first()["date"])
    broken = spark.createDataFrame([("a", 2, "y")], ROWS).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        publish.publish(broken, entries, root)
    assert published(spark, root) == [("1", "a", 1, "x")]


def test_publish_to_target_takes_over_its_id(spark, entries, tmp_path):
    root = str(tmp_path / "out")
    publish.publish(
        spark.createDataFrame([("old", 1, "x")], ROWS),
        spark.createDataFrame([("old", "9", None, None, None, None)], REGISTRY),
        root,
    )
    kept = publish.publish_to_target(spark.createDataFrame([("a", 2, "y"), ("b", 3, "y")], ROWS), entries, root)
    assert published(spark, root) == [("9", "a", 2, "y")]
    assert {r["sheet"]: r["id"] for r in kept.collect()}["a"] == "9"


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_split_keeps_null_aircraft(spark, tmp_path, format):
    df = spark.createDataFrame([("f", "1", "007"), ("f", None, "b"), ("g", "1", ""), ("g", "", "c")], "base string, AC string, v string")
    publish.split_by_ac(df, str(tmp_path / "s"), format=format)
    back = publish.read_export(spark, str(tmp_path / "s"), df.schema, format)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    names = {p.name for p in (tmp_path / "s" / "by_base=f").iterdir() if p.is_dir()}
    assert names == {"by_AC=1", "by_AC=__HIVE_DEFAULT_PARTITION__"}


def test_split_job_takes_the_last_worksheet(spark, tmp_path):
    df = spark.createDataFrame([("f", 1, "A", "x"), ("f", 2, "A", "y")], "base string, ws int, AC string, v string")
    extracts.split_job(df, str(tmp_path / "s"), worksheet="ws")
    assert [r["v"] for r in spark.read.parquet(str(tmp_path / "s")).collect()] == ["y"]


def test_folder_counts(spark, tmp_path):
    one = spark.range(3)
    one.write.parquet(str(tmp_path / "A319/Category/x"))
    one.write.parquet(str(tmp_path / "A319/Category/y"))
    one.write.parquet(str(tmp_path / "A319/AC/z"))
    one.write.parquet(str(tmp_path / "A320/AC/z"))
    one.limit(0).coalesce(1).write.parquet(str(tmp_path / "A 321/AC/z"))  # nothing but an empty file
    rows = sorted(map(tuple, publish.folder_counts(spark, str(tmp_path)).collect()))
    assert rows == [("A 321", 0, 0), ("A319", 6, 3), ("A320", 0, 3)]


CURRENT = "sheet string, _id long, AC string, FLEET string, PN string, MAIN_PN string, VENDOR string, PROPOSED_ACTION string, Status string"


@pytest.fixture(scope="module")
def tracker(spark):
    return spark.createDataFrame(
        [("a", i, "A", "F", f"p{i}", "m", "v", "X", "Issue") for i in range(1, 4)]
        + [("a", 9, "A", "F", "p1", "m", "v", "X", "Issue"), ("c", 1, "A", "F", "p1", "m", "v", "X", "Issue")],
        CURRENT,
    )


def test_dedupe_then_feedback_by_tag(spark, tracker, entries):
    deduped = jobs.dedupe(tracker, entries)
    assert [(r["sheet"], r["_id"]) for r in deduped.changes.collect()] == [("a", 9)]
    assert [tuple(r) for r in deduped.counts.collect()] == [("a", 1)]
    assert {r["sheet"] for r in deduped.sheets.collect()} == {"a"}
    refresh = spark.createDataFrame(
        [("a", 100, "A", "F", "p1", "m", "v", "NO_ACTION"), ("a", 100, "A", "F", "p2", "m", "v", "X"),
         ("a", 100, "A", "F", "p7", "m", "v", "X"), ("c", 100, "A", "F", "p1", "m", "v", "X")],
        "sheet string, _x int, AC string, FLEET string, PN string, MAIN_PN string, VENDOR string, PROPOSED_ACTION string",
    )
    outcome = jobs.feedback(deduped.sheets, refresh, entries)
    assert {r["_id"]: r["Status"] for r in outcome.sheets.collect()} == {1: "Complete", 2: "Issue", 3: "Error", 4: None}
    again = jobs.feedback(outcome.sheets, refresh, entries)
    assert [tuple(r) for r in again.counts.collect()] == [("a", 1, 0)]
    assert outcome.sheets.columns == tracker.columns
    assert [tuple(r) for r in outcome.counts.collect()] == [("a", 2, 1)]
    assert sorted(r["op"] for r in outcome.changes.collect()) == ["COMPLETE", "ERROR", "INSERT"]


def test_summary_refresh_job(spark):
    current = spark.createDataFrame([("s", 1, "A", 1), ("s", 2, "B", 2)], "sheet string, _id long, AC string, n int")
    new = spark.createDataFrame([("s", "A", "7"), ("s", "C", "8")], "sheet string, AC string, n string")
    outcome = jobs.refresh_summaries(current, new)
    assert sorted(map(tuple, outcome.sheets.collect()), key=repr) == [("s", 1, "A", 7), ("s", 2, None, None)]
    assert outcome.sheets.schema["n"].dataType == T.IntegerType()
    assert {r["op"]: r["n"] for r in outcome.counts.collect()} == {"UPDATE": 1, "BLANK": 1, "UNMATCHED_NEW": 1}


def test_update_job_conforms(spark, tracker):
    clean, rejects = jobs.update_sheets(tracker.withColumn("Status", F.when(F.col("_id") < 3, "Issue").otherwise("?")))
    # No row is lost: those with an unfit cell are flagged.
    assert clean.count() == 5 and clean.where("_rejected").count() == 2 and rejects.count() == 2


def test_sorted_export_is_in_order_over_files(spark, tmp_path):
    """One folder has most rows, and a third of all rows are equal in the order."""
    key = F.when(F.col("id") % 3 == 0, F.lit("m")).otherwise(F.when(F.col("id") % 50 != 1, F.sha2(F.col("id").cast("string"), 256)))
    df = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 10 == 1, None).otherwise("a").alias("g"), key.alias("k"), "id")
    publish.export_by(df, ["g"], str(tmp_path / "o"), sort=["k"], partitions=6)
    rows = publish.in_order(spark, str(tmp_path / "o"), df.schema, ["g"]).collect()
    assert sorted((r["g"] or "", r["id"]) for r in rows) == sorted((r["g"] or "", r["id"]) for r in df.collect())
    files = spark.read.schema(df.schema).parquet(str(tmp_path / "o")).select("g", "k", "_metadata.file_name").distinct().collect()
    assert len({r["file_name"] for r in files if r["g"] == "a"}) > 2
    assert len({r["file_name"] for r in files if r["k"] == "m"}) > 1
    for g in ("a", "b", None):
        own = sorted((r["place"], r["k"]) for r in rows if r["g"] == g and r["k"] is not None)
        nulls = [r["place"] for r in rows if r["g"] == g and r["k"] is None]
        assert sorted([p for p, _ in own] + nulls) == list(range(1, len(own) + len(nulls) + 1))
        assert [k for _, k in own] == sorted(k for _, k in own)
        assert not nulls or min(nulls) > len(own)


def test_a_sheet_in_parts_lands_whole_and_in_order(spark, tmp_path):
    rows = spark.range(25).selectExpr(
        "if(id < 23, 'A', 'B') AS sheet", "100 - id AS _id", "if(id % 5 = 0, NULL, concat('v', id)) AS v"
    )
    write_documents(rows, str(tmp_path / "docs"), part_rows=4, compression="gzip")
    documents = spark.read.schema(SHEET_JSON).json(str(tmp_path / "docs"), multiLine=True)
    assert documents.agg(F.max(F.size("rows"))).first()[0] <= 4 and documents.count() >= 7
    sheets.land_documents(spark, str(tmp_path / "docs"), str(tmp_path / "lines"), named_by="folder")
    columns = [tuple(r) for r in sheets.landed_columns(spark, str(tmp_path / "lines")).orderBy("sheet").collect()]
    assert columns == [("A", 1, "v", 0), ("B", 1, "v", 0)]
    landed = sheets.read_landed(spark, str(tmp_path / "lines"))
    order = Window.partitionBy("sheet").orderBy("_id")
    want = rows.select("sheet", "_id", (F.row_number().over(order) - 1).cast("long").alias("_row"), "v")
    assert sorted(map(tuple, landed.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    with pytest.raises(Exception, match="comes in parts"):
        sheets.read_sheets(spark, str(tmp_path / "docs"), ["v"], named_by="folder").collect()
