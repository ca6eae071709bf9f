"""What jobs read, write and deal out as their input grows."""

import glob
import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from trackledger.catalog import files as file_queries
from trackledger.catalog import jobs as job_queries
from trackledger.catalog.files import QUERIES as FILE_QUERIES
from trackledger.catalog.fixtures import view
from trackledger.model import AIRFRAME_KEY
from trackledger.operators.dedupe import keep_first
from trackledger.operators.reconcile import reconcile_once
from trackledger.plans import sheets as plans
from trackledger.sinks import publish
from trackledger.sources import sheets

SMALL = "/root/testdata/sf0.001"


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_lines_of_small_documents_stay_where_they_are(spark, tmp_path, monkeypatch):
    """all lines were shuffled; now those of large documents are, with the same rows."""
    path = file_queries._sheet_documents(spark, SMALL)
    found = []
    for limit in (0, sheets.LARGE_DOCUMENT):
        monkeypatch.setattr(sheets, "LARGE_DOCUMENT", limit)
        sheets.land_documents(spark, path, str(tmp_path / str(limit)), named_by="folder")
        found.append(sorted(map(repr, sheets.read_landed(spark, str(tmp_path / str(limit))).collect())))
    assert found[0] == found[1] and len(found[0]) == 6000


def test_paths_are_looked_at_once_a_file(spark, tmp_path):
    """no pattern on the path reaches the scan that counts rows."""
    spark.range(3).write.parquet(str(tmp_path / "A319/Category/x"))
    counted = publish.folder_counts(spark, str(tmp_path))
    assert [tuple(r) for r in counted.collect()] == [("A319", 3, 0)]
    assert not any("A319" in f for f in counted.inputFiles())


def test_kept_documents_are_small(spark, tmp_path):
    """documents were written as plain text, and kept at a sixth to a tenth of it."""
    path = file_queries._sheet_documents(spark, SMALL)
    assert all(f.endswith(".json.gz") for f in glob.glob(f"{path}/sheet=*/part-*"))
    sheets.snapshot_raw(spark, f"{path}/*", str(tmp_path / "kept"))
    written = glob.glob(f"{tmp_path}/kept/part-*")
    assert written and all(f.endswith(".zstd.parquet") for f in written)
    assert sheets.read_snapshot(spark, str(tmp_path / "kept")).where(F.col("document").startswith('{"columns"')).count() == 1


@pytest.mark.parametrize("name", ["sheet_json_scan", "sheet_columns"])
def test_documents_are_written_compressed(spark, name):
    """F7, F8: the documents of a scan were written as plain text, seven times the tables' rows."""
    read = FILE_QUERIES[name].run(spark, SMALL).inputFiles()
    assert read and all(f.endswith(".json.gz") for f in read)


def test_inferred_text_is_written_by_more_tasks_as_it_grows(spark, monkeypatch):
    """three tasks wrote all rows, however many."""
    monkeypatch.setattr(file_queries, "_ROWS_PER_TASK", 500, raising=False)
    assert len(FILE_QUERIES["inferred_text"].run(spark, SMALL).inputFiles()) > 6


def test_export_is_cut_into_more_ranges_as_it_grows(spark, monkeypatch):
    """eight tasks sorted all rows, however many."""
    monkeypatch.setattr(file_queries, "_ROWS_PER_TASK", 100, raising=False)
    numbers = FILE_QUERIES["export_order"].run(spark, SMALL).inputFiles()
    assert len({f.split("/part-")[1][:5] for f in numbers if "/part-" in f and "ordered" in f}) > 20


def test_mixed_types_are_made_once(spark):
    """both sides were made twice, to check their keys and to join them."""
    found = job_queries.QUERIES["reconcile_mixed_types"].run(spark, SMALL)
    assert not any("lineitem" in f for f in found.inputFiles()) and found.count() > 3


def test_feedback_reads_its_sides_once(spark):
    """the sheets were made again to be changed, and both sides shuffled again to be joined."""
    current, refresh = view(spark, SMALL, "tracker"), view(spark, SMALL, "refresh")
    plain = plans.feedback(keep_first(current, AIRFRAME_KEY), keep_first(refresh, AIRFRAME_KEY, "src_id"))
    kept = [keep_first(current, AIRFRAME_KEY, keep_hash=True), keep_first(refresh, AIRFRAME_KEY, "src_id", keep_hash=True)]
    hashed = plans.feedback(*kept)
    assert not any("lineitem" in f for f in hashed.sheets.inputFiles())
    assert hashed.sheets.columns == plain.sheets.columns == current.columns
    for part in ("sheets", "changes", "counts"):
        one, two = getattr(plain, part), getattr(hashed, part)
        assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    assert _plan(reconcile_once(*kept, AIRFRAME_KEY)).count("Exchange hashpartitioning(_key_hash") == 2


def test_a_hash_of_other_types_is_made_again(spark):
    """A key that is a number in the sheet and padded digits in the extract still matches."""
    schema = "sheet string, _id long, AC int, PROPOSED_ACTION string, Status string"
    current = spark.createDataFrame([("a", 1, 7, "X", "Updated")], schema)
    refresh = spark.createDataFrame([("a", "07", "X", 1)], "sheet string, AC string, PROPOSED_ACTION string, src_id int")
    sides = keep_first(current, ["AC"], keep_hash=True), keep_first(refresh, ["AC"], "src_id", keep_hash=True)
    assert [r["Status"] for r in plans.feedback(*sides, keys=["AC"]).sheets.collect()] == ["Re-Opened"]
