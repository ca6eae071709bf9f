"""The versioned table: every row is accounted for, and versions count all at once."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.model import REGISTRY
from trackledger.plans import sheets as jobs
from trackledger.sinks import publish, versions

ROWS = "sheet string, _id long, v string"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def entries(spark, *rows):
    return spark.createDataFrame([(s, i, t, src, "old", None) for s, i, t, src in rows], REGISTRY)


def table(spark, root, registry=None):
    rows = publish.read_published(spark, root, T._parse_datatype_string(ROWS), registry)
    return sorted((r["sheet_id"], r["sheet"], r["_id"]) for r in rows.collect())


def account(done):
    return {(r["sheet"], r["fate"], r["reason"]): r["n_rows"] for r in done.account.collect()}


def test_every_row_of_a_reformat_is_accounted_for(spark, root):
    registry = entries(spark, ("a", "1", "91", None), ("b", "2", None, None), ("c", "3", "93", None))
    rows = [("a", 1, "x"), ("a", 2, "x"), ("b", 3, "x"), ("c", 4, "x"), ("unknown", 5, "x"), (None, 6, "x")]
    frame = spark.createDataFrame(rows, ROWS)
    first = publish.publish_version(frame, registry, root, "2025-02-18")
    assert account(first) == {
        ("a", "published", None): 2, ("b", "published", None): 1, ("c", "published", None): 1,
        ("unknown", "left_out", "not in the registry"): 1, (None, "left_out", "not in the registry"): 1,
    }
    second = publish.publish_version(frame.where("sheet <> 'c'"), first.registry, root, "2025-02-19", to_target=True)
    assert account(second) == {
        ("a", "moved", None): 2, ("a", "cleared", None): 2, ("b", "left_out", "no target"): 1,
        ("unknown", "left_out", "not in the registry"): 1,
    }
    assert sorted(r["_id"] for r in second.left_out.collect()) == [3, 5]
    assert table(spark, root) == [("2", "b", 3), ("3", "c", 4), ("91", "a", 1), ("91", "a", 2)]
    kept = {r["sheet"]: (r["id"], r["date"]) for r in second.registry.collect()}
    assert kept == {"a": ("91", "2025-02-19"), "b": ("2", "2025-02-18"), "c": ("3", "2025-02-18")}


def test_targets_may_be_other_sheets_ids(spark, root):
    registry = entries(spark, ("a", "1", "2", None), ("b", "2", "3", None))
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", 3, "x")], ROWS)
    publish.publish(frame, registry, root)
    done = publish.publish_version(frame, registry, root, to_target=True)
    assert table(spark, root) == [("2", "a", 1), ("2", "a", 2), ("3", "b", 3)]
    assert account(done) == {
        ("a", "moved", None): 2, ("b", "moved", None): 1, ("a", "cleared", None): 2, ("b", "cleared", None): 1,
    }


def test_ids_that_would_repeat_are_refused(spark, root):
    registry = entries(spark, ("a", "1", "2", None), ("b", "2", None, None))
    frame = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], ROWS)
    publish.publish(frame, registry, root)
    with pytest.raises(ValueError, match="registry repeats id"):
        publish.publish_version(frame.where("sheet = 'a'"), registry, root, to_target=True)
    assert table(spark, root) == [("1", "a", 1), ("2", "b", 2)]


def test_jobs_empty_sheets_that_have_a_source_and_no_rows(spark, root):
    registry = entries(spark, ("a", "1", "91", "a.csv"), ("b", "2", "92", "b.csv"), ("c", "3", None, None))
    frame = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")], ROWS)
    first = jobs.set_sheets(frame, registry, root, "2025-02-18")
    second = jobs.set_sheets(frame.where("sheet = 'a'"), first.registry, root, "2025-02-19")
    assert table(spark, root) == [("1", "a", 1), ("3", "c", 3)]
    assert account(second) == {("a", "published", None): 1, ("a", "cleared", None): 1, ("b", "cleared", None): 1}
    dates = {r["sheet"]: r["date"] for r in second.registry.collect()}
    assert dates == {"a": "2025-02-19", "b": "2025-02-19", "c": "2025-02-18"}
    third = jobs.reformat_sheets(frame.limit(0), second.registry, root, "2025-02-20")
    assert table(spark, root) == [("3", "c", 3)]
    assert {r["sheet"]: r["id"] for r in third.registry.collect()} == {"a": "91", "b": "92", "c": "3"}
    held = {r["sheet_id"]: r["n_rows"] for r in versions.live(spark, root).collect()}
    assert held == {"91": 0, "92": 0, "3": 1}


def test_a_version_counts_when_it_is_finished(spark, root):
    registry = entries(spark, ("a", "1", None, None), ("b", "2", None, None))
    publish.publish(spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], ROWS), registry, root)
    before = table(spark, root)
    # All rows are written and the state, too, but the log does not name them yet.
    rows = spark.createDataFrame([("a", 7, "y", "1")], f"{ROWS}, sheet_id string")
    held, version = versions.live_and_next(spark, root)
    versions.add_rows(rows, root, version)
    assert table(spark, root) == before
    state = held.where("sheet_id <> '1'")
    state = state.unionByName(spark.createDataFrame([("1", version, 1)], versions.LIVE))
    versions.commit(state, root, version)
    assert table(spark, root) == [("1", "a", 7), ("2", "b", 2)]


def test_of_two_writers_one_is_told(spark, root):
    rows = spark.createDataFrame([("a", 1, "x", "1")], f"{ROWS}, sheet_id string")
    one, two = sorted(versions.live_and_next(spark, root)[1] for _ in range(2))
    for version in (one, two):
        versions.add_rows(rows, root, version)
    state = [spark.createDataFrame([("1", v, 1)], versions.LIVE) for v in (one, two)]
    versions.commit(state[0], root, one)
    with pytest.raises(RuntimeError, match="meanwhile"):
        versions.commit(state[1], root, two)
    assert {r["version"] for r in versions.live(spark, root).collect()} == {one}


def test_an_empty_table_and_empty_input(spark, root):
    registry = entries(spark, ("a", None, "9", None))
    assert table(spark, root) == []
    done = publish.publish_version(spark.createDataFrame([], ROWS), registry, root, "2025-02-18")
    assert table(spark, root) == [] and done.account.isEmpty() and done.left_out.isEmpty()
    assert [(r["date"], bool(r["id"])) for r in done.registry.collect()] == [("old", True)]


def test_a_sheet_of_a_third_of_all_rows_is_written_by_several_tasks(spark, root):
    registry = entries(spark, ("hot", "1", None, None), *[(f"s{k}", f"i{k}", None, None) for k in range(5)])
    sheet = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    frame = spark.range(0, 60_000, 1, 8).select(sheet.alias("sheet"), F.col("id").alias("_id"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        done = publish.publish_version(frame, registry, root)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sum(r["n_rows"] for r in done.account.collect()) == 60_000
    files = spark.read.parquet(root).where("sheet_id = '1'").select("_metadata.file_path").distinct()
    assert files.count() > 1
