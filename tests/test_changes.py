import pytest
from pyspark.sql import functions as F

from trackledger.operators import changes
from trackledger.operators.blocks import number_rows, ordered_blocks
from trackledger.operators.refresh import refresh_summary, refreshed_rows

TARGET = "sheet string, _id long, _row long, AC string, n long, Status string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [("s", 1, 0, "A", 5, "Issue"), ("s", 2, 1, "B", 6, "Issue"), ("t", 1, 0, "C", 7, None)], TARGET
    )


def by_id(df, *cols):
    return {(r["sheet"], r["_id"]): tuple(r[c] for c in cols) for r in df.collect()}


def test_update_writes_only_the_named_columns_and_null_blanks(spark, target):
    new = spark.createDataFrame([("s", 1, "Z", None), ("s", 9, "Z", "x")], "sheet string, _id long, AC string, Status string")
    assert by_id(changes.apply_update(target, new, ["Status"]), "AC", "Status") == {
        ("s", 1): ("A", None), ("s", 2): ("B", "Issue"), ("t", 1): ("C", None),
    }
    both = changes.apply_update(target, new)
    assert by_id(both, "AC", "n", "Status")["s", 1] == ("Z", 5, None)
    assert both.columns == target.columns


def test_update_takes_a_predicate(spark, target):
    new = target.withColumn("Status", F.lit("x"))
    changed = changes.apply_update(target, new, ["Status"], rows=F.col("n") > 5)
    assert by_id(changed, "Status") == {("s", 1): ("Issue",), ("s", 2): ("x",), ("t", 1): ("x",)}


def test_delete_is_by_sheet_and_id(spark, target):
    ids = spark.createDataFrame([("s", 1), ("x", 2)], "sheet string, _id long")
    assert set(by_id(changes.apply_delete(target, ids))) == {("s", 2), ("t", 1)}
    assert set(by_id(changes.apply_delete(target, ids, rows=F.col("sheet") == "x"))) == set(by_id(target))


def test_insert_goes_to_the_top_with_new_ids(spark, target):
    new = spark.createDataFrame([("s", "Y", 1, "q"), ("s", "X", 0, "q")], "sheet string, AC string, n long, unknown string")
    result = changes.apply_insert(target, new, ["sheet", "AC"])
    assert result.columns == target.columns
    added = result.where("AC IN ('X', 'Y')").orderBy("_row").collect()
    assert [(r["AC"], r["_id"], r["_row"], r["Status"]) for r in added] == [("X", 3, -2, None), ("Y", 4, -1, None)]
    some = changes.apply_insert(target, new, ["AC"], where=F.col("n") > 0, last_id=100)
    assert [(r["AC"], r["_id"]) for r in some.where("AC IN ('X', 'Y')").collect()] == [("Y", 101)]


def test_insert_payload_drops_falsy_cells_and_update_payload_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("s", 1, "", 0, False, 0.0, None), ("s", 2, "0", 7, True, 0.5, " ")],
        "sheet string, _id long, a string, b int, c boolean, d double, e string",
    )
    cells = {r["_id"]: dict(r["cells"]) for r in changes.update_payload(df).collect()}
    assert cells[1] == {"a": "", "b": "0", "c": "false", "d": "0.0", "e": None}
    inserted = [dict(r["cells"]) for r in changes.insert_payload(df).collect()]
    assert inserted == [{}, {"a": "0", "b": "7", "c": "true", "d": "0.5", "e": " "}]


def test_change_set_carries_status_for_updates_and_titles_for_inserts(spark):
    reconciled = spark.createDataFrame(
        [("s", 1, "A", "Complete", "COMPLETE"), ("s", None, "B", None, "INSERT"), ("s", 2, "C", "Issue", "KEEP")],
        "sheet string, _id long, AC string, Status string, op string",
    )
    rows = {r["op"]: [tuple(c) for c in r["cells"]] for r in changes.change_set(reconciled, ["AC", "Status"]).collect()}
    assert rows == {"COMPLETE": [("Status", "Complete")], "INSERT": [("AC", "B")]}
    counts = changes.command_counts(reconciled).first()
    assert (counts["updated"], counts["inserted"]) == (1, 1)


def test_rows_are_numbered_over_all_blocks(spark):
    df = spark.range(0, 1000, 1, 5).select((F.col("id") * 7 % 1000).alias("k"))
    numbered = number_rows(df, ["k"], "i", start=10)
    assert numbered.where(F.col("i") != F.col("k") + 11).isEmpty() and numbered.count() == 1000
    cut = ordered_blocks(df, ["k"], partitions=4)
    ends = cut.groupBy("_block").agg(F.min("k").alias("a"), F.max("k").alias("b"), F.count("*").alias("n")).orderBy("_block")
    last = -1
    for r in ends.collect():
        assert r["a"] == last + 1 and r["b"] - r["a"] + 1 == r["n"]
        last = r["b"]


def test_equal_rows_are_numbered_once_each(spark):
    """A third of the rows are equal in the order and share no single partition."""
    df = spark.range(0, 3000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    numbered = number_rows(df, ["k"], "i", partitions=6)
    got = [(r["i"], r["k"]) for r in numbered.orderBy("i").collect()]
    assert [i for i, _ in got] == list(range(1, 3001))
    assert [k for _, k in got] == sorted(k for _, k in got)
    tied = df.withColumn("t", F.spark_partition_id())
    homes = ordered_blocks(tied, ["k", "t"], 6).where("k = -1").select("_block").distinct()
    assert homes.count() > 1


def test_column_ids_replace_titles(spark):
    cells = "sheet string, _id long, cells array<struct<title:string,value:string>>"
    df = spark.createDataFrame(
        [("s", 1, [("A", "x"), ("gone", "y")]), ("t", 2, [("A", None)]), ("u", 3, [("A", "z")])], cells
    )
    columns = spark.createDataFrame([("s", 11, "A"), ("t", 21, "A"), ("t", 22, "B")], "sheet string, column_id long, title string")
    rows = {r["_id"]: [tuple(c) for c in r["cells"]] for r in changes.with_column_ids(df, columns).collect()}
    assert rows == {1: [(11, "x")], 2: [(21, None)], 3: []}


SUMMARY = "sheet string, _id long, AC string, n long"
NEW = "sheet string, AC string, n long"


def test_refresh_matches_by_aircraft_or_by_single_row(spark):
    current = spark.createDataFrame(
        [("m", 1, "A", 1), ("m", 2, "B", 2), ("m", 3, None, 3),
         ("one", 4, None, 4), ("renamed", 5, "X", 5), ("shrunk", 6, "A", 6), ("shrunk", 7, "B", 7)],
        SUMMARY,
    )
    new = spark.createDataFrame(
        [("m", "A", 10), ("m", "C", 30), ("m", None, 40), ("one", None, 50), ("renamed", "Y", 60), ("shrunk", "B", 70)],
        NEW,
    )
    result = refresh_summary(current, new)
    assert result.columns == ["sheet", "_id", "AC", "n", "op"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(
        [
            ("m", 1, "A", 10, "UPDATE"), ("m", 2, None, None, "BLANK"), ("m", 3, None, None, "BLANK"),
            ("m", None, "C", 30, "UNMATCHED_NEW"), ("m", None, None, 40, "UNMATCHED_NEW"),
            ("one", 4, None, 50, "UPDATE"), ("renamed", 5, "Y", 60, "UPDATE"),
            ("shrunk", 6, None, None, "BLANK"), ("shrunk", 7, "B", 70, "UPDATE"),
        ],
        key=repr,
    )
    assert {r["_id"] for r in refreshed_rows(result).collect()} == {1, 2, 3, 4, 5, 6, 7}


def test_refresh_keeps_columns_the_extract_lacks(spark):
    current = spark.createDataFrame([("s", 1, "A", 1), ("s", 2, "B", 2)], SUMMARY).withColumn("note", F.col("AC"))
    new = spark.createDataFrame([("s", "A", 9)], NEW)
    assert by_id(refresh_summary(current, new), "n", "note") == {("s", 1): (9, "A"), ("s", 2): (None, "B")}
