import datetime as dt

import pytest
from pyspark.sql import functions as F

from trackledger.functions import rules
from trackledger.functions.conform import Date, Picklist, conform


def values(df, column):
    return [r[column] for r in df.collect()]


def test_feedback_needs_content_but_a_space_is_enough(spark):
    df = spark.createDataFrame(
        [(1, "note", "Initial"), (2, "", "Initial"), (3, None, "Issue"), (4, " ", None)],
        "i int, FEEDBACK string, Status string",
    )
    assert values(rules.apply_feedback(df).orderBy("i"), "Status") == [
        "Validated", "Initial", "Issue", "Validated",
    ]


def test_null_status_is_open(spark):
    df = spark.createDataFrame([("Validated",), ("Complete",), (None,), ("Error",)], "Status string")
    assert values(rules.open_rows(df), "Status") == [None, "Error"]


def test_null_action_is_not_an_action(spark):
    df = spark.createDataFrame([("NO_ACTION",), (None,), ("X",)], "PROPOSED_ACTION string")
    assert values(rules.action_rows(df), "PROPOSED_ACTION") == ["X"]


def test_fold_can_be_left_out(spark):
    df = spark.createDataFrame([("KIT",), ("ROTABLE",), (None,)], "CATEGORY string")
    assert values(rules.fold_category(df), "CATEGORY") == ["OTHER", "ROTABLE", None]
    assert values(rules.fold_category(df, fold=False), "CATEGORY") == ["KIT", "ROTABLE", None]


def test_fill_status_leaves_empty_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("Issue",)], "Status string")
    assert values(rules.fill_status(df), "Status") == ["Initial", "", "Issue"]


def test_seed_drops_first_column_and_puts_new_ones_after_the_second(spark):
    df = spark.createDataFrame([(1, "A", "x", "note")], "n int, AC string, PN string, FEEDBACK string")
    seeded = rules.seed_columns(df, dt.date(2025, 2, 18))
    assert seeded.columns == [
        "AC", "Status", "Assignment", "Notes", "Created Date", "Modified Date", "PN", "FEEDBACK",
    ]
    row = seeded.first()
    assert row["Status"] == "Validated" and row["Created Date"] == dt.date(2025, 2, 18)
    assert row["Assignment"] == "" and row["Notes"] == ""


def test_run_date_defaults_to_today(spark):
    df = spark.range(1)
    today = df.select(F.current_date().alias("d")).first()["d"]
    assert rules.stamp_dates(df).first()["Created Date"] == today


def test_missing_columns_are_all_named(spark):
    with pytest.raises(KeyError, match="required columns not found: PN, AC"):
        rules.require_columns(spark.range(1), ["id", "PN", "AC"])


def test_user_columns_leave_out_system_columns(spark):
    df = spark.createDataFrame([("s", 1, "a")], "sheet string, _id long, AC string")
    assert rules.select_user_columns(df).columns == ["sheet", "AC"]
    assert rules.user_schema(df).names == ["AC"]


def test_imposed_schema_is_strict_unless_told_otherwise(spark):
    df = spark.createDataFrame([("1", "x"), ("b", "y")], "n string, other string")
    schema = spark.createDataFrame([], "n int").schema
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rules.impose_schema(df, schema).collect()
    assert values(rules.impose_schema(df, schema, strict=False), "n") == [1, None]


def test_titles_with_dots_and_ticks(spark):
    df = spark.createDataFrame([(None, 1)], "`a.b` string, `c``d` int")
    assert rules.fill_status(df, status="a.b").first()["a.b"] == "Initial"
    assert rules.select_user_columns(df).columns == ["a.b", "c`d"]


def test_conform_splits_rows_and_names_bad_cells(spark):
    df = spark.createDataFrame(
        [
            ("s", 1, "Initial", "2025-02-18", 5),
            ("s", 2, "Error", "2025-02-18", 6),
            ("s", 3, None, "18/02/25", 7),
            ("s", 4, "Nope", "2025-02-30", 8),
            ("s", 5, None, None, None),
        ],
        "sheet string, _id long, Status string, `Created Date` string, n int",
    )
    clean, rejects = conform(df)
    assert [(r["_id"], r["Created Date"], r["n"]) for r in clean.orderBy("_id").collect()] == [
        (1, dt.date(2025, 2, 18), "5"),
        (5, None, None),
    ]
    assert sorted((r["_id"], r["column"], r["value"], r["reason"]) for r in rejects.collect()) == [
        (2, "Status", "Error", "not in picklist"),
        (3, "Created Date", "18/02/25", "not a date"),
        (4, "Created Date", "2025-02-30", "not a date"),
        (4, "Status", "Nope", "not in picklist"),
    ]


def test_conform_takes_other_rules(spark):
    df = spark.createDataFrame([("02/18/25", "a"), ("13/40/25", "z")], "d string, p string")
    clean, rejects = conform(df, {"d": Date("MM/dd/yy"), "p": Picklist(["a", "b"])})
    assert values(clean, "d") == [dt.date(2025, 2, 18)]
    assert sorted(values(rejects, "column")) == ["d", "p"]
    clean, rejects = conform(df, {})
    assert clean.count() == 2 and rejects.count() == 0
