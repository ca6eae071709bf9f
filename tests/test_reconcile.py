import pytest
from pyspark.sql import functions as F

from trackledger.catalog.fixtures import view
from trackledger.model import AIRFRAME_KEY, CLOSABLE, PICKLIST
from trackledger.operators.changes import apply_delete
from trackledger.operators.dedupe import duplicate_ids, duplicate_rows, first_ids, keep_first
from trackledger.operators.reconcile import key_violations, reconcile, reconcile_once, require_no_repeats, require_unique
from trackledger.plans import sheets

SF = "/root/testdata/sf0.001"
KEYS = ["AC", "PN"]
CURRENT = "sheet string, _id long, AC string, PN string, PROPOSED_ACTION string, Status string, Notes string"
REFRESH = "sheet string, AC string, PN string, PROPOSED_ACTION string, Status string"


def ops(df):
    return {(r["sheet"], r["AC"], r["PN"], r["_id"]): (r["op"], r["Status"]) for r in df.collect()}


def expected_op(status, action):
    if status == "Updated" and action is not None and action != "NO_ACTION":
        return "REOPEN", "Re-Opened"
    if status in CLOSABLE and action == "NO_ACTION":
        return "COMPLETE", "Complete"
    if action is None:
        return "ERROR", "Error"
    return "KEEP", status


@pytest.mark.parametrize("gone", [True, False])
def test_every_status_and_action(spark, gone):
    statuses = [*PICKLIST, "Error", None]
    actions = ["ADD_EFFECTIVITY", "NO_ACTION", None]
    cases = [(s, a) for s in statuses for a in actions]
    current = [("s", i, "A", f"p{i}", "ADD_EFFECTIVITY", s, "n") for i, (s, _) in enumerate(cases)]
    refresh = [] if gone else [("s", "A", f"p{i}", a, "x") for i, (_, a) in enumerate(cases)]
    result = reconcile(
        spark.createDataFrame(current, CURRENT), spark.createDataFrame(refresh, REFRESH), KEYS
    )
    want = {
        ("s", "A", f"p{i}", i): expected_op(s, None if gone else a) for i, (s, a) in enumerate(cases)
    }
    assert ops(result) == want


def test_inserts_need_an_action_and_bring_the_refresh_columns(spark):
    current = spark.createDataFrame([("s", 1, "A", "p", "X", "Issue", "n")], CURRENT)
    refresh = spark.createDataFrame(
        [
            ("s", "A", "p", "X", None),
            ("s", "A", "q", "X", "Assigned"),
            ("s", "A", "r", "NO_ACTION", None),
            ("s", "A", "t", None, None),
            ("other", "A", "p", "X", None),
        ],
        REFRESH,
    )
    result = reconcile(current, refresh, KEYS)
    assert result.columns == [*current.columns, "_old_status", "_new_action", "op"]
    assert ops(result) == {
        ("s", "A", "p", 1): ("KEEP", "Issue"),
        ("s", "A", "q", None): ("INSERT", "Assigned"),
        ("other", "A", "p", None): ("INSERT", None),
    }
    new = result.where("op = 'INSERT' AND sheet = 's'").first()
    assert new["PROPOSED_ACTION"] == "X" and new["Notes"] is None


def test_action_in_the_sheet_is_not_overwritten(spark):
    current = spark.createDataFrame([("s", 1, "A", "p", "OLD", "Updated", "n")], CURRENT)
    refresh = spark.createDataFrame([("s", "A", "p", "NEW", None)], REFRESH)
    row = reconcile(current, refresh, KEYS).first()
    assert (row["PROPOSED_ACTION"], row["_new_action"], row["_old_status"]) == ("OLD", "NEW", "Updated")


@pytest.mark.parametrize("spread", [True, False])
def test_null_keys_match_only_when_null_safe(spark, spread):
    current = spark.createDataFrame([("s", 1, None, "p", "X", "Updated", None)], CURRENT)
    refresh = spark.createDataFrame([("s", None, "p", "X", None)], REFRESH)
    plain = reconcile(current, refresh, KEYS, spread_nulls=spread)
    assert ops(plain) == {
        ("s", None, "p", 1): ("ERROR", "Error"),
        ("s", None, "p", None): ("INSERT", None),
    }
    safe = reconcile(current, refresh, KEYS, null_safe=True)
    assert ops(safe) == {("s", None, "p", 1): ("REOPEN", "Re-Opened")}


def test_many_null_keys_are_all_kept(spark):
    """A third of both sides has only nulls for a key."""
    key = F.when(F.col("id") % 3 != 0, F.col("id").cast("string"))
    n = 3000
    current = spark.range(0, n, 1, 7).select(
        F.lit("s").alias("sheet"), F.col("id").alias("_id"), key.alias("AC"), key.alias("PN"),
        F.lit("X").alias("PROPOSED_ACTION"), F.lit("Updated").alias("Status"),
    )
    refresh = current.drop("_id", "Status")
    counts = {r["op"]: r["count"] for r in reconcile(current, refresh, KEYS).groupBy("op").count().collect()}
    assert counts == {"REOPEN": 2000, "ERROR": 1000, "INSERT": 1000}


def test_duplicate_keys_are_refused(spark):
    current = spark.createDataFrame(
        [("s", 1, "A", "p", "X", "Issue", ""), ("s", 2, "A", "p", "X", "Issue", "")], CURRENT
    )
    refresh = spark.createDataFrame([("s", "A", "p", "X", None)], REFRESH)
    with pytest.raises(ValueError, match="current is not one row per key"):
        reconcile(current, refresh, KEYS)
    with pytest.raises(ValueError, match="refresh is not one row per key"):
        reconcile(current.limit(1), refresh.union(refresh), KEYS)
    require_unique(current.withColumn("sheet", F.col("_id").cast("string")), KEYS)


def test_equal_hashes_of_different_keys_are_no_violation(spark):
    df = spark.createDataFrame([("s", 1, "A", "p", "X", "", ""), ("s", 2, "A", "q", "X", "", "")], CURRENT)
    same_hash = df.withColumn("_key_hash", F.lit(7).cast("long"))
    require_unique(same_hash, KEYS)
    refresh = same_hash.drop("_id", "Notes").withColumn("Status", F.lit(None).cast("string"))
    assert {r["op"] for r in reconcile(same_hash, refresh, KEYS).collect()} == {"KEEP"}
    assert keep_first(same_hash, KEYS).count() == 2


def test_null_keys_are_violations_only_when_null_safe(spark):
    df = spark.createDataFrame([("s", 1, None, "p", "X", "", ""), ("s", 2, None, "p", "X", "", "")], CURRENT)
    assert key_violations(df, KEYS).isEmpty()
    assert key_violations(df, KEYS, null_safe=True).first()["n"] == 2


def test_reconcile_again_changes_nothing_more(spark):
    current = spark.createDataFrame(
        [("s", 1, "A", "p", "X", "Updated", ""), ("s", 2, "A", "q", "X", "Issue", ""),
         ("s", 3, "A", "r", "X", "Issue", "")],
        CURRENT,
    )
    refresh = spark.createDataFrame([("s", "A", "p", "X", None), ("s", "A", "q", "NO_ACTION", None)], REFRESH)
    once = reconcile(current, refresh, KEYS).select(*current.columns)
    twice = reconcile(once, refresh, KEYS).select(*current.columns)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dedupe_after_join_plan_has_one_shuffle_per_side(spark):
    """The join uses the rows as keep_first leaves them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        current = spark.range(100).selectExpr(
            "'s' sheet", "id _id", "cast(id AS string) AC", "cast(id AS string) PN",
            "'X' PROPOSED_ACTION", "'Issue' Status",
        )
        joined = reconcile(
            keep_first(current, KEYS, keep_hash=True),
            keep_first(current.drop("Status"), KEYS, keep_hash=True).drop("_id"),
            KEYS,
            validate=False,
            spread_nulls=False,
        )
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2
    assert "WindowGroupLimit" in plan and "Partial" in plan


DUPES = "sheet string, _id long, _row long, AC string, PN string"


def test_first_is_by_order_and_nulls_are_equal(spark):
    df = spark.createDataFrame(
        [("s", 1, 9, "A", None), ("s", 2, 3, "A", None), ("s", 3, 1, "A", "p"), ("t", 4, 2, "A", "p"),
         ("s", 5, 0, None, None), ("s", 6, 8, None, None)],
        DUPES,
    )
    assert sorted(r["_id"] for r in keep_first(df, KEYS, "_row").collect()) == [2, 3, 4, 5]
    assert sorted(r["_id"] for r in first_ids(df, KEYS, "_row").collect()) == [2, 3, 4, 5]
    assert sorted(r["_id"] for r in duplicate_ids(df, KEYS, "_row").collect()) == [1, 6]
    assert sorted(r["_id"] for r in keep_first(df, KEYS).collect()) == [1, 3, 4, 5]
    assert keep_first(df, KEYS).columns == df.columns


def test_dedupe_is_idempotent_with_a_hot_key(spark):
    df = spark.range(0, 6000, 1, 6).select(
        F.lit("s").alias("sheet"), F.col("id").alias("_id"), F.col("id").alias("_row"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("AC"),
        F.lit("p").alias("PN"),
    )
    kept = keep_first(df, KEYS)
    assert kept.count() == 51 and duplicate_ids(df, KEYS).count() == 6000 - 51
    assert duplicate_ids(kept, KEYS).isEmpty()


def _rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("null_safe", [False, True])
def test_one_pass_gives_what_reconcile_gives(spark, null_safe):
    current, refresh = (view(spark, SF, n).transform(lambda d, o=o: keep_first(d, AIRFRAME_KEY, o)) for n, o in (("tracker", "_id"), ("refresh", "src_id")))
    plain = reconcile(current, refresh, AIRFRAME_KEY, null_safe)
    once = reconcile_once(current, refresh, AIRFRAME_KEY, null_safe)
    require_no_repeats(once, AIRFRAME_KEY)
    once = once.drop("_repeats")
    assert _rows_of(once) == _rows_of(plain) and once.columns == plain.columns


def test_one_pass_shuffles_each_side_once(spark, tmp_path):
    for n in ("tracker", "refresh"):
        view(spark, SF, n).write.parquet(str(tmp_path / n))
    current, refresh = (spark.read.parquet(str(tmp_path / n)) for n in ("tracker", "refresh"))
    once = reconcile_once(current, refresh, AIRFRAME_KEY)
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange ") == 2


@pytest.mark.parametrize("side", ["current", "refresh"])
def test_one_pass_finds_repeated_keys_and_does_not_multiply_them(spark, side):
    columns = "sheet string, _id long, AC string, FLEET string, PN string, MAIN_PN string, VENDOR string, PROPOSED_ACTION string, Status string"
    one = [("s", 1, "A", "F", "p", "m", "v", "X", "Issue"), ("s", 2, "A", "F", None, "m", "v", "X", "Issue"), ("s", 3, "A", "F", None, "m", "v", "X", "Issue")]
    hot = [("s", k, "A", "F", "p", "m", "v", "X", "Issue") for k in range(3000)]
    current = spark.createDataFrame(hot if side == "current" else one, columns).repartition(4)
    refresh = spark.createDataFrame(hot if side == "refresh" else one, columns).drop("_id", "Status").repartition(4)
    rows = reconcile_once(current, refresh, AIRFRAME_KEY)
    assert rows.count() <= 7
    with pytest.raises(ValueError, match=rf"{side} is not one row per key .*'PN': 'p'"):
        require_no_repeats(rows, AIRFRAME_KEY)
    with pytest.raises(ValueError, match=f"{side} is not one row per key"):
        sheets.feedback(current, refresh)


def test_one_pass_over_empty_sides(spark):
    current, refresh = (view(spark, SF, n).transform(lambda d, o=o: keep_first(d, AIRFRAME_KEY, o)) for n, o in (("tracker", "_id"), ("refresh", "src_id")))
    for a, b in ((current.limit(0), refresh), (current, refresh.limit(0)), (current.limit(0), refresh.limit(0))):
        rows = reconcile_once(a, b, AIRFRAME_KEY)
        require_no_repeats(rows, AIRFRAME_KEY)
        assert rows.count() == reconcile(a, b, AIRFRAME_KEY).count()
        outcome = sheets.feedback(a, b)
        assert outcome.sheets.count() == a.count() + outcome.changes.where("op = 'INSERT'").count()


def test_repeated_keys_without_action_are_found_too(spark):
    current = spark.createDataFrame([("s", 1, "A", "p", "X", "Issue", "n")], CURRENT)
    refresh = spark.createDataFrame([("s", "A", "q", "NO_ACTION", None)] * 2, REFRESH)
    with pytest.raises(ValueError, match="refresh is not one row per key"):
        require_no_repeats(reconcile_once(current, refresh, KEYS), KEYS)


def test_feedback_keeps_changed_rows_only(spark):
    current = view(spark, SF, "tracker").transform(lambda d: keep_first(d, AIRFRAME_KEY)).withColumn("sheet", F.when(F.col("FLEET") == "F1", "quiet").otherwise(F.col("sheet")))
    refresh = current.drop("Status").withColumn("PROPOSED_ACTION", F.when(F.col("sheet") == "quiet", "X").otherwise(F.col("PROPOSED_ACTION")))
    current = current.withColumn("Status", F.when(F.col("sheet") == "quiet", "Issue").otherwise(F.col("Status")))
    outcome = sheets.feedback(current, refresh, null_safe=True)
    changed = outcome.changes.count()
    assert 0 < changed < current.count()
    counts = {r["sheet"]: (r["updated"], r["inserted"]) for r in outcome.counts.collect()}
    assert counts["quiet"] == (0, 0) and sum(u for u, _ in counts.values()) == changed
    before = {(r["sheet"], r["_id"]): r["Status"] for r in current.collect()}
    after = {(r["sheet"], r["_id"]): r["Status"] for r in outcome.sheets.collect()}
    assert set(before) == set(after) and sum(before[k] != after[k] for k in before) == changed


def _brute_dedupe(rows):
    """First row of each (sheet, key) by id; of equal ids the first in the list."""
    seen, kept, gone = set(), [], []
    for row in sorted(rows, key=lambda r: r[1]):
        key = (row[0], row[2], row[3])
        (gone if key in seen else kept).append(row)
        seen.add(key)
    return kept, gone


def test_rows_that_share_an_id_are_deduplicated_by_row(spark):
    rows = [
        ("s", 5, "A", "p", "x"), ("s", 5, "A", "p", "x"),  # equal rows
        ("s", 6, "A", "q", "x"), ("s", 6, "A", "p", "x"),  # one first, one not
        ("s", 7, "A", "q", "x"), ("s", 7, "A", "q", "y"),  # both not first
        ("s", 8, None, "z", "x"), ("s", 8, None, "z", "x"), ("s", 8, None, "w", "x"),
        ("t", 5, "A", "p", "x"),
    ]
    frame = spark.createDataFrame(rows, "sheet string, _id long, AC string, PN string, v string").repartition(3)
    kept, gone = _brute_dedupe(rows)
    assert _rows_of(duplicate_ids(frame, KEYS)) == sorted(((r[0], r[1]) for r in gone), key=repr)
    outcome = sheets.dedupe(frame, keys=KEYS)
    assert _rows_of(outcome.changes) == sorted(((r[0], r[1]) for r in gone), key=repr)
    got = _rows_of(outcome.sheets.select("sheet", "_id", "AC", "PN"))
    assert got == sorted((r[:4] for r in kept), key=repr)
    left = apply_delete(frame, duplicate_rows(frame, KEYS))
    assert left.count() == len(kept) and left.columns == frame.columns
