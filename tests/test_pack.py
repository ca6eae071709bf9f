import random

import pytest
from pyspark.sql import functions as F

from trackledger.operators import blocks, pack
from trackledger.operators.skew import attach_by_key
from trackledger.plans import extracts
from trackledger.sinks import publish


def walk(sizes, cap):
    """Units in ascending order onto sheets, one after the other."""
    sheet, used, out = 1, 0, {}
    for unit in sorted(sizes):
        if used and used + sizes[unit] > cap:
            sheet, used = sheet + 1, 0
        out[unit] = sheet
        used += sizes[unit]
    return out


def brute(groups, cap):
    return {
        (*group, unit): sheet for group, sizes in groups.items() for unit, sheet in walk(sizes, cap).items()
    }


def counted(spark, groups):
    rows = [(*g, unit, n) for g, sizes in groups.items() for unit, n in sizes.items()]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "FLEET string, CATEGORY string, PN string, n long")


def got(units):
    return {(r["FLEET"], r["CATEGORY"], r["PN"]): r["sheet_no"] for r in units.collect()}


def random_groups(seed):
    rng = random.Random(seed)
    top = rng.choice([1, 3, 40, 130])
    groups = {
        (f"F{i}", c): {f"P{k}": rng.randint(1, top) for k in rng.sample(range(10_000), rng.randint(1, 300))}
        for i in range(2)
        for c in ("A", "B")
    }
    # One group has most of the units, and some units are larger than a sheet.
    groups["F0", "A"] = {f"P{k}": rng.choice([1, 2, 50, 99, 100, 101, 450]) for k in range(900)}
    return groups


@pytest.mark.parametrize("seed,cap,partitions", [(1, 100, None), (2, 100, 1), (3, 100, 7), (4, 1, 5), (5, 250, 16), (6, 10_000, 9)])
def test_units_go_where_a_walk_puts_them(spark, seed, cap, partitions):
    groups = random_groups(seed)
    assert got(pack.pack_units(counted(spark, groups), cap=cap, partitions=partitions)) == brute(groups, cap)


def test_blocks_without_a_sheet_change(spark):
    """A sheet spans several blocks when the units are few and small."""
    groups = {("F", "A"): {f"P{k:03d}": 1 for k in range(200)}}
    assert got(pack.pack_units(counted(spark, groups), cap=150, partitions=12)) == brute(groups, 150)


@pytest.mark.parametrize("bits", [0, 3])
def test_large_partitions_are_cut_into_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(blocks, "_POSITION_BITS", bits)
    groups = {("F", "A"): {f"P{k:03d}": 1 + k % 7 for k in range(150)}, ("F", "B"): {"P": 3}}
    cut = blocks.ordered_blocks(counted(spark, groups), ["FLEET", "CATEGORY", "PN"], partitions=2)
    assert cut.groupBy("_block").count().agg(F.max("count")).first()[0] <= 1 << bits
    assert got(pack.pack_units(counted(spark, groups), cap=60, partitions=2)) == brute(groups, 60)
    numbered = blocks.number_rows(counted(spark, groups), ["FLEET", "CATEGORY", "PN"], "i", partitions=2)
    assert [r["i"] for r in numbered.orderBy("FLEET", "CATEGORY", "PN").collect()] == list(range(1, 152))


@pytest.mark.parametrize("cap,bits", [(37, 2), (5000, 3), (9, 0)])
def test_no_task_holds_more_than_two_tables(spark, monkeypatch, cap, bits):
    """One group over very many blocks, beside groups that begin and end inside them."""
    monkeypatch.setattr(blocks, "_POSITION_BITS", bits)
    plain = pack._composed

    def checked(by, cap):
        compose = plain(by, cap)

        def run(pair):
            assert len(pair) <= 2 * (cap + 1) and pair["_node"].nunique() <= 2
            return compose(pair)

        return run

    monkeypatch.setattr(pack, "_composed", checked)
    rng = random.Random(bits)
    groups = {("F", "B"): {f"P{k:04d}": rng.choice([1, 2, 3, 11, 40]) for k in range(400 if bits else 90)}}
    groups |= {("F", c): {f"P{k}": k + 1 for k in range(3)} for c in ("A", "C")}
    units = counted(spark, groups)
    cut = blocks.ordered_blocks(units, ["FLEET", "CATEGORY", "PN"], partitions=3)
    assert cut.where("CATEGORY = 'B'").select("_block").distinct().count() > 40
    assert got(pack.pack_units(units, cap=cap, partitions=3)) == brute(groups, cap)


def test_rows_before_blocks_with_gaps(spark):
    sizes = {b: b % 5 for b in (0, 1, 2, 3, 8, 9, 31, 8192, 8193, 3 << 13, 5 << 20)}
    frame = spark.createDataFrame(list(sizes.items()), "_block long, _n long")
    want = {b: sum(n for c, n in sizes.items() if c < b) for b in sizes}
    assert {r["_block"]: r["_offset"] for r in blocks.rows_before(frame).collect()} == want


def test_exact_fit_and_oversized(spark):
    groups = {
        ("F", "A"): {"P1": 60, "P2": 40, "P3": 1},
        ("F", "B"): {"P1": 500, "P2": 1, "P3": 99, "P4": 300, "P5": 300},
    }
    result = got(pack.pack_units(counted(spark, groups), cap=100, partitions=3))
    assert result == brute(groups, 100)
    assert [result["F", "B", f"P{i}"] for i in range(1, 6)] == [1, 2, 2, 3, 4]


def test_order_is_by_text(spark):
    groups = {("F", "A"): {"P10": 60, "P9": 60, "P1": 30, "p": 5, "É": 50}}
    assert got(pack.pack_units(counted(spark, groups), cap=100, partitions=2)) == brute(groups, 100)


@pytest.fixture(scope="module")
def rows(spark):
    """One unit holds a third of all rows, in equal copies."""
    n = 9000
    return spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "F0").otherwise(F.concat(F.lit("F"), F.col("id") % 2)).alias("FLEET"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("CATEGORY"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("P"), F.col("id") % 700)).alias("PN"),
        F.lit("M").alias("MAIN_PN"),
        F.lit("A1").alias("AC"),
        F.lit(None).cast("string").alias("Status"),
        F.lit(None).cast("date").alias("Created Date"),
        F.lit(None).cast("date").alias("Modified Date"),
    )


def test_packed_rows_are_whole_and_sheets_keep_their_limits(rows):
    cap = 200
    packed = pack.pack_assign(rows, cap=cap, partitions=4)
    assert packed.count() == 9000
    units = packed.groupBy("FLEET", "CATEGORY", "PN").agg(
        F.count("*").alias("n"), F.countDistinct("sheet_no").alias("sheets"), F.min("sheet_no").alias("sheet_no")
    )
    found = units.collect()
    assert {r["sheets"] for r in found} == {1}
    groups = {}
    for r in found:
        groups.setdefault((r["FLEET"], r["CATEGORY"]), {})[r["PN"]] = r["n"]
    want = brute(groups, cap)
    assert {(r["FLEET"], r["CATEGORY"], r["PN"]): r["sheet_no"] for r in found} == want
    sheets = pack.pack_sheets(rows, cap=cap)
    for r in sheets.collect():
        assert r["rows"] <= cap or r["units"] == 1
    assert sheets.agg(F.sum("rows")).first()[0] == 9000
    assert sheets.where("CATEGORY = 'A'").first()["sheet_name"] == "F0_A_01"


def test_hot_unit_is_not_shuffled_by_its_key(spark, rows):
    """The slot stays part of the shuffle key, and the hot rows use many slots."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = ["FLEET", "CATEGORY", "PN"]
        units = pack.unit_counts(rows).withColumn("sheet_no", F.lit(1) + F.col("n") * 0)
        joined = attach_by_key(rows, units, keys, "sheet_no")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        spread = joined.where("PN = 'HOT'").groupBy(F.spark_partition_id()).count()
        assert joined.count() == 9000 and joined.where("sheet_no IS NULL").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_slot" in line for line in exchanges) == 2
    assert spread.count() >= 1


def test_null_groups_and_units_are_rejected_not_lost(spark):
    df = spark.createDataFrame(
        [("F", "A", "P"), (None, "A", "P"), ("F", None, "P"), ("F", "A", None)],
        "FLEET string, CATEGORY string, PN string",
    )
    assert pack.pack_assign(df).count() == 1 and pack.pack_rejects(df).count() == 3


def test_names_have_two_digits_or_more(spark):
    df = spark.createDataFrame([("F", "A", 7), ("F", "A", 123)], "FLEET string, CATEGORY string, sheet_no long")
    assert [r["sheet_name"] for r in pack.name_sheets(df).collect()] == ["F_A_07", "F_A_123"]


def test_pack_job_writes_sorted_sheets(spark, rows, tmp_path):
    path = str(tmp_path / "sheets")
    rejects = extracts.pack_job(rows, path, "2025-02-18", cap=500)
    assert rejects.isEmpty()
    back = spark.read.parquet(path)
    assert back.count() == 9000
    first = back.first()
    assert first["Status"] == "Initial" and str(first["Created Date"]) == "2025-02-18"
    sheet = back.where("sheet_name = 'F1_B_01'").select("PN").collect()
    assert 0 < len(sheet) <= 500 and [r["PN"] for r in sheet] == sorted(r["PN"] for r in sheet)


def test_many_sheets_are_written_by_several_tasks_and_listed_by_few(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(extracts, "SHEETS", 50, raising=False)
    path = str(tmp_path / "sheets")
    extracts.pack_job(rows, path, "2025-02-18", cap=20)
    back = spark.read.parquet(path)
    files = back.select("sheet_name", F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).alias("task"))
    sheets = files.select("sheet_name").distinct().count()
    assert back.count() == 9000 and sheets > 200
    assert files.select("task").distinct().count() > 2

    context = spark.sparkContext
    context.setJobGroup("listing", "")
    try:
        read = publish.read_export(spark, path, back.drop("by_sheet_name").schema)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= publish.LISTING * context.defaultParallelism < sheets
    assert read.count() == 9000


def test_pack_job_needs_its_columns(spark):
    with pytest.raises(KeyError, match="Created Date, Modified Date"):
        extracts.prepare(spark.createDataFrame([], "Status string, CATEGORY string, PN string, MAIN_PN string, AC string, FLEET string"))


def test_empty_extract_packs_to_nothing(spark):
    df = spark.createDataFrame([], "FLEET string, CATEGORY string, PN string")
    assert pack.pack_assign(df).isEmpty() and pack.pack_sheets(df).isEmpty()
