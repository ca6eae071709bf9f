import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trackledger.functions.rules import apply_feedback, fold_category, open_rows
from trackledger.model import ENGINE_ACTIONS, REPORTED
from trackledger.operators import dimension, summary
from trackledger.plans import summaries

SCHEMA = (
    "FLEET string, CATEGORY string, AC string, PROPOSED_ACTION string, FEEDBACK string, Status string"
)


@pytest.fixture(scope="module")
def frame():
    rng = random.Random(7)
    pick = rng.choice
    return pd.DataFrame(
        [
            {
                "FLEET": pick(["F1", "F2", None]),
                "CATEGORY": pick(["KIT", "GEN-CON", "SOFTWARE", "OTHER", "ROTABLE", None]),
                "AC": pick(["A1", "A2", "A3", None]),
                "PROPOSED_ACTION": pick(["ADD_EFFECTIVITY", "VALIDATE_EFFECTIVITY", "UPDATE_EFFECTIVITY", None]),
                "FEEDBACK": pick([None, None, None, "", " ", "ok"]),
                "Status": pick([*REPORTED, "Assigned", "Error", None]),
            }
            for _ in range(1500)
        ]
    )


@pytest.fixture(scope="module")
def rows(spark, frame):
    return spark.createDataFrame([tuple(r) for r in frame.itertuples(index=False)], SCHEMA)


def prepared(frame):
    out = frame.copy()
    filled = out["FEEDBACK"].notna() & (out["FEEDBACK"] != "")
    out.loc[filled, "Status"] = "Validated"
    return out


def folded(frame):
    out = prepared(frame)
    out["CATEGORY"] = out["CATEGORY"].replace(dict.fromkeys(["KIT", "GEN-CON", "SOFTWARE"], "OTHER"))
    return out


def brute_actions(frame, by, actions):
    still = frame[~frame["Status"].isin(["Validated", "Complete"])]
    out = set()
    groups = still.groupby(by) if by else [((), still)]
    for key, part in groups:
        key = key if isinstance(key, tuple) else (key,)
        for ac in part["AC"].unique():
            counts = [
                int(((part["AC"] == ac) & (part["PROPOSED_ACTION"] == action)).sum())
                for action in actions.values()
            ]
            out.add((*key, ac, *counts, sum(counts)))
    return out


def brute_matrix(frame, by):
    out = set()
    for key, part in frame.dropna(subset=["AC", "Status"]).groupby([*by, "AC"]):
        out.add((*key, *[int((part["Status"] == s).sum()) for s in REPORTED]))
    return out


def brute_totals(part, actions):
    return (
        *[int((part["PROPOSED_ACTION"] == a).sum()) for a in actions.values()],
        *[int((part["Status"] == s).sum()) for s in REPORTED],
    )


def got(df):
    return {tuple(r) for r in df.collect()}


def test_open_actions(rows, frame):
    ready = apply_feedback(rows)
    want = brute_actions(prepared(frame), ["FLEET"], summary.AIRFRAME_ACTIONS)
    assert got(summary.open_actions(open_rows(ready))) == want
    assert any(r[1] is None and r[2:] == (0, 0, 0) for r in want)
    want = brute_actions(folded(frame), ["FLEET", "CATEGORY"], summary.AIRFRAME_ACTIONS)
    assert got(summary.open_actions(open_rows(fold_category(ready)), ["FLEET", "CATEGORY"])) == want
    want = brute_actions(prepared(frame), [], ENGINE_ACTIONS)
    assert got(summary.open_actions(open_rows(ready), [], ENGINE_ACTIONS)) == want


def test_status_matrix(rows, frame):
    ready = apply_feedback(rows)
    assert got(summary.status_matrix(ready)) == brute_matrix(prepared(frame), ["FLEET"])
    assert got(summary.status_matrix(fold_category(ready), ["FLEET", "CATEGORY"])) == brute_matrix(
        folded(frame), ["FLEET", "CATEGORY"]
    )


def test_aircraft_with_unlisted_statuses_stays_with_zeros(spark):
    df = spark.createDataFrame([("F1", "K", "A1", "x", None, "Error"), ("F1", "K", "A2", "x", None, None)], SCHEMA)
    assert got(summary.status_matrix(df)) == {("F1", "A1", 0, 0, 0, 0, 0, 0, 0)}
    assert summary.status_matrix(df, statuses=["Error"]).first()["Error"] == 1


def test_totals_with_categories(rows, frame):
    ready, plain = fold_category(apply_feedback(rows)), folded(frame)
    wide = dimension.totals_with_categories(ready)
    assert wide.columns[-2:] == ["OTHER", "ROTABLE"]
    want = {
        (
            fleet,
            *brute_totals(part, summary.AIRFRAME_ACTIONS),
            int((part["CATEGORY"] == "OTHER").sum()),
            int((part["CATEGORY"] == "ROTABLE").sum()),
        )
        for fleet, part in plain.groupby("FLEET")
    }
    assert got(wide) == want


def test_all_pairs_are_present(spark, rows, frame):
    ready, plain = fold_category(apply_feedback(rows)), folded(frame)
    want = {
        (f, c, *brute_totals(plain[(plain["FLEET"] == f) & (plain["CATEGORY"] == c)], summary.AIRFRAME_ACTIONS))
        for f in ["F1", "F2"]
        for c in ["OTHER", "ROTABLE"]
    }
    assert got(dimension.pair_totals(ready)) == want
    sparse = spark.createDataFrame(
        [("F1", "A", "x", None, None, "Issue"), ("F2", "B", "x", None, None, None), ("F3", None, "x", None, None, None)],
        SCHEMA,
    )
    result = dimension.pair_totals(sparse)
    assert result.count() == 6
    assert [r["Issue"] for r in result.where("FLEET = 'F1' AND CATEGORY = 'A'").collect()] == [1]


def test_declared_categories_have_rows_with_zeros(spark, rows, frame):
    ready, plain = fold_category(apply_feedback(rows)), folded(frame)
    actions = summary.AIRFRAME_ACTIONS
    declared = spark.createDataFrame([("SPARE",), ("ROTABLE",)], "CATEGORY string")
    result = got(dimension.pair_totals(ready, declared))
    assert {r[:2] for r in result} == {(f, c) for f in ("F1", "F2") for c in ("SPARE", "ROTABLE", "OTHER")}
    assert {r[2:] for r in result if r[1] == "SPARE"} == {(0,) * (len(actions) + len(REPORTED))}
    pairs = spark.createDataFrame([("F1", "SPARE"), ("F9", "OTHER")], "FLEET string, CATEGORY string")
    found = {r[:2] for r in got(dimension.pair_totals(ready, pairs))}
    assert found == {(f, c) for f in ("F1", "F2") for c in ("ROTABLE", "OTHER")} | {("F1", "SPARE"), ("F9", "OTHER")}
    long = {(r["FLEET"], r["kind"], r["title"]): r["n"] for r in dimension.long_totals(ready, declared).collect()}
    for fleet, part in plain.groupby("FLEET"):
        assert long[fleet, "category", "SPARE"] == 0
        assert long[fleet, "category", "OTHER"] == int((part["CATEGORY"] == "OTHER").sum())
        assert [long[fleet, "action", t] for t in actions] + [long[fleet, "status", t] for t in REPORTED] == list(
            brute_totals(part, actions)
        )
    wide = dimension.totals_with_categories(ready, categories=declared)
    assert wide.columns[-2:] == ["ROTABLE", "SPARE"] and set(r["SPARE"] for r in wide.collect()) == {0}


def test_any_number_of_categories(spark):
    """More than a pivot would take, in rows; every fleet with every category."""
    df = spark.range(0, 12_000).select(
        F.concat(F.lit("F"), F.col("id") % 2).alias("FLEET"), F.concat(F.lit("C"), F.col("id")).alias("CATEGORY"),
        F.lit("A").alias("AC"), F.lit("x").alias("PROPOSED_ACTION"), F.lit(None).cast("string").alias("FEEDBACK"), F.lit("Issue").alias("Status"),
    )
    long = dimension.long_totals(df).where("kind = 'category'")
    assert long.count() == 12_000 + 2
    pairs = dimension.pair_totals(df)
    assert pairs.count() == 24_000 and pairs.agg(F.sum("Issue")).first()[0] == 12_000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert dimension.pair_totals(df.limit(0)).isEmpty() and dimension.long_totals(df.limit(0)).isEmpty()


def test_reports_from_counted_rows_equal_reports_from_rows(rows, frame):
    ready = apply_feedback(rows)
    reports = summaries.fleet_summaries(rows)
    assert got(reports["ACTIONS"]) == got(summary.open_actions(open_rows(ready)))
    assert got(reports["STATUS"]) == got(summary.status_matrix(ready))
    assert got(reports["TOTALS"]) == got(dimension.totals_with_categories(fold_category(ready)))
    pairs = summaries.fleet_category_summaries(rows)
    assert got(pairs["TOTALS"]) == got(dimension.pair_totals(fold_category(ready)))
    assert got(pairs["ACTION"]) == brute_actions(folded(frame), ["FLEET", "CATEGORY"], summary.AIRFRAME_ACTIONS)
    engine = summaries.engine_summaries(rows)
    assert got(engine["totals"]) == {brute_totals(prepared(frame), ENGINE_ACTIONS)}
    assert got(engine["all_status"]) == got(summary.status_matrix(ready, []))
    raw = summaries.fleet_category_summaries(rows, fold=False)
    assert {r["CATEGORY"] for r in raw["TOTALS"].collect()} == {"KIT", "GEN-CON", "SOFTWARE", "OTHER", "ROTABLE"}


def test_engine_totals_of_nothing_are_zero(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert set(summaries.engine_summaries(empty)["totals"].first()) == {0}


def test_export_reports(spark, rows, tmp_path):
    summaries.export_reports(summaries.fleet_summaries(rows), str(tmp_path / "fleet"))
    assert (tmp_path / "fleet" / "STATUS" / "by_FLEET=F1").is_dir()
    back = spark.read.parquet(str(tmp_path / "fleet" / "TOTALS"))
    assert sorted(r["FLEET"] for r in back.collect()) == ["F1", "F2"]
    summaries.export_reports(summaries.engine_summaries(rows), str(tmp_path / "engine"))
    assert spark.read.parquet(str(tmp_path / "engine" / "totals")).count() == 1
    acs = [r["AC"] for r in spark.read.parquet(str(tmp_path / "engine" / "all_action")).collect()]
    assert acs == ["A1", "A2", "A3", None]
