"""Every registered query against the same in SQL."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from trackledger.catalog import QUERIES

ROOT = "/root/testdata"
SMALL = os.environ.get("TRACKLEDGER_SF_DIR", f"{ROOT}/sf0.001")


@pytest.fixture(scope="module")
def connections():
    return {}


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_sql(spark, connections, name):
    if SMALL not in connections:
        connections[SMALL] = oracle.connect(SMALL)
    result = contract.queries()[name](spark, SMALL)
    assert oracle.compare(result, connections[SMALL], contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql())


def test_entry_has_rows(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == [
        "sheet", "_id", "AC", "FLEET", "PN", "MAIN_PN", "VENDOR", "_old_status", "Status", "op",
    ]
    assert not flagship.isEmpty()


def test_reconcile_counts_add_up(spark):
    """Counts known for the middle tables, with plain and null-safe keys."""
    sf_dir = f"{ROOT}/sf0.01"

    def ops(name):
        rows = contract.queries()[name](spark, sf_dir).groupBy("op").count().collect()
        return {r["op"]: r["count"] for r in rows}

    assert ops("reconcile_ops") == {
        "INSERT": 7996, "REOPEN": 2050, "COMPLETE": 6083, "ERROR": 14981, "KEEP": 22453,
    }
    assert ops("reconcile_null_safe") == {
        "INSERT": 3053, "REOPEN": 2516, "COMPLETE": 7580, "ERROR": 7592, "KEEP": 27879,
    }
