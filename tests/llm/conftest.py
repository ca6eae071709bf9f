import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size string"


@pytest.fixture(scope="session")
def shared(spark, tmp_path_factory):
    """A shared folder for sessions that name none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    return spark


@pytest.fixture(scope="session")
def odd(shared):
    """Nulls, empty and long texts, copies, near copies, repeated rows and clashing columns."""
    base = " ".join(f"word{k % 97}x{k}" for k in range(200))
    texts = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (6, "One"), (7, base), (8, base + " end"),
        (9, base.replace("word5x5 ", "")), (10, "x" * 3000), (11, " ".join(["the cat's 12 ñandú, don't!"] * 4000)),
        (12, base), (12, base), (13, "it's we'll 　  x\n\n  y 😀 l'été"), (None, "a b c d e f"),
    ]
    sources = ["a", "b", None]
    rows = [(i, t, None, sources[k % 3], len(t or ""), "k", "s") for k, (i, t) in enumerate(texts)]
    return shared.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(shared):
    return shared.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TRACKLEDGER_SF_DIR", "/root/testdata/sf0.001")


