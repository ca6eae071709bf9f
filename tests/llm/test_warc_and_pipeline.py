"""Archives with null and repeated ids, and the pipeline's stages on odd tables."""

import base64
import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackledger.llm import mixing, warc
from trackledger.session import scratch_path


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_null_and_repeated_page_ids(shared):
    pages = [
        (None, "a", "same"), (1, "b", "same"), (2, "c", "same"), (2, "d", "same"), (2, "d", "same"),
        (None, "e", "alone"), (None, "f", "alone"), (7, "g", "one"), (7, "h", "other"), (8, None, None), (None, None, ""),
    ]
    frame = shared.createDataFrame(pages, "page_id long, url string, html string")
    got = rows(warc.read_records(warc.write_archives(frame.repartition(3), scratch_path(shared, "warc"))))
    last = {"same": 2, "": 8}
    want = []
    for i, _, html in pages:
        payload = (html or "").encode()
        top = last.get(html or "")
        refers = top if top is not None and (i is None or i < top) else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        want.append((i, len(payload), digest, "revisit" if refers else "response", refers))
    assert got == sorted(want, key=repr)


def test_html_of_pages_without_a_revisit_is_not_shuffled(shared):
    """Few pages have a copy; nearly all html is written by the task that reads it, also without broadcasts by size."""
    html = F.when(F.col("id") % 100 == 0, F.lit("copy")).otherwise(F.sha2(F.col("id").cast("string"), 512))
    frame = shared.range(0, 20_000, 1, 8).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    seen = {}
    plain = warc.tested

    def marked(*args):
        seen["rows"] = plain(*args)
        return seen["rows"]

    shared.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    warc.tested = marked
    try:
        found = warc.read_records(warc.write_archives(frame, scratch_path(shared, "warc")))
        kinds = {r["record_type"]: r["count"] for r in found.groupBy("record_type").count().collect()}
        plan = seen["rows"].where("NOT _maybe")._jdf.queryExecution().executedPlan().toString()
        moved = seen["rows"].where("_maybe").count()
    finally:
        warc.tested = plain
        shared.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kinds == {"response": 19_801, "revisit": 199}
    assert "Exchange hashpartitioning(page_id" not in plan and "SortMergeJoin" not in plan
    assert moved < 1_000


CLASHING = ["id", "component", "hash", "keep", "flag", "digest", "word", "bits", "score", "rank", "n", "taken"]


def _stages(spark, docs, sf_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = corpus_pipeline.materialize(out)
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_on_odd_tables(odd, none, shared, sf_dir, empty):
    docs = none if empty else odd
    for k, column in enumerate(CLASHING):
        docs = docs.withColumn(column, F.lit(f"v{k}"))
    kept, tokens = _stages(shared, docs, sf_dir)
    if empty:
        assert kept.isEmpty() and tokens.isEmpty()
        return
    texts = [r["text"] or "" for r in kept.collect()]
    assert 0 < len(set(texts)) <= len({r["text"] or "" for r in odd.collect()})
    assert all(r["id"] == "v0" and r["component"] == "v1" for r in kept.select("id", "component").collect())
    assert tokens.count() == kept.count()
    sums = {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert {r["decoded_sha256"] for r in tokens.collect()} == sums


def test_pipeline_hands_rows_to_python_in_bounded_batches(shared):
    """A row may be a chunk of many texts: batches are bounded by bytes as well, and a mix makes no RDD of Python rows."""

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], names=["n", "bytes"])

    row = 1 << 18
    chunks = shared.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), row).alias("chunk"))
    kept = {k: shared.conf.get(k, None) for k in (f"spark.sql.execution.arrow.max{x}PerBatch" for x in ("Records", "Bytes"))}
    try:
        corpus_pipeline._small_batches(shared)
        found = chunks.mapInArrow(sizes, "n long, bytes long").collect()
    finally:
        for key, value in kept.items():
            shared.conf.unset(key) if value is None else shared.conf.set(key, value)
    assert sum(r["n"] for r in found) == 64
    assert max(r["bytes"] for r in found) <= corpus_pipeline.BATCH_BYTES + 2 * row


def test_mix_keeps_no_python_rows(shared, odd, none):
    for docs in (odd, none):
        plan = mixing.mix_by_source(docs)._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" in plan and "LogicalRDD" not in plan
