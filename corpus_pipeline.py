"""A corpus pipeline: toxicity, exact and near duplicates, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns documents with all their
columns, but for the last, which returns token digests. ``run`` writes each
stage's result to the shared folder and reads it again as the next one's
input, so a lost executor costs one stage at most. Stages hand rows to Python in
batches of ``BATCH_ROWS`` rows and of ``BATCH_BYTES``, as the session is told: the
stages before have left an executor less memory than an operator on its own has.
Rows alone are no bound, as one may be a chunk of many texts: without the bytes a
task of the last stage gathers all its chunks in a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackledger.llm import bpe, exact_dedup, mixing, near_dups, toxicity
from trackledger.session import materialize


BATCH_ROWS = 200
BATCH_BYTES = 1 << 20


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that of the largest id."""
    _small_batches(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    _small_batches(spark)
    return near_dups.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    _small_batches(spark)
    return mixing.draw_by_source(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the text decoded from them.

    No words are folded before the others, which changes no id.
    """
    _small_batches(spark)
    return bpe.digests(docs, first=0)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The classifier and the seeded mix have no SQL; a test runs a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
