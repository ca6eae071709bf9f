"""Operator 6: exact duplicates by two passes over a Bloom filter.

Pass 1 maps every text's hash to two bits of one 64-bit word and counts the
rows that set each bit; bits set twice or more make the filter. Pass 2 tests
every row: a row whose two bits are not both in the filter has no equal and
passes straight through; only the others, the possibly repeated ones, are
shuffled and compared by their SHA-256.

The filter has 16 bits a row or more, up to 2^27 bits: a table of 64-bit words
of which at most 32 MB are ever broadcast. Past that size the filter fills up
and passes more rows on to the shuffle; the result stays whole. DataFrame
functions only.

Defined results: a null text equals an empty one; of equal texts the largest
``doc_id`` stays (a null ``doc_id`` is smaller than any); rows that share text
and ``doc_id`` are one document in ``duplicates`` terms: each is listed and
each is kept where its ``doc_id`` is. ``drop_duplicates`` keeps exactly one
row. An empty table gives an empty result; other columns, whatever their
names, pass through ``drop_duplicates`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackledger.llm.bloom import fresh_names, repeated, tested, words_for
from trackledger.session import materialize


def duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), dropped ones too.

    doc_id, keep_id, group_size, kept, text_sha256 (of the text in UTF-8).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("text_sha256"))
    ).withColumn("hash", F.xxhash64("text_sha256"))
    words = words_for(digests.count())
    rows = tested(digests, F.col("hash"), repeated(digests, "hash", words), words, "suspect")
    single = rows.where("NOT suspect").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # Written, so that both sides of the join below are plain scans, whose hot keys can be split.
    suspects = materialize(rows.where("suspect").select("doc_id", "text_sha256"))
    groups = materialize(
        suspects.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    )
    several = suspects.join(groups, "text_sha256").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(several)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of equal texts, that of the largest ``doc_id``.

    Rows with a text of their own are not shuffled. Of the others only id and
    digest are compared; the rows that stay are found by id and digest.
    """
    digest, hashed, keep, rank, flag = fresh_names(docs, 5)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.withColumn(digest, F.sha2(text, 256)).withColumn(hashed, F.xxhash64(digest))
    words = words_for(docs.count())
    rows = tested(rows, F.col(hashed), repeated(rows, hashed, words), words, flag)
    single = rows.where(~F.col(flag)).select(*docs.columns)
    suspects = rows.where(flag).drop(flag, hashed)
    best = suspects.groupBy(digest).agg(F.max("doc_id").alias(keep))
    # Both keys: a hot text is one row of ``best`` and meets the rows of one id.
    kept = suspects.alias("s").join(
        best.withColumnRenamed(digest, hashed).alias("b"),
        (F.col("doc_id").eqNullSafe(F.col(keep))) & (F.col(digest) == F.col(hashed)),
    )
    one = Window.partitionBy("doc_id", digest).orderBy(*[F.col(c) for c in _sortable(docs)])
    kept = kept.withColumn(rank, F.row_number().over(one)).where(F.col(rank) == 1)
    return single.unionByName(kept.select(*docs.columns))


def _sortable(docs: DataFrame) -> list[str]:
    """Columns that can be ordered by (not maps): they break ties between equal ids and texts."""
    return [f.name for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document with the one of its text that stays."""
    return duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
SELECT doc_id,
  max(doc_id) OVER same AS keep_id,
  count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
