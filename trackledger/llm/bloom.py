"""Bloom filters as small tables of 64-bit words, with DataFrame functions only.

A hash sets two bits of one word. A filter has at most ``MAX_BITS`` bits, so the
table that is broadcast has at most ``MAX_BITS / 64`` rows of two numbers, 32 MB,
whatever the input. A full filter passes more rows; it never loses one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_ROW = 16
MAX_BITS = 1 << 27


def words_for(n_rows: int) -> int:
    """Number of 64-bit words of a filter for so many rows."""
    return min(MAX_BITS, 1 << max(10, (BITS_PER_ROW * max(1, n_rows) - 1).bit_length())) // 64


def _word(value: Column, words: int) -> Column:
    return F.pmod(F.shiftrightunsigned(value, 12), F.lit(words))


def _bits(value: Column) -> tuple[Column, Column]:
    return value.bitwiseAND(F.lit(63)), F.shiftrightunsigned(value, 6).bitwiseAND(F.lit(63))


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))


def _both(value: Column) -> Column:
    one, two = _bits(value)
    return _mask(one).bitwiseOR(_mask(two))


def repeated(hashes: DataFrame, column: str, words: int) -> DataFrame:
    """Filter (word, bits) of the bits that two rows of ``hashes`` or more set."""
    value = F.col(column)
    bit = F.explode(F.array_distinct(F.array(*_bits(value)))).alias("bit")
    counted = hashes.select(_word(value, words).alias("word"), bit).groupBy("word", "bit").agg(F.count("*").alias("n"))
    return counted.where("n > 1").groupBy("word").agg(F.bit_or(_mask(F.col("bit"))).alias("bits"))


def members(hashes: DataFrame, column: str, words: int) -> DataFrame:
    """Filter (word, bits) of all rows of ``hashes``."""
    value = F.col(column)
    return hashes.groupBy(_word(value, words).alias("word")).agg(F.bit_or(_both(value)).alias("bits"))


def tested(rows: DataFrame, value: Column, found: DataFrame, words: int, flag: str) -> DataFrame:
    """``rows`` with a boolean column: the filter may hold ``value`` or certainly doesn't."""
    word, bits = f"{flag}_word", f"{flag}_bits"
    found = found.withColumnsRenamed({"word": word, "bits": bits})
    joined = rows.join(F.broadcast(found), F.col(word) == _word(value, words), "left")
    mask = _both(value)
    return joined.withColumn(flag, F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False))).drop(word, bits)


def fresh_names(df: DataFrame, count: int, prefix: str = "_own") -> list[str]:
    """Column names that ``df`` does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    names = (f"{prefix}{k}" for k in range(len(taken) + count))
    return [n for n in names if n not in taken][:count]


def without_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``column`` is in ``ids`` (one column, ``id``).

    Rows that the filter of ``ids`` excludes pass without a shuffle.
    """
    flag, gone = fresh_names(docs, 2)
    words = words_for(ids.count())
    found = members(ids.select(F.xxhash64("id").alias("hash")), "hash", words)
    rows = tested(docs, F.xxhash64(F.col(column).cast("long")), found, words, flag)
    clear = rows.where(~F.col(flag)).drop(flag)
    checked = rows.where(flag).drop(flag)
    ids = ids.select(F.col("id").alias(gone))
    return clear.unionByName(checked.join(ids, F.col(column).cast("long") == F.col(gone), "left_anti"))


def with_ids(docs: DataFrame, ids: DataFrame, column: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose ``column`` may be in ``ids``, and few others; no shuffle."""
    (flag,) = fresh_names(docs, 1)
    words = words_for(ids.count())
    found = members(ids.select(F.xxhash64("id").alias("hash")), "hash", words)
    return tested(docs, F.xxhash64(F.col(column).cast("long")), found, words, flag).where(flag).drop(flag)
