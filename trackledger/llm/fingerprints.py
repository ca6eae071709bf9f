"""Operator 1: document fingerprints by locally consistent parsing.

A text is parsed level by level, first its UTF-8 bytes, then the names of
phrases. On each level deterministic coin tossing, twice, turns every
symbol into a small label that depends on its nearest neighbours to the left
and differs from the next one's, but in a run of one symbol; a phrase begins at
each label that is higher than both its neighbours, so a run stays in one
phrase. A phrase's name is a hash of its symbols, and the names are the next
level's symbols. So equal substrings are cut alike but for a few phrases at
their ends, wherever they stand, and share the names of their interior.

The fingerprint holds the ``KEPT`` smallest names (hashed again) of the phrases
from level ``LEVEL`` up: phrases of a word or two and everything above. The
likeness of two fingerprints estimates the share of common phrases among all
phrases of both texts; it is 1 for equal texts.

``fingerprint_with_next`` orders documents by id over ranges, so a text moves
once. The last document of a range meets the first of the next by a table of
two rows per range.

Defined results: a null or empty text has an empty fingerprint; two empty
fingerprints are alike (1), an empty and another one are not (0); a null
``doc_id`` comes first; rows that share a ``doc_id`` follow one another by
text; the last document's next one is the first, its own next if it is alone;
an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackledger.llm.words import bounds
from trackledger.session import materialize

LEVEL = 2
LEVELS = 24
KEPT = 48
CHUNK = 1 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(32))) * MULTIPLIER
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _coins(bits: int) -> np.ndarray:
    """Coin tossing as a table over (left label, label): twice the lowest bit in
    which they differ plus that bit of the label, from 1; 0 if they are equal."""
    left, label = np.arange(1 << bits)[:, None], np.arange(1 << bits)[None, :]
    differ = left ^ label
    place = np.zeros(differ.shape, dtype=np.int64)
    for bit in reversed(range(bits)):
        place[(differ >> bit) & 1 == 1] = bit
    return np.where(differ == 0, 0, 1 + 2 * place + ((label >> place) & 1)).astype(np.uint8).ravel()


_BYTE_COINS, _NAME_COINS, _SMALL_COINS = _coins(8), _coins(7), _coins(5)
#: Hash of each byte at each place of a phrase, by place modulo 64.
_BYTE_MIX = _mix(np.arange(1, (64 << 8) + 1, dtype=np.uint64))


def _toss(label: np.ndarray, heads: np.ndarray, bits: int, coins: np.ndarray) -> np.ndarray:
    """One round over small labels; a text's first symbol has the label 0 on its left."""
    index = label.astype(np.uint16)
    index[1:] |= label[:-1].astype(np.uint16) << np.uint16(bits)
    index[heads] = label[heads]
    return coins[index]


def _toss_names(names: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """The first round over 64-bit names."""
    differ = np.empty_like(names)
    np.bitwise_xor(names[1:], names[:-1], out=differ[1:])
    differ[heads] = names[heads]
    low = differ & (~differ + np.uint64(1))
    # The exponent of a power of two as a float is its bit's number.
    place = (low.astype(np.float64).view(np.uint64) >> np.uint64(52)) - np.uint64(1023)
    place[low == 0] = 0
    place &= np.uint64(63)
    return ((place << np.uint64(1)) | ((names >> place) & np.uint64(1))).astype(np.uint8)


def _level(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of all texts, and where each text's names begin and end."""
    heads = at[:-1]
    if symbols.dtype == np.uint8:
        label = _toss(_toss(symbols, heads, 8, _BYTE_COINS), heads, 5, _SMALL_COINS)
    else:
        label = _toss(_toss_names(symbols, heads), heads, 7, _NAME_COINS)
    begin = np.zeros(len(label), dtype=bool)
    begin[1:] = label[1:] > label[:-1]
    higher = label[:-1] >= label[1:]
    higher[at[1:-1] - 1] = True  # nothing is on the right of a text's last symbol
    begin[:-1] &= higher
    # A phrase has two symbols at least, but for a text of one.
    second = heads + 1
    begin[second[second < len(label)]] = False
    begin[heads] = True
    starts = np.flatnonzero(begin)
    length = np.diff(np.append(starts, len(symbols)))
    place = np.arange(len(symbols), dtype=np.int32) - np.repeat(starts.astype(np.int32), length)
    if symbols.dtype == np.uint8:
        mixed = _BYTE_MIX[(place & np.int32(63)) << np.int32(8) | symbols]
    else:
        mixed = _mix(symbols + place.astype(np.uint64) * MULTIPLIER)
    return _mix(np.add.reduceat(mixed, starts)), np.searchsorted(starts, at)


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(coded), np.uint8), bounds(np.fromiter(map(len, coded), np.int64, len(coded)))


def phrases(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, name) of all phrases from ``LEVEL`` up; at least each text's top one."""
    symbols, at = _bytes(texts)
    filled = np.flatnonzero(np.diff(at) > 0)
    at = at[np.append(filled, len(at) - 1)]
    owners, names = [], []
    for level in range(1, LEVELS + 1):
        if not len(filled):
            break
        symbols, at = _level(symbols, at)
        count = np.diff(at)
        done = count == 1
        if level >= LEVEL or done.any():
            owner = np.repeat(filled, count)
            use = np.ones(len(symbols), dtype=bool) if level >= LEVEL else np.repeat(done, count)
            owners.append(owner[use])
            names.append(_mix(symbols[use] + np.uint64(level)))
        if done.any():  # a single phrase is the top of its text
            keep = np.repeat(~done, count)
            symbols, filled, at = symbols[keep], filled[~done], bounds(count[~done])
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(owners), np.concatenate(names)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The ``KEPT`` smallest names of each text, as sorted 32-bit numbers."""
    owner, name = phrases(texts)
    key = np.sort((owner.astype(np.uint64) << np.uint64(32)) | (name >> np.uint64(32)))
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    cuts = np.searchsorted(key, np.arange(len(texts) + 1).astype(np.uint64) << np.uint64(32))
    return [key[a : min(b, a + KEPT)].astype(np.uint32) for a, b in zip(cuts[:-1], cuts[1:])]


def spelled(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of common names among the smallest names of both."""
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    both = np.sort(np.concatenate([one, two]))
    again = both[1:] == both[:-1]
    union = both[np.concatenate([[True], ~again])][:KEPT]
    shared = both[1:][again]
    return float(np.searchsorted(shared, union[-1], side="right")) / len(union)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many of the next one's first signs."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
#: A range's first and last text besides, for the one that has to wait.
PARTIAL = RESULT + ", part int, place string, text string"


def _batch(columns: list[list], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.record_batch([pa.array(c, types[f[1]]) for c, f in zip(columns, fields)], names=[f[0] for f in fields])


def _compare(doc_ids: list, texts: list[str]) -> list[list]:
    """Result rows of all but the last text, each with the one behind it."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, other = sketches(texts), sketches(changed)
    rows = []
    for k, text in enumerate(changed):
        sha = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
        near = likeness(own[k], other[k]), likeness(own[k], own[k + 1])
        rows.append([doc_ids[k], len(texts[k]), sha, spelled(own[k]), spelled(other[k]), *near])
    return rows


def _parse_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    ids, texts, size, begun = [], [], 0, False

    def rows() -> pa.RecordBatch:
        return _batch([*map(list, zip(*[[*r, part, "done", None] for r in _compare(ids, texts)]))], PARTIAL)

    def waiting(place: str) -> pa.RecordBatch:
        return _batch([[x] for x in (ids[-1], *[None] * 6, part, place, texts[-1])], PARTIAL)

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if not begun:
                begun = True
                yield waiting("first")
            if size >= CHUNK and len(texts) > 1:
                yield rows()
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if begun:
        if len(texts) > 1:
            yield rows()
        yield waiting("last")


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _batch([*map(list, zip(*_compare([row["doc_id"], None], [row["text"] or "", row["following"] or ""])))], RESULT)


def fingerprint_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of their edited texts, and likenesses."""
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    parsed = materialize(ordered.mapInArrow(_parse_range, PARTIAL))
    firsts = parsed.where("place = 'first'").select("part", F.col("text").alias("following"))
    lasts = parsed.where("place = 'last'").select("doc_id", "text", "part")
    # One number per range: the range that comes next, the first one behind the last.
    everywhere = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("part").withColumn(
        "next", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(everywhere))
    )
    pairs = (
        lasts.join(following, "part")
        .drop("part")
        .join(firsts.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "text", "following")
    )
    names = [f.split()[0] for f in RESULT.split(", ")]
    return parsed.where("place = 'done'").select(*names).unionByName(pairs.mapInArrow(_finish, RESULT))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row of ``docs``, without moving a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= CHUNK:
                    yield _batch([ids, [*map(spelled, sketches(texts))]], "doc_id long, fingerprint string")
                    ids, texts, size = [], [], 0
            if ids:
                yield _batch([ids, [*map(spelled, sketches(texts))]], "doc_id long, fingerprint string")

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows_in.mapInArrow(rows, "doc_id long, fingerprint string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: fingerprints of every document and of its edited text."""
    return fingerprint_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
