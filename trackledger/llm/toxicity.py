"""Operator 2: toxicity by a linear classifier over character n-grams.

Features are the hashed n-grams of ``SIZES`` bytes of a text, each counted once
per document and scaled by its naive Bayes log-count ratio between toxic and
clean training documents; logistic regression weighs the scaled features. The
ratios come from a bounded sample of labelled rows, at most ``MAX_TRAIN``, the
first in the order of a hash of their ids; of the 2^20 n-gram slots with a ratio
of ``LEAST_RATIO`` or more the ``FEATURES`` with the surest ones are kept. Scoring reads every whole text
once, in its own task, with a model of a few kilobytes.

Defined results: a null or empty text has no n-grams, its score is the model's
intercept; rows that share a ``doc_id`` are scored one by one; a label counts
once per ``doc_id`` (toxic if any of its labels is), null labels not at all;
without labels of both kinds nothing is called toxic; an empty table gives no
rows. Other columns are not read as inputs and pass through ``reject``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.llm.words import distinct, raw, release, slices, text_column
from trackledger.session import materialize

SIZES = (5, 6)
SLOT_BITS = 20
MAX_TRAIN = 12_000
FEATURES = 4096
LEAST_RATIO = 3.0
ROUNDS = 200
CHUNK = 1 << 20
FOLDS = 5


def held_out(doc_id: Column, fold: int) -> Column:
    """True where crc32 of the id as text falls into the fold kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == fold, F.lit(False))


def _ngrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """(slots of the n-grams at every byte, n, bytes' texts' ends): one n at a time."""
    data, at = raw(texts)
    data = data + ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) * np.uint8(32)
    data[(data >= 0x09) & (data <= 0x0D)] = 0x20
    value = np.zeros(len(data), dtype=np.uint32)
    wide = data.astype(np.uint32)
    for size in range(1, max(SIZES) + 1):
        value = value[: max(0, len(data) - size + 1)] * np.uint32(0x01000193) + wide[size - 1 :] + np.uint32(1)
        if size in SIZES:
            mixed = (value ^ np.uint32(size << 24)) * np.uint32(0x9E3779B1)
            yield (mixed >> np.uint32(32 - SLOT_BITS)), size, at


def _owners(places: np.ndarray, size: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which text each n-gram lies in, and whether it lies in it whole."""
    owner = np.searchsorted(at, places, side="right") - 1
    return owner, places + size <= at[owner + 1]


def _present(texts: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every wanted slot that a text has, each once; wanted: sorted slots."""
    table = np.zeros(1 << SLOT_BITS, dtype=bool)
    table[wanted] = True
    pairs = []
    for slots, size, at in _ngrams(texts):
        places = np.flatnonzero(table[slots])
        owner, whole = _owners(places, size, at)
        feature = np.searchsorted(wanted, slots[places[whole]])
        pairs.append(distinct(owner[whole] * len(wanted) + feature))
    found = distinct(np.concatenate(pairs)) if pairs and len(wanted) else np.zeros(0, dtype=np.int64)
    return found // max(1, len(wanted)), found % max(1, len(wanted))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of toxic and clean documents with each slot, per task."""
    counts = np.zeros((2, 1 << SLOT_BITS), dtype=np.int32)
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            toxic = np.asarray(part.column(1)).astype(np.int64)
            texts, seen = text_column(part.column(0)), []
            ends = raw(texts)[1]
            owner = np.repeat(np.arange(len(texts)), np.diff(ends))
            for slots, size, _ in _ngrams(texts):
                own = owner[: len(slots)]
                whole = own == owner[size - 1 :]
                # Equal slots of other sizes are told apart only by chance: they count as one.
                seen.append(distinct((own[whole] << SLOT_BITS) | slots[whole]))
            found = distinct(np.concatenate(seen)) if seen else np.zeros(0, dtype=np.int64)
            label, slot = toxic[found >> SLOT_BITS], found & ((1 << SLOT_BITS) - 1)
            for kind in (0, 1):
                counts[kind] += np.bincount(slot[label == kind], minlength=1 << SLOT_BITS).astype(np.int32)
    used = np.flatnonzero(counts.any(axis=0))
    for start in range(0, len(used), 1 << 16):
        own = used[start : start + (1 << 16)]
        yield pa.record_batch(
            [pa.array(own, pa.int64()), pa.array(counts[0, own], pa.int64()), pa.array(counts[1, own], pa.int64())],
            names=["slot", "clean", "toxic"],
        )


@dataclass(frozen=True)
class Model:
    slots: np.ndarray  # sorted
    weights: np.ndarray  # regression weight times log-count ratio
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        text, feature = _present(texts, self.slots)
        total = np.bincount(text, self.weights[feature], minlength=len(texts)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _regress(doc: np.ndarray, feature: np.ndarray, ratio: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features, by gradient steps of their own size (AdaGrad)."""
    value, rate = ratio[feature], toxic.mean()
    weight, bias = np.zeros(len(ratio)), math.log(rate / (1 - rate))
    scale, bias_scale = np.full(len(ratio), 1e-8), 1e-8
    for _ in range(ROUNDS):
        total = np.bincount(doc, weight[feature] * value, minlength=len(toxic)) + bias
        error = 1 / (1 + np.exp(-np.clip(total, -500, 500))) - toxic
        slope = np.bincount(feature, error[doc] * value, minlength=len(ratio)) / len(toxic) + 1e-5 * weight
        scale += slope**2
        weight -= 0.2 * slope / np.sqrt(scale)
        bias_scale += error.mean() ** 2
        bias -= 0.2 * error.mean() / math.sqrt(bias_scale)
    return weight * ratio, bias


def train(docs: DataFrame, labels: DataFrame, fold: int = 0, max_train: int = MAX_TRAIN) -> Model:
    """Fit on ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) covers, without the held-out fold."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), fold))
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(max_train)
    )
    # Bounded: at most max_train rows of two numbers; an id that repeats gives one text, the largest.
    sample = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(materialize(chosen)), F.col("doc_id") == F.col("_labelled"))
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(np.zeros(0, np.int64), np.zeros(0), -10.0)
    counts = sample.mapInArrow(_count, "slot long, clean long, toxic long").groupBy("slot").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    ratio = F.log((F.col("toxic") + 1) / (n[1] + 2)) - F.log((F.col("clean") + 1) / (n[0] + 2))
    sure = F.abs(ratio) / F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    clear = counts.select("slot", ratio.alias("ratio"), sure.alias("sure")).where(F.abs("ratio") >= math.log(LEAST_RATIO))
    best = clear.orderBy(F.desc("sure"), "slot").limit(FEATURES).collect()
    best.sort(key=lambda r: r["slot"])
    slots, ratios = np.array([r["slot"] for r in best]), np.array([r["ratio"] for r in best])
    rows = sample.mapInArrow(_sparse(slots), "toxic int, features binary").collect()  # at most max_train rows
    rows.sort(key=lambda r: (r["toxic"], bytes(r["features"])))
    lists = [np.frombuffer(r["features"], "<u2").astype(np.int64) for r in rows]
    doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    weights, bias = _regress(doc, np.concatenate(lists), ratios, np.array([float(r["toxic"]) for r in rows]))
    return Model(slots, weights, bias)


def _sparse(slots: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                text, feature = _present(text_column(part.column(0)), slots)
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                lists = [feature[a:b].astype("<u2").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.record_batch(
                    [part.column(1).cast(pa.int32()), pa.array(lists, pa.binary())], names=["toxic", "features"]
                )

    return rows


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                found = model.scores(text_column(part.column(1)))
                yield pa.record_batch([part.column(0), pa.array(found)], names=["doc_id", "score"])
        release()

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows_in.mapInArrow(rows, "doc_id long, score double")


def reject(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for text in texts:
            array = text_column(pa.array(text, pa.string(), from_pandas=True))
            parts = slices(pa.record_batch([array], names=["text"]), "text", CHUNK)
            found = [model.scores(text_column(p.column(0))) for p in parts]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))
        release()

    return docs.where(scores(F.col("text")) < threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: toxicity of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id"), 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
