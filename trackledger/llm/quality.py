"""Operator 13: quality by compression with dictionaries of good and bad text.

Two zstandard dictionaries of ``DICTIONARY`` bytes are built, one from pieces of
labelled good texts and one from pieces of labelled bad texts. A text is cut
into pieces of ``PIECE`` bytes, first to last; every piece is compressed with
either dictionary. The normalised difference

    (bytes with the bad one - bytes with the good one) / bytes of the text

says how much better the good dictionary explains the text. A logistic curve
turns it into a score; a second term, ``PIECE / (PIECE + bytes)``, tells it how
little a short text can say. The curve is fitted on labelled documents that gave
no piece to a dictionary.

Labels are learnt from a bounded sample: at most ``MAX_TRAIN`` labelled ids, the
first in the order of a hash, one text each; ``DICTIONARY_EIGHTHS`` eighths of
them feed the dictionaries, with at most ``MAX_PIECES`` pieces a label (10 MB),
the rest fits the curve, as three numbers a document. Scoring reads every whole
text once, in its own task, without a shuffle.

Defined results: a null or empty text has the difference 0 and the score of the
shortest texts; rows that share a ``doc_id`` are scored one by one; a label
counts once per ``doc_id`` (bad if any of its labels is), null labels not at
all, and of several texts of one id the last in order is learnt from; with
labels of one kind every score is that kind's, without any it is 0.5; too few
pieces for a trained dictionary are used as they are, one after the other; an
empty table gives no rows. Other columns are not read and pass through
``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.llm.words import raw, slices, text_column
from trackledger.session import materialize

PIECE = 512
DICTIONARY = 1 << 16
LEVEL = 1
MAX_TRAIN = 12_000
MAX_PIECES = 20_000
DICTIONARY_EIGHTHS = 5
THRESHOLD = 0.7
FOLDS = 4
CHUNK = 4 << 20


def held_out(doc_id: Column, fold: int = 2) -> Column:
    """True where crc32 of the id as text falls into the fold kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == fold, F.lit(False))


def _pieces(texts: pa.Array) -> Iterator[list[bytes]]:
    """Every text's bytes in pieces."""
    data, at = raw(texts)
    whole = data.tobytes()
    for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
        yield [whole[k : min(k + PIECE, end)] for k in range(start, end, PIECE)]


def _dictionary(pieces: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too few or too alike
        return b"".join(pieces)[:DICTIONARY]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    trained = zstandard.ZstdCompressionDict(dictionary)
    if not trained.dict_id():
        trained = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=trained, write_checksum=False, write_content_size=False, write_dict_id=False
    )


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the weights of difference and shortness, and an intercept."""

    bad: bytes
    good: bytes
    weights: tuple[float, float]
    intercept: float

    def features(self):
        """A function from texts to (difference, shortness) of each."""
        compressors = [_compressor(d) for d in (self.bad, self.good)] if self.bad and self.good else []

        def of(texts: pa.Array) -> np.ndarray:
            found = np.zeros((len(texts), 2))
            for k, pieces in enumerate(_pieces(texts)):
                size = sum(map(len, pieces))
                found[k, 1] = PIECE / (PIECE + size)
                if compressors and size:
                    bad, good = (sum(len(c.compress(p)) for p in pieces) for c in compressors)
                    found[k, 0] = (bad - good) / size
            return found

        return of

    def scorer(self):
        """A function from texts to scores between 0 and 1."""
        features, weights = self.features(), np.array(self.weights)
        return lambda texts: _logistic(features(texts) @ weights + self.intercept)


def _logistic(total: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _fit(x: np.ndarray, good: np.ndarray) -> tuple[tuple[float, float], float]:
    """Logistic regression by Newton steps, with a small pull towards 0."""
    scale = np.append(np.maximum(x.std(axis=0), 1e-6), 1.0)
    x = np.column_stack([x, np.ones(len(x))]) / scale
    weight = np.zeros(3)
    for _ in range(50):
        p = _logistic(x @ weight)
        slope = x.T @ (p - good) + 1e-2 * weight
        curve = (x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        # A long step would leave the region where the curve tells anything.
        weight -= step * min(1.0, 4 / max(1e-12, float(np.abs(step).max())))
    weight /= scale
    return (float(weight[0]), float(weight[1])), float(weight[2])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            pieces = list(_pieces(text_column(part.column(0))))
            good = np.repeat(np.asarray(part.column(1)), [len(p) for p in pieces])
            yield pa.record_batch(
                [pa.array([p for own in pieces for p in own], pa.binary()), pa.array(good, pa.int32())],
                names=["piece", "good"],
            )


def _measured(model: Model):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = model.features()
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                found = features(text_column(part.column(0)))
                yield pa.record_batch(
                    [pa.array(found[:, 0]), pa.array(found[:, 1]), part.column(1).cast(pa.int32())],
                    names=["difference", "shortness", "good"],
                )

    return rows


def train(docs: DataFrame, labels: DataFrame, fold: int = 2, max_train: int = MAX_TRAIN) -> Model:
    """Fit on ``docs`` (doc_id, text) that ``labels`` (doc_id, quality) covers, without the held-out fold."""
    chosen = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), fold))
        .groupBy(F.col("doc_id").cast("long").alias("_labelled"))
        .agg(F.min(F.col("quality").cast("int")).alias("good"))
        .orderBy(F.xxhash64("_labelled"), "_labelled")
        .limit(max_train)
    )
    # Bounded: at most max_train rows of two numbers; an id that repeats gives one text, the largest.
    sample = materialize(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(materialize(chosen)), F.col("doc_id") == F.col("_labelled"))
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("good").alias("good"))
        .select("text", "good", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(8)).alias("part"))
    )
    n = {r["good"]: r["n"] for r in sample.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(b"", b"", (0.0, 0.0), 0.0 if not n else 10.0 if n.get(1) else -10.0)
    pieces = sample.where(F.col("part") < DICTIONARY_EIGHTHS).select("text", "good").mapInArrow(_cut, "piece binary, good int")
    pieces = materialize(pieces)
    dictionaries = []
    for good in (0, 1):
        own = pieces.where(F.col("good") == good).orderBy(F.xxhash64("piece"), "piece").limit(MAX_PIECES)
        dictionaries.append(_dictionary([bytes(r["piece"]) for r in own.select("piece").collect()]))
    model = Model(dictionaries[0], dictionaries[1], (0.0, 0.0), 0.0)
    rest = sample.where(F.col("part") >= DICTIONARY_EIGHTHS).select("text", "good")
    rows = rest.mapInArrow(_measured(model), "difference double, shortness double, good int").collect()  # max_train at most
    if not rows:
        return model
    weights, intercept = _fit(np.array([r[:2] for r in rows]), np.array([float(r["good"]) for r in rows]))
    return Model(dictionaries[0], dictionaries[1], weights, intercept)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: good likelier) of every row of ``docs``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = model.scorer()
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                found = scores(text_column(part.column(1)))
                yield pa.record_batch([part.column(0), pa.array(found)], names=["doc_id", "score"])

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows_in.mapInArrow(rows, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; all columns stay."""

    @F.pandas_udf("double")
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for text in texts:
            array = text_column(pa.array(text, pa.string(), from_pandas=True))
            parts = slices(pa.record_batch([array], names=["text"]), "text", CHUNK)
            found = [scorer(text_column(p.column(0))) for p in parts]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    return docs.where(scores(F.col("text")) >= threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
