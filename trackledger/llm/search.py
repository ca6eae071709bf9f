"""Operator 12: ranked lexical search over bit-sliced Bloom signatures.

``build`` makes an index of all documents, whatever the queries. A document is a
column of bits; a key sets ``HASHES`` of its bits, and a key is a term together
with a step of ``STEPS``, one for every step that its occurrences reach. Up to
``COLUMNS`` documents of about as many keys make a block, stored by rows: row r
holds bit r of all its documents.

``search`` answers queries, in parts of about ``PART`` terms:

1. One pass over the texts counts the documents that hold each term of a query.
2. The rows of a key, ANDed, are the documents that may hold a term so often:
   never too few, a few too many. So many occurrences at most, times the term's
   weight, summed over the query's terms, bound every document's score from
   above. Each task keeps the ``SEEDS * k`` best bounds of a query.
3. The best of all tasks are scored exactly. The k-th of their scores is a floor:
   a document whose bound is below it, or equals it with a larger id than the
   k-th, is provably not among the k best.
4. A second pass over the blocks returns all other documents, however many, and
   these are scored exactly from their texts.

Texts move only for documents that are scored, found by a Bloom filter over
their ids. Of a part, the driver holds the queries' terms, their counts and k
scores a query.

Score of a document for a query: the sum over the query's terms, repeats
included, of w * ((1000000000 tf) div (1000 tf + 12 m)), with
w = floor(1000 ln((2 N + 2) / (2 df + 1))) and m = 75 + (25 n N) div L.

Defined results: a null or empty text, or one without terms, is no document: it
counts in no statistic and is never returned; rows that share a ``doc_id`` are
documents of their own and each can be returned; rows without ``doc_id`` count
in the statistics and are not returned, as nothing names them; rows that share
an ``item_id``, also a null one, are one query with the terms of all its rows,
repeats included; a query without terms, or whose terms no document has, gives
no rows; equal scores rank by ascending ``doc_id``. Empty tables give no rows.
Other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackledger.llm.bloom import with_ids
from trackledger.llm.words import bounds, gather, slices, text_column, tokens
from trackledger.session import materialize

TOP = 20
HASHES = 8
BITS_PER_KEY = 24
COLUMNS = 1024
KEYS = 1 << 18
SEEDS = 2
PART = 1 << 18
CHUNK = 4 << 20

#: Numbers of occurrences that have a key: all up to 8, then four to a doubling.
STEPS = np.unique(np.concatenate([np.arange(1, 9), (8 * 2 ** (np.arange(0, 120) / 4)).astype(np.int64)]))

#: Bytes of terms: ASCII digits and letters, and every byte of other characters.
TERM = np.zeros(256, dtype=bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True

_INDEX = "ids array<long>, sizes array<long>, height long, bits binary"


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(all terms of all texts, the text each lies in, number of terms of each text)."""
    data, begins, ends, first = tokens(texts, inside=TERM)
    lengths = ends - begins
    flat, offsets = gather(data, begins, lengths), bounds(lengths)
    words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    sizes = np.diff(first)
    return words, np.repeat(np.arange(len(texts)), sizes), sizes


def _counted(owner: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code, occurrences) of each pair that occurs, sorted."""
    pairs, times = np.unique(owner * width + codes, return_counts=True)
    return pairs // max(1, width), pairs % max(1, width), times


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def _keys(hashes: np.ndarray, step: np.ndarray | int) -> np.ndarray:
    """One number per term and step."""
    x = hashes + np.asarray(step).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _rows_of(keys: np.ndarray, height: int) -> np.ndarray:
    """Rows of each key's bits."""
    first, stride = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((first[:, None] + np.arange(HASHES, dtype=np.uint64) * stride[:, None]) % np.uint64(height)).astype(np.int64)


def _block(docs: list[tuple[int | None, int, np.ndarray]]) -> pa.RecordBatch:
    """Documents (id, number of terms, keys) as rows of bits."""
    height = max(64, BITS_PER_KEY * max(len(keys) for _, _, keys in docs))
    bits = np.zeros((height, -(-len(docs) // 8)), dtype=np.uint8)
    for k, (_, _, keys) in enumerate(docs):
        bits[_rows_of(keys, height).ravel(), k >> 3] |= np.uint8(1 << (k & 7))
    columns = [[[d[0] for d in docs]], [[d[1] for d in docs]], [height], [bits.tobytes()]]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary()]
    names = ["ids", "sizes", "height", "bits"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, list] = {}  # by number of keys: two bins to a doubling
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            words, owner, sizes = _words(text_column(part.column(1)))
            if not len(words):
                continue
            coded = words.dictionary_encode()
            text, code, times = _counted(owner, np.asarray(coded.indices).astype(np.int64), len(coded.dictionary))
            steps = np.searchsorted(STEPS, times, side="right")
            ends = np.cumsum(steps)
            step = np.arange(ends[-1]) - np.repeat(ends - steps, steps)
            keys = _keys(np.repeat(_hashes(coded.dictionary)[code], steps), step)
            cuts = np.append(0, ends)[np.searchsorted(text, np.arange(len(sizes) + 1))]
            for k, doc_id in enumerate(part.column(0).to_pylist()):
                own = keys[cuts[k] : cuts[k + 1]]
                if not len(own):
                    continue
                size = int(2 * math.log2(len(own)))
                docs = waiting.setdefault(size, [])
                docs.append((doc_id, int(sizes[k]), own.copy()))
                if len(docs) >= COLUMNS or sum(len(d[2]) for d in docs) >= KEYS:
                    yield _block(waiting.pop(size))
    for docs in waiting.values():
        yield _block(docs)


def build(docs: DataFrame) -> DataFrame:
    """Index of ``docs`` (doc_id, text): blocks of signatures, one row a block."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialize(rows.mapInArrow(_signatures, _INDEX))


@dataclass(frozen=True)
class Corpus:
    """Number of documents and of all their terms."""

    documents: int
    terms: int

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents of so many terms; in two parts, so that no product outgrows 64 bits early."""
        whole, rest = divmod(25 * self.documents, self.terms)
        return 75 + sizes * whole + sizes * rest // self.terms

    def saturation(self, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * times // (1000 * times + 12 * self.lengths(sizes))

    def weight(self, documents: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * documents + 1)))


def corpus(index: DataFrame) -> Corpus:
    each = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b)
    row = index.agg(F.sum(F.size("sizes")).alias("n"), F.sum(each).alias("l")).head()
    return Corpus(int(row["n"] or 0), int(row["l"] or 0))


@dataclass(frozen=True)
class Queries:
    """A part of the queries: for each the numbers of its terms and their weights."""

    vocabulary: list[bytes]
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray  # term weight times repeats in the query
    corpus: Corpus

    def __len__(self) -> int:
        return len(self.starts) - 1

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return _hashes(pa.array(self.vocabulary, pa.binary()))

    def totals(self, query: int, values: np.ndarray) -> np.ndarray:
        """Weighted sum of the rows of ``values`` that belong to the query's terms."""
        total = np.zeros(values.shape[1:], dtype=np.int64)
        for a in range(int(self.starts[query]), int(self.starts[query + 1]), 4096):
            part = slice(a, min(a + 4096, int(self.starts[query + 1])))
            total += np.tensordot(self.weights[part], values[self.terms[part]], axes=1)
        return total

    def bounds(self, sizes: np.ndarray, height: int, bits: bytes) -> np.ndarray:
        """What no score of a block's document exceeds: one row a query, one column a document."""
        columns = len(sizes)
        table = np.frombuffer(bits, dtype=np.uint8).reshape(height, -1)
        reached = np.zeros((len(self.vocabulary), columns), dtype=np.uint8)
        term, before, step = np.arange(len(self.vocabulary)), None, 0
        while len(term) and step < len(STEPS):
            rows = _rows_of(_keys(self.hashes[term], step), height)
            held = table[rows[:, 0]] if before is None else table[rows[:, 0]] & before
            for k in range(1, HASHES):
                held &= table[rows[:, k]]
            some = held.any(axis=1)
            term, before = term[some], held[some]
            reached[term] += np.unpackbits(before, axis=1, count=columns, bitorder="little")
            step += 1
        # Who reaches a step has fewer occurrences than the next one, and not more than terms.
        most = np.minimum(np.append(STEPS[1:], np.iinfo(np.int64).max)[:step, None] - 1, sizes)
        value = np.vstack([np.zeros((1, columns), dtype=np.int64), self.corpus.saturation(most, sizes)])
        values = np.take_along_axis(value, reached.astype(np.int64), axis=0)
        return np.stack([self.totals(q, values) for q in range(len(self))])


def _blocks(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, bounds) of every block, without documents that have no id."""
    for batch in batches:
        ids, sizes, heights, bits = (batch.column(k) for k in range(4))
        for k in range(batch.num_rows):
            own = ids[k].values
            named = np.asarray(own.is_valid())
            found = queries.bounds(np.asarray(sizes[k].values), heights[k].as_py(), bits[k].as_buffer())
            yield np.asarray(own.drop_null()).astype(np.int64), found[:, named]


def _pairs(query: list[np.ndarray], ids: list[np.ndarray], bound: list[np.ndarray]) -> pa.RecordBatch:
    columns = [np.concatenate(query), np.concatenate(ids), np.concatenate(bound)]
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "bound"])


def _best_bounds(queries: Queries, count: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        best = [(none, none)] * len(queries)
        for ids, found in _blocks(batches, queries):
            for q, (own_ids, own) in enumerate(best):
                least = own[-1] if len(own) == count else 1
                at = np.flatnonzero(found[q] >= least)
                if len(at):
                    own_ids, own = np.append(own_ids, ids[at]), np.append(own, found[q, at])
                    first = np.lexsort((own_ids, -own))[:count]
                    best[q] = own_ids[first], own[first]
        if any(len(own) for own, _ in best):
            number = [np.full(len(own), q) for q, (own, _) in enumerate(best)]
            yield _pairs(number, [b[0] for b in best], [b[1] for b in best])

    return rows


def _possible(queries: Queries, floor: np.ndarray, last: np.ndarray):
    """Documents that are not provably below a query's k best."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _blocks(batches, queries):
            open_ = (found > floor[:, None]) | ((found == floor[:, None]) & (ids <= last[:, None]))
            query, at = np.nonzero(open_)
            if len(query):
                yield _pairs([query], [ids[at]], [found[query, at]])

    return rows


def _holders(vocabulary: list[bytes]):
    """Number of documents with each term, per task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_binary())
        counts = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                owner, code, _ = _known(text_column(part.column(0)), known)[0]
                counts += np.bincount(code, minlength=len(counts))
        term = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(term, pa.int64()), pa.array(counts[term])], names=["term", "documents"])

    return rows


def _known(texts: pa.Array, known: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
    """((text, term, occurrences) of the known terms, number of all terms of each text)."""
    words, owner, sizes = _words(texts)
    code = pc.index_in(words, value_set=known)
    there = np.asarray(code.is_valid())
    return _counted(owner[there], np.asarray(code.drop_null()).astype(np.int64), len(known)), sizes


def _scores(queries: Queries):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(queries.vocabulary, pa.large_binary())
        values = np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                (text, term, times), sizes = _known(text_column(part.column(1)), known)
                cuts = np.searchsorted(text, np.arange(part.num_rows + 1))
                value = queries.corpus.saturation(times, sizes[text])
                query, doc, score = [], [], []
                for k, (doc_id, wanted) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist())):
                    own = slice(cuts[k], cuts[k + 1])
                    values[term[own]] = value[own]
                    query += wanted
                    doc += [doc_id] * len(wanted)
                    score += [int(queries.totals(q, values)) for q in wanted]
                    values[term[own]] = 0
                yield pa.record_batch(
                    [pa.array(query, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())],
                    names=["query", "doc_id", "score"],
                )

    return rows


def scored(docs: DataFrame, pairs: DataFrame, queries: Queries) -> DataFrame:
    """(query, doc_id, score) of all rows of the documents in ``pairs`` (query, doc_id), from their texts."""
    wanted = materialize(pairs.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set("query").alias("queries")))
    rows = with_ids(docs, wanted.select("id")).join(wanted, F.col("doc_id") == F.col("id"))
    rows = rows.select("doc_id", "text", "queries")
    return materialize(rows.mapInArrow(_scores(queries), "query long, doc_id long, score long"))


def _first(rows: DataFrame, by: str, count: int) -> DataFrame:
    """The ``count`` best rows of each query by ``by``, ties by id, with their rank."""
    order = Window.partitionBy("query").orderBy(F.desc(by), "doc_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            words, owner, _ = _words(text_column(part.column(1)))
            coded = words.dictionary_encode()
            text, code, times = _counted(owner, np.asarray(coded.indices).astype(np.int64), len(coded.dictionary))
            terms = coded.dictionary.cast(pa.binary()).take(pa.array(code))
            yield pa.record_batch(
                [part.column(0).take(pa.array(text)), terms, pa.array(times, pa.int64())],
                names=["item_id", "term", "times"],
            )


def _queries(rows: list, holders: dict[bytes, int], whole: Corpus) -> tuple[list, Queries]:
    """(item ids, queries) of rows (item_id, term, times); terms that no document has add nothing."""
    weight = {t: whole.weight(n) for t, n in holders.items()}
    rows = [r for r in rows if weight.get(bytes(r["term"]), 0) > 0]
    items = sorted({r["item_id"] for r in rows}, key=lambda i: (i is None, i))
    vocabulary = sorted({bytes(r["term"]) for r in rows})
    number = {t: k for k, t in enumerate(vocabulary)}
    place = {i: k for k, i in enumerate(items)}
    cells = sorted((place[r["item_id"]], number[bytes(r["term"])], r["times"]) for r in rows)
    query, term, times = (np.array(c, dtype=np.int64) for c in zip(*cells)) if cells else [np.zeros(0, np.int64)] * 3
    weights = times * np.array([weight[vocabulary[t]] for t in term], dtype=np.int64)
    starts = np.searchsorted(query, np.arange(len(items) + 1))
    return items, Queries(vocabulary, starts, term, weights, whole)


def _answer(docs: DataFrame, index: DataFrame, whole: Corpus, rows: list, top: int) -> tuple[list, DataFrame | None]:
    """(item ids, (query, rank, doc_id, score)) for the queries of one part."""
    vocabulary = sorted({bytes(r["term"]) for r in rows})
    held = docs.select("text").mapInArrow(_holders(vocabulary), "term long, documents long")
    held = held.groupBy("term").agg(F.sum("documents").alias("documents")).collect()  # a row a term of the part
    items, queries = _queries(rows, {vocabulary[r["term"]]: r["documents"] for r in held}, whole)
    if not items:
        return [], None
    schema = "query long, doc_id long, bound long"
    seeds = materialize(_first(index.mapInArrow(_best_bounds(queries, SEEDS * top), schema), "bound", SEEDS * top))
    best = _first(scored(docs, seeds, queries).where("score > 0"), "score", top)
    floor = np.ones(len(items), dtype=np.int64)
    last = np.full(len(items), np.iinfo(np.int64).max)
    for r in best.where(F.col("rank") == top).collect():  # a row a query
        floor[r["query"]], last[r["query"]] = r["score"], r["doc_id"]
    possible = materialize(index.mapInArrow(_possible(queries, floor, last), schema))
    return items, _first(scored(docs, possible, queries).where("score > 0"), "score", top)


def search(docs: DataFrame, index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of the ``top`` best documents for each of ``items`` (item_id, text).

    ``index`` is what ``build`` made of the same ``docs``.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = items.schema["item_id"].dataType
    schema = T.StructType().add("item_id", kind).add("rank", T.IntegerType())
    schema = schema.add("doc_id", T.LongType()).add("score", T.LongType())
    found = spark.createDataFrame([], schema)
    whole = corpus(index)
    terms = items.select("item_id", "text").mapInArrow(
        _query_terms, T.StructType().add("item_id", kind).add("term", T.BinaryType()).add("times", T.LongType())
    )
    terms = materialize(terms.groupBy("item_id", "term").agg(F.sum("times").alias("times")))
    parts = -(-terms.count() // PART) if whole.documents else 0
    for part in range(parts):
        # Whole queries by a hash: about PART rows, and one query's terms at least.
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()
        ids, best = _answer(docs, index, whole, own, top) if own else ([], None)
        if best is None:
            continue
        names = spark.createDataFrame(list(enumerate(ids)), T.StructType().add("query", T.LongType()).add("item_id", kind))
        found = found.unionByName(materialize(best.join(names, "query").select("item_id", "rank", "doc_id", "score")))
    return found


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the best documents for every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, build(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = r"""
WITH terms AS (
  SELECT row, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
),
wanted AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term
),
sizes AS (SELECT row, doc_id, count(*) AS n FROM terms GROUP BY row, doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
held AS (
  SELECT row, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM wanted) GROUP BY row, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, whole GROUP BY term, docs
),
scores AS (
  SELECT item_id, held.row, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN held USING (term) JOIN sizes ON held.row = sizes.row, whole
  GROUP BY item_id, held.row, doc_id
),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
