"""Operator 5: byte-level BPE encoding and decoding by a rank file.

Texts are cut into the pattern's words on whole chunks of bytes; a chunk then
is one row with its distinct words as byte arrays and a code per place. A word
that is a piece itself has that piece's id. For all others Spark higher-order
functions fold the ranked merges over the byte arrays: every step joins the
adjacent pair of lowest rank, the first one of equals, until no pair has a rank.
The fold carries the ranks of the pairs along, so a step looks up only the two
pairs beside the joined one. The rank map is one broadcast row of 3 MB that a
task makes: two arrays of slots (cuckoo hashing), of which a pair is in the one
or the other at its key's remainder.
Texts are never shuffled. A task folds a word once: it remembers up to ``WORDS``
words for its later chunks. Words that many tasks would fold are folded before
all others: the ``FREQUENT`` commonest ones of a sample of documents, of about
``SAMPLE`` bytes, written to the shared folder with their ids, where every task
reads them; the sample decides what is folded
when, and nothing else.

Words over ``LONG`` bytes (one step per byte makes the fold quadratic) get the
same merges from the same map with a heap.

Defined results: a null or empty text has no ids; rows keep their ``doc_id``
as it is, null or repeated; an empty table gives no rows. Other columns are
not read. Decoding concatenates the pieces of the ids; ids outside the
vocabulary raise.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.llm.store import file_system
from trackledger.llm.words import bounds, gather, pretokens, raw, release, slices, text_column
from trackledger.session import materialize, scratch_path

CHUNK = 1 << 20
LONG = 256
WORDS = 2_000_000  # that a task remembers
FREQUENT = 400_000  # words folded before all others: 10 MB with their ids
SAMPLE = 48 << 20  # bytes of text they are looked for in
BYTES = LONG  # no slice of a folded word is longer
NONE = 1 << 16
RANK_SHIFT = 28  # of an entry of the fold; the bits between the id and the rank hold the start
#: Primes; a third of the slots is used by a map of 50,000 pieces.
SLOTS = (149_993, 150_011)
MAP = ("map_one", "map_two", "map_doubles", "map_first")  # columns of the rank map

CHUNKS = (
    "doc_ids array<long>, firsts binary, codes binary, n_codes long, base long, counts binary, ids binary, "
    "numbers binary, words array<array<short>>, long_words binary"
)


class Ranks:
    """A rank file: pieces by id, and the map of pairs to joined pieces.

    A worker makes and keeps only the tables that it uses: the first of a chunk's
    two needs ``arrow``, the second the pieces and decimals, and the map is for
    the broadcast row and for long words.
    """

    def __init__(self, path: str):
        ids = self._read(path)
        pieces = [b""] * (max(ids.values()) + 1)
        for piece, rank in ids.items():
            pieces[rank] = piece
        if len(pieces) > NONE:
            raise ValueError(f"the rank map holds at most {NONE} pieces")
        self.path = path
        self.arrow = pa.array(pieces, pa.binary())

    @staticmethod
    def _read(path: str) -> dict[bytes, int]:
        with open(path, "rb") as lines:
            parts = (line.split() for line in lines if line.strip())
            return {base64.b64decode(piece): int(rank) for piece, rank in parts}

    @functools.cached_property
    def pieces(self) -> list[bytes]:
        return self.arrow.to_pylist()

    @functools.cached_property
    def piece_array(self) -> np.ndarray:
        return np.array(self.pieces, dtype=object)

    @functools.cached_property
    def decimals(self) -> np.ndarray:
        return np.array([str(k) for k in range(len(self.arrow))], dtype=object)

    @functools.cached_property
    def ids(self) -> dict[bytes, int]:
        return self._read(self.path)

    @functools.cached_property
    def bytes(self) -> list[int]:
        return [self.ids[bytes([b])] for b in range(256)]

    @functools.cached_property
    def slots(self) -> list[list[int]]:
        """Every pair of pieces whose bytes are a piece, in one of its two slots."""
        slots = [[-1] * size for size in SLOTS]
        for piece, rank in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    self._put(slots, (left * NONE + right) * NONE + rank)
        return slots

    @staticmethod
    def _put(slots: list[list[int]], entry: int) -> None:
        for turn in range(200):
            side = turn % 2
            place = entry // NONE % SLOTS[side]
            entry, slots[side][place] = slots[side][place], entry
            if entry < 0:
                return
        raise ValueError("the rank file has too many pairs for the slots")

    def join(self, left: int, right: int) -> int:
        """Rank of two adjacent pieces, NONE where they don't join."""
        key = left * NONE + right
        for slots, size in zip(self.slots, SLOTS):
            if slots[key % size] // NONE == key:
                return slots[key % size] % NONE
        return NONE

    def doubles(self) -> list[int]:
        """Rank of each pair of bytes, at 256 times the first plus the second."""
        return [self.join(a, b) for a in self.bytes for b in self.bytes]

    def merged(self, word: bytes) -> list[int]:
        """The merges of one long word, by a heap over its places."""
        piece = [self.bytes[b] for b in word]
        after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
        heap = [(self.join(a, b), k) for k, (a, b) in enumerate(zip(piece, piece[1:]))]
        heapq.heapify(heap)
        while heap and heap[0][0] < NONE:
            rank, at = heapq.heappop(heap)
            right = after[at] if piece[at] >= 0 else len(piece)
            if right >= len(piece) or self.join(piece[at], piece[right]) != rank:
                continue  # one of the two has been joined meanwhile
            piece[at], piece[right], after[at] = rank, -1, after[right]
            if after[at] < len(piece):
                before[after[at]] = at
                heapq.heappush(heap, (self.join(rank, piece[after[at]]), at))
            if before[at] >= 0:
                heapq.heappush(heap, (self.join(piece[before[at]], rank), before[at]))
        return [p for p in piece if p >= 0]


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> Ranks:
    return Ranks(path)


def _map_row(path: str):
    def row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = Ranks(path)
            arrays = (*table.slots, table.doubles(), table.bytes)
            yield pa.record_batch([pa.array([x], pa.list_(pa.int64())) for x in arrays], names=list(MAP))
            del table, arrays
        release()

    return row


def with_map(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with the columns ``MAP``, as ``merge_words`` needs them: one row for all, of a size that the rank file bounds."""
    one = rows.sparkSession.range(0, 1, 1, 1).mapInArrow(_map_row(path), ", ".join(f"{c} array<long>" for c in MAP))
    return rows.crossJoin(F.broadcast(one))


def merge_words(words: Column) -> Column:
    """Ids of each byte array (array of arrays) of ``with_map``: the fold over ranked merges.

    The fold's state is one array of numbers, an entry for each piece: the rank
    of the pair that it begins, where it starts in the word, and its id. The
    smallest entry is the leftmost pair of lowest rank. An edge that joins
    nothing stands before and after the word, so all neighbours exist.
    """
    one, two, doubles, first = (F.col(c) for c in MAP)
    unjoined = NONE << RANK_SHIFT
    before, after = (F.array(F.lit(unjoined + (k << 16) + NONE - 1).cast("long")) for k in (0, 4095))

    def key(left: Column, right: Column) -> Column:
        return F.shiftleft(left, 16).bitwiseOR(right)

    def rank(key: Column) -> Column:
        """The rank of a key's two ids, shifted to its place in an entry."""
        found = [F.get(slots, (key % size).cast("int")) for slots, size in zip((one, two), SLOTS)]
        low = [F.shiftleft(x.bitwiseAND(F.lit(NONE - 1)), RANK_SHIFT) for x in found]
        hit = F.when(F.shiftright(found[0], 16) == key, low[0]).when(F.shiftright(found[1], 16) == key, low[1])
        return hit.otherwise(F.lit(unjoined))

    def number(entry: Column) -> Column:
        return entry.bitwiseAND(F.lit(NONE - 1).cast("long"))

    def below(entry: Column, bits: int) -> Column:
        return entry.bitwiseAND(F.lit((1 << bits) - 1).cast("long"))

    # A fold over one value names it, so that it is worked out once.
    def step(now: Column, _: Column) -> Column:
        return F.aggregate(F.array(F.array_min(now)), now, joined)

    def joined(now: Column, best: Column) -> Column:
        def at(now: Column, place: Column) -> Column:
            piece = F.shiftright(best, RANK_SHIFT)
            left, right = F.get(now, place - 2), F.get(now, place + 1)
            start = below(best, RANK_SHIFT) - number(best)
            two = F.zip_with(
                F.array(key(number(left), piece), key(piece, number(right))),
                F.array(below(left, RANK_SHIFT), start.bitwiseOR(piece)),
                lambda pair, low: rank(pair).bitwiseOR(low),
            )
            return F.concat(F.slice(now, F.lit(1), place - 2), two, F.slice(now, place + 2, BYTES + 2))

        # Starts ascend. array_position() would leave its loop by an exception, which costs more.
        place = F.size(F.filter(now, lambda entry: below(entry, RANK_SHIFT) <= below(best, RANK_SHIFT)))
        return F.when(best >= unjoined, now).otherwise(F.aggregate(F.array(place), now, at))

    def start(word: Column) -> Column:
        # get() counts from 0: a byte is its own position.
        def entry(b: Column, k: Column) -> Column:
            pair = F.get(doubles, b.cast("int") * 256 + F.get(word, k + 1).cast("int"))
            low = F.shiftleft((k + 1).cast("long"), 16).bitwiseOR(F.get(first, b.cast("int")))
            return F.shiftleft(F.coalesce(pair, F.lit(NONE).cast("long")), RANK_SHIFT).bitwiseOR(low)

        entries = F.transform(word, entry)
        return F.concat(before, entries, after)

    def fold(word: Column) -> Column:
        # A word of n bytes has n - 1 merges at most; further steps change nothing.
        return F.aggregate(
            F.sequence(F.lit(2), F.size(word)),
            start(word),
            step,
            lambda end: F.transform(F.slice(end, F.lit(2), F.size(end) - 2), number),
        )

    return F.transform(words, fold)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


class Folded:
    """Words that are folded already, in the order of their hashes, with the ids of each."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        word, hashed, ids = (table.column(c).combine_chunks() if table.num_rows else None for c in ("word", "hash", "ids"))
        self.words = word
        self.hashes = np.asarray(hashed).view(np.uint64) if table.num_rows else np.zeros(0, np.uint64)
        self.starts = np.asarray(ids.offsets)[:-1] if table.num_rows else np.zeros(0, np.int32)
        self.counts = np.asarray(pc.list_value_length(ids)).astype(np.uint16) if table.num_rows else np.zeros(0, np.uint16)
        self.ids = np.asarray(ids.values).astype(np.uint16) if table.num_rows else np.zeros(0, np.uint16)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, 0 where it isn't here; the ids of those that are)."""
        counts = np.zeros(len(words), np.int64)
        if not len(self.hashes):
            return counts, self.ids[:0]
        hashes = _hashes(words)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        maybe = np.flatnonzero(self.hashes[at] == hashes)
        same = pc.equal(words.take(pa.array(maybe)), self.words.take(pa.array(at[maybe])))
        found = maybe[np.asarray(same)]
        counts[found] = self.counts[at[found]]
        return counts, gather(self.ids, self.starts[at[found]], counts[found])


@functools.lru_cache(maxsize=1)
def _load(folder: str | None) -> Folded:
    """The words that ``frequent`` has written; at most ``FREQUENT``, none without a folder."""
    schema = pa.schema([("word", pa.binary()), ("hash", pa.uint64()), ("ids", pa.list_(pa.int32()))])
    if folder is None:
        return Folded(schema.empty_table())
    system, path = file_system(folder)
    files = [f.path for f in system.get_file_info(pafs.FileSelector(path)) if f.base_name.startswith("part-")]
    tables = [pq.read_table(f, filesystem=system).cast(schema, safe=False) for f in sorted(files)]
    return Folded(pa.concat_tables([schema.empty_table(), *tables]).sort_by("hash"))


def _byte_arrays(words: pa.Array) -> pa.Array:
    """Words as arrays of their bytes."""
    data, at = raw(words.cast(pa.large_binary()))
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(data.astype(np.int16)))


def _missing(path: str):
    """Words of texts that are no pieces, and that the fold is for, with how often they are there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                words, _ = pretokens(text_column(part.column(0)))
                counted = words.value_counts()
                word, n = counted.field(0), counted.field(1)
                fits = pc.less_equal(pc.binary_length(word), LONG)
                wanted = pc.and_(pc.invert(pc.is_in(word, value_set=ranks(path).arrow)), fits)
                yield pa.record_batch([word.filter(wanted), n.filter(wanted)], names=["word", "n"])

    return rows


def _folding_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            words = batch.column(0).slice(start, 4096)
            ends = pa.array([0, len(words)], pa.int32())
            arrays = _byte_arrays(words)
            yield pa.record_batch(
                [pa.ListArray.from_arrays(ends, words.cast(pa.binary())), pa.ListArray.from_arrays(ends, arrays)],
                names=["words", "arrays"],
            )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0)
        hashes = pa.array(_hashes(words).view(np.int64))
        yield pa.record_batch([words, hashes, batch.column(1)], names=["word", "hash", "ids"])


def frequent(docs: DataFrame, path: str, count: int = FREQUENT, sample: int = SAMPLE) -> str:
    """The commonest words of a sample of ``docs`` (text), folded: a folder of the shared one with their ids."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    part = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(1 + total // sample)) == 0)
    words = part.mapInArrow(_missing(path), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    best = materialize(words.orderBy(F.desc("n"), "word").limit(count).select("word"))
    rows = best.repartition(max(1, docs.sparkSession.sparkContext.defaultParallelism)).mapInArrow(
        _folding_rows, "words array<binary>, arrays array<array<short>>"
    )
    merged = merge_words(F.col("arrays")).cast("array<array<int>>")
    found = materialize(with_map(rows, path).select(F.explode(F.arrays_zip("words", merged.alias("ids"))).alias("w")).select("w.words", "w.ids"))
    folder = scratch_path(docs.sparkSession, "words")
    found.mapInArrow(_hashed, "word binary, hash long, ids array<int>").coalesce(1).write.parquet(folder)
    return folder


def _chunks(path: str, folder: str | None, remembered: int):
    """Rows of ``CHUNKS``; ``codes`` count the chunk's distinct words, from 0.

    ``counts`` says how many ids each of these has, 0 where they are not known
    yet, and ``ids`` are the known ones. The others have ``numbers``: words that
    the task has met, counted from 0. Those from ``base`` on are new; they follow
    as ``words`` to fold and ``long_words``. A task that has met more than
    ``remembered`` words forgets them (``base`` 0 again).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[bytes, int] = {}
        folded = _load(folder)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                words, first = pretokens(text_column(part.column(1)))
                coded = words.dictionary_encode()
                piece = np.asarray(pc.fill_null(pc.index_in(coded.dictionary, value_set=ranks(path).arrow), -1)).astype(np.int32)
                counts, cached = folded.of(coded.dictionary)
                counts[piece >= 0] = 0  # no word is in both
                ids = np.empty(int(counts.sum() + (piece >= 0).sum()), np.int32)
                place = np.repeat(piece >= 0, np.where(piece >= 0, 1, counts))
                ids[place], ids[~place] = piece[piece >= 0], cached
                counts[piece >= 0] = 1
                if len(met) > remembered:
                    met = {}
                base, rest = len(met), coded.dictionary.filter(pa.array(counts == 0))
                number = np.array([met.setdefault(w, len(met)) for w in rest.to_pylist()], np.int32)
                new = rest.filter(pa.array(number >= base, pa.bool_()))
                data, at = raw(new.cast(pa.large_binary()))
                sizes = np.diff(at)
                # Long words travel as bytes: their place among the new ones, length and text.
                packed = b"".join(
                    np.array([k, sizes[k]], "<i8").tobytes() + data[at[k] : at[k + 1]].tobytes()
                    for k in np.flatnonzero(sizes > LONG)
                )
                short = _byte_arrays(new.filter(pa.array(sizes <= LONG)))
                codes = np.asarray(coded.indices).astype("<i4")
                yield pa.record_batch(
                    [
                        pa.array([part.column(0)], pa.list_(pa.int64())),
                        pa.array([first.astype("<i8").tobytes()], pa.binary()),
                        pa.array([pa.compress(codes.tobytes(), "lz4", asbytes=True)], pa.binary()),
                        pa.array([len(codes)], pa.int64()),
                        pa.array([base], pa.int64()),
                        pa.array([counts.astype("<i4").tobytes()], pa.binary()),
                        pa.array([ids.astype("<i4").tobytes()], pa.binary()),
                        pa.array([number.astype("<i4").tobytes()], pa.binary()),
                        pa.ListArray.from_arrays(pa.array([0, len(short)], pa.int32()), short),
                        pa.array([packed], pa.binary()),
                    ],
                    names=[f.split()[0] for f in CHUNKS.split(", ")],
                )
        met = {}
        release()

    return cut


def _unpack(packed: bytes) -> Iterator[tuple[int, bytes]]:
    at = 0
    while at < len(packed):
        number, size = np.frombuffer(packed, "<i8", 2, at).tolist()
        yield number, packed[at + 16 : at + 16 + size]
        at += 16 + size


def _new_ids(path: str, word_ids: pa.ListArray, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each) of a chunk's new words: folded ones, long ones by the heap."""
    long = {number: ranks(path).merged(word) for number, word in _unpack(packed)}
    counts = np.full(len(word_ids) + len(long), -1, np.int64)
    for number, found in long.items():
        counts[number] = len(found)
    folded = counts < 0
    counts[folded] = np.diff(np.asarray(word_ids.offsets))
    starts = bounds(counts)[:-1]
    ids = np.empty(counts.sum(), np.int32)
    ids[gather(np.arange(len(ids)), starts[folded], counts[folded])] = np.asarray(word_ids.flatten())
    for number, found in long.items():
        ids[starts[number] : starts[number] + len(found)] = found
    return ids, counts


def _encoded(path: str, finish):
    """Per chunk: ids of its distinct words, from the chunk and from what its task has met, then ``finish``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met_ids, met_counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, word_ids = (batch.column(c).slice(row, 1).flatten() for c in (0, 8))
                firsts, codes, n_codes, base, counts, known, number, packed = (
                    batch.column(c)[row].as_py() for c in (1, 2, 3, 4, 5, 6, 7, 9)
                )
                if base == 0:
                    met_ids, met_counts = met_ids[:0], met_counts[:0]
                if base != len(met_counts):
                    raise ValueError("chunks of a task came out of order")
                new = _new_ids(path, word_ids, packed)
                met_ids, met_counts = np.concatenate([met_ids, new[0]]), np.concatenate([met_counts, new[1]])
                counts, number = np.frombuffer(counts, "<i4").astype(np.int64), np.frombuffer(number, "<i4")
                there = counts > 0
                counts[~there] = met_counts[number]
                starts = bounds(counts)[:-1]
                ids = np.empty(counts.sum(), np.int32)
                ids[gather(np.arange(len(ids)), starts[there], counts[there])] = np.frombuffer(known, "<i4")
                own = gather(met_ids, bounds(met_counts)[:-1][number], met_counts[number])
                ids[gather(np.arange(len(ids)), starts[~there], counts[~there])] = own
                codes = np.frombuffer(pa.decompress(codes, 4 * n_codes, "lz4"), "<i4")
                yield finish(doc_ids, np.frombuffer(firsts, "<i8"), codes, ids, counts)
        release()

    return encode


def encode(
    docs: DataFrame, path: str, finish, schema: str, remembered: int = WORDS, first: int = FREQUENT
) -> DataFrame:
    """Encode ``docs`` (doc_id, text); ``finish`` makes the rows of a chunk.

    ``first`` is the number of words folded before all others.

    ``finish(doc_ids, firsts, codes, ids, counts)`` gets the chunk's documents,
    the place of each one's first word, the word number per place, and the ids
    of the chunk's distinct words with their number per word.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    folder = frequent(docs, path, first) if first else None
    chunks = docs.mapInArrow(_chunks(path, folder, remembered), CHUNKS)
    merged = merge_words(F.col("words")).cast("array<array<int>>").alias("words")
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    return with_map(chunks, path).select(*[merged if n == "words" else n for n in names]).mapInArrow(_encoded(path, finish), schema)


def _id_rows(doc_ids, firsts, codes, ids, counts) -> pa.RecordBatch:
    places = counts[codes]
    flat = gather(ids, bounds(counts)[:-1][codes], places)
    ends = bounds(places)[firsts]
    return pa.record_batch(
        [doc_ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))],
        names=["doc_id", "ids"],
    )


def encode_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of every document."""
    return encode(docs, path, _id_rows, "doc_id long, ids array<int>")


def decode_ids(table: Ranks, ids: np.ndarray) -> bytes:
    """The concatenated pieces of one run of ids."""
    if len(ids) and ids.min() < 0:
        raise ValueError("id outside the vocabulary")
    return b"".join(table.piece_array[ids].tolist())


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of (doc_id, ids); null ids give a null text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks(path)
        for batch in batches:
            runs = (None if x is None else np.array(x, np.int64) for x in batch.column(1).to_pylist())
            texts = [None if x is None else decode_ids(table, x).decode("utf-8", "replace") for x in runs]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(rows, "doc_id long, text string")


def _digests(path: str):
    def finish(doc_ids, firsts, codes, ids, counts) -> pa.RecordBatch:
        table, starts = ranks(path), bounds(counts)[:-1]
        # One document at a time: the ids of a chunk are never held flat at once.
        n_tokens, id_sums, text_sums = [], [], []
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            own = codes[a:b]
            flat = gather(ids, starts[own], counts[own])
            n_tokens.append(len(flat))
            id_sums.append(hashlib.sha256(" ".join(table.decimals[flat].tolist()).encode()).hexdigest())
            text_sums.append(hashlib.sha256(decode_ids(table, flat)).hexdigest())
        return pa.record_batch(
            [doc_ids, pa.array(n_tokens, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return finish


def digests(docs: DataFrame, path: str | None = None, first: int = FREQUENT) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of ``docs``; ``first`` as in ``encode``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode(docs, path, _digests(path), schema, first=first)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5: ids of every document and the text decoded from them, as digests."""
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
