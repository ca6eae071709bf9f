"""Operator 10: token ids as Arrow files of equal-length sequences.

``write_sequences`` orders documents by id, encodes each whole text with the
tokenizers library, appends an end id and writes the ids one after another as
Arrow IPC files. A sequence file holds record batches of two fixed-size-list
columns, ``ids`` (unsigned 16 or 32 bits) and ``mask`` (false on the padding
that ends the file), so a reader maps it and takes sequence k without decoding
or copying. An index file beside it holds ``doc_id, start, n_tokens`` per
document, ``start`` counted from the beginning of the sequence file.

Documents are dealt by ranges of ``doc_id``, so every file holds one range and
no task holds more than a range. The manifest, one row per file, gives the
order of files; the ids before a file are the running total of the manifest.

Defined results: a null or empty text has the end id alone; a null ``doc_id``
comes first; rows that share a ``doc_id`` are ordered by text and each keeps
its place; an empty table gives an empty manifest and no documents. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackledger.llm.store import Folder, open_input
from trackledger.llm.words import bounds, gather, pretokens, slices, text_column
from trackledger.session import materialize, scratch_path

SEQUENCE = 2048
BATCH = 256
CHUNK = 16 << 20
CACHED_WORDS = 300_000
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, n_docs long, n_tokens long, sequences string, documents string"


class WordEncoder:
    """Ids of words by a byte-level BPE file of the tokenizers library.

    Every word of the pattern is encoded apart from its neighbours, so each
    distinct word of a chunk is encoded once. At most ``CACHED_WORDS`` words
    are kept from chunk to chunk.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        self.size = tokenizer.get_vocab_size()
        self._model = tokenizer.model
        self._whole = tokenizer
        self._added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._signs = _byte_signs(level)
        self._known: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> list[bytes]:
        known, tokenize, signs = self._known, self._model.tokenize, self._signs
        if len(known) > CACHED_WORDS:
            known.clear()
        found = []
        for word in words:
            ids = known.get(word)
            if ids is None:
                spelled = word.decode("latin-1").translate(signs)
                ids = np.array([t.id for t in tokenize(spelled)], dtype="<u4").tobytes()
                known[word] = ids
            found.append(ids)
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, ids per text); texts that hold an added token are encoded by the library."""
        ids, counts = self._by_words(texts)
        marked = np.zeros(len(texts), dtype=bool)
        for token in self._added:
            marked |= np.asarray(pc.match_substring(texts, token).fill_null(False))
        if not marked.any():
            return ids, counts
        parts = np.split(ids, bounds(counts)[1:-1])
        for k in np.flatnonzero(marked):
            own = texts[int(k)].as_py()
            own = own.decode() if isinstance(own, bytes) else own
            parts[k] = np.array(self._whole.encode(own, add_special_tokens=False).ids, dtype="<u4")
        return np.concatenate(parts), np.array([len(x) for x in parts], dtype=np.int64)

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        words, first = pretokens(texts)
        coded = words.dictionary_encode()
        found = self._encode(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        codes = np.asarray(coded.indices)
        counts = lengths[codes]
        return gather(ids, bounds(lengths)[:-1][codes], counts), np.diff(bounds(counts)[first])


def _byte_signs(level) -> dict[int, str]:
    """The sign that stands for each byte, asked from the library."""
    leads = [0x800, *range(0x1000, 0x10000, 0x1000), 0x10000, *range(0x40000, 0x110000, 0x40000)]
    signs = {}
    for point in (*range(0x800), *leads):
        signs.update(zip(chr(point).encode(), level.pre_tokenize_str(chr(point))[0][0]))
    return signs


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class _SequenceFile:
    """One open pair of files: sequences and the documents in them."""

    def __init__(self, folder: Folder, kind: pa.DataType, length: int, pad: int):
        self.kind, self.length, self.pad = kind, length, pad
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sequences, self._to = folder.new(".sequences.arrow")
        self._writer = pa.ipc.new_file(self._to, self.schema)
        self.documents, self._index_to = folder.new(".documents.arrow")
        self._index = pa.ipc.new_file(self._index_to, INDEX)
        self._left = np.zeros(0, dtype=kind.to_pandas_dtype())
        self.n_docs = self.n_tokens = 0

    def _put(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        rows = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(ids, self.kind), mask)]
        self._writer.write_batch(pa.record_batch(rows, schema=self.schema))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        start = self.n_tokens + bounds(counts)
        index = [doc_ids, pa.array(start[:-1]), pa.array(counts)]
        self._index.write_batch(pa.record_batch(index, schema=INDEX))
        self.n_docs += len(counts)
        self.n_tokens = int(start[-1])
        left = np.concatenate([self._left, ids.astype(self._left.dtype)])
        step = self.length * BATCH
        whole = len(left) // step * step
        for at in range(0, whole, step):
            self._put(left[at : at + step], step)
        self._left = left[whole:]

    def close(self) -> None:
        real = len(self._left)
        if real:
            short = -real % self.length
            self._put(np.concatenate([self._left, np.full(short, self.pad, self._left.dtype)]), real)
        for x in (self._writer, self._to, self._index, self._index_to):
            x.close()


def _writer(folder: str, tokenizer: str, end_id: int, length: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                encode = word_encoder(tokenizer)
                kind = pa.uint16() if max(encode.size, end_id + 1) <= 1 << 16 else pa.uint32()
                if out is None:
                    out = _SequenceFile(Folder(folder), kind, length, end_id)
                ids, counts = encode(text_column(part.column(1)))
                # The end id goes behind the last id of every document.
                ids = np.insert(ids, np.cumsum(counts), end_id)
                out.add(part.column(0), ids, counts + 1)
        if out is not None:
            out.close()
            row = [TaskContext.get().partitionId(), out.n_docs, out.n_tokens, out.sequences, out.documents]
            names = ["part", "n_docs", "n_tokens", "sequences", "documents"]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return write


def write_sequences(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, length: int = SEQUENCE
) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``folder``; returns the committed manifest.

    Manifest: part, n_docs, n_tokens, first (ids in the files before), and the
    addresses ``sequences`` and ``documents``.
    """
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    manifest = materialize(ordered.mapInArrow(_writer(folder, tokenizer, end_id, length), MANIFEST))
    # One row per file: the running total needs no more than the list of files.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class SequenceReader:
    """Random access to one file: sequence k, or ids from any place."""

    def __init__(self, uri: str):
        self._file = pa.ipc.open_file(open_input(uri))
        self.length = self._file.schema.field("ids").type.list_size
        self.rows = self._file.num_record_batches
        self._at, self._batch = -1, None

    def batch(self, number: int) -> pa.RecordBatch:
        if number != self._at:
            self._at, self._batch = number, self._file.get_batch(number)
        return self._batch

    def sequence(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of one sequence; the ids are a view of the file's buffer."""
        batch, row = self.batch(number // BATCH), number % BATCH
        ids, mask = (batch.column(c).slice(row, 1).flatten() for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask.to_numpy(zero_copy_only=False)

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views of the ids from ``start``, batch by batch."""
        step = self.length * BATCH
        while count > 0:
            number, skip = divmod(start, step)
            values = self.batch(number).column(0).flatten().to_numpy(zero_copy_only=True)
            view = values[skip : skip + count]
            yield view
            start, count = start + len(view), count - len(view)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            reader = SequenceReader(row["sequences"])
            index = pa.ipc.open_file(open_input(row["documents"]))
            for number in range(index.num_record_batches):
                found = index.get_batch(number)
                starts, counts = (np.asarray(found.column(c)) for c in (1, 2))
                sums = []
                for start, count in zip(starts.tolist(), counts.tolist()):
                    crc = 0
                    for view in reader.ids(start, count):
                        crc = zlib.crc32(view.astype("<u4").tobytes(), crc)
                    sums.append(crc)
                yield pa.record_batch(
                    [found.column(0), pa.array(starts + row["first"]), found.column(2), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the checksum of the ids, from the files.

    The manifest's rows are small, so they are dealt one file to a task.
    """
    files = max(1, manifest.count())
    return manifest.select("first", "sequences", "documents").repartition(files, "sequences").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the ids of every document, from the files they were written to."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "sequences")
    return read_documents(write_sequences(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), 2))
