"""Operator 9: WARC archives, written record by record and read by byte range.

Writing: the digest of every payload is worked out first; of records with
equal payloads the one with the largest id becomes a response, the others
revisit it. Only pages that may be revisits, by a Bloom filter, are shuffled. Each record is a gzip member of its own, so archives can be split
anywhere. Records go to files of the shared folder; a manifest that Spark
commits names the files.

Reading: every archive is cut into byte ranges. A task looks for the gzip
magic in its range, takes a place for a record only if the member there
decodes to a WARC header and its checksum holds, and owns the records that
start inside its range, reading past its end for the last one. Within a range
a record's end is the next one's beginning. Memory holds one record.

Defined results: a null payload is an empty one; equal payloads below
``revisit_from`` bytes are all responses; a null id is smaller than any, so such
a page revisits the equal one with the largest id, and equal pages that all lack
an id are responses; rows that share an id are separate records, and those with
the largest id of their payload are all responses, to which the others refer by
that id; an empty table gives no files and no rows; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackledger.llm.bloom import members, tested, words_for
from trackledger.llm.store import Folder, open_input
from trackledger.session import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
FILE_BYTES = 512 << 20
SPLIT_BYTES = 32 << 20
BLOCK = 1 << 20
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: WARC header, HTTP header and, for a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{_digest(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(body))),
    ]
    if refers_to is not None:
        fields[3:3] = [
            ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def _writer(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, out, path, size, records, done = None, None, "", 0, 0, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in range(4))):
                if out is None:
                    target = target or Folder(folder)
                    path, out = target.new(".warc.gz")
                member = _record(
                    page_id.as_py(), url.as_py(), (html.as_py() or "").encode(), refers_to.as_py()
                )
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= file_bytes:
                    out.close()
                    done.append((path, size, records))
                    out, size, records = None, 0, 0
        if out is not None:
            out.close()
            done.append((path, size, records))
        if done:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))]
            yield pa.record_batch([pa.array(c) for c in columns], names=["path", "length", "records"])

    return write


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) below ``folder``; the manifest: path, length, records."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    digests = materialize(
        rows.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n"))
    )
    # Only payloads that are there twice have anything to refer to.
    groups = materialize(
        digests.where(F.col("n") >= revisit_from)
        .groupBy("digest", "n")
        .agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    referring = (
        digests.join(groups, ["digest", "n"])
        .where(F.col("last").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("last"))))
        .select(F.col("page_id").alias("_id"), F.col("last").alias("refers_to"), F.col("digest").alias("_copy"))
    )
    referring = materialize(referring.distinct())
    # Pages that a filter of the revisits excludes are written where they are read; only the others move.
    words = words_for(referring.count())
    found = members(referring.select(F.xxhash64("_id", "_copy").alias("hash")), "hash", words)
    marked = rows.withColumn("_digest", F.sha1(payload))
    marked = tested(marked, F.xxhash64("page_id", "_digest"), found, words, "_maybe")
    clear = marked.where("NOT _maybe").withColumn("refers_to", F.lit(None).cast("long"))
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_copy"))
    suspects = marked.where("_maybe").join(referring, same, "left")
    columns = ["page_id", "url", "html", "refers_to"]
    return materialize(
        clear.select(*columns).unionByName(suspects.select(*columns)).mapInArrow(
            _writer(folder, file_bytes), "path string, length long, records long"
        )
    )


def archives(spark: SparkSession, path: str) -> DataFrame:
    """path and length of the archives below a folder; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", "length")


class _Members:
    """Gzip members of an archive, from any byte on."""

    def __init__(self, file, length: int):
        self._file, self._length = file, length

    def read(self, at: int, count: int) -> bytes:
        return self._file.read_at(min(count, max(0, self._length - at)), at)

    def member(self, at: int) -> tuple[bytes, int] | None:
        """(record, place behind it) if a whole WARC record's member starts at ``at``."""
        unpack, parts, place = zlib.decompressobj(31), [], at
        checked = False
        try:
            while not unpack.eof:
                block = self.read(place, BLOCK if checked else 4096)
                if not block:
                    return None
                place += len(block)
                parts.append(unpack.decompress(block))
                if not checked and (head := b"".join(parts))[: len(VERSION)]:
                    if not VERSION.startswith(head[: len(VERSION)]):
                        return None
                    checked = len(head) >= len(VERSION)
        except zlib.error:
            return None
        return b"".join(parts), place - len(unpack.unused_data)

    def records(self, start: int, end: int) -> Iterator[bytes]:
        """Records whose member starts in ``[start, end)``."""
        at = start
        while at < end:
            found = self.member(at) if self.read(at, 3) == MAGIC else None
            if found:
                record, at = found
                yield record
            else:
                at = self._next_magic(at + 1, end)

    def _next_magic(self, at: int, end: int) -> int:
        while at < end:
            block = self.read(at, BLOCK + 2)
            place = block.find(MAGIC)
            if place >= 0:
                return at + place
            at += BLOCK
        return end


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}


def parse_record(record: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _headers(head)
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, _headers(http), payload


def _number(urn: str) -> int | None:
    value = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(value) if value else None


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            found = []
            for record in _Members(open_input(row["path"]), row["length"]).records(row["start"], row["end"]):
                fields, http, payload = parse_record(record)
                digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
                if kind == "response" and _digest(payload) != digest:
                    raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
                size = len(payload) if kind == "response" else int(http["content-length"])
                refers_to = _number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None
                found.append((_number(fields["warc-record-id"]), size, digest, kind, refers_to))
            if found:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
                yield pa.record_batch(columns, names=[f.split()[0] for f in RECORDS.split(", ")])


def read_records(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Records of the archives listed in ``files`` (path, length), split by byte range."""
    total = files.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, files.sparkSession.sparkContext.defaultParallelism, math.ceil(total / split_bytes))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(split_bytes)))
    ranges = files.select("path", "length", starts.alias("start")).withColumn(
        "end", F.least(F.col("start") + split_bytes, F.col("length"))
    )
    # The rows are tiny and the work behind them is not: one range to a task.
    return ranges.repartition(tasks).mapInArrow(_ranges, RECORDS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: every page as the archives give it back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return read_records(write_archives(pages, scratch_path(spark, "warc")), split_bytes=8 << 20)


SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
  FROM pages
)
SELECT page_id,
  cast(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    cast(((cast('0x' || substr(sha1(payload), cast(k // 4 * 5 + 1 AS INT), 5) AS INT) >> (15 - 5 * cast(k % 4 AS INT))) & 31) + 1 AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to
FROM payloads
"""
