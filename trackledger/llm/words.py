"""Words of texts as Arrow arrays, found on whole batches of UTF-8 bytes.

``pretokens`` splits as the byte-level tokenizers' pattern does
(contractions, letters, numbers and other signs with one space before them,
white space); ``tokens`` takes runs of bytes that are not ASCII white space.
Both return slices of the batch's own bytes: nothing is copied per word, and
``dictionary_encode`` then gives the distinct words and a code per place.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3

# The code points with the White_Space property.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]


@functools.cache
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    found = (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000))
    table = np.fromiter(found, dtype=np.uint8, count=0x110000)
    table[WHITE_SPACE] = SPACE
    return table


def text_column(column: pa.Array) -> pa.Array:
    """A text column as large strings without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends)."""
    at = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or at[-1] == at[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` with about ``limit`` bytes of text, one row at least."""
    length = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    total = np.cumsum(np.asarray(length, dtype=np.int64))
    row, done = 0, 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield batch.slice(row, end - row)
        row, done = end, int(total[end - 1])


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to."""
    table = _classes()
    cls = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        b = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int32) & 0x3F for k in range(4)]
        first = data[lead].astype(np.int32)
        point = np.where(
            first < 0xE0,
            ((first & 0x1F) << 6) | b[1],
            np.where(
                first < 0xF0,
                ((first & 0x0F) << 12) | (b[1] << 6) | b[2],
                ((first & 0x07) << 18) | (b[1] << 12) | (b[2] << 6) | b[3],
            ),
        )
        kind = table[np.minimum(point, 0x10FFFF)]
        cls[lead] = kind
        for k, least in ((1, 0xC0), (2, 0xE0), (3, 0xF0)):
            longer = first >= least
            cls[lead[longer] + k] = kind[longer]
    return cls


def _contractions(data: np.ndarray, start: np.ndarray, inside: np.ndarray) -> None:
    """Cut 's 't 'm 'd 're 've 'll where a match may begin."""
    mark = np.flatnonzero(start & (data == 0x27))
    mark = mark[mark + 1 < len(data)]
    mark = mark[inside[mark + 1]]
    if not len(mark):
        return
    one = data[mark + 1]
    second = np.minimum(mark + 2, len(data) - 1)
    two = np.where((mark + 2 < len(data)) & inside[second], data[second], 0)
    short = np.isin(one, np.frombuffer(b"stmd", dtype=np.uint8))
    long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
    long |= (one == ord("l")) & (two == ord("l"))
    start[mark[short | long] + 1] = False
    after = np.concatenate([mark[short] + 2, mark[long] + 3])
    start[after[after < len(data)]] = True


def pretokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all words of all texts, number of each text's first word and the end)."""
    data, at = raw(texts)
    if not len(data):
        return pa.array([], type=pa.binary()), np.zeros(len(at), dtype=np.int64)
    cls = _byte_classes(data)
    start = np.ones(len(data), dtype=bool)
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    inside = np.ones(len(data), dtype=bool)
    inside[at[:-1][at[:-1] < len(data)]] = False
    start |= ~inside
    # The last white space before a word goes with it if it is a blank, else stands alone.
    head = np.flatnonzero(start & inside & (cls != SPACE))
    head = head[cls[head - 1] == SPACE]
    last = head - 1
    for _ in range(2):
        last = last - ((data[last] & 0xC0) == 0x80)
    start[last] = True
    start[head] = data[head - 1] != 0x20
    _contractions(data, start, inside)
    first = np.flatnonzero(start)
    offsets = np.append(first, len(data)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(first, at)


def tokens(
    texts: pa.Array, lower: bool = True, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs without ASCII white space, A-Z lower-cased.

    ``inside`` says of each of the 256 bytes whether it belongs to a run instead.
    Returns the bytes, where each run begins and ends, and the number of each
    text's first run and the end.
    """
    data, at = raw(texts)
    if lower and len(data):
        data = data + ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) * np.uint8(32)
    word = ~((data == 0x20) | ((data >= 0x09) & (data <= 0x0D))) if inside is None else inside[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    begins = np.flatnonzero(begin)
    return data, begins, np.flatnonzero(end) + 1, np.searchsorted(begins, at)


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[starts[0]:starts[0]+counts[0]], then the next, as one array."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return values[:0]
    place = np.arange(ends[-1]) - np.repeat(ends - counts, counts)
    return values[np.repeat(starts, counts) + place]


def bounds(counts: np.ndarray) -> np.ndarray:
    """0 and the running totals of ``counts``."""
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; by a sort, which for many numbers beats a hash table."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def release() -> None:
    """Give back to the system what a task no longer needs: its Python worker stays, and waits for others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)
