"""Array helpers that the Arrow-batch operators of this subpackage share.

Everything here works on one bounded chunk of texts at a time: the UTF-8
bytes of a few thousand documents as one array, their words as start and end
offsets, and a 64-bit hash per word.  No Python loop runs over characters or
words, so a chunk costs a handful of numpy passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a chunk of its own.
CHUNK_BYTES = 4 << 20

_U = np.uint64


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64 finalizer)."""
    with np.errstate(over="ignore"):
        x = x + _U((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


#: Bytes that belong to a word: all but space and 0x09-0x0D.
NON_SPACE = bytes(0 if b == 0x20 or 0x09 <= b <= 0x0D else 1 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Keeps the first 0 to 8 bytes of a little-endian 64-bit load.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], _U)


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one large_string array, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return pc.fill_null(column.cast(pa.large_string()), "")


def flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one array."""
    if isinstance(column, pa.ChunkedArray):
        return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts on end, and the offset at which each begins (and the last ends)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of the batches whose texts hold at most ``limit`` bytes (one row at least)."""
    for batch in batches:
        texts = text_array(batch.column(batch.schema.get_field_index(column)))
        _, offsets = text_bytes(texts)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, end - at), texts.slice(at, end - at)
            at = end


def words(data: np.ndarray, offsets: np.ndarray, is_word: bytes = NON_SPACE,
          lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that lie inside one document.

    Returns (start, end, document, hash) of each word, in text order; A-Z
    are folded before hashing if ``lower``.  The hash takes eight bytes of
    every word at a time.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U)
    raw = data.tobytes()
    mask = np.frombuffer(raw.translate(is_word), bool)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = mask & edge[:-1], mask & edge[1:]
    first[1:] |= mask[1:] & ~mask[:-1]
    first[0] |= mask[0]
    last[:-1] |= mask[:-1] & ~mask[1:]
    last[-1] |= mask[-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(start, offsets))
    document = np.repeat(np.arange(len(counts)), counts)
    loads = np.ndarray((len(raw),), "<u8", (raw.translate(_LOWER) if lower else raw) + bytes(8), strides=(1,))
    left = end - start
    value = mix64(left.astype(_U))
    todo, at = np.arange(len(start)), start
    while len(todo):
        value[todo] = mix64(value[todo] ^ (loads[at] & _KEEP[np.minimum(left, 8)]), 5)
        more = np.flatnonzero(left > 8)
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return start, end, document, value


def windows(values: np.ndarray, document: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``n`` values inside one document, and the index of its first value."""
    if len(values) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    first = np.flatnonzero(document[n - 1:] == document[:len(document) - n + 1])
    with np.errstate(over="ignore"):
        total = np.zeros(len(first), _U)
        for k in range(n):
            total = total * _U(0xD6E8FEB86659FD93) + values[first + k]
        return mix64(total, n), first


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Index at which each run of equal values begins."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position as an integer, zeros beyond the end."""
    return np.ndarray((len(data) + 16,), "<u8", data.tobytes() + bytes(24), strides=(1,))


def piece_hash(loaded: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of the ``size`` bytes from each position in ``first``."""
    value, left, at, todo = mix64(size.astype(_U), 9), size, first, np.arange(len(first))
    while len(todo):
        value[todo] = mix64(value[todo] ^ (loaded[at] & _KEEP[np.minimum(left, 8)]), 13)
        more = np.flatnonzero(left > 8)
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return value
