"""Vectorised word spans and 64-bit word hashes over Arrow string columns.

An Arrow string column is one byte buffer with row offsets. The helpers here
work on that buffer directly with numpy, so the operators that need every word
of every text never build a Python object per word. Rows are taken in blocks of
bounded bytes (one row at least), which bounds a task's memory by the block and
the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: Byte ranges beyond this are hashed by a cryptographic function.
LONG = 512
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def space_table() -> np.ndarray:
    """Byte classes: 0 for U+0020 and U+0009..U+000D, 1 for all else."""
    t = np.ones(256, np.uint8)
    t[0x20] = 0
    t[0x09:0x0E] = 0
    return t


def lower_table() -> np.ndarray:
    """Maps A-Z to a-z and leaves all other bytes."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 0x20
    return t


IDENTITY = np.arange(256, dtype=np.uint8)
SPACE = space_table()
LOWER = lower_table()


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    if len(col) == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0] : offs[-1]]
    return data, offs - offs[0]


def blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of rows of bounded bytes, one row at least."""
    data, offs = text_buffer(col)
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                p, step = np.ones(1, U64), b
                while len(p) < size:
                    p = np.concatenate([p, p * U64(step)])
                    step = step * step & _MASK
                setattr(self, name, p)


_POWERS = _Powers()


class Spans:
    """Words of a block of texts: begin, end (byte positions), row, and their hashes.

    ``table`` gives each byte a class; a word is a run of one class other than
    0 within one row. ``fold`` is applied to bytes before hashing.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, table: np.ndarray = SPACE, fold: np.ndarray = IDENTITY):
        n = len(data)
        self.data, self.offs, self.rows, self.fold = data, offs, len(offs) - 1, fold
        if n == 0:
            self.begin = self.end = self.row = np.zeros(0, np.int64)
            self.kind = np.zeros(0, np.uint8)
            self.first = np.zeros(len(offs), np.int64)
            self._sums = np.zeros(1, U64)
            return
        cls = table[data]
        edge = np.empty(n, bool)
        edge[0] = True
        np.not_equal(cls[1:], cls[:-1], out=edge[1:])
        inner = offs[:-1]
        edge[inner[inner < n]] = True
        pos = np.flatnonzero(edge)
        kind = cls[pos]
        stop = np.append(pos[1:], n)
        word = kind > 0
        self.begin, self.end, self.kind = pos[word], stop[word], kind[word]
        self.first = np.searchsorted(self.begin, offs)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))
        self._sums = None

    def __len__(self) -> int:
        return len(self.begin)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def span_hash(self, begin: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """64-bit hashes of byte ranges of the block, equal for equal folded bytes."""
        if self._sums is None:
            n = len(self.data)
            _POWERS.reach(n)
            sums = np.empty(n + 1, U64)
            sums[0] = 0
            letters = self.fold[self.data].astype(U64)
            letters += U64(1)
            letters *= _POWERS.up[:n]
            np.cumsum(letters, out=sums[1:])
            self._sums = sums
        if len(begin) == 0:
            return np.zeros(0, U64)
        h = self._sums[end] - self._sums[begin]
        h *= _POWERS.down[begin]
        h += (end - begin).astype(U64) * U64(0xD6E8FEB86659FD93)
        for i in np.flatnonzero(end - begin > LONG).tolist():  # few: sums modulo 2**64 can agree for long repetitive ranges
            own = self.fold[self.data[begin[i] : end[i]]].tobytes()
            h[i] = int.from_bytes(blake2b(own, digest_size=8).digest(), "little")
        if salt:
            h ^= U64(salt * 0xA0761D6478BD642F & _MASK)
        return mix(h)

    def hashes(self, salt: int = 0) -> np.ndarray:
        return self.span_hash(self.begin, self.end, salt)


def gram_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive items of ``h`` (len(h) - n + 1 of them)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    out = np.zeros(m, U64)
    for k in range(n):
        out *= U64(0x9E3779B97F4A7C15)
        out += h[k : k + m]
        out ^= out >> U64(29)
    return mix(out)


def grams_in_rows(words: Spans, n: int) -> np.ndarray:
    """Indices of words that begin a run of ``n`` words of one row."""
    if len(words) < n:
        return np.zeros(0, np.int64)
    i = np.arange(len(words) - n + 1)
    return i[words.row[: len(i)] == words.row[n - 1 :]]


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... for each range, one after the other."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    keep = length > 0
    start, length = start[keep], length[keep]
    out = np.ones(total, np.int64)
    at = np.concatenate([[0], np.cumsum(length)[:-1]])
    out[at] = start
    out[at[1:]] -= start[:-1] + length[:-1] - 1
    return np.cumsum(out)


def list_column(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from flat values and row lengths."""
    offs = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(values, kind))


def bytes_column(data: np.ndarray, offs: np.ndarray, kind: pa.DataType = pa.string()) -> pa.Array:
    """An Arrow string or binary column over a byte buffer."""
    o = np.ascontiguousarray(offs, np.int32)
    return pa.Array.from_buffers(kind, len(o) - 1, [None, pa.py_buffer(o.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])
