"""Words of whole texts as arrays, for operators that run on Arrow batches inside tasks.

A word is a longest run of 0-9, a-z (A-Z is lower-cased first) and characters beyond ASCII. Texts are
read from Arrow's buffers, a few megabytes at a time, so memory follows neither the batch nor the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000  # text handled at once; one longer text makes a block of its own
BLOCK_ROWS = 30_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = True
_IS_WORD[97:123] = True
_IS_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be undone modulo 2^64
_MASK = (1 << 64) - 1
_BYTE_VALUE = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 … n of the base and of its inverse modulo 2^64; the arrays grow as longer texts come."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, BLOCK_BYTES * 2)
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            powers, have, step = np.ones(size, dtype=np.uint64), 1, base
            while have < size:  # doubling: powers[have:2*have] = powers[:have] * base^have
                take = min(have, size - have)
                powers[have:have + take] = powers[:take] * np.uint64(step)
                step = step * step & _MASK
                have += take
            out.append(powers)
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose texts hold about ``size`` bytes."""
    for batch in batches:
        _, at = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, min(first + BLOCK_ROWS, int(np.searchsorted(at, at[first] + size, side="right")) - 1))
            yield batch.slice(first, last - first)
            first = last


@dataclass
class Words:
    """Words of a block: bytes ``[start, end)`` of ``data`` (lower-cased); row ``r`` owns words ``first[r]:first[r + 1]``."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, equal for equal words in every block."""
        power, inverse = _powers(len(self.data))
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[self.data] * power[:len(self.data)], out=total[1:])
        length = (self.end - self.start).astype(np.uint64)
        return mix((total[self.end] - total[self.start]) * inverse[self.start] + length)


def words_of(texts: pa.Array) -> Words:
    raw, at = text_bytes(texts)
    data = _LOWER[raw]
    inside = _IS_WORD[data]
    before = np.empty(len(data) + 1, dtype=bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(len(data) + 1, dtype=bool)
    after[-1] = False
    after[:-1] = inside
    before[at] = False  # no word crosses from one row into the next
    after_edge = at[1:]
    opens = inside & ~before[:-1]
    following = after[1:].copy()
    following[after_edge[after_edge > 0] - 1] = False
    closes = inside & ~following
    start = np.flatnonzero(opens)
    return Words(data, at, start, np.flatnonzero(closes) + 1, np.searchsorted(start, at).astype(np.int64))


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``n`` consecutive words and their rows, in text order.

    A text of fewer words, but not none, is one shingle of all its words.
    """
    h = words.hashes()
    count, first = words.count, words.first
    k = len(h)
    acc = np.zeros(max(0, k - n + 1), dtype=np.uint64)
    for j in range(n):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[j:j + len(acc)]
    row = words.row()
    whole = np.zeros(k, dtype=bool)
    whole[:len(acc)] = row[:len(acc)] == row[n - 1:n - 1 + len(acc)] if k >= n else False
    keep = np.flatnonzero(whole)
    values, rows = mix(acc[keep]), row[keep]
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(n - 1):
            has = count[short] > j
            extra[has] = extra[has] * np.uint64(0xD6E8FEB86659FD93) + h[first[short[has]] + j]
        extra = mix(extra + count[short].astype(np.uint64))
        values, rows = np.concatenate([values, extra]), np.concatenate([rows, short])
        order = np.argsort(rows, kind="stable")
        values, rows = values[order], rows[order]
    return values, rows


def row_counts(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(value, row, times) of each distinct value of each row of a block, sorted by row and value."""
    if not len(values):
        return values, rows, np.zeros(0, np.int64)
    order = np.argsort(values)
    order = order[np.argsort(rows[order].astype(np.uint16), kind="stable")]  # a radix sort
    v, r = values[order], rows[order]
    new = np.empty(len(v), dtype=bool)
    new[0] = True
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return v[at], r[at], np.diff(np.append(at, len(v)))
