"""Periodic runs of words: seeds on diagonals of one document, extended once, and texts without the repeats.

A run is a stretch of words with smallest period ``q`` of at least ``max(MIN_LENGTH, 2 * q)`` words that no
neighbouring word continues. Shifted by its period it overlaps itself by at least ``max(MIN_LENGTH - q, q)``
words, so lags are taken in classes, each with the gram that every run of the class must repeat: 6 words for
lags below 12, and ``k`` words for the lags from ``k`` to ``2k`` with ``k`` = 12, 24, 48 and so on. Gram ids
are exact: those of ``2k`` words number the pairs of those of ``k`` words.

Equal grams of a document at a lag of the class are a seed. A text that says one word a million times holds
no quadratic number of seeds: of occurrences that follow each other within half a gram only the first one, the
head, is paired with all others, and that loses no run (at the start of a run one of the two is a head, or the
words before would be equal too). A seed with equal words before it lies in the part of its lag that an
earlier seed covers; it is not extended again. So each stretch of a lag is extended once, to the right,
by grams of falling size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assaylake.llm.words import Words, blocks, text_bytes
from assaylake.session import spread

MIN_LENGTH = 12
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[*range(9, 14), 32]] = True
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def tokens_of(texts: pa.Array) -> Words:
    """Words between white space (blank, tab, line breaks), letter case kept."""
    data, at = text_bytes(texts)
    inside = ~_IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True  # no word crosses from one row into the next
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:-1] if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:] if len(data) else inside
    start = np.flatnonzero(inside & ~before)
    return Words(data, at, start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, at).astype(np.int64))


def _numbered(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers from 0 for equal pairs; -1 where a part is missing (negative)."""
    out = np.full(len(left), -1, dtype=np.int64)
    both = np.flatnonzero((left >= 0) & (right >= 0))
    if len(both):
        out[both] = np.unique(left[both] * (int(right.max()) + 1) + right[both], return_inverse=True)[1]
    return out


def _ahead(ids: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(ids), -1, dtype=np.int64)
    out[:max(0, len(ids) - k)] = ids[k:]
    return out


def _repeated(ids: np.ndarray) -> bool:
    known = ids[ids >= 0]
    return len(known) > 0 and int(np.bincount(known).max()) > 1


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) for every position of the half-open ranges."""
    size = np.maximum(last - first, 0)
    owner = np.repeat(np.arange(len(first)), size)
    return owner, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[owner]


def _seeds(ids: np.ndarray, least: int, below: int, heads_only: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions with equal ids and ``least <= lag < below``; with ``heads_only`` one of the two is a head."""
    p = np.flatnonzero(ids >= 0)
    p = p[np.argsort(ids[p], kind="stable")]
    key = ids[p] * (len(ids) + 2 * below + 1) + p
    head = np.ones(len(p), dtype=bool)
    if heads_only:
        head[1:] = np.diff(key) > least // 2
    h = np.flatnonzero(head)
    x, y = _ranges(np.searchsorted(key, key[h] + least), np.searchsorted(key, key[h] + below))
    first, second = p[h[x]], p[y]
    if heads_only:
        y, x = _ranges(np.searchsorted(key, key[h] - below, side="right"), np.searchsorted(key, key[h] - least, side="right"))
        first, second = np.concatenate([first, p[x]]), np.concatenate([second, p[h[y]]])
    return first, second


def runs_of(row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the rows' word numbers, by start and period; starts count over all rows."""
    n = len(word)
    grams = {1: np.unique(row * (int(word.max(initial=0)) + 1) + word, return_inverse=True)[1].astype(np.int64)}
    for k, half in ((2, 1), (3, 2), (6, 3)):
        grams[k] = _numbered(grams[half], _ahead(grams[k - half], half))
    found = [_seeds(grams[6], 1, 12, False)] if _repeated(grams[6]) else []
    k = 12
    while k // 2 in grams and k <= n // 2 and _repeated(grams[k // 2]):
        grams[k] = _numbered(grams[k // 2], _ahead(grams[k // 2], k // 2))
        found.append(_seeds(grams[k], k, 2 * k, True))
        k *= 2
    if not found:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    i = np.concatenate([f[0] for f in found])
    j = np.concatenate([f[1] for f in found])
    one = grams[1]
    uncovered = (i == 0) | (one[i - 1] != one[j - 1])
    i, j = i[uncovered], j[uncovered]
    length = np.zeros(len(i), dtype=np.int64)
    for k in sorted(grams, reverse=True):
        live = np.arange(len(i))
        while len(live):
            b = j[live] + length[live]
            live, b = live[b < n], b[b < n]
            a = i[live] + length[live]
            live = live[(grams[k][a] >= 0) & (grams[k][a] == grams[k][b])]
            length[live] += k
    lag = j - i
    keep = length >= np.maximum(MIN_LENGTH - lag, lag)
    start, total, lag = i[keep], (length + lag)[keep], lag[keep]
    order = np.lexsort((lag, total, start))
    start, total, lag = start[order], total[order], lag[order]
    smallest = np.ones(len(start), dtype=bool)  # a multiple of the period gives the same stretch again
    smallest[1:] = (np.diff(start) != 0) | (np.diff(total) != 0)
    start, total, lag = start[smallest], total[smallest], lag[smallest]
    order = np.lexsort((lag, start))
    return start[order], total[order], lag[order]


def _suspects(words: Words) -> np.ndarray:
    """Rows in which some six words stand twice, told by hashes: no row with a run is left out."""
    h, row = words.hashes(), words.row()
    m = max(0, len(h) - 5)
    gram = row[:m].astype(np.uint64)
    for j in range(6):
        gram = gram * np.uint64(0xD6E8FEB86659FD93) + h[j:j + m]
    whole = np.flatnonzero(row[:m] == row[5:5 + m])
    order = whole[np.argsort(gram[whole])]
    return np.unique(row[order[1:]][gram[order[1:]] == gram[order[:-1]]])


def _exact_numbers(words: Words, at: np.ndarray) -> np.ndarray:
    """A number for each chosen word, equal only for equal bytes."""
    seen: dict[bytes, int] = {}
    raw = words.data.tobytes()
    return np.array([seen.setdefault(raw[s:e], len(seen)) for s, e in zip(words.start[at], words.end[at], strict=True)], dtype=np.int64)


def _collapsed(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each row joined by one blank."""
    kept = np.flatnonzero(keep)
    row = words.row()[kept]
    size = words.end[kept] - words.start[kept] + 1
    last = np.ones(len(kept), dtype=bool)
    last[:-1] = row[1:] != row[:-1]
    size[last] -= 1  # no blank behind a row's last word
    ends = np.cumsum(size)
    from_ = np.repeat(words.start[kept] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
    out = np.append(words.data, np.uint8(32))[from_]
    out[ends[~last] - 1] = 32
    rows = len(words.first) - 1
    offsets = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(row, weights=size, minlength=rows).astype(np.int64), out=offsets[1:])
    return pa.LargeStringArray.from_buffers(rows, pa.py_buffer(offsets), pa.py_buffer(out)).cast(pa.string())


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        words = tokens_of(block.column("text"))
        rows, keep = block.num_rows, np.ones(len(words.start), dtype=bool)
        offsets, values = np.zeros(rows + 1, dtype=np.int32), [np.zeros(0, dtype=np.int64)] * 3
        suspects = _suspects(words)
        if len(suspects):
            row, at = _ranges(words.first[suspects], words.first[suspects + 1])
            start, length, period = runs_of(row, _exact_numbers(words, at))
            if len(start):
                owner = suspects[row[start]]
                change = np.zeros(len(at) + 1, dtype=np.int64)
                np.add.at(change, start + period, 1)
                np.add.at(change, start + length, -1)
                keep[at[np.cumsum(change)[:-1] > 0]] = False
                values = [at[start] - words.first[owner], length, period]
                np.cumsum(np.bincount(owner, minlength=rows), out=offsets[1:])
        runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(v) for v in values], fields=list(_RUN)))
        yield pa.RecordBatch.from_arrays(
            [block.column("id"), pa.array(words.count), runs, _collapsed(words, keep)], names=["id", "n_words", "runs", "text"])


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs, text) per row of ``docs``: its periodic runs, and its words without the repeats.

    ``runs`` is an array of (start, length, period) in words from 0, by start, then period. ``text`` joins by one
    blank the words that no run holds after its first period. Each row stands by itself, so nothing is shuffled,
    and equal rows or ids give equal rows. A null or blank text has no words, no runs and an empty text; a
    null id stays null. Other columns of ``docs`` are not looked at. A very long text is one block of its own and
    takes about 250 bytes of memory a word and n log n steps, however periodic it is.
    """
    scan = spread(docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")))
    fields = [scan.schema["id"], T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("text", T.StringType())]
    out = scan.mapInArrow(_scan, T.StructType(fields))
    return out.withColumnRenamed("id", id_column)
