"""Spelling variants: frequent words with the near words (one edit apart) that they may be misspellings of.

An edit changes the letter counts of a word by a squared distance of 1 (a letter more or less) or 2 (one letter
for another), and the length by one at most. Distances of whole blocks of words come from one matrix product,
|a|² + |b|² - 2ab. The alphabet is dealt into four classes of about equal use; an edit touches at most two of
them, so near words have equal counts in two classes at least. Blocks are the words that agree in all
letters of two given classes, of adjacent lengths; a pair is reported by the first such two classes.
A block of many words is cut into parts and its products into tiles of two parts, so no task holds more than
two parts. What a product leaves is compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import materialize, small_side

MIN_LENGTH, MIN_COUNT = 6, 5
FORM_RATIO = 5  # how much more frequent the form of a word has to be
CLASSES = 4
TILE = 4_096  # words of a block that are compared in one task with as many others
_PAIRS = list(combinations(range(CLASSES), 2))
_AT_ONCE = 30_000  # rows gathered before their blocks are compared
_SQUARE = 1_024  # side of one matrix product
_VERIFY_BYTES = 4_000_000
_VERIFY_ROWS = 20_000
_LETTER = np.full(256, -1, dtype=np.int64)
_LETTER[97:123] = np.arange(26)
_LETTER[0xC0:] = np.arange(26, 90)
_LETTERS = [chr(c) for c in range(256) if _LETTER[c] >= 0]
_WEIGHT = np.random.default_rng(20_261_201).integers(1, 1 << 62, len(_LETTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_EDGE = "a string, b string, n_a bigint, n_b bigint"


def letter_runs(text: Column) -> Column:
    """Longest runs of at least MIN_LENGTH letters, a row each, null for a text without any; shorter ones give no word.

    Outer, as an inner explode gets a filter on the size of the array and would search every text three times.
    """
    return F.explode_outer(F.regexp_extract_all(text, F.lit(rf"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0)))


def word_counts(runs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words in the column ``word`` that are long and frequent enough; counted before the shuffle."""
    return runs.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def letter_classes(words: DataFrame) -> np.ndarray:
    """The class of each letter: by falling use, each to the class used least so far. Ninety letters at most are read."""
    used = dict(words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect())
    load, out = [0] * CLASSES, np.zeros(len(_LETTERS), dtype=np.int64)
    for letter in sorted(_LETTERS, key=lambda c: (-used.get(c, 0), c)):
        least = load.index(min(load))
        out[_LETTER[ord(letter)]] = least
        load[least] += used.get(letter, 0) + 1
    return out


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a letter, and the offsets of the words."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    at = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(w) for w in raw], out=at[1:])
    return np.frombuffer(b"".join(raw), dtype=np.uint8), at


def _letter_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    rows, width = len(at) - 1, len(_LETTERS)
    cell = np.repeat(np.arange(rows), np.diff(at)) * width + _LETTER[data]
    return np.bincount(cell, minlength=rows * width).reshape(rows, width)


def _block_keys(classes: np.ndarray):
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 10_000):
                b = whole.slice(first, 10_000)
                data, at = _latin(b.column("word"))
                counts = _letter_counts(data, at).astype(np.uint64) * _WEIGHT
                part = [counts[:, classes == c].sum(axis=1, dtype=np.uint64) for c in range(CLASSES)]
                length = np.diff(at)
                for i, (c, d) in enumerate(_PAIRS):
                    h = (part[c] * np.uint64(0x9E3779B97F4A7C15) + part[d]).view(np.int64)
                    for low in (length - 1, length):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(b.num_rows, i, dtype=np.int32)), pa.array(low), pa.array(h), b.column("word"), b.column("n")],
                            names=["pair", "low", "h", "word", "n"])

    return keys


def _close(counts: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block whose letter counts have squared distance 1 or 2, as they are found;
    ``group`` tells the block of a row."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, len(group)))
    kind = np.float32 if int(counts.sum(axis=1).max()) < 2_000 else np.float64  # squares stay exact
    x = np.vstack([counts, np.zeros((1, counts.shape[1]), dtype=counts.dtype)]).astype(kind)
    norm = (x * x).sum(axis=1)
    below = 1
    for side in (4, 16, 64):  # small blocks side by side, filled up with an empty row
        some = np.flatnonzero((size > below) & (size <= side))
        below = side
        step = max(1, 200_000 // (side * side))
        for s in range(0, len(some), step):
            g = some[s:s + step]
            at = first[g][:, None] + np.arange(side)
            at[np.arange(side) >= size[g][:, None]] = len(counts)
            m = x[at]
            d = norm[at][:, :, None] + norm[at][:, None, :] - 2 * np.matmul(m, m.transpose(0, 2, 1))
            k, i, j = np.nonzero((d > 0.5) & (d < 2.5))
            ok = (i < j) & (at[k, j] < len(counts)) & (at[k, i] < len(counts))
            yield at[k, i][ok], at[k, j][ok]
    for g in np.flatnonzero(size > 64):
        stop = first[g] + size[g]
        for a in range(first[g], stop, _SQUARE):
            for b in range(a, stop, _SQUARE):
                p, q = slice(a, min(a + _SQUARE, stop)), slice(b, min(b + _SQUARE, stop))
                d = norm[p][:, None] + norm[q][None, :] - 2 * (x[p] @ x[q].T)
                i, j = np.nonzero((d > 0.5) & (d < 2.5))
                ok = i + a < j + b
                yield i[ok] + a, j[ok] + b


def _one_edit(data: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the words a and b, b as long or one letter longer, differ by exactly one letter put in or replaced."""
    out = np.zeros(len(a), dtype=bool)
    length = at[a + 1] - at[a]
    for n in np.unique(length):
        same = np.flatnonzero(length == n)
        step = max(1, _VERIFY_BYTES // int(n + 1))
        for s in range(0, len(same), step):
            k = same[s:s + step]
            x = data[at[a[k]][:, None] + np.arange(n)]
            y_at = at[b[k]][:, None] + np.arange(n)
            equal = x == data[y_at]
            longer = at[b[k] + 1] - at[b[k]] > n
            shifted = x == data[y_at + longer[:, None]]
            agree = np.minimum.accumulate(equal, axis=1)  # up to the first difference
            tail = np.where(agree, True, shifted).all(axis=1)
            out[k] = np.where(longer, tail, (~equal).sum(axis=1) == 1)
    return out


def _near_in_blocks(classes: np.ndarray):
    member = np.eye(CLASSES, dtype=np.float32)[classes]

    def near(table: pa.Table) -> Iterator[pa.RecordBatch]:
        words = table.column("word").combine_chunks()
        data, at = _latin(words)
        column = {c: table.column(c).to_numpy() for c in ("pair", "low", "h", "x", "y", "part", "n")}
        counts = _letter_counts(data, at).astype(np.int32)
        length = np.diff(at)
        change = np.zeros(len(counts), dtype=bool)
        for c in ("pair", "low", "h", "x", "y"):
            change[1:] |= column[c][1:] != column[c][:-1]

        def chosen(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            two_parts = column["x"][i] != column["y"][i]
            ok = (np.minimum(length[i], length[j]) == column["low"][i]) & (~two_parts | (column["part"][i] != column["part"][j]))
            ok &= np.abs(length[j] - length[i]) <= 1
            i, j = i[ok], j[ok]
            differs = ((counts[i] != counts[j]).astype(np.float32) @ member) > 0
            agree = np.stack([~differs[:, c] & ~differs[:, d] for c, d in _PAIRS], axis=1)
            ok = agree[np.arange(len(i)), column["pair"][i]] & (agree.argmax(axis=1) == column["pair"][i])
            i, j = i[ok], j[ok]
            swap = length[i] > length[j]
            i, j = np.where(swap, j, i), np.where(swap, i, j)
            ok = _one_edit(data, at, i, j)
            return i[ok], j[ok]

        for left, right in _close(counts, np.cumsum(change)):
            for s in range(0, len(left), _VERIFY_ROWS):
                i, j = chosen(left[s:s + _VERIFY_ROWS], right[s:s + _VERIFY_ROWS])
                if len(i):
                    yield pa.RecordBatch.from_arrays(
                        [words.take(pa.array(i)), words.take(pa.array(j)), pa.array(column["n"][i]), pa.array(column["n"][j])],
                        names=["a", "b", "n_a", "n_b"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < _AT_ONCE:
                continue
            t = pa.Table.from_batches(held)
            same = np.ones(rows, dtype=bool)  # rows of the last block, which may go on in the next batch
            for c in ("pair", "low", "h", "x", "y"):
                v = t.column(c).to_numpy()
                same &= v == v[-1]
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from near(t.slice(0, cut))
                held, rows = t.slice(cut).to_batches(), rows - cut
        if rows:
            yield from near(pa.Table.from_batches(held))

    return scan


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(a, b, n_a, n_b): each pair of distinct words of ``words`` (word, n) one edit apart, once.

    Words are distinct runs of letters a-z and U+00C0 to U+00FF. A block of over ``tile`` words is cut into parts by a hash.
    """
    classes = letter_classes(words)
    keyed = words.select("word", "n").mapInArrow(_block_keys(classes), "pair int, low bigint, h bigint, word string, n bigint")
    block = ("pair", "low", "h")
    large = small_side(keyed.groupBy(*block).count().filter(F.col("count") > tile).select(*block, F.ceil(F.col("count") / tile).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    cut = keyed.join(large, list(block), "left").withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    tiled = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        *block, F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"), "part", "word", "n")
    sorted_ = tiled.repartition(*block, "x", "y").sortWithinPartitions(*block, "x", "y")
    return sorted_.mapInArrow(_near_in_blocks(classes), _EDGE)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): ``forms`` (word, form) followed to the end. A form is rarer in no chain than FORM_RATIO times its word,
    so chains are short; each round doubles the step and is written."""
    step = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialize(step.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not step.filter("moved").take(1):
            return step.select("word", "root")
        step = step.drop("moved")


def spelling_variants(counts: DataFrame, ratio: int = FORM_RATIO, tile: int = TILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``counts`` (word, n), words distinct.

    ``n_near`` counts the words one edit apart. The most frequent of them (of equal ones the first by code points) is the
    ``form`` if it occurs at least ``ratio`` times as often; ``root`` is the last one when forms are followed. An empty
    table gives no rows.
    """
    words = materialize(counts.select("word", "n"), "words")
    edges = materialize(near_words(words, tile), "near_words")
    both = edges.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        edges.select(F.col("b"), F.col("a"), F.col("n_a")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("best"))
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.n") >= ratio * F.col("n")
    found = materialize(joined.select(
        "word", F.when(is_form, F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    last = roots(found.filter("form is not null").select("word", "form"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
