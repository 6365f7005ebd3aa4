"""Toxicity by class-conditional Kneser-Ney models.

Two models predict the characters of a word, each from those before it: one counts the words of toxic
training documents, the other those of ordinary ones. Below the longest context both back off to the
same continuation counts, taken from both classes together. So an expression that is rare in either
class is judged by what is known of its beginnings, and where neither class has seen a context the
models agree. A word's evidence is the difference of its two log-likelihoods; a document's is that
difference per word, with its strongest word and its strong words' share beside it, turned into a
probability by a logistic fit on labelled documents that the models have not counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.words import Words, blocks, words_of
from assaylake.session import PACKED, materialize, scratch_path, shuffles_dropped, small_side

ORDER = 10  # characters of an n-gram, six bits each, packed into one 64-bit integer
LOW = 3  # n-grams of this order and below are one table, of 64^3 rows at most; longer ones are dealt by as many last letters of the context
GROUP_ROWS = 250_000  # n-grams of a task, about
COMMON_NGRAMS = 1_200_000  # n-grams whose ratios every task holds; words with rarer ones get their evidence by a join
CALIBRATION_ROWS = 20_000  # labelled documents, in the mean, that the logistic fit sees
ID_BUCKETS = 1 << 20
THRESHOLD = 0.3
STRONG = 3.0  # a word this much (in nats) likelier in toxic text counts as strong
_BITS, _OPEN, _CLOSE, _DIGIT = 6, 61, 62, 63  # symbols before and after a word, and for every digit
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[48:58] = _DIGIT
FEATURES = ("mean", "strongest", "strong_share", "strong_sum")


def _symbols(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Six bits for each character at its first byte, and which bytes are first ones; letters beyond a-z share 34 symbols."""
    symbol, lead = _SYMBOL[data], (data & 0xC0) != 0x80
    far = np.flatnonzero(data >= 0xC0)
    if len(far):
        symbol[far] = 27 + (data[far].astype(np.int64) * 64 + data[np.minimum(far + 1, len(data) - 1)]) % 34
    return symbol, lead


def word_ngrams(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each character of the chosen words and behind it; and how many each word has."""
    symbol, lead = _symbols(w.data)
    before = np.concatenate([[0], np.cumsum(lead)])
    chars, symbol = before[w.start[which]], symbol[lead]
    length = before[w.end[which]] - chars
    at = np.concatenate([[0], np.cumsum(length + ORDER)])
    buffer = np.full(at[-1], _OPEN, dtype=np.int64)
    within = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    buffer[np.repeat(at[:-1] + ORDER - 1, length) + within] = symbol[np.repeat(chars, length) + within]
    buffer[at[1:] - 1] = _CLOSE
    ends = np.ones(at[-1], dtype=bool)
    for j in range(ORDER - 1):
        ends[at[:-1] + j] = False
    position = np.flatnonzero(ends)
    key = np.zeros(len(position), dtype=np.int64)
    for j in range(ORDER - 1, -1, -1):
        key = (key << _BITS) | buffer[position - j]
    return key, length + 1


COUNTS = ("ordinary", "toxic", "ordinary_3", "toxic_3")  # of folds 0 and 1, and of fold 3
HELD_WORDS, HELD_BYTES = 200_000, 8_000_000  # distinct words that a task holds before it gives them on


def count_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """(hash, word, a count for each part) of rows (text, part); summed within the task as far as memory is bounded."""
    names = ["hash", "word", *(f"n{i}" for i in range(parts))]
    held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
    size = 0

    def merged() -> tuple[np.ndarray, pa.Array, np.ndarray]:
        key, first, at = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        counts = np.concatenate([h[2] for h in held])
        word = pa.concat_arrays([h[1] for h in held]).take(pa.array(first))
        return key, word, np.column_stack([np.bincount(at, c, len(key)).astype(np.int64) for c in counts.T])

    def batch(key: np.ndarray, word: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), word, *(pa.array(c) for c in counts.T)], names)

    for b in blocks(batches):
        w = words_of(b.column("text"))
        if not len(w.start):
            continue
        part = np.asarray(b.column("part"))[w.row()]
        key, first, at = np.unique(w.hashes(), return_index=True, return_inverse=True)
        n = np.bincount(at * parts + part, minlength=len(first) * parts).reshape(len(first), -1)
        word = _word_bytes(w, first)
        held.append((key, word, n))
        size += word.nbytes
        if size > HELD_BYTES or sum(len(h[0]) for h in held) > HELD_WORDS:
            held[:] = [merged()]
            size = held[0][1].nbytes
            if size > HELD_BYTES // 2 or len(held[0][0]) > HELD_WORDS // 2:
                yield batch(*held.pop())
                size = 0
    if held:
        yield batch(*merged())


def count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each n-gram of the words of a block, from rows (hash, word, counts of the word)."""
    for b in blocks(batches, "word"):
        key, per = word_ngrams(words_of(b.column("word")), np.arange(b.num_rows))
        keys, at = np.unique(key, return_inverse=True)
        counts = [np.bincount(at, np.repeat(np.asarray(b.column(f"n{i}")), per), len(keys)).astype(np.int64) for i in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, counts)], ["key", *COUNTS])


def ask_ngrams(batches: Iterator[pa.RecordBatch], common: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(key, hash, e) for rows (hash, word): each n-gram of a word that is not common, and without a key the sum of those that are."""
    for b in blocks(batches, "word"):
        key, per = word_ngrams(words_of(b.column("word")), np.arange(b.num_rows))
        value, known = _look_up(key, common)
        to, word = np.repeat(np.arange(b.num_rows), per), np.asarray(b.column("hash"))
        columns = [pa.array(np.concatenate([key[~known], np.zeros(b.num_rows, np.int64)]), mask=np.repeat([False, True], [(~known).sum(), b.num_rows])),
                   pa.array(np.concatenate([word[to[~known]], word])),
                   pa.array(np.concatenate([np.zeros((~known).sum()), np.bincount(to, value, b.num_rows)]))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "hash", "e"])


def _look_up(key: np.ndarray, common: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ratio of each n-gram and whether it is known; ``common`` has all n-grams if it has their contexts too."""
    keys, ratio, contexts, fallback = common
    wanted, at = np.unique(key, return_inverse=True)
    found, value = Model(keys, ratio, contexts, fallback).values(wanted)
    return value[at], (found | (len(contexts) > 0))[at]


@dataclass
class Model:
    keys: np.ndarray  # n-grams of either class, sorted
    ratio: np.ndarray  # log P(last character | context) in toxic less ordinary
    contexts: np.ndarray
    fallback: np.ndarray  # the same for a character that neither class has there

    def values(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether either class has each n-gram, and the log-likelihood ratio of its last character."""
        found, value = np.zeros(len(key), dtype=bool), np.zeros(len(key))
        if len(self.contexts):
            j = np.minimum(np.searchsorted(self.contexts, key >> _BITS), len(self.contexts) - 1)
            value = np.where(self.contexts[j] == key >> _BITS, self.fallback[j], 0.0)
        if len(self.keys):
            i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[i] == key
            value = np.where(found, self.ratio[i], value)
        return found, value


def _discount(once: float, twice: float) -> float:
    return once / (once + 2 * twice) if once else 0.5


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For sorted n-grams: their contexts, each n-gram's context, and the contexts' totals and distinct followers."""
    contexts, at = np.unique(keys >> _BITS, return_inverse=True)
    return contexts, at, np.bincount(at, counts, len(contexts)), np.bincount(at, counts > 0, len(contexts))


def _followers(keys: np.ndarray, orders: range) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(order, n-grams, how many letters stand before each) for falling orders below that of ``keys``."""
    tables, above = [], keys
    for k in orders:
        above, n = np.unique(above & ((1 << _BITS * k) - 1), return_counts=True)
        tables.append((k, above, n.astype(float)))
    return tables


Below = tuple[int, np.ndarray, np.ndarray]  # an order, its sorted n-grams and P(last character | context) of each
ROOT: Below = (0, np.zeros(1, np.int64), np.full(1, 1 / (1 << _BITS)))


def _climb(below: Below, tables: list[tuple[int, np.ndarray, np.ndarray]], discounts: dict[int, float]) -> Below:
    """From the probabilities of one order to those of the longest in ``tables``, which fall in order."""
    for k, key, n in reversed(tables):
        _, at, total, distinct = _sums(key, n)
        shorter = below[2][np.searchsorted(below[1], key & ((1 << _BITS * (k - 1)) - 1))]
        below = k, key, np.maximum(n - discounts[k], 0) / total[at] + discounts[k] * distinct[at] / total[at] * shorter
    return below


def _discounts(tables: list[tuple[int, np.ndarray, np.ndarray]]) -> dict[int, float]:
    return {k: _discount(float((n == 1).sum()), float((n == 2).sum())) for k, _, n in tables}


def kneser_ney(keys: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray, discounts: tuple[float, float],
               shorter: dict[int, float] | None = None, below: Below = ROOT) -> Model:
    """Both class models on sorted n-grams, with continuation counts of shorter ones shared.

    ``keys`` may be part of all n-grams, if ``below`` has the probabilities of an order of all of them, ``shorter`` the
    discounts of the orders above that, and all n-grams whose contexts end alike in as many letters are together.
    """
    tables = _followers(keys, range(ORDER - 1, below[0], -1))
    _, below_keys, below_p = _climb(below, tables, _discounts(tables) if shorter is None else shorter)
    shared = below_p[np.searchsorted(below_keys, keys & ((1 << _BITS * (ORDER - 1)) - 1))]
    logs, backoffs, contexts = [], [], None
    for counts, d in zip((toxic, ordinary), discounts, strict=True):
        contexts, at, total, distinct = _sums(keys, counts)
        seen = np.maximum(total, 1)
        backoff = np.where(total > 0, d * distinct / seen, 1.0)
        logs.append(np.log(np.maximum(counts - d, 0) / seen[at] + backoff[at] * shared))
        backoffs.append(np.log(np.maximum(backoff, 1e-12)))
    return Model(keys, logs[0] - logs[1], contexts, backoffs[0] - backoffs[1])


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton steps on standardised features; returns weights for the features as they are."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    keep = np.full(z.shape[1], ridge)
    keep[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    weights = w[1:] / scale
    return np.concatenate([[w[0] - weights @ mean], weights])


MODELS = ((("toxic",), ("ordinary",)), (("toxic", "toxic_3"), ("ordinary", "ordinary_3")))  # of folds 0 and 1, and of all three


def _columns(table: pa.Table, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted n-grams that a model holds and their counts in both classes."""
    key, (toxic, ordinary) = table.column("key").to_numpy(), (sum(table.column(c).to_numpy() for c in side) for side in MODELS[m])
    order = np.flatnonzero(toxic + ordinary > 0)
    order = order[np.argsort(key[order])]
    return key[order], toxic[order].astype(float), ordinary[order].astype(float)


def count_orders(table: pa.Table) -> pa.Table:
    """(model, size, key, n, twice) of whole groups of n-grams: for order ``LOW`` the letters before each n-gram, for longer ones how many n-grams have one letter before them, and two."""
    rows = []
    for m in range(len(MODELS)):
        tables = _followers(_columns(table, m)[0], range(ORDER - 1, LOW - 1, -1))
        for k, key, n in tables[:-1]:
            rows.append((m, k, np.zeros(1, np.int64), *(np.array([(n == i).sum()], dtype=np.int64) for i in (1, 2))))
        _, key, n = tables[-1]
        rows.append((m, LOW, key, n.astype(np.int64), np.zeros(len(key), np.int64)))
    columns = [np.concatenate([np.full(len(r[2]), r[i], np.int32) for r in rows]) for i in (0, 1)]
    return pa.table([*columns, *(np.concatenate([r[i] for r in rows]) for i in (2, 3, 4))], names=["model", "size", "key", "n", "twice"])


def _common(table: pa.Table, fit: tuple, m: int, least: int, every: bool) -> pa.Table:
    """(context, key, ratio) of a model's n-grams of at least that count in all, and if these are all n-grams, of the contexts."""
    n = sum(table.column(c).to_numpy() for c in COUNTS)
    model = kneser_ney(*_columns(table, m), *fit)
    at = np.flatnonzero(np.isin(model.keys, table.column("key").to_numpy()[n >= least]))
    contexts, fallback = (model.contexts, model.fallback) if every else (model.contexts[:0], model.fallback[:0])
    return pa.table({"context": np.repeat([False, True], [len(at), len(contexts)]), "key": np.concatenate([model.keys[at], contexts]),
                     "ratio": np.concatenate([model.ratio[at], fallback])})


def _answer(counts: pa.Table, asked: pa.Table, fit: tuple, m: int) -> pa.Table:
    """(hash, e): what the n-grams of whole groups add to the words that ask for them."""
    if not asked.num_rows:
        return pa.table({"hash": pa.array([], pa.int64()), "e": pa.array([], pa.float64())})
    key, word = asked.column("key").to_numpy(), asked.column("hash").to_numpy()
    order = np.argsort(key, kind="stable")  # a word's sum is always of the same order
    keys, at = np.unique(key[order], return_inverse=True)
    words, to = np.unique(word[order], return_inverse=True)
    value = kneser_ney(*_columns(counts, m), *fit).values(keys)[1] if counts.num_rows else np.zeros(len(keys))
    return pa.table({"hash": words, "e": np.bincount(to, value[at], len(words))})


def fold(doc_id: Column) -> Column:
    """Remainder of crc32 of the id as text by 4; documents of remainder 2 are held out of all training."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def _word_table(rows: DataFrame, parts: int) -> DataFrame:
    """(hash, word, n0 …): the distinct words of rows (text, part), part from 0."""
    names = [f"n{i}" for i in range(parts)]
    found = rows.mapInArrow(lambda it: count_words(it, parts), "hash bigint, word binary, " + ", ".join(f"{c} bigint" for c in names))
    return found.groupBy("hash").agg(F.any_value("word").alias("word"), *[F.sum(c).alias(c) for c in names])


def _fit(counts: DataFrame) -> list:
    """For each model the discounts of its classes and of the orders above ``LOW``, and the probabilities of order ``LOW``; None without both classes.

    The driver gets 64^3 rows a model at most, whatever the text.
    """
    names = [(m, c, sum((F.col(x) for x in side[1:]), F.col(side[0]))) for m, model in enumerate(MODELS) for c, side in enumerate(model)]
    total = counts.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(f"m{m}_{c}") for m, c, n in names],
                       *[F.count(F.when(n == i, 1)).alias(f"m{m}_{c}_{i}") for m, c, n in names for i in (1, 2)]).first()
    orders = counts.groupBy("part").applyInArrow(count_orders, "model int, size int, key bigint, n bigint, twice bigint")
    orders = orders.groupBy("model", "size", "key").agg(F.sum("n").alias("n"), F.sum("twice").alias("twice")).toArrow()
    model, size, key, n, twice = (orders.column(c).to_numpy() for c in orders.column_names)
    fitted = []
    for m in range(len(MODELS)):
        if not all(total[f"m{m}_{c}"] for c in (0, 1)):
            fitted.append(None)
            continue
        at = np.flatnonzero((model == m) & (size == LOW))
        at = at[np.argsort(key[at])]
        tables = [(LOW, key[at], n[at].astype(float)), *_followers(key[at], range(LOW - 1, 0, -1))]
        shorter = {int(size[i]): _discount(float(n[i]), float(twice[i])) for i in np.flatnonzero((model == m) & (size > LOW))}
        fitted.append((tuple(_discount(total[f"m{m}_{c}_1"], total[f"m{m}_{c}_2"]) for c in (0, 1)), shorter, _climb(ROOT, tables, _discounts(tables))))
    return fitted


_MEASURED = pa.struct([("n", pa.int64()), ("total", pa.float64()), ("strongest", pa.float64()), ("strong", pa.float64()), ("rare", pa.list_(pa.binary()))])


def _word_bytes(w: Words, which: np.ndarray) -> pa.Array:
    length = w.end[which] - w.start[which]
    ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    data = w.data[np.repeat(w.start[which] - ends[:-1], length) + np.arange(ends[-1])]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(which), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def _measure(texts: pa.Array, common: list[np.ndarray]) -> pa.Array:
    """Sums over the words of each text whose n-grams are all known, and its other words."""
    w = words_of(texts)
    rows, row = len(texts), w.row()
    _, first, at = np.unique(w.hashes(), return_index=True, return_inverse=True)
    key, per = word_ngrams(w, first)
    value, known = _look_up(key, common)
    to = np.repeat(np.arange(len(first)), per)
    held = np.bincount(to, ~known, len(first)) == 0
    evidence = np.where(held, np.bincount(to, value, len(first)), 0.0)[at]
    strongest = np.zeros(rows)
    np.maximum.at(strongest, row, evidence)
    other = np.flatnonzero(~held[at])
    ends = np.concatenate([[0], np.cumsum(np.bincount(row[other], minlength=rows))])
    columns = [pa.array(w.count), pa.array(np.bincount(row, evidence, rows)), pa.array(strongest),
               pa.array(np.bincount(row, np.maximum(evidence - STRONG, 0), rows)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), _word_bytes(w, other))]
    return pa.StructArray.from_arrays(columns, fields=list(_MEASURED))


@dataclass
class Evidence:
    """Two models of words: the ratios of common n-grams in each task's memory, those of all n-grams from the counts."""

    counts: DataFrame  # (part, key, COUNTS)
    tasks: int
    fitted: list
    common: list[Broadcast]  # for each model sorted n-grams, ratios, and if these are all, contexts and their ratios
    every: bool

    def rare_words(self, words: DataFrame, m: int) -> DataFrame:
        """(hash, e): the evidence of each distinct word."""
        common, fit = self.common[m], self.fitted[m]
        words = words.distinct().select(F.xxhash64("word").alias("hash"), "word")
        asked = materialize(words.mapInArrow(lambda it: ask_ngrams(it, common.value), "key bigint, hash bigint, e double"), "asked")
        rest = asked.filter(F.col("key").isNotNull()).select(_part(self.tasks), "key", "hash")
        answers = self.counts.groupBy("part").cogroup(rest.groupBy("part")).applyInArrow(lambda a, b: _answer(a, b, fit, m), "hash bigint, e double")
        sums = answers.unionByName(asked.filter(F.col("key").isNull()).select("hash", "e"))
        return sums.groupBy("hash").agg(_exact(F.col("e")).alias("e"))

    def measure(self, docs: DataFrame, text: str, m: int) -> DataFrame:
        """``docs`` with the columns of ``FEATURES`` by model ``m``."""
        common = self.common[m]

        def look(texts: pa.Array) -> pa.Array:
            out = [_measure(b.column("text"), common.value) for b in blocks(iter([pa.RecordBatch.from_arrays([texts], ["text"])]))]
            return pa.concat_arrays(out) if out else pa.array([], _MEASURED)

        look.__annotations__ = {"texts": pa.Array, "return": pa.Array}
        kind = "struct<n: bigint, total: double, strongest: double, strong: double, rare: array<binary>>"
        kept = [c for c in docs.columns if c != text]
        found = docs.select(*kept, F.arrow_udf(look, kind)(F.col(text)).alias("_m"))
        total, strongest, strong = (F.col(f"_m.{c}") for c in ("total", "strongest", "strong"))
        if not self.every:
            found = materialize(found.withColumn("_id", F.monotonically_increasing_id()), "measured")
            rare = found.select("_id", F.explode("_m.rare").alias("word"))
            e = F.col("e")
            more = rare.select("_id", F.xxhash64("word").alias("hash")).join(self.rare_words(rare.select("word"), m), "hash").groupBy("_id").agg(
                _exact(e).alias("_total"), F.max(e).alias("_strongest"), _exact(F.greatest(e - STRONG, F.lit(0.0))).alias("_strong"))
            found = found.join(small_side(more), "_id", "left")
            total, strong = total + F.coalesce("_total", F.lit(0.0)), strong + F.coalesce("_strong", F.lit(0.0))
            strongest = F.greatest(strongest, F.coalesce("_strongest", F.lit(0.0)))
        n = F.greatest(F.col("_m.n"), F.lit(1))
        values = (total / n, strongest, strong / n, F.log1p(strong))
        return found.select(*kept, *[v.alias(c) for v, c in zip(values, FEATURES, strict=True)])


def _exact(x: Column) -> Column:
    """A sum that is the same in any order."""
    return F.sum(x.cast("decimal(38,12)")).cast("double")


def _part(tasks: int) -> Column:
    """The part of an n-gram: n-grams whose contexts end in the same ``LOW`` letters are in one."""
    group = F.shiftright("key", _BITS).bitwiseAND(F.lit((1 << _BITS * LOW) - 1))
    return F.pmod(F.xxhash64(group), F.lit(tasks)).cast("int").alias("part")


def learn_words(rows: DataFrame, common_ngrams: int = COMMON_NGRAMS) -> Evidence | None:
    """The models of ``rows`` (text, part of ``COUNTS``); None if folds 0 and 1 lack a class.

    All n-grams are counted and dealt by the last ``LOW`` letters of their contexts: what an n-gram's probability
    needs of longer orders is then in one part, and what it needs of shorter ones in a table of fixed size. The
    counts are written bucketed by part, so that the passes over parts shuffle nothing of them.
    """
    spark = rows.sparkSession
    words = materialize(_word_table(rows, len(COUNTS)), "words")
    tasks = words.count() * 3 // GROUP_ROWS + 1
    found = words.mapInArrow(count_ngrams, "key bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)).select(_part(tasks), "*")
    found = found.repartition(tasks, "part").groupBy("part", "key").agg(*[F.sum(c).alias(c) for c in COUNTS])
    path = scratch_path(spark, "ngrams")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    with shuffles_dropped(spark):
        found.write.bucketBy(tasks, "part").option("compression", PACKED).option("path", path).saveAsTable(name)
    counts = spark.table(name)
    fitted = _fit(counts)
    if fitted[0] is None:
        return None
    size = F.floor(F.log2(sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0]))) * 16).alias("size")
    sizes = {r["size"]: (r["count"], r["least"]) for r in counts.select(size, sum((F.col(c) for c in COUNTS[1:]), F.col(COUNTS[0])).alias("n"))
             .groupBy("size").agg(F.count(F.lit(1)).alias("count"), F.min("n").alias("least")).collect()}
    least, held, every = 1 << 62, 0, True
    for k in sorted(sizes, reverse=True):
        held += sizes[k][0]
        every = held <= common_ngrams
        if not every:
            break
        least = sizes[k][1]
    common = []
    for m, fit in enumerate(fitted):
        kept = counts.groupBy("part").applyInArrow(lambda t: _common(t, fit, m, least, every), "context boolean, key bigint, ratio double").toArrow()  # noqa: B023
        arrays = []
        for of_context in (False, True):
            part = kept.filter(pc.equal(kept.column("context"), of_context)).sort_by("key")
            arrays += [part.column("key").to_numpy(), part.column("ratio").to_numpy()]
        common.append(spark.sparkContext.broadcast(arrays))
        del kept, part, arrays
    return Evidence(counts, tasks, fitted, common, every)


def train(docs: DataFrame, labels: DataFrame, text_col: str = "text", common_ngrams: int = COMMON_NGRAMS) -> tuple[Evidence, np.ndarray] | None:
    """Count n-grams over all labelled documents of folds 0, 1 and 3 and fit the score: the models of words, and weights.

    The logistic fit sees fold 3 through models that count only folds 0 and 1; the models of the score
    count all three. None without both classes.
    """
    marked = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # the buckets of labelled ids keep most unlabelled texts out of the shuffle; there are ID_BUCKETS of them at most
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(ID_BUCKETS)).alias("bucket")
    buckets = marked.select(bucket).distinct()
    text = F.col(text_col).cast("string").alias("text")
    rows = (
        docs.filter(F.col("doc_id").isNotNull())
        .select("doc_id", text, fold(F.col("doc_id")).alias("fold"), bucket)
        .filter(F.col("fold") != 2).join(F.broadcast(buckets), "bucket", "left_semi")
        .join(marked.hint("merge"), "doc_id")
        .select("doc_id", "text", "toxic", "fold", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("_class")))
    parts = rows.select("text", (F.col("_class") + F.when(F.col("fold") == 3, 2).otherwise(0)).cast("int").alias("part"))
    evidence = learn_words(parts, common_ngrams)
    if evidence is None:
        return None
    third = rows.filter("fold = 3")
    rate = min(1.0, CALIBRATION_ROWS / max(third.select("doc_id").count(), 1))
    sample = third.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(rate * 1_000_000))
    seen = evidence.measure(sample.select("text", "toxic"), "text", 0).select(*FEATURES, "toxic").toArrow()
    evidence.common[0].destroy()
    y = np.asarray(seen.column("toxic")) > 0
    if not y.any() or y.all():
        return None
    return evidence, _logistic(np.column_stack([np.asarray(seen.column(c)) for c in FEATURES]), y.astype(float))


def score_toxicity(docs: DataFrame, labels: DataFrame, keep: list[Column], text_col: str = "text",
                   common_ngrams: int = COMMON_NGRAMS) -> DataFrame:
    """(row, score): ``row`` is a struct of the ``keep`` columns of each document, ``score`` in 0 … 1.

    ``docs`` needs ``doc_id``, which chooses the folds and finds the labels; several labels of an id
    count as toxic if one does, null labels do not count. Null and empty texts score as a text without
    evidence. Without training documents of both classes every score is 0. Repeated rows score alike;
    other columns are carried in ``row`` whatever their names; an empty table gives no rows. Scores do
    not depend on ``common_ngrams``, only what each task holds in memory.
    """
    fitted = train(docs, labels, text_col, common_ngrams)
    row = F.struct(*keep).alias("row")
    if fitted is None:
        return docs.select(row, F.lit(0.0).alias("score"))
    evidence, weights = fitted
    found = evidence.measure(docs.select(row, F.col(text_col).cast("string").alias("text")), "text", 1)
    x = sum((F.col(c) * float(w) for c, w in zip(FEATURES, weights[1:], strict=True)), F.lit(float(weights[0])))
    score = 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0))))
    return found.select("row", score.alias("score"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs, labels, [F.col("doc_id")])
    return scored.select("row.doc_id", F.coalesce(fold(F.col("row.doc_id")) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents whose score stays below the threshold, all columns as they were."""
    scored = score_toxicity(docs, labels, [F.col(f"`{c}`") for c in docs.columns], text_col)
    return scored.filter(F.col("score") < THRESHOLD).select("row.*")
