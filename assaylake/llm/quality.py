"""Quality by co-training: a text view and a metadata view teach each other, then vote.

Each view is a logistic model. In every round each one marks the unlabelled documents it is surest of,
and the other learns from them as if they were labelled. At the end both are calibrated on labelled
documents that neither has seen, and a logistic model of the two calibrated scores gives the result.
The models are fitted on bounded samples (``LABELLED``, ``UNLABELLED``); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm.toxicity import fold
from assaylake.llm.words import blocks, mix, text_bytes, words_of

LABELLED, UNLABELLED = 8_000, 8_000  # documents, in the mean, that the models are fitted on
ROUNDS, SURE, SHARE = 3, 0.95, 0.05  # pseudo-labels per round: the surest 5 %, and only those of 95 % or more
WORD_BUCKETS, SOURCE_BUCKETS = 512, 64
THRESHOLD = 0.5
_COUNTED = [b"\n", b"!", b"#", b"%", b"$", b"&", b"*", b"|"]


def text_view(texts: pa.Array) -> np.ndarray:
    """Square roots of hashed word shares, and shape: lengths, repetition, capitals, marks, lines."""
    w, (raw, at) = words_of(texts), text_bytes(texts)
    n, row, h = len(texts), w.row(), w.hashes()
    words, size = np.maximum(w.count, 1), np.maximum(np.diff(at), 1)
    bucket = (h >> np.uint64(64 - 9)).astype(np.int64)
    hashed = np.sqrt(np.bincount(row * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, -1) / words[:, None])
    order = np.argsort(h)
    order = order[np.argsort(row[order].astype(np.uint16), kind="stable")]
    hs, rs = h[order], row[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1])
    start = np.flatnonzero(new)
    times = np.diff(np.append(start, len(hs)))
    most = np.zeros(n)
    np.maximum.at(most, rs[start], times)
    again = np.bincount(row[1:][(h[1:] == h[:-1]) & (row[1:] == row[:-1])], minlength=n)
    owner = np.repeat(np.arange(n), np.diff(at))
    share = lambda mask: np.bincount(owner[mask], minlength=n) / size
    shape = [np.log1p(w.count), np.bincount(rs[start], minlength=n) / words, most / words, again / words,
             np.bincount(row, w.end - w.start, n) / words, share((raw >= 65) & (raw <= 90)), share((raw >= 48) & (raw <= 57)),
             *(share(raw == c[0]) for c in _COUNTED)]
    return np.column_stack([hashed, *shape])


def metadata_view(batch: pa.RecordBatch) -> np.ndarray:
    """Source and language, hashed, and the length that the table states."""
    n, out = batch.num_rows, []
    for name in ("source", "lang"):
        values = batch.column(name).fill_null("").dictionary_encode()
        codes = np.array([int(mix(np.array([sum((i + 1) * c for i, c in enumerate(str(v).encode()))], np.uint64))[0] % SOURCE_BUCKETS)
                          for v in values.dictionary.to_pylist()], dtype=np.int64)
        hot = np.zeros((n, SOURCE_BUCKETS))
        hot[np.arange(n), codes[np.asarray(values.indices)]] = 1
        out.append(hot)
    length = np.log1p(np.maximum(np.asarray(batch.column("n_chars").fill_null(0), dtype=float), 0))
    return np.column_stack([*out, length, length ** 2 / 10])


class Logistic:
    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 300):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        self.w, self.b = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
        m, v = np.zeros(len(self.w) + 1), np.zeros(len(self.w) + 1)
        for t in range(1, steps + 1):
            error = _squash(z @ self.w + self.b) - y
            g = np.append(z.T @ error / len(y) + ridge * self.w, error.mean())
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            self.w, self.b = self.w - step[:-1], self.b - step[-1]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.w + self.b


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class CoTrained:
    def __init__(self, views: list[np.ndarray], label: np.ndarray, check: np.ndarray):
        """``label``: 1, 0 or -1 for none; ``check`` marks labelled rows kept for calibration."""
        known = (label >= 0) & ~check
        marks = [np.where(known, label, -1) for _ in views]
        for _ in range(ROUNDS):
            models = [Logistic(x[m >= 0], m[m >= 0].astype(float)) for x, m in zip(views, marks, strict=True)]
            for i, model in enumerate(models):
                other = marks[1 - i]
                p = _squash(model.logit(views[i]))
                free = np.flatnonzero((label < 0) & (other < 0))
                for value, sure in ((1, p), (0, 1 - p)):
                    best = free[np.argsort(-sure[free], kind="stable")[:max(1, int(SHARE * len(free)))]]
                    best = best[(sure[best] >= SURE) & (other[best] < 0)]
                    other[best] = value
        self.models = [Logistic(x[m >= 0], m[m >= 0].astype(float)) for x, m in zip(views, marks, strict=True)]
        held = check if check.any() and 0 < label[check].mean() < 1 else known
        y = label[held].astype(float)
        raw = [model.logit(x[held])[:, None] for model, x in zip(self.models, views, strict=True)]
        self.calibration = [Logistic(r, y) for r in raw]
        self.vote = Logistic(np.column_stack([c.logit(r) for c, r in zip(self.calibration, raw, strict=True)]), y)

    def score(self, views: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        each = [c.logit(m.logit(x)[:, None]) for c, m, x in zip(self.calibration, self.models, views, strict=True)]
        return _squash(self.vote.logit(np.column_stack(each))), [_squash(e) for e in each]


def _views(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [text_view(batch.column("text")), metadata_view(batch)]


def fit(docs: DataFrame, labels: DataFrame) -> CoTrained | None:
    marked = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000))
    docs = docs.select("doc_id", "text", "source", "lang", "n_chars")  # other columns may have the names used here
    usable = docs.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 2))
    n_labelled, n = marked.count(), docs.count()
    if not n_labelled or not n:
        return None
    some = marked.filter(draw < int(min(1.0, LABELLED / n_labelled) * 1_000_000))
    # at most one row in a few is a candidate, so the label join moves few texts
    rest = usable.filter(draw < int(min(1.0, UNLABELLED / n) * 1_000_000)).join(marked, "doc_id", "left_anti").withColumn("label", F.lit(-1))
    taught = usable.join(F.broadcast(some), "doc_id")
    sample = taught.unionByName(rest).select(
        F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        F.col("n_chars").cast("double").alias("n_chars"), "label", (fold(F.col("doc_id")) == 3).alias("check"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            views = [pa.FixedSizeListArray.from_arrays(pa.array(v.astype(np.float32).ravel()), v.shape[1]).cast(pa.list_(pa.float32())) for v in _views(b)]
            yield pa.RecordBatch.from_arrays([*views, b.column("label"), b.column("check")], ["a", "b", "label", "check"])

    found = sample.mapInArrow(measure, "a array<float>, b array<float>, label int, check boolean").toArrow().combine_chunks()
    label, check = np.asarray(found.column("label")), np.asarray(found.column("check")) & (np.asarray(found.column("label")) >= 0)
    known = label[(label >= 0) & ~check]
    if not len(known) or known.min() == known.max():
        return None
    views = []
    for c in ("a", "b"):
        column = found.column(c).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        views.append(np.asarray(column.flatten(), dtype=np.float64).reshape(len(label), -1))
    return CoTrained(views, label, check)


def score_quality(docs: DataFrame, labels: DataFrame, keep: list[Column]) -> DataFrame:
    """(row, score, text_score, metadata_score): ``row`` is a struct of the ``keep`` columns, scores in 0 … 1.

    ``docs`` has doc_id, text, source, lang and n_chars, any of which may be null (an empty text, a
    source or language of its own, length 0). Documents of fold 2 are held out of all training. An id with
    several labels counts as the lowest; null labels do not count. Without labels of both kinds every
    score is 0.5. Repeated rows score alike; an empty table gives no rows; other columns do not matter, whatever their names.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    work = docs.select(F.struct(*keep).alias("row"), *[F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")],
                       F.col("n_chars").cast("double").alias("n_chars"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            half = np.full(b.num_rows, 0.5)
            score, each = model.value.score(_views(b)) if model.value else (half, [half, half])
            yield pa.RecordBatch.from_arrays([b.column("row"), *(pa.array(s) for s in (score, *each))], ["row", "score", "text_score", "metadata_score"])

    double = [T.StructField(c, T.DoubleType()) for c in ("score", "text_score", "metadata_score")]
    return work.mapInArrow(run, T.StructType([work.schema["row"], *double]))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = score_quality(docs, labels, [F.col("doc_id")])
    return found.select("row.doc_id", F.coalesce(fold(F.col("row.doc_id")) == 2, F.lit(False)).alias("held_out"), "score", "text_score", "metadata_score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
