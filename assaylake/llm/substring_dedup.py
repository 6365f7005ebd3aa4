"""Substring dedup: lines and runs of words are hashed, grouped over the whole table, and later occurrences removed.

Of all runs of ``MIN_WORDS`` words the least hash of half as many words is a run's print, which depends on
the run's words only. Runs whose print occurs once cannot repeat; the others are compared by hashes of all
their words. So a passage is found word by word wherever it begins and ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm.near_dedup import text_key
from assaylake.llm.words import Words, blocks, mix, text_bytes
from assaylake.session import materialize

MIN_WORDS = 50  # words of a repeated run, or of a run of repeated lines, from which it is removed
_TOKEN = re.compile(r"[^\t-\r\x1c-\x1f ]+")
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[*range(9, 14), *range(28, 33)]] = True
_LINE = re.compile(r"[^\n]*\n?")
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def units(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised line) of each line that has words; the end lies behind the line break."""
    out = []
    for m in _LINE.finditer(text):
        words = m.group().lower().split()
        if words:
            out.append((m.start(), m.end(), " ".join(words)))
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[tuple] = []
        for id_, key, text in zip(b.column("id").to_pylist(), b.column("key").to_pylist(), b.column("text"), strict=True):
            for i, (_, _, line) in enumerate(units(text.as_py() or "")):
                rows.append((xxhash.xxh3_128_digest(line.encode()), id_, key, i))
            if len(rows) > 100_000:
                yield _unit_batch(rows, b.schema)
                rows = []
        yield _unit_batch(rows, b.schema)


def _unit_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
    kinds = [pa.binary(), schema.field("id").type, pa.binary(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["digest", "id", "key", "unit"])


def _tokens(texts: pa.Array) -> Words:
    """Lower-cased words between white space, those of ``_TOKEN``."""
    data, at = text_bytes(pc.utf8_lower(texts))
    inside = np.concatenate([[False], ~_IS_SPACE[data], [False]])
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Words(data, at, start, end, np.searchsorted(start, at).astype(np.int64))


def word_runs(texts: pa.Array, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of ``min_words`` words its row, its first word in the row, its print, the print's place, and its own hash."""
    w = _tokens(texts)
    h, row, half = w.hashes(), w.row(), (min_words + 1) // 2
    n = len(h) - min_words + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none
    part = np.zeros(len(h) - half + 1, dtype=np.uint64)
    for j in range(half):
        part = part * np.uint64(0xD6E8FEB86659FD93) + h[j:j + len(part)]
    part = mix(part)
    at = np.flatnonzero(row[:n] == row[min_words - 1:])
    least = np.lib.stride_tricks.sliding_window_view(part, min_words - half + 1)[:n].argmin(axis=1)[at] + at
    own = mix(part[at] * np.uint64(0x9E3779B97F4A7C15) + part[at + min_words - half])
    return row[at], at - w.first[row[at]], part[least].view(np.int64), least, own.view(np.int64)


def _prints(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(print, id, key, n): each print of a text and at how many places it is one."""
    for b in blocks(batches):
        row, _, print_, least, _ = word_runs(b.column("text"), min_words)
        _, one = np.unique(least, return_index=True)
        pair, n = np.unique(np.column_stack([row[one], print_[one]]), axis=0, return_counts=True)
        at = pa.array(pair[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(pair[:, 1]), b.column("id").take(at), b.column("key").take(at), pa.array(n.astype(np.int64))],
                                         ["print", "id", "key", "n"])


def _runs(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(print, own, id, key, unit): the runs whose print is among the row's ``prints``."""
    for b in blocks(batches):
        row, unit, print_, _, own = word_runs(b.column("text"), min_words)
        prints = b.column("prints")
        asked = np.asarray(prints.flatten())
        of = np.repeat(np.arange(b.num_rows), np.asarray(pc.list_value_length(prints)))
        # pairs of row and print as one number each
        values, number = np.unique(np.concatenate([asked, print_]), return_inverse=True)
        good = np.isin(number[len(asked):] * b.num_rows + row, number[:len(asked)] * b.num_rows + of)
        at = pa.array(row[good])
        yield pa.RecordBatch.from_arrays([pa.array(print_[good]), pa.array(own[good]), b.column("id").take(at), b.column("key").take(at),
                                          pa.array(unit[good].astype(np.int32))], ["print", "own", "id", "key", "unit"])


def run_spans(text: str, firsts: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Character spans that the runs beginning at these words cover, with the blanks behind them, and the line break if they begin a line."""
    if not firsts:
        return []
    places = [m.span() for m in _TOKEN.finditer(text)]
    spans: list[tuple[int, int]] = []
    begin = last = -1
    for i in [*sorted(firsts), len(places) + min_words]:
        if begin >= 0 and i > last + 1:
            start, end = places[begin][0], places[last][1]
            while end < len(text) and text[end] in " \t":
                end += 1
            if end < len(text) and text[end] == "\n" and (start == 0 or text[start - 1] == "\n"):
                end += 1
            spans.append((start, end))
            begin = -1
        if begin < 0:
            begin = i
        last = i + min_words - 1
    return spans


def cut(text: str, repeated: set[int], min_words: int = MIN_WORDS, runs: list[int] | None = None) -> tuple[str, list[dict]]:
    """The text without runs of repeated lines that hold ``min_words`` words or more and without the repeated runs that begin
    at the words ``runs``, and the removed spans."""
    spans: list[dict] = []
    run: list[tuple[int, int, str]] = []

    def close() -> None:
        if run and sum(len(u[2].split()) for u in run) >= min_words:
            spans.append({"start": run[0][0], "end": run[-1][1]})
        run.clear()

    for i, unit in enumerate(units(text)):
        if i in repeated:
            run.append(unit)
        else:
            close()
    close()
    both = sorted([(s["start"], s["end"]) for s in spans] + run_spans(text, runs or [], min_words))
    spans = []
    for start, end in both:
        if spans and start <= spans[-1]["end"]:
            spans[-1]["end"] = max(spans[-1]["end"], end)
        else:
            spans.append({"start": start, "end": end})
    kept, at = [], 0
    for s in spans:
        kept.append(text[at:s["start"]])
        at = s["end"]
    out = "".join([*kept, text[at:]])
    return (out.rstrip("\n") if spans and spans[-1]["end"] == len(text) else out), spans


def _apply(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts, spans = [], []
        for text, repeated, runs in zip(b.column("text"), b.column("repeated"), b.column("runs"), strict=True):
            text, repeated, runs = text.as_py(), repeated.as_py(), runs.as_py()
            new, gone = cut(text, set(repeated or []), min_words, runs) if text is not None and (repeated or runs) else (text, [])
            texts.append(new)
            spans.append(gone)
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array(spans, _SPAN)], ["row", "text", "removed"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(row, text, removed): ``row`` a struct of all columns of ``docs``, the new text, and the spans taken out of the old one.

    A unit is a line with words, compared in lower case with single spaces. Its earliest occurrence by
    (id, text key, line) stands; ids rank upwards, a missing id last. Other occurrences are
    repeated; a run of repeated lines, lines without words not counted, goes if it has ``min_words``
    words together. Spans are character offsets in the original text. So a passage stays in the first
    document that has it, and short lines that many documents share stay everywhere.

    A null text stays null; an empty one stays empty; rows that agree in id and text are one document
    and lose the same lines; long texts are handled whole; an empty table gives no rows.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"),
                        text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    lines = materialize(keyed.select("id", "key", "text").mapInArrow(_digests, f"digest binary, id {id_type}, key binary, unit int"), "lines")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "key", "unit")
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))

    def firsts(df: DataFrame, by: list[str], name: str) -> DataFrame:
        return materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).filter("n > 1"), name)

    later = lines.join(firsts(lines, ["digest"], "firsts"), "digest").filter(~(same & (F.col("unit") == F.col("first.unit"))))
    later = materialize(later.select("key", "id", "unit"), "later")  # else its shuffle lies beside that of the runs
    of = [F.col("key").alias("_key"), F.col("id").alias("_id")]
    own = (F.col("key") == F.col("_key")) & F.col("id").eqNullSafe(F.col("_id"))
    prints = materialize(keyed.select("id", "key", "text").mapInArrow(
        lambda it: _prints(it, min_words), f"print bigint, id {id_type}, key binary, n bigint"), "prints")
    often = materialize(prints.groupBy("print").agg(F.sum("n").alias("n")).filter("n > 1").select("print"), "often")
    asked = materialize(prints.join(often, "print").groupBy(*of).agg(F.collect_set("print").alias("prints")), "asked")
    # rows that agree in id and text are one document
    texts = keyed.select("id", "key", "text").join(asked, own).select("id", "key", "text", "prints")
    runs = materialize(texts.mapInArrow(
        lambda it: _runs(it, min_words), f"print bigint, own bigint, id {id_type}, key binary, unit int"), "runs")
    later_runs = runs.join(firsts(runs, ["print", "own"], "run_firsts"), ["print", "own"]).filter(
        ~same | (F.col("unit") >= F.col("first.unit") + min_words))
    both = later.select("key", "id", "unit", F.lit(None).cast("int").alias("run")).unionByName(
        later_runs.select("key", "id", F.lit(None).cast("int").alias("unit"), F.col("unit").alias("run")))
    repeated = materialize(both.groupBy(*of).agg(F.collect_set("unit").alias("repeated"), F.collect_set("run").alias("runs")), "repeated")
    # the text is in the row: beside it, it would lie in the shuffle twice
    marked = keyed.drop("text").join(repeated, own, "left").select("row", F.col("row")[text_col].cast("string").alias("text"), "repeated", "runs")
    schema = T.StructType([marked.schema["row"], T.StructField("text", T.StringType()), T.StructField("removed", SPANS)])
    return marked.mapInArrow(lambda it: _apply(it, min_words), schema)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the new texts, and their lengths where the table has a length; all other columns as they were."""
    found = remove_repeats(docs, id_col, text_col)
    new = {text_col: F.col("text"), length_col: F.char_length("text").cast(docs.schema[length_col].dataType) if length_col in docs.columns else None}
    return found.select(*[new[c].alias(c) if new.get(c) is not None else F.col("row")[c].alias(c) for c in docs.columns])


def repeats_report(docs: DataFrame) -> DataFrame:
    """One row per document: its new text, what it lost, and where."""
    found = remove_repeats(docs)
    lost = F.aggregate("removed", F.lit(0).cast("bigint"), lambda s, x: s + (x["end"] - x["start"]).cast("bigint"))
    return found.select("row.doc_id", "text", F.size("removed").cast("bigint").alias("n_spans"), lost.alias("removed_chars"), "removed")
