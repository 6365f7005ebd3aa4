"""Benchmark decontamination: an FM-index per training shard, searched backwards for the benchmark's windows.

A task walks its documents shard by shard (a few megabytes of text). The shard's words become the text
of an FM-index: suffix order, Burrows-Wheeler transform, wavelet-matrix ranks, sampled suffix positions.
All windows of the benchmark are then searched at once, last word first; what is left of an interval is
located by stepping back to a sampled position. Documents are neither shuffled nor joined: the
benchmark is the query set and goes to the documents, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.llm.words import blocks, words_of

WINDOW = 13
SHARD_BYTES = 8_000_000
BLOCK_WORDS = 1_000_000  # benchmark words searched in one pass over the documents, in the mean
SAMPLE = 32

FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("first", T.ArrayType(T.IntegerType())), T.StructField("last", T.ArrayType(T.IntegerType())),
    T.StructField("start", T.ArrayType(T.IntegerType())), T.StructField("end", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType()))])
_FOUND = pa.struct([("n_words", pa.int64()), *[(c, pa.list_(pa.int32())) for c in ("first", "last", "start", "end")],
                    ("items", pa.list_(pa.string()))])


class FmIndex:
    """Tokens over 1 … ``symbols``; 0 separates runs. The text begins and ends with 0, and no search crosses a 0."""

    def __init__(self, tokens: np.ndarray, symbols: int):
        n = len(tokens)
        gap = tokens == 0
        gaps = int(gap.sum())
        rank = tokens.astype(np.int64) + gaps
        rank[gap] = np.arange(gaps)  # each separator is a symbol of its own, so all suffixes differ
        order, step = np.argsort(rank, kind="stable"), 1
        while True:  # prefix doubling
            after = np.zeros(n, dtype=np.int64)
            after[:n - step] = rank[step:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(n, dtype=np.int64)
            new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank, step = new, step * 2
            if rank.max() == n - 1:
                break
        seq = tokens[order - 1]
        self.n, self.bits = n, symbols.bit_length()
        self.smaller = gaps + np.concatenate([[0, 0], np.cumsum(np.bincount(tokens[~gap], minlength=symbols + 1)[1:])])
        self.ones, self.zeros = [], []
        for level in range(self.bits - 1, -1, -1):
            bit = (seq >> level) & 1
            ones = np.zeros(n + 1, dtype=np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        run_start = np.zeros(n, dtype=bool)
        run_start[1:] = gap[:-1]
        sampled = (order % SAMPLE == 0) | run_start[order]
        self.known = np.where(sampled, order, -1).astype(np.int32)

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol among the first ``upto`` entries of the transform."""
        low, high = np.zeros_like(upto), upto
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            set_ = (symbol >> (self.bits - 1 - i)) & 1 == 1
            a, b = ones[low], ones[high]
            low, high = np.where(set_, zeros + a, low - a), np.where(set_, zeros + b, high - b)
        return high - low

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix that begins one token earlier."""
        symbol, low, high = np.zeros_like(row), np.zeros_like(row), row
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            set_ = ones[high + 1] - ones[high] == 1
            a, b = ones[low], ones[high]
            low, high = np.where(set_, zeros + a, low - a), np.where(set_, zeros + b, high - b)
            symbol = symbol * 2 + set_
        return self.smaller[symbol] + high - low

    def locate(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``windows``, position) of every occurrence."""
        which = np.arange(len(windows))
        low, high = np.zeros(len(windows), dtype=np.int64), np.full(len(windows), self.n, dtype=np.int64)
        for j in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[which, j].astype(np.int64)
            base = self.smaller[symbol]
            low, high = base + self.rank(symbol, low), base + self.rank(symbol, high)
            some = high > low
            which, low, high = which[some], low[some], high[some]
        times = high - low
        which = np.repeat(which, times)
        row = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(len(which)) if len(which) else low
        steps, at = np.zeros(len(row), dtype=np.int64), np.full(len(row), -1, dtype=np.int64)
        todo = np.arange(len(row))
        while len(todo):
            known = self.known[row[todo]]
            done = known >= 0
            at[todo[done]] = known[done] + steps[todo[done]]
            todo = todo[~done]
            row[todo] = self.back(row[todo])
            steps[todo] += 1
        return which, at


class Probe:
    """The distinct windows of a block of benchmark items, by length, and the items that own each."""

    def __init__(self, words: np.ndarray, ids: np.ndarray, first: np.ndarray, names: list[str], window: int):
        self.words, self.names, self.groups = words, names, []  # groups: (windows, start of each one's owners, owners)
        count = np.diff(first)
        long = np.flatnonzero(count >= window)
        for length in np.unique(np.append(count[(count > 0) & (count < window)], [window] if len(long) else [])).astype(int):
            items = long if length == window else np.flatnonzero(count == length)
            per = count[items] - length + 1
            owner = np.repeat(items, per)
            start = np.repeat(first[items] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())
            matrix = ids[start[:, None] + np.arange(length)]
            order = np.lexsort([owner, *matrix.T[::-1]])
            matrix, owner = matrix[order], owner[order]
            new = np.concatenate([[True], (matrix[1:] != matrix[:-1]).any(axis=1)])
            at = np.flatnonzero(new)
            self.groups.append((matrix[at], np.append(at, len(owner)), owner))
        self.shortest = min((g[0].shape[1] for g in self.groups), default=0)


def _probe(texts: list, names: list[str], window: int) -> Probe:
    w = words_of(pa.array(texts, pa.string()))
    words, ids = np.unique(w.hashes(), return_inverse=True)
    return Probe(words, ids.astype(np.int32) + 1, w.first, names, window)


class _Shard:
    """Rows gathered for one index: runs of benchmark words that are long enough to hold a window."""

    def __init__(self, probe: Probe):
        self.probe, self.batches, self.bytes, self.rows = probe, [], 0, 0
        self.tokens, self.row, self.word, self.start, self.end, self.counts = [np.zeros(1, np.int32)], [], [], [], [], []

    def add(self, batch: pa.RecordBatch) -> None:
        w = words_of(batch.column("text"))
        probe = self.probe
        if len(probe.words):
            h, row = w.hashes(), w.row()
            at = np.searchsorted(probe.words, h)
            at[at == len(probe.words)] = 0
            known = probe.words[at] == h
            # runs of benchmark words within a row; no window fits into a shorter run, so those are not indexed
            edge = np.ones(len(h) + 1, dtype=bool)
            if len(h):
                edge[1:-1] = (known[1:] != known[:-1]) | (row[1:] != row[:-1])
            bound = np.flatnonzero(edge)
            long = np.repeat(np.diff(bound) >= probe.shortest, np.diff(bound))
            keep = np.flatnonzero(known & long)
            if len(keep):
                chars = np.cumsum((w.data & 0xC0) != 0x80, dtype=np.int32)
                before = np.concatenate([[0], chars])[w.at[row[keep]]]
                gap = np.concatenate([[False], (np.diff(keep) != 1) | (np.diff(row[keep]) != 0)])
                place = np.arange(len(keep)) + np.cumsum(gap)
                size = place[-1] + 2  # a separator between runs and one at the end

                def spread(values: np.ndarray, fill: int) -> np.ndarray:
                    out = np.full(size, fill, dtype=np.int32)
                    out[place] = values
                    return out

                self.tokens.append(spread(at[keep] + 1, 0))
                self.row.append(spread(row[keep] + self.rows, -1))
                self.word.append(spread(keep - w.first[row[keep]], -1))
                self.start.append(spread(chars[w.start[keep]] - 1 - before, -1))
                self.end.append(spread(chars[w.end[keep] - 1] - before, -1))
        self.counts.append(w.count)
        self.batches.append(batch)
        self.bytes += len(w.data)
        self.rows += batch.num_rows

    def search(self) -> tuple[dict[int, np.ndarray], dict[int, set[str]]]:
        """Hit tokens (indices into the shard) and items of each row that has any."""
        tokens = np.concatenate(self.tokens)
        if len(tokens) == 1:
            return {}, {}
        index = FmIndex(tokens, len(self.probe.words))
        row = np.concatenate([[-1], *self.row]).astype(np.int64)
        change = np.zeros(len(tokens) + 1, dtype=np.int32)
        pairs = []
        for windows, owned, owner in self.probe.groups:
            which, at = index.locate(windows)
            np.add.at(change, at, 1)
            np.add.at(change, at + windows.shape[1], -1)
            # an item is named once for a row, however often its windows occur there
            seen = np.unique(which * self.rows + row[at])
            which, rows = seen // self.rows, seen % self.rows
            per = owned[which + 1] - owned[which]
            items = owner[np.repeat(owned[which] - np.concatenate([[0], np.cumsum(per)[:-1]]), per) + np.arange(per.sum())] if len(which) else owner[:0]
            pairs.append(np.unique(np.repeat(rows, per) * len(self.probe.names) + items))
        hit = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        hits = {int(r): part for r, part in zip(np.unique(row[hit]), np.split(hit, np.flatnonzero(np.diff(row[hit])) + 1), strict=True)} if len(hit) else {}
        items: dict[int, set[str]] = {}
        for pair in np.unique(np.concatenate(pairs)):
            items.setdefault(int(pair // len(self.probe.names)), set()).add(self.probe.names[pair % len(self.probe.names)])
        return hits, items

    def results(self) -> list[dict]:
        hits, items = self.search()
        counts = np.concatenate(self.counts)
        word, start, end = (np.concatenate([[-1], *x]) for x in (self.word, self.start, self.end))
        out = [{"n_words": int(n), "first": [], "last": [], "start": [], "end": [], "items": []} for n in counts]
        old = [x for b in self.batches for x in b.column("found").to_pylist()]
        for r in {*hits, *(i for i, x in enumerate(old) if x and x["items"])}:
            runs = []
            if old[r]:
                runs += zip(*(old[r][c] for c in ("first", "last", "start", "end")), strict=True)
            if r in hits:
                t = hits[r]
                cut = np.concatenate([[0], np.flatnonzero(np.diff(word[t]) != 1) + 1, [len(t)]])
                runs += [(int(word[t[a]]), int(word[t[b - 1]]) + 1, int(start[t[a]]), int(end[t[b - 1]])) for a, b in zip(cut, cut[1:], strict=False)]
            merged: list[list[int]] = []
            for run in sorted(runs):
                if merged and run[0] <= merged[-1][1]:
                    if run[1] > merged[-1][1]:
                        merged[-1][1], merged[-1][3] = run[1], run[3]
                else:
                    merged.append(list(run))
            out[r] |= {c: [m[i] for m in merged] for i, c in enumerate(("first", "last", "start", "end"))}
            out[r]["items"] = sorted(items.get(r, set()) | set((old[r] or {}).get("items") or ()))
        return out


def _search_shards(batches: Iterator[pa.RecordBatch], probe: Probe, keep_text: bool, size: int) -> Iterator[pa.RecordBatch]:
    def flush(shard: _Shard) -> Iterator[pa.RecordBatch]:
        results = shard.results()
        done = 0
        for b in shard.batches:
            found = pa.array(results[done:done + b.num_rows], _FOUND)
            done += b.num_rows
            cols = {"row": b.column("row"), **({"text": b.column("text")} if keep_text else {}), "found": found}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    shard = _Shard(probe)
    for block in blocks(batches):
        shard.add(block)
        if shard.bytes >= size:
            yield from flush(shard)
            shard = _Shard(probe)
    if shard.batches:
        yield from flush(shard)


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: list[Column], text_col: str = "text", item_col: str = "item_id",
                       item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
                       shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row, found): ``row`` is a struct of the ``keep`` columns of each document, ``found`` what of the benchmark occurs in it.

    ``found.n_words`` counts words; runs of hit words are ``first[i]`` up to ``last[i]`` (in words) and
    ``start[i]`` up to ``end[i]`` (in characters of the original text), merged and in order; ``items`` are
    the sorted ids, as strings, of the items that have a window in the document. A window is ``window``
    consecutive words of an item; an item of fewer, but not none, is one window.

    The benchmark is searched in blocks of about ``block_words`` words, one pass over the documents
    each; a pass adds its runs to those before. Words are compared by 64-bit hashes.

    Null and empty texts have no words. An item without an id has the id ''; items that repeat an id
    count once. Documents that repeat are separate rows. An empty benchmark finds nothing; an empty
    table gives no rows. Other columns are carried in ``row`` whatever their names.
    """
    spark = docs.sparkSession
    names = F.coalesce(F.col(item_col).cast("string"), F.lit(""))
    items = benchmark.select(names.alias("name"), F.col(item_text).alias("text"))
    total = items.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    n_blocks = max(1, -(-total // block_words))
    work = docs.select(F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast(FOUND).alias("found"))
    row_type = work.schema["row"]
    for b in range(n_blocks):
        part = items if n_blocks == 1 else items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n_blocks)) == b)
        local = part.collect()  # one block of the query set
        probe = spark.sparkContext.broadcast(_probe([r["text"] for r in local], [r["name"] for r in local], window))
        last = b == n_blocks - 1
        schema = T.StructType([row_type, *([] if last else [T.StructField("text", T.StringType())]), T.StructField("found", FOUND)])
        work = work.mapInArrow(lambda it, p=probe, k=not last: _search_shards(it, p.value, k, shard_bytes), schema)
    return work


def n_hit(found: str = "found") -> Column:
    return F.aggregate(F.zip_with(f"{found}.first", f"{found}.last", lambda a, b: (b - a).cast("bigint")), F.lit(0).cast("bigint"), lambda s, x: s + x)


def is_contaminated(hit: Column, words: Column) -> Column:
    """At least a twentieth of the words, and at least one, lie in occurrences of benchmark windows."""
    return (hit > 0) & (20 * hit >= words)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, number and digest of the items found, and the verdict."""
    found = find_contamination(docs, benchmark, [F.col("doc_id")])
    return found.select("row.doc_id", "found.n_words", n_hit().alias("n_hit"), F.size("found.items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256")).withColumn(
        "contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents without those that the benchmark contaminates, all columns as they were."""
    found = find_contamination(docs, benchmark, [F.col(f"`{c}`") for c in docs.columns], text_col)
    return found.filter(~is_contaminated(n_hit(), F.col("found.n_words"))).select("row.*")
