"""Boosted regression trees on sets of bits, grown by grouped sums and kept as a table.

A level of a tree is one aggregation: every row adds its weight and its weighted residual to (node, bit) for each of its
bits, which combines on the map side to nodes × bits rows, whatever the number of rows. Labels, residuals and leaf
values are whole numbers of 1 / ``SCALE``, so sums do not depend on the order of rows or tasks: the same rows give the same
model on any cluster, after a lost executor too. Between tasks and driver go at most 2^depth numbers a level.

Nodes are numbered as in a heap: 1 is the root, 2n holds the rows of n without the bit, 2n + 1 those with it.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaylake.session import materialize

SCALE = 1_000_000  # labels are rounded to this fraction
WRITE_EVERY = 20  # trees between two written states of the residuals
MODEL_SCHEMA = "tree int, node int, bit int, gain double, n bigint, value bigint"
_WORD = 64


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once a row, although ``then`` names it inside of loops."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _rows_of(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, bit) of all bits of a column of sets."""
    flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
    there = np.asarray(flat.is_valid())
    return row[there], np.asarray(flat.drop_null()).astype(np.int64)


def words(bits: Column, n_bits: int) -> Column:
    """The set as 64-bit words, in which a bit is found without a search."""
    n_words = (n_bits - 1) // _WORD + 1

    def pack(sets: pa.Array) -> pa.Array:
        row, bit = _rows_of(sets)
        inside = (bit >= 0) & (bit < n_words * _WORD)
        packed = np.zeros(len(sets) * n_words, dtype=np.uint64)
        np.bitwise_or.at(packed, row[inside] * n_words + bit[inside] // _WORD, np.uint64(1) << (bit[inside] % _WORD).astype(np.uint64))
        ends = pa.array(np.arange(len(sets) + 1) * n_words, pa.int32())
        return pa.ListArray.from_arrays(ends, pa.array(packed.view(np.int64)), mask=sets.is_null())

    pack.__annotations__ = {"sets": pa.Array, "return": pa.Array}
    return F.arrow_udf(pack, "array<bigint>")(bits)


def _node_of(packed: Column, bits: Column, depth: int) -> Column:
    """The node a set ends up in; ``bits`` has the bit of each inner node by number, -1 for a leaf."""

    def step(node: Column) -> Column:
        bit = F.get(bits, node)
        has = F.getbit(F.get(packed, F.shiftright(bit, 6)), bit.bitwiseAND(_WORD - 1)).cast("int")
        return F.when(bit < 0, node).otherwise(node * 2 + has)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(1), lambda node, _: step(node))


@dataclass
class Trees:
    """A model: base value, and for each tree rows (tree, node, bit, gain, n, value); a leaf has no bit, an inner node no value."""

    base: int
    depth: int
    nodes: list[tuple] = field(default_factory=list)

    def count(self) -> int:
        return 1 + max((r[0] for r in self.nodes), default=-1)

    def table(self, spark: SparkSession) -> DataFrame:
        """The model as rows; tree -1 holds the base value. It has trees × 2^(depth + 1) rows at most."""
        base = (-1, 1, None, None, None, self.base)
        return spark.createDataFrame([base, *self.nodes], MODEL_SCHEMA)

    @classmethod
    def of(cls, table: DataFrame) -> Trees:
        """A model read back from its table."""
        rows = [tuple(r) for r in table.select("tree", "node", "bit", "gain", "n", "value").orderBy("tree", "node").collect()]
        deepest = max((r[1] for r in rows if r[0] >= 0), default=1).bit_length() - 1
        return cls(next(r[5] for r in rows if r[0] < 0), deepest, [r for r in rows if r[0] >= 0])

    def first(self, n_trees: int) -> Trees:
        return Trees(self.base, self.depth, [r for r in self.nodes if r[0] < n_trees])

    def value(self, packed: Column, since: int = 0) -> Column:
        """What the trees from number ``since`` on say of a set given as ``words``, in 1 / ``SCALE``; without the base."""
        size = 2 << self.depth
        trees = [{"bit": [-1] * size, "value": [0] * size} for _ in range(since, self.count())]
        for tree, node, bit, _, _, value in self.nodes:
            if tree >= since:
                trees[tree - since]["bit"][node] = -1 if bit is None else bit
                trees[tree - since]["value"][node] = value or 0
        zero = F.lit(0).cast("bigint")
        if not trees:
            return zero
        model = F.from_json(F.lit(json.dumps(trees)), "array<struct<bit: array<int>, value: array<bigint>>>")  # folded to one constant

        return F.aggregate(model, zero, lambda acc, tree: acc + F.get(tree["value"], _node_of(packed, tree["bit"], self.depth)))

    def predict(self, rows: DataFrame, n_bits: int, features: str = "bits", prediction: str = "prediction") -> DataFrame:
        """``rows`` with a prediction, row by row: no shuffle and no Python. A row without a set gets null."""
        total = _once(words(F.col(features), n_bits), lambda packed: self.value(packed) + F.lit(self.base))
        return rows.withColumn(prediction, F.when(F.col(features).isNotNull(), total.cast("double") / F.lit(float(SCALE))))


def bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of w and wr of each (node, bit) of a batch of rows (node, w, wr, bits); bit -1 is in every row with a set."""
    for b in batches:
        b = b.filter(b.column("bits").is_valid())
        if not b.num_rows:
            continue
        nodes, node = np.unique(np.asarray(b.column("node")), return_inverse=True)
        row, bit = _rows_of(b.column("bits"))
        row, bit = np.concatenate([np.arange(b.num_rows), row]), np.concatenate([np.full(b.num_rows, -1), bit])
        span = int(bit.max()) + 2
        key = node[row] * span + bit + 1
        if len(nodes) * span <= 1 << 22:
            found, at, size = None, key, len(nodes) * span
        else:
            found, at = np.unique(key, return_inverse=True)
            size = len(found)
        sums = [np.zeros(size, dtype=np.int64) for _ in range(2)]
        for total, c in zip(sums, ("w", "wr"), strict=True):
            np.add.at(total, at, np.asarray(b.column(c).fill_null(0)).astype(np.int64)[row])
        if found is None:
            found = np.flatnonzero(np.bincount(at, minlength=size))
            sums = [total[found] for total in sums]
        columns = [nodes[found // span].astype(np.int64), found % span - 1, *sums]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "bit", "n1", "s1"])


def best_splits(rows: DataFrame, min_rows: int) -> list:
    """(node, n, s, best) of each node of rows (node, w, r, bits); ``best`` is (gain, -bit, n1, s1) or null.

    Bit -1 is in every row, so one aggregation gives the sums of nodes and of bits; a task sums its batches before. A split
    leaves weight ``min_rows`` on both sides and lowers the squared error; of equal gains the smallest bit wins.
    """
    sums = rows.select("node", "w", (F.col("w") * F.col("r")).alias("wr"), "bits").mapInArrow(bit_sums, "node bigint, bit bigint, n1 bigint, s1 bigint")
    sums = sums.groupBy("node", "bit").agg(F.sum("n1").alias("n1"), F.sum("s1").alias("s1"))
    whole = Window.partitionBy("node")  # at most one row a bit
    total = lambda c: F.max(F.when(F.col("bit") == -1, F.col(c))).over(whole)
    both = sums.select("*", total("n1").alias("n"), total("s1").alias("s"))
    d = lambda c: F.col(c).cast("double")
    rest_s, rest_n = (F.col("s") - F.col("s1")).cast("double"), (F.col("n") - F.col("n1")).cast("double")
    gain = F.try_divide(d("s1") * d("s1"), d("n1")) + F.try_divide(rest_s * rest_s, rest_n) - F.try_divide(d("s") * d("s"), d("n"))
    fits = (F.col("bit") >= 0) & (F.col("n1") >= min_rows) & (F.col("n") - F.col("n1") >= min_rows) & (gain > 0)
    best = F.max(F.when(fits, F.struct(gain.alias("gain"), (-F.col("bit")).alias("neg"), F.col("n1"), F.col("s1"))))
    return both.groupBy("node").agg(F.max("n").alias("n"), F.max("s").alias("s"), best.alias("best")).collect()


def grow(rows: DataFrame, n_bits: int, trees: int, depth: int, rate: float, label: str = "label", features: str = "bits",
         weight: str | None = None, min_rows: int = 1, valid: DataFrame | None = None, patience: int = 10) -> Trees:
    """Squared-error boosting on the rows with a label, a set and a weight above 0 (whole numbers; 1 without a column).

    With ``valid`` rows growth ends once ``patience`` trees have not lowered their squared error, and the model ends
    with the tree of the lowest. Without a training row the model is the base 0.
    """
    y = F.floor(F.col(label).cast("double") * SCALE + 0.5).cast("bigint")
    usable = F.col(label).isNotNull() & ~F.isnan(F.col(label).cast("double")) & F.col(features).isNotNull()

    def state(df: DataFrame, w: Column) -> DataFrame:
        return df.filter(usable).select(w.cast("bigint").alias("w"), y.alias("r"), F.col(features).alias("bits"), words(F.col(features), n_bits).alias("packed"))

    train = materialize(state(rows, F.col(weight) if weight else F.lit(1)).filter("w > 0"), "boost")
    check = materialize(state(valid, F.lit(1)), "boost_valid") if valid is not None else None
    n, s = train.agg(F.sum("w"), F.sum(F.col("w") * F.col("r"))).first()
    model = Trees(_rounded(s, n) if n else 0, depth)
    if not n:
        return model
    base, written = model.base, 0
    best, best_at = None, 0
    for tree in range(trees):
        left = F.col("r") - F.lit(base) - model.value(F.col("packed"), written)
        current = train.select("w", left.alias("r"), "bits", "packed")
        if tree and tree % WRITE_EVERY == 0:
            train, base, written = materialize(current, "boost"), 0, tree
            current = train
        model.nodes += _tree(current, tree, depth, rate, min_rows)
        if check is not None:
            off = (F.col("r") - F.lit(model.base) - model.value(F.col("packed"))).cast("double")
            error = check.agg(F.sum(off * off)).first()[0]
            if best is None or (error is not None and error < best):
                best, best_at = error, tree
            if error is None or tree - best_at >= patience:
                return model.first(best_at + 1)
    return model.first(best_at + 1) if check is not None else model


def _rounded(s: int, n: int, rate: float = 1.0) -> int:
    """rate × s / n to the nearest whole number, in the steps of double arithmetic that SQL takes."""
    return math.floor(rate * (float(s) / float(n)) + 0.5)


def _tree(rows: DataFrame, tree: int, depth: int, rate: float, min_rows: int) -> list[tuple]:
    """Rows of one tree; every level is one job over ``rows`` (w, r, bits, packed)."""
    out: list[tuple] = []
    sums: dict[int, tuple[int, int]] = {}
    split: dict[int, int] = {}
    for level in range(depth):
        if level and not any(p >> (level - 1) == 1 for p in split):
            break
        known = F.from_json(F.lit(json.dumps([split.get(i, -1) for i in range(2 << depth)])), "array<int>")
        node = _node_of(F.col("packed"), known, level) if level else F.lit(1)
        for r in best_splits(rows.select(node.alias("node"), "w", "r", "bits").filter(F.col("node") >= 1 << level), min_rows):
            sums[r["node"]] = (r["n"], r["s"])
            if r["best"]:
                n1, s1 = r["best"]["n1"], r["best"]["s1"]
                split[r["node"]] = -r["best"]["neg"]
                out.append((tree, r["node"], split[r["node"]], float(r["best"]["gain"]), r["n"], None))
                sums[2 * r["node"]], sums[2 * r["node"] + 1] = (r["n"] - n1, r["s"] - s1), (n1, s1)
    return sorted(out + [(tree, i, None, None, n, _rounded(s, n, rate)) for i, (n, s) in sums.items() if i not in split], key=lambda r: r[1])


def importance(model: DataFrame) -> DataFrame:
    """(importance_rank, bit, importance, n_splits): each bit's share of all gains of a model table, all bits that split."""
    gains = model.filter("bit IS NOT NULL").groupBy("bit").agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("n_splits"))
    share = F.round(F.col("gain") / F.sum("gain").over(Window.partitionBy()), 9)
    order = Window.orderBy(F.col("importance").desc(), "bit")  # at most as many rows as bits
    return gains.select("bit", share.alias("importance"), "n_splits").select(
        F.row_number().over(order).alias("importance_rank"), "bit", "importance", "n_splits")


def ensemble(members: Sequence[Trees], rows: DataFrame, n_bits: int, features: str = "bits") -> DataFrame:
    """``rows`` with ``prediction`` and ``uncertainty``: mean and sample spread of the members, one pass over the rows."""
    said = _once(words(F.col(features), n_bits), lambda packed: F.array(*[m.value(packed) + F.lit(m.base) for m in members]))
    rows = rows.withColumn("_said", said)
    each = [F.get("_said", F.lit(i)).cast("double") / F.lit(float(SCALE)) for i in range(len(members))]
    mean = sum(each, F.lit(0.0)) / F.lit(float(len(members)))
    spread = sum(((p - mean) * (p - mean) for p in each), F.lit(0.0)) / F.lit(float(max(1, len(members) - 1)))
    return rows.withColumn("prediction", mean).withColumn("uncertainty", F.sqrt(spread)).drop("_said")
