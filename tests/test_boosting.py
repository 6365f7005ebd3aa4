"""The tree table against plain Python boosting on the same rows."""

import math
import random

import pytest

from assaylake.operators import boosting as B

N_BITS = 130


@pytest.fixture(scope="module")
def sets():
    draw = random.Random(5)
    out = []
    for i in range(240):
        bits = sorted(draw.sample(range(N_BITS), draw.randint(0, 12)))
        out.append((i, bits, round(-20 + 7.5 * (3 in bits) - 4 * (64 in bits) + 2 * (127 in bits) + draw.random(), 3), draw.randint(0, 2)))
    return out


def frame(spark, sets, parts=3):
    return spark.createDataFrame(sets, "id int, bits array<int>, label double, w int").repartition(parts)


def plain(rows, trees, depth, rate):
    """[(tree, node, bit)] and {id: prediction} of rows (id, bits, label, w) by the rule of the docstrings."""
    used = [(i, set(b), math.floor(y * B.SCALE + 0.5), w) for i, b, y, w in rows]
    fit = [r for r in used if r[3] > 0]
    base = math.floor(sum(r[2] * r[3] for r in fit) / sum(r[3] for r in fit) + 0.5)
    told, splits = {r[0]: base for r in used}, []
    for tree in range(trees):
        node = {r[0]: 1 for r in used}
        for level in range(depth):
            for k in sorted({n for n in node.values() if n >> level == 1}):
                here = [r for r in fit if node[r[0]] == k]
                if not here:
                    continue
                n, s = sum(r[3] for r in here), sum(r[3] * (r[2] - told[r[0]]) for r in here)
                best = None
                for bit in range(N_BITS):
                    n1 = sum(r[3] for r in here if bit in r[1])
                    s1 = sum(r[3] * (r[2] - told[r[0]]) for r in here if bit in r[1])
                    if 0 < n1 < n:
                        gain = float(s1) * float(s1) / n1 + float(s - s1) * float(s - s1) / (n - n1) - float(s) * float(s) / n
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, bit)
                if best:
                    splits.append((tree, k, best[1]))
                    for r in used:
                        if node[r[0]] == k:
                            node[r[0]] = 2 * k + (best[1] in r[1])
        value = {}
        for k in set(node.values()):
            here = [r for r in fit if node[r[0]] == k]
            if here:
                value[k] = math.floor(rate * (sum(r[3] * (r[2] - told[r[0]]) for r in here) / sum(r[3] for r in here)) + 0.5)
        for i in told:
            told[i] += value.get(node[i], 0)
    return splits, {i: v / B.SCALE for i, v in told.items()}


def inner(model):
    return sorted(r[:3] for r in model.nodes if r[2] is not None)


@pytest.mark.parametrize("write_every", [2, 20])
def test_equals_plain_boosting(spark, sets, monkeypatch, write_every):
    monkeypatch.setattr(B, "WRITE_EVERY", write_every)
    model = B.grow(frame(spark, sets), N_BITS, 5, 3, 0.3, weight="w")
    splits, told = plain(sets, 5, 3, 0.3)
    assert inner(model) == sorted(splits)
    got = {r["id"]: r["prediction"] for r in model.predict(frame(spark, sets), N_BITS).collect()}
    assert got == told


def test_same_model_whatever_the_partitions(spark, sets):
    assert B.grow(frame(spark, sets, 1), N_BITS, 3, 3, 0.3).nodes == B.grow(frame(spark, sets, 7), N_BITS, 3, 3, 0.3).nodes


def test_table_gives_the_model_back(spark, sets):
    model = B.grow(frame(spark, sets), N_BITS, 2, 2, 0.3)
    again = B.Trees.of(model.table(spark).repartition(3))
    assert (again.base, again.depth, again.nodes) == (model.base, model.depth, sorted(model.nodes, key=lambda r: r[:2]))
    best = B.importance(model.table(spark)).collect()
    assert best[0]["bit"] == 3 and abs(sum(r["importance"] for r in best) - 1) < 1e-6


def test_stops_when_the_check_rows_are_not_helped(spark, sets):
    rows = frame(spark, sets)
    noise = rows.withColumn("label", -rows["label"])
    assert B.grow(rows, N_BITS, 12, 2, 0.3, valid=noise, patience=2).count() == 1
    assert B.grow(rows, N_BITS, 4, 2, 0.3, valid=rows, patience=2).count() == 4


def test_rows_without_label_or_set(spark):
    odd = spark.createDataFrame([(1, [1], None, 1), (2, None, 3.0, 1), (3, [], float("nan"), 1)], "id int, bits array<int>, label double, w int")
    assert B.grow(odd, N_BITS, 2, 2, 0.3) == B.Trees(0, 2, [])
    model = B.grow(odd.union(spark.createDataFrame([(4, [], 2.0, 1), (5, [0], 4.0, 1), (6, [0], 4.0, 1)], odd.schema)), N_BITS, 1, 2, 1.0)
    got = {r["id"]: r["prediction"] for r in model.predict(odd, N_BITS).collect()}
    assert got == {1: 2.0, 2: None, 3: 2.0}


def test_a_batch_is_summed_before_the_shuffle():
    import pyarrow as pa

    rows = [(n, w, w * 10**15, [1, 5, 5, 900_000_000 * wide]) for wide in (0, 2) for n, w in ((2, 1), (3, 4)) for _ in range(300)] + [(2, 1, 1, None), (3, 1, 1, [])]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]),
                                        pa.array([r[3] for r in rows], pa.list_(pa.int32()))], ["node", "w", "wr", "bits"])
    want = {}
    for node, w, wr, bits in rows:
        for bit in [] if bits is None else [-1, *bits]:
            n, s = want.get((node, bit), (0, 0))
            want[node, bit] = (n + w, s + wr)
    (got,) = B.bit_sums([batch])
    assert got.num_rows == len(want)
    assert {(r["node"], r["bit"]): (r["n1"], r["s1"]) for r in got.to_pylist()} == want
