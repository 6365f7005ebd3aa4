import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from assaylake.operators import pareto
from assaylake.operators import similarity as Z
from assaylake.operators.clustering import cluster_by_similarity, leader_cluster
from conftest import rows


def random_sets(seed, n=40, universe=30, copies=10):
    rng = random.Random(seed)
    base = [frozenset(rng.sample(range(universe), rng.randint(1, 12))) for _ in range(6)]
    out = []
    for _ in range(n):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            s ^= {rng.randrange(universe)}
        out.append(sorted(s))
    return out + [out[0]] * copies + [[]]


def as_df(spark, sets, start=0):
    return spark.createDataFrame([(start + i, s) for i, s in enumerate(sets)], "id bigint, fp array<int>")


def similar(a, b, t):
    a, b = set(a), set(b)
    return len(a & b) * 1_000_000 >= len(a | b) * round(t * 1_000_000) if a and b else False


@pytest.mark.parametrize("seed,t", [(1, 0.5), (2, 0.65), (3, 0.8), (4, 0.3), (5, 1.0)])
def test_self_join_equals_brute_force(spark, seed, t):
    sets = random_sets(seed)
    reps = {}
    for i, s in enumerate(sets):
        if s:
            reps.setdefault(tuple(s), []).append(i)
    want = sorted((ia[0], ib[0], len(ia), len(ib)) for a, ia in reps.items() for b, ib in reps.items() if ia[0] < ib[0] and similar(a, b, t))
    got = Z.similarity_join(as_df(spark, sets), None, t, "id")
    assert sorted(rows(got, "rep_a", "rep_b", "copies_a", "copies_b")) == want
    for a, b, s in rows(got, "rep_a", "rep_b", "sim"):
        x, y = set(sets[a]), set(sets[b])
        assert s == pytest.approx(len(x & y) / len(x | y))


@pytest.mark.parametrize("seed", [7, 8])
def test_max_similarity_equals_brute_force(spark, seed):
    new, old = random_sets(seed), random_sets(seed + 100)
    got = dict(rows(Z.max_similarity(as_df(spark, new), as_df(spark, old), 0.4, "id"), "id", "max_sim"))
    for i, s in enumerate(new):
        sims = [len(set(s) & set(o)) / len(set(s) | set(o)) for o in old if similar(s, o, 0.4)]
        assert got[i] == pytest.approx(max(sims, default=0.0))


@pytest.mark.parametrize("seed", range(30, 34))
def test_best_partner_equals_brute_force(spark, seed):
    """Sparse and dense sets, boilerplate bits that all sets hold, copies, partners that share common bits only."""
    rng = random.Random(seed)
    common = list(range(1_000, 1_000 + rng.randrange(1, 30)))
    some = lambda n: [sorted({rng.randrange(400) for _ in range(rng.randrange(0, 40))} | set(common if rng.random() < 0.7 else [])) for _ in range(n)]
    new, old = some(40), some(60)
    old += new[:3] + [new[5] + [5_000]] * 4
    for low in (0.0, 0.3):
        got = dict(rows(Z.max_similarity(as_df(spark, new), as_df(spark, old), low, "id"), "id", "max_sim"))
        for i, s in enumerate(new):
            sims = [len(set(s) & set(o)) / len(set(s) | set(o)) for o in old if s and o]
            best = max(sims, default=0.0)
            assert got[i] == pytest.approx(best if best >= low else 0.0), (i, low)


def test_best_partner_without_any_old_set(spark):
    new, none = as_df(spark, [[1, 2], []]), as_df(spark, [[]])
    assert rows(Z.max_similarity(new, none, 0.0, "id"), "id", "max_sim") == [(0, 0.0), (1, 0.0)]


def sequential_leaders(n, edges):
    near = {i: set() for i in range(n)}
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    free, out = set(range(n)), {}
    while free:
        lead = max(free, key=lambda i: (len(near[i] & free), -i))
        for m in (near[lead] & free) | {lead}:
            out[m] = lead
        free -= set(m for m, l in out.items() if l == lead)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_leaders_equal_sequential_rule(spark, seed):
    rng = random.Random(seed)
    n = 25
    edges = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(rng.randint(5, 40))})
    nodes = spark.createDataFrame([(i, i) for i in range(n)], "id int, rank int")
    got = dict(rows(leader_cluster(nodes, spark.createDataFrame(edges, "a int, b int")), "id", "leader"))
    assert got == sequential_leaders(n, edges)


def test_path_star_and_isolated_point(spark):
    nodes = spark.createDataFrame([(c, i) for i, c in enumerate("abcx")], "id string, rank int")
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "a string, b string")
    assert dict(rows(leader_cluster(nodes, edges), "id", "leader")) == {"a": "b", "b": "b", "c": "b", "x": "x"}


@pytest.mark.parametrize("seed", [11, 12])
def test_clusters_with_copies_equal_sequential_rule(spark, seed):
    """A text that makes up a third of the rows is one weighted node and must not change the result."""
    sets = random_sets(seed, n=24, copies=14)
    n = len(sets)
    edges = [(i, j) for i in range(n) for j in range(i + 1, n) if similar(sets[i], sets[j], 0.6)]
    want = sequential_leaders(n, edges)
    df = as_df(spark, sets).withColumn("rank", F.col("id"))
    got = dict(rows(cluster_by_similarity(df, "id", "rank", "fp", 0.6), "id", "cluster_id"))
    assert got == want


def dominated(points, low):
    pts = np.array(points, dtype=float) * np.where(low, 1, -1)
    return [bool(((pts <= p).all(axis=1) & (pts < p).any(axis=1)).any()) for p in pts]


@pytest.mark.parametrize("tile,held,cells", [(2_048, 20_000, 4_096), (7, 5, 30)])
def test_pareto_equals_brute_force(spark, monkeypatch, tile, held, cells):
    for name, value in (("TILE", tile), ("HELD", held), ("CELLS", cells)):
        monkeypatch.setattr(pareto, name, value)
    rng = random.Random(tile)
    pts = [(rng.randint(0, 30), rng.randint(0, 30), rng.randint(0, 30)) for _ in range(200)] + [(30, 0, 30)] * 5
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)] + [(999, None, 1.0, 1.0)], "id int, a double, b double, c double")
    got = rows(pareto.pareto_front(df.repartition(5), [("a", True), ("b", False), ("c", True)]), "id")
    want = [i for i, d in enumerate(dominated(pts, [True, False, True])) if not d]
    assert [g[0] for g in sorted(got)] == want
    one = rows(pareto.pareto_front(df, [("a", True)]), "id")
    assert [g[0] for g in sorted(one)] == [i for i, p in enumerate(pts) if p[0] == min(x[0] for x in pts)]
    assert pareto.pareto_front(df.limit(0), [("a", True), ("b", False)]).count() == 0


def test_pareto_of_fifty_thousand_survivors(spark):
    """Points of a plane do not beat each other; those behind it are beaten."""
    plane = spark.range(50_000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b")).withColumn("c", -F.col("a") - F.col("b"))
    behind = plane.select((F.col("id") + 50_000).alias("id"), *[(F.col(c) + 1e-7).alias(c) for c in "abc"])
    front = pareto.pareto_front(plane.unionByName(behind), [("a", True), ("b", True), ("c", True)])
    assert front.agg(F.count("*"), F.max("id")).first() == (50_000, 49_999)


def test_minhash_pairs_are_true_pairs(spark):
    from pyspark.ml.linalg import Vectors

    sets = [s for s in random_sets(21) if s]
    df = spark.createDataFrame([(i, Vectors.sparse(30, s, [1.0] * len(s))) for i, s in enumerate(sets)], ["id", "v"])
    for a, b, s in rows(Z.approx_similarity_pairs(df, 0.6, "id", "v"), "id_a", "id_b", "sim"):
        assert s == pytest.approx(len(set(sets[a]) & set(sets[b])) / len(set(sets[a]) | set(sets[b]))) and s >= 0.6 - 1e-9


def test_two_thirds_is_exact(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1, 2, 3])], "id int, fp array<int>")
    assert len(Z.similarity_join(df, None, 2 / 3, "id").collect()) == 1


def test_true_maximum_below_every_step(spark):
    new = spark.createDataFrame([(1, [1, 2, 3]), (2, list(range(10, 30))), (3, [99])], "id int, fp array<int>")
    old = spark.createDataFrame([(7, [1, 2, 3, 4]), (8, list(range(29, 60)))], "id int, fp array<int>")
    assert rows(Z.max_similarity(new, old, 0.0, "id"), "id", "max_sim") == [(1, 0.75), (2, 1 / 50), (3, 0.0)]


def test_sets_of_a_join_are_not_written_whole(spark, tmp_path, monkeypatch):
    """Of texts without partners only hashes and prefixes leave their place, and shuffle files go with the step."""
    from assaylake import session
    from assaylake.functions.fingerprints import fingerprint

    monkeypatch.setattr(session, "scratch_root", lambda s: str(tmp_path))
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(2_000)) for _ in range(60)]
    texts += [texts[0][:1_900], texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").select("id", fingerprint(F.col("text")).alias("fp"))
    got = Z.similarity_join(df, None, 0.65, "id")
    assert rows(got, "rep_a", "rep_b", "copies_a", "copies_b") == [(0, 60, 2, 1)]
    assert sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < len(texts) * 2_000


@pytest.mark.parametrize("cell", [2, 1 << 10])
def test_pairs_of_a_cluster_over_cells_equal_brute_force(spark, monkeypatch, cell):
    for name, value in (("CELL", cell), ("PAIRS", 50), ("PART_BITS", 20)):
        monkeypatch.setattr(Z, name, value)
    sets = random_sets(33, n=30)
    got = Z.similarity_join(as_df(spark, sets), None, 0.4, "id")
    reps = {tuple(s): i for i, s in reversed(list(enumerate(sets))) if s}
    want = sorted((i, j) for a, i in reps.items() for b, j in reps.items() if i < j and similar(a, b, 0.4))
    assert sorted(rows(got, "rep_a", "rep_b")) == want


def test_two_sided_join_with_null_and_repeated_ids(spark):
    a = spark.createDataFrame([(None, [1, 2, 3]), (4, [7, 8, 9]), (4, [1, 2])], "id bigint, fp array<int>")
    b = spark.createDataFrame([(None, [1, 2, 3]), (5, [7, 8, 9, 10])], "id bigint, fp array<int>")
    got = Z.similarity_join(a, b, 0.6, "id")
    assert sorted(map(str, rows(got, "rep_a", "rep_b", "copies_a", "copies_b"))) == sorted(
        map(str, [(None, None, 1, 1), (4, 5, 1, 1), (4, None, 1, 1)]))


def test_sets_are_computed_of_chosen_rows_only(spark):
    seen = spark.sparkContext.accumulator(0)

    def bits(texts: pa.Array) -> pa.Array:
        seen.add(len(texts))
        return pa.array([[ord(c) for c in sorted(set(t))] for t in texts.to_pylist()], pa.list_(pa.int32()))

    bits.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    df = spark.createDataFrame([(i, f"{chr(48 + i)}ab") for i in range(40)], "id bigint, text string").repartition(3)
    sets = Z.distinct_sets(df, "id", F.arrow_udf(bits, "array<int>")("text"))
    before = seen.value
    wanted = sets.members.filter("id < 2").select("set_id")
    assert sorted(rows(Z._asked_sets(sets, wanted, "sets"), "fp")) == [([48, 97, 98],), ([49, 97, 98],)]
    assert (before, seen.value) == (40, 42)


def test_best_partners_of_a_tile_are_joined_in_the_task():
    blob = lambda sets: [b"".join(bytes([n]) * 16 for n, _ in sets), np.array([len(s) for _, s in sets], np.int32).tobytes(),
                         np.concatenate([np.array(s, np.int32) for _, s in sets]).tobytes()]
    a, tiles = blob([(1, [1, 2, 3]), (2, [7])]), [blob([(3, [1, 2, 9])]), blob([(4, [1, 2, 3, 4]), (5, [8])]), blob([(6, [7, 8])])]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*[a + b for b in tiles], strict=True)],
                                       ["set_ids", "sizes", "bits", "set_ids_b", "sizes_b", "bits_b"])
    got = pa.Table.from_batches(list(Z._best_of_tiles(iter([batch]), Z._ratio(0.0)))).to_pylist()
    assert sorted((r["set_id"][0], r["max_sim"]) for r in got) == [(1, 0.75), (2, 0.5)]


def counted_sets(spark, n):
    """(texts without a common letter, their sets, how often a set was made)."""
    seen = spark.sparkContext.accumulator(0)

    def bits(texts: pa.Array) -> pa.Array:
        seen.add(len(texts))
        return pa.array([[ord(c) for c in sorted(set(t))] for t in texts.to_pylist()], pa.list_(pa.int32()))

    bits.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    df = spark.createDataFrame([(i, "".join(chr(0x4E00 + 20 * i + j) for j in range(20))) for i in range(n)], "id bigint, text string").repartition(3)
    return df, F.arrow_udf(bits, "array<int>")("text"), seen


def test_members_and_prefixes_are_made_in_one_pass(spark, monkeypatch):
    monkeypatch.setattr(Z, "ORDER_ROWS", 1)
    df, fp, seen = counted_sets(spark, 90)
    assert Z.similarity_join(df, None, 0.65, "id", fp).count() == 0
    assert 90 <= seen.value <= 110


def test_prefixes_hold_the_rare_bits():
    """A third of each set are bits of all sets: none of them is in a prefix, so no list is as long as the table."""
    common, n = list(range(1_000_000, 1_000_010)), 200
    sets = [sorted(range(20 * i, 20 * i + 20)) + common for i in range(n)]
    fp = pa.array(sets, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), fp, pa.nulls(n, pa.int64())], ["id", "fp", "none_0"])
    rarity = np.frombuffer(next(Z._seen(iter([batch]), Z._ratio(0.65))).column("seen")[0].as_py(), dtype=np.uint8)
    members, packed = Z._scanned(iter([batch]), Z._ratio(0.65), np.ones(Z.BANDS, np.int64), 0, 1, rarity)
    assert members.num_rows == n and packed.column("part").to_pylist() == [2]
    raw = np.frombuffer(packed.column("bits")[0].as_py(), dtype=np.uint8).reshape(-1, 3)
    assert np.unique(raw, axis=0, return_counts=True)[1].max() <= 2
    out = list(Z._candidates(iter([members, packed]), Z._ratio(0.65), 1))
    assert [b.num_rows for b in out] == [n, 0]


def test_pairs_of_a_part_equal_brute_force():
    """Every pair whose shared bits reach the threshold is a candidate; one part holds whole prefixes, so few others are."""
    rng = random.Random(5)
    base = [rng.sample(range(4_000), 60) for _ in range(12)]
    sets = [sorted({*rng.sample(rng.choice(base), rng.randint(40, 60)), *(rng.randrange(4_000) for _ in range(rng.randrange(6)))}) for _ in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(150), pa.int64()), pa.array(sets, pa.list_(pa.int32())), pa.nulls(150, pa.int64())], ["id", "fp", "none_0"])
    rarity = np.frombuffer(next(Z._seen(iter([batch]), Z._ratio(0.65))).column("seen")[0].as_py(), dtype=np.uint8)
    for t in (0.4, 0.65, 0.9):
        members, packed = Z._scanned(iter([batch]), Z._ratio(t), np.full(Z.BANDS, 5), 0, 1, rarity)
        names, found = dict(zip([m[:8] for m in members.column("set_id").to_pylist()], range(150), strict=True)), set()
        for part in range(5 * Z.BANDS):
            for b in Z._candidates(iter([x for x in [packed.filter(pc.equal(packed.column("part"), part))] if x.num_rows]), Z._ratio(t), 1):
                found |= {tuple(sorted((names[x], names[y]))) for x, y in zip(b.column("name_a").to_pylist(), b.column("name_b").to_pylist(), strict=True)}
        want = {(i, j) for i in range(150) for j in range(i + 1, 150) if similar(sets[i], sets[j], t)}
        assert want and want <= found and len(found) < 150 * 149 / 4


def test_sets_that_share_a_name_are_told_apart(spark, monkeypatch):
    """Parts know sets by 8 bytes of their hash; here all hashes begin alike."""
    from hashlib import md5

    monkeypatch.setattr(Z, "_names", lambda size, bits: [b"\0" * 8 + md5(bits[e - n:e].tobytes()).digest()[:8] for n, e in zip(size.tolist(), np.cumsum(size).tolist(), strict=True)])
    sets = [[1, 2, 3, 4], [2, 3, 4, 5], [9], [1, 2, 3, 4], [1, 2, 3, 4, 5]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5), pa.int64()), pa.array(sets, pa.list_(pa.int32())), pa.nulls(5, pa.int64())], ["id", "fp", "none_0"])
    made = list(Z._scanned(iter([batch]), Z._ratio(0.5), np.ones(Z.BANDS, np.int64), 0, 1, np.zeros(1 << Z.ORDER_SLOTS, np.uint8)))
    parts = [made[1].slice(i, 1) for i in range(made[1].num_rows)]
    found = pa.Table.from_batches([x for p in parts for x in Z._candidates(iter([p]), Z._ratio(0.5), 1)])
    assert found.num_rows >= 3 and set(found.column("name_a").to_pylist() + found.column("name_b").to_pylist()) == {b"\0" * 8}


def test_short_sets_are_in_few_parts():
    """Long sets make many parts; short ones are not torn into them, where one shared bit would make a candidate."""
    rng = random.Random(8)
    short = [sorted(rng.sample(range(300), 30)) for _ in range(100)]
    long = [sorted(rng.sample(range(1_000_000), 3_000)) for _ in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array(short + long, pa.list_(pa.int32())), pa.nulls(120, pa.int64())], ["id", "fp", "none_0"])
    seen = next(Z._seen(iter([batch]), Z._ratio(0.65)))
    rarity, held = np.frombuffer(seen.column("seen")[0].as_py(), dtype=np.uint8), np.frombuffer(seen.column("held")[0].as_py(), dtype=np.int64)
    assert held[5] >= 20 * 1_000 and held[2] == Z._prefix(np.array([30]), Z._ratio(0.65))[0] * 100 and held[8:].sum() == 0
    _, packed = Z._scanned(iter([batch]), Z._ratio(0.65), 1 + held // 1_000, 0, 1, rarity)
    parts = [packed.slice(i, 1) for i in range(packed.num_rows)]
    assert len(parts) >= 20
    assert sum(b.num_rows for p in parts for b in Z._candidates(iter([p]), Z._ratio(0.65), 1)) < 300


def test_lists_of_a_tile_are_made_once_and_cells_are_few(monkeypatch):
    """A tile keeps its posting lists over all the tiles it meets, and however many short sets meet, few counts are held at once."""
    rng = random.Random(3)
    some = lambda n, at: [(at + i, sorted(rng.sample(range(60), rng.randint(1, 6)))) for i in range(n)]
    blob = lambda sets: [b"".join(bytes([n]) * 16 for n, _ in sets), np.array([len(s) for _, s in sets], np.int32).tobytes(),
                         np.concatenate([np.array(s, np.int32) for _, s in sets]).tobytes()]
    a, others = some(30, 1), [some(25, 100), some(20, 150), some(1, 200)]
    made, postings, counted, bincount = [], Z._postings, [], np.bincount
    monkeypatch.setattr(Z, "PAIRS", 40)
    monkeypatch.setattr(Z, "_postings", lambda *x: made.append(1) or postings(*x))
    monkeypatch.setattr(Z.np, "bincount", lambda x, **kw: counted.append(kw["minlength"]) or bincount(x, **kw))
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*[blob(a) + blob(x) for x in others], strict=True)],
                                       ["set_ids", "sizes", "bits", "set_ids_b", "sizes_b", "bits_b"])
    got = {r["set_id"][0]: r["max_sim"] for r in pa.Table.from_batches(list(Z._best_of_tiles(iter([batch]), Z._ratio(0.0)))).to_pylist()}
    for n, s in a:
        assert got.get(n, 0.0) == pytest.approx(max(len({*s} & {*o}) / len({*s} | {*o}) for x in others for _, o in x))
    assert len(made) == 4 and max(counted) <= 40
