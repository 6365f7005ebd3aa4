import random

import pytest
from pyspark.sql import functions as F

from assaylake.operators import selection as G
from assaylake.operators import topk
from assaylake.operators.topk import Key
from conftest import rows


def pool(spark, n, tox=0):
    return spark.range(n).select(F.format_string("h%04d", "id").alias("molecule_hash"), (F.col("id") % 7).cast("double").alias("docking_score"),
                                 F.lit(0.9).alias("qed_score"), F.lit(2.0).alias("sa_score"), F.lit(tox).alias("toxicity_label"))


def test_top_k_ties_by_hash_and_missing_last(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("d", 0.5)], "molecule_hash string, s double")
    assert [r[0] for r in G.top_k(df, 3, "s").collect()] == ["d", "a", "b"]
    assert [r[0] for r in G.top_k(df, 2, "s", ascending=False).collect()] == ["a", "b"]


def test_top_k_refuses_empty_rank_column(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "molecule_hash string, s double")
    with pytest.raises(Exception, match="no value in rank column s"):
        G.top_k(df, 1, "s").select("molecule_hash").collect()
    assert G.top_k(df.limit(0), 1, "s").count() == 0


def awkward(n):
    """Ties, nulls, NaN, signed zero, infinities and huge integers."""
    rng = random.Random(n)
    real = lambda: rng.choice([None, float("nan"), 0.0, -0.0, float("inf"), float("-inf"), 1.5, rng.randint(-5, 5) / 2, rng.random()])
    whole = lambda: rng.choice([None, 2**63 - 1, -2**63, 2**53, 2**53 + 1, rng.randint(-3, 3)])
    return [(real(), whole(), rng.choice([None, "", "a", "ab", "abcdefgh1", "abcdefgh0", "é", chr(0)]), i) for i in range(n)]


@pytest.mark.parametrize("enough", [0, topk.ENOUGH])
@pytest.mark.parametrize("ascending", [True, False])
def test_first_rows_equal_a_sort_for_every_k(spark, monkeypatch, enough, ascending):
    monkeypatch.setattr(topk, "ENOUGH", enough)
    df = spark.createDataFrame(awkward(400), "x double, n bigint, s string, id int").repartition(5).cache()
    for first in (["x", "n"], ["n", "s"], ["s", "x"]):
        keys = [Key(F.col(c), ascending) for c in first] + [Key(F.col("id"))]
        in_order = [r.id for r in df.orderBy(*[k.order for k in keys]).collect()]
        for k in (0, 1, 37, 200, 390, 1_000):
            assert {r[0] for r in rows(topk.first_rows(df, keys, k), "id")} == set(in_order[:k]), (first, k)
    df.unpersist()


def test_selection_narrows_large_tables(spark, monkeypatch):
    """Few rows are left for the sort, also where a third of all rows tie on the score and where texts share a start."""
    monkeypatch.setattr(topk, "ENOUGH", 200)
    sorted_rows = []
    plain = topk.with_row_index
    monkeypatch.setattr(topk, "with_row_index", lambda df, *a, **b: (sorted_rows.append(df.count()), plain(df, *a, **b))[1])
    n = 30_000
    df = spark.range(n).select(F.format_string("h%06d", F.col("id") * 7 % n).alias("molecule_hash"),
                               F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double") / 10).alias("s"))
    for k in (1, 100, 5_000, 10_030, 29_000):
        got = [r[0] for r in G.top_k(df, k, "s").collect()]
        assert got == [r[0] for r in df.orderBy("s", "molecule_hash").limit(k).collect()], k
        assert rows(G.sample_k(df, k, "x"), "molecule_hash") == rows(df.orderBy(F.md5(F.concat(F.lit("x"), "molecule_hash"))).limit(k), "molecule_hash")
    assert sum(x < n / 20 for x in sorted_rows) >= 8 and max(sorted_rows) < n / 2


def test_share_and_needed_value(spark):
    df = pool(spark, 201)
    assert topk.first_rows(df, [Key(F.col("molecule_hash"))], lambda rows: rows // 10).count() == 20
    with pytest.raises(ValueError, match="no value in rank column s"):
        G.top_k(df.withColumn("s", F.lit(None).cast("double")), 5_000, "s")


def test_sample_is_exact_and_independent_of_layout(spark):
    df = pool(spark, 500)
    one = rows(G.sample_k(df, 50, "s"), "molecule_hash")
    assert len(one) == 50 and one == rows(G.sample_k(df.repartition(7), 50, "s"), "molecule_hash")
    assert one != rows(G.sample_k(df, 50, "t"), "molecule_hash")
    assert G.sample_k(df, 900, "s").count() == 500


def test_selection_legs_are_disjoint_and_full(spark):
    got = G.select_for_labelling(pool(spark, 100), 30, 20).collect()
    assert len(got) == 50 and len({r.molecule_hash for r in got}) == 50
    assert sum(r.strategy == "exploitation" for r in got) == 30


def test_selection_from_a_small_pool_takes_all_once(spark):
    got = G.select_for_labelling(pool(spark, 12), 30, 20).collect()
    assert len(got) == 12 and len({r.molecule_hash for r in got}) == 12


def test_selection_ignores_toxic_rows(spark):
    both = pool(spark, 5).unionByName(pool(spark, 9, tox=1).withColumn("molecule_hash", F.concat(F.lit("t"), "molecule_hash")))
    assert G.select_for_labelling(both, 9, 9).filter("molecule_hash like 't%'").count() == 0


def test_elite_shortfall_moves_to_random(spark):
    df = spark.range(50).select(F.format_string("h%02d", "id").alias("molecule_hash"), (F.col("id") % 4).alias("cluster_id"), F.col("id").alias("rank"))
    got = G.select_elite(df, 10, 5).collect()
    kinds = [r.selection_strategy for r in got]
    assert kinds.count("cluster_centroid") == 4 and kinds.count("diversity_random") == 11
    assert {r["rank"] for r in got if r.selection_strategy == "cluster_centroid"} == {0, 1, 2, 3}
    assert len({r.molecule_hash for r in got}) == 15


def test_splits(spark):
    df = pool(spark, 2000).select("molecule_hash")
    a = rows(G.hash_split(df, 0.8), "*")
    assert a == rows(G.hash_split(df.repartition(5), 0.8), "*")
    assert 0.75 < sum(s == "train" for _, s in a) / 2000 < 0.85
    first = G.positional_split(df, [F.col("molecule_hash").asc()], 0.9)
    assert first.filter("split = 'train'").count() == 1800


def test_retention_orders_versions_by_number(spark):
    df = spark.createDataFrame([("loop_2",), ("loop_10",), ("loop_9",), ("loop_9",)], "model_version string")
    assert rows(G.retain_last_versions(df, 2), "*") == [("loop_10",), ("loop_9",), ("loop_9",)]


def test_replay_adds_a_share_without_overlap(spark):
    df = pool(spark, 100).select("molecule_hash")
    elite = df.limit(20)
    got = G.replay_mix(elite, df, 0.2)
    assert got.filter("origin = 'original'").count() == 4 and got.select("molecule_hash").distinct().count() == 24


def test_top_percent_and_discovery(spark):
    df = pool(spark, 200).withColumn("proxy", -F.col("docking_score"))
    assert G.top_percent(df, 5.0, "docking_score").count() == 10
    assert G.discovery_rate(df, 20, "proxy", "docking_score").first().discovery_pct == 100.0


def test_stack_cycles_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,)], "y int")
    assert rows(G.stack_cycles({"c1": a, "c2": b}), "cycle", "x", "y") == [("c1", 1, None), ("c2", None, 2)]
