import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaylake.operators import aggregates as A
from assaylake.operators import indexing as I
from conftest import rows


def results(spark, data):
    return spark.createDataFrame([(k, v, s, i) for i, (k, v, s) in enumerate(data)], "molecule_hash string, delta_g string, status string, seq int")


def test_best_result_edges(spark):
    data = [
        ("a", "NaN", "Failed_Setup"), ("a", "-3", "Success"),          # success replaces failure
        ("b", "-3", "Success"), ("b", "-3.0", "Success"),              # tie: earliest
        ("c", "NaN", "Failed_Equil"), ("c", "NaN", "Failed_Setup"),    # only failures: earliest
        ("d", "NaN", "Failed_Setup"), ("d", "10000", "Success"),       # a bad success still is one
        ("e", "nan", "Success"), ("e", "abc", "Success"), ("e", "-1", "Success"),
        ("f", "nan", "Success"),
        (None, "-9", "Success"),
    ]
    got = {r[0]: r[1] for r in rows(A.best_result(results(spark, data)), "molecule_hash", "seq")}
    assert got == {"a": 1, "b": 2, "c": 4, "d": 7, "e": 10, "f": 11}


def test_best_of_bests_is_best(spark):
    rng = random.Random(3)
    data = [(rng.choice("abcdef"), str(rng.randint(-5, 5)), rng.choice(["Success", "Failed_Setup"])) for _ in range(400)]
    df = results(spark, data)
    halves = A.best_result(df.filter("seq % 2 = 0")).unionByName(A.best_result(df.filter("seq % 2 = 1")))
    assert rows(A.best_result(halves), "*") == rows(A.best_result(df.repartition(9)), "*")


def test_first_row_of_hot_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  (F.lit(9000) - F.col("id")).alias("v"))
    one = A.first_row(df, "k", ["v"])
    assert one.count() == 6001 and one.filter("k = 'hot'").first()["v"] == 3


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_equal_pandas(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["x", "y", None]), rng.choice([None, 1.0, rng.random(), float(rng.randint(0, 5))])) for _ in range(700)] + [("z", 4.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(6)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r[0], r[1]): r[2] for r in I.exact_quantiles(df, ["g"], "v", probs).collect()}
    pdf = pd.DataFrame(data, columns=["g", "v"]).dropna(subset=["v"])
    for g, part in pdf.groupby("g", dropna=False):
        for p in probs:
            assert got[(None if pd.isna(g) else g, p)] == pytest.approx(part["v"].quantile(p))
    assert len(got) == 4 * len(probs)


def test_bins_count_missing_in_total(spark):
    df = spark.createDataFrame([("c", -50.0, 0.9), ("c", None, None)], "cycle string, final_score double, qed_score double")
    r = A.bin_distribution(df).first()
    assert (r.strong_pct, r.medium_pct, r.weak_pct, r.total) == (50.0, 0.0, 0.0, 2)


def test_quality_report_finds_constant_and_empty_columns(spark):
    df = spark.createDataFrame([("r", 0.0, None, "1"), ("r", 0.0, None, "x")], "run_id string, sa double, dock double, raw string")
    got = {r.column_name: r for r in A.quality_report(df, ["sa", "dock", "raw"], numeric_text=["raw"]).collect()}
    assert got["sa"].is_constant == 1 and got["dock"].null_pct == 100.0 and got["raw"].n_unparsable == 1


def test_fold_change_of_zero_base(spark):
    m = spark.createDataFrame([("a", 0.0), ("b", 2.0)], "cycle string, x double")
    r = A.cycle_compare(m, ["x"], "a", "b").first()
    assert (r.delta, r.fold_change) == (2.0, None)


def test_population_and_unique_mean_differ(spark):
    df = spark.createDataFrame([("a", -40.0)] * 3 + [("b", 0.0)], "k string, v double")
    r = A.population_vs_unique_mean(df, "k", "v").first()
    assert (r.population_mean, r.unique_mean) == (-30.0, -20.0)


def test_approximate_variants(spark):
    df = spark.range(1000).select(F.lit("c").alias("cycle"), F.col("id").cast("double").alias("final_score"), F.lit(0.5).alias("qed_score"),
                                  F.lit(0).alias("toxicity_label"))
    assert abs(A.cycle_metrics(df, exact=False).first().median_affinity - 499) < 5
    assert abs(A.uniqueness(df, "final_score", approximate=True).first().n_distinct - 1000) < 100


@pytest.mark.parametrize("parts", [1, 5])
def test_row_index_is_a_global_order(spark, parts):
    rng = random.Random(parts)
    data = [(rng.randint(0, 9), i) for i in range(500)]
    df = spark.createDataFrame(data, "v int, id int").repartition(parts)
    got = rows(I.with_row_index(df, [F.col("v").desc(), F.col("id").asc()]), "row_index", "v", "id")
    want = sorted(data, key=lambda x: (-x[0], x[1]))
    assert sorted(got) == [(i, v, k) for i, (v, k) in enumerate(want)]


def test_rank_within_groups_with_null_group(spark):
    data = [(None, 3), (None, 1), ("a", 5), ("a", 4), ("a", 9)]
    df = spark.createDataFrame(data, "g string, v int")
    got = rows(I.with_row_index(df, [F.col("v").asc()], ["g"]), "g", "v", "row_index")
    assert set(got) == {(None, 1, 0), (None, 3, 1), ("a", 4, 0), ("a", 5, 1), ("a", 9, 2)}


def test_trend_over_gaps_and_equal_numbers(spark):
    df = spark.createDataFrame([("cycle1", 1.0), ("dev1", 2.0), ("cycle2", 4.0), ("cycle4", 8.0), ("cycle10", 9.0)], "c string, s double")
    got = A.trend_by_iteration(df, "c", F.col("s"))
    assert rows(got, "c", "best_change") == [("cycle1", None), ("cycle10", 1.0), ("cycle2", 2.0), ("cycle4", 4.0), ("dev1", 1.0)]


def test_percent_rank_keeps_a_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, x int")
    got = I.rank_within(df, ["g"], [F.col("x").asc()])
    assert rows(got, "g", "x", "rank_in_run", "percent_rank") == [("a", 3, 1, 0.0), (None, 1, 1, 0.0), (None, 2, 2, 1.0)]


def test_quality_report_counts_values_exactly(spark):
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 700).alias("v"), F.lit("x").alias("c"), (F.col("id") % 2).alias("run_id"))
    got = {(r.run_id, r.column_name): r for r in A.quality_report(df, ["v", "c"]).collect()}
    assert [(got[i, "v"].n_rows, got[i, "v"].n_distinct, got[i, "c"].is_constant) for i in (0, 1)] == [(1_500, 350, 1), (1_500, 350, 1)]


def test_sketches_of_runs_unite(spark, tmp_path):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("v"), F.lit(None).cast("string").alias("none"),
                                    F.floor(F.col("id") / 15_000).alias("run_id"))
    for run in range(4):  # stored per run, as each ends
        A.column_sketches(df.filter(F.col("run_id") == run), ["v", "none"]).write.parquet(f"{tmp_path}/r={run}")
    stored = spark.read.parquet(f"{tmp_path}/r=*")
    assert "sketch" in stored.columns and stored.count() == 8
    got = {r.column_name: r for r in A.distinct_over(stored).collect()}
    assert abs(got["v"].n_distinct_approx - 20_000) < 800 and got["none"].n_distinct_approx == 0
    assert (got["v"].n_rows, got["v"].n_known, got["none"].n_known) == (60_000, 60_000, 0)
