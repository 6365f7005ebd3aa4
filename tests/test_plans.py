"""What the physical plans must and must not contain."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from assaylake.operators import aggregates as A
from assaylake.operators import joins as J
from assaylake.operators import selection as G
from assaylake.sources import tables as T

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("k", [10, 900])
def test_no_task_gathers_the_top_k(spark, k):
    """No heap of k rows a task, whatever k is; only the counts of the ranges, a row each, meet in one partition."""
    p = plan(G.top_k(T.screening(spark, SF).select("molecule_hash", "docking_score"), k, "docking_score"))
    assert "TakeOrdered" not in p and "GlobalLimit" not in p and "rangepartitioning" in p
    single = p.split("SinglePartition")
    assert len(single) <= 2 and all("HashAggregate(keys=[_piece" in x for x in single[1:])


def test_dedup_combines_before_the_shuffle(spark):
    p = plan(A.dedup_registry(T.registry_raw(spark, SF), ["seq"]))
    assert "partial_min_by" in p and "Window" not in p


def test_filters_and_columns_reach_the_scan(spark):
    p = T.table(spark, SF, "lineitem").filter("l_quantity > 40").select("l_orderkey")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in p


def test_score_join_is_a_single_join(spark):
    frame = lambda c: spark.range(10).select(F.col("id").cast("string").alias("smiles"), F.lit(1.0).alias(c))
    joined = J.join_scores(frame("m"), frame("qed"), frame("tox"), frame("dock"))
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


@pytest.mark.parametrize("make", [
    lambda s: J.comprehensive(T.registry(s, SF), T.gold(s, SF), T.predictions(s, SF), T.screening(s, SF)),
    lambda s: A.zscore_outliers(T.table(s, SF, "lineitem"), "l_extendedprice"),
    lambda s: A.status_report(T.oracle_by_doc(s, SF)),
    lambda s: J.without(T.screening(s, SF), T.gold(s, SF)),
])
def test_no_cartesian_products(spark, make):
    p = plan(make(spark))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_library_has_no_local_copies():
    """No localCheckpoint, cross join, RDD loop or toPandas; ``collect`` and ``first`` read tables of a stated bound."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "assaylake")
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        text = open(path).read()
        assert not any(x in text for x in ("localCheckpoint", "crossJoin", "mapPartitions", "toPandas")), path


TEXT_ONCE = ["j4_leaderboard", "j5_comprehensive", "j6_comprehensive_union", "j11_lineage", "a3_run_summary", "a17_trend_by_iteration",
             "e10_best_estimate", "best_scores"]


@pytest.mark.parametrize("name", TEXT_ONCE)
def test_texts_are_scanned_once_at_most(spark, name):
    """Hashes come from the identity dictionary, which is written before."""
    import __spark_entry__

    p = plan(__spark_entry__.queries()[name](spark, SF))
    assert len([x for x in re.findall(r"ReadSchema: struct<([^\n]*)>", p) if re.search(r"\btext:string", x)]) <= 1


def test_hash_joins_shuffle_nothing_of_the_dictionary(spark):
    grouped = T.registry_keys(spark, SF)
    assert "Exchange" not in plan(grouped)
    both = grouped.select("molecule_hash", "run_id").hint("merge").join(T.screening(spark, SF), "molecule_hash")
    assert "hashpartitioning(molecule_hash" not in plan(both)


def test_bucketed_tables_join_without_exchange(spark):
    from assaylake.plans.q_sources import bucketed_join

    p = plan(bucketed_join(spark, SF))
    assert "SortMergeJoin" in p and "Exchange" not in p


def test_dictionary_follows_the_documents(spark, tmp_path):
    for texts in (["a", "b"], ["c"]):
        spark.createDataFrame([(i, t, "src1") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.mode("overwrite").parquet(
            f"{tmp_path}/documents.parquet")
        got = T.identities(spark, str(tmp_path)).join(spark.read.parquet(f"{tmp_path}/documents.parquet"), "doc_id").filter(
            F.col("molecule_hash") == F.sha2("text", 256))
        assert got.count() == len(texts) == T.identities(spark, str(tmp_path)).count()
