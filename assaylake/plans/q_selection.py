"""Queries for positions, top-k, samples, selections and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.operators import indexing as I
from assaylake.operators import selection as G
from assaylake.plans import views as V
from assaylake.plans.catalog import query
from assaylake.sources import tables as T

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LINE_SQL = ", ".join(LINE_ORDER)


def _asc(*names):
    return [F.col(n).asc() for n in names]


@query("w2_row_index", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS row_index FROM orders""")
def _(spark, sf):
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return I.with_row_index(o, _asc("o_totalprice", "o_orderkey")).select("o_orderkey", "row_index")


@query("w4_cluster_best", """
    SELECT p_brand AS cluster_id, p_partkey AS rank, p_retailprice FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1""")
def _(spark, sf):
    parts = T.table(spark, sf, "part").select(F.col("p_brand").alias("cluster_id"), F.col("p_partkey").alias("rank"), "p_retailprice")
    return G.cluster_best(parts)


@query("w5_retain_last_versions", """
    SELECT molecule_hash, predicted_delta_g, model_version FROM predictions WHERE model_version IN (
        SELECT model_version FROM (SELECT DISTINCT model_version FROM predictions)
        ORDER BY CAST(regexp_extract(model_version, '(\\d+)', 1) AS INTEGER) DESC LIMIT 3)""")
def _(spark, sf):
    return G.retain_last_versions(T.predictions(spark, sf), 3).select("molecule_hash", "predicted_delta_g", "model_version")


@query("w6_rank_within_run", """
    SELECT cycle, molecule_hash, row_number() OVER w AS rank_in_run, round(percent_rank() OVER w, 9) AS percent_rank
    FROM cycles WINDOW w AS (PARTITION BY cycle ORDER BY final_score NULLS FIRST, molecule_hash)""")
def _(spark, sf):
    rows = V.cycles(spark, sf).select("cycle", "molecule_hash", "final_score")
    out = I.rank_within(rows, ["cycle"], _asc("final_score", "molecule_hash"))
    return out.select("cycle", "molecule_hash", "rank_in_run", F.round("percent_rank", 9).alias("percent_rank"))


@query("w7_hash_split", """
    SELECT molecule_hash, CASE WHEN CAST(('0x' || substr(md5('split' || molecule_hash), 1, 8)) AS BIGINT) < CAST(0.8 * 4294967296 AS BIGINT)
                               THEN 'train' ELSE 'valid' END AS split FROM registry""")
def _(spark, sf):
    return G.hash_split(T.registry_keys(spark, sf).select("molecule_hash"), 0.8)


@query("w7_positional_split", """
    SELECT molecule_hash, CASE WHEN row_number() OVER (ORDER BY molecule_hash) - 1 < CAST(floor((SELECT count(*) FROM registry) * 0.9) AS BIGINT)
                               THEN 'train' ELSE 'valid' END AS split FROM registry""")
def _(spark, sf):
    return G.positional_split(T.registry_keys(spark, sf).select("molecule_hash"), _asc("molecule_hash"))


@query("s14_assign_slice", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST((row_number() OVER (ORDER BY {_LINE_SQL}) - 1) % 10 AS INTEGER) AS slice
    FROM lineitem""")
def _(spark, sf):
    li = T.table(spark, sf, "lineitem").select(*LINE_ORDER)
    return I.assign_slice(li, _asc(*LINE_ORDER), 10).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "slice")


@query("s14_slice_rows", """
    SELECT o_orderkey FROM orders QUALIFY (row_number() OVER (ORDER BY o_orderkey) - 1) % 20 = 3""")
def _(spark, sf):
    return I.slice_rows(T.table(spark, sf, "orders").select("o_orderkey"), _asc("o_orderkey"), 20, 3)


@query("t1_top_k", """
    SELECT molecule_hash, docking_score FROM screening ORDER BY docking_score NULLS LAST, molecule_hash LIMIT 100""")
def _(spark, sf):
    return G.top_k(T.screening(spark, sf).select("molecule_hash", "docking_score"), 100, "docking_score")


@query("t2_sample_k", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('s1' || o_orderkey), o_orderkey LIMIT 500""")
def _(spark, sf):
    return G.sample_k(T.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 500, "s1", "o_orderkey")


@query("t3_select_for_labelling", "SELECT molecule_hash, strategy FROM selected")
def _(spark, sf):
    return V.selected(spark, sf)


@query("t3_overlapping_legs", """
    SELECT * FROM (SELECT molecule_hash, 'exploitation' AS strategy FROM screening WHERE docking_score IS NOT NULL
                   ORDER BY 0.0 - 0.7 * docking_score + 0.3 * qed_score DESC, molecule_hash LIMIT 90)
    UNION ALL
    SELECT * FROM (SELECT molecule_hash, 'exploration' AS strategy FROM screening WHERE docking_score IS NOT NULL
                   ORDER BY md5('mix' || molecule_hash), molecule_hash LIMIT 10)""")
def _(spark, sf):
    from assaylake.functions import scalars as S

    s = T.screening(spark, sf).withColumn("mpo", S.default_mpo(F.col("docking_score"), F.col("qed_score")))
    return G.select_for_labelling(s, 90, 10, "mpo", ascending=False, seed="mix", valid=F.col("docking_score").isNotNull(), disjoint=False)


@query("t4_top_uncertain", """
    WITH u AS (SELECT molecule_hash, stddev_samp(delta_g) AS uncertainty FROM oracle_raw WHERE status = 'Success' GROUP BY 1)
    SELECT molecule_hash, round(uncertainty, 6) AS uncertainty FROM u ORDER BY u.uncertainty DESC NULLS LAST, molecule_hash LIMIT 50""")
def _(spark, sf):
    spreads = T.oracle_raw(spark, sf).filter(F.col("status") == "Success").groupBy("molecule_hash").agg(
        F.stddev_samp("delta_g").alias("uncertainty"))
    return G.top_uncertain(spreads, 50).withColumn("uncertainty", F.round("uncertainty", 6))


@query("t5_elite_pool", """
    SELECT molecule_hash, final_score FROM elite ORDER BY final_score NULLS LAST, molecule_hash LIMIT 100""")
def _(spark, sf):
    return G.elite_pool(V.unified(spark, sf), 100).select("molecule_hash", "final_score")


@query("t6_select_elite", """
    WITH c AS (SELECT p_partkey AS molecule_hash, p_name AS cluster_id, p_partkey AS rank FROM part),
         reps AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY rank) = 1),
         chosen AS (SELECT * FROM reps ORDER BY rank LIMIT 80),
         drawn AS (SELECT * FROM c WHERE molecule_hash NOT IN (SELECT molecule_hash FROM chosen)
                   ORDER BY md5('elite' || molecule_hash), molecule_hash LIMIT (20 + 80 - (SELECT count(*) FROM chosen)))
    SELECT molecule_hash, cluster_id, 'cluster_centroid' AS selection_strategy FROM chosen
    UNION ALL SELECT molecule_hash, cluster_id, 'diversity_random' FROM drawn""")
def _(spark, sf):
    parts = T.table(spark, sf, "part").select(F.col("p_partkey").alias("molecule_hash"), F.col("p_name").alias("cluster_id"),
                                              F.col("p_partkey").alias("rank"))
    return G.select_elite(parts, 80, 20).drop("rank")


@query("t7_top_percent", """
    SELECT molecule_hash, final_score FROM unified ORDER BY final_score NULLS LAST, molecule_hash
    LIMIT (SELECT CAST(floor(count(*) * 5 / 100) AS BIGINT) FROM screening)""")
def _(spark, sf):
    return G.top_percent(V.unified(spark, sf).select("molecule_hash", "final_score"), 5.0, "final_score")


@query("u2_stack_cycles", """
    SELECT 'Cycle 1' AS cycle, molecule_hash, docking_score, CAST(NULL AS DOUBLE) AS delta_g FROM screening
    UNION ALL SELECT 'Cycle 2', molecule_hash, CAST(NULL AS DOUBLE), delta_g FROM gold""")
def _(spark, sf):
    return G.stack_cycles({"Cycle 1": T.screening(spark, sf).select("molecule_hash", "docking_score"),
                           "Cycle 2": T.gold(spark, sf).select("molecule_hash", "delta_g")})


@query("u3_exploit_and_explore", "SELECT strategy, count(*) AS n, min(molecule_hash) AS first_hash FROM selected GROUP BY 1")
def _(spark, sf):
    return V.selected(spark, sf).groupBy("strategy").agg(F.count("*").alias("n"), F.min("molecule_hash").alias("first_hash"))


@query("u4_replay_mix", """
    WITH e AS (SELECT molecule_hash FROM elite),
         o AS (SELECT molecule_hash FROM gold WHERE molecule_hash NOT IN (SELECT molecule_hash FROM e)
               ORDER BY md5('replay' || molecule_hash), molecule_hash LIMIT (SELECT CAST(floor(count(*) * 0.2) AS BIGINT) FROM e))
    SELECT molecule_hash, 'elite' AS origin FROM e UNION ALL SELECT molecule_hash, 'original' FROM o""")
def _(spark, sf):
    from assaylake.functions import predicates as P

    elite = T.screening(spark, sf).filter(P.elite_filter()).select("molecule_hash")
    return G.replay_mix(elite, T.gold(spark, sf).select("molecule_hash"), 0.2)


@query("u5_pool_difference", """
    SELECT molecule_hash FROM valid_rows EXCEPT SELECT molecule_hash FROM exploit""")
def _(spark, sf):
    from assaylake.functions import predicates as P
    from assaylake.operators.joins import without

    valid = T.screening(spark, sf).filter(P.valid_pool()).select("molecule_hash", "docking_score")
    return without(valid, G.top_k(valid, 80, "docking_score")).select("molecule_hash")
