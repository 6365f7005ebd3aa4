"""Queries for table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.operators import mutation as M
from assaylake.plans import views as V
from assaylake.plans.catalog import query
from assaylake.session import scratch_path
from assaylake.sources import tables as T
from assaylake.sources.readers import conform
from assaylake.sources.writers import append_with_new_columns, replace_table


@query("m1_insert_new", """
    WITH t AS (SELECT molecule_hash, global_id, run_id, seq FROM registry_raw WHERE run_id = 'cycle1'
               QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY seq) = 1),
         s AS (SELECT molecule_hash, global_id, run_id, seq FROM registry_raw WHERE run_id = 'cycle2'
               QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY seq) = 1)
    SELECT * FROM t UNION ALL SELECT * FROM s WHERE molecule_hash NOT IN (SELECT molecule_hash FROM t)""")
def _(spark, sf):
    raw = T.registry_raw(spark, sf).select("molecule_hash", "global_id", "run_id", "seq")
    start = M.insert_new(raw.limit(0), raw.filter("run_id = 'cycle1'"), order=["seq"])
    return M.insert_new(start, raw.filter("run_id = 'cycle2'"), order=["seq"])


@query("m2_upsert_latest", """
    SELECT event_user AS molecule_hash, delta_g, run_id, ts FROM (
        SELECT o_custkey AS event_user, 0.0 - o_totalprice AS delta_g, o_orderpriority AS run_id,
               epoch_us(o_orderdate) // 1000000 AS ts, o_orderkey FROM orders)
    QUALIFY row_number() OVER (PARTITION BY event_user ORDER BY ts DESC, o_orderkey % 2 DESC, delta_g DESC, run_id DESC) = 1""")
def _(spark, sf):
    day = F.datediff(F.col("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    o = T.table(spark, sf, "orders")
    rows = o.select(F.col("o_custkey").alias("molecule_hash"), (F.lit(0.0) - F.col("o_totalprice")).alias("delta_g"),
                    F.col("o_orderpriority").alias("run_id"), day.alias("ts"), (F.col("o_orderkey") % 2).alias("half"))
    old, new = rows.filter("half = 0").drop("half"), rows.filter("half = 1").drop("half")
    return M.upsert_latest(old, new, tie=("delta_g", "run_id"))


@query("m3_update_from", """
    SELECT s.molecule_hash, CASE WHEN g.molecule_hash IS NULL THEN s.docking_score ELSE g.delta_g END AS docking_score, s.qed_score
    FROM screening s LEFT JOIN gold g USING (molecule_hash)""")
def _(spark, sf):
    target = T.screening(spark, sf).select("molecule_hash", "docking_score", "qed_score")
    return M.update_from(target, T.gold(spark, sf), {"docking_score": "delta_g"})


@query("m4_unify_scores", "SELECT molecule_hash, final_score, score_method FROM unified")
def _(spark, sf):
    return V.unified(spark, sf).select("molecule_hash", "final_score", "score_method")


@query("m5_replace_staging", "SELECT molecule_hash, predicted_delta_g FROM predictions")
def _(spark, sf):
    path = scratch_path(spark, "staging")
    replace_table(T.registry_keys(spark, sf), path)
    replace_table(T.predictions(spark, sf).select("molecule_hash", "predicted_delta_g"), path)
    return spark.read.parquet(path)


@query("m6_add_columns", """
    SELECT molecule_hash, docking_score, CAST(NULL AS DOUBLE) AS final_score, CAST(NULL AS VARCHAR) AS score_method FROM screening
    UNION ALL SELECT molecule_hash, docking_score, final_score, score_method FROM unified""")
def _(spark, sf):
    path = scratch_path(spark, "screening")
    replace_table(T.screening(spark, sf).select("molecule_hash", "docking_score"), path)
    grown = append_with_new_columns(V.unified(spark, sf).select("molecule_hash", "docking_score", "final_score", "score_method"), path)
    return grown.select("molecule_hash", "docking_score", "final_score", "score_method")


@query("s9_conform", """
    SELECT molecule_hash, docking_score, qed_score, sa_score, logp, mw, toxicity_label, CAST(NULL AS DOUBLE) AS final_score,
           CAST(NULL AS VARCHAR) AS score_method FROM screening_raw""")
def _(spark, sf):
    raw = T.screening_raw(spark, sf).withColumnRenamed("qed_score", "qed").withColumnRenamed("toxicity_label", "toxicity")
    return conform(raw, schemas.SCREENING, {"qed": "qed_score", "toxicity": "toxicity_label"})
