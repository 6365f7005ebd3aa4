"""Queries for de-duplication, summaries, distributions and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.functions import scalars as S
from assaylake.operators import aggregates as A
from assaylake.operators import selection as G
from assaylake.plans import views as V
from assaylake.plans.catalog import query
from assaylake.session import materialize
from assaylake.sources import tables as T

METRICS = ["total", "mean_affinity", "median_affinity", "hit_rate", "elite_rate", "mean_qed", "safety_rate", "gold_count", "gold_rate"]


def rounded(df, *cols, digits=6):
    for c in cols:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query("a1_dedup_registry", "SELECT molecule_hash, global_id, run_id, seq FROM registry")
def _(spark, sf):
    raw = T.registry_raw(spark, sf).select("molecule_hash", "global_id", "run_id", "seq")
    return A.dedup_registry(raw, ["seq"])


@query("a1_dedup_orders", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def _(spark, sf):
    li = T.table(spark, sf, "lineitem")
    first = A.first_row(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


_BEST_SQL = "SELECT molecule_hash, delta_g, status, batch_id, attempt, day FROM oracle_best"


@query("a2_best_result", _BEST_SQL)
def _(spark, sf):
    return T.oracle_best(spark, sf).select("molecule_hash", "delta_g", "status", "batch_id", "attempt", "day")


@query("p3_best_row_expression", _BEST_SQL)
def _(spark, sf):
    raw = T.oracle_raw(spark, sf)
    key = A.best_result_key(F.col("delta_g"), "status", T.TIE)
    best = raw.groupBy("molecule_hash").agg(F.min_by(F.struct("delta_g", "status", "batch_id", "attempt", "day"), key).alias("r"))
    return best.select("molecule_hash", "r.*")


@query("a3_run_summary", """
    SELECT r.run_id, u.molecule_hash, round(avg(u.final_score), 6) AS final_score, round(avg(u.qed_score), 6) AS qed_score,
           round(avg(u.mw), 6) AS avg_molwt, round(avg(u.logp), 6) AS avg_logp, round(avg(u.sa_score), 6) AS avg_sa_score,
           max(u.toxicity_label) AS toxicity_label, 'xgboost' AS score_method
    FROM (SELECT s.*, x.final_score FROM screening_raw s JOIN unified x ON x.molecule_hash = s.molecule_hash) u
    JOIN registry r ON r.molecule_hash = u.molecule_hash
    WHERE r.run_id = 'cycle1' AND u.final_score IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    scores = V.unified(spark, sf).select("molecule_hash", "final_score")
    rows = T.screening_raw(spark, sf).join(scores, "molecule_hash")
    out = A.run_summary(rows, T.registry_keys(spark, sf), "cycle1")
    return rounded(out, "final_score", "qed_score", "avg_molwt", "avg_logp", "avg_sa_score")


CYCLE_SQL = """
    SELECT cycle, count(*) AS total, round(avg(final_score), 6) AS mean_affinity, round(median(final_score), 6) AS median_affinity,
           round(count(CASE WHEN final_score < -30 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS hit_rate,
           round(count(CASE WHEN final_score < -40 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS elite_rate,
           round(avg(qed_score), 6) AS mean_qed,
           round(count(CASE WHEN toxicity_label = 0 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS safety_rate,
           count(CASE WHEN final_score < -30 AND toxicity_label = 0 THEN 1 END) AS gold_count,
           round(count(CASE WHEN final_score < -30 AND toxicity_label = 0 THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS gold_rate
    FROM cycles GROUP BY 1"""


def cycle_metrics(spark, sf):
    scores = materialize(V.cycles(spark, sf).select("cycle", "final_score", "qed_score", "toxicity_label"), "cycles")
    m = A.cycle_metrics(scores)
    return rounded(m, "mean_affinity", "median_affinity", "hit_rate", "elite_rate", "mean_qed", "safety_rate", "gold_rate")


@query("a5_cycle_metrics", CYCLE_SQL)
def _(spark, sf):
    return cycle_metrics(spark, sf)


BIN_SQL = "SELECT cycle, " + ", ".join(
    f"round(count(CASE WHEN {cond} THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS {name}" for name, cond in {
        "strong_pct": "final_score < -40", "medium_pct": "final_score BETWEEN -40 AND -30", "weak_pct": "final_score > -30",
        "high_qed_pct": "qed_score > 0.6", "medium_qed_pct": "qed_score BETWEEN 0.2 AND 0.6", "low_qed_pct": "qed_score < 0.2"}.items()) \
    + ", count(*) AS total FROM cycles GROUP BY 1"


@query("a6_bin_distribution", BIN_SQL)
def _(spark, sf):
    out = A.bin_distribution(V.cycles(spark, sf).select("cycle", "final_score", "qed_score"))
    return rounded(out, *[c for c in out.columns if c.endswith("_pct")])


@query("a7_value_counts", """
    SELECT CASE toxicity_label WHEN 0 THEN 'Safe' WHEN 1 THEN 'Toxic' ELSE 'Unknown' END AS safety, count(*) AS n
    FROM screening_raw GROUP BY 1""")
def _(spark, sf):
    return A.value_counts(T.screening_raw(spark, sf).select(S.safety_class(F.col("toxicity_label")).alias("safety")), "safety")


@query("a8_run_count", "SELECT count(*) AS n_rows FROM registry_raw WHERE run_id = 'cycle2'")
def _(spark, sf):
    return A.run_count(T.registry_raw(spark, sf), "cycle2")


@query("a9_uniqueness", """
    SELECT count(*) AS total, count(DISTINCT molecule_hash) AS n_distinct,
           round(count(DISTINCT molecule_hash) / CAST(count(*) AS DOUBLE) * 100, 6) AS uniqueness_pct FROM registry_raw""")
def _(spark, sf):
    return rounded(A.uniqueness(T.registry_raw(spark, sf), "molecule_hash"), "uniqueness_pct")


@query("a10_status_report", """
    WITH c AS (SELECT status, count(*) AS n FROM oracle_raw GROUP BY 1), t AS (SELECT sum(n) AS total FROM c)
    SELECT status, n, round(n / CAST(total AS DOUBLE) * 100, 6) AS pct FROM c, t
    UNION ALL SELECT 'ALL', CAST(any_value(total) AS BIGINT), round(sum(CASE WHEN status = 'Success' THEN n END) / CAST(any_value(total) AS DOUBLE) * 100, 6) FROM c, t""")
def _(spark, sf):
    return rounded(A.status_report(T.oracle_by_doc(spark, sf)), "pct")


_LONG = " UNION ALL ".join(f"SELECT cycle, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM m" for m in METRICS)


@query("a11_cycle_compare", f"""
    WITH m AS ({CYCLE_SQL}), l AS ({_LONG}),
         w AS (SELECT metric, max(CASE WHEN cycle = 'cycle1' THEN value END) AS base_value,
                      max(CASE WHEN cycle = 'cycle2' THEN value END) AS new_value FROM l GROUP BY 1)
    SELECT metric, base_value, new_value, round(new_value - base_value, 6) AS delta,
           round(CASE WHEN base_value <> 0 THEN new_value / base_value END, 6) AS fold_change FROM w""")
def _(spark, sf):
    return rounded(A.cycle_compare(cycle_metrics(spark, sf), METRICS, "cycle1", "cycle2"), "delta", "fold_change")


@query("a12_zscore_outliers", """
    WITH s AS (SELECT avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS sd FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, round((l_extendedprice - mean) / sd, 6) AS z FROM lineitem, s
    WHERE abs((l_extendedprice - mean) / sd) > 1.7""")
def _(spark, sf):
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return rounded(A.zscore_outliers(li, "l_extendedprice", 1.7).drop("mean", "sd"), "z")


_SAFETY = "CASE toxicity_label WHEN 0 THEN 'Safe' WHEN 1 THEN 'Toxic' ELSE 'Unknown' END"


def _with_safety(spark, sf):
    return V.cycles(spark, sf).select("cycle", S.safety_class(F.col("toxicity_label")).alias("safety"), "final_score", "qed_score")


QUARTILE_SQL = f"""
    SELECT cycle, safety, round(min(final_score), 6) AS lowest, round(quantile_cont(final_score, 0.25), 6) AS q1,
           round(quantile_cont(final_score, 0.5), 6) AS median, round(quantile_cont(final_score, 0.75), 6) AS q3,
           round(max(final_score), 6) AS highest
    FROM (SELECT cycle, {_SAFETY} AS safety, final_score FROM cycles) GROUP BY 1, 2"""


@query("a13_quartiles", QUARTILE_SQL)
def _(spark, sf):
    return rounded(A.quartiles(_with_safety(spark, sf), ["cycle", "safety"], "final_score"), "lowest", "q1", "median", "q3", "highest")


@query("a13_order_quartiles", """
    SELECT o_orderpriority, min(o_totalprice) AS lowest, round(quantile_cont(o_totalprice, 0.25), 6) AS q1,
           round(quantile_cont(o_totalprice, 0.5), 6) AS median, round(quantile_cont(o_totalprice, 0.75), 6) AS q3, max(o_totalprice) AS highest
    FROM orders GROUP BY 1""")
def _(spark, sf):
    o = T.table(spark, sf, "orders").select("o_orderpriority", "o_totalprice")
    return rounded(A.quartiles(o, ["o_orderpriority"], "o_totalprice"), "q1", "median", "q3")


@query("a13_histogram", """
    SELECT cycle, CAST(CASE WHEN final_score < -80 THEN 0 WHEN final_score >= 0 THEN 17 ELSE floor((final_score + 80) / 5) + 1 END AS INTEGER) AS bin,
           count(*) AS n FROM cycles WHERE final_score IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    return A.histogram(V.cycles(spark, sf), ["cycle"], "final_score", -80.0, 0.0, 16)


@query("a13_scatter_bins", """
    SELECT cycle, CAST(floor(qed_score / 0.1) AS INTEGER) AS x_bin, CAST(floor(final_score / 5.0) AS INTEGER) AS y_bin, count(*) AS n
    FROM cycles WHERE qed_score IS NOT NULL AND final_score IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return A.scatter_bins(V.cycles(spark, sf), ["cycle"], "qed_score", "final_score", 0.1, 5.0)


QUALITY_COLS = ["docking_score", "qed_score", "sa_score", "logp", "mw", "toxicity_label"]


def quality_sql(run: str, cols: list[str], source: str, text: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(f"""
    SELECT {run}, '{c}' AS column_name, count(*) AS n_rows, round((count(*) - count({c})) / CAST(count(*) AS DOUBLE) * 100, 6) AS null_pct,
           count(DISTINCT {c}) AS n_distinct, CAST(count(DISTINCT {c}) = 1 AS INTEGER) AS is_constant,
           CAST({f"count(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL THEN 1 END)" if c in text else "0"} AS BIGINT) AS n_unparsable
    FROM {source} GROUP BY 1""" for c in cols)


@query("a14_quality_report", quality_sql("run_id", [*QUALITY_COLS, "method", "raw"], """(
        SELECT s.*, r.run_id, CASE WHEN s.qed_score >= 0 THEN 'dock' END AS method,
               CASE s.seq % 17 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE CAST(s.seq % 100 AS VARCHAR) END AS raw
        FROM screening s JOIN registry r ON r.molecule_hash = s.molecule_hash)""", ("raw",)))
def _(spark, sf):
    """Numbers, a constant column, and a text column with gaps, blanks and marks for missing values."""
    rows = T.screening(spark, sf).join(T.registry_keys(spark, sf).select("molecule_hash", "run_id"), "molecule_hash")
    at = F.col("seq") % 17
    raw = F.when(at == 0, "n/a").when(at == 1, None).when(at == 2, "").otherwise((F.col("seq") % 100).cast("string"))
    rows = rows.withColumn("method", F.when(F.col("qed_score") >= 0, "dock")).withColumn("raw", raw)
    return rounded(A.quality_report(rows, [*QUALITY_COLS, "method", "raw"], numeric_text=["raw"]), "null_pct")


_TOPS = """
    WITH b AS (SELECT molecule_hash, predicted_delta_g, docking_score FROM predictions JOIN screening USING (molecule_hash)),
         p AS (SELECT molecule_hash FROM b ORDER BY predicted_delta_g NULLS LAST, molecule_hash LIMIT 100),
         d AS (SELECT molecule_hash FROM b ORDER BY docking_score NULLS LAST, molecule_hash LIMIT 100)"""


@query("a15_discovery_rate", _TOPS + """
    SELECT count(*) AS k, count(CASE WHEN d.molecule_hash IS NULL THEN 1 END) AS n_new,
           round(count(CASE WHEN d.molecule_hash IS NULL THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS discovery_pct
    FROM p LEFT JOIN d USING (molecule_hash)""")
def _(spark, sf):
    both = T.predictions(spark, sf).join(T.screening(spark, sf), "molecule_hash").select("molecule_hash", "predicted_delta_g", "docking_score")
    return rounded(G.discovery_rate(both, 100, "predicted_delta_g", "docking_score"), "discovery_pct")


@query("a16_population_vs_unique_mean", """
    WITH k AS (SELECT molecule_hash, sum(delta_g) AS s, count(delta_g) AS n FROM oracle_raw WHERE status = 'Success' GROUP BY 1)
    SELECT round(sum(s) / sum(n), 6) AS population_mean, round(avg(s / n), 6) AS unique_mean, CAST(sum(n) AS BIGINT) AS n_rows,
           count(CASE WHEN n > 0 THEN 1 END) AS n_keys FROM k""")
def _(spark, sf):
    rows = T.oracle_raw(spark, sf).filter(F.col("status") == "Success")
    return rounded(A.population_vs_unique_mean(rows, "molecule_hash", "delta_g"), "population_mean", "unique_mean")


@query("a17_trend_by_iteration", """
    WITH t AS (SELECT cycle, max(-0.7 * final_score + 0.3 * qed_score) AS best, avg(-0.7 * final_score + 0.3 * qed_score) AS mean,
                      count(-0.7 * final_score + 0.3 * qed_score) AS n FROM cycles GROUP BY 1)
    SELECT cycle, round(best, 6) AS best, round(mean, 6) AS mean, n, round(best - lag(best) OVER (ORDER BY cycle), 6) AS best_change,
           round(mean - lag(mean) OVER (ORDER BY cycle), 6) AS mean_change FROM t""")
def _(spark, sf):
    out = A.trend_by_iteration(V.cycles(spark, sf), "cycle", S.default_mpo(F.col("final_score"), F.col("qed_score")))
    return rounded(out, "best", "mean", "best_change", "mean_change")


@query("a18_scaffold_share", """
    WITH t AS (SELECT r.smiles FROM unified u JOIN registry r USING (molecule_hash) ORDER BY u.final_score, u.molecule_hash LIMIT 200),
         c AS (SELECT split_part(smiles, ' ', 1) AS scaffold, count(*) AS n FROM t GROUP BY 1)
    SELECT scaffold, n, round(n / CAST((SELECT sum(n) FROM c) AS DOUBLE) * 100, 6) AS share_pct FROM c ORDER BY n DESC, scaffold LIMIT 10""")
def _(spark, sf):
    best = G.top_k(V.unified(spark, sf).select("molecule_hash", "final_score"), 200, "final_score")
    named = T.registry(spark, sf).join(best, "molecule_hash", "left_semi")
    return rounded(A.scaffold_share(named, F.split_part("smiles", F.lit(" "), F.lit(1)), 10), "share_pct")


@query("a19_regression_metrics", """
    SELECT p_type, round(sqrt(avg(e)), 6) AS rmse, round(1 - sum(e) / (var_pop(a) * count(a)), 6) AS r2, count(*) AS n
    FROM (SELECT p_type, p_retailprice AS a, power(p_size * 20 + 900 - p_retailprice, 2) AS e FROM part) GROUP BY 1""")
def _(spark, sf):
    rows = T.table(spark, sf, "part").withColumn("guess", (F.col("p_size") * 20 + 900).cast("double"))
    return rounded(A.regression_metrics(rows, "guess", "p_retailprice", ["p_type"]), "rmse", "r2")


@query("a20_gate", f"""
    WITH m AS ({CYCLE_SQL})
    SELECT cycle, 'safety_rate' AS metric, safety_rate AS value, CAST(90.0 AS DOUBLE) AS limit_value, CAST(safety_rate >= 90 AS INTEGER) AS passed FROM m
    UNION ALL SELECT cycle, 'mean_affinity', mean_affinity, CAST(-30.0 AS DOUBLE), CAST(mean_affinity <= -30 AS INTEGER) FROM m""")
def _(spark, sf):
    return A.gate(cycle_metrics(spark, sf), [("safety_rate", ">=", 90.0), ("mean_affinity", "<=", -30.0)])
