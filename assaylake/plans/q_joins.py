"""Queries for joins, leaderboards, similarity joins and the Pareto front."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.functions import fingerprints as FP
from assaylake.functions import predicates as P
from assaylake.functions import scalars as S
from assaylake.operators import joins as J
from assaylake.operators import similarity as Z
from assaylake.operators.aggregates import validation_metrics, value_counts
from assaylake.operators.pareto import pareto_front
from assaylake.plans import views as V
from assaylake.plans.catalog import query
from assaylake.session import small_side, spread
from assaylake.sources import tables as T

SIM_BITS, SIM_K, SIM_MIN = 1 << 31, 8, 0.65


@query("q1_report_rows", """
    SELECT r.run_id, u.molecule_hash, u.final_score, u.qed_score, u.mw AS mol_wt, u.logp, u.sa_score, u.toxicity_label, u.score_method
    FROM unified u JOIN registry r ON r.molecule_hash = u.molecule_hash
    WHERE r.run_id = 'cycle2' AND u.final_score IS NOT NULL""")
def _(spark, sf):
    rows = V.cycles(spark, sf).filter(P.scored_in_run("cycle2", "cycle"))
    return rows.select(F.col("cycle").alias("run_id"), "molecule_hash", "final_score", "qed_score", F.col("mw").alias("mol_wt"),
                       "logp", "sa_score", "toxicity_label", "score_method")


def score_families(spark, sf):
    """Three score files per molecule as separate engines would leave them, with retried duplicates."""
    s = T.screening_raw(spark, sf)
    props = s.select(F.col("molecule_hash").alias("smiles"), F.col("qed_score").alias("qed"), "sa_score")
    tox = s.filter(F.col("toxicity_label").isNotNull()).select(F.col("molecule_hash").alias("smiles"), F.col("toxicity_label").alias("toxicity"))
    dock = s.filter(F.col("docking_score").isNotNull()).select(F.col("molecule_hash").alias("smiles"), "docking_score")
    return props, tox, dock


@query("j1_join_scores", """
    WITH props AS (SELECT molecule_hash, qed_score AS qed, sa_score FROM screening_raw
                   QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY qed_score, sa_score) = 1),
         tox AS (SELECT molecule_hash, min(toxicity_label) AS toxicity FROM screening_raw WHERE toxicity_label IS NOT NULL GROUP BY 1),
         dock AS (SELECT molecule_hash, min(docking_score) AS docking_score FROM screening_raw WHERE docking_score IS NOT NULL GROUP BY 1)
    SELECT m.global_id, m.molecule_hash AS smiles, qed, sa_score, toxicity, docking_score
    FROM registry_raw m LEFT JOIN props USING (molecule_hash) LEFT JOIN tox USING (molecule_hash) LEFT JOIN dock USING (molecule_hash)""")
def _(spark, sf):
    manifest = T.registry_raw(spark, sf).select("global_id", F.col("molecule_hash").alias("smiles"))
    return J.join_scores(manifest, *score_families(spark, sf)).select("global_id", "smiles", "qed", "sa_score", "toxicity", "docking_score")


@query("j2_candidates_with_ids", """
    SELECT DISTINCT r.molecule_hash, r.global_id FROM selected s JOIN registry_raw r ON r.molecule_hash = s.molecule_hash""")
def _(spark, sf):
    return J.candidates_with_ids(V.selected(spark, sf), T.registry_raw(spark, sf))


def _batch_inputs(spark, sf):
    sup = T.table(spark, sf, "supplier")
    batch_map = sup.select(F.col("s_suppkey").alias("batch_id"), F.explode(F.array(F.lit("mol_1"), F.lit("mol_2"))).alias("mol_index"), "s_name") \
        .select("batch_id", "mol_index", S.molecule_hash(F.concat("s_name", "mol_index")).alias("molecule_hash"))
    # line numbers run to 7, so most results belong to a place the map does not hold
    results = T.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("batch_id"), F.concat(F.lit("mol_"), F.col("l_linenumber").cast("string")).alias("mol_index"),
        (F.lit(0.0) - F.col("l_quantity")).alias("delta_g"))
    return results, batch_map


_MAP_SQL = """
    WITH map AS (SELECT s_suppkey AS batch_id, m AS mol_index, sha256(s_name || m) AS molecule_hash
                 FROM supplier, (VALUES ('mol_1'), ('mol_2')) t(m)),
         res AS (SELECT l_suppkey AS batch_id, 'mol_' || l_linenumber AS mol_index, 0.0 - l_quantity AS delta_g FROM lineitem)"""


@query("j3_attach_batch_hash", _MAP_SQL + """
    SELECT molecule_hash, count(*) AS n, min(delta_g) AS best FROM res JOIN map USING (batch_id, mol_index) GROUP BY 1""")
def _(spark, sf):
    matched, _ = J.attach_batch_hash(*_batch_inputs(spark, sf))
    return matched.groupBy("molecule_hash").agg(F.count("*").alias("n"), F.min("delta_g").alias("best"))


@query("j3_unmatched_results", _MAP_SQL + """
    SELECT mol_index, count(*) AS n FROM res WHERE NOT EXISTS (
        SELECT 1 FROM map WHERE map.batch_id = res.batch_id AND map.mol_index = res.mol_index) GROUP BY 1""")
def _(spark, sf):
    return value_counts(J.attach_batch_hash(*_batch_inputs(spark, sf))[1], "mol_index")


@query("j3_collapsed_map", _MAP_SQL + """
    SELECT molecule_hash, count(*) AS n FROM res JOIN (
        SELECT batch_id, arg_max(molecule_hash, mol_index) AS molecule_hash FROM map GROUP BY 1) USING (batch_id) GROUP BY 1""")
def _(spark, sf):
    results, batch_map = _batch_inputs(spark, sf)
    return value_counts(J.attach_batch_hash(results, batch_map, collapsed=True)[0], "molecule_hash")


@query("j4_leaderboard", """
    SELECT r.smiles, g.delta_g, g.method, s.docking_score, s.qed_score, g.molecule_hash
    FROM registry r JOIN gold g USING (molecule_hash) LEFT JOIN screening s USING (molecule_hash)""")
def _(spark, sf):
    return J.leaderboard(T.registry(spark, sf), T.gold(spark, sf), T.screening(spark, sf))


@query("j5_comprehensive", """
    SELECT r.molecule_hash, coalesce(g.delta_g, p.predicted_delta_g) AS best_estimate_score,
           CASE WHEN g.delta_g IS NOT NULL THEN 'GOLD_PHYSICS' ELSE 'BRONZE_AI' END AS confidence_tier, s.qed_score, s.toxicity_label,
           length(r.smiles) AS chars
    FROM registry r LEFT JOIN gold g USING (molecule_hash) LEFT JOIN predictions p USING (molecule_hash)
    LEFT JOIN screening s USING (molecule_hash)""")
def _(spark, sf):
    return V.comprehensive(spark, sf).withColumn("chars", F.length("smiles").cast("bigint")).drop("smiles")


_UNION_SQL = """
    SELECT molecule_hash, delta_g AS score, 'GOLD' AS source, run_id FROM gold WHERE delta_g IS NOT NULL
    UNION ALL
    SELECT molecule_hash, predicted_delta_g, 'BRONZE', run_id FROM predictions
    WHERE molecule_hash NOT IN (SELECT molecule_hash FROM gold)"""


def _tier_union(spark, sf):
    empty = F.lit(None).cast("string").alias("smiles")
    return J.comprehensive_union(T.gold(spark, sf).select("*", empty), T.predictions(spark, sf).select("*", empty)).drop("smiles")


@query("j6_comprehensive_union", _UNION_SQL)
def _(spark, sf):
    return _tier_union(spark, sf)


@query("u1_tier_union", f"SELECT source, run_id, count(*) AS n, round(avg(score), 6) AS mean_score FROM ({_UNION_SQL}) GROUP BY ALL")
def _(spark, sf):
    return _tier_union(spark, sf).groupBy("source", "run_id").agg(F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mean_score"))


@query("j7_unlabeled_pool", """
    SELECT molecule_hash, docking_score FROM screening WHERE molecule_hash NOT IN (SELECT molecule_hash FROM selected)""")
def _(spark, sf):
    return J.unlabeled_pool(T.screening(spark, sf), V.selected(spark, sf)).select("molecule_hash", "docking_score")


@query("j8_pred_vs_truth", """
    SELECT molecule_hash, predicted_delta_g, delta_g FROM predictions JOIN gold USING (molecule_hash) WHERE delta_g IS NOT NULL""")
def _(spark, sf):
    return J.pred_vs_truth(T.predictions(spark, sf), T.gold(spark, sf))


@query("a4_validation_metrics", """
    SELECT round(corr(predicted_delta_g, delta_g), 9) AS correlation,
           round(sqrt(avg(power(predicted_delta_g - delta_g, 2))), 9) AS rmse, count(*) AS n
    FROM predictions JOIN gold USING (molecule_hash) WHERE delta_g IS NOT NULL""")
def _(spark, sf):
    m = validation_metrics(J.pred_vs_truth(T.predictions(spark, sf), T.gold(spark, sf)), "predicted_delta_g", "delta_g")
    return m.select(F.round("correlation", 9).alias("correlation"), F.round("rmse", 9).alias("rmse"), "n")


@query("j10_training_set", """
    SELECT molecule_hash, length(smiles) AS chars, delta_g AS label FROM gold JOIN registry USING (molecule_hash) WHERE delta_g IS NOT NULL""")
def _(spark, sf):
    return J.training_set(T.gold(spark, sf), T.registry(spark, sf)).select(
        "molecule_hash", F.length("smiles").cast("bigint").alias("chars"), "label")


@query("j11_lineage", """
    SELECT r.molecule_hash, r.run_id AS generated_in, s.docking_score, g.delta_g, g.run_id AS labelled_in,
           p.predicted_delta_g, p.model_version, e.strategy AS selection_strategy
    FROM registry r LEFT JOIN screening s USING (molecule_hash) LEFT JOIN gold g USING (molecule_hash)
    LEFT JOIN predictions p USING (molecule_hash) LEFT JOIN selected e USING (molecule_hash)""")
def _(spark, sf):
    reg = T.registry_keys(spark, sf)
    chosen = V.selected(spark, sf).withColumnRenamed("strategy", "selection_strategy")
    return J.lineage(reg, reg, T.screening(spark, sf), T.gold(spark, sf), T.predictions(spark, sf), chosen)


@query("j13_orphans", """
    SELECT DISTINCT sha256('part-' || p_name) AS molecule_hash FROM part
    WHERE sha256('part-' || p_name) NOT IN (SELECT molecule_hash FROM registry)""")
def _(spark, sf):
    facts = T.table(spark, sf, "part").select(S.molecule_hash(F.concat(F.lit("part-"), "p_name")).alias("molecule_hash"))
    both = facts.unionByName(T.screening(spark, sf).select("molecule_hash"))
    return J.orphans(both, T.registry_keys(spark, sf)).distinct()


def texts(spark, sf):
    """The documents with their run; their sets are computed of the texts where a step needs them."""
    d = spread(T.table(spark, sf, "documents").select("doc_id", "text"))
    return d.withColumn("run_id", F.when(F.col("doc_id") % 10 == 0, "cycle2").otherwise("cycle1"))


def text_set():
    return FP.fingerprint_of(F.col("text"), SIM_BITS, SIM_K)


def previous_elite(spark, sf):
    """All candidates of the second cycle and the elite set of the first, chosen ahead of its sets."""
    docs = texts(spark, sf)
    elite = T.screening_raw(spark, sf).filter(P.elite_filter()).select(F.col("seq").alias("doc_id"))
    old = docs.filter(F.col("run_id") == "cycle1").join(small_side(elite), "doc_id", "left_semi")
    return docs.filter(F.col("run_id") == "cycle2"), old


_FP_CTE = """
    WITH chars AS (SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM documents),
         gram AS (SELECT doc_id, c || """ + " || ".join(f"lead(c, {i}) OVER w" for i in range(1, SIM_K)) + """ AS g
                  FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
         post AS (SELECT DISTINCT doc_id, CAST(('0x' || substr(md5(g), 1, 8)) AS BIGINT) % 2147483648 AS bit FROM gram WHERE g IS NOT NULL),
         sets AS (SELECT doc_id, count(*) AS size, md5(string_agg(bit, ',' ORDER BY bit)) AS set_id FROM post GROUP BY 1)"""


# the sequential rule, one leader a step, over all documents that have a partner
CLUSTER_CTE = _FP_CTE.replace("WITH ", "WITH RECURSIVE ", 1) + """,
         link AS (
             SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM post x JOIN post y ON x.bit = y.bit AND x.doc_id <> y.doc_id GROUP BY ALL)
             JOIN sets sa ON sa.doc_id = a JOIN sets sb ON sb.doc_id = b WHERE shared * 100 >= 65 * (sa.size + sb.size - shared)),
         walk AS (
             SELECT DISTINCT a AS id, CAST(NULL AS BIGINT) AS leader FROM link
             UNION ALL
             (WITH alive AS (SELECT id FROM walk WHERE leader IS NULL),
                   degree AS (SELECT l.a AS id, count(*) AS d FROM link l JOIN alive x ON x.id = l.a JOIN alive y ON y.id = l.b GROUP BY 1),
                   lead AS (SELECT x.id FROM alive x LEFT JOIN degree USING (id) ORDER BY coalesce(d, 0) DESC, x.id LIMIT 1)
              SELECT x.id, CASE WHEN x.id = lead.id OR l.b IS NOT NULL THEN lead.id END
              FROM alive x CROSS JOIN lead LEFT JOIN link l ON l.a = lead.id AND l.b = x.id)),
         clusters AS (SELECT d.doc_id, coalesce(w.leader, d.doc_id) AS cluster_id
                      FROM documents d LEFT JOIN (SELECT id, leader FROM walk WHERE leader IS NOT NULL) w ON w.id = d.doc_id)"""


@query("j9_similarity_join", _FP_CTE + """,
         rep AS (SELECT set_id, min(doc_id) AS rep, count(*) AS copies, any_value(size) AS size FROM sets GROUP BY 1),
         rpost AS (SELECT p.doc_id, p.bit FROM post p JOIN rep r ON r.rep = p.doc_id),
         inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM rpost a JOIN rpost b ON a.bit = b.bit AND a.doc_id < b.doc_id GROUP BY ALL)
    SELECT x AS rep_a, y AS rep_b, ra.copies AS copies_a, rb.copies AS copies_b,
           round(CAST(shared AS DOUBLE) / (ra.size + rb.size - shared), 9) AS sim
    FROM inter JOIN rep ra ON ra.rep = x JOIN rep rb ON rb.rep = y
    WHERE shared * 100 >= 65 * (ra.size + rb.size - shared)""")
def _(spark, sf):
    pairs = Z.similarity_join(texts(spark, sf), None, SIM_MIN, "doc_id", text_set())
    return pairs.withColumn("sim", F.round("sim", 9))


_MAX_SIM_SQL = _FP_CTE + """,
         new AS (SELECT doc_id FROM documents WHERE doc_id % 10 = 0),
         old AS (SELECT seq AS doc_id FROM screening_raw WHERE seq % 10 <> 0 AND sa_score < 4 AND qed_score > 0.5),
         inter AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM post a JOIN new USING (doc_id)
                   JOIN (SELECT * FROM post JOIN old USING (doc_id)) b ON a.bit = b.bit GROUP BY ALL),
         sim AS (SELECT x AS doc_id, max(CAST(shared AS DOUBLE) / (sa.size + sb.size - shared)) AS max_sim
                 FROM inter JOIN sets sa ON sa.doc_id = x JOIN sets sb ON sb.doc_id = y GROUP BY 1)"""


@query("f8_novel", _MAX_SIM_SQL + """
    SELECT n.doc_id, round(coalesce(max_sim, 0.0), 9) AS max_sim FROM new n LEFT JOIN sim USING (doc_id)
    WHERE coalesce(max_sim, 0.0) <= 0.7""")
def _(spark, sf):
    new, old = previous_elite(spark, sf)
    near = Z.max_similarity(new, old, 0.0, "doc_id", text_set())
    return near.filter(P.novel()).withColumn("max_sim", F.round("max_sim", 9))


@query("e17_similarity_penalty", _MAX_SIM_SQL + """
    SELECT n.doc_id, round(s.docking_score + 10.0 * coalesce(max_sim, 0.0), 6) AS penalised
    FROM new n JOIN screening_raw s ON s.seq = n.doc_id LEFT JOIN sim ON sim.doc_id = n.doc_id""")
def _(spark, sf):
    new, old = previous_elite(spark, sf)
    near = Z.max_similarity(new, old, 0.0, "doc_id", text_set())
    scores = T.screening_raw(spark, sf).select(F.col("seq").alias("doc_id"), "docking_score")
    return near.join(scores, "doc_id").select(
        "doc_id", F.round(S.similarity_penalty(F.col("docking_score"), F.col("max_sim"), 10.0), 6).alias("penalised"))


@query("j12_pareto_front", """
    WITH o AS (SELECT molecule_hash, docking_score, qed_score, sa_score, mw FROM screening WHERE docking_score IS NOT NULL)
    SELECT molecule_hash, docking_score, qed_score, sa_score, mw FROM o a WHERE NOT EXISTS (
        SELECT 1 FROM o b WHERE b.docking_score <= a.docking_score AND b.qed_score >= a.qed_score AND b.sa_score <= a.sa_score AND b.mw <= a.mw
          AND (b.docking_score < a.docking_score OR b.qed_score > a.qed_score OR b.sa_score < a.sa_score OR b.mw < a.mw))""")
def _(spark, sf):
    rows = T.screening(spark, sf).select("molecule_hash", "docking_score", "qed_score", "sa_score", "mw")
    return pareto_front(rows, [("docking_score", True), ("qed_score", False), ("sa_score", True), ("mw", True)])


@query("j12_pareto_parts", """
    WITH o AS (SELECT DISTINCT p_size, p_retailprice FROM part)
    SELECT p_partkey, p_size, p_retailprice FROM part a WHERE NOT EXISTS (
        SELECT 1 FROM o b WHERE b.p_size <= a.p_size AND b.p_retailprice <= a.p_retailprice
          AND (b.p_size < a.p_size OR b.p_retailprice < a.p_retailprice))""")
def _(spark, sf):
    parts = T.table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return pareto_front(parts, [("p_size", True), ("p_retailprice", True)])
