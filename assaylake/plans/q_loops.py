"""Queries for whole loop steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.plans import cycle as C
from assaylake.plans import views as V
from assaylake.plans.boosting_sql import model
from assaylake.plans.catalog import query
from assaylake.plans.q_aggregates import BIN_SQL, CYCLE_SQL, QUARTILE_SQL, quality_sql, rounded
from assaylake.plans.q_sources import write_shards
from assaylake.sources import tables as T
from assaylake.sources.readers import conform


@query("best_scores", """
    SELECT u.molecule_hash, u.final_score, u.score_method, u.qed_score, r.global_id, r.run_id
    FROM unified u JOIN registry r USING (molecule_hash) ORDER BY u.final_score NULLS LAST, u.molecule_hash LIMIT 100""")
def _(spark, sf):
    return V.best_scores(spark, sf, 100)


_INGEST = """
    WITH l AS (SELECT doc_id, CAST(doc_id // 1000 AS INTEGER) AS shard_id, doc_id % 1000 AS local_index,
                      trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), ' \t') AS line FROM documents),
         m AS (SELECT sha256(line) AS molecule_hash, 'gen_shard' || shard_id || '_idx' || local_index AS global_id FROM l WHERE line <> '')"""


def _ingest(spark, sf, stray: str = ""):
    old = T.registry_raw(spark, sf).filter("run_id = 'cycle2'").withColumn("created_at", F.lit("2023-01-01 00:00:00").cast("timestamp"))
    old = conform(C.A.first_row(old, "molecule_hash", ["seq"]), schemas.REGISTRY)
    d = T.table(spark, sf, "documents")
    line = C.S.strip(F.regexp_replace("text", r"[\r\n]+", " "))
    scores = [
        d.select(line.alias("smiles"), (F.col("n_chars").cast("double")).alias("mw")),
        d.join(T.table(spark, sf, "labels"), "doc_id").select(line.alias("smiles"), F.col("toxic").cast("int").alias("toxicity")),
    ]
    return C.ingest_cycle(spark, write_shards(spark, sf, stray), T.BASE, scores, "cycle3", "2024-01-01 00:00:00", old)


@query("r1_ingest_registry", _INGEST + """,
         old AS (SELECT molecule_hash, global_id, run_id FROM registry_raw WHERE run_id = 'cycle2'
                 QUALIFY row_number() OVER (PARTITION BY molecule_hash ORDER BY seq) = 1)
    SELECT * FROM old UNION ALL
    SELECT molecule_hash, min(global_id), 'cycle3' FROM m WHERE molecule_hash NOT IN (SELECT molecule_hash FROM old) GROUP BY 1""")
def _(spark, sf):
    return _ingest(spark, sf)[0].select("molecule_hash", "global_id", "run_id")


@query("r1_ingest_screening", _INGEST + """
    SELECT sha256(line) AS molecule_hash, CAST(min(n_chars) AS DOUBLE) AS mw, CAST(min(toxic) AS INTEGER) AS toxicity_label
    FROM l JOIN documents USING (doc_id) LEFT JOIN labels USING (doc_id) WHERE line <> '' GROUP BY 1""")
def _(spark, sf):
    return _ingest(spark, sf)[1].select("molecule_hash", "mw", "toxicity_label")


@query("r1_skipped_lines", """
    SELECT count(*) AS n_lines_skipped, count(DISTINCT doc_id // 1000) AS n_files_skipped FROM documents
    WHERE doc_id // 1000 % 4 = 0 AND trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), ' \t') <> ''""")
def _(spark, sf):
    """Every fourth folder does not tell its shard."""
    return _ingest(spark, sf, "part_")[2]


_LABEL_SQL = """
    WITH o AS (SELECT molecule_hash, row_number() OVER (ORDER BY molecule_hash) - 1 AS i FROM selected),
         map AS (SELECT i // 8 AS batch_id, 'mol_' || (i % 8) AS mol_index, molecule_hash FROM o),
         res AS (SELECT l_suppkey AS batch_id, 'mol_' || l_linenumber AS mol_index, 0.0 - l_quantity AS delta_g, l_returnflag <> 'R' AS ok FROM lineitem),
         fresh AS (SELECT molecule_hash, min(CASE WHEN ok THEN delta_g END) AS delta_g, 'run9' AS run_id FROM map JOIN res USING (batch_id, mol_index) GROUP BY 1)"""


def _label_cycle(spark, sf):
    """(the started round, the validated table, results of unknown batches)."""
    started = C.start_labelling(T.screening(spark, sf), 80, 20, 8)
    lost = F.col("l_returnflag") == "R"
    results = T.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("batch_id"), F.concat(F.lit("mol_"), F.col("l_linenumber").cast("string")).alias("mol_index"),
        (F.lit(0.0) - F.col("l_quantity")).alias("delta_g"), F.when(lost, "Failed_Analysis").otherwise("Success").alias("status"))
    gold = T.gold(spark, sf).withColumn("ts", F.lit("2023-01-01 00:00:00").cast("timestamp"))
    return started, *C.finish_labelling(results, started.batch_map, gold, "run9", F.lit("2024-01-01 00:00:00").cast("timestamp"))


@query("r2_label_cycle", _LABEL_SQL + """
    SELECT * FROM fresh
    UNION ALL SELECT molecule_hash, delta_g, run_id FROM gold WHERE molecule_hash NOT IN (SELECT molecule_hash FROM fresh)""")
def _(spark, sf):
    return _label_cycle(spark, sf)[1].select("molecule_hash", "delta_g", "run_id")


@query("r2_batches", _LABEL_SQL + " SELECT batch_id, mol_index, molecule_hash, strategy FROM map JOIN selected USING (molecule_hash)")
def _(spark, sf):
    started = C.start_labelling(T.screening(spark, sf), 80, 20, 8)
    return started.batch_map.join(started.selected, "molecule_hash").select("batch_id", "mol_index", "molecule_hash", "strategy")


@query("r2_unlabeled_pool", """
    SELECT molecule_hash, docking_score, toxicity_label FROM screening WHERE molecule_hash NOT IN (SELECT molecule_hash FROM selected)""")
def _(spark, sf):
    return C.start_labelling(T.screening(spark, sf), 80, 20, 8).unlabeled.select("molecule_hash", "docking_score", "toxicity_label")


@query("r2_unmatched_results", _LABEL_SQL + """
    SELECT batch_id, mol_index, delta_g, CASE WHEN ok THEN 'Success' ELSE 'Failed_Analysis' END AS status
    FROM res r WHERE NOT EXISTS (SELECT 1 FROM map m WHERE m.batch_id = r.batch_id AND m.mol_index = r.mol_index)""")
def _(spark, sf):
    return _label_cycle(spark, sf)[2].select("batch_id", "mol_index", "delta_g", "status")


_LEARN_SQL = f"""
    {model(3, 3, "CASE WHEN split = 'train' THEN 1 ELSE 0 END")},
         learned AS (SELECT u.* REPLACE (coalesce(g.delta_g, m.p, u.final_score) AS final_score,
                                         CASE WHEN g.delta_g IS NOT NULL THEN 'gromacs' WHEN m.p IS NOT NULL THEN 'xgboost' ELSE u.score_method END AS score_method)
                     FROM unified u LEFT JOIN m_pred m USING (molecule_hash) LEFT JOIN gold g USING (molecule_hash))"""

_ELITE_SQL = _LEARN_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
         pool AS (SELECT row_number() OVER (ORDER BY final_score NULLS LAST, molecule_hash) - 1 AS rank, molecule_hash, final_score, smiles
                  FROM learned JOIN registry USING (molecule_hash) WHERE sa_score < 4.0 AND qed_score > 0.5
                  ORDER BY rank LIMIT 20000),
         fp AS (SELECT DISTINCT rank, CAST(('0x' || substr(md5(gram), 1, 8)) AS BIGINT) % 2147483648 AS bit
                FROM (SELECT rank, unnest(list_transform(range(1, length(smiles) - 6), lambda i: substr(smiles, i, 8))) AS gram FROM pool)),
         size AS (SELECT rank, count(*) AS size FROM fp GROUP BY 1),
         link AS (SELECT a, b FROM (SELECT x.rank AS a, y.rank AS b, count(*) AS shared FROM fp x JOIN fp y ON x.bit = y.bit AND x.rank <> y.rank GROUP BY ALL)
                  JOIN size sa ON sa.rank = a JOIN size sb ON sb.rank = b WHERE shared * 100 >= 65 * (sa.size + sb.size - shared)),
         walk AS (
             SELECT DISTINCT a AS id, CAST(NULL AS BIGINT) AS leader FROM link
             UNION ALL
             (WITH alive AS (SELECT id FROM walk WHERE leader IS NULL),
                   degree AS (SELECT l.a AS id, count(*) AS d FROM link l JOIN alive x ON x.id = l.a JOIN alive y ON y.id = l.b GROUP BY 1),
                   lead AS (SELECT x.id FROM alive x LEFT JOIN degree USING (id) ORDER BY coalesce(d, 0) DESC, x.id LIMIT 1)
              SELECT x.id, CASE WHEN x.id = lead.id OR l.b IS NOT NULL THEN lead.id END
              FROM alive x CROSS JOIN lead LEFT JOIN link l ON l.a = lead.id AND l.b = x.id)),
         grouped AS (SELECT p.molecule_hash, p.final_score, p.rank, coalesce(w.leader, p.rank) AS lead
                     FROM pool p LEFT JOIN (SELECT id, leader FROM walk WHERE leader IS NOT NULL) w ON w.id = p.rank),
         named AS (SELECT g.molecule_hash, g.final_score, g.rank, p.molecule_hash AS cluster_id FROM grouped g JOIN pool p ON p.rank = g.lead),
         chosen AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY rank) = 1 ORDER BY rank LIMIT 80),
         drawn AS (SELECT * FROM named WHERE molecule_hash NOT IN (SELECT molecule_hash FROM chosen)
                   QUALIFY row_number() OVER (ORDER BY md5('elite' || molecule_hash), molecule_hash) <= 20 + 80 - (SELECT count(*) FROM chosen)),
         elite_rows AS (SELECT *, 'cluster_centroid' AS selection_strategy FROM chosen UNION ALL SELECT *, 'diversity_random' FROM drawn)"""


def _learn(spark, sf):
    return C.learn_cycle(T.gold(spark, sf), T.registry(spark, sf), V.unified(spark, sf), "proxy_2", "cycle2", 20_000, 80, 20, trees=3, depth=3)


@query("r3_learn_cycle", _ELITE_SQL + """
    SELECT *, CASE WHEN CAST(('0x' || substr(md5('split' || molecule_hash), 1, 8)) AS BIGINT) < CAST(0.9 * 4294967296 AS BIGINT) THEN 'train' ELSE 'valid' END AS split
    FROM elite_rows""")
def _(spark, sf):
    return _learn(spark, sf).elite.drop("smiles")


@query("r3_learned_scores", _LEARN_SQL + " SELECT molecule_hash, final_score, score_method, qed_score FROM learned")
def _(spark, sf):
    return _learn(spark, sf).screening.select("molecule_hash", "final_score", "score_method", "qed_score")


_BINS = {"strong_pct": "final_score < -40", "medium_pct": "final_score BETWEEN -40 AND -30", "weak_pct": "final_score > -30",
         "high_qed_pct": "qed_score > 0.6", "medium_qed_pct": "qed_score BETWEEN 0.2 AND 0.6", "low_qed_pct": "qed_score < 0.2"}
_BIN_SQL = "SELECT cycle, " + ", ".join(f"count(CASE WHEN {c} THEN 1 END) / CAST(count(*) AS DOUBLE) * 100 AS {n}" for n, c in _BINS.items()) \
    + " FROM cycles GROUP BY 1"
_LONG = " UNION ALL ".join(
    [f"SELECT cycle, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM m" for m in C.REPORT_METRICS]
    + [f"SELECT cycle, '{m}', {m} FROM b" for m in C.BIN_METRICS])


@query("r4_report_cycle", f"""
    WITH m AS ({CYCLE_SQL}), b AS ({_BIN_SQL}), l AS ({_LONG})
    SELECT metric, round(max(CASE WHEN cycle = 'cycle1' THEN value END), 4) AS base_value,
           round(max(CASE WHEN cycle = 'cycle2' THEN value END), 4) AS new_value FROM l GROUP BY 1""")
def _(spark, sf):
    tables = C.report_cycle(V.cycles(spark, sf), "cycle1", "cycle2")
    both = tables["compare"].unionByName(tables["bin_compare"])
    return both.select("metric", F.round("base_value", 4).alias("base_value"), F.round("new_value", 4).alias("new_value"))


def _report(spark, sf, table, *digits):
    return rounded(C.report_cycle(V.cycles(spark, sf), "cycle1", "cycle2")[table], *digits)


@query("r4_metrics", CYCLE_SQL)
def _(spark, sf):
    return _report(spark, sf, "metrics", "mean_affinity", "median_affinity", "hit_rate", "elite_rate", "mean_qed", "safety_rate", "gold_rate")


@query("r4_bins", BIN_SQL)
def _(spark, sf):
    return _report(spark, sf, "bins", *C.BIN_METRICS)


@query("r4_quartiles", QUARTILE_SQL)
def _(spark, sf):
    return _report(spark, sf, "quartiles", "lowest", "q1", "median", "q3", "highest")


@query("r4_landscape", """
    SELECT cycle, CAST(floor(qed_score / 0.05) AS INTEGER) AS x_bin, CAST(floor(final_score / 5.0) AS INTEGER) AS y_bin, count(*) AS n
    FROM cycles WHERE qed_score IS NOT NULL AND final_score IS NOT NULL GROUP BY ALL""")
def _(spark, sf):
    return _report(spark, sf, "landscape")


@query("r4_quality", quality_sql("cycle", ["final_score", "qed_score", "sa_score", "logp", "mw", "docking_score", "toxicity_label"], "cycles"))
def _(spark, sf):
    return _report(spark, sf, "quality", "null_pct")


@query("r4_gate", f"""
    WITH m AS ({CYCLE_SQL})
    SELECT cycle, 'safety_rate' AS metric, safety_rate AS value, CAST(90.0 AS DOUBLE) AS limit_value, CAST(safety_rate >= 90 AS INTEGER) AS passed FROM m""")
def _(spark, sf):
    return _report(spark, sf, "gate", "value")
