"""Loop drivers: ingest, label, learn and report, each a composition of the operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.functions import scalars as S
from assaylake.functions.fingerprints import fingerprint
from assaylake.operators import aggregates as A
from assaylake.operators import joins as J
from assaylake.operators import mutation as M
from assaylake.operators import proxy as X
from assaylake.operators import selection as G
from assaylake.operators.clustering import cluster_by_similarity
from assaylake.operators.indexing import with_row_index
from assaylake.session import materialize
from assaylake.sources import readers as R
from assaylake.sources import writers as W


def ingest_cycle(spark: SparkSession, shard_glob: str, base: str, scores: list[DataFrame], run_id: str, created_at: str,
                 registry: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(registry with the new molecules, screening rows of this run, one row with what was skipped).

    One lazy plan: shard lines → manifest → score join → identity → conform → insert of new hashes.
    """
    lines, skipped = R.read_shard_lines(spark, shard_glob)
    joined = J.join_scores(R.build_manifest(lines, base), *scores)
    hashed = S.stamp(joined.withColumn("molecule_hash", S.molecule_hash(F.col("smiles"))), run_id, created_at)
    screening = R.conform(hashed, schemas.SCREENING, {"qed": "qed_score", "toxicity": "toxicity_label"})
    return M.insert_new(registry, R.conform(hashed, schemas.REGISTRY)), A.first_row(screening, "molecule_hash", screening.columns[1:]), skipped


@dataclass
class LabelRound:
    selected: DataFrame
    unlabeled: DataFrame
    batch_map: DataFrame


def start_labelling(screening: DataFrame, k_exploit: int, k_explore: int, batch_size: int = 1, seed: str = "label") -> LabelRound:
    """Choose molecules, keep the rest as the pool, cut the chosen into batches.

    The choice is written once: what is handed out for labelling must be what the pool lacks.
    """
    chosen = materialize(G.select_for_labelling(screening, k_exploit, k_explore, seed=seed), "selected")
    batches = materialize(W.label_batches(chosen, [F.col("molecule_hash").asc()], batch_size), "batch-map")
    return LabelRound(chosen, J.unlabeled_pool(screening, chosen), batches)


def finish_labelling(results: DataFrame, batch_map: DataFrame, gold: DataFrame, run_id: str, ts: Column,
                     tie: tuple[str, ...] = ("delta_g",)) -> tuple[DataFrame, DataFrame]:
    """(validated table with the new labels, results of unknown batches)."""
    matched, unknown = J.attach_batch_hash(results, batch_map)
    best = A.best_result(matched, tie=tie)
    fresh = best.select("molecule_hash", F.when(F.col("status") == A.SUCCESS, F.col("delta_g")).alias("delta_g"), "status",
                        F.lit(run_id).alias("run_id"), ts.alias("ts"))
    return M.upsert_latest(gold.select(*fresh.columns), fresh), unknown


@dataclass
class LearnRound:
    model: X.Trees
    metrics: DataFrame
    predictions: DataFrame
    screening: DataFrame
    elite: DataFrame


def learn_cycle(gold: DataFrame, registry: DataFrame, screening: DataFrame, model_version: str, run_id: str, pool_size: int,
                n_struct: int, n_random: int, min_sim: float = 0.65, trees: int = X.N_TREES, depth: int = X.DEPTH,
                fp_bits: int = 1 << 31, fp_k: int = 8) -> LearnRound:
    """Train on the labels, score the pool, unify, cluster the elite pool and split it for training."""
    labelled, _ = X.featurize(J.training_set(gold, registry))
    rows = materialize(X.with_split(labelled.drop("smiles")), "train")
    model = X.train_proxy(rows.filter("split = 'train'"), trees=trees, depth=depth)
    everything, _ = X.featurize(registry.select("molecule_hash", "smiles"))
    predictions = materialize(X.predict_pool(model, everything, model_version, run_id), "predictions")
    unified = materialize(M.unify_scores(screening, predictions, gold), "unified")
    pool = G.elite_pool(unified, pool_size).select("molecule_hash", "final_score").join(
        registry.select("molecule_hash", "smiles"), "molecule_hash")
    ranked = materialize(with_row_index(pool, [F.col("final_score").asc_nulls_last(), F.col("molecule_hash").asc()], index="rank")
                         .withColumn("fp", fingerprint(F.col("smiles"), fp_bits, fp_k)), "pool")
    clustered = materialize(cluster_by_similarity(ranked, "molecule_hash", "rank", "fp", min_sim).drop("fp"), "clusters")
    elite = G.hash_split(G.select_elite(clustered, n_struct, n_random), 0.9)
    return LearnRound(model, X.evaluate_proxy(model, rows), predictions, unified, elite)


REPORT_METRICS = ["total", "mean_affinity", "median_affinity", "hit_rate", "elite_rate", "mean_qed", "safety_rate", "gold_count", "gold_rate"]
BIN_METRICS = ["strong_pct", "medium_pct", "weak_pct", "high_qed_pct", "medium_qed_pct", "low_qed_pct"]


def report_cycle(scores: DataFrame, base: str, new: str) -> dict[str, DataFrame]:
    """The tables of the cycle report from unified scores tagged with their cycle."""
    scores = materialize(scores.select("cycle", "final_score", "qed_score", "sa_score", "logp", "mw", "docking_score", "toxicity_label"), "report")
    metrics = materialize(A.cycle_metrics(scores), "metrics")  # one row per cycle
    bins = A.bin_distribution(scores)
    safety = scores.withColumn("safety", S.safety_class(F.col("toxicity_label")))
    return {
        "metrics": metrics,
        "compare": A.cycle_compare(metrics, REPORT_METRICS, base, new),
        "bins": bins,
        "bin_compare": A.cycle_compare(bins, BIN_METRICS, base, new),
        "quartiles": A.quartiles(safety, ["cycle", "safety"], "final_score"),
        "landscape": A.scatter_bins(scores, ["cycle"], "qed_score", "final_score", 0.05, 5.0),
        "quality": A.quality_report(scores, ["final_score", "qed_score", "sa_score", "logp", "mw", "docking_score", "toxicity_label"], "cycle"),
        "gate": A.gate(metrics, [("safety_rate", ">=", 90.0)]),
    }
