"""Score joins, leaderboards and pools.

Right sides are reduced to one row per key first, so a join is always N:1 and no key multiplies.
No broadcast hints: Spark broadcasts a side only when its measured size is under the session's
threshold, and AQE splits a partition that a hot key on the left makes too large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions import scalars as S
from assaylake.operators.aggregates import first_row


def join_scores(manifest: DataFrame, *scores: DataFrame, key: str = "smiles", dedup_right: bool = True) -> DataFrame:
    """Manifest left-joined to every score family; a missing score is null.

    By default the families are stacked and reduced to one row per key in one shuffle, so there is a
    single join, whose hot left partitions AQE can split (in a chain of joins on one key it cannot).
    When a family holds a key twice the row with the smallest values stays. ``dedup_right=False``
    keeps all matches and so multiplies rows.
    """
    if not dedup_right:
        out = manifest
        for family in scores:
            out = out.join(family, key, "left")
        return out
    if not scores:
        return manifest
    parts, picks = [], []
    for i, family in enumerate(scores):
        cols = [c for c in family.columns if c != key]
        row = F.struct(*cols)
        parts.append(family.filter(F.col(key).isNotNull()).select(key, row.alias(f"_f{i}")))
        picks.append((f"_f{i}", cols))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    merged = stacked.groupBy(key).agg(*[F.min(f).alias(f) for f, _ in picks])
    right = merged.select(key, *[F.col(f"{f}.{c}").alias(c) for f, cols in picks for c in cols])
    return manifest.join(right, key, "left")


def candidates_with_ids(candidates: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct (hash, global_id) of the candidates."""
    chosen = candidates.select("molecule_hash").distinct()
    return registry.select("molecule_hash", "global_id").join(chosen, "molecule_hash", "left_semi").distinct()


def attach_batch_hash(results: DataFrame, batch_map: DataFrame, collapsed: bool = False,
                      seq: str = "mol_index") -> tuple[DataFrame, DataFrame]:
    """(results with their molecule_hash, results no map row matches).

    Joins on batch and position in the batch. ``collapsed`` keeps one hash per batch, the last map
    row winning, as needed for results that do not say which molecule they belong to.
    """
    if collapsed:
        keys, right = ["batch_id"], batch_map.groupBy("batch_id").agg(F.max_by("molecule_hash", seq).alias("molecule_hash"))
    else:
        keys = ["batch_id", "mol_index"]
        right = first_row(batch_map.select(*keys, "molecule_hash"), keys, ["molecule_hash"])
    matched = results.join(right, keys)
    return matched, results.join(right.select(*keys), keys, "left_anti")


def leaderboard(registry: DataFrame, affinity: DataFrame, screening: DataFrame) -> DataFrame:
    """Labelled molecules with their docking and QED scores; order it only to show it."""
    return (
        registry.select("molecule_hash", "smiles")
        .join(affinity.select("molecule_hash", "delta_g", "method"), "molecule_hash")
        .join(screening.select("molecule_hash", "docking_score", "qed_score"), "molecule_hash", "left")
        .select("smiles", "delta_g", "method", "docking_score", "qed_score", "molecule_hash")
    )


def comprehensive(registry: DataFrame, gold: DataFrame, predictions: DataFrame, screening: DataFrame) -> DataFrame:
    """Every registered molecule with its best estimate and where that comes from."""
    return (
        registry.select("molecule_hash", "smiles")
        .join(gold.select("molecule_hash", "delta_g"), "molecule_hash", "left")
        .join(predictions.select("molecule_hash", "predicted_delta_g"), "molecule_hash", "left")
        .join(screening.select("molecule_hash", "qed_score", "toxicity_label"), "molecule_hash", "left")
        .select(
            "smiles",
            "molecule_hash",
            S.best_estimate(F.col("delta_g"), F.col("predicted_delta_g")).alias("best_estimate_score"),
            S.confidence_tier(F.col("delta_g")).alias("confidence_tier"),
            "qed_score",
            "toxicity_label",
        )
    )


def comprehensive_union(gold: DataFrame, predictions: DataFrame) -> DataFrame:
    """Labels, and predictions only for molecules that were never validated.

    A molecule validated without a value appears in neither leg; in ``comprehensive`` it falls back
    to its prediction.
    """
    top = gold.filter(F.col("delta_g").isNotNull()).select(
        "molecule_hash", "smiles", F.col("delta_g").alias("score"), F.lit("GOLD").alias("source"), "run_id")
    rest = predictions.join(gold.select("molecule_hash").filter(F.col("molecule_hash").isNotNull()),
                            "molecule_hash", "left_anti")
    return top.unionByName(rest.select(
        "molecule_hash", "smiles", F.col("predicted_delta_g").alias("score"), F.lit("BRONZE").alias("source"), "run_id"))


def without(df: DataFrame, other: DataFrame, key: str | Sequence[str] = "molecule_hash") -> DataFrame:
    """Rows whose key is not in ``other`` (null keys in ``other`` do not empty the result)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(other.select(*keys).dropna().distinct(), keys, "left_anti")


def unlabeled_pool(pool: DataFrame, selected: DataFrame) -> DataFrame:
    return without(pool, selected)


def orphans(facts: DataFrame, registry: DataFrame) -> DataFrame:
    return without(facts, registry)


def pred_vs_truth(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    good = truth.filter(F.col("delta_g").isNotNull() & ~F.isnan("delta_g"))
    return predictions.select("molecule_hash", "predicted_delta_g").join(
        good.select("molecule_hash", "delta_g"), "molecule_hash")


def training_set(gold: DataFrame, registry: DataFrame) -> DataFrame:
    """(molecule_hash, smiles, label) of every labelled molecule."""
    labels = gold.filter(F.col("delta_g").isNotNull() & ~F.isnan("delta_g"))
    return registry.select("molecule_hash", "smiles").join(
        labels.select("molecule_hash", F.col("delta_g").alias("label")), "molecule_hash")


def lineage(molecules: DataFrame, registry: DataFrame, screening: DataFrame, gold: DataFrame, predictions: DataFrame,
            elite: DataFrame) -> DataFrame:
    """How each of the given molecules went through the loop, with run and model at every station."""
    keys = molecules.select("molecule_hash").distinct()
    return (
        keys.join(registry.select("molecule_hash", F.col("run_id").alias("generated_in")), "molecule_hash", "left")
        .join(screening.select("molecule_hash", "docking_score"), "molecule_hash", "left")
        .join(gold.select("molecule_hash", "delta_g", F.col("run_id").alias("labelled_in")), "molecule_hash", "left")
        .join(predictions.select("molecule_hash", "predicted_delta_g", "model_version"), "molecule_hash", "left")
        .join(elite.select("molecule_hash", "selection_strategy"), "molecule_hash", "left")
    )
