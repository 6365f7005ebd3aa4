"""Views over the derived tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.operators import joins as J
from assaylake.operators.mutation import unify_scores
from assaylake.operators.selection import select_for_labelling, top_k
from assaylake.sources import tables as T


def unified(spark: SparkSession, sf: str) -> DataFrame:
    """Screening with the best known score: a measured value, else a prediction."""
    s = T.screening(spark, sf).withColumn("final_score", F.lit(None).cast("double")).withColumn(
        "score_method", F.lit(None).cast("string"))
    return unify_scores(s, T.predictions(spark, sf), T.gold(spark, sf))


def cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Unified scores with the cycle each molecule was generated in."""
    r = T.registry_keys(spark, sf).select("molecule_hash", F.col("run_id").alias("cycle"))
    return unified(spark, sf).join(r, "molecule_hash")


def best_scores(spark: SparkSession, sf: str, k: int) -> DataFrame:
    """Flagship: identity, registry de-duplication, best label attempt, precedence, top k."""
    reg = T.registry_keys(spark, sf).select("molecule_hash", "global_id", "run_id")
    best = top_k(unified(spark, sf).select("molecule_hash", "final_score", "score_method", "qed_score"), k, "final_score")
    return best.join(reg, "molecule_hash")


def comprehensive(spark: SparkSession, sf: str) -> DataFrame:
    return J.comprehensive(T.registry(spark, sf), T.gold(spark, sf), T.predictions(spark, sf), T.screening(spark, sf))


def selected(spark: SparkSession, sf: str) -> DataFrame:
    """The molecules chosen for labelling: 80 best docked and 20 random others of the valid pool."""
    return select_for_labelling(T.screening(spark, sf), 80, 20)
