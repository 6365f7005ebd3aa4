"""Table changes as DataFrame in, DataFrame out; write the result as a new snapshot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.operators.aggregates import first_row
from assaylake.operators.joins import without

# Methods named in score_method.
PROXY_METHOD, GOLD_METHOD = "xgboost", "gromacs"


def insert_new(target: DataFrame, source: DataFrame, key: str = "molecule_hash",
               order: Sequence[str] = ("created_at", "global_id")) -> DataFrame:
    """Insert keys the target lacks; rows already there stay as they are.

    The source is reduced to one row per key first, so a batch that holds a new key twice inserts
    it once, and running the same batch again changes nothing.
    """
    fresh = first_row(source.filter(F.col(key).isNotNull()), key, order)
    return target.unionByName(without(fresh, target, key))


def upsert_latest(target: DataFrame, source: DataFrame, ts: str = "ts", key: str = "molecule_hash",
                  tie: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest; at equal time the source replaces the target."""
    both = target.withColumn("_src", F.lit(0)).unionByName(source.withColumn("_src", F.lit(1)))
    rest = [c for c in target.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(ts), F.col("_src"), *tie)).alias("_row")
    return both.groupBy(key).agg(newest).select(key, "_row.*").select(*target.columns)


def update_from(target: DataFrame, source: DataFrame, updates: Mapping[str, str], key: str = "molecule_hash") -> DataFrame:
    """Matched rows take the source's values, even null ones; unmatched rows stay.

    ``updates`` maps target column → source column. Two source rows for one target row are an
    error, raised when such a row is reached.
    """
    values = sorted(set(updates.values()))
    right = source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(v).alias(f"_v_{v}") for v in values])
    joined = target.join(right, key, "left")
    checked = F.when(
        F.col("_n") > 1,
        F.raise_error(F.concat(F.lit("several source rows match "), F.col(key).cast("string"))).cast("boolean"),
    ).otherwise(F.col("_n").isNotNull())
    out = joined.withColumn("_hit", checked)
    cols = [
        F.when(F.col("_hit"), F.col(f"_v_{updates[c]}")).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
        for c in target.columns
    ]
    return out.select(*cols)


def unify_scores(screening: DataFrame, predictions: DataFrame, gold: DataFrame, key: str = "molecule_hash") -> DataFrame:
    """Proxy score on every predicted row, then the measured one where a valid label exists.

    Predictions and labels are stacked and reduced per key in one shuffle, and the wide table is
    joined once. Two predictions for one row are an error, raised when the row is reached.
    """
    p = predictions.select(key, F.struct(F.col("predicted_delta_g").alias("v")).alias("p"))
    g = gold.filter(F.col("delta_g").isNotNull() & ~F.isnan("delta_g")).select(
        key, F.struct(F.col("delta_g").alias("v")).alias("g"))
    scores = p.unionByName(g, allowMissingColumns=True).groupBy(key).agg(
        F.min("p").alias("_p"), F.min("g").alias("_g"), F.count("p").alias("_n"))
    out = screening.join(scores, key, "left")
    predicted = F.when(
        F.col("_n") > 1,
        F.raise_error(F.concat(F.lit("several predictions match "), F.col(key).cast("string"))).cast("boolean"),
    ).otherwise(F.col("_p").isNotNull())
    score = F.when(F.col("_g").isNotNull(), F.col("_g.v")).when(F.col("_p").isNotNull(), F.col("_p.v"))
    method = F.when(F.col("_g").isNotNull(), GOLD_METHOD).when(F.col("_p").isNotNull(), PROXY_METHOD)
    untouched = ~predicted & F.col("_g").isNull()
    return out.withColumn("final_score", F.when(untouched, F.col("final_score")).otherwise(score)).withColumn(
        "score_method", F.when(untouched, F.col("score_method")).otherwise(method)).select(*screening.columns)
