"""Surrogate model: hashed k-gram bits and boosted trees that are rows of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaylake.functions.fingerprints import fingerprint
from assaylake.operators import boosting
from assaylake.operators.aggregates import regression_metrics, validation_metrics
from assaylake.operators.boosting import Trees
from assaylake.operators.selection import hash_split

# Settings of the production model.
N_BITS, N_TREES, LEARNING_RATE, DEPTH, TRAIN_SHARE = 2048, 500, 0.05, 6, 0.8


def featurize(df: DataFrame, text: str = "smiles", n_bits: int = N_BITS, k: int = 3, features: str = "bits") -> tuple[DataFrame, DataFrame]:
    """(rows with their set of bits, one row with the numbers of valid and dropped rows).

    A row without a text, or with one too short for any k-gram, is invalid.
    """
    valid = F.coalesce(F.length(text) >= k, F.lit(False))
    counts = df.agg(F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_dropped"))
    return df.filter(valid).withColumn(features, fingerprint(F.col(text), n_bits, k)), counts


def train_proxy(train: DataFrame, label: str = "label", features: str = "bits", trees: int = N_TREES, rate: float = LEARNING_RATE,
                depth: int = DEPTH, n_bits: int = N_BITS, weight: str | None = None, valid: DataFrame | None = None, patience: int = 10) -> Trees:
    """Squared-error boosting; with ``valid`` rows it stops once ``patience`` trees have not helped them."""
    return boosting.grow(train, n_bits, trees, depth, rate, label, features, weight, valid=valid, patience=patience)


def evaluate_proxy(model: Trees, rows: DataFrame, label: str = "label", by: Sequence[str] = ("split",), n_bits: int = N_BITS) -> DataFrame:
    return regression_metrics(model.predict(rows, n_bits), "prediction", label, by)


def evaluate_against_labels(model: Trees, rows: DataFrame, label: str = "label", n_bits: int = N_BITS) -> DataFrame:
    """Correlation and RMSE against all labels, the training rows among them."""
    return validation_metrics(model.predict(rows.filter(F.col(label).isNotNull()), n_bits), "prediction", label)


def predict_pool(model: Trees, pool: DataFrame, model_version: str, run_id: str, n_bits: int = N_BITS) -> DataFrame:
    """Prediction rows in the layout of the prediction table."""
    return model.predict(pool, n_bits).select(
        "molecule_hash", "smiles", F.col("prediction").alias("predicted_delta_g"),
        F.lit(model_version).alias("model_version"), F.lit(run_id).alias("run_id"))


def feature_importance(model: Trees, spark) -> DataFrame:
    """All bits that the model uses, the most important first."""
    return boosting.importance(model.table(spark))


def with_split(df: DataFrame, fraction: float = TRAIN_SHARE, key: str = "molecule_hash") -> DataFrame:
    return hash_split(df, fraction, key, "proxy", ("train", "test"))


def bootstrap(df: DataFrame, member: int, key: str = "molecule_hash") -> DataFrame:
    """Bootstrap weights ``_w`` from a hash of the key: a Poisson(1) count of copies."""
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(f"boot{member}-"), F.col(key).cast("string"))), 1, 8), 16, 10)
         .cast("double") + 0.5) / F.lit(4294967296.0)
    # cumulative Poisson(1) probabilities
    cuts = [0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563]
    copies = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        copies = F.when(u < cuts[i], i).otherwise(copies)
    return df.withColumn("_w", copies.cast("bigint")).filter(F.col("_w") > 0)


def ensemble_uncertainty(train: DataFrame, pool: DataFrame, members: int = 4, trees: int = 10, depth: int = 3,
                         label: str = "label", rate: float = LEARNING_RATE, n_bits: int = N_BITS) -> DataFrame:
    """(molecule_hash, predicted_delta_g, uncertainty): mean and spread of models on bootstrap samples."""
    models = [train_proxy(bootstrap(train, m), label, trees=trees, rate=rate, depth=depth, n_bits=n_bits, weight="_w") for m in range(members)]
    return boosting.ensemble(models, pool, n_bits).select("molecule_hash", F.col("prediction").alias("predicted_delta_g"), "uncertainty")
