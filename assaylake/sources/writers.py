"""Table layouts, exports, tier routing and label batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.functions import scalars as S
from assaylake.operators.indexing import with_row_index
from assaylake.operators.joins import without
from assaylake.sources.readers import conform

# Tiers and the separator between structures.
GOLD, SILVER, BRONZE = "GOLD", "SILVER", "BRONZE"
STRUCTURE_END = "$$$$"

_LAYOUT = {
    GOLD: (schemas.GOLD, {"affinity_score": "delta_g"}),
    SILVER: (schemas.SILVER, {"docking_score": "affinity"}),
    BRONZE: (schemas.BRONZE, {"final_score": "predicted_delta_g"}),
}


def route_by_tier(df: DataFrame, tier: str, run_id: str, model_version: str | None = None) -> DataFrame:
    """Rows of one tier in the layout of its table, stamped with run and model."""
    if tier not in _LAYOUT:
        raise ValueError(f"unknown tier {tier!r}")
    schema, renames = _LAYOUT[tier]
    if "molecule_hash" not in df.columns:
        df = df.withColumn("molecule_hash", S.molecule_hash(F.col("smiles")))
    return conform(S.stamp(df, run_id, None, model_version if tier == BRONZE else None), schema, renames)


def route_mixed(df: DataFrame, run_id: str, model_version: str, tier_col: str = "tier") -> dict[str, DataFrame]:
    """One frame per tier from rows that carry their tier; an unknown tier fails the job."""
    checked = df.filter(
        F.when(F.col(tier_col).isin(GOLD, SILVER, BRONZE), True)
        .otherwise(F.raise_error(F.concat(F.lit("unknown tier "), F.coalesce(F.col(tier_col), F.lit("null")))).cast("boolean")))
    return {t: route_by_tier(checked.filter(F.col(tier_col) == t).drop(tier_col), t, run_id, model_version)
            for t in (GOLD, SILVER, BRONZE)}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet, partitioned by low-cardinality columns and range-clustered within each.

    Range clustering keeps min/max per row group tight for look-ups by hash, and unlike hashing by
    the partition column it spreads one large run over many tasks.
    """
    keys = [F.col(c) for c in (*partition_by, *cluster_by)]
    if cluster_by:
        df = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
        df = df.sortWithinPartitions(*keys)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str = "molecule_hash", buckets: int = 64, mode: str = "overwrite",
                   path: str | None = None) -> None:
    """Table bucketed and sorted by key, one file a bucket, so that joins of such tables need no shuffle.

    Managed, or at ``path`` if one is given.
    """
    writer = df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate and reload: a staging area always holds exactly the last load."""
    df.write.mode("overwrite").parquet(path)


def append_with_new_columns(df: DataFrame, path: str) -> DataFrame:
    """Append rows that may carry more columns than the table; older rows read null there."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", "true").parquet(path)


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of CSV parts with headers; the parts are written in parallel and not merged."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def export_manifest(manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Manifest CSV in (shard, index) order across its parts."""
    keys = ["shard_id", "local_index"]
    export_csv(manifest.repartitionByRange(*keys).sortWithinPartitions(*keys), path, mode)


def label_batches(candidates: DataFrame, order: Sequence[Column], size: int = 1) -> DataFrame:
    """Batch map (batch_id, mol_index, molecule_hash) of the ordered candidates."""
    at = F.col("_at")
    return with_row_index(candidates, order, index="_at").select(
        F.floor(at / F.lit(size)).cast("bigint").alias("batch_id"),
        F.concat(F.lit("mol_"), F.pmod(at, F.lit(size)).cast("string")).alias("mol_index"),
        "molecule_hash",
    )


def batch_structures(batch_map: DataFrame, structures: DataFrame) -> DataFrame:
    """(batch_id, n_structures, structure_text): the structures of each batch in map order.

    A molecule without a structure is left out of the text but stays in the map. A batch holds at
    most ``size`` molecules, so the list per batch is bounded.
    """
    place = F.regexp_extract("mol_index", r"(\d+)", 1).cast("bigint")
    found = batch_map.join(structures.select("molecule_hash", "structure"), "molecule_hash", "left")
    rows = F.sort_array(F.collect_list(F.when(F.col("structure").isNotNull(), F.struct(place.alias("p"), F.col("structure").alias("s")))))
    body = F.array_join(F.transform(rows, lambda r: F.concat(r["s"], F.lit(f"\n{STRUCTURE_END}\n"))), "")
    return found.groupBy("batch_id").agg(F.count("structure").alias("n_structures"), body.alias("structure_text"))


def training_structures(elite: DataFrame, structures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(elite rows with their structure, elite hashes without one)."""
    keys = elite.select("molecule_hash").distinct()
    return (structures.join(keys, "molecule_hash", "left_semi"),
            without(keys, structures))
