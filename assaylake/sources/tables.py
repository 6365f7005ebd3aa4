"""Domain tables derived from the given benchmark tables.

``documents`` plays the generated molecules, ``lineitem`` the retried label runs, ``part`` the
proxy's predictions and ``labels`` says which molecules have been validated. All rules are column
expressions, so the derived tables grow with their inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions import scalars as S
from assaylake.operators.aggregates import best_result, first_row
from assaylake.session import scratch_path
from assaylake.sources.writers import write_bucketed

BASE = "store://generated"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_WRITTEN: dict[tuple, str] = {}


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, molecule_hash) of every document: the identity dictionary.

    Texts are read and hashed once for a state of the documents (files, sizes and times), whatever number of derived
    tables needs the hashes. It is bucketed and sorted by the hash, as many buckets as shuffle partitions, so grouping
    and joining by the hash shuffles nothing of it.
    """
    docs = table(spark, sf_dir, "documents")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir.rstrip('/')}/documents.parquet")
    state = tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime")).first())
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = (spark.sparkContext.applicationId, sf_dir, buckets, state)
    if key not in _WRITTEN:
        path = scratch_path(spark, "identity")
        name = "identity_" + path.rpartition("-")[2]
        write_bucketed(docs.select("doc_id", "source", S.molecule_hash(F.col("text")).alias("molecule_hash")), name, buckets=buckets, path=path)
        _WRITTEN[key] = name
    return spark.table(_WRITTEN[key])


def _registered(molecule_hash, *more) -> list:
    shard = F.regexp_extract("source", r"(\d+)", 1)
    doc = F.col("doc_id").cast("string")
    return [
        molecule_hash.alias("molecule_hash"), *more,
        F.concat(F.lit("gen_shard"), shard, F.lit("_idx"), doc).alias("global_id"),
        F.concat(F.lit(f"{BASE}/shard_"), shard, F.lit("/SDF/"), doc, F.lit(".sdf")).alias("sdf_path"),
        F.when(F.col("doc_id") % 10 == 0, "cycle2").otherwise("cycle1").alias("run_id"),
        F.col("doc_id").alias("seq"),
    ]


def registry_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per generated string; texts that occur twice are registered twice."""
    return table(spark, sf_dir, "documents").select(*_registered(S.molecule_hash(F.col("text")), F.col("text").alias("smiles")))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_row(registry_raw(spark, sf_dir), "molecule_hash", ["seq"])


def registry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry without the strings themselves, for operators that only need ids."""
    rows = identities(spark, sf_dir).select(*_registered(F.col("molecule_hash"))).drop("sdf_path")
    return first_row(rows, "molecule_hash", ["seq"])


def screening_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = identities(spark, sf_dir)
    lab = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    i = F.col("doc_id")
    num = lambda c: c.cast("double")
    return d.join(lab, "doc_id", "left").select(
        "molecule_hash",
        i.alias("seq"),
        F.when(i % 13 != 0, F.lit(0.0) - num((i * 37) % 700) / 10.0).alias("docking_score"),
        (num((i * 17) % 101) / 100.0).alias("qed_score"),
        (F.lit(1.0) + num((i * 29) % 91) / 10.0).alias("sa_score"),
        (num((i * 31) % 90) / 10.0 - 2.0).alias("logp"),
        num(F.lit(150) + (i * 53) % 500).alias("mw"),
        F.col("toxic").cast("int").alias("toxicity_label"),
    )


def screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_row(screening_raw(spark, sf_dir), "molecule_hash", ["seq"])


def oracle_by_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label attempts by document number: many rows per key, a third of them failures."""
    n_docs = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") % n_docs).alias("doc_id"),
        (F.lit(0.0) - F.col("l_quantity")).alias("delta_g"),
        F.when(F.col("l_returnflag") == "R", "Failed_Analysis").otherwise("Success").alias("status"),
        F.col("l_suppkey").alias("batch_id"),
        F.col("l_linenumber").alias("attempt"),
        F.datediff(F.col("l_shipdate"), F.lit("1990-01-01").cast("date")).alias("day"),
        F.col("l_partkey").alias("task"),
    )


def doc_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identities(spark, sf_dir).select("doc_id", "molecule_hash")


TIE = ("day", "attempt", "batch_id", "task", "delta_g")


def oracle_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oracle_by_doc(spark, sf_dir).join(doc_hashes(spark, sf_dir), "doc_id").drop("doc_id")


def oracle_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best attempt per molecule. Attempts are reduced per document before the join to the hashes:
    the best of the bests is the best, and a document with a third of all attempts joins as one row."""
    per_doc = best_result(oracle_by_doc(spark, sf_dir), "doc_id", tie=TIE)
    hashed = per_doc.join(doc_hashes(spark, sf_dir), "doc_id").drop("doc_id")
    return best_result(hashed, "molecule_hash", tie=TIE)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated molecules: best attempts of the documents that carry a label row."""
    lab = table(spark, sf_dir, "labels").select("doc_id")
    chosen = doc_hashes(spark, sf_dir).join(lab, "doc_id", "left_semi").select("molecule_hash").distinct()
    best = oracle_best(spark, sf_dir).join(chosen, "molecule_hash", "left_semi")
    return best.select(
        "molecule_hash",
        F.when(F.col("status") == "Success", F.col("delta_g")).alias("delta_g"),
        F.lit("mmpbsa").alias("method"),
        "status",
        F.concat(F.lit("run"), (F.col("batch_id") % 3).cast("string")).alias("run_id"),
        "day",
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per molecule, from the part with the document's number."""
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc_id"), (F.lit(0.0) - F.col("p_retailprice") / 25.0).alias("predicted_delta_g"),
        F.col("p_brand").alias("model_version"), F.col("p_type").alias("run_id"))
    rows = p.join(doc_hashes(spark, sf_dir), "doc_id").withColumnRenamed("doc_id", "seq")
    return first_row(rows, "molecule_hash", ["seq"])
