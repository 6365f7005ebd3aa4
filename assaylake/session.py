"""Session helper and the shared scratch folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
PACKED = "zstd"  # of written intermediates
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "assaylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; a running session is reused."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # chains of joins on one key still get their hot partitions split
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``; a local one only for local-mode tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="assaylake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; every call gives another one."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run within go with the end of each: left to the driver's garbage collection
    those of all steps would lie on disk at once."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs one stage, and pins results of operators that
    must not be computed twice (range partitioning samples its input). Columnar, so later passes
    read only the columns they use, and packed closer than by default, as all steps of a query lie there together.
    The shuffle files of the write go with its end: nothing reads them after it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_dropped(spark):
        df.write.option("compression", PACKED).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A side meant to be narrow and short: written once, counted, broadcast only if it is short.

    Beyond the limit it is an ordinary join side.
    """
    written = materialize(df, "side")
    return F.broadcast(written) if written.count() <= max_rows else written


def spread(scan: DataFrame) -> DataFrame:
    """A table scan ahead of costly per-row work, on all cores.

    Only a scan with fewer splits than cores (a small file) is redistributed; a large table is left
    as it is read.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
