"""Structured Streaming: score files arriving from many tasks, retries, routing and progress."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assaylake.functions import scalars as S
from assaylake.operators.aggregates import best_result_key, first_row
from assaylake.operators.joins import without
from assaylake.session import scratch_path
from assaylake.sources.writers import route_mixed


def stream_scores(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  max_files: int | None = None) -> DataFrame:
    """Files as they arrive; ``max_files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def stream_dedup(events: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Drops resent rows; a key is remembered for ``delay``, which bounds the state."""
    return events.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_progress(events: DataFrame, event_time: str, status: str, width: str, slide: str | None = None,
                    delay: str = "1 hour") -> DataFrame:
    """Rows per state and time window; windows close when the watermark passes their end."""
    window = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    return events.withWatermark(event_time, delay).groupBy(window.alias("w"), status).agg(
        F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), status, "n")


def stream_best_so_far(results: DataFrame, key: str, value: str, status: str, tie: Sequence[str]) -> DataFrame:
    """Running best attempt per key; state is one row per key. Use update mode."""
    rest = [c for c in results.columns if c != key]
    best = F.min_by(F.struct(*rest), best_result_key(F.col(value), status, tie)).alias("_row")
    return results.groupBy(key).agg(best).select(key, "_row.*")


# the state lies on disk; all the stores of an executor share so many MB
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Settings for a stream that starts inside; a restart goes on with the store its checkpoint names."""
    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_to_end(df: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None,
               each_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Process everything that is there and stop; a restart with the same checkpoint goes on."""
    where = checkpoint or scratch_path(df.sparkSession, "stream-state")
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", where).trigger(availableNow=True)
    with _state_on_disk(df.sparkSession):
        if each_batch is None:
            query = writer.format("parquet").option("path", path).start()
        else:
            query = writer.foreachBatch(each_batch).start()
    query.awaitTermination()
    return query


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch to its own folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_no", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            f"{path}/b={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Newest row per key of an update-mode stream written with ``append_batches``."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/b=*").drop("b")
    return first_row(rows, key, [-F.col("batch_no")]).drop("batch_no")


def upsert_registry_batches(path: str, key: str = "molecule_hash", order: Sequence[str] = ("seq",)) -> Callable[[DataFrame, int], None]:
    """Idempotent registry insert per micro-batch.

    Every batch adds only keys no other batch folder holds, into a folder of its own. A replayed
    batch leaves its own folder out of the look-up and overwrites it, so it gives the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = first_row(batch.filter(F.col(key).isNotNull()), key, list(order))
        if batch_id > 0:
            known = spark.read.option("basePath", path).parquet(f"{path}/b=*").filter(F.col("b") < batch_id)
            fresh = without(fresh, known, key)
        fresh.write.mode("overwrite").parquet(f"{path}/b={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path}/b=*").drop("b")


def route_batches(path: str, run_id: str, model_version: str) -> Callable[[DataFrame, int], None]:
    """Writes every tier of a micro-batch to its table; the batch is read once and kept for the three writes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for tier, rows in route_mixed(batch, run_id, model_version).items():
                rows.write.mode("overwrite").parquet(f"{path}/{tier.lower()}/b={batch_id}")
        finally:
            batch.unpersist()

    return write


def hash_scores(scores: DataFrame, c: str = "smiles") -> DataFrame:
    return scores.withColumn("molecule_hash", S.molecule_hash(F.col(c)))
