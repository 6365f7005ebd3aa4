"""Streaming queries: each runs a stream over the given tables to its end and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.plans.catalog import query
from assaylake.session import scratch_path
from assaylake.sources import tables as T
from assaylake.streaming import streams as X


def stream_table(spark, sf, name):
    """A given table as a stream; the pattern also matches a folder of files."""
    schema = T.table(spark, sf, name).schema
    return X.stream_scores(spark, f"{sf.rstrip('/')}/{name}.parque*", schema)


def stream_copy(spark, df, files: int = 4):
    """``df`` as files that arrive one per micro-batch."""
    path = scratch_path(spark, "arrivals")
    df.repartition(files).write.parquet(path)
    return X.stream_scores(spark, path, df.schema, max_files=1)


def _events(spark, sf):
    return stream_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("x1_stream_scores", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    out = scratch_path(spark, "x1")
    X.run_to_end(stream_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), out)
    return spark.read.parquet(out)


@query("x2_stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def _(spark, sf):
    out = scratch_path(spark, "x2")
    resent = _events(spark, sf).withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    X.run_to_end(X.stream_dedup(resent, ["event_id"], "ts", "2 hours").select("event_id", "user_id", "event_type"), out)
    return spark.read.parquet(out)


@query("x3_stream_upsert_registry", "SELECT DISTINCT molecule_hash FROM registry_raw")
def _(spark, sf):
    out = scratch_path(spark, "x3")
    arrivals = stream_copy(spark, T.registry_raw(spark, sf).select("molecule_hash", "global_id", "run_id", "seq"))
    X.run_to_end(arrivals, out, each_batch=X.upsert_registry_batches(out))
    return X.read_batches(spark, out).select("molecule_hash")


@query("x4_stream_route_tiers", """
    SELECT CASE p_type WHEN 'PROMO' THEN 'gold' WHEN 'LARGE' THEN 'silver' ELSE 'bronze' END AS tier, count(*) AS n,
           round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1""")
def _(spark, sf):
    out = scratch_path(spark, "x4")
    kind = F.col("p_type")
    tier = F.when(kind == "PROMO", "GOLD").when(kind == "LARGE", "SILVER").otherwise("BRONZE")
    price = F.col("p_retailprice")
    rows = stream_table(spark, sf, "part").select(
        F.col("p_name").alias("smiles"), tier.alias("tier"), price.alias("delta_g"), price.alias("affinity"), price.alias("predicted_delta_g"))
    X.run_to_end(rows, out, each_batch=X.route_batches(out, "run-7", "proxy_4"))
    found = None
    for name, c in (("gold", "delta_g"), ("silver", "affinity"), ("bronze", "predicted_delta_g")):
        one = X.read_batches(spark, f"{out}/{name}").agg(F.count("*").alias("n"), F.round(F.sum(c), 2).alias("total")).withColumn("tier", F.lit(name))
        found = one if found is None else found.unionByName(one)
    return found


def _progress_sql(width: int, slide: int) -> str:
    steps = width // slide
    return f"""
    WITH e AS (SELECT event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s, (SELECT max(epoch(ts)) FROM events) - 3600 AS mark FROM events),
         w AS (SELECT event_type, mark, (s // {slide}) * {slide} - k * {slide} AS start FROM e, range({steps}) t(k))
    SELECT strftime(make_timestamp(start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
    FROM w WHERE start + {width} <= mark GROUP BY ALL"""


def _progress(spark, sf, width, slide=None):
    out = scratch_path(spark, "x5")
    X.run_to_end(X.stream_progress(_events(spark, sf), "ts", "event_type", width, slide, "1 hour"), out)
    return spark.read.parquet(out).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@query("x5_stream_progress", _progress_sql(21600, 21600))
def _(spark, sf):
    return _progress(spark, sf, "6 hours")


@query("x5_stream_progress_sliding", _progress_sql(43200, 21600))
def _(spark, sf):
    return _progress(spark, sf, "12 hours", "6 hours")


@query("x6_stream_best_so_far", """
    SELECT l_orderkey, l_returnflag AS flag, 0.0 - l_quantity AS delta_g, l_partkey FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey ORDER BY CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END,
                     CASE WHEN l_returnflag <> 'R' THEN 0.0 - l_quantity END, l_linenumber, l_partkey, l_suppkey, 0.0 - l_quantity) = 1""")
def _(spark, sf):
    out = scratch_path(spark, "x6")
    li = T.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_returnflag").alias("flag"), (F.lit(0.0) - F.col("l_quantity")).alias("delta_g"), "l_partkey",
        "l_linenumber", "l_suppkey", F.when(F.col("l_returnflag") == "R", "Failed_Analysis").otherwise("Success").alias("status"))
    best = X.stream_best_so_far(stream_copy(spark, li), "l_orderkey", "delta_g", "status", ["l_linenumber", "l_partkey", "l_suppkey", "delta_g"])
    X.run_to_end(best, out, "update", each_batch=X.append_batches(out))
    return X.read_latest(spark, out, "l_orderkey").select("l_orderkey", "flag", "delta_g", "l_partkey")
