"""Queries that write the derived tables in the formats generators and scorers use, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.functions import scalars as S
from assaylake.plans.catalog import query
from assaylake.plans.views import selected
from assaylake.session import scratch_path, small_side
from assaylake.sources import readers as R
from assaylake.sources import tables as T
from assaylake.sources import writers as W

LINES_PER_SHARD = 1000
ROWS_PER_FILE = 100_000
COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")  # tasks move their files; the driver would move them one by one


def _writers(spark) -> int:
    """Tasks that write many small files: a small table would be one task, which makes all the files one after the other."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_shards(spark, sf, stray: str = "") -> str:
    """One text folder per 1,000 documents, as generator tasks leave them; returns the glob.

    With ``stray`` every fourth folder has this in place of ``shard_`` in its name.
    """
    path = scratch_path(spark, "shards")
    d = T.table(spark, sf, "documents")
    line = F.regexp_replace("text", r"[\r\n]+", " ")
    shard = F.floor(F.col("doc_id") / LINES_PER_SHARD).cast("int")
    name = F.when(shard % 4 == 0, stray or "shard_").otherwise("shard_")
    rows = d.select("doc_id", line.alias("value"), F.concat(name, shard.cast("string")).alias("task"))
    rows.repartition("task").sortWithinPartitions("task", "doc_id").select("value", "task").write.partitionBy("task").text(path)
    return f"{path}/task=*/*"


_SHARDS = """
    WITH l AS (SELECT CAST(doc_id // 1000 AS INTEGER) AS shard_id, doc_id % 1000 AS local_index,
                      trim(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), ' \t') AS line FROM documents)"""


@query("s1_read_shard_lines", _SHARDS + "SELECT shard_id, local_index, sha256(line) AS molecule_hash FROM l WHERE line <> ''")
def _(spark, sf):
    lines, _ = R.read_shard_lines(spark, write_shards(spark, sf))
    return lines.select("shard_id", "local_index", S.molecule_hash(F.col("smiles")).alias("molecule_hash"))


@query("w1_line_positions", _SHARDS + "SELECT local_index AS line_index, count(*) AS n FROM l WHERE line <> '' GROUP BY 1")
def _(spark, sf):
    return R.file_lines(spark, write_shards(spark, sf)).groupBy("line_index").agg(F.count("*").alias("n"))


@query("p4_line_table", """
    SELECT page_id, CAST(i - 1 AS INTEGER) AS line_no, length(line) AS chars FROM (
        SELECT page_id, unnest(string_split(html, chr(10))) AS line, generate_subscripts(string_split(html, chr(10)), 1) AS i FROM pages)""")
def _(spark, sf):
    p = T.table(spark, sf, "pages")
    return p.select("page_id", F.posexplode(F.split("html", "\n", -1)).alias("line_no", "line")).select(
        "page_id", "line_no", F.length("line").cast("bigint").alias("chars"))


@query("s2_build_manifest", _SHARDS + """
    SELECT 'gen_shard' || shard_id || '_idx' || local_index AS global_id, length(line) AS chars, shard_id, local_index,
           'store://generated/shard_' || shard_id || '/SDF/' || local_index || '.sdf' AS sdf_path FROM l WHERE line <> ''""")
def _(spark, sf):
    lines, _ = R.read_shard_lines(spark, write_shards(spark, sf))
    m = R.build_manifest(lines, T.BASE)
    return m.select("global_id", F.length("smiles").cast("bigint").alias("chars"), "shard_id", "local_index", "sdf_path")


def write_score_files(spark, sf) -> list[str]:
    """Property and docking files, one header each, keyed by hash."""
    s = T.screening_raw(spark, sf)
    out = []
    for name, cols in (("props", ["qed_score", "sa_score", "logp", "mw"]), ("dock", ["docking_score"])):
        path = scratch_path(spark, name)
        renamed = [F.col(c).alias("qed" if c == "qed_score" else c) for c in cols]
        W.export_csv(s.select(F.col("molecule_hash").alias("smiles"), *renamed), path)
        out.append(f"{path}/part-*")
    return out


_SCORES = schemas.PROPERTY_SCORES.add("docking_score", schemas.DBL)


@query("s3_read_score_shards", """
    SELECT molecule_hash AS smiles, qed_score AS qed, sa_score, logp, mw, CAST(NULL AS DOUBLE) AS docking_score FROM screening_raw
    UNION ALL SELECT molecule_hash, NULL, NULL, NULL, NULL, docking_score FROM screening_raw""")
def _(spark, sf):
    return R.read_score_shards(spark, write_score_files(spark, sf), _SCORES)


@query("s3_skipped_files", """
    WITH d AS (SELECT CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) AS shard, count(*) AS n FROM documents GROUP BY 1)
    SELECT shard, CASE WHEN shard % 5 = 0 THEN 0 ELSE n END AS n_read, CASE WHEN shard % 5 = 0 THEN 1 ELSE 0 END AS n_files_skipped FROM d""")
def _(spark, sf):
    """A file a shard; every fifth one is named as compressed and is not."""
    path = scratch_path(spark, "shards")
    d = T.table(spark, sf, "documents").select("doc_id", F.regexp_extract("source", r"(\d+)", 1).alias("shard"))
    d.repartition("shard").write.partitionBy("shard").option("header", "true").csv(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for file in fs.globStatus(hadoop.Path(f"{path}/shard=*/*.csv")):
        if int(file.getPath().getParent().getName().split("=")[1]) % 5 == 0:
            fs.rename(file.getPath(), file.getPath().suffix(".gz"))
    of = lambda c: F.regexp_extract(c, r"shard=(\d+)/", 1).cast("int").alias("shard")
    doc = R.read_score_shards(spark, f"{path}/shard=*/*", schemas.T.StructType.fromDDL("doc_id bigint"), path_col="path")
    read = doc.filter("doc_id IS NOT NULL").select(of("path"), F.lit(1).alias("line"), F.lit(0).alias("skipped"))
    skipped = R.skipped_files(spark, f"{path}/shard=*/*").select(of("path"), F.lit(0).alias("line"), F.lit(1).alias("skipped"))
    return read.unionByName(skipped).groupBy("shard").agg(F.sum("line").alias("n_read"), F.sum("skipped").cast("int").alias("n_files_skipped"))


@query("s4_read_molecules", "SELECT p_name AS smiles, count(*) AS n FROM part GROUP BY 1")
def _(spark, sf):
    path = scratch_path(spark, "molecules")
    W.export_csv(T.table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("smiles")), path)
    return R.read_molecules(spark, f"{path}/part-*").groupBy("smiles").agg(F.count("*").alias("n"))


@query("s5_read_keyed_results", """
    SELECT l_suppkey AS batch_id, 'mol_' || l_linenumber AS mol_index,
           CASE WHEN l_returnflag <> 'R' THEN 0.0 - l_quantity END AS delta_g,
           CASE WHEN l_returnflag = 'R' THEN 'Failed_Analysis' WHEN l_linestatus = 'F' THEN 'Success' ELSE 'Unknown' END AS status
    FROM lineitem""")
def _(spark, sf):
    path = scratch_path(spark, "results")
    lost = F.col("l_returnflag") == "R"
    rows = T.table(spark, sf, "lineitem").select(
        F.concat(F.lit("mol_"), F.col("l_linenumber").cast("string")).alias("SMILES"),
        F.when(lost, "NaN").otherwise((F.lit(0.0) - F.col("l_quantity")).cast("string")).alias("DeltaG"),
        F.when(lost, "Failed_Analysis").when(F.col("l_linestatus") == "F", "Success").alias("Status"),
        F.concat(F.lit("batch_"), F.col("l_suppkey").cast("string"), F.lit("_results")).alias("task"))
    # one file per batch, more for a batch with very many rows; the folder is read as a whole: a glob is listed in the driver
    n_files = small_side(rows.groupBy("task").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).alias("n_files")))
    part = F.pmod(F.xxhash64("SMILES", "DeltaG"), F.col("n_files"))
    sized = rows.join(n_files.withColumnRenamed("task", "t"), F.col("task").eqNullSafe(F.col("t"))).withColumn("part", part)
    sized.repartition(_writers(spark), "task", "part").drop("t", "n_files", "part").write.partitionBy("task") \
        .option(*COMMIT_BY_TASK).option("header", "true").csv(path)
    return R.read_keyed_results(spark, path)


@query("s6_read_result_json", """
    SELECT sha256(s_name) AS molecule_hash, s_name AS smiles, 0.0 - s_acctbal AS delta_g, CAST(s_nationkey AS DOUBLE) / 10 AS uncertainty,
           'mol_' || s_suppkey || '/run/' AS folder FROM supplier""")
def _(spark, sf):
    path = scratch_path(spark, "validated")
    T.table(spark, sf, "supplier").select(
        F.col("s_name").alias("smiles"), (F.lit(0.0) - F.col("s_acctbal")).alias("delta_g"),
        (F.col("s_nationkey").cast("double") / 10.0).alias("uncertainty"),
        F.concat(F.lit("mol_"), F.col("s_suppkey").cast("string")).alias("task")).repartition(_writers(spark), "task").write.partitionBy("task").option(*COMMIT_BY_TASK).json(path)
    rows = R.read_result_json(spark, path)
    rows = rows.withColumn("folder", F.regexp_extract("trajectory_uri", r"(mol_[^/]+/run/)$", 1)).drop("trajectory_uri")
    return rows.filter("folder <> ''")  # a supplier without a key has no folder of its own


_TIERED = """
    SELECT p_partkey, sha256(p_name) AS molecule_hash, p_retailprice,
           CASE p_type WHEN 'PROMO' THEN 'GOLD' WHEN 'LARGE' THEN 'SILVER' ELSE 'BRONZE' END AS tier FROM part"""


@query("s7_route_by_tier", f"""
    SELECT tier, 'run-7' AS run_id, CASE WHEN tier = 'BRONZE' THEN 'proxy_4' END AS model_version, count(*) AS n,
           round(sum(p_retailprice), 2) AS total, count(DISTINCT molecule_hash) AS n_hashes FROM ({_TIERED}) GROUP BY 1""")
def _(spark, sf):
    kind = F.col("p_type")
    tier = F.when(kind == "PROMO", "GOLD").when(kind == "LARGE", "SILVER").otherwise("BRONZE")
    rows = T.table(spark, sf, "part").select(
        F.col("p_name").alias("smiles"), tier.alias("tier"), F.col("p_retailprice").alias("delta_g"),
        F.col("p_retailprice").alias("affinity"), F.col("p_retailprice").alias("predicted_delta_g"))
    value = {"GOLD": "delta_g", "SILVER": "affinity", "BRONZE": "predicted_delta_g"}
    out = None
    for name, part in W.route_mixed(rows, "run-7", "proxy_4").items():
        version = F.col("model_version") if name == "BRONZE" else F.lit(None).cast("string").alias("model_version")
        one = part.groupBy("run_id", version).agg(F.count("*").alias("n"), F.round(F.sum(value[name]), 2).alias("total"),
                                                  F.count_distinct("molecule_hash").alias("n_hashes")).withColumn("tier", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("s8_write_table", "SELECT molecule_hash, global_id, run_id, seq FROM registry")
def _(spark, sf):
    path = scratch_path(spark, "registry")
    W.write_table(T.registry_keys(spark, sf), path, ["run_id"], ["molecule_hash"])
    return spark.read.parquet(path).select("molecule_hash", "global_id", "run_id", "seq")


@query("s8_write_bucketed", """
    SELECT r.molecule_hash, r.run_id, s.docking_score, s.toxicity_label FROM registry r JOIN screening s ON s.molecule_hash = r.molecule_hash""")
def _(spark, sf):
    return bucketed_join(spark, sf)


def bucketed_join(spark, sf):
    """Two tables written in the same buckets and joined bucket by bucket."""
    names = []
    for df in (T.registry_keys(spark, sf).select("molecule_hash", "run_id"), T.screening(spark, sf).select("molecule_hash", "docking_score", "toxicity_label")):
        path = scratch_path(spark, "bucketed")
        names.append("bucketed_" + path.rpartition("-")[2])
        W.write_bucketed(df, names[-1], buckets=16, path=path)
    return spark.table(names[0]).join(spark.table(names[1]).hint("merge"), "molecule_hash")


@query("s10_export_csv", "SELECT doc_id, sha256(text) AS molecule_hash, length(text) AS chars FROM documents")
def _(spark, sf):
    path = scratch_path(spark, "export")
    W.export_csv(T.table(spark, sf, "documents").select("doc_id", "text"), path)
    back = spark.read.schema("doc_id bigint, text string").option("header", "true").option("multiLine", "true") \
        .option("escape", '"').csv(path)
    return back.select("doc_id", S.molecule_hash(F.col("text")).alias("molecule_hash"), F.length("text").cast("bigint").alias("chars"))


def _listing(spark, sf):
    o = T.table(spark, sf, "orders")
    shard = (F.col("o_custkey") % 700).cast("int")
    run = F.concat(F.lit("run_config_"), F.date_format("o_orderdate", "yyyyMMdd"))
    return o.select(shard.alias("shard_id"), run.alias("run_config"), (F.col("o_orderstatus") == "O").alias("has_sdf"),
                    F.concat(F.lit("store://generated/shard_"), shard.cast("string"), F.lit("/"), run, F.lit("/")).alias("path"))


_LIST_SQL = """
    WITH l AS (SELECT CAST(o_custkey % 700 AS INTEGER) AS shard_id, 'run_config_' || strftime(o_orderdate, '%Y%m%d') AS run_config,
                      o_orderstatus = 'O' AS has_sdf FROM orders),
         best AS (SELECT shard_id, max(run_config) AS run_config FROM l WHERE has_sdf GROUP BY 1)"""


@query("s11_resolve_latest_path", _LIST_SQL + """
    SELECT shard_id, 'store://generated/shard_' || shard_id || '/' || run_config || '/SDF/' AS sdf_path FROM best""")
def _(spark, sf):
    listing = _listing(spark, sf)
    return R.resolve_latest_path(listing, listing)[0]


@query("w3_latest_per_shard", """
    WITH l AS (SELECT o_custkey AS shard_id, 'run_config_' || strftime(o_orderdate, '%Y%m%d') AS run_config FROM orders)
    SELECT shard_id, max(run_config) AS run_config FROM l GROUP BY 1""")
def _(spark, sf):
    o = T.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("shard_id"), F.concat(F.lit("run_config_"), F.date_format("o_orderdate", "yyyyMMdd")).alias("run_config"))
    return o.groupBy("shard_id").agg(F.max("run_config").alias("run_config"))


def _batches(spark, sf, size):
    ids = selected(spark, sf).select("molecule_hash")
    return W.label_batches(ids, [F.col("molecule_hash").asc()], size)


@query("s12_label_batch_map", """
    WITH o AS (SELECT molecule_hash, row_number() OVER (ORDER BY molecule_hash) - 1 AS i FROM selected)
    SELECT i // 8 AS batch_id, 'mol_' || (i % 8) AS mol_index, molecule_hash FROM o""")
def _(spark, sf):
    return _batches(spark, sf, 8)


@query("s12_label_batch_files", """
    WITH o AS (SELECT molecule_hash, row_number() OVER (ORDER BY molecule_hash) - 1 AS i FROM selected),
         t AS (SELECT i // 8 AS batch_id, i, CASE WHEN run_id = 'cycle1' THEN smiles END AS structure FROM o JOIN registry USING (molecule_hash))
    SELECT batch_id, count(structure) AS n_structures,
           md5(coalesce(string_agg(structure || chr(10) || '$$$$' || chr(10), '' ORDER BY i), '')) AS text_md5 FROM t GROUP BY 1""")
def _(spark, sf):
    structures = T.registry(spark, sf).filter("run_id = 'cycle1'").select("molecule_hash", F.col("smiles").alias("structure"))
    out = W.batch_structures(_batches(spark, sf, 8), structures)
    return out.select("batch_id", "n_structures", F.md5("structure_text").alias("text_md5"))


@query("s13_training_structures", """
    SELECT e.molecule_hash, r.run_id, length(r.smiles) AS chars FROM elite e JOIN registry r USING (molecule_hash)""")
def _(spark, sf):
    from assaylake.functions import predicates as P

    elite = T.screening(spark, sf).filter(P.elite_filter()).select("molecule_hash")
    found, _ = W.training_structures(elite, T.registry(spark, sf))
    path = scratch_path(spark, "training")
    W.write_table(found, path, ["run_id"], ["molecule_hash"])
    return spark.read.parquet(path).select("molecule_hash", "run_id", F.length("smiles").cast("bigint").alias("chars"))
