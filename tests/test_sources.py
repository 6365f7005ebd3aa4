import os

import pytest
from pyspark.sql import functions as F

from assaylake import schemas
from assaylake.sources import readers as R
from assaylake.sources import writers as W
from conftest import rows


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_shard_lines_keep_gaps_and_drop_outer_blanks(spark, tmp_path):
    put(f"{tmp_path}/shard_3/SMILES.txt", "\n  \nC\n\n N \nO\n\n")
    put(f"{tmp_path}/shard_12/SMILES.txt", "CC")
    put(f"{tmp_path}/other/SMILES.txt", "X\nY\n")
    good, skipped = R.read_shard_lines(spark, f"{tmp_path}/*/SMILES.txt")
    assert rows(good, "shard_id", "local_index", "smiles") == [(12, 0, "CC"), (3, 0, "C"), (3, 2, "N"), (3, 3, "O")]
    assert tuple(skipped.first()) == (2, 1)


def test_line_numbers_across_many_splits(spark, tmp_path):
    lines = [("" if i % 11 == 5 else f"line-{i}-" + "x" * (i % 17)) for i in range(5000)]
    put(f"{tmp_path}/shard_1/SMILES.txt", "\n".join(lines))
    put(f"{tmp_path}/shard_2/SMILES.txt", "\n\n" + "\n".join(lines[:700]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        good, _ = R.read_shard_lines(spark, f"{tmp_path}/shard_*/SMILES.txt")
        got = {(r.shard_id, r.local_index): r.smiles for r in good.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = {(1, i): s for i, s in enumerate(lines) if s} | {(2, i): s for i, s in enumerate(lines[:700]) if s}
    assert got == want


def test_manifest_and_export_round_trip(spark, tmp_path):
    lines = spark.createDataFrame([(2, 0, "C,\"x\""), (10, 1, "N"), (2, 11, "O")], "shard_id int, local_index bigint, smiles string")
    m = R.build_manifest(lines, "store://base/")
    assert rows(m, "global_id", "sdf_path")[0] == ("gen_shard10_idx1", "store://base/shard_10/SDF/1.sdf")
    W.export_manifest(m, f"{tmp_path}/m")
    back = spark.read.schema(schemas.MANIFEST).option("header", "true").option("escape", '"').csv(f"{tmp_path}/m")
    assert rows(back.select(*m.columns), "*") == rows(m, "*")


def test_score_shards_by_name_with_mixed_headers(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "smiles,qed,sa_score\nC,0.5,NaN\nN,abc,2\n")
    put(f"{tmp_path}/b.csv", "sa_score,smiles,filename\n3,O,f\n")
    got = R.read_score_shards(spark, f"{tmp_path}/*.csv", schemas.PROPERTY_SCORES)
    assert rows(got, "smiles", "qed", "sa_score", "mw") == [("C", 0.5, None, None), ("N", None, 2.0, None), ("O", None, 3.0, None)]


def test_score_shards_quotes_blanks_and_unreadable_files(spark, tmp_path):
    put(f"{tmp_path}/a.csv", '\n  \n QED , smiles\n0.5,"C,""x"""\n\n0.25\n1,N,extra,more\n')
    put(f"{tmp_path}/b.csv", "smiles\nO\n")
    put(f"{tmp_path}/only_header.csv", "smiles,qed\n")
    put(f"{tmp_path}/empty.csv", "")
    put(f"{tmp_path}/bad.csv.gz", "smiles,qed\nP,1\n")
    got = R.read_score_shards(spark, f"{tmp_path}/*", schemas.PROPERTY_SCORES, path_col="path")
    assert rows(got, "smiles", "qed") == sorted([('C,"x"', 0.5), (None, 0.25), ("N", 1.0), ("O", None)], key=repr)
    assert {r.path.rpartition("/")[2] for r in got.collect()} == {"a.csv", "b.csv"}
    skipped = R.skipped_files(spark, [f"{tmp_path}/*", f"{tmp_path}/none/*"]).collect()
    assert [(r.path.rpartition("/")[2], r.length) for r in skipped] == [("bad.csv.gz", 15)]
    assert R.skipped_files(spark, f"{tmp_path}/none/*").count() == 0


def test_score_shards_of_one_family_are_checked(spark, tmp_path):
    put(f"{tmp_path}/a.csv", "smiles,toxicity\nC,1\n")
    put(f"{tmp_path}/b.csv", "toxicity,smiles\n0,N\n")
    with pytest.raises(Exception):
        R.read_score_shards(spark, f"{tmp_path}/*.csv", schemas.TOXICITY_SCORES, mixed_headers=False).collect()


def test_no_score_shards_give_an_empty_table(spark, tmp_path):
    got = R.read_score_shards(spark, f"{tmp_path}/none/*.csv", schemas.TOXICITY_SCORES)
    assert got.count() == 0 and got.columns == ["smiles", "toxicity"]


@pytest.mark.parametrize("text,want", [
    ("id,smiles\n1,C\n2,\n3,N\n", ["C", "N"]),       # column found
    ("C,x\n\nN\n", ["C", "N"]),                       # plain lines: first field
    ("idx;SMILES\n7,CC\nO\n", ["CC", "O"]),           # header-like line: second field
])
def test_read_molecules_forms(spark, tmp_path, text, want):
    put(f"{tmp_path}/in.csv", text)
    got = R.read_molecules(spark, f"{tmp_path}/in.csv")
    assert [r.smiles for r in got.orderBy("row_no").collect()] == want


def test_keyed_results(spark, tmp_path):
    put(f"{tmp_path}/batch_7_results.csv", "SMILES,DeltaG,Status\nmol_0,-3.5,Success\nmol_1,NaN,Failed_Setup\nmol_2,,\n")
    got = rows(R.read_keyed_results(spark, f"{tmp_path}/*_results.csv"), "batch_id", "mol_index", "delta_g", "status")
    assert got == [(7, "mol_0", -3.5, "Success"), (7, "mol_1", None, "Failed_Setup"), (7, "mol_2", None, "Unknown")]


def test_result_json_builds_run_folder(spark, tmp_path):
    put(f"{tmp_path}/loop/mol_4/analyze/output/results.json", '{\n "smiles": "C",\n "delta_g": -7.5, "uncertainty": 0.5\n}')
    r = R.read_result_json(spark, f"{tmp_path}/loop/mol_*/analyze/output/results.json").first()
    assert r.delta_g == -7.5 and r.trajectory_uri.endswith("/loop/mol_4/run/")


def test_latest_path_needs_structures(spark, tmp_path):
    for p in ("shard_1/run_config_20240101/SDF/0.sdf", "shard_1/run_config_20240301/log.txt", "shard_2/run_config_20240101/log.txt"):
        put(f"{tmp_path}/{p}", "x")
    listing = R.list_structures(spark, f"{tmp_path}/shard_*/run_config_*/SDF/*.sdf").unionByName(
        R.list_structures(spark, f"{tmp_path}/shard_*/run_config_*/*.txt"))
    found, lost = R.resolve_latest_path(listing, listing)
    assert [(r.shard_id, r.sdf_path.endswith("run_config_20240101/SDF/")) for r in found.collect()] == [(1, True)]
    assert rows(lost, "*") == [(2,)]


def test_label_batches_keep_missing_structures_in_map(spark):
    cands = spark.createDataFrame([(h,) for h in "abcde"], "molecule_hash string")
    m = W.label_batches(cands, [F.col("molecule_hash").asc()], 2)
    assert rows(m, "batch_id", "mol_index", "molecule_hash") == [
        (0, "mol_0", "a"), (0, "mol_1", "b"), (1, "mol_0", "c"), (1, "mol_1", "d"), (2, "mol_0", "e")]
    s = spark.createDataFrame([("a", "A"), ("b", "B"), ("d", "D")], "molecule_hash string, structure string")
    got = rows(W.batch_structures(m, s), "batch_id", "n_structures", "structure_text")
    assert got == [(0, 2, "A\n$$$$\nB\n$$$$\n"), (1, 1, "D\n$$$$\n"), (2, 0, "")]


def test_unknown_tier_fails(spark):
    df = spark.createDataFrame([("C", "TIN")], "smiles string, tier string")
    with pytest.raises(ValueError):
        W.route_by_tier(df, "TIN", "r")
    with pytest.raises(Exception, match="unknown tier TIN"):
        W.route_mixed(df, "r", "m")["GOLD"].collect()


def test_table_layout_prunes_partitions(spark, tmp_path):
    df = spark.range(100).select(F.col("id").cast("string").alias("molecule_hash"), F.concat(F.lit("r"), (F.col("id") % 3)).alias("run_id"))
    W.write_table(df, f"{tmp_path}/t", ["run_id"], ["molecule_hash"], files=2)
    back = spark.read.parquet(f"{tmp_path}/t").filter("run_id = 'r1'")
    assert back.count() == 33
    assert "PartitionFilters: [isnotnull(run_id" in back._jdf.queryExecution().toString()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    a = spark.range(200).select(F.col("id").cast("string").alias("molecule_hash"), F.col("id").alias("x"))
    spark.sql("DROP TABLE IF EXISTS bucket_a")
    spark.sql("DROP TABLE IF EXISTS bucket_b")
    W.write_bucketed(a, "bucket_a", buckets=4)
    W.write_bucketed(a, "bucket_b", buckets=4)
    joined = spark.table("bucket_a").hint("merge").join(spark.table("bucket_b"), "molecule_hash")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 200
    spark.sql("DROP TABLE bucket_a")
    spark.sql("DROP TABLE bucket_b")


def test_append_with_new_columns(spark, tmp_path):
    spark.createDataFrame([("a",)], "molecule_hash string").write.parquet(f"{tmp_path}/s")
    grown = W.append_with_new_columns(spark.createDataFrame([("b", 1.0)], "molecule_hash string, final_score double"), f"{tmp_path}/s")
    assert rows(grown, "molecule_hash", "final_score") == [("a", None), ("b", 1.0)]


def test_keyed_results_by_column_name(spark, tmp_path):
    (tmp_path / "batch_1_results.csv").write_text("Status,SMILES,DeltaG\nSuccess,mol_0,-5.5\n")
    (tmp_path / "batch_2_results.csv").write_text("SMILES,Status\nmol_1,Failed\n")
    got = rows(R.read_keyed_results(spark, f"{tmp_path}/*_results.csv"), "batch_id", "mol_index", "delta_g", "status")
    assert got == [(1, "mol_0", -5.5, "Success"), (2, "mol_1", None, "Failed")]


def test_molecules_of_a_csv_have_line_numbers(spark, tmp_path):
    (tmp_path / "m.csv").write_text('id,smiles\n1,"C,C"\n2,\n3,CO\n')
    assert rows(R.read_molecules(spark, f"{tmp_path}/m.csv"), "row_no", "smiles") == [(1, "C,C"), (3, "CO")]


def test_small_result_files_are_written_by_all_cores(spark, tmp_path):
    """A table of one split and a folder a row: the files come from many tasks, one file a batch."""
    import glob

    from assaylake.plans import catalog
    from assaylake.plans import q_sources as Q
    from assaylake.session import scratch_root

    catalog.load()
    sf = str(tmp_path / "t")
    spark.range(40).selectExpr("nullif(id, 39) AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity",
                               "'N' AS l_returnflag", "'F' AS l_linestatus").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(5)))).coalesce(1).write.parquet(f"{sf}/lineitem.parquet")
    spark.range(41).selectExpr("nullif(id, 40) AS s_suppkey", "concat('s', id) AS s_name", "CAST(id AS DOUBLE) AS s_acctbal", "id % 3 AS s_nationkey").coalesce(1).write.parquet(f"{sf}/supplier.parquet")
    old = set(glob.glob(f"{scratch_root(spark)}/*"))
    assert catalog.QUERIES["s5_read_keyed_results"](spark, sf).count() == 200
    assert catalog.QUERIES["s6_read_result_json"](spark, sf).select("folder").distinct().count() == 40
    for name, kind in (("results-", "csv"), ("validated-", "json")):
        (root,) = [d for d in set(glob.glob(f"{scratch_root(spark)}/*")) - old if d.rpartition("/")[2].startswith(name)]
        files = glob.glob(f"{root}/task=*/part-*.{kind}")
        assert len(files) == 40 + (kind == "json")
        assert len({f.rpartition("/part-")[2][:5] for f in files}) > 4
    assert Q.ROWS_PER_FILE > 5
