import pandas as pd
import pytest
from pyspark.sql import functions as F

from assaylake.operators import proxy as X
from assaylake.operators.plugins import score_batches, with_properties
from assaylake.streaming import streams as S
from conftest import rows


def test_replayed_batch_gives_the_same_registry(spark, tmp_path):
    write = S.upsert_registry_batches(str(tmp_path / "reg"))
    b0 = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2)], "molecule_hash string, seq int")
    b1 = spark.createDataFrame([("b", 9), ("c", 3), (None, 4)], "molecule_hash string, seq int")
    for batch, no in ((b0, 0), (b1, 1), (b1, 1), (b0, 0)):
        write(batch, no)
    assert rows(S.read_batches(spark, str(tmp_path / "reg")), "*") == [("a", 0), ("b", 2), ("c", 3)]


def test_stream_restart_processes_only_new_files(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    spark.range(5).write.parquet(src)
    stream = lambda: S.stream_scores(spark, src, spark.read.parquet(src).schema, max_files=1)
    S.run_to_end(stream(), out, checkpoint=state)
    spark.range(5, 9).write.mode("append").parquet(src)
    S.run_to_end(stream(), out, checkpoint=state)
    assert rows(spark.read.parquet(out), "id") == [(i,) for i in range(9)]


def test_best_so_far_over_many_batches_equals_batch_result(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    df = spark.range(300).select((F.col("id") % 11).alias("k"), (F.lit(0.0) - (F.col("id") * 37) % 50).alias("delta_g"),
                                 F.when(F.col("id") % 3 == 0, "Failed_Setup").otherwise("Success").alias("status"), F.col("id").alias("seq"))
    df.repartition(3).write.parquet(src)
    best = S.stream_best_so_far(S.stream_scores(spark, src, df.schema, max_files=1), "k", "delta_g", "status", ["seq"])
    S.run_to_end(best, out, "update", each_batch=S.append_batches(out))
    from assaylake.operators.aggregates import best_result
    assert rows(S.read_latest(spark, out, "k").select("k", "delta_g", "status", "seq"), "*") == rows(best_result(df, "k"), "*")


def test_failing_batch_keeps_its_rows(spark):
    df = spark.createDataFrame([(i, "bad" if i == 5 else "C") for i in range(10)], "i int, smiles string").coalesce(1)

    def scorer(batch: pd.DataFrame) -> pd.DataFrame:
        if (batch["smiles"] == "bad").any():
            raise RuntimeError
        return pd.DataFrame({"score": batch["i"] * 1.0, "label": batch["smiles"]})

    got = rows(score_batches(df, scorer, 4, "score double, label string", ["i"]), "i", "score", "status")
    assert len(got) == 10
    assert [g for g in got if g[2] != "Success"] == [(i, None, "Scorer_Failed") for i in (4, 5, 6, 7)]


def test_properties_drop_and_count_invalid_rows(spark):
    df = spark.createDataFrame([("CC",), ("",), (None,), ("boom",)], "smiles string")

    def fn(s):
        if s == "boom":
            raise ValueError
        return {"n": len(s), "u": s.lower()} if s else None

    good, counts = with_properties(df, fn, "n int, u string")
    assert rows(good, "*") == [("CC", 2, "cc")]
    assert tuple(counts.first()) == (1, 3)


@pytest.fixture(scope="module")
def learned(spark):
    """Texts whose label is decided by one token."""
    df = spark.range(400).select(F.sha2(F.col("id").cast("string"), 256).alias("molecule_hash"),
                                 F.concat(F.md5(F.col("id").cast("string")), F.when(F.col("id") % 2 == 0, "QQQ").otherwise("ZZZ")).alias("smiles"),
                                 F.when(F.col("id") % 2 == 0, -40.0).otherwise(-10.0).alias("label"))
    rows_, counts = X.featurize(df)
    return X.with_split(rows_).cache(), counts


def test_featurize_drops_short_texts(spark):
    _, counts = X.featurize(spark.createDataFrame([("CCC",), ("C",), (None,)], "smiles string"))
    assert tuple(counts.first()) == (1, 2)


def test_proxy_beats_the_mean_predictor(learned):
    data, _ = learned
    model = X.train_proxy(data.filter("split = 'train'"), trees=20, depth=2, rate=0.3)
    r = {m["split"]: m for m in X.evaluate_proxy(model, data).collect()}
    assert r["test"]["rmse"] < 5 and r["test"]["r2"] > 0.8
    top = X.feature_importance(model, data.sparkSession).collect()
    assert top and top[0].importance >= top[-1].importance


def test_ensemble_spread_is_finite(learned):
    data, _ = learned
    got = X.ensemble_uncertainty(data, data, members=2, trees=2, depth=2).agg(F.count("uncertainty"), F.min("uncertainty")).first()
    assert got[0] == 400 and got[1] >= 0


def test_state_of_a_stream_lies_on_disk(spark, tmp_path):
    path = str(tmp_path)
    spark.range(50).select((F.col("id") % 7).alias("k")).repartition(2).write.parquet(path + "/in")
    counts = S.stream_scores(spark, path + "/in", spark.read.parquet(path + "/in").schema, max_files=1).groupBy("k").count()
    before = {key: spark.conf.get(key, None) for key in S.STATE}
    query = S.run_to_end(counts, path + "/out", "update", each_batch=S.append_batches(path + "/out"))
    assert "rocksdbBytesCopied" in str(query.lastProgress["stateOperators"])
    assert {key: spark.conf.get(key, None) for key in S.STATE} == before
    assert sum(r["count"] for r in S.read_latest(spark, path + "/out", "k").collect()) == 50
