import pytest
from pyspark.sql import functions as F

from assaylake.operators import joins as J
from assaylake.operators import mutation as M
from conftest import rows

REG = "molecule_hash string, global_id string, run_id string, created_at int"


def test_join_scores_keeps_one_or_all(spark):
    manifest = spark.createDataFrame([("C", 1), ("C", 2), ("N", 3), (None, 4)], "smiles string, id int")
    score = spark.createDataFrame([("C", 0.2), ("C", 0.1), (None, 9.0)], "smiles string, qed double")
    tox = spark.createDataFrame([("N", 1)], "smiles string, toxicity int")
    one = rows(J.join_scores(manifest, score, tox), "id", "qed", "toxicity")
    assert one == [(1, 0.1, None), (2, 0.1, None), (3, None, 1), (4, None, None)]
    assert J.join_scores(manifest.filter("id < 3"), score, dedup_right=False).count() == 4


def test_leaderboards_differ_on_validated_without_value(spark):
    reg = spark.createDataFrame([("v",), ("n",)], "molecule_hash string").withColumn("smiles", F.col("molecule_hash"))
    gold = spark.createDataFrame([("v", "v", None, "r")], "molecule_hash string, smiles string, delta_g double, run_id string")
    pred = spark.createDataFrame([("v", "v", -5.0, "p")], "molecule_hash string, smiles string, predicted_delta_g double, run_id string")
    scr = spark.createDataFrame([], "molecule_hash string, qed_score double, toxicity_label int")
    full = {r.molecule_hash: (r.best_estimate_score, r.confidence_tier) for r in J.comprehensive(reg, gold, pred, scr).collect()}
    assert full == {"v": (-5.0, "BRONZE_AI"), "n": (None, "BRONZE_AI")}
    assert J.comprehensive_union(gold, pred).count() == 0


def test_without_survives_null_keys(spark):
    a = spark.createDataFrame([("x",), ("y",)], "molecule_hash string")
    b = spark.createDataFrame([("x",), (None,)], "molecule_hash string")
    assert rows(J.without(a, b), "*") == [("y",)]


def test_batch_map_join_and_rejects(spark):
    res = spark.createDataFrame([(0, "mol_0", -1.0), (0, "mol_1", -2.0), (9, "mol_0", -3.0)], "batch_id bigint, mol_index string, delta_g double")
    m = spark.createDataFrame([(0, "mol_0", "a"), (0, "mol_1", "b")], "batch_id bigint, mol_index string, molecule_hash string")
    good, lost = J.attach_batch_hash(res, m)
    assert rows(good, "molecule_hash", "delta_g") == [("a", -1.0), ("b", -2.0)]
    assert rows(lost, "batch_id") == [(9,)]
    assert rows(J.attach_batch_hash(res, m, collapsed=True)[0], "molecule_hash") == [("b",), ("b",)]


def test_insert_new_is_idempotent_and_first_writer_wins(spark):
    target = spark.createDataFrame([("a", "g1", "run1", 1)], REG)
    source = spark.createDataFrame([("a", "g9", "run2", 2), ("b", "g3", "run2", 2), ("b", "g2", "run2", 2), (None, "g", "r", 1)], REG)
    once = M.insert_new(target, source)
    assert rows(once, "molecule_hash", "global_id", "run_id") == [("a", "g1", "run1"), ("b", "g2", "run2")]
    assert rows(M.insert_new(once, source), "*") == rows(once, "*")


def test_upsert_latest_takes_newer_and_is_idempotent(spark):
    kind = "molecule_hash string, delta_g double, run_id string, ts int"
    target = spark.createDataFrame([("a", -1.0, "r1", 5), ("b", -2.0, "r1", 5)], kind)
    source = spark.createDataFrame([("a", -9.0, "r0", 4), ("b", None, "r2", 5), ("c", -3.0, "r2", 6)], kind)
    once = M.upsert_latest(target, source)
    assert rows(once, "molecule_hash", "delta_g", "run_id") == [("a", -1.0, "r1"), ("b", None, "r2"), ("c", -3.0, "r2")]
    assert rows(M.upsert_latest(once, source), "*") == rows(once, "*")


def test_update_from_sets_null_and_refuses_two_matches(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "molecule_hash string, x double")
    source = spark.createDataFrame([("a", None)], "molecule_hash string, y double")
    assert rows(M.update_from(target, source, {"x": "y"}), "*") == [("a", None), ("b", 2.0)]
    twice = source.unionByName(source)
    with pytest.raises(Exception, match="several source rows match a"):
        M.update_from(target, twice, {"x": "y"}).collect()
    # two source rows nobody matches are no error
    other = spark.createDataFrame([("z", 1.0), ("z", 2.0)], "molecule_hash string, y double")
    assert M.update_from(target, other, {"x": "y"}).count() == 2


def test_unify_scores_precedence(spark):
    scr = spark.createDataFrame([("a", 7.0, "old"), ("b", 7.0, "old"), ("c", 7.0, "old"), ("d", 7.0, "old")],
                                "molecule_hash string, final_score double, score_method string")
    pred = spark.createDataFrame([("a", -1.0), ("b", -2.0), ("d", None)], "molecule_hash string, predicted_delta_g double")
    gold = spark.createDataFrame([("b", -9.0), ("a", float("nan")), ("c", None)], "molecule_hash string, delta_g double")
    once = M.unify_scores(scr, pred, gold)
    assert rows(once, "*") == [("a", -1.0, "xgboost"), ("b", -9.0, "gromacs"), ("c", 7.0, "old"), ("d", None, "xgboost")]
    assert rows(M.unify_scores(once, pred, gold), "*") == rows(once, "*")


def test_unify_scores_refuses_two_predictions(spark):
    scr = spark.createDataFrame([("a", 7.0, "old")], "molecule_hash string, final_score double, score_method string")
    pred = spark.createDataFrame([("a", -1.0), ("a", -9.0)], "molecule_hash string, predicted_delta_g double")
    gold = spark.createDataFrame([], "molecule_hash string, delta_g double")
    with pytest.raises(Exception, match="several predictions match a"):
        M.unify_scores(scr, pred, gold).collect()
