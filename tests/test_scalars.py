import math

from pyspark.sql import functions as F

from assaylake.functions import fingerprints as FP
from assaylake.functions import parsing as L
from assaylake.functions import predicates as P
from assaylake.functions import scalars as S


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, fn, values, kind="string"):
    df = column(spark, values, kind).select("i", fn(F.col("v")).alias("o"))
    return [r["o"] for r in df.orderBy("i").collect()]


def test_verdicts(spark):
    texts = ["(A)", "(B)", "(A) (B)", "Non-toxic", "TOXIC", "", "n/a", None]
    assert apply(spark, S.parse_verdict, texts) == [0, 1, 0, 0, 1, None, None, None]


def test_bins_have_closed_middle(spark):
    assert apply(spark, S.affinity_bin, [-40.0, -40.01, -30.0, -29.99, None], "double") == ["medium", "strong", "medium", "weak", None]
    assert apply(spark, S.qed_bin, [0.6, 0.61, 0.2, 0.19], "double") == ["medium", "high", "medium", "low"]


def test_numbers_from_text(spark):
    texts = ["1.5", " -2 ", "1e3", "nan", "NaN", "abc", "", "1d", None, "+.5"]
    assert apply(spark, S.to_number, texts) == [1.5, -2.0, 1000.0, None, None, None, None, None, None, 0.5]


def test_global_ids(spark):
    df = column(spark, ["gen_shard0_idx1", "gen_shard12_idx007", "bad", None]).withColumnRenamed("v", "global_id")
    good, bad = S.split_global_ids(df)
    assert [(r.shard_id, r.local_index) for r in good.orderBy("i").collect()] == [(0, 1), (12, 7)]
    assert bad.count() == 2


def test_hash_keeps_null(spark):
    assert apply(spark, S.molecule_hash, [None, "a"])[0] is None


def test_tier_of_unknown_is_bronze(spark):
    assert apply(spark, S.confidence_tier, [-1.0, None], "double") == ["GOLD_PHYSICS", "BRONZE_AI"]


def test_label_column_choice(spark):
    both = spark.createDataFrame([(1.0, 2.0)], "delta_g double, final_deltag double")
    assert S.with_label(both).first()["label"] == 2.0
    assert S.with_label(both.drop("final_deltag")).first()["label"] == 1.0
    assert S.with_label(both.withColumn("label", F.lit(3.0))).first()["label"] == 3.0


def test_synthetic_noise_is_stable_and_normal(spark):
    df = spark.range(4000).select(S.synthetic_label(F.lit(0.0), F.lit(1.0), F.col("id"), 1.0, "s", 2.0).alias("x"))
    first = df.agg(F.avg("x"), F.stddev("x")).first()
    assert abs(first[0]) < 0.06 and abs(first[1] - 1) < 0.05
    assert df.repartition(7).agg(F.sum("x")).first()[0] == df.agg(F.sum("x")).first()[0] or math.isclose(
        df.repartition(7).agg(F.sum("x")).first()[0], df.agg(F.sum("x")).first()[0], rel_tol=1e-9)


def test_similarity_penalty_sign(spark):
    df = spark.createDataFrame([(-10.0, 0.5)], "s double, m double")
    low = df.select(S.similarity_penalty(F.col("s"), F.col("m"), 2.0)).first()[0]
    high = df.select(S.similarity_penalty(F.col("s"), F.col("m"), 2.0, False)).first()[0]
    assert (low, high) == (-9.0, -11.0)


def test_energy_fallbacks(spark):
    cases = [
        ("Delta G binding = -30.50 +/- 3.25", None, None, -30.5, "Success"),
        ("Delta G binding = 0.00 +/- 0", "GENERAL TOTAL -1\nGENERAL a TOTAL -7.5", None, -7.5, "Success"),
        (None, "TOTAL -3", "ΔTOTAL  -1.00 2\nAttempting ΔTOTAL -9\nΔTOTAL  -29.50   3.25\n", -29.5, "Success"),
        (None, None, "nothing", None, "Failed_Analysis"),
        ("Delta G binding = nan", None, None, None, "Failed_Analysis"),
    ]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, s string, n string, l string")
    got = df.select("i", L.extract_energy(F.col("s"), F.col("n"), F.col("l")).alias("e")).orderBy("i").collect()
    assert [(r.e.delta_g, r.e.status) for r in got] == [c[3:] for c in cases]


def test_score_after_last_header(spark):
    log = "CNN pose score\n1 2 3 -4.0\nCNN pose score | x\n a b c -7.25 d\n"
    got = apply(spark, L.extract_score, [log, "no header", "CNN pose score\n1 2\n"])
    assert [(g.docking_score, g.status) for g in got] == [(-7.25, "Success"), (None, "Gnina_Failed"), (None, "Gnina_Failed")]


def test_grams_cover_whole_text(spark):
    text = "ab\ncdéfg" * 3
    got = apply(spark, lambda c: FP.grams(c, 4), [text, "abc", ""])
    assert got[0] == [text[i:i + 4] for i in range(len(text) - 3)]
    assert got[1] == [] and got[2] == []


def test_fingerprint_hashes_a_gram_of_a_block_once(spark, monkeypatch):
    import hashlib

    import pyarrow as pa

    texts = ["ab\ncdéfg" * 3, "x😀yz日本" * 2, "abc" * 30, "ab", "", None]
    bits = lambda t, n, k: None if t is None else sorted({int(hashlib.md5(t[i:i + k].encode()).hexdigest()[:8], 16) % n for i in range(len(t) - k + 1)})
    for n, k in ((1 << 31, 8), (2048, 3)):
        assert apply(spark, lambda c, n=n, k=k: FP.fingerprint(c, n, k), texts) == [bits(t, n, k) for t in texts]
    hashed = []
    monkeypatch.setattr(FP, "md5", lambda g, **kw: hashed.append(g) or hashlib.md5(g, **kw))
    many = [chr(97 + i % 26) * 4 + str(i) for i in range(500)]  # letters enough for grams to need more than one number
    assert FP.text_bits(pa.array(many * 20), 1 << 31, 3).to_pylist() == [bits(t, 1 << 31, 3) for t in many] * 20
    assert len(hashed) == len(set(hashed)) == len({t[i:i + 3] for t in many for i in range(len(t) - 2)})


def test_tanimoto_of_empty_sets(spark):
    df = spark.createDataFrame([([], []), ([1, 2, 3], [2, 3, 4])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(FP.tanimoto(F.col("a"), F.col("b"))).collect()] == [0.0, 0.5]


def test_token_profile(spark):
    t = apply(spark, FP.token_profile, ["CCl(Br)c1ccccc1"])[0]
    assert (t.n_c, t.n_cl, t.n_br, t.n_ring_marks, t.n_branches, t.n_heavy) == (7, 1, 1, 2, 1, 9)
    assert abs(t.mass - (7 * 12.011 + 35.45 + 79.904)) < 1e-9


def test_missing_score_is_no_hit_and_no_neighbour_is_novel(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(P.hit("x", -8.0)).first()[0] is False
    assert df.select(P.novel("x")).first()[0] is True


def test_prompt_fills_every_slot(spark):
    assert apply(spark, lambda c: S.build_prompt(c, "a {smiles} b {smiles}"), ["X%s"]) == ["a X%s b X%s"]


def test_grams_of_any_alphabet_are_hashed_by_blocks(monkeypatch):
    """No call a gram, and a gram met before is looked up: hashes stay those of md5."""
    import hashlib

    import pyarrow as pa

    texts = ["plain ascii text, twice: plain ascii text", "äöüßéèêñ and then ascii", "中文字符測試一二三四", "😀" * 9 + "mixed é中😀 end", "\0" * 9, "abcdefg"]
    want = [sorted({int(hashlib.md5(t[i:i + 8].encode()).hexdigest()[:8], 16) % (1 << 31) for i in range(len(t) - 7)}) for t in texts]
    monkeypatch.setattr(FP, "md5", None)
    for known in (20, 1):  # so few places that grams push each other out
        monkeypatch.setattr(FP, "_KNOWN_BITS", known)
        FP._known.clear()
        assert [FP.text_bits(pa.array(texts), 1 << 31, 8).to_pylist() for _ in range(2)] == [want] * 2
    FP._known.clear()
