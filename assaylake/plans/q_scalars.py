"""Queries for scalar projections, filters and token features."""

from __future__ import annotations

from pyspark.sql import functions as F

from assaylake.functions import fingerprints as FP
from assaylake.functions import parsing as L
from assaylake.functions import predicates as P
from assaylake.functions import scalars as S
from assaylake.operators.aggregates import value_counts
from assaylake.plans.catalog import query
from assaylake.plans.views import cycles
from assaylake.sources import tables as T



@query("e1_molecule_hash", "SELECT doc_id, sha256(text) AS molecule_hash FROM documents")
def _(spark, sf):
    return T.table(spark, sf, "documents").select("doc_id", S.molecule_hash(F.col("text")).alias("molecule_hash"))


@query("e2_parse_global_id", """
    SELECT global_id, CAST(regexp_extract(global_id, 'shard(\\d+)', 1) AS INTEGER) AS shard_id, seq AS local_index
    FROM registry_raw""")
def _(spark, sf):
    return S.split_global_ids(T.registry_raw(spark, sf).select("global_id"))[0]


@query("e3_shard_of", """
    SELECT CAST(regexp_extract(sdf_path, 'shard_(\\d+)', 1) AS INTEGER) AS shard_id, count(*) AS n
    FROM registry_raw GROUP BY 1""")
def _(spark, sf):
    return value_counts(T.registry_raw(spark, sf).select(S.shard_of(F.col("sdf_path")).alias("shard_id")), "shard_id")


@query("e4_to_number", """
    SELECT event_type, count(*) AS n, count(CASE WHEN event_id % 5 < 3 THEN 1 END) AS n_parsed,
           round(sum(CASE WHEN event_id % 5 < 3 THEN value END), 4) AS total
    FROM events GROUP BY 1""")
def _(spark, sf):
    e = T.table(spark, sf, "events")
    i = F.col("event_id") % 5
    value = F.col("value").cast("string")
    text = F.when(i == 0, value).when(i == 1, F.concat(F.lit(" "), value)).when(i == 2, F.concat(value, F.lit(" "))) \
        .when(i == 3, "NaN").otherwise(F.concat(F.lit("x"), value))
    number = S.to_number(text)
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.count(number).alias("n_parsed"),
                                       F.round(F.sum(number), 4).alias("total"))


_VERDICT_SQL = """
    CASE WHEN toxic = 1 AND quality = 1 THEN 'Answer: (B)' WHEN toxic = 1 THEN 'It is TOXIC'
         WHEN quality = 1 THEN 'Answer: (A), not (B)' ELSE 'A Non-toxic compound' END"""


@query("e5_parse_verdict", f"""
    SELECT doc_id, CASE WHEN t LIKE '%(A)%' THEN 0 WHEN t LIKE '%(B)%' THEN 1 WHEN lower(t) LIKE '%non-toxic%' THEN 0
                        WHEN lower(t) LIKE '%toxic%' THEN 1 END AS toxicity
    FROM (SELECT doc_id, {_VERDICT_SQL} AS t FROM labels)""")
def _(spark, sf):
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    text = F.when(toxic & good, "Answer: (B)").when(toxic, "It is TOXIC").when(good, "Answer: (A), not (B)") \
        .otherwise("A Non-toxic compound")
    return T.table(spark, sf, "labels").select("doc_id", S.parse_verdict(text).alias("toxicity"))


@query("e6_safety_class", """
    SELECT molecule_hash, CASE toxicity_label WHEN 0 THEN 'Safe' WHEN 1 THEN 'Toxic' ELSE 'Unknown' END AS safety
    FROM screening""")
def _(spark, sf):
    return T.screening(spark, sf).select("molecule_hash", S.safety_class(F.col("toxicity_label")).alias("safety"))


_PROMPT_SQL = " || ".join(
    "text" if i % 2 else "'" + part.replace("'", "''") + "'" for i, part in enumerate(
        sum([[p, None] for p in S.TOXICITY_PROMPT.split("{smiles}")], [])[:-1]))


@query("e7_build_prompt", f"""
    SELECT conv_id, turn, md5(p) AS prompt_md5, length(p) AS prompt_chars
    FROM (SELECT conv_id, turn, {_PROMPT_SQL} AS p FROM conversations)""")
def _(spark, sf):
    prompt = S.build_prompt(F.col("text"))
    return T.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(prompt).alias("prompt_md5"), F.length(prompt).cast("bigint").alias("prompt_chars"))


@query("e8_affinity_bin", """
    SELECT molecule_hash, CASE WHEN docking_score < -40 THEN 'strong' WHEN docking_score > -30 THEN 'weak'
                               WHEN docking_score IS NOT NULL THEN 'medium' END AS affinity_bin FROM screening""")
def _(spark, sf):
    return T.screening(spark, sf).select("molecule_hash", S.affinity_bin(F.col("docking_score")).alias("affinity_bin"))


@query("e9_qed_bin", """
    SELECT molecule_hash, CASE WHEN qed_score > 0.6 THEN 'high' WHEN qed_score < 0.2 THEN 'low'
                               WHEN qed_score IS NOT NULL THEN 'medium' END AS qed_bin FROM screening""")
def _(spark, sf):
    return T.screening(spark, sf).select("molecule_hash", S.qed_bin(F.col("qed_score")).alias("qed_bin"))


def _three_tiers(spark, sf):
    keys = T.screening(spark, sf).select("molecule_hash", "docking_score")
    return keys.join(T.gold(spark, sf).select("molecule_hash", "delta_g"), "molecule_hash", "left").join(
        T.predictions(spark, sf).select("molecule_hash", "predicted_delta_g"), "molecule_hash", "left")


@query("e10_best_estimate", """
    SELECT s.molecule_hash, coalesce(g.delta_g, p.predicted_delta_g) AS two_way,
           coalesce(g.delta_g, s.docking_score, p.predicted_delta_g) AS three_way
    FROM screening s LEFT JOIN gold g USING (molecule_hash) LEFT JOIN predictions p USING (molecule_hash)""")
def _(spark, sf):
    g, s, p = F.col("delta_g"), F.col("docking_score"), F.col("predicted_delta_g")
    return _three_tiers(spark, sf).select(
        "molecule_hash", S.best_estimate(g, p).alias("two_way"), S.best_estimate(g, s, p).alias("three_way"))


@query("e11_confidence_tier", """
    SELECT CASE WHEN g.delta_g IS NOT NULL THEN 'GOLD_PHYSICS' ELSE 'BRONZE_AI' END AS confidence_tier, count(*) AS n
    FROM screening s LEFT JOIN gold g USING (molecule_hash) GROUP BY 1""")
def _(spark, sf):
    return value_counts(
        _three_tiers(spark, sf).select(S.confidence_tier(F.col("delta_g")).alias("confidence_tier")), "confidence_tier")


@query("e12_mpo_score", """
    SELECT molecule_hash, round(0.0 - 0.7 * docking_score + 0.3 * qed_score, 6) AS mpo,
           round(0.5 * qed_score - 0.2 * sa_score, 6) AS custom
    FROM screening""")
def _(spark, sf):
    custom = S.mpo_score([(F.col("qed_score"), 0.5, True), (F.col("sa_score"), 0.2, False)])
    return T.screening(spark, sf).select(
        "molecule_hash", F.round(S.default_mpo(F.col("docking_score"), F.col("qed_score")), 6).alias("mpo"),
        F.round(custom, 6).alias("custom"))


@query("e13_extract_energy", """
    SELECT status, delta_g, count(*) AS n FROM (
        SELECT CASE l_returnflag WHEN 'A' THEN 0.0 - l_quantity - 0.5
                    WHEN 'N' THEN CASE WHEN l_linestatus = 'O' THEN 0.0 - l_quantity - 0.25 ELSE 0.0 - l_quantity - 0.75 END
               END AS delta_g,
               CASE WHEN l_returnflag = 'R' THEN 'Failed_Analysis' ELSE 'Success' END AS status
        FROM lineitem) GROUP BY ALL""")
def _(spark, sf):
    q = F.concat(F.lit("-"), F.col("l_quantity").cast("bigint").cast("string"))
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    summary = F.when(flag == "A", F.concat(F.lit("Results\nDelta G binding = "), q, F.lit(".50 +/- 3.25\nend"))) \
        .when(flag == "N", "Delta G binding = 0.00 +/- 0.00")
    info = F.when(state == "O", F.concat(F.lit("GENERAL TOTAL -1.00\nPB TOTAL -2.00\nGENERAL x TOTAL "), q, F.lit(".25\n")))
    log = F.when(state == "F", F.concat(
        F.lit("ΔTOTAL   -1.00   3.25\nAttempting to sniff ΔTOTAL -9.00\nΔTOTAL    "), q, F.lit(".75   3.25\ndone")))
    none = F.lit(None).cast("string")
    lost = flag == "R"
    energy = L.extract_energy(summary, F.when(~lost, info).otherwise(none), F.when(~lost, log).otherwise("no result"))
    return T.table(spark, sf, "lineitem").select(energy.alias("e")).select("e.*").groupBy("status", "delta_g").agg(
        F.count("*").alias("n"))


@query("e14_extract_score", """
    SELECT status, docking_score, count(*) AS n FROM (
        SELECT CASE WHEN event_type <> 'error' THEN round(0.0 - value, 2) END AS docking_score,
               CASE WHEN event_type = 'error' THEN 'Gnina_Failed' ELSE 'Success' END AS status
        FROM events) GROUP BY ALL""")
def _(spark, sf):
    value = F.concat(F.lit("-"), F.col("value").cast("decimal(18,2)").cast("string"))
    log = F.when(F.col("event_type") == "error", "Error: no pose").otherwise(F.concat(
        F.lit("mode | CNN pose score\n  1   0.5   0.1   99.0\nrerun: CNN pose score | affinity\n   1  0.91  0.2   "), value, F.lit("  x\n")))
    return T.table(spark, sf, "events").select(L.extract_score(log).alias("e")).select(
        "e.status", F.round("e.docking_score", 2).alias("docking_score")).groupBy("status", "docking_score").agg(
        F.count("*").alias("n"))


@query("e15_status_class", """
    SELECT stage, count(*) AS n FROM (
        SELECT CASE event_type WHEN 'click' THEN 'success' WHEN 'error' THEN 'docking' WHEN 'view' THEN 'input'
                               WHEN 'signup' THEN 'simulation' ELSE 'unknown' END AS stage FROM events) GROUP BY 1""")
def _(spark, sf):
    t = F.col("event_type")
    state = F.when(t == "click", "Success").when(t == "error", "Gnina_Failed").when(t == "view", "PDBQT_Empty") \
        .when(t == "signup", "Failed_Equil").otherwise(t)
    return value_counts(T.table(spark, sf, "events").select(L.status_class(state).alias("stage")), "stage")


_UNIFORM = "(CAST(('0x' || substr(md5('7' || molecule_hash), {a}, 8)) AS BIGINT) + 0.5) / 4294967296.0"


@query("e16_synthetic_label", f"""
    SELECT molecule_hash, round(docking_score + sqrt(-2.0 * ln({_UNIFORM.format(a=1)})) * cos(2.0 * pi() * {_UNIFORM.format(a=9)}) * 1.5
                                + (1.0 - qed_score) * 2.0, 6) AS label
    FROM screening""")
def _(spark, sf):
    label = S.synthetic_label(F.col("docking_score"), F.col("qed_score"), F.col("molecule_hash"), 1.5, "7", 2.0)
    return T.screening(spark, sf).select("molecule_hash", F.round(label, 6).alias("label"))


_COUNT = "len(regexp_extract_all(smiles, '{p}'))"
_N = {n: _COUNT.format(p=p) for n, p in {
    "cl": "Cl", "br": "Br", "c0": "Cl|C|c", "n": "N|n", "o": "O|o", "s": "S|s", "p": "P|p", "f": "F", "i": "I", "b0": "Br|B|b"}.items()}


@query("e18_token_profile", f"""
    SELECT molecule_hash, CAST(c AS INTEGER) AS n_c, CAST(n AS INTEGER) AS n_n, CAST(o AS INTEGER) AS n_o,
           CAST(s AS INTEGER) AS n_s, CAST(b AS INTEGER) AS n_b, CAST(rings AS INTEGER) AS n_ring_marks,
           CAST(branches AS INTEGER) AS n_branches, CAST(c + n + o + s + p + f + i + b + cl + br AS INTEGER) AS n_heavy,
           round(CAST(c AS DOUBLE) * 12.011 + n * 14.007 + o * 15.999 + s * 32.06 + p * 30.974 + f * 18.998 + cl * 35.45 + br * 79.904
                 + i * 126.904 + b * 10.81, 3) AS mass
    FROM (SELECT molecule_hash, {_N['c0']} - {_N['cl']} AS c, {_N['n']} AS n, {_N['o']} AS o, {_N['s']} AS s, {_N['p']} AS p,
                 {_N['f']} AS f, {_N['i']} AS i, {_N['b0']} - {_N['br']} AS b, {_N['cl']} AS cl, {_N['br']} AS br,
                 {_COUNT.format(p='%[0-9][0-9]|[0-9]')} AS rings, {_COUNT.format(p='[(]')} AS branches
          FROM registry)""")
def _(spark, sf):
    t = T.registry(spark, sf).select("molecule_hash", FP.token_profile(F.col("smiles")).alias("t"))
    return t.select("molecule_hash", "t.n_c", "t.n_n", "t.n_o", "t.n_s", "t.n_b", "t.n_ring_marks", "t.n_branches",
                    "t.n_heavy", F.round("t.mass", 3).alias("mass"))


_BITS_SQL = """list_sort(list_distinct(list_transform(range(1, length({c}) - {k} + 2),
    lambda i: CAST(CAST(('0x' || substr(md5(substr({c}, i, {k})), 1, 8)) AS BIGINT) % {n} AS INTEGER))))"""


@query("e19_fingerprint", f"""
    SELECT page_id, len(fp) AS n_set, CAST(list_sum(fp) AS BIGINT) AS bit_sum, md5(array_to_string(fp, ',')) AS fp_md5
    FROM (SELECT page_id, {_BITS_SQL.format(c='url', k=3, n=2048)} AS fp FROM pages)""")
def _(spark, sf):
    p = T.table(spark, sf, "pages").select("page_id", FP.fingerprint(F.col("url"), 2048, 3).alias("fp"))
    total = F.aggregate("fp", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return p.select("page_id", F.size("fp").cast("bigint").alias("n_set"), total.alias("bit_sum"),
                    F.md5(F.array_join(F.col("fp").cast("array<string>"), ",").cast("binary")).alias("fp_md5"))


@query("e20_tanimoto", """
    WITH v AS (SELECT vec_id, list_filter(list_transform(range(len(embedding)), lambda i: CASE WHEN embedding[i + 1] > 0 THEN i END),
                                          lambda x: x IS NOT NULL) AS fp FROM embeddings)
    SELECT a.vec_id, round(CAST(len(list_intersect(a.fp, b.fp)) AS DOUBLE)
                           / (len(a.fp) + len(b.fp) - len(list_intersect(a.fp, b.fp))), 9) AS sim
    FROM v a JOIN v b ON b.vec_id = a.vec_id + 1""")
def _(spark, sf):
    v = T.table(spark, sf, "embeddings").select("vec_id", FP.set_bits(F.col("embedding")).alias("fp"))
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("fp").alias("fp_next"))
    return v.join(nxt, "vec_id").select("vec_id", F.round(FP.tanimoto(F.col("fp"), F.col("fp_next")), 9).alias("sim"))


@query("e21_split_uri", """
    SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)/(.*)$', 1) AS bucket, regexp_extract(url, '^[a-z]+://([^/]+)/(.*)$', 2) AS key
    FROM pages WHERE regexp_matches(url, '^[a-z]+://([^/]+)/(.*)$')""")
def _(spark, sf):
    p = T.table(spark, sf, "pages").select("page_id", S.split_uri(F.col("url")).alias("u"))
    return p.filter(F.col("u").isNotNull()).select("page_id", "u.bucket", "u.key")


@query("e22_stamp", """
    SELECT molecule_hash, 'prod_v1' AS run_id, '2024-01-01 00:00:00' AS created_at, 'proxy_3' AS model_version FROM predictions""")
def _(spark, sf):
    p = T.predictions(spark, sf).select("molecule_hash")
    return S.stamp(p, "prod_v1", "2024-01-01 00:00:00", "proxy_3").withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


@query("e23_label_column", "SELECT molecule_hash, delta_g AS label FROM gold WHERE delta_g IS NOT NULL")
def _(spark, sf):
    g = T.gold(spark, sf).select("molecule_hash", "delta_g")
    return P.drop_missing(S.with_label(g), ["label"]).select("molecule_hash", "label")


@query("f1_valid_pool", "SELECT molecule_hash, docking_score FROM valid_rows")
def _(spark, sf):
    return T.screening(spark, sf).filter(P.valid_pool()).select("molecule_hash", "docking_score")


@query("f2_elite_filter", "SELECT molecule_hash FROM screening WHERE sa_score < 4 AND qed_score > 0.5")
def _(spark, sf):
    return T.screening(spark, sf).filter(P.elite_filter()).select("molecule_hash")


@query("f3_scored_in_run", "SELECT molecule_hash, final_score FROM cycles WHERE cycle = 'cycle2' AND final_score IS NOT NULL")
def _(spark, sf):
    return cycles(spark, sf).filter(P.scored_in_run("cycle2", "cycle")).select("molecule_hash", "final_score")


@query("f4_labelled", "SELECT molecule_hash, delta_g FROM gold WHERE delta_g IS NOT NULL AND NOT isnan(delta_g)")
def _(spark, sf):
    return T.gold(spark, sf).filter(P.labelled()).select("molecule_hash", "delta_g")


@query("f5_drop_missing", "SELECT molecule_hash FROM screening WHERE docking_score IS NOT NULL AND toxicity_label IS NOT NULL")
def _(spark, sf):
    return P.drop_missing(T.screening(spark, sf), ["docking_score", "toxicity_label"]).select("molecule_hash")


@query("f6_drug_like", """
    SELECT molecule_hash, CAST(mw < 500 AND logp BETWEEN 2 AND 5 AND sa_score < 4 AS INTEGER) AS drug_like FROM screening""")
def _(spark, sf):
    return T.screening(spark, sf).select("molecule_hash", P.drug_like().cast("int").alias("drug_like"))


@query("f7_hit", """
    SELECT molecule_hash, CAST(coalesce(docking_score < -8, false) AS INTEGER) AS hit_8,
           CAST(coalesce(docking_score < -20, false) AS INTEGER) AS hit_20,
           CAST(coalesce(docking_score < -30, false) AS INTEGER) AS hit_30,
           CAST(coalesce(docking_score < -40, false) AS INTEGER) AS hit_40
    FROM screening""")
def _(spark, sf):
    return T.screening(spark, sf).select(
        "molecule_hash", *[P.hit("docking_score", -float(t)).cast("int").alias(f"hit_{t}") for t in (8, 20, 30, 40)])
