"""Periodic runs, spelling variants and URL reputation against brute force and hand-written cases."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from assaylake.llm import queries, twins
from assaylake.llm.periodic import collapse_runs
from assaylake.llm.spelling import near_words, spelling_variants
from assaylake.llm.url_reputation import LIMIT, Rule, host_reputation, judge_urls, registered_domain


def all_runs(x):
    """Every stretch, by every period, letter by letter."""
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and x[e] == x[e + q]:
                e += 1
            length = e - s + q
            part = x[s:s + length]
            if length >= max(12, 2 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((s, length, q))
            s = max(e, s + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(x, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(x) if i not in gone)


def periodic_texts():
    rng = random.Random(7)
    some = lambda n, k: [rng.choice("abcdef"[:k]) for _ in range(n)]
    out = [[], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 500, ["a", "b"] * 6, ["a", "b"] * 200 + ["a"], some(300, 2)]
    for _ in range(60):
        u = some(rng.randrange(1, 40), 2)
        out.append(some(5, 3) + u * rng.randrange(1, 6) + u[:rng.randrange(len(u))] + some(4, 3))
        v = ["a", "b"] * rng.randrange(4, 20) + ["a"]
        out.append(v + v + some(2, 3) + v)
        w = ["a"] * rng.randrange(3, 30) + ["b"]
        out.append((w + ["a"] * rng.randrange(3, 30) + ["b"]) * 3)
    return out


def test_runs_equal_brute_force(spark):
    texts = periodic_texts()
    rows = [(i, "\t\n ".join(x)) for i, x in enumerate(texts)] + [(None, None), (None, "  \n"), (3, "a " * 12), (3, "a " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("x")).withColumn("id", F.lit(1)).repartition(3)
    got = sorted((r["doc_id"], r["n_words"], tuple(tuple(x) for x in r["runs"]), r["text"]) for r in collapse_runs(docs).collect() if r["doc_id"] is not None)
    want = [(i, len(x), tuple(all_runs(x)), collapsed(x, all_runs(x))) for i, x in enumerate(texts)] + [(3, 12, ((0, 12, 1),), "a")] * 2
    assert got == sorted(want)
    nulls = collapse_runs(docs).filter("doc_id is null").collect()
    assert [(r["n_words"], r["runs"], r["text"]) for r in nulls] == [(0, [], "")] * 2
    assert collapse_runs(docs.limit(0)).count() == 0


def test_only_ascii_space_divides_words_and_case_counts(spark):
    text = " ".join(["É\u00a0x"] * 12) + "\u3000" + " " + "A a " * 3
    r = collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r["runs"]] == all_runs(text.split(" ")[:-1]) and r["n_words"] == 18


def test_long_periodic_text(spark):
    text = ("a " * 400_000) + ("b c " * 100_000)
    r = collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 400_000, 1), (400_000, 200_000, 2)] and r["text"] == "a b c"


def test_query_of_periodic_runs(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 60)))) for i in range(300)] + [(None, "a " * 30), (11, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for id_, text in rows:
        x = (text or "").split()
        h = zlib.crc32(str(id_).encode()) if id_ is not None else 1
        if h % 10 == 0 and x:
            n, g = len(x), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = x[:a] + [x[a + (i - a) % p] for i in range(a, n)]
        runs = all_runs(x)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((id_, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(x, runs))))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(want, key=key)


def edits(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("tile", [3, 4_096])
def test_near_words_equal_brute_force(spark, tile):
    rng = random.Random(1)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(6, 9))) for _ in range(700)}
    words |= {"".join(rng.sample("abcdefgh", 8)) for _ in range(200)} | {"x" * 5_000, "x" * 5_001, "x" * 4_999 + "y", "ÿ" * 6, "ÿ" * 5 + "÷"}
    words |= {"largeblock" + c + d for c in "abcdefghijk" for d in "abcdefghijk"}
    words = sorted(words)
    df = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    got = sorted(tuple(sorted((r["a"], r["b"]))) for r in near_words(df, tile).collect())
    want = sorted((a, b) for i, a in enumerate(words) for b in words[i + 1:] if edits(a, b))
    assert got == want and len(want) > 1_000


def test_forms_roots_and_ties(spark):
    counts = [("abcdef", 4_000), ("abcdeg", 700), ("abcdxg", 130), ("abcyxg", 26), ("abzyxg", 5), ("abcdeh", 600), ("lonely", 7), ("abcdefg", 599)]
    df = spark.createDataFrame(counts, "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["n_near"], r["form_n"]) for r in spelling_variants(df).collect()}
    assert got["abcdef"] == (None, "abcdef", 3, None) and got["abcdeg"] == ("abcdef", "abcdef", 4, 4_000)
    assert got["abcdxg"] == ("abcdeg", "abcdef", 2, 700) and got["abcyxg"] == ("abcdxg", "abcdef", 2, 130)
    assert got["abzyxg"][:2] == ("abcyxg", "abcdef") and got["lonely"] == (None, "lonely", 0, None)
    assert got["abcdefg"] == ("abcdef", "abcdef", 2, 4_000)
    assert spelling_variants(df.limit(0)).count() == 0
    tied = spark.createDataFrame([("zzzzza", 5), ("zzzzzc", 25), ("zzzzzb", 25)], "word string, n long")
    assert {r["word"]: r["form"] for r in spelling_variants(tied).collect()} == {"zzzzza": "zzzzzb", "zzzzzb": None, "zzzzzc": None}


def twin_rows(spark, tmp_path, name, tables):
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = queries.QUERIES[name](spark, str(tmp_path))
    cur = con.execute(queries.ORACLES[name])
    assert df.columns == [d[0] for d in cur.description]
    return sorted(map(tuple, df.collect()), key=str), sorted(cur.fetchall(), key=str)


def test_spelling_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(2)
    words = ["Wörter", "spelling", "SPELLING", "speling", "straße", "éèàçùœ", "Œuvres", "a" * 300, "toolong" * 9]
    rows = [(i if i % 7 else None, " ".join(rng.choice(words) for _ in range(80)) + rng.choice(["", "é", "\n1"])) for i in range(60)]
    docs = spark.createDataFrame([*rows, (1, None), (2, ""), rows[3], rows[3]], "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit(2))
    got, want = twin_rows(spark, tmp_path, "op11_spelling_variants", {"documents": docs})
    assert got == want and len(got) >= 8


URLS = [
    "https://www.example.com/en/1", "https://EXAMPLE.com/en/2", "http://a.example.com/en", "https://b.net/es/3", "https://b.net/esx", "ftp://net/fr/",
    "no scheme", "", None, "x://?q", "://h.co.uk/p?x#y", "https://com", "https://com/", "https://notcom.org/://com/en/", "https://10.0.0.1:80/x",
    "https://h.org/en/5\n6", "https://h.org/en/99999999999999999999", "https://a.b.co.uk#f", "http://www.example.com/en/", "https://.com/", "https://h.org/xx/7/",
]


def test_url_query_on_odd_rows(spark, tmp_path):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (0, URLS[0])], "page_id long, url string")
    pages = pages.withColumn("host", F.lit(1)).withColumn("key", F.lit(1)).withColumn("n", F.lit(1))
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 1, 1), (5, None, None), (7, 0, None), (7, 0, None), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got, want = twin_rows(spark, tmp_path, "op13_url_filter", {"pages": pages, "labels": labels})
    assert got == want and len(got) == len(URLS) + 2
    by = {r[0]: r for r in got if r[0] is not None}
    assert by[0][1:5] == ("www.example.com", "/en/1", "www.example.com/en/", "allow") and by[1][1:5] == ("example.com", "/en/2", "example.com/en/", "block")
    assert by[2][3:5] == ("com/", "allow") and by[3][3:5] == ("net/es/", "block") and by[4][3] is None and by[5][3:5] == ("net/fr/", "block")
    assert by[6][1:4] == ("", "", None) and by[8][1:4] == ("", "", None) and by[11][2:4] == ("", None) and by[12][3] == "com/"
    assert by[13][1:4] == ("notcom.org", "/://com/en/", None) and by[19][3] == "com/"


def test_reputation_blocks_bad_hosts_and_shrinks_thin_ones(spark):
    counts = [(f"good{i}.clean.org", 200, 4) for i in range(20)] + [(f"bad{i}.farm.net", 100, 80) for i in range(5)]
    counts += [("thin.clean.org", 1, 1), ("new.farm.net", 0, 0), ("one.bad.clean.org", 300, 270)]
    hosts = spark.createDataFrame(counts, "host string, n long, k long")
    got = {r["host"]: r for r in host_reputation(hosts).collect()}
    assert len(got) == len(counts)
    assert got["bad0.farm.net"]["bound"] > 0.6 and got["new.farm.net"]["mean"] > 0.6 and got["good0.clean.org"]["mean"] < 0.05
    assert got["thin.clean.org"]["bound"] < LIMIT < 1 and got["one.bad.clean.org"]["bound"] > 0.5
    none = host_reputation(hosts.withColumn("n", F.lit(0).cast("long")).withColumn("k", F.lit(0).cast("long"))).agg(F.max("mean")).first()[0]
    assert none == 0
    assert host_reputation(hosts.limit(0)).count() == 0


def test_longest_rule_and_hot_host(spark):
    pages = spark.range(5_000).select(F.col("id").alias("page_id"), F.when(F.col("id") < 4_000, "http://hot.bad.net/x").otherwise(
        F.concat(F.lit("http://h"), F.col("id"), F.lit(".fine.org/y"))).alias("url"))
    outcomes = pages.filter("page_id % 2 = 0").select("url", (F.col("page_id") < 4_000).alias("bad"))
    got = judge_urls(pages, outcomes, [Rule("allow", "h4001.fine.org", "/"), Rule("block", "h4001.fine.org", "/y")])
    rows = {r["page_id"]: r for r in got.collect()}
    assert len(rows) == 5_000 and {rows[i]["verdict"] for i in range(4_000)} == {"block"}
    assert rows[4001]["verdict"] == "block" and rows[4001]["rule"] == "h4001.fine.org/y" and rows[4002]["verdict"] == "allow"
    assert judge_urls(pages.limit(0), outcomes, []).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, outcomes.limit(0), []).collect()} == {"allow"}


def test_registered_domains(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("co.uk",), ("x.com",), ("com",), ("",), ("10.0.0.1",)], "h string")
    assert [r[0] for r in df.select(registered_domain(F.col("h"))).collect()] == ["b.co.uk", "co.uk", "x.com", "com", "", "10.0.0.1"]


def test_twins_are_registered():
    assert twins.SPELLING == queries.ORACLES["op11_spelling_variants"] and "op12_periodic_runs" not in queries.ORACLES
