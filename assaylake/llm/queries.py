"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.llm import twins
from assaylake.llm.ann import search
from assaylake.llm.chat import format_chats
from assaylake.llm.decontamination import contamination_report
from assaylake.llm.html_extraction import extraction_report
from assaylake.llm.licenses import license_report
from assaylake.llm.mixing import mix_sources
from assaylake.llm.near_dedup import near_duplicates
from assaylake.llm.periodic import collapse_runs
from assaylake.llm.quality import quality_report
from assaylake.llm.spelling import letter_runs, spelling_variants, word_counts
from assaylake.llm.substring_dedup import repeats_report
from assaylake.llm.toxicity import toxicity_report
from assaylake.llm.url_reputation import Rule, judge_urls, lower_ascii, url_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_mix_sources", twins.MIX)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op6_license_scan", twins.licenses())
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


@query("op5_decontaminate", twins.CONTAMINATION)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_minhash_near_dedup")
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_report(table(spark, sf_dir, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_report(table(spark, sf_dir, "pages"))


@query("op8_posting_lists")
def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query("op7_chat_format")
def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document by crc32 of its id repeats a stretch of its words to the end; the others are as they were."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    docs = docs.select("doc_id", "text", h.alias("h"), F.when((h % 10 == 0) & (F.length("text") > 0), words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    docs = docs.withColumn("n", n).withColumn("a", F.when(n > 0, g % n)).withColumn("g", g)
    docs = docs.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = (F.col("n") - F.col("a")).cast("int")
    block = F.slice("w", F.col("a").cast("int") + 1, F.col("p"))
    repeated = F.slice(F.flatten(F.array_repeat(block, F.ceil(rest / F.col("p")).cast("int"))), 1, rest)
    planted = F.array_join(F.concat(F.slice("w", 1, F.col("a").cast("int")), repeated), " ")
    return docs.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.withColumn("best", F.array_max(key)).withColumn("lines", F.array_join(lines, ""))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


URL_RULES = [
    Rule("allow", "com"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
]


@query("op13_url_filter", twins.urls(URL_RULES))
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a page's path is the document it shows: toxic or low-quality documents are bad outcomes."""
    pages = table(spark, sf_dir, "pages")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    shown = F.regexp_extract(url_path(F.col("url")), r"^/[^/]*/([0-9]{1,18})(?![0-9])", 1)
    shown = pages.select("url", F.when(shown != "", shown.cast("long")).alias("doc_id")).filter("doc_id is not null")
    return judge_urls(pages, shown.join(labels, "doc_id"), URL_RULES)


@query("op11_spelling_variants", twins.SPELLING)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run in 199, by crc32 of its document and itself, loses a letter before words are counted."""
    docs = table(spark, sf_dir, "documents")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), letter_runs(F.col("text")).alias("run"))
    runs = runs.select("id", lower_ascii(F.col("run")).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return spelling_variants(word_counts(runs.select(F.when(h % 199 == 0, cut).otherwise(F.col("run")).alias("word"))))
