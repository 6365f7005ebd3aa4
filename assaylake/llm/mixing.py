"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

DataFrame functions only. Texts are read once, for their sizes; what is shuffled are sums per source
and per (source, bin), and the rows of one bin of each source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.operators.indexing import with_row_index
from assaylake.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096  # three hexadecimal digits of the document's key


def word_count(text: Column) -> Column:
    """Words between white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, weight, target) for rows (source, size).

    Sources in code point order, null last, take ``weights`` in turn and share the sum of all sizes by
    them. A target stops at ``max_epochs`` times its source's size; what it leaves is shared by weight
    among the others, again and again until no target is above its cap. Every round is one aggregate
    over the small table of sources; a round ends the loop unless it caps another source.
    """
    spark = sized.sparkSession
    sums = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    order = [F.col("source").isNull(), F.col("source")]
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    sources = materialize(
        with_row_index(sums, order, index="_at")
        .select("source", "source_size", weight.cast("bigint").alias("weight"),
                (F.col("source_size") * max_epochs).alias("_cap")), "weighted")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("_cap") <= F.col("weight") * F.lit(level)
        held, open_weight, n = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("_cap"))), F.lit(0)), F.sum(F.when(~full, F.col("weight"))),
            F.coalesce(F.sum(full.cast("int")), F.lit(0))).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - held) / open_weight, n
    target = F.when(F.col("_cap") <= F.col("weight") * F.lit(level), F.col("_cap").cast("double")).otherwise(
        F.col("weight") * F.lit(level))
    return spark.createDataFrame([], "source string, source_size bigint, weight bigint, target double").union(
        sources.select("source", "source_size", "weight", target))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix",
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken): how many words of each document the mix takes, repeats counted.

    A source is repeated whole as often as its target allows. The rest of its target is filled by one
    more repetition in the order of md5(seed, id): documents are taken whole until the target is met,
    and the document that crosses it contributes only the words still missing, so a source misses
    its target by half a word at most. The cut is found by counting: sizes per (source, bin of keys)
    give the bin that holds it, and only that bin's rows, a 4096th of the source, are put in order.

    Null texts have size 0 and take nothing; a null source is a source of its own; rows that repeat an
    id are separate documents, and which of several equal rows is cut changes nothing in the result.
    An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = materialize(
        docs.select(F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"), F.col(source_col).alias("source"),
                    key.alias("key"))
        .withColumn("bin", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")), "sizes")
    targets = source_targets(sized, weights, max_epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint"))
    targets = targets.withColumn("rest", F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint"))
    # at most 4096 rows per source, whatever the source's size
    bins = sized.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    so_far = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    same = F.col("b.source").eqNullSafe(F.col("t.source"))
    cut = (
        targets.alias("t").join(bins.alias("b"), same & (F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")), "left")
        .select("t.source", "t.source_size", "t.target", "t.whole", "t.rest", F.coalesce("b.bin", F.lit(-1)).alias("cut_bin"),
                F.coalesce("b.before", F.lit(0)).alias("before")))
    cut = materialize(cut, "cuts")
    rows = sized.alias("d").join(cut.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))).select(
        "d.id", "d.size", "d.source", "d.key", "d.bin", *[F.col(f"t.{c}") for c in ("source_size", "target", "whole", "rest", "cut_bin", "before")])
    more = F.when(F.col("bin") < F.col("cut_bin"), F.col("size")).otherwise(F.lit(0))
    inside = rows.filter(F.col("bin") == F.col("cut_bin")).withColumn("more", F.least("size", F.greatest(F.lit(0), (
        F.col("rest") - F.col("before") - F.coalesce(F.sum("size").over(
            Window.partitionBy("source").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))))
    every = rows.filter(F.col("bin") != F.col("cut_bin")).withColumn("more", more).unionByName(inside)
    return every.select(F.col("id").alias(id_col), "size", "source_size", "target",
                        (F.col("whole") * F.col("size") + F.col("more")).alias("taken"))
