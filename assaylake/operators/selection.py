"""Top-k, hash-ordered samples and the exploit/explore selections built from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions import predicates as P
from assaylake.operators.aggregates import first_row
from assaylake.operators.indexing import with_row_index
from assaylake.operators.joins import without
from assaylake.operators.topk import Key, first_rows
from assaylake.session import materialize

# Names of the selection legs.
EXPLOIT, EXPLORE = "exploitation", "exploration"
CENTROID, DIVERSITY = "cluster_centroid", "diversity_random"


def top_k(df: DataFrame, k: int | Callable[[int], int], by: str, ascending: bool = True, key: str = "molecule_hash") -> DataFrame:
    """Best k rows, best first, missing scores last, ties broken by key.

    Fails on a rank column without any value: its "best" rows would be arbitrary. ``k`` may be a function of the number
    of rows.
    """
    keys = [Key(F.col(by), ascending), Key(F.col(key))]
    return first_rows(df, keys, k, needs_value=by).orderBy(*[x.order for x in keys])


def sample_order(key: str, seed: str) -> list[Key]:
    return [Key(F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))), Key(F.col(key))]


def sample_k(df: DataFrame, k: int, seed: str, key: str = "molecule_hash") -> DataFrame:
    """Exactly min(k, rows) rows without replacement; the same rows on every run."""
    return first_rows(df, sample_order(key, seed), k)


def select_for_labelling(pool: DataFrame, k_exploit: int, k_explore: int, by: str = "docking_score",
                         ascending: bool = True, seed: str = "label", valid: Column | None = None,
                         disjoint: bool = True, key: str = "molecule_hash") -> DataFrame:
    """(key, strategy): the best k_exploit of the valid pool and k_explore random others.

    ``disjoint=False`` draws the random leg from the whole pool and keeps overlaps.
    """
    valid_rows = pool.filter(P.valid_pool() if valid is None else valid)
    # the k best are used twice; written once, the pool is not ranked again
    best = materialize(top_k(valid_rows, k_exploit, by, ascending, key).select(key, F.lit(EXPLOIT).alias("strategy")), "best")
    rest = without(valid_rows, best, key) if disjoint else valid_rows
    drawn = sample_k(rest.select(key), k_explore, seed, key).select(key, F.lit(EXPLORE).alias("strategy"))
    return best.unionByName(drawn)


def top_uncertain(df: DataFrame, k: int, uncertainty: str = "uncertainty", key: str = "molecule_hash") -> DataFrame:
    return top_k(df, k, uncertainty, ascending=False, key=key)


def elite_pool(screening: DataFrame, k: int = 20_000, by: str = "final_score") -> DataFrame:
    """Passes the elite filter, best scores first."""
    return top_k(screening.filter(P.elite_filter()), k, by)


def top_percent(df: DataFrame, percent: float, by: str, ascending: bool = True, key: str = "molecule_hash") -> DataFrame:
    """The best ``percent`` of the rows, rounded down to whole rows."""
    return top_k(df, lambda rows: int(rows * percent / 100.0), by, ascending, key)


def cluster_best(members: DataFrame, cluster: str = "cluster_id", rank: str = "rank") -> DataFrame:
    """The member with the best (smallest) rank of every cluster."""
    return first_row(members, cluster, [rank])


def select_elite(clustered: DataFrame, n_struct: int, n_random: int, seed: str = "elite", key: str = "molecule_hash",
                 cluster: str = "cluster_id", rank: str = "rank") -> DataFrame:
    """Best of each cluster up to n_struct, then random others; a shortage of clusters is made up
    for by more random ones."""
    reps = cluster_best(clustered, cluster, rank)
    chosen = materialize(first_rows(reps, [Key(F.col(rank)), Key(F.col(key))], n_struct), "chosen")
    n_chosen = chosen.count()
    rest = without(clustered, chosen, key)
    drawn = sample_k(rest, n_random + max(0, n_struct - n_chosen), seed, key)
    return chosen.withColumn("selection_strategy", F.lit(CENTROID)).unionByName(
        drawn.withColumn("selection_strategy", F.lit(DIVERSITY)))


def discovery_rate(df: DataFrame, k: int, proxy: str, docking: str, key: str = "molecule_hash") -> DataFrame:
    """Share of the proxy's top k that the docking top k misses."""
    by_proxy = top_k(df.select(key, proxy), k, proxy, key=key)
    by_docking = top_k(df.select(key, docking), k, docking, key=key).select(key, F.lit(1).alias("_in"))
    return by_proxy.join(by_docking, key, "left").agg(
        F.count(F.lit(1)).alias("k"),
        F.count_if(F.col("_in").isNull()).alias("n_new"),
        (F.count_if(F.col("_in").isNull()) / F.count(F.lit(1)) * 100.0).alias("discovery_pct"),
    )


def replay_mix(elite: DataFrame, original: DataFrame, fraction: float, seed: str = "replay",
               key: str = "molecule_hash") -> DataFrame:
    """Elite rows plus ``fraction`` times as many rows of the original training set."""
    elite = materialize(elite, "elite")  # read three times; counted from the written copy
    extra = sample_k(without(original, elite, key), int(elite.count() * fraction), seed, key)
    return elite.withColumn("origin", F.lit("elite")).unionByName(
        extra.withColumn("origin", F.lit("original")), allowMissingColumns=True)


def stack_cycles(cycles: dict[str, DataFrame], tag: str = "cycle") -> DataFrame:
    """All cycles in one frame with a tag; columns one cycle lacks are null there."""
    out: DataFrame | None = None
    for name, df in cycles.items():
        tagged = df.withColumn(tag, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no cycles")
    return out


def retain_last_versions(df: DataFrame, n: int, version: str = "model_version") -> DataFrame:
    """Rows of the n latest model versions, by the number in the version name."""
    versions = df.select(version).distinct().withColumn(
        "_no", F.regexp_extract(F.col(version), r"(\d+)", 1).try_cast("int"))
    last = versions.orderBy(F.col("_no").desc_nulls_last(), F.col(version).desc()).limit(n)
    return df.join(last.select(version), version, "left_semi")


def hash_split(df: DataFrame, fraction: float, key: str = "molecule_hash", seed: str = "split",
               names: Sequence[str] = ("train", "valid")) -> DataFrame:
    """Adds ``split``: a key stays on its side however the data are partitioned or extended."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint")
    limit = int(fraction * (1 << 32))
    return df.withColumn("split", F.when(digits < F.lit(limit), names[0]).otherwise(names[1]))


def positional_split(df: DataFrame, order: Sequence[Column], fraction: float = 0.9,
                     names: Sequence[str] = ("train", "valid")) -> DataFrame:
    """First ``fraction`` of the rows in order, and the rest."""
    cut = F.floor(F.col("_rows") * F.lit(float(fraction)))
    return with_row_index(df, order, index="_at", size="_rows").withColumn(
        "split", F.when(F.col("_at") < cut, names[0]).otherwise(names[1])).drop("_at", "_rows")
