"""De-duplication, run summaries, model checks and cycle metrics.

All are plain ``groupBy().agg()`` with partial aggregation, so a key that holds a third of the rows
shrinks to one row per map task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.functions import scalars as S
from assaylake.operators.indexing import exact_quantiles

# Thresholds of the cycle report and the state of a good label.
HIT, ELITE = -30.0, -40.0
SUCCESS = "Success"


def first_row(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One whole row per key: the first in ``order``, which must end in a unique column.

    ``min_by`` combines on the map side; a window with row_number would ship every duplicate.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ranks = [F.col(o).alias(f"o{i}") if isinstance(o, str) else o.alias(f"o{i}") for i, o in enumerate(order)]
    best = F.min_by(F.struct(*rest), F.struct(*ranks)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)


def dedup_registry(registry: DataFrame, order: Sequence[str] = ("created_at", "global_id")) -> DataFrame:
    """One row per molecule_hash; the earliest registration stays."""
    return first_row(registry.filter(F.col("molecule_hash").isNotNull()), "molecule_hash", order)


def best_result_key(value: Column, status: str, tie: Sequence[str]) -> Column:
    """Ordering of label attempts: successes by value, then failures by time."""
    good = (F.col(status) == SUCCESS) & value.isNotNull()
    return F.struct(
        F.when(good, 0).otherwise(1).alias("fail"),
        F.when(good, value).alias("value"),
        *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
    )


def best_result(results: DataFrame, key: str = "molecule_hash", delta_g: str = "delta_g", status: str = "status",
                tie: Sequence[str] = ("seq",)) -> DataFrame:
    """Lowest ΔG among the successes of a key; a failure only when it has no success.

    A success whose value is text, ``nan`` or missing counts as a failure.
    """
    rest = [c for c in results.columns if c != key]
    is_text = dict(results.dtypes)[delta_g] == "string"
    value = S.to_number(F.col(delta_g)) if is_text else S.nan_to_null(F.col(delta_g).cast("double"))
    best = F.min_by(F.struct(*rest), best_result_key(value, status, tie)).alias("_row")
    return (
        results.filter(F.col(key).isNotNull()).groupBy(key).agg(best)
        .select(key, "_row.*").select(*results.columns)
    )


def run_summary(screening: DataFrame, registry: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per (run, hash): mean scores, worst toxicity, constant method.

    Sums are taken per hash before the join, so duplicated score rows never cross the network.
    """
    names = {"final_score": "final_score", "qed_score": "qed_score", "mw": "avg_molwt", "logp": "avg_logp",
             "sa_score": "avg_sa_score"}
    per_hash = screening.filter(F.col("final_score").isNotNull()).groupBy("molecule_hash").agg(
        *[F.avg(c).alias(n) for c, n in names.items()], F.max("toxicity_label").alias("toxicity_label"))
    runs = registry.select("run_id", "molecule_hash").distinct()
    if run_id is not None:
        runs = runs.filter(F.col("run_id") == run_id)
    return runs.join(per_hash, "molecule_hash").select(
        "run_id", "molecule_hash", *names.values(), "toxicity_label", F.lit("xgboost").alias("score_method"))


def validation_metrics(pairs: DataFrame, predicted: str, actual: str) -> DataFrame:
    p, a = F.col(predicted), F.col(actual)
    return pairs.agg(F.corr(p, a).alias("correlation"), F.sqrt(F.avg((p - a) * (p - a))).alias("rmse"),
                     F.count(F.lit(1)).alias("n"))


def regression_metrics(pairs: DataFrame, predicted: str, actual: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE and R² as aggregates, per split if one is given."""
    p, a = F.col(predicted), F.col(actual)
    err = (p - a) * (p - a)
    return pairs.groupBy(*by).agg(
        F.sqrt(F.avg(err)).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.sum(err), F.var_pop(a) * F.count(a))).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def share(condition: Column) -> Column:
    """Rows that meet a condition in percent of all rows; a missing value meets none."""
    return F.count_if(condition) / F.count(F.lit(1)) * F.lit(100.0)


def cycle_metrics(scores: DataFrame, cycle: str = "cycle", exact: bool = True) -> DataFrame:
    """Per cycle: size, mean, median, hit rates, mean QED, safety, gold count; rates over all rows."""
    safe = S.safety_class(F.col("toxicity_label")) == S.SAFE
    score = F.col("final_score")
    aggs = [
        F.count(F.lit(1)).alias("total"),
        F.avg(score).alias("mean_affinity"),
        share(score < HIT).alias("hit_rate"),
        share(score < ELITE).alias("elite_rate"),
        F.avg("qed_score").alias("mean_qed"),
        share(safe).alias("safety_rate"),
        F.count_if((score < HIT) & safe).alias("gold_count"),
        share((score < HIT) & safe).alias("gold_rate"),
    ]
    if not exact:
        aggs.append(F.percentile_approx(score, 0.5).alias("median_affinity"))
        return scores.groupBy(cycle).agg(*aggs)
    medians = exact_quantiles(scores.select(cycle, "final_score"), [cycle], "final_score", [0.5])
    medians = medians.select(F.col(cycle).alias("_c"), F.col("quantile").alias("median_affinity"))
    base = scores.groupBy(cycle).agg(*aggs)
    return base.join(medians, base[cycle].eqNullSafe(medians["_c"]), "left").drop("_c")


def bin_distribution(scores: DataFrame, cycle: str = "cycle") -> DataFrame:
    """Share of each affinity and QED bin; missing scores are in no bin but in the total."""
    affinity, qed = S.affinity_bin(F.col("final_score")), S.qed_bin(F.col("qed_score"))
    return scores.groupBy(cycle).agg(
        *[share(affinity == b).alias(f"{b}_pct") for b in ("strong", "medium", "weak")],
        *[share(qed == b).alias(f"{b}_qed_pct") for b in ("high", "medium", "low")],
        F.count(F.lit(1)).alias("total"),
    )


def value_counts(df: DataFrame, c: str) -> DataFrame:
    return df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))


def run_count(df: DataFrame, run_id: str) -> DataFrame:
    return df.filter(F.col("run_id") == run_id).agg(F.count(F.lit(1)).alias("n_rows"))


def uniqueness(df: DataFrame, c: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct(c, 0.02) if approximate else F.count_distinct(F.col(c))
    return df.agg(F.count(F.lit(1)).alias("total"), distinct.alias("n_distinct")).withColumn(
        "uniqueness_pct", F.try_divide(F.col("n_distinct"), F.col("total")) * 100.0)


def status_report(df: DataFrame, status: str = "status") -> DataFrame:
    """Rows per state with their share, and a row ``ALL`` whose share is the success rate."""
    counts = df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
    rolled = counts.rollup(status).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col(status) == SUCCESS, F.col("n")).otherwise(0)).alias("n_success"),
        F.grouping(status).alias("is_total"))
    total = counts.agg(F.sum("n")).scalar()
    is_total = F.col("is_total") == 1
    return rolled.select(
        F.when(is_total, "ALL").otherwise(F.col(status)).alias("status"),
        F.col("n"),
        (F.when(is_total, F.col("n_success")).otherwise(F.col("n")) / total * 100.0).alias("pct"),
    )


def cycle_compare(metrics: DataFrame, names: Sequence[str], base: str, new: str, cycle: str = "cycle") -> DataFrame:
    """metric × cycle table with difference and fold change (null when the base is 0)."""
    long = metrics.select(cycle, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        [cycle], list(names), "metric", "value")
    wide = long.groupBy("metric").agg(
        F.max(F.when(F.col(cycle) == base, F.col("value"))).alias("base_value"),
        F.max(F.when(F.col(cycle) == new, F.col("value"))).alias("new_value"))
    return wide.withColumn("delta", F.col("new_value") - F.col("base_value")).withColumn(
        "fold_change", F.try_divide(F.col("new_value"), F.col("base_value")))


def zscore_outliers(df: DataFrame, c: str, limit: float = 3.0, sample: bool = True) -> DataFrame:
    """Rows further than ``limit`` standard deviations from the mean, with their z."""
    sd = F.stddev_samp(c) if sample else F.stddev_pop(c)
    mean, spread = df.agg(F.avg(c)).scalar(), df.agg(sd).scalar()
    return (
        df.withColumn("mean", mean).withColumn("sd", spread)
        .withColumn("z", F.try_divide(F.col(c) - F.col("mean"), F.col("sd")))
        .filter(F.abs("z") > limit)
    )


def quartiles(df: DataFrame, by: Sequence[str], c: str, exact: bool = True) -> DataFrame:
    """Five-number summary per group, for box and violin plots."""
    names = {0.0: "lowest", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "highest"}
    if not exact:
        return df.groupBy(*by).agg(*[F.percentile_approx(c, p).alias(n) for p, n in names.items()])
    q = exact_quantiles(df.select(*by, c), list(by), c, list(names))
    return q.groupBy(*by).agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in names.items()])


def histogram(df: DataFrame, by: Sequence[str], c: str, low: float, high: float, bins: int) -> DataFrame:
    """Fixed-width bins; values below ``low`` fall in bin 0, values from ``high`` up in bin ``bins + 1``."""
    bucket = F.width_bucket(F.col(c), F.lit(low), F.lit(high), F.lit(bins)).cast("int")
    return df.filter(F.col(c).isNotNull()).groupBy(*by, bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def scatter_bins(df: DataFrame, by: Sequence[str], x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """2-D bins that stand in for a scatter plot of any number of rows."""
    cell = lambda c, w: F.floor(F.col(c) / F.lit(w)).cast("int")
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(
        *by, cell(x, x_width).alias("x_bin"), cell(y, y_width).alias("y_bin")).agg(F.count(F.lit(1)).alias("n"))


def quality_report(df: DataFrame, cols: Sequence[str], run: str = "run_id", numeric_text: Sequence[str] = ()) -> DataFrame:
    """Per run and column: null rate, distinct values, constant flag, and how many values are no numbers in the columns
    ``numeric_text``. All exact.

    The columns are stacked as (column, value) and equal values counted before the shuffle, so a value that most rows
    share is one row a task. For columns of very many values see ``column_sketches``.
    """
    cell = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"), F.lit(c in numeric_text).alias("numeric")) for c in cols]
    values = df.select(run, F.explode(F.array(*cell)).alias("c")).select(run, "c.*").groupBy(run, "column_name", "numeric", "value").agg(
        F.count(F.lit(1)).alias("n"))
    missing, bad = F.col("value").isNull(), F.col("numeric") & F.col("value").isNotNull() & S.to_number(F.col("value")).isNull()
    of = lambda what: F.sum(F.when(what, F.col("n")).otherwise(0))
    return values.groupBy(run, "column_name").agg(
        F.sum("n").alias("n_rows"), (of(missing) / F.sum("n") * 100.0).alias("null_pct"), F.count("value").alias("n_distinct"),
        (F.count("value") == 1).cast("int").alias("is_constant"), of(bad).alias("n_unparsable"))


def column_sketches(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ("run_id",)) -> DataFrame:
    """(by…, column_name, n_rows, n_known, sketch): a HyperLogLog sketch of each column's values per group, a few kB each.

    Stored with a run, they tell the distinct values of any union of runs without reading the runs again.
    """
    parts = [F.struct(F.count(c).alias("n_known"), F.hll_sketch_agg(F.col(c).cast("string")).alias("sketch")).alias(f"s{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *parts)
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"s{i}").alias("s")) for i, c in enumerate(cols)]))
    return wide.select(*by, "n_rows", one.alias("e")).select(*by, "e.column_name", "n_rows", "e.s.n_known", "e.s.sketch")


def distinct_over(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by…, column_name, n_rows, n_known, n_distinct_approx) of united groups; the error is about 1.6 percent."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_known").alias("n_known"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct_approx"))


def population_vs_unique_mean(df: DataFrame, key: str, c: str) -> DataFrame:
    """Mean over raw rows beside the mean over distinct keys (one value per key: its mean)."""
    per_key = df.groupBy(key).agg(F.sum(c).alias("s"), F.count(c).alias("n"))
    return per_key.agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("population_mean"),
        F.avg(F.try_divide(F.col("s"), F.col("n"))).alias("unique_mean"),
        F.sum("n").alias("n_rows"),
        F.count_if(F.col("n") > 0).alias("n_keys"),
    )


def trend_by_iteration(df: DataFrame, iteration: str, score: Column, higher_is_better: bool = True) -> DataFrame:
    """Best and mean score per iteration and the change from the one before, gaps or not.

    Iterations are ordered by the number in their name, then by name; names without a number come last.
    """
    best = F.max("_s") if higher_is_better else F.min("_s")
    per = df.withColumn("_s", score).groupBy(iteration).agg(best.alias("best"), F.avg("_s").alias("mean"),
                                                            F.count("_s").alias("n"))
    # one row per iteration, so one task orders them
    numbered = per.withColumn("_no", F.regexp_extract(F.col(iteration).cast("string"), r"(\d+)", 1).try_cast("int"))
    in_order = Window.orderBy(F.col("_no").asc_nulls_last(), F.col(iteration).asc_nulls_last())
    return numbered.select(
        iteration, "best", "mean", "n", (F.col("best") - F.lag("best").over(in_order)).alias("best_change"),
        (F.col("mean") - F.lag("mean").over(in_order)).alias("mean_change"))


def scaffold_share(top: DataFrame, scaffold: Column, k: int = 1) -> DataFrame:
    """The commonest backbone keys among a selection and the share of rows that carry each."""
    counts = top.groupBy(scaffold.alias("scaffold")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share_pct", F.col("n") / total * 100.0).orderBy(F.desc("n"), "scaffold").limit(k)


def gate(metrics: DataFrame, rules: Sequence[tuple[str, str, float]]) -> DataFrame:
    """Loop guard: per cycle and rule (metric, '>=' or '<=', limit) whether the rule holds."""
    checks = []
    for metric, op, limit in rules:
        ok = F.col(metric) >= limit if op == ">=" else F.col(metric) <= limit
        checks.append(F.struct(F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"),
                               F.lit(float(limit)).alias("limit_value"), F.coalesce(ok, F.lit(False)).cast("int").alias("passed")))
    return metrics.select("cycle", F.explode(F.array(*checks)).alias("g")).select("cycle", "g.*")
