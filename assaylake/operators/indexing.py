"""Global positions, ranks and exact quantiles without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.session import materialize, small_side

_POS_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def _sorted_pieces(df: DataFrame, order: Sequence[Column], group: Sequence[str]) -> DataFrame:
    """Range-partition and sort, then write once: each row carries its piece and its place in it.

    Equal keys are split by a hash of the whole row, so a score shared by a third of the rows is
    still spread over many pieces. The written copy matters: range partitioning samples its input
    and would cut at other points if it ran again.
    """
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keys = [F.col(g) for g in group] + list(order) + [F.col("_tie")]
    ranged = (
        df.withColumn("_tie", tie)
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_tie")
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_piece", F.shiftright("_pos", _POS_BITS).cast("int"))
    )
    return materialize(ranged, "sorted")


def with_row_index(df: DataFrame, order: Sequence[Column], group: Sequence[str] = (),
                   index: str = "row_index", size: str | None = None) -> DataFrame:
    """0-based position of each row in the given order, within each group if groups are given.

    ``size`` names a column for the number of rows of the group, which the same counts give.

    Two passes: sort into ranges, count rows per (range, group), add the counts of the ranges
    before. End ``order`` with a unique column to make the result unique. A group may span many
    ranges, so one huge group does not land on one task.
    """
    pieces = _sorted_pieces(df, order, group)
    per_piece = pieces.groupBy("_piece", *group).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    # one row per (range, group): at most ranges + groups rows
    window = Window.partitionBy(*group, F.lit(0)).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.withColumn("_before", F.coalesce(F.sum("_n").over(window), F.lit(0)))
    if size:
        offsets = offsets.withColumn("_all", F.sum("_n").over(Window.partitionBy(*group, F.lit(0))))
    offsets = offsets.drop("_n")
    on = F.col("p._piece") == F.col("o._piece")
    for g in group:
        on = on & F.col(f"p.{g}").eqNullSafe(F.col(f"o.{g}"))
    # without groups there is one row a range, and no more ranges than shuffle partitions
    offsets = small_side(offsets) if group else F.broadcast(offsets)
    position = (F.col("_pos") - F.col("_start") + F.col("_before")).cast("bigint")
    return (
        pieces.alias("p").join(offsets.alias("o"), on)
        .select(*[F.col(f"p.{c}") for c in df.columns], position.alias(index), *([F.col("_all").alias(size)] if size else []))
    )


def assign_slice(df: DataFrame, order: Sequence[Column], n: int, slice_col: str = "slice") -> DataFrame:
    """Deterministic dispatch: data row r belongs to slice r mod n."""
    return with_row_index(df, order, index="_at").withColumn(slice_col, F.pmod("_at", F.lit(n)).cast("int")).drop("_at")


def slice_rows(df: DataFrame, order: Sequence[Column], n: int, i: int) -> DataFrame:
    return assign_slice(df, order, n, "_slice").filter(F.col("_slice") == i).drop("_slice")


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank_in_run",
                percent: str | None = "percent_rank") -> DataFrame:
    """1-based rank in each group and its share of the way to the last; groups may be huge."""
    out = with_row_index(df, order, group, "_at", "_size").withColumn(rank, F.col("_at") + 1)
    if percent:
        out = out.withColumn(percent, F.when(F.col("_size") > 1, F.col("_at") / (F.col("_size") - 1)).otherwise(F.lit(0.0)))
    return out.drop("_at", "_size")


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """(group…, prob, quantile) with linear interpolation, exact at any size.

    ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here equal
    values are counted first (map-side), the counts are range-sorted, and only the rows at the
    wanted positions leave their range.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    pieces = _sorted_pieces(counts, [F.col(value)], group)
    by_group = Window.partitionBy(*group, F.lit(0))
    per_piece = (
        pieces.groupBy("_piece", *group).agg(F.sum("_n").alias("_rows"))
        .withColumn("_before", F.coalesce(
            F.sum("_rows").over(by_group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(by_group))
    )
    wanted = (
        per_piece
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_want", F.col("prob") * (F.col("_total") - 1))
        .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn("_at", F.when(F.col("_side") == 0, F.floor("_want")).otherwise(F.ceil("_want")))
        .filter((F.col("_at") >= F.col("_before")) & (F.col("_at") < F.col("_before") + F.col("_rows")))
    )
    # ranges that hold a wanted position: at most two per quantile and group
    target = wanted.groupBy("_piece", *group).agg(
        F.first("_before").alias("_before"), F.collect_list(F.struct("prob", "_side", "_at", "_want")).alias("_targets"))
    on = F.col("p._piece") == F.col("t._piece")
    for g in group:
        on = on & F.col(f"p.{g}").eqNullSafe(F.col(f"t.{g}"))
    inside = Window.partitionBy("_piece", *group).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    hits = (
        pieces.alias("p").join(target.alias("t"), on)
        .select(*[F.col(f"p.{g}") for g in group], F.col("p._piece").alias("_piece"), F.col(f"p.{value}").alias(value),
                F.col("p._n").alias("_n"), "_before", "_targets")
        .withColumn("_from", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .withColumn("_t", F.explode("_targets"))
        .filter((F.col("_t._at") >= F.col("_from")) & (F.col("_t._at") < F.col("_from") + F.col("_n")))
    )
    low = F.max(F.when(F.col("_t._side") == 0, F.col(value)))
    high = F.max(F.when(F.col("_t._side") == 1, F.col(value)))
    part = F.max(F.col("_t._want") - F.floor("_t._want"))
    return hits.groupBy(*group, F.col("_t.prob").alias("prob")).agg((low + (high - low) * part).alias("quantile"))
