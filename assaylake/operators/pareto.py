"""Non-dominated rows for several objectives, by a grid of dominance cells.

A cell holds the rows between two neighbouring quantiles of each objective. A row strictly above another one's
cell in every objective is beaten by any row there, so whole cells fall by looking at which cells are occupied; a
row of the others can only be beaten from cells that are nowhere above its own. Only such cells are compared row
by row, in tiles of bounded size that Spark deals out, however many rows survive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.session import materialize

HELD = 20_000  # rows of a skyline that a task holds before it hands them on
CELLS = 4_096  # most cells of the grid; which of them are occupied is looked at in the driver
TILE = 2_048  # rows of a cell that are compared at a time


def _not_dominated(points: np.ndarray, by: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Which points no row of ``by`` beats: at least as small everywhere, smaller somewhere."""
    keep = np.ones(len(points), dtype=bool)
    for i in range(0, len(by), chunk):
        alive = np.flatnonzero(keep)
        if not len(alive):
            break
        p, q = points[alive], by[i:i + chunk]
        no_worse, better = np.ones((len(p), len(q)), dtype=bool), np.zeros((len(p), len(q)), dtype=bool)
        for j in range(p.shape[1]):
            no_worse &= q[:, j] <= p[:, j, None]
            better |= q[:, j] < p[:, j, None]
        keep[alive[(no_worse & better).any(axis=1)]] = False
    return keep


def _skyline(values: np.ndarray) -> np.ndarray:
    """Positions of the non-dominated rows: sweep in order of the sum, so no later row beats an earlier one."""
    order = np.argsort(values.sum(axis=1), kind="stable")
    kept: list[int] = []
    window = np.empty((0, values.shape[1]))
    for start in range(0, len(order), 512):
        part = order[start:start + 512]
        part = part[_not_dominated(values[part], window)]
        part = part[_not_dominated(values[part], values[part])]
        kept.extend(part.tolist())
        window = values[np.asarray(kept, dtype=int)] if kept else window
    return np.asarray(kept, dtype=int)


def _steps(objectives: int, cells: int) -> int:
    """Cells along one objective."""
    steps = 2
    while (steps + 1) ** objectives <= cells:
        steps += 1
    return steps


def _cell(cols: Sequence[str], cuts: Sequence[Sequence[float]], steps: int) -> Column:
    """The number of the cell: per objective how many cuts lie below the value."""
    out = F.lit(0)
    for c, at in zip(cols, cuts, strict=True):
        out = out * steps + sum([(F.col(c) > F.lit(float(x))).cast("int") for x in at], F.lit(0))
    return out


def _meetings(occupied: Sequence[int], objectives: int, steps: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Cells that no occupied cell beats as a whole, and pairs (cell, cell that may hold rows that beat its rows)."""
    shape = (steps,) * objectives
    there = np.zeros(shape, dtype=bool)
    there.reshape(-1)[list(occupied)] = True
    below = there.copy()
    for axis in range(objectives):
        below = np.logical_or.accumulate(below, axis=axis)
    beaten = np.zeros(shape, dtype=bool)
    beaten[(slice(1, None),) * objectives] = below[(slice(None, -1),) * objectives]
    live = np.flatnonzero((there & ~beaten).reshape(-1))
    at = np.stack(np.unravel_index(live, shape), axis=1) if len(live) else np.zeros((0, objectives), dtype=int)
    pairs = [(int(live[i]), int(b)) for i in range(len(live)) for b in live[(at <= at[i]).all(axis=1)]]
    return [int(c) for c in live], pairs


def _beaten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of the rows of a tile that a row of the other tile beats."""
    for b in batches:
        for rows, others in zip(b.column("rows"), b.column("others"), strict=True):
            one, two = (np.stack([x.values.field(f"v{j}").to_numpy() for j in range(x.values.type.num_fields - 1)], axis=1) for x in (rows, others))
            lost = ~_not_dominated(one, two)
            yield pa.RecordBatch.from_arrays([rows.values.field("id").filter(pa.array(lost))], names=["id"])


def pareto_front(df: DataFrame, objectives: Sequence[tuple[str, bool]]) -> DataFrame:
    """Rows no other row beats; each objective is (column, lower_is_better).

    Rows without a value in some objective are left out. Equal rows do not beat each other, so
    distinct objective vectors are compared once and joined back. Each task first drops what its own
    rows beat. Of what is left, quantiles make a grid of at most ``CELLS`` cells; beaten cells go as a whole,
    and tiles of a cell meet the tiles of the cells that can beat them. The check is exact however many survive.
    """
    cols = [c for c, _ in objectives]
    oriented = [(F.col(c) if low else -F.col(c)).cast("double").alias(c) for c, low in objectives]
    known = df.dropna(subset=cols)
    vectors = known.select(*oriented).distinct()
    schema = vectors.schema

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # keeps only the skyline of what it has seen, and hands it on when it grows large
        held = np.empty((0, len(cols)))
        for batch in batches:
            values = np.vstack([held, batch[cols].to_numpy(dtype=float)])
            held = values[_skyline(values)]
            if len(held) > HELD:
                yield pd.DataFrame(held, columns=cols)
                held = np.empty((0, len(cols)))
        if len(held):
            yield pd.DataFrame(held, columns=cols)

    survivors = materialize(vectors.mapInPandas(local, schema).withColumn("_id", F.monotonically_increasing_id()), "skyline")
    steps = _steps(len(cols), CELLS)
    shares = [i / steps for i in range(1, steps)]
    cuts = survivors.agg(*[F.percentile_approx(c, shares, 1_000).alias(c) for c in cols]).first()
    placed = survivors.withColumn("_cell", _cell(cols, [sorted(set(x or [])) for x in cuts], steps))
    sizes = {r["_cell"]: r["n"] for r in placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most CELLS rows
    live, pairs = _meetings(list(sizes), len(cols), steps)
    spark = df.sparkSession
    parts = F.broadcast(spark.createDataFrame([(c, -(-sizes[c] // TILE)) for c in live], "_cell int, parts long"))
    placed = materialize(placed.join(parts, "_cell"), "placed")
    row = F.struct(*[F.col(c).alias(f"v{j}") for j, c in enumerate(cols)], F.col("_id").alias("id"))
    tiles = materialize(placed.groupBy("_cell", F.pmod(F.xxhash64("_id"), "parts").alias("part")).agg(F.collect_list(row).alias("rows")), "tiles")
    meets = F.broadcast(spark.createDataFrame(pairs, "_cell int, by int"))
    met = tiles.join(meets, "_cell").select("by", "rows").join(
        tiles.select(F.col("_cell").alias("by"), F.col("rows").alias("others")), "by").select("rows", "others")
    lost = met.mapInArrow(_beaten, "id long").distinct()
    front = placed.join(lost.withColumnRenamed("id", "_id"), "_id", "left_anti")
    back = front.select(*[(F.col(c) if low else -F.col(c)).alias(f"_o_{c}") for c, low in objectives])
    on = None
    for c in cols:
        same = F.col(c).cast("double") == F.col(f"_o_{c}")
        on = same if on is None else on & same
    return known.join(back, on, "left_semi")
