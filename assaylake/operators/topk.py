"""The first k rows of a table by selection: find where the k-th key lies, sort only what is left around it.

One pass reads the keys alone and keeps a quantile sketch of fixed size. The sketch brackets the k-th key
between two values with a known rank error; rows before the bracket are taken as they are, rows behind it
are dropped, and only the rows within it go on. That is repeated, with the next key where all remaining rows
tie, until it no longer pays; the remainder is cut by position after a distributed sort. No step depends on
k, and no task holds k rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.operators.indexing import with_row_index
from assaylake.session import materialize

ACCURACY = 10_000  # ranks from the sketch are off by at most this part of all rows
_GRID = [i / 4_000 for i in range(1, 40)] + [i / 400 for i in range(4, 401)]
ENOUGH = 65_536  # remaining rows that are not worth another pass
_NAN_FIRST, _VALUE, _NAN_LAST, _NULL = range(4)


@dataclass(frozen=True)
class Key:
    """An order key; nulls come last either way, NaN counts as the largest number."""

    column: Column
    ascending: bool = True

    @property
    def order(self) -> Column:
        return self.column.asc_nulls_last() if self.ascending else self.column.desc_nulls_last()


def _number(key: Column, kind: T.DataType, ascending: bool) -> tuple[Column | None, bool]:
    """A number that never falls along the order, and whether equal numbers mean equal keys; None for other types."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        c = key.cast("bigint")
        return (c if ascending else F.bitwise_not(c)), True  # -c - 1 has no overflow
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        c = key.cast("double")
        return (c if ascending else -c), not isinstance(kind, T.DecimalType)
    if isinstance(kind, T.StringType) and ascending:  # the first six bytes
        return F.conv(F.rpad(F.hex(F.substring(key.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("bigint"), False
    return None, False


def _level(key: Column, kind: T.DataType, ascending: bool) -> Column:
    level = F.when(key.isNull(), _NULL)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        level = level.when(F.isnan(key), _NAN_LAST if ascending else _NAN_FIRST)
    return level.otherwise(_VALUE)


def _measure(rows: DataFrame, level: Column, number: Column | None) -> tuple[list[int], list]:
    """Rows on each level, and the quantiles of the numbers; one row of fixed size."""
    counts = [F.count_if(level == i) for i in range(4)]
    sketch = [] if number is None else [F.percentile_approx(F.when(level == _VALUE, number), _GRID, ACCURACY)]
    out = rows.agg(*[c.alias(f"c{i}") for i, c in enumerate([*counts, *sketch])]).first()
    return [int(x or 0) for x in out[:4]], list(out[4] or []) if sketch else []


def _bracket(share: float, quantiles: list) -> tuple:
    """Values between which the row at this share of all lies; None where there is no bound."""
    off = 2.0 / ACCURACY
    low = high = None
    for p, q in zip(_GRID, quantiles, strict=False):
        if p <= share - off:
            low = q
        if p >= share + off and high is None:
            high = q
    return low, high


def first_rows(df: DataFrame, keys: Sequence[Key], k: int | Callable[[int], int], needs_value: str | None = None) -> DataFrame:
    """The first ``k`` rows in the order of ``keys``, in no particular order; all rows if there are fewer.

    ``k`` may be a function of the number of rows, which the first pass counts anyway. End ``keys`` with a unique
    one to make the result unique. With ``needs_value`` the first key (of that name) must have a value in some row:
    its first rows would be arbitrary.
    """
    sure: list[DataFrame] = []
    rest, at, want = df, 0, k
    while at < len(keys):
        key = keys[at]
        kind = rest.select(key.column).schema[0].dataType
        number, exact = _number(key.column, kind, key.ascending)
        level = _level(key.column, kind, key.ascending)
        counts, quantiles = _measure(rest, level, number)
        total = sum(counts)
        if rest is df:
            want = k(total) if callable(k) else k
            if needs_value and total and counts[_NULL] == total:
                raise ValueError(f"no value in rank column {needs_value}")
        if want <= 0 or total <= want:
            sure.append(rest if want > 0 else rest.limit(0))
            return _stacked(sure)
        if total <= ENOUGH or number is None:
            break
        there = next(i for i in range(4) if sum(counts[:i + 1]) >= want)
        before = sum(counts[:there])
        low = high = None
        if there == _VALUE:
            low, high = _bracket((want - before) / counts[_VALUE], quantiles)
        inside = level == there
        kept = (level < there) | (inside if high is None else inside & (number <= high))
        done = (level < there) if low is None else (level < there) | (inside & (number < low))
        written = materialize(rest.filter(kept).withColumn("_done", done), "bracket")
        n_done, n_kept = (int(x or 0) for x in written.agg(F.count_if("_done"), F.count(F.lit(1))).first())
        if n_done > want or n_kept < want:  # outside the sketch's promise: leave the bracket out
            break
        sure.append(written.filter("_done").drop("_done"))
        rest, want = written.filter("not _done").drop("_done"), want - n_done
        if there != _VALUE or (low is not None and low == high and exact):
            at += 1  # the remaining rows tie on this key
        elif (n_kept - n_done) * 2 > total:
            break
    if want:
        sure.append(with_row_index(rest, [x.order for x in keys], index="_at").filter(F.col("_at") < want).drop("_at"))
    return _stacked(sure)


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
