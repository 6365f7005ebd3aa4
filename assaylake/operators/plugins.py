"""Hooks for user-supplied scorers; the only operators that run Python per batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.session import materialize


def score_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], batch_size: int,
                  out_schema: T.StructType | str, keys: Sequence[str] = ("smiles",),
                  failed: str = "Scorer_Failed") -> DataFrame:
    """Apply a batch scorer; a batch that fails gives its rows with a failure status.

    ``fn`` gets up to ``batch_size`` rows and returns the columns of ``out_schema``, one row per input
    row, in order. The output is the key columns, these columns and ``status``; the job never aborts
    because of one bad batch.
    """
    produced = T.StructType.fromDDL(out_schema) if isinstance(out_schema, str) else out_schema
    names = [f.name for f in produced.fields]
    schema = T.StructType([df.schema[k] for k in keys] + [T.StructField(f.name, f.dataType, True) for f in produced.fields]
                          + [T.StructField("status", T.StringType(), False)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in batches:
            for start in range(0, len(big), batch_size):
                part = big.iloc[start:start + batch_size].reset_index(drop=True)
                out = part[list(keys)].copy()
                try:
                    scored = fn(part)
                    if len(scored) != len(part):
                        raise ValueError("scorer changed the number of rows")
                    for n in names:
                        out[n] = scored[n].to_numpy()
                    out["status"] = "Success"
                except Exception:  # the user's code may fail in any way
                    for n in names:
                        out[n] = None
                    out["status"] = failed
                yield out

    return df.mapInPandas(run, schema)


def property_udf(fn: Callable[[str], dict | None], returns: T.StructType | str) -> Callable[[Column], Column]:
    """Arrow UDF from a per-row property function; null where it fails or returns None."""
    schema = T.StructType.fromDDL(returns) if isinstance(returns, str) else returns
    names = [f.name for f in schema.fields]

    def one(value: str | None) -> dict | None:
        if value is None:
            return None
        try:
            return fn(value)
        except Exception:
            return None

    def run(values: pd.Series) -> pd.DataFrame:
        rows = [one(v) or {} for v in values]
        return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})

    # object columns let Arrow turn None into null for every type
    return F.pandas_udf(run, schema)


def with_properties(df: DataFrame, fn: Callable[[str], dict | None], returns: T.StructType | str,
                    c: str = "smiles") -> tuple[DataFrame, DataFrame]:
    """(valid rows with the property columns, one row with the numbers of valid and dropped rows)."""
    schema = T.StructType.fromDDL(returns) if isinstance(returns, str) else returns
    # written once, so that the function runs once per row
    scored = materialize(df.withColumn("_p", property_udf(fn, schema)(F.col(c))), "properties")
    bad = F.lit(True)
    for f in schema.fields:
        bad = bad & F.col(f"_p.{f.name}").isNull()
    counts = scored.agg(F.count_if(~bad).alias("n_valid"), F.count_if(bad).alias("n_dropped"))
    return scored.filter(~bad).select(*df.columns, "_p.*"), counts
