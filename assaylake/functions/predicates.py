"""Boolean columns used in selections and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_pool(tox: str = "toxicity_label", qed: str = "qed_score", sa: str = "sa_score",
               min_qed: float = 0.4, max_sa: float = 6.0) -> Column:
    """Safe, drug-like enough and synthesisable: the pool labels are chosen from."""
    return (F.col(tox) == 0) & (F.col(qed) > min_qed) & (F.col(sa) < max_sa)


def elite_filter(qed: str = "qed_score", sa: str = "sa_score", max_sa: float = 4.0, min_qed: float = 0.5) -> Column:
    return (F.col(sa) < max_sa) & (F.col(qed) > min_qed)


def scored_in_run(run_id: str, run: str = "run_id", score: str = "final_score") -> Column:
    return (F.col(run) == run_id) & F.col(score).isNotNull()


def labelled(c: str = "delta_g") -> Column:
    return F.col(c).isNotNull() & ~F.isnan(F.col(c))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def drug_like(mw: str = "mw", logp: str = "logp", sa: str = "sa_score", max_mw: float = 500.0,
              logp_range: tuple[float, float] = (2.0, 5.0), max_sa: float = 4.0) -> Column:
    return (F.col(mw) < max_mw) & F.col(logp).between(*logp_range) & (F.col(sa) < max_sa)


def hit(c: str, threshold: float) -> Column:
    """Lower scores are better; a missing score is no hit."""
    return F.coalesce(F.col(c) < threshold, F.lit(False))


def novel(max_sim: str = "max_sim", limit: float = 0.7) -> Column:
    """Not near the previous elite set; a row without any neighbour is novel."""
    return F.coalesce(F.col(max_sim) <= limit, F.lit(True))
