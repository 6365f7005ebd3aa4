"""Scalar projections. Every function takes and returns a Column and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class names, thresholds and the question put to the toxicity scorer.
SAFE, TOXIC, UNKNOWN = "Safe", "Toxic", "Unknown"
GOLD_TIER, BRONZE_TIER = "GOLD_PHYSICS", "BRONZE_AI"
STRONG_BELOW, WEAK_ABOVE = -40.0, -30.0
QED_HIGH_ABOVE, QED_LOW_BELOW = 0.6, 0.2
AFFINITY_WEIGHT, QED_WEIGHT = 0.7, 0.3
TOXICITY_PROMPT = (
    "<start_of_turn>user\n"
    "Instructions: Answer the following question about drug properties.\n"
    "Context: Clinical toxicity is a major cause of attrition in drug development. "
    "We need to identify if a molecule is toxic.\n"
    "Question: Given a drug SMILES string, predict whether it is (A) Non-toxic or (B) Toxic. "
    "Drug SMILES: {smiles}\n"
    "Answer:<end_of_turn>\n"
    "<start_of_turn>model\n"
)

_NUMERIC = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?)\s*$"
_BLANK = " \t\r\n\f\u000b"


def strip(c: Column) -> Column:
    """Remove blanks, tabs and line ends from both sides (Spark's own trim removes blanks only)."""
    return F.btrim(c, F.lit(_BLANK))


def nan_to_null(c: Column) -> Column:
    """Spark orders NaN above all numbers and spreads it through max and avg, so sources drop it."""
    return F.when(~F.isnan(c), c)


def molecule_hash(c: Column) -> Column:
    """Content identity: lower-case hex sha256 of the string; null stays null."""
    return F.sha2(c, 256)


def parse_global_id(c: Column) -> Column:
    """``gen_shard12_idx7`` → struct(shard_id, local_index); null when the text has another form."""
    pattern = r"^[^_]+_shard(\d+)_idx(\d+)$"
    shard = F.regexp_extract(c, pattern, 1).try_cast("int")
    index = F.regexp_extract(c, pattern, 2).try_cast("bigint")
    return F.when(
        shard.isNotNull() & index.isNotNull(),
        F.struct(shard.alias("shard_id"), index.alias("local_index")),
    )


def split_global_ids(df: DataFrame, c: str = "global_id") -> tuple[DataFrame, DataFrame]:
    """(rows with shard_id and local_index, rows whose id cannot be parsed)."""
    parsed = df.withColumn("_id", parse_global_id(F.col(c)))
    good = parsed.filter(F.col("_id").isNotNull()).select(*df.columns, "_id.shard_id", "_id.local_index")
    return good, parsed.filter(F.col("_id").isNull()).select(*df.columns)


def global_id(shard: Column, index: Column) -> Column:
    return F.concat(F.lit("gen_shard"), shard.cast("string"), F.lit("_idx"), index.cast("string"))


def shard_of(path: Column) -> Column:
    return F.regexp_extract(path, r"shard_(\d+)", 1).try_cast("int")


def batch_of(name: Column) -> Column:
    """``batch_12`` and plain ``12`` are the same batch."""
    return F.regexp_extract(name, r"(\d+)", 1).try_cast("bigint")


def to_number(c: Column) -> Column:
    """Coerce text to double; unparsable text and NaN become null."""
    text = c.cast("string")
    return F.when(text.rlike(_NUMERIC), strip(text).try_cast("double"))


def parse_verdict(text: Column) -> Column:
    """0 for a non-toxic answer, 1 for a toxic one, null when the text says neither."""
    low = F.lower(text)
    return (
        F.when(text.contains("(A)"), 0)
        .when(text.contains("(B)"), 1)
        .when(low.contains("non-toxic"), 0)
        .when(low.contains("toxic"), 1)
        .cast("int")
    )


def safety_class(c: Column) -> Column:
    value = c.try_cast("double")
    return F.when(value == 0, SAFE).when(value == 1, TOXIC).otherwise(UNKNOWN)


def build_prompt(c: Column, template: str = TOXICITY_PROMPT, slot: str = "{smiles}") -> Column:
    """The template with its slot filled from the column."""
    parts = template.split(slot)
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(c)
        if part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


def affinity_bin(c: Column) -> Column:
    return F.when(c < STRONG_BELOW, "strong").when(c > WEAK_ABOVE, "weak").when(c.isNotNull(), "medium")


def qed_bin(c: Column) -> Column:
    return F.when(c > QED_HIGH_ABOVE, "high").when(c < QED_LOW_BELOW, "low").when(c.isNotNull(), "medium")


def best_estimate(*by_fidelity: Column) -> Column:
    """First known value, highest fidelity first."""
    return F.coalesce(*[c for c in by_fidelity])


def confidence_tier(gold: Column) -> Column:
    return F.when(gold.isNotNull(), GOLD_TIER).otherwise(BRONZE_TIER)


def mpo_score(terms: Sequence[tuple[Column, float, bool]]) -> Column:
    """Weighted sum in which larger is better; each term is (column, weight, higher_is_better)."""
    total = F.lit(0.0)
    for column, weight, higher in terms:
        total = total + column * F.lit(weight if higher else -weight)
    return total


def default_mpo(affinity: Column, qed: Column) -> Column:
    """Reference weights; low affinity values and high QED are good."""
    return mpo_score([(affinity, AFFINITY_WEIGHT, False), (qed, QED_WEIGHT, True)])


def hash_uniform(key: Column, seed: str, part: int = 0) -> Column:
    """Uniform in (0, 1) taken from 32 bits of md5(seed‖key): stable under re-runs and re-partitioning."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), key.cast("string"))), 1 + 8 * part, 8)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)


def synthetic_label(docking: Column, qed: Column, key: Column, sigma: float = 1.5, seed: str = "0",
                    penalty: float = 2.0) -> Column:
    """Stand-in label: docking score + N(0, σ) + a penalty that grows as QED falls."""
    radius = F.sqrt(F.lit(-2.0) * F.log(hash_uniform(key, seed, 0)))
    noise = radius * F.cos(F.lit(2.0 * pi) * hash_uniform(key, seed, 1))
    return docking + noise * F.lit(sigma) + (F.lit(1.0) - qed) * F.lit(penalty)


def similarity_penalty(score: Column, max_sim: Column, alpha: float, lower_is_better: bool = True) -> Column:
    """Make candidates close to the previous elite set look worse."""
    shift = F.coalesce(max_sim, F.lit(0.0)) * F.lit(alpha)
    return score + shift if lower_is_better else score - shift


def split_uri(c: Column) -> Column:
    """scheme://bucket/key → struct(bucket, key)."""
    pattern = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]+)/(.*)$"
    return F.when(
        c.rlike(pattern),
        F.struct(F.regexp_extract(c, pattern, 1).alias("bucket"), F.regexp_extract(c, pattern, 2).alias("key")),
    )


def stamp(df: DataFrame, run_id: str, created_at: str | None = None, model_version: str | None = None) -> DataFrame:
    """Add run metadata; the time is passed in so that every row of a run carries the same one."""
    out = df.withColumn("run_id", F.lit(run_id))
    if created_at is not None:
        out = out.withColumn("created_at", F.lit(created_at).cast("timestamp"))
    if model_version is not None:
        out = out.withColumn("model_version", F.lit(model_version))
    return out


def with_label(df: DataFrame) -> DataFrame:
    """A frame with its target in ``label``: kept if there, else final_deltag, else delta_g."""
    for name in ("label", "final_deltag", "delta_g"):
        if name in df.columns:
            return df if name == "label" else df.withColumn("label", F.col(name))
    raise ValueError("no label, final_deltag or delta_g column")
