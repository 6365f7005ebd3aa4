"""Table schemas in one place."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


STR, DBL, INT, LNG, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType()

MANIFEST = _schema(
    ("global_id", STR, False),
    ("smiles", STR, False),
    ("shard_id", INT, False),
    ("local_index", LNG, False),
    ("sdf_path", STR, True),
)
REGISTRY = _schema(
    ("molecule_hash", STR, False),
    ("smiles", STR, False),
    ("global_id", STR, True),
    ("sdf_path", STR, True),
    ("run_id", STR, False),
    ("created_at", TS, True),
)
SCREENING = _schema(
    ("molecule_hash", STR, False),
    ("docking_score", DBL, True),
    ("qed_score", DBL, True),
    ("sa_score", DBL, True),
    ("logp", DBL, True),
    ("mw", DBL, True),
    ("toxicity_label", INT, True),
    ("final_score", DBL, True),
    ("score_method", STR, True),
)
GOLD = _schema(
    ("molecule_hash", STR, False),
    ("smiles", STR, True),
    ("delta_g", DBL, True),
    ("uncertainty", DBL, True),
    ("run_id", STR, True),
    ("trajectory_uri", STR, True),
)
SILVER = _schema(
    ("molecule_hash", STR, False),
    ("smiles", STR, True),
    ("cnn_score", DBL, True),
    ("affinity", DBL, True),
    ("run_id", STR, True),
    ("pose_uri", STR, True),
)
BRONZE = _schema(
    ("molecule_hash", STR, False),
    ("smiles", STR, True),
    ("predicted_delta_g", DBL, True),
    ("model_version", STR, True),
    ("run_id", STR, True),
)
PROPERTY_SCORES = _schema(
    ("smiles", STR, True),
    ("qed", DBL, True),
    ("sa_score", DBL, True),
    ("logp", DBL, True),
    ("mw", DBL, True),
)
TOXICITY_SCORES = _schema(("smiles", STR, True), ("toxicity", INT, True))
DOCKING_SCORES = _schema(("smiles", STR, True), ("docking_score", DBL, True), ("status", STR, True))
LABEL_RESULTS = _schema(("SMILES", STR, True), ("DeltaG", STR, True), ("Status", STR, True))
BATCH_MAP = _schema(("batch_id", LNG, False), ("mol_index", STR, False), ("molecule_hash", STR, False))
