"""Readers for the files generators and scorers leave behind."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions import scalars as S
from assaylake.session import small_side


def read_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """(path, line_no, first_filled, line): 0-based line numbers for files of any size.

    Files stay splittable. A row's place in its split comes from its task-local row id, and the
    splits of a file are put in order by their byte offsets; only the per-split line counts (one
    row per 128 MB or so) are aggregated. ``first_filled`` is the number of the file's first line
    that is not blank.
    """
    raw = spark.read.option("lineSep", "\n").text(path_glob).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("id"),
    )
    filled = F.length(S.strip(F.col("line"))) > 0
    splits = raw.groupBy("path", "start").agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"), F.min(F.when(filled, F.col("id"))).alias("filled_id"))
    by_file = Window.partitionBy("path")
    before = F.coalesce(F.sum("n").over(by_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.withColumn("before", before).withColumn(
        "first_filled", F.min(F.col("filled_id") - F.col("first_id") + F.col("before")).over(by_file))
    splits = small_side(splits.select("path", "start", "first_id", "before", "first_filled"))
    return raw.join(splits, ["path", "start"]).select(
        "path", (F.col("id") - F.col("first_id") + F.col("before")).alias("line_no"), "first_filled", "line")


def file_lines(spark: SparkSession, path_glob: str) -> DataFrame:
    """(path, line_index, line) of all filled lines, counted from the first filled line of each file.

    A file is read as if its outer white space were cut off; blank lines inside keep their number.
    """
    lines = read_lines(spark, path_glob)
    return lines.filter(F.length(S.strip(F.col("line"))) > 0).select(
        "path", (F.col("line_no") - F.col("first_filled")).alias("line_index"), S.strip(F.col("line")).alias("line"))


def read_shard_lines(spark: SparkSession, path_glob: str) -> tuple[DataFrame, DataFrame]:
    """((shard_id, local_index, smiles), one row with the number of lines under unreadable shard names)."""
    lines = file_lines(spark, path_glob).withColumn("shard_id", S.shard_of(F.col("path")))
    good = lines.filter(F.col("shard_id").isNotNull()).select(
        "shard_id", F.col("line_index").alias("local_index"), F.col("line").alias("smiles"))
    skipped = lines.filter(F.col("shard_id").isNull()).agg(
        F.count(F.lit(1)).alias("n_lines_skipped"), F.count_distinct("path").alias("n_files_skipped"))
    return good, skipped


def build_manifest(lines: DataFrame, base: str) -> DataFrame:
    """Adds global_id and the path of the structure file."""
    shard, index = F.col("shard_id").cast("string"), F.col("local_index").cast("string")
    return lines.select(
        S.global_id(F.col("shard_id"), F.col("local_index")).alias("global_id"),
        "smiles", "shard_id", "local_index",
        F.concat(F.lit(f"{base.rstrip('/')}/shard_"), shard, F.lit("/SDF/"), index, F.lit(".sdf")).alias("sdf_path"))


def _present(spark: SparkSession, globs: str | Sequence[str]) -> list[str]:
    """The globs that match a file."""
    out = []
    for glob in [globs] if isinstance(globs, str) else globs:
        try:
            spark.read.text(glob)
            out.append(glob)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return out


def _filled_lines(spark: SparkSession, globs: Sequence[str]) -> DataFrame | None:
    """(path, start, id, line) of the lines that are not blank; a file that cannot be read gives none. None if a glob matches no file."""
    try:
        files = spark.read.option("ignoreCorruptFiles", "true").text(list(globs))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    lines = files.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    return lines.filter(F.trim("line") != "")


def _first_lines(lines: DataFrame) -> DataFrame:
    """(path, top, header): id and text of the line that the first split of each file begins with."""
    return lines.filter(F.col("start") == 0).groupBy("path").agg(F.min("id").alias("top"), F.min_by("line", "id").alias("header"))


def read_score_shards(spark: SparkSession, path_globs: str | list[str], schema: T.StructType,
                      mixed_headers: bool = True, path_col: str | None = None) -> DataFrame:
    """Many CSV shards with headers as one frame, columns matched by name.

    All files are one scan, whatever their headers: every line is parsed by place, as many places as the widest
    header has, and meets its file's row of the header dictionary, which says in which place each wanted column
    stands. A column a file lacks is null, an unreadable file is skipped (``skipped_files`` tells which), no file at
    all gives an empty frame, NaN becomes null. With ``mixed_headers=False`` every file of a glob must have the header of the
    first one: that saves the pass over the first lines, and a file with another header or one that
    cannot be read is an error. ``path_col`` names a column for the path of a row's file.
    """
    globs = [path_globs] if isinstance(path_globs, str) and mixed_headers else _present(spark, path_globs)
    lines = _filled_lines(spark, globs) if mixed_headers and globs else None
    if not globs or (mixed_headers and lines is None):
        return spark.createDataFrame([], T.StructType([*schema.fields, *([T.StructField(path_col, T.StringType())] if path_col else [])]))
    if not mixed_headers:
        out = None
        for glob in globs:
            part = _one_header(spark, glob, schema, path_col)
            out = part if out is None else out.unionByName(part)
        return out
    tops = small_side(_first_lines(lines))
    width = tops.agg(F.max(F.size(F.split("header", ",")))).first()[0] or 1
    places = [f"c{i}" for i in range(width)]
    parsed = lambda c: F.from_csv(c, ", ".join(f"{p} string" for p in places), {"escape": '"'})
    names = F.transform(F.array(*[F.col(f"h.{p}") for p in places]), lambda n: F.lower(F.trim(n)))
    at = [F.array_position("names", f.name.lower()).cast("int").alias(f"at{i}") for i, f in enumerate(schema.fields)]
    dictionary = small_side(tops.select("path", "top", parsed("header").alias("h")).select("path", "top", names.alias("names")).select("path", "top", *at))
    # parsed before the join, so once a line however many columns are wanted
    rows = lines.select("path", "id", parsed("line").alias("f")).join(dictionary, "path").filter(F.col("id") != F.col("top"))
    fields = F.array(*[F.col(f"f.{p}") for p in places])
    values = rows.select("path", *[F.get(fields, F.col(f"at{i}") - 1).alias(f.name) for i, f in enumerate(schema.fields)])
    return values.select(*[_typed(f.name, f) for f in schema.fields], *([F.col("path").alias(path_col)] if path_col else []))


def skipped_files(spark: SparkSession, path_globs: str | list[str]) -> DataFrame:
    """(path, length) of the files that hold bytes of which no line could be read, in place of an error for each."""
    globs = _present(spark, path_globs)
    if not globs:
        return spark.createDataFrame([], "path string, length bigint")
    files = spark.read.format("binaryFile").load(globs).select(F.col("_metadata.file_path").alias("path"), "length")
    return files.filter("length > 0").join(_first_lines(_filled_lines(spark, globs)).select("path"), "path", "left_anti")


def _one_header(spark: SparkSession, glob: str, schema: T.StructType, path_col: str | None) -> DataFrame:
    """Files of one header, which is read from one of them and checked in all."""
    first = spark.read.text(glob).filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")).limit(1).collect()
    cols = [w.strip() for w in first[0]["value"].split(",")] if first else []
    text = T.StructType([T.StructField(c, T.StringType()) for c in cols])
    part = spark.read.schema(text).option("header", "true").option("enforceSchema", "false").option("escape", '"').csv(glob)
    by_lower = {c.lower(): c for c in cols}
    return part.select(*[_typed(by_lower.get(f.name.lower()), f) for f in schema.fields],
                       *([F.col("_metadata.file_path").alias(path_col)] if path_col else []))


def _typed(source: str | None, field: T.StructField) -> Column:
    if source is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    c = F.col(f"`{source}`")
    if isinstance(field.dataType, T.DoubleType):
        return S.to_number(c).alias(field.name)
    if isinstance(field.dataType, (T.IntegerType, T.LongType)):
        return S.to_number(c).try_cast(field.dataType).alias(field.name)
    return c.try_cast(field.dataType).alias(field.name)


def read_molecules(spark: SparkSession, path: str, column: str = "smiles") -> DataFrame:
    """(row_no, smiles) from a CSV with that column, or from plain lines.

    The first line decides: if it is a header with the column, that column; if it only mentions the
    name, the second field of the other lines; else the first field of every line.
    """
    head = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0).limit(1).collect()
    if not head:
        return spark.createDataFrame([], "row_no bigint, smiles string")
    first = head[0]["value"]
    fields = [f.strip() for f in first.split(",")]
    lines = read_lines(spark, path)
    if column in fields:
        names = T.StructType([T.StructField(f or f"_c{i}", T.StringType()) for i, f in enumerate(fields)])
        value = F.from_csv("line", names.toDDL(), {"escape": '"'})[column]
        out = lines.filter(F.col("line_no") > 0).select(F.col("line_no").alias("row_no"), S.strip(value).alias("smiles"))
        return out.filter(F.length("smiles") > 0)
    text = S.strip(F.col("line"))
    parts = F.split(text, ",")
    if column in first.lower():
        lines = lines.filter(F.col("line_no") > 0)
        value = F.when(F.size(parts) > 1, F.get(parts, F.lit(1))).otherwise(text)
    else:
        value = F.get(parts, F.lit(0))
    return lines.filter(F.length(text) > 0).select(F.col("line_no").alias("row_no"), value.alias("smiles"))


def read_keyed_results(spark: SparkSession, path_glob: str, pattern: str = r"batch_(\d+)[^/]*") -> DataFrame:
    """Label results whose path names the batch: (batch_id, mol_index, delta_g, status).

    Columns are matched by name, whatever their order in a file; ``SMILES`` holds the molecule's place
    in its batch. A missing value is null with status as given; a missing status is ``Unknown``.
    """
    schema = T.StructType.fromDDL("SMILES string, DeltaG double, Status string")
    rows = read_score_shards(spark, path_glob, schema, path_col="_path")
    return rows.select(
        F.regexp_extract(F.col("_path"), pattern, 1).try_cast("bigint").alias("batch_id"),
        F.col("SMILES").alias("mol_index"),
        F.col("DeltaG").alias("delta_g"),
        F.coalesce("Status", F.lit("Unknown")).alias("status"),
    )


def read_result_json(spark: SparkSession, path_glob: str, pattern: str = r"^(.*/(?:[^/]*=)?mol_[^/]+)/") -> DataFrame:
    """Validated results: hash, ΔG, uncertainty and the run folder found from the file's path."""
    schema = "smiles string, delta_g double, uncertainty double"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path_glob)
    return rows.select(
        S.molecule_hash(F.col("smiles")).alias("molecule_hash"), "smiles",
        S.nan_to_null(F.col("delta_g")).alias("delta_g"), S.nan_to_null(F.col("uncertainty")).alias("uncertainty"),
        F.concat(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1), F.lit("/run/")).alias("trajectory_uri"),
    )


def conform(df: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, add absent columns as null, cast and put in order."""
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def resolve_latest_path(listing: DataFrame, shards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shard_id, sdf_path) of the newest run folder that holds structures; shards without any.

    ``listing``: shard_id, run_config, has_sdf, path.
    """
    latest = listing.filter(F.col("has_sdf")).groupBy("shard_id").agg(
        F.max_by(F.concat("path", F.lit("SDF/")), "run_config").alias("sdf_path"))
    wanted = shards.select("shard_id").distinct()
    return wanted.join(latest, "shard_id"), wanted.join(latest.select("shard_id"), "shard_id", "left_anti")


def list_structures(spark: SparkSession, path_glob: str) -> DataFrame:
    """A listing for ``resolve_latest_path`` from file names alone; file contents are not read."""
    files = spark.read.format("binaryFile").load(path_glob).select("path")
    folder = F.regexp_extract("path", r"^(.*run_config[^/]*/)", 1)
    return files.select(
        S.shard_of(F.col("path")).alias("shard_id"), F.regexp_extract("path", r"(run_config[^/]*)/", 1).alias("run_config"),
        folder.alias("path"), F.col("path").contains("/SDF/").alias("has_sdf"),
    ).groupBy("shard_id", "run_config", "path").agg(F.max("has_sdf").alias("has_sdf"))
