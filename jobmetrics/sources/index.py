"""File index: which log files belong to which job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.functions.text import comparable_path, names_a_node, node_from_path

ENTRY_TYPE = "struct<cpu:array<string>,gpu:array<string>>"
LINE_TYPE = "job_id string, cpu array<string>, gpu array<string>"
# One `"<job>": {...` piece of the index object, its closing brace cut off.
ENTRY_TEXT = r'^[\s,{]*"((?:[^"\\]|\\.)*)"\s*:\s*(\{[\s\S]*)$'


def read_index_object(spark: SparkSession, path: str) -> DataFrame:
    """Index stored as one JSON object `{job: {"cpu": [...], "gpu": [...]}, ...}`.

    The file is cut at closing braces, which end each job's entry, so an index of any size is
    read by many tasks. A piece that is not an entry, such as a path with a brace, is an error.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("value").alias("piece"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("pos"),
    )
    return parse_index_pieces(pieces)


def parse_index_pieces(pieces: DataFrame) -> DataFrame:
    """(job_id, cpu, gpu) from brace-delimited `piece`s in `pos` order; the last entry of a job wins."""
    body = F.regexp_extract("piece", ENTRY_TEXT, 2)
    entry = F.from_json(F.concat(body, F.lit("}")), ENTRY_TYPE, {"mode": "FAILFAST"})
    bad = F.raise_error(F.concat(F.lit("not an index entry: "), F.col("piece"))).cast(ENTRY_TYPE)
    return (
        pieces.where(F.col("piece").rlike(r"[^\s,{}]"))
        .select(
            F.regexp_extract("piece", ENTRY_TEXT, 1).try_cast("bigint").alias("job_id"),
            F.when(F.col("piece").rlike(ENTRY_TEXT), entry).otherwise(bad).alias("entry"),
            "pos",
        )
        .groupBy("job_id")
        .agg(F.max_by("entry", "pos").alias("entry"))
        .select("job_id", "entry.cpu", "entry.gpu")
    )


def read_index_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Index stored as JSON lines `{"job_id": ..., "cpu": [...], "gpu": [...]}`."""
    rows = spark.read.schema(LINE_TYPE).json(path)
    landed = F.struct("_metadata.file_modification_time", "_metadata.file_path", F.monotonically_increasing_id().alias("row"))
    return typed_index(rows.select("*", landed.alias("_landed")), "_landed")


def typed_index(raw: DataFrame, order: str) -> DataFrame:
    """One row per job; of several entries of a job the last one along `order` counts."""
    entry = F.struct(F.col("cpu"), F.col("gpu"))
    return (
        raw.select(F.col("job_id").try_cast("bigint").alias("job_id"), entry.alias("entry"), order)
        .where(F.col("job_id").isNotNull())
        .groupBy("job_id")
        .agg(F.max_by("entry", order).alias("entry"))
        .select("job_id", "entry.cpu", "entry.gpu")
    )


def index_counts(index: DataFrame) -> DataFrame:
    """Jobs in the index, and how many have CPU and GPU files."""
    return index.agg(
        F.count(F.lit(1)).alias("jobs"),
        F.count_if(has_files("cpu")).alias("jobs_with_cpu"),
        F.count_if(has_files("gpu")).alias("jobs_with_gpu"),
    )


def has_files(kind: str):
    return F.coalesce(F.size(kind), F.lit(0)) > 0


def log_manifest(index: DataFrame, base_uri: str = "") -> DataFrame:
    """One row per log to read: every GPU file of a job, but only its first CPU file."""
    root = f"{base_uri.rstrip('/')}/" if base_uri else ""
    cpu_file = F.transform(F.slice("cpu", 1, 1), lambda p, i: _log("cpu", i, p))
    gpu_files = F.transform("gpu", lambda p, i: _log("gpu", i, p))
    none = F.array().cast("array<struct<kind:string,pos:int,path:string>>")
    logs = F.concat(F.coalesce(cpu_file, none), F.coalesce(gpu_files, none))
    exploded = index.select("job_id", F.explode(logs).alias("log")).select("job_id", "log.*")
    return exploded.select(
        "job_id",
        "kind",
        "pos",
        "path",
        F.concat(F.lit(root), F.col("path")).alias("uri"),
        comparable_path(F.concat(F.lit(root), F.col("path"))).alias("path_key"),
        node_from_path(F.col("path")).alias("node_id"),
        names_a_node(F.col("path")).alias("names_node"),
    )


def _log(kind: str, pos, path):
    return F.struct(F.lit(kind).alias("kind"), pos.alias("pos"), path.alias("path"))
