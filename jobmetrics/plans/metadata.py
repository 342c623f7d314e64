"""Scheduler metadata: one typed row per job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics.functions.clock import from_epoch
from jobmetrics.functions.text import allocated_gpus, gpu_type, is_unparseable, to_integer, to_number, to_text

# Fixed value: jobs that ran for at most this many seconds are skipped.
SHORTEST_RUNTIME_S = 10

METADATA_COLUMNS = (
    "start_timestamp", "end_timestamp", "runtime_seconds", "node_hours", "gpu_hours", "num_nodes",
    "num_alloc_gpus", "gpu_type", "user_id", "queue_name", "exit_code", "cpus_req", "project_id",
    "domain", "subdomain",
)


def latest_rows(raw: DataFrame) -> DataFrame:
    """One row per `id_job`: the one submitted last. Partials come before the shuffle; rows hold text,
    so Spark aggregates them by sorting."""
    row = F.struct(to_number(F.col("time_submit")).alias("_submitted"), *raw.columns)
    return (
        raw.where(to_integer(F.col("id_job")).isNotNull())
        .groupBy(to_integer(F.col("id_job")).alias("job_id"))
        .agg(F.max(row).alias("_row"))
        .select("job_id", *[F.col(f"_row.{c}").alias(c) for c in raw.columns])
    )


def job_metadata(raw: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Typed metadata of scheduler rows read as text.

    Adds `metadata_error`, the reason why a row cannot be used, `cpus_error`, which only spoils
    the CPU part, and `cpus_per_node` for normalising CPU samples.
    """
    start, end = to_number(F.col("time_start")), to_number(F.col("time_end"))
    runtime = F.coalesce((end - start).try_cast("bigint"), F.lit(0).cast("bigint"))
    typed = raw.select(
        "job_id",
        *(carry or []),
        from_epoch(start).alias("start_timestamp"),
        from_epoch(end).alias("end_timestamp"),
        runtime.alias("runtime_seconds"),
        to_number(F.col("nodes_alloc")).alias("num_nodes"),
        allocated_gpus(F.col("tres_alloc")).alias("num_alloc_gpus"),
        gpu_type(F.col("tres_alloc")).alias("gpu_type"),
        to_text(F.col("id_user")).alias("user_id"),
        to_text(F.col("partition")).alias("queue_name"),
        to_text(F.col("exit_code")).alias("exit_code"),
        to_number(F.col("cpus_req")).alias("cpus_req"),
        metadata_error().alias("metadata_error"),
        is_unparseable(F.col("cpus_req")).alias("cpus_error"),
        to_number(F.col("time_submit")).alias("time_submit"),
    )
    return add_resource_hours(typed).withColumn("cpus_per_node", cpus_per_node())


def add_resource_hours(jobs: DataFrame) -> DataFrame:
    """Node and GPU hours; GPUs are counted per node, and a job without runtime has neither."""
    ran = F.col("runtime_seconds") > 0
    node_seconds = F.col("num_nodes") * F.col("runtime_seconds")
    missing = F.lit(None).cast("string")
    return jobs.withColumns(
        {
            "node_hours": F.when(ran, node_seconds / 3600.0),
            "gpu_hours": F.when(ran, node_seconds * F.col("num_alloc_gpus") / 3600.0),
            "project_id": missing,
            "domain": missing,
            "subdomain": missing,
        }
    )


def metadata_error():
    checks = [
        F.when(is_unparseable(F.col(c)), F.lit(f"{c} is not a number"))
        for c in ("time_start", "time_end", "nodes_alloc")
    ]
    return F.coalesce(*checks)


def cpus_per_node(cpus: str = "cpus_req", nodes: str = "num_nodes"):
    """CPUs requested per node, NULL when CPU samples have to stay as they are."""
    node_count = F.when(F.col(nodes) <= 0, F.lit(1.0)).otherwise(F.col(nodes))
    return F.when(F.col(cpus) > 0, F.col(cpus) / node_count)


def normalised(raw_util, per_node):
    """CPU utilisation per requested CPU, or the raw value when the request is unknown."""
    return F.when(per_node > 0, raw_util / per_node).otherwise(raw_util)


def ran_long_enough():
    return F.col("runtime_seconds") > SHORTEST_RUNTIME_S
