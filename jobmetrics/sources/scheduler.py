"""Scheduler metadata CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.sources.logs import map_records, read_log_lines, stage_records

SCHEDULER_COLUMNS = (
    "id_job", "time_submit", "time_start", "time_end", "nodes_alloc", "cpus_req", "tres_alloc",
    "partition", "exit_code", "id_user",
)


def read_scheduler_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scheduler rows with every column as text, matched by the header of each file; absent columns
    and empty cells are NULL. Files may order their columns differently."""
    records = stage_records(read_log_lines(spark, path), SCHEDULER_COLUMNS)
    rows = map_records(records, records.select("path_key").distinct(), SCHEDULER_COLUMNS, keep_wide=True)
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in SCHEDULER_COLUMNS])
