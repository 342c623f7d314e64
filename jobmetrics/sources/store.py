"""Result store: summaries and the job ledger, one folder per run id."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.session import child_names, path_exists, replace_path

LEDGER_SCHEMA = "job_id bigint, status string, error string, logs_found bigint, run_id bigint"
# A job some of whose logs were not found has its row, but comes back once another log is there.
DONE, SKIPPED, FAILED, MISSING = "done", "skipped", "failed", "missing_logs"
RUN_PREFIX = "run_id="
FINISHED = "_SUCCESS"  # left by Spark's file committer


def summary_path(store: str) -> str:
    return f"{store.rstrip('/')}/summary"


def ledger_path(store: str) -> str:
    return f"{store.rstrip('/')}/ledger"


def write_summary(summary: DataFrame, store: str, run_id: int) -> None:
    """Write one run's rows; a run id is never overwritten."""
    target = f"{summary_path(store)}/{RUN_PREFIX}{run_id}"
    summary.write.mode("errorifexists").option("compression", "zstd").parquet(target)


def summary_finished(spark: SparkSession, store: str, run_id: int) -> bool:
    return path_exists(spark, f"{summary_path(store)}/{RUN_PREFIX}{run_id}/{FINISHED}")


def append_ledger(entries: DataFrame, store: str, run_id: int) -> None:
    """Record (job_id, status, error, logs_found) of a run, after its summary has been written."""
    target = f"{ledger_path(store)}/{RUN_PREFIX}{run_id}"
    found = F.col("logs_found") if "logs_found" in entries.columns else F.lit(None).cast("bigint").alias("logs_found")
    entries.select("job_id", "status", "error", found).write.mode("append").parquet(target)


def read_summaries(spark: SparkSession, store: str) -> DataFrame | None:
    """All finished runs' rows united by column name, or None before the first one.

    A run folder whose write did not finish is left out; one whose files are damaged fails the read, so no row is lost silently.
    """
    root = summary_path(store)
    folders = [f"{root}/{RUN_PREFIX}{n}" for n in run_ids(spark, root)]
    finished = [f for f in folders if path_exists(spark, f"{f}/{FINISHED}")]
    if not finished:
        return None
    reader = spark.read.option("mergeSchema", True)
    return reader.option("basePath", root).parquet(*finished)


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    if not path_exists(spark, ledger_path(store)):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path(store))


def run_ids(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in child_names(spark, path) if n.startswith(RUN_PREFIX)]
    return sorted(int(n.removeprefix(RUN_PREFIX)) for n in names)


def next_run_id(spark: SparkSession, store: str) -> int:
    """One past the highest run id used by any summary or ledger entry."""
    used = run_ids(spark, summary_path(store)) + run_ids(spark, ledger_path(store))
    return max(used, default=0) + 1


def complete_rows(summaries: DataFrame) -> DataFrame:
    """Rows made from all of their job's logs."""
    if "logs_missing" not in summaries.columns:
        return summaries
    return summaries.where(F.coalesce(F.col("logs_missing"), F.lit(0)) == 0)


def done_jobs(ledger: DataFrame, summaries: DataFrame | None = None) -> DataFrame:
    """Distinct ids of jobs not to be processed again.

    A job with a complete summary row counts even if its ledger entry is missing, so a crash between
    the two writes neither loses nor repeats it. Failed jobs and those that miss logs are not done.
    """
    ids = ledger.where(F.col("status").isin(DONE, SKIPPED)).select("job_id")
    if summaries is not None:
        ids = ids.union(complete_rows(summaries).select("job_id"))
    return ids.distinct()


def logs_found_before(ledger: DataFrame) -> DataFrame:
    """How many logs were found of the jobs that missed some (`found_before`)."""
    missing = ledger.where(F.col("status") == MISSING)
    return missing.groupBy("job_id").agg(F.max("logs_found").alias("found_before"))


def unrecorded_jobs(ledger: DataFrame, summaries: DataFrame) -> DataFrame:
    """Jobs with a summary row that the ledger does not list as done."""
    recorded = ledger.where(F.col("status").isin(DONE, SKIPPED)).select("job_id")
    return complete_rows(summaries).select("job_id").distinct().join(recorded, "job_id", "left_anti")


def latest_summaries(summaries: DataFrame) -> DataFrame:
    """One row per job: its complete one, else the one of the last run. Only incomplete rows are compared."""
    if "logs_missing" not in summaries.columns:
        return summaries
    complete = complete_rows(summaries)
    partial = summaries.where(F.col("logs_missing") > 0).join(complete.select("job_id"), "job_id", "left_anti")
    last = partial.groupBy("job_id").agg(F.max("run_id").alias("run_id"))
    return complete.unionByName(partial.join(last, ["job_id", "run_id"], "left_semi")).drop("logs_missing")


def assemble(spark: SparkSession, store: str, output: str) -> bool:
    """Write all jobs' rows as one compressed dataset; False when there is nothing yet.

    The rows are written beside the old output, which stays readable until they are complete.
    """
    summaries = read_summaries(spark, store)
    if summaries is None:
        return False
    staged = f"{output.rstrip('/')}-{uuid.uuid4().hex}"
    latest_summaries(summaries).drop("run_id").write.option("compression", "zstd").parquet(staged)
    replace_path(spark, staged, output)
    return True
