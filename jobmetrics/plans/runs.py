"""Incremental runs: find pending jobs, summarise them, commit results before the ledger."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.functions.text import scanned_path
from jobmetrics.operators.ranking import batch_numbers, running_total
from jobmetrics.plans.gpu import BUSY_PCT
from jobmetrics.plans.metadata import job_metadata, latest_rows, ran_long_enough
from jobmetrics.plans.summary import job_summary
from jobmetrics.session import configure, materialise, scratch_scope
from jobmetrics.sources import store as results
from jobmetrics.sources.index import has_files, log_manifest, read_index_lines, read_index_object
from jobmetrics.sources.logs import (
    CPU_COLUMNS,
    GPU_COLUMNS,
    map_columns,
    read_log_lines,
    tidy_cpu,
    tidy_gpu,
)
from jobmetrics.sources.scheduler import read_scheduler_csv

logger = logging.getLogger(__name__)

# Pending jobs are committed in splits of about this many log files, whose names the driver lists.
FILES_PER_SPLIT = 10_000
LINE_TYPE = "path_key string, pos struct<block:bigint,row:bigint>, line string"


@dataclass(frozen=True)
class RunConfig:
    scheduler_csv: str
    file_index: str
    store: str
    base_uri: str = ""  # folder or bucket the paths of the index are relative to
    output: str | None = None
    index_format: str = "object"  # or "lines"
    batch_size: int | None = None  # jobs per commit; all pending jobs at once if unset
    busy_pct: float = BUSY_PCT


def load_index(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    read = read_index_lines if cfg.index_format == "lines" else read_index_object
    return read(spark, cfg.file_index)


def job_states(jobs: DataFrame, index: DataFrame, done: DataFrame) -> DataFrame:
    """Every scheduler job with its files and its `state`: no_files, already_done or to_process."""
    marked = done.select("job_id", F.lit(True).alias("_done"))
    state = F.when(F.col("_indexed").isNull(), "no_files").when(F.col("_done"), "already_done")
    return (
        jobs.join(index.withColumn("_indexed", F.lit(True)), "job_id", "left")
        .join(marked, "job_id", "left")
        .withColumn("state", state.otherwise("to_process"))
        .drop("_indexed", "_done")
    )


def pending_jobs(jobs: DataFrame, index: DataFrame, done: DataFrame) -> DataFrame:
    """Jobs that have logs and are not done yet; failed ones come back by themselves."""
    return jobs.join(index, "job_id").join(done, "job_id", "left_anti")


def run_accounting(states: DataFrame) -> DataFrame:
    def jobs_in(state: str):
        return F.count_if(F.col("state") == state).alias(state)

    return states.agg(
        F.count(F.lit(1)).alias("total"), jobs_in("to_process"), jobs_in("no_files"), jobs_in("already_done")
    )


def plan_report(pending: DataFrame, done: DataFrame, batch_size: int, existing_runs: int) -> DataFrame:
    """One row saying what a run would do; reads no telemetry."""
    counts = pending.agg(F.count(F.lit(1)).alias("to_process"))
    return counts.select(
        "to_process",
        done.agg(F.count(F.lit(1))).scalar().alias("already_done"),
        F.lit(batch_size).alias("batch_size"),
        F.ceil(F.col("to_process") / F.lit(batch_size)).cast("bigint").alias("batches"),
        F.lit(existing_runs).alias("existing_runs"),
    )


def run_plan(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    """Dry run of `run`."""
    configure(spark)
    done = _done(spark, cfg)
    jobs = latest_rows(read_scheduler_csv(spark, cfg.scheduler_csv))
    pending = pending_jobs(jobs, load_index(spark, cfg), done)
    existing = len(results.run_ids(spark, results.summary_path(cfg.store)))
    return plan_report(pending, done, cfg.batch_size or 500, existing)


def run(spark: SparkSession, cfg: RunConfig) -> list[int]:
    """Process all pending jobs, then assemble the output. Returns the run ids written.

    A job that fails is recorded with its error and left pending; the others go on.
    """
    configure(spark)
    written = process_index(spark, cfg, load_index(spark, cfg))
    if cfg.output:
        results.assemble(spark, cfg.store, cfg.output)
    return written


def process_index(spark: SparkSession, cfg: RunConfig, index: DataFrame, raise_errors: bool = False) -> list[int]:
    """Process the pending jobs among those in `index`.

    A failed job leaves the others their turn; with `raise_errors` the first error follows them.
    """
    repair_ledger(spark, cfg.store)
    with scratch_scope(spark):
        jobs = latest_rows(read_scheduler_csv(spark, cfg.scheduler_csv))
        pending = pending_jobs(jobs, index, _done(spark, cfg))
        typed = materialise(job_metadata(pending, carry=["cpu", "gpu"]), "pending")
        typed = typed.join(results.logs_found_before(results.read_ledger(spark, cfg.store)), "job_id", "left")
        if typed.isEmpty():
            logger.info("nothing to process")
            return []
        numbered = split_by_files(typed, cfg.batch_size, FILES_PER_SPLIT)
        # Sorted by split, so that reading one skips the files and row groups of others.
        numbered = numbered.repartitionByRange("batch", "split").sortWithinPartitions("batch", "split")
        numbered = materialise(numbered, "batches")
        written, failures = [], []
        for row in numbered.select("batch", "split").distinct().orderBy("batch", "split").collect():
            mine = (F.col("batch") == row.batch) & (F.col("split") == row.split)
            _process_or_halve(spark, cfg, numbered.where(mine).drop("batch", "split"), written, failures)
        if failures and raise_errors:
            raise failures[0]
        return written


def split_by_files(jobs: DataFrame, batch_size: int | None, files: int) -> DataFrame:
    """Add `batch` (jobs in submission order, `batch_size` at a time) and within it `split`, which
    closes once it has `files` log files, so one split exceeds them by less than one job's."""
    batched = jobs.withColumn("batch", F.lit(0).cast("bigint"))
    if batch_size:
        batched = batch_numbers(jobs, [F.col("time_submit").isNull(), "time_submit"], "job_id", batch_size)
    logs = F.least(F.coalesce(F.size("cpu"), F.lit(0)), F.lit(1)) + F.coalesce(F.size("gpu"), F.lit(0))
    summed = running_total(batched, logs.cast("bigint"), ["job_id"], ["batch"], out="_files", total_out="_all_files")
    before = F.col("_files") - logs
    return summed.withColumn("split", F.floor(before / F.lit(files))).drop("_files", "_all_files")


def _process_or_halve(
    spark: SparkSession, cfg: RunConfig, batch: DataFrame, written: list[int], failures: list[Exception]
) -> None:
    """Process a batch; if it fails, its halves, so that only the jobs at fault stay failed.

    An error after the rows were written is not repeated: the next run repairs the ledger.
    """
    run_id = results.next_run_id(spark, cfg.store)
    try:
        with scratch_scope(spark):
            if process_batch(spark, cfg, batch, run_id) is not False:
                written.append(run_id)
        return
    except Exception as error:
        logger.exception("run %d failed", run_id)
        failure = error
    if results.summary_finished(spark, cfg.store, run_id):
        failures.append(failure)
        return
    size, middle = batch.agg(F.count(F.lit(1)), F.percentile_approx("job_id", 0.5)).first()
    if size > 1:
        for half in (F.col("job_id") <= middle, F.col("job_id") > middle):
            _process_or_halve(spark, cfg, batch.where(half), written, failures)
        return
    if _is_unreadable(failure) and _without_damaged_part(spark, cfg, batch, written, failure):
        return
    failures.append(failure)
    try:
        entry = batch.select("job_id", F.lit(results.FAILED).alias("status"), F.lit(str(failure)).alias("error"))
        results.append_ledger(entry, cfg.store, results.next_run_id(spark, cfg.store))
    except Exception:
        logger.exception("the failed job could not be recorded; it stays pending")


def _is_unreadable(error: Exception) -> bool:
    """Whether a file could not be read to its end."""
    return any(word in str(error) for word in ("FAILED_READ_FILE", "CANNOT_READ_FILE"))


def _without_damaged_part(spark: SparkSession, cfg: RunConfig, job: DataFrame, written: list[int], error: Exception) -> bool:
    """Process a job without its GPU logs, or its CPU logs, or both, whichever goes through first.

    The row has that part blank, and the ledger says why. A job without readable GPU logs is a CPU job.
    """
    for parts in (("gpu",), ("cpu",), ("gpu", "cpu")):
        rest = job.withColumns({p: F.lit(None).cast("array<string>") for p in parts})
        run_id = results.next_run_id(spark, cfg.store)
        try:
            with scratch_scope(spark):
                process_batch(spark, cfg, rest, run_id, note=f"{' and '.join(parts)} logs left out: {error}")
            written.append(run_id)
            return True
        except Exception:
            logger.info("run %d failed without %s logs", run_id, " and ".join(parts))
    return False


def process_batch(spark: SparkSession, cfg: RunConfig, batch: DataFrame, run_id: int, note: str | None = None) -> bool:
    """Summarise one batch of pending jobs: results first, then the ledger. False if there was nothing to do.

    Jobs that missed logs before, and of which no more are found now, are left as they are.
    """
    todo = batch.where(F.col("metadata_error").isNull() & ran_long_enough())
    counts = materialise(log_counts(spark, cfg, todo), "log-counts")
    if "found_before" in batch.columns:
        now = batch.join(counts.select("job_id", F.col("logs_found").alias("_now")), "job_id", "left")
        batch = materialise(now.where(~F.coalesce(F.col("_now") <= F.col("found_before"), F.lit(False))).drop("_now"), "batch")
        todo = batch.where(F.col("metadata_error").isNull() & ran_long_enough())
    if batch.isEmpty():
        return False
    if not todo.isEmpty():
        rows = summarise(spark, cfg, todo).join(counts.select("job_id", "logs_missing"), "job_id", "left")
        results.write_summary(rows.withColumn("logs_missing", F.coalesce("logs_missing", F.lit(0))), cfg.store, run_id)
    results.append_ledger(ledger_entries(batch, counts, note), cfg.store, run_id)
    return True


def ledger_entries(batch: DataFrame, counts: DataFrame, note: str | None = None) -> DataFrame:
    """(job_id, status, error, logs_found) of typed jobs; `counts` tells which of their logs were found."""
    missing = F.coalesce(F.col("logs_missing"), F.lit(0)) > 0
    state = (
        F.when(F.col("metadata_error").isNotNull(), results.FAILED)
        .when(~F.coalesce(ran_long_enough(), F.lit(False)), results.SKIPPED)
        .when(missing, results.MISSING)
        .otherwise(results.DONE)
    )
    told = F.when(state == results.MISSING, F.concat_ws(" ", "logs_missing", F.lit("logs were not found")))
    return batch.join(counts, "job_id", "left").select(
        "job_id", state.alias("status"), F.coalesce("metadata_error", told, F.lit(note).cast("string")).alias("error"),
        F.when(state == results.MISSING, F.col("logs_found")).alias("logs_found"),
    )


def log_counts(spark: SparkSession, cfg: RunConfig, jobs: DataFrame) -> DataFrame:
    """job_id, logs_found and logs_missing of the jobs with logs. Names are looked up, no log is read."""
    manifest = materialise(log_manifest(jobs, cfg.base_uri).select("job_id", "path_key", "uri"), "manifest")
    return count_logs(manifest, found_logs(spark, manifest))


def count_logs(manifest: DataFrame, found: DataFrame) -> DataFrame:
    met = manifest.join(found.select("path_key", F.lit(True).alias("_met")), "path_key", "left")
    return met.groupBy("job_id").agg(
        F.count("_met").alias("logs_found"), F.count_if(F.col("_met").isNull()).alias("logs_missing")
    )


def found_logs(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path_key of the files of a manifest that are there."""
    listed = [(name,) for name in scan_logs(spark, files).inputFiles()]
    return spark.createDataFrame(listed, "name string").select(scanned_path(F.col("name")).alias("path_key")).distinct()


def summarise(spark: SparkSession, cfg: RunConfig, jobs: DataFrame) -> DataFrame:
    """Wide rows of `jobs` (typed metadata with their `cpu` and `gpu` file lists)."""
    manifest = log_manifest(jobs, cfg.base_uri)
    gpu_files = materialise(
        manifest.where(F.col("kind") == "gpu").select("job_id", "path_key", "uri", "node_id", "names_node"),
        "gpu-manifest",
    )
    attributes = jobs.where(~F.col("cpus_error")).select("job_id", "cpus_per_node")
    cpu_files = materialise(
        manifest.where(F.col("kind") == "cpu").select("job_id", "path_key", "uri").join(attributes, "job_id"),
        "cpu-manifest",
    )
    gpu_records = map_columns(scan_logs(spark, gpu_files), gpu_files.drop("uri"), GPU_COLUMNS)
    cpu_records = map_columns(scan_logs(spark, cpu_files), cpu_files.drop("uri"), CPU_COLUMNS)
    cpu_ts = materialise(tidy_cpu(cpu_records), "cpu-samples")
    gpu_ts = tidy_gpu(gpu_records)
    described = jobs.withColumn("has_gpu_logs", has_files("gpu"))
    return job_summary(described, cpu_ts, gpu_ts, cfg.busy_pct)


def scan_logs(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Lines of exactly the files in the manifest of one split; one that is not there contributes nothing.

    The names are listed by the driver, FILES_PER_SPLIT and those of one job at most, and read
    through one glob, which skips missing names.
    """
    listed = [row.uri for row in files.select("uri").distinct().collect()]
    if not listed:
        return spark.createDataFrame([], LINE_TYPE)
    paths = _one_glob(listed)
    try:
        return read_log_lines(spark, paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no log of this batch was found at %s", paths[:500])
        return spark.createDataFrame([], LINE_TYPE)


def _one_glob(uris: list[str]) -> str:
    """Glob naming exactly `uris`, their common folder first, as a glob cannot open with a brace."""
    common = os.path.commonprefix(uris)
    folder = common[: common.rfind("/") + 1]
    names = ",".join(_glob_literal(u[len(folder) :]) for u in uris)
    return f"{_glob_literal(folder)}{{{names}}}"


def _glob_literal(path: str) -> str:
    return "".join(f"\\{c}" if c in "{}[]*?,\\" else c for c in path)


def repair_ledger(spark: SparkSession, store: str) -> None:
    """Record jobs whose rows were written by a run that ended before its ledger entries."""
    summaries = results.read_summaries(spark, store)
    if summaries is None:
        return
    with scratch_scope(spark):
        missing = materialise(
            results.unrecorded_jobs(results.read_ledger(spark, store), summaries).select(
                "job_id", F.lit(results.DONE).alias("status"), F.lit(None).cast("string").alias("error")
            ),
            "unrecorded",
        )
        if not missing.isEmpty():
            results.append_ledger(missing, store, results.next_run_id(spark, store))


def _done(spark: SparkSession, cfg: RunConfig) -> DataFrame:
    return results.done_jobs(results.read_ledger(spark, cfg.store), results.read_summaries(spark, cfg.store))
