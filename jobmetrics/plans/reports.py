"""Overview reports over finished job rows. Each report is a small table, sorted for display."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from jobmetrics.functions.text import strip, to_number
from jobmetrics.operators.distribution import (
    ecdf,
    histogram,
    log_histogram_density,
    table_quantiles,
)
from jobmetrics.session import materialise, scratch_scope

logger = logging.getLogger(__name__)

# Labels and bin counts of the reports.
DAY_LABELS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
NODE_BINS = 50
DURATION_BINS = 80
RUNTIME_EDGES = 60
SHORTEST_HOURS = 1e-3
ROLLING_DAYS = 7
UNKNOWN_PARTITION = "unknown"

DIMENSIONS = ("month", "day_of_week", "date", "partition", "is_gpu_job", "is_success")
HOURS = ("node_hours", "gpu_hours")


def job_overview(summary: DataFrame) -> DataFrame:
    """Report columns of job rows: date parts, partition, runtime hours, success, job type.

    A column whose source is absent is absent here too, and so are the reports that need it.
    """
    partition = "partition" if "partition" in summary.columns else "queue_name"
    has_gpus = F.lit(False)
    if "num_alloc_gpus" in summary.columns:
        has_gpus = F.coalesce(F.col("num_alloc_gpus") > 0, F.lit(False))
    is_gpu = F.col("is_gpu_job") | has_gpus if "is_gpu_job" in summary.columns else has_gpus
    sources = {
        "job_id": ("job_id", F.col("job_id")),
        "start_timestamp": ("start_timestamp", F.col("start_timestamp")),
        "month": ("start_timestamp", F.date_format("start_timestamp", "yyyy-MM")),
        "day_of_week": ("start_timestamp", F.weekday("start_timestamp")),
        "date": ("start_timestamp", F.to_date("start_timestamp")),
        "partition": (partition, F.coalesce(F.lower(strip(F.col(partition))), F.lit(UNKNOWN_PARTITION))),
        "is_gpu_job": ("is_gpu_job" if "is_gpu_job" in summary.columns else "num_alloc_gpus", is_gpu),
        "runtime_hours": ("runtime_seconds", F.col("runtime_seconds") / F.lit(3600.0)),
        "is_success": ("exit_code", F.coalesce(to_number(F.col("exit_code")), F.lit(0.0)) == 0),
        "num_nodes": ("num_nodes", F.col("num_nodes")),
        "node_hours": ("node_hours", F.col("node_hours")),
        "gpu_hours": ("gpu_hours", F.col("gpu_hours")),
    }
    return summary.select(*[value.alias(name) for name, (needed, value) in sources.items() if needed in summary.columns])


def job_counts(ov: DataFrame) -> DataFrame:
    """`jobs` and summed hours per combination of the dimensions that reports count by.

    Reports that only count and sum take this in place of the overview, from which it is one hash
    aggregation: it has a row per day and partition, however many jobs there are.
    """
    dimensions = [c for c in DIMENSIONS if c in ov.columns]
    hours = [F.sum(c).alias(c) for c in HOURS if c in ov.columns]
    return ov.groupBy(*dimensions).agg(F.count(F.lit(1)).alias("jobs"), *hours)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of `job_counts`, or of the overview as one job each."""
    return rows if "jobs" in rows.columns else rows.withColumn("jobs", F.lit(1).cast("bigint"))


def _jobs(of: Column | None = None) -> Column:
    jobs = F.col("jobs") if of is None else F.when(of, F.col("jobs")).otherwise(0)
    return F.sum(jobs)


def jobs_by_month(ov: DataFrame) -> DataFrame:
    return _counted(ov).groupBy("month").agg(_jobs().alias("count")).orderBy("month")


def jobs_by_weekday(ov: DataFrame) -> DataFrame:
    """All seven days, Monday first; days without jobs count 0."""
    counts = _counted(ov).groupBy("day_of_week").agg(_jobs().alias("count"))
    labels = F.array(*[F.lit(x) for x in DAY_LABELS])
    days = ov.sparkSession.range(len(DAY_LABELS)).select(F.col("id").cast("int").alias("day_of_week"))
    return (
        days.join(counts, "day_of_week", "left")
        .select(
            "day_of_week",
            F.get(labels, F.col("day_of_week")).alias("label"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("day_of_week")
    )


def nodes_stats(ov: DataFrame) -> DataFrame:
    """Job count, share of one-node jobs (jobs without a node count are not), median, p90, p99."""
    one_node = F.avg(F.when(F.col("num_nodes") == 1, 1.0).otherwise(0.0)) * 100
    totals = ov.agg(F.count(F.lit(1)).alias("total"), one_node.alias("one_node_pct"))
    points = table_quantiles(ov, "num_nodes", {"median": 0.5, "p90": 0.9, "p99": 0.99})
    packed = points.select(F.struct("median", "p90", "p99")).scalar()
    return totals.withColumn("_q", packed).select("total", "one_node_pct", "_q.median", "_q.p90", "_q.p99")


def nodes_histogram(ov: DataFrame) -> DataFrame:
    return histogram(ov, "num_nodes", NODE_BINS).orderBy("bin")


def nodes_cdf(ov: DataFrame) -> DataFrame:
    """Zero-based distribution of node counts: shares of all jobs, also those without a node count,
    that are below the first and the last job per value."""
    return ecdf(ov, "num_nodes", of_all=True).select("num_nodes", "count", "cdf_first", "cdf_last").orderBy("num_nodes")


def nodes_capped(ov: DataFrame) -> DataFrame:
    """Jobs per node count up to the 99th percentile (whole number, plus one), with the
    distribution within the cap and the p50 and p95 of all jobs."""
    used = ov.where(F.col("num_nodes") > 0)
    points = table_quantiles(used, "num_nodes", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    packed = points.select(
        F.struct("p50", "p95", (F.col("p99").cast("bigint") + 1).alias("cap"))
    ).scalar()
    capped = used.where(F.col("num_nodes") <= packed["cap"])
    return (
        ecdf(capped, "num_nodes")
        .withColumn("_q", packed)
        .select("num_nodes", "count", "cdf", "_q.cap", "_q.p50", "_q.p95")
        .orderBy("num_nodes")
    )


def job_type_split(ov: DataFrame) -> DataFrame:
    """Two rows at most, so the share of the total is a plain window."""
    counts = _counted(ov).groupBy("is_gpu_job").agg(_jobs().alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("is_gpu_job", "count", (F.col("count") * 100.0 / total).alias("pct")).orderBy("is_gpu_job")


def job_type_by_month(ov: DataFrame) -> DataFrame:
    typed = [_jobs(~F.col("is_gpu_job")).alias("cpu"), _jobs(F.col("is_gpu_job")).alias("gpu")]
    return _counted(ov).groupBy("month").agg(*typed).orderBy("month")


def error_rate_by_month(ov: DataFrame) -> DataFrame:
    monthly = _counted(ov).groupBy("month").agg(_jobs().alias("total"), _jobs(F.col("is_success")).alias("success"))
    errors = F.col("total") - F.col("success")
    return monthly.select(
        "month", "total", "success", errors.alias("errors"), (errors * 100.0 / F.col("total")).alias("error_rate")
    ).orderBy("month")


def _positive_hours(ov: DataFrame) -> DataFrame:
    return ov.where(F.col("runtime_hours") > 0)


def _log_hours(ov: DataFrame) -> DataFrame:
    hours = F.greatest(F.col("runtime_hours"), F.lit(SHORTEST_HOURS))
    return _positive_hours(ov).withColumn("log_hours", F.log10(hours))


def duration_histogram(ov: DataFrame) -> DataFrame:
    return histogram(_log_hours(ov), "log_hours", DURATION_BINS).orderBy("bin")


def duration_cdf(ov: DataFrame) -> DataFrame:
    return ecdf(_log_hours(ov), "log_hours").select("log_hours", "count", "cdf").orderBy("log_hours")


def duration_quantiles(ov: DataFrame) -> DataFrame:
    return table_quantiles(_positive_hours(ov), "runtime_hours", {"p50": 0.5, "p95": 0.95})


def daily_throughput(ov: DataFrame) -> DataFrame:
    """Jobs per day with the centred seven-row mean over the days present.

    The window has no partition key, but its input is one row per calendar day.
    """
    daily = _counted(ov).groupBy("date").agg(_jobs().alias("count"))
    around = Window.orderBy("date").rowsBetween(-(ROLLING_DAYS // 2), ROLLING_DAYS // 2)
    full = F.count(F.lit(1)).over(around) == ROLLING_DAYS
    return daily.select(
        "date",
        "count",
        F.when(full, F.avg("count").over(around)).alias("rolling7"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    ).orderBy("date")


def busiest_days(ov: DataFrame, days: int | None = None) -> DataFrame:
    """Days by descending job count, all of them or the first `days`."""
    ranked = _counted(ov).groupBy("date").agg(_jobs().alias("count")).orderBy(F.desc("count"), "date")
    return ranked if days is None else ranked.limit(days)


def jobs_by_partition(ov: DataFrame) -> DataFrame:
    return _counted(ov).groupBy("partition").agg(_jobs().alias("count")).orderBy(F.desc("count"), "partition")


def gpu_hours_by_partition(ov: DataFrame) -> DataFrame:
    hours = F.coalesce(F.sum("gpu_hours"), F.lit(0.0)).alias("gpu_hours")
    return ov.groupBy("partition").agg(hours).orderBy(F.desc("gpu_hours"), "partition")


def gpu_pct_by_partition(ov: DataFrame) -> DataFrame:
    share = _jobs(F.col("is_gpu_job")) / F.nullif(_jobs(F.col("is_gpu_job").isNotNull()), F.lit(0))
    return _counted(ov).groupBy("partition").agg((share * 100).alias("gpu_pct")).orderBy(F.desc("gpu_pct"), "partition")


def resource_hours_by_month(ov: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in HOURS]
    return ov.groupBy("month").agg(*sums).orderBy("month")


def runtime_hist_by_type(ov: DataFrame) -> DataFrame:
    return log_histogram_density(
        _positive_hours(ov), "runtime_hours", "is_gpu_job", RUNTIME_EDGES, SHORTEST_HOURS
    ).orderBy("is_gpu_job", "bin")


def runtime_cdf_by_type(ov: DataFrame) -> DataFrame:
    return (
        ecdf(_positive_hours(ov), "runtime_hours", ["is_gpu_job"])
        .select("is_gpu_job", "runtime_hours", "count", "cdf")
        .orderBy("is_gpu_job", "runtime_hours")
    )


def runtime_quantiles_by_type(ov: DataFrame) -> DataFrame:
    points = {"p50": 0.5, "p95": 0.95}
    return table_quantiles(_positive_hours(ov), "runtime_hours", points, ["is_gpu_job"]).orderBy("is_gpu_job")


REPORTS = {
    f.__name__: f
    for f in (
        jobs_by_month, jobs_by_weekday, nodes_stats, nodes_histogram, nodes_cdf, nodes_capped,
        job_type_split, job_type_by_month, error_rate_by_month, duration_histogram, duration_cdf,
        duration_quantiles, daily_throughput, busiest_days, jobs_by_partition,
        gpu_hours_by_partition, gpu_pct_by_partition, resource_hours_by_month,
        runtime_hist_by_type, runtime_cdf_by_type, runtime_quantiles_by_type,
    )
}

# Reports that `job_counts` is enough for.
COUNTING = {
    f.__name__
    for f in (
        jobs_by_month, jobs_by_weekday, job_type_split, job_type_by_month, error_rate_by_month, daily_throughput,
        busiest_days, jobs_by_partition, gpu_hours_by_partition, gpu_pct_by_partition, resource_hours_by_month,
    )
}


def write_reports(summary: DataFrame, out: str) -> list[str]:
    """Write the reports below `out` and return the names of those written.

    The job rows are read once: the overview is written to the scratch folder, and the counting
    reports are cut from one aggregation of it. A report whose columns are absent is left out, and
    one that fails is logged; neither stops the others.
    """
    written = []
    with scratch_scope(summary.sparkSession):
        ov = materialise(job_overview(summary), "overview")
        counts = materialise(job_counts(ov), "job-counts")
        for name, report in REPORTS.items():
            try:
                result = report(counts if name in COUNTING else ov)
                result.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{name}")
                written.append(name)
            except AnalysisException as error:
                if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                    logger.exception("report %s failed", name)
                else:
                    logger.info("report %s is left out: %s", name, error.getCondition())
            except Exception:
                logger.exception("report %s failed", name)
    return written
