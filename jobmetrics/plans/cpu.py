"""CPU telemetry of all jobs: per-node statistics averaged over the nodes of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.operators.imbalance import imbalance, imbalance_of_nodes, node_parts
from jobmetrics.operators.series import QUARTILES, Metric, series_averages, series_stats

# Thresholds of the time-above shares (percent, and a ratio).
BUSY_PCT = 50.0
FULL_MEMORY = 0.9

JOB = "job_id"
SERIES = ["job_id", "node_id"]

METRICS = [
    Metric("cpu_util_pct", "cpu_util", quantiles=QUARTILES, above={"cpu_time_above_50pct": BUSY_PCT}),
    Metric("mem_rss_kb", "mem_rss_kb", quantiles=QUARTILES),
    Metric("mem_avail_kb", "mem_avail_kb"),
    Metric("mem_pct_utilization", "mem_pct_util", quantiles=QUARTILES, above={"mem_util_time_above_90pct": FULL_MEMORY}),
    Metric("read_kb", "read_kb"),
    Metric("write_kb", "write_kb"),
]

IMBALANCE = {
    "cpu_util": "cpu_util_pct",
    "mem_rss": "mem_rss_kb",
    "mem_avail": "mem_avail_kb",
    "mem_pct_util": "mem_pct_utilization",
    "read_kb": "read_kb",
    "write_kb": "write_kb",
}


def memory_ratio(rss: Column, available: Column) -> Column:
    """Resident over available memory, NULL unless some is available."""
    return F.when(available > 0, rss / F.nullif(available, F.lit(0.0)))


def row_totals() -> list[Column]:
    """Per-series parts of the totals that also count samples without a node."""
    return [
        F.sum("read_kb").alias("_read"),
        F.sum("write_kb").alias("_write"),
        F.max("mem_rss_kb").alias("_peak_rss"),
        F.sum("mem_avail_kb").alias("_avail"),
        F.count("mem_avail_kb").alias("_n_avail"),
    ]


def io_totals() -> list[Column]:
    return [
        F.coalesce(F.sum("_read"), F.lit(0.0)).alias("read_kb_total"),
        F.coalesce(F.sum("_write"), F.lit(0.0)).alias("write_kb_total"),
    ]


def memory_pressure() -> Column:
    """Peak resident over mean available memory of the whole job."""
    mean = F.sum("_avail") / F.nullif(F.sum("_n_avail"), F.lit(0))
    return F.when(mean > 0, F.max("_peak_rss") / F.nullif(mean, F.lit(0.0)))


def cpu_series(cpu_ts: DataFrame, metrics: list[Metric] | None = None) -> DataFrame:
    """One row per node of a job; samples without a node form a series of their own."""
    return series_stats(cpu_ts, SERIES, METRICS if metrics is None else metrics, row_totals())


def cpu_summary(cpu_ts: DataFrame, imbalance_decimals: int | None = 4) -> DataFrame:
    """One row per job with CPU telemetry. Samples without a node only enter the totals.

    A series is a node, so the parts of the imbalance are aggregates of the same first level.
    """
    extra = [*row_totals(), *node_parts(IMBALANCE)]
    series = series_stats(cpu_ts, SERIES, METRICS, extra)
    on_node = F.col("node_id").isNotNull()
    averaged = [n for m in METRICS for n in m.outputs()]
    return series.groupBy(JOB).agg(
        *series_averages(averaged, on_node),
        memory_pressure().alias("mem_pressure"),
        *io_totals(),
        *imbalance_of_nodes(IMBALANCE, imbalance_decimals, on_node),
    )


def cpu_imbalance(cpu_ts: DataFrame, decimals: int | None = 4) -> DataFrame:
    return imbalance(cpu_ts.where(F.col("node_id").isNotNull()), JOB, "node_id", IMBALANCE, decimals)
