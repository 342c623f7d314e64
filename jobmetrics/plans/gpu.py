"""GPU telemetry of all jobs: per-device statistics averaged over the active devices of a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobmetrics.functions.clock import seconds_between
from jobmetrics.operators.imbalance import imbalance, node_signal
from jobmetrics.operators.series import QUARTILES, Metric, series_averages, series_stats

# Fixed value: a device is active when its mean utilisation exceeds this many percent.
BUSY_PCT = 2.0

JOB = "job_id"
SERIES = ["job_id", "node_id", "gpu_index"]
# Per-file facts that tidy logs carry (see sources.logs); tables without them are complete.
FILE_FLAGS = ("file_ok", "has_util", "has_power", "has_mem_util", "has_temperature")

IMBALANCE = {
    "gpu_util": "util_pct",
    "gpu_mem_util": "mem_util_pct",
    "gpu_mem_used": "mem_used_kib",
    "gpu_power": "power_w",
    "gpu_temp": "temperature",
}


def gpu_metrics(busy_pct: float = BUSY_PCT) -> list[Metric]:
    return [
        Metric("util_pct", "gpu_util", quantiles=QUARTILES, above={"gpu_time_above_threshold_pct": busy_pct}),
        Metric("mem_util_pct", "gpu_mem_util", quantiles=QUARTILES),
        Metric("mem_used_kib", "gpu_mem_used_kib"),
        Metric("temperature", "gpu_temp"),
        Metric("power_w", "gpu_power"),
    ]


def is_active(busy_pct: float = BUSY_PCT) -> Column:
    return F.coalesce(F.col("gpu_util_mean") > F.lit(float(busy_pct)), F.lit(False))


def gpu_series(
    gpu_ts: DataFrame, busy_pct: float = BUSY_PCT, metrics: list[Metric] | None = None
) -> DataFrame:
    """One row per device of a job with its statistics, first sample and first busy sample."""
    metrics = gpu_metrics(busy_pct) if metrics is None else metrics
    extra = [
        F.min("ts").alias("first_ts"),
        F.min(F.when(F.col("util_pct") > F.lit(float(busy_pct)), F.col("ts"))).alias("first_busy_ts"),
    ]
    if "file_ok" in gpu_ts.columns:
        extra += [F.min("file_ok").alias("file_ok")]
        extra += [F.max(flag).alias(flag) for flag in FILE_FLAGS[1:]]
    return series_stats(gpu_ts, SERIES, metrics, extra)


def sum_over_active(column: str, active: Column) -> Column:
    """Physical total over active devices: NULL without any, 0 when they never reported."""
    any_active = F.count_if(active) > 0
    return F.when(any_active, F.coalesce(F.sum(F.when(active, F.col(column))), F.lit(0.0)))


def device_counts(active: Column) -> list[Column]:
    return [
        F.count_if(active).alias("num_gpus_used"),
        F.count(F.lit(1)).alias("num_gpus_total_in_logs"),
    ]


def power_totals(active: Column) -> list[Column]:
    return [
        sum_over_active("gpu_power_mean", active).alias("gpu_power_mean_total_w"),
        sum_over_active("gpu_power_max", active).alias("gpu_power_peak_w"),
        F.coalesce(F.sum("gpu_power_mean"), F.lit(0.0)).alias("gpu_power_mean_total_including_idle_w"),
    ]


def power_variability(active: Column) -> list[Column]:
    names = {"std": "gpu_power_std_w", "skew": "gpu_power_skew", "kurtosis": "gpu_power_kurtosis", "min": "gpu_power_min_w"}
    return [F.avg(F.when(active, F.col(f"gpu_power_{s}"))).alias(n) for s, n in names.items()]


def first_use() -> list[Column]:
    """Seconds and minutes from the first sample of any device to the first busy sample."""
    seconds = seconds_between(F.min("first_ts"), F.min("first_busy_ts"))
    return [seconds.alias("time_to_gpu_use_s"), (seconds / 60).alias("minutes_to_gpu_use")]


def gpu_summary(gpu_ts: DataFrame, busy_pct: float = BUSY_PCT) -> DataFrame:
    """One row per job with GPU telemetry.

    A device is aggregated once and carries its own active flag, so restricting to active devices
    is a condition of the second aggregation instead of a join back to the samples.
    """
    metrics = gpu_metrics(busy_pct)
    series = gpu_series(gpu_ts, busy_pct, metrics)
    active = is_active(busy_pct)
    averaged = [n for m in metrics if m.prefix != "gpu_power" for n in m.outputs()]
    flags = []
    if "file_ok" in series.columns:
        flags += [F.min("file_ok").alias("file_ok")]
        flags += [F.max(flag).alias(flag) for flag in FILE_FLAGS[1:]]
    return series.groupBy(JOB).agg(
        *device_counts(active),
        *series_averages(averaged, active),
        sum_over_active("gpu_mem_used_kib_mean", active).alias("gpu_mem_used_kib_sum"),
        *power_totals(active),
        *power_variability(active),
        *first_use(),
        *flags,
    )


def energy_wh(power: str) -> Column:
    return F.col(power) * F.col("runtime_seconds") / F.lit(3600.0)


def idle_allocated_ratio() -> Column:
    """Share of the allocated devices that stayed idle; negative when logs show more than allocated."""
    return F.when(
        F.col("num_alloc_gpus") > 0,
        1 - F.col("num_gpus_used") / F.nullif(F.col("num_alloc_gpus"), F.lit(0)),
    )


def add_allocation(summary: DataFrame) -> DataFrame:
    """Energy and idle ratio, once `runtime_seconds` and `num_alloc_gpus` have been joined in."""
    return summary.withColumns(
        {
            "gpu_energy_total_wh": energy_wh("gpu_power_mean_total_w"),
            "gpu_energy_total_including_idle_wh": energy_wh("gpu_power_mean_total_including_idle_w"),
            "gpu_idle_allocated_ratio": idle_allocated_ratio(),
        }
    )


def gpu_imbalance(gpu_ts: DataFrame, decimals: int | None = 4) -> DataFrame:
    signal = node_signal(gpu_ts, [JOB, "node_id"], "ts", list(IMBALANCE.values()))
    return imbalance(signal, JOB, "node_id", IMBALANCE, decimals)


def active_samples(gpu_ts: DataFrame, busy_pct: float = BUSY_PCT) -> DataFrame:
    """Samples of the active devices only; the semi-join form of the active filter."""
    active = gpu_ts.groupBy(*SERIES).agg(F.avg("util_pct").alias("u")).where(F.col("u") > float(busy_pct))
    return gpu_ts.join(active, SERIES, "left_semi")
