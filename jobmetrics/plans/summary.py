"""The wide row: metadata, CPU, GPU and imbalance of every job."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics.functions.statistics import DISTRIBUTION
from jobmetrics.plans import cpu, gpu
from jobmetrics.plans.metadata import METADATA_COLUMNS


def _names(prefix: str, quantiles: bool = False) -> list[str]:
    parts = DISTRIBUTION + (("p25", "p75", "p95") if quantiles else ())
    return [f"{prefix}_{part}" for part in parts]


CPU_COLUMNS = [
    *_names("cpu_util", True), "cpu_time_above_50pct",
    *_names("mem_rss_kb", True),
    *_names("mem_avail_kb"),
    *_names("mem_pct_util", True), "mem_util_time_above_90pct", "mem_pressure",
    *_names("read_kb"), *_names("write_kb"), "read_kb_total", "write_kb_total",
]
GPU_COLUMNS = [
    "num_gpus_used", "num_gpus_total_in_logs", "gpu_idle_allocated_ratio",
    *_names("gpu_util", True), "gpu_time_above_threshold_pct",
    *_names("gpu_mem_util", True),
    *_names("gpu_mem_used_kib"), "gpu_mem_used_kib_sum",
    *_names("gpu_temp"),
    "gpu_power_mean_total_w", "gpu_power_peak_w", "gpu_energy_total_wh",
    "gpu_power_mean_total_including_idle_w", "gpu_energy_total_including_idle_wh",
    "gpu_power_std_w", "gpu_power_skew", "gpu_power_kurtosis", "gpu_power_min_w",
    "time_to_gpu_use_s", "minutes_to_gpu_use",
]
GPU_IMBALANCE_COLUMNS = [f"ri_{kind}_{label}" for label in gpu.IMBALANCE for kind in ("temporal", "spatial")]
CPU_IMBALANCE_COLUMNS = [f"ri_{kind}_{label}" for label in cpu.IMBALANCE for kind in ("temporal", "spatial")]

SUMMARY_COLUMNS = [
    "job_id", "is_gpu_job", *METADATA_COLUMNS, *CPU_COLUMNS, *GPU_COLUMNS,
    *GPU_IMBALANCE_COLUMNS, *CPU_IMBALANCE_COLUMNS,
]

# Imbalance columns that exist only if some log file of the job had the optional column.
OPTIONAL_IMBALANCE = {"gpu_mem_util": "has_mem_util", "gpu_temp": "has_temperature"}


def job_summary(
    jobs: DataFrame,
    cpu_ts: DataFrame,
    gpu_ts: DataFrame,
    busy_pct: float = gpu.BUSY_PCT,
    imbalance_decimals: int | None = 4,
) -> DataFrame:
    """Wide row per job of `jobs`, which needs the metadata columns and `has_gpu_logs`.

    Every part is one row per job and already hash-partitioned by job, so the left joins only
    shuffle the metadata. A job whose GPU logs are unusable counts as a CPU job.
    """
    gpu_part = gpu.gpu_summary(gpu_ts, busy_pct)
    checked = "file_ok" in gpu_part.columns
    usable = F.lit(True)
    if checked:
        usable = F.coalesce(F.col("file_ok") & F.col("has_util") & F.col("has_power"), F.lit(True))
    joined = (
        jobs.join(cpu.cpu_summary(cpu_ts, imbalance_decimals), "job_id", "left")
        .join(gpu_part, "job_id", "left")
        .join(gpu.gpu_imbalance(gpu_ts, imbalance_decimals), "job_id", "left")
        .withColumn("is_gpu_job", F.col("has_gpu_logs") & usable)
    )
    wide = gpu.add_allocation(joined)

    def finished(name: str):
        value = F.col(name)
        if name in GPU_COLUMNS or name in GPU_IMBALANCE_COLUMNS:
            value = F.when(F.col("is_gpu_job"), value)
        if checked:
            for label, flag in OPTIONAL_IMBALANCE.items():
                if name.startswith("ri_") and name.endswith(f"_{label}"):
                    value = F.when(F.col(flag), value)
        return value.alias(name)

    return wide.select(*[finished(name) for name in SUMMARY_COLUMNS])
