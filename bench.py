"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from jobmetrics.session import build_session, clear_scratch  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "gpu_series_stats gpu_job_stats gpu_percentiles gpu_time_above gpu_active_semijoin gpu_power_energy "
    "gpu_time_to_first_use gpu_node_signal ri_gpu cpu_job_stats cpu_percentiles cpu_normalised_util "
    "ri_cpu job_metadata job_summary_wide gpu_log_samples cpu_log_samples local_clock_to_utc "
    "file_index_explode pending_jobs run_accounting job_batches jobs_by_month nodes_stats "
    "nodes_histogram error_rate_by_month duration_histogram duration_cdf daily_throughput "
    "gpu_hours_by_partition resource_hours_by_month runtime_hist_by_type runtime_cdf_by_type"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    QUERIES["jobs_by_month"](spark, sf_dir).collect()  # start-up is not part of any query
    for name in wanted:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
