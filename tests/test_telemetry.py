"""Statistics of GPU and CPU samples, checked against hand values and against numpy."""

import math
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from jobmetrics.operators import quantiles
from jobmetrics.operators.imbalance import imbalance
from jobmetrics.operators.quantiles import refined_quantiles
from jobmetrics.operators.series import QUARTILES, Metric, series_stats
from jobmetrics.plans.cpu import cpu_imbalance, cpu_summary
from jobmetrics.plans.gpu import active_samples, add_allocation, gpu_imbalance, gpu_summary
from jobmetrics.plans.summary import SUMMARY_COLUMNS, job_summary

GPU = "job_id bigint, node_id string, gpu_index bigint, ts timestamp, util_pct double, mem_util_pct double, mem_used_kib double, power_w double, temperature double"
CPU = "job_id bigint, node_id string, ts timestamp, cpu_util_pct double, mem_rss_kb double, mem_avail_kb double, mem_pct_utilization double, read_kb double, write_kb double"
START = datetime(2023, 2, 11, 6, tzinfo=timezone.utc)
STEP = timedelta(seconds=15)


def column(values, n):
    """A list as it is, or one value for all `n` samples."""
    return values if isinstance(values, list) else [values] * n


def gpu_trace(node, device, util, watts=75.0, kib=2048.0, job=1):
    n = len(util)
    cells = zip(util, column(kib, n), column(watts, n))
    return [(job, node, device, START + k * STEP, u, 12.0, m, w, 41.0) for k, (u, m, w) in enumerate(cells)]


def cpu_trace(node, util, rss=256.0, read=0.0, job=1):
    n, rows = len(util), []
    for k, (u, used, kb) in enumerate(zip(util, column(rss, n), column(read, n))):
        ratio = used / 1024 if used is not None else None
        rows.append((job, node, START + k * STEP, u, used, 1024.0, ratio, kb, 0.0))
    return rows


def gpu_job(spark, *series, **kw):
    return gpu_summary(spark.createDataFrame([r for s in series for r in s], GPU), **kw).first()


def cpu_job(spark, *series):
    return cpu_summary(spark.createDataFrame([r for s in series for r in s], CPU)).first()


def describe(values):
    x = np.array([v for v in values if v is not None], dtype=float)
    if len(x) == 0:
        return dict.fromkeys(("mean", "max", "min", "std", "skew", "kurtosis", "iof", "p25", "p75", "p95"))
    mean, m2 = x.mean(), ((x - x.mean()) ** 2).mean()
    flat = x.max() == x.min()
    return {
        "mean": mean, "max": x.max(), "min": x.min(),
        "std": x.std(ddof=1) if len(x) > 1 else None,
        "skew": None if flat else ((x - mean) ** 3).mean() / m2**1.5,
        "kurtosis": None if flat else ((x - mean) ** 4).mean() / m2**2 - 3,
        "iof": 0.0 if mean == 0 else (x.var(ddof=1) / mean if len(x) > 1 else None),
        "p25": np.quantile(x, 0.25), "p75": np.quantile(x, 0.75), "p95": np.quantile(x, 0.95),
    }


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def test_series_statistics_match_numpy(spark):
    rng = np.random.default_rng(7)
    series = {k: [None if rng.random() < 0.2 else float(rng.integers(0, 50)) for _ in range(n)] for k, n in enumerate([1, 2, 5, 40, 300])}
    series |= {10: [None, None], 11: [7.0] * 9, 12: [1000000.1] * 12, 13: [0.0, 0.0, 0.0], 14: [0.0]}
    rows = [(k, v) for k, values in series.items() for v in values]
    df = spark.createDataFrame(rows, "k int, v double")
    metric = Metric("v", "v", quantiles=QUARTILES, above={"above": 20.0})
    for row in series_stats(df, ["k"], [metric]).collect():
        for name, value in describe(series[row.k]).items():
            assert close(row[f"v_{name}"], value), (row.k, name, row[f"v_{name}"], value)
        present = [v for v in series[row.k] if v is not None]
        share = sum(v > 20 for v in present) / len(present) if present else None
        assert close(row["above"], share)


@pytest.mark.parametrize("log_bins,fine_bins", [(1 << 16, 1 << 20), (1, 8)])
@settings(max_examples=2, deadline=None)
@given(st.lists(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), min_size=1, max_size=4))
def test_refined_quantiles_match_numpy(spark, log_bins, fine_bins, groups):
    """Also with bins so coarse that most order statistics need several rounds."""
    rows = [(k or None, v, float(i)) for k, values in enumerate(groups) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k int, v double, w double")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quantiles, "LOG_BINS", log_bins)
        patch.setattr(quantiles, "FINE_BINS", fine_bins)
        for row in refined_quantiles(df, ["k"], {"v": (0.25, 0.95), "w": (0.5,)}).collect():
            mine = groups[row.k or 0]
            assert np.allclose(row["q_v"], np.quantile(mine, [0.25, 0.95]), rtol=1e-9, atol=1e-9)
            assert np.allclose(row["q_w"], [(len(mine) - 1) / 2])


def test_quantiles_of_a_long_series_in_a_small_table_of_bins(spark):
    """One series with nearly all rows, many of them in one bin; infinite values and series without any."""
    n = 200_000
    df = spark.range(n).select(F.lit(1).alias("k"), (1e6 + F.col("id") * 7919 % n / 1e5).alias("v"))
    more = [(2, float("inf")), (2, 1.0), (2, float("-inf")), (3, None), (4, float("nan")), (4, 2.0), (4, 1.0)]
    rows = refined_quantiles(df.union(spark.createDataFrame(more, "k int, v double")), ["k"], {"v": (0.25, 0.5, 1.0)})
    got = {r.k: r.q_v for r in rows.collect()}
    assert np.allclose(got[1], np.quantile(1e6 + np.arange(n) / 1e5, [0.25, 0.5, 1.0]), rtol=1e-12)
    assert got[2][1:] == [1.0, math.inf] and got[3] == [None] * 3 and got[4][1] == 2.0 and math.isnan(got[4][2])


def test_idle_devices_are_left_out(spark):
    row = gpu_job(spark, gpu_trace("n", 0, [1.0, 1.0]), gpu_trace("n", 1, [80.0, 80.0]))
    assert (row.num_gpus_used, row.num_gpus_total_in_logs, row.gpu_util_mean) == (1, 2, 80.0)


def test_threshold_is_strict(spark):
    row = gpu_job(spark, gpu_trace("n", 0, [2.0, 2.0]))
    assert row.num_gpus_used == 0
    assert row.gpu_util_mean is None and row.gpu_power_mean_total_w is None and row.gpu_mem_used_kib_sum is None
    assert row.gpu_power_mean_total_including_idle_w == 75.0


def test_steady_devices_do_not_vary(spark):
    row = gpu_job(spark, gpu_trace("n", 0, [80.0] * 5), gpu_trace("n", 1, [20.0] * 5))
    assert (row.gpu_util_std, row.gpu_util_mean) == (0.0, 50.0)
    assert gpu_job(spark, gpu_trace("n", 0, [0.0, 100.0] * 5)).gpu_util_std > 40


def test_power_and_memory_totals(spark):
    row = gpu_job(
        spark,
        gpu_trace("a", 0, [90.0] * 2, [200.0] * 2, [4096.0] * 2),
        gpu_trace("b", 0, [90.0] * 2, [100.0, 200.0], [4096.0] * 2),
        gpu_trace("b", 1, [0.0] * 2, [80.0] * 2),
    )
    assert (row.gpu_power_mean_total_w, row.gpu_power_peak_w) == (350.0, 400.0)
    assert row.gpu_power_mean_total_including_idle_w == 430.0
    assert (row.gpu_mem_used_kib_sum, row.gpu_mem_used_kib_mean) == (8192.0, 4096.0)


def test_active_device_without_power_counts_zero(spark):
    row = gpu_job(spark, gpu_trace("a", 0, [90.0], [None]))
    assert (row.gpu_power_mean_total_w, row.gpu_power_mean_total_including_idle_w) == (0.0, 0.0)
    assert row.gpu_power_std_w is None


def test_energy_and_idle_ratio(spark):
    rows = [(300.0, 310.0, 3600, 2, 2), (300.0, 310.0, 1800, 2, 1), (300.0, 310.0, 3600, 0, 1), (None, 310.0, 3600, 1, 3)]
    df = spark.createDataFrame(rows, "gpu_power_mean_total_w double, gpu_power_mean_total_including_idle_w double, runtime_seconds bigint, num_alloc_gpus int, num_gpus_used bigint")
    out = [tuple(r) for r in add_allocation(df).select("gpu_energy_total_wh", "gpu_energy_total_including_idle_wh", "gpu_idle_allocated_ratio").collect()]
    assert out == [(300.0, 310.0, 0.0), (150.0, 155.0, 0.5), (300.0, 310.0, None), (None, 310.0, -2.0)]


def test_time_to_first_use_counts_all_devices(spark):
    row = gpu_job(spark, gpu_trace("a", 0, [0.0, 0.0, 3.0, 0.0]), gpu_trace("b", 0, [0.0] * 4))
    assert (row.time_to_gpu_use_s, row.minutes_to_gpu_use) == (30.0, 0.5)
    assert gpu_job(spark, gpu_trace("a", 0, [0.0])).time_to_gpu_use_s is None


def test_active_semi_join(spark):
    df = spark.createDataFrame(gpu_trace("a", 0, [1.0] * 3) + gpu_trace("a", 1, [9.0] * 4), GPU)
    assert active_samples(df, 2.0).count() == 4


def test_cpu_statistics_average_over_nodes(spark):
    row = cpu_job(spark, cpu_trace("a", [90.0] * 10), cpu_trace("b", [10.0] * 2))
    assert (row.cpu_util_mean, row.cpu_util_std, row.cpu_util_p75, row.cpu_time_above_50pct) == (50.0, 0.0, 50.0, 0.5)


def test_cpu_totals_include_samples_without_node(spark):
    row = cpu_job(spark, cpu_trace("a", [1.0, 1.0], [100.0, 300.0], [100.0, 200.0]), cpu_trace(None, [99.0], [2048.0], [200.0]))
    assert (row.read_kb_total, row.write_kb_total) == (500.0, 0.0)
    assert row.cpu_util_mean == 1.0 and row.mem_pressure == 2.0
    assert cpu_imbalance(spark.createDataFrame(cpu_trace(None, [9.0]), CPU)).count() == 0


def test_imbalance_of_the_summary_is_that_of_the_samples(spark):
    traces = [
        *cpu_trace("a", [90.0, 10.0, None], [5.0, 7.0, 9.0], 3.0), *cpu_trace("b", [20.0], [64.0]), *cpu_trace(None, [99.0], [2048.0]),
        *cpu_trace("a", [None, None], job=2), *cpu_trace("c", [50.0, 75.0], job=2), *cpu_trace(None, [9.0], job=3),
    ]
    samples = spark.createDataFrame(traces, CPU)
    alone = cpu_imbalance(samples, None).orderBy("job_id").collect()
    fused = cpu_summary(samples, imbalance_decimals=None).select(*alone[0].asDict()).orderBy("job_id").collect()
    assert alone == fused[:2] and len(alone) == 2
    assert set(fused[2].asDict().values()) == {3, None}


def test_all_null_totals_are_zero(spark):
    row = cpu_job(spark, cpu_trace("a", [1.0], [None], [None]))
    assert row.read_kb_total == 0.0 and row.mem_pressure is None and row.mem_rss_kb_mean is None


def ri(spark, nodes, decimals=4):
    rows = [(1, n, v) for n, values in nodes.items() for v in values]
    row = imbalance(spark.createDataFrame(rows, "job_id bigint, node_id string, u double"), "job_id", "node_id", {"u": "u"}, decimals).first()
    return row.ri_temporal_u, row.ri_spatial_u


@pytest.mark.parametrize(
    ("nodes", "temporal", "spatial"),
    [
        ({"a": [100.0, 0.0]}, 0.5, 0.0),
        ({"a": [100.0, 0.0], "b": [80.0, 80.0]}, 0.5, 0.1),
        ({"a": [0.0, 0.0], "b": [0.0]}, 0.0, 0.0),
        ({"a": [100.0], "b": [20.0]}, 0.0, 0.4),
        ({"a": [100.0, None, 0.0]}, 0.5, 0.0),
        ({"a": [100.0], "b": [0.0]}, 0.0, 0.5),
        ({"a": [90.0], "b": [90.0], "c": [30.0]}, 0.0, 0.2222),
        ({"a": [90.0], "b": [None]}, 0.0, 0.5),
        ({"a": [None]}, 0.0, 0.0),
        ({"a": [0.001, 0.0, 0.0, 0.0, 0.0]}, 0.8, 0.0),
        ({"a": [-5.0, -1.0], "b": [-2.0]}, 0.0, 0.0),
    ],
)
def test_imbalance(spark, nodes, temporal, spatial):
    assert ri(spark, nodes) == (temporal, spatial)


def test_gpu_imbalance_averages_devices_first(spark):
    rows = gpu_trace("a", 0, [100.0, 0.0]) + gpu_trace("a", 1, [0.0, 100.0]) + gpu_trace("b", 0, [25.0, 25.0])
    row = gpu_imbalance(spark.createDataFrame(rows, GPU)).first()
    assert (row.ri_temporal_gpu_util, row.ri_spatial_gpu_util) == (0.0, 0.25)


def test_wide_row(spark):
    meta = "job_id bigint, start_timestamp timestamp, end_timestamp timestamp, runtime_seconds bigint, node_hours double, gpu_hours double, num_nodes double, num_alloc_gpus int, gpu_type string, user_id string, queue_name string, exit_code string, cpus_req double, project_id string, domain string, subdomain string, has_gpu_logs boolean"
    rest = (START, START, 3600, 1.0, 2.0, 1.0, 2, "volta", "u", "q", "0", 4.0, None, None, None)
    jobs = spark.createDataFrame([(1, *rest, True), (2, *rest, False), (3, *rest, True)], meta)
    gpu_ts = spark.createDataFrame(gpu_trace("a", 0, [50.0, 60.0], [100.0, 200.0]) + gpu_trace("a", 0, [50.0], job=2), GPU)
    cpu_ts = spark.createDataFrame(cpu_trace("a", [10.0, 20.0], job=2), CPU)
    wide = job_summary(jobs, cpu_ts, gpu_ts)
    assert wide.columns == SUMMARY_COLUMNS and len(wide.columns) == 145
    rows = {r.job_id: r for r in wide.collect()}
    assert rows[1].is_gpu_job and rows[1].gpu_energy_total_wh == 150.0 and rows[1].gpu_idle_allocated_ratio == 0.5
    assert rows[1].cpu_util_mean is None and rows[1].ri_temporal_cpu_util is None
    assert not rows[2].is_gpu_job and rows[2].gpu_util_mean is None and rows[2].ri_spatial_gpu_util is None
    assert rows[2].cpu_util_mean == 15.0 and rows[2].ri_temporal_cpu_util == 0.25
    assert rows[3].is_gpu_job and rows[3].num_gpus_used is None
