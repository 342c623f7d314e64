"""The physical plans that matter at scale."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from jobmetrics.operators import quantiles
from jobmetrics.plans import cpu, gpu, reports
from jobmetrics.sources import logs
from workload import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_are_reduced_by_hash_before_the_shuffle(spark):
    for df in (
        gpu.gpu_series(tables.gpu_ts(spark, SF), metrics=[m for m in gpu.gpu_metrics() if not m.quantiles]),
        cpu.cpu_series(tables.cpu_ts(spark, SF), metrics=[m for m in cpu.METRICS if not m.quantiles]),
        gpu.gpu_imbalance(tables.gpu_ts(spark, SF)),
        cpu.cpu_imbalance(tables.cpu_ts(spark, SF)),
    ):
        text = plan(df)
        assert "SortAggregate" not in text and "partial_" in text
        assert text.count("Exchange hashpartitioning") <= 3


def test_samples_come_together_by_node_before_they_are_described(spark):
    plain = [m for m in gpu.gpu_metrics() if not m.quantiles]
    for df, shuffles in (
        (gpu.gpu_series(tables.gpu_ts(spark, SF), metrics=plain), 1),
        (cpu.cpu_series(tables.cpu_ts(spark, SF), metrics=[]), 1),
        (gpu.gpu_imbalance(tables.gpu_ts(spark, SF)), 2),
    ):
        text = plan(df)
        # The widest partials are made of samples that were dealt out, and need no shuffle of their own.
        assert text.count("Exchange hashpartitioning") == shuffles
        assert "REPARTITION_BY_COL" in text[text.rindex("partial_") :]


def test_quantiles_scan_only_their_columns_and_count_before_the_shuffle(spark, monkeypatch):
    written, write = [], quantiles.materialise
    monkeypatch.setattr(quantiles, "materialise", lambda df, label: written.append(plan(df)) or write(df, label))
    whole = plan(gpu.gpu_summary(tables.gpu_ts(spark, SF)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for text in written:
        assert "percentile" not in text and "SortAggregate" not in text and "partial_count" in text
        assert "l_tax" not in text and "l_extendedprice" not in text
    assert written and "percentile" not in whole


def test_log_headers_need_no_text_shuffle(spark, tmp_path):
    (tmp_path / "1-n.csv").write_text("timestamp,gpu_index\n1,2\n")
    text = plan(logs.file_headers(logs.stage_records(logs.read_log_lines(spark, str(tmp_path)), logs.GPU_COLUMNS), logs.GPU_COLUMNS))
    assert "SortAggregate" not in text and "partial_" in text


def test_cpu_samples_are_aggregated_once_for_statistics_and_imbalance(spark):
    text = plan(cpu.cpu_summary(tables.cpu_ts(spark, SF)))
    # One pass for statistics, totals and imbalance; the quantiles were written by passes of their own.
    scans = [s for s in re.findall("FileScan parquet.*", text) if "_slot:" not in s]
    assert len(scans) == 1 and "peak_cpu_util" in text


@pytest.mark.parametrize("name", sorted(reports.COUNTING))
def test_counting_reports_are_the_same_from_counts(spark, name):
    ov = tables.overview(spark, SF)
    alone, cut = reports.REPORTS[name](ov), reports.REPORTS[name](reports.job_counts(ov))
    assert alone.schema.simpleString() == cut.schema.simpleString()
    pairs = zip(sorted(map(tuple, alone.collect()), key=str), sorted(map(tuple, cut.collect()), key=str), strict=True)
    for a, b in pairs:
        assert all(x == y or abs(x - y) <= 1e-9 * abs(x) for x, y in zip(a, b, strict=True))


def test_reports_skip_absent_columns_and_outlive_errors(spark, tmp_path, monkeypatch):
    full = tables.overview(spark, SF).select("job_id", "start_timestamp", "num_nodes", "node_hours", "gpu_hours")
    jobs = full.withColumns({"num_alloc_gpus": F.col("gpu_hours"), "queue_name": F.lit(" A ")}).drop("node_hours")
    needed = {"error_rate_by_month", "resource_hours_by_month"} | {n for n in reports.REPORTS if n.startswith(("duration", "runtime"))}

    def fails(ov):
        raise RuntimeError("broken report")

    monkeypatch.setitem(reports.REPORTS, "nodes_stats", fails)
    written = reports.write_reports(jobs, str(tmp_path))
    assert set(written) == set(reports.REPORTS) - needed - {"nodes_stats"}
    assert spark.read.parquet(str(tmp_path / "jobs_by_partition")).first().partition == "a"


def test_reports_prune_columns(spark):
    text = plan(reports.jobs_by_month(tables.overview(spark, SF)))
    assert "o_totalprice" not in text and "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["job_summary_wide", "gpu_log_samples", "runtime_cdf_by_type", "pending_jobs"])
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "NestedLoop"):
        assert word not in text
