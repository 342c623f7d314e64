"""Every operator as a query over the test tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.functions import clock, text
from jobmetrics.operators.imbalance import node_signal
from jobmetrics.operators.ranking import batch_numbers
from jobmetrics.operators.series import QUARTILES, Metric, average_over_series, series_stats
from jobmetrics.plans import cpu, gpu, metadata, reports, runs
from jobmetrics.plans.summary import job_summary
from jobmetrics.session import materialise, scratch_dir
from jobmetrics.sources import index as file_index
from jobmetrics.sources import logs, store
from jobmetrics.sources.scheduler import read_scheduler_csv
from workload import log_files, tables
from workload.tables import BUSY_PCT


def places(column: str) -> int:
    """Decimals compared: fewer for large magnitudes."""
    if column.endswith("_wh"):
        return 2
    shape = column.endswith(("_skew", "_kurtosis"))
    return 4 if ("_kib" in column or "_kb" in column) and not shape and not column.startswith("ri_") else 6


def nudge(column: str) -> float:
    """Added before rounding, so that exact halves (common for means of whole numbers) lie clear
    of the point where the last bit of a sum would decide."""
    return 1.7 * 10.0 ** -(places(column) + 2)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded for comparison, without negative zeros."""

    def tidy(name: str, kind: str) -> Column:
        if kind != "double":
            return F.col(name)
        value = F.round(F.col(name) + F.lit(nudge(name)), places(name))
        return F.when(value == 0, F.lit(0.0)).otherwise(value).alias(name)

    return df.select(*[tidy(name, kind) for name, kind in df.dtypes])


# GPU telemetry


def gpu_series_stats(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric(m.column, m.prefix) for m in gpu.gpu_metrics(BUSY_PCT)]
    return rounded(series_stats(tables.gpu_ts(spark, d), gpu.SERIES, metrics))


def gpu_job_stats(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric(m.column, m.prefix) for m in gpu.gpu_metrics(BUSY_PCT)]
    series = gpu.gpu_series(tables.gpu_ts(spark, d), BUSY_PCT, metrics)
    names = [n for m in metrics for n in m.outputs()]
    return rounded(average_over_series(series, ["job_id"], names, gpu.is_active(BUSY_PCT)))


def gpu_percentiles(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric("util_pct", "gpu_util", ("mean",), QUARTILES), Metric("mem_util_pct", "gpu_mem_util", (), QUARTILES)]
    series = gpu.gpu_series(tables.gpu_ts(spark, d), BUSY_PCT, metrics)
    names = [n for m in metrics for n in m.quantile_names()]
    return rounded(average_over_series(series, ["job_id"], names, gpu.is_active(BUSY_PCT)))


def gpu_time_above(spark: SparkSession, d: str) -> DataFrame:
    name = "gpu_time_above_threshold_pct"
    metrics = [Metric("util_pct", "gpu_util", ("mean",), above={name: BUSY_PCT})]
    series = gpu.gpu_series(tables.gpu_ts(spark, d), BUSY_PCT, metrics)
    return rounded(average_over_series(series, ["job_id"], [name], gpu.is_active(BUSY_PCT)))


def _with_jobs(spark: SparkSession, d: str, part: DataFrame) -> DataFrame:
    attributes = tables.jobs(spark, d).select("job_id", "runtime_seconds", "num_alloc_gpus")
    return part.join(attributes, "job_id")


def _device_means(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric("util_pct", "gpu_util", ("mean",)), Metric("power_w", "gpu_power"), Metric("mem_used_kib", "gpu_mem_used_kib")]
    return gpu.gpu_series(tables.gpu_ts(spark, d), BUSY_PCT, metrics)


def gpu_active_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = _device_means(spark, d).groupBy("job_id").agg(*gpu.device_counts(gpu.is_active(BUSY_PCT)))
    ratio = gpu.idle_allocated_ratio().alias("gpu_idle_allocated_ratio")
    return rounded(_with_jobs(spark, d, counts).select(*counts.columns, ratio))


def gpu_active_semijoin(spark: SparkSession, d: str) -> DataFrame:
    samples = gpu.active_samples(tables.gpu_ts(spark, d), BUSY_PCT)
    return rounded(samples.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("samples"), F.avg("util_pct").alias("util_mean"), F.max("power_w").alias("power_max")
    ))


def gpu_power_energy(spark: SparkSession, d: str) -> DataFrame:
    totals = _device_means(spark, d).groupBy("job_id").agg(*gpu.power_totals(gpu.is_active(BUSY_PCT)))
    energy = [gpu.energy_wh(f"gpu_power_mean_total{s}_w").alias(f"gpu_energy_total{s}_wh") for s in ("", "_including_idle")]
    return rounded(_with_jobs(spark, d, totals).select(*totals.columns, *energy))


def gpu_power_variability(spark: SparkSession, d: str) -> DataFrame:
    active = gpu.is_active(BUSY_PCT)
    return rounded(_device_means(spark, d).groupBy("job_id").agg(*gpu.power_variability(active)))


def gpu_mem_totals(spark: SparkSession, d: str) -> DataFrame:
    total = gpu.sum_over_active("gpu_mem_used_kib_mean", gpu.is_active(BUSY_PCT)).alias("gpu_mem_used_kib_sum")
    mean = F.avg(F.when(gpu.is_active(BUSY_PCT), F.col("gpu_mem_used_kib_mean"))).alias("gpu_mem_used_kib_mean")
    return rounded(_device_means(spark, d).groupBy("job_id").agg(total, mean))


def gpu_time_to_first_use(spark: SparkSession, d: str) -> DataFrame:
    series = gpu.gpu_series(tables.gpu_ts(spark, d), BUSY_PCT, [Metric("util_pct", "gpu_util", ("mean",))])
    return rounded(series.groupBy("job_id").agg(*gpu.first_use()))


def gpu_node_signal(spark: SparkSession, d: str) -> DataFrame:
    columns = list(gpu.IMBALANCE.values())
    signal = node_signal(tables.gpu_ts(spark, d), ["job_id", "node_id"], "ts", columns)
    seconds = F.unix_seconds("ts").alias("ts_s")
    return rounded(signal.select("job_id", "node_id", seconds, *columns))


def ri_gpu(spark: SparkSession, d: str) -> DataFrame:
    return rounded(gpu.gpu_imbalance(tables.gpu_ts(spark, d), decimals=None))


# CPU telemetry


def cpu_job_stats(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric(m.column, m.prefix) for m in cpu.METRICS]
    names = [n for m in metrics for n in m.outputs()]
    series = cpu.cpu_series(tables.cpu_ts(spark, d), metrics)
    return rounded(average_over_series(series, ["job_id"], names, F.col("node_id").isNotNull()))


def cpu_percentiles(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric(m.column, m.prefix, (), m.quantiles) for m in cpu.METRICS if m.quantiles]
    names = [n for m in metrics for n in m.outputs()]
    series = cpu.cpu_series(tables.cpu_ts(spark, d), metrics)
    return rounded(average_over_series(series, ["job_id"], names, F.col("node_id").isNotNull()))


def cpu_time_above(spark: SparkSession, d: str) -> DataFrame:
    metrics = [Metric(m.column, m.prefix, (), above=m.above) for m in cpu.METRICS if m.above]
    names = [n for m in metrics for n in m.outputs()]
    series = cpu.cpu_series(tables.cpu_ts(spark, d), metrics)
    return rounded(average_over_series(series, ["job_id"], names, F.col("node_id").isNotNull()))


def cpu_normalised_util(spark: SparkSession, d: str) -> DataFrame:
    """Raw utilisation over the CPUs per node each job requested; all samples of a job keep one
    divisor, so the join adds one small row per job."""
    per_node = tables.jobs(spark, d).select("job_id", "cpus_per_node")
    samples = tables.cpu_ts(spark, d).join(per_node, "job_id")
    util = metadata.normalised(F.col("cpu_util_pct") * 4, F.col("cpus_per_node"))
    normal = samples.withColumn("cpu_util_pct", util)
    series = cpu.cpu_series(normal, [Metric("cpu_util_pct", "cpu_util", ("mean", "max"), above={"cpu_time_above_50pct": 50.0})])
    names = ["cpu_util_mean", "cpu_util_max", "cpu_time_above_50pct"]
    return rounded(average_over_series(series, ["job_id"], names))


def cpu_io_totals(spark: SparkSession, d: str) -> DataFrame:
    return rounded(cpu.cpu_series(tables.cpu_ts(spark, d), []).groupBy("job_id").agg(*cpu.io_totals()))


def cpu_mem_pressure(spark: SparkSession, d: str) -> DataFrame:
    series = cpu.cpu_series(tables.cpu_ts(spark, d), [])
    return rounded(series.groupBy("job_id").agg(cpu.memory_pressure().alias("mem_pressure")))


def cpu_mem_ratio(spark: SparkSession, d: str) -> DataFrame:
    ratio = cpu.memory_ratio(F.col("mem_rss_kb"), F.col("mem_avail_kb"))
    return rounded(
        tables.cpu_ts(spark, d)
        .withColumn("ratio", ratio)
        .groupBy("job_id", "node_id")
        .agg(F.count("ratio").alias("n"), F.min("ratio").alias("lo"), F.max("ratio").alias("hi"))
    )


def ri_cpu(spark: SparkSession, d: str) -> DataFrame:
    return rounded(cpu.cpu_imbalance(tables.cpu_ts(spark, d), decimals=None))


# Metadata and the wide row


def job_metadata(spark: SparkSession, d: str) -> DataFrame:
    jobs = metadata.job_metadata(metadata.latest_rows(tables.resubmitted(spark, d)))
    kept = [c for c in metadata.METADATA_COLUMNS if c not in ("start_timestamp", "end_timestamp")]
    seconds = [F.unix_seconds(f"{s}_timestamp").alias(f"{s}_s") for s in ("start", "end")]
    return rounded(jobs.select("job_id", *seconds, *kept, "cpus_per_node"))


def tres_parse(spark: SparkSession, d: str) -> DataFrame:
    """Allocation strings of every shape, derived from the orders."""
    key = F.col("o_orderkey")
    shapes = [
        F.concat(F.lit("cpu=8,mem=16G,100"), (key % 4).cast("string"), F.lit("="), (key % 5).cast("string")),
        F.concat(F.lit("1002="), (key % 7).cast("string"), F.lit("G")),
        F.concat(F.lit("1002="), (key % 7).cast("string"), F.lit(",billing="), (key % 3).cast("string")),
        F.concat(F.lit("1001=2,1002="), (key % 7).cast("string"), F.lit(".0")),
        F.lit(None).cast("string"),
        F.lit("1001"),
        F.concat(F.lit("1001= "), (key % 7).cast("string"), F.lit(" ")),
    ]
    tres = F.get(F.array(*shapes), (key % len(shapes)).cast("int"))
    return tables.table(spark, d, "orders").select(
        key.alias("job_id"), text.allocated_gpus(tres).alias("num_alloc_gpus"), text.gpu_type(tres).alias("gpu_type")
    )


def skip_short_jobs(spark: SparkSession, d: str) -> DataFrame:
    jobs = tables.jobs(spark, d)
    return jobs.where(metadata.ran_long_enough()).select("job_id", "runtime_seconds")


def described_jobs(spark: SparkSession, d: str) -> DataFrame:
    """Long enough jobs with telemetry, ready for the wide row."""
    index = tables.file_index(spark, d)
    joined = tables.jobs(spark, d).where(metadata.ran_long_enough()).join(index, "job_id")
    return joined.withColumn("has_gpu_logs", file_index.has_files("gpu"))


def job_summary_wide(spark: SparkSession, d: str) -> DataFrame:
    samples = tables.cpu_ts(spark, d), tables.gpu_ts(spark, d)
    wide = job_summary(described_jobs(spark, d), *samples, BUSY_PCT, imbalance_decimals=None)
    seconds = {f"{s}_timestamp": F.unix_seconds(f"{s}_timestamp") for s in ("start", "end")}
    return rounded(wide.withColumns(seconds))


# Raw formats, derived from the tables


def lenient_cast(spark: SparkSession, d: str) -> DataFrame:
    """Numbers with stray text among them."""
    value = F.col("value").cast("string")
    shapes = [value, F.concat(F.lit(" "), value), F.lit("N/A"), F.lit("[N/A]"), F.concat(value, F.lit("d")), F.lit("nan"), F.lit("inf"), F.concat(F.lit("+"), value), F.lit(""), F.concat(value, F.lit("e1"))]
    raw = F.get(F.array(*shapes), (F.col("event_id") % len(shapes)).cast("int"))
    return rounded(tables.table(spark, d, "events").select("event_id", text.to_number(raw).alias("number")))


def accounting_step_filter(spark: SparkSession, d: str) -> DataFrame:
    step = F.get(F.array(*[F.lit(s) for s in ("-4", "-1", "0", "batch", None, "-1.0", "14")]), (F.col("event_id") % 7).cast("int"))
    kept = tables.table(spark, d, "events").withColumn("step", step).where(~text.is_accounting_step(F.col("step")))
    return kept.groupBy("user_id").agg(F.count(F.lit(1)).alias("samples"), F.count("step").alias("with_step"))


def node_from_path(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    shapes = [
        F.concat(F.lit("gpu/0001/"), key, F.lit("-r62-n83.csv")),
        F.concat(F.lit("gpu/"), key, F.lit(".csv")),
        F.concat(key, F.lit("-node1.csv.gz")),
        F.concat(F.lit("a-b/"), key, F.lit("-.csv")),
    ]
    path = F.get(F.array(*shapes), (F.col("s_suppkey") % 4).cast("int"))
    return tables.table(spark, d, "supplier").select(
        "s_suppkey", text.node_from_path(path).alias("node_id"), text.names_a_node(path).alias("valid")
    )


def local_clock_to_utc(spark: SparkSession, d: str) -> DataFrame:
    """Order dates as wall clock seconds of one series per customer: the whole series takes the
    offset of its first row in file order, whatever its own dates are."""
    orders = tables.table(spark, d, "orders")
    samples = orders.select(
        F.col("o_custkey").alias("job_id"),
        "o_orderkey",
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double").alias("wall_s"),
        F.col("o_orderkey").alias("pos"),
    )
    shifted = logs.series_to_utc(samples, ["job_id"])
    return shifted.select("job_id", "o_orderkey", F.unix_seconds("ts").alias("utc_s"))


def sample_offset(spark: SparkSession, d: str) -> DataFrame:
    """Wall clock offset of every event time."""
    wall = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    offset = clock.wall_offset(wall).cast("bigint").alias("offset_s")
    return tables.table(spark, d, "events").select("event_id", offset)


def _gpu_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """The line items written out as GPU logs, one file per supplier and line number. Files of odd
    suppliers put their columns in another order; some cells hold text."""
    items = tables.table(spark, d, "lineitem")
    odd = F.col("l_suppkey") % 2 == 1
    gpu_index = F.when(F.col("l_returnflag") == "A", "0").when(F.col("l_returnflag") == "N", "1").otherwise("2")
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp")).cast("string")
    util = F.when(F.col("l_partkey") % 50 == 0, "N/A").otherwise((F.col("l_quantity") * 2).cast("string"))
    power = F.when(F.col("l_partkey") % 30 == 0, "[N/A]").otherwise((80 + F.col("l_quantity") * 4).cast("string"))
    cells = {
        "timestamp": seconds,
        "gpu_index": gpu_index,
        "utilization_gpu_pct": util,
        "utilization_memory_pct": F.round(F.col("l_discount") * 1000).cast("string"),
        "memory_used_MiB": F.floor("l_extendedprice").cast("string"),
        "memory_free_MiB": F.lit("100"),
        "temperature_gpu": F.round(30 + F.col("l_tax") * 500).cast("string"),
        "power_draw_W": power,
    }
    straight, turned = list(cells), list(reversed(cells))
    path = F.concat(F.lit("/gpu/"), F.col("l_suppkey").cast("string"), F.lit("-r"), F.col("l_linenumber").cast("string"), F.lit(".csv"))

    def joined(names: list[str]) -> Column:
        return F.concat_ws(",", *[cells[n] for n in names])

    body = items.select(
        path.alias("path_key"),
        _position(F.col("l_orderkey") * 100000 + F.col("l_partkey") + 1),
        F.when(odd, joined(turned)).otherwise(joined(straight)).alias("line"),
    )
    heads = items.select("l_suppkey", "l_linenumber").distinct().select(
        path.alias("path_key"),
        _position(F.lit(0)),
        F.when(odd, ",".join(turned)).otherwise(",".join(straight)).alias("line"),
    )
    return heads.unionByName(body)


def _written(lines: DataFrame, label: str) -> DataFrame:
    """Log lines on disk, in files as the tables' scans deal them out."""
    return materialise(lines, label)


def _position(row: Column) -> Column:
    return F.struct(F.lit(0).cast("bigint").alias("block"), row.cast("bigint").alias("row")).alias("pos")


def gpu_log_samples(spark: SparkSession, d: str) -> DataFrame:
    """GPU logs read back: columns by header name, unusable rows dropped, clock corrected."""
    records = logs.stage_records(_written(_gpu_log_lines(spark, d), "gpu-lines"), logs.GPU_COLUMNS)
    return _gpu_log_totals(records, _gpu_manifest(spark, d))


def gpu_log_files(spark: SparkSession, d: str) -> DataFrame:
    """The same from real files, one for every node of a job."""
    records = _from_files(_gpu_log_lines(spark, d), "gpu-logs", lambda x: logs.stage_records(x, logs.GPU_COLUMNS))
    return _gpu_log_totals(records, _gpu_manifest(spark, d))


def _gpu_manifest(spark: SparkSession, d: str) -> DataFrame:
    return file_index.log_manifest(tables.file_index(spark, d), "").where("kind = 'gpu'").select(
        "job_id", F.concat(F.lit("/"), "path_key").alias("path_key"), "node_id", "names_node"
    )


def _gpu_log_totals(records: DataFrame, manifest: DataFrame) -> DataFrame:
    samples = logs.tidy_gpu(logs.map_records(records, manifest, logs.GPU_COLUMNS))
    return rounded(
        samples.groupBy("job_id", "node_id", "gpu_index").agg(
            F.count(F.lit(1)).alias("samples"),
            F.sum("util_pct").alias("util_sum"),
            F.sum("mem_util_pct").alias("mem_util_sum"),
            F.sum("mem_used_kib").alias("mem_used_kib_sum"),
            F.count("power_w").alias("power_n"),
            F.sum("power_w").alias("power_sum"),
            F.sum("temperature").alias("temperature_sum"),
            F.sum(F.unix_seconds("ts") - F.lit(800000000)).alias("ts_sum"),
            F.min("file_ok").alias("file_ok"),
        )
    )


def _from_files(
    lines: DataFrame, label: str, stage: Callable[[DataFrame], DataFrame] = lambda scanned: scanned
) -> DataFrame:
    """Log lines written as one file for each log and scanned again; `path_key` is the log's again.

    `stage` is applied to the lines of one scan at a time, so if it writes them the driver never
    holds the names of more files than one scan has.
    """
    spark = lines.sparkSession
    folder = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    named = lines.select(F.replace("path_key", F.lit("/"), F.lit("!")).alias("log"), "pos", "line")
    log = F.substring_index(F.substring_index("path_key", "log=", -1), "/", 1)
    log = F.replace(log, F.lit("!"), F.lit("/"))
    scans = log_files.write_logs(named, folder)
    with log_files.small_files(spark):
        staged = [stage(logs.read_log_lines(spark, s.folders, s.small).withColumn("path_key", log)) for s in scans]
    return functools.reduce(DataFrame.unionByName, staged)


def _cpu_log_lines(spark: SparkSession, d: str) -> DataFrame:
    """The events written out as CPU logs, one file per user."""
    events = tables.table(spark, d, "events")
    step = F.when(F.col("event_type") == "signup", "-4").when(F.col("event_id") % 11 == 0, "").otherwise("0")
    node = F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("event_type"))
    seconds = F.when(F.col("event_id") % 17 == 0, "?").otherwise(F.unix_seconds(F.col("ts").cast("timestamp")).cast("string"))
    k = F.get_json_object("props", "$.k")
    rss = (F.floor("value") * 10).cast("string")
    cells = [step, node, seconds, F.floor("value").cast("string"), rss, k, k, (F.col("event_id") % 100).cast("string")]
    path = F.concat(F.lit("/cpu/"), F.col("user_id").cast("string"), F.lit("-timeseries.csv"))
    body = events.select(path.alias("path_key"), _position(F.col("event_id") + 1), F.concat_ws(",", *cells).alias("line"))
    heads = events.select("user_id").distinct().select(
        path.alias("path_key"), _position(F.lit(0)), F.lit(",".join(logs.CPU_COLUMNS)).alias("line")
    )
    return heads.unionByName(body)


def cpu_log_samples(spark: SparkSession, d: str) -> DataFrame:
    """CPU logs read back, normalised by the request of the job."""
    records = logs.stage_records(_written(_cpu_log_lines(spark, d), "cpu-lines"), logs.CPU_COLUMNS)
    return _cpu_log_totals(records, _cpu_manifest(spark, d))


def cpu_log_files(spark: SparkSession, d: str) -> DataFrame:
    """The same from real files, one for every job."""
    records = _from_files(_cpu_log_lines(spark, d), "cpu-logs", lambda x: logs.stage_records(x, logs.CPU_COLUMNS))
    return _cpu_log_totals(records, _cpu_manifest(spark, d))


def _cpu_manifest(spark: SparkSession, d: str) -> DataFrame:
    per_node = tables.jobs(spark, d).select("job_id", "cpus_per_node")
    manifest = file_index.log_manifest(tables.file_index(spark, d), "").where("kind = 'cpu'")
    return manifest.select("job_id", F.concat(F.lit("/"), "path_key").alias("path_key")).join(per_node, "job_id")


def _cpu_log_totals(records: DataFrame, manifest: DataFrame) -> DataFrame:
    samples = logs.tidy_cpu(logs.map_records(records, manifest, logs.CPU_COLUMNS))
    return rounded(
        samples.groupBy("job_id", "node_id").agg(
            F.count(F.lit(1)).alias("samples"),
            F.max("cpu_util_pct").alias("util_max"),
            F.sum("mem_rss_kb").alias("rss_sum"),
            F.count("mem_pct_utilization").alias("ratio_n"),
            F.max("mem_pct_utilization").alias("ratio_max"),
            F.sum("read_kb").alias("read_kb_total"),
            F.sum("write_kb").alias("write_kb_total"),
            F.min(F.unix_seconds("ts")).alias("first_s"),
        )
    )


def _index_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The index as the JSON object a collector writes, cut at closing braces."""
    entry = F.to_json(F.struct("cpu", "gpu"))
    key = F.concat(F.lit('"'), F.col("job_id").cast("string"), F.lit('": '))
    piece = F.concat(F.lit(", "), key, F.regexp_replace(entry, r"\}$", ""))
    return tables.file_index(spark, d).select(piece.alias("piece"), F.col("job_id").alias("pos"))


def file_index_explode(spark: SparkSession, d: str) -> DataFrame:
    parsed = file_index.parse_index_pieces(_index_pieces(spark, d))
    return file_index.log_manifest(parsed).select("job_id", "kind", "pos", "path", "node_id", "names_node")


def file_index_counts(spark: SparkSession, d: str) -> DataFrame:
    return file_index.index_counts(file_index.parse_index_pieces(_index_pieces(spark, d)))


# Incremental runs: finished orders are done, open ones were not started, pending ones failed


def _run_state(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    jobs = tables.jobs(spark, d)
    status = F.when(F.col("o_orderstatus") == "F", store.DONE).when(F.col("o_orderstatus") == "P", store.FAILED)
    ledger = jobs.select("job_id", status.alias("status")).where("status IS NOT NULL")
    index = tables.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job_id")).distinct()
    return jobs, index, store.done_jobs(ledger)


def pending_jobs(spark: SparkSession, d: str) -> DataFrame:
    return runs.pending_jobs(*_run_state(spark, d)).select("job_id", "runtime_seconds")


def run_accounting(spark: SparkSession, d: str) -> DataFrame:
    return runs.run_accounting(runs.job_states(*_run_state(spark, d)))


def run_plan(spark: SparkSession, d: str) -> DataFrame:
    jobs, index, done = _run_state(spark, d)
    return runs.plan_report(runs.pending_jobs(jobs, index, done), done, batch_size=500, existing_runs=3)


def job_batches(spark: SparkSession, d: str) -> DataFrame:
    """Pending jobs in submission order, 500 to a batch."""
    pending = runs.pending_jobs(*_run_state(spark, d)).select("job_id", "time_submit")
    order = [F.col("time_submit").isNull(), "time_submit"]
    return batch_numbers(pending, order, "job_id", 500).select("job_id", "batch")


def jobs_in_order(spark: SparkSession, d: str) -> DataFrame:
    pending = runs.pending_jobs(*_run_state(spark, d))
    return pending.select("job_id", F.col("time_submit").cast("bigint").alias("submit_s")).orderBy(
        F.asc_nulls_last("time_submit"), "job_id"
    )


def union_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Rows of two runs with different columns, written to a store and read as one table."""
    jobs, where = tables.jobs(spark, d), f"{scratch_dir(spark)}/store-{uuid.uuid4().hex}"
    store.write_summary(jobs.where("o_orderstatus = 'F'").select("job_id", "runtime_seconds", "num_nodes"), where, 1)
    store.write_summary(jobs.where("o_orderstatus <> 'F'").select("job_id", "queue_name", "runtime_seconds"), where, 2)
    return store.read_summaries(spark, where).select("job_id", "runtime_seconds", "num_nodes", "queue_name")


def ledger_repair(spark: SparkSession, d: str) -> DataFrame:
    """Jobs whose summary was written but whose ledger entry is missing."""
    jobs, _, done = _run_state(spark, d)
    ledger = done.withColumn("status", F.lit(store.DONE))
    written = jobs.where(metadata.ran_long_enough() & (F.col("o_orderstatus") != "O")).select("job_id")
    return store.unrecorded_jobs(ledger, written)


def done_set(spark: SparkSession, d: str) -> DataFrame:
    """Ledger and summaries united without duplicates."""
    jobs, _, done = _run_state(spark, d)
    summaries = jobs.where(metadata.ran_long_enough())
    return store.done_jobs(done.withColumn("status", F.lit(store.DONE)), summaries)


def ledger_states(spark: SparkSession, d: str) -> DataFrame:
    """What a run records of its jobs, one log of every seventh job being away."""
    bad = F.when(F.col("o_orderstatus") == "P", "unreadable")
    batch = tables.jobs(spark, d).withColumn("metadata_error", bad)
    manifest = file_index.log_manifest(tables.file_index(spark, d), "logs")
    away = (F.col("job_id") % 7 == 0) & (F.col("kind") == "gpu") & (F.col("pos") == 0)
    entries = runs.ledger_entries(batch, runs.count_logs(manifest, manifest.where(~away).select("path_key")))
    return entries.groupBy("status").agg(F.count(F.lit(1)).alias("jobs"), F.sum("logs_found").alias("logs_found"))


def scheduler_two_orders(spark: SparkSession, d: str) -> DataFrame:
    """Scheduler exports in two files whose columns stand in different orders, read as one table."""
    rows = tables.scheduler_rows(spark, d)
    folder = f"{scratch_dir(spark)}/scheduler-{uuid.uuid4().hex}"
    open_, closed = rows.where("exit_code = 'n/a'"), rows.where("exit_code <> 'n/a'")
    turned = sorted(c for c in open_.columns if c != "partition")  # this one lacks a column too
    open_.select(turned).write.option("header", True).option("escape", '"').csv(f"{folder}/open")
    closed.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(f"{folder}/closed")
    read = read_scheduler_csv(spark, folder)
    return read.select("id_job", "time_submit", "nodes_alloc", "tres_alloc", "partition", "id_user")


# Overview reports


def _report(name: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        result = reports.REPORTS[name](tables.overview(spark, d))
        if "date" in result.columns:
            result = result.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
        return rounded(result)

    return query


def job_overview(spark: SparkSession, d: str) -> DataFrame:
    ov = tables.overview(spark, d)
    return rounded(ov.drop("start_timestamp").withColumn("date", F.date_format("date", "yyyy-MM-dd")))


def busiest_days_top10(spark: SparkSession, d: str) -> DataFrame:
    top = reports.busiest_days(tables.overview(spark, d), 10)
    return top.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


QUERIES = {
    f.__name__: f
    for f in (
        gpu_series_stats, gpu_job_stats, gpu_percentiles, gpu_time_above, gpu_active_counts,
        gpu_active_semijoin, gpu_power_energy, gpu_power_variability, gpu_mem_totals,
        gpu_time_to_first_use, gpu_node_signal, ri_gpu, cpu_job_stats, cpu_percentiles,
        cpu_time_above, cpu_normalised_util, cpu_io_totals, cpu_mem_pressure, cpu_mem_ratio,
        ri_cpu, job_metadata, tres_parse, skip_short_jobs, job_summary_wide, lenient_cast,
        accounting_step_filter, node_from_path, local_clock_to_utc, sample_offset,
        gpu_log_samples, cpu_log_samples, gpu_log_files, cpu_log_files, scheduler_two_orders, file_index_explode, file_index_counts, pending_jobs,
        run_accounting, run_plan, job_batches, jobs_in_order, union_chunks, ledger_repair,
        done_set, ledger_states, job_overview, busiest_days_top10,
    )
}
QUERIES |= {name: _report(name) for name in reports.REPORTS}
