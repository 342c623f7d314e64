"""The test tables seen as telemetry: suppliers as GPU jobs, users as CPU jobs, orders as the
scheduler's jobs.

Samples are whole numbers (or quarters), as counters and percentages of real logs are. Sums of
them are exact in any order, so two engines can be compared digit by digit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.functions.text import allocated_gpus, gpu_type, to_text
from jobmetrics.plans.metadata import add_resource_hours, cpus_per_node
from jobmetrics.plans.reports import job_overview
from jobmetrics.session import configure

# Every device of the test data is busier than 2 %, so a higher threshold separates them.
BUSY_PCT = 50.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def gpu_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey AS job_id",
        "concat('r', CAST(l_linenumber AS STRING)) AS node_id",
        "CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS gpu_index",
        "CAST(l_shipdate AS TIMESTAMP) AS ts",
        "l_quantity * 2 AS util_pct",
        "round(l_discount * 1000) AS mem_util_pct",
        "CAST(floor(l_extendedprice) AS DOUBLE) AS mem_used_kib",
        "80 + l_quantity * 4 AS power_w",
        "round(30 + l_tax * 500) AS temperature",
    )


def cpu_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is a sample of the node that its type names."""
    events = table(spark, sf_dir, "events")
    with_k = events.withColumn("k", F.expr("CAST(get_json_object(props, '$.k') AS DOUBLE)"))
    return with_k.selectExpr(
        "user_id AS job_id",
        "event_type AS node_id",
        "CAST(ts AS TIMESTAMP) AS ts",
        "floor(value) / 4.0D AS cpu_util_pct",
        "floor(value) * 10.0D AS mem_rss_kb",
        "k * 100 AS mem_avail_kb",
        "CASE WHEN k > 0 THEN floor(value) * 10.0D / (k * 100) END AS mem_pct_utilization",
        "k * 1024.0D AS read_kb",
        "CAST(event_id % 100 AS DOUBLE) * 1024 AS write_kb",
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the end and the node count their line items give them."""
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("end_ts"), F.countDistinct("l_suppkey").alias("nodes")
    )
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .join(lines, "o_orderkey", "left")
        .select(
            "o_orderkey",
            "o_orderstatus",
            F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("start_s"),
            F.unix_seconds(F.col("end_ts").cast("timestamp")).alias("end_s"),
            # Some jobs have no node count.
            F.when(key % 89 != 0, F.col("nodes")).alias("nodes"),
            F.concat(
                F.lit("cpu=8,mem=16G,100"), (key % 4).cast("string"), F.lit("="), (key % 5).cast("string")
            ).alias("tres_alloc"),
            F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")).alias("partition"),
            F.when(F.col("o_orderstatus") == "O", "0")
            .when(F.col("o_orderstatus") == "F", "1")
            .otherwise("n/a")
            .alias("exit_code"),
            F.col("o_custkey").cast("string").alias("id_user"),
        )
    )


def scheduler_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scheduler rows, every column as text like a scheduler export."""

    def string(name: str, alias: str):
        return F.col(name).cast("string").alias(alias)

    return _orders(spark, sf_dir).select(
        string("o_orderkey", "id_job"),
        string("start_s", "time_submit"),
        string("start_s", "time_start"),
        string("end_s", "time_end"),
        string("nodes", "nodes_alloc"),
        (F.col("o_orderkey") % 17).cast("string").alias("cpus_req"),
        "tres_alloc",
        "partition",
        "exit_code",
        "id_user",
    )


def resubmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduler rows in which some jobs also appear with an earlier submission."""
    rows = scheduler_rows(spark, sf_dir)
    earlier = rows.where("id_job % 3 = 0").withColumns(
        {"time_submit": F.lit("1000"), "tres_alloc": F.lit("1001=9"), "exit_code": F.lit("7")}
    )
    return rows.unionByName(earlier)


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same jobs with typed metadata, as a run keeps them."""
    typed = _orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("job_id"),
        "o_orderstatus",
        F.timestamp_seconds("start_s").alias("start_timestamp"),
        F.timestamp_seconds("end_s").alias("end_timestamp"),
        F.coalesce(F.col("end_s") - F.col("start_s"), F.lit(0)).alias("runtime_seconds"),
        F.col("nodes").cast("double").alias("num_nodes"),
        allocated_gpus(F.col("tres_alloc")).alias("num_alloc_gpus"),
        gpu_type(F.col("tres_alloc")).alias("gpu_type"),
        F.col("id_user").alias("user_id"),
        F.col("partition").alias("queue_name"),
        to_text(F.col("exit_code")).alias("exit_code"),
        (F.col("o_orderkey") % 17).cast("double").alias("cpus_req"),
        F.col("start_s").cast("double").alias("time_submit"),
    )
    return add_resource_hours(typed).withColumn("cpus_per_node", cpus_per_node())


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report columns of the jobs that ran long enough; jobs with allocated GPUs are GPU jobs."""
    return job_overview(jobs(spark, sf_dir).where("runtime_seconds > 10"))


def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows for every job with telemetry, as a collector would have written them."""
    gpu = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_suppkey").alias("job_id"), F.col("l_linenumber").alias("line"))
        .distinct()
        .groupBy("job_id")
        .agg(F.sort_array(F.collect_list(F.concat_ws("", F.lit("gpu/"), "job_id", F.lit("-r"), "line", F.lit(".csv")))).alias("gpu"))
    )
    cpu = (
        table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id")).distinct()
        .select("job_id", F.array(F.concat_ws("", F.lit("cpu/"), "job_id", F.lit("-timeseries.csv"))).alias("cpu"))
    )
    return cpu.join(gpu, "job_id", "full_outer").select("job_id", "cpu", "gpu")
