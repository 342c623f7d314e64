from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from jobmetrics.functions import clock, text
from jobmetrics.plans.metadata import cpus_per_node, job_metadata, latest_rows, normalised

SCHEDULER = "id_job string, time_submit string, time_start string, time_end string, nodes_alloc string, cpus_req string, tres_alloc string, partition string, exit_code string, id_user string"


def one(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_numbers_are_parsed_leniently(spark):
    values = ["80.0", " 7 ", "+1", "-2.5e1", ".5", "5.", "N/A", "[N/A]", "12d", "nan", "inf", "0x10", "", None, "1 2"]
    expected = [80.0, 7.0, 1.0, -25.0, 0.5, 5.0] + [None] * 9
    assert one(spark, values, text.to_number) == expected


def test_unparseable_is_not_missing(spark):
    assert one(spark, ["x", "3", None, "nan"], text.is_unparseable) == [True, False, False, False]


def test_accounting_steps(spark):
    steps = ["-4", "-1", "-4.0", "0", "batch", None, "4"]
    assert one(spark, steps, text.is_accounting_step) == [True, True, True, False, False, False, False]


@pytest.mark.parametrize(
    ("tres", "count", "kind"),
    [
        ("cpu=8,mem=16G,1002=2", 2, "volta"),
        ("cpu=8,1001=1", 1, "tesla"),
        ("cpu=8,mem=16G", 0, None),
        ("1002=2G", 0, "volta"),
        ("1002=2,billing=8", 8, "volta"),
        ("1001=1,1002=2.0", 0, "tesla"),
        ("", 0, None),
        (None, 0, None),
    ],
)
def test_allocation_strings(spark, tres, count, kind):
    assert one(spark, [tres], text.allocated_gpus) == [count]
    assert one(spark, [tres], text.gpu_type) == [kind]


def test_node_from_path(spark):
    paths = ["a/123-r62-n83.csv", "123.csv", "x-y/5-node1.csv.gz"]
    assert one(spark, paths, text.node_from_path) == ["r62-n83", "", "node1"]
    assert one(spark, paths, text.names_a_node) == [True, False, True]


def test_csv_fields(spark):
    lines = ["a,b,c", "a,,c", 'x,"b, c",d', '"say ""hi""",2', "a,b,"]
    expected = [["a", "b", "c"], ["a", "", "c"], ["x", "b, c", "d"], ['say "hi"', "2"], ["a", "b", ""]]
    assert one(spark, lines, text.split_csv_line) == expected


def test_wall_offset_matches_zone_rules(spark):
    zone = ZoneInfo("America/New_York")
    edges = [datetime(2021, 3, 14, 1), datetime(2021, 11, 7, 0), datetime(2021, 7, 1)]
    walls = [e.replace(tzinfo=timezone.utc).timestamp() + 900 * k for e in edges for k in range(20)]
    expected = [
        datetime.fromtimestamp(w, timezone.utc).replace(tzinfo=zone).utcoffset().total_seconds() for w in walls
    ]
    assert one(spark, walls, clock.wall_offset, "double") == expected


def scheduler(spark, *rows):
    return spark.createDataFrame(rows, SCHEDULER)


def test_job_metadata(spark):
    raw = scheduler(
        spark,
        ("1", "5", "1621000000", "1621003600", "2", "8", "cpu=8,mem=16G,1002=2", " GPU ", "0", "u1"),
        ("2", "6", None, "1621003600", "2", "8", None, "cpu", "n/a", "u2"),
        ("3", "7", "100.5", "90.0", "0", None, "", None, "1", "u3"),
        ("4", "8", "100", "200", "two", "x", "1001=1", "p", "0", "u4"),
    )
    jobs = {r.job_id: r for r in job_metadata(latest_rows(raw)).collect()}
    first = jobs[1]
    assert (first.runtime_seconds, first.node_hours, first.gpu_hours) == (3600, 2.0, 4.0)
    assert (first.num_alloc_gpus, first.gpu_type, first.queue_name) == (2, "volta", " GPU ")
    assert first.start_timestamp.replace(tzinfo=timezone.utc).timestamp() == 1621000000 or first.start_timestamp.timestamp() == 1621000000
    assert (jobs[2].runtime_seconds, jobs[2].node_hours, jobs[2].exit_code) == (0, None, None)
    assert jobs[3].runtime_seconds == -10 and jobs[3].gpu_hours is None
    assert jobs[4].metadata_error == "nodes_alloc is not a number" and jobs[4].cpus_error
    assert first.metadata_error is None and first.project_id is None


def test_latest_submission_wins(spark):
    rows = [("1", str(t), "0", str(100 + t), "1", "1", None, "p", "0", "u") for t in (5, 9, 7)]
    kept = latest_rows(scheduler(spark, *rows)).collect()
    assert [(r.job_id, r.time_end) for r in kept] == [(1, "109")]


def test_cpu_normalisation(spark):
    rows = [(400.0, 8.0, 2.0), (400.0, 8.0, 0.0), (400.0, 8.0, -1.0), (400.0, 0.0, 2.0), (400.0, None, 2.0), (400.0, 8.0, None)]
    df = spark.createDataFrame(rows, "raw double, cpus_req double, num_nodes double")
    out = [r[0] for r in df.select(normalised(F.col("raw"), cpus_per_node())).collect()]
    assert out == [100.0, 50.0, 50.0, 400.0, 400.0, 400.0]
