"""Cells, ids, headers and index entries at their limits, damaged files, and jobs that fail."""

import gzip
import json

import pytest

from jobmetrics.functions.text import to_integer
from jobmetrics.plans import runs
from jobmetrics.sources import logs
from jobmetrics.sources.index import read_index_lines
from pyspark.sql import functions as F


def test_integers_are_exact_or_null(spark):
    cells = ["9007199254740992", "9007199254740993", "12.0", "1e30", "99999999999999999999", "x", "", None, " 7 "]
    rows = spark.createDataFrame([(c,) for c in cells], "c string").select(to_integer(F.col("c")).alias("n")).collect()
    assert [r.n for r in rows] == [9007199254740992, 9007199254740993, 12, None, None, None, None, None, 7]


def test_last_index_line_wins(spark, tmp_path):
    lines = [{"job_id": "4", "cpu": ["old"], "gpu": []}, {"job_id": "4", "cpu": ["new"], "gpu": ["g"]}, {"job_id": "no", "cpu": []}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, lines)))
    assert [tuple(r) for r in read_index_lines(spark, str(tmp_path)).collect()] == [(4, ["new"], ["g"])]


def test_only_the_job_at_fault_stays_failed(spark, monkeypatch):
    class Broken(Exception):
        pass

    def fail(_spark, _cfg, batch, _run_id):
        if batch.where("job_id = 3").count():
            raise Broken("bad job")

    columns = "job_id long, metadata_error string, time_submit double, runtime_seconds long, cpu array<string>, gpu array<string>"
    table = spark.createDataFrame([(k, None, None, 60, ["c"], []) for k in range(1, 6)], columns)
    recorded = []
    monkeypatch.setattr(runs, "repair_ledger", lambda *_: None)
    for name in ("latest_rows", "read_scheduler_csv", "job_metadata", "pending_jobs", "_done"):
        monkeypatch.setattr(runs, name, lambda *_a, **_k: table)
    monkeypatch.setattr(runs, "process_batch", fail)
    monkeypatch.setattr(runs.results, "next_run_id", lambda *_: 1)
    monkeypatch.setattr(runs.results, "append_ledger", lambda entries, *_: recorded.extend(map(tuple, entries.collect())))
    cfg = runs.RunConfig(scheduler_csv="x", file_index="x", base_uri="x", store="x", output=None)
    with pytest.raises(Broken):
        runs.process_index(spark, cfg, table, raise_errors=True)
    assert recorded == [(3, "failed", "bad job")]
    assert runs.process_index(spark, cfg, table) == [1, 1]  # jobs 1 and 2, jobs 4 and 5


def test_records_that_contain_column_names_are_kept(spark, tmp_path):
    header = "Step,Node,EpochTime,CPUUtilization,RSS,VMSize,ReadMB,WriteMB"
    lines = ["", header, "0,Node01,1620000000,100,1,2,0,0", "Step-7,Node,1620000005,100,1,2,0,0", "0,RSS,1620000009,100,1,2,0,0"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("x,y\n1,Node\n")
    scanned = logs.read_log_lines(spark, str(tmp_path))
    manifest = scanned.select("path_key").distinct().selectExpr("1L AS job_id", "path_key", "4.0D AS cpus_per_node")
    records = logs.map_columns(scanned, manifest, logs.CPU_COLUMNS)
    assert sorted(r.Node for r in records.where("has_Node").collect()) == ["Node", "Node01", "RSS"]
    assert records.where("NOT has_Node").count() == 1


def test_half_a_file_is_not_taken_for_the_whole(spark, tmp_path):
    packed = gzip.compress("\n".join(map(str, range(200_000))).encode())
    (tmp_path / "a.csv.gz").write_bytes(packed[: len(packed) // 2])
    with pytest.raises(Exception):
        logs.read_log_lines(spark, str(tmp_path)).count()
