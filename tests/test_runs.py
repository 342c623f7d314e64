"""Whole runs over files: reading, resuming, repairing."""

import dataclasses
import gzip
import json
import os
from datetime import timezone

import pytest

from jobmetrics.plans import runs
from jobmetrics.plans.runs import RunConfig, run, run_plan
from jobmetrics.plans.reports import REPORTS, write_reports
from jobmetrics.sources import index, logs, store
from jobmetrics.sources.scheduler import read_scheduler_csv
from jobmetrics.streaming.manifests import process_new_manifests

GPU_HEADER = "timestamp,gpu_index,utilization_gpu_pct,utilization_memory_pct,memory_used_MiB,memory_free_MiB,temperature_gpu,temperature_memory,power_draw_W,pcie_link_width_current"
CPU_HEADER = "Step,Node,EpochTime,CPUUtilization,RSS,VMSize,ReadMB,WriteMB"
SCHEDULER_HEADER = "id_job,time_submit,time_start,time_end,nodes_alloc,cpus_req,tres_alloc,partition,exit_code,id_user"


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def gpu_line(t, gpu=0, util="64.0", power="180.0"):
    return f"{t},{gpu},{util},12.5,3072,5120,48,44,{power},8"


@pytest.fixture
def site(tmp_path):
    """A small log store with every kind of oddity."""
    base = str(tmp_path / "logs")
    write(f"{base}/gpu/1-n1.csv", GPU_HEADER, gpu_line(1620000000, power="[N/A]"), gpu_line(1620000007), gpu_line(1620000019, util="unknown"))
    reordered = ",".join(reversed(GPU_HEADER.split(",")))
    write(f"{base}/gpu/1-n2.csv", reordered, ",".join(reversed(gpu_line(1620000000, util="32.0").split(","))))
    write(f"{base}/gpu/2.csv", GPU_HEADER, gpu_line(1620000000))  # no node in the name
    write(f"{base}/gpu/5-n1.csv", GPU_HEADER, gpu_line(1620000000), gpu_line(1620000010) + ",9,9")  # too wide
    cpu = ["0,a,1620000000,400,100,200,1,2", "-4,a,1620000010,9999,1,1,9,9", ",a,1620000020,200,100,0,1,2", "0,a,x,1,1,1,1,1", "0,,1620000030,1,400,200,5,5"]
    write(f"{base}/cpu/1-timeseries.csv", CPU_HEADER, *cpu)
    write(f"{base}/cpu/2 b-timeseries.csv", CPU_HEADER, *cpu)
    write(f"{base}/cpu/3-timeseries.csv", CPU_HEADER.replace("VMSize", "Other"), *cpu)
    entries = {
        "1": {"cpu": ["cpu/1-timeseries.csv", "cpu/ignored.csv"], "gpu": ["gpu/1-n1.csv", "gpu/1-n2.csv"]},
        "2": {"cpu": ["cpu/2 b-timeseries.csv"], "gpu": ["gpu/2.csv"]},
        "3": {"cpu": ["cpu/3-timeseries.csv"]},
        "4": {"cpu": ["cpu/missing.csv"], "gpu": []},
        "5": {"cpu": [], "gpu": ["gpu/5-n1.csv"]},
        "6": {"cpu": ["cpu/1-timeseries.csv"], "gpu": []},
        "7": {"cpu": ["cpu/1-timeseries.csv"], "gpu": []},
        "99": {"cpu": ["cpu/1-timeseries.csv"], "gpu": []},
    }
    with open(tmp_path / "index.json", "w") as f:
        json.dump(entries, f, indent=1)
    lines = [json.dumps({"job_id": k, **v}) for k, v in entries.items()]
    write(str(tmp_path / "manifests" / "first.json"), *lines[:3])
    job = "{0},{1},1620000000,{2},2,8,\"cpu=8,1002=2\", GPU ,0,u"
    rows = [job.format(k, 1000 - k, 1620003600) for k in range(1, 6)]
    rows += [job.format(6, 1, 1620000010), "7,2,1620000000,1620003600,many,8,,p,0,u", job.format(8, 3, 1620003600)]
    write(str(tmp_path / "jobs.csv"), SCHEDULER_HEADER, *rows)
    return tmp_path, lines


def config(path, **kw):
    return RunConfig(
        scheduler_csv=str(path / "jobs.csv"), file_index=str(path / "index.json"), store=str(path / "store"),
        base_uri=str(path / "logs"), output=str(path / "out"), **kw,
    )


def ledger(spark, path):
    """The last state of every job."""
    return {r.job_id: r.status for r in store.read_ledger(spark, str(path / "store")).orderBy("run_id").collect()}


def test_run_end_to_end(spark, site):
    path, _ = site
    cfg = config(path)
    plan = run_plan(spark, cfg).first()
    assert (plan.to_process, plan.already_done, plan.batches, plan.existing_runs) == (7, 0, 1, 0)

    assert run(spark, cfg) == [1]
    rows = {r.job_id: r for r in spark.read.parquet(str(path / "out")).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    one = rows[1]
    assert one.is_gpu_job and one.num_gpus_used == 2 and one.num_gpus_total_in_logs == 2
    assert one.gpu_util_mean == 48.0 and one.gpu_power_mean_total_w == 360.0 and one.gpu_mem_used_kib_sum == 2 * 3072 * 1024
    assert one.gpu_energy_total_wh == 360.0 and one.time_to_gpu_use_s == 0.0
    assert one.cpu_util_mean == 75.0 and one.cpu_util_max == 100.0  # over 8 / 2 CPUs
    assert one.mem_pct_util_mean == 0.5 and one.read_kb_total == 7 * 1024.0
    assert one.ri_spatial_gpu_util == 0.25
    assert not rows[2].is_gpu_job and rows[2].num_gpus_used is None and rows[2].cpu_util_mean == 75.0
    assert rows[3].cpu_util_mean is None and rows[3].read_kb_total is None and not rows[3].is_gpu_job
    assert rows[4].cpu_util_mean is None and rows[4].ri_temporal_cpu_util is None
    assert rows[5].is_gpu_job and rows[5].num_gpus_used is None and rows[5].ri_temporal_gpu_util is None
    states = ledger(spark, path)
    assert states == {**dict.fromkeys(range(1, 6), "done"), 4: "missing_logs", 6: "skipped", 7: "failed"}

    # Only the failed job and the one that misses a log come back; nothing is written twice.
    assert run_plan(spark, cfg).first().to_process == 2
    assert run(spark, cfg) == [2]
    assert spark.read.parquet(str(path / "out")).count() == 5 == store.read_summaries(spark, cfg.store).count()
    write(str(path / "logs/cpu/missing.csv"), CPU_HEADER, "0,a,1620000000,300,100,200,1,2")
    assert run(spark, cfg) == [3]
    assert ledger(spark, path)[4] == "done" and run_plan(spark, cfg).first().to_process == 1
    assert {r.job_id: r.cpu_util_mean for r in spark.read.parquet(str(path / "out")).collect()}[4] == 75.0
    assert len(spark.read.parquet(str(path / "out")).columns) == 145
    assert write_reports(spark.read.parquet(str(path / "out")), str(path / "reports")) == list(REPORTS)
    split = spark.read.parquet(str(path / "reports" / "job_type_split")).collect()
    assert [(r.is_gpu_job, r["count"]) for r in split] == [(True, 5)]


def test_batches_and_crash_between_the_two_writes(spark, site, monkeypatch):
    path, _ = site
    cfg = config(path, batch_size=2)
    real = store.append_ledger

    def crash(*_):
        raise RuntimeError("gone")

    monkeypatch.setattr(store, "append_ledger", crash)
    assert run(spark, cfg) == []  # every batch lost its ledger entry, one left its summary
    monkeypatch.setattr(store, "append_ledger", real)
    written = store.read_summaries(spark, cfg.store).select("job_id").collect()
    assert len({r.job_id for r in written}) == len(written) > 0

    run(spark, cfg)
    out = [r.job_id for r in spark.read.parquet(cfg.output).collect()]
    assert sorted(out) == [1, 2, 3, 4, 5]
    states = ledger(spark, path)
    assert {k for k, v in states.items() if v == "done"} == {1, 2, 3, 5} and states[6] == "skipped" and states[4] == "missing_logs"
    assert run_plan(spark, cfg).first().to_process == 2


def test_wrong_base_uri_commits_no_job(spark, site):
    path, _ = site
    cfg = config(path)
    run(spark, dataclasses.replace(cfg, base_uri=str(path / "nowhere"), output=None))
    assert set(ledger(spark, path).values()) == {"missing_logs", "skipped", "failed"}
    assert run_plan(spark, cfg).first().to_process == 6
    run(spark, cfg)
    assert {k for k, v in ledger(spark, path).items() if v == "done"} == {1, 2, 3, 5}
    rows = {r.job_id: r for r in spark.read.parquet(cfg.output).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5] and rows[1].gpu_util_mean == 48.0


def test_a_damaged_log_spoils_only_its_part(spark, tmp_path):
    lines = "\n".join([GPU_HEADER, *[gpu_line(1620000000 + k) for k in range(50_000)]])
    packed = gzip.compress(lines.encode())
    os.makedirs(tmp_path / "logs")
    (tmp_path / "logs/1-n1.csv.gz").write_bytes(packed[: len(packed) // 2])
    write(str(tmp_path / "logs/1-cpu.csv"), CPU_HEADER, "0,a,1620000000,300,100,200,1,2")
    write(str(tmp_path / "logs/2-n1.csv"), GPU_HEADER, gpu_line(1620000000))
    index_ = {"1": {"cpu": ["1-cpu.csv"], "gpu": ["1-n1.csv.gz"]}, "2": {"cpu": [], "gpu": ["2-n1.csv"]}}
    (tmp_path / "index.json").write_text(json.dumps(index_))
    rows = ["{0},1,1620000000,1620003600,2,8,\"cpu=8,1002=2\",p,0,u".format(k) for k in (1, 2)]
    write(str(tmp_path / "jobs.csv"), SCHEDULER_HEADER, *rows)
    cfg = config(tmp_path)
    run(spark, cfg)
    rows = {r.job_id: r for r in spark.read.parquet(cfg.output).collect()}
    assert rows[1].cpu_util_mean == 75.0 and not rows[1].is_gpu_job and rows[1].gpu_util_mean is None
    assert rows[2].is_gpu_job and rows[2].gpu_util_mean == 64.0
    entries = {r.job_id: r for r in store.read_ledger(spark, cfg.store).collect()}
    assert entries[1].status == entries[2].status == "done" and "gpu logs left out" in entries[1].error


def test_the_old_output_stays_until_the_new_one_is_written(spark, tmp_path, monkeypatch):
    where, out = str(tmp_path / "s"), str(tmp_path / "out")
    store.write_summary(spark.range(2).selectExpr("id AS job_id", "0L AS logs_missing"), where, 1)
    assert store.assemble(spark, where, out) and spark.read.parquet(out).count() == 2
    store.write_summary(spark.range(2, 5).selectExpr("id AS job_id", "id - 2 AS logs_missing"), where, 2)
    store.write_summary(spark.range(3, 5).selectExpr("id AS job_id", "id - 3 AS logs_missing"), where, 3)
    with monkeypatch.context() as m:
        m.setattr(store, "replace_path", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.assemble(spark, where, out)
    assert spark.read.parquet(out).count() == 2
    assert store.assemble(spark, where, out)
    assert sorted(r.job_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    done = store.done_jobs(store.read_ledger(spark, where), store.read_summaries(spark, where))
    assert sorted(r.job_id for r in done.collect()) == [0, 1, 2, 3]


def test_headers_do_not_depend_on_how_files_are_packed(spark, tmp_path):
    for k in range(6):
        write(str(tmp_path / f"{k}-n.csv"), GPU_HEADER, *[gpu_line(1620000000 + i) for i in range(5 + k)])
    lines = logs.read_log_lines(spark, str(tmp_path))
    manifest = lines.select("path_key").distinct().selectExpr("1L AS job_id", "path_key", "'n' AS node_id", "true AS names_node")
    records = logs.stage_records(lines, logs.GPU_COLUMNS)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "200000000")
        mapped = logs.map_records(records, manifest, logs.GPU_COLUMNS)
        assert mapped.count() == sum(range(5, 11)) and mapped.where("gpu_index <> '0'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_scheduler_files_with_other_column_orders(spark, tmp_path):
    write(str(tmp_path / "a.csv"), "id_job,partition,tres_alloc", '9,p,"cpu=8,1002=2"', "8,,x,too,many")
    write(str(tmp_path / "b.csv"), "partition,extra,id_job", '"say ""hi""",1,10')
    rows = read_scheduler_csv(spark, str(tmp_path)).select("id_job", "partition", "tres_alloc", "id_user").collect()
    assert sorted(map(tuple, rows)) == [("10", 'say "hi"', None, None), ("8", None, "x", None), ("9", "p", "cpu=8,1002=2", None)]


def test_jobs_are_split_by_their_files(spark, site, monkeypatch):
    path, _ = site
    monkeypatch.setattr(runs, "FILES_PER_SPLIT", 4)
    assert len(run(spark, config(path))) > 1
    rows = {r.job_id: r for r in spark.read.parquet(str(path / "out")).collect()}
    assert rows[1].gpu_util_mean == 48.0 and rows[2].cpu_util_mean == 75.0 and rows[4].cpu_util_mean is None


def test_stream_of_manifests(spark, site):
    path, lines = site
    cfg = config(path, index_format="lines")
    args = (spark, cfg, str(path / "manifests"), str(path / "stream"))
    process_new_manifests(*args)
    assert sorted(r.job_id for r in spark.read.parquet(cfg.output).collect()) == [1, 2, 3]
    write(str(path / "manifests" / "second.json"), *lines[2:])
    process_new_manifests(*args)
    assert sorted(r.job_id for r in spark.read.parquet(cfg.output).collect()) == [1, 2, 3, 4, 5]


def test_index_object(spark, site):
    path, _ = site
    idx = index.read_index_object(spark, str(path / "index.json"))
    rows = {r.job_id: r for r in idx.collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 99] and rows[3].gpu is None and rows[4].gpu == []
    counts = index.index_counts(idx).first()
    assert (counts.jobs, counts.jobs_with_cpu, counts.jobs_with_gpu) == (8, 7, 3)
    manifest = index.log_manifest(idx, "base").where("job_id = 1").orderBy("kind", "pos").collect()
    assert [(m.kind, m.pos, m.uri) for m in manifest] == [
        ("cpu", 0, "base/cpu/1-timeseries.csv"), ("gpu", 0, "base/gpu/1-n1.csv"), ("gpu", 1, "base/gpu/1-n2.csv"),
    ]


def test_index_with_braces_in_a_path_is_refused(spark, tmp_path):
    write(str(tmp_path / "i.json"), json.dumps({"1": {"cpu": ["a}b.csv"]}}))
    with pytest.raises(Exception, match="(?i)index entry|malformed"):
        index.read_index_object(spark, str(tmp_path / "i.json")).collect()


def test_series_keeps_its_first_offset_over_a_clock_change(spark, tmp_path):
    before, after = 1636243200, 1636286400  # 2021-11-07 00:00 and 12:00 on the wall clock
    lines = [gpu_line(before, util="bad"), gpu_line(after), gpu_line(before), gpu_line(before, gpu=1)]
    write(str(tmp_path / "8-n.csv"), GPU_HEADER, *lines)
    scanned = logs.read_log_lines(spark, str(tmp_path))
    manifest = scanned.select("path_key").distinct().selectExpr("8L AS job_id", "path_key", "'n' AS node_id", "true AS names_node")
    rows = logs.tidy_gpu(logs.map_columns(scanned, manifest, logs.GPU_COLUMNS)).collect()
    seconds = sorted((r.gpu_index, int(r.ts.replace(tzinfo=timezone.utc).timestamp()) if r.ts.tzinfo is None else 0) for r in rows)
    epochs = sorted((r.gpu_index, e) for r, e in zip(rows, [x.e for x in logs.tidy_gpu(logs.map_columns(scanned, manifest, logs.GPU_COLUMNS)).selectExpr("unix_seconds(ts) AS e").collect()]))
    assert len(seconds) == 3
    assert epochs == [(0, before + 5 * 3600), (0, after + 5 * 3600), (1, before + 4 * 3600)]


def test_missing_columns_spoil_the_gpu_part(spark, tmp_path):
    write(str(tmp_path / "1-n.csv"), GPU_HEADER.replace("memory_free_MiB", "x"), gpu_line(1620000000))
    write(str(tmp_path / "2-n.csv"), "foo,bar", "1,2")
    write(str(tmp_path / "3-n.csv"), GPU_HEADER)
    scanned = logs.read_log_lines(spark, str(tmp_path))
    manifest = scanned.select("path_key").distinct().selectExpr(
        "CAST(regexp_extract(path_key, '([0-9])-n', 1) AS BIGINT) AS job_id", "path_key", "'n' AS node_id", "true AS names_node"
    )
    rows = logs.tidy_gpu(logs.map_columns(scanned, manifest, logs.GPU_COLUMNS)).collect()
    assert {(r.job_id, r.file_ok, r.has_util) for r in rows} == {(1, False, True), (2, False, False)}


def test_runs_are_united_by_column_name(spark, tmp_path):
    where = str(tmp_path / "s")
    assert store.read_summaries(spark, where) is None and store.next_run_id(spark, where) == 1
    store.write_summary(spark.range(2).selectExpr("id AS job_id", "1.5D AS a"), where, 1)
    store.write_summary(spark.range(2, 3).selectExpr("id AS job_id", "'x' AS b"), where, 4)
    rows = {r.job_id: (r.a, r.b, r.run_id) for r in store.read_summaries(spark, where).collect()}
    assert rows == {0: (1.5, None, 1), 1: (1.5, None, 1), 2: (None, "x", 4)}
    assert store.next_run_id(spark, where) == 5
    os.makedirs(f"{where}/summary/run_id=7/_temporary")  # a write that was cut short
    assert store.read_summaries(spark, where).count() == 3 and store.next_run_id(spark, where) == 8
    with pytest.raises(Exception, match="(?i)exists"):
        store.write_summary(spark.range(1).selectExpr("id AS job_id"), where, 4)
