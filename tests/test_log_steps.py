"""Steps from log lines to samples that must hold for very many logs."""

import os

from pyspark.sql import DataFrame, functions as F

from jobmetrics.sources import logs
from workload import queries

SUMMER, WINTER = 1720000000.0, 1736000000.0


def test_first_offsets_take_one_aggregation_over_numbers(spark, monkeypatch):
    rows = [
        ("a", 1, 0, SUMMER), ("a", 0, 9, SUMMER), ("a", 0, 7, WINTER),
        ("b", 0, 1, SUMMER), ("b", 0, 2, SUMMER),
        (None, 0, 1, SUMMER), (None, 0, 2, WINTER),
        ("c", 0, 4, WINTER), ("c", 0, None, SUMMER),
    ]
    pos = F.struct("block", "row").alias("pos")
    samples = spark.createDataFrame(rows, "job_id string, block long, row long, wall_s double").select("job_id", pos, "wall_s")
    written, write = [], logs.materialise
    monkeypatch.setattr(logs, "materialise", lambda df, label: written.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, label))
    found = logs.series_to_utc(samples, ["job_id"]).select("job_id", "pos.block", "pos.row", (F.unix_seconds("ts") - F.col("wall_s")).alias("shift"))
    shift = {tuple(r)[:3]: r["shift"] / 3600 for r in found.collect()}
    assert shift == {
        ("a", 1, 0): 5, ("a", 0, 9): 5, ("a", 0, 7): 5, ("b", 0, 1): 4, ("b", 0, 2): 4,
        (None, 0, 1): 4, (None, 0, 2): 5, ("c", 0, 4): 4, ("c", 0, None): 4,
    }
    assert len(written) == 1 and "SortAggregate" not in written[0]


def test_logs_written_as_files_are_scanned_without_a_list_of_them(spark, monkeypatch, tmp_path):
    def listed(self):
        raise AssertionError("the driver lists the files")

    rows = [("/gpu/1-r1.csv", 0, "h"), ("/gpu/1-r1.csv", 1, "x"), ("/gpu/2-r1.csv", 0, "h"), (None, 1, "y")]
    lines = spark.createDataFrame(rows, "path_key string, row long, line string")
    lines = lines.select("path_key", F.struct(F.lit(0).cast("bigint").alias("block"), "row").alias("pos"), "line")
    monkeypatch.setattr(DataFrame, "inputFiles", listed)
    monkeypatch.setattr(queries, "scratch_dir", lambda spark: str(tmp_path))
    scanned = queries._from_files(lines, "logs")
    found = scanned.where(F.col("path_key").startswith("/")).orderBy("path_key", "pos").select("path_key", "line").collect()
    assert [tuple(r) for r in found] == [("/gpu/1-r1.csv", "h"), ("/gpu/1-r1.csv", "x"), ("/gpu/2-r1.csv", "h")]
    names = [n for _, _, files in os.walk(tmp_path) for n in files if n.startswith(("part-", ".part-"))]
    assert len(names) == 3 and not [n for n in names if n.endswith(".crc")]


def test_log_lines_are_written_where_they_were_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "materialise", lambda df, label: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or df)
    queries._written(spark.range(3), "lines").count()
    assert len(seen) == 1 and "Repartition" not in seen[0]


def _log_lines(spark, rows):
    lines = spark.createDataFrame(rows, "path_key string, row long, line string")
    return lines.select("path_key", F.struct(F.lit(0).cast("bigint").alias("block"), "row").alias("pos"), "line")


LOG_ROWS = [(f"/gpu/{k}-r1.csv", n, f"{k},{n}") for k in range(9) for n in range(k + 1)] + [("/gpu/3-r1.csv", 9, None), ("/gpu/4-r1.csv", 9, "é\"")]
LOG_LINES = {(p, line) for p, _, line in LOG_ROWS if line}


def test_many_logs_share_a_folder_and_are_scanned_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(queries.log_files, "FILES_PER_FOLDER", 2)
    monkeypatch.setattr(queries.log_files, "FILES_PER_SCAN", 3)
    staged = []
    lines = _log_lines(spark, LOG_ROWS).repartition(3)
    found = queries._from_files(lines, "logs", lambda scan: staged.append(len(scan.inputFiles())) or scan)
    rows = [tuple(r) for r in found.orderBy("path_key", "pos").select("path_key", "line").collect()]
    assert rows == sorted(LOG_LINES) and sum(staged) == 9 and len(staged) > 1 and max(staged) <= 4
    folders = {f: len(files) for f, _, files in os.walk(tmp_path) if files}
    assert sum(folders.values()) == 9 and max(folders.values()) == 2


def test_logs_in_a_store_that_only_spark_reads(spark, monkeypatch, tmp_path):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.logs.link./logs", tmp_path.as_uri())
    monkeypatch.setattr(queries, "scratch_dir", lambda spark: "viewfs://logs/logs")
    found = queries._from_files(_log_lines(spark, LOG_ROWS), "logs")
    rows = [tuple(r) for r in found.orderBy("path_key", "pos").select("path_key", "line").collect()]
    assert rows == sorted(LOG_LINES)


def test_no_logs(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark: str(tmp_path))
    assert queries._from_files(_log_lines(spark, []), "logs").count() == 0


def test_a_scan_of_logs_leaves_the_session_as_it_was(spark):
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    with queries.log_files.small_files(spark):
        assert spark.conf.get(key) != before
    assert spark.conf.get(key) == before


def test_files_read_at_once_give_the_lines_the_text_reader_gives(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfa,b\r\n1,2\r3,4\n\n  \n\t\nx\xe2\x82\nq\xff\xfe")
    (tmp_path / "b c+%20.csv").write_bytes("é,ü\n\nlast".encode())
    (tmp_path / "e.csv").write_bytes(b"")
    (tmp_path / "f.csv").write_bytes(b"\xef\xbb\xbf")
    read = {}
    for whole in (False, True):
        lines = logs.read_log_lines(spark, str(tmp_path), whole)
        rows = lines.orderBy("path_key", "pos").select("path_key", "pos.block", F.hex("line")).collect()
        read[whole] = [tuple(r) for r in rows]
    assert read[True] == read[False] and len(read[True]) == 8


def test_a_whole_file_that_vanishes_contributes_nothing(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("x\ny")
    lines = logs.read_log_lines(spark, str(tmp_path), whole=True)
    (tmp_path / "1.csv").unlink()
    assert lines.count() == 4


def test_large_logs_are_not_read_at_once(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "scratch_dir", lambda spark: str(tmp_path))
    monkeypatch.setattr(queries.log_files, "FILES_PER_FOLDER", 1)
    monkeypatch.setattr(queries.log_files, "SMALL_FILE", 12)
    read, asked = queries.logs.read_log_lines, []
    monkeypatch.setattr(queries.logs, "read_log_lines", lambda spark, paths, whole=False: asked.append((whole, len(paths))) or read(spark, paths, whole))
    found = queries._from_files(_log_lines(spark, LOG_ROWS), "logs")
    rows = [tuple(r) for r in found.orderBy("path_key", "pos").select("path_key", "line").collect()]
    assert rows == sorted(LOG_LINES)
    # Four bytes a line, and five and four more in two of the logs.
    assert asked == [(True, 3), (False, 6)]
