"""Log lines as real files, one for each log, and scans of them."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# Files that lie in one folder, and files that one scan reads: the driver holds the names of one scan.
FILES_PER_FOLDER = 1_000
FILES_PER_SCAN = 100_000
# Bytes of a file that is read at once.
SMALL_FILE = 1 << 20


class Scan(NamedTuple):
    """Folders to scan together, and whether all of their files are small."""

    folders: list[str]
    small: bool


def write_logs(lines: DataFrame, folder: str) -> list[Scan]:
    """Write one file for each `log` of `lines` (`log`, `pos`, `line`), its lines in the order of `pos`.

    Returns the scans of them, of about FILES_PER_SCAN files each. The log's name follows `log=` in the
    path of its file.

    On a disk that all tasks share, a task writes its files itself: Hadoop's local file system starts
    a process for every file, to set its permissions, and Spark moves all files once more in the driver.
    """
    path = lines.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(lines.sparkSession._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    ordered = lines.repartition("log").sortWithinPartitions("log", "pos").select("log", "line")
    if fs.getUri().getScheme() != "file":
        ordered.write.mode("append").partitionBy("log").text(folder)
        return [Scan([folder], False)]
    return _scans(_write_local(ordered, path.toUri().getPath()), folder)


def _write_local(ordered: DataFrame, folder: str) -> list[tuple[str, int, int]]:
    """Name, number of files and bytes of the largest file of every folder written below `folder`.

    An attempt of a task has folders of its own; those of attempts that failed or came second are
    not among the names.
    """
    per_folder = FILES_PER_FOLDER

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, written, out, current = uuid.uuid4().hex, [], None, None
        nothing, line_end = pa.scalar(b"", pa.large_binary()), pa.scalar(b"\n", pa.large_binary())
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                line = batch.column("line").cast(pa.large_binary())
                text = pc.binary_join_element_wise(line, nothing, line_end, null_handling="replace")
                _, ends, data = text.buffers()
                ends = memoryview(ends).cast("q")
                logs = pc.run_end_encode(batch.column("log"))
                start = 0
                for log, end in zip(logs.values.to_pylist(), logs.run_ends.to_pylist()):
                    if out is None or log != current:
                        if out is not None:
                            out.close()
                        if not written or written[-1][1] == per_folder:
                            written.append([f"{attempt}-{len(written)}", 0, 0])
                            os.makedirs(f"{folder}/{written[-1][0]}")
                        name = "__HIVE_DEFAULT_PARTITION__" if log is None else log
                        out = open(f"{folder}/{written[-1][0]}/part-log={name}", "xb", buffering=0)
                        written[-1][1] += 1
                        current, size = log, 0
                    part = memoryview(data)[ends[start] : ends[end]]
                    size += len(part)
                    written[-1][2] = max(written[-1][2], size)
                    while len(part):
                        part = part[out.write(part) :]
                    start = end
        finally:
            if out is not None:
                out.close()
        if written:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*written)], ["name", "files", "largest"])

    return [tuple(r) for r in ordered.mapInArrow(write, "name string, files long, largest long").collect()]


def _scans(written: list[tuple[str, int, int]], folder: str) -> list[Scan]:
    """The folders in groups that close once they have FILES_PER_SCAN files."""
    scans = []
    for small in (True, False):
        files = FILES_PER_SCAN
        for name, count, largest in written:
            if (largest <= SMALL_FILE) == small:
                if files >= FILES_PER_SCAN:
                    scans.append(Scan([], small))
                    files = 0
                scans[-1].folders.append(f"{folder}/{name}")
                files += count
    return scans or [Scan([folder], True)]


@contextlib.contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Inside the block a task scans hundreds of small files instead of about thirty."""
    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        yield
    finally:
        spark.conf.set(key, before)
