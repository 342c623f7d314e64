"""CPU and GPU log files: header-mapped CSV text to tidy samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobmetrics.functions.clock import from_epoch, wall_offset
from jobmetrics.functions.text import (
    is_accounting_step,
    scanned_path,
    split_csv_line,
    to_number,
    to_text,
)
from jobmetrics.plans.cpu import memory_ratio
from jobmetrics.plans.metadata import normalised
from jobmetrics.session import materialise

# Column names of the logs and their units.
CPU_COLUMNS = ("Step", "Node", "EpochTime", "CPUUtilization", "RSS", "VMSize", "ReadMB", "WriteMB")
GPU_COLUMNS = (
    "timestamp", "gpu_index", "utilization_gpu_pct", "utilization_memory_pct", "memory_used_MiB",
    "memory_free_MiB", "temperature_gpu", "power_draw_W",
)
GPU_REQUIRED = ("timestamp", "gpu_index", "memory_used_MiB", "memory_free_MiB")
KIB_PER_MIB = 1024.0


def read_log_lines(spark: SparkSession, paths: str | list[str], whole: bool = False) -> DataFrame:
    """Lines of log files: `path_key`, `pos` (order within the file) and `line`.

    `paths` may be folders, files or globs. Blank lines are dropped. Files that vanish contribute
    nothing; a damaged file fails the read, so that no part of it passes for the whole.

    `whole` is for many small files without compression: each is read at once and then cut into the
    same lines, as the text reader copies the Hadoop settings for every file, one copy at a time.
    """
    reader = spark.read.option("ignoreMissingFiles", True).option("recursiveFileLookup", True)
    path_key = scanned_path(F.col("_metadata.file_path")).alias("path_key")
    if whole:
        files = reader.format("binaryFile").load(paths).select(path_key, "content")
        block = F.lit(0).cast("bigint").alias("block")
        lines = files.select("path_key", block, F.explode(_lines_of(F.col("content"))).alias("line"))
    else:
        lines = reader.text(paths).select(path_key, F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    pos = F.struct("block", F.monotonically_increasing_id().alias("row")).alias("pos")
    return lines.select("path_key", pos, "line").where(F.trim("line") != "")


def _lines_of(content: Column) -> Column:
    """The lines in the bytes of a file, as the text reader finds them: without a byte order mark, and
    with bytes that are no UTF-8 left as they are."""
    marked = F.startswith(content, F.lit(b"\xef\xbb\xbf"))
    content = F.when(marked, F.substring(content, 4, 2**31 - 1)).otherwise(content)
    text, ends = content.cast("string"), "\r\n|\r|\n"
    # A character stands for every byte here, so no byte is lost.
    kept = F.transform(F.split(F.decode(content, "ISO-8859-1"), ends), lambda x: F.encode(x, "ISO-8859-1").cast("string"))
    return F.when(F.is_valid_utf8(text), F.split(text, ends)).otherwise(kept)


def stage_records(lines: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The lines cut into `fields` and written once: `path_key`, `pos`, `fields`, `width` and `names`.

    Everything later, also which record is a file's header, is read off this one scan, so it does not
    matter how another scan would deal the files out to tasks. `names` repeats the fields of records
    that hold a column name, which the headers are among; elsewhere it is NULL and costs nothing.
    """
    named = F.arrays_overlap("fields", F.array(*[F.lit(c) for c in columns]))
    records = lines.select("path_key", "pos", split_csv_line(F.col("line")).alias("fields"))
    return materialise(
        records.select("*", F.size("fields").alias("width"), F.when(named, F.col("fields")).alias("names")), "log-records"
    )


def file_headers(records: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """One row per file: `header_row`, the row number of its first record, which is the header;
    `at_<column>`, the position of every column in it (NULL if the header lacks it); and
    `readable`: no record has more fields than the header.

    Files are reduced by a hash aggregation over numbers with partials; only the records that hold
    a column name are looked at for their text. A header without any of the columns fits all records.
    """
    opening, row = F.col("pos.block") == 0, F.col("pos.row")
    files = records.groupBy("path_key").agg(
        F.min(F.when(opening, row)).alias("header_row"), F.max("width").alias("_widest")
    )
    headings = records.where(F.col("names").isNotNull() & opening).select(
        F.col("path_key").alias("_path"), row.alias("_row"), F.col("width").alias("_width"), F.col("names").alias("_names")
    )
    first = (F.col("path_key") == F.col("_path")) & (F.col("header_row") == F.col("_row"))
    at = [F.array_position("_names", c) for c in columns]
    positions = [F.when(k > 0, k - 1).cast("int").alias(f"at_{c}") for k, c in zip(at, columns)]
    readable = F.coalesce(F.col("_widest") <= F.col("_width"), F.lit(True)).alias("readable")
    return files.join(headings, first, "left").select("path_key", "header_row", readable, *positions)


def map_records(records: DataFrame, manifest: DataFrame, columns: tuple[str, ...], keep_wide: bool = False) -> DataFrame:
    """Staged records of the files in `manifest` without the headers, columns found by header name in every file.

    Files may order their columns differently, so the position of each column travels with the
    file: the per-file table is written once and joined to the records. It is broadcast only if
    its written size allows it; otherwise the join shuffles and splits skewed files. A file with
    a record wider than its header cannot be read as a table and is left out as a whole, unless
    `keep_wide` is set, which ignores the fields beyond the header. Adds `has_<column>` for every column.
    """
    files = manifest.join(file_headers(records, columns), "path_key")
    files = materialise((files if keep_wide else files.where("readable")).drop("readable"), "log-files")
    header = (F.col("pos.block") == 0) & (F.col("pos.row") == F.col("header_row"))
    body = records.select("path_key", "pos", "fields").join(files, "path_key").where(~header)
    return body.select(
        *manifest.columns, "pos", *[F.col(f"at_{c}").isNotNull().alias(f"has_{c}") for c in columns],
        *[F.get("fields", F.col(f"at_{c}")).alias(c) for c in columns],
    )


def map_columns(lines: DataFrame, manifest: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """`map_records` of lines, which are read once."""
    return map_records(stage_records(lines, columns), manifest, columns)


def tidy_gpu(records: DataFrame) -> DataFrame:
    """GPU samples in UTC from mapped records; see `gpu_samples`.

    The parsed samples are written once, so that finding clock changes and every later pass read
    a few Parquet columns instead of parsing the text again.
    """
    samples = materialise(gpu_samples(records), "gpu-samples")
    series = ["job_id", "path_key", "gpu_index"]
    return series_to_utc(samples, series).drop("path_key", "pos", "wall_s")


def gpu_samples(records: DataFrame) -> DataFrame:
    """GPU samples on the log's own clock (`wall_s`); unusable rows are dropped.

    Flags per sample tell whether its file has the required columns (`file_ok`) and the ones
    some file of the job must have.
    """
    number = {c: to_number(F.col(c)) for c in GPU_COLUMNS}
    core = ("timestamp", "gpu_index", "utilization_gpu_pct")
    number["gpu_index"] = number["gpu_index"].try_cast("bigint")
    usable = None
    for c in core:
        kept = number[c].isNotNull() | ~F.col(f"has_{c}")
        usable = kept if usable is None else usable & kept
    complete = F.col("names_node")
    for c in GPU_REQUIRED:
        complete = complete & F.col(f"has_{c}")
    return records.where(usable).select(
        "job_id",
        "node_id",
        number["gpu_index"].alias("gpu_index"),
        number["timestamp"].alias("wall_s"),
        number["utilization_gpu_pct"].alias("util_pct"),
        number["utilization_memory_pct"].alias("mem_util_pct"),
        (number["memory_used_MiB"] * F.lit(KIB_PER_MIB)).alias("mem_used_kib"),
        (number["memory_free_MiB"] * F.lit(KIB_PER_MIB)).alias("mem_free_kib"),
        number["power_draw_W"].alias("power_w"),
        number["temperature_gpu"].alias("temperature"),
        complete.alias("file_ok"),
        F.col("has_utilization_gpu_pct").alias("has_util"),
        F.col("has_power_draw_W").alias("has_power"),
        F.col("has_utilization_memory_pct").alias("has_mem_util"),
        F.col("has_temperature_gpu").alias("has_temperature"),
        "path_key",
        "pos",
    )


def _first_by_position(samples: DataFrame, series: list[str]) -> DataFrame:
    """`_first_offset`, `_least` and `_most` of `_offset` in every `_block` of every series.

    `pos` is a block and a row, or just a number. Numbers are compared, not the pair, which keeps
    this a hash aggregation. In a pair NULL comes first.
    """
    block, row = F.lit(0), F.col("pos")
    if isinstance(samples.schema["pos"].dataType, StructType):
        block, row = (F.coalesce(F.col(f"pos.{part}"), F.lit(-(1 << 63))) for part in ("block", "row"))
    return samples.groupBy(*series, block.alias("_block")).agg(
        F.min_by("_offset", row).alias("_first_offset"), F.min("_offset").alias("_least"), F.max("_offset").alias("_most")
    )


def series_to_utc(samples: DataFrame, series: list[str]) -> DataFrame:
    """Add `ts`, shifting every series by the wall-clock offset of its first sample in file order.

    The offset of a sample's own time is the same thing unless its series crosses a clock change.
    Only those series are looked up, so ordinary samples are converted in place without a join
    on the series. One aggregation finds them and their first offsets.
    """
    offset = wall_offset(F.col("wall_s"))
    extent = F.min("_least").alias("_least"), F.max("_most").alias("_most")
    first = (
        _first_by_position(samples.withColumn("_offset", offset), series)
        .groupBy(*series)
        .agg(F.min_by("_first_offset", "_block").alias("_first_offset"), *extent)
        .where(F.col("_least") != F.col("_most"))
        .select(*series, "_first_offset")
    )
    first = materialise(first, "clock-change-offsets")
    if first.isEmpty():
        return samples.withColumn("ts", from_epoch(F.col("wall_s") - offset))
    joined = samples.join(first, series, "left")
    shift = F.coalesce(F.col("_first_offset"), offset)
    return joined.withColumn("ts", from_epoch(F.col("wall_s") - shift)).drop("_first_offset")


def tidy_cpu(records: DataFrame) -> DataFrame:
    """CPU samples from mapped records that carry `cpus_per_node`.

    Files lacking any column are left out; accounting steps and samples without a time are dropped.
    """
    complete = None
    for c in CPU_COLUMNS:
        complete = F.col(f"has_{c}") if complete is None else complete & F.col(f"has_{c}")
    rss, available = to_number(F.col("RSS")), to_number(F.col("VMSize"))
    return (
        records.where(complete & ~is_accounting_step(F.col("Step")))
        .select(
            "job_id",
            to_text(F.col("Node")).alias("node_id"),
            from_epoch(to_number(F.col("EpochTime"))).alias("ts"),
            normalised(to_number(F.col("CPUUtilization")), F.col("cpus_per_node")).alias("cpu_util_pct"),
            rss.alias("mem_rss_kb"),
            available.alias("mem_avail_kb"),
            memory_ratio(rss, available).alias("mem_pct_utilization"),
            (to_number(F.col("ReadMB")) * F.lit(KIB_PER_MIB)).alias("read_kb"),
            (to_number(F.col("WriteMB")) * F.lit(KIB_PER_MIB)).alias("write_kb"),
        )
        .where(F.col("ts").isNotNull())
    )
