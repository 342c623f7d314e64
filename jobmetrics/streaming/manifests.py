"""Incremental intake: process newly landed JSON-lines index files with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.plans.runs import RunConfig, process_index
from jobmetrics.session import configure, path_exists
from jobmetrics.sources.index import LINE_TYPE, typed_index
from jobmetrics.sources.store import assemble


def process_new_manifests(
    spark: SparkSession, cfg: RunConfig, manifest_dir: str, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Take in the index files that landed in `manifest_dir`, then process all pending jobs.

    A micro-batch only stores its rows, in a folder of its own beside the checkpoint, so a replayed one
    writes the same again. Every call then processes the jobs of all stored rows that are not done:
    a job that failed, or that the scheduler table did not list yet, comes again with the next call. A
    failure is raised after the others had their turn.
    """
    configure(spark)
    reader = spark.readStream.schema(LINE_TYPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    landed = f"{checkpoint.rstrip('/')}/landed"

    def store_rows(rows: DataFrame, batch_id: int) -> None:
        stored = rows.withColumn("row", F.monotonically_increasing_id())
        stored.write.mode("overwrite").parquet(f"{landed}/batch={batch_id}")

    query = (
        reader.json(manifest_dir)
        .writeStream.foreachBatch(store_rows)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if not path_exists(spark, landed):
        return
    rows = spark.read.schema(f"{LINE_TYPE}, row bigint, batch bigint").parquet(landed)
    index = typed_index(rows.withColumn("_landed", F.struct("batch", "row")), "_landed")
    try:
        process_index(spark, cfg, index, raise_errors=True)
    finally:
        if cfg.output:
            assemble(spark, cfg.store, cfg.output)
