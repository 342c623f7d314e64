"""What the operators share: reading tables, words, Arrow batches of a bounded size."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobmetrics.session import materialise

# A word is a run of anything but the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Rows handed to Python at once. Texts differ by a factor of thousands in length, so the rows in a
# batch are few: a batch of the longest texts must still fit beside the other tasks of an executor.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch (a runtime setting that changes no result)."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply `make()` to every Arrow batch of `df`; `make` runs once per task, for its tables and models."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield step(batch)

    return df.mapInArrow(run, schema)


def fold_equal_rows(docs: DataFrame) -> tuple[DataFrame, int, bool]:
    """Every distinct row of `docs` once, the characters of their texts, and whether any was folded.

    Then `_copies` says how often each occurs. Rows that may be equal are found by a hash, so only
    those are grouped by their columns, with partial counts before the shuffle.
    """
    columns = docs.columns
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    sizes = docs.groupBy(row.alias("_row")).agg(F.count(F.lit(1)).alias("_n"), F.max(F.length("text")).alias("_chars"))
    sizes = materialise(sizes, "row-sizes")
    chars = sizes.agg(F.sum("_chars")).first()[0] or 0
    several = sizes.where(F.col("_n") > 1).select("_row")
    if several.isEmpty():
        return docs, chars, False
    marked = docs.withColumn("_row", row)
    once = marked.join(several, "_row", "left_anti").select(*columns, F.lit(1).cast("long").alias("_copies"))
    again = marked.join(several, "_row", "left_semi").groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    return once.unionByName(again), chars, True


def unfold(rows: DataFrame) -> DataFrame:
    """Every row `_copies` times."""
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copy", "_copies")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch as Python strings; null counts as empty."""
    return [x if x is not None else "" for x in batch.column(column).to_pylist()]


def label_split(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """One row per labelled id; of repeated rows the larger label counts, null ids and labels do not."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    return known.groupBy("doc_id").agg(F.max(label).alias("label"))
