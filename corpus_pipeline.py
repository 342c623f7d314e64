"""A corpus pipeline from raw documents to packed training sequences; every stage is one operator.

Null texts go through every stage (as texts without words). Documents keep their columns until the
last stage, whose rows are the pieces of the packed sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.llm import jaccard, packing, pii, substrings, toxicity
from jobmetrics.llm.common import DOCUMENT_COLUMNS, table
from jobmetrics.llm.queries import END_ID, PATTERN, RANKS, SEQUENCE_TOKENS
from jobmetrics.operators.ranking import running_total
from jobmetrics.session import materialise, remove_path, scratch_dir

TOXIC_SCORE = 0.7
# Near duplicates: words of a shingle, and the least Jaccard similarity.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def _documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as the text now is."""
    sized = rows.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return sized.select(*DOCUMENT_COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, DOCUMENT_COLUMNS, score="_score")
    return scored.where(F.col("_score") < TOXIC_SCORE).drop("_score")


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; rows without id all stay.

    If an id occurs more than once, its different texts are judged as documents of their own (by id,
    then by a hash of the text), and of its rows with equal texts the least one stays.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    named = docs.where(F.col("doc_id").isNotNull())
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.join(_later_of_group(docs), "doc_id", "left_anti").select(*DOCUMENT_COLUMNS)
    hashed = named.withColumn("_text", F.xxhash64("text", F.col("text").isNull()))
    texts = hashed.select("doc_id", "_text").distinct()
    numbers = materialise(running_total(texts, F.lit(1), ["doc_id", "_text"], out="_row").drop("total"), "rows")
    least = F.min(F.struct(*DOCUMENT_COLUMNS)).alias("_least")
    rows = materialise(hashed.join(numbers, ["doc_id", "_text"]).groupBy("_row").agg(least), "distinct-rows")
    gone = _later_of_group(rows.select(F.col("_row").alias("doc_id"), "_least.text"))
    kept = rows.join(gone.withColumnRenamed("doc_id", "_row"), "_row", "left_anti").select("_least.*")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def _later_of_group(docs: DataFrame) -> DataFrame:
    """Ids of the documents that are not the first of their group of near duplicates."""
    groups = jaccard.similar_documents(docs, NEAR_WORDS, NEAR_SIMILARITY)
    return groups.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; a text without any stays as it is, line breaks included."""
    done = substrings.remove_repeats(docs.select(*DOCUMENT_COLUMNS), carry=("text", "lang", "source", "n_chars"))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return _documents(done.withColumn("text", text), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays."""
    return _documents(pii.mask_personal_data(docs.select(*DOCUMENT_COLUMNS)), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences as their pieces: which tokens of which document lie where."""
    pieces = packing.token_pieces(docs, RANKS, PATTERN, END_ID, SEQUENCE_TOKENS)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", toxicity_stage),
    ("jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

# The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages; each result is written to the shared folder and read again as the next one's input.

    A stage's result is deleted once the next one is written; the last one's is what is returned.
    """
    docs, previous = table(spark, sf_dir, "documents"), None
    folder = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if previous:
            remove_path(spark, previous)
        previous = path
    return docs
