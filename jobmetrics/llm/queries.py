"""The operators as registered queries, over whole tables and with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobmetrics.llm import (
    ann, bpe, chat, divergence, fim, jaccard, packing, pii, quality_model, quality_rules, substrings, toxicity, url_filter,
)
from jobmetrics.llm.common import table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
SEQUENCE_TOKENS = 1024
END_ID = 2


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substrings.remove_repeats(table(spark, sf_dir, "documents"), length=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), RANKS, PATTERN, END_ID, SEQUENCE_TOKENS)
    # The ids themselves need not be shuffled: a piece is known by where it starts.
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), shingle_words=3, threshold=0.9)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), RULES)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    again = fim.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(again, 256).alias("restored_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # One conversation more, whose texts hold the template's own strings behind an escape character.
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    done = chat.format_conversations(turns.unionByName(own))
    read = done.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("learned"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_quality_rules": op4_quality_rules,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_pii": op6_pii,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_toxicity": op8_toxicity,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_url_filter": op10_url_filter,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_chat_format": op13_chat_format,
}
