"""Repeated rows and ids, and the stages of the pipeline on tables without rows."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from jobmetrics.llm import common, jaccard, substrings
from tests.llm.test_operators import OTHERS, SCHEMA, frame, prose


def test_equal_rows_are_folded_and_counted(spark):
    # Neither a null in another column nor another type of absence makes rows equal.
    rows = [(1, "a", None), (1, None, "a"), (None, None, None), (None, None, None), (2, "b", "x"), (2, "b", "x"), (2, "b", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    folded, chars, any_folded = common.fold_equal_rows(docs)
    got = {(r.doc_id, r.text, r.lang): r._copies for r in folded.collect()}
    assert got == Counter(rows) and any_folded and chars == 3
    assert Counter(map(tuple, common.unfold(folded).collect())) == Counter(rows)
    same, chars, any_folded = common.fold_equal_rows(docs.limit(2))
    assert same.columns == docs.columns and not any_folded and chars == 1


def test_very_many_equal_rows(spark):
    """100,000 rows of one id and text, and as many without any, meet no task all together."""
    n, passage = 100_000, prose(1, 40)
    few = frame(spark, [(1, passage), (2, "x " + passage), (3, prose(2, 40))])
    copies = spark.range(n).select(F.lit(2).cast("long").alias("doc_id"), F.lit("x " + passage).alias("text"))
    nothing = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    docs = few.select("doc_id", "text").union(copies).union(nothing)
    rows = substrings.remove_repeats(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 40, 0, 1), (2, 41, 40, n + 1), (3, 40, 0, 1), (None, 0, 0, n)], key=str)
    rows = jaccard.similar_documents(docs).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, 38, 1, 1), (2, 39, 1, n + 1), (3, 38, 3, 1), (None, 0, None, n)], key=str)
    assert common.fold_equal_rows(docs)[0].count() == 4


def test_near_duplicates_are_decided_by_row(spark):
    """Of an id with two texts only the near copy goes; of equal rows one stays; rows without id stay."""
    one, two, three = prose(3, 100), prose(4, 100), prose(5, 100)
    rows = [(1, one), (5, one + " z"), (5, two), (5, two), (6, three), (6, three + " z"), (7, None), (7, None), (None, one), (None, one)]
    kept = corpus_pipeline.jaccard_stage(spark, frame(spark, rows), "")
    assert kept.columns == common.DOCUMENT_COLUMNS
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    six = [t for t in (three, three + " z") if got[(6, t)]]
    assert len(six) == 1
    assert got == Counter([(1, one), (5, two), (6, six[0]), (7, None), (None, one), (None, one)])


def test_nothing_repeats(spark):
    """No window at all, and windows none of which is in another document."""
    for texts in ([(1, "a b"), (2, None)], [(1, prose(1, 50)), (2, prose(2, 50))]):
        got = substrings.remove_repeats(frame(spark, texts)).collect()
        assert sorted(r.doc_id for r in got) == [1, 2] and not any(r.n_removed for r in got)


@pytest.fixture
def empty_folder(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_without_documents(spark, empty_folder):
    done = corpus_pipeline.run(spark, empty_folder)
    assert done.count() == 0 and {"doc_id", "piece", "sequence_id", "offset"} <= set(done.columns)


def test_stages_keep_columns_and_documents(spark):
    rows = [(None, None), (1, None), (2, ""), (3, prose(8, 60)), (4, "write to jane@example.com now"), (4, "write to jane@example.com now")]
    docs = frame(spark, rows)
    for stage in (corpus_pipeline.substring_stage, corpus_pipeline.pii_stage):
        done = stage(spark, docs, "")
        assert done.columns == common.DOCUMENT_COLUMNS and done.dtypes == docs.select(*common.DOCUMENT_COLUMNS).dtypes
        texts = sorted((str(r.doc_id), r.text) for r in done.collect() if r.doc_id != 4 and r.text)
        assert texts == [("3", prose(8, 60))] and done.count() == len(rows)
    assert not [r for r in corpus_pipeline.pii_stage(spark, docs, "").collect() if r.text and "@" in r.text]
    assert {r.lang for r in done.collect()} == {OTHERS[0]}


def test_content_of_a_set_is_compared_only_where_an_id_repeats(monkeypatch):
    content, asked = jaccard._content, []
    monkeypatch.setattr(jaccard, "_content", lambda s: asked.append(len(s)) or content(s))
    firsts = pa.table({"kind": pa.array([0], pa.int32()), "h": pa.array([jaccard.packed(np.array([1, 2]))], pa.binary())})
    table = pa.table({"doc_id": [1, 2, 2, 2, 3], "text": ["a b c d", "a b c", "a b c", "b c d e", "x y z"]})
    found = [(doc, len(s)) for doc, s in jaccard._entries(jaccard.Measure.of(3, 0.9), table, firsts)]
    assert found == [(1, 2), (2, 1), (2, 2)] and asked == [1, 1, 2]


def test_sets_of_a_chunk_at_once(monkeypatch):
    """Sets of many texts are those of each one, and no text is cut into words by itself."""
    monkeypatch.setattr(jaccard, "PORTION_BYTES", 40)  # several portions
    texts = [None, "", " ", "a", "A b", "a b C", "a a a a a", "\u3000x É\tÉ y\x0bz\x85w \x1cq ", prose(3, 50), None, prose(4, 9) + "\n"]
    for words in (1, 2, 3, 5):
        measure = jaccard.Measure.of(words, 0.9)
        each = [measure.shingles(t or "", jaccard.WordHashes()) for t in texts]
        with monkeypatch.context() as m:
            m.setattr(jaccard.Measure, "shingles", None)
            sets = jaccard.Sets.of(measure, pa.chunked_array([texts[:4], texts[4:]], pa.string()))
            columns = {"doc_id": range(len(texts)), "chunk": [0] * len(texts), "text": texts, "_copies": [1] * len(texts)}
            told = jaccard._describe(measure, pa.table({c: pa.array(v) for c, v in columns.items()}))
        assert [sets[k].tolist() for k in range(len(texts))] == [s.tolist() for s in each]
        content = [(n, np.int64(a).view(np.uint64), np.int64(b).view(np.uint64)) for n, a, b in zip(*(told.column(c).to_pylist() for c in ("n", "s1", "s2")))]
        assert content == [jaccard._content(s) for s in each]
        frequencies = {h: k % 60 for k, h in enumerate(sets.tokens.tolist())}
        known = np.array([frequencies[h] for h in sets.tokens.tolist() if h % int(measure.counted) == 0], dtype=np.int64)
        number, key = measure.keys_of(sets, known)
        assert [key[number == k].tolist() for k in range(len(texts))] == [measure.keys(s, frequencies).tolist() for s in each]
    none = jaccard.Sets.of(measure, pa.chunked_array([], pa.string()))
    assert len(none.tokens) == 0 and len(measure.keys_of(none, np.zeros(0, np.int64))[1]) == 0
