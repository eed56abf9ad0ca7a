"""Stages of the pipeline, each against a plain version over its own input."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute
import corpus_pipeline

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(5000, None, None, "s", 0), (5001, "", "en", "s", 0), (5002, "123 !!", None, "s", 6), (None, "the of and to in that with", "en", "s", 26)]
    odd += [(5003, "Мама мыла раму, а папа читал газету и пил чай на кухне.", None, "s", 9), (5004, "a" * 300, None, "s", 300)]
    odd += [(5005, "日本語の文章はここにあります。これは試験のための文です。", None, "s", 9)]
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long"))
    out, path = {}, tmp_path_factory.mktemp("pipeline")
    docs.write.parquet(f"{path}/documents")
    docs = spark.read.parquet(f"{path}/documents")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{path}/{name}")
        out[name] = (docs, spark.read.parquet(f"{path}/{name}"))
        docs = out[name][1]
    return out


def _rows(df):
    return {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()}


def test_columns_and_order(stages):
    assert list(stages) == ["language", "near_copies", "benchmark", "secrets", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.schema == before.schema


def test_language_rejects_only_texts_without_one(stages):
    """No clean document goes, whatever its length; texts without a letter, in foreign alphabets and of one letter do."""
    before, after = stages["language"]
    gone = {r[0] for r in _rows(before) - _rows(after)}
    assert gone == {5000, 5001, 5002, 5003, 5004, 5005}


def test_without_labels_nothing_is_dropped_silently(spark):
    docs = spark.createDataFrame([(1, "some text", None, "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    with pytest.raises(ValueError, match="no language model"):
        corpus_pipeline.identify_language(spark, docs, FOLDER)


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = stages["near_copies"]
    named = [(r[0], r[1]) for r in _rows(before) if r[0] is not None]
    stay = {i for i, (_, c) in brute.near_groups(named, 5, 80).items() if i == c}
    assert _rows(after) == {r for r in _rows(before) if r[0] is None or r[0] in stay}


def test_documents_with_benchmark_passages_go(spark, stages):
    before, after = stages["benchmark"]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert _rows(after) == {r for r in _rows(before) if not any(i in r[1] for i in items)}


def test_secrets_are_replaced(stages):
    before, after = stages["secrets"]
    old, new = {r[0]: r for r in _rows(before)}, {r[0]: r for r in _rows(after)}
    assert old.keys() == new.keys()
    for key, row in old.items():
        spans = brute.secrets(row[1])
        if not spans:
            assert new[key] == row
        else:
            assert "[SECRET]" in new[key][1] and new[key][4] == len(new[key][1])
            assert not brute.secrets(new[key][1])


def test_every_document_is_packed_whole(stages):
    before, after = stages["packing"]
    total = {r.doc_id: (r.n, r.m) for r in after.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()}
    assert set(total) == {r[0] for r in _rows(before)} and all(n == m for n, m in total.values())


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
