"""The pipeline against a plain version of its stages, and odd tables through every stage."""

import pytest

import corpus_pipeline
from tests.harness import TESTDATA
from tests.llm.test_neardup import plain_classes

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

def test_stages_against_plain_versions(spark, tmp_path):
    spm = pytest.importorskip("sentencepiece")
    folder = f"{TESTDATA}/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        steps.append(docs.collect())
        assert name == "sentencepiece" or docs.columns == corpus_pipeline.COLUMNS
    spoken, unique, clean, mixed, coded = steps
    assert len(spoken) == 1000
    expected, _ = plain_classes([(r.doc_id, r.text) for r in spoken])
    assert sorted(r.doc_id for r in unique) == sorted(set(expected.values()))
    before = {r.doc_id: r.text for r in unique}
    assert {r.doc_id for r in clean} == set(before)
    changed = [r for r in clean if r.text != before[r.doc_id]]
    assert changed and all("[SECRET]" in r.text for r in changed) and all(r.n_chars == len(r.text) for r in clean)
    assert not any("password=" in r.text for r in clean)
    copies = {}
    for r in mixed:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    taken = [type(r)(doc_id=r.doc_id, source=r.source, size=len(r.text.split()), copies=copies.get(r.doc_id, 0)) for r in clean]
    assert len(mixed) == sum(r.copies for r in taken) and max(copies.values()) <= 3
    library = spm.SentencePieceProcessor(model_file=f"{corpus_pipeline.TOKENIZERS}/piece_bpe_32k.model")
    texts = {r.doc_id: r.text for r in clean}
    assert len(coded) == len(mixed) and all(r.round_trip and r.ids == library.encode(texts[r.doc_id]) for r in coded)

def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, f"{TESTDATA}/sf0.001")
    assert got.count() > 100 and got.filter("not round_trip").count() == 0

def test_odd_tables_through_every_stage(spark):
    odd = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "plain words in here", "en", "a", 19), (2, "plain words in here", "en", "a", 19), (3, "long " * 50_000, "en", None, 250_000)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS size", "'x' AS found")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            assert name == "sentencepiece" or out.columns == corpus_pipeline.COLUMNS
            assert len(out.collect()) <= 12 and (rows or out.count() == 0)

