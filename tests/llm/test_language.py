"""Language identification against a plain coder, on held-out rows, and odd rows."""

import math
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.harness import TESTDATA
from tramline.llm import language, queries

SCHEMA = "doc_id bigint, text string, lang string, lang_pred string"


def plain_bits(texts, text):
    """Code length of ``text`` by PPM, method C with exclusion, over context trees of ``texts``."""
    tree = defaultdict(Counter)
    for t in texts:
        data = t.encode()
        for i, b in enumerate(data):
            for k in range(min(i, language.ORDER) + 1):
                tree[data[i - k : i]][b] += 1
    total, data = 0.0, text.encode()
    for i, b in enumerate(data):
        ruled_out, chance = set(), 1.0
        for k in range(min(i, language.ORDER), -1, -1):
            seen = {s: n for s, n in tree.get(data[i - k : i], {}).items() if s not in ruled_out}
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if b in seen:
                chance *= seen[b] / whole
                break
            chance *= len(seen) / whole
            ruled_out |= seen.keys()
        else:
            chance /= 256 - len(ruled_out)
        total -= math.log2(chance)
    return total


def test_code_lengths(spark):
    r = random.Random(4)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(1, 6)))
    texts = {"aa": [" ".join(word("abcde") for _ in range(30)) for _ in range(8)], "zz": [" ".join(word("deéfg") for _ in range(30)) for _ in range(8)]}
    rows = [(k, t, lang, "") for lang, own in texts.items() for k, t in enumerate(own)]
    model = language.train(spark.createDataFrame(rows, SCHEMA))
    tried = ["abc ade", "", None, "é", "xyz\U0001F600 abba", "d", "fég gaa " * 50, texts["aa"][0]]
    got = model.code_lengths(pa.array(tried, pa.string()))
    for t, bits in zip(tried, got, strict=True):
        for k, lang in enumerate(model.langs):
            assert bits[k] == pytest.approx(plain_bits(texts[lang], t or ""), rel=1e-5, abs=1e-5)
    sliced = pa.array(["skip", *tried], pa.string()).slice(1)
    assert (model.code_lengths(sliced) == got).all()


def test_long_texts_in_slices(spark, monkeypatch):
    rows = [(k, t, lang, "") for k, (t, lang) in enumerate([("abcab cab", "x"), ("dede eded", "y")])]
    model = language.train(spark.createDataFrame(rows, SCHEMA))
    texts = pa.array(["abc" * 400, "d", "", None, "e de" * 999])
    whole = model.code_lengths(texts)
    monkeypatch.setattr(language, "_SLICE", 7)
    assert model.code_lengths(texts) == pytest.approx(whole)


def test_held_out_accuracy(spark):
    folder = f"{TESTDATA}/sf0.01"
    got = queries.op6_language_id(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    own = got.filter("held_out").collect()
    assert len(own) > 200 and got.count() == 1000
    assert sum(r.lang == r.lang_pred for r in own) / len(own) > 0.98
    assert all(0 <= r.score <= 1 for r in own)


def test_odd_rows(spark):
    rows = [(1, "hello there friend", "en", "old"), (2, "bonjour mon ami", "fr", "old"), (3, None, "en", "old"), (4, "hm", None, "old"), (4, "hm", None, "old")]
    table = spark.createDataFrame(rows, SCHEMA)
    model = language.train(table)
    tried = spark.createDataFrame([(1, None, None, ""), (2, "", None, ""), (3, "123 !?", None, ""), (4, "hello", None, ""), (4, "hello", None, "")], SCHEMA)
    got = sorted((r.doc_id, r.lang_pred, r.score > 0.5) for r in language.identify(tried, model).collect())
    assert got == [(1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True)]
    assert language.identify(tried, model).columns == ["doc_id", "text", "lang", "lang_pred", "score", "bits"]
    assert language.train(table.filter("false")) is None
    assert {r.lang_pred for r in language.identify(tried, None).collect()} == {"und"}
    assert language.identify(tried.filter("false"), model).collect() == []
    assert [r.doc_id for r in language.speakable(tried, model).collect()] == [4, 4]


def test_speakable_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    kept = language.speakable(docs, language.train(docs))
    assert kept.columns == docs.columns and kept.count() == docs.filter(F.col("text").rlike(r"\p{L}")).count()
