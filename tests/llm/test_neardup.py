"""Near-duplicates against all pairs."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.harness import TESTDATA
from tramline.llm import neardup, queries

SCHEMA = "doc_id bigint, text string, lang string, source string, class_id bigint"


def grams(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower())
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def plain_classes(rows, least=0.8):
    """doc_id -> class id for rows (doc_id, text) of different ids; and the similarity of linked pairs."""
    import math

    bags = [grams(t or "") for _, t in rows]
    n = sum(bool(t) for _, t in rows)
    df = Counter(g for b in bags for g in b)
    floor = max(2, neardup.COMMON * n)
    weight = {g: math.log1p(n / c) / math.log1p(1 / neardup.COMMON) if c >= floor else 1.0 for g, c in df.items()}
    bags = [{g: c * weight[g] for g, c in b.items()} for b in bags]
    post = {}
    for i, b in enumerate(bags):
        for g in b:
            post.setdefault(g, []).append(i)
    links, root = {}, list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    same = {}
    for i, (_, t) in enumerate(rows):
        if t and (j := same.setdefault(t, i)) != i:
            root[find(i)] = find(j)
    for i, b in enumerate(bags):
        for j in {j for g in b for j in post[g] if j > i}:
            common = sum(min(v, bags[j].get(g, 0)) for g, v in b.items())
            s = common / (sum(b.values()) + sum(bags[j].values()) - common)
            if s >= least - 1e-9:
                links[i, j] = s
                root[find(i)] = find(j)
    least_id = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least_id[r] = min(d, least_id.get(r, d))
    return {d: least_id[find(i)] for i, (d, _) in enumerate(rows)}, links


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_all_pairs(spark, sf):
    folder = f"{TESTDATA}/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected, links = plain_classes(rows)
    got = {r.doc_id: r.class_id for r in queries.op9_minhash_neardup(spark, folder).collect()}
    assert len(links) > 10 and got == expected


def edited(r, words, share):
    return " ".join(f"new{r.randrange(10**9)}" if r.random() < share else w for w in words)


def test_large_groups_hot_passages_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "_MEMBERS", 7)
    r = random.Random(9)
    word = lambda: f"w{r.randrange(10**6)}"
    base, passage = [word() for _ in range(150)], " ".join(word() for _ in range(60))
    rows = [(k, edited(r, base, 0.012)) for k in range(120)]  # similar to the base, but not all to each other
    rows += [(1000 + k, passage + " " + " ".join(word() for _ in range(90))) for k in range(150)]
    rows += [(2000 + k, " ".join(base)) for k in range(60)] + [(3000 + k, "Short text.") for k in range(3)]
    expected, _ = plain_classes(rows)
    got = {x.doc_id: x.class_id for x in neardup.classes(spark.createDataFrame([(d, t, "", "", 0) for d, t in rows], SCHEMA)).collect()}
    assert got == expected


ODD = [
    (1, None, "en", "a", 0), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "!!! ???", "en", "a", 0), (4, "!!! ???", "fr", "a", 0), (5, "??? !!!", "en", "a", 0),
    (None, "one two three four five six", "en", "a", 0), (6, "One, two; three four five SIX", "en", "a", 0), (7, "seven eight", "en", "b", 0), (7, "seven eight", "en", "b", 0),
    (7, "nine ten", "en", "b", 0), (None, "all alone here", "en", None, 0), (8, "word " * 60_000, "en", "c", 0), (9, "word " * 59_000, "en", "c", 0), (10, "x" * 100_000, "en", "c", 0),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.class_id) for r in neardup.classes(docs).collect()), key=repr)
    assert got == sorted([(False, 1, 1), (False, 1, 1), (False, 2, 2), (False, 3, 3), (False, 4, 3), (False, 5, 5), (True, 0, 6), (False, 6, 6), (False, 7, 7), (False, 7, 7), (False, 7, 7), (True, 0, None), (False, 8, 8), (False, 9, 8), (False, 10, 10)], key=repr)
    kept = neardup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text and r.text[:9]) for r in kept.collect()), key=repr) == sorted(
        [(1, None), (1, None), (2, ""), (3, "!!! ???"), (5, "??? !!!"), (6, "One, two;"), (7, "seven eig"), (7, "nine ten"), (None, "all alone"), (8, "word word"), (10, "xxxxxxxxx")], key=repr
    )


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert neardup.classes(docs).collect() == [] and neardup.deduplicated(docs).collect() == []


def test_slices_do_not_matter(spark, monkeypatch):
    import pyarrow as pa

    texts = pa.array(["One two  three four five six", None, "", "a " * 50, "ünïcode wörds here are five and six", "x" * 40, "tail word"])
    same = lambda a, b: all((p[0] == q[0]).all() and (p[1] == q[1]).all() for p, q in zip(a, b, strict=True))
    whole = [x for _, rows in neardup.shingles(texts) for x in rows]
    for size in (1, 5, 16):
        monkeypatch.setattr(neardup, "_SLICE", size)
        assert same(whole, [x for _, rows in neardup.shingles(texts) for x in rows])


def test_samples_agree_as_often_as_similar():
    import numpy as np

    rng = np.random.default_rng(1)
    ids = rng.integers(1, 2**63, 400).astype(np.uint64)
    w = rng.random(400) + 0.5
    v = np.where(rng.random(400) < 0.5, w, w * 0.7)
    agree = []
    for k in range(60):
        spread = neardup._mixed(ids + np.uint64(k))
        order = np.argsort(spread)
        a, b = (neardup.band_keys(spread[order], x[order], np.array([0]))[0] for x in (w, v))
        agree.append((a == b).mean())
    true = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    assert np.mean(agree) == pytest.approx(true**neardup.ROWS, abs=0.06)


def test_text_is_not_cut(spark):
    a = " ".join(f"w{k}" for k in range(30_000))
    b = a + " " + " ".join(f"v{k}" for k in range(9_000))
    docs = spark.createDataFrame([(1, a, "", "", 0), (2, b, "", "", 0)], SCHEMA)
    assert {r.class_id for r in neardup.classes(docs).collect()} == {1, 2}
    assert neardup.classes(docs.filter(F.col("doc_id") == 1)).count() == 1


def test_edits_in_large_groups_and_small_tables(spark, tmp_path):
    r = random.Random(4)
    word = lambda: f"w{r.randrange(10**6)}"
    base = [word() for _ in range(150)]
    edit = lambda *at: " ".join("new" + str(r.randrange(10**9)) if k in at else w for k, w in enumerate(base))
    group = [edit(7 + 4 * k) for k in range(30)]  # 136 of 156 shingles are shared
    rows = [(k, t) for k, t in enumerate(group)] + [(100 + k, " ".join(word() for _ in range(100))) for k in range(60)]
    for name, some in (("group", rows), ("small", rows[:2] + rows[30:38])):
        folder = tmp_path / name
        spark.createDataFrame(some, "doc_id bigint, text string").write.parquet(str(folder / "documents.parquet"))
        got = {x.doc_id: x.class_id for x in queries.op9_minhash_neardup(spark, str(folder)).collect()}
        assert got == {d: 0 if d < 100 else d for d, _ in some}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert neardup.deduplicated(docs, either=True).count() == 61
