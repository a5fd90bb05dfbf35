"""Spelling variants against all pairs, and the query against SQL."""

import random
import zlib
from collections import Counter

import pytest

from tests.harness import TESTDATA, connect, differences
from tramline.llm import queries, spelling


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(counts, ratio=5):
    """All pairs, one after the other."""
    others = {a: [b for b in counts if b != a and near(a, b)] for a in counts}
    form = {}
    for a, found in others.items():
        best = min(found, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= ratio * counts[a] else None

    def root(a):
        return a if form[a] is None else root(form[a])

    return {(a, counts[a], form[a], root(a), len(others[a]), counts.get(form[a])) for a in counts}


def run(spark, counts, partitions=8):
    frame = spark.createDataFrame(list(counts.items()) or [("x", 1)], "word string, n long").filter("true" if counts else "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return [tuple(r) for r in spelling.variants(frame).select("word", "n", "form", "root", "n_near", "form_n").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed,partitions", [(1, 1), (2, 7), (3, 40)])
def test_against_all_pairs(spark, seed, partitions):
    r = random.Random(seed)
    found = {"".join(r.choice("abé") for _ in range(r.randint(1, 7))) for _ in range(350)}
    counts = {w: r.choice([1, 2, 5, 10, 25, 25, 130, 700]) for w in found}
    got = run(spark, counts, partitions)
    assert len(got) == len(counts) and set(got) == plain(counts)


def test_runs_of_equal_letters_long_words_and_ties(spark):
    long = "ab" * 20_000
    counts = {
        "aaaa": 1, "aaaaa": 6, "aaaaaa": 40, "baaaa": 6, long: 9, long[1:]: 50, long + "a": 50, long[:7] + "x" + long[8:]: 50,
        "\U0001F600a": 3, "\U0001F600": 30, "ﬀa": 30,
    }
    expected = {(w, n, form, root, k, counts.get(form)) for w, n, form, root, k in [
        ("aaaa", 1, "aaaaa", "aaaaaa", 2), ("aaaaa", 6, "aaaaaa", "aaaaaa", 3), ("aaaaaa", 40, None, "aaaaaa", 1), ("baaaa", 6, None, "baaaa", 2),
        (long, 9, long + "a", long + "a", 3), (long[1:], 50, None, long[1:], 1), (long + "a", 50, None, long + "a", 1),
        (long[:7] + "x" + long[8:], 50, None, long[:7] + "x" + long[8:], 1), ("\U0001F600a", 3, "ﬀa", "ﬀa", 2),
        ("\U0001F600", 30, None, "\U0001F600", 1), ("ﬀa", 30, None, "ﬀa", 1),
    ]}
    assert set(run(spark, counts, 5)) == expected


def test_a_long_chain(spark):
    counts = {"a" * k: 6 ** k for k in range(1, 20)}
    got = {r[0]: r for r in run(spark, counts)}
    assert all(r[3] == "a" * 19 for r in got.values())


def test_whole_alphabet_in_one_group(spark):
    letters = [*map(chr, range(97, 123)), *map(chr, range(0xC0, 0x100))]
    counts = {f"some{c}thing": 5 + k for k, c in enumerate(letters)} | {"something": 1000}
    got = {r[0]: r for r in run(spark, counts)}
    # Two of them have the letter twice ("somee", ...) and are near the plain word at another place.
    assert set(got.values()) == plain(counts)


def test_empty_and_odd_rows(spark):
    assert run(spark, {}) == []
    frame = spark.createDataFrame([(None, 3), ("", 3), ("x", 3)], "word string, n long")
    assert [r["word"] for r in spelling.variants(frame).collect()] == ["x"]


def test_words(spark):
    texts = [(1, "Hello, hello HELLO-world"), (2, None), (None, "hello Élan élan"), (1, "Hello, hello HELLO-world"), (3, ""), (4, "naïve×naïve 日本" * 3)]
    docs = spark.createDataFrame([(d, t, "clash", 7) for d, t in texts], "doc_id long, text string, word string, n long")
    expected = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    import re

    for d, t in texts:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'null' if d is None else d}:{w}".encode())
            expected[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 2 == 0 else w] += 1
    got = spelling.words(docs, every=2, shortest=1, least=1).collect()
    assert {r["word"]: r["n"] for r in got} == {w: n for w, n in expected.items() if w}


def test_query_equals_sql(spark):
    folder = f"{TESTDATA}/sf0.001"
    name = "op12_spelling_variants"
    assert differences(queries.QUERIES[name](spark, folder), connect(folder), queries.SQL[name]) is None
