"""Mixing against a plain version that reshares the excess step by step, and its SQL."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.harness import TESTDATA, connect, differences
from tramline.llm import mixing, queries

SCHEMA = "doc_id bigint, text string, source string, size string"


def plain_targets(sizes, most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: float(k % 3 + 1) for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def check(rows, mixed):
    size = {}
    for _, text, source, _ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = plain_targets(size)
    taken, largest = dict.fromkeys(size, 0), dict.fromkeys(size, 0)
    assert len(mixed) == len(rows)
    for r in mixed:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source], abs=1e-6)
        assert r.taken == r.copies * r.size and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    return target, taken, largest


def test_targets_and_taken(spark):
    words = lambda n: " ".join(["w"] * n)
    rows = [(k, words(int(hashlib.md5(str(k).encode()).hexdigest()[:2], 16) % 40), f"s{k % 7}", "x") for k in range(2000)]
    rows += [(10_000 + k, words(30), "big", "x") for k in range(3000)]
    rows += [(None, "null id", None, "x"), (None, None, None, "x"), (5, "", "empty", "x"), (6, "a b c\x0bd", "s1", "x"), (9, words(50_000), "s2", "x")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    target, taken, largest = check(rows, got)
    assert len(target) == 10 and any(taken[s] > 2 * sum(r.size for r in got if r.source == s) for s in target)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted((r.doc_id or 0, r.source or "", r.size, r.taken) for r in got) == sorted((r.doc_id or 0, r.source or "", r.size, r.taken) for r in again)


def test_nested_budgets(spark):
    rows = spark.range(3000).select(F.lit("s").alias("source"), (F.col("id") % 9 + 1).alias("size"), mixing.position(F.col("id"), F.lit("")).alias("place"))
    cut = lambda b: mixing.thresholds(rows, spark.createDataFrame([("s", b)], "source string, budget double")).first().threshold
    assert cut(100.0) < cut(5000.0) < cut(9000.0)
    for budget in (100.0, 5000.0):
        assert abs(rows.filter(F.col("place") < cut(budget)).agg(F.sum("size")).first()[0] - budget) <= 4.5


def test_empty_equal_and_materialised(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "a b", "s", "x")] * 50 + [(2, "c", "t", "x")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA))
    assert {r.taken for r in got.filter("doc_id = 1").collect()} <= {0, 2, 4, 6}
    assert len(got.filter("doc_id = 1").select("copies").distinct().collect()) == 1
    assert mixing.materialised(got).count() == got.agg(F.sum("copies")).first()[0]


def test_sql(spark):
    folder = f"{TESTDATA}/sf0.001"
    assert differences(queries.op4_source_mixing(spark, folder), connect(folder), queries.SQL["op4_source_mixing"]) is None


def test_many_sources_and_clashing_columns(spark, monkeypatch):
    """More sources than are broadcast: the same mix; columns of the results' names are replaced."""
    rows = [(k, f"{'w ' * (k % 7)}{k}", None if k % 11 == 0 else f"s{min(k % 60, 25)}", "clash", 1, 2) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string, target int, threshold int")
    few = {tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken", "threshold").collect()}
    monkeypatch.setattr(mixing, "FEW", 20)  # 27 sources; those with more than a twentieth of the rows are hot
    many = [tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken", "threshold").collect()]
    assert len(many) == 900 and set(many) == few
