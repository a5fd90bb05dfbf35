"""Vector operators against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.harness import TESTDATA
from tramline.llm import ann, pigeonhole, queries
from tramline.llm.components import components

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, n_links bigint"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v if v is None else [None if x is None else float(x) for x in v], 1, 0.0, 0) for k, v in vectors], SCHEMA)


def plain_nearest(rows, k=20):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        score = x @ x[at]
        score[at] = -np.inf
        order = np.lexsort((ids, -np.round(score, 12)))[: min(k, len(ids) - 1)]
        out[int(ids[at])] = [(int(ids[i]), score[i]) for i in order]
    return out


def plain_links(rows, least=0.9):
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float32).astype(float)
    n = np.linalg.norm(x, axis=1)
    link = (x @ x.T) / n[:, None] / n[None, :] >= least
    np.fill_diagonal(link, False)
    root = dict(zip(range(len(ids)), ids, strict=True))
    while True:
        new = {i: min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in root}
        if new == root:
            break
        root = new
    return {ids[i]: (int(link[i].sum()), root[i]) for i in root}


def clustered(n, size, seed, spread=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(n // 40, 1), size))
    return [(i, centres[i % len(centres)] + spread * rng.standard_normal(size)) for i in range(n)]


def test_every_length_is_searched(spark):
    rows = [(i, v) for i, v in clustered(100, 8, 3)] + [(1000 + i, v) for i, v in clustered(40, 4, 4)]
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = plain_nearest(rows[:100]) | plain_nearest(rows[100:])
    assert {q: [i for i, _ in found] for q, found in want.items()} == got


def test_structure_needs_few_blocks_and_short_blocks_starve_no_query(spark, monkeypatch):
    """Vectors along a line: few blocks hold the neighbours; every query still gets 20."""
    monkeypatch.setattr(ann, "_BLOCK", 30)
    angle = np.linspace(0, np.pi, 3000)
    rows = [(i, [np.cos(a), np.sin(a), 0.01 * np.cos(9 * a)]) for i, a in enumerate(angle)]
    seen = []
    reach = ann._reach
    monkeypatch.setattr(ann, "_reach", lambda *a: seen.append((*reach(*a), a[2])) or seen[-1][:2])
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    assert len(got) == 150 and all(sorted(v) == list(range(1, 21)) for v in got.values())
    want = plain_nearest(rows)
    hits = sum(len({i for i, _ in want[q]} & set(v.values())) for q, v in got.items())
    assert hits >= 0.95 * 20 * len(got)
    curves, blocks, total = seen[0]
    assert curves * (2 * blocks + 1) < 0.2 * max(total)


def test_enough_rows_around_every_place():
    assert ann._enough(np.array([50, 1, 1, 50]), 20) == 1
    assert ann._enough(np.array([1, 1, 1, 1, 30]), 20) == 4
    assert ann._enough(np.array([5]), 20) == 0


def test_repeated_ids_give_one_list(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.9, 0.1]), (2, [0.1, 0.8]), (3, [0.5, 0.5]), (3, [0.5, 0.5])]
    got = [tuple(r) for r in ann.nearest(frame(spark, rows), F.col("vec_id") == 0, k=3).orderBy("rank").collect()]
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]


def test_hilbert_neighbours_differ_by_one():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("size", [3, 24])
def test_nearest_recall_and_order(spark, monkeypatch, size):
    rows = clustered(1500, size, 1)
    rows += [(5000 + k, rows[0][1]) for k in range(60)]
    monkeypatch.setattr(ann, "_BLOCK", 50)
    monkeypatch.setattr(ann, "_TOGETHER", 4)
    bad = [(9000, None), (9020, []), (9040, [0.0] * size), (9060, [float("nan")] * size), (9080, [float("inf")] + [1.0] * (size - 1)), (9100, [None] + [1.0] * (size - 1)), (9120, [1.0])]
    got = ann.nearest(frame(spark, rows + bad), F.col("vec_id") % 20 == 0).collect()
    expected = plain_nearest(rows)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == set(expected)
    hits = 0
    for query, want in expected.items():
        own = [found[query][k] for k in range(1, 21)]
        hits += len({i for i, _ in own} & {i for i, _ in want})
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and query not in {i for i, _ in own}
    assert hits / (20 * len(expected)) >= 0.95
    # Equal scores go to the smaller id; the copies of vector 0 tie among themselves.
    copies = [i for i, _ in (found[5000][k] for k in range(1, 21)) if i == 0 or i > 5000]
    assert copies == sorted(copies)
    assert size == 3 or copies == [0, *range(5001, 5020)]


def test_nearest_few_rows(spark):
    got = ann.nearest(frame(spark, [(0, [1, 0]), (1, [0.5, 0]), (20, [0, 1])]), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0)]
    assert ann.nearest(frame(spark, [(0, [1, 0])]), F.lit(True)).collect() == []
    assert ann.nearest(frame(spark, [(1, None)]), F.lit(True)).collect() == []
    assert ann.nearest(frame(spark, []), F.lit(True)).collect() == []


def test_nearest_query_recall(spark):
    folder = f"{TESTDATA}/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    expected = plain_nearest(rows)
    got = queries.op3_nearest_neighbours(spark, folder).collect()
    hits = sum((r.vec_id in {i for i, _ in expected[r.query_id]}) for r in got)
    assert len(got) == 20 * len(expected) and hits / len(got) >= 0.9


@pytest.mark.parametrize("size", [1, 2, 17, 64])
def test_links(spark, monkeypatch, size):
    monkeypatch.setattr(pigeonhole, "_PACK", 37)
    rng = np.random.default_rng(7)
    rows = clustered(240, size, 3, spread=0.3)
    rows += [(1000 + k, rows[k % 5][1]) for k in range(80)] + [(2000 + k, 3 * rows[7][1]) for k in range(3)]
    rows += [(3000 + k, rows[k][1] * (1 + 0.02 * rng.standard_normal(size))) for k in range(50)]
    bad = [(9000, None), (9001, [0.0] * size), (9002, [float("nan")] * size), (9003, [None] * size), (9004, [])]
    got = {r.vec_id: r for r in pigeonhole.linked(frame(spark, rows + bad)).collect()}
    expected = plain_links(rows)
    assert {k: (r.n_links, r.component_id) for k, r in got.items() if k < 9000} == expected
    assert all((got[k].n_links, got[k].component_id, got[k].kept) == (0, k, True) for k, _ in bad)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_links_lengths_ties_and_empty(spark):
    got = pigeonhole.linked(frame(spark, [(1, [1, 0]), (2, [1, 0, 0]), (3, [2, 0]), (3, [2, 0]), (4, [0.9, math.sqrt(1 - 0.81)])])).collect()
    said = sorted((r.vec_id, r.n_links, r.component_id) for r in got)
    assert said[1] == (2, 0, 2) and [x[0] for x in said] == [1, 2, 3, 3, 4] and said[0][1] >= 2
    assert pigeonhole.linked(frame(spark, [])).collect() == []
    assert [r.kept for r in pigeonhole.linked(frame(spark, [(5, None)])).collect()] == [True]


def test_query_links(spark):
    folder = f"{TESTDATA}/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id) for r in queries.op5_embedding_neardup(spark, folder).collect()} == plain_links(rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(100)] + [(200, 300), (300, 201), (5, 5), (200, 300)] + [(1000, 1000 + k) for k in range(50)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({roots[k] for k in range(101)}) == 1 and len({roots[k] for k in (200, 201, 300)}) == 1 and len(set(roots.values())) == 3
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
