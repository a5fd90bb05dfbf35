import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.operators import incremental, joins, spatial


def test_new_rows_treats_null_as_equal_and_is_idempotent(spark, rows):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, None, 3)], "p string, q string, v int")
    known = spark.createDataFrame([("a", None), (None, "z")], "p string, q string")
    fresh = joins.new_rows(df, known, ["p", "q"])
    assert rows(fresh, "v") == [(2,), (3,)]
    assert joins.new_rows(fresh, df, ["p", "q"]).isEmpty()


def test_upsert_twice_changes_nothing(spark, rows):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "c", 0)], "k int, n string, v int")
    new = spark.createDataFrame([(2, "b", 9), (None, "c", 9), (3, "d", 9)], "k int, n string, v int")
    once = incremental.upsert(old, new, ["k", "n"])
    assert rows(once) == rows(incremental.upsert(once, new, ["k", "n"]))
    assert rows(once, "n", "v") == [("a", 0), ("b", 9), ("c", 9), ("d", 9)]


def _haversine(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 6_371_000 * 2 * np.arcsin(np.sqrt(h))


@pytest.mark.parametrize(("lat0", "lon0"), [(51.03, 3.71), (0.0, 0.0), (-33.9, -70.6), (68.4, 17.4)])
@pytest.mark.parametrize("metres", [500, 120])
def test_radius_and_nearest_match_brute_force(spark, rows, lat0, lon0, metres):
    rng = np.random.default_rng(3)
    p = np.column_stack([lat0 + rng.normal(0, 0.01, 250), lon0 + rng.normal(0, 0.015, 250)])
    q = np.column_stack([lat0 + rng.normal(0, 0.01, 120), lon0 + rng.normal(0, 0.015, 120)])
    left = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(p)], "l int, la double, lo double")
    right = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], "r int, ra double, ro double")
    far = _haversine(p[:, None, 0], p[:, None, 1], q[None, :, 0], q[None, :, 1])
    want = sorted((int(i), int(j)) for i, j in np.argwhere(far <= metres))
    got = spatial.within_radius(left, right, metres, ("la", "lo"), ("ra", "ro")).select("l", "r").collect()
    assert sorted(tuple(r) for r in got) == want
    near = spatial.nearest(left, right, metres, ("la", "lo"), ("ra", "ro"), "r")
    expected = {i: (int(far[i].argmin()) if far[i].min() <= metres else None) for i in range(len(p))}
    assert {r["l"]: r["nearest_key"] for r in near.collect()} == expected
    any_near = spatial.near_any(left, right, metres, ("la", "lo"), ("ra", "ro"))
    assert {r["l"] for r in any_near.collect()} == {i for i, _ in want}


def test_pairs_of_one_position_are_dealt_over_tasks(spark, monkeypatch):
    """Rows that share a position, copies and nulls among them, in one partition of the left table."""
    monkeypatch.setattr(spatial, "_PART", 32, raising=False)
    left = spark.createDataFrame([(i % 290, 51.0, 3.0) for i in range(300)] + [(None, 51.0, 3.0), (7, None, 3.0), (8, 60.0, 3.0)], "l int, la double, lo double").coalesce(1)
    right = spark.createDataFrame([(i, 51.0 + i % 2 * 0.001, 3.0) for i in range(200)] + [(None, 51.0, 3.0), (9, 51.0, None)], "r int, ra double, ro double")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pairs = spatial.within_radius(left, right, 500, ("la", "lo"), ("ra", "ro"))
        got = pairs.select("l", "r", F.round("distance_m", 6), F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert pairs.columns == ["l", "la", "lo", "r", "ra", "ro", "distance_m"]
    far = round(float(_haversine(51.0, 3.0, 51.001, 3.0)), 6)
    want = Counter((a, b, far if (b or 0) % 2 else 0.0) for a in [*(i % 290 for i in range(300)), None] for b in [*range(200), None])
    assert Counter(tuple(r)[:3] for r in got) == want
    tasks = Counter(r[3] for r in got)
    assert len(tasks) > 4 and max(tasks.values()) < len(got) / 2


def test_nearest_with_copies_and_nulls(spark):
    left = spark.createDataFrame([(1, 51.0, 3.0), (2, 51.0, 3.0), (3, None, 3.0)], "l int, la double, lo double")
    right = spark.createDataFrame([(9, 51.001, 3.0), (4, 51.001, 3.0)], "r int, ra double, ro double")
    got = spatial.nearest(left, right, 500, ("la", "lo"), ("ra", "ro"), "r")
    assert {r["l"]: r["nearest_key"] for r in got.collect()} == {1: 4, 2: 4, 3: None}


def test_linked_station_example(spark):
    bike = spark.createDataFrame([(1, 51.036, 3.71)], "b int, la double, lo double")
    stations = spark.createDataFrame([(101, 51.0361, 3.7101), (102, 51.2, 3.5)], "s int, ra double, ro double")
    assert spatial.nearest(bike, stations, 500, ("la", "lo"), ("ra", "ro"), "s").first()["nearest_key"] == 101


def test_closest_name_matches_all_pairs(spark):
    """The character join loses no pair at or above the cutoff."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def best(name):
        scored = [(1 - distance(name, o) / max(len(name), len(o)), o) for o in options]
        return max([x for x in scored if x[0] >= 0.6], default=(0, "unknown"))[1]

    rnd = random.Random(5)
    options = sorted({"".join(rnd.choice("abcde ") for _ in range(rnd.randint(2, 12))).strip() or "x" for _ in range(80)})
    typed = ["".join(rnd.choice("abcde ") for _ in range(rnd.randint(1, 14))) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in typed], "typed string")
    dim = spark.createDataFrame([(o,) for o in options], "name string")
    got = {r["typed"]: r["match"] for r in joins.closest_name(df, "typed", dim, "name").collect()}
    for t in typed:
        assert got[t] == best(t), t


def test_intervals_later_rows_win(spark, rows):
    spans = spark.sql("SELECT DATE'2026-07-01' s, DATE'2026-07-03' e, 1 o, 'a' n UNION ALL SELECT DATE'2026-07-03', DATE'2026-07-04', 2, 'b'")
    days = joins.on_days(spans, "s", "e", "o", "n")
    assert [r["n"] for r in days.orderBy("day").collect()] == ["a", "a", "b", "b"]


def test_days_of_intervals_are_not_sorted(spark):
    """Only one row per day at most is sorted: that of the winning interval. Nulls and copies keep their days."""
    spans = spark.sql(
        "SELECT DATE'2026-07-01' s, DATE'2026-07-03' e, 1 o, 'a' n UNION ALL SELECT DATE'2026-07-03', DATE'2026-07-04', 2, 'b' UNION ALL SELECT DATE'2026-07-03', DATE'2026-07-04', 2, 'b'"
        " UNION ALL SELECT DATE'2026-07-06', DATE'2026-07-06', CAST(NULL AS INT), 'c' UNION ALL SELECT NULL, DATE'2026-07-09', 9, 'd' UNION ALL SELECT DATE'2026-07-08', DATE'2026-07-08', 3, NULL"
    )
    got = {r["day"].day: r["n"] for r in joins.on_days(spans, "s", "e", "o", "n").collect()}
    assert got == {1: "a", 2: "a", 3: "b", 4: "b", 6: None, 8: None}
    many = spark.range(4000, numPartitions=1).selectExpr("DATE'2026-01-01' s", "DATE'2026-03-31' e", "id o", "CAST(id AS STRING) n")
    days = joins.on_days(many, "s", "e", "o", "n")
    assert {r["n"] for r in days.collect()} == {"3999"}
    assert "max_by" not in days._jdf.queryExecution().executedPlan().toString()


def test_last_by_keeps_newest(spark, rows):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, None), (2, 1, "z")], "k int, o int, v string")
    assert rows(joins.last_by(df, ["k"], ["o"])) == [(1, 2, None), (2, 1, "z")]


def test_surrogate_keys_continue_in_natural_order(spark, rows):
    existing = spark.createDataFrame([(7,), (3,)], "k int")
    fresh = spark.createDataFrame([(f"n{i:03d}",) for i in random.Random(1).sample(range(200), 200)], "name string")
    keyed = incremental.assign_keys(fresh, existing, "k", ["name"])
    assert rows(keyed) == sorted([(8 + i, f"n{i:03d}") for i in range(200)], key=repr)
    empty = incremental.assign_keys(fresh.limit(1), spark.createDataFrame([], "k int"), "k", ["name"])
    assert empty.first()["k"] == 1


def test_period_pruning(spark, rows):
    asked = spark.createDataFrame([(1, y, m) for y in (2024, 2025, 2026) for m in range(1, 13) if (y, m) <= (2026, 3)], "p int, year int, month int")
    loaded = spark.createDataFrame([(1, 2024, 5), (1, 2026, 1), (1, 2026, 3)], "p int, year int, month int")
    todo = rows(incremental.prune_loaded_periods(asked, loaded, "p", 2026, 3))
    assert todo == [(1, 2025, m) for m in (1, 10, 11, 12, 2, 3, 4, 5, 6, 7, 8, 9)] + [(1, 2026, 2), (1, 2026, 3)]


def test_predicate_delete_keeps_null_keys(spark, rows):
    df = spark.createDataFrame([(20260301,), (20260401,), (None,)], "d int")
    assert rows(incremental.drop_range(df, "d", 20260300, 20260399)) == [(20260401,), (None,)]


def test_reconcile_tags(spark):
    a = spark.createDataFrame([(1, "l"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2, "r"), (None, "m")], "k int, v string")
    got = {(r["k"], r["provenance"]) for r in joins.reconcile(a, b, ["k"]).collect()}
    assert got == {(1, "left_only"), (2, "right_only"), (None, "both")}
