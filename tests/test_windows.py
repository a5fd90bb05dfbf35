"""Split and unsplit forms agree, also with a key holding most rows, NULL keys and gaps."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tramline.operators import aggregates, quantiles, reshape, windows


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "key": rng.choice(["hot", "a", "b", None], n, p=[0.7, 0.1, 0.1, 0.1]),
            "bucket": np.sort(rng.integers(0, 40, n)),
            "v": rng.normal(0, 50, n).round(1),
        }
    )
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "id long, key string, bucket int, v double").cache()


@pytest.fixture(params=[0.0, 0.5, 1.0], ids=["all keys split", "only the hot key", "no key split"], autouse=True)
def hot_share(request, monkeypatch):
    monkeypatch.setattr(windows, "HOT_SHARE", request.param)


def test_hot_keys_are_bounded(skewed, rows):
    assert rows(windows.hot_keys(skewed, ["key"], 0.5)) == [("hot",)]
    assert windows.hot_keys(skewed, ["key"], 1.0).isEmpty()


def test_lag_split_equals_plain(skewed, rows):
    plain = windows.lagged(skewed, ["key"], ["id"], {"p": "v"})
    split = windows.lagged(skewed, ["key"], ["id"], {"p": "v"}, ["bucket"])
    assert rows(plain, "id", "p") == rows(split, "id", "p")


@pytest.mark.parametrize("first", ["zero", "null", "drop"])
@pytest.mark.parametrize("direction", ["rise", "fall"])
def test_delta_split_equals_plain(skewed, rows, first, direction):
    args = (skewed.dropna(subset=["v"]), ["key"], ["id"], "v", "d", direction, first)
    assert rows(windows.positive_delta(*args), "id", "d") == rows(windows.positive_delta(*args, ["bucket"]), "id", "d")


def test_running_sum_and_positions(skewed, rows):
    whole = skewed.withColumn("c", F.col("id") % 11)
    assert rows(windows.running_sum(whole, ["key"], ["id"], "c", "s"), "id", "s") == rows(
        windows.running_sum(whole, ["key"], ["id"], "c", "s", ["bucket"]), "id", "s"
    )
    assert rows(windows.positions(skewed, ["key"], ["id"]), "id", "position", "size") == rows(
        windows.positions(skewed, ["key"], ["id"], ["bucket"]), "id", "position", "size"
    )


def test_negative_direction_is_checked(skewed):
    with pytest.raises(ValueError, match="direction"):
        windows.positive_delta(skewed, ["key"], ["id"], "v", direction="up")


def test_no_task_sorts_a_whole_key(skewed):
    plan = windows.lagged(skewed, ["key"], ["id"], {"p": "v"}, ["bucket"])._jdf.queryExecution().toString()
    assert "hashpartitioning(key" in plan and "__bucket" in plan


def test_standing_matches_pandas(skewed, rows):
    pdf = skewed.dropna(subset=["v"]).toPandas()
    pdf["rank"] = pdf["v"].rank(ascending=False, method="min").astype(int)
    got = dict((r["id"], r["rank"]) for r in windows.standing(skewed, "v").filter("v IS NOT NULL").collect())
    assert got == dict(zip(pdf["id"], pdf["rank"], strict=True))


def test_quantiles_match_numpy(skewed):
    probs = {"p0": 0.0, "p1": 0.13, "p5": 0.5, "p9": 0.987, "p10": 1.0}
    pdf = skewed.dropna(subset=["v"]).toPandas()
    got = {r["key"]: r for r in quantiles.exact_quantiles(skewed, ["key"], "v", probs).collect()}
    for key in ["hot", "a", "b", None]:
        part = pdf[pdf["key"].isna()] if key is None else pdf[pdf["key"] == key]
        for name, p in probs.items():
            assert got[key][name] == pytest.approx(np.quantile(part["v"], p), abs=1e-9)


def test_quantiles_of_one_value_and_none(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "k string, v double")
    got = quantiles.exact_quantiles(df, ["k"], "v", {"m": 0.5}).collect()
    assert [(r["k"], r["m"]) for r in got] == [("a", 5.0)]


def test_describe_matches_pandas(skewed):
    want = skewed.select("v").toPandas()["v"].describe()
    got = quantiles.describe(skewed, [], "v").first()
    assert [got[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")] == pytest.approx(list(want))


@pytest.mark.parametrize("series", [[None, 1.0, None, 3.0], [1.0, None, None, None, None, None, 7.0], [2.0, None, None, None, None], [None, None]])
def test_interpolation_matches_pandas(spark, series):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(series)], "k int, i int, v double")
    got = [r["f"] for r in reshape.interpolate(df, ["k"], "i", "v", "f", 3).orderBy("i").collect()]
    want = pd.Series(series, dtype=float).interpolate("linear", limit=3)
    assert got == pytest.approx([None if np.isnan(v) else v for v in want])


def test_trailing_means_match_pandas(spark):
    values = list(np.random.default_rng(1).integers(0, 100, 40))
    df = spark.createDataFrame([(1, i, int(v)) for i, v in enumerate(values)], "k int, d int, v int")
    got = windows.lag_features(df, ["k"], ["d"], "v", (1, 7), {7: 3}).orderBy("d").toPandas()
    s = pd.Series(values)
    assert got["lag7"].tolist()[7:] == s.shift(7).tolist()[7:]
    pd.testing.assert_series_equal(got["mean7"], s.shift(1).rolling(7, min_periods=3).mean(), check_names=False)


def test_histogram_of_equal_values(spark):
    assert [tuple(r) for r in aggregates.histogram(spark.createDataFrame([(2.0,)] * 3, "v double"), "v", 5).collect()] == [(0, 2.0, 3)]


def test_calendar_fill(spark, rows):
    df = spark.sql("SELECT 'a' k, DATE'2024-02-27' d, 1 v UNION ALL SELECT 'a', DATE'2024-03-01', 2")
    assert [r["v"] for r in reshape.fill_days(df, ["k"], "d").orderBy("d").collect()] == [1, None, None, 2]
    assert reshape.missing_days(df, ["k"], "d").count() == 2


def test_chronological_split_floors(spark):
    df = spark.createDataFrame([(1, i) for i in range(7)], "k int, i int")
    assert windows.chronological_split(df, ["k"], ["i"]).filter("is_train").count() == 5


@pytest.mark.parametrize("value", ["5 + id * 1e-6", "pow(id, 6)", "-id", "if(id % 3 = 0, id, id * 1e-9)"])
def test_ranges_are_even_and_in_order(spark, value):
    df = spark.range(100_000).selectExpr(f"CAST({value} AS DOUBLE) AS v", "id % 2 AS k").dropDuplicates(["k", "v"])
    sized = windows.ranged(df, ["k"], "v", "r").groupBy("r").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    rows = sorted(sized.collect())
    assert max(r["n"] for r in rows) < 2 * 100_000 / 256
    assert all(a["hi"] < b["lo"] for a, b in zip(rows, rows[1:], strict=False))


def test_ranges_of_few_and_no_rows(spark):
    few = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "v double")
    got = {str(r["v"]): r["r"] for r in windows.ranged(few, [], "v", "r").collect()}
    assert got["1.0"] < got["2.0"] <= got["nan"]
    assert windows.ranged(few.limit(0), [], "v", "r").collect() == []


def test_points_of_ranges_are_in_the_plan_once(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS v")
    plan = windows.ranged(df, [], "v", "r")._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("scalar-subquery#") <= 3
