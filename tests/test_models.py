from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.operators import aggregates
from tramline.plans import models, stats


@pytest.mark.parametrize(("t", "df", "p"), [(2.0, 10, 0.0733880348), (1.0, 1, 0.5), (0.0, 5, 1.0), (-12.0, 30, 5.6e-13), (1.959964, 1e7, 0.05)])
def test_p_values(t, df, p):
    assert stats.two_sided_p(t, df) == pytest.approx(p, rel=0.02 if p < 1e-6 else 1e-6)


def test_t_test_formulas(spark):
    a, b = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 9.0]
    df = spark.createDataFrame([("a", x) for x in a] + [("b", x) for x in b], "g string, v double")
    va, vb = np.var(a, ddof=1) / 4, np.var(b, ddof=1) / 3
    welch = stats.t_test(df, "g", "v", [("a", "b")], equal_var=False).first()
    assert welch["t"] == pytest.approx((np.mean(a) - np.mean(b)) / np.sqrt(va + vb))
    assert welch["df"] == pytest.approx((va + vb) ** 2 / (va**2 / 3 + vb**2 / 2))
    pooled = stats.t_test(df, "g", "v", [("a", "b")], equal_var=True).first()
    assert pooled["df"] == 5 and 0 < pooled["p_value"] < 1


def test_grouped_ols_matches_lstsq_and_skips_short_series(spark):
    rng = np.random.default_rng(0)
    rows = []
    for key, n in (("a", 60), ("b", 45), ("short", 10)):
        x = rng.normal(size=(n, 2)) * [1, 100] + [5, 1000]
        y = 3 + x @ [2.0, -0.5] + rng.normal(size=n)
        rows += [(key, *map(float, p), float(q)) for p, q in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "k string, x1 double, x2 double, y double")
    got = {r["k"]: r for r in stats.grouped_ols(df, ["k"], ["x1", "x2"], "y").collect()}
    assert set(got) == {"a", "b"}
    for key in got:
        part = np.array([r[1:] for r in rows if r[0] == key])
        want = np.linalg.lstsq(np.column_stack([np.ones(len(part)), part[:, :2]]), part[:, 2], rcond=None)[0]
        assert [got[key][c] for c in ("intercept", "coef_x1", "coef_x2")] == pytest.approx(list(want), rel=1e-6)


def test_ols_with_collinear_features_predicts_the_same(spark):
    df = spark.createDataFrame([("a", float(i), 2.0 * i, 5.0 + i) for i in range(40)], "k string, x1 double, x2 double, y double")
    fit = stats.grouped_ols(df, ["k"], ["x1", "x2"], "y")
    worst = stats.apply_ols(df, fit, ["k"], ["x1", "x2"]).agg(F.max(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    assert worst < 1e-6


def test_splits_are_exact_and_stable(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("c"))
    split = stats.random_split(df, "id", classes=["c"])
    again = stats.random_split(df.repartition(13), "id", classes=["c"])
    sizes = {r["c"]: r["n"] for r in split.filter("is_train").groupBy("c").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 267, 1: 266, 2: 266}
    assert split.exceptAll(again).isEmpty()


def test_standardise_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, True), (9.0, False)], "x double, tr boolean")
    assert sorted(r["x"] for r in stats.standardise(df, ["x"], "tr").collect()) == pytest.approx([-1.0, 1.0, 7.0])


def test_recursive_forecast_matches_a_loop(spark):
    rng = np.random.default_rng(2)
    history = [float(v) for v in rng.integers(50, 150, 40)]
    start = date(2026, 1, 1)
    days = [start + timedelta(days=i) for i in range(40)]
    daily = spark.createDataFrame([("a", d, v) for d, v in zip(days, history, strict=True)], "k string, day date, v double")
    names = ["lag1", "lag7", "mean7", "day_of_week", "month", "is_weekend", "is_holiday"]
    coef = [0.3, 0.2, 0.1, -1.5, 2.0, -9.0, -20.0]
    model = spark.createDataFrame([("a", 99, 20.0, *coef), ("new", 99, 20.0, *coef)], "k string, n long, intercept double, " + ", ".join(f"coef_{n} double" for n in names))
    as_of, feast = days[-1], days[-1] + timedelta(days=3)
    got = stats.recursive_forecast(daily, model, ["k"], "day", "v", names, as_of, 7, [feast]).collect()
    for key, past in (("a", history[-30:]), ("new", [100.0] * 30)):
        past, want = list(past), {}
        for i in range(1, 8):
            d = as_of + timedelta(days=i)
            x = [past[-1], past[-7], np.mean(past[-7:]), d.weekday(), d.month, int(d.weekday() >= 5), int(d == feast)]
            value = max(20.0 + float(np.dot(coef, x)), 0)
            past.append(value)
            want[d] = round(value)
        assert {r["day"]: r["forecast"] for r in got if r["k"] == key} == want


def _seasonal(n, noise=2.0, seed=4):
    t = np.arange(n)
    return 100 + 0.3 * t + 25 * np.sin(2 * np.pi * t / 7) + np.random.default_rng(seed).normal(0, noise, n)


def _daily(spark, values, key="a"):
    return spark.createDataFrame([(key, date(2025, 1, 1) + timedelta(days=i), None if np.isnan(v) else float(v)) for i, v in enumerate(values)], "k string, day date, v double")


def test_triple_smoothing_beats_the_naive_forecast(spark):
    y = _seasonal(140)
    split = _daily(spark, y).withColumn("is_train", F.col("day") < F.lit(date(2025, 1, 1) + timedelta(days=112)))
    out = models.smoothing_forecasts(split, ["k"], "day", "v", "is_train").orderBy("day").toPandas()
    assert len(out) == 28
    mae = {c: float((out[c] - out["v"]).abs().mean()) for c in ("ses", "des", "tes")}
    naive = float(np.abs(y[112:] - np.resize(y[105:112], 28)).mean())
    assert mae["tes"] < naive and mae["tes"] < mae["ses"] and mae["tes"] < 5


def test_short_series_have_no_seasonal_forecast():
    assert np.isnan(models.fit_forecast(np.arange(10.0), 3, True, 7)).all()
    assert models.fit_forecast(np.full(30, 5.0), 3) == pytest.approx([5.0] * 3)
    assert models.fit_forecast(np.arange(30.0), 2, True) == pytest.approx([30.0, 31.0], abs=0.2)


def test_short_series_fall_back_and_say_so(spark):
    start = date(2025, 1, 1)
    rows = [(k, start + timedelta(days=i), v, i < trained) for k, values, trained in [
        ("whole", [10.0 + i % 7 for i in range(40)], 35), ("short", [float(i) for i in range(13)], 10), ("late", [None, None, 4.0, 4.0, 4.0, 4.0], 5),
        ("one", [3.0, 9.0], 1), ("nothing", [None, 5.0], 1),
    ] for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "k string, day date, v double, is_train boolean")
    out = {(r["k"], r["day"]): r for r in models.smoothing_forecasts(frame, ["k"], "day", "v", "is_train").collect()}
    kinds = {k: r["tes_kind"] for (k, _), r in out.items()}
    assert kinds == {"whole": "seasonal", "short": "trend", "late": "trend", "one": "level", "nothing": "none"}
    assert len(out) == 5 + 3 + 1 + 1 + 1
    assert out["short", start + timedelta(days=12)]["tes"] == pytest.approx(12, abs=0.3)
    assert out["late", start + timedelta(days=5)]["tes"] == pytest.approx(4.0)
    assert out["one", start + timedelta(days=1)]["tes"] == 3.0
    lost = out["nothing", start + timedelta(days=1)]
    assert lost["tes"] is None or np.isnan(lost["tes"])


def test_contamination_from_a_label(spark):
    df = spark.range(400).select("id", F.rand(3).alias("a"), F.rand(4).alias("b"), (F.col("id") % 5 > 0).alias("is_train"), (F.col("id") % 8 == 1).cast("int").alias("proxy"))
    out = models.isolation_forest(df, "id", ["a", "b"], "is_train", "proxy", trees=20)
    rate = df.filter("is_train").agg(F.avg("proxy")).first()[0]
    marked, n = out.filter("is_train").agg(F.sum("anomaly"), F.count(F.lit(1))).first()
    assert abs(marked - rate * n) <= 1


def test_scores_of_nested_quantiles_stay_a_small_plan(spark):
    """Fences of scaled rows under the forest: the plan stays small."""
    df = spark.range(300).select("id", F.rand(3).alias("a"), F.rand(4).alias("b"), (F.col("id") % 5 > 0).alias("is_train"))
    marked = stats.outside_fences(df, df.filter("is_train"), "a", "proxy")
    assert marked._jdf.queryExecution().optimizedPlan().toString().count("scalar-subquery#") < 20
    out = models.isolation_forest(marked, "id", ["a", "b"], "is_train", "proxy", trees=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "mapInPandas" not in plan and plan.count("scalar-subquery#") < 20
    assert out.count() == 300


def test_gaps_are_filled_from_the_past_only(spark):
    y = _seasonal(80, 0.5)
    holed = y.copy()
    holed[[3, 40, 41, 60, 61, 62]] = np.nan
    out = models.impute_gaps(_daily(spark, holed), ["k"], "day", "v").orderBy("day").toPandas()
    assert out["imputed"].sum() == 0 and np.isnan(out["filled"][3])  # an early gap stays and blocks later fits
    holed[3] = y[3]
    out = models.impute_gaps(_daily(spark, holed), ["k"], "day", "v").orderBy("day").toPandas()
    assert list(np.flatnonzero(out["imputed"])) == [40, 41, 60, 61, 62]
    assert np.abs(out["filled"].to_numpy() - y)[[40, 41, 60, 61, 62]].max() < 6


def test_isolation_forest_finds_the_outliers(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(0, 1, (600, 2))
    x[:6] = [[9, 9], [-9, 8], [10, -9], [-8, -10], [0, 14], [13, 0]]
    df = spark.createDataFrame([(i, *map(float, p), i % 5 > 0) for i, p in enumerate(x)], "id int, a double, b double, is_train boolean")
    out = models.isolation_forest(df, "id", ["a", "b"], "is_train", 0.02, trees=40)
    worst = {r["id"] for r in out.orderBy("score").limit(6).collect()}
    assert worst == set(range(6))
    again = models.isolation_forest(df.repartition(11), "id", ["a", "b"], "is_train", 0.02, trees=40)
    assert out.select("id", F.round("score", 9)).exceptAll(again.select("id", F.round("score", 9))).isEmpty()


def test_tree_samples_are_bounded(spark):
    df = spark.range(20000).select("id", F.rand(1).alias("a"))
    sizes = [r["count"] for r in models.tree_samples(df, "id", ["a"], 20, 64, 1).groupBy("tree").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 64 and min(sizes) > 40


def test_sweep_does_not_pass_over_tiny_partitions(spark):
    df = spark.range(600).select("id", F.rand(5).alias("a"), (F.rand(6) + F.col("id") % 3).alias("b")).repartition(150)
    context = spark.sparkContext
    context.setJobGroup("sweep", "sweep")
    try:
        out = models.kmeans_sweep(df, ["a", "b"], range(1, 4)).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert [r["k"] for r in out] == [1, 2, 3] and out[0]["inertia"] > out[1]["inertia"] > out[2]["inertia"]
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("sweep") for s in tracker.getJobInfo(j).stageIds]
    assert len(stages) > 20 and sum(s is not None and s.numTasks >= 150 for s in stages) <= 6


def test_clusters_and_components(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.1, (40, 2)) for c in ([0, 0], [5, 5], [0, 5])])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, a double, b double")
    sweep = models.kmeans_sweep(df, ["a", "b"], range(1, 5)).toPandas().set_index("k")
    assert sweep["inertia"][1] == pytest.approx(((x - x.mean(axis=0)) ** 2).sum())
    assert sweep["silhouette"].idxmax() == 3
    labelled = models.kmeans_clusters(df, ["a", "b"], 3).toPandas()
    assert labelled.groupby(labelled["id"] // 40)["cluster"].nunique().tolist() == [1, 1, 1]
    scaled = stats.standardise(df, ["a", "b"])
    rows, loadings = models.principal_components(scaled, ["a", "b"])
    shares = loadings.select("component", "explained").distinct().toPandas()["explained"]
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)) / 2)[::-1]
    assert sorted(shares, reverse=True) == pytest.approx(list(want))
    assert rows.agg(F.var_pop("pc1")).first()[0] == pytest.approx(want[0] * 2)


def test_pooled_forest_beats_naive_on_noisy_weeks(spark):
    frames = []
    for k, level in (("a", 100.0), ("b", 400.0)):
        y = _seasonal(220, 12.0, seed=int(level)) + level
        frames += [(k, date(2025, 1, 1) + timedelta(days=i), float(v)) for i, v in enumerate(y)]
    daily = spark.createDataFrame(frames, "k string, day date, v double")
    rows = stats.series_features(daily, ["k"], "day", "v").withColumn("is_train", F.col("day") < F.lit(date(2025, 7, 1)))
    names = ["lag1", "lag7", "mean7", "day_of_week", "is_weekend"]
    scored, importances = models.forest_regression(rows, ["k"], names, "v", "is_train", trees=30, depth=8)
    assert abs(importances.agg(F.sum("importance")).first()[0] - 1) < 1e-6
    forest = aggregates.forecast_errors(scored, "v", "predicted").first()["mae"]
    naive = aggregates.forecast_errors(scored, "v", "lag7").first()["mae"]
    assert forest < naive


def test_circular_errors(spark):
    df = spark.createDataFrame([(11, 0), (5, 5), (0, 3), (1, 11)], "t int, predicted int")
    got = models.circular_errors(df, "t").first()
    assert (got["accuracy"], got["mean_gap"], got["median_gap"], got["within_1"], got["within_2"]) == (0.25, 1.5, 1.5, 0.5, 0.75)
