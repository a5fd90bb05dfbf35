"""Model jobs at the size of the operators' defaults. Most have no SQL equivalent; tests compare them with small direct computations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import DAILY, Tables, query
from tramline.operators import aggregates, reshape, windows
from tramline.plans import models, reports, stats
from tramline.session import cut_lineage


def _features(t: Tables):
    rows = stats.series_features(t.daily, ["c_nationkey"], "day", "total")
    return windows.chronological_split(rows, ["c_nationkey"], ["day"])


_NAMES = ["lag1", "lag7", "mean7", "day_of_week", "month", "is_weekend"]


@query("forest_forecast_errors", "N7 N6 J5 N19")
def forest_forecast_errors(t: Tables):
    scored, _ = models.forest_regression(_features(t), ["c_nationkey"], _NAMES, "total", "is_train")
    return aggregates.forecast_errors(scored, "total", "predicted", ["c_nationkey"])


@query("forest_importances", "N8")
def forest_importances(t: Tables):
    _, table = models.forest_regression(_features(t), ["c_nationkey"], _NAMES, "total", "is_train")
    return table


_WEATHER = ["temp", "rain", "wind", "sun", "highest", "lowest", "spread", "pressure", "gusts", "humidity", "soil", "grass", "waves"]


def _days_of_weather(t: Tables):
    """Line items per ship day as daily weather with its month as class 0..11."""
    day = F.col("l_shipdate").cast("date")
    daily = t.lineitem.groupBy(day.alias("day")).agg(
        F.avg("l_quantity").alias("temp"), F.avg("l_discount").alias("rain"), F.avg("l_tax").alias("wind"), F.count(F.lit(1)).cast("double").alias("sun"),
        F.max("l_extendedprice").alias("highest"), F.min("l_extendedprice").alias("lowest"), F.stddev_pop("l_quantity").alias("spread"),
        F.avg("l_extendedprice").alias("pressure"), F.max("l_tax").alias("gusts"), F.stddev_pop("l_discount").alias("humidity"), F.avg("l_linenumber").alias("soil"),
        F.min("l_quantity").alias("grass"), F.sum("l_quantity").alias("waves"),
    )
    labelled = daily.select("*", (F.month("day") - 1).alias("label")).fillna(0.0)
    return stats.random_split(labelled, "day", classes=["label"])


@query("month_classifier_errors", "N9 N10 N12 F27")
def month_classifier_errors(t: Tables):
    scored, _ = models.forest_classification(_days_of_weather(t), _WEATHER, "label", "is_train")
    return models.circular_errors(scored, "label")


@query("month_classifier_report", "N13 A21 A22")
def month_classifier_report(t: Tables):
    scored, _ = models.forest_classification(_days_of_weather(t), _WEATHER, "label", "is_train")
    return aggregates.class_report(scored, "label", "predicted")


@query("isolation_forest_labels", "N4 T5 N3 N5")
def isolation_forest_labels(t: Tables):
    """Anomalies on scaled order days, compared with the fence label."""
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).cast("double").alias("n"))
    # One row per day from here on; scaling and fences each read it several times.
    split = cut_lineage(windows.chronological_split(daily.withColumn("year", F.year("day")), [], ["day"], split=["year"]))
    scaled = stats.standardise(split, ["total", "n"], "is_train")
    proxied = stats.outside_fences(scaled, scaled.filter("is_train"), "total", "proxy")
    scored = models.isolation_forest(proxied, "day", ["total", "n"], "is_train", "proxy")
    return aggregates.binary_scores(scored, "proxy", "anomaly", ["is_train"])


_PROFILE = ["rush_ratio", "weekend_ratio", "rentals_per_day"]


def _profile(t: Tables):
    profile = reports.activity_profile(t.gauge, "user_id", "ts", "value", ["minute"])
    return stats.standardise(profile, _PROFILE)


@query("cluster_sweep", "N14")
def cluster_sweep(t: Tables):
    return models.kmeans_sweep(_profile(t), _PROFILE, range(1, 10))


@query("cluster_profiles", "N15 N14 N11 M15 N2")
def cluster_profiles(t: Tables):
    split = stats.random_split(_profile(t), "user_id")
    clustered = models.kmeans_clusters(split, _PROFILE, 3, is_train="is_train")
    return models.cluster_profile(clustered, _PROFILE, ["is_train", "cluster"])


@query("component_loadings", "N16")
def component_loadings(t: Tables):
    _, loadings = models.principal_components(_profile(t), _PROFILE)
    return loadings


@query("smoothing_errors", "N20 N23 N18")
def smoothing_errors(t: Tables):
    split = windows.chronological_split(t.daily, ["c_nationkey"], ["day"])
    forecasts = models.smoothing_forecasts(split, ["c_nationkey"], "day", "total", "is_train")
    return stats.model_comparison(forecasts, ["c_nationkey"], "total", ["ses", "des", "tes"])


@query("yearly_smoothing_errors", "N20 N23")
def yearly_smoothing_errors(t: Tables):
    """As ``smoothing_errors`` with a season of a year."""
    split = windows.chronological_split(t.daily, ["c_nationkey"], ["day"])
    forecasts = models.smoothing_forecasts(split, ["c_nationkey"], "day", "total", "is_train", 365)
    return stats.model_comparison(forecasts, ["c_nationkey"], "total", ["ses", "des", "tes"])


_SEASON, _A, _B, _G = 7, 0.3, 0.1, 0.2


@query(
    "smoothed_week_ahead",
    "N20 N21",
    f"""WITH RECURSIVE {DAILY}, y AS (SELECT c_nationkey, list(total::DOUBLE ORDER BY day) AS v FROM daily GROUP BY 1 HAVING count(*) >= {2 * _SEASON}),
    start AS (SELECT c_nationkey, v, list_avg(v[1:{_SEASON}]) AS l, list_avg(v[{_SEASON + 1}:{2 * _SEASON}]) AS l2 FROM y),
    run AS (
      SELECT c_nationkey, 1::BIGINT AS i, l, (l2 - l) / {_SEASON} AS b, list_transform(v[1:{_SEASON}], lambda x: x - l) AS s FROM start
      UNION ALL
      SELECT c_nationkey, i + 1, nl, {_B} * (nl - l) + (1 - {_B}) * b, list_append(s[2:], {_G} * (a - l - ({_B} * (nl - l) + (1 - {_B}) * b)) + (1 - {_G}) * s[1])
      FROM (SELECT r.c_nationkey, i, l, b, s, v[i] AS a, {_A} * (v[i] - s[1]) + (1 - {_A}) * (l + b) AS nl FROM run r JOIN y ON y.c_nationkey = r.c_nationkey WHERE i <= len(v))),
    last AS (SELECT r.* FROM run r JOIN y ON y.c_nationkey = r.c_nationkey WHERE i = len(v) + 1)
    SELECT c_nationkey, step::INT AS step, round(l + b * step + s[step], 2) AS forecast FROM last, (SELECT unnest(generate_series(1, {_SEASON})) AS step)""",
)
def smoothed_week_ahead(t: Tables):
    """Triple smoothing with given parameters, a week ahead."""
    out = models.smoothed_ahead(t.daily, ["c_nationkey"], "day", "total", _SEASON, _A, _B, _G, _SEASON)
    return out.withColumn("forecast", F.round("forecast", 2))


@query(
    "forests_against_naive",
    "N7 N18 N19 N23",
    f"""WITH {DAILY}, x AS (SELECT c_nationkey, total, lag(total, 7) OVER w AS naive, row_number() OVER w AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day))
    SELECT count(*) AS n, round(sqrt(avg(pow(total - naive, 2))), 2) AS naive_rmse, TRUE AS forest_is_better FROM x WHERE i > floor(n * 0.8) AND naive IS NOT NULL""",
)
def forests_against_naive(t: Tables):
    """Held-out error of the forest at full size beside that of the value a week ago, over all series."""
    scored, _ = models.forest_regression(_features(t), ["c_nationkey"], _NAMES, "total", "is_train")
    total = F.col("total").cast("double")
    errors = scored.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(total - F.col("lag7"), F.lit(2)))).alias("naive"), F.sqrt(F.avg(F.pow(total - F.col("predicted"), F.lit(2)))).alias("forest")
    )
    return errors.select("n", F.round("naive", 2).alias("naive_rmse"), (F.col("forest") < F.col("naive")).alias("forest_is_better"))


@query("imputed_gaps", "N21 U6")
def imputed_gaps(t: Tables):
    """Daily totals per event type with every ninth day left out and filled again."""
    daily = t.gauge.filter(F.dayofmonth("day") % 9 > 0).groupBy("event_type", "day").agg(F.sum("value").alias("total"))
    return models.impute_gaps(reshape.fill_days(daily, ["event_type"], "day"), ["event_type"], "day", "total")
