"""Splits, scaling, regressions and forecast errors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tramline.catalog.base import DAILY, Tables, query
from tramline.operators import aggregates, windows
from tramline.plans import stats


def _rounded(df, **digits: int):
    return df.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns))


@query(
    "random_split",
    "N11",
    """SELECT c_custkey, row_number() OVER (ORDER BY md5('42:' || c_custkey)) <= floor(count(*) OVER () * 0.8) AS is_train FROM customer""",
)
def random_split(t: Tables):
    return stats.random_split(t.customer.select("c_custkey"), "c_custkey")


@query(
    "stratified_split",
    "N10",
    """SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY md5('42:' || event_id)) <= floor(count(*) OVER (PARTITION BY event_type) * 0.8) AS is_train FROM events""",
)
def stratified_split(t: Tables):
    return stats.random_split(t.events.select("event_id", "event_type"), "event_id", classes=["event_type"])


@query(
    "standardised",
    "N2 X7",
    """WITH tr AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
    SELECT l_orderkey, l_partkey, l_suppkey, round((l_quantity - mq) / sq, 6) AS l_quantity, round((l_extendedprice - mp) / sp, 6) AS l_extendedprice FROM lineitem, tr""",
)
def standardised(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")).alias("is_train"))
    return _rounded(stats.standardise(rows, ["l_quantity", "l_extendedprice"], "is_train").drop("is_train"), l_quantity=6, l_extendedprice=6)


@query(
    "outliers_by_fences",
    "N3",
    """WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events WHERE day(ts) <= 20)
    SELECT event_id, (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))::INT AS outlier FROM events, q""",
)
def outliers_by_fences(t: Tables):
    return stats.outside_fences(t.events, t.events.filter(F.dayofmonth("ts") <= 20), "value").select("event_id", "outlier")


@query(
    "series_features",
    "N6 W4 W5 F14 X10",
    f"""WITH {DAILY} SELECT c_nationkey, day, total, lag(total, 1) OVER w AS lag1, lag(total, 7) OVER w AS lag7, CASE WHEN count(total) OVER w7 >= 3 THEN round(avg(total) OVER w7, 4) END AS mean7,
      month(day)::INT AS month, (isodow(day) - 1)::INT AS day_of_week, dayofyear(day)::INT AS day_of_year, (isodow(day) >= 6)::INT AS is_weekend
    FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day), w7 AS (PARTITION BY c_nationkey ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
)
def series_features(t: Tables):
    return _rounded(stats.series_features(t.daily, ["c_nationkey"], "day", "total"), mean7=4)


_OLS = f"""{DAILY}, f AS (SELECT c_nationkey, total::DOUBLE AS y, month(day)::DOUBLE AS a, dayofyear(day)::DOUBLE AS b FROM daily),
s AS (SELECT c_nationkey, count(*) AS n, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS saa, var_pop(b) AS sbb, covar_pop(a, b) AS sab, covar_pop(a, y) AS say, covar_pop(b, y) AS sby FROM f GROUP BY 1 HAVING count(*) >= 30),
k AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS ka, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS kb FROM s)"""


@query(
    "regression_per_series",
    "N17",
    f"WITH {_OLS} SELECT c_nationkey, n, round(my - ka * ma - kb * mb, 2) AS intercept, round(ka, 2) AS coef_month, round(kb, 4) AS coef_day_of_year FROM k",
)
def regression_per_series(t: Tables):
    rows = t.daily.withColumns({"month": F.month("day"), "day_of_year": F.dayofyear("day")})
    return _rounded(stats.grouped_ols(rows, ["c_nationkey"], ["month", "day_of_year"], "total"), intercept=2, coef_month=2, coef_day_of_year=4)


_EVAL = """x AS (SELECT c_nationkey, day, total, lag(total, 7) OVER w AS naive, row_number() OVER w AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day)),
test AS (SELECT * FROM x WHERE i > floor(n * 0.8) AND naive IS NOT NULL)"""


def _evaluated(t: Tables):
    lagged = windows.lag_features(t.daily, ["c_nationkey"], ["day"], "total", (1, 7))
    split = windows.chronological_split(lagged, ["c_nationkey"], ["day"])
    return split.filter(~F.col("is_train") & F.col("lag7").isNotNull()).withColumnRenamed("lag7", "naive")


@query(
    "naive_forecast_errors",
    "N18 N19",
    f"""WITH {DAILY}, {_EVAL} SELECT c_nationkey, count(*) AS n, round(avg(abs(total - naive)), 4) AS mae, round(sqrt(avg(pow(total - naive, 2))), 4) AS rmse, round(avg(abs(total - naive)) / avg(total) * 100, 4) AS mape FROM test GROUP BY 1""",
)
def naive_forecast_errors(t: Tables):
    return _rounded(aggregates.forecast_errors(_evaluated(t), "total", "naive", ["c_nationkey"]), mae=4, rmse=4, mape=4)


@query(
    "horizon_errors",
    "N22",
    f"""WITH {DAILY}, {_EVAL}, h AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY day) AS horizon FROM test)
    SELECT c_nationkey, horizon::INT AS horizon, round(avg(abs(total - naive)) OVER (PARTITION BY c_nationkey ORDER BY day ROWS UNBOUNDED PRECEDING), 4) AS mae_naive FROM h QUALIFY horizon <= 7""",
)
def horizon_errors(t: Tables):
    return _rounded(stats.horizon_errors(_evaluated(t), ["c_nationkey"], "day", "total", ["naive"]), mae_naive=4)


_MODELS = f"""WITH {DAILY}, x AS (SELECT c_nationkey, day, total, lag(total, 1) OVER w AS lag1, lag(total, 7) OVER w AS lag7, row_number() OVER w AS i, count(*) OVER (PARTITION BY c_nationkey) AS n FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day)),
long AS (SELECT c_nationkey, total, 'lag1' AS model, lag1 AS p FROM x WHERE i > floor(n * 0.8) AND lag1 IS NOT NULL UNION ALL SELECT c_nationkey, total, 'lag7', lag7 FROM x WHERE i > floor(n * 0.8) AND lag7 IS NOT NULL)"""


def _test_rows(t: Tables):
    lagged = windows.lag_features(t.daily, ["c_nationkey"], ["day"], "total", (1, 7))
    return windows.chronological_split(lagged, ["c_nationkey"], ["day"]).filter(~F.col("is_train"))


@query(
    "model_comparison",
    "N23 N19",
    f"""{_MODELS} SELECT model, count(*) AS n, round(avg(abs(total - p)), 4) AS mae, round(sqrt(avg(pow(total - p, 2))), 4) AS rmse, round(avg(abs(total - p)) / avg(total) * 100, 4) AS mape FROM long GROUP BY 1""",
)
def model_comparison(t: Tables):
    return _rounded(stats.model_comparison(_test_rows(t), [], "total", ["lag1", "lag7"]), mae=4, rmse=4, mape=4)


@query(
    "error_distribution",
    "N28 A16",
    f"""{_MODELS} SELECT model, count(*) AS count, round(avg(total - p), 4) AS mean, round(stddev_samp(total - p), 4) AS std, min(total - p)::DOUBLE AS min, round(quantile_cont(total - p, 0.25), 4) AS q25,
      round(quantile_cont(total - p, 0.5), 4) AS q50, round(quantile_cont(total - p, 0.75), 4) AS q75, max(total - p)::DOUBLE AS max FROM long GROUP BY 1""",
)
def error_distribution(t: Tables):
    return _rounded(stats.error_distribution(_test_rows(t), "total", ["lag1", "lag7"]), mean=4, std=4, q25=4, q50=4, q75=4)


@query(
    "evaluation_ranking",
    "N27",
    f"""WITH {DAILY}, {_EVAL}, e AS (SELECT c_nationkey, avg(abs(total - naive)) AS mae FROM test GROUP BY 1)
    SELECT count(*) AS series, round(avg(mae), 4) AS mean_mae, min_by(c_nationkey, (mae, c_nationkey)) AS best, round(min(mae), 4) AS best_mae, max_by(c_nationkey, (mae, c_nationkey)) AS worst, round(max(mae), 4) AS worst_mae FROM e""",
)
def evaluation_ranking(t: Tables):
    scores = aggregates.forecast_errors(_evaluated(t), "total", "naive", ["c_nationkey"])
    return _rounded(stats.ranked_evaluation(scores, "c_nationkey"), mean_mae=4, best_mae=4, worst_mae=4)


@query(
    "calendar_forecast",
    "N26 N17",
    f"""WITH {_OLS}, d AS (SELECT unnest(generate_series(DATE '2001-08-02', DATE '2001-08-08', INTERVAL 1 DAY))::DATE AS day)
    SELECT c_nationkey, day, round(my - ka * ma - kb * mb + ka * month(day) + kb * dayofyear(day), 2) AS forecast FROM k, d""",
)
def calendar_forecast(t: Tables):
    features = ["month", "day_of_year"]
    rows = t.daily.withColumns({"month": F.month("day"), "day_of_year": F.dayofyear("day")})
    models = stats.grouped_ols(rows, ["c_nationkey"], features, "total")
    return _rounded(stats.calendar_forecast(models, ["c_nationkey"], features, date(2001, 8, 1), 7), forecast=2)


@query("recursive_forecast", "N24 N17 W14")
def recursive_forecast(t: Tables):
    """Seven days ahead with lags fed back; checked against a plain loop in the tests."""
    features = ["lag1", "lag7", "mean7", "day_of_week", "month"]
    rows = stats.series_features(t.daily, ["c_nationkey"], "day", "total")
    models = stats.grouped_ols(rows, ["c_nationkey"], features, "total")
    return stats.recursive_forecast(t.daily, models, ["c_nationkey"], "day", "total", features, date(2001, 8, 1), 7, [date(2001, 8, 3)])


@query(
    "lag7_forecast",
    "N25",
    f"""WITH {DAILY}, x AS (SELECT c_nationkey, total::DOUBLE AS y, lag(total, 7) OVER w AS a FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day)),
    m AS (SELECT c_nationkey, regr_slope(y, a) AS k, regr_intercept(y, a) AS b FROM x WHERE a IS NOT NULL GROUP BY 1 HAVING count(*) >= 30),
    r AS (SELECT c_nationkey, total, row_number() OVER (PARTITION BY c_nationkey ORDER BY day DESC) AS i FROM daily)
    SELECT c_nationkey, DATE '2001-08-01' + (8 - i)::INT AS day, round(greatest(b + k * total, 0), 1) AS forecast FROM r JOIN m USING (c_nationkey) WHERE i <= 7""",
)
def lag7_forecast(t: Tables):
    lagged = windows.lag_features(t.daily, ["c_nationkey"], ["day"], "total", (7,))
    models = stats.grouped_ols(lagged, ["c_nationkey"], ["lag7"], "total")
    return stats.recursive_forecast(t.daily, models, ["c_nationkey"], "day", "total", ["lag7"], date(2001, 8, 1), 7, digits=1)
