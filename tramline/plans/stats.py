"""Tests, splits, standardising, feature tables and per-series regressions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tramline.operators import windows
from tramline.operators.quantiles import exact_quantiles

Names = Sequence[str]

# --- t-test -------------------------------------------------------------------------------


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return total


def two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if not (math.isfinite(t) and math.isfinite(df)) or df <= 0:
        return math.nan
    x, a, b = df / (df + t * t), df / 2, 0.5
    if x in (0.0, 1.0):
        return x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(DoubleType())
def _p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([two_sided_p(a, b) for a, b in zip(t, df, strict=True)])


def t_test(df: DataFrame, group: str, value: str, pairs: Sequence[tuple[str, str]], equal_var: bool) -> DataFrame:
    """Two-sample t-tests from one pass of moments.

    Output: group_a, group_b, mean_a, mean_b, t, df, p_value. The p-value is computed on
    these result rows only.
    """
    wanted = sorted({g for pair in pairs for g in pair})
    moments = df.filter(F.col(group).isin(wanted)).groupBy(group).agg(
        F.struct(F.count(value).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")).alias("s")
    )
    row = moments.agg(*(F.max(F.when(F.col(group) == g, F.col("s"))).alias(f"g{i}") for i, g in enumerate(wanted)))
    at = {g: f"g{i}" for i, g in enumerate(wanted)}
    tests = row.select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), F.col(at[a]).alias("a"), F.col(at[b]).alias("b"))
                    for a, b in pairs
                )
            )
        )
    )
    na, nb = F.col("a.n").cast("double"), F.col("b.n").cast("double")
    va, vb = F.col("a.v"), F.col("b.v")
    if equal_var:
        dof = na + nb - 2
        error = F.sqrt(((na - 1) * va + (nb - 1) * vb) / dof * (1 / na + 1 / nb))
    else:
        sa, sb = va / na, vb / nb
        error = F.sqrt(sa + sb)
        dof = F.pow(sa + sb, F.lit(2)) / (F.pow(sa, F.lit(2)) / (na - 1) + F.pow(sb, F.lit(2)) / (nb - 1))
    scored = tests.select(
        "group_a", "group_b", F.col("a.m").alias("mean_a"), F.col("b.m").alias("mean_b"),
        ((F.col("a.m") - F.col("b.m")) / F.nullif(error, F.lit(0.0))).alias("t"), dof.alias("df"),
    )
    return scored.withColumn("p_value", _p_value("t", "df"))


# --- splits -------------------------------------------------------------------------------


def _draw(id_column: str, seed: int) -> Column:
    """A reproducible pseudo-random text per row, independent of partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")))


def random_split(df: DataFrame, id_column: str, fraction: float = 0.8, seed: int = 42, classes: Names = (), out: str = "is_train") -> DataFrame:
    """Exact-size random split, within each class if ``classes`` is given (stratified).

    Rows are ranked by a hash of their unique id; the hash's first characters cut the ranking
    into 65536 buckets.
    """
    drawn = df.withColumn("__h", _draw(id_column, seed)).withColumn("__b", F.left("__h", F.lit(4)))
    marked = windows.chronological_split(drawn, classes, ["__h"], fraction, ["__b"], out)
    return marked.drop("__h", "__b")


# --- scaling and fences -------------------------------------------------------------------


def standardise(df: DataFrame, columns: Names, is_train: str | None = None) -> DataFrame:
    """Scale to mean 0 and population std 1, with the statistics of the training rows."""
    train = df if is_train is None else df.filter(F.col(is_train))
    stats = train.agg(
        F.struct(*(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    ).scalar()
    joined = df.withColumn("__s", stats)
    scaled = {
        c: (F.col(c) - F.col(f"__s.m_{c}")) / F.coalesce(F.nullif(F.col(f"__s.s_{c}"), F.lit(0.0)), F.lit(1.0))
        for c in columns
    }
    return joined.withColumns(scaled).drop("__s")


def iqr_fences(train: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """One row (low, high): quartiles minus/plus ``k`` interquartile ranges."""
    q = exact_quantiles(train, [], value, {"q1": 0.25, "q3": 0.75})
    width = (F.col("q3") - F.col("q1")) * k
    return q.select("q1", "q3", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))


def outside_fences(df: DataFrame, train: DataFrame, value: str, out: str = "outlier", k: float = 1.5) -> DataFrame:
    """Proxy label: 1 outside the training fences."""
    fences = iqr_fences(train, value, k).select(F.struct("low", "high")).scalar()
    marked = df.withColumn("__f", fences)
    outside = (F.col(value) < F.col("__f.low")) | (F.col(value) > F.col("__f.high"))
    return marked.withColumn(out, outside.cast("int")).drop("__f")


# --- features -----------------------------------------------------------------------------


def series_features(daily: DataFrame, keys: Names, day: str, value: str) -> DataFrame:
    """Calendar parts, lag 1, lag 7 and the trailing 7-row mean (at least 3 rows) per series."""
    lagged = windows.lag_features(daily, keys, [day], value, (1, 7), {7: 3})
    return lagged.withColumns(
        {
            "month": F.month(day),
            "day_of_week": F.weekday(day),
            "day_of_year": F.dayofyear(day),
            "is_weekend": (F.weekday(day) >= 5).cast("int"),
        }
    )


# --- regression per series ----------------------------------------------------------------


def grouped_ols(df: DataFrame, keys: Names, features: Names, target: str, min_rows: int = 30) -> DataFrame:
    """Least squares with intercept for every series at once.

    One combinable aggregation yields means and covariances; the small systems are solved in
    Arrow batches, one row per series. Series with fewer than ``min_rows`` complete rows are
    left out. Output: keys, n, intercept, coef_<feature>. Collinear features get the
    minimum-norm solution.
    """
    names = [*features, target]
    numeric = df.dropna(subset=names).select(*keys, *(F.col(c).cast("double").alias(c) for c in names))
    moments = [F.avg(c).alias(f"__m{i}") for i, c in enumerate(names)]
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(names))]
    moments += [F.covar_pop(names[i], names[j]).alias(f"__c{i}_{j}") for i, j in pairs]
    stats = numeric.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *moments).filter(F.col("n") >= min_rows)
    k = len(features)
    coefficients = [f"coef_{f}" for f in features]
    kinds = ", ".join(f"`{c}` {stats.schema[c].dataType.simpleString()}" for c in keys)
    schema = ", ".join(filter(None, [kinds, "n long", "intercept double", *(f"`{c}` double" for c in coefficients)]))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = len(batch)
            gram, moment = np.zeros((rows, k, k)), np.zeros((rows, k))
            for i, j in pairs:
                column = batch[f"__c{i}_{j}"].to_numpy(float)
                if j == k:
                    moment[:, i] = column
                else:
                    gram[:, i, j] = gram[:, j, i] = column
            beta = np.einsum("rij,rj->ri", np.linalg.pinv(gram, rcond=1e-12, hermitian=True), moment)
            means = batch[[f"__m{i}" for i in range(k)]].to_numpy(float)
            out = batch[[*keys, "n"]].copy()
            out["intercept"] = batch[f"__m{k}"].to_numpy(float) - (beta * means).sum(axis=1)
            out[coefficients] = beta
            yield out

    return stats.mapInPandas(solve, schema)


def apply_ols(df: DataFrame, models: DataFrame, keys: Names, features: Names, out: str = "predicted") -> DataFrame:
    """Predictions by joining the coefficient table."""
    value = F.col("intercept")
    for f in features:
        value = value + F.col(f"coef_{f}") * F.col(f)
    joined = df.join(models.drop("n"), list(keys))
    return joined.withColumn(out, value).drop("intercept", *(f"coef_{f}" for f in features))


def horizon_errors(test: DataFrame, keys: Names, order: str, actual: str, predictions: Names, horizon: int = 7) -> DataFrame:
    """Mean absolute error over the first 1..``horizon`` test rows of every series, per model."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order)
    first = test.withColumn("horizon", F.row_number().over(w)).filter(F.col("horizon") <= horizon)
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    errors = {p: F.avg(F.abs(F.col(actual) - F.col(p))).over(frame) for p in predictions}
    return first.select(*keys, "horizon", *(c.alias(f"mae_{p}") for p, c in errors.items()))


def model_comparison(test: DataFrame, keys: Names, actual: str, predictions: Names) -> DataFrame:
    """MAE and RMSE per model (and series), forecasts turned to rows first."""
    from tramline.operators.aggregates import forecast_errors

    return forecast_errors(_by_model(test, keys, actual, predictions), actual, "predicted", [*keys, "model"])


def error_distribution(test: DataFrame, actual: str, predictions: Names) -> DataFrame:
    """Summary of the signed errors per model."""
    from tramline.operators.quantiles import describe

    long = _by_model(test, [], actual, predictions).withColumn("error", F.col(actual) - F.col("predicted"))
    return describe(long, ["model"], "error")


def _by_model(test: DataFrame, keys: Names, actual: str, predictions: Names) -> DataFrame:
    narrow = test.select(*keys, F.col(actual).cast("double").alias(actual), *(F.col(p).cast("double").alias(p) for p in predictions))
    return narrow.unpivot([*keys, actual], list(predictions), "model", "predicted").filter(F.col("predicted").isNotNull())


def ranked_evaluation(scores: DataFrame, label: str, measure: str = "mae") -> DataFrame:
    """One row: number of series, mean error, best and worst series."""
    return scores.agg(
        F.count(F.lit(1)).alias("series"),
        F.avg(measure).alias(f"mean_{measure}"),
        F.min_by(label, F.struct(measure, label)).alias("best"),
        F.min(measure).alias(f"best_{measure}"),
        F.max_by(label, F.struct(measure, label)).alias("worst"),
        F.max(measure).alias(f"worst_{measure}"),
    )


# --- forecasts from coefficients ----------------------------------------------------------


def future_days(models: DataFrame, as_of, days: int) -> DataFrame:
    """Every model with the ``days`` days after ``as_of`` and their calendar parts."""
    scaffold = models.withColumn("day", F.explode(F.sequence(F.date_add(F.lit(as_of), 1), F.date_add(F.lit(as_of), days), F.expr("interval 1 day"))))
    return scaffold.withColumns(
        {
            "month": F.month("day"),
            "day_of_year": F.dayofyear("day"),
            "day_of_week": F.weekday("day"),
            "is_weekend": (F.weekday("day") >= 5).cast("int"),
        }
    )


def calendar_forecast(models: DataFrame, keys: Names, features: Names, as_of, days: int) -> DataFrame:
    """Forecast from calendar parts only."""
    value = F.col("intercept")
    for f in features:
        value = value + F.col(f"coef_{f}") * F.col(f)
    return future_days(models, as_of, days).select(*keys, "day", value.alias("forecast"))


def recursive_forecast(
    daily: DataFrame, models: DataFrame, keys: Names, day: str, value: str, features: Names, as_of, days: int,
    holidays: Sequence = (), history: int = 30, digits: int = 0, fallback: float = 100.0,
) -> DataFrame:
    """Day-by-day forecast where each day's floor-at-0 prediction feeds the next lags.

    Features may be lag1, lag7, mean7, month, day_of_week, is_weekend, is_holiday. The last
    ``history`` values of a series travel as one array and are folded over with SQL lambdas;
    a series without history starts from ``fallback``. Published values are rounded half-even.
    """
    recent = windows.latest(daily.select(*keys, day, value), keys, [day], history)
    past = recent.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.col(day), F.col(value).cast("double").alias("v")))), lambda s: s["v"]).alias("past")
    )
    start = models.join(past, list(keys), "left").withColumn(
        "past", F.coalesce("past", F.array_repeat(F.lit(float(fallback)), history))
    )
    holiday = F.array(*(F.lit(h) for h in holidays)) if holidays else F.array().cast("array<date>")

    def step(past: Column, ahead: Column) -> Column:
        target = F.date_add(F.lit(as_of), ahead)
        n = F.size(past)
        tail = F.slice(past, F.greatest(n - 6, F.lit(1)), F.lit(7))
        feature = {
            "lag1": F.element_at(past, -1),
            "lag7": F.when(n >= 7, F.try_element_at(past, F.lit(-7))).otherwise(F.element_at(past, 1)),
            "mean7": F.aggregate(tail, F.lit(0.0), lambda a, x: a + x) / F.size(tail),
            "month": F.month(target),
            "day_of_week": F.weekday(target),
            "is_weekend": (F.weekday(target) >= 5).cast("int"),
            "is_holiday": F.array_contains(holiday, target).cast("int"),
        }
        total = F.col("intercept")
        for f in features:
            total = total + F.col(f"coef_{f}") * feature[f]
        return F.concat(past, F.array(F.greatest(total, F.lit(0.0))))

    grown = F.aggregate(F.sequence(F.lit(1), F.lit(days)), F.col("past"), step)
    ahead = F.slice(grown, F.size("past") + 1, F.lit(days))
    return start.select(*keys, F.posexplode(ahead).alias("__i", "__v")).select(
        *keys, F.date_add(F.lit(as_of), F.col("__i") + 1).alias("day"), F.bround("__v", digits).alias("forecast")
    )
