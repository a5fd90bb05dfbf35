"""MLlib models, isolation forest and exponential smoothing for all series at once."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tramline.operators.quantiles import exact_quantiles
from tramline.session import cut_lineage

Names = Sequence[str]


def _vector(df: DataFrame, features: Names) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="__x").transform(df)


# --- forests ------------------------------------------------------------------------------


def forest_regression(
    df: DataFrame, keys: Names, features: Names, target: str, is_train: str, trees: int = 200, depth: int = 10, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(test rows with ``predicted``, feature importances) of one forest pooled over all series.

    A series enters through its mean training target, so one distributed model replaces a
    driver loop over series.
    """
    complete = df.dropna(subset=[*features, target])
    levels = complete.filter(F.col(is_train)).groupBy(*keys).agg(F.avg(target).alias("series_level"))
    columns = [*features, "series_level"]
    rows = _vector(complete.join(levels, list(keys)), columns)
    forest = RandomForestRegressor(featuresCol="__x", labelCol=target, predictionCol="predicted", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(rows.filter(F.col(is_train)))
    scored = model.transform(rows.filter(~F.col(is_train))).drop("__x", "series_level")
    return scored, _importances(df, columns, model.featureImportances.toArray())


def _importances(df: DataFrame, names: Names, values) -> DataFrame:
    rows = sorted(zip(names, map(float, values), strict=True), key=lambda r: (-r[1], r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def forest_classification(
    df: DataFrame, features: Names, label: str, is_train: str, trees: int = 300, min_leaf: int = 2, depth: int = 10, seed: int = 42
) -> tuple[DataFrame, RandomForestClassificationModel]:
    """(test rows with ``predicted``, model); labels are small non-negative integers."""
    rows = _vector(df.dropna(subset=[*features, label]), features)
    forest = RandomForestClassifier(
        featuresCol="__x", labelCol=label, predictionCol="predicted", probabilityCol="__p", rawPredictionCol="__r",
        numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=depth, seed=seed,
    )
    model = forest.fit(rows.filter(F.col(is_train)))
    scored = model.transform(rows.filter(~F.col(is_train))).drop("__x", "__p", "__r")
    return scored.withColumn("predicted", F.col("predicted").cast("int")), model


def circular_errors(scored: DataFrame, truth: str, predicted: str = "predicted", cycle: int = 12) -> DataFrame:
    """Accuracy and circular distance (mean, median, within 1 and 2) of class predictions."""
    from tramline.functions.values import circular_distance

    gaps = scored.select(circular_distance(F.col(truth), F.col(predicted), cycle).alias("gap"))
    median = exact_quantiles(gaps, [], "gap", {"m": 0.5}).select("m").scalar()
    return gaps.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("gap") == 0).cast("int")).alias("accuracy"),
        F.avg("gap").alias("mean_gap"),
        F.avg((F.col("gap") <= 1).cast("int")).alias("within_1"),
        F.avg((F.col("gap") <= 2).cast("int")).alias("within_2"),
    ).withColumn("median_gap", median)


# --- isolation forest ---------------------------------------------------------------------

SAMPLE = 256
_NODES = "tree int, node int, feature int, threshold double, left int, right int, size int"


def _average_path(n):
    """Mean search depth of a random binary tree with n leaves."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    long = 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def tree_samples(df: DataFrame, id_column: str, features: Names, trees: int, sample: int, seed: int) -> DataFrame:
    """``sample`` rows per tree, chosen by hash. A row may serve several trees.

    Every row draws for every tree, at a rate that leaves about 1.5 times the sample (all rows, if
    there are fewer); of these the ``sample`` rows with the smallest draw are kept.
    """
    from pyspark.sql import Window

    total = df.agg(F.count(F.lit(1))).scalar()

    def draw(tree: Column) -> Column:
        return F.xxhash64(F.lit(seed), tree, F.col(id_column)) / 2.0**64 + 0.5

    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda tree: draw(tree) < F.col("__rate"))
    offered = df.select(id_column, *features, (F.lit(1.5 * sample) / total).alias("__rate")).withColumn("tree", F.explode(drawn))
    w = Window.partitionBy("tree").orderBy(draw(F.col("tree")), id_column)
    return offered.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= sample).drop("__r", "__rate")


def grow_forest(df: DataFrame, id_column: str, features: Names, trees: int = 100, sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """Random split trees as node rows; at most trees * (2 * sample - 1) rows."""
    features = list(features)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        x = rows.sort_values(id_column)[features].to_numpy(float)
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes, todo = [], [(0, np.arange(len(x)), 0)]
        next_id = 1
        while todo:
            node, members, depth = todo.pop()
            part = x[members]
            low, high = part.min(axis=0), part.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or not len(open_features):
                nodes.append((tree, node, -1, 0.0, -1, -1, len(members)))
                continue
            f = int(rng.choice(open_features))
            cut = float(rng.uniform(low[f], high[f]))
            below = part[:, f] <= cut
            nodes.append((tree, node, f, cut, next_id, next_id + 1, len(members)))
            todo += [(next_id, members[below], depth + 1), (next_id + 1, members[~below], depth + 1)]
            next_id += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size"])

    samples = tree_samples(df, id_column, features, trees, sample, seed)
    return samples.groupBy("tree").applyInPandas(grow, _NODES)


def anomaly_scores(df: DataFrame, forest: DataFrame, features: Names, sample: int = SAMPLE, out: str = "score") -> DataFrame:
    """Score of every row; the more negative, the more anomalous.

    The forest's size is bounded by its construction (see ``grow_forest``), so it travels to
    the tasks as a broadcast variable.
    """
    features = list(features)
    spark = df.sparkSession
    nodes = forest.toPandas().sort_values(["tree", "node"])
    trees = [g.to_numpy(float)[:, 2:] for _, g in nodes.groupby("tree")]
    shared = spark.sparkContext.broadcast(trees)
    norm = float(_average_path(max((t[0, 4] for t in trees), default=sample)))
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(float)
            depth = np.zeros(len(x))
            for tree in shared.value:
                at, steps = np.zeros(len(x), dtype=int), np.zeros(len(x))
                moving = np.flatnonzero(tree[at, 0] >= 0)
                while len(moving):
                    node = tree[at[moving]]
                    below = x[moving, node[:, 0].astype(int)] <= node[:, 1]
                    at[moving] = np.where(below, node[:, 2], node[:, 3]).astype(int)
                    steps[moving] += 1
                    moving = moving[tree[at[moving], 0] >= 0]
                depth += steps + _average_path(tree[at, 4])
            yield batch.assign(**{out: -(2.0 ** (-depth / len(shared.value) / norm))})

    return df.mapInPandas(score, schema)


def isolation_forest(
    df: DataFrame, id_column: str, features: Names, is_train: str, contamination: float | str, trees: int = 100, seed: int = 42
) -> DataFrame:
    """Rows with ``score`` and ``anomaly`` (1 where the score is below the training quantile).

    ``contamination`` is that quantile, or the column of a 0/1 label whose rate among the training rows gives it.
    The rows and their scores are read several times, so the lineage of both is cut.
    """
    df = cut_lineage(df)
    if isinstance(contamination, str):
        contamination = float(df.filter(F.col(is_train)).agg(F.coalesce(F.avg(F.col(contamination).cast("int")), F.lit(0.0))).first()[0])
    forest = grow_forest(df.filter(F.col(is_train)), id_column, features, trees, seed=seed)
    scored = cut_lineage(anomaly_scores(df, forest, features))
    cut = exact_quantiles(scored.filter(F.col(is_train)), [], "score", {"c": contamination}).select("c").scalar()
    return scored.withColumn("anomaly", (F.col("score") < cut).cast("int"))


# --- clusters and components --------------------------------------------------------------

_PASS_ROWS = 50_000


def kmeans_sweep(df: DataFrame, features: Names, ks: Sequence[int] = range(1, 10), seed: int = 42) -> DataFrame:
    """Inertia for every k and, from 2 on, the silhouette. One fit per k over a cached table.

    A fit is dozens of passes, so what a task costs beside its rows counts: the lineage of the table is cut, as
    every task would carry its plan, and partitions of less than ``_PASS_ROWS`` rows are put together, down to two per
    core. KMeans gets a projection: of a table that is not itself cached it keeps the vectors while it fits, of a
    cached one it decodes the columns in every pass.
    """
    computed = _vector(df, features).select("__x", *features).cache()
    spread = computed.agg(sum((F.var_pop(f) for f in features), F.lit(0.0)).alias("v"), F.count(F.lit(1)).alias("n")).first()
    tasks = max(math.ceil(spread["n"] / _PASS_ROWS), 2 * df.sparkSession.sparkContext.defaultParallelism)
    # coalesce() may change the order of partitions even where it joins none, and the starting centres are drawn by partition.
    packed = computed.coalesce(tasks) if computed.rdd.getNumPartitions() > tasks else computed
    rows = cut_lineage(packed).cache()
    computed.unpersist()
    found = []
    try:
        for k in ks:
            if k == 1:
                found.append((1, float(spread["v"] * spread["n"]), None))
                continue
            model = KMeans(featuresCol="__x", predictionCol="cluster", k=k, seed=seed).fit(rows.select("__x"))
            labelled = model.transform(rows)
            distinct = model.summary.k > 1 and labelled.select("cluster").distinct().limit(2).count() > 1
            silhouette = ClusteringEvaluator(featuresCol="__x", predictionCol="cluster").evaluate(labelled) if distinct else None
            found.append((k, float(model.summary.trainingCost), silhouette))
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(found, "k int, inertia double, silhouette double")


def kmeans_clusters(df: DataFrame, features: Names, k: int = 3, seed: int = 42, is_train: str | None = None) -> DataFrame:
    """Rows with their ``cluster``; fitted on the training rows if given."""
    rows = _vector(df, features)
    train = rows if is_train is None else rows.filter(F.col(is_train))
    model = KMeans(featuresCol="__x", predictionCol="cluster", k=k, seed=seed).fit(train)
    return model.transform(rows).drop("__x")


def cluster_profile(clustered: DataFrame, features: Names, by: Names = ("cluster",)) -> DataFrame:
    return clustered.groupBy(*by).agg(F.count(F.lit(1)).alias("members"), *(F.avg(f).alias(f) for f in features))


def principal_components(df: DataFrame, features: Names, k: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows with pc1..pck, loadings with the explained share). Features must be standardised."""
    rows = _vector(df, features)
    model = PCA(k=k, inputCol="__x", outputCol="__pc").fit(rows)
    from pyspark.ml.functions import vector_to_array

    projected = model.transform(rows).withColumn("__a", vector_to_array("__pc"))
    out = projected.select(*df.columns, *(F.get("__a", F.lit(i)).alias(f"pc{i + 1}") for i in range(k)))
    loadings = model.pc.toArray()
    shares = model.explainedVariance.toArray()
    table = [(f"pc{i + 1}", f, float(loadings[j, i]), float(shares[i])) for i in range(k) for j, f in enumerate(features)]
    return out, df.sparkSession.createDataFrame(table, "component string, feature string, loading double, explained double")


# --- exponential smoothing ----------------------------------------------------------------


def _smooth(y: np.ndarray, params: np.ndarray, trend: bool, m: int, horizon: int = 0):
    """Run additive smoothing for many parameter rows (alpha, beta, gamma) side by side.

    Returns the squared error per row and, with ``horizon``, the forecasts. Missing values are
    stepped over with the prediction.
    """
    alpha, beta, gamma = (params[:, [i]] for i in range(3))
    first = np.nanmean(y[:m]) if m else y[0]
    level = np.full((len(params), 1), first)
    slope = np.zeros_like(level)
    if trend:
        slope[:] = np.nan_to_num((np.nanmean(y[m : 2 * m]) - first) / m if m else y[1] - y[0])
    seasons = np.tile(np.nan_to_num(y[:m] - first), (len(params), 1)) if m else np.zeros((len(params), 1))
    error = np.zeros(len(params))
    period = max(m, 1)
    for i in range(0 if m or not trend else 1, len(y)):
        s = seasons[:, [i % period]]
        ahead = level + slope + s
        actual = np.where(np.isnan(y[i]), ahead, y[i])
        error += ((actual - ahead) ** 2)[:, 0]
        before = level
        level = alpha * (actual - s) + (1 - alpha) * (level + slope)
        if trend:
            slope = beta * (level - before) + (1 - beta) * slope
        if m:
            seasons[:, [i % period]] = gamma * (actual - before - slope) + (1 - gamma) * s
    steps = np.arange(1, horizon + 1)
    forecast = level + slope * steps + seasons[:, (len(y) + steps - 1) % period] if m else level + slope * steps
    return error, forecast


def fit_forecast(y: np.ndarray, horizon: int, trend: bool = False, m: int = 0) -> np.ndarray:
    """Forecast with the smoothing parameters of least squared error (grid, refined twice)."""
    y = np.asarray(y, dtype=float)
    if len(y) < max(2 * m, 2):
        return np.full(horizon, np.nan)
    axes = [np.array([0.05, 0.2, 0.4, 0.6, 0.8, 0.95])] + [np.array([0.01, 0.1, 0.3, 0.6]) if on else np.zeros(1) for on in (trend, bool(m))]
    width, best = 0.1, None
    for _ in range(3):
        grid = np.stack([g.ravel() for g in np.meshgrid(*axes, indexing="ij")], axis=1)
        error, _ = _smooth(y, grid, trend, m)
        best = grid[int(np.argmin(error))]
        axes = [np.clip(b + width * np.array([-1, -0.5, 0, 0.5, 1]), 1e-4, 0.9999) if b > 0 else np.zeros(1) for b in best]
        width /= 3
    return _smooth(y, best[None, :], trend, m, horizon)[1][0]


def smoothing_forecasts(
    series: DataFrame, keys: Names, day: str, value: str, is_train: str, season: int = 7
) -> DataFrame:
    """Simple, double and triple smoothing of every series over its test rows, floored at 0.

    Each series has one row per day, so a group is as long as the calendar at most.
    Output: keys, day, value, ses, des, tes and ``tes_kind``: 'seasonal', 'trend' where the training
    rows are fewer than two seasons (then ``tes`` is double smoothing), 'level' where there is a single
    one (all three repeat it) and 'none' where there is none (no forecast).
    """
    rows = series.select(*keys, day, F.col(value).cast("double").alias(value), is_train)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*keys, day])
    schema = f"{kinds}, `{value}` double, ses double, des double, tes double, tes_kind string"

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(day)
        mask = group[is_train].to_numpy(bool)
        train, test = group.loc[mask, value].to_numpy(float), group.loc[~mask].copy()
        train = train[np.flatnonzero(~np.isnan(train)).min(initial=len(train)) :]
        if len(train) < 2:
            found = [np.full(len(test), train[0] if len(train) else np.nan)] * 3
            kind = "level" if len(train) else "none"
        else:
            kind = "seasonal" if len(train) >= 2 * season else "trend"
            found = [fit_forecast(train, len(test), trend, m) for trend, m in ((False, 0), (True, 0), (True, season if kind == "seasonal" else 0))]
        forecasts = dict(zip(("ses", "des", "tes"), (np.maximum(f, 0) for f in found), strict=True))
        return test.assign(**forecasts, tes_kind=kind)[[*keys, day, value, "ses", "des", "tes", "tes_kind"]]

    return rows.groupBy(*keys).applyInPandas(run, schema)


def smoothed_ahead(
    series: DataFrame, keys: Names, day: str, value: str, horizon: int, alpha: float, beta: float = 0.0, gamma: float = 0.0, season: int = 0
) -> DataFrame:
    """Forecasts 1..``horizon`` steps after each series with given parameters (a trend where ``beta`` is positive).

    Series shorter than two seasons (or two rows) give no rows. Output: keys, step, forecast.
    """
    rows = series.select(*keys, day, F.col(value).cast("double").alias(value))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        y = group.sort_values(day)[value].to_numpy(float)
        y = y[np.flatnonzero(~np.isnan(y)).min(initial=len(y)) :]
        ahead = _smooth(y, np.array([[alpha, beta, gamma]]), beta > 0, season, horizon)[1][0] if len(y) >= max(2 * season, 2) else []
        return pd.DataFrame({**{k: group[k].iloc[0] for k in keys}, "step": np.arange(1, len(ahead) + 1), "forecast": np.asarray(ahead, float)})

    return rows.groupBy(*keys).applyInPandas(run, f"{kinds}, step int, forecast double")


def impute_gaps(full: DataFrame, keys: Names, day: str, value: str, season: int = 7) -> DataFrame:
    """Fill each gap with a seasonal forecast fitted on everything before it.

    ``full`` has one row per key and calendar day (see reshape.fill_days). Gaps before two
    whole seasons stay open. Output adds ``filled`` and ``imputed``; leave imputed rows out of
    any evaluation.
    """
    rows = full.select(*keys, day, F.col(value).cast("double").alias(value))
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*keys, day])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(day).reset_index(drop=True)
        y = group[value].to_numpy(float).copy()
        missing = np.isnan(y)
        i = 0
        while i < len(y):
            if not missing[i]:
                i += 1
                continue
            end = i
            while end < len(y) and missing[end]:
                end += 1
            if i >= 2 * season and not np.isnan(y[:i]).any():
                y[i:end] = fit_forecast(y[:i], end - i, True, season)
            i = end
        return group.assign(filled=y, imputed=missing & ~np.isnan(y))

    return rows.groupBy(*keys).applyInPandas(run, f"{kinds}, `{value}` double, filled double, imputed boolean")
