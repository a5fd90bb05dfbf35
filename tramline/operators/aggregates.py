"""Grouped measures that Spark has no single call for."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def total_or_zero(value: str | Column) -> Column:
    """Sum that is 0 instead of NULL when no row qualifies."""
    return F.coalesce(F.sum(value), F.lit(0))


def mean_of_totals(
    df: DataFrame, unit: Sequence[str], by: Sequence[str], value: str, out: str = "mean"
) -> DataFrame:
    """Sum per ``unit`` first, then average those sums per ``by`` (a subset of the unit)."""
    totals = df.groupBy(*unit).agg(F.sum(value).alias("__total"))
    return totals.groupBy(*by).agg(F.avg("__total").alias(out))


def count_pivot(df: DataFrame, row: Sequence[str], column: str, levels: Sequence) -> DataFrame:
    """Counts per row key, one column per level, 0 where a pair does not occur."""
    counts = [F.count_if(F.col(column) == F.lit(k)).alias(str(k)) for k in levels]
    return df.groupBy(*row).agg(*counts)


def value_pivot(df: DataFrame, row: Sequence[str], column: str, value: str, levels: Sequence) -> DataFrame:
    """Long to wide on a measure; NULL where a pair does not occur."""
    picks = [F.max(F.when(F.col(column) == F.lit(k), F.col(value))).alias(str(k)) for k in levels]
    return df.groupBy(*row).agg(*picks)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs in long form (a, b, r), both directions and the diagonal."""
    pairs = list(combinations(columns, 2))
    one_row = df.agg(*(F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)))
    cells = [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")))
    return one_row.select(F.inline(F.array(*cells)))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and largest value; the last bin is closed."""
    edges = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    placed = df.filter(F.col(value).isNotNull()).withColumn("__e", edges)
    width = (F.col("__e.hi") - F.col("__e.lo")) / bins
    # All values equal: the width is 0 and everything falls into the first bin.
    steps = F.coalesce(F.floor((F.col(value) - F.col("__e.lo")) / F.nullifzero(width)), F.lit(0))
    return (
        placed.groupBy(F.least(steps, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.first("__e").alias("__e"))
        .select(
            "bin",
            (F.col("__e.lo") + F.col("bin") * (F.col("__e.hi") - F.col("__e.lo")) / bins).alias("lower"),
            "n",
        )
    )


def share_of_categories(df: DataFrame, by: Sequence[str], category: str) -> DataFrame:
    """Count and share of every category within its group."""
    counts = df.groupBy(*by, category).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Confusion matrix in long form with the share within each true class."""
    counts = df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("row_share", F.col("n") / F.sum("n").over(Window.partitionBy(truth)))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from one pass over both label columns."""
    sides = F.array(
        F.struct(F.col(truth).alias("label"), F.lit(1).alias("t"), F.lit(0).alias("p")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).alias("t"), F.lit(1).alias("p")),
    )
    hit = (F.col(truth) == F.col(predicted)).cast("int")
    counts = (
        df.select(hit.alias("hit"), F.explode(sides).alias("s"))
        .groupBy("s.label")
        .agg(
            F.sum(F.col("hit") * F.col("s.t")).alias("tp"),
            F.sum("s.t").alias("support"),
            F.sum("s.p").alias("predicted"),
        )
    )
    precision = _ratio("tp", "predicted")
    recall = _ratio("tp", "support")
    return counts.select(
        "label", precision.alias("precision"), recall.alias("recall"), _f1(precision, recall).alias("f1"), "support"
    )


def binary_scores(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, precision, recall and F1 of 0/1 columns; empty denominators give 0."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    counts = df.groupBy(*by).agg(
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
    )
    counts = counts.withColumns({"__p": F.col("tp") + F.col("fp"), "__t": F.col("tp") + F.col("fn")})
    precision, recall = _ratio("tp", "__p"), _ratio("tp", "__t")
    return counts.withColumns(
        {"precision": precision, "recall": recall, "f1": _f1(precision, recall)}
    ).drop("__p", "__t")


def _ratio(numerator: str, denominator: str) -> Column:
    return F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator)).otherwise(F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    total = precision + recall
    return F.when(total > 0, 2 * precision * recall / total).otherwise(F.lit(0.0))


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAE as percentage of the mean actual value."""
    gap = F.col(actual) - F.col(predicted)
    mae = F.avg(F.abs(gap))
    mean = F.avg(actual)
    return df.groupBy(*by).agg(
        F.count(gap).alias("n"),
        mae.alias("mae"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.when(mean > 0, mae / F.nullifzero(mean) * 100).alias("mape"),
    )


def missing_census(df: DataFrame) -> DataFrame:
    """NULL count of every column, one pass, long form."""
    names = df.columns
    one_row = df.agg(
        F.count(F.lit(1)).alias("__rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in names)
    )
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing"), F.col("__rows").alias("rows")) for c in names]
    return one_row.select(F.inline(F.array(*cells)))


def row_census(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def top_n(df: DataFrame, measure: str, n: int, tiebreak: Sequence[str]) -> DataFrame:
    """Largest ``n`` rows; ties go to the smallest tie-break columns. Runs as a per-task top-n."""
    return df.orderBy(F.col(measure).desc(), *tiebreak).limit(n)
