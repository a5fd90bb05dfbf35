"""Exact quantiles and summaries without gathering a group in one task.

``percentile`` keeps a map of all distinct values of a group in one buffer. Here equal
values are counted first, the wanted ranks are located in ranges of values whose split points
are drawn from the data, and only those ranges are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.operators.windows import ranged


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: dict[str, float]
) -> DataFrame:
    """Linear-interpolated quantiles, one column per ``{name: probability}``."""
    by = list(by)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    counted = ranged(counted, by, "__v", "__b")
    in_order = Window.partitionBy(*by).orderBy("__b")
    buckets = (
        counted.groupBy(*by, "__b")
        .agg(F.sum("__n").alias("__m"))
        .withColumns(
            {
                "__before": F.coalesce(
                    F.sum("__m").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
                ),
                "__size": F.sum("__m").over(Window.partitionBy(*by)),
            }
        )
    )
    places = [F.col("__size").cast("double") - 1] * len(probabilities)
    spots = [place * p for place, p in zip(places, probabilities.values(), strict=True)]
    wanted = F.array_distinct(
        F.array(*(f(s).cast("long") for s in spots for f in (F.floor, F.ceil)))
    )
    targets = buckets.withColumn(
        "__wanted",
        F.filter(wanted, lambda i: (i >= F.col("__before")) & (i < F.col("__before") + F.col("__m"))),
    ).filter(F.size("__wanted") > 0)

    narrowed = _join_null_safe(counted, targets.drop("__m"), [*by, "__b"], "inner")
    w = Window.partitionBy(*by, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    through = narrowed.withColumn("__through", F.sum("__n").over(w) + F.col("__before"))
    hits = through.select(
        *by, "__v", "__size",
        F.explode(
            F.filter(
                "__wanted",
                lambda i: (i >= F.col("__through") - F.col("__n")) & (i < F.col("__through")),
            )
        ).alias("__i"),
    )

    def at(rounding, p: float):
        index = rounding((F.col("__size").cast("double") - 1) * p).cast("long")
        return F.max(F.when(F.col("__i") == index, F.col("__v")))

    def weight(p: float):
        spot = (F.max("__size").cast("double") - 1) * p
        return spot - F.floor(spot)

    return hits.groupBy(*by).agg(
        *(
            (at(F.floor, p) + (at(F.ceil, p) - at(F.floor, p)) * weight(p)).alias(name)
            for name, p in probabilities.items()
        )
    )


def describe(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per group."""
    by = list(by)
    moments = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(df, by, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    order = [*by, "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    if not by:
        # Two one-row results side by side.
        row = quartiles.select(F.struct("*").alias("q")).scalar()
        return moments.withColumn("q", row).select(
            "*", *(F.col(f"q.{c}").alias(c) for c in ("q25", "q50", "q75"))
        ).select(*order)
    return _join_null_safe(moments, quartiles, by, "left").select(*order)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equality join on equally named keys where NULL meets NULL."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(other, on, how).drop(*(f"__r_{k}" for k in keys))
