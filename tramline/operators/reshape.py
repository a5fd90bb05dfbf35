"""Cleaning, unions, unpivots and calendar gap filling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.functions.values import clip_floor, lenient_number

Names = Sequence[str]


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def clip_columns(df: DataFrame, columns: Names, floor: float = 0) -> DataFrame:
    """Make the columns numeric (bad text becomes NULL) and raise values below ``floor``."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: clip_floor(lenient_number(F.col(c)), floor) for c in present})


def clip_report(df: DataFrame, columns: Names, floor: float = 0) -> DataFrame:
    """How many values per column ``clip_columns`` would change, in one pass."""
    present = [c for c in columns if c in df.columns]
    one = df.agg(*(F.count_if(lenient_number(F.col(c)) < floor).alias(c) for c in present))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("corrected")) for c in present]
    return one.select(F.inline(F.array(*cells)))


def ensure_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed NULLs."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def rescale_numeric(df: DataFrame, start: int, divisor: float) -> DataFrame:
    """Divide every numeric column from position ``start`` on; other columns pass through."""
    numeric = {f.name for f in df.schema.fields[start:] if isinstance(f.dataType, T.NumericType)}
    return df.select(*((F.col(c) / divisor).alias(c) if c in numeric else F.col(c) for c in df.columns))


def decode_labels(df: DataFrame, labels: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Replace survey codes by labels; unknown codes become NULL.

    ``labels`` is long (label_set, code double, label); ``columns`` maps a column to its set.
    Columns without a known set are left alone.
    """
    for column, label_set in columns.items():
        if column in df.columns:
            right = labels.filter(F.col("label_set") == label_set).select(
                F.col("code").alias("__code"), F.col("label").alias("__label")
            )
            joined = df.join(right, df[column].try_cast("double") == F.col("__code"), "left")
            df = joined.select(*(F.col("__label").alias(c) if c == column else df[c] for c in df.columns))
    return df


def where_given(df: DataFrame, **equalities: Any) -> DataFrame:
    """One equality per argument that is not None."""
    given = [F.col(c) == v for c, v in equalities.items() if v is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column missing in one frame is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def new_members(values: DataFrame, column: str, existing: DataFrame, existing_column: str) -> DataFrame:
    """Distinct non-NULL values not yet in a dimension."""
    known = existing.select(F.trim(F.col(existing_column)).alias("__known")).distinct()
    fresh = values.select(F.col(column)).filter(F.col(column).isNotNull()).distinct()
    return fresh.join(known, F.col(column) == F.col("__known"), "left_anti")


def unpivot_days(df: DataFrame, ids: Names, prefix: str = "dag ", last: int = 31, value: str = "distance") -> DataFrame:
    """Columns 'dag 1'..'dag 31' to rows (day_of_month, value)."""
    days = [f"{prefix}{i}" for i in range(1, last + 1)]
    long = df.unpivot(list(ids), [F.col(f"`{d}`") for d in days], "__day", value)
    return long.select(*ids, F.regexp_extract("__day", r"(\d+)", 1).cast("int").alias("day_of_month"), value)


def fill_days(series: DataFrame, keys: Names, day: str) -> DataFrame:
    """Every day between a key's first and last day; days without data have NULL measures."""
    bounds = series.groupBy(*keys).agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))
    scaffold = bounds.select(
        *keys, F.explode(F.sequence("__lo", "__hi", F.expr("interval 1 day"))).alias(day)
    )
    return scaffold.join(series, [*keys, day], "left").select(*series.columns)


def missing_days(series: DataFrame, keys: Names, day: str) -> DataFrame:
    """Days inside a key's range that have no row."""
    return fill_days(series.select(*keys, day).withColumn("__has", F.lit(True)), keys, day).filter(
        F.col("__has").isNull()
    ).drop("__has")


def interpolate(series: DataFrame, keys: Names, order: str, value: str, out: str, limit: int = 3) -> DataFrame:
    """Linear interpolation by row distance of at most ``limit`` cells after each known value.

    Longer gaps keep NULL from cell ``limit + 1`` on; after the last known value that value is
    carried, also for ``limit`` cells; NULLs before the first known value stay. Meant for one
    row per key and day.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    back = w.rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    placed = series.withColumn("__i", F.row_number().over(w))
    known = F.when(F.col(value).isNotNull(), F.struct(F.col("__i").alias("i"), F.col(value).alias("v")))
    placed = placed.withColumns(
        {"__a": F.last(known, ignorenulls=True).over(back), "__b": F.last(known, ignorenulls=True).over(ahead)}
    )
    step = F.col("__i") - F.col("__a.i")
    line = F.col("__a.v") + (F.col("__b.v") - F.col("__a.v")) * step / F.nullifzero(F.col("__b.i") - F.col("__a.i"))
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(
        F.col("__a").isNotNull() & (step <= limit), F.coalesce(line, F.col("__a.v"))
    )
    return placed.withColumn(out, filled).drop("__i", "__a", "__b")


def back_fill(series: DataFrame, keys: Names, order: str, value: str, out: str) -> DataFrame:
    """NULLs take the next known value."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    return series.withColumn(out, F.last(value, ignorenulls=True).over(w))
