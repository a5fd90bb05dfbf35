"""Incremental loading: upserts, surrogate keys, period pruning, late dimension members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions.keys import date_key
from tramline.operators.joins import last_by, new_rows
from tramline.operators.reshape import new_members
from tramline.session import cut_lineage

Names = Sequence[str]


def upsert(existing: DataFrame, updates: DataFrame, keys: Names) -> DataFrame:
    """Old versions of updated keys leave, all update rows enter (NULL keys match)."""
    return new_rows(existing, updates, keys).unionByName(updates)


def newest_version(versions: DataFrame, keys: Names, version: str, tie: Names = ()) -> DataFrame:
    """Latest version of every key; the aggregate form of ``upsert`` for append-only landings."""
    return last_by(versions, keys, [version, *tie])


def assign_keys(fresh: DataFrame, existing: DataFrame, key: str, natural: Names) -> DataFrame:
    """Surrogate keys for new rows: above the current maximum, in natural-key order.

    Rows are range-partitioned by the natural key, each range is numbered on its own, and the
    ranges' row counts give the offsets. The range number is stored with a checkpoint before it
    is used, so that a recomputed task cannot see other range bounds. ``natural`` must be unique
    in ``fresh``.
    """
    ranges = fresh.repartitionByRange(*natural).withColumn("__range", F.spark_partition_id())
    ranges = cut_lineage(ranges)
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).scalar()
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    within = Window.partitionBy("__range").orderBy(*natural)
    numbered = ranges.join(offsets, "__range").withColumn(
        key, (top + F.col("__before") + F.row_number().over(within)).cast("int")
    )
    return numbered.select(key, *fresh.columns)


def prune_loaded_periods(requested: DataFrame, loaded: DataFrame, point: str, as_of_year: int, as_of_month: int) -> DataFrame:
    """Requested (point, year, month) partitions still worth loading.

    Past years already present and past months of the current year already present are
    skipped; the current month is always loaded again.
    """
    years = loaded.select(F.col(point).alias("__p"), F.col("year").alias("__y")).distinct()
    months = loaded.select(F.col(point).alias("__p"), F.col("year").alias("__y"), F.col("month").alias("__m")).distinct()
    this_year = F.col("year") == as_of_year
    this_month = this_year & (F.col("month") == as_of_month)
    past = requested.filter(F.col("year") < as_of_year).join(
        years, (F.col(point) == F.col("__p")) & (F.col("year") == F.col("__y")), "left_anti"
    )
    current = requested.filter(this_year & (F.col("month") < as_of_month)).join(
        months,
        (F.col(point) == F.col("__p")) & (F.col("year") == F.col("__y")) & (F.col("month") == F.col("__m")),
        "left_anti",
    )
    return past.unionByName(current).unionByName(requested.filter(this_month))


def loaded_periods(fact: DataFrame, point: str, day_key: str = "date_key") -> DataFrame:
    """(point, year, month) present in a fact table."""
    return fact.select(
        point,
        F.floor(F.col(day_key) / 10000).cast("int").alias("year"),
        (F.floor(F.col(day_key) / 100) % 100).cast("int").alias("month"),
    ).distinct()


def drop_range(df: DataFrame, day_key: str, low: int, high: int) -> DataFrame:
    """Predicate delete: everything outside the key range (NULL keys stay)."""
    return df.filter(~F.coalesce(F.col(day_key).between(low, high), F.lit(False)))


def late_members(
    facts: DataFrame, column: str, dim: DataFrame, dim_column: str, rates: DataFrame | None = None,
    rate: str = "co2_per_km", default: float = 0.0,
) -> DataFrame:
    """Dimension rows for fact values the dimension lacks, with a known or default rate."""
    fresh = new_members(facts, column, dim, dim_column).withColumnRenamed(column, dim_column)
    if rates is None:
        return fresh.withColumn(rate, F.lit(default))
    known = rates.select(F.col(dim_column).alias("__v"), F.col(rate))
    joined = fresh.join(known, F.col(dim_column) == F.col("__v"), "left")
    return joined.select(dim_column, F.coalesce(F.col(rate), F.lit(default)).alias(rate))


def with_validity(df: DataFrame, as_of, end_key: int = 20261231) -> DataFrame:
    """Validity interval of a type-1 dimension: from the load day to a fixed end."""
    return df.withColumns({"start_date": date_key(F.lit(as_of)), "end_date": F.lit(end_key)})
