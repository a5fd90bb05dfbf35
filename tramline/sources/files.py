"""Scans of landed files and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str | list[str], schema: str | StructType, sep: str = ",") -> DataFrame:
    """CSV with a header and a declared schema (no inference pass)."""
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: str | StructType, lines: bool = False) -> DataFrame:
    """JSON payloads: one array or object per file or, with ``lines``, per line (large files are then split)."""
    return spark.read.option("multiLine", not lines).schema(schema).json(path)


def read_optional(spark: SparkSession, path: str, schema: str | StructType, sep: str = ";") -> DataFrame:
    """CSV that may be absent or empty: then an empty frame with the same schema."""
    try:
        return read_csv(spark, path, schema, sep)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Value-label dictionary {"value_labels": {set: {code: label}}} as (label_set, code, label)."""
    whole = read_json(spark, path, "value_labels map<string, map<string, string>>")
    sets = whole.select(F.explode("value_labels").alias("label_set", "codes"))
    return sets.select("label_set", F.explode("codes").alias("code", "label")).withColumn(
        "code", F.col("code").try_cast("double")
    )


LIVEBOARD = (
    "station_key int, polled_at timestamp_ntz, arrivals struct<arrival: array<struct<"
    "vehicle: string, time: string, delay: string, canceled: string>>>"
)


def flatten_liveboard(payloads: DataFrame, zone: str = "Europe/Brussels") -> DataFrame:
    """Nested arrival boards to staging rows; boards without arrivals yield nothing."""
    from tramline.functions.keys import date_key, local_from_unix, time_key

    rows = payloads.select("station_key", "polled_at", F.explode("arrivals.arrival").alias("a"))
    planned = local_from_unix(F.col("a.time").cast("long"), zone)
    return rows.select(
        F.col("a.vehicle").alias("train_id"),
        "station_key",
        date_key(planned).alias("date_key"),
        time_key(planned).alias("time_key"),
        F.col("a.delay").cast("int").alias("delay"),
        (F.col("a.canceled") == "1").alias("canceled"),
        F.col("polled_at").alias("last_updated"),
    )


def write_table(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (), skip_empty: bool = True
) -> bool:
    """Append to or replace a Parquet table; an empty append is skipped. True if written.

    With ``partition_by`` an overwrite replaces only the partitions present in ``df``. Rows
    are clustered on those columns first so that each partition gets few files; AQE splits
    the large ones.
    """
    if skip_empty and mode == "append" and df.isEmpty():
        return False
    writer = df
    if partition_by:
        writer = df.hint("rebalance", *partition_by)
    out = writer.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        out = out.partitionBy(*partition_by)
    out.parquet(path)
    return True


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
