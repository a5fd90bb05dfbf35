"""Request log lines to rows and per-endpoint measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the fields in a log line, in order.
LINE = (
    r'^(\S+ \S+).*?remote=(\S+) method=(\S+) path="([^"]*)" status=(\d+) '
    r'duration_ms=([\d.]+) endpoint=(\S+) query="([^"]*)"'
)
COLUMNS = ["logged_at", "remote", "method", "path", "status", "duration_ms", "endpoint", "query"]


def read_access_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_access_log(spark.read.text(path), "value")


def parse_access_log(lines: DataFrame, line: str) -> DataFrame:
    """One row per well-formed line."""
    fields = {c: F.regexp_extract(F.col(line), LINE, i + 1) for i, c in enumerate(COLUMNS)}
    rows = lines.filter(F.rlike(F.col(line), F.lit(LINE))).select(*(v.alias(k) for k, v in fields.items()))
    return rows.withColumns(
        {
            "logged_at": F.replace(F.col("logged_at"), F.lit(","), F.lit(".")).try_cast("timestamp_ntz"),
            "status": F.col("status").cast("int"),
            "duration_ms": F.col("duration_ms").cast("double"),
        }
    )


def endpoint_metrics(log: DataFrame) -> DataFrame:
    """Requests, errors (status 400 and up), mean/max/min duration and last status per endpoint."""
    return log.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        F.avg("duration_ms").alias("avg_ms"),
        F.max("duration_ms").alias("max_ms"),
        F.min("duration_ms").alias("min_ms"),
        F.max_by("status", "logged_at").alias("last_status"),
    )
