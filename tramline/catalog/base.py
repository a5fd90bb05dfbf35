"""Registration of queries and shared column derivations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.keys import floor_minutes
from tramline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)

    # Derived views used by several queries. They add columns only; every row stays.

    @property
    def gauge(self) -> DataFrame:
        """Events as gauge readings with their day and the minute that splits a hot station's day."""
        return self.events.select(
            "event_id", "user_id", "ts", "event_type", "value",
            F.col("ts").cast("date").alias("day"), (F.hour("ts") * 60 + F.minute("ts")).alias("minute"),
        )

    @property
    def daily(self) -> DataFrame:
        """Orders per customer nation and day: one row per series and day."""
        return (
            self.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
            .agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
            .join(self.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey", "day")
            .agg(F.sum("cents").alias("cents"))
            .select("c_nationkey", "day", F.floor(F.col("cents") / 100).cast("bigint").alias("total"))
        )

    @property
    def staging(self) -> DataFrame:
        """Events as train arrivals: planned at ts, delayed by value seconds, errors are canceled."""
        return self.events.select(
            F.col("event_id").cast("string").alias("train_id"),
            F.col("user_id").cast("int").alias("station_key"),
            (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).alias("date_key"),
            (F.hour("ts") * 100 + F.minute("ts")).alias("time_key"),
            F.floor(F.col("value") * 10).cast("int").alias("delay"),
            (F.col("event_type") == "error").alias("canceled"),
            floor_minutes(F.col("ts"), 1).alias("last_updated"),
        )


def lat(key: str) -> Column:
    """A deterministic latitude from a key, spread over about 11 km."""
    return 51.0 + (F.col(key) * 7919 % 1000) / 10000.0


def lon(key: str) -> Column:
    return 3.7 + (F.col(key) * 104729 % 1000) / 10000.0


LAT = "(51.0 + ({0} * 7919 % 1000) / 10000.0)"
LON = "(3.7 + ({0} * 104729 % 1000) / 10000.0)"
DISTANCE = (
    "(2 * 6371000 * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + "
    "cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"
)


def date_key_sql(x: str) -> str:
    return f"(year({x}) * 10000 + month({x}) * 100 + day({x}))::INT"


def time_key_sql(x: str) -> str:
    return f"(hour({x}) * 100 + minute({x}))::INT"


#: SQL of the derived views, to be put after WITH.
DAILY = """daily AS (
  SELECT c_nationkey, day, floor(sum(cents) / 100.0)::BIGINT AS total FROM (
    SELECT o_custkey, o_orderdate::DATE AS day, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents
    FROM orders GROUP BY 1, 2) JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""

STAGING = f"""staging AS (
  SELECT event_id::VARCHAR AS train_id, user_id::INT AS station_key, {date_key_sql('ts')} AS date_key,
    {time_key_sql('ts')} AS time_key, floor(value * 10)::INT AS delay, event_type = 'error' AS canceled,
    date_trunc('minute', ts) AS last_updated,
    date_trunc('minute', ts) + to_seconds(floor(value * 10)::INT) AS actual FROM events)"""

RISES = """steps AS (
  SELECT *, ts::DATE AS day, lag(value) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS prev FROM events),
rises AS (SELECT *, CASE WHEN value > prev THEN value - prev ELSE 0 END AS rise FROM steps)"""


def query(name: str, covers: str, sql: str | None = None):
    """Register a function of ``Tables`` with the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        COVERS[name] = covers
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
