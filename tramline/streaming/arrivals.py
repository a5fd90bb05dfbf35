"""Train arrivals: upsert into staging, promote stable half-hours to the fact table.

A half-hour window leaves staging only when every row of every station in it is stable,
i.e. its actual arrival and its last update are both older than the lateness. A watermark
cannot express this (it drops late rows and ignores update times), so the rule is a batch
function over staging that runs inside ``foreachBatch``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.keys import add_seconds, date_key, floor_minutes, key_timestamp, time_key, wall_clock
from tramline.operators.incremental import newest_version, upsert

STAGING_KEY = ["train_id", "station_key", "date_key", "time_key"]
STAGING = (
    "train_id string, station_key int, date_key int, time_key int, delay int, "
    "canceled boolean, last_updated timestamp_ntz"
)
FACT = "station_key int, date_key int, start_time int, end_time int, arrivals int"
FACT_COLUMNS = [part.split()[0] for part in FACT.split(", ")]
#: What ``with_windows`` adds, as stored: the verdict is the folder.
VERDICT = "window_start timestamp_ntz, is_stable boolean, window_stable boolean"


def actual_arrival() -> Column:
    """Planned moment plus the delay in seconds."""
    return add_seconds(key_timestamp(F.col("date_key"), F.col("time_key")), F.col("delay"))


def with_windows(staging: DataFrame, as_of: Column, minutes: int = 30, lateness: str = "90 minutes") -> DataFrame:
    """Staging rows with their window start, row stability and the verdict of the whole window.

    The verdict is aggregated per window first (map-side combined) and joined back, so a
    crowded window is never gathered in one task.
    """
    cutoff = as_of - F.expr(f"interval {lateness}")
    actual = actual_arrival()
    rows = staging.withColumns(
        {
            "window_start": floor_minutes(actual, minutes),
            "is_stable": F.coalesce((actual < cutoff) & (F.col("last_updated") < cutoff), F.lit(False)),
        }
    )
    verdict = rows.groupBy(F.col("window_start").alias("__w")).agg(F.bool_and("is_stable").alias("window_stable"))
    return rows.join(verdict, F.col("window_start").eqNullSafe(F.col("__w"))).drop("__w")


def promote(
    staging: DataFrame, stations: DataFrame, as_of: datetime | Column, minutes: int = 30,
    lateness: str = "90 minutes",
) -> tuple[DataFrame, DataFrame]:
    """(fact rows, remaining staging rows).

    Every station gets a row per promoted window, 0 where nothing arrived. Canceled trains are
    not counted but leave staging with their window.
    """
    moment = as_of if isinstance(as_of, Column) else wall_clock(as_of)
    rows = with_windows(staging, moment, minutes, lateness)
    remaining = rows.filter(~F.col("window_stable")).select(*staging.columns)
    return promoted(rows.filter("window_stable"), stations, minutes), remaining


def promoted(ready: DataFrame, stations: DataFrame, minutes: int = 30) -> DataFrame:
    """Fact rows of staging rows (with ``window_start``) whose windows are stable."""
    counts = ready.groupBy("station_key", "window_start").agg(
        F.count_if(~F.col("canceled")).cast("int").alias("arrivals")
    )
    # The promoted windows are at most the half-hours of the batch's time span: one array cell,
    # with the keys worked out once per window instead of once per station and window.
    end = F.col("window_start") + F.expr(f"interval {minutes} minutes")
    window = F.struct(
        "window_start",
        date_key(F.col("window_start")).alias("date_key"),
        time_key(F.col("window_start")).alias("start_time"),
        time_key(end).alias("end_time"),
    )
    windows = ready.select("window_start").distinct().select(F.collect_list(window)).scalar()
    # A fixed partition count keeps AQE from packing the few stations into one task before
    # each of them is multiplied by the windows.
    spread = int(stations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scaffold = (
        stations.select("station_key").repartition(spread, "station_key").distinct()
        .select("station_key", F.inline(windows))
    )
    filled = scaffold.join(counts, ["station_key", "window_start"], "left")
    return filled.select(
        "station_key", "date_key", "start_time", "end_time", F.coalesce("arrivals", F.lit(0)).alias("arrivals")
    )


def slot_counts(board: DataFrame, start: datetime | Column, minutes: int = 30) -> DataFrame:
    """One-shot count of a single slot: running trains arriving in [start, start + minutes)."""
    lo = start if isinstance(start, Column) else wall_clock(start)
    hi = lo + F.expr(f"interval {minutes} minutes")
    actual = actual_arrival()
    return (
        board.filter((actual >= lo) & (actual < hi) & ~F.col("canceled"))
        .groupBy("station_key")
        .agg(F.count(F.lit(1)).cast("int").alias("arrivals"))
    )


class ArrivalSink:
    """``foreachBatch`` handler that commits fact and staging of a batch together.

    A batch writes all staging rows with the verdict of their window, once, then the fact rows of
    the stable ones, each into the folder of its batch id. The append of one row to the commit
    log publishes both: readers take the batches named there only, so they never see the facts
    of a batch beside the staging of the one before. What a batch leaves in staging is the part
    of its folder whose windows are not stable. A batch broken before its commit is written
    again on replay, one that is committed is left as it is. The as-of moment is the newest poll
    time of the batch, never the clock. One stream (and its checkpoint) belongs to the folders.
    """

    def __init__(self, staging_path: str, fact_path: str, stations: DataFrame, lateness: str = "90 minutes"):
        self.staging_path = staging_path
        self.fact_path = fact_path
        self.commit_path = f"{staging_path.rstrip('/')}-commits"
        self.stations = stations
        self.lateness = lateness

    def committed(self, spark: SparkSession) -> list[int]:
        """Ids of the published batches: one small row a batch."""
        try:
            log = spark.read.schema("batch_id long").parquet(self.commit_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted({r[0] for r in log.collect()})

    def staging_after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What batch ``batch_id`` left in staging; nothing before the first batch."""
        if batch_id < 0:
            return spark.createDataFrame([], STAGING)
        return self._judged(spark, batch_id).filter("NOT window_stable").select(*STAGING_NAMES)

    def staging(self, spark: SparkSession) -> DataFrame:
        """Staging as published last."""
        return self.staging_after(spark, max(self.committed(spark), default=-1))

    def facts(self, spark: SparkSession) -> DataFrame:
        """Fact rows of all published batches."""
        paths = [f"{self.fact_path}/batch={n}" for n in self.committed(spark)]
        return spark.read.schema(FACT).parquet(*paths) if paths else spark.createDataFrame([], FACT)

    def _judged(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(f"{STAGING}, {VERDICT}").parquet(f"{self.staging_path}/batch={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in self.committed(spark):
            return
        arrived = newest_version(batch, STAGING_KEY, "last_updated", ["delay", "canceled"]).select(*STAGING_NAMES)
        merged = upsert(self.staging_after(spark, batch_id - 1), arrived, STAGING_KEY)
        judged = with_windows(merged, batch.select(F.max("last_updated")).scalar(), lateness=self.lateness)
        # Written before the facts are counted, so both outputs come from the same rows.
        judged.write.mode("overwrite").partitionBy("window_stable").parquet(f"{self.staging_path}/batch={batch_id}")
        fact = promoted(self._judged(spark, batch_id).filter("window_stable"), self.stations)
        fact.write.mode("overwrite").parquet(f"{self.fact_path}/batch={batch_id}")
        self.commit(spark, batch_id)

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        spark.createDataFrame([(batch_id,)], "batch_id long").coalesce(1).write.mode("append").parquet(self.commit_path)


STAGING_NAMES = [part.split()[0] for part in STAGING.split(", ")]


def run_arrival_stream(arrivals: DataFrame, sink: ArrivalSink, checkpoint: str):
    """Start the promotion over a streaming frame of staging rows; ends when the input is drained."""
    return (
        arrivals.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def watermarked_counts(arrivals: DataFrame, lateness: str = "90 minutes", minutes: int = 30) -> DataFrame:
    """Approximate variant on Spark's own event time: counts per station and window.

    Unlike ``promote`` it closes a window on the newest event time alone and drops rows that
    come later than the lateness. Event time needs a zoned timestamp, hence the cast.
    """
    return (
        arrivals.withColumn("actual", actual_arrival().cast("timestamp"))
        .withWatermark("actual", lateness)
        .filter(~F.col("canceled"))
        .groupBy("station_key", F.window("actual", f"{minutes} minutes").alias("w"))
        .agg(F.count(F.lit(1)).alias("arrivals"))
        .select("station_key", F.col("w.start").alias("window_start"), "arrivals")
    )


