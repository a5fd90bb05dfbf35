"""Bike gauge snapshots and incremental appends as file streams."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.keys import date_key, time_key


def gauge_stream(
    spark: SparkSession, folder: str, schema: str, max_files: int | None = None, whole_files: bool = True
) -> DataFrame:
    """Streaming scan of landed JSON snapshots: one payload per file, else one per line."""
    reader = spark.readStream.schema(schema).option("multiLine", whole_files)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(folder)


def stamped(snapshots: DataFrame, polled_at: str) -> DataFrame:
    """Gauge rows with their date and time key; the poll time itself is dropped."""
    moment = F.col(polled_at)
    return snapshots.withColumns({"date_key": date_key(moment), "time_key": time_key(moment)}).drop(polled_at)


def append_unseen(stream: DataFrame, event_time: str, keys: list[str], lateness: str = "1 day") -> DataFrame:
    """Streaming form of the incremental append: each key once within the lateness."""
    zoned = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return zoned.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """Append a stream to a Parquet table partitioned by date key; drains the input and stops."""
    return (
        stream.writeStream.format("parquet")
        .partitionBy("date_key")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class UnseenSink:
    """``foreachBatch`` handler that appends the rows whose key the target does not have yet.

    Unlike ``append_unseen`` it compares with all that is stored, however old, so a snapshot
    landed again months later, or by another stream, adds nothing. The target has one folder per
    batch id and day; the days between the batch's first and last are the ones read. A replayed
    batch compares with all other batches and replaces its own folder. Of a batch's rows with one
    key, the least (by all other columns) stays.
    """

    def __init__(self, path: str, keys: list[str], schema: str):
        self.path, self.keys, self.schema = path, keys, schema

    def table(self, spark: SparkSession) -> DataFrame:
        """All appended rows."""
        return self._stored(spark).select(*self._names(spark))

    def _names(self, spark: SparkSession) -> list[str]:
        return spark.createDataFrame([], self.schema).columns

    def _stored(self, spark: SparkSession) -> DataFrame:
        schema = f"{self.schema}, batch long"
        try:
            return spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = self._names(spark)
        others = [c for c in names if c not in self.keys]
        once = batch.groupBy(*self.keys).agg(F.min(F.struct(*others)).alias("__rest")).select(*self.keys, "__rest.*").select(*names)
        low, high = batch.agg(F.min("date_key"), F.max("date_key")).first()
        stored = self._stored(spark).filter(F.col("batch") != batch_id)
        if low is not None:
            stored = stored.filter(F.col("date_key").between(low, high) | F.col("date_key").isNull())
        known = stored.select(*[F.col(c).alias(f"__{c}") for c in self.keys])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in self.keys])
        fresh = once.join(known, same, "left_anti")
        # Only this batch's folder is replaced, days of a broken attempt included.
        fresh.hint("rebalance", "date_key").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date_key").parquet(f"{self.path}/batch={batch_id}")


def run_unseen(stream: DataFrame, sink: UnseenSink, checkpoint: str):
    """Append what has landed and stop."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
