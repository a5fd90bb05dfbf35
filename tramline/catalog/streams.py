"""File streams run to the end of what has landed, restarted, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.catalog.base import STAGING, Tables, date_key_sql, query, time_key_sql
from tramline.session import checkpoint_dir
from tramline.streaming import arrivals, gauges

_POLLS = 4


def _folder(t: Tables) -> str:
    return f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"


def _polls(rows: DataFrame, moment: str) -> list[DataFrame]:
    """The rows in four stretches of time, oldest first."""
    low, high = rows.agg(F.min(moment), F.max(moment)).first()
    if low is None:
        return [rows]
    cuts = [low + (high - low) * i / _POLLS for i in range(1, _POLLS)]
    number = F.coalesce(sum((F.col(moment) >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return [rows.filter(number == i) for i in range(_POLLS)]


def _arrivals_run(t: Tables) -> arrivals.ArrivalSink:
    """Staging rows land poll by poll; the promotion drains each poll and runs once more without a new one."""
    folder = _folder(t)
    sink = arrivals.ArrivalSink(f"{folder}/staging", f"{folder}/fact", t.staging.select("station_key"))
    stream = t.spark.readStream.schema(arrivals.STAGING).parquet(f"{folder}/landed/*")
    polls = _polls(t.staging, "last_updated")
    for i, poll in enumerate([*polls, None]):
        if poll is not None:
            poll.write.parquet(f"{folder}/landed/poll={i}")
        arrivals.run_arrival_stream(stream, sink, f"{folder}/checkpoint").awaitTermination()
    # The last batch once more, as after a driver lost between its commit and the stream's own.
    sink(polls[-1], max(sink.committed(t.spark)))
    return sink


_LATE = f"""{STAGING}, cut AS (SELECT max(last_updated) - INTERVAL 90 MINUTE AS edge FROM staging),
rows AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, actual) AS ws, actual < edge AND last_updated < edge AS stable FROM staging, cut),
verdict AS (SELECT ws, bool_and(stable) AS ok FROM rows GROUP BY 1)"""


@query(
    "arrival_stream_facts",
    "R8 R1 R5 R7 B16",
    f"""WITH {_LATE}, n AS (SELECT station_key, ws, count(*) FILTER (NOT canceled) AS n FROM rows JOIN verdict USING (ws) WHERE ok GROUP BY 1, 2)
    SELECT s.station_key, {date_key_sql('ws')} AS date_key, {time_key_sql('ws')} AS start_time, {time_key_sql('(ws + INTERVAL 30 MINUTE)')} AS end_time, coalesce(n, 0)::INT AS arrivals
    FROM (SELECT DISTINCT station_key FROM staging) s CROSS JOIN (SELECT ws FROM verdict WHERE ok) v LEFT JOIN n USING (station_key, ws)""",
)
def arrival_stream_facts(t: Tables):
    """Every stable window once, in whichever poll it became stable."""
    return _arrivals_run(t).facts(t.spark)


@query(
    "arrival_stream_staging",
    "R8 R5 R6",
    f"WITH {_LATE} SELECT train_id, station_key, date_key, time_key, delay, canceled, last_updated FROM rows JOIN verdict USING (ws) WHERE NOT ok",
)
def arrival_stream_staging(t: Tables):
    """What the last poll leaves in staging."""
    return _arrivals_run(t).staging(t.spark)


@query(
    "gauge_stream_appended",
    "R12 R10 S8 C5",
    f"SELECT event_id, user_id::INT AS station_key, value AS bikes, {date_key_sql('ts')} AS date_key, {time_key_sql('ts')} AS time_key FROM events",
)
def gauge_stream_appended(t: Tables):
    """Snapshots land as JSON; each landing also repeats a third of all rows, and a second stream reads everything again."""
    folder = _folder(t)
    feed = t.events.select("event_id", F.col("user_id").cast("int").alias("station_key"), F.col("value").alias("bikes"), F.col("ts").alias("polled_at"))
    schema = "event_id long, station_key int, bikes double, polled_at timestamp_ntz"
    sink = gauges.UnseenSink(f"{folder}/gauge", ["event_id", "station_key", "date_key", "time_key"], "event_id long, station_key int, bikes double, date_key int, time_key int")
    stream = gauges.stamped(gauges.gauge_stream(t.spark, f"{folder}/landed/*", schema, whole_files=False), "polled_at")
    for i, poll in enumerate(_polls(feed, "polled_at")):
        poll.unionByName(feed.filter(F.col("event_id") % 3 == 0)).write.json(f"{folder}/landed/poll={i}")
        gauges.run_unseen(stream, sink, f"{folder}/checkpoint").awaitTermination()
    gauges.run_unseen(stream, Renumbered(sink, 1_000_000), f"{folder}/checkpoint-2").awaitTermination()
    return sink.table(t.spark)


class Renumbered:
    """A second stream into the same table: its batches get ids of their own."""

    def __init__(self, sink: gauges.UnseenSink, first: int):
        self.sink, self.first = sink, first

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.sink(batch, self.first + batch_id)
