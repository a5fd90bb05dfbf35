"""Staging upsert and promotion, in batch form and as a file stream."""

import os
import shutil
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tramline.operators.incremental import upsert
from tramline.streaming import arrivals, gauges

NOW = datetime(2026, 3, 21, 12, 0)


def staging(spark, *rows):
    return spark.createDataFrame(list(rows), arrivals.STAGING)


def test_upsert_replaces_and_keeps(spark, rows):
    t = datetime(2026, 3, 21, 9, 0)
    old = staging(spark, ("IC1", 1, 20260321, 900, 0, False, t), ("OLD1", 2, 20260320, 800, 0, False, t))
    new = staging(spark, ("IC1", 1, 20260321, 900, 120, False, NOW), ("IC2", 1, 20260321, 910, 0, True, NOW))
    merged = upsert(old, new, arrivals.STAGING_KEY)
    assert rows(merged, "train_id", "delay") == [("IC1", 120), ("IC2", 0), ("OLD1", 0)]


@pytest.fixture(scope="module")
def example(spark):
    return staging(
        spark,
        ("IC1", 1, 20260321, 900, 0, False, datetime(2026, 3, 21, 9, 5)),
        ("IC2", 1, 20260321, 910, 0, True, datetime(2026, 3, 21, 9, 10)),
        ("IC3", 2, 20260321, 1100, 0, False, datetime(2026, 3, 21, 11, 0)),
    )


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame([(1,), (2,)], "station_key int")


def test_promotion_example(example, stations, rows):
    fact, remaining = arrivals.promote(example, stations, NOW)
    assert fact.columns == arrivals.FACT_COLUMNS
    assert rows(fact) == [(1, 20260321, 900, 930, 1), (2, 20260321, 900, 930, 0)]
    assert rows(remaining, "train_id") == [("IC3",)]
    assert remaining.columns == example.columns


def test_nothing_staged_nothing_promoted(spark, stations):
    fact, remaining = arrivals.promote(staging(spark), stations, NOW)
    assert fact.isEmpty() and remaining.isEmpty()


def test_one_fresh_update_holds_the_window_of_all_stations(spark, stations, rows):
    late = staging(
        spark, ("A", 1, 20260321, 900, 0, False, datetime(2026, 3, 21, 9, 0)), ("B", 2, 20260321, 905, 0, False, datetime(2026, 3, 21, 11, 45))
    )
    fact, remaining = arrivals.promote(late, stations, NOW)
    assert fact.isEmpty() and remaining.count() == 2


def test_delay_moves_a_train_over_midnight(spark, stations, rows):
    night = staging(spark, ("N", 1, 20260320, 2350, 900, False, datetime(2026, 3, 20, 23, 50)), ("M", 2, 20260320, 2335, 0, False, datetime(2026, 3, 20, 23, 40)))
    fact, _ = arrivals.promote(night, stations, NOW)
    assert rows(fact.filter("arrivals > 0")) == [(1, 20260321, 0, 30, 1), (2, 20260320, 2330, 0, 1)]


def test_promotion_conserves_rows(spark, stations):
    board = spark.range(500).select(
        F.concat(F.lit("T"), "id").alias("train_id"), (F.col("id") % 2 + 1).cast("int").alias("station_key"), F.lit(20260321).alias("date_key"),
        ((F.col("id") % 12) * 100 + F.col("id") % 60).cast("int").alias("time_key"), F.lit(30).alias("delay"), (F.col("id") % 7 == 0).alias("canceled"),
        F.lit(datetime(2026, 3, 21, 10, 0)).cast("timestamp_ntz").alias("last_updated"),
    )
    fact, remaining = arrivals.promote(board, stations, NOW)
    counted = fact.agg(F.sum("arrivals")).first()[0]
    held = {r["train_id"] for r in remaining.collect()}
    canceled = sum(1 for r in board.filter("canceled").collect() if r["train_id"] not in held)
    assert counted + canceled + len(held) == 500


def test_slot_count(spark, rows):
    board = staging(
        spark, ("A", 1, 20260321, 855, 300, False, NOW), ("B", 1, 20260321, 929, 60, False, NOW), ("C", 1, 20260321, 910, 0, True, NOW), ("D", 2, 20260321, 900, 0, False, NOW)
    )
    assert rows(arrivals.slot_counts(board, datetime(2026, 3, 21, 9, 0))) == [(1, 1), (2, 1)]


def _polls(hours):
    """One poll per hour announcing a train per station ten minutes later."""
    for h in hours:
        at = datetime(2026, 3, 21, h, 0)
        yield h, [(f"T{h}-{s}", s, 20260321, h * 100 + 10, 60 * s, s == 2 and h % 3 == 0, at) for s in (1, 2)]


@pytest.mark.parametrize("per_trigger", [1, 100])
def test_stream_equals_one_batch(spark, stations, rows, tmp_path, per_trigger):
    """Micro-batches promote the same windows as a single batch, and a replay changes nothing."""
    landing = tmp_path / "landing"
    for h, polled in _polls(range(6, 15)):
        path = tmp_path / f"w{h}"
        staging(spark, *polled).coalesce(1).write.parquet(str(path))
        os.makedirs(landing, exist_ok=True)
        part = next(p for p in os.listdir(path) if p.startswith("part"))
        shutil.copy(path / part, landing / f"{h:02d}-{uuid.uuid4().hex}.parquet")
        os.utime(landing, None)
    sink = arrivals.ArrivalSink(str(tmp_path / "staging"), str(tmp_path / "fact"), stations)
    stream = spark.readStream.schema(arrivals.STAGING).option("maxFilesPerTrigger", per_trigger).parquet(str(landing))
    query = arrivals.run_arrival_stream(stream, sink, str(tmp_path / "checkpoint"))
    query.awaitTermination()
    assert query.exception() is None
    fact = spark.read.parquet(str(tmp_path / "fact")).select(*arrivals.FACT_COLUMNS)
    everything = staging(spark, *[r for _, polled in _polls(range(6, 15)) for r in polled])
    want, _ = arrivals.promote(everything, stations, datetime(2026, 3, 21, 14, 0))
    assert rows(fact) == rows(want)
    if per_trigger == 100:
        sink(everything, 0)
        assert rows(spark.read.parquet(str(tmp_path / "fact")).select(*arrivals.FACT_COLUMNS)) == rows(want)


def test_watermarked_variant_counts(spark, tmp_path):
    staging(spark, *[r for _, polled in _polls(range(6, 15)) for r in polled]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(arrivals.STAGING).parquet(str(tmp_path / "in"))
    query = arrivals.watermarked_counts(stream).writeStream.format("memory").queryName("watermarked").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("watermarked").agg(F.sum("arrivals")).first()[0] == 15


def test_gauge_stream_appends_each_snapshot_once(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    for minute in (0, 5):
        (tmp_path / "in" / f"{minute}.json").write_text(f'[{{"id": 1, "bikes": {minute}, "polled_at": "2026-03-21T08:0{minute}:00"}}]')
    stream = gauges.gauge_stream(spark, str(tmp_path / "in"), "id int, bikes int, polled_at timestamp_ntz", 1)
    unseen = gauges.append_unseen(stream, "polled_at", ["id", "bikes"])
    for _ in range(2):
        query = gauges.append_to(gauges.stamped(unseen, "polled_at"), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("id", "date_key", "time_key").collect())
    assert got == [(1, 20260321, 800), (1, 20260321, 805)]


class _Breaks(arrivals.ArrivalSink):
    """Loses its driver once, on the second batch: before its commit or right after it."""

    def __init__(self, *args, after: bool):
        super().__init__(*args)
        self.after, self.broken = after, False

    def commit(self, spark, batch_id):
        if batch_id == 1 and not self.broken:
            self.broken = True
            if self.after:
                super().commit(spark, batch_id)
            raise RuntimeError("lost")
        super().commit(spark, batch_id)


@pytest.mark.parametrize("after", [False, True])
def test_a_broken_batch_is_published_once(spark, stations, rows, tmp_path, after):
    polls = [polled for _, polled in _polls(range(6, 15))]
    sink = _Breaks(str(tmp_path / "staging"), str(tmp_path / "fact"), stations, after=after)
    for i, polled in enumerate([polls[:4], polls[4:7], polls[7:]]):
        staging(spark, *[r for p in polled for r in p]).coalesce(1).write.parquet(str(tmp_path / "landed" / f"poll={i}"))
        stream = spark.readStream.schema(arrivals.STAGING).parquet(str(tmp_path / "landed" / "*"))
        for _ in range(2):
            query = arrivals.run_arrival_stream(stream, sink, str(tmp_path / "checkpoint"))
            try:
                query.awaitTermination()
            except Exception:
                assert i == 1 and sink.committed(spark) == ([0, 1] if after else [0])
    want, left = arrivals.promote(staging(spark, *[r for p in polls for r in p]), stations, datetime(2026, 3, 21, 14, 0))
    assert sink.broken and sink.committed(spark) == [0, 1, 2]
    assert rows(sink.facts(spark)) == rows(want)
    assert rows(sink.staging(spark)) == rows(left)


def test_what_is_not_committed_is_not_seen(spark, stations, example, tmp_path):
    sink = _Breaks(str(tmp_path / "staging"), str(tmp_path / "fact"), stations, after=False)
    assert sink.facts(spark).isEmpty() and sink.staging(spark).isEmpty()
    sink(example, 0)
    facts, left = sink.facts(spark).collect(), sink.staging(spark).collect()
    with pytest.raises(RuntimeError, match="lost"):
        sink(staging(spark, ("X", 1, 20260322, 900, 0, False, datetime(2026, 3, 22, 12, 0))), 1)
    assert sink.facts(spark).collect() == facts and sink.staging(spark).collect() == left


def test_unseen_rows_against_all_that_is_stored(spark, rows, tmp_path):
    schema = "id int, bikes int, date_key int, time_key int"
    sink = gauges.UnseenSink(str(tmp_path / "gauge"), ["id", "date_key", "time_key"], schema)
    assert sink.table(spark).isEmpty()
    frame = lambda *r: spark.createDataFrame(list(r), schema)
    sink(frame((1, 5, 20260321, 800), (1, 4, 20260321, 800), (None, 1, None, 800)), 0)
    sink(frame((1, 9, 20260321, 800), (2, 9, 20260322, 800), (None, 2, None, 800)), 1)
    sink(frame(), 2)
    want = [(1, 4, 20260321, 800), (2, 9, 20260322, 800), (None, 1, None, 800)]
    assert rows(sink.table(spark)) == sorted(want, key=repr)
    sink(frame((2, 9, 20260322, 800)), 1)  # a replay replaces what its first attempt wrote
    assert rows(sink.table(spark)) == sorted(want, key=repr)
