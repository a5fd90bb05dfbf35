"""Revisit resolution: worked cases, and its SQL."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.harness import TESTDATA, connect, differences
from tramline.llm import queries, warc

SCHEMA = "record_id bigint, url string, is_revisit boolean, date timestamp, digest string, headers map<string,string>, payload string, status string"


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_resolution(spark):
    url = "http://Host.example:80/a?b=2&a=1&utm_source=x#f"
    rows = [
        (1, url, False, at(1), "d1", {"ETag": 'W/"1"', "Content-Length": "9", "Age": "0"}, "first", ""),
        (2, "http://host.example/a?a=1&b=2", True, at(1, 5), None, {"etag": '"1"', "content-length": "0", "AGE": "7"}, None, ""),
        (3, url, False, at(2), "d2", {"ETag": '"2"'}, "second", ""),
        (4, url, True, at(9), None, {"etag": '"1"'}, None, ""),  # the latest response has another tag
        (5, url, True, at(9), "d2", None, None, ""),
        (6, url, True, at(9), "d1", None, None, ""),  # and another digest
        (7, url, True, at(1), None, None, None, ""),  # not later than the first response
        (8, "http://other.example", True, at(3), None, None, None, ""),
        (9, None, True, at(3), None, None, None, ""), (10, url, True, None, None, None, None, ""),
        (11, "https://h:443", False, at(4), None, {"Last-Modified": "m"}, "third", ""), (12, "HTTPS://H/", False, at(4), None, {"Last-Modified": "n"}, "fourth", ""),
        (13, "https://h/", True, at(4, 1), None, {"last-modified": "n"}, None, ""), (14, "https://h/", True, at(5), None, {"last-modified": "m"}, None, ""),
    ]
    got = {r.record_id: r for r in warc.resolve(spark.createDataFrame(rows, SCHEMA)).collect()}
    said = {k: (r.status, r.resolved_id, r.payload) for k, r in got.items()}
    missing, wrong = ("missing", None, None), ("contradicted", None, None)
    assert said == {2: ("resolved", 1, "first"), 4: wrong, 5: ("resolved", 3, "second"), 6: wrong, 7: missing, 8: missing, 9: missing, 10: missing, 13: ("resolved", 12, "fourth"), 14: wrong}
    assert got[2].headers == {"etag": '"1"', "content-length": "9", "age": "7"} and got[5].headers == {"etag": '"2"'}


def test_empty_and_hot_url(spark):
    assert warc.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
    hot = spark.range(3000).select(
        F.col("id").alias("record_id"), F.lit("http://h/").alias("url"), (F.col("id") % 50 > 0).alias("is_revisit"), F.timestamp_seconds(F.col("id") * 7200).alias("date"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("map<string,string>").alias("headers"), F.lit("p").alias("payload"),
    )
    got = warc.resolve(hot).collect()
    assert len(got) == 2940 and all(r.resolved_id == r.record_id - r.record_id % 50 for r in got)


def test_sql(spark):
    folder = f"{TESTDATA}/sf0.01"
    got = queries.op7_warc_revisits(spark, folder)
    assert differences(got, connect(folder), queries.SQL["op7_warc_revisits"]) is None
    assert {r.status for r in got.collect()} == {"resolved", "contradicted", "missing"}
