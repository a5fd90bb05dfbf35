"""Reports as SQL table functions."""

from datetime import datetime

from pyspark.sql import functions as F

from tests.harness import TESTDATA
from tramline.plans import table_functions
from tramline.session import table


def _gauge(spark):
    rows = [
        (1, 5, datetime(2024, 1, 31, 8, 0), 2.0, 4.0, 9.0), (2, 5, datetime(2024, 1, 31, 8, 5), 5.0, 3.0, None), (3, 5, datetime(2024, 1, 31, 8, 5), 4.0, 5.0, 7.0),
        (4, 5, datetime(2024, 2, 1, 9, 0), 7.0, 1.0, 1.0), (5, 5, datetime(2024, 2, 1, 9, 5), 8.0, 0.0, 1.0), (6, 6, datetime(2024, 2, 3, 9, 0), 1.0, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, "reading int, station long, moment timestamp_ntz, in_use double, electric double, classic double")


def test_months_and_years(spark, rows):
    table_functions.register_rentals(_gauge(spark), "small_")
    january, year = [(8, False, 3.0)], [(8, False, 3.0), (9, False, 1.0)]
    assert rows(spark.sql("SELECT * FROM small_rentals_per_hour(5, 2024, 1)")) == january
    assert rows(spark.sql("SELECT * FROM small_rentals_per_hour(5, 2024)")) == rows(spark.sql("SELECT * FROM small_rentals_per_hour(5, 2024, NULL)")) == year
    assert rows(spark.sql("SELECT * FROM small_rentals_per_day(5, 2024)")) == [(20240131, 31, "31-01", 1.0, 0.0), (20240201, 1, "01-02", 1.0, 0.0)]
    for nothing in ("6, 2024, 2", "5, 2023", "99, 2024", "NULL, 2024"):
        assert spark.sql(f"SELECT * FROM small_rentals_per_hour({nothing})").isEmpty()


def test_constants_reach_the_scan(spark):
    events = table(spark, f"{TESTDATA}/sf0.001", "events")
    table_functions.register_rentals(
        events.select(F.col("event_id").alias("reading"), F.col("user_id").alias("station"), F.col("ts").alias("moment"), F.col("value").alias("in_use"), F.lit(0.0).alias("electric"), F.lit(0.0).alias("classic")),
        "pushed_",
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    try:
        plan = spark.sql("SELECT * FROM pushed_rentals_per_hour(3, 2024, 1)")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "EqualTo(user_id,3)" in pushed and "GreaterThanOrEqual(ts,2024-01-01T00:00" in pushed and "LessThan(ts,2024-02-01T00:00" in pushed


def test_standing_by_name(spark, rows):
    means = spark.createDataFrame([("a", 3.0), ("b", 3.0), ("c", 1.0), ("d", None)], "station_name string, mean_rentals double")
    table_functions.register_top_percentage(means, "small_")
    assert rows(spark.sql("SELECT rank, round(top_percent, 3) FROM small_top_percentage('c')")) == [(3, 100.0)]
    assert rows(spark.sql("SELECT rank, round(top_percent, 3) FROM small_top_percentage('b')")) == [(1, 33.333)]
    assert spark.sql("SELECT * FROM small_top_percentage('nobody')").isEmpty()
