from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tramline.functions import dates, geo, keys, text, values


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("moment", "day_key", "clock_key", "half_hour"),
    [
        (datetime(2026, 3, 20, 0, 0), 20260320, 0, datetime(2026, 3, 20, 0, 0)),
        (datetime(2026, 3, 20, 8, 29, 59), 20260320, 829, datetime(2026, 3, 20, 8, 0)),
        (datetime(2026, 12, 31, 23, 59), 20261231, 2359, datetime(2026, 12, 31, 23, 30)),
    ],
)
def test_key_codecs(spark, moment, day_key, clock_key, half_hour):
    ts = F.lit(moment).cast("timestamp_ntz")
    assert one(spark, keys.date_key(ts)) == day_key
    assert one(spark, keys.time_key(ts)) == clock_key
    assert one(spark, keys.floor_minutes(ts, 30)) == half_hour
    assert one(spark, keys.key_timestamp(F.lit(day_key), F.lit(clock_key))) == moment.replace(second=0)
    assert one(spark, keys.key_date(F.lit(day_key))) == moment.date()


@pytest.mark.parametrize(("key", "ok"), [(20240229, True), (20230229, False), (20241301, False), (2024011, False), (None, False)])
def test_valid_date_key(spark, key, ok):
    assert one(spark, keys.valid_date_key(F.lit(key).cast("int"))) is ok


def test_unix_seconds_follow_the_zone(spark):
    seconds = F.lit(1711846800)  # 2024-03-31 01:00 UTC, the moment summer time starts
    assert one(spark, keys.local_from_unix(seconds, "Europe/Brussels")) == datetime(2024, 3, 31, 3, 0)
    assert one(spark, keys.local_from_unix(seconds - 1, "Europe/Brussels")) == datetime(2024, 3, 31, 1, 59, 59)


@pytest.mark.parametrize(
    ("period", "start"),
    [("day", date(2024, 7, 14)), ("week", date(2024, 7, 8)), ("month", date(2024, 7, 1)), ("year", date(2024, 1, 1))],
)
def test_period_start_on_a_sunday(spark, period, start):
    assert one(spark, dates.period_start(F.lit(date(2024, 7, 14)), period)) == start


def test_unknown_period():
    with pytest.raises(ValueError, match="period"):
        dates.period_start(None, "decade")


@pytest.mark.parametrize(("raw", "titled"), [("X_TEST_CITY_A", "X_Test_City_A"), ("sint-pieters 's gravenbrakel", "Sint-Pieters 'S Gravenbrakel"), ("ÉCAUSSINNES", "Écaussinnes")])
def test_title_case(spark, raw, titled):
    assert one(spark, text.title_case(F.lit(raw))) == titled == raw.title()


def test_text_repairs(spark):
    assert one(spark, text.repair_mojibake(F.lit("CafÃ©"))) == "Café"
    assert one(spark, text.repair_mojibake(F.lit("Café"))) == "Café"
    assert one(spark, text.repair_mojibake(F.lit("東京"))) == "東京"
    assert one(spark, text.unescape(F.lit(r"Café"))) == "Café"
    assert one(spark, text.clean_label(F.lit(r"<b>CafÃ©</b>,"))) == "Café"
    assert one(spark, text.drop_tail(F.lit("Deinze Station (noord)"), "Station")) == "Deinze"


@pytest.mark.parametrize(("raw", "repaired"), [("51047", 51.047), ("508852", 50.8852), ("51.0470", 51.047 / 1000), ("50.88521", 50.88521)])
def test_repair_latitude_counts_digits(spark, raw, repaired):
    assert one(spark, geo.repair_latitude(F.lit(raw))) == pytest.approx(repaired)


def test_null_and_unknown_rules(spark):
    null = F.lit(None).cast("double")
    assert one(spark, values.clip_floor(null)) is None
    assert one(spark, values.clip_floor(F.lit(-0.2))) == 0
    assert one(spark, values.map_values(F.lit("x"), {"a": "b"})) is None
    assert one(spark, values.replace_values(F.lit("x"), {"a": "b"})) == "x"
    assert one(spark, values.lenient_number(F.lit("12,5"))) == 12.5
    assert one(spark, values.lenient_number(F.lit("abc"))) is None
    assert one(spark, values.empty_to_null(F.lit("  "))) is None
    assert one(spark, values.half_even(F.lit(2.5))) == 2.0
    assert one(spark, values.circular_distance(F.lit(12), F.lit(1))) == 1


def test_truncated_average(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    assert df.agg(values.truncated_average(F.col("v"))).first()[0] == 1
    assert df.filter("v > 5").agg(values.truncated_average(F.col("v"))).first()[0] is None


def test_short_period(spark):
    assert one(spark, dates.short_period(F.lit("09/2025"))) == "sep/25"
    assert one(spark, dates.short_period(F.lit("13/2025"))) is None
    assert one(spark, dates.month_number(F.lit("MRT"))) == 3
    assert one(spark, dates.month_number(F.lit("mar"))) == 3


def test_haversine(spark):
    metres = one(spark, geo.haversine_m(F.lit(51.036), F.lit(3.71), F.lit(51.0361), F.lit(3.7101)))
    assert metres == pytest.approx(13.1, abs=0.2)
