"""Codecs of the integer date key (yyyyMMdd) and time key (HHmm).

All arithmetic stays on integers, so it runs inside whole-stage codegen and never
depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(moment: datetime) -> Column:
    """A naive datetime as a literal without zone (a plain literal would pass through the session zone)."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def date_key(moment: Column) -> Column:
    """Date or timestamp to a yyyyMMdd integer."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def on_days(moment: Column, first: Column, last: Column) -> Column:
    """True from the first through the last day. Next to a test on computed keys, this is what reaches the scan."""
    return (moment >= first) & (moment < F.date_add(last, 1))


def time_key(moment: Column) -> Column:
    """Timestamp to an HHmm integer (0..2359)."""
    return F.hour(moment) * 100 + F.minute(moment)


def month_key(year: Column, month: Column) -> Column:
    """Key of the first day of a month, used by monthly snapshots."""
    return year * 10000 + month * 100 + 1


def key_date(day_key: Column) -> Column:
    """yyyyMMdd integer to a date."""
    return F.make_date(_div(day_key, 10000), _div(day_key, 100) % 100, day_key % 100)


def key_timestamp(day_key: Column, clock_key: Column) -> Column:
    """(date key, time key) to a wall-clock timestamp."""
    minutes = _div(clock_key, 100) * 60 + clock_key % 100
    return F.timestamp_add("MINUTE", minutes, key_date(day_key).cast("timestamp_ntz"))


def valid_date_key(day_key: Column) -> Column:
    """True where the key names a real calendar day."""
    return F.coalesce(F.try_to_date(day_key.cast("string"), "yyyyMMdd").isNotNull(), F.lit(False))


def month_bounds(year: int, month: int | None = None) -> tuple[int, int]:
    """Inclusive key range of a year or a month; pushes down where a LIKE prefix would not."""
    if month is None:
        return year * 10000, year * 10000 + 9999
    return year * 10000 + month * 100, year * 10000 + month * 100 + 99


def local_from_unix(seconds: Column, zone: str | Column) -> Column:
    """Unix seconds to the wall clock of ``zone``."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    utc = add_seconds(F.lit("1970-01-01").cast("timestamp_ntz"), seconds)
    return F.convert_timezone(F.lit("UTC"), zone, utc)


def add_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, moment)


def floor_minutes(moment: Column, minutes: int) -> Column:
    """Start of the clock-aligned slot of ``minutes`` (a divisor of a day) holding ``moment``."""
    start = F.lit("0001-01-01").cast("timestamp_ntz")
    passed = F.timestamp_diff("MINUTE", start, moment)
    return F.timestamp_add("MINUTE", passed - passed % minutes, start)


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b)).cast("int")
