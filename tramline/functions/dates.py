"""Calendar attributes, period starts and month-name codecs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.functions.values import map_values

# The calendar dimension stores these names.
DUTCH_DAYS = ["maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag", "zondag"]
DUTCH_MONTHS = [
    "januari", "februari", "maart", "april", "mei", "juni",
    "juli", "augustus", "september", "oktober", "november", "december",
]

# Month abbreviations met in reimbursement periods ("mar" is the one English spelling).
MONTH_NUMBERS = {
    "jan": 1, "feb": 2, "mrt": 3, "mar": 3, "apr": 4, "mei": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "okt": 10, "nov": 11, "dec": 12,
}

PERIODS = {"day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR"}


def monday_first(day: Column) -> Column:
    """Weekday number 1 (Monday) to 7."""
    return F.weekday(day) + 1


def whole_weeks(ordinal: Column) -> Column:
    """Full weeks before the ``ordinal``-th day."""
    return F.call_function("div", ordinal - 1, F.lit(7)).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """The non-holiday attributes of the calendar dimension, in table order."""
    week_in_month = whole_weeks(F.dayofmonth(day)) + 1
    return {
        "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "day_name_en": F.date_format(day, "EEEE"),
        "day_name_nl": F.element_at(F.array(*map(F.lit, DUTCH_DAYS)), monday_first(day)),
        "day_of_week": monday_first(day),
        "day_of_week_in_month": week_in_month,
        "day_of_week_in_year": F.dayofyear(day),
        "day_of_quarter": F.date_diff(day, F.trunc(day, "quarter")) + 1,
        "day_of_year": F.dayofyear(day),
        "week_of_month": week_in_month,
        "week_of_quarter": whole_weeks(F.dayofyear(day)) % 13 + 1,
        "week_of_year": F.weekofyear(day),
        "month": F.month(day),
        "month_name_en": F.date_format(day, "MMMM"),
        "month_name_nl": F.element_at(F.array(*map(F.lit, DUTCH_MONTHS)), F.month(day)),
        "month_of_quarter": (F.month(day) - 1) % 3 + 1,
        "quarter": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "year": F.year(day),
        "month_year": F.date_format(day, "MM-yyyy"),
        "mmyyyy": F.date_format(day, "MMyyyy"),
        "is_weekend": F.weekday(day) >= 5,
    }


def iso_year(day: Column) -> Column:
    """Year that owns the ISO week of ``day`` (the year of that week's Thursday)."""
    return F.year(F.date_add(day, F.lit(3) - F.weekday(day)))


def period_start(as_of: Column, period: str) -> Column:
    """First day of the day, ISO week, month or year holding ``as_of``."""
    if period not in PERIODS:
        raise ValueError(f"period must be one of {sorted(PERIODS)}, got {period!r}")
    if period == "day":
        return as_of.cast("date")
    return F.trunc(as_of.cast("date"), PERIODS[period])


def season(month: Column) -> Column:
    """Meteorological season of a month number."""
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


SEASON_ORDER = ["Winter", "Spring", "Summer", "Autumn"]


def month_number(abbreviation: Column) -> Column:
    """'sep' to 9; unknown abbreviations become NULL."""
    return map_values(F.lower(F.trim(abbreviation)), MONTH_NUMBERS)


def two_digit_year(text: Column) -> Column:
    return F.lit(2000) + text.cast("int")


def short_period(period: Column) -> Column:
    """'09/2025' to 'sep/25'; NULL where the month is not 01..12."""
    names = F.array(*(F.lit(m) for m in _short_months()))
    number = F.regexp_extract(period, r"^(\d{2})/\d{4}$", 1)
    year = F.regexp_extract(period, r"^\d{2}/\d{2}(\d{2})$", 1)
    month = F.when(number != "", number.cast("int"))
    return F.when(
        month.between(1, 12), F.concat_ws("/", F.get(names, month - 1), year)
    )


def _short_months() -> list[str]:
    return [next(k for k, v in MONTH_NUMBERS.items() if v == n) for n in range(1, 13)]


def rank_in(order: list[str], value: Column) -> Column:
    """Position of ``value`` in a domain order, for sorting Monday..Sunday or season order."""
    return F.array_position(F.array(*map(F.lit, order)), value).cast("int")
