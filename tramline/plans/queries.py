"""Parameterised queries. The as-of moment is always an argument."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import dates, keys
from tramline.operators.aggregates import top_n, total_or_zero

MAX_TOP = 1000
_DIRECTIONS = ["total", "direction_in", "direction_out"]


class UnknownId(LookupError):
    """The asked entity does not exist."""


def require_id(dim: DataFrame, column: str, value: object) -> None:
    if dim.filter(F.col(column) == F.lit(value)).select(column).limit(1).isEmpty():
        raise UnknownId(f"{column} {value!r} does not exist")


def _stored(moment: str | None, first: Column, last: Column) -> Column:
    """The same days on the stored moment that a computed day key comes from; true without one."""
    return F.lit(True) if moment is None else keys.on_days(F.col(moment), first, last)


def detail(dim: DataFrame, column: str, value: object) -> DataFrame:
    """The one row of an id; an unknown id is an error."""
    require_id(dim, column, value)
    return dim.filter(F.col(column) == F.lit(value)).limit(1)


def totals_since(
    counts: DataFrame, point: object, period: str, as_of: date, points: DataFrame | None = None,
    id_column: str = "counting_point_id", day_key: str = "date_key", moment: str | None = None,
) -> DataFrame:
    """Totals from the start of the day, week, month or year up to ``as_of``; 0 if nothing was counted."""
    if points is not None:
        require_id(points, id_column, point)
    today = F.lit(as_of)
    start = dates.period_start(today, period)
    chosen = counts.filter(
        (F.col(id_column) == F.lit(point)) & F.col(day_key).between(keys.date_key(start), keys.date_key(today)) & _stored(moment, start, today)
    )
    return chosen.agg(*(total_or_zero(c).alias(c) for c in _DIRECTIONS if c in counts.columns)).select(
        F.lit(point).alias(id_column), F.lit(period).alias("period"), start.alias("start_date"), today.alias("end_date"), "*"
    )


def totals_on(
    counts: DataFrame, point: object, day: date, as_of: date, points: DataFrame | None = None,
    id_column: str = "counting_point_id", day_key: str = "date_key", moment: str | None = None,
) -> DataFrame:
    """Totals of one past day."""
    if day >= as_of:
        raise ValueError("day must lie before the as-of date")
    if points is not None:
        require_id(points, id_column, point)
    chosen = counts.filter((F.col(id_column) == F.lit(point)) & (F.col(day_key) == keys.date_key(F.lit(day))) & _stored(moment, F.lit(day), F.lit(day)))
    return chosen.agg(*(total_or_zero(c).alias(c) for c in _DIRECTIONS if c in counts.columns)).select(
        F.lit(point).alias(id_column), F.lit(day).alias("day"), "*"
    )


def wind_for_day(weather: DataFrame, stations: DataFrame, station: str, day: date, as_of: date, moment: str | None = None) -> DataFrame:
    """Mean 10 m wind speed and strongest gust of a station; NULLs if the day has no reading."""
    if day > as_of:
        raise ValueError("day must not lie after the as-of date")
    require_id(stations, "weather_station_id", station)
    readings = weather.filter((F.col("date_key") == keys.date_key(F.lit(day))) & _stored(moment, F.lit(day), F.lit(day))).select(
        F.col("weather_station_key").cast("string").alias("__id"), "wind_speed_10m", "wind_gusts_speed"
    )
    chosen = stations.filter(F.col("weather_station_id") == F.lit(station))
    return (
        chosen.join(readings, F.col("weather_station_id") == F.col("__id"), "left")
        .groupBy("weather_station_id", "name")
        .agg(
            F.avg(F.col("wind_speed_10m").cast("decimal(10,2)")).alias("avg_wind_speed_10m"),
            F.max("wind_gusts_speed").alias("max_wind_gusts_speed"),
        )
        .withColumn("day", F.lit(day))
    )


def in_last_days(day_key: Column, clock_key: Column, as_of: datetime, days: int, moment: Column | None = None) -> Column:
    """True from ``days`` before ``as_of`` (to the minute) up to ``as_of``.

    The bounds are plain key literals: on stored keys the day range reaches the scan, and the minute
    test trims the first and the last day. Where the keys are computed, ``moment`` is the column stored.
    """
    high = keys.wall_clock(as_of)
    low = high - F.expr(f"interval {days} days")
    lo_day, hi_day = keys.date_key(low), keys.date_key(high)
    minute = keys.time_key(high)
    stored = F.lit(True) if moment is None else keys.on_days(moment, low.cast("date"), high.cast("date"))
    return (
        stored
        & day_key.between(lo_day, hi_day)
        & ((day_key > lo_day) | (clock_key >= minute))
        & ((day_key < hi_day) | (clock_key <= minute))
    )


def availability_window(
    gauge: DataFrame, stations: DataFrame, days: int, as_of: datetime, value: str = "total_available",
    station: str = "bike_station_key", day_key: str = "date_key", clock_key: str = "time_key", moment: str | None = None,
) -> DataFrame:
    """Lowest and highest availability per station in the last days, stations without data kept.

    ``measurements`` counts joined rows, so a station without readings shows 1. Readings are
    aggregated before the join.
    """
    recent = gauge.filter(in_last_days(F.col(day_key), F.col(clock_key), as_of, days, F.col(moment) if moment else None))
    stats = recent.groupBy(F.col(station).alias("__s")).agg(
        F.min(value).alias("min_available"), F.max(value).alias("max_available"), F.count(F.lit(1)).alias("__n")
    )
    return (
        stations.join(stats, F.col(station) == F.col("__s"), "left")
        .withColumn("measurements", F.coalesce("__n", F.lit(1)))
        .drop("__s", "__n")
        .orderBy(station)
    )


def health(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Status row with the row count of every dimension, counted side by side."""
    spark = next(iter(tables.values())).sparkSession
    counts = {n: df.agg(F.count(F.lit(1))).scalar() for n, df in tables.items()}
    return spark.range(1).select(
        F.lit("ok").alias("status"), keys.wall_clock(as_of).alias("checked_at"), *(c.alias(n) for n, c in counts.items())
    )


def listing(dim: DataFrame, columns: list[str], order: str) -> DataFrame:
    return dim.select(*columns).orderBy(order)


def top_points(
    counts: DataFrame, points: DataFrame, day: date, n: int, as_of: date,
    id_column: str = "counting_point_id", name: str = "counting_point_name", value: str = "total", day_key: str = "date_key",
    moment: str | None = None,
) -> DataFrame:
    """Busiest points of a day. Counts are summed before the dimension is joined."""
    if not 1 <= n <= MAX_TOP:
        raise ValueError(f"n must lie between 1 and {MAX_TOP}")
    if day > as_of:
        raise ValueError("day must not lie after the as-of date")
    sums = (
        counts.filter((F.col(day_key) == keys.date_key(F.lit(day))) & _stored(moment, F.lit(day), F.lit(day)))
        .groupBy(id_column)
        .agg(F.sum(value).alias(value))
    )
    named = sums.join(points.select(id_column, name), id_column).select(id_column, name, value)
    return top_n(named, value, n, [id_column])


# --- control queries ----------------------------------------------------------------------


def control_queries(t: Mapping[str, DataFrame], yesterday: date) -> dict[str, DataFrame]:
    """Named checks over the filled warehouse, in the order of the warehouse's tables."""

    def count(df: DataFrame, condition: Column | None = None) -> DataFrame:
        return (df if condition is None else df.filter(condition)).agg(F.count(F.lit(1)).alias("rows"))

    def per(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))

    def placed(dim: str) -> DataFrame:
        return t[dim].join(t["dim_location"].select("location_key", "postal_code", "municipality", "main_municipality", "province"), "location_key")

    def point_year(name: str, year: int) -> DataFrame:
        named = t["dim_counting_point"].filter(F.col("counting_point_name").ilike(f"%{name}%")).select("counting_point_id")
        return t["fact_counts"].filter(F.col("date_key").between(*keys.month_bounds(year))).join(named, "counting_point_id").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("total").alias("total"), F.max("direction_in").alias("max_in"), F.min("direction_out").alias("min_out")
        )

    weather = t["fact_weather"].join(
        t["dim_weather_station"].select(F.col("weather_station_id").alias("__w"), "name"),
        F.col("weather_station_key").cast("string") == F.col("__w"),
    )
    gauge = t["fact_bike_gauge"].join(t["dim_bike_station"].select("bike_station_key", "location_name"), "bike_station_key")
    points = t["dim_counting_point"].select("counting_point_id", "counting_point_name")
    counted = t["fact_counts"].join(points, "counting_point_id").select("date_key", "counting_point_name", "total")
    co2 = F.col("co2_per_km")
    heads = t["fact_department"].join(t["dim_department"].select("department_key", "department_name"), "department_key")
    trips = t["fact_worker_mobility"].join(t["dim_transport_type"].select("transport_key", "vehicle_type"), "transport_key")
    return {
        "days_since_2017": count(t["dim_date"], F.col("date_key") > 20161230),
        "minutes": count(t["dim_time"]),
        "weather_stations": count(t["dim_weather_station"]),
        "weather_stations_per_province": per(placed("dim_weather_station"), "province"),
        "station_extremes": weather.filter(F.col("name").ilike("zeebrugge")).agg(
            *(f(c).alias(f"{n}_{c}") for c in ("temp_avg", "temp_min", "temp_max") for n, f in (("max", F.max), ("min", F.min))),
            F.max("precip_quantity").alias("max_precip_quantity"),
        ),
        "readings_per_weather_station": per(weather.filter(F.col("date_key") >= 20200101), "name"),
        "transport_types": count(t["dim_transport_type"]),
        "transport_type_by_name": t["dim_transport_type"].filter(F.lower("vehicle_type") == "vliegtuig+700"),
        "transport_types_not_above": count(t["dim_transport_type"], ~(co2 > 0.2)),
        "transport_types_above": count(t["dim_transport_type"], co2 > 0.2),
        "bike_stations": count(t["dim_bike_station"]),
        "bike_stations_per_province": per(placed("dim_bike_station"), "province"),
        "bike_stations_in_city": count(placed("dim_bike_station"), F.col("municipality").ilike("%gent%")),
        "bike_stations_at_stations": count(t["dim_bike_station"], F.col("location_name").ilike("%station%")),
        "mean_availability_of_station": gauge.filter(F.lower("location_name") == "oostende station").agg(F.avg("total_available").alias("mean")),
        "gauge_rows": count(t["fact_bike_gauge"]),
        "gauge_rows_of_station": count(gauge, F.col("location_name").ilike("%gent-dampoort%")),
        "points": count(t["dim_counting_point"]),
        "points_in_postcode": count(placed("dim_counting_point"), F.col("postal_code").cast("string") == "9800"),
        "points_named": t["dim_counting_point"].filter(F.col("counting_point_name").ilike("%wervik%")),
        "points_in_towns": count(
            placed("dim_counting_point"),
            (F.col("main_municipality").ilike("sint-niklaas")) | (F.col("municipality").ilike("mechelen")),
        ),
        "points_per_province": per(placed("dim_counting_point"), "province"),
        "point_year_a": point_year("Fintele", 2025),
        "point_year_b": point_year("Jaagpad Bovenschelde", 2024),
        "busiest_day": counted.filter(F.col("total") == t["fact_counts"].agg(F.max("total")).scalar()),
        "zero_days": count(t["fact_counts"], F.col("total") == 0),
        "first_days_with_total": counted.filter(F.col("total") == 1230).orderBy("date_key", "counting_point_name").limit(5),
        "total_not_sum": count(
            t["fact_counts"],
            F.col("direction_in").isNotNull() & F.col("direction_out").isNotNull()
            & (F.col("total") != F.col("direction_in") + F.col("direction_out")),
        ),
        "staff": count(t["dim_staff"]),
        "staff_in_department": count(
            t["dim_staff"].join(t["dim_department"].filter(F.lower("department_name") == "alg"), "department_key", "left_semi")
        ),
        "staff_per_campus": per(t["dim_staff"], "campus"),
        "staff_listing": t["dim_staff"],
        "head_count_rows": count(t["fact_department"]),
        "head_count_on_day": heads.filter((F.col("date_key") == 20250101) & F.col("department_name").isin("DBO", "DIT", "DHR")),
        "head_count_per_year": heads.filter(F.col("department_name") == "DBO")
        .join(t["dim_date"].select("date_key", "year"), "date_key")
        .groupBy("year").agg(F.call_function("div", F.sum("workers"), F.count("workers")).alias("workers")),
        "workers": count(t["dim_worker"]),
        "workers_per_vehicle": trips.groupBy("vehicle_type").agg(F.count_distinct("worker_id").alias("workers")),
        "arrivals_yesterday": t["fact_train_arrivals"].filter(F.col("date_key") == keys.date_key(F.lit(yesterday)))
        .join(t["dim_station"].filter(F.col("station_name").ilike("%kortrijk%")), "station_key", "left_semi")
        .agg(F.sum("arrivals").alias("arrivals")),
    }
