"""Analysis reports over any table with the named columns.

``split`` columns (see operators.windows) keep the gauge reports parallel for hot stations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import dates, values
from tramline.operators import aggregates, quantiles, windows
from tramline.plans.stats import t_test

Names = Sequence[str]


def weekday_profile(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Truncated mean per weekday, Monday first."""
    return (
        daily.groupBy(dates.monday_first(F.col(day)).alias("day_of_week"))
        .agg(values.truncated_average(F.col(value)).alias("mean_value"))
        .orderBy("day_of_week")
    )


def weekly_rises(gauge: DataFrame, station: str, moment: str, value: str, split: Names = (), tie: Names = ()) -> DataFrame:
    """Estimated rentals per station, calendar year and ISO week."""
    delta = windows.positive_delta(gauge, [station], [moment, *tie], value, "rise", "rise", "zero", split)
    return delta.groupBy(
        station, F.year(moment).alias("year"), F.weekofyear(moment).alias("week")
    ).agg(F.sum("rise").alias("rentals"))


def mean_per_week(gauge: DataFrame, station: str, moment: str, value: str, split: Names = (), tie: Names = ()) -> DataFrame:
    weekly = weekly_rises(gauge, station, moment, value, split, tie)
    return weekly.groupBy(station).agg(F.avg("rentals").alias("mean_rentals"), F.count(F.lit(1)).alias("weeks"))


def rain_days(weather: DataFrame, region: str, day: str, rain: str) -> DataFrame:
    """Days on which any station of a region saw rain, dry days and the rain share."""
    per_day = weather.groupBy(region, day).agg(F.bool_or(F.coalesce(F.col(rain) > 0, F.lit(False))).alias("wet"))
    return per_day.groupBy(region).agg(
        F.count_if("wet").alias("rain_days"),
        F.count_if(~F.col("wet")).alias("dry_days"),
        F.count(F.lit(1)).alias("days"),
        (F.count_if("wet") / F.count(F.lit(1)) * 100).alias("rain_pct"),
    )


def hourly_profile(
    gauge: DataFrame, station: str, moment: str, value: str, split: Names = (), tie: Names = ()
) -> DataFrame:
    """Mean rises per hour of the day on working days and weekends, per station."""
    daily = gauge.withColumn("__day", F.col(moment).cast("date"))
    delta = windows.positive_delta(daily, [station, "__day"], [moment, *tie], value, "rise", "rise", "zero", split)
    hourly = delta.withColumns({"hour": F.hour(moment), "is_weekend": F.weekday("__day") >= 5})
    return aggregates.mean_of_totals(
        hourly, [station, "__day", "hour", "is_weekend"], [station, "hour", "is_weekend"], "rise", "mean_rentals"
    )


def daily_rises(gauge: DataFrame, station: str, moment: str, value: str, split: Names = (), tie: Names = ()) -> DataFrame:
    """Rises per station and day; the first reading of a day counts as none."""
    daily = gauge.withColumn("day", F.col(moment).cast("date"))
    delta = windows.positive_delta(daily, [station, "day"], [moment, *tie], value, "rise", "rise", "zero", split)
    return delta.groupBy(station, "day").agg(F.sum("rise").alias("rentals"), F.count(F.lit(1)).alias("readings"))


def daily_falls(
    gauge: DataFrame, station: str, moment: str, gauges: dict[str, str], split: Names = (), tie: Names = ()
) -> DataFrame:
    """Falls per day of several gauges at once, ``{output: gauge column}``."""
    daily = gauge.withColumn("day", F.col(moment).cast("date"))
    prev = {f"__{g}": g for g in gauges.values()}
    stepped = windows.lagged(daily, [station, "day"], [moment, *tie], prev, split)
    falls = {
        out: F.sum(F.when(F.col(f"__{g}") > F.col(g), F.col(f"__{g}") - F.col(g)).otherwise(F.lit(0)))
        for out, g in gauges.items()
    }
    return stepped.groupBy(station, "day").agg(*(c.alias(o) for o, c in falls.items()))


def season_means(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Truncated mean per year and season, in season order."""
    named = daily.select(F.year(day).alias("year"), dates.season(F.month(day)).alias("season"), value)
    means = named.groupBy("year", "season").agg(values.truncated_average(F.col(value)).alias("mean_value"))
    return means.orderBy("year", dates.rank_in(dates.SEASON_ORDER, F.col("season")))


def season_profile(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Mean, median and quartiles of the daily values per season."""
    named = daily.select(dates.season(F.month(day)).alias("season"), value)
    means = named.groupBy("season").agg(F.avg(value).alias("mean"))
    cuts = quantiles.exact_quantiles(named, ["season"], value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return means.join(cuts, "season")


def season_tests(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Pooled t-tests between all pairs of seasons."""
    named = daily.select(dates.season(F.month(day)).alias("season"), value)
    order = dates.SEASON_ORDER
    pairs = [(a, b) for i, a in enumerate(order) for b in order[i + 1 :]]
    return t_test(named, "season", value, pairs, equal_var=True)


def emissions_per_person(trips: DataFrame, person: str, distance: str, rate: str) -> DataFrame:
    """Distance times rate, summed per person."""
    return trips.groupBy(person).agg(F.sum(F.col(distance) * F.col(rate)).alias("emission"))


def compare_populations(per_person: DataFrame, population: str, value: str, first: str, second: str) -> DataFrame:
    """Welch test between two populations."""
    return t_test(per_person, population, value, [(first, second)], equal_var=False)


def modal_split(trips: DataFrame, population: Names, vehicle: str) -> DataFrame:
    return aggregates.share_of_categories(trips, population, vehicle)


def mean_km_per_employee(commutes: DataFrame, by: Names, employee: str, km: str) -> DataFrame:
    """Kilometres per distinct employee of a group: totals per employee first, then over them."""
    per_employee = commutes.groupBy(*by, employee).agg(F.sum(km).alias("__km"))
    return per_employee.groupBy(*by).agg(
        F.sum("__km").alias("total_km"),
        F.count(employee).alias("employees"),
        (F.sum("__km") / F.count(employee)).alias("km_per_employee"),
    )


def quarter_totals(daily: DataFrame, day: str, value: str) -> DataFrame:
    return daily.groupBy(F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(
        F.sum(value).alias("total"), F.avg(value).alias("mean")
    )


def quarter_correlation(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Correlation of the quarterly totals with each quarter's 0/1 column."""
    totals = quarter_totals(daily, day, value)
    coded = totals.select(F.col("total").cast("double").alias("total"), *values.one_hot(F.col("quarter"), [1, 2, 3, 4], "q"))
    return aggregates.correlations(coded, ["total", "q1", "q2", "q3", "q4"])


def weather_correlation_raw(
    counts: DataFrame, weather: DataFrame, day: str, count: str, measures: Names
) -> DataFrame:
    """Correlation of daily sums with weather means after joining raw rows on the day.

    The sum is multiplied by the number of stations reporting that day, as in the report this
    follows. Both sides are aggregated per day before the join; the factor is put back as a
    product, so the many-to-many rows never exist.
    """
    left = counts.groupBy(day).agg(F.sum(count).alias("__sum"))
    right = weather.groupBy(day).agg(F.count(F.lit(1)).alias("__stations"), *(F.avg(m).alias(m) for m in measures))
    joined = left.join(right, day).select((F.col("__sum") * F.col("__stations")).cast("double").alias(count), *measures)
    return aggregates.correlations(joined, [count, *measures])


def weather_correlation(counts: DataFrame, weather: DataFrame, day: str, count: str, measures: Names) -> DataFrame:
    """The same without the station factor."""
    left = counts.groupBy(day).agg(F.sum(count).cast("double").alias(count))
    right = weather.groupBy(day).agg(*(F.avg(m).alias(m) for m in measures))
    return aggregates.correlations(left.join(right, day), [count, *measures])


def growth(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Yearly totals with change, growth since the first year and compound growth."""
    yearly = daily.groupBy(F.year(day).alias("year")).agg(F.sum(value).alias("total"))
    whole = windows.compound_growth(yearly, "year", "total").select("cagr_pct").scalar()
    return windows.year_over_year(yearly, "year", "total").withColumn("cagr_pct", whole)


def quarter_shares(daily: DataFrame, day: str, value: str) -> DataFrame:
    """Each quarter's part of its year's total, one column per quarter."""
    shares = windows.share(quarter_totals(daily, day, value), ["year"], "total")
    return aggregates.value_pivot(
        shares.withColumn("q", F.concat(F.lit("q"), F.col("quarter"))), ["year"], "q", "share", ["q1", "q2", "q3", "q4"]
    )


def activity_profile(
    gauge: DataFrame, station: str, moment: str, value: str, split: Names = (), tie: Names = ()
) -> DataFrame:
    """Total, rush-hour, weekday and weekend rentals of active stations, with their ratios."""
    daily = gauge.withColumn("__day", F.col(moment).cast("date"))
    delta = windows.positive_delta(daily, [station, "__day"], [moment, *tie], value, "rise", "rise", "zero", split)
    hour, weekend = F.hour(moment), F.weekday("__day") >= 5

    def part(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("rise")).otherwise(F.lit(0.0)))

    # Per day first: the number of active days then needs no DISTINCT.
    per_day = delta.groupBy(station, "__day").agg(
        F.sum("rise").alias("total"),
        part(hour.between(6, 9)).alias("morning"),
        part(hour.between(16, 19)).alias("evening"),
        part(~weekend).alias("weekday"),
        part(weekend).alias("weekend"),
    )
    sums = ["total", "morning", "evening", "weekday", "weekend"]
    stations = per_day.groupBy(station).agg(*(F.sum(c).alias(c) for c in sums), F.count(F.lit(1)).alias("active_days"))
    total = F.col("total")
    return stations.filter(total > 0).withColumns(
        {
            "rush_ratio": (F.col("morning") + F.col("evening")) / total,
            "weekend_ratio": F.col("weekend") / total,
            "rentals_per_day": total / F.col("active_days"),
        }
    )


def mean_in_use(gauge: DataFrame, station: str, moment: str, value: str) -> DataFrame:
    return gauge.groupBy(station, F.col(moment).cast("date").alias("day")).agg(F.avg(value).alias("mean_in_use"))
