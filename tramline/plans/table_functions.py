"""Parameterised reports as SQL table functions over views of a session.

A call with constants folds into the scan's filters. With ``LATERAL`` Spark rewrites the call into one join and one
aggregation for all rows of the calling table, so a report for every station is one job, not one per station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tramline.operators.windows import standing

#: From the first day of the month (of the year, if month is NULL) to the first day of the next.
_PERIOD = """moment >= CAST(make_date(year, coalesce(month, 1), 1) AS TIMESTAMP_NTZ)
    AND moment < CAST(add_months(make_date(year, coalesce(month, 1), 1), if(month IS NULL, 12, 1)) AS TIMESTAMP_NTZ)"""

_STEPS = "OVER (PARTITION BY station, CAST(moment AS DATE) ORDER BY moment, reading)"


def register_rentals(gauge: DataFrame, prefix: str = "") -> None:
    """``rentals_per_hour`` and ``rentals_per_day`` (station, year, month or NULL) over gauge readings.

    ``gauge``: reading (unique, orders equal moments), station, moment, in_use, electric, classic. The first
    reading of a day has none before it and does not count.
    """
    spark = gauge.sparkSession
    view = f"{prefix}gauge_readings"
    gauge.createOrReplaceTempView(view)
    parameters = "id BIGINT, year INT, month INT DEFAULT NULL"
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {prefix}rentals_per_hour({parameters})
      RETURNS TABLE (hour INT, is_weekend BOOLEAN, mean_rentals DOUBLE) RETURN
      SELECT hour, is_weekend, avg(rentals) FROM (
        SELECT day, hour, weekday(day) >= 5 AS is_weekend, sum(greatest(in_use - before, 0)) AS rentals FROM (
          SELECT CAST(moment AS DATE) AS day, hour(moment) AS hour, in_use, lag(in_use) {_STEPS} AS before FROM {view} WHERE station = id AND {_PERIOD})
        WHERE before IS NOT NULL GROUP BY day, hour)
      GROUP BY hour, is_weekend""")
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {prefix}rentals_per_day({parameters})
      RETURNS TABLE (date_key INT, day_of_month INT, label STRING, electric DOUBLE, classic DOUBLE) RETURN
      SELECT year(day) * 10000 + month(day) * 100 + day(day), day(day), date_format(day, 'dd-MM'),
        sum(if(electric_before > electric, electric_before - electric, 0)), sum(if(classic_before > classic, classic_before - classic, 0)) FROM (
          SELECT CAST(moment AS DATE) AS day, electric, classic, lag(electric) {_STEPS} AS electric_before, lag(classic) {_STEPS} AS classic_before
          FROM {view} WHERE station = id AND {_PERIOD})
      WHERE electric_before IS NOT NULL OR classic_before IS NOT NULL GROUP BY day""")


def register_top_percentage(means: DataFrame, prefix: str = "") -> None:
    """``top_percentage(name)``: mean, competition rank and rank as a share of all stations.

    ``means``: station_name, mean_rentals. All stations of a name answer; an unknown name gives no row.
    """
    view = f"{prefix}station_standing"
    standing(means, "mean_rentals").createOrReplaceTempView(view)
    means.sparkSession.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION {prefix}top_percentage(name STRING)
      RETURNS TABLE (mean_rentals DOUBLE, rank BIGINT, top_percent DOUBLE) RETURN
      SELECT mean_rentals, rank, top_percent FROM {view} WHERE station_name = name""")
