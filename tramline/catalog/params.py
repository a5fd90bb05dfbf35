"""Parameterised queries on orders (counts per customer and day) and events (gauge)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tramline.catalog.base import Tables, date_key_sql, query
from tramline.functions import keys
from tramline.plans import queries


def _counts(t: Tables):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.select(
        F.col("o_custkey").alias("counting_point_id"), "o_orderdate",
        keys.date_key(F.col("o_orderdate")).alias("date_key"),
        cents.alias("total"),
        F.when(F.col("o_orderstatus") == "F", cents).otherwise(F.lit(0).cast("bigint")).alias("direction_in"),
        F.when(F.col("o_orderstatus") != "F", cents).otherwise(F.lit(0).cast("bigint")).alias("direction_out"),
    )


def _points(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("counting_point_id"), F.col("c_name").alias("counting_point_name"))


_COUNTS = f"""counts AS (SELECT o_custkey AS counting_point_id, {date_key_sql('o_orderdate')} AS date_key, round(o_totalprice * 100)::BIGINT AS total,
  CASE WHEN o_orderstatus = 'F' THEN round(o_totalprice * 100)::BIGINT ELSE 0 END AS direction_in, CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice * 100)::BIGINT ELSE 0 END AS direction_out FROM orders)"""
_SUMS = "coalesce(sum(total), 0)::BIGINT AS total, coalesce(sum(direction_in), 0)::BIGINT AS direction_in, coalesce(sum(direction_out), 0)::BIGINT AS direction_out"


@query(
    "totals_since_start",
    "Q1 F17 A2 X13",
    " UNION ALL ".join(
        f"SELECT * FROM (WITH {_COUNTS} SELECT 42 AS counting_point_id, '{p}' AS period, DATE '{s}' AS start_date, DATE '1999-08-18' AS end_date, {_SUMS} FROM counts WHERE counting_point_id = 42 AND date_key BETWEEN {s.replace('-', '')} AND 19990818)"
        for p, s in (("day", "1999-08-18"), ("week", "1999-08-16"), ("month", "1999-08-01"), ("year", "1999-01-01"))
    ),
)
def totals_since_start(t: Tables):
    frames = [queries.totals_since(_counts(t), 42, p, date(1999, 8, 18), _points(t), moment="o_orderdate") for p in ("day", "week", "month", "year")]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query(
    "totals_on_day",
    "Q2",
    f"WITH {_COUNTS} SELECT 42 AS counting_point_id, DATE '1998-10-03' AS day, {_SUMS} FROM counts WHERE counting_point_id = 42 AND date_key = 19981003",
)
def totals_on_day(t: Tables):
    return queries.totals_on(_counts(t), 42, date(1998, 10, 3), date(1999, 1, 1), _points(t), moment="o_orderdate")


@query(
    "wind_of_day",
    "Q3 C18 C20",
    """SELECT '7' AS weather_station_id, 'Supplier#000000007' AS name, round(avg(l_discount * 100), 6) AS avg_wind_speed_10m, max(l_quantity) AS max_wind_gusts_speed, DATE '1998-03-04' AS day
    FROM lineitem WHERE l_suppkey = 7 AND l_shipdate::DATE = DATE '1998-03-04'""",
)
def wind_of_day(t: Tables):
    weather = t.lineitem.select(
        F.col("l_suppkey").alias("weather_station_key"), "l_shipdate", keys.date_key(F.col("l_shipdate")).alias("date_key"),
        (F.col("l_discount") * 100).alias("wind_speed_10m"), F.col("l_quantity").alias("wind_gusts_speed"),
    )
    stations = t.supplier.select(F.col("s_suppkey").cast("string").alias("weather_station_id"), F.col("s_name").alias("name"))
    out = queries.wind_for_day(weather, stations, "7", date(1998, 3, 4), date(2000, 1, 1), "l_shipdate")
    return out.withColumn("avg_wind_speed_10m", F.round(F.col("avg_wind_speed_10m").cast("double"), 6))


@query(
    "availability_last_week",
    "Q4 P25 C20 A1",
    """SELECT c_custkey AS bike_station_key, c_name AS location_name, min(value) AS min_available, max(value) AS max_available, greatest(count(*), 1) AS measurements
    FROM customer LEFT JOIN (SELECT * FROM events WHERE date_trunc('minute', ts) BETWEEN TIMESTAMP '2024-01-13 15:40:00' AND TIMESTAMP '2024-01-20 15:40:00') ON user_id = c_custkey GROUP BY 1, 2""",
)
def availability_last_week(t: Tables):
    gauge = t.events.select(
        F.col("user_id").alias("bike_station_key"), "ts", keys.date_key(F.col("ts")).alias("date_key"), keys.time_key(F.col("ts")).alias("time_key"), F.col("value").alias("total_available")
    )
    stations = t.customer.select(F.col("c_custkey").alias("bike_station_key"), F.col("c_name").alias("location_name"))
    return queries.availability_window(gauge, stations, 7, datetime(2024, 1, 20, 15, 40), moment="ts")


@query(
    "health_census",
    "Q5 A26",
    "SELECT 'ok' AS status, TIMESTAMP '2024-01-20 12:00:00' AS checked_at, (SELECT count(*) FROM customer) AS points, (SELECT count(*) FROM supplier) AS weather_stations, (SELECT count(*) FROM part) AS bike_stations",
)
def health_census(t: Tables):
    return queries.health({"points": t.customer, "weather_stations": t.supplier, "bike_stations": t.part}, datetime(2024, 1, 20, 12))


@query("point_listing", "Q6 Q7 Q8 P1 T1", "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_name")
def point_listing(t: Tables):
    return queries.listing(t.customer, ["c_custkey", "c_name", "c_nationkey"], "c_name")


@query(
    "busiest_points",
    "Q9 T2",
    f"""WITH {_COUNTS}, d AS (SELECT counting_point_id, sum(total)::BIGINT AS total FROM counts WHERE date_key = 19981003 GROUP BY 1)
    SELECT counting_point_id, c_name AS counting_point_name, total FROM d JOIN customer ON c_custkey = counting_point_id ORDER BY total DESC, 1 LIMIT 10""",
)
def busiest_points(t: Tables):
    return queries.top_points(_counts(t), _points(t), date(1998, 10, 3), 10, date(1999, 1, 1), moment="o_orderdate")


@query("point_detail", "Q10", "SELECT * FROM customer WHERE c_custkey = 42")
def point_detail(t: Tables):
    return queries.detail(t.customer, "c_custkey", 42)


# --- control queries on the shared tables -------------------------------------------------


@query(
    "control_counts",
    "Q11 A1 C1 P19",
    """SELECT r_name, count(c_custkey) AS customers, count(c_custkey) FILTER (lower(c_name) LIKE '%customer#00000%') AS named, count(c_custkey) FILTER (NOT c_acctbal > 0) AS not_above, count(DISTINCT c_mktsegment) AS segments
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
)
def control_counts(t: Tables):
    placed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return placed.groupBy("r_name").agg(
        F.count("c_custkey").alias("customers"),
        F.count_if(F.col("c_name").ilike("%CUSTOMER#00000%")).alias("named"),
        F.count_if(~(F.col("c_acctbal") > 0)).alias("not_above"),
        F.count_distinct("c_mktsegment").alias("segments"),
    )


@query(
    "control_extremes",
    "Q11 A1 P21",
    f"""SELECT c_name, count(*) AS rows, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total, max(o_totalprice) AS max_in, min(o_totalprice) AS min_out
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE {date_key_sql('o_orderdate')} BETWEEN 19980000 AND 19989999 GROUP BY 1""",
)
def control_extremes(t: Tables):
    low, high = keys.month_bounds(1998)
    year = t.orders.filter(keys.date_key(F.col("o_orderdate")).between(low, high))
    per = year.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"),
        F.max("o_totalprice").alias("max_in"), F.min("o_totalprice").alias("min_out"),
    )
    return per.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_name", "rows", "total", "max_in", "min_out")


@query(
    "control_yearly_average",
    "Q11 A3 X1",
    """SELECT c_mktsegment, year(o_orderdate)::INT AS year, (sum(round(o_totalprice)::BIGINT) // count(*))::BIGINT AS mean_price, count(DISTINCT o_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def control_yearly_average(t: Tables):
    rows = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    price = F.round("o_totalprice").cast("bigint")
    return rows.groupBy("c_mktsegment", F.year("o_orderdate").alias("year")).agg(
        F.call_function("div", F.sum(price), F.count(F.lit(1))).cast("bigint").alias("mean_price"), F.count_distinct("o_custkey").alias("customers")
    )
