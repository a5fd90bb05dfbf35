"""Parameterised reports called as SQL table functions, by constants and for all rows of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import Tables, query
from tramline.plans import table_functions


def _register(t: Tables) -> None:
    k = F.get_json_object("props", "$.k").cast("double")
    table_functions.register_rentals(
        t.events.select(F.col("event_id").alias("reading"), F.col("user_id").alias("station"), F.col("ts").alias("moment"), F.col("value").alias("in_use"), k.alias("electric"), F.col("value").alias("classic"))
    )


_STEPPED = """g AS (SELECT event_id, user_id, ts, ts::DATE AS day, value, (props->>'k')::DOUBLE AS k FROM events),
steps AS (SELECT *, lag(value) OVER w AS pv, lag(k) OVER w AS pk FROM g WINDOW w AS (PARTITION BY user_id, day ORDER BY ts, event_id))"""
_HOURS = f"""WITH {_STEPPED}, hours AS (SELECT user_id, day, hour(ts)::INT AS hour, isodow(day) >= 6 AS is_weekend, sum(greatest(value - pv, 0)) AS rentals FROM steps WHERE pv IS NOT NULL GROUP BY ALL)"""


@query(
    "rentals_per_hour_function",
    "J4 M5 A8 W1",
    f"""{_HOURS} SELECT 3::BIGINT AS station, hour, is_weekend, round(avg(rentals), 6) AS mean_rentals FROM hours WHERE user_id = 3 AND day >= DATE '2024-01-01' AND day < DATE '2024-02-01' GROUP BY ALL
    UNION ALL SELECT 8, hour, is_weekend, round(avg(rentals), 6) FROM hours WHERE user_id = 8 AND year(day) = 2024 GROUP BY ALL""",
)
def rentals_per_hour_function(t: Tables):
    """One station's month, and another's whole year (the month left out)."""
    _register(t)
    return t.spark.sql(
        "SELECT 3L AS station, hour, is_weekend, round(mean_rentals, 6) AS mean_rentals FROM rentals_per_hour(3, 2024, 1) UNION ALL SELECT 8L, hour, is_weekend, round(mean_rentals, 6) FROM rentals_per_hour(8, 2024)"
    )


@query(
    "rentals_per_hour_of_all",
    "J4 M5 A8 W1 C1",
    f"""{_HOURS} SELECT c_name, hour, is_weekend, round(avg(rentals), 6) AS mean_rentals FROM hours JOIN customer ON user_id = c_custkey WHERE day >= DATE '2024-01-01' AND day < DATE '2024-02-01' GROUP BY ALL""",
)
def rentals_per_hour_of_all(t: Tables):
    """The function for every station of a table."""
    _register(t)
    t.customer.createOrReplaceTempView("stations_asked")
    return t.spark.sql("SELECT c_name, h.hour, h.is_weekend, round(h.mean_rentals, 6) AS mean_rentals FROM stations_asked, LATERAL rentals_per_hour(c_custkey, 2024, 1) h")


@query(
    "rentals_per_day_function",
    "J4 M6 W3",
    f"""WITH {_STEPPED}, days AS (SELECT user_id AS station, day, round(sum(CASE WHEN pk > k THEN pk - k ELSE 0 END), 4) AS electric, round(sum(CASE WHEN pv > value THEN pv - value ELSE 0 END), 4) AS classic
      FROM steps WHERE pv IS NOT NULL OR pk IS NOT NULL GROUP BY ALL)
    SELECT station, (year(day) * 10000 + month(day) * 100 + day(day))::INT AS date_key, day(day)::INT AS day_of_month, strftime(day, '%d-%m') AS label, electric, classic FROM days
    WHERE (station = 3 AND year(day) = 2024) OR (station = 8 AND day >= DATE '2024-01-01' AND day < DATE '2024-02-01')""",
)
def rentals_per_day_function(t: Tables):
    _register(t)
    return t.spark.sql(
        """SELECT station, date_key, day_of_month, label, round(electric, 4) AS electric, round(classic, 4) AS classic FROM (
        SELECT 3L AS station, * FROM rentals_per_day(3, 2024, CAST(NULL AS INT)) UNION ALL SELECT 8L, * FROM rentals_per_day(8, 2024, 1))"""
    )


_STANDING = """m AS (SELECT c_name, round(avg(value), 6) AS mean_rentals FROM events JOIN customer ON user_id = c_custkey GROUP BY 1),
r AS (SELECT c_name, mean_rentals, rank() OVER (ORDER BY mean_rentals DESC) AS rank, round(rank() OVER (ORDER BY mean_rentals DESC) * 100.0 / count(*) OVER (), 6) AS top_percent FROM m)"""


def _register_top(t: Tables) -> None:
    named = t.events.join(t.customer.select("c_custkey", "c_name"), F.col("user_id") == F.col("c_custkey"))
    table_functions.register_top_percentage(named.groupBy(F.col("c_name").alias("station_name")).agg(F.round(F.avg("value"), 6).alias("mean_rentals")))


@query(
    "top_percentage_function",
    "J4 M3 W8",
    f"""WITH {_STANDING} SELECT c_name AS name, mean_rentals, rank, top_percent FROM r WHERE c_name IN ('Customer#000000003', 'Customer#000000008')""",
)
def top_percentage_function(t: Tables):
    """Two names, and one that no station has."""
    _register_top(t)
    names = ("Customer#000000003", "Customer#000000008", "nowhere")
    calls = " UNION ALL ".join(f"SELECT '{n}' AS name, mean_rentals, rank, round(top_percent, 6) AS top_percent FROM top_percentage('{n}')" for n in names)
    return t.spark.sql(calls)


@query("top_percentage_of_all", "J4 M3 W8 C1", f"WITH {_STANDING} SELECT c_name AS name, rank, top_percent FROM r")
def top_percentage_of_all(t: Tables):
    """The function for every station of a table."""
    _register_top(t)
    t.customer.createOrReplaceTempView("stations_asked")
    return t.spark.sql("SELECT c_name AS name, p.rank, round(p.top_percent, 6) AS top_percent FROM stations_asked, LATERAL top_percentage(c_name) p")
