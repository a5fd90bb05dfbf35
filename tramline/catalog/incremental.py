"""Staging, promotion and incremental loads."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tramline.catalog.base import STAGING, Tables, date_key_sql, query, time_key_sql
from tramline.functions.keys import wall_clock
from tramline.operators import incremental, reshape
from tramline.plans.builders import replace_month
from tramline.streaming import arrivals

_AS_OF = datetime(2024, 1, 20, 12, 0)
_WINDOWS = f"""{STAGING}, rows AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, actual) AS ws, actual < TIMESTAMP '2024-01-20 10:30:00' AND last_updated < TIMESTAMP '2024-01-20 10:30:00' AS stable FROM staging),
verdict AS (SELECT ws, bool_and(stable) AS ok FROM rows GROUP BY 1)"""


@query(
    "upserted_staging",
    "R1 C7",
    """SELECT event_id, user_id, event_type, CASE WHEN event_type = 'error' THEN value + 1000 ELSE value END AS value FROM events WHERE event_id % 3 <> 0 OR event_type = 'error'""",
)
def upserted_staging(t: Tables):
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    staged = rows.filter("event_id % 3 <> 0")
    updates = rows.filter("event_type = 'error'").withColumn("value", F.col("value") + 1000)
    return incremental.upsert(staged, updates, ["event_id", "user_id"])


@query(
    "newest_versions",
    "R1 R13 P10",
    """SELECT user_id, event_type, max(ts) AS ts, max_by(value, row(ts, event_id)) AS value, max_by(event_id, row(ts, event_id)) AS event_id FROM events GROUP BY 1, 2""",
)
def newest_versions(t: Tables):
    return incremental.newest_version(t.events.select("user_id", "event_type", "ts", "value", "event_id"), ["user_id", "event_type"], "ts", ["event_id"])


@query(
    "window_verdicts",
    "R2 R3 R4 C22 W15",
    f"""WITH {_WINDOWS} SELECT train_id, ws AS window_start, stable AS is_stable, ok AS window_stable FROM rows JOIN verdict USING (ws)""",
)
def window_verdicts(t: Tables):
    out = arrivals.with_windows(t.staging, wall_clock(_AS_OF))
    return out.select("train_id", "window_start", "is_stable", "window_stable")


@query(
    "promoted_arrivals",
    "R5 R6 R7 C10 B16",
    f"""WITH {_WINDOWS}, n AS (SELECT station_key, ws, count(*) FILTER (NOT canceled) AS n FROM rows JOIN verdict USING (ws) WHERE ok GROUP BY 1, 2)
    SELECT s.station_key, {date_key_sql('ws')} AS date_key, {time_key_sql('ws')} AS start_time, {time_key_sql('(ws + INTERVAL 30 MINUTE)')} AS end_time, coalesce(n, 0)::INT AS arrivals
    FROM (SELECT DISTINCT station_key FROM staging) s CROSS JOIN (SELECT ws FROM verdict WHERE ok) v LEFT JOIN n USING (station_key, ws)""",
)
def promoted_arrivals(t: Tables):
    fact, _ = arrivals.promote(t.staging, t.staging.select("station_key"), _AS_OF)
    return fact


@query(
    "remaining_staging",
    "R5 R8",
    f"""WITH {_WINDOWS} SELECT train_id, station_key, date_key, time_key, delay, canceled, last_updated FROM rows JOIN verdict USING (ws) WHERE NOT ok""",
)
def remaining_staging(t: Tables):
    _, remaining = arrivals.promote(t.staging, t.staging.select("station_key"), _AS_OF)
    return remaining


@query(
    "slot_arrivals",
    "R9 F23",
    f"""WITH {STAGING} SELECT station_key, count(*)::INT AS arrivals FROM staging WHERE actual >= TIMESTAMP '2024-01-15 08:00:00' AND actual < TIMESTAMP '2024-01-15 20:00:00' AND NOT canceled GROUP BY 1""",
)
def slot_arrivals(t: Tables):
    return arrivals.slot_counts(t.staging, datetime(2024, 1, 15, 8), 720)


@query(
    "periods_to_load",
    "R11 T6 F10",
    """WITH p AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders),
    l AS (SELECT DISTINCT o_custkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month FROM orders WHERE o_orderkey % 2 = 0)
    SELECT * FROM p WHERE (year < 2000 AND (o_custkey, year) NOT IN (SELECT (o_custkey, year) FROM l)) OR (year = 2000 AND month < 6 AND (o_custkey, year, month) NOT IN (SELECT (o_custkey, year, month) FROM l)) OR (year = 2000 AND month = 6)""",
)
def periods_to_load(t: Tables):
    keyed = t.orders.select("o_orderkey", "o_custkey", (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + 1).alias("date_key"))
    requested = incremental.loaded_periods(keyed, "o_custkey")
    loaded = incremental.loaded_periods(keyed.filter("o_orderkey % 2 = 0"), "o_custkey")
    return incremental.prune_loaded_periods(requested, loaded, "o_custkey", 2000, 6)


@query(
    "month_replaced",
    "S4 R11 B15 P21",
    f"""SELECT o_orderkey, {date_key_sql('o_orderdate')} AS date_key FROM orders WHERE NOT (year(o_orderdate) = 2001 AND month(o_orderdate) = 7) OR o_orderkey % 2 = 0""",
)
def month_replaced(t: Tables):
    keyed = t.orders.select("o_orderkey", (F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")).alias("date_key"))
    fresh = keyed.filter("date_key BETWEEN 20010700 AND 20010799 AND o_orderkey % 2 = 0")
    return replace_month(keyed, fresh, date(2001, 7, 15))


@query(
    "late_members",
    "R14",
    """SELECT event_type AS vehicle_type, CASE event_type WHEN 'error' THEN 0.08 ELSE 0.0 END::DOUBLE AS co2_per_km FROM (SELECT DISTINCT event_type FROM events) WHERE event_type NOT IN ('click', 'view')""",
)
def late_members(t: Tables):
    kinds = t.events.select(F.col("event_type").alias("vehicle_type"))
    dim = kinds.filter("vehicle_type IN ('click', 'view')")
    rates = kinds.filter("vehicle_type = 'error'").distinct().withColumn("co2_per_km", F.lit(0.08))
    return incremental.late_members(kinds, "vehicle_type", dim, "vehicle_type", rates)


@query(
    "surrogate_keys",
    "B21",
    """SELECT (row_number() OVER (ORDER BY c_name) + (SELECT max(c_custkey) FROM customer WHERE c_custkey % 2 = 0))::INT AS point_key, c_name FROM customer WHERE c_custkey % 2 = 1""",
)
def surrogate_keys(t: Tables):
    existing = t.customer.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("point_key"))
    fresh = t.customer.filter("c_custkey % 2 = 1").select("c_name")
    return incremental.assign_keys(fresh, existing, "point_key", ["c_name"])


@query(
    "validity_interval",
    "R15 P4",
    "SELECT DISTINCT c_mktsegment AS department_name, 20240120 AS start_date, 20261231 AS end_date FROM customer",
)
def validity_interval(t: Tables):
    rows = t.customer.select(F.col("c_mktsegment").alias("department_name")).distinct()
    return incremental.with_validity(rows, date(2024, 1, 20))


@query(
    "unprocessed_records",
    "R13 C7",
    """SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND trim(text) <> ''""",
)
def unprocessed_records(t: Tables):
    todo = t.documents.join(t.labels.select("doc_id").distinct(), "doc_id", "left_anti")
    return todo.filter(F.trim("text") != "").select("doc_id", "lang")


@query(
    "missing_days_of_points",
    "U6 R11",
    """WITH s AS (SELECT DISTINCT event_type, ts::DATE AS day FROM events WHERE day(ts) % 5 > 0), b AS (SELECT event_type, min(day) lo, max(day) hi FROM s GROUP BY 1)
    SELECT event_type, day FROM (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b) EXCEPT SELECT event_type, day FROM s""",
)
def missing_days_of_points(t: Tables):
    days = t.gauge.filter(F.dayofmonth("day") % 5 > 0).select("event_type", "day").distinct()
    return reshape.missing_days(days, ["event_type"], "day")
