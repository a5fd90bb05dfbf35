"""Analysis reports on events (gauge) and orders (daily counts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import DAILY, RISES, Tables, query
from tramline.operators.quantiles import describe
from tramline.plans import reports

_SEASON = """CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) IN (3, 4, 5) THEN 'Spring' WHEN month(day) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""


def _rounded(df, **digits: int):
    return df.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns))


@query(
    "daily_rises",
    "M16 W1 W2 A1",
    f"WITH {RISES} SELECT user_id, day, round(sum(rise), 2) AS rentals, count(*) AS readings FROM rises GROUP BY 1, 2",
)
def daily_rises(t: Tables):
    """Flagship: estimated events per station and day from a gauge."""
    out = reports.daily_rises(t.gauge, "user_id", "ts", "value", ["minute"], ["event_id"])
    return _rounded(out, rentals=2)


@query(
    "weekday_profile",
    "M1 C1 A3 T4",
    f"WITH {DAILY} SELECT isodow(day)::INT AS day_of_week, (sum(total) // count(total))::BIGINT AS mean_value FROM daily GROUP BY 1 ORDER BY 1",
)
def weekday_profile(t: Tables):
    return reports.weekday_profile(t.daily, "day", "total")


_WEEKLY = """s AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
weekly AS (SELECT user_id, year(ts)::INT AS year, week(ts)::INT AS week, sum(CASE WHEN value > prev THEN value - prev ELSE 0 END) AS rentals FROM s GROUP BY 1, 2, 3)"""


@query("weekly_rises", "M2 W2 X8 X9", f"WITH {_WEEKLY} SELECT user_id, year, week, round(rentals, 2) AS rentals FROM weekly")
def weekly_rises(t: Tables):
    return _rounded(reports.weekly_rises(t.gauge, "user_id", "ts", "value", ["day", "minute"], ["event_id"]), rentals=2)


@query(
    "mean_rises_per_week",
    "M2 A8 P9",
    f"WITH {_WEEKLY} SELECT user_id, round(avg(rentals), 4) AS mean_rentals, count(*) AS weeks FROM weekly GROUP BY 1",
)
def mean_rises_per_week(t: Tables):
    return _rounded(reports.mean_per_week(t.gauge, "user_id", "ts", "value", ["day", "minute"], ["event_id"]), mean_rentals=4)


@query(
    "rain_days",
    "M4 A9 A10 A12 C2",
    """WITH d AS (SELECT n_regionkey, day, bool_or(wet) AS wet FROM (SELECT c_nationkey, ts::DATE AS day, value > 120 AS wet FROM events JOIN customer ON user_id = c_custkey) JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT n_regionkey, count(*) FILTER (wet) AS rain_days, count(*) FILTER (NOT wet) AS dry_days, count(*) AS days, round(count(*) FILTER (wet) * 100.0 / count(*), 6) AS rain_pct FROM d GROUP BY 1""",
)
def rain_days(t: Tables):
    placed = (
        t.gauge.join(t.customer.select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_regionkey", "day", (F.col("value") - 120).alias("rain"))
    )
    return _rounded(reports.rain_days(placed, "n_regionkey", "day", "rain"), rain_pct=6)


@query(
    "hourly_profile",
    "M5 P21 W1 W2 A8",
    f"""WITH {RISES} SELECT user_id, hour, is_weekend, round(avg(s), 8) AS mean_rentals FROM (SELECT user_id, day, hour(ts)::INT AS hour, isodow(day) >= 6 AS is_weekend, sum(rise) AS s
      FROM rises WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31' GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3""",
)
def hourly_profile(t: Tables):
    january = t.gauge.filter("day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'")
    return _rounded(reports.hourly_profile(january, "user_id", "ts", "value", ["minute"], ["event_id"]), mean_rentals=8)


@query(
    "daily_falls",
    "M6 W3",
    """WITH g AS (SELECT event_id, user_id, ts, ts::DATE AS day, value, (props->>'k')::DOUBLE AS k FROM events), s AS (SELECT *, lag(value) OVER w AS pv, lag(k) OVER w AS pk FROM g WINDOW w AS (PARTITION BY user_id, day ORDER BY ts, event_id))
    SELECT user_id, day, round(sum(CASE WHEN pv > value THEN pv - value ELSE 0 END), 2) AS classic, round(sum(CASE WHEN pk > k THEN pk - k ELSE 0 END), 2) AS electric FROM s GROUP BY 1, 2""",
)
def daily_falls(t: Tables):
    gauge = t.events.select("event_id", "user_id", "ts", (F.hour("ts") * 60 + F.minute("ts")).alias("minute"), "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    out = reports.daily_falls(gauge, "user_id", "ts", {"classic": "value", "electric": "k"}, ["minute"], ["event_id"])
    return _rounded(out, classic=2, electric=2)


@query(
    "season_means",
    "M7 P24 A7 X1",
    f"WITH {DAILY} SELECT year(day)::INT AS year, {_SEASON} AS season, (sum(total) // count(total))::BIGINT AS mean_value FROM daily GROUP BY 1, 2",
)
def season_means(t: Tables):
    return reports.season_means(t.daily, "day", "total")


@query(
    "season_profile",
    "M7 A15 X6",
    f"""WITH {DAILY} SELECT {_SEASON} AS season, round(avg(total), 4) AS mean, round(quantile_cont(total, 0.25), 4) AS q25, round(quantile_cont(total, 0.5), 4) AS median, round(quantile_cont(total, 0.75), 4) AS q75 FROM daily GROUP BY 1""",
)
def season_profile(t: Tables):
    return _rounded(reports.season_profile(t.daily, "day", "total"), mean=4, q25=4, median=4, q75=4)


@query(
    "season_tests",
    "M8 N1",
    f"""WITH {DAILY}, m AS (SELECT {_SEASON} AS s, count(*) AS n, avg(total) AS m, var_samp(total) AS v FROM daily GROUP BY 1), o AS (SELECT *, list_position(['Winter','Spring','Summer','Autumn'], s) AS i FROM m)
    SELECT a.s AS group_a, b.s AS group_b, round(a.m, 4) AS mean_a, round(b.m, 4) AS mean_b, round((a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)), 6) AS t, (a.n + b.n - 2)::DOUBLE AS df
    FROM o a JOIN o b ON a.i < b.i""",
)
def season_tests(t: Tables):
    """The p-value column is left out here (no SQL equivalent); see the unit tests."""
    return _rounded(reports.season_tests(t.daily, "day", "total"), mean_a=4, mean_b=4, t=6).drop("p_value")


@query("season_p_values", "M8 N1")
def season_p_values(t: Tables):
    return reports.season_tests(t.daily, "day", "total").select("group_a", "group_b", "p_value")


_PEOPLE = """trips AS (SELECT o_custkey, CASE WHEN c_nationkey % 2 = 0 THEN 'students' ELSE 'workers' END AS population, l_quantity AS km, p_size / 1000.0::DOUBLE AS rate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
people AS (SELECT population, o_custkey, sum(km * rate) AS emission FROM trips GROUP BY 1, 2)"""


def _emissions(t: Tables):
    trips = (
        t.lineitem.select("l_orderkey", "l_partkey", F.col("l_quantity").alias("km"))
        .join(t.part.select("p_partkey", (F.col("p_size") / 1000.0).alias("rate")), F.col("l_partkey") == F.col("p_partkey"))
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    )
    people = reports.emissions_per_person(trips, "o_custkey", "km", "rate")
    kind = F.when(F.col("c_nationkey") % 2 == 0, "students").otherwise("workers")
    return people.join(t.customer.select("c_custkey", kind.alias("population")), F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")


@query(
    "emission_summary",
    "M9 A18 U1 A16",
    f"""WITH {_PEOPLE} SELECT population, count(emission) AS count, round(avg(emission), 9) AS mean, round(stddev_samp(emission), 9) AS std, round(min(emission), 9) AS min,
      round(quantile_cont(emission, 0.25), 9) AS q25, round(quantile_cont(emission, 0.5), 9) AS q50, round(quantile_cont(emission, 0.75), 9) AS q75, round(max(emission), 9) AS max FROM people GROUP BY 1""",
)
def emission_summary(t: Tables):
    return _rounded(describe(_emissions(t), ["population"], "emission"), mean=9, std=9, min=9, q25=9, q50=9, q75=9, max=9)


@query(
    "emission_welch_test",
    "M9 N1",
    f"""WITH {_PEOPLE}, m AS (SELECT population AS p, count(*) AS n, avg(emission) AS m, var_samp(emission) AS v FROM people GROUP BY 1)
    SELECT a.p AS group_a, b.p AS group_b, round(a.m, 9) AS mean_a, round(b.m, 9) AS mean_b, round((a.m - b.m) / sqrt(a.v / a.n + b.v / b.n), 6) AS t,
      round(pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)), 4) AS df FROM m a JOIN m b ON a.p = 'students' AND b.p = 'workers'""",
)
def emission_welch_test(t: Tables):
    out = reports.compare_populations(_emissions(t), "population", "emission", "students", "workers")
    return _rounded(out, mean_a=9, mean_b=9, t=6).withColumn("df", F.round("df", 4)).drop("p_value")


@query(
    "km_per_employee",
    "M11 C1 A4 A8",
    """SELECT c_nationkey, year(o_orderdate)::INT AS year, sum(l_quantity) AS total_km, count(DISTINCT o_custkey) AS employees, round(sum(l_quantity) / count(DISTINCT o_custkey), 6) AS km_per_employee
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def km_per_employee(t: Tables):
    rows = (
        t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("km"))
        .join(t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    )
    return _rounded(reports.mean_km_per_employee(rows, ["c_nationkey", "year"], "o_custkey", "km"), km_per_employee=6)


@query(
    "quarter_totals",
    "M12 A1",
    f"WITH {DAILY} SELECT year(day)::INT AS year, quarter(day)::INT AS quarter, sum(total)::BIGINT AS total, round(avg(total), 4) AS mean FROM daily GROUP BY 1, 2",
)
def quarter_totals(t: Tables):
    return _rounded(reports.quarter_totals(t.daily, "day", "total"), mean=4)


_Q = ["total", "q1", "q2", "q3", "q4"]


@query(
    "quarter_correlation",
    "M12 P28 A14",
    f"WITH {DAILY}, q AS (SELECT sum(total)::DOUBLE AS total, (quarter(day) = 1)::INT AS q1, (quarter(day) = 2)::INT AS q2, (quarter(day) = 3)::INT AS q3, (quarter(day) = 4)::INT AS q4 FROM daily GROUP BY year(day), quarter(day)) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)") + " AS r FROM " + ("(SELECT 1)" if a == b else "q")
        for a in _Q for b in _Q
    ),
)
def quarter_correlation(t: Tables):
    return _rounded(reports.quarter_correlation(t.daily, "day", "total"), r=6)


_WEATHER = """c AS (SELECT o_orderdate::DATE AS day, sum(round(o_totalprice)::BIGINT)::DOUBLE AS s FROM orders GROUP BY 1),
w AS (SELECT l_shipdate::DATE AS day, count(*) AS n, avg(l_quantity) AS temp, avg(l_discount) AS rain FROM lineitem GROUP BY 1)"""
_PAIRS = [("cents", "temp"), ("cents", "rain"), ("temp", "rain")]


def _weather_sql(count: str) -> str:
    cells = [f"SELECT '{x}' AS a, '{y}' AS b, round(corr({p[0]}, {p[1]}), 6) AS r FROM j" for p in _PAIRS for x, y in (p, p[::-1])]
    cells += [f"SELECT '{x}', '{x}', 1.0::DOUBLE" for x in ("cents", "temp", "rain")]
    return f"WITH {_WEATHER}, j AS (SELECT {count} AS cents, temp, rain FROM c JOIN w USING (day)) " + " UNION ALL ".join(cells)


def _weather(t: Tables):
    counts = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), F.round("o_totalprice").cast("bigint").alias("cents"))
    weather = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), F.col("l_quantity").alias("temp"), F.col("l_discount").alias("rain"))
    return counts, weather


@query("weather_correlation_raw", "M13 C19 A13 X12", _weather_sql("s * n"))
def weather_correlation_raw(t: Tables):
    return _rounded(reports.weather_correlation_raw(*_weather(t), "day", "cents", ["temp", "rain"]), r=6)


@query("weather_correlation", "M13 A14", _weather_sql("s"))
def weather_correlation(t: Tables):
    return _rounded(reports.weather_correlation(*_weather(t), "day", "cents", ["temp", "rain"]), r=6)


@query(
    "growth_report",
    "M14 W9 W10 W11",
    f"""WITH {DAILY}, y AS (SELECT year(day)::INT AS year, sum(total)::BIGINT AS total FROM daily GROUP BY 1)
    SELECT year, total, total - lag(total) OVER (ORDER BY year) AS change_abs, round((total / lag(total) OVER (ORDER BY year) - 1) * 100, 6) AS change_pct,
      round((total / first(total) OVER (ORDER BY year) - 1) * 100, 6) AS growth_since_first_pct,
      (SELECT round((pow(max_by(total, year) / min_by(total, year), 1.0 / (max(year) - min(year))) - 1) * 100, 6) FROM y) AS cagr_pct FROM y""",
)
def growth_report(t: Tables):
    return _rounded(reports.growth(t.daily, "day", "total"), change_pct=6, growth_since_first_pct=6, cagr_pct=6)


@query(
    "quarter_shares",
    "M14 W12 A11 U4",
    f"""WITH {DAILY}, q AS (SELECT year(day)::INT AS year, quarter(day) AS quarter, sum(total) AS s FROM daily GROUP BY 1, 2), p AS (SELECT year, quarter, s / sum(s) OVER (PARTITION BY year) AS share FROM q)
    SELECT year, round(max(share) FILTER (quarter = 1), 8) AS q1, round(max(share) FILTER (quarter = 2), 8) AS q2, round(max(share) FILTER (quarter = 3), 8) AS q3, round(max(share) FILTER (quarter = 4), 8) AS q4 FROM p GROUP BY 1""",
)
def quarter_shares(t: Tables):
    return _rounded(reports.quarter_shares(t.daily, "day", "total"), q1=8, q2=8, q3=8, q4=8)


@query(
    "activity_profile",
    "M15 A4 A5 A6 W2",
    f"""WITH {RISES}, p AS (SELECT user_id, sum(rise) AS total, sum(CASE WHEN hour(ts) BETWEEN 6 AND 9 THEN rise ELSE 0 END) AS morning, sum(CASE WHEN hour(ts) BETWEEN 16 AND 19 THEN rise ELSE 0 END) AS evening,
      sum(CASE WHEN isodow(day) < 6 THEN rise ELSE 0 END) AS weekday, sum(CASE WHEN isodow(day) >= 6 THEN rise ELSE 0 END) AS weekend, count(DISTINCT day) AS active_days FROM rises GROUP BY 1 HAVING sum(rise) > 0)
    SELECT user_id, round(total, 2) AS total, round(morning, 2) AS morning, round(evening, 2) AS evening, round(weekday, 2) AS weekday, round(weekend, 2) AS weekend, active_days,
      round((morning + evening) / total, 6) AS rush_ratio, round(weekend / total, 6) AS weekend_ratio, round(total / active_days, 6) AS rentals_per_day FROM p""",
)
def activity_profile(t: Tables):
    out = reports.activity_profile(t.gauge, "user_id", "ts", "value", ["minute"], ["event_id"])
    return _rounded(out, total=2, morning=2, evening=2, weekday=2, weekend=2, rush_ratio=6, weekend_ratio=6, rentals_per_day=6)


@query("mean_in_use", "M17 A1", "SELECT user_id, ts::DATE AS day, round(avg(value), 8) AS mean_in_use FROM events GROUP BY 1, 2")
def mean_in_use(t: Tables):
    return _rounded(reports.mean_in_use(t.events, "user_id", "ts", "value"), mean_in_use=8)
