"""Window operators, top-k and ordering. Gauge keys are split by day or hour (operators.windows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import DAILY, Tables, query
from tramline.functions import dates
from tramline.operators import aggregates, windows


@query(
    "previous_readings",
    "W1",
    """SELECT event_id, lag(value) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS prev_today, lag(event_type) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS prev_type FROM events""",
)
def previous_readings(t: Tables):
    out = windows.lagged(t.gauge, ["user_id", "day"], ["ts", "event_id"], {"prev_today": "value", "prev_type": "event_type"}, ["minute"])
    return out.select("event_id", "prev_today", "prev_type")


@query(
    "previous_by_station",
    "W1 X8",
    "SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events",
)
def previous_by_station(t: Tables):
    return windows.lagged(t.gauge, ["user_id"], ["ts", "event_id"], {"prev": "value"}, ["day", "minute"]).select("event_id", "prev")


@query(
    "positive_deltas",
    "W2",
    """WITH s AS (SELECT *, lag(value) OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS p FROM events)
    SELECT event_id, round(CASE WHEN value > p THEN value - p ELSE 0 END, 2) AS rise, round(CASE WHEN p IS NOT NULL THEN greatest(p - value, 0) END, 2) AS fall FROM s""",
)
def positive_deltas(t: Tables):
    rise = windows.positive_delta(t.gauge, ["user_id", "day"], ["ts", "event_id"], "value", "rise", split=["minute"])
    both = windows.positive_delta(rise, ["user_id", "day"], ["ts", "event_id"], "value", "fall", "fall", "null", ["minute"])
    return both.select("event_id", F.round("rise", 2).alias("rise"), F.round("fall", 2).alias("fall"))


@query(
    "rises_without_first",
    "W2 W3",
    """WITH s AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events)
    SELECT event_id, round(greatest(value - p, 0), 2) AS rise FROM s WHERE p IS NOT NULL""",
)
def rises_without_first(t: Tables):
    out = windows.positive_delta(t.gauge, ["user_id"], ["ts", "event_id"], "value", "rise", first="drop", split=["day", "minute"])
    return out.select("event_id", F.round("rise", 2).alias("rise"))


@query(
    "lag_and_trailing_means",
    "W4 W5 W6 W7 N6",
    f"""WITH {DAILY} SELECT c_nationkey, day, lag(total, 1) OVER w AS lag1, lag(total, 7) OVER w AS lag7,
      CASE WHEN count(total) OVER w7 >= 3 THEN round(avg(total) OVER w7, 4) END AS mean7,
      CASE WHEN count(total) OVER w3 = 3 THEN round(avg(total) OVER w3, 4) END AS sma3,
      CASE WHEN count(total) OVER w10 = 10 THEN round(avg(total) OVER w10, 4) END AS sma10,
      CASE WHEN count(total) OVER w7 >= 3 THEN round(total - avg(total) OVER w7, 4) END AS off_mean7
    FROM daily WINDOW w AS (PARTITION BY c_nationkey ORDER BY day), w3 AS (PARTITION BY c_nationkey ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
      w7 AS (PARTITION BY c_nationkey ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), w10 AS (PARTITION BY c_nationkey ORDER BY day ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""",
)
def lag_and_trailing_means(t: Tables):
    f = windows.lag_features(t.daily, ["c_nationkey"], ["day"], "total", (1, 7), {7: 3, 3: 3, 10: 10})
    return f.select(
        "c_nationkey", "day", "lag1", "lag7",
        F.round("mean7", 4).alias("mean7"), F.round("mean3", 4).alias("sma3"), F.round("mean10", 4).alias("sma10"),
        F.round(F.col("total") - F.col("mean7"), 4).alias("off_mean7"),
    )


@query(
    "standing_of_stations",
    "W8 M3",
    """SELECT o_custkey, n, rank() OVER (ORDER BY n DESC) AS rank, round(rank() OVER (ORDER BY n DESC) * 100.0 / count(*) OVER (), 6) AS top_percent
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""",
)
def standing_of_stations(t: Tables):
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return windows.standing(counts, "n").select("o_custkey", "n", "rank", F.round("top_percent", 6).alias("top_percent"))


@query(
    "yearly_change",
    "W9 W10",
    """WITH y AS (SELECT year(o_orderdate)::INT AS year, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total FROM orders GROUP BY 1)
    SELECT year, total, total - lag(total) OVER (ORDER BY year) AS change_abs, round((total / lag(total) OVER (ORDER BY year) - 1) * 100, 6) AS change_pct,
      round((total / first(total) OVER (ORDER BY year) - 1) * 100, 6) AS growth_since_first_pct FROM y""",
)
def yearly_change(t: Tables):
    yearly = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"))
    out = windows.year_over_year(yearly, "year", "total")
    return out.select("year", "total", "change_abs", F.round("change_pct", 6).alias("change_pct"), F.round("growth_since_first_pct", 6).alias("growth_since_first_pct"))


@query(
    "compound_growth",
    "W11",
    """WITH y AS (SELECT c_nationkey, year(o_orderdate)::INT AS year, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    SELECT c_nationkey, round((pow(max_by(total, year) / min_by(total, year), 1.0 / (max(year) - min(year))) - 1) * 100, 6) AS cagr_pct FROM y GROUP BY 1""",
)
def compound_growth(t: Tables):
    rows = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    yearly = rows.groupBy("c_nationkey", F.year("o_orderdate").alias("year")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total"))
    return windows.compound_growth(yearly, "year", "total", ["c_nationkey"]).select("c_nationkey", F.round("cagr_pct", 6).alias("cagr_pct"))


@query(
    "share_of_total",
    "W12",
    """WITH s AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
    SELECT l_returnflag, l_linestatus, round(q / sum(q) OVER (PARTITION BY l_returnflag), 8) AS share FROM s""",
)
def share_of_total(t: Tables):
    sums = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"))
    return windows.share(sums, ["l_returnflag"], "q").select("l_returnflag", "l_linestatus", F.round("share", 8).alias("share"))


@query(
    "chronological_split",
    "W13",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) <= floor(count(*) OVER (PARTITION BY user_id) * 0.8) AS is_train FROM events""",
)
def chronological_split(t: Tables):
    return windows.chronological_split(t.gauge, ["user_id"], ["ts", "event_id"], 0.8, ["day", "minute"]).select("event_id", "is_train")


@query(
    "positions_in_series",
    "W13 W4",
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position, count(*) OVER (PARTITION BY event_type) AS size FROM events""",
)
def positions_in_series(t: Tables):
    return windows.positions(t.gauge, ["event_type"], ["ts", "event_id"], ["day", "minute"]).select("event_id", "position", "size")


@query(
    "running_totals",
    "W10 W5",
    """SELECT o_orderkey, sum(round(o_totalprice * 100)::BIGINT) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::BIGINT AS cents FROM orders""",
)
def running_totals(t: Tables):
    rows = t.orders.select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"),
        F.trunc("o_orderdate", "month").alias("month"),
    )
    out = windows.running_sum(rows, ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "c", "cents", ["month"])
    return out.select("o_orderkey", "cents")


@query(
    "latest_thirty",
    "W14 T3",
    """SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 30""",
)
def latest_thirty(t: Tables):
    return windows.latest(t.events, ["user_id"], ["ts", "event_id"], 30).select("event_id")


@query(
    "date_lagged",
    "W16 N18",
    f"""WITH {DAILY} SELECT a.c_nationkey, a.day, a.total, b.total AS week_before FROM daily a LEFT JOIN daily b ON a.c_nationkey = b.c_nationkey AND b.day = a.day - 7""",
)
def date_lagged(t: Tables):
    return windows.date_lag(t.daily, ["c_nationkey"], "day", "total", 7, "week_before")


@query(
    "top_customers",
    "T1 T2 Q9",
    """SELECT o_custkey, c_name, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY cents DESC, o_custkey LIMIT 10""",
)
def top_customers(t: Tables):
    sums = t.orders.groupBy("o_custkey").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    named = sums.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "c_name", "cents")
    return aggregates.top_n(named, "cents", 10, ["o_custkey"])


@query(
    "first_five_urgent",
    "T3 P22",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY o_orderdate, o_orderkey LIMIT 5",
)
def first_five_urgent(t: Tables):
    return t.orders.filter("o_orderpriority = '1-URGENT'").orderBy("o_orderdate", "o_orderkey").limit(5).select("o_orderkey", "o_orderdate")


@query(
    "season_ordered",
    "T4 X1",
    """SELECT season, (sum(cents) // count(*))::BIGINT AS mean_cents, list_position(['Winter','Spring','Summer','Autumn'], season)::INT AS place FROM
      (SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season,
        round(o_totalprice * 100)::BIGINT AS cents FROM orders) GROUP BY 1 ORDER BY place""",
)
def season_ordered(t: Tables):
    from tramline.functions.values import truncated_average

    rows = t.orders.select(dates.season(F.month("o_orderdate")).alias("season"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"))
    means = rows.groupBy("season").agg(truncated_average(F.col("c")).alias("mean_cents"))
    return means.withColumn("place", dates.rank_in(dates.SEASON_ORDER, F.col("season"))).orderBy("place")


@query(
    "smallest_scores",
    "T5",
    "SELECT event_id, value FROM events ORDER BY value, event_id LIMIT 10",
)
def smallest_scores(t: Tables):
    return t.events.orderBy("value", "event_id").limit(10).select("event_id", "value")
