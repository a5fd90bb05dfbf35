"""Projection, cleaning and predicates."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tramline.catalog.base import Tables, date_key_sql, query, time_key_sql
from tramline.functions import dates, keys, values
from tramline.operators import joins, reshape
from tramline.plans.queries import in_last_days


@query(
    "projected_renamed",
    "P1 P2 P3 P4 S1",
    """SELECT s_suppkey AS station_key, s_name AS station_name, s_acctbal AS balance, 20240131 AS date_key FROM supplier""",
)
def projected_renamed(t: Tables):
    names = {"s_suppkey": "station_key", "s_name": "station_name", "s_acctbal": "balance"}
    return reshape.rename(t.supplier, names).drop("s_nationkey", "not_there").withColumn("date_key", F.lit(20240131))


@query(
    "clipped_readings",
    "P6 P8",
    """SELECT event_id, CASE WHEN value - 10 < 0 THEN 0 ELSE round(value - 10, 2) END AS reading FROM events""",
)
def clipped_readings(t: Tables):
    shifted = t.events.select("event_id", F.round(F.col("value") - 10, 2).cast("string").alias("reading"))
    return reshape.clip_columns(shifted, ["reading", "not_there"])


@query(
    "clip_counts",
    "P8",
    """SELECT 'value' AS column_name, count(*) FILTER (value - 10 < 0) AS corrected FROM events
    UNION ALL SELECT 'k', count(*) FILTER ((props->>'k')::INT - 10 < 0) FROM events""",
)
def clip_counts(t: Tables):
    shifted = t.events.select((F.col("value") - 10).alias("value"), (F.get_json_object("props", "$.k").cast("int") - 10).alias("k"))
    return reshape.clip_report(shifted, ["value", "k"])


@query(
    "nulls_dropped_filled",
    "P9 P27",
    """SELECT event_id, coalesce(CASE WHEN event_type <> 'error' THEN value END, 0) AS filled FROM events WHERE event_type <> 'view'""",
)
def nulls_dropped_filled(t: Tables):
    rows = t.events.select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("kind"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("filled"),
    )
    return rows.dropna(subset=["kind"]).fillna({"filled": 0.0}).drop("kind")


@query(
    "deduplicated_first_last",
    "P10 W14",
    """SELECT user_id, event_type, min_by(event_id, row(ts, event_id)) AS first_id, max_by(event_id, row(ts, event_id)) AS last_id,
      max_by(value, row(ts, event_id)) AS last_value FROM events GROUP BY 1, 2""",
)
def deduplicated_first_last(t: Tables):
    keys_ = ["user_id", "event_type"]
    narrow = t.events.select(*keys_, "ts", "event_id", "value")
    first = joins.first_by(narrow, keys_, ["ts", "event_id"], ["event_id"]).withColumnRenamed("event_id", "first_id")
    last = joins.last_by(narrow, keys_, ["ts", "event_id"]).select(*keys_, F.col("event_id").alias("last_id"), F.col("value").alias("last_value"))
    return first.join(last, keys_)


@query("distinct_pairs", "P10 T6", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_pairs(t: Tables):
    return t.events.select("user_id", "event_type").distinct()


@query(
    "mapped_and_replaced",
    "P11 P12 P30",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS mapped,
      CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS replaced,
      CASE WHEN o_orderkey % 3 = 0 THEN true WHEN o_orderkey % 3 = 1 THEN false END AS flag FROM orders""",
)
def mapped_and_replaced(t: Tables):
    names = {"F": "finished", "O": "open"}
    status = F.col("o_orderstatus")
    written = F.element_at(F.array(F.lit("True"), F.lit("false"), F.lit("?")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return t.orders.select(
        "o_orderkey",
        values.map_values(status, names).alias("mapped"),
        values.replace_values(status, names).alias("replaced"),
        values.lenient_boolean(written).alias("flag"),
    )


@query(
    "decoded_labels",
    "P13 S10",
    """SELECT c_custkey, n_name AS c_nationkey, c_mktsegment FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20""",
)
def decoded_labels(t: Tables):
    labels = t.nation.filter("n_nationkey < 20").select(
        F.lit("nations").alias("label_set"), F.col("n_nationkey").cast("double").alias("code"), F.col("n_name").alias("label")
    )
    return reshape.decode_labels(t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), labels, {"c_nationkey": "nations"})


@query(
    "rescaled_numbers",
    "P14",
    """SELECT p_partkey, p_name, p_brand, p_type, p_size / 10.0::DOUBLE AS p_size, p_retailprice / 10 AS p_retailprice FROM part""",
)
def rescaled_numbers(t: Tables):
    return reshape.rescale_numeric(t.part, 2, 10)


@query(
    "range_filters",
    "P17 P20 P21 P22 P23 X2 P19",
    f"""SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0 AND {date_key_sql('o_orderdate')} BETWEEN 19960300 AND 19960399
      AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_orderpriority ILIKE '%-h%' AND NOT (o_orderstatus = 'P') AND o_orderstatus IS NOT NULL""",
)
def range_filters(t: Tables):
    low, high = keys.month_bounds(1996, 3)
    keyed = t.orders.filter((F.col("o_orderdate") >= F.lit(date(1996, 3, 1))) & (F.col("o_orderdate") < F.lit(date(1996, 4, 1))))
    return keyed.filter(
        (F.col("o_totalprice") > 0)
        & keys.date_key(F.col("o_orderdate")).between(low, high)
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW")
        & F.col("o_orderpriority").ilike("%-h%")
        & ~(F.col("o_orderstatus") == "P")
        & F.col("o_orderstatus").isNotNull()
    ).select("o_orderkey", "o_totalprice")


@query(
    "substring_filter",
    "P19 X2",
    "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'widget') OR p_brand LIKE '%#1%'",
)
def substring_filter(t: Tables):
    return t.part.filter(F.lower("p_name").contains("widget") | F.col("p_brand").contains("#1")).select("p_partkey", "p_name")


@query(
    "seasons",
    "P24 A7",
    """SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Spring'
      WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season, count(*) AS n FROM orders GROUP BY 1""",
)
def seasons(t: Tables):
    return t.orders.groupBy(dates.season(F.month("o_orderdate")).alias("season")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "last_seven_days",
    "P25",
    f"""SELECT event_id, user_id FROM events WHERE date_trunc('minute', ts) BETWEEN TIMESTAMP '2024-01-13 15:40:00' AND TIMESTAMP '2024-01-20 15:40:00'""",
)
def last_seven_days(t: Tables):
    as_of = datetime(2024, 1, 20, 15, 40)
    keyed = t.events.select("event_id", "user_id", "ts", keys.date_key(F.col("ts")).alias("d"), keys.time_key(F.col("ts")).alias("c"))
    return keyed.filter(in_last_days(F.col("d"), F.col("c"), as_of, 7, F.col("ts"))).select("event_id", "user_id")


@query(
    "working_days",
    "P26 F14",
    """SELECT event_id, isodow(ts) >= 6 AS is_weekend, isodow(ts) < 6 AND event_type <> 'signup' AS is_working, value > 50 AS is_high FROM events""",
)
def working_days(t: Tables):
    weekend = F.weekday("ts") >= 5
    return t.events.select(
        "event_id", weekend.alias("is_weekend"), (~weekend & (F.col("event_type") != "signup")).alias("is_working"), (F.col("value") > 50).alias("is_high")
    )


@query(
    "one_hot_quarters",
    "P28",
    """SELECT o_orderkey, (quarter(o_orderdate) = 1)::INT AS q1, (quarter(o_orderdate) = 2)::INT AS q2,
      (quarter(o_orderdate) = 3)::INT AS q3, (quarter(o_orderdate) = 4)::INT AS q4 FROM orders""",
)
def one_hot_quarters(t: Tables):
    return t.orders.select("o_orderkey", *values.one_hot(F.quarter("o_orderdate"), [1, 2, 3, 4], "q"))


@query(
    "optional_filters",
    "P31",
    "SELECT c_custkey FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'BUILDING'",
)
def optional_filters(t: Tables):
    return reshape.where_given(t.customer, c_nationkey=7, c_name=None, c_mktsegment="BUILDING").select("c_custkey")


@query(
    "legacy_columns",
    "P32 U1",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def legacy_columns(t: Tables):
    new = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    old = reshape.ensure_columns(t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), {"segment": "string"})
    return reshape.union_all([new, old])


@query(
    "time_key_census",
    "P20 F13",
    f"SELECT {time_key_sql('ts')} AS time_key, count(*) AS n FROM events GROUP BY 1",
)
def time_key_census(t: Tables):
    return t.events.groupBy(keys.time_key(F.col("ts")).alias("time_key")).agg(F.count(F.lit(1)).alias("n"))
