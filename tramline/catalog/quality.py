"""Data-quality rules as report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import STAGING, Tables, date_key_sql, query
from tramline.functions import keys
from tramline.operators import rules

_ORDER_RULES = rules.TableRules(
    "orders",
    columns=("o_orderkey", "o_custkey", "date_key", "in_part", "out_part", "total"),
    not_null=("o_custkey", "status"),
    unique=("o_custkey", "date_key"),
    non_negative=("total", "adjusted", "status"),
    date_keys=("date_key", "bad_key"),
    not_blank=("status",),
    row_count=15000,
    min_rows=100,
    total_of=("total", "in_part", "out_part"),
)


def _orders(t: Tables):
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_orderkey") % 11 == 0, " ").otherwise(F.col("o_orderstatus"))).alias("status"),
        keys.date_key(F.col("o_orderdate")).alias("date_key"),
        (keys.date_key(F.col("o_orderdate")) + F.when(F.col("o_orderkey") % 13 == 0, 900).otherwise(0)).alias("bad_key"),
        cents.alias("total"),
        (cents - 10_000_000).alias("adjusted"),
        F.when(F.col("o_orderkey") % 5 != 0, F.floor(cents / 2)).alias("in_part"),
        (cents - F.floor(cents / 2) + F.when(F.col("o_orderkey") % 7 == 0, 1).otherwise(0)).alias("out_part"),
    )


_V = f"""v AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE o_orderstatus END END AS status,
  {date_key_sql('o_orderdate')} AS date_key, ({date_key_sql('o_orderdate')} + CASE WHEN o_orderkey % 13 = 0 THEN 900 ELSE 0 END) AS bad_key, round(o_totalprice * 100)::BIGINT AS total,
  round(o_totalprice * 100)::BIGINT - 10000000 AS adjusted, CASE WHEN o_orderkey % 5 <> 0 THEN round(o_totalprice * 100)::BIGINT // 2 END AS in_part,
  round(o_totalprice * 100)::BIGINT - round(o_totalprice * 100)::BIGINT // 2 + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS out_part FROM orders)"""

_CHECKS = [
    ("columns", "o_orderkey,o_custkey,date_key,in_part,out_part,total", "0"),
    ("not_empty", "", "(count(*) = 0)::INT"),
    ("row_count", "", "abs(count(*) - 15000)"),
    ("row_count_at_least", "", "greatest(100 - count(*), 0)"),
    ("unique", "o_custkey,date_key", "count(*) - count(DISTINCT (o_custkey, date_key))"),
    ("not_null", "o_custkey", "count(*) FILTER (o_custkey IS NULL)"),
    ("not_null", "status", "count(*) FILTER (status IS NULL)"),
    ("not_blank", "status", "count(*) FILTER (trim(status) = '')"),
    ("non_negative", "total", "count(*) FILTER (total < 0)"),
    ("non_negative", "adjusted", "count(*) FILTER (adjusted < 0)"),
    ("date_key", "date_key", "count(*) FILTER (try_strptime(date_key::VARCHAR, '%Y%m%d') IS NULL)"),
    ("date_key", "bad_key", "count(*) FILTER (try_strptime(bad_key::VARCHAR, '%Y%m%d') IS NULL)"),
    ("total_of", "total,in_part,out_part", "count(*) FILTER (in_part IS NOT NULL AND out_part IS NOT NULL AND total <> in_part + out_part)"),
]


@query(
    "order_rules",
    "K1 K2 K3 K4 K5 K6 K7 K8 K14 K15 K17 K20",
    f"WITH {_V}, m AS (SELECT count(*) AS n, "
    + ", ".join(f"({e})::BIGINT AS c{i}" for i, (_, _, e) in enumerate(_CHECKS))
    + " FROM v) "
    + " UNION ALL ".join(
        f"SELECT 'orders' AS table_name, '{r}' AS rule, '{c}' AS column_name, c{i} AS violations, c{i} = 0 AS passed, n AS row_count FROM m"
        for i, (r, c, _) in enumerate(_CHECKS)
    ),
)
def order_rules(t: Tables):
    return rules.check(_orders(t), _ORDER_RULES)


@query(
    "arrival_rules",
    "K9 K10 X11 K12",
    f"""WITH {STAGING}, w AS (SELECT station_key, {date_key_sql('s')} AS date_key, (hour(s) * 100 + minute(s))::INT AS start_time, (hour(e) * 100 + minute(e))::INT AS end_time FROM
      (SELECT *, time_bucket(INTERVAL 30 MINUTE, actual) AS s, time_bucket(INTERVAL 30 MINUTE, actual) + INTERVAL 30 MINUTE AS e FROM staging)),
    m AS (SELECT count(*) AS n, count(*) FILTER (NOT start_time < end_time AND NOT (start_time = 2330 AND end_time = 0)) AS c FROM w)
    SELECT 'arrivals' AS table_name, 'columns' AS rule, 'station_key,start_time,end_time' AS column_name, 0::BIGINT AS violations, true AS passed, n AS row_count FROM m
    UNION ALL SELECT 'arrivals', 'warn_empty', '', (n = 0)::BIGINT, true, n FROM m
    UNION ALL SELECT 'arrivals', 'non_negative', 'station_key', 0, true, n FROM m
    UNION ALL SELECT 'arrivals', 'ordered_pair', 'start_time,end_time', c, c = 0, n FROM m""",
)
def arrival_rules(t: Tables):
    from tramline.streaming.arrivals import actual_arrival

    start = keys.floor_minutes(actual_arrival(), 30)
    rows = t.staging.select(
        "station_key", keys.time_key(start).alias("start_time"), keys.time_key(start + F.expr("interval 30 minutes")).alias("end_time")
    )
    table_rules = rules.TableRules(
        "arrivals", columns=("station_key", "start_time", "end_time"), non_negative=("station_key",), ordered_pair=("start_time", "end_time", 2330, 0), empty="warn"
    )
    return rules.check(rows, table_rules)


@query(
    "foreign_keys",
    "K16 C8 K17",
    """SELECT 'orders' AS table_name, 'foreign_key' AS rule, 'o_custkey->customer.c_custkey' AS column_name, count(*) AS violations, count(*) = 0 AS passed, NULL::BIGINT AS row_count FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'orders', 'foreign_key', 'o_orderkey->lineitem.l_orderkey', count(*), count(*) = 0, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def foreign_keys(t: Tables):
    table_rules = rules.TableRules("orders", foreign={"o_custkey": ("customer", "c_custkey"), "o_orderkey": ("lineitem", "l_orderkey")})
    return rules.check_foreign(t.orders, table_rules, {"customer": t.customer, "lineitem": t.lineitem})


@query(
    "rule_summary",
    "K13 K21",
    f"WITH {_V}, m AS (SELECT unnest([" + ", ".join(f"({e})::BIGINT" for _, _, e in _CHECKS) + "]) AS c FROM v) "
    "SELECT 'orders' AS table_name, count(*) AS checks, count(*) FILTER (c = 0) AS passed, count(*) FILTER (c <> 0) AS failed, bool_and(c = 0) AS all_passed FROM m "
    "UNION ALL SELECT 'nation', 3, 3, 0, true",
)
def rule_summary(t: Tables):
    nation = rules.TableRules("nation", columns=("n_nationkey",), unique=("n_nationkey",))
    report = rules.validate({"orders": _orders(t), "nation": t.nation}, {"orders": _ORDER_RULES, "nation": nation})
    return rules.summary(report)


@query(
    "expectations",
    "K18 K19",
    """SELECT 'sum' AS how, round(sum(o_totalprice), 2) AS value, abs(sum(o_totalprice) - 1000) <= 5 AS passed FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE lower(c_name) LIKE '%customer#00000000%' AND year(o_orderdate) = 1997
    UNION ALL SELECT 'count', count(o_totalprice)::DOUBLE, count(o_totalprice) BETWEEN 0 AND 1e9 FROM orders JOIN customer ON o_custkey = c_custkey WHERE lower(c_name) LIKE '%customer#00000000%' AND year(o_orderdate) = 1997
    UNION ALL SELECT 'avg', round(avg(o_totalprice), 4), avg(o_totalprice) > 10 FROM orders JOIN customer ON o_custkey = c_custkey WHERE lower(c_name) LIKE '%customer#00000000%' AND year(o_orderdate) = 1997""",
)
def expectations(t: Tables):
    fact = t.orders.withColumn("date_key", keys.date_key(F.col("o_orderdate")))

    def measured(how: str):
        return rules.expectation_value(fact, t.customer, ("o_custkey", "c_custkey"), "c_name", "%CUSTOMER#00000000%", "o_totalprice", "date_key", 19970000, 19979999, how)

    def shaped(df, how: str, digits: int):
        return df.select(F.lit(how).alias("how"), F.round(F.col("value").cast("double"), digits).alias("value"), "passed")

    total = shaped(rules.expect(measured("sum"), "value", expected=1000, tolerance=5), "sum", 2)
    count = shaped(rules.expect(measured("count"), "value", low=0, high=1e9), "count", 0)
    mean = shaped(rules.expect(measured("avg"), "value", op=">", expected=10), "avg", 4)
    return total.unionByName(count).unionByName(mean)


@query(
    "warehouse_rule_table",
    "K11",
    f"""WITH d AS (SELECT o_custkey, {date_key_sql('o_orderdate')} AS k, count(*) AS n FROM orders GROUP BY 1, 2), m AS (SELECT count(*) AS n FROM d)
    SELECT 'fact_counts' AS table_name, rule, column_name, 0::BIGINT AS violations, true AS passed, n AS row_count FROM m, (SELECT unnest([
      'columns','unique','not_null','not_null','non_negative','non_negative','non_negative','date_key','total_of']) AS rule,
      unnest(['counting_point_id,date_key,direction_in,direction_out,total','counting_point_id,date_key','counting_point_id','date_key','direction_in','direction_out','total','date_key','total,direction_in,direction_out']) AS column_name)""",
)
def warehouse_rule_table(t: Tables):
    """The warehouse's own rules for counts, applied to daily order counts per customer."""
    from tramline.plans.schemas import LOAD_RULES

    daily = t.orders.groupBy(F.col("o_custkey").alias("counting_point_id"), keys.date_key(F.col("o_orderdate")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("direction_in")
    )
    counts = daily.withColumn("direction_out", F.col("total") - F.col("direction_in"))
    return rules.check(counts, LOAD_RULES["fact_counts"])
