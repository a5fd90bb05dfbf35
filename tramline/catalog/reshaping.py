"""Unions, unpivots and calendar gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import DAILY, Tables, query
from tramline.operators import reshape


@query(
    "all_accounts",
    "U1",
    """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL::INT AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def all_accounts(t: Tables):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return reshape.union_all([a, b])


@query(
    "new_dimension_values",
    "U2 R14",
    """SELECT DISTINCT event_type AS kind FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def new_dimension_values(t: Tables):
    known = t.events.filter("event_type IN ('click', 'view')").select(F.concat(F.lit(" "), "event_type").alias("known"))
    return reshape.new_members(t.events.select(F.col("event_type").alias("kind")), "kind", known, "known")


@query(
    "unpivoted_days",
    "U3 F6 P7 P17",
    """WITH w AS (SELECT o_custkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day_of_month, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 1, 2, 3, 4)
    SELECT o_custkey, year, month, day_of_month, cents FROM w""",
)
def unpivoted_days(t: Tables):
    """Orders pivoted to one column per day of the month and back."""
    parts = ["o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")]
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    wide = t.orders.groupBy(*parts).agg(*(F.sum(F.when(F.dayofmonth("o_orderdate") == i, cents)).alias(f"dag {i}") for i in range(1, 32)))
    return reshape.unpivot_days(wide, ["o_custkey", "year", "month"], value="cents").filter("cents IS NOT NULL")


_SPARSE = "sparse AS (SELECT user_id, ts::DATE AS day, round(sum(value), 2) AS total FROM events WHERE user_id % 3 > 0 OR day(ts) % 4 > 0 GROUP BY 1, 2)"
_FILLED = f"""WITH {_SPARSE}, b AS (SELECT user_id, min(day) lo, max(day) hi FROM sparse GROUP BY 1), s AS (SELECT user_id, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b),
filled AS (SELECT s.user_id, s.day, total, row_number() OVER (PARTITION BY s.user_id ORDER BY s.day) AS i FROM s LEFT JOIN sparse USING (user_id, day))"""


def _sparse(t: Tables):
    rows = t.gauge.filter((F.col("user_id") % 3 > 0) | (F.dayofmonth("day") % 4 > 0))
    return rows.groupBy("user_id", "day").agg(F.round(F.sum("value"), 2).alias("total"))


@query("filled_days", "U6 C10", f"{_FILLED} SELECT user_id, day, total FROM filled")
def filled_days(t: Tables):
    return reshape.fill_days(_sparse(t), ["user_id"], "day")


@query("missing_days", "U6", f"{_FILLED} SELECT user_id, day FROM filled WHERE total IS NULL")
def missing_days(t: Tables):
    return reshape.missing_days(_sparse(t), ["user_id"], "day")


@query(
    "interpolated_days",
    "U7",
    f"""{_FILLED}, k AS (SELECT *, last_value(CASE WHEN total IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS ai, last_value(total IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS av,
      first_value(CASE WHEN total IS NOT NULL THEN i END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bi,
      first_value(total IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv FROM filled)
    SELECT user_id, day, round(CASE WHEN total IS NOT NULL THEN total WHEN i - ai <= 3 THEN coalesce(av + (bv - av) * (i - ai) / nullif(bi - ai, 0), av) END, 6) AS total FROM k""",
)
def interpolated_days(t: Tables):
    full = reshape.fill_days(_sparse(t), ["user_id"], "day")
    return reshape.interpolate(full, ["user_id"], "day", "total", "filled", 3).select("user_id", "day", F.round("filled", 6).alias("total"))


@query(
    "back_filled_days",
    "U8",
    f"""{_FILLED} SELECT user_id, day, first_value(total IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS total FROM filled""",
)
def back_filled_days(t: Tables):
    full = reshape.fill_days(_sparse(t), ["user_id"], "day")
    return reshape.back_fill(full, ["user_id"], "day", "total", "filled").select("user_id", "day", F.col("filled").alias("total"))


@query(
    "daily_totals",
    "A1 M1",
    f"WITH {DAILY} SELECT * FROM daily",
)
def daily_totals(t: Tables):
    return t.daily
