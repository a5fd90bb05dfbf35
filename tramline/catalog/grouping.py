"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import Tables, query
from tramline.functions import values
from tramline.operators import aggregates, quantiles

_LEVELS = ["click", "error", "purchase", "signup", "view"]


@query(
    "grouped_measures",
    "A1 A3 A4 X1",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity, round(avg(l_extendedprice), 8) AS mean_price,
      min(l_discount) AS min_discount, max(l_tax) AS max_tax, count(DISTINCT l_partkey) AS parts,
      (sum(l_linenumber) // count(l_linenumber))::BIGINT AS mean_line FROM lineitem GROUP BY 1, 2""",
)
def grouped_measures(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.round(F.avg("l_extendedprice"), 8).alias("mean_price"),
        F.min("l_discount").alias("min_discount"),
        F.max("l_tax").alias("max_tax"),
        F.count_distinct("l_partkey").alias("parts"),
        values.truncated_average(F.col("l_linenumber")).alias("mean_line"),
    )


@query(
    "total_or_zero",
    "A2 X13",
    "SELECT coalesce(sum(l_quantity), 0) AS total, count(*) AS n FROM lineitem WHERE l_shipdate > TIMESTAMP '2090-01-01'",
)
def total_or_zero(t: Tables):
    return t.lineitem.filter("l_shipdate > timestamp_ntz '2090-01-01'").agg(
        F.coalesce(aggregates.total_or_zero("l_quantity"), F.lit(0.0)).alias("total"), F.count(F.lit(1)).alias("n")
    )


@query(
    "conditional_sums",
    "A5 A6",
    """SELECT user_id, sum(value) FILTER (hour(ts) BETWEEN 6 AND 9) IS NOT NULL AS has_morning, round(sum(CASE WHEN isodow(ts) >= 6 THEN value ELSE 0 END), 2) AS weekend,
      count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1 HAVING sum(value) > 1000""",
)
def conditional_sums(t: Tables):
    rows = t.gauge.groupBy("user_id").agg(
        F.sum(F.when(F.hour("ts").between(6, 9), F.col("value"))).isNotNull().alias("has_morning"),
        F.round(F.sum(F.when(F.weekday("day") >= 5, F.col("value")).otherwise(0.0)), 2).alias("weekend"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum("value").alias("total"),
    )
    return rows.filter("total > 1000").drop("total")


@query(
    "two_level_mean",
    "A8",
    """SELECT hour, round(avg(s), 8) AS mean_total FROM (SELECT user_id, ts::DATE AS d, hour(ts)::INT AS hour, sum(value) AS s FROM events GROUP BY 1, 2, 3) GROUP BY 1""",
)
def two_level_mean(t: Tables):
    return aggregates.mean_of_totals(t.gauge.withColumn("hour", F.hour("ts")), ["user_id", "day", "hour"], ["hour"], "value", "m").select("hour", F.round("m", 8).alias("mean_total"))


@query(
    "count_pivot",
    "A10 U4",
    "SELECT user_id, " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS {k}" for k in _LEVELS) + " FROM events GROUP BY 1",
)
def count_pivot(t: Tables):
    return aggregates.count_pivot(t.events, ["user_id"], "event_type", _LEVELS)


@query(
    "value_pivot",
    "A11 U4",
    "SELECT user_id, " + ", ".join(f"max(value) FILTER (event_type = '{k}') AS {k}" for k in _LEVELS) + " FROM events GROUP BY 1",
)
def value_pivot(t: Tables):
    tops = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    return aggregates.value_pivot(tops, ["user_id"], "event_type", "value", _LEVELS)


@query(
    "named_ratio",
    "A12 A13",
    """SELECT c_nationkey, count(*) AS members, sum((c_acctbal > 5000)::INT)::BIGINT AS rich, round(sum((c_acctbal > 5000)::INT) * 100.0 / count(*), 6) AS rich_pct,
      round(avg(c_acctbal), 8) AS mean_balance FROM customer GROUP BY 1""",
)
def named_ratio(t: Tables):
    rich = F.count_if(F.col("c_acctbal") > 5000)
    n = F.count(F.lit(1))
    return t.customer.groupBy("c_nationkey").agg(
        n.alias("members"), rich.alias("rich"), F.round(rich * 100.0 / n, 6).alias("rich_pct"), F.round(F.avg("c_acctbal"), 8).alias("mean_balance")
    )


_PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]


@query(
    "correlation_matrix",
    "A14",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS r FROM lineitem"
        for p in _PAIRS for a, b in (p, p[::-1])
    ) + " UNION ALL SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS a, unnest(['l_quantity', 'l_extendedprice', 'l_discount']) AS b, 1.0::DOUBLE AS r",
)
def correlation_matrix(t: Tables):
    long = aggregates.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return long.select("a", "b", F.round("r", 8).alias("r"))


@query(
    "quartiles",
    "A15 X6",
    """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q75 FROM events GROUP BY 1""",
)
def quartiles(t: Tables):
    cuts = quantiles.exact_quantiles(t.events, ["event_type"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return cuts.select("event_type", *(F.round(c, 6).alias(c) for c in ("q25", "median", "q75")))


@query(
    "described",
    "A16 X7",
    """SELECT l_returnflag, count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
      round(quantile_cont(l_extendedprice, 0.25), 6) AS q25, round(quantile_cont(l_extendedprice, 0.5), 6) AS q50, round(quantile_cont(l_extendedprice, 0.75), 6) AS q75, max(l_extendedprice) AS max FROM lineitem GROUP BY 1""",
)
def described(t: Tables):
    d = quantiles.describe(t.lineitem, ["l_returnflag"], "l_extendedprice")
    digits = {"mean": 4, "std": 4, "q25": 6, "q50": 6, "q75": 6}
    return d.select(*(F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in d.columns))


@query(
    "largest_rows",
    "A17",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)",
)
def largest_rows(t: Tables):
    return t.orders.filter(F.col("o_totalprice") == t.orders.agg(F.max("o_totalprice")).scalar()).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "product_sum",
    "A18",
    """SELECT p_type, round(sum(l_quantity * p_retailprice), 2) AS emission FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def product_sum(t: Tables):
    """Quantities are summed per part before the part table joins."""
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    joined = per_part.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_type").agg(F.round(F.sum(F.col("quantity") * F.col("p_retailprice")), 2).alias("emission"))


@query(
    "duplicate_keys",
    "A19 A6 K4",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(t: Tables):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


@query(
    "histogram50",
    "A20 M3",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT least(floor((value - lo) / ((hi - lo) / 50)), 49)::INT AS bin, round(lo + bin * (hi - lo) / 50, 6) AS lower, count(*) AS n FROM events, e GROUP BY 1, lo, hi""",
)
def histogram50(t: Tables):
    return aggregates.histogram(t.events, "value", 50).select("bin", F.round("lower", 6).alias("lower"), "n")


_SCORED = """scored AS (SELECT event_id, event_type AS truth, CASE WHEN (props->>'k')::INT < 60 THEN event_type ELSE ['click','error','purchase','signup','view'][((props->>'k')::INT % 5) + 1] END AS predicted FROM events)"""


def _scored(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    guess = F.element_at(F.array(*map(F.lit, _LEVELS)), k % 5 + 1)
    return t.events.select("event_id", F.col("event_type").alias("truth"), F.when(k < 60, F.col("event_type")).otherwise(guess).alias("predicted"))


@query(
    "confusion_matrix",
    "A21",
    f"""WITH {_SCORED} SELECT truth, predicted, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY truth), 8) AS row_share FROM scored GROUP BY 1, 2""",
)
def confusion_matrix(t: Tables):
    return aggregates.confusion(_scored(t), "truth", "predicted").withColumn("row_share", F.round("row_share", 8))


@query(
    "accuracy_per_class",
    "A22",
    f"""WITH {_SCORED} SELECT truth, round(avg((truth = predicted)::INT), 8) AS accuracy FROM scored GROUP BY 1""",
)
def accuracy_per_class(t: Tables):
    hit = (F.col("truth") == F.col("predicted")).cast("int")
    return _scored(t).groupBy("truth").agg(F.round(F.avg(hit), 8).alias("accuracy"))


@query(
    "error_shares",
    "A23",
    """SELECT least(abs(k - 50), 100 - abs(k - 50))::INT AS gap, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 8) AS pct FROM (SELECT (props->>'k')::INT AS k FROM events) GROUP BY 1""",
)
def error_shares(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    gaps = t.events.select(values.circular_distance(k, F.lit(50), 100).alias("gap"))
    return aggregates.share_of_categories(gaps, [], "gap").select("gap", "n", F.round(F.col("share") * 100.0, 8).alias("pct"))


@query(
    "modal_shares",
    "A24 M10",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment), 8) AS share
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def modal_shares(t: Tables):
    from tramline.plans.reports import modal_split

    trips = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return modal_split(trips, ["c_mktsegment"], "o_orderpriority").withColumn("share", F.round("share", 8))


@query(
    "class_report",
    "N13 N5",
    f"""WITH {_SCORED}, c AS (SELECT label, count(*) FILTER (label = truth AND label = predicted) AS tp, count(*) FILTER (label = truth) AS support, count(*) FILTER (label = predicted) AS pred
      FROM scored, (SELECT unnest(['click','error','purchase','signup','view']) AS label) GROUP BY 1)
    SELECT label, round(tp / pred, 8) AS precision, round(tp / support, 8) AS recall, round(2 * (tp / pred) * (tp / support) / (tp / pred + tp / support), 8) AS f1, support FROM c""",
)
def class_report(t: Tables):
    r = aggregates.class_report(_scored(t), "truth", "predicted")
    return r.select("label", *(F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")), "support")


@query(
    "binary_scores",
    "N5 A21",
    """WITH s AS (SELECT user_id % 10 AS grp, value > 80 AS t, (props->>'k')::INT > 50 AS p FROM events), c AS (SELECT grp, count(*) FILTER (t AND p) AS tp, count(*) FILTER (NOT t AND p) AS fp, count(*) FILTER (t AND NOT p) AS fn, count(*) FILTER (NOT t AND NOT p) AS tn FROM s GROUP BY 1)
    SELECT *, round(coalesce(tp / nullif(tp + fp, 0), 0), 8) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 8) AS recall,
      round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 8) AS f1 FROM c""",
)
def binary_scores(t: Tables):
    rows = t.events.select(
        (F.col("user_id") % 10).alias("grp"), (F.col("value") > 80).cast("int").alias("t"), (F.get_json_object("props", "$.k").cast("int") > 50).cast("int").alias("p")
    )
    r = aggregates.binary_scores(rows, "t", "p", ["grp"])
    return r.select("grp", "tp", "fp", "fn", "tn", *(F.round(c, 8).alias(c) for c in ("precision", "recall", "f1")))


@query(
    "event_metrics",
    "A25",
    """SELECT event_type AS endpoint, count(*) AS requests, count(*) FILTER ((props->>'k')::INT >= 40) AS errors, round(avg(value), 6) AS avg_ms,
      max(value) AS max_ms, min(value) AS min_ms, max_by((props->>'k')::INT, ts) AS last_status FROM events GROUP BY 1""",
)
def event_metrics(t: Tables):
    """Endpoint metrics over events: value as duration, k * 10 as status."""
    from tramline.sources.access_log import endpoint_metrics

    k = F.get_json_object("props", "$.k").cast("int")
    log = t.events.select(F.col("event_type").alias("endpoint"), (k * 10).alias("status"), F.col("value").alias("duration_ms"), F.col("ts").alias("logged_at"))
    m = endpoint_metrics(log)
    return m.withColumns({"avg_ms": F.round("avg_ms", 6), "last_status": (F.col("last_status") / 10).cast("int")})


@query(
    "table_census",
    "A26 Q5",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in ("customer", "supplier", "part", "nation")),
)
def table_census(t: Tables):
    return aggregates.row_census({n: getattr(t, n) for n in ("customer", "supplier", "part", "nation")})


@query(
    "missing_values",
    "K22",
    """SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS missing, count(*) AS rows FROM documents
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL), count(*) FROM documents LEFT JOIN labels USING (doc_id)
    UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL), count(*) FROM documents""",
)
def missing_values(t: Tables):
    rows = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return aggregates.missing_census(rows.select("doc_id", "quality", "lang"))


@query(
    "cte_chain",
    "U9 S1",
    """WITH d AS (SELECT user_id, ts::DATE AS day, sum(value) AS total FROM events GROUP BY 1, 2), m AS (SELECT user_id, max(total) AS top FROM d GROUP BY 1)
    SELECT d.user_id, min(d.day) AS best_day, round(max(m.top), 2) AS top FROM d JOIN m ON d.user_id = m.user_id AND d.total = m.top GROUP BY 1""",
)
def cte_chain(t: Tables):
    return t.spark.sql(
        """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS total FROM {events} GROUP BY ALL),
        m AS (SELECT user_id, max_by(day, struct(total, -unix_date(day))) AS best_day, max(total) AS top FROM d GROUP BY user_id)
        SELECT user_id, best_day, round(top, 2) AS top FROM m""",
        events=t.events,
    )
