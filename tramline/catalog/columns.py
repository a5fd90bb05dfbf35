"""Scalar functions: keys, dates, text, geometry, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.catalog.base import DISTANCE, LAT, LON, Tables, date_key_sql, lat, lon, query, time_key_sql
from tramline.functions import dates, geo, keys, text, values


@query(
    "key_codecs",
    "F13 F12 F22 F23 R2",
    f"""SELECT event_id, {date_key_sql('ts')} AS date_key, {time_key_sql('ts')} AS time_key,
      date_trunc('minute', ts) AS decoded, time_bucket(INTERVAL 30 MINUTE, ts) AS half_hour,
      date_trunc('minute', ts) + to_seconds(floor(value * 10)::INT) AS delayed FROM events""",
)
def key_codecs(t: Tables):
    day, clock = keys.date_key(F.col("ts")), keys.time_key(F.col("ts"))
    decoded = keys.key_timestamp(day, clock)
    return t.events.select(
        "event_id",
        day.alias("date_key"),
        clock.alias("time_key"),
        decoded.alias("decoded"),
        keys.floor_minutes(F.col("ts"), 30).alias("half_hour"),
        keys.add_seconds(decoded, F.floor(F.col("value") * 10).cast("int")).alias("delayed"),
    )


@query(
    "unix_to_local",
    "F24",
    """SELECT event_id, to_timestamp(epoch(ts)::BIGINT) AT TIME ZONE 'Europe/Brussels' AS local_time FROM events""",
)
def unix_to_local(t: Tables):
    whole = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", "ts").cast("timestamp_ntz"))
    # The oracle rounds half seconds up.
    up = (F.date_format("ts", "SSSSSS").cast("int") >= 500000).cast("int")
    return t.events.select("event_id", keys.local_from_unix(whole + up, "Europe/Brussels").alias("local_time"))


@query(
    "calendar_of_orders",
    "F14 F15 F16 P26 U5 S16",
    f"""SELECT d AS full_date, {date_key_sql('d')} AS date_key, day(d)::INT AS day_of_month, isodow(d)::INT AS day_of_week,
      dayname(d) AS day_name_en,
      ['maandag','dinsdag','woensdag','donderdag','vrijdag','zaterdag','zondag'][isodow(d)] AS day_name_nl,
      ((day(d) - 1) // 7 + 1)::INT AS week_of_month, (datediff('day', date_trunc('quarter', d), d) + 1)::INT AS day_of_quarter,
      dayofyear(d)::INT AS day_of_year, (((dayofyear(d) - 1) // 7) % 13 + 1)::INT AS week_of_quarter, week(d)::INT AS week_of_year,
      isoyear(d)::INT AS iso_year, month(d)::INT AS month, monthname(d) AS month_name_en,
      ((month(d) - 1) % 3 + 1)::INT AS month_of_quarter, quarter(d)::INT AS quarter, 'Q' || quarter(d) AS quarter_name,
      year(d)::INT AS year, strftime(d, '%m-%Y') AS month_year, strftime(d, '%m%Y') AS mmyyyy, isodow(d) >= 6 AS is_weekend
    FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders)""",
)
def calendar_of_orders(t: Tables):
    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    columns = dates.calendar_columns(F.col("day"))
    chosen = [
        "full_date", "date_key", "day_of_month", "day_of_week", "day_name_en", "day_name_nl", "week_of_month",
        "day_of_quarter", "day_of_year", "week_of_quarter", "week_of_year", "month", "month_name_en",
        "month_of_quarter", "quarter", "quarter_name", "year", "month_year", "mmyyyy", "is_weekend",
    ]
    return days.select(*(columns[c].alias(c) for c in chosen), dates.iso_year(F.col("day")).alias("iso_year"))


@query(
    "period_starts",
    "F17 F18",
    """SELECT o_orderkey, o_orderdate::DATE AS day_start, date_trunc('week', o_orderdate)::DATE AS week_start,
      date_trunc('month', o_orderdate)::DATE AS month_start, date_trunc('year', o_orderdate)::DATE AS year_start,
      (o_orderdate::DATE - 7) AS week_ago FROM orders""",
)
def period_starts(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        *(dates.period_start(day, p).alias(f"{p}_start") for p in ("day", "week", "month", "year")),
        F.date_sub(day.cast("date"), 7).alias("week_ago"),
    )


@query(
    "clock_faces",
    "F25 B1 S15",
    """SELECT DISTINCT (hour(ts) * 100 + minute(ts))::INT AS time_key, strftime(ts, '%p') AS am_pm,
      strftime(ts, '%I')::INT AS hour12 FROM events""",
)
def clock_faces(t: Tables):
    """Minutes met in the data, by a join with the minute dimension."""
    from tramline.plans.builders import dim_time

    met = t.events.select(keys.time_key(F.col("ts")).alias("time_key")).distinct()
    return dim_time(t.spark).join(met, "time_key", "left_semi").select("time_key", "am_pm", "hour12")


@query(
    "text_cases",
    "F1 F2 F3 F9 F10 F11 P29",
    r"""SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand, trim(p_name) AS trimmed,
      array_to_string(list_transform(regexp_extract_all(lower(p_brand || '_' || p_name), '([a-z]+|[^a-z]+)'),
        lambda x: upper(x[1]) || x[2:]), '') AS titled,
      replace(p_brand, 'Brand#', '') AS brand_number, regexp_replace(lower(trim(p_brand || ' ' || p_name)), '[^a-z0-9_]', '_', 'g') AS safe_name,
      left(p_type, 3) AS type_head, substring(p_type, 2, 3) AS type_mid, p_size::VARCHAR AS size_text,
      nullif(trim(replace(p_type, 'SMALL', ' ')), '') AS blank_to_null FROM part""",
)
def text_cases(t: Tables):
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    return t.part.select(
        "p_partkey",
        F.upper(name).alias("upper_name"),
        F.lower(brand).alias("lower_brand"),
        F.trim(name).alias("trimmed"),
        text.title_case(F.concat_ws("_", brand, name)).alias("titled"),
        text.strip_prefix(brand, "Brand#").alias("brand_number"),
        text.safe_identifier(F.concat_ws(" ", brand, name)).alias("safe_name"),
        F.left(kind, F.lit(3)).alias("type_head"),
        F.substring(kind, 2, 3).alias("type_mid"),
        F.col("p_size").cast("string").alias("size_text"),
        F.trim(values.empty_to_null(F.replace(kind, F.lit("SMALL"), F.lit(" ")))).alias("blank_to_null"),
    )


@query(
    "padded_keys",
    "F12 F18",
    f"""SELECT o_orderkey, lpad((o_orderkey % 2400)::VARCHAR, 4, '0') AS padded, strftime(o_orderdate, '%Y%m%d') AS style112,
      {date_key_sql('o_orderdate')}::VARCHAR || '-' || o_orderstatus AS label,
      make_date(year(o_orderdate), month(o_orderdate), 1) AS month_first FROM orders""",
)
def padded_keys(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.lpad((F.col("o_orderkey") % 2400).cast("string"), 4, "0").alias("padded"),
        F.date_format(day, "yyyyMMdd").alias("style112"),
        F.concat_ws("-", keys.date_key(day).cast("string"), "o_orderstatus").alias("label"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("month_first"),
    )


@query(
    "parsed_dates",
    "F19 F20 F21",
    """SELECT o_orderkey, date_trunc('minute', day) AS parsed, month(day)::INT AS month_number,
      year(day)::INT AS year,
      ['jan','feb','mrt','apr','mei','jun','jul','aug','sep','okt','nov','dec'][month(day)] || '/' || strftime(day, '%y') AS short_period
    FROM (SELECT o_orderkey, o_orderdate + INTERVAL 20 YEAR AS day FROM orders)""",
)
def parsed_dates(t: Tables):
    """Two-digit years stand for 2000 and later, so the orders are moved there by twenty years."""
    day = F.col("o_orderdate")
    rows = t.orders.withColumn("o_orderdate", day + F.make_ym_interval(F.lit(20)))
    written = F.date_format(day, "dd/MM/yyyy HH:mm")
    short = dates.short_period(F.date_format(day, "MM/yyyy"))
    return rows.select(
        "o_orderkey",
        F.to_timestamp_ntz(written, F.lit("dd/MM/yyyy HH:mm")).alias("parsed"),
        dates.month_number(F.split(short, "/")[0]).alias("month_number"),
        dates.two_digit_year(F.split(short, "/")[1]).alias("year"),
        short.alias("short_period"),
    )


@query(
    "wkt_points",
    "F7 P6 P7 P15 P16",
    f"""SELECT c_custkey, round({LAT.format('c_custkey')}, 4) AS lat, round({LON.format('c_custkey')}, 4) AS lon,
      round(c_acctbal, 2) AS balance, round({LAT.format('c_custkey')}, 4) BETWEEN 49.4 AND 51.6 AS inside,
      (CASE WHEN c_custkey % 2 = 0 THEN 51.047 ELSE 50.8852 END)::DOUBLE AS repaired FROM customer""",
)
def wkt_points(t: Tables):
    point = F.format_string("POINT (%.4f %.4f)", lat("c_custkey"), lon("c_custkey"))
    first, second = text.wkt_point(point)
    comma = F.replace(F.format_string("%.2f", F.col("c_acctbal")), F.lit("."), F.lit(","))
    lost = F.when(F.col("c_custkey") % 2 == 0, F.lit("51047")).otherwise(F.lit("508852"))
    return t.customer.select(
        "c_custkey",
        first.alias("lat"),
        second.alias("lon"),
        values.lenient_number(comma).alias("balance"),
        geo.in_box(first, second).alias("inside"),
        geo.repair_latitude(lost).alias("repaired"),
    )


@query(
    "distances",
    "F26 F27 F28 F29 P5",
    f"""SELECT c_custkey, round({DISTANCE.format(a=LAT.format('c_custkey'), b=LON.format('c_custkey'), c='51.05', d='3.72')}, 3) AS metres,
      least(abs(c_custkey % 12 - c_nationkey % 12), 12 - abs(c_custkey % 12 - c_nationkey % 12))::INT AS month_gap,
      round_even(c_acctbal / 10, 0) AS half_even, greatest(c_acctbal, 0) AS floor0, pow(c_nationkey, 2)::DOUBLE AS squared,
      coalesce(nullif(c_mktsegment, 'MACHINERY'), 'none') AS segment FROM customer""",
)
def distances(t: Tables):
    gap = values.circular_distance((F.col("c_custkey") % 12).cast("int"), (F.col("c_nationkey") % 12).cast("int"))
    return t.customer.select(
        "c_custkey",
        F.round(geo.haversine_m(lat("c_custkey"), lon("c_custkey"), F.lit(51.05), F.lit(3.72)), 3).alias("metres"),
        gap.alias("month_gap"),
        values.half_even(F.col("c_acctbal") / 10).alias("half_even"),
        values.clip_floor(F.col("c_acctbal"), 0.0).alias("floor0"),
        F.pow("c_nationkey", F.lit(2)).alias("squared"),
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), F.lit("none")).alias("segment"),
    )


@query(
    "json_paths",
    "F30 S8 S9",
    """SELECT event_id, (props->>'k')::INT AS k, props->>'absent' AS absent FROM events""",
)
def json_paths(t: Tables):
    parsed = F.from_json("props", "k int, absent string")
    return t.events.select("event_id", parsed["k"].alias("k"), parsed["absent"].alias("absent"))
