"""Warehouse builders fed from the shared tables."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import functions as F

from tramline.catalog.base import DISTANCE, LAT, LON, Tables, date_key_sql, lat, lon, query
from tramline.functions import text, values
from tramline.operators import incremental, reshape
from tramline.plans import builders, waves
from tramline.session import checkpoint_dir


def _locations(t: Tables):
    """Nations as locations: postal code = key, municipality in title case."""
    return t.nation.select(F.col("n_nationkey").alias("location_key"), F.col("n_nationkey").alias("postal_code"), text.title_case(F.col("n_name")).alias("municipality"))


def _geocodes(places, key: str, la: str, lo: str):
    """Landed geocodes: an unambiguous postal code for each position."""
    return places.groupBy(F.col(la).alias("latitude"), F.col(lo).alias("longitude")).agg(
        (F.min(key) % 25).cast("int").alias("postal_code"), F.lit(None).cast("int").alias("alt_postal_code"), F.lit(None).cast("string").alias("alt_municipality")
    )


def _spot_sql(key: str, name: str) -> str:
    """Location of a place: that of the smallest key at its position."""
    return f"(min({key}) OVER (PARTITION BY {LAT.format(key)}, {LON.format(key)}) % 25)::INT AS {name}"


@query(
    "built_calendar",
    "B2 B28 S16 C13 C14 P26",
    f"""WITH days AS (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS d FROM orders),
    feast AS (SELECT DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT AS d, max(c_name) AS n FROM customer GROUP BY 1),
    span AS (SELECT DATE '1995-01-01' + (s_suppkey * 53 % 2300)::INT AS s, DATE '1995-01-01' + (s_suppkey * 53 % 2300 + s_suppkey % 20)::INT AS e, s_name FROM supplier),
    school AS (SELECT d, max_by(s_name, s) AS n FROM days JOIN span ON d BETWEEN s AND e GROUP BY 1)
    SELECT {date_key_sql('days.d')} AS date_key, feast.n IS NOT NULL AS is_holiday, feast.n AS holiday_name, isodow(days.d) >= 6 AS is_weekend, isodow(days.d) < 6 AND feast.n IS NULL AS is_working_day,
      school.n IS NOT NULL AS is_school_holiday, school.n AS school_holiday_name FROM days LEFT JOIN feast USING (d) LEFT JOIN school USING (d)""",
)
def built_calendar(t: Tables):
    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    start = F.lit(date(1995, 1, 1))
    feast = t.customer.select(F.date_add(start, (F.col("c_custkey") * 37 % 2400).cast("int")).alias("date"), F.col("c_name").alias("localName"))
    first = (F.col("s_suppkey") * 53 % 2300).cast("int")
    school = t.supplier.select(
        F.date_add(start, first).alias("startDate"), F.date_add(start, first + (F.col("s_suppkey") % 20).cast("int")).alias("endDate"), F.array(F.struct(F.col("s_name").alias("text"))).alias("name")
    )
    out = builders.dim_date(days, feast, school)
    return out.select("date_key", "is_holiday", "holiday_name", "is_weekend", "is_working_day", "is_school_holiday", "school_holiday_name")


@query(
    "built_locations",
    "B3 F1 P2 C5",
    """SELECT n_nationkey AS postal_code, 'Nation_' || n_nationkey AS municipality, array_to_string(list_transform(string_split(r_name, ' '), lambda x: upper(x[1]) || lower(x[2:])), ' ') AS main_municipality,
      r_name AS province FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 > 0""",
)
def built_locations(t: Tables):
    codes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("Postcode"), F.col("n_name").alias("Plaatsnaam"), F.col("r_name").alias("Hoofdgemeente"), F.col("r_name").alias("Provincie")
    )
    existing = builders.dim_location(codes.filter("Postcode % 4 = 0"))
    return builders.dim_location(codes.unionByName(codes), existing)


@query(
    "built_transport_types",
    "B4 S5 C5",
    "SELECT DISTINCT p_brand AS vehicle_type, length(p_brand) / 100.0::DOUBLE AS co2_per_km FROM part WHERE p_brand NOT LIKE '%#1%'",
)
def built_transport_types(t: Tables):
    rates = t.part.select(F.col("p_brand").alias("VehicleType"), (F.length("p_brand") / 100.0).alias("CO2PerKM")).distinct()
    existing = rates.filter(F.col("VehicleType").contains("#1")).select(F.col("VehicleType").alias("vehicle_type"))
    return builders.dim_transport_type(rates, existing)


def _head_count(t: Tables):
    """Orders per market segment and month as departmental head count."""
    rows = t.orders.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.groupBy(F.year("o_orderdate").alias("JAAR"), F.month("o_orderdate").alias("MAAND"), F.col("c_mktsegment").alias("Entiteit")).agg(F.count(F.lit(1)).alias("aantal"))


def _departments(t: Tables):
    """Segments with the smallest customer key as department key."""
    return t.customer.groupBy(F.col("c_mktsegment").alias("department_name")).agg(F.min("c_custkey").cast("int").alias("department_key"))


@query(
    "built_departments",
    "B5 R15 P4",
    "SELECT DISTINCT c_mktsegment AS department_name, 20260209 AS start_date, 20261231 AS end_date FROM customer WHERE c_mktsegment <> 'BUILDING'",
)
def built_departments(t: Tables):
    existing = _departments(t).filter("department_name = 'BUILDING'")
    return builders.dim_department(_head_count(t), date(2026, 2, 9), existing)


@query(
    "built_head_count",
    "B19 C2",
    """SELECT (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1)::INT AS date_key, k AS department_key, count(*) AS workers FROM orders JOIN customer ON o_custkey = c_custkey
      LEFT JOIN (SELECT c_mktsegment AS s, min(c_custkey)::INT AS k FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1) ON s = c_mktsegment GROUP BY 1, 2, c_mktsegment""",
)
def built_head_count(t: Tables):
    return builders.fact_department(_head_count(t), _departments(t).filter("department_name <> 'MACHINERY'"))


def _later(t: Tables):
    """Orders with two-digit years that stand for 2000 and later."""
    return t.orders.withColumn("o_orderdate", F.col("o_orderdate") + F.make_ym_interval(F.lit(20)))


def _commutes(t: Tables):
    """Orders, twenty years later, per customer and month in wide reimbursement form, decimal comma."""
    months = F.array(*map(F.lit, ["jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec"]))
    rows = _later(t).join(t.customer.select("c_custkey", "c_mktsegment", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    named = rows.select(
        F.col("o_custkey").alias("PersoneelsID"), F.col("c_mktsegment").alias("Entiteit"), F.concat(F.lit("Campus "), "c_nationkey").alias("Hoofdcampus"),
        F.concat(F.get(months, F.month("o_orderdate") - 1), F.lit("/"), F.date_format("o_orderdate", "yy")).alias("periode"), "o_orderdate", "o_totalprice",
    )
    days = [
        F.concat(F.sum(F.when(F.dayofmonth("o_orderdate") == i, F.round(F.col("o_totalprice") / 100).cast("long"))).cast("string"), F.lit(",50")).alias(f"dag {i}")
        for i in range(1, 32)
    ]
    return named.groupBy("PersoneelsID", "Entiteit", "Hoofdcampus", "periode").agg(*days)


def _commute_parts(t: Tables):
    paper = _commutes(t)
    return builders.combined_commutes(paper.filter("PersoneelsID % 4 > 0"), paper.filter("PersoneelsID % 4 = 0").drop("Hoofdcampus").withColumnRenamed("PersoneelsID", "staff_id"))


@query(
    "built_staff",
    "B11 S7 U1 C2 P10",
    """SELECT DISTINCT o_custkey::VARCHAR AS staff_id, k AS department_key, CASE WHEN o_custkey % 4 > 0 THEN 'Campus ' || c_nationkey END AS campus FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN (SELECT c_mktsegment AS s, min(c_custkey)::INT AS k FROM customer GROUP BY 1) ON s = c_mktsegment WHERE o_custkey % 5 > 0""",
)
def built_staff(t: Tables):
    existing = t.customer.filter("c_custkey % 5 = 0").select(F.col("c_custkey").cast("string").alias("staff_id"))
    staff = builders.dim_staff(_commute_parts(t), _departments(t), existing)
    return staff.withColumn("staff_id", F.col("staff_id").cast("string"))


@query(
    "built_staff_commute",
    "B17 U1 U3 P7 P17 F20 C3 C5",
    f"""WITH d AS (SELECT o_custkey, o_orderdate + INTERVAL 20 YEAR AS day, sum(round(o_totalprice / 100)::BIGINT) AS km FROM orders GROUP BY 1, 2)
    SELECT (o_custkey + 100000)::INT AS staff_key, {date_key_sql('day')} AS date_key, ['jan','feb','mrt','apr','mei','jun','jul','aug','sep','okt','nov','dec'][month(day)] || '/' || strftime(day, '%y') AS period, (km + 0.5)::DOUBLE AS distance_km FROM d WHERE o_custkey % 3 > 0""",
)
def built_staff_commute(t: Tables):
    staff = t.customer.filter("c_custkey % 3 > 0").select((F.col("c_custkey") + 100000).cast("int").alias("staff_key"), F.col("c_custkey").alias("staff_id"))
    span = _later(t).agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    day = F.explode(F.sequence("lo", "hi", F.expr("interval 1 day")))
    calendar = span.select(day.alias("d")).select(
        (F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")).alias("date_key"), F.dayofmonth("d").alias("day_of_month"), F.month("d").alias("month"), F.year("d").alias("year")
    )
    fact = builders.fact_staff_commute(_commute_parts(t), staff, calendar)
    return fact.withColumn("distance_km", F.col("distance_km").cast("double"))


_MODES = {"click": "Openbaar vervoer - trein", "view": "Fiets", "signup": "Te voet", "purchase": "Auto"}


def _registrations(t: Tables):
    """Events as student registrations; errors carry an unknown vehicle."""
    mode = F.coalesce(values.map_values(F.col("event_type"), _MODES), F.lit("Zeppelin"))
    return t.events.select(
        F.concat(F.lit(" Student "), F.col("user_id").cast("string"), F.lit(" ")).alias("Naam"), F.col("ts").cast("string").alias("Begintijd"),
        F.col("value").alias("Km"), F.concat(mode, F.lit(" ")).alias("Vervoermiddel"),
    )


@query(
    "built_students",
    "B12 F2 P10 C2 P9",
    """SELECT DISTINCT 'Student ' || user_id AS student_name, (SELECT min(c_custkey)::INT FROM customer WHERE c_mktsegment = 'BUILDING') AS department_key
    FROM events WHERE user_id % 3 > 0""",
)
def built_students(t: Tables):
    departments = _departments(t)
    existing = t.events.filter("user_id % 3 = 0").select(F.concat(F.lit("Student "), F.col("user_id").cast("string")).alias("student_name"))
    return builders.dim_student(_registrations(t), departments, existing, "BUILDING")


@query(
    "built_student_trips",
    "B20 F13 C6 P11 P18 R14",
    f"""SELECT user_id::INT AS student_key, {date_key_sql('ts')} AS date_key, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 4 ELSE 3 END AS transport_key, value AS distance_km
    FROM events WHERE event_type <> 'error' AND day(ts) <= 20""",
)
def built_student_trips(t: Tables):
    """'Te voet' is missing from the transport dimension and is added first."""
    registrations = _registrations(t)
    calendar = t.gauge.filter("dayofmonth(day) <= 20").select((F.year("day") * 10000 + F.month("day") * 100 + F.dayofmonth("day")).alias("date_key")).distinct()
    students = t.events.select(F.col("user_id").cast("int").alias("student_key"), F.concat(F.lit("Student "), F.col("user_id").cast("string"), F.lit(" ")).alias("student_name")).distinct()
    kinds = t.events.select(values.map_values(F.col("event_type"), {"click": "Trein", "view": "Fiets", "purchase": "Auto"}).alias("vehicle_type")).filter("vehicle_type IS NOT NULL").distinct()
    known = kinds.withColumn("transport_key", values.map_values(F.col("vehicle_type"), {"Trein": 1, "Fiets": 2, "Auto": 3}))
    late = incremental.late_members(builders.student_trips(registrations, calendar), "vehicle_type", known, "vehicle_type")
    transport = known.unionByName(late.select("vehicle_type", F.lit(4).alias("transport_key")))
    return builders.fact_student_mobility(registrations, calendar, students, transport)


def _survey(t: Tables):
    """Customers as survey answers: codes times ten, coordinates that lost their point."""
    k = F.col("c_custkey")
    ten = lambda c: (c * 10).cast("double")
    return t.customer.select(
        F.concat(F.lit("R_"), k.cast("string")).alias("ResponseId"), F.date_format(F.date_add(F.lit(date(2024, 1, 1)), (k % 300).cast("int")), "dd/MM/yyyy 09:30").alias("RecordedDate"),
        F.when(k % 10 == 0, 70111).otherwise(51000 + k % 100 * 10 + 1).cast("int").alias("LocationLatitude"), F.lit(37123).alias("LocationLongitude"),
        ten(F.col("c_nationkey")).alias("werkplek"), ten(k % 2).alias("Finished"), ten(k % 30).alias("functie"), ten(k % 3).alias("werk__"), ten(k % 4).alias("thuiswerk"),
        (k % 90).cast("int").alias("pendeltijd"), (k % 60 + 0.5).alias("pendelafstand"), ten(k % 4 + 15).alias("vervoermiddel"),
    )


def _labels(t: Tables):
    """Label sets out of the nations; travel labels are four of the survey's answers."""
    travel = F.array(F.lit("Trein"), F.lit("Te voet"), F.lit("Bus, tram of metro"))
    sets = F.array(
        *(F.struct(F.lit(s).alias("label_set"), F.col("n_nationkey").cast("double").alias("code"), F.concat(F.lit(f"{s}:"), "n_name").alias("label")) for s in ("labels3", "labels195", "labels7", "labels8")),
        F.struct(F.lit("labels4").alias("label_set"), (F.col("n_nationkey") + 15).cast("double").alias("code"), F.get(travel, F.col("n_nationkey")).alias("label")),
    )
    return t.nation.select(F.inline(sets))


@query(
    "built_workers",
    "B9 P13 P14 P15 P16 F19 J1",
    """WITH n AS (SELECT n_nationkey AS k, n_name AS v FROM nation), s AS (SELECT *, CASE WHEN c_custkey % 10 = 0 THEN 70.111 ELSE (51000 + c_custkey % 100 * 10 + 1) / 1000.0 END::DOUBLE AS la FROM customer)
    SELECT 'R_' || c_custkey AS response_id, (strftime(DATE '2024-01-01' + (c_custkey % 300)::INT, '%Y%m%d'))::INT AS record_date, CASE WHEN la <= 51.6 THEN 7 END AS location_key, round(la, 4) AS latitude, 3.7123::DOUBLE AS longitude,
      'labels3:' || a.v AS work_place, 'labels195:' || b.v AS work_function, 'labels7:' || c.v AS work_regime, 'labels8:' || d.v AS home_work, (c_custkey % 2)::DOUBLE AS finished
    FROM s LEFT JOIN n a ON a.k = c_nationkey LEFT JOIN n b ON b.k = c_custkey % 30 LEFT JOIN n c ON c.k = c_custkey % 3 LEFT JOIN n d ON d.k = c_custkey % 4 WHERE c_custkey % 6 > 0""",
)
def built_workers(t: Tables):
    survey = _survey(t)
    spots = survey.select((F.col("LocationLatitude") / 1000.0).alias("latitude"), (F.col("LocationLongitude") / 10000.0).alias("longitude")).distinct()
    geocodes = spots.select("*", F.lit(7).alias("postal_code"), F.lit(None).cast("int").alias("alt_postal_code"), F.lit(None).cast("string").alias("alt_municipality"))
    existing = t.customer.filter("c_custkey % 6 = 0").select(F.concat(F.lit("R_"), F.col("c_custkey").cast("string")).alias("response_id"))
    out = builders.dim_worker(survey, _labels(t), geocodes, _locations(t), existing)
    return out.withColumn("latitude", F.round("latitude", 4))


@query(
    "built_worker_trips",
    "B18 P11 P13 C3 C4 A18",
    """SELECT CASE WHEN c_custkey % 8 > 0 THEN c_custkey::INT END AS worker_id, (strftime(DATE '2024-01-01' + (c_custkey % 300)::INT, '%Y%m%d'))::INT AS date_key,
      CASE c_custkey % 4 WHEN 0 THEN 5 WHEN 2 THEN 6 END AS transport_key, (c_custkey % 90)::DOUBLE AS travel_time, (c_custkey % 60 + 0.5)::DOUBLE AS travel_distance,
      CASE c_custkey % 4 WHEN 0 THEN round((c_custkey % 60 + 0.5) * 0.02, 5) WHEN 2 THEN round((c_custkey % 60 + 0.5) * 0.03, 5) END::DOUBLE AS total_emission FROM customer""",
)
def built_worker_trips(t: Tables):
    survey = _survey(t)
    workers = t.customer.filter("c_custkey % 8 > 0").select(
        F.col("c_custkey").cast("int").alias("worker_id"), F.concat(F.lit("R_"), F.col("c_custkey").cast("string")).alias("response_id"),
        F.date_format(F.date_add(F.lit(date(2024, 1, 1)), (F.col("c_custkey") % 300).cast("int")), "yyyyMMdd").cast("int").alias("record_date"),
    )
    transport = t.nation.filter("n_nationkey IN (5, 6)").select(
        F.col("n_nationkey").alias("transport_key"), F.when(F.col("n_nationkey") == 5, "Trein").otherwise("Bus").alias("vehicle_type"), F.when(F.col("n_nationkey") == 5, 0.02).otherwise(0.03).alias("co2_per_km")
    )
    fact = builders.fact_worker_mobility(survey, _labels(t), workers, transport)
    return fact.withColumn("total_emission", F.col("total_emission").cast("double"))


def _weather_feed(t: Tables):
    from tramline.plans.schemas import WEATHER_COLUMNS

    sums = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("code"), F.col("l_shipdate").alias("timestamp")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    others = [c for c in WEATHER_COLUMNS if c not in ("code", "temp_avg", "precip_quantity")]
    return sums.select(
        "code", "timestamp", F.lit("f").alias("FID"), F.lit("{}").alias("qc_flags"), F.lit("POINT (0 0)").alias("the_geom"),
        (F.col("q") - 30).alias("precip_quantity"), F.col("q").alias("temp_avg"), *(F.lit(1.0).alias(c) for c in others),
    )


@query(
    "built_weather",
    "B13 S6 S20 P2 P3 P8 C5 F13",
    f"""SELECT l_suppkey::VARCHAR AS weather_station_key, {date_key_sql('l_shipdate')} AS date_key, greatest(sum(l_quantity) - 30, 0) AS precip_quantity, sum(l_quantity) AS temp_avg FROM lineitem WHERE year(l_shipdate) > 1996 GROUP BY l_suppkey, l_shipdate""",
)
def built_weather(t: Tables):
    feed = _weather_feed(t)
    existing = builders.fact_weather(feed.filter("year(timestamp) <= 1996"))
    return builders.fact_weather(feed, existing).select("weather_station_key", "date_key", "precip_quantity", "temp_avg")


@query(
    "built_weather_day",
    "B27 S17",
    """SELECT l_suppkey::VARCHAR AS weather_station_key, 19980304 AS date_key, sum(l_quantity) AS temp_avg FROM lineitem WHERE l_shipdate::DATE = DATE '1998-03-04' GROUP BY l_suppkey""",
)
def built_weather_day(t: Tables):
    return builders.fact_weather(_weather_feed(t), day=date(1998, 3, 4)).select("weather_station_key", "date_key", "temp_avg")


@query(
    "built_gauge",
    "B14 S8 C2 C6 P4 C12 R12 P18",
    f"""SELECT c_custkey::INT AS bike_station_key, c_nationkey AS total_available, (c_custkey % 5)::INT AS bikes_in_use, 20260321 AS date_key, 830 AS time_key,
      (SELECT min_by(s_suppkey, (d, s_suppkey)) FROM (SELECT s_suppkey, {DISTANCE.format(a=LAT.format('c.c_custkey'), b=LON.format('c.c_custkey'), c=LAT.format('s_suppkey'), d=LON.format('s_suppkey'))} AS d FROM supplier) WHERE d <= 500)::INT AS linked_station_key
    FROM customer c WHERE c_custkey % 9 > 0""",
)
def built_gauge(t: Tables):
    feed = t.customer.select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_nationkey").alias("total_bikes_available"), F.lit(0).alias("e_bikes_available"), F.lit(0).alias("blue_bikes_available"), F.lit(30).alias("max_capacity"), F.lit(0).alias("bikes_defect")
    )
    in_use = t.customer.select(F.col("c_custkey").cast("int").alias("id"), (F.col("c_custkey") % 5).cast("int").alias("bikes_in_use"))
    stations = t.customer.filter("c_custkey % 9 > 0").select(F.col("c_custkey").cast("int").alias("bike_station_key"), lat("c_custkey").alias("latitude"), lon("c_custkey").alias("longitude"))
    rail = t.supplier.select(F.col("s_suppkey").cast("int").alias("station_key"), lat("s_suppkey").alias("latitude"), lon("s_suppkey").alias("longitude"))
    out = builders.fact_bike_gauge(feed, in_use, stations, rail, datetime(2026, 3, 21, 8, 30))
    return out.select("bike_station_key", "total_available", "bikes_in_use", "date_key", "time_key", "linked_station_key")


@query(
    "built_counts",
    "B15 P5 F13 C6",
    f"""SELECT o_custkey::INT AS counting_point_id, {date_key_sql('o_orderdate')} AS date_key, count(*) FILTER (o_orderstatus = 'F')::INT AS direction_in, count(*) FILTER (o_orderstatus <> 'F')::INT AS direction_out, count(*)::INT AS total
    FROM orders WHERE o_custkey % 4 > 0 GROUP BY 1, 2""",
)
def built_counts(t: Tables):
    counts = t.orders.groupBy(F.col("o_custkey").alias("counting_point_id"), F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("direction_in"), F.count_if(F.col("o_orderstatus") != "F").alias("direction_out"), F.count(F.lit(1)).alias("total")
    )
    points = t.customer.filter("c_custkey % 4 > 0").select(F.col("c_custkey").cast("int").alias("counting_point_id"))
    return builders.fact_counts(counts, points)


@query(
    "built_bike_stations",
    "B6 C5 C15 S8",
    f"""SELECT * FROM (SELECT c_custkey AS bike_station_key, c_name AS location_name, {_spot_sql('c_custkey', 'location_key')} FROM customer) WHERE bike_station_key % 3 > 0""",
)
def built_bike_stations(t: Tables):
    feed = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), lat("c_custkey").alias("latitude"), lon("c_custkey").alias("longitude"))
    existing = feed.filter("id % 3 = 0").select(F.col("id").alias("bike_station_key"))
    out = builders.dim_bike_station(feed, _geocodes(feed, "id", "latitude", "longitude"), _locations(t), existing)
    return out.select("bike_station_key", "location_name", "location_key")


@query(
    "built_rail_stations",
    "B7 S6 F3 C11 P10 C5 C15 J2",
    f"""SELECT * FROM (SELECT s_suppkey::VARCHAR AS uri, s_name AS station_name, {_spot_sql('s_suppkey', 'location_key')} FROM supplier) x WHERE EXISTS (SELECT 1 FROM customer WHERE
      {DISTANCE.format(a=LAT.format('c_custkey'), b=LON.format('c_custkey'), c=LAT.format('x.uri::BIGINT'), d=LON.format('x.uri::BIGINT'))} <= 500)""",
)
def built_rail_stations(t: Tables):
    rail = t.supplier.select(
        F.concat(F.lit("http://irail.be/stations/NMBS/"), F.col("s_suppkey").cast("string")).alias("URI"), F.col("s_name").alias("name"), lat("s_suppkey").alias("latitude"), lon("s_suppkey").alias("longitude"), "s_suppkey"
    )
    bikes = t.customer.select(lat("c_custkey").alias("latitude"), lon("c_custkey").alias("longitude"))
    out = builders.dim_station(rail, bikes, _geocodes(rail, "s_suppkey", "latitude", "longitude"), _locations(t))
    return out.select("uri", "station_name", "location_key")


@query(
    "built_weather_stations",
    "B8 F7 P6 R16",
    f"""SELECT s_suppkey::VARCHAR AS weather_station_id, s_name AS name, s_acctbal AS altitude, {_spot_sql('s_suppkey', 'location_key')}, DATE '2026-03-20' AS snapshot_date FROM supplier""",
)
def built_weather_stations(t: Tables):
    spots = t.supplier.select("*", F.round(lat("s_suppkey"), 4).alias("la"), F.round(lon("s_suppkey"), 4).alias("lo"))
    feed = spots.select(
        F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("string").alias("altitude"), F.format_string("POINT (%.4f %.4f)", "la", "lo").alias("the_geom")
    )
    geocodes = _geocodes(spots, "s_suppkey", "la", "lo")
    out = builders.dim_weather_station(feed, geocodes, _locations(t), date(2026, 3, 20))
    return out.select("weather_station_id", "name", "altitude", "location_key", "snapshot_date")


@query(
    "built_points",
    "B10 S12 P1 P9 P30 P5 C15",
    f"""SELECT * FROM (SELECT c_custkey::INT AS counting_point_id, c_name AS counting_point_name, c_custkey % 2 = 0 AS directional, {_spot_sql('c_custkey', 'location_key')} FROM customer) WHERE counting_point_id % 10 > 0 AND location_key < 20""",
)
def built_points(t: Tables):
    rows = t.customer.select("*", lat("c_custkey").alias("latitude"), lon("c_custkey").alias("longitude"))
    text_columns = ["custom_id", "first_data", "granularity", "direction_name_in", "direction_name_out", "domain_name", "description"]
    catalogue = reshape.ensure_columns(
        rows.select(F.col("c_custkey").alias("counting_point_id"), F.col("c_name").alias("name"), "latitude", "longitude", F.when(F.col("c_custkey") % 2 == 0, "true").otherwise("false").alias("directional")),
        {**dict.fromkeys(text_columns, "string"), "domain_id": "int"},
    )
    known = t.customer.filter("c_custkey % 10 = 0").select(F.col("c_custkey").cast("int").alias("counting_point_id"))
    out = builders.dim_counting_point(catalogue, _geocodes(rows, "c_custkey", "latitude", "longitude"), _locations(t).filter("location_key < 20"), known)
    return out.select("counting_point_id", "counting_point_name", "directional", "location_key")


@query(
    "loaded_waves",
    "B22 B23 B25 S2 S3 S19 K13 B5 B19 B21",
    """WITH d AS (SELECT row_number() OVER (ORDER BY CASE WHEN s = 'MACHINERY' THEN 1 ELSE 0 END, s)::INT AS department_key, s FROM (SELECT DISTINCT c_mktsegment AS s FROM customer))
    SELECT department_key, s AS department_name, (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1)::INT AS date_key, count(*) AS workers FROM orders JOIN customer ON o_custkey = c_custkey JOIN d ON s = c_mktsegment GROUP BY 1, 2, 3""",
)
def loaded_waves(t: Tables):
    """Two waves into a fresh warehouse, then an update run that meets one more department.

    Tables are written below the shared checkpoint folder, each run in a folder of its own.
    """
    house = waves.Warehouse(t.spark, f"{checkpoint_dir(t.spark)}/warehouse-{uuid.uuid4().hex}")
    heads = _head_count(t)

    def targets(head_count):
        department = waves.Target(
            "dim_department", lambda w: builders.dim_department(head_count, date(2026, 2, 9), waves.existing_or_none(w, "dim_department")),
            surrogate=("department_key", ("department_name",)),
        )
        fact = waves.Target("fact_department", lambda w: builders.fact_department(head_count, w.read("dim_department"), waves.existing_or_none(w, "fact_department")))
        return [[department], [fact]]

    waves.run_waves(house, targets(heads.filter("Entiteit <> 'MACHINERY'")))
    waves.run_waves(house, targets(heads), update=True)
    return house.read("fact_department").join(house.read("dim_department"), "department_key").select("department_key", "department_name", "date_key", "workers")
