"""Joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tramline.catalog.base import DISTANCE, LAT, LON, Tables, lat, lon, query
from tramline.functions import text, values
from tramline.operators import joins, spatial

_STARS = """FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey"""


@query(
    "star_join",
    "C1 A1 A18",
    f"""SELECT n_name, year(o_orderdate)::INT AS year, count(*) AS n, sum(l_quantity) AS quantity,
      round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
    {_STARS} GROUP BY 1, 2""",
)
def star_join(t: Tables):
    """Facts are aggregated per (supplier, order year) before the small dimensions join."""
    items = t.lineitem.join(t.orders.select(F.col("o_orderkey"), F.year("o_orderdate").alias("year")), F.col("l_orderkey") == F.col("o_orderkey"))
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per_supplier = items.groupBy("l_suppkey", "year").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"), F.sum(revenue).alias("revenue"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
    )
    placed = joins.lookup(per_supplier, t.supplier, {"l_suppkey": "s_suppkey"}, {"nation": "s_nationkey"}, "inner")
    placed = joins.lookup(placed, t.nation, {"nation": "n_nationkey"}, {"n_name": "n_name"}, "inner")
    return placed.groupBy("n_name", "year").agg(
        F.sum("n").alias("n"), F.sum("quantity").alias("quantity"), F.round(F.sum("revenue"), 4).alias("revenue"),
        F.min("first_ship").alias("first_ship"), F.max("last_ship").alias("last_ship"),
    )


@query(
    "left_lookup",
    "C2 C4",
    "SELECT event_id, user_id, c_name AS name FROM events LEFT JOIN customer ON user_id = c_custkey AND c_acctbal > 0",
)
def left_lookup(t: Tables):
    return joins.lookup(t.events.select("event_id", "user_id"), t.customer.filter("c_acctbal > 0"), {"user_id": "c_custkey"}, {"name": "c_name"})


@query(
    "composite_lookup",
    "C3",
    """SELECT a.o_orderkey, b.n AS same_day_orders FROM orders a JOIN (SELECT day(o_orderdate) d, month(o_orderdate) m,
      year(o_orderdate) y, count(*) n FROM orders GROUP BY 1, 2, 3) b
      ON day(a.o_orderdate) = d AND month(a.o_orderdate) = m AND year(a.o_orderdate) = y""",
)
def composite_lookup(t: Tables):
    parts = {"day_of_month": F.dayofmonth("o_orderdate"), "month": F.month("o_orderdate"), "year": F.year("o_orderdate")}
    rows = t.orders.select("o_orderkey", *(c.alias(n) for n, c in parts.items()))
    days = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("same_day_orders"))
    return rows.join(days, list(parts)).select("o_orderkey", "same_day_orders")


@query(
    "unseen_rows",
    "C5 X3 R10 U2",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_custkey % 5 AS grp FROM orders)
    SELECT o_orderkey, status, grp FROM o WHERE NOT EXISTS (SELECT 1 FROM o k WHERE k.o_orderkey % 3 = 0 AND k.grp = 2
      AND k.status IS NOT DISTINCT FROM o.status AND k.grp = o.grp)""",
)
def unseen_rows(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), (F.col("o_custkey") % 5).alias("grp"))
    known = rows.filter((F.col("o_orderkey") % 3 == 0) & (F.col("grp") == 2))
    return joins.new_rows(rows, known, ["status", "grp"])


@query(
    "member_rows",
    "C6 P18",
    "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def member_rows(t: Tables):
    members = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return joins.known_rows(t.events.select("event_id", "user_id"), members, ["user_id"])


@query(
    "orphan_rows",
    "C8 C7 K16",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3)",
)
def orphan_rows(t: Tables):
    return joins.orphans(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", t.customer.filter("c_nationkey <> 3"), "c_custkey")


@query(
    "reconciled_feeds",
    "C9",
    """SELECT coalesce(a.k, b.k) AS k, a.n, b.n AS n_right, CASE WHEN a.k IS NULL THEN 'right_only' WHEN b.k IS NULL THEN 'left_only' ELSE 'both' END AS provenance
    FROM (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
    FULL JOIN (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1) b ON a.k = b.k""",
)
def reconciled_feeds(t: Tables):
    a = t.orders.filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t.events.groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return joins.reconcile(a, b, ["k"])


@query(
    "zero_filled_scaffold",
    "C10 R7 P27",
    """SELECT n_nationkey, y.year, count(o_orderkey) AS orders FROM nation CROSS JOIN (SELECT DISTINCT year(o_orderdate)::INT AS year FROM orders) y
    LEFT JOIN (orders JOIN customer ON o_custkey = c_custkey) ON c_nationkey = n_nationkey AND year(o_orderdate) = y.year AND o_orderstatus = 'P' GROUP BY 1, 2""",
)
def zero_filled_scaffold(t: Tables):
    """Each nation carries the list of years (one array cell) instead of a cross join."""
    years = t.orders.select(F.collect_set(F.year("o_orderdate"))).scalar()
    scaffold = t.nation.select("n_nationkey", F.explode(years).alias("year"))
    counts = (
        t.orders.filter("o_orderstatus = 'P'")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("year"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return scaffold.join(counts, ["n_nationkey", "year"], "left").fillna({"orders": 0})


@query(
    "pairs_within_500m",
    "C11 F26",
    f"""SELECT c_custkey, s_suppkey, round(d, 3) AS distance_m FROM (SELECT c_custkey, s_suppkey, {DISTANCE.format(a=LAT.format('c_custkey'), b=LON.format('c_custkey'), c=LAT.format('s_suppkey'), d=LON.format('s_suppkey'))} AS d
      FROM customer, supplier) WHERE d <= 500""",
)
def pairs_within_500m(t: Tables):
    bikes = t.customer.select("c_custkey", lat("c_custkey").alias("la"), lon("c_custkey").alias("lo"))
    rail = t.supplier.select("s_suppkey", lat("s_suppkey").alias("ra"), lon("s_suppkey").alias("ro"))
    pairs = spatial.within_radius(bikes, rail, 500, ("la", "lo"), ("ra", "ro"), digits=3)
    return pairs.select("c_custkey", "s_suppkey", "distance_m")


@query(
    "stations_near_bikes",
    "C11 P10 B7",
    f"""SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM customer WHERE {DISTANCE.format(a=LAT.format('c_custkey'), b=LON.format('c_custkey'), c=LAT.format('s_suppkey'), d=LON.format('s_suppkey'))} <= 150)""",
)
def stations_near_bikes(t: Tables):
    rail = t.supplier.select("s_suppkey", "s_name", lat("s_suppkey").alias("la"), lon("s_suppkey").alias("lo"))
    bikes = t.customer.select(lat("c_custkey").alias("ra"), lon("c_custkey").alias("ro"))
    return spatial.near_any(rail, bikes, 150, ("la", "lo"), ("ra", "ro")).select("s_suppkey", "s_name")


@query(
    "nearest_station",
    "C12",
    f"""SELECT c_custkey, (SELECT min_by(s_suppkey, (d, s_suppkey)) FROM (SELECT s_suppkey, {DISTANCE.format(a=LAT.format('c.c_custkey'), b=LON.format('c.c_custkey'), c=LAT.format('s_suppkey'), d=LON.format('s_suppkey'))} AS d FROM supplier) WHERE d <= 500) AS linked FROM customer c""",
)
def nearest_station(t: Tables):
    bikes = t.customer.select("c_custkey", lat("c_custkey").alias("la"), lon("c_custkey").alias("lo"))
    rail = t.supplier.select("s_suppkey", lat("s_suppkey").alias("ra"), lon("s_suppkey").alias("ro"))
    return spatial.nearest(bikes, rail, 500, ("la", "lo"), ("ra", "ro"), "s_suppkey", "linked").select("c_custkey", "linked")


@query(
    "holidays_by_interval",
    "C13 C14 U5",
    """WITH v AS (SELECT c_custkey, DATE '1995-01-01' + (c_custkey * 37 % 2400)::INT AS s, DATE '1995-01-01' + (c_custkey * 37 % 2400 + c_custkey % 9)::INT AS e, c_name FROM customer)
    SELECT o_orderkey, max_by(c_name, c_custkey) AS holiday FROM orders LEFT JOIN v ON o_orderdate::DATE BETWEEN s AND e GROUP BY 1""",
)
def holidays_by_interval(t: Tables):
    start = F.date_add(F.lit(date(1995, 1, 1)), (F.col("c_custkey") * 37 % 2400).cast("int"))
    spans = t.customer.select("c_custkey", "c_name", start.alias("s"), F.date_add(start, (F.col("c_custkey") % 9).cast("int")).alias("e"))
    days = joins.on_days(spans, "s", "e", "c_custkey", "c_name")
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return rows.join(days, "day", "left").select("o_orderkey", F.col("c_name").alias("holiday"))


_LOCATIONS = """loc AS (SELECT p_partkey AS location_key, p_size AS postal_code, upper(p_name[1]) || p_name[2:] AS town0, p_brand FROM part),
  locations AS (SELECT location_key, postal_code, (SELECT string_agg(upper(x[1]) || x[2:], ' ' ORDER BY i) FROM (SELECT unnest(string_split(lower(town0), ' ')) AS x, unnest(range(2)) AS i)) AS municipality FROM loc),
  places AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN -1 ELSE s_suppkey % 60 END::INT AS postal_code, CASE WHEN s_suppkey % 3 = 0 THEN -2 ELSE s_suppkey % 50 END::INT AS alt_code,
     CASE s_suppkey % 4 WHEN 0 THEN 'red widget' WHEN 1 THEN 'Nowhere Town' WHEN 2 THEN 'SMALL ring' END AS alt_town, 'Halte ' || CASE WHEN s_suppkey % 2 = 0 THEN 'gizmo' ELSE 'bolt' END || ' plein' AS name FROM supplier)"""


@query(
    "location_cascade",
    "C15 C16 C2",
    f"""WITH {_LOCATIONS}, one AS (SELECT p.*, u.n, u.sole FROM places p LEFT JOIN (SELECT postal_code, count(*) n, min(municipality) sole FROM locations GROUP BY 1) u USING (postal_code)),
    two AS (SELECT *, CASE WHEN n = 1 THEN postal_code ELSE alt_code END AS code,
      CASE WHEN n = 1 THEN sole ELSE (SELECT string_agg(upper(x[1]) || x[2:], ' ' ORDER BY i) FROM (SELECT unnest(string_split(lower(alt_town), ' ')) AS x, unnest(range(2)) AS i)) END AS town FROM one)
    SELECT s_suppkey, CASE WHEN town IS NOT NULL THEN coalesce(
      (SELECT min(location_key) FROM locations l WHERE l.postal_code = code AND l.municipality = town),
      (SELECT min(location_key) FROM locations l WHERE l.municipality = town),
      (SELECT min(location_key) FROM locations l WHERE l.municipality = (SELECT min_by(m.municipality, m.location_key) FROM locations m WHERE m.postal_code = two.postal_code
         AND (contains(lower(name), lower(m.municipality)) OR contains(lower(name), string_split(lower(m.municipality), ' ')[1]) OR contains(lower(name), string_split(lower(m.municipality), ' ')[2])))),
      (SELECT min(location_key) FROM locations l WHERE l.postal_code = code)) END AS location_key FROM two""",
)
def location_cascade(t: Tables):
    locations = t.part.select(F.col("p_partkey").alias("location_key"), F.col("p_size").alias("postal_code"), text.title_case(F.col("p_name")).alias("municipality"))
    k = F.col("s_suppkey")
    places = t.supplier.select(
        "s_suppkey",
        F.when(k % 7 == 0, -1).otherwise(k % 60).cast("int").alias("postal_code"),
        F.when(k % 3 == 0, -2).otherwise(k % 50).cast("int").alias("alt_postal_code"),
        values.map_values((k % 4).cast("int"), {0: "red widget", 1: "Nowhere Town", 2: "SMALL ring"}).alias("alt_municipality"),
        F.concat(F.lit("Halte "), F.when(k % 2 == 0, "gizmo").otherwise("bolt"), F.lit(" plein")).alias("name"),
    )
    return joins.location_cascade(places, locations, "name").select("s_suppkey", "location_key")


@query(
    "names_within_names",
    "C16 C24",
    """WITH m AS (SELECT p_partkey, p_size, p_name FROM part), s AS (SELECT s_suppkey, (s_suppkey % 50)::INT AS p_size,
      'depot ' || CASE WHEN s_suppkey % 3 = 0 THEN 'RED WIDGET' WHEN s_suppkey % 3 = 1 THEN 'small yard' ELSE 'Hot Gear' END AS place FROM supplier),
    h AS (SELECT s_suppkey, p_name, p_partkey, contains(lower(place), p_name) AS whole FROM s JOIN m USING (p_size)
      WHERE contains(lower(place), p_name) OR contains(lower(place), string_split(p_name, ' ')[1]) OR contains(lower(place), string_split(p_name, ' ')[2]))
    SELECT s.s_suppkey, min_by(p_name, p_partkey) AS any_first, min_by(p_name, (NOT whole, p_partkey)) AS whole_first FROM s LEFT JOIN h USING (s_suppkey) GROUP BY 1""",
)
def names_within_names(t: Tables):
    k = F.col("s_suppkey")
    place = F.when(k % 3 == 0, "RED WIDGET").when(k % 3 == 1, "small yard").otherwise("Hot Gear")
    sites = t.supplier.select("s_suppkey", (k % 50).cast("int").alias("p_size"), F.concat(F.lit("depot "), place).alias("place"))
    towns = t.part.select("p_size", "p_name", "p_partkey")
    once = joins.named_within(sites, "place", towns, ["p_size"], "p_name", "p_partkey", "any_first")
    both = joins.named_within(once, "place", towns, ["p_size"], "p_name", "p_partkey", "whole_first", whole_first=True)
    return both.select("s_suppkey", "any_first", "whole_first")


@query(
    "closest_names",
    "C17 F33 F28",
    """WITH typed AS (SELECT p_partkey, substr(p_name, 2) || 's ' AS typed FROM part),
    scored AS (SELECT a.typed, b.p_name, 1 - levenshtein(a.typed, b.p_name) / greatest(length(a.typed), length(b.p_name))::DOUBLE AS score
      FROM (SELECT DISTINCT typed FROM typed) a, (SELECT DISTINCT p_name FROM part) b),
    best AS (SELECT typed, max_by(p_name, (score, p_name)) AS match FROM scored WHERE score >= 0.6 GROUP BY 1)
    SELECT p_partkey, typed, coalesce(match, 'unknown') AS match FROM typed LEFT JOIN best USING (typed)""",
)
def closest_names(t: Tables):
    """Typed station names against the part names."""
    typed = t.part.select("p_partkey", F.concat(F.substr("p_name", F.lit(2)), F.lit("s ")).alias("typed"))
    return joins.closest_name(typed, "typed", t.part, "p_name")


@query(
    "cast_key_join",
    "C18 C20",
    """SELECT n_nationkey::VARCHAR AS code, n_name, count(c_custkey) AS members FROM nation LEFT JOIN customer ON c_nationkey::VARCHAR = n_nationkey::VARCHAR AND c_acctbal > 9000 GROUP BY 1, 2""",
)
def cast_key_join(t: Tables):
    rich = t.customer.filter("c_acctbal > 9000").groupBy(F.col("c_nationkey").cast("string").alias("code")).agg(F.count(F.lit(1)).alias("members"))
    return t.nation.select(F.col("n_nationkey").cast("string").alias("code"), "n_name").join(rich, "code", "left").fillna({"members": 0})


@query(
    "deduplicated_lookup",
    "C21",
    """SELECT s_suppkey, k AS part_key FROM supplier LEFT JOIN (SELECT p_size, min(p_partkey) AS k FROM part GROUP BY 1) ON s_suppkey % 60 = p_size""",
)
def deduplicated_lookup(t: Tables):
    first = joins.first_by(t.part, ["p_size"], ["p_partkey"], ["p_partkey"])
    rows = t.supplier.select("s_suppkey", (F.col("s_suppkey") % 60).alias("size"))
    return joins.lookup(rows, first, {"size": "p_size"}, {"part_key": "p_partkey"}).select("s_suppkey", "part_key")


@query(
    "group_verdict_on_rows",
    "C22 A9 W15",
    """SELECT event_id, bool_and(value < 150) OVER (PARTITION BY user_id, ts::DATE) AS all_low, bool_or(value > 100) OVER (PARTITION BY user_id, ts::DATE) AS any_high FROM events""",
)
def group_verdict_on_rows(t: Tables):
    rows = t.gauge
    verdict = rows.groupBy("user_id", "day").agg(F.bool_and(F.col("value") < 150).alias("all_low"), F.bool_or(F.col("value") > 100).alias("any_high"))
    return rows.join(verdict, ["user_id", "day"]).select("event_id", "all_low", "any_high")


@query(
    "normalised_name_join",
    "C23 F4 B26",
    """SELECT DISTINCT s_suppkey, s_name FROM supplier JOIN (SELECT DISTINCT regexp_replace(c_name || ' Station ' || c_nationkey, '\\s*Station.*$', '') AS n FROM customer) ON replace(s_name, 'Supplier', 'Customer') = n""".replace("\\\\", "\\"),
)
def normalised_name_join(t: Tables):
    from tramline.plans.builders import stations_by_name

    rail = t.supplier.select(F.col("s_suppkey").cast("string").alias("URI"), F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("name"))
    bikes = t.customer.select(F.concat_ws(" Station ", "c_name", F.col("c_nationkey").cast("string")).alias("Location"))
    found = stations_by_name(rail, bikes)
    return found.select(F.col("uri").cast("long").alias("s_suppkey"), F.replace("station_name", F.lit("Customer"), F.lit("Supplier")).alias("s_name"))


@query(
    "many_to_many_days",
    "C19 X12",
    """SELECT o.day, sum(o.cents)::BIGINT AS multiplied FROM (SELECT o_orderdate::DATE AS day, round(o_totalprice * 100)::BIGINT AS cents FROM orders) o
      JOIN (SELECT l_shipdate::DATE AS day FROM lineitem) l ON o.day = l.day GROUP BY 1""",
)
def many_to_many_days(t: Tables):
    """Sum times partner count per day equals the sum over the many-to-many join."""
    left = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    right = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("partners"))
    return left.join(right, "day").select("day", (F.col("cents") * F.col("partners")).alias("multiplied"))


@query(
    "older_location_link",
    "B24 C21 P12",
    """SELECT s_suppkey, coalesce(a.k, b.k) AS location_key FROM (SELECT s_suppkey, (s_suppkey % 80)::INT AS code, CASE WHEN s_suppkey % 2 = 0 THEN 'Old Town' ELSE 'Hot Gear' END AS town FROM supplier)
      LEFT JOIN (SELECT p_size, min(p_partkey) AS k FROM part GROUP BY 1) a ON code = p_size
      LEFT JOIN (SELECT p_name, min(p_partkey) AS k FROM part GROUP BY 1) b ON CASE town WHEN 'Old Town' THEN 'red widget' ELSE lower(town) END = b.p_name""",
)
def older_location_link(t: Tables):
    from tramline.plans.builders import locations_by_postcode

    locations = t.part.select(F.col("p_partkey").alias("location_key"), F.col("p_size").alias("postal_code"), text.title_case(F.col("p_name")).alias("municipality"))
    k = F.col("s_suppkey")
    rows = t.supplier.select("s_suppkey", (k % 80).cast("int").alias("code"), F.when(k % 2 == 0, "OLD TOWN").otherwise("hot gear").alias("town"))
    return locations_by_postcode(rows, locations, "code", "town", {"Old Town": "Red Widget"}).select("s_suppkey", "location_key")


