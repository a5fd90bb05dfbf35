"""The warehouse run: dependency waves, update runs, single loads, rejected waves, months and snapshots replaced."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.catalog.base import Tables, date_key_sql, lat, lon, query
from tramline.catalog.builders import _geocodes, _head_count, _weather_feed
from tramline.functions import keys
from tramline.operators import reshape, rules
from tramline.plans import builders, schemas, store
from tramline.session import checkpoint_dir

AS_OF, END = date(1995, 1, 1), date(2026, 12, 31)
#: The fixed row counts hold for the real calendar and postal codes only.
RULES = {name: rules.rules_with(r, row_count=None) for name, r in schemas.LOAD_RULES.items()}
UPDATES = {name: RULES[name].for_update() for name in schemas.UPDATE_RULES} | {n: RULES[n].for_update() for n in ("fact_counts", "fact_weather")}


def fresh_store(t: Tables) -> store.Store:
    """A warehouse of its own below the shared checkpoint folder."""
    return store.Store(t.spark, f"{checkpoint_dir(t.spark)}/store-{uuid.uuid4().hex}")


def _until(t: Tables, day: date | None) -> Tables:
    """Orders and line items before a day, all other tables whole."""
    if day is None:
        return t
    cut = Tables(t.spark, t.folder)
    cut.orders = t.orders.filter(F.col("o_orderdate") < F.lit(day))
    cut.lineitem = t.lineitem.filter(F.col("l_shipdate") < F.lit(day))
    return cut


def _days(t: Tables) -> DataFrame:
    seen = t.orders.select(F.col("o_orderdate").cast("date").alias("day")).union(t.lineitem.select(F.col("l_shipdate").cast("date")))
    firsts = t.orders.select(F.trunc(F.col("o_orderdate").cast("date"), "month"))
    return seen.union(firsts).union(t.spark.range(1).select(F.explode(F.array(F.lit(AS_OF), F.lit(END))))).distinct()


def _counts(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").alias("counting_point_id"), F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("direction_in"), F.count_if(F.col("o_orderstatus") != "F").alias("direction_out"), F.count(F.lit(1)).alias("total")
    )


def month_of() -> Column:
    return F.floor(F.col("date_key") / 100).cast("int")


def jobs(t: Tables) -> dict[str, store.Job]:
    """Loaders of nine tables; the graph gives three waves."""
    def dim_date(s):
        none = t.spark.createDataFrame([], "date date, localName string")
        spans = t.spark.createDataFrame([], "startDate date, endDate date, name array<struct<text:string>>")
        return builders.dim_date(_days(t), none, spans, s.find("dim_date"))

    def dim_location(s):
        codes = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("Postcode"), F.col("n_name").alias("Plaatsnaam"), F.col("r_name").alias("Hoofdgemeente"), F.col("r_name").alias("Provincie")
        )
        return builders.dim_location(codes, s.find("dim_location"))

    def dim_counting_point(s):
        rows = t.customer.select("*", lat("c_custkey").alias("latitude"), lon("c_custkey").alias("longitude"))
        texts = ["custom_id", "first_data", "granularity", "direction_name_in", "direction_name_out", "domain_name", "description"]
        catalogue = reshape.ensure_columns(
            rows.select(F.col("c_custkey").alias("counting_point_id"), F.col("c_name").alias("name"), "latitude", "longitude", F.lit("true").alias("directional")),
            {**dict.fromkeys(texts, "string"), "domain_id": "int"},
        )
        return builders.dim_counting_point(catalogue, _geocodes(rows, "c_custkey", "latitude", "longitude"), s.read("dim_location"), s.find("dim_counting_point"))

    def dim_weather_station(s):
        spots = t.supplier.select("*", F.round(lat("s_suppkey"), 4).alias("la"), F.round(lon("s_suppkey"), 4).alias("lo"))
        feed = spots.select(
            F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("string").alias("altitude"), F.format_string("POINT (%.4f %.4f)", "la", "lo").alias("the_geom")
        )
        return builders.dim_weather_station(feed, _geocodes(spots, "s_suppkey", "la", "lo"), s.read("dim_location"), AS_OF)

    listed = [
        store.Job("dim_time", lambda s: builders.dim_time(t.spark, s.find("dim_time"))),
        store.Job("dim_date", dim_date),
        store.Job("dim_location", dim_location, surrogate=("location_key", ("postal_code", "municipality", "main_municipality", "province"))),
        store.Job("dim_department", lambda s: builders.dim_department(_head_count(t), AS_OF, s.find("dim_department")), ("dim_date",), surrogate=("department_key", ("department_name",))),
        store.Job("dim_counting_point", dim_counting_point, ("dim_location",)),
        store.Job("dim_weather_station", dim_weather_station, ("dim_location",), "snapshot"),
        store.Job("fact_department", lambda s: builders.fact_department(_head_count(t), s.read("dim_department"), s.find("fact_department")), ("dim_department", "dim_date")),
        store.Job("fact_counts", lambda s: builders.fact_counts(_counts(t), s.read("dim_counting_point")), ("dim_counting_point", "dim_date"), "periods", month_of),
        store.Job("fact_weather", lambda s: builders.fact_weather(_weather_feed(t), s.find("fact_weather")), ("dim_weather_station", "dim_date")),
    ]
    return {j.name: j for j in listed}


#: What is measured of each table: rows, smallest and largest key, and a sum.
MEASURES = {
    "dim_time": ("time_key", "hour"), "dim_date": ("date_key", "day_of_month"), "dim_location": ("location_key", "postal_code"),
    "dim_department": ("department_key", "start_date"), "dim_counting_point": ("counting_point_id", "location_key"),
    "dim_weather_station": ("location_key", "location_key"), "fact_department": ("date_key", "workers"),
    "fact_counts": ("date_key", "direction_in"), "fact_weather": ("date_key", "temp_avg"),
}


def census(s: store.Store) -> DataFrame:
    """One row per published table."""
    parts = [
        s.read(name).agg(F.count(F.lit(1)).alias("n"), F.min(key).cast("bigint").alias("low"), F.max(key).cast("bigint").alias("high"), F.sum(F.col(value).cast("bigint")).alias("total"))
        .select(F.lit(name).alias("table_name"), "n", "low", "high", "total")
        for name, (key, value) in MEASURES.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_SPOT = "min({0}) OVER (PARTITION BY ({0} * 7919 % 1000), ({0} * 104729 % 1000)) % 25 + 1"
_CENSUS = f"""days AS (
  SELECT o_orderdate::DATE AS d FROM orders UNION SELECT l_shipdate::DATE FROM lineitem UNION SELECT date_trunc('month', o_orderdate)::DATE FROM orders
  UNION SELECT DATE '1995-01-01' UNION SELECT DATE '2026-12-31'),
segments AS (SELECT row_number() OVER (ORDER BY s) AS k FROM (SELECT DISTINCT c_mktsegment AS s FROM orders JOIN customer ON o_custkey = c_custkey)),
points AS (SELECT c_custkey AS k, {_SPOT.format('c_custkey')} AS place FROM customer),
stations AS (SELECT s_suppkey AS k, {_SPOT.format('s_suppkey')} AS place FROM supplier),
weather AS (SELECT l_suppkey, {date_key_sql('l_shipdate')} AS d, sum(l_quantity) AS q FROM lineitem GROUP BY l_suppkey, l_shipdate),
census AS (
  SELECT 'dim_time' AS table_name, 1440::BIGINT AS n, 0::BIGINT AS low, 2359::BIGINT AS high, 16560::BIGINT AS total
  UNION ALL SELECT 'dim_date', count(*), min({date_key_sql('d')}), max({date_key_sql('d')}), sum(day(d)) FROM days
  UNION ALL SELECT 'dim_location', count(*), 1, count(*), sum(n_nationkey) FROM nation
  UNION ALL SELECT 'dim_department', count(*), 1, count(*), count(*) * 19950101 FROM segments
  UNION ALL SELECT 'dim_counting_point', count(*), min(k), max(k), sum(place) FROM points
  UNION ALL SELECT 'dim_weather_station', count(*), min(place), max(place), sum(place) FROM stations
  UNION ALL SELECT 'fact_department', count(*), min(d), max(d), sum(n) FROM (SELECT {date_key_sql("date_trunc('month', o_orderdate)")} AS d, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, c_mktsegment)
  UNION ALL SELECT 'fact_counts', count(*), min(d), max(d), sum(n) FROM (SELECT {date_key_sql('o_orderdate')} AS d, count(*) FILTER (o_orderstatus = 'F') AS n FROM orders GROUP BY o_custkey, o_orderdate)
  UNION ALL SELECT 'fact_weather', count(*), min(d), max(d), sum(q::BIGINT) FROM weather)"""


@query("warehouse_load", "B22 B21 K11 K13 K15 K16 S2 S3 B1 B2 B3 B5 B8 B10 B13 B15 B19", f"WITH {_CENSUS} SELECT table_name, n, low, high, total::BIGINT AS total FROM census")
def warehouse_load(t: Tables):
    """load_0, load_1 and load_2 into a fresh warehouse."""
    s = fresh_store(t)
    store.run(s, list(jobs(t).values()), RULES, schemas.FOREIGN_KEYS)
    return census(s)


@query("warehouse_update", "B23 R10 R16 K13", f"WITH {_CENSUS} SELECT table_name, n, low, high, total::BIGINT AS total FROM census")
def warehouse_update(t: Tables):
    """Everything before 1997 loaded, then an update run with all rows."""
    s = fresh_store(t)
    store.run(s, list(jobs(_until(t, date(1997, 1, 1))).values()), RULES, schemas.FOREIGN_KEYS)
    store.run(s, list(jobs(t).values()), UPDATES, schemas.FOREIGN_KEYS)
    return census(s)


@query(
    "warehouse_wave_report", "K13 K21 B22",
    """SELECT * FROM (VALUES ('dim_date', 0), ('dim_location', 0), ('dim_time', 0), ('dim_counting_point', 1), ('dim_department', 1), ('dim_weather_station', 1),
    ('fact_counts', 2), ('fact_department', 2), ('fact_weather', 2)) x(table_name, wave), (SELECT 0::BIGINT AS failed)""",
)
def warehouse_wave_report(t: Tables):
    """The wave in which each table was loaded, and its failed checks."""
    report = store.run(fresh_store(t), list(jobs(t).values()), RULES, schemas.FOREIGN_KEYS)
    return report.groupBy("table_name", "wave").agg(F.count_if(~F.col("passed")).alias("failed"))


def _loaded_before(t: Tables, names: tuple[str, ...]) -> store.Store:
    """A warehouse with the dimensions of all rows and the facts ``names`` before 1997."""
    s = fresh_store(t)
    dims = [j for j in jobs(t).values() if j.name.startswith("dim_")]
    store.run(s, dims, RULES, schemas.FOREIGN_KEYS)
    early = jobs(_until(t, date(1997, 1, 1)))
    store.run(s, [early[n] for n in names], RULES, schemas.FOREIGN_KEYS)
    return s


@query(
    "single_table_loads", "B25 B13 B15 B19",
    f"WITH {_CENSUS} SELECT table_name, n, low, high, total::BIGINT AS total FROM census WHERE table_name LIKE 'fact%'",
)
def single_table_loads(t: Tables):
    """Facts loaded one by one, each by itself, on top of earlier loads."""
    names = ("fact_weather", "fact_counts", "fact_department")
    s = _loaded_before(t, names)
    later = jobs(t)
    for name in names:
        store.run(s, [later[name]], UPDATES, schemas.FOREIGN_KEYS)
    return census(s).filter(F.col("table_name").isin(*names))


@query(
    "month_reloaded", "S4 R11 B15",
    f"""SELECT o_custkey::INT AS counting_point_id, {date_key_sql('o_orderdate')} AS date_key, count(*)::INT AS total FROM orders
    WHERE o_orderdate < DATE '1996-01-01' AND (o_orderstatus = 'F' OR date_trunc('month', o_orderdate) = DATE '1995-03-01') AND date_trunc('month', o_orderdate) <> DATE '1994-07-01' GROUP BY 1, 2""",
)
def month_reloaded(t: Tables):
    """A stored month deleted, another replaced by what comes again; all other months stay as they were."""
    s = fresh_store(t)
    store.run(s, [j for j in jobs(t).values() if j.name.startswith("dim_")], RULES, schemas.FOREIGN_KEYS)
    done = Tables(t.spark, t.folder)
    done.orders = t.orders.filter("o_orderdate < DATE '1996-01-01' AND o_orderstatus = 'F'")
    store.run(s, [jobs(done)["fact_counts"]], RULES, schemas.FOREIGN_KEYS)
    month = Tables(t.spark, t.folder)
    month.orders = t.orders.filter("o_orderdate >= DATE '1995-03-01' AND o_orderdate < DATE '1995-04-01'")
    store.run(s, [jobs(month)["fact_counts"]], UPDATES, schemas.FOREIGN_KEYS)
    s.drop_periods("fact_counts", [199407])
    return s.read("fact_counts").select("counting_point_id", "date_key", "total")


@query(
    "rejected_wave", "K13 K15 K16 B22",
    f"""WITH fact AS (SELECT o_custkey AS c, {date_key_sql('o_orderdate')} AS d, year(o_orderdate) AS y FROM orders GROUP BY ALL),
    w AS (SELECT l_suppkey, l_shipdate, year(l_shipdate) AS y FROM lineitem GROUP BY ALL)
    SELECT 'fact_counts' AS table_name, 'foreign_key' AS rule, 'counting_point_id->dim_counting_point.counting_point_id' AS column_name, (SELECT count(*) FROM fact) AS violations
    UNION ALL SELECT 'fact_counts', 'foreign_key', 'date_key->dim_date.date_key', (SELECT count(*) FROM fact)
    UNION ALL SELECT 'fact_weather', 'target_unique', 'weather_station_key,date_key', (SELECT count(*) FROM w WHERE y < 1997)
    UNION ALL SELECT 'fact_weather', 'published', 'rows', (SELECT count(*) FROM w WHERE y < 1997)
    UNION ALL SELECT 'fact_counts', 'published', 'rows', (SELECT count(*) FROM fact WHERE y < 1997)""",
)
def rejected_wave(t: Tables):
    """A wave of two tables that break keys: the failed checks, and what is published afterwards (as before the wave)."""
    s = _loaded_before(t, ("fact_weather", "fact_counts"))
    points = t.customer.select(F.col("c_custkey").cast("int").alias("counting_point_id"))
    unknown = {"counting_point_id": F.col("counting_point_id") + 100_000_000, "date_key": F.col("date_key") + 20_000_000}
    wave = [
        store.Job("fact_counts", lambda _: builders.fact_counts(_counts(t), points).withColumns(unknown), (), "periods", month_of),
        store.Job("fact_weather", lambda _: builders.fact_weather(_weather_feed(t))),
    ]
    version = s.entries()[0]
    try:
        store.run_wave(s, wave, RULES, schemas.FOREIGN_KEYS)
        raise AssertionError("the wave was not rejected")
    except rules.RejectedWave as rejected:
        failed = [(f.table, f.rule, f.column, f.violations) for f in rejected.failures]
    if s.entries()[0] != version:
        raise AssertionError("a rejected wave published a version")
    report = t.spark.createDataFrame(failed, "table_name string, rule string, column_name string, violations long")
    for name in ("fact_weather", "fact_counts"):
        rows = s.read(name).agg(F.count(F.lit(1)).alias("violations"))
        report = report.union(rows.select(F.lit(name), F.lit("published"), F.lit("rows"), "violations"))
    return report
