"""Landed files: rows of the tables written as the files a source delivers, then read by the library's readers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.catalog.base import Tables, date_key_sql, query, time_key_sql
from tramline.catalog.builders import _weather_feed
from tramline.functions.values import lenient_number
from tramline.operators import reshape
from tramline.plans import builders, schemas, store
from tramline.session import checkpoint_dir
from tramline.sources import access_log, files


def _folder(t: Tables) -> str:
    """A landing folder of its own that all executors reach."""
    return f"{checkpoint_dir(t.spark)}/landed-{uuid.uuid4().hex}"


def _comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


@query(
    "landed_rates", "S5 P7 P10 B4",
    """SELECT p_partkey, p_name || '; "' || p_brand || '"' AS vehicle_type, replace(p_retailprice::VARCHAR, '.', ',') AS as_text, p_retailprice AS co2_per_km FROM part""",
)
def landed_rates(t: Tables):
    """Semicolon file: decimal commas stay text until they are cast; separators and quotes inside a field survive."""
    path = _folder(t)
    rates = t.part.select("p_partkey", F.concat("p_name", F.lit('; "'), "p_brand", F.lit('"')).alias("VehicleType"), _comma(F.col("p_retailprice")).alias("CO2PerKM"))
    files.write_csv(rates, path, ";")
    read = files.read_csv(t.spark, path, "p_partkey long, VehicleType string, CO2PerKM string", ";")
    return read.select("p_partkey", F.col("VehicleType").alias("vehicle_type"), F.col("CO2PerKM").alias("as_text"), lenient_number(F.col("CO2PerKM")).alias("co2_per_km"))


_HISTORY = f"""SELECT l_suppkey::VARCHAR AS weather_station_key, {date_key_sql('l_shipdate')} AS date_key, greatest(sum(l_quantity) - 30, 0) AS precip_quantity, sum(l_quantity) AS temp_avg
    FROM lineitem GROUP BY l_suppkey, l_shipdate"""


@query("landed_weather_history", "S6 S20 S2 B13 P2 P3 P8 C5", _HISTORY)
def landed_weather_history(t: Tables):
    """A file of many years appended at once, then the daily export, which repeats the last of these years, on top of it."""
    path = _folder(t)
    feed = _weather_feed(t)
    files.write_csv(feed.filter("year(timestamp) <= 1996"), f"{path}/history")
    files.write_csv(feed.filter("year(timestamp) >= 1996"), f"{path}/export")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in feed.schema)
    s = store.Store(t.spark, f"{path}/store")
    for part in ("history", "export"):
        landed = files.read_csv(t.spark, f"{path}/{part}", schema)
        job = store.Job("fact_weather", lambda s, landed=landed: builders.fact_weather(landed, s.find("fact_weather")))
        store.run(s, [job], schemas.LOAD_RULES, {})
    return s.read("fact_weather").select("weather_station_key", "date_key", "precip_quantity", "temp_avg")


@query(
    "landed_optional_files", "S7 U1 B11",
    """SELECT 'there' AS source, c_custkey, c_name FROM customer""",
)
def landed_optional_files(t: Tables):
    """Three sources of one schema: a file, a folder with a header and no rows, and one that was never delivered."""
    path = _folder(t)
    staff = t.customer.select("c_custkey", "c_name")
    files.write_csv(staff, f"{path}/there", ";")
    files.write_csv(staff.filter("false"), f"{path}/empty", ";")
    parts = [
        files.read_optional(t.spark, f"{path}/{name}", "c_custkey long, c_name string").select(F.lit(name).alias("source"), "*")
        for name in ("there", "empty", "absent")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _arrays(rows: DataFrame, by: list, record) -> DataFrame:
    """One JSON array per group (an hour of a key), as a payload holds them."""
    return rows.groupBy(*by).agg(F.collect_list(record).alias("records"))


@query(
    "landed_gauge_records", "S8 B14 F24",
    f"""SELECT user_id::INT AS id, event_id, value AS bikes, {date_key_sql('ts')} AS date_key, {time_key_sql('ts')} AS time_key FROM events""",
)
def landed_gauge_records(t: Tables):
    """Payloads that are arrays of flat records, of which some fields are taken."""
    from tramline.functions.keys import date_key, time_key

    path = _folder(t)
    record = F.struct(F.col("user_id").alias("id"), "event_id", F.col("value").alias("bikes"), F.col("ts").alias("polled_at"), F.col("event_type").alias("ignored"))
    _arrays(t.events, [F.date_trunc("hour", "ts").alias("hour"), "user_id"], record).select(F.to_json("records")).write.text(path)
    read = files.read_json(t.spark, path, "id int, event_id long, bikes double, polled_at timestamp_ntz", lines=True)
    return read.select("id", "event_id", "bikes", date_key(F.col("polled_at")).alias("date_key"), time_key(F.col("polled_at")).alias("time_key"))


@query(
    "landed_boards", "S9 R2 F24 F30",
    f"""SELECT 'BE.' || event_id AS train_id, user_id::INT AS station_key, {date_key_sql('ts')} AS date_key, {time_key_sql('ts')} AS time_key, floor(value * 10)::INT AS delay, event_type = 'error' AS canceled,
    date_trunc('hour', ts) AS last_updated FROM events""",
)
def landed_boards(t: Tables):
    """Nested arrival boards flattened; boards with an empty list, without the list and without arrivals give no rows."""
    path = _folder(t)
    second = F.date_diff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60 + F.floor(F.second("ts"))
    record = F.struct(
        F.concat(F.lit("BE."), F.col("event_id").cast("string")).alias("vehicle"), second.cast("string").alias("time"), F.floor(F.col("value") * 10).cast("string").alias("delay"),
        F.when(F.col("event_type") == "error", "1").otherwise("0").alias("canceled"), F.lit("Gent").alias("ignored"),
    )
    boards = _arrays(t.events, [F.col("user_id").cast("int").alias("station_key"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("polled_at")], record)
    boards.select("station_key", "polled_at", F.struct(F.col("records").alias("arrival")).alias("arrivals")).write.json(f"{path}/boards")
    bare = t.nation.select(
        F.element_at(
            F.array(F.lit('{"station_key": 1, "arrivals": {"arrival": []}}'), F.lit('{"station_key": 1, "arrivals": {}}'), F.lit('{"station_key": 1}')), (F.col("n_nationkey") % 3 + 1).cast("int")
        )
    )
    bare.write.text(f"{path}/bare")
    return files.flatten_liveboard(files.read_json(t.spark, [f"{path}/boards", f"{path}/bare"], files.LIVEBOARD, lines=True), "UTC")


@query(
    "landed_labels", "S10 P13",
    """SELECT c_custkey, n_name AS c_nationkey, 'segment ' || s AS c_mktsegment FROM (SELECT *, length(c_mktsegment) AS s FROM customer) LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20""",
)
def landed_labels(t: Tables):
    """A dictionary file of two label sets; codes it does not name become NULL."""
    path = _folder(t)
    nations = t.nation.filter("n_nationkey < 20").select(F.lit("nations").alias("s"), F.col("n_nationkey").cast("double").cast("string").alias("code"), F.col("n_name").alias("label"))
    lengths = t.customer.select(F.length("c_mktsegment").alias("n")).distinct()
    segments = lengths.select(F.lit("segments").alias("s"), F.col("n").cast("double").cast("string").alias("code"), F.concat(F.lit("segment "), F.col("n").cast("string")).alias("label"))
    sets = nations.unionByName(segments).groupBy("s").agg(F.map_from_entries(F.collect_list(F.struct("code", "label"))).alias("codes"))
    sets.agg(F.map_from_entries(F.collect_list(F.struct("s", "codes"))).alias("value_labels")).coalesce(1).write.json(path)
    rows = t.customer.select("c_custkey", "c_nationkey", F.length("c_mktsegment").alias("c_mktsegment"))
    return reshape.decode_labels(rows, files.read_labels(t.spark, path), {"c_nationkey": "nations", "c_mktsegment": "segments"})


@query(
    "evaluation_written_as_csv", "S17 A1 N19",
    """SELECT c_nationkey, count(*) AS n, sum(o_totalprice > 150000)::BIGINT AS large, min(o_totalprice) AS least, max(o_totalprice) AS most, min(o_orderdate)::DATE AS first_day
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def evaluation_written_as_csv(t: Tables):
    """A result table written with a header twice (the second takes the first one's place) and read back."""
    path = _folder(t)
    summary = (
        t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") > 150000).alias("large"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"),
             F.min(F.col("o_orderdate").cast("date")).alias("first_day"))
    )
    for _ in range(2):
        files.write_csv(summary, path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in summary.schema)
    return files.read_csv(t.spark, path, schema)


@query(
    "landed_access_log", "S18 A25",
    """SELECT event_type AS endpoint, count(*) AS requests, count(*) FILTER (200 + (props->>'k')::INT * 3 >= 400) AS errors, max(value) AS max_ms, min(value) AS min_ms FROM events GROUP BY 1""",
)
def landed_access_log(t: Tables):
    """A log written as text files between lines of another kind, read and measured per endpoint."""
    path = _folder(t)
    k = F.get_json_object("props", "$.k").cast("int")
    line = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(",000 remote=10.0.0."), F.col("user_id").cast("string"), F.lit(' method=GET path="/points/'), F.col("event_id").cast("string"),
        F.lit('" status='), (k * 3 + 200).cast("string"), F.lit(" duration_ms="), F.format_string("%.2f", "value"), F.lit(" endpoint="), "event_type", F.lit(' query="n='), F.col("event_id").cast("string"), F.lit('"'),
    )
    other = F.concat(F.lit("worker started "), F.col("event_id").cast("string"))
    t.events.select(F.explode(F.array(line, other)).alias("value")).write.text(path)
    return access_log.endpoint_metrics(access_log.read_access_log(t.spark, path)).select("endpoint", "requests", "errors", "max_ms", "min_ms")
