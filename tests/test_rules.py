from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tramline.operators import rules as q
from tramline.plans import builders, queries, waves
from tramline.plans.schemas import HEAD_COUNT, LOAD_RULES, UPDATE_RULES


def failed(report):
    return {(r["rule"], r["column_name"]): r["violations"] for r in report.filter(~F.col("passed")).collect()}


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "counting_point_id int, date_key int, direction_in int, direction_out int, total int")


def test_all_rules_see_their_violations(spark):
    df = counts(spark, (1, 20260320, 1, 2, 3), (1, 20260320, 1, 2, 4), (None, 20261320, -1, None, 5), (None, 20261320, 0, None, 5))
    got = failed(q.check(df, LOAD_RULES["fact_counts"]))
    assert got == {
        ("unique", "counting_point_id,date_key"): 2,
        ("not_null", "counting_point_id"): 2,
        ("non_negative", "direction_in"): 1,
        ("date_key", "date_key"): 2,
        ("total_of", "total,direction_in,direction_out"): 1,
    }


def test_missing_columns_are_reported_without_a_job(spark):
    got = failed(q.check(counts(spark).drop("total"), LOAD_RULES["fact_counts"]))
    assert got == {("columns", "total"): 1}


def test_empty_policies(spark):
    empty = counts(spark)
    assert failed(q.check(empty, LOAD_RULES["fact_counts"])) == {}
    strict = q.rules_with(LOAD_RULES["fact_counts"], empty="error", row_count=3, min_rows=2)
    assert failed(q.check(empty, strict)) == {("not_empty", ""): 1, ("row_count", ""): 3, ("row_count_at_least", ""): 2}
    warned = q.check(empty, q.rules_with(LOAD_RULES["fact_counts"], empty="warn"))
    assert failed(warned) == {} and warned.filter("rule = 'warn_empty'").first()["violations"] == 1


def test_last_half_hour_is_exempt(spark):
    df = spark.createDataFrame([(1, 20260320, 2330, 0, 1), (1, 20260320, 2300, 2330, 1), (1, 20260320, 930, 900, 1)], "station_key int, date_key int, start_time int, end_time int, arrivals int")
    assert failed(q.check(df, LOAD_RULES["fact_train_arrivals"])) == {("ordered_pair", "start_time,end_time"): 1}


def test_rule_table_is_complete():
    assert len(LOAD_RULES) == 20 and len(UPDATE_RULES) == 16
    assert LOAD_RULES["dim_location"].row_count == 2764 and UPDATE_RULES["dim_location"].row_count is None
    assert UPDATE_RULES["dim_time"].row_count == 1440
    assert all(r.empty == "ok" for r in UPDATE_RULES.values())


def test_expectations(spark):
    one = spark.createDataFrame([(28.65,)], "value double")
    check = lambda **k: q.expect(one, "value", **k).first()["passed"]
    assert check(expected=28.6, tolerance=0.1) and not check(expected=28.4, tolerance=0.1)
    assert check(low=20, high=30) and not check(low=30, high=40)
    assert check(op=">=", expected=28.65) and not check(op="<", expected=1)
    assert not q.expect(spark.createDataFrame([(None,)], "value double"), "value", expected=1).first()["passed"]


# --- waves --------------------------------------------------------------------------------


def heads(spark):
    return spark.createDataFrame([(2024, 1, "DIT", 60), (2024, 1, "DBO", 240), (2024, 2, "DIT", 61)], HEAD_COUNT)


def targets(df):
    first = waves.Target(
        "dim_department", lambda w: builders.dim_department(df, date(2026, 2, 9), waves.existing_or_none(w, "dim_department")),
        surrogate=("department_key", ("department_name",)),
    )
    second = waves.Target("fact_department", lambda w: builders.fact_department(df, w.read("dim_department"), waves.existing_or_none(w, "fact_department")))
    return [[first], [second]]


def test_waves_load_in_order_and_again_add_nothing(spark, tmp_path, rows):
    house = waves.Warehouse(spark, str(tmp_path))
    reports = waves.run_waves(house, targets(heads(spark)))
    assert all(r.filter(~F.col("passed")).isEmpty() for r in reports)
    assert rows(house.read("dim_department"), "department_key", "department_name") == [(1, "DBO"), (2, "DIT")]
    assert rows(house.read("fact_department")) == [(20240101, 1, 240), (20240101, 2, 60), (20240201, 2, 61)]
    waves.run_waves(house, targets(heads(spark)), update=True)
    assert house.read("dim_department").count() == 2 and house.read("fact_department").count() == 3
    more = heads(spark).union(spark.createDataFrame([(2024, 2, "DHR", 1)], HEAD_COUNT))
    waves.run_waves(house, targets(more), update=True)
    assert rows(house.read("dim_department").filter("department_key = 3"), "department_name") == [("DHR",)]


def test_rejected_wave_writes_nothing(spark, tmp_path):
    house = waves.Warehouse(spark, str(tmp_path))
    bad = spark.createDataFrame([(2024, 1, "DIT", -5)], HEAD_COUNT)
    waves.run_wave(house, targets(bad)[0])
    with pytest.raises(q.RejectedWave, match="non_negative workers"):
        waves.run_wave(house, [*targets(bad)[1], waves.Target("dim_time", lambda w: builders.dim_time(spark))])
    assert waves.existing_or_none(house, "fact_department") is None
    assert waves.existing_or_none(house, "dim_time") is None


# --- parameterised queries ----------------------------------------------------------------


def test_totals_are_zero_without_rows_and_unknown_ids_fail(spark):
    points = spark.createDataFrame([(1,), (2,)], "counting_point_id int")
    df = counts(spark, (1, 20240708, 1, 2, 3), (1, 20240714, 2, 2, 4), (1, 20240707, 9, 9, 18))
    got = queries.totals_since(df, 1, "week", date(2024, 7, 14), points).first()
    assert (got["start_date"], got["total"], got["direction_in"]) == (date(2024, 7, 8), 7, 3)
    assert queries.totals_since(df, 2, "year", date(2024, 7, 14), points).first()["total"] == 0
    with pytest.raises(queries.UnknownId):
        queries.totals_since(df, 3, "day", date(2024, 7, 14), points)
    with pytest.raises(queries.UnknownId):
        queries.detail(points, "counting_point_id", 9)


def test_guards(spark):
    df = counts(spark)
    points = spark.createDataFrame([(1, "a")], "counting_point_id int, counting_point_name string")
    with pytest.raises(ValueError, match="before"):
        queries.totals_on(df, 1, date(2024, 1, 1), date(2024, 1, 1))
    for n in (0, 1001):
        with pytest.raises(ValueError, match="between"):
            queries.top_points(df, points, date(2024, 1, 1), n, date(2024, 1, 2))
    with pytest.raises(ValueError, match="after"):
        queries.top_points(df, points, date(2024, 1, 3), 5, date(2024, 1, 2))


def test_seven_days_to_the_minute(spark, rows):
    stations = spark.createDataFrame([(1,), (2,)], "bike_station_key int")
    gauge = spark.createDataFrame(
        [(1, 20240113, 1539, 1), (1, 20240113, 1540, 5), (1, 20240120, 1540, 9), (1, 20240120, 1541, 99)], "bike_station_key int, date_key int, time_key int, total_available int"
    )
    got = queries.availability_window(gauge, stations, 7, datetime(2024, 1, 20, 15, 40))
    assert rows(got) == [(1, 5, 9, 2), (2, None, None, 1)]


def test_wind_without_reading_is_null(spark):
    stations = spark.createDataFrame([("1", "A")], "weather_station_id string, name string")
    weather = spark.createDataFrame([(1, 20240101, 2.0, 9.0)], "weather_station_key int, date_key int, wind_speed_10m double, wind_gusts_speed double")
    got = queries.wind_for_day(weather, stations, "1", date(2024, 1, 2), date(2024, 2, 1)).first()
    assert got["avg_wind_speed_10m"] is None and got["max_wind_gusts_speed"] is None


def test_control_queries_run_on_a_small_warehouse(spark):
    make = spark.createDataFrame
    t = {
        "dim_date": make([(20250101, 2025), (20160101, 2016)], "date_key int, year int"),
        "dim_time": make([(0,)], "time_key int"),
        "dim_location": make([(1, 9800, "Gent", "Gent", "OV")], "location_key int, postal_code int, municipality string, main_municipality string, province string"),
        "dim_weather_station": make([("7", "Zeebrugge", 1)], "weather_station_id string, name string, location_key int"),
        "fact_weather": make([(7, 20250101, 5.0, 1.0, 9.0, 0.5)], "weather_station_key int, date_key int, temp_avg double, temp_min double, temp_max double, precip_quantity double"),
        "dim_transport_type": make([(1, "Vliegtuig+700", 0.3), (2, "Fiets", 0.0)], "transport_key int, vehicle_type string, co2_per_km double"),
        "dim_bike_station": make([(1, "Oostende Station", 1)], "bike_station_key int, location_name string, location_key int"),
        "fact_bike_gauge": make([(1, 20250101, 800, 7), (1, 20250101, 805, 8)], "bike_station_key int, date_key int, time_key int, total_available int"),
        "dim_counting_point": make([(5, "Fintele brug", 1)], "counting_point_id int, counting_point_name string, location_key int"),
        "fact_counts": counts(spark, (5, 20250101, 10, 5, 15), (5, 20250102, 0, 0, 0), (5, 20250103, 1, 1, 1230)),
        "dim_staff": make([(1, 1, "Campus")], "staff_key int, department_key int, campus string"),
        "dim_department": make([(1, "DBO"), (2, "ALG")], "department_key int, department_name string"),
        "fact_department": make([(20250101, 1, 221), (20250101, 1, 220)], "date_key int, department_key int, workers int"),
        "dim_worker": make([(1,)], "worker_id int"),
        "fact_worker_mobility": make([(1, 2), (1, 2)], "worker_id int, transport_key int"),
        "dim_station": make([(1, "Kortrijk")], "station_key int, station_name string"),
        "fact_train_arrivals": make([(1, 20260329, 4), (1, 20260328, 9)], "station_key int, date_key int, arrivals int"),
    }
    pack = queries.control_queries(t, date(2026, 3, 29))
    assert len(pack) == 38
    first = {name: df.first() for name, df in pack.items()}
    assert first["days_since_2017"][0] == 1
    assert first["bike_stations_at_stations"][0] == 1
    assert first["mean_availability_of_station"][0] == 7.5
    assert first["point_year_a"][:] == (3, 1245, 10, 0)
    assert first["busiest_day"]["total"] == 1230 and first["zero_days"][0] == 1 and first["total_not_sum"][0] == 1
    assert first["head_count_per_year"]["workers"] == 220
    assert first["workers_per_vehicle"]["workers"] == 1
    assert first["arrivals_yesterday"][0] == 4
