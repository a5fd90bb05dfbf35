"""Worked examples of every builder: input and expected rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tramline.operators import incremental
from tramline.plans import builders, schemas

D = date(2026, 3, 20)


@pytest.fixture(scope="module")
def locations(spark):
    rows = [(10, 9000, "Gent"), (20, 9050, "Gentbrugge"), (30, 9050, "Ledeberg"), (40, 9300, "Aalst")]
    return spark.createDataFrame(rows, "location_key int, postal_code int, municipality string")


def geocodes(spark, *rows):
    return spark.createDataFrame(
        list(rows), "latitude double, longitude double, postal_code int, alt_postal_code int, alt_municipality string"
    )


def test_minutes(spark):
    df = builders.dim_time(spark).cache()
    assert df.count() == 1440
    assert df.agg(F.min("time_key"), F.max("time_key")).first()[:] == (0, 2359)
    got = {r["time_key"]: (r["full_time"], r["am_pm"], r["hour12"]) for r in df.filter("time_key IN (0, 830, 1200, 2359)").collect()}
    assert got == {0: ("00:00:00", "AM", 12), 830: ("08:30:00", "AM", 8), 1200: ("12:00:00", "PM", 12), 2359: ("23:59:00", "PM", 11)}
    assert builders.dim_time(spark, df).isEmpty()


@pytest.fixture(scope="module")
def calendar(spark):
    public = spark.createDataFrame([(date(y, m, d), n) for y in range(2010, 2027) for m, d, n in ((1, 1, "Nieuwjaar"), (12, 25, "Kerstmis"))], schemas.PUBLIC_HOLIDAYS)
    school = spark.createDataFrame(
        [(date(2026, 2, 16), date(2026, 2, 22), [("Krokusvakantie",)]), (date(2026, 7, 1), date(2026, 8, 31), [("Zomervakantie",)])], schemas.SCHOOL_HOLIDAYS
    )
    return builders.dim_date(builders.standard_days(spark), public, school).cache()


def test_calendar(calendar):
    assert calendar.count() == 6209
    assert len(calendar.columns) == 28
    row = {r["date_key"]: r for r in calendar.filter("date_key IN (20100101, 20261231, 20260101, 20260715, 20260303, 20240712)").collect()}
    first = row[20100101]
    assert (first["day_name_en"], first["day_name_nl"], first["month_name_nl"], first["quarter"]) == ("Friday", "vrijdag", "januari", 1)
    assert (row[20261231]["day_name_en"], row[20261231]["quarter_name"]) == ("Thursday", "Q4")
    assert row[20260101]["is_holiday"] and not row[20260101]["is_working_day"]
    assert row[20260715]["school_holiday_name"] == "Zomervakantie"
    assert not row[20260303]["is_holiday"] and not row[20260303]["is_school_holiday"]
    assert (row[20240712]["month_name_en"], row[20240712]["month_name_nl"]) == ("July", "juli")
    assert calendar.filter("date_key BETWEEN 20200101 AND 20251231").count() == 2192


def test_locations(spark, rows):
    codes = spark.createDataFrame([(99999, "X_TEST_CITY_A", "X_MAIN", "P"), (99998, "B", "M", "P"), (99997, "C", "M", None), (99997, "C", "M", None)], schemas.POSTCODES)
    got = builders.dim_location(codes)
    assert rows(got, "postal_code", "municipality") == [(99997, "C"), (99998, "B"), (99999, "X_Test_City_A")]
    assert builders.dim_location(codes, got).isEmpty()


def test_departments_and_head_count(spark, rows):
    heads = spark.createDataFrame([(2024, 1, "DIT", 60), (2024, 1, "DBO", 240), (2024, 2, "DIT", 61)], schemas.HEAD_COUNT)
    dims = builders.dim_department(heads, date(2026, 2, 9))
    assert rows(dims) == [("DBO", 20260209, 20261231), ("DIT", 20260209, 20261231)]
    keyed = spark.createDataFrame([(1, "DIT"), (2, "DBO")], "department_key int, department_name string")
    fact = builders.fact_department(heads, keyed)
    assert rows(fact) == [(20240101, 1, 60), (20240101, 2, 240), (20240201, 1, 61)]
    assert builders.fact_department(heads, keyed, fact).isEmpty()


def test_bike_stations_only_new(spark, locations, rows):
    feed = spark.createDataFrame([(48, "Gent", 51.0, 3.7, 1, 0, 1, 5, 0), (49, "Ledeberg", 51.03, 3.74, 1, 0, 1, 5, 0)], schemas.BIKE_FEED)
    codes = geocodes(spark, (51.0, 3.7, 9000, None, None), (51.03, 3.74, 9050, 9050, "LEDEBERG"))
    known = spark.createDataFrame([(48,)], "bike_station_key int")
    got = builders.dim_bike_station(feed, codes, locations, known)
    assert rows(got, "bike_station_key", "location_key") == [(49, 30)]
    assert builders.dim_bike_station(feed.filter("id = 48"), codes, locations, known).isEmpty()


def test_location_falls_back_to_the_name_then_the_postcode(spark, locations, rows):
    places = spark.createDataFrame([(1, 1.0, 1.0, "Station Ledeberg"), (2, 2.0, 2.0, "Plein"), (3, 3.0, 3.0, "Ergens")], "id int, latitude double, longitude double, name string")
    codes = geocodes(spark, (1.0, 1.0, 9050, 9050, "Nergens"), (2.0, 2.0, 9050, 9050, "Nergens"), (3.0, 3.0, 1234, None, None))
    got = builders.link_locations(places, codes, locations, "latitude", "longitude", "name")
    assert rows(got, "id", "location_key") == [(1, 30), (2, 20), (3, None)]


@pytest.mark.parametrize(("metres_off", "kept"), [(100, True), (499, True), (1200, False)])
def test_rail_stations_within_500m(spark, locations, rows, metres_off, kept):
    lat = 51.0 + metres_off / 111194.93
    rail = spark.createDataFrame([("http://irail.be/stations/NMBS/0088", "A", lat, 3.7), ("http://irail.be/stations/NMBS/0089", "Far", 49.0, 5.0)], schemas.RAIL_STATIONS)
    bikes = spark.createDataFrame([(51.0, 3.7), (51.0, 3.7001)], "latitude double, longitude double")
    got = builders.dim_station(rail, bikes, geocodes(spark, (lat, 3.7, 9000, None, None)), locations)
    assert rows(got, "uri", "location_key") == ([("0088", 10)] if kept else [])


def test_stations_by_name(spark, rows):
    rail = spark.createDataFrame([("http://irail.be/stations/NMBS/1", "Deinze", 0.0, 0.0), ("http://irail.be/stations/NMBS/2", "Noorderkempen", 0.0, 0.0)], schemas.RAIL_STATIONS)
    bikes = spark.createDataFrame([("Deinze Station",), ("Deinze Station Zuid",), ("Brecht Station",), ("Markt",)], "Location string")
    assert rows(builders.stations_by_name(rail, bikes)) == [("1", "Deinze"), ("2", "Noorderkempen")]


def test_weather_stations(spark, locations, rows):
    feed = spark.createDataFrame([("f", "AWS1", "MELLE", "15.0", "", "", "", "POINT (50.98 3.81)"), ("f", "AWS2", "UCCLE", "x", "", "", "", "bad")], schemas.WEATHER_STATIONS)
    got = builders.dim_weather_station(feed, geocodes(spark, (50.98, 3.81, 9000, None, None)), locations, D)
    assert rows(got, "weather_station_id", "altitude", "latitude", "longitude", "location_key", "snapshot_date") == [("AWS1", 15.0, 50.98, 3.81, 10, D), ("AWS2", None, None, None, None, D)]


def test_weather_day(spark, rows):
    columns = [c for c in schemas.WEATHER_COLUMNS if c != "code"]
    values = {"temp_avg": 10.5, "wind_speed_10m": 4.5, "precip_quantity": -0.1}
    feed = spark.createDataFrame([("f", "6418", "q", "g", datetime(2026, 3, 20, 12), *[values.get(c) for c in columns])], schemas.WEATHER_DAY)
    got = builders.fact_weather(feed)
    assert rows(got, "weather_station_key", "date_key", "temp_avg", "wind_speed_10m", "precip_quantity", "pressure") == [("6418", 20260320, 10.5, 4.5, 0.0, None)]
    assert builders.fact_weather(feed, got).isEmpty()
    assert builders.fact_weather(feed, day=date(2026, 3, 21)).isEmpty()


def test_gauge_snapshot(spark, rows):
    feed = spark.createDataFrame([(1, "A", 0.0, 0.0, 5, 1, 4, 10, 0), (2, "B", 0.0, 0.0, 5, 1, 4, 10, 0)], schemas.BIKE_FEED)
    in_use = spark.createDataFrame([(1, 3)], schemas.BIKES_IN_USE)
    stations = spark.createDataFrame([(1, 51.036, 3.71)], "bike_station_key int, latitude double, longitude double")
    rail = spark.createDataFrame([(101, 51.0361, 3.7101)], "station_key int, latitude double, longitude double")
    got = builders.fact_bike_gauge(feed, in_use, stations, rail, datetime(2026, 3, 21, 8, 30))
    assert rows(got, "bike_station_key", "date_key", "time_key", "bikes_in_use", "linked_station_key") == [(1, 20260321, 830, 3, 101)]
    assert set(got.columns) == set(schemas.LOAD_RULES["fact_bike_gauge"].columns)


def test_counts(spark, rows):
    counts = spark.createDataFrame([(7, date(2026, 3, 20), 10, 12, 22), (7, date(2026, 3, 21), 14, 15, 29)], "counting_point_id int, day date, direction_in int, direction_out int, total int")
    points = spark.createDataFrame([(7,)], "counting_point_id int")
    fact = builders.fact_counts(counts, points)
    assert rows(fact, "date_key", "total") == [(20260320, 22), (20260321, 29)]
    assert builders.fact_counts(counts, points.filter("false")).isEmpty()
    again = builders.replace_month(fact, fact.filter("date_key = 20260320"), D)
    assert rows(again, "date_key") == [(20260320,)]


@pytest.fixture(scope="module")
def commutes(spark):
    blank = [None] * 28
    paper = spark.createDataFrame(
        [(1001, "DIT", "Campus A", "jan/24", "12,5", "0", None, *blank), (1002, "DBO", "Campus B", "feb/24", "8,0", None, "x", *blank), (1001, "DIT", "Campus A", "xxx/24", "9", None, None, *blank)], schemas.COMMUTE
    )
    return builders.combined_commutes(paper, paper.filter("false").drop("Hoofdcampus"))


def test_staff(spark, commutes, rows):
    departments = spark.createDataFrame([(10, "DIT"), (20, "DBO")], "department_key int, department_name string")
    staff = builders.dim_staff(commutes, departments)
    assert rows(staff, "staff_id", "department_key", "campus") == [(1001, 10, "Campus A"), (1002, 20, "Campus B")]


def test_staff_commute(spark, commutes, calendar, rows):
    staff = spark.createDataFrame([(10, 1001), (20, 1002)], "staff_key int, staff_id int")
    fact = builders.fact_staff_commute(commutes, staff, calendar)
    assert [(k, d, float(km)) for k, d, km in rows(fact, "staff_key", "date_key", "distance_km")] == [(10, 20240101, 12.5), (20, 20240201, 8.0)]
    assert builders.fact_staff_commute(commutes, staff, calendar, fact).isEmpty()


def test_students(spark, calendar, rows):
    registered = spark.createDataFrame([("A ", "2024-01-05 08:00:00", 10.0, "Fiets"), ("B", "2024-01-06", 15.0, "Openbaar vervoer - trein"), ("A", "2031-01-06", 15.0, "Auto"), ("B", "2024-01-07", 1.0, "Raket")], "Naam string, Begintijd string, Km double, Vervoermiddel string")
    departments = spark.createDataFrame([(10, "DIT")], "department_key int, department_name string")
    assert rows(builders.dim_student(registered, departments)) == [("A", 10), ("B", 10)]
    students = spark.createDataFrame([(1, "A"), (2, "B ")], "student_key int, student_name string")
    known = spark.createDataFrame([(200, "Trein")], "transport_key int, vehicle_type string")
    late = incremental.late_members(builders.student_trips(registered, calendar), "vehicle_type", known, "vehicle_type")
    assert rows(late) == [("Fiets", 0.0)]
    transport = known.unionByName(late.select(F.lit(100).alias("transport_key"), "vehicle_type"))
    assert rows(builders.fact_student_mobility(registered, calendar, students, transport)) == [(1, 20240105, 100, 10.0), (2, 20240106, 200, 15.0)]


@pytest.fixture(scope="module")
def survey(spark):
    schema = "RecordedDate string, ResponseId string, LocationLatitude int, LocationLongitude int, werkplek int, Finished int, functie int, werk__ int, thuiswerk int, vervoermiddel int, pendeltijd double, pendelafstand double"
    return spark.createDataFrame([("15/03/2024 09:30", "R1", 51047, 37123, 10, 10, 10, 10, 10, 140, 20.0, 8.5), ("15/03/2024 09:31", "R2", 70000, 37123, 990, 10, 10, 10, 10, 150, 40.0, 15.0)], schema)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [("labels3", 1.0, "Aalst"), ("labels195", 1.0, "Docent"), ("labels7", 1.0, "Voltijds"), ("labels8", 1.0, "Geen thuiswerk"), ("labels4", 15.0, "Trein"), ("labels4", 14.0, "Fiets of elektrische fiets (speed pedelec inbegrepen)")]
    return spark.createDataFrame(rows, "label_set string, code double, label string")


def test_workers(spark, survey, labels, locations, rows):
    got = builders.dim_worker(survey, labels, geocodes(spark, (51.047, 3.7123, 9300, None, None)), locations)
    assert rows(got, "response_id", "record_date", "location_key", "work_place", "home_work", "finished") == [("R1", 20240315, 40, "Aalst", "Geen thuiswerk", 1.0), ("R2", 20240315, None, None, "Geen thuiswerk", 1.0)]


def test_worker_trips(spark, survey, labels, rows):
    workers = spark.createDataFrame([(1, "R1", 20240315), (2, "R2", 20240315)], "worker_id int, response_id string, record_date int")
    transport = spark.createDataFrame([(100, "Fiets", 0.0), (200, "Trein", 0.02)], "transport_key int, vehicle_type string, co2_per_km double")
    fact = builders.fact_worker_mobility(survey, labels, workers, transport)
    assert [(w, t, float(e)) for w, t, e in rows(fact, "worker_id", "transport_key", "total_emission")] == [(1, 100, 0.0), (2, 200, 0.3)]


def test_counting_points(spark, locations, rows):
    catalogue = spark.createDataFrame(
        [(1, "c", "P1", "51.0", "3.7", "2020-01-01", "PT15M", "True", "in", "out", 5, "dom", None), (2, "c", "P2", "0.0", "0.0", "2020-01-01", "PT15M", "False", "in", "out", 5, "dom", None)],
        "counting_point_id long, custom_id string, name string, latitude string, longitude string, first_data string, granularity string, directional string, direction_name_in string, direction_name_out string, domain_id int, domain_name string, description string",
    )
    got = builders.dim_counting_point(catalogue, geocodes(spark, (51.0, 3.7, 9000, None, None)), locations)
    assert rows(got, "counting_point_id", "directional", "location_key") == [(1, True, 10)]
    assert got.columns == list(schemas.LOAD_RULES["dim_counting_point"].columns)
