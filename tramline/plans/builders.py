"""Warehouse builders: pure functions from landed frames to candidate tables.

Every builder returns a logical plan and takes its load moment as an argument. ``existing``
is the current content of the target table; only unseen natural keys come back.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import dates, geo, keys, text, values
from tramline.operators import incremental, joins, reshape, spatial
from tramline.plans import schemas
from tramline.sources import generated

# --- calendar -----------------------------------------------------------------------------


def dim_time(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The 1440 minutes of a day."""
    minute = F.col("minute_of_day")
    hour, rest = F.floor(minute / 60).cast("int"), minute % 60
    rows = generated.minutes_of_day(spark).select(
        (hour * 100 + rest).alias("time_key"),
        F.format_string("%02d:%02d:00", hour, rest).alias("full_time"),
        hour.alias("hour"),
        rest.alias("minute"),
        F.when(hour < 12, "AM").otherwise("PM").alias("am_pm"),
        ((hour + 11) % 12 + 1).alias("hour12"),
    )
    return _unseen(rows, existing, ["time_key"])


def dim_date(
    days: DataFrame, public_holidays: DataFrame, school_holidays: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Calendar attributes of every ``day`` with public and school holidays.

    ``public_holidays``: (date, localName), a later row for a date wins by name order;
    ``school_holidays``: (startDate, endDate, name[].text), later starts overwrite earlier ones.
    """
    day = F.col("day")
    columns = dates.calendar_columns(day)
    weekend = columns.pop("is_weekend")
    feast = public_holidays.groupBy(F.col("date").alias("day")).agg(F.max("localName").alias("holiday_name"))
    school = joins.on_days(
        school_holidays.select("startDate", "endDate", F.get("name", F.lit(0))["text"].alias("school_holiday_name")),
        "startDate", "endDate", "startDate", "school_holiday_name",
    )
    rows = days.join(feast, "day", "left").join(school, "day", "left")
    holiday = F.col("holiday_name").isNotNull()
    out = rows.select(
        *(c.alias(n) for n, c in columns.items()),
        holiday.alias("is_holiday"),
        "holiday_name",
        weekend.alias("is_weekend"),
        (~(weekend | holiday)).alias("is_working_day"),
        F.col("school_holiday_name").isNotNull().alias("is_school_holiday"),
        "school_holiday_name",
    )
    return _unseen(out, existing, ["date_key"])


def standard_days(spark: SparkSession, start: date = date(2010, 1, 1), end: date = date(2026, 12, 31)) -> DataFrame:
    return generated.days_between(spark, start, end)


# --- reference dimensions -----------------------------------------------------------------


def dim_location(postcodes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Municipalities in title case, one row per (postal code, municipality, main, province)."""
    rows = reshape.rename(
        postcodes,
        {"Postcode": "postal_code", "Plaatsnaam": "municipality", "Hoofdgemeente": "main_municipality", "Provincie": "province"},
    )
    named = rows.select(
        "postal_code",
        text.title_case(F.col("municipality")).alias("municipality"),
        text.title_case(F.col("main_municipality")).alias("main_municipality"),
        "province",
    ).distinct()
    return _unseen(named, existing, ["postal_code", "municipality", "main_municipality", "province"])


def dim_transport_type(rates: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = rates.select(F.col("VehicleType").alias("vehicle_type"), F.col("CO2PerKM").alias("co2_per_km"))
    return _unseen(rows, existing, ["vehicle_type"])


def dim_department(head_count: DataFrame, as_of: date, existing: DataFrame | None = None) -> DataFrame:
    """Departments seen in the head count, valid from the load day."""
    rows = head_count.select(F.col("Entiteit").alias("department_name")).distinct()
    dated = incremental.with_validity(rows, as_of)
    return _unseen(dated, existing, ["department_name"])


def link_locations(places: DataFrame, geocodes: DataFrame, locations: DataFrame, lat: str, lon: str, name: str | None) -> DataFrame:
    """Location key of each place, from landed geocodes (latitude, longitude, postal_code,
    alt_postal_code, alt_municipality) in place of online look-ups."""
    at = geocodes.select(
        F.col("latitude").alias("__la"), F.col("longitude").alias("__lo"), "postal_code", "alt_postal_code", "alt_municipality"
    ).dropDuplicates(["__la", "__lo"])
    coded = places.join(at, (F.col(lat) == F.col("__la")) & (F.col(lon) == F.col("__lo")), "left").drop("__la", "__lo")
    linked = joins.location_cascade(coded, locations, name)
    return linked.select(*places.columns, "location_key")


def dim_bike_station(feed: DataFrame, geocodes: DataFrame, locations: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    rows = feed.select(
        F.col("id").alias("bike_station_key"), F.col("name").alias("location_name"), "latitude", "longitude"
    )
    fresh = _unseen(rows, existing, ["bike_station_key"])
    return link_locations(fresh, geocodes, locations, "latitude", "longitude", "location_name")


def dim_station(
    rail: DataFrame, bike_stations: DataFrame, geocodes: DataFrame, locations: DataFrame,
    existing: DataFrame | None = None, metres: float = 500, prefix: str = schemas.RAIL_URI_PREFIX,
) -> DataFrame:
    """Rail stations with a bike station within ``metres``."""
    rows = rail.select(
        text.strip_prefix(F.col("URI"), prefix).alias("uri"), F.col("name").alias("station_name"), "latitude", "longitude"
    ).distinct()
    near = spatial.near_any(rows, bike_stations, metres, ("latitude", "longitude"), ("latitude", "longitude"))
    fresh = _unseen(near, existing, ["uri"])
    return link_locations(fresh, geocodes, locations, "latitude", "longitude", "station_name")


def stations_by_name(rail: DataFrame, bikes: DataFrame, location: str = "Location", prefix: str = schemas.RAIL_URI_PREFIX) -> DataFrame:
    """Older variant: rail stations whose name equals a bike place '<name> Station ...'."""
    named = bikes.filter(F.col(location).contains("Station")).select(
        values.replace_values(text.drop_tail(F.col(location), "Station"), schemas.STATION_ALIASES).alias("station_name")
    ).distinct()
    return rail.join(named, F.col("name") == F.col("station_name")).select(
        text.strip_prefix(F.col("URI"), prefix).alias("uri"), "station_name"
    )


def dim_weather_station(
    feed: DataFrame, geocodes: DataFrame, locations: DataFrame, as_of: date, existing: DataFrame | None = None
) -> DataFrame:
    """Weather stations; the point text stores latitude first. Replaced as a full snapshot."""
    lat, lon = text.wkt_point(F.col("the_geom"))
    rows = feed.select(
        F.col("code").alias("weather_station_id"),
        "name",
        values.lenient_number(F.col("altitude")).alias("altitude"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        F.lit(as_of).alias("snapshot_date"),
    ).dropDuplicates(["weather_station_id"])
    fresh = _unseen(rows, existing, ["weather_station_id"])
    return link_locations(fresh, geocodes, locations, "latitude", "longitude", "name")


def dim_counting_point(
    catalogue: DataFrame, geocodes: DataFrame, locations: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Counting points that could be linked to a location."""
    rows = catalogue.select(
        F.col("counting_point_id").cast("int").alias("counting_point_id"),
        "custom_id",
        F.col("name").alias("counting_point_name"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "first_data",
        "granularity",
        values.lenient_boolean(F.col("directional")).alias("directional"),
        "direction_name_in",
        "direction_name_out",
        "domain_id",
        "domain_name",
        "description",
    )
    fresh = _unseen(rows, existing, ["counting_point_id"])
    linked = link_locations(fresh, geocodes, locations, "latitude", "longitude", "counting_point_name")
    return linked.dropna(subset=["location_key"])


# --- people -------------------------------------------------------------------------------


def combined_commutes(paper: DataFrame, mails: DataFrame) -> DataFrame:
    """Reimbursements of both channels with English names (wide day columns kept)."""
    names = {"PersoneelsID": "staff_id", "Entiteit": "entity", "Hoofdcampus": "campus", "periode": "period"}
    left = reshape.rename(paper, names)
    right = reshape.rename(mails, names)
    days = [f"dag {i}" for i in range(1, 32)]
    keep = ["staff_id", "entity", "campus", "period"]

    def shaped(df: DataFrame, rank: int) -> DataFrame:
        full = reshape.ensure_columns(df, {c: "string" for c in [*keep, *days]})
        return full.select(*keep, *(F.col(f"`{d}`").cast("string").alias(d) for d in days), F.lit(rank).alias("channel"))

    return shaped(left, 0).unionByName(shaped(right, 1))


def dim_staff(commutes: DataFrame, departments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per staff member; the paper channel and the earliest campus name win."""
    linked = joins.lookup(commutes, departments, {"entity": "department_name"}, {"department_key": "department_key"})
    first = joins.first_by(linked, ["staff_id"], ["channel", "entity", "campus"], ["department_key", "campus"])
    return _unseen(first, existing, ["staff_id"])


def fact_staff_commute(
    commutes: DataFrame, staff: DataFrame, calendar: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Kilometres per staff member and day out of the wide day columns."""
    long = reshape.unpivot_days(commutes, ["staff_id", "period"], value="raw")
    parts = F.split("period", "/")
    rows = (
        long.filter(F.col("raw").isNotNull() & F.col("period").isNotNull())
        .withColumns(
            {
                "distance_km": values.lenient_number(F.col("raw")),
                "month": dates.month_number(parts[0]),
                "year": dates.two_digit_year(parts[1]),
                "staff_id": F.col("staff_id").cast("string"),
            }
        )
        .filter((F.col("distance_km") > 0) & F.col("month").isNotNull())
    )
    people = staff.select("staff_key", F.col("staff_id").cast("string").alias("staff_id"))
    days = calendar.select("date_key", "day_of_month", "month", "year")
    fact = (
        rows.join(people, "staff_id")
        .join(days, ["day_of_month", "month", "year"])
        .select("staff_key", "date_key", "period", F.col("distance_km").cast("decimal(10,2)").alias("distance_km"))
    )
    return _unseen(fact, existing, ["staff_key", "date_key"])


def dim_student(registrations: DataFrame, departments: DataFrame, existing: DataFrame | None = None, department: str = "DIT") -> DataFrame:
    names = registrations.select(F.trim("Naam").alias("student_name")).filter(F.col("student_name").isNotNull()).distinct()
    rows = joins.lookup(
        names.withColumn("department_name", F.lit(department)), departments,
        {"department_name": "department_name"}, {"department_key": "department_key"},
    ).select("student_name", "department_key")
    return _unseen(rows, existing, ["student_name"])


def student_trips(registrations: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cleaned registrations with a known day, name and vehicle type."""
    rows = registrations.select(
        F.trim("Naam").alias("student_name"),
        keys.date_key(F.col("Begintijd").cast("timestamp_ntz")).alias("date_key"),
        values.map_values(F.trim("Vervoermiddel"), schemas.STUDENT_TRANSPORT).alias("vehicle_type"),
        F.col("Km").cast("double").alias("distance_km"),
    )
    return joins.known_rows(rows, calendar, ["date_key"]).dropna(subset=["vehicle_type", "student_name"])


def fact_student_mobility(
    registrations: DataFrame, calendar: DataFrame, students: DataFrame, transport: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Student trips; run ``incremental.late_members`` on the transport types before."""
    trips = student_trips(registrations, calendar)
    who = students.select("student_key", F.trim("student_name").alias("student_name"))
    linked = joins.lookup(trips, who, {"student_name": "student_name"}, {"student_key": "student_key"})
    linked = joins.lookup(linked, transport, {"vehicle_type": "vehicle_type"}, {"transport_key": "transport_key"})
    fact = linked.select("student_key", "date_key", "transport_key", "distance_km")
    return _unseen(fact, existing, ["student_key", "date_key", "transport_key"])


def survey_day(recorded: str = "RecordedDate"):
    return keys.date_key(F.to_timestamp_ntz(F.col(recorded), F.lit("dd/MM/yyyy HH:mm")))


def dim_worker(
    survey: DataFrame, labels: DataFrame, geocodes: DataFrame, locations: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Survey respondents: coordinates repaired, codes rescaled and decoded, located if inside the box."""
    rows = survey.select(
        F.col("ResponseId").alias("response_id"),
        survey_day().alias("record_date"),
        geo.repair_latitude(F.col("LocationLatitude")).alias("latitude"),
        (F.col("LocationLongitude").cast("double") / 10000).alias("longitude"),
        F.col("werkplek").alias("work_place"),
        F.col("Finished").alias("finished"),
        F.col("functie").alias("work_function"),
        F.col("werk__").alias("work_regime"),
        F.col("thuiswerk").alias("home_work"),
    )
    fresh = _unseen(rows, existing, ["response_id"])
    inside = fresh.withColumns(
        {
            "box_lat": F.when(geo.in_box(F.col("latitude"), F.col("longitude")), F.col("latitude")),
            "box_lon": F.when(geo.in_box(F.col("latitude"), F.col("longitude")), F.col("longitude")),
        }
    )
    linked = link_locations(inside, geocodes, locations, "box_lat", "box_lon", None).drop("box_lat", "box_lon")
    rescaled = reshape.rescale_numeric(linked.select(*fresh.columns, "location_key"), 4, 10)
    rescaled = rescaled.withColumn("location_key", (F.col("location_key") * 10).cast("int"))
    decoded = reshape.decode_labels(rescaled, labels, schemas.WORKER_LABELS)
    return decoded.select(*schemas.LOAD_RULES["dim_worker"].columns)


def worker_trips(survey: DataFrame, labels: DataFrame) -> DataFrame:
    """Commute answers with the vehicle type behind the survey label."""
    rows = survey.select(
        F.col("ResponseId").alias("response_id"),
        survey_day().alias("record_date"),
        F.col("pendeltijd").cast("double").alias("travel_time"),
        F.col("pendelafstand").cast("double").alias("travel_distance"),
        (F.col("vervoermiddel").cast("double") / 10).alias("travel_type"),
    )
    decoded = reshape.decode_labels(rows, labels, schemas.TRAVEL_LABELS)
    return decoded.withColumn("vehicle_type", values.map_values(F.col("travel_type"), schemas.SURVEY_TRANSPORT)).drop("travel_type")


def fact_worker_mobility(
    survey: DataFrame, labels: DataFrame, workers: DataFrame, transport: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Commutes with emission = distance * kg CO2 per km."""
    trips = worker_trips(survey, labels)
    linked = joins.lookup(trips, workers, {"response_id": "response_id", "record_date": "record_date"}, {"worker_id": "worker_id"})
    linked = joins.lookup(
        linked, transport, {"vehicle_type": "vehicle_type"}, {"transport_key": "transport_key", "co2_per_km": "co2_per_km"}
    )
    fact = linked.select(
        "worker_id",
        F.col("record_date").alias("date_key"),
        "transport_key",
        "travel_time",
        "travel_distance",
        (F.col("travel_distance") * F.col("co2_per_km").cast("double")).cast("decimal(18,5)").alias("total_emission"),
    )
    return _unseen(fact, existing, ["worker_id", "date_key", "transport_key"])


def fact_department(head_count: DataFrame, departments: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Monthly head count, dated at the first of the month."""
    linked = joins.lookup(head_count, departments, {"Entiteit": "department_name"}, {"department_key": "department_key"})
    fact = linked.select(
        keys.month_key(F.col("JAAR"), F.col("MAAND")).alias("date_key"), "department_key", F.col("aantal").alias("workers")
    )
    return _unseen(fact, existing, ["date_key", "department_key"])


# --- measurements -------------------------------------------------------------------------


def fact_weather(feed: DataFrame, existing: DataFrame | None = None, day: date | None = None) -> DataFrame:
    """Daily measures per station; small negative sensor errors become 0."""
    rows = feed if day is None else feed.filter(F.col("timestamp").cast("date") == F.lit(day))
    dated = rows.withColumn("date_key", keys.date_key(F.col("timestamp")))
    slim = reshape.rename(dated.drop("FID", "qc_flags", "the_geom", "timestamp"), schemas.WEATHER_COLUMNS)
    clean = reshape.clip_columns(slim, schemas.NON_NEGATIVE_WEATHER)
    return _unseen(clean, existing, ["date_key", "weather_station_key"])


def fact_bike_gauge(
    feed: DataFrame, in_use: DataFrame, bike_stations: DataFrame, rail_stations: DataFrame, as_of: datetime,
    metres: float = 500,
) -> DataFrame:
    """Gauge snapshot of the known bike stations with the nearest rail station."""
    rows = feed.select(
        F.col("id").alias("bike_station_key"),
        F.col("total_bikes_available").alias("total_available"),
        "e_bikes_available",
        F.col("blue_bikes_available").alias("bikes_available"),
        "max_capacity",
        "bikes_defect",
    )
    rows = joins.lookup(rows, in_use, {"bike_station_key": "id"}, {"bikes_in_use": "bikes_in_use"})
    rows = joins.lookup(
        rows, bike_stations, {"bike_station_key": "bike_station_key"}, {"at_lat": "latitude", "at_lon": "longitude"}, "inner"
    )
    moment = keys.wall_clock(as_of)
    stamped = rows.withColumns({"date_key": keys.date_key(moment), "time_key": keys.time_key(moment)})
    linked = spatial.nearest(
        stamped, rail_stations, metres, ("at_lat", "at_lon"), ("latitude", "longitude"), "station_key", "linked_station_key"
    )
    return linked.drop("at_lat", "at_lon")


def fact_counts(counts: DataFrame, points: DataFrame) -> DataFrame:
    """Daily counts of the known counting points."""
    rows = counts.select(
        F.col("counting_point_id").cast("int").alias("counting_point_id"),
        keys.date_key(F.col("day")).alias("date_key"),
        F.col("direction_in").cast("int").alias("direction_in"),
        F.col("direction_out").cast("int").alias("direction_out"),
        F.col("total").cast("int").alias("total"),
    )
    return joins.known_rows(rows, points, ["counting_point_id"])


def replace_month(fact: DataFrame, fresh: DataFrame, as_of: date) -> DataFrame:
    """Counts with the current month reloaded: its old rows go, all fresh rows come."""
    low, high = keys.month_bounds(as_of.year, as_of.month)
    return incremental.drop_range(fact, "date_key", low, high).unionByName(fresh)


def locations_by_postcode(df: DataFrame, locations: DataFrame, postcode: str, town: str, aliases: dict[str, str]) -> DataFrame:
    """Older link: by postal code, else by the aliased municipality name (one row per name)."""
    codes = locations.groupBy(F.col("postal_code").alias("__c")).agg(F.min("location_key").alias("__k1"))
    towns = locations.groupBy(F.col("municipality").alias("__m")).agg(F.min("location_key").alias("__k2"))
    named = df.withColumn("__town", values.replace_values(text.title_case(F.col(town)), aliases))
    joined = named.join(codes, F.col(postcode) == F.col("__c"), "left").join(towns, F.col("__town") == F.col("__m"), "left")
    return joined.select(*df.columns, F.coalesce("__k1", "__k2").alias("location_key"))


def _unseen(rows: DataFrame, existing: DataFrame | None, natural: list[str]) -> DataFrame:
    return rows if existing is None else joins.new_rows(rows, existing, natural)
