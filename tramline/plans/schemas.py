"""Input schemas and the rule table of the warehouse."""

from __future__ import annotations

from tramline.operators.rules import TableRules

# --- landed inputs ------------------------------------------------------------------------

BIKE_FEED = (
    "id int, name string, latitude double, longitude double, total_bikes_available int, "
    "e_bikes_available int, blue_bikes_available int, max_capacity int, bikes_defect int"
)
BIKES_IN_USE = "id int, bikes_in_use int"
RAIL_STATIONS = "URI string, name string, latitude double, longitude double"
POSTCODES = "Postcode int, Plaatsnaam string, Hoofdgemeente string, Provincie string"
COMMUTE = "PersoneelsID int, Entiteit string, Hoofdcampus string, periode string, " + ", ".join(
    f"`dag {i}` string" for i in range(1, 32)
)
HEAD_COUNT = "JAAR int, MAAND int, Entiteit string, aantal int"
PUBLIC_HOLIDAYS = "date date, localName string"
SCHOOL_HOLIDAYS = "startDate date, endDate date, name array<struct<text: string>>"
TRANSPORT_TYPES = "VehicleType string, CO2PerKM decimal(10,5)"
WEATHER_STATIONS = "FID string, code string, name string, altitude string, province string, date_begin string, date_end string, the_geom string"

# Daily weather measures, feed name to table column.
WEATHER_COLUMNS = {
    "code": "weather_station_key",
    "precip_quantity": "precip_quantity",
    "temp_avg": "temp_avg",
    "temp_max": "temp_max",
    "temp_min": "temp_min",
    "temp_grass_pt100_avg": "temp_grass_avg",
    "temp_soil_avg": "temp_soil_avg",
    "temp_soil_avg_5cm": "temp_soil_avg_5cm",
    "temp_soil_avg_10cm": "temp_soil_avg_10cm",
    "temp_soil_avg_20cm": "temp_soil_avg_20cm",
    "temp_soil_avg_50cm": "temp_soil_avg_50cm",
    "wind_speed_10m": "wind_speed_10m",
    "wind_speed_avg_30m": "wind_speed_avg_30m",
    "wind_gusts_speed": "wind_gusts_speed",
    "humidity_rel_shelter_avg": "humidity_avg",
    "pressure": "pressure",
    "sun_duration": "sun_duration",
    "short_wave_from_sky_avg": "short_wave_avg",
    "sun_int_avg": "sun_intensity_avg",
}
WEATHER_DAY = "FID string, code string, qc_flags string, the_geom string, timestamp timestamp_ntz, " + ", ".join(
    f"{c} double" for c in WEATHER_COLUMNS if c != "code"
)

# Measures that cannot physically be negative.
NON_NEGATIVE_WEATHER = [
    "precip_quantity", "wind_speed_10m", "wind_speed_avg_30m", "wind_gusts_speed", "humidity_avg",
    "pressure", "sun_duration", "short_wave_avg", "sun_intensity_avg",
]

# Survey answers to vehicle types, vehicle types to kg CO2 per km.
SURVEY_TRANSPORT = {
    "Te voet": "Te voet",
    "Fiets of elektrische fiets (speed pedelec inbegrepen)": "Fiets",
    "Trein": "Trein",
    "Bus, tram of metro": "Bus",
    "Wagen, bestelwagen of vrachtwagen alleen of met familieleden": "Auto",
    "Wagen, bestelwagen of vrachtwagen, met andere werknemers (op dezelfde of een andere vestigingseenheid tewerkgesteld)": "Auto",
    "Bromfiets of motorfiets": "Bromfiets",
    "Voertuigen van commerciële deelplatformen (bluebike, cambio, ...)": "Auto",
    "Step (al dan niet elektrisch), monowheel, hoverboard, enz.": "Step",
}
STUDENT_TRANSPORT = {
    "Openbaar vervoer - trein": "Trein",
    "Openbaar vervoer - bus": "Bus",
    "Openbaar vervoer - tram": "Trein",
    "Fiets": "Fiets",
    "Te voet": "Te voet",
    "Elektrische fiets / step": "Fiets",
    "Elektrische wagen": "Auto",
    "Auto": "Auto",
}
CO2_RATES = {
    "Te voet": 0.0, "Fiets": 0.0, "Step": 0.0, "Trein": 0.02, "Bus": 0.03, "Auto": 0.15, "Bromfiets": 0.08,
}

# Survey columns to their label set.
WORKER_LABELS = {"work_place": "labels3", "work_function": "labels195", "work_regime": "labels7", "home_work": "labels8"}
TRAVEL_LABELS = {"travel_type": "labels4"}

# Fixed value: start of the station identifiers in the rail feed, stored without it.
RAIL_URI_PREFIX = "http://irail.be/stations/NMBS/"

# Station names the rail feed spells differently.
STATION_ALIASES = {
    "Beveren-Waas": "Beveren",
    "Brecht": "Noorderkempen",
    "Mortsel-Oude-God": "Mortsel-Oude God",
    "Sint-Maria-Aalter": "Maria-Aalter",
}

# --- rules --------------------------------------------------------------------------------


# What must hold for each table.
def _rules() -> dict[str, TableRules]:
    tables = [
        TableRules(
            "dim_time",
            columns=("time_key", "full_time", "hour", "minute", "am_pm", "hour12"),
            not_null=("time_key", "hour", "minute"), unique=("time_key",),
            non_negative=("time_key", "hour", "minute", "hour12"), row_count=1440,
        ),
        TableRules(
            "dim_date",
            columns=("date_key", "full_date", "day_of_month", "month", "quarter", "year", "is_holiday", "is_weekend",
                     "is_working_day", "is_school_holiday"),
            not_null=("date_key", "year", "month", "day_of_month"), unique=("date_key",),
            non_negative=("date_key", "year", "month", "day_of_month", "quarter"), date_keys=("date_key",),
            row_count=6209,
        ),
        TableRules(
            "dim_location",
            columns=("postal_code", "municipality", "main_municipality", "province"),
            not_null=("postal_code", "municipality", "main_municipality"),
            unique=("postal_code", "municipality", "main_municipality", "province"), row_count=2764,
        ),
        TableRules(
            "dim_transport_type", columns=("vehicle_type", "co2_per_km"), not_null=("vehicle_type",),
            unique=("vehicle_type",), non_negative=("co2_per_km",), row_count=8,
        ),
        TableRules(
            "dim_bike_station",
            columns=("bike_station_key", "location_key", "location_name", "latitude", "longitude"),
            not_null=("bike_station_key", "location_key", "latitude", "longitude"), unique=("bike_station_key",),
            non_negative=("bike_station_key", "location_key"), empty="ok",
        ),
        TableRules(
            "dim_station", columns=("uri", "station_name", "latitude", "longitude", "location_key"),
            not_null=("uri", "station_name", "latitude", "longitude"), unique=("uri",), empty="ok",
        ),
        TableRules(
            "dim_weather_station",
            columns=("weather_station_id", "name", "altitude", "latitude", "longitude", "location_key", "snapshot_date"),
            not_null=("weather_station_id", "latitude", "longitude", "snapshot_date"),
            unique=("weather_station_id",), non_negative=("location_key",),
        ),
        TableRules(
            "dim_worker",
            columns=("response_id", "record_date", "location_key", "latitude", "longitude", "work_place",
                     "work_function", "work_regime", "home_work", "finished"),
            not_null=("response_id", "record_date"), unique=("response_id",), non_negative=("location_key",),
            date_keys=("record_date",),
        ),
        TableRules(
            "dim_department", columns=("department_name", "start_date", "end_date"),
            not_null=("department_name", "start_date", "end_date"), unique=("department_name",),
            non_negative=("start_date", "end_date"), date_keys=("start_date", "end_date"),
        ),
        TableRules(
            "dim_staff", columns=("staff_id", "department_key", "campus"), not_null=("staff_id",),
            unique=("staff_id",), non_negative=("department_key",), empty="ok",
        ),
        TableRules(
            "dim_student", columns=("student_name", "department_key"), not_null=("student_name",),
            unique=("student_name",), non_negative=("department_key",), empty="ok",
        ),
        TableRules(
            "dim_counting_point",
            columns=("counting_point_id", "custom_id", "counting_point_name", "latitude", "longitude", "first_data",
                     "granularity", "directional", "direction_name_in", "direction_name_out", "domain_id",
                     "domain_name", "description", "location_key"),
            not_null=("counting_point_id", "location_key"), unique=("counting_point_id",),
            non_negative=("counting_point_id", "domain_id", "location_key"), empty="ok",
        ),
        TableRules(
            "fact_weather", columns=("weather_station_key", "date_key", *NON_NEGATIVE_WEATHER),
            not_null=("weather_station_key", "date_key"), unique=("weather_station_key", "date_key"),
            non_negative=tuple(NON_NEGATIVE_WEATHER), date_keys=("date_key",), empty="warn",
        ),
        TableRules(
            "fact_bike_gauge",
            columns=("bike_station_key", "date_key", "time_key", "total_available", "e_bikes_available",
                     "bikes_available", "max_capacity", "bikes_defect", "bikes_in_use", "linked_station_key"),
            not_null=("bike_station_key", "date_key", "time_key"),
            unique=("bike_station_key", "date_key", "time_key"),
            non_negative=("bike_station_key", "date_key", "time_key", "total_available", "e_bikes_available",
                          "bikes_available", "max_capacity", "bikes_defect", "bikes_in_use", "linked_station_key"),
            date_keys=("date_key",),
        ),
        TableRules(
            "fact_worker_mobility",
            columns=("worker_id", "date_key", "transport_key", "travel_time", "travel_distance", "total_emission"),
            not_null=("worker_id", "date_key"),
            non_negative=("travel_time", "travel_distance", "total_emission", "transport_key"),
        ),
        TableRules(
            "fact_department", columns=("date_key", "department_key", "workers"),
            not_null=("date_key", "department_key"), unique=("date_key", "department_key"),
            non_negative=("date_key", "department_key", "workers"), date_keys=("date_key",),
        ),
        TableRules(
            "fact_staff_commute", columns=("staff_key", "date_key", "period", "distance_km"),
            not_null=("staff_key", "date_key"), non_negative=("staff_key", "date_key", "distance_km"),
            date_keys=("date_key",),
        ),
        TableRules(
            "fact_counts",
            columns=("counting_point_id", "date_key", "direction_in", "direction_out", "total"),
            not_null=("counting_point_id", "date_key"), unique=("counting_point_id", "date_key"),
            non_negative=("direction_in", "direction_out", "total"), date_keys=("date_key",),
            total_of=("total", "direction_in", "direction_out"), empty="ok",
        ),
        TableRules(
            "fact_student_mobility", columns=("student_key", "date_key", "transport_key", "distance_km"),
            not_null=("student_key", "date_key"),
            non_negative=("student_key", "date_key", "distance_km", "transport_key"),
        ),
        TableRules(
            "fact_train_arrivals", columns=("station_key", "date_key", "start_time", "end_time", "arrivals"),
            not_null=("station_key", "date_key", "start_time", "end_time"),
            unique=("station_key", "date_key", "start_time"),
            non_negative=("station_key", "date_key", "start_time", "end_time", "arrivals"),
            date_keys=("date_key",), ordered_pair=("start_time", "end_time", 2330, 0),
        ),
    ]
    return {t.name: t for t in tables}


LOAD_RULES = _rules()

#: Update runs leave out the tables that have their own loaders.
UPDATE_RULES = {
    name: rules.for_update()
    for name, rules in LOAD_RULES.items()
    if name not in ("fact_bike_gauge", "fact_train_arrivals", "fact_counts", "fact_weather")
}

# The foreign keys of the model, dimensions first.
FOREIGN_KEYS = {
    "dim_department": {"start_date": ("dim_date", "date_key"), "end_date": ("dim_date", "date_key")},
    "dim_staff": {"department_key": ("dim_department", "department_key")},
    "dim_student": {"department_key": ("dim_department", "department_key")},
    "dim_worker": {"location_key": ("dim_location", "location_key")},
    "dim_station": {"location_key": ("dim_location", "location_key")},
    "dim_bike_station": {"location_key": ("dim_location", "location_key")},
    "dim_counting_point": {"location_key": ("dim_location", "location_key")},
    "fact_counts": {"counting_point_id": ("dim_counting_point", "counting_point_id"), "date_key": ("dim_date", "date_key")},
    "fact_weather": {"date_key": ("dim_date", "date_key")},
    "fact_staff_commute": {"staff_key": ("dim_staff", "staff_key"), "date_key": ("dim_date", "date_key")},
    "fact_bike_gauge": {
        "bike_station_key": ("dim_bike_station", "bike_station_key"),
        "date_key": ("dim_date", "date_key"),
        "time_key": ("dim_time", "time_key"),
        "linked_station_key": ("dim_station", "station_key"),
    },
    "fact_worker_mobility": {
        "worker_id": ("dim_worker", "worker_id"),
        "date_key": ("dim_date", "date_key"),
        "transport_key": ("dim_transport_type", "transport_key"),
    },
    "fact_train_arrivals": {
        "station_key": ("dim_station", "station_key"),
        "date_key": ("dim_date", "date_key"),
        "start_time": ("dim_time", "time_key"),
        "end_time": ("dim_time", "time_key"),
    },
    "fact_department": {"date_key": ("dim_date", "date_key"), "department_key": ("dim_department", "department_key")},
    "fact_student_mobility": {
        "student_key": ("dim_student", "student_key"),
        "date_key": ("dim_date", "date_key"),
        "transport_key": ("dim_transport_type", "transport_key"),
    },
}
