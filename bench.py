"""Time the headline queries: one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tramline.catalog import QUERIES  # noqa: E402
from tramline.session import get_session  # noqa: E402

HEADLINE = [
    # parameterised queries and control queries
    "totals_since_start", "totals_on_day", "wind_of_day", "availability_last_week", "health_census", "busiest_points",
    "control_extremes", "control_yearly_average",
    # reports
    "daily_rises", "weekly_rises", "hourly_profile", "daily_falls", "activity_profile", "season_profile", "season_tests",
    "emission_summary", "km_per_employee", "growth_report", "weather_correlation_raw", "rain_days",
    # operators
    "star_join", "unseen_rows", "pairs_within_500m", "nearest_station", "holidays_by_interval", "location_cascade",
    "quartiles", "described", "standing_of_stations", "lag_and_trailing_means", "chronological_split", "interpolated_days",
    # loads
    "promoted_arrivals", "remaining_staging", "order_rules", "built_calendar", "built_staff_commute", "built_weather",
    # text and statistics
    "counter_series", "mail_reimbursements", "regression_per_series", "naive_forecast_errors", "recursive_forecast",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    width = os.cpu_count() if cpus == "*" else int(cpus)
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{
            "spark_sql_shuffle_partitions": str(width), "spark_ui_enabled": "false", "spark_ui_showConsoleProgress": "false",
            "spark_driver_memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["table_census"](spark, folder).collect()  # start the JVM's code paths once
    took: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_wall_clock", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
