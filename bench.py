"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the star files, BENCH_CPUS the local cores. Each query runs once to
warm up; the median of three further full runs into a no-op sink is reported. M01 writes all
five results once; the dimensions that a session prepares once count in the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from railyard.catalog import EARLY, all_queries  # noqa: E402
from railyard.operators.booking_jobs import create_bookings  # noqa: E402
from railyard.sources.commands import booking_requests  # noqa: E402
from railyard.sources.star import star_tables  # noqa: E402

HEADLINE = (
    "q01_revenue_by_date",
    "q02_revenue_by_route",
    "q03_revenue_by_seat_class",
    "q04_top_customers",
    "q06a_revenue_summary",
    "q07a_dashboard_totals",
    "q08b_revenue_by_week",
    "q10_train_utilization",
    "q11_route_performance",
    "q12_customer_segmentation",
    "q13_payment_analytics",
    "q16a_monthly_revenue",
    "q16c_monthly_customers",
    "l07_bookings",
    "l12a_booking_headers",
    "l14_seat_map_of_coach",
    "v02_customer_bookings",
    "v03_ticket_details",
    "v04_seat_availability",
    "f04_seat_available",
    "m02_bookings",
    "m04_payments",
    "m05_departure_reminders",
    "m06_tickets",
    "c03_foreign_keys",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("railyard-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Parquet is compressed: without this, fact tables look small enough to broadcast
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median_seconds(run, times: int) -> float:
    run()
    took = []
    for _ in range(times):
        start = time.perf_counter()
        run()
        took.append(time.perf_counter() - start)
    return round(statistics.median(took), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    every = all_queries()
    start = time.perf_counter()
    tables = star_tables(spark, sf_dir, EARLY)
    seconds = {"prepare_dimensions": round(time.perf_counter() - start, 3)}
    for name in HEADLINE:
        seconds[name] = median_seconds(lambda n=name: consume(every[n](spark, sf_dir)), 3)

    def book():
        for part in create_bookings(tables, booking_requests(spark, sf_dir), EARLY).values():
            consume(part)

    seconds["m01_create_bookings"] = median_seconds(book, 1)
    total = sum(seconds.values())
    print(
        json.dumps(
            {
                "metric": "seconds of preparation and of all queries (medians)",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
