"""Small helpers for tests on the sample data."""

from __future__ import annotations

import datetime as dt

from railyard.plans.tables import Tables, merge_rows
from railyard.schemas import TABLES
from railyard.sources.store import with_ids

AS_OF = "2025-11-05 12:00:00"
KEYS = {
    "bookings": "Bookings",
    "tickets": "Tickets",
    "payments": "Payments",
    "new_payments": "Payments",
    "schedules": "Schedules",
}


def fix(df):
    """The frame as literal rows, so that plans of long flows stay short."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def apply(t: Tables, result: dict) -> Tables:
    """Tables after a job: changed and new rows merged, notifications appended."""
    new = {}
    for part, table in KEYS.items():
        if part in result:
            base = new.get(table, t[table])
            key = TABLES[table].key
            new[table] = fix(merge_rows(base, result[part].select(*base.columns), key))
    if "notifications" in result:
        rows = with_ids(t, "Notifications", result["notifications"], "BookingID", "Message")
        new["Notifications"] = fix(t["Notifications"].unionByName(rows))
    bounds = {n: b for n, b in t.bounds.items() if n in new}
    return t.with_frames(bounds, **new)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def frame(spark, table, values):
    return spark.createDataFrame(values, TABLES[table].struct)


def ts(text):
    return dt.datetime.fromisoformat(text)


BOOKING_REQUEST = (
    "request_id bigint, user_id bigint, schedule_id bigint, seat_ids string,"
    " passenger_names string, payment_method string"
)
CANCEL = "request_id bigint, booking_id bigint, reason string, admin_id bigint"
ATTEMPT = "request_id bigint, booking_id bigint, transaction_id string, response_code string"
FLOW_REQUESTS = [
    (1, 1, 1, "3,4", "Tôn, Anh", "VNPay"),
    (2, 2, 1, "12,13", "Thanh, Hưng", "VNPay"),
    (3, 3, 1, "21,22,25", "Long, VIệt, Bình", "VNPay"),
]
