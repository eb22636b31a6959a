"""Oracle SQL of the constraint summary: every rule spelled out as a count."""

from __future__ import annotations

from .ctes import with_tables

KEYS = {
    "Users": ["UserID", "Email", "PhoneNumber"],
    "Stations": ["StationID", "StationCode"],
    "Routes": ["RouteID", "RouteCode"],
    "Trains": ["TrainID", "TrainCode"],
    "SeatClasses": ["SeatClassID", "ClassName"],
    "Coaches": ["CoachID"],
    "Seats": ["SeatID"],
    "Schedules": ["ScheduleID"],
    "Bookings": ["BookingID", "BookingCode"],
    "Tickets": ["TicketID"],
    "Payments": ["PaymentID"],
    "RefundPolicies": ["PolicyID"],
    "Notifications": ["NotificationID"],
}
COMPOSITE = {"Coaches": "TrainID, CoachNumber", "Seats": "CoachID, SeatNumber"}
FOREIGN = [
    ("Routes", "DepartureStationID", "Stations", "StationID"),
    ("Routes", "ArrivalStationID", "Stations", "StationID"),
    ("Coaches", "TrainID", "Trains", "TrainID"),
    ("Coaches", "SeatClassID", "SeatClasses", "SeatClassID"),
    ("Seats", "CoachID", "Coaches", "CoachID"),
    ("Schedules", "TrainID", "Trains", "TrainID"),
    ("Schedules", "RouteID", "Routes", "RouteID"),
    ("Bookings", "UserID", "Users", "UserID"),
    ("Bookings", "ScheduleID", "Schedules", "ScheduleID"),
    ("Tickets", "BookingID", "Bookings", "BookingID"),
    ("Tickets", "SeatID", "Seats", "SeatID"),
    ("Payments", "BookingID", "Bookings", "BookingID"),
    ("Notifications", "UserID", "Users", "UserID"),
    ("Notifications", "BookingID", "Bookings", "BookingID"),
]
DOMAINS = [
    ("Users", "UserType", "'Customer', 'Staff', 'Admin'"),
    ("Seats", "SeatType", "'Lower', 'Upper', 'Middle', 'Single'"),
    ("Schedules", "Status", "'Scheduled', 'Delayed', 'Cancelled', 'Completed'"),
    ("Bookings", "PaymentStatus", "'Pending', 'Paid', 'Refunded', 'Failed'"),
    ("Bookings", "BookingStatus", "'Active', 'Cancelled', 'Completed'"),
    ("Tickets", "TicketStatus", "'Valid', 'Used', 'Cancelled', 'Refunded'"),
    ("Payments", "PaymentMethod", "'Momo', 'ZaloPay', 'VNPay', 'Visa', 'MasterCard', 'Cash'"),
    ("Payments", "PaymentStatus", "'Success', 'Failed', 'Pending'"),
    (
        "Notifications",
        "NotificationType",
        "'Reminder', 'Cancellation', 'Delay', 'Payment', 'Promotion'",
    ),
]
ROWS = [
    ("Users", "contact present", "Email IS NULL AND PhoneNumber IS NULL"),
    ("Routes", "different stations", "DepartureStationID = ArrivalStationID"),
    ("Schedules", "arrival after departure", "ArrivalTime <= DepartureTime"),
]
# per table: columns that must not be NULL, and the greatest lengths of texts
REQUIRED = {
    "Users": "UserID FullName PhoneNumber PasswordHash",
    "Stations": "StationID StationCode StationName City Province",
    "Routes": "RouteID RouteCode",
    "Trains": "TrainID TrainCode TrainName TotalCoaches",
    "SeatClasses": "SeatClassID ClassName",
    "Coaches": "CoachID CoachNumber TotalSeats",
    "Seats": "SeatID SeatNumber",
    "Schedules": "ScheduleID DepartureTime ArrivalTime BasePrice",
    "Bookings": "BookingID BookingCode TotalAmount",
    "Tickets": "TicketID PassengerName TicketPrice",
    "Payments": "PaymentID Amount",
    "RefundPolicies": "PolicyID HoursBeforeDeparture RefundPercentage",
    "Notifications": "NotificationID",
}
LENGTHS = {
    "Users": {"FullName": 100, "Email": 100, "PhoneNumber": 20, "UserType": 20},
    "Stations": {
        "StationCode": 10, "StationName": 100, "City": 50, "Province": 50, "Address": 200
    },
    "Routes": {"RouteCode": 20},
    "Trains": {"TrainCode": 20, "TrainName": 100, "TrainType": 50},
    "SeatClasses": {"ClassName": 50, "Description": 200},
    "Seats": {"SeatNumber": 10, "SeatType": 20},
    "Schedules": {"Status": 20},
    "Bookings": {
        "BookingCode": 20, "PaymentStatus": 20, "BookingStatus": 20, "CancellationReason": 500
    },
    "Tickets": {
        "PassengerName": 100, "PassengerIDNumber": 20, "PassengerPhone": 20, "TicketStatus": 20
    },
    "Payments": {
        "PaymentMethod": 50, "TransactionID": 100, "PaymentStatus": 20, "ResponseCode": 50,
        "ResponseMessage": 500,
    },
    "RefundPolicies": {"Description": 200},
    "Notifications": {"NotificationType": 50, "Title": 200, "Message": 1000},
}


def _required() -> list[str]:
    parts = []
    for table, columns in REQUIRED.items():
        for c in columns.split():
            stored = "PasswordHex" if c == "PasswordHash" else c
            sql = f"SELECT count(*) FROM {table} WHERE {stored} IS NULL"
            parts.append(_rule(table, f"required {c}", sql))
    for table, columns in LENGTHS.items():
        for c, n in columns.items():
            sql = f"SELECT count(*) FROM {table} WHERE length({c}) > {n}"
            parts.append(_rule(table, f"length {c}", sql))
    return parts


def _rule(table: str, rule: str, sql: str) -> str:
    return f"SELECT '{table}' AS TableName, '{rule}' AS Rule, ({sql}) AS Violations"


def _duplicates(table: str, columns: str) -> str:
    given = " AND ".join(f"{c.strip()} IS NOT NULL" for c in columns.split(","))
    sql = f"""SELECT count(*) FROM (SELECT {columns} FROM {table} WHERE {given}
  GROUP BY {columns} HAVING count(*) > 1)"""
    return _rule(table, f"unique {columns}", sql)


def quality_sql(as_of: str) -> dict[str, str]:
    union = "\nUNION ALL ".join
    bodies = {
        "c01_unique_keys": union(_duplicates(t, c) for t, cs in KEYS.items() for c in cs),
        "c02_composite_keys": union(_duplicates(t, c) for t, c in COMPOSITE.items()),
        "c03_foreign_keys": union(
            _rule(
                t,
                f"foreign {c}",
                f"""SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{c})""",
            )
            for t, c, p, k in FOREIGN
        ),
        "c04_domains": union(
            _rule(t, f"domain {c}", f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({v})")
            for t, c, v in DOMAINS
        ),
        "c06_required_and_length": union(_required()),
        "c05_row_checks": union(
            _rule(t, r, f"SELECT count(*) FROM {t} WHERE {cond}") for t, r, cond in ROWS
        ),
    }
    return {name: with_tables(body, as_of) for name, body in bodies.items()}
