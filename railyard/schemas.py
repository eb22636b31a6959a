"""The thirteen tables of the ticketing model: types, keys, domains and defaults.

One declaration per table drives the Parquet read schemas, the data-quality job
(`operators.quality`) and the defaults that `operators.master_data` fills in.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

LONG, INT, STR = T.LongType(), T.IntegerType(), T.StringType()
BOOL, BIN, NTZ = T.BooleanType(), T.BinaryType(), T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)

# default marker: the column is filled with the job's ``as_of`` instant
AS_OF = "<as_of>"


@dataclass(frozen=True)
class Col:
    name: str
    type: T.DataType
    required: bool = False
    max_len: int | None = None
    domain: tuple[str, ...] | None = None
    default: object = None


@dataclass(frozen=True)
class Table:
    name: str
    cols: tuple[Col, ...]
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return self.cols[0].name

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.cols])

    def col(self, name: str) -> Col:
        return next(c for c in self.cols if c.name == name)


# The value domains of the model.
USER_TYPES = ("Customer", "Staff", "Admin")
SEAT_TYPES = ("Lower", "Upper", "Middle", "Single")
SCHEDULE_STATUS = ("Scheduled", "Delayed", "Cancelled", "Completed")
BOOKING_PAYMENT_STATUS = ("Pending", "Paid", "Refunded", "Failed")
BOOKING_STATUS = ("Active", "Cancelled", "Completed")
TICKET_STATUS = ("Valid", "Used", "Cancelled", "Refunded")
PAYMENT_METHODS = ("Momo", "ZaloPay", "VNPay", "Visa", "MasterCard", "Cash")
PAYMENT_STATUS = ("Success", "Failed", "Pending")
NOTIFICATION_TYPES = ("Reminder", "Cancellation", "Delay", "Payment", "Promotion")

_TABLES = (
    Table(
        "Users",
        (
            Col("UserID", LONG, True),
            Col("FullName", STR, True, 100),
            Col("Email", STR, max_len=100),
            Col("PhoneNumber", STR, True, 20),
            Col("PasswordHash", BIN, True),
            Col("UserType", STR, max_len=20, domain=USER_TYPES, default="Customer"),
            Col("IsActive", BOOL, default=True),
            Col("CreatedAt", NTZ, default=AS_OF),
        ),
        unique=(("Email",), ("PhoneNumber",)),
    ),
    Table(
        "Stations",
        (
            Col("StationID", LONG, True),
            Col("StationCode", STR, True, 10),
            Col("StationName", STR, True, 100),
            Col("City", STR, True, 50),
            Col("Province", STR, True, 50),
            Col("Address", STR, max_len=200),
            Col("IsActive", BOOL, default=True),
        ),
        unique=(("StationCode",),),
    ),
    Table(
        "Routes",
        (
            Col("RouteID", LONG, True),
            Col("RouteCode", STR, True, 20),
            Col("DepartureStationID", LONG),
            Col("ArrivalStationID", LONG),
            Col("Distance", T.DecimalType(8, 2)),
            Col("EstimatedDuration", INT),
            Col("IsActive", BOOL, default=True),
        ),
        unique=(("RouteCode",),),
        foreign={
            "DepartureStationID": ("Stations", "StationID"),
            "ArrivalStationID": ("Stations", "StationID"),
        },
    ),
    Table(
        "Trains",
        (
            Col("TrainID", LONG, True),
            Col("TrainCode", STR, True, 20),
            Col("TrainName", STR, True, 100),
            Col("TrainType", STR, max_len=50),
            Col("TotalCoaches", INT, True),
            Col("IsActive", BOOL, default=True),
        ),
        unique=(("TrainCode",),),
    ),
    Table(
        "SeatClasses",
        (
            Col("SeatClassID", LONG, True),
            Col("ClassName", STR, True, 50),
            Col("Description", STR, max_len=200),
            Col("PriceMultiplier", T.DecimalType(4, 2), default="1.00"),
        ),
        unique=(("ClassName",),),
    ),
    Table(
        "Coaches",
        (
            Col("CoachID", LONG, True),
            Col("TrainID", LONG),
            Col("CoachNumber", INT, True),
            Col("SeatClassID", LONG),
            Col("TotalSeats", INT, True),
        ),
        unique=(("TrainID", "CoachNumber"),),
        foreign={
            "TrainID": ("Trains", "TrainID"),
            "SeatClassID": ("SeatClasses", "SeatClassID"),
        },
    ),
    Table(
        "Seats",
        (
            Col("SeatID", LONG, True),
            Col("CoachID", LONG),
            Col("SeatNumber", STR, True, 10),
            Col("SeatType", STR, max_len=20, domain=SEAT_TYPES),
        ),
        unique=(("CoachID", "SeatNumber"),),
        foreign={"CoachID": ("Coaches", "CoachID")},
    ),
    Table(
        "Schedules",
        (
            Col("ScheduleID", LONG, True),
            Col("TrainID", LONG),
            Col("RouteID", LONG),
            Col("DepartureTime", NTZ, True),
            Col("ArrivalTime", NTZ, True),
            Col("BasePrice", MONEY, True),
            Col("Status", STR, max_len=20, domain=SCHEDULE_STATUS, default="Scheduled"),
            Col("AvailableSeats", INT),
            Col("CreatedAt", NTZ, default=AS_OF),
        ),
        foreign={"TrainID": ("Trains", "TrainID"), "RouteID": ("Routes", "RouteID")},
    ),
    Table(
        "Bookings",
        (
            Col("BookingID", LONG, True),
            Col("BookingCode", STR, True, 20),
            Col("UserID", LONG),
            Col("ScheduleID", LONG),
            Col("BookingDate", NTZ, default=AS_OF),
            Col("TotalAmount", MONEY, True),
            Col("PaymentStatus", STR, max_len=20, domain=BOOKING_PAYMENT_STATUS, default="Pending"),
            Col("BookingStatus", STR, max_len=20, domain=BOOKING_STATUS, default="Active"),
            Col("CancelledAt", NTZ),
            Col("CancellationReason", STR, max_len=500),
        ),
        unique=(("BookingCode",),),
        foreign={
            "UserID": ("Users", "UserID"),
            "ScheduleID": ("Schedules", "ScheduleID"),
        },
    ),
    Table(
        "Tickets",
        (
            Col("TicketID", LONG, True),
            Col("BookingID", LONG),
            Col("SeatID", LONG),
            Col("PassengerName", STR, True, 100),
            Col("PassengerIDNumber", STR, max_len=20),
            Col("PassengerPhone", STR, max_len=20),
            Col("TicketPrice", MONEY, True),
            Col("TicketStatus", STR, max_len=20, domain=TICKET_STATUS, default="Valid"),
        ),
        foreign={"BookingID": ("Bookings", "BookingID"), "SeatID": ("Seats", "SeatID")},
    ),
    Table(
        "Payments",
        (
            Col("PaymentID", LONG, True),
            Col("BookingID", LONG),
            Col("PaymentMethod", STR, max_len=50, domain=PAYMENT_METHODS),
            Col("TransactionID", STR, max_len=100),
            Col("Amount", MONEY, True),
            Col("PaymentDate", NTZ, default=AS_OF),
            Col("PaymentStatus", STR, max_len=20, domain=PAYMENT_STATUS, default="Pending"),
            Col("ResponseCode", STR, max_len=50),
            Col("ResponseMessage", STR, max_len=500),
        ),
        foreign={"BookingID": ("Bookings", "BookingID")},
    ),
    Table(
        "RefundPolicies",
        (
            Col("PolicyID", LONG, True),
            Col("HoursBeforeDeparture", INT, True),
            Col("RefundPercentage", T.DecimalType(5, 2), True),
            Col("Description", STR, max_len=200),
        ),
    ),
    Table(
        "Notifications",
        (
            Col("NotificationID", LONG, True),
            Col("UserID", LONG),
            Col("BookingID", LONG),
            Col("NotificationType", STR, max_len=50, domain=NOTIFICATION_TYPES),
            Col("Title", STR, max_len=200),
            Col("Message", STR, max_len=1000),
            Col("IsRead", BOOL, default=False),
            Col("SentAt", NTZ, default=AS_OF),
            Col("ScheduledFor", NTZ),
        ),
        foreign={
            "UserID": ("Users", "UserID"),
            "BookingID": ("Bookings", "BookingID"),
        },
    ),
)

TABLES: dict[str, Table] = {t.name: t for t in _TABLES}
