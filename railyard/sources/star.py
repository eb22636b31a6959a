"""Reads a star schema of order data as the ticketing tables.

The fact tables, users, trains and seats are projections of star files and are derived
lazily. The small dimensions that the star has no table for are found once per session
and written to the shared folder, so later queries read them as the tables they are, with
a size that the optimizer knows. Their row numbers are the broadcast bounds.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import as_date, instant, keep_days, padded, password_hash
from ..plans.checkpoints import cut, shared_dir
from ..plans.tables import Tables

LONG, INT, STR, DBL, NTZ = (
    T.LongType(),
    T.IntegerType(),
    T.StringType(),
    T.DoubleType(),
    T.TimestampNTZType(),
)

STAR = {
    "region": [("r_regionkey", INT), ("r_name", STR)],
    "nation": [("n_nationkey", INT), ("n_name", STR), ("n_regionkey", INT)],
    "customer": [
        ("c_custkey", LONG),
        ("c_name", STR),
        ("c_nationkey", INT),
        ("c_acctbal", DBL),
        ("c_mktsegment", STR),
    ],
    "supplier": [("s_suppkey", LONG), ("s_name", STR), ("s_nationkey", INT), ("s_acctbal", DBL)],
    "part": [
        ("p_partkey", LONG),
        ("p_name", STR),
        ("p_brand", STR),
        ("p_type", STR),
        ("p_size", INT),
        ("p_retailprice", DBL),
    ],
    "orders": [
        ("o_orderkey", LONG),
        ("o_custkey", LONG),
        ("o_orderstatus", STR),
        ("o_totalprice", DBL),
        ("o_orderdate", NTZ),
        ("o_orderpriority", STR),
    ],
    "lineitem": [
        ("l_orderkey", LONG),
        ("l_partkey", LONG),
        ("l_suppkey", LONG),
        ("l_linenumber", INT),
        ("l_quantity", DBL),
        ("l_extendedprice", DBL),
        ("l_discount", DBL),
        ("l_tax", DBL),
        ("l_returnflag", STR),
        ("l_linestatus", STR),
        ("l_shipdate", NTZ),
    ],
    "events": [
        ("event_id", LONG),
        ("ts", NTZ),
        ("user_id", LONG),
        ("event_type", STR),
        ("value", DBL),
        ("props", STR),
    ],
}

AS_OF = "2001-01-01 00:00:00"
NOTICES_AS_OF = "2024-01-31 00:00:00"

# The refund policies (hours before departure, percentage, text).
POLICIES = (
    (1, 72, "90.00", "Hoàn 90% nếu hủy trước 72 giờ"),
    (2, 48, "70.00", "Hoàn 70% nếu hủy trước 48 giờ"),
    (3, 24, "50.00", "Hoàn 50% nếu hủy trước 24 giờ"),
    (4, 12, "30.00", "Hoàn 30% nếu hủy trước 12 giờ"),
    (5, 0, "0.00", "Không hoàn nếu hủy trong vòng 12 giờ"),
)


def star_schema(name: str) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in STAR[name]])


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(star_schema(name)).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stream_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same file as a stream; further files of that name would be further input."""
    reader = spark.readStream.schema(star_schema(name)).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def _cases(column, pairs, otherwise):
    out = F.lit(otherwise)
    for value, result in reversed(pairs):
        out = F.when(column == value, result).otherwise(out)
    return out


def policies(spark: SparkSession) -> DataFrame:
    rows = [(i, h, Decimal(p), d) for i, h, p, d in POLICIES]
    return spark.createDataFrame(
        rows,
        "PolicyID bigint, HoursBeforeDeparture int, RefundPercentage decimal(5,2),"
        " Description string",
    )


def _hours(n) -> F.Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def schedule_of(date, custkey):
    """One schedule per calendar month and last digit of the customer key."""
    months = (F.year(date) - F.lit(1995)) * F.lit(12) + F.month(date) - F.lit(1)
    return months.cast("bigint") * F.lit(10) + custkey % F.lit(10)


def _month_start_after(schedule_id):
    months = F.floor(schedule_id / F.lit(10)).cast("int") + F.lit(1)
    year = F.lit(1995) + F.floor(months / F.lit(12)).cast("int")
    return F.make_date(year, months % F.lit(12) + F.lit(1), F.lit(1))


@dataclass(frozen=True)
class Star:
    """The star files, and the dimensions written from them so far."""

    spark: SparkSession
    sf_dir: str
    as_of: str = AS_OF
    written: dict[str, DataFrame] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)
    streaming: bool = False

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR:
            raise AttributeError(name)
        read = stream_star if self.streaming else read_star
        return read(self.spark, self.sf_dir, name)

    @property
    def suppliers(self):
        return F.lit(max(self.sizes["Trains"], 1)).cast("bigint")


_WRITTEN: dict[tuple[str, str, str], tuple[dict[str, DataFrame], dict[str, int]]] = {}


def _write_dimensions(spark: SparkSession, sf_dir: str):
    """The written dimensions and all known row numbers, once per session."""
    memo = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir)
    if memo not in _WRITTEN:
        star = Star(spark, sf_dir)
        star.sizes["Trains"] = star.supplier.count()
        makers = {
            "Stations": _stations,
            "Routes": _routes,
            "SeatClasses": _classes,
            "Coaches": _coaches,
            "Schedules": _timetable,
        }
        for name, make in makers.items():
            star.written[name] = cut(make(star))
            star.sizes[name] = star.written[name].count()
        _WRITTEN[memo] = star.written, star.sizes
    return _WRITTEN[memo]


def _null(kind: str):
    return F.lit(None).cast(kind)


def _users(star: Star) -> DataFrame:
    key = F.col("c_custkey")
    return star.customer.select(
        key.alias("UserID"),
        F.col("c_name").alias("FullName"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("Email"),
        F.concat(F.lit("09"), padded(key, 8)).alias("PhoneNumber"),
        password_hash(F.col("c_name")).alias("PasswordHash"),
        F.when(key % 100 == 0, "Admin")
        .when(key % 25 == 0, "Staff")
        .otherwise("Customer")
        .alias("UserType"),
        (F.col("c_acctbal") >= 0).alias("IsActive"),
        (
            instant("1995-01-01")
            + F.make_dt_interval(F.floor(key / 24).cast("int"), (key % 24).cast("int"))
        ).alias("CreatedAt"),
    )


def _stations(star: Star) -> DataFrame:
    n = F.col("n_nationkey").cast("bigint")
    return star.nation.join(
        star.region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        n.alias("StationID"),
        F.concat(F.lit("N"), n.cast("string")).alias("StationCode"),
        F.col("n_name").alias("StationName"),
        F.col("n_name").alias("City"),
        F.col("r_name").alias("Province"),
        _null("string").alias("Address"),
        (n % 10 != 9).alias("IsActive"),
    )


def _routes(star: Star) -> DataFrame:
    n, k = F.col("n_nationkey").cast("bigint"), F.col("k").cast("bigint")
    arrival = (n + k * 7) % 25
    distance = F.lit(100) + n * 10 + k * 50
    twice = star.nation.select("n_nationkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return twice.select(
        (n * 2 + k - 1).alias("RouteID"),
        F.concat(F.lit("N"), n.cast("string"), F.lit("-N"), arrival.cast("string")).alias(
            "RouteCode"
        ),
        n.alias("DepartureStationID"),
        arrival.alias("ArrivalStationID"),
        distance.cast("decimal(8,2)").alias("Distance"),
        # 1.2 minutes per kilometre, in whole minutes
        F.floor(distance * 6 / 5).cast("int").alias("EstimatedDuration"),
        F.lit(True).alias("IsActive"),
    )


def _trains(star: Star) -> DataFrame:
    s = F.col("s_suppkey")
    return star.supplier.select(
        s.alias("TrainID"),
        F.concat(F.lit("T"), s.cast("string")).alias("TrainCode"),
        F.col("s_name").alias("TrainName"),
        _cases(s % 3, [(0, "SE"), (1, "TN")], "SNT").alias("TrainType"),
        (s % 7 + 6).cast("int").alias("TotalCoaches"),
        (F.col("s_acctbal") >= 0).alias("IsActive"),
    )


def _classes(star: Star) -> DataFrame:
    # one row per class: the unpartitioned window only ever sees the distinct types
    return (
        star.part.select("p_type")
        .distinct()
        .withColumn("id", F.row_number().over(Window.orderBy("p_type")).cast("bigint"))
        .select(
            F.col("id").alias("SeatClassID"),
            F.col("p_type").alias("ClassName"),
            _null("string").alias("Description"),
            ((F.col("id") * 3 + 7) / F.lit(10)).cast("decimal(4,2)").alias("PriceMultiplier"),
        )
    )


def _class_ids(star: Star) -> DataFrame:
    return star.written["SeatClasses"].select("SeatClassID", F.col("ClassName").alias("p_type"))


def _coach_id():
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("bigint")
    return brand * 10 + F.col("SeatClassID")


def _coaches(star: Star) -> DataFrame:
    return (
        star.part.groupBy("p_brand", "p_type")
        .agg(F.count(F.lit(1)).alias("seats"))
        .join(_class_ids(star), "p_type")
        .select(
            _coach_id().alias("CoachID"),
            (_coach_id() % star.suppliers).alias("TrainID"),
            _coach_id().cast("int").alias("CoachNumber"),
            "SeatClassID",
            F.col("seats").cast("int").alias("TotalSeats"),
        )
    )


def _seats(star: Star) -> DataFrame:
    p = F.col("p_partkey")
    return star.part.join(_class_ids(star), "p_type").select(
        p.alias("SeatID"),
        _coach_id().alias("CoachID"),
        # the key itself numbers the seat: unique in the coach without ranking its seats
        padded(p, 4).alias("SeatNumber"),
        _cases(p % 3, [(1, "Lower"), (2, "Middle")], "Upper").alias("SeatType"),
    )


def _timetable(star: Star) -> DataFrame:
    """Schedules without their status, which depends on the time of the query."""
    sid = F.col("ScheduleID")
    duration = star.written["Routes"].select("RouteID", "EstimatedDuration")
    departs = _month_start_after(sid).cast("timestamp_ntz") + F.make_dt_interval(
        (sid % 28).cast("int"), (sid % 24).cast("int")
    )
    takes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("EstimatedDuration"))
    ids = schedule_of(F.col("o_orderdate"), F.col("o_custkey"))
    return (
        star.orders.select(ids.alias("ScheduleID"))
        .distinct()
        .withColumn("RouteID", sid % 50)
        .join(duration, "RouteID")
        .withColumn("DepartureTime", departs)
        .select(
            "ScheduleID",
            (sid % star.suppliers).alias("TrainID"),
            "RouteID",
            "DepartureTime",
            (F.col("DepartureTime") + takes).alias("ArrivalTime"),
            (F.lit(300000) + sid % 10 * 50000).cast("decimal(10,2)").alias("BasePrice"),
            (F.lit(350) - sid % 100).cast("int").alias("AvailableSeats"),
            (F.col("DepartureTime") - F.make_dt_interval(F.lit(60))).alias("CreatedAt"),
        )
    )


def _schedules(star: Star) -> DataFrame:
    sid = F.col("ScheduleID")
    status = (
        F.when(sid % 20 == 0, "Cancelled")
        .when(sid % 20 == 1, "Delayed")
        .when(F.col("ArrivalTime") < instant(star.as_of), "Completed")
        .otherwise("Scheduled")
    )
    return star.written["Schedules"].select(
        "ScheduleID",
        "TrainID",
        "RouteID",
        "DepartureTime",
        "ArrivalTime",
        "BasePrice",
        status.alias("Status"),
        "AvailableSeats",
        "CreatedAt",
    )


def _booked_at():
    return F.col("o_orderdate") + _hours(F.col("o_orderkey") % 24)


def _amount():
    return (F.col("o_totalprice").cast("decimal(10,2)") * F.lit(3)).cast("decimal(10,2)")


def _ordered(star: Star, start, end, earlier: int = 0) -> DataFrame:
    """Orders of the days on which bookings of these days were ordered: the hours of a
    booking never leave its day. A plain range on a column of the file is pushed down."""
    first = None if start is None else as_date(start) - dt.timedelta(days=earlier)
    return keep_days(star.orders, "o_orderdate", first, end)


def _bookings(star: Star, orders: DataFrame | None = None) -> DataFrame:
    o = F.col("o_orderkey")
    return (star.orders if orders is None else orders).select(
        o.alias("BookingID"),
        F.concat(F.lit("BK"), F.date_format("o_orderdate", "yyyyMMdd"), padded(o, 8)).alias(
            "BookingCode"
        ),
        F.col("o_custkey").alias("UserID"),
        schedule_of(F.col("o_orderdate"), F.col("o_custkey")).alias("ScheduleID"),
        _booked_at().alias("BookingDate"),
        _amount().alias("TotalAmount"),
        _cases(o % 10, [(7, "Pending"), (8, "Refunded"), (9, "Failed")], "Paid").alias(
            "PaymentStatus"
        ),
        _cases(
            F.col("o_orderstatus"), [("O", "Active"), ("F", "Completed")], "Cancelled"
        ).alias("BookingStatus"),
        _null("timestamp_ntz").alias("CancelledAt"),
        _null("string").alias("CancellationReason"),
    )


def _ticket_parts(star: Star) -> DataFrame:
    """Tickets with the parts of their TicketID that are no columns of theirs."""
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    return star.lineitem.select(
        F.col("l_linenumber").alias("_line"),
        F.col("l_suppkey").alias("_supplier"),
        F.col("l_shipdate").cast("date").alias("_shipped"),
        F.col("l_orderkey").alias("BookingID"),
        F.col("l_partkey").alias("SeatID"),
        F.concat(F.lit("Passenger "), F.col("l_suppkey").cast("string")).alias("PassengerName"),
        _null("string").alias("PassengerIDNumber"),
        _null("string").alias("PassengerPhone"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("TicketPrice"),
        F.when(flag == "R", "Refunded")
        .when((flag == "A") & (line == "F"), "Used")
        .when((flag == "N") & (line == "F"), "Cancelled")
        .otherwise("Valid")
        .alias("TicketStatus"),
    )


def _ticket_id():
    shipped = F.date_format("_shipped", "yyyyMMdd")
    return F.concat_ws("-", "BookingID", "_line", "SeatID", "_supplier", shipped)


def _tickets(star: Star) -> DataFrame:
    rows = _ticket_parts(star)
    kept = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(_ticket_id().alias("TicketID"), *kept)


def _payments(star: Star, orders: DataFrame | None = None) -> DataFrame:
    o = F.col("o_orderkey")
    method = F.when(o % 6 == 0, "Cash").otherwise(
        _cases(
            F.col("o_orderpriority"),
            [("1-URGENT", "Momo"), ("2-HIGH", "ZaloPay"), ("3-MEDIUM", "VNPay")]
            + [("4-NOT SPECIFIED", "Visa")],
            "MasterCard",
        )
    )
    outcome = _cases(o % 10, [(7, "Pending"), (9, "Failed")], "Success")
    return (star.orders if orders is None else orders).select(
        o.alias("PaymentID"),
        o.alias("BookingID"),
        method.alias("PaymentMethod"),
        F.concat(F.lit("TX"), o.cast("string")).alias("TransactionID"),
        _amount().alias("Amount"),
        F.when(outcome != "Failed", _booked_at() + _hours(F.lit(1))).alias("PaymentDate"),
        outcome.alias("PaymentStatus"),
        _cases(o % 10, [(7, None), (9, "05")], "00").alias("ResponseCode"),
        _null("string").alias("ResponseMessage"),
    )


def _notifications(star: Star) -> DataFrame:
    e = F.col("event_id")
    return star.events.select(
        e.alias("NotificationID"),
        F.col("user_id").alias("UserID"),
        F.when(e % 3 == 0, e).alias("BookingID"),
        _cases(
            F.col("event_type"),
            [("view", "Promotion"), ("click", "Reminder"), ("purchase", "Payment")]
            + [("signup", "Delay")],
            "Cancellation",
        ).alias("NotificationType"),
        F.col("event_type").alias("Title"),
        F.col("props").alias("Message"),
        (F.col("value") >= 5).alias("IsRead"),
        F.col("ts").alias("SentAt"),
        _null("timestamp_ntz").alias("ScheduledFor"),
    )


# plans only, no data: building the same frames again would cost planning time
_TABLES: dict[tuple[str, str, str, str], Tables] = {}


def star_tables(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> Tables:
    """The thirteen tables over the star files in ``sf_dir``, seen at ``as_of``."""
    memo = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir, as_of)
    if memo not in _TABLES:
        _TABLES[memo] = _star_tables(spark, sf_dir, as_of)
    return _TABLES[memo]


def _star_tables(spark: SparkSession, sf_dir: str, as_of: str) -> Tables:
    written, sizes = _write_dimensions(spark, sf_dir)
    star = Star(spark, sf_dir, as_of, written, sizes)
    makers = {
        "Users": _users,
        "Trains": _trains,
        "Seats": _seats,
        "Schedules": _schedules,
        "Bookings": _bookings,
        "Tickets": _tickets,
        "Payments": _payments,
        "Notifications": _notifications,
    }
    frames = {**written, **{name: partial(make, star) for name, make in makers.items()}}
    frames["RefundPolicies"] = partial(policies, spark)
    ranged = {
        "Bookings": lambda start, end: _bookings(star, _ordered(star, start, end)),
        # paid an hour after the booking, which may be the next day
        "Payments": lambda start, end: _payments(star, _ordered(star, start, end, earlier=1)),
    }
    parts = {"Tickets": {"TicketID": (partial(_ticket_parts, star), _ticket_id())}}
    bounds = {**sizes, "RefundPolicies": len(POLICIES)}
    return Tables(frames, bounds=bounds, ranged=ranged, parts=parts)


def stream_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Bookings or payments arriving as a stream."""
    written, sizes = _write_dimensions(spark, sf_dir)
    star = Star(spark, sf_dir, AS_OF, written, sizes, streaming=True)
    return {"Bookings": _bookings, "Payments": _payments}[table](star)
