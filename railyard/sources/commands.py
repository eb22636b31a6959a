"""Command batches over the star files: every row of a file becomes a command.

They give the batch jobs whole-table inputs with conflicts: two or more commands for one
booking, schedule or user, unknown keys, and commands without the right to run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import padded
from ..plans.tables import Tables
from ..schemas import TABLES
from .star import read_star, schedule_of


def _nobody():
    return F.lit(None).cast("bigint")


def booking_requests(spark: SparkSession, sf_dir: str, read=read_star) -> DataFrame:
    """Every order asks for two of the first forty seats on the trip it was made for, so
    a trip sees many requests for few seats. Some ask for one seat twice."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = F.array(o % 40, F.floor(c / 10) % 40).cast("array<string>")
    return read(spark, sf_dir, "orders").select(
        o.alias("request_id"),
        c.alias("user_id"),
        schedule_of(F.col("o_orderdate"), c).alias("schedule_id"),
        F.array_join(pair, ",").alias("seat_ids"),
        F.lit("An,Binh").alias("passenger_names"),
        F.lit("VNPay").alias("payment_method"),
    )


def mixed_booking_requests(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for one to three seats of the trip's own train, many of them faulty: lists of
    different length, unknown users, trips, seats and methods, seats that are no number, seats
    of another train and none at all."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    coaches = t["Coaches"].select("CoachID", "TrainID")
    # a train's seats are as many as it has places, whatever the number of requests
    own = t["Seats"].join(coaches, "CoachID").groupBy("TrainID").agg(
        F.array_sort(F.collect_list("SeatID")).alias("own")
    )
    trips = t["Schedules"].select("ScheduleID", "TrainID").join(own, "TrainID").drop("TrainID")
    asked = read_star(spark, sf_dir, "orders").withColumn("ScheduleID", schedule_of(F.col("o_orderdate"), c))

    def seat(place):
        # no number on a train without seats
        found = F.get("own", (place % F.size("own")).cast("int")).cast("string")
        return F.coalesce(found, F.lit("-"))

    first = F.when(o % 19 == 6, o + 10**9).when(o % 3 == 0, o % 40).cast("string")
    second = F.when(o % 17 == 4, "x7").otherwise(seat(F.floor(c / 10)))
    third = F.when(o % 5 == 1, seat(o + c))
    # without array_compact, which would copy a train's whole seat list for every request: a
    # joined text leaves nulls out
    seats = F.array(F.coalesce(first, seat(o)), second, third)
    names = F.when(o % 11 == 3, "An").when(o % 5 == 1, "An, Binh , Chi").otherwise("An,Binh")
    nothing = o % 29 == 7
    return asked.join(trips, "ScheduleID", "left").select(
        o.alias("request_id"),
        F.when(o % 13 == 5, -c).when(o % 37 != 1, c).alias("user_id"),
        F.when(o % 31 != 9, F.col("ScheduleID")).alias("schedule_id"),
        F.when(~nothing, F.array_join(seats, ", ")).alias("seat_ids"),
        F.when(~nothing, names).alias("passenger_names"),
        F.when(o % 7 == 2, "Cheque").when(o % 23 == 8, None).otherwise("VNPay").alias("payment_method"),
    )


def seat_claims(spark: SparkSession, sf_dir: str, read=read_star) -> DataFrame:
    """Every order claims one of the first forty seats on its trip."""
    o, at = F.col("o_orderkey"), F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        schedule_of(at, F.col("o_custkey")).alias("ScheduleID"),
        (o % 40).alias("SeatID"),
        o.alias("BookingID"),
        at.cast("timestamp_ntz").alias("ClaimedAt"),
    )


def _with_events(spark: SparkSession, sf_dir: str, first: DataFrame, event_columns) -> DataFrame:
    early = F.when(F.col("value") < 50, 0).otherwise(2)
    events = read_star(spark, sf_dir, "events").select(
        (F.col("event_id") * 4 + early).alias("request_id"),
        F.col("event_id").alias("booking_id"),
        *event_columns,
    )
    return first.unionByName(events)


def cancel_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One command per order, one per event (before or after it, by an administrator or
    not), and one per customer for a booking that does not exist."""
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    orders = read_star(spark, sf_dir, "orders").select(
        (o * 4 + 1).alias("request_id"),
        o.alias("booking_id"),
        F.lit("plan changed").alias("reason"),
        _nobody().alias("admin_id"),
    )
    unknown = read_star(spark, sf_dir, "customer").select(
        (-c - 1).alias("request_id"),
        (-c - 1).alias("booking_id"),
        F.lit("mistake").alias("reason"),
        _nobody().alias("admin_id"),
    )
    by_event = [F.col("event_type").alias("reason"), F.col("user_id").alias("admin_id")]
    return _with_events(spark, sf_dir, orders.unionByName(unknown), by_event)


def cancel_schedule_commands(t: Tables) -> DataFrame:
    """Two commands per schedule; reasons may be NULL, some callers are no administrators."""
    s = F.col("ScheduleID")
    ids = t["Schedules"].select("ScheduleID")
    track = F.when(s % 3 != 0, F.concat(F.lit("track work "), s.cast("string")))
    caller = F.when(s % 2 == 0, _nobody()).when(s % 3 == 0, 100).otherwise(101)
    first = ids.select(
        (s * 2).alias("request_id"),
        s.alias("schedule_id"),
        track.alias("reason"),
        caller.cast("bigint").alias("admin_id"),
    )
    second = ids.select(
        (s * 2 + 1).alias("request_id"),
        s.alias("schedule_id"),
        F.lit("storm").alias("reason"),
        _nobody().alias("admin_id"),
    )
    return first.unionByName(second)


def payment_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("c_custkey")
    orders = read_star(spark, sf_dir, "orders").select(
        (o * 4 + 1).alias("request_id"),
        o.alias("booking_id"),
        F.concat(F.lit("A"), o.cast("string")).alias("transaction_id"),
        F.when(o % 5 == 0, "05").otherwise("00").alias("response_code"),
    )
    unknown = read_star(spark, sf_dir, "customer").select(
        (-c - 1).alias("request_id"),
        (-c - 1).alias("booking_id"),
        F.concat(F.lit("U"), c.cast("string")).alias("transaction_id"),
        F.lit("00").alias("response_code"),
    )
    by_event = [
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.when(F.col("event_type") == "error", "12").otherwise("00").alias("response_code"),
    ]
    return _with_events(spark, sf_dir, orders.unionByName(unknown), by_event)


def new_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups from suppliers and customers: taken addresses, shared phone numbers, short
    passwords, callers without rights."""
    s, c = F.col("s_suppkey"), F.col("c_custkey")
    suppliers = read_star(spark, sf_dir, "supplier").select(
        (s * 2).alias("request_id"),
        F.when(s % 3 == 0, 100).when(s % 3 == 1, 101).cast("bigint").alias("admin_id"),
        F.col("s_name").alias("FullName"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("Email"),
        F.concat(F.lit("08"), padded(s, 8)).alias("PhoneNumber"),
        F.concat(F.lit("secret"), s.cast("string")).alias("password"),
        F.lit("Staff").alias("UserType"),
    )
    fresh = F.concat(F.lit("new."), F.lower("c_name"), F.lit("@example.com"))
    known = F.concat(F.lower("c_name"), F.lit("@example.com"))
    customers = read_star(spark, sf_dir, "customer").select(
        (c * 2 + 1).alias("request_id"),
        _nobody().alias("admin_id"),
        F.col("c_name").alias("FullName"),
        F.when(c % 4 == 0, known).otherwise(fresh).alias("Email"),
        F.concat(F.lit("07"), padded(F.floor(c / 2), 8)).alias("PhoneNumber"),
        F.concat(F.lit("password"), c.cast("string")).alias("password"),
        F.lit("Customer").alias("UserType"),
    )
    return suppliers.unionByName(customers)


def new_schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One new trip per supplier; some routes do not exist, some arrive too early."""
    s = F.col("s_suppkey")
    start = F.lit("2002-01-01").cast("timestamp_ntz")
    leaves = start + F.make_dt_interval((s % 365).cast("int"))
    takes = F.when(s % 7 == 0, -1).otherwise(5)
    return read_star(spark, sf_dir, "supplier").select(
        s.alias("request_id"),
        s.alias("TrainID"),
        (s % 60).alias("RouteID"),
        leaves.alias("DepartureTime"),
        (leaves + F.make_dt_interval(F.lit(0), takes)).alias("ArrivalTime"),
        F.lit("450000.00").cast("decimal(10,2)").alias("BasePrice"),
    )


def user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return read_star(spark, sf_dir, "events").select(
        e.alias("request_id"),
        F.col("user_id").alias("UserID"),
        F.concat(F.lit("Name "), e.cast("string")).alias("FullName"),
        F.when(e % 2 == 0, F.concat(F.lit("u"), e.cast("string"), F.lit("@example.org"))).alias(
            "Email"
        ),
        F.concat(F.lit("06"), padded(e, 8)).alias("PhoneNumber"),
    )


def schedule_changes(t: Tables) -> DataFrame:
    """Every booking moves the price and status of its schedule; the last one counts."""
    b = F.col("BookingID")
    at = F.col("BookingDate")
    return t["Bookings"].select(
        b.alias("request_id"),
        F.col("ScheduleID"),
        at.alias("DepartureTime"),
        (at + F.make_dt_interval(F.lit(0), F.lit(9))).alias("ArrivalTime"),
        F.col("TotalAmount").alias("BasePrice"),
        F.lit("Delayed").alias("Status"),
    )


def delete_commands(t: Tables, table: str) -> DataFrame:
    """A delete for every row of a table, by an administrator, someone else or nobody."""
    key = t[table].columns[0]
    k = F.col(key)
    caller = F.when(k % 3 == 0, _nobody()).when(k % 3 == 1, 100).otherwise(101)
    return t[table].select(
        k.alias("request_id"), k.alias("id"), caller.cast("bigint").alias("admin_id")
    )


def new_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stations per nation: known codes, codes asked for twice, missing and long names."""
    n, name = F.col("n_nationkey").cast("bigint"), F.col("n_name")
    fresh = F.concat(F.lit("S"), n.cast("string"))
    nations = read_star(spark, sf_dir, "nation")
    first = nations.select(
        (n * 2).alias("request_id"),
        F.when(n % 4 == 0, F.concat(F.lit("N"), n.cast("string"))).otherwise(fresh).alias("StationCode"),
        F.concat(F.lit("New "), name).alias("StationName"),
        F.when(n % 5 != 0, name).alias("City"),
        F.lit("West").alias("Province"),
    )
    second = nations.select(
        (n * 2 + 1).alias("request_id"),
        fresh.alias("StationCode"),
        F.when(n % 3 == 0, F.repeat(F.lit("x"), F.lit(101))).otherwise(name).alias("StationName"),
        name.alias("City"),
        F.lit("East").alias("Province"),
    )
    return first.unionByName(second)


def new_trains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A train per supplier: known codes, codes asked for twice, no number of coaches."""
    s = F.col("s_suppkey")
    return read_star(spark, sf_dir, "supplier").select(
        s.alias("request_id"),
        F.when(s % 5 == 0, F.concat(F.lit("T"), s.cast("string")))
        .otherwise(F.concat(F.lit("X"), F.floor(s / 2).cast("string")))
        .alias("TrainCode"),
        F.col("s_name").alias("TrainName"),
        F.lit("SE").alias("TrainType"),
        F.when(s % 7 != 0, 8).alias("TotalCoaches"),
    )


def new_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A route per nation: some lead nowhere or to a station that does not exist."""
    n = F.col("n_nationkey").cast("bigint")
    return read_star(spark, sf_dir, "nation").select(
        n.alias("request_id"),
        F.concat(F.lit("R"), n.cast("string")).alias("RouteCode"),
        n.alias("DepartureStationID"),
        F.when(n % 5 == 0, n).when(n % 5 == 1, n + 100).otherwise((n + 1) % 25).alias("ArrivalStationID"),
        F.lit("100.00").cast("decimal(8,2)").alias("Distance"),
        F.lit(60).alias("EstimatedDuration"),
    )


def user_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits by event that break a rule each: no name, a long one, an address that several
    ask for, the number of another user."""
    e = F.col("event_id")
    kind, text = e % 11, e.cast("string")
    return read_star(spark, sf_dir, "events").select(
        e.alias("request_id"),
        F.col("user_id").alias("UserID"),
        F.when(kind == 0, None).when(kind == 1, F.repeat(F.lit("x"), F.lit(101)))
        .otherwise(F.concat(F.lit("Name "), text)).alias("FullName"),
        F.when(kind == 3, F.concat(F.lit("shared"), F.floor(e / 50).cast("string"), F.lit("@example.org")))
        .otherwise(F.concat(F.lit("u"), text, F.lit("@example.org"))).alias("Email"),
        F.when(kind == 4, F.concat(F.lit("09"), padded(F.lit(1), 8)))
        .otherwise(F.concat(F.lit("06"), padded(e, 8))).alias("PhoneNumber"),
    )


def code_moves(t: Tables, table: str) -> DataFrame:
    """Codes that move on: of three rows the first takes a new code, the second that of the
    first, the third that of the second; the first also asks for the second's while that is
    held. Of seven rows one asks for no code, so that its own stays taken."""
    key, code = TABLES[table].key, TABLES[table].unique[0][0]
    k, c = F.col(key), F.col(code)
    rows = t[table].select(key, code)
    before = rows.select((k + 1).alias(key), c.alias("before"))
    after = rows.select((k - 1).alias(key), c.alias("after"))
    near = rows.join(before, key, "left").join(after, key, "left")
    moved = F.when(k % 3 == 0, F.concat(c, F.lit("x"))).otherwise(F.coalesce("before", F.concat(c, F.lit("y"))))
    first = near.select((k * 2).alias("request_id"), key, F.when(k % 7 != 0, moved).alias(code))
    second = near.filter(k % 3 == 0).select(
        (k * 2 + 1).alias("request_id"), key, F.coalesce("after", F.concat(c, F.lit("z"))).alias(code)
    )
    return first.unionByName(second)


def schedule_edits(t: Tables) -> DataFrame:
    """Edits by booking: arrivals before departures, no price, odd states, unknown routes."""
    b, at = F.col("BookingID"), F.col("BookingDate")
    kind = b % 7
    return t["Bookings"].select(
        b.alias("request_id"),
        F.col("ScheduleID"),
        F.when(kind == 3, F.lit(999)).otherwise(b % 50).cast("bigint").alias("RouteID"),
        at.alias("DepartureTime"),
        (at + F.make_dt_interval(F.lit(0), F.when(kind == 0, -1).otherwise(9))).alias("ArrivalTime"),
        F.when(kind != 1, F.col("TotalAmount")).alias("BasePrice"),
        F.when(kind == 2, "Lost").otherwise("Delayed").alias("Status"),
    )
