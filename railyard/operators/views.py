"""The six views. They have no order; listings that sort are in ``operators.listings``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import instant
from ..plans.joins import class_of_coach, tickets_per_booking, trips_for
from ..plans.tables import Tables

STATIONS = ("DepartureStation", "ArrivalStation")
TIMES = ("DepartureTime", "ArrivalTime")


def users_for(t: Tables, *columns) -> DataFrame:
    return t.hint(t["Users"].select("UserID", *columns), "Users")


def with_ticket_number(t: Tables, bookings: DataFrame) -> DataFrame:
    """Adds NumberOfTickets, 0 for a booking without tickets."""
    return bookings.join(tickets_per_booking(t), "BookingID", "left").withColumn(
        "NumberOfTickets", F.coalesce("tickets", F.lit(0).cast("bigint"))
    )


def available_schedules(t: Tables, as_of) -> DataFrame:
    """Scheduled trips that leave after ``as_of``, sold out or not."""
    trips = trips_for(
        t,
        *TIMES,
        "TrainCode",
        "TrainName",
        *STATIONS,
        "Distance",
        "EstimatedDuration",
        "BasePrice",
        "AvailableSeats",
        "Status",
    )
    return trips.filter((F.col("Status") == "Scheduled") & (F.col("DepartureTime") > instant(as_of)))


def customer_bookings(t: Tables, bookings: DataFrame | None = None) -> DataFrame:
    """Bookings with customer, trip and ticket number; ``bookings`` may be pre-filtered."""
    bookings = t["Bookings"] if bookings is None else bookings
    users = users_for(t, F.col("FullName").alias("CustomerName"), "Email", "PhoneNumber")
    return (
        with_ticket_number(t, bookings)
        .join(trips_for(t, *TIMES, "TrainCode", *STATIONS), "ScheduleID")
        .join(users, "UserID")
        .select(
            "BookingID",
            "BookingCode",
            "BookingDate",
            "CustomerName",
            "Email",
            "PhoneNumber",
            *TIMES,
            "TrainCode",
            *STATIONS,
            "TotalAmount",
            "PaymentStatus",
            "BookingStatus",
            "NumberOfTickets",
        )
    )


def ticket_rows(
    t: Tables, bookings: DataFrame, *trip_columns: str, few: bool = False, order: tuple = ()
) -> DataFrame:
    """Tickets with their booking, trip, seat, coach and class (all inner joins).

    Tickets meet the seats first, of which they take but numbers, then the bookings with their
    codes; what small tables tell comes last, so no shuffle carries it, nor do these joins carry
    the text of a TicketID. ``few`` says that the bookings are a small part of all: tickets of
    others are then left out first. Each of the two large joins has a unique key on one side, so
    AQE can split a hot booking or seat. Rows that are to be sorted are dealt in that ``order`` of
    DepartureTime and ticket columns before the small tables are joined, where these are known to
    be small.
    """
    booked = bookings.select("BookingID", "BookingCode", "ScheduleID")
    seats = t["Seats"].select("SeatID", "CoachID", "SeatNumber", "SeatType")
    tickets, ticket_id = t.in_parts("Tickets", "TicketID")
    if few:
        rows = tickets.join(booked, "BookingID").join(seats, "SeatID")
    else:
        rows = tickets.join(seats, "SeatID").join(booked, "BookingID")
    rows = rows.withColumn("TicketID", ticket_id)
    coaches = class_of_coach(t, "CoachNumber", F.col("ClassName").alias("SeatClass"))
    if order and all(t.bounds.get(n, t.broadcast_rows + 1) <= t.broadcast_rows for n in ("Schedules", "Coaches")):
        leaves = t.hint(t["Schedules"].select("ScheduleID", "DepartureTime"), "Schedules")
        rows = rows.join(leaves, "ScheduleID").repartitionByRange(*order)
        trip_columns = tuple(c for c in trip_columns if c != "DepartureTime")
    return rows.join(trips_for(t, *trip_columns), "ScheduleID").join(coaches, "CoachID")


def ticket_details(t: Tables) -> DataFrame:
    return ticket_rows(t, t["Bookings"], "TrainCode", *STATIONS, *TIMES).select(
        "TicketID",
        "BookingCode",
        "PassengerName",
        "PassengerIDNumber",
        "PassengerPhone",
        "TrainCode",
        *STATIONS,
        *TIMES,
        "CoachNumber",
        "SeatNumber",
        "SeatClass",
        "TicketPrice",
        "TicketStatus",
    )


# rows one task makes out of one input row before it starts the next array
_CHUNK = 10_000


def _repeat(df: DataFrame, copies: str) -> DataFrame:
    """Every row ``copies`` times. Two nested generators keep each array short."""
    chunks = F.floor((F.col(copies) - 1) / F.lit(_CHUNK)).cast("int")
    left = F.least(F.lit(_CHUNK), F.col(copies) - F.col("_chunk") * F.lit(_CHUNK)).cast("int")
    return (
        df.filter(F.col(copies) > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks)))
        .withColumn("_row", F.explode(F.sequence(F.lit(1), left)))
        .drop("_chunk", "_row", copies)
    )


def seat_counts(t: Tables, schedule_seats: DataFrame, few: bool = False) -> DataFrame:
    """For (ScheduleID, SeatID, ...) rows: a row per state, ``Booked`` or not, with the
    number of tickets in it as ``copies``, which may be 0.

    A seat yields one row per ticket it ever had, on whatever schedule; the row is booked
    when that ticket's booking is an Active one of this schedule. A seat without tickets
    yields one free row. Tickets are counted per seat, and per seat and schedule, before
    they meet the seats, so no ticket is ever paired with the schedules one by one. ``few``
    says that the seats are a small part of all: other tickets are then left out first.
    """
    tickets = t["Tickets"].select("BookingID", "SeatID")
    if few:
        tickets = tickets.join(schedule_seats.select("SeatID").distinct(), "SeatID", "left_semi")
    per_seat = tickets.groupBy("SeatID").agg(F.count(F.lit(1)).alias("all_tickets"))
    active = t["Bookings"].filter(F.col("BookingStatus") == "Active")
    per_trip = (
        tickets.join(active.select("BookingID", "ScheduleID"), "BookingID")
        .groupBy("SeatID", "ScheduleID")
        .agg(F.count(F.lit(1)).alias("booked"))
    )
    booked = F.coalesce("booked", F.lit(0).cast("bigint"))
    every = F.greatest(F.coalesce("all_tickets", F.lit(1)), F.lit(1)).cast("bigint")
    states = F.array(
        F.struct(F.lit(True).alias("Booked"), booked.alias("copies")),
        F.struct(F.lit(False).alias("Booked"), (every - booked).alias("copies")),
    )
    return (
        schedule_seats.join(per_seat, "SeatID", "left")
        .join(per_trip, ["SeatID", "ScheduleID"], "left")
        .select(*schedule_seats.columns, F.inline(states))
    )


def seat_rows(t: Tables, schedule_seats: DataFrame, few: bool = False) -> DataFrame:
    """`seat_counts` with each row repeated, one row per ticket."""
    return _repeat(seat_counts(t, schedule_seats, few), "copies")


def seat_status_counts(t: Tables) -> DataFrame:
    """Tickets per seat and state of every Scheduled trip: what `seat_availability` repeats."""
    return (
        seat_counts(t, _places_of_trips(t))
        .filter("copies > 0")
        .select(
            "ScheduleID",
            "SeatID",
            F.when(F.col("Booked"), "Booked").otherwise("Available").alias("SeatStatus"),
            F.col("copies").alias("Tickets"),
        )
    )


def _places_of_trips(t: Tables) -> DataFrame:
    trips = (
        t["Schedules"]
        .filter(F.col("Status") == "Scheduled")
        .select("ScheduleID", "TrainID")
        .join(t.hint(t["Trains"].select("TrainID", "TrainCode"), "Trains"), "TrainID")
    )
    coaches = class_of_coach(t, "TrainID", "CoachNumber", "ClassName")
    places = t.hint(trips, "Schedules").join(coaches, "TrainID").drop("TrainID")
    places = t.hint(places, "Schedules", "Coaches")
    return t["Seats"].join(places, "CoachID")


def seat_availability(t: Tables) -> DataFrame:
    """Seat map of every Scheduled trip, a row per ticket that a seat ever had."""
    return seat_rows(t, _places_of_trips(t)).select(
        "ScheduleID",
        "TrainCode",
        "CoachNumber",
        "ClassName",
        "SeatID",
        "SeatNumber",
        "SeatType",
        F.when(F.col("Booked"), "Booked").otherwise("Available").alias("SeatStatus"),
    )


def payment_history(t: Tables) -> DataFrame:
    users = users_for(t, F.col("FullName").alias("CustomerName"))
    bookings = (
        t["Bookings"]
        .select("BookingID", "BookingCode", "UserID", "ScheduleID")
        .join(trips_for(t, "TrainCode", *STATIONS), "ScheduleID")
        .join(users, "UserID")
    )
    return (
        t["Payments"]
        .join(bookings, "BookingID")
        .select(
            "PaymentID",
            "TransactionID",
            "BookingCode",
            "CustomerName",
            "PaymentMethod",
            "Amount",
            "PaymentDate",
            "PaymentStatus",
            "TrainCode",
            *STATIONS,
        )
    )


def with_booking_code(t: Tables, notes: DataFrame) -> DataFrame:
    """Adds BookingCode. Notifications without a booking, of which there may be very many,
    do not take part in the join, where they would all meet in one partition."""
    codes = t["Bookings"].select("BookingID", "BookingCode")
    about = notes.filter(F.col("BookingID").isNotNull()).join(codes, "BookingID", "left")
    general = notes.filter(F.col("BookingID").isNull())
    return about.unionByName(general.withColumn("BookingCode", F.lit(None).cast("string")))


def unread_notifications(t: Tables) -> DataFrame:
    unread = t["Notifications"].filter(~F.col("IsRead"))
    return (
        with_booking_code(t, unread)
        .join(users_for(t, "FullName", "Email"), "UserID")
        .select(
            "NotificationID",
            "UserID",
            "FullName",
            "Email",
            "NotificationType",
            "Title",
            "Message",
            "SentAt",
            "BookingCode",
        )
    )
