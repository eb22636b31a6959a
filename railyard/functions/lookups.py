"""Scalar look-ups of the model, done in bulk as joins."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import route_dims
from ..plans.tables import Tables
from .exprs import hours_crossed, instant, minutes_crossed


def ticket_price(base: Column, multiplier: Column) -> Column:
    return (base * multiplier).cast("decimal(10,2)")


def with_ticket_price(
    t: Tables, df: DataFrame, schedule="ScheduleID", seat_class="SeatClassID", out="Price"
) -> DataFrame:
    """Adds BasePrice x PriceMultiplier, or 0 when the schedule or the class is unknown."""
    base = t.hint(
        t["Schedules"].select(F.col("ScheduleID").alias(schedule), F.col("BasePrice").alias("_base")),
        "Schedules",
    )
    mult = t.hint(
        t["SeatClasses"].select(
            F.col("SeatClassID").alias(seat_class), F.col("PriceMultiplier").alias("_mult")
        ),
        "SeatClasses",
    )
    zero = F.lit(Decimal("0.00")).cast("decimal(10,2)")
    return (
        df.join(base, schedule, "left")
        .join(mult, seat_class, "left")
        .withColumn(out, F.coalesce(ticket_price(F.col("_base"), F.col("_mult")), zero))
        .drop("_base", "_mult")
    )


def price_list(t: Tables) -> DataFrame:
    """Price of every seat class on every schedule whose train carries that class."""
    carried = t["Coaches"].select("TrainID", "SeatClassID").distinct()
    pairs = t["Schedules"].select("ScheduleID", "TrainID").join(
        t.hint(carried, "Coaches"), "TrainID"
    )
    return with_ticket_price(t, pairs.drop("TrainID"))


def ticket_prices(t: Tables) -> DataFrame:
    """List price of every ticket's class on its schedule. The seats have their class before they
    meet the tickets, and the text of a TicketID is made after the last shuffle."""
    tickets, ticket_id = t.in_parts("Tickets", "TicketID")
    coaches = t.hint(t["Coaches"].select("CoachID", "SeatClassID"), "Coaches")
    seats = t["Seats"].select("SeatID", "CoachID").join(coaches, "CoachID").drop("CoachID")
    booked = t["Bookings"].select("BookingID", "ScheduleID")
    sold = tickets.join(booked, "BookingID").join(seats, "SeatID")
    return with_ticket_price(t, sold).select(
        ticket_id.alias("TicketID"), "ScheduleID", "SeatClassID", "Price"
    )


def refund_by_schedule(t: Tables, as_of) -> DataFrame:
    """Refund percentage per schedule: the policy with the greatest threshold that is
    not above the hours left, 0 without one.

    The answer depends on the departure only, so the range join runs over schedules and
    not over bookings. It is taken per distinct number of hours, of which there are few.
    """
    hours = t["Schedules"].select(
        "ScheduleID",
        hours_crossed(instant(as_of), F.col("DepartureTime")).alias("HoursLeft"),
    )
    per_hour = (
        hours.select("HoursLeft")
        .distinct()
        .join(t.small("RefundPolicies"), F.col("HoursBeforeDeparture") <= F.col("HoursLeft"))
        .groupBy("HoursLeft")
        .agg(F.max_by("RefundPercentage", "HoursBeforeDeparture").alias("pct"))
    )
    return hours.join(t.hint(per_hour, "Schedules"), "HoursLeft", "left").select(
        "ScheduleID",
        "HoursLeft",
        F.coalesce("pct", F.lit(0)).cast("decimal(5,2)").alias("RefundPercentage"),
    )


def with_refund_percentage(t: Tables, bookings: DataFrame, as_of) -> DataFrame:
    """Adds RefundPercentage to rows that carry a ScheduleID; 0 for an unknown schedule."""
    pct = t.hint(refund_by_schedule(t, as_of).drop("HoursLeft"), "Schedules")
    return bookings.join(pct, "ScheduleID", "left").withColumn(
        "RefundPercentage", F.coalesce("RefundPercentage", F.lit(0)).cast("decimal(5,2)")
    )


def refund_percentages(t: Tables, as_of) -> DataFrame:
    bookings = t["Bookings"].select("BookingID", "ScheduleID")
    return with_refund_percentage(t, bookings, as_of).drop("ScheduleID")


def travel_time(departure: Column, arrival: Column) -> Column:
    """Text such as ``8 giờ 0 phút``; both parts count unit boundaries."""
    return F.concat(
        hours_crossed(departure, arrival).cast("string"),
        F.lit(" giờ "),
        (minutes_crossed(departure, arrival) % F.lit(60)).cast("string"),
        F.lit(" phút"),
    )


def schedules_with_travel_time(t: Tables) -> DataFrame:
    return t["Schedules"].select(
        "ScheduleID",
        "DepartureTime",
        "ArrivalTime",
        travel_time(F.col("DepartureTime"), F.col("ArrivalTime")).alias("TravelTime"),
    )


def taken_seats(
    t: Tables, trips: DataFrame | None = None, seats: DataFrame | None = None
) -> DataFrame:
    """Distinct (SeatID, ScheduleID) held by a Valid ticket of an Active booking, of the
    given trips (distinct ScheduleID) and, if these are few, seats (distinct SeatID) only."""
    valid = t["Tickets"].filter(F.col("TicketStatus") == "Valid").select("BookingID", "SeatID")
    active = (
        t["Bookings"].filter(F.col("BookingStatus") == "Active").select("BookingID", "ScheduleID")
    )
    if seats is not None:
        valid = valid.join(seats, "SeatID", "left_semi")
    if trips is not None:
        active = active.join(t.hint(trips, "Schedules"), "ScheduleID", "left_semi")
    return valid.join(active, "BookingID").select("SeatID", "ScheduleID").distinct()


def with_seat_available(t: Tables, df: DataFrame) -> DataFrame:
    """Adds IsAvailable (1/0) to rows that carry SeatID and ScheduleID."""
    taken = taken_seats(t).withColumn("_taken", F.lit(True))
    return (
        df.join(taken, ["SeatID", "ScheduleID"], "left")
        .withColumn("IsAvailable", F.when(F.col("_taken"), 0).otherwise(1))
        .drop("_taken")
    )


def seats_asked_for(t: Tables) -> DataFrame:
    """Every (seat, schedule) pair that any ticket was ever issued for."""
    return (
        t["Tickets"]
        .select("BookingID", "SeatID")
        .join(t["Bookings"].select("BookingID", "ScheduleID"), "BookingID")
        .select("SeatID", "ScheduleID")
        .distinct()
    )


def route_names(t: Tables) -> DataFrame:
    """``departure → arrival`` per route, NULL when a station is missing."""
    named = route_dims(t).select(
        "RouteID", F.concat("DepartureStation", F.lit(" → "), "ArrivalStation").alias("RouteName")
    )
    return t["Routes"].select("RouteID").join(t.hint(named, "Routes"), "RouteID", "left")


def admins(t: Tables) -> DataFrame:
    """Ids of active administrators."""
    return (
        t["Users"]
        .filter((F.col("UserType") == "Admin") & F.col("IsActive"))
        .select(F.col("UserID").alias("admin_id"))
    )


def admin_flags(t: Tables) -> DataFrame:
    is_admin = (F.col("UserType") == "Admin") & F.col("IsActive")
    return t["Users"].select("UserID", F.coalesce(is_admin, F.lit(False)).alias("IsAdmin"))


def split_authorised(t: Tables, commands: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(commands that may run, refused ones). A NULL ``admin_id`` marks the plain form of
    a command, which needs no rights."""
    plain = commands.filter(F.col("admin_id").isNull())
    by_admin = commands.filter(F.col("admin_id").isNotNull())
    # the distinct callers come down to few rows before anything meets the commands, so the
    # commands, of which one caller may have given most, need no shuffle by caller
    known = admins(t).join(by_admin.select("admin_id").distinct(), "admin_id", "left_semi")
    # the plain commands may be most of the batch and all have the same, missing, key
    allowed = plain.unionByName(by_admin.join(known, "admin_id", "left_semi"))
    return allowed, by_admin.join(known, "admin_id", "left_anti")
