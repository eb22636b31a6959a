"""Dimension joins and per-booking pre-aggregates shared by the operators.

Dimensions are joined to each other before they meet a fact table, so a fact crosses
one join instead of five. A dimension chain has at most as many rows as its first
table (all its joins are many-to-one), which is the bound used for the hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables


def _station(t: Tables, role: str) -> DataFrame:
    return t.hint(
        t["Stations"].select(
            F.col("StationID").alias(f"{role}StationID"),
            F.col("StationName").alias(f"{role}Station"),
            F.col("StationCode").alias(f"{role}StationCode"),
        ),
        "Stations",
    )


def route_dims(t: Tables) -> DataFrame:
    """Routes with both station names (Stations plays two roles)."""
    return t.once("route_dims", _route_dims)


def _route_dims(t: Tables) -> DataFrame:
    return (
        t["Routes"]
        .join(_station(t, "Departure"), "DepartureStationID")
        .join(_station(t, "Arrival"), "ArrivalStationID")
    )


def trip_dims(t: Tables) -> DataFrame:
    """Schedules with train, route and stations; one row per complete schedule."""
    return t.once("trip_dims", _trip_dims)


def _trip_dims(t: Tables) -> DataFrame:
    trains = t["Trains"].select("TrainID", "TrainCode", "TrainName")
    routes = route_dims(t).select(
        "RouteID",
        "RouteCode",
        "Distance",
        "EstimatedDuration",
        "DepartureStationID",
        "DepartureStation",
        "DepartureStationCode",
        "ArrivalStationID",
        "ArrivalStation",
        "ArrivalStationCode",
    )
    schedules = t["Schedules"].drop("CreatedAt")
    # whichever side is known to be small is broadcast; the schedules usually are
    return (
        t.hint(schedules, "Schedules")
        .join(t.hint(trains, "Trains"), "TrainID")
        .join(t.hint(routes, "Routes"), "RouteID")
    )


def trips_for(t: Tables, *columns: str) -> DataFrame:
    """Trip dimensions cut to the given columns, ready to join on ScheduleID."""
    return t.hint(trip_dims(t).select("ScheduleID", *columns), "Schedules")


def class_of_coach(t: Tables, *columns: str) -> DataFrame:
    coaches = t["Coaches"].join(t.small("SeatClasses"), "SeatClassID")
    return t.hint(coaches.select("CoachID", *columns), "Coaches")


def seat_dims(t: Tables) -> DataFrame:
    """Seats with coach and class. As large as Seats, so it is never broadcast by hint."""
    dims = class_of_coach(t, "TrainID", "CoachNumber", "SeatClassID", "ClassName")
    return t["Seats"].join(dims, "CoachID")


def tickets_per_booking(t: Tables, bookings: DataFrame | None = None) -> DataFrame:
    """One row per booking that has tickets, of the given bookings if these are few. Counted
    map-side first, so a booking with very many tickets costs one small row per task, and
    later joins are one-to-one."""
    tickets = t["Tickets"].select("BookingID").filter(F.col("BookingID").isNotNull())
    if bookings is not None:
        tickets = tickets.join(bookings.select("BookingID"), "BookingID", "left_semi")
    return (
        tickets.groupBy("BookingID")
        .agg(F.count(F.lit(1)).alias("tickets"))
    )


def booking_facts(
    t: Tables, bookings: DataFrame, fanout: str = "rows", few: bool = False
) -> DataFrame:
    """Bookings with their ticket number and the weight their amount gets in sums.

    ``fanout="rows"``: the amount counts once per ticket (once if there is none), as a
    join of bookings and tickets followed by SUM does. ``fanout="once"``: it counts once.
    Because BookingID is unique, weighting replaces that join and its distinct counts.
    ``few`` says that the bookings are a small part of all: tickets of others are then left
    out before they are counted.
    """
    if fanout not in ("rows", "once"):
        raise ValueError(f"fanout must be 'rows' or 'once', not {fanout!r}")
    facts = bookings.join(tickets_per_booking(t, bookings if few else None), "BookingID", "left").withColumn(
        "tickets", F.coalesce("tickets", F.lit(0).cast("bigint"))
    )
    one = F.lit(1).cast("bigint")
    weight = F.greatest("tickets", one) if fanout == "rows" else one
    return facts.withColumn("weight", weight)
