"""Periodic and structural jobs: reminders, status roll, guarded deletion, seat making."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import messages as msg
from ..functions.exprs import hours_crossed, instant, keep_ids, padded
from ..plans.tables import Tables
from .notices import notices


def departure_reminders(t: Tables, as_of) -> DataFrame:
    """Reminders for Active, Paid bookings that leave in 2 to 24 hours and have none yet.

    The trips that qualify are few and known from the schedule alone, so they are found
    first and the bookings are reduced to them before anything is shuffled.
    """
    soon = (
        t["Schedules"]
        .filter(hours_crossed(instant(as_of), F.col("DepartureTime")).between(2, 24))
        .join(t.hint(t["Trains"].select("TrainID", "TrainCode"), "Trains"), "TrainID")
        .select("ScheduleID", "TrainCode", "DepartureTime")
    )
    reminded = (
        t["Notifications"]
        .filter((F.col("NotificationType") == "Reminder") & F.col("BookingID").isNotNull())
        .select("BookingID")
        .distinct()
    )
    due = (
        t["Bookings"]
        .filter((F.col("BookingStatus") == "Active") & (F.col("PaymentStatus") == "Paid"))
        .select("BookingID", "UserID", "ScheduleID")
        .join(t.hint(soon, "Schedules"), "ScheduleID")
        .join(reminded, "BookingID", "left_anti")
    )
    return reminder_notices(due, F.col("TrainCode"), F.col("DepartureTime"), instant(as_of))


def reminder_notices(due: DataFrame, train: Column, leaves: Column, told: Column) -> DataFrame:
    """The notifications for rows with UserID and BookingID, sent at ``told``."""
    before, between, after = (F.lit(x) for x in msg.REMINDER_TEXT)
    return notices(
        due,
        "Reminder",
        F.lit(msg.REMINDER_TITLE),
        F.concat(before, train, between, F.date_format(leaves, "HH:mm dd/MM/yyyy"), after),
        told,
        scheduled_for=leaves - F.make_dt_interval(F.lit(0), F.lit(2)),
    )


def roll_statuses(t: Tables, as_of) -> dict[str, DataFrame]:
    """Arrived Scheduled trips become Completed, then Active bookings of any Completed
    trip, then Valid tickets of any Completed booking become Used. Changed rows only."""
    arrived = (F.col("Status") == "Scheduled") & (F.col("ArrivalTime") < instant(as_of))
    schedules = t["Schedules"].filter(arrived).withColumn("Status", F.lit("Completed"))
    over = t["Schedules"].filter((F.col("Status") == "Completed") | arrived).select("ScheduleID")
    ending = F.col("BookingStatus") == "Active"
    bookings = (
        t["Bookings"]
        .filter(ending)
        .join(t.hint(over, "Schedules"), "ScheduleID", "left_semi")
        .withColumn("BookingStatus", F.lit("Completed"))
        .select(*t["Bookings"].columns)
    )
    completed = t["Bookings"].filter(F.col("BookingStatus") == "Completed").select("BookingID")
    tickets = (
        t["Tickets"]
        .filter(F.col("TicketStatus") == "Valid")
        .join(completed.unionByName(bookings.select("BookingID")), "BookingID", "left_semi")
        .withColumn("TicketStatus", F.lit("Used"))
        .select(*t["Tickets"].columns)
    )
    return {"schedules": schedules, "bookings": bookings, "tickets": tickets}


def roll_counts(changed: dict[str, DataFrame]) -> DataFrame:
    """Number of changed rows per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("Rows")).select(F.lit(name).alias("TableName"), "Rows")
        for name, df in changed.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def delete_schedules(t: Tables, ids) -> dict[str, DataFrame]:
    """Deletes a batch of schedules, or none of them if any has an Active booking.

    ``ids`` is a list or a DataFrame with the ids in its first column. Returns the
    remaining table, the deleted and the refused ids.
    """
    batch = keep_ids(t["Schedules"].select("ScheduleID"), "ScheduleID", ids)
    active = t["Bookings"].filter(F.col("BookingStatus") == "Active")
    active = active.select("ScheduleID").distinct()
    blocked = not batch.join(active, "ScheduleID", "left_semi").isEmpty()
    gone = batch.filter(F.lit(not blocked))
    return {
        "schedules": t["Schedules"].join(gone, "ScheduleID", "left_anti"),
        "deleted": gone,
        "rejects": batch.filter(F.lit(blocked)).withColumn(
            "reason", F.lit(msg.SCHEDULE_HAS_BOOKINGS)
        ),
    }


def generate_seats(coaches: DataFrame) -> DataFrame:
    """One row per seat of each coach, numbered from 01; seat ids are given on storing.
    Coaches with more than 50 seats have single seats, others three-tier berths."""
    n = F.col("n")
    berth = F.when(n % 3 == 1, "Lower").when(n % 3 == 2, "Middle").otherwise("Upper")
    kind = F.when(F.col("TotalSeats") > 50, "Single").otherwise(berth)
    return (
        coaches.filter(F.col("TotalSeats") > 0)
        .select("CoachID", "TotalSeats", F.explode(F.sequence(F.lit(1), "TotalSeats")).alias("n"))
        .select("CoachID", padded(n, 2).alias("SeatNumber"), kind.alias("SeatType"))
    )
