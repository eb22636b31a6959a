"""Batch jobs on bookings: create, cancel, cancel by schedule, late check.

Every job is ``(tables, commands, as_of) -> named DataFrames``: changed rows, new rows,
notifications and rejects. Inputs are never modified; ``plans.tables.merge_rows`` gives
the new table and ``sources.store`` writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import messages as msg
from ..functions.exprs import hours_crossed, instant, padded
from ..functions.ids import next_id, number_rows
from ..functions.lookups import refund_by_schedule, split_authorised, taken_seats, ticket_price
from ..plans.checkpoints import cut
from ..plans.joins import class_of_coach
from ..plans.tables import Tables
from ..schemas import PAYMENT_METHODS
from .claims import distinct_claims, first_come
from .notices import first_failure, notices, reject

HOURS_BEFORE_DEPARTURE = 2


def split_late(t: Tables, rows: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(in time, late) bookings: late ones leave in less than two hours. A booking of an
    unknown schedule is not late."""
    left = hours_crossed(instant(as_of), F.col("_departure"))
    departures = t.hint(
        t["Schedules"].select("ScheduleID", F.col("DepartureTime").alias("_departure")),
        "Schedules",
    )
    late = F.coalesce(left < F.lit(HOURS_BEFORE_DEPARTURE), F.lit(False))
    checked = rows.join(departures, "ScheduleID", "left").withColumn("_late", late)
    keep = checked.drop("_departure", "_late").columns
    return checked.filter(~F.col("_late")).select(*keep), checked.filter("_late").select(*keep)


# all that a cast to bigint takes, and too large numbers
WHOLE_NUMBER = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"


def _asked(requests: DataFrame) -> DataFrame:
    return requests.select(
        "request_id",
        F.col("user_id").cast("bigint").alias("UserID"),
        F.col("schedule_id").cast("bigint").alias("ScheduleID"),
        "seat_ids",
        "passenger_names",
        F.col("payment_method").alias("PaymentMethod"),
    )


def _with_lists(asked: DataFrame) -> DataFrame:
    """Seat and name lists as arrays, paired by position. Names are trimmed where they are used.

    A failing try_cast throws and catches an exception, so only what looks like a number meets it.
    """
    no_text = F.array().cast("array<string>")

    def number(text):
        return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("bigint"))

    seats = F.transform(F.coalesce(F.split("seat_ids", ","), no_text), number)
    names = F.coalesce(F.split("passenger_names", ","), no_text)
    return asked.select("*", seats.alias("seats"), names.alias("names")).drop("seat_ids", "passenger_names")


def first_new_ids(t: Tables) -> dict[str, int]:
    return {
        "bookings": next_id(t["Bookings"], "BookingID"),
        "tickets": next_id(t["Tickets"], "TicketID"),
        "payments": next_id(t["Payments"], "PaymentID"),
    }


def create_bookings(
    t: Tables,
    requests: DataFrame,
    as_of,
    *,
    first_code: int = 1,
    check_train: bool = False,
    refuse_late: bool = False,
    held: DataFrame | None = None,
    first_ids: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Books requests (request_id, user_id, schedule_id, seat_ids, passenger_names,
    payment_method) in the order of ``request_id``.

    A request is refused when its schedule is not Scheduled, its lists differ in length, a
    seat is held already or is asked for twice, or a user, seat or payment method is
    unknown. ``check_train`` also refuses seats of another train, ``refuse_late`` trips
    that leave within two hours. A caller that knows them can give the held seats
    (SeatID, ScheduleID) and the first new ids, which otherwise come from the tables.
    """
    asked = _asked(requests)
    open_trips = t.hint(
        t["Schedules"]
        .filter(F.col("Status") == "Scheduled")
        .select("ScheduleID", "TrainID", "BasePrice", "DepartureTime"),
        "Schedules",
    )
    users = t["Users"].select("UserID", F.lit(True).alias("known_user"))
    known = F.col("UserID").isNull() | F.coalesce("known_user", F.lit(False))
    late = hours_crossed(instant(as_of), F.col("DepartureTime")) < HOURS_BEFORE_DEPARTURE
    code, reason = first_failure(
        (F.col("BasePrice").isNull(), msg.NO_SCHEDULE),
        (F.lit(refuse_late) & late, msg.TOO_LATE),
        (~known, "unknown UserID"),
        (F.size("seats") != F.size("names"), msg.LIST_MISMATCH),
        (F.exists("seats", lambda s: s.isNull()), "unknown SeatID"),
        (F.size(F.array_distinct("seats")) < F.size("seats"), msg.SEAT_TAKEN),
        (~F.col("PaymentMethod").isin(*PAYMENT_METHODS), "unknown PaymentMethod"),
    )
    # lists are split after the joins: a lambda copies the row it stands on, and requests may come
    # with all that they were made from
    checked = cut(
        _with_lists(asked.join(open_trips, "ScheduleID", "left").join(users, "UserID", "left"))
        .select("*", code.alias("code"), reason.alias("reason"))
    )
    sound = checked.filter(F.col("reason").isNull()).drop("code", "reason", "known_user")

    # what there is to know of an asked seat is found once per trip and seat, of which there may
    # be far fewer than requests; each join has a unique key on its right
    asked_seats = cut(sound.select("ScheduleID", F.explode("seats").alias("SeatID")).distinct())
    coaches = class_of_coach(t, F.col("TrainID").alias("seat_train"), "PriceMultiplier")
    places = t["Seats"].select("SeatID", "CoachID").join(coaches, "CoachID", "left")
    places = places.select("SeatID", "seat_train", "PriceMultiplier", F.lit(True).alias("known"))
    if held is None:  # of the asked trips only, not of all history
        seats = asked_seats.select("SeatID").distinct()
        few = seats.count() <= t.broadcast_rows
        held = taken_seats(
            t, asked_seats.select("ScheduleID").distinct(), F.broadcast(seats) if few else None
        )
    wrong_train = F.lit(check_train) & ~F.col("seat_train").eqNullSafe(F.col("TrainID"))
    price = ticket_price(F.col("BasePrice"), F.coalesce("PriceMultiplier", F.lit(1)))
    judged_seats = cut(
        asked_seats.join(places, "SeatID", "left")
        .join(held.withColumn("taken", F.lit(True)), ["SeatID", "ScheduleID"], "left")
        .join(open_trips, "ScheduleID")
        .select(
            "ScheduleID",
            "SeatID",
            price.alias("TicketPrice"),
            F.col("known").isNull().alias("unknown"),
            wrong_train.alias("wrong_train"),
            F.col("taken").isNotNull().alias("taken"),
        )
    )
    refusing = judged_seats.filter("unknown OR wrong_train OR taken").drop("TicketPrice")
    faults = (
        sound.select("request_id", "ScheduleID", F.explode("seats").alias("SeatID"))
        .join(refusing, ["ScheduleID", "SeatID"])
        .groupBy("request_id")
        .agg(*[F.bool_or(flag).alias(flag) for flag in ("unknown", "wrong_train", "taken")])
    )
    code, reason = first_failure(
        (F.col("unknown"), "unknown SeatID"),
        (F.col("wrong_train"), "seat of another train"),
        (F.col("taken"), msg.SEAT_TAKEN),
    )
    judged = cut(
        sound.join(faults, "request_id", "left").select(
            *sound.columns, code.alias("code"), reason.alias("reason")
        )
    )
    candidates = judged.filter(F.col("reason").isNull()).drop("code", "reason")
    winners = first_come(distinct_claims(candidates, "ScheduleID", "seats"))
    without_seats = candidates.filter(F.size("seats") == 0).select("request_id")
    winners = winners.unionByName(without_seats)
    refused = (
        reject(candidates.join(winners, "request_id", "left_anti"), msg.SEAT_TAKEN)
        .unionByName(judged.filter("reason is not null").select("request_id", "code", "reason"))
        .unionByName(checked.filter("reason is not null").select("request_id", "code", "reason"))
    )

    served = cut(candidates.join(winners, "request_id", "left_semi"))
    sold = (
        served.select("request_id", "ScheduleID", F.posexplode("seats").alias("pos", "SeatID"), "names")
        .withColumn("PassengerName", F.trim(F.get("names", F.col("pos"))))
        .drop("names")
        .join(judged_seats.select("ScheduleID", "SeatID", "TicketPrice"), ["ScheduleID", "SeatID"])
    )
    totals = sold.groupBy("request_id").agg(
        F.sum("TicketPrice").cast("decimal(10,2)").alias("TotalAmount")
    )
    accepted = number_rows(
        served.join(totals, "request_id", "left").select("request_id", "UserID", "ScheduleID", "PaymentMethod", "TotalAmount"
        ),
        "request_id",
    )
    ids = first_ids or first_new_ids(t)
    today = F.lit(str(as_of)[:10].replace("-", ""))
    # the number grows past five digits instead of losing its first ones
    number = padded(F.col("_n") + F.lit(first_code - 1), 5)
    booked = accepted.withColumn("BookingID", F.col("_n") + F.lit(ids["bookings"] - 1))
    amount = F.coalesce("TotalAmount", F.lit(0).cast("decimal(10,2)")).alias("TotalAmount")
    bookings = booked.select(
        "BookingID",
        F.concat(F.lit("BK"), today, number).alias("BookingCode"),
        "UserID",
        "ScheduleID",
        instant(as_of).alias("BookingDate"),
        amount,
        F.lit("Pending").alias("PaymentStatus"),
        F.lit("Active").alias("BookingStatus"),
        F.lit(None).cast("timestamp_ntz").alias("CancelledAt"),
        F.lit(None).cast("string").alias("CancellationReason"),
    )
    payments = booked.select(
        (F.col("_n") + F.lit(ids["payments"] - 1)).alias("PaymentID"),
        "BookingID",
        "PaymentMethod",
        F.lit(None).cast("string").alias("TransactionID"),
        amount.alias("Amount"),
        instant(as_of).alias("PaymentDate"),
        F.lit("Pending").alias("PaymentStatus"),
        F.lit(None).cast("string").alias("ResponseCode"),
        F.lit(None).cast("string").alias("ResponseMessage"),
    )
    ticket_type = t["Tickets"].schema["TicketID"].dataType
    tickets = number_rows(
        sold.join(booked.select("request_id", "BookingID"), "request_id"), "BookingID", "pos"
    ).select(
        (F.col("_n") + F.lit(ids["tickets"] - 1)).cast(ticket_type).alias("TicketID"),
        "BookingID",
        "SeatID",
        "PassengerName",
        F.lit(None).cast("string").alias("PassengerIDNumber"),
        F.lit(None).cast("string").alias("PassengerPhone"),
        "TicketPrice",
        F.lit("Valid").alias("TicketStatus"),
    )
    used = sold.groupBy("ScheduleID").agg(F.count(F.lit(1)).alias("n"))
    schedules = (
        t["Schedules"]
        .join(used, "ScheduleID")
        .withColumn("AvailableSeats", (F.col("AvailableSeats") - F.col("n")).cast("int"))
        .select(*t["Schedules"].columns)
    )
    return {
        "bookings": bookings,
        "tickets": tickets,
        "payments": payments,
        "schedules": schedules,
        "rejects": refused,
    }


def cancel_bookings(t: Tables, commands: DataFrame, as_of) -> dict[str, DataFrame]:
    """Cancels bookings by (request_id, booking_id, reason, admin_id).

    Of several good commands for one booking the first counts; the others find it no
    longer Active. A refund above 0 turns the payment status to Refunded. The schedule
    gets back as many seats as the booking has cancelled tickets, earlier ones included.
    """
    allowed, unauthorised = split_authorised(t, commands)
    trips = t.hint(refund_by_schedule(t, as_of), "Schedules")
    bookings = t["Bookings"].join(trips, "ScheduleID").withColumnRenamed("BookingID", "booking_id")
    code, why = first_failure(
        (F.col("BookingStatus").isNull(), msg.NO_BOOKING_TO_CANCEL),
        (F.col("BookingStatus") != "Active", msg.BOOKING_NOT_ACTIVE),
        (F.col("HoursLeft") < 0, msg.ALREADY_DEPARTED),
    )
    # the bookings are read once: every output comes from the commands with their bookings
    judged = cut(
        allowed.withColumnRenamed("reason", "asked_reason")
        .join(bookings, "booking_id", "left")
        .select("*", code.alias("code"), why.alias("why"))
    )
    good = judged.filter(F.col("why").isNull())
    first = good.groupBy("booking_id").agg(F.min("request_id").alias("first"))
    ranked = good.join(first, "booking_id")
    second = ranked.filter(F.col("request_id") != F.col("first"))
    hit = ranked.filter(F.col("request_id") == F.col("first"))
    changed = hit.select(
        F.col("booking_id").alias("BookingID"),
        "BookingCode",
        "UserID",
        "ScheduleID",
        "BookingDate",
        "TotalAmount",
        F.when(F.col("RefundPercentage") > 0, "Refunded")
        .otherwise(F.col("PaymentStatus"))
        .alias("PaymentStatus"),
        F.lit("Cancelled").alias("BookingStatus"),
        instant(as_of).alias("CancelledAt"),
        F.col("asked_reason").alias("CancellationReason"),
    )
    done = hit.select(F.col("booking_id").alias("BookingID"), "ScheduleID")
    held = F.col("TicketStatus").isin("Valid", "Cancelled")
    own = cut(t["Tickets"].filter(held).join(done, "BookingID"))
    tickets = (
        own.filter(F.col("TicketStatus") == "Valid")
        .withColumn("TicketStatus", F.lit("Cancelled"))
        .select(*t["Tickets"].columns)
    )
    restored = (
        own.groupBy("ScheduleID").agg(F.count(F.lit(1)).alias("n"))
    )
    schedules = (
        t["Schedules"]
        .join(restored, "ScheduleID")
        .withColumn("AvailableSeats", (F.col("AvailableSeats") + F.col("n")).cast("int"))
        .select(*t["Schedules"].columns)
    )
    before, between, after = (F.lit(x) for x in msg.CANCELLED_TEXT)
    text = F.concat(
        before, "BookingCode", between, F.col("RefundPercentage").cast("string"), after
    )
    sent = notices(
        hit.withColumnRenamed("booking_id", "BookingID"),
        "Cancellation",
        F.lit(msg.CANCELLED_TITLE),
        text,
        as_of,
    )
    refused = (
        reject(unauthorised, msg.NO_RIGHTS)
        .unionByName(
            judged.filter("why is not null").select("request_id", "code", F.col("why").alias("reason"))
        )
        .unionByName(reject(second, msg.BOOKING_NOT_ACTIVE))
    )
    refunds = hit.select("request_id", "booking_id", "RefundPercentage")
    return {
        "bookings": changed,
        "refunds": refunds,
        "tickets": tickets,
        "schedules": schedules,
        "notifications": sent,
        "rejects": refused,
    }


def cancel_schedules(
    t: Tables, commands: DataFrame, as_of, cascade: bool = False
) -> dict[str, DataFrame]:
    """Cancels schedules by (request_id, schedule_id, reason, admin_id).

    Active bookings are cancelled with the reason of the first command; every booking of
    the schedule is told once per command, whatever its state. Tickets, payments and seats
    stay as they are, unless ``cascade`` also cancels the tickets.
    """
    allowed, unauthorised = split_authorised(t, commands)
    runs = cut(allowed.withColumnRenamed("schedule_id", "ScheduleID"))
    first = runs.groupBy("ScheduleID").agg(
        F.min_by(F.struct("reason"), "request_id").alias("command")
    )
    schedules = (
        t["Schedules"]
        .join(first, "ScheduleID", "left_semi")
        .withColumn("Status", F.lit("Cancelled"))
    )
    met = cut(t["Bookings"].join(first, "ScheduleID"))  # read once for both outputs
    bookings = (
        met.filter(F.col("BookingStatus") == "Active")
        .withColumn("BookingStatus", F.lit("Cancelled"))
        .withColumn("CancelledAt", instant(as_of))
        .withColumn("CancellationReason", F.col("command.reason"))
        .select(*t["Bookings"].columns)
    )
    # texts are made per command and schedule, and only then meet the bookings
    before, between = (F.lit(x) for x in msg.TRIP_CANCELLED_TEXT)
    trains = t.hint(t["Trains"].select("TrainID", "TrainCode"), "Trains")
    texts = (
        runs.join(t.hint(t["Schedules"].select("ScheduleID", "TrainID"), "Schedules"), "ScheduleID")
        .join(trains, "TrainID")
        .select("ScheduleID", F.concat(before, "TrainCode", between, "reason").alias("text"))
    )
    told = met.select("UserID", "BookingID", "ScheduleID").join(texts, "ScheduleID")
    sent = notices(told, "Cancellation", F.lit(msg.TRIP_CANCELLED_TITLE), F.col("text"), as_of)
    out = {
        "schedules": schedules,
        "bookings": bookings,
        "notifications": sent,
        "rejects": reject(unauthorised, msg.NO_RIGHTS),
    }
    if cascade:
        out["tickets"] = cancelled_tickets(t, bookings)
    return out


def cancelled_tickets(t: Tables, bookings: DataFrame | None = None) -> DataFrame:
    """Tickets to cancel because their booking is: those not yet Cancelled. ``bookings``
    is the changed batch, by default every booking."""
    bookings = t["Bookings"] if bookings is None else bookings
    gone = bookings.filter(F.col("BookingStatus") == "Cancelled").select("BookingID")
    return (
        t["Tickets"]
        .filter(F.col("TicketStatus") != "Cancelled")
        .join(gone, "BookingID", "left_semi")
        .withColumn("TicketStatus", F.lit("Cancelled"))
        .select(*t["Tickets"].columns)
    )


def double_booked_seats(t: Tables) -> DataFrame:
    """(ScheduleID, SeatID) held by more than one Valid ticket of Active bookings."""
    valid = t["Tickets"].filter(F.col("TicketStatus") == "Valid").select("BookingID", "SeatID")
    active = (
        t["Bookings"].filter(F.col("BookingStatus") == "Active").select("BookingID", "ScheduleID")
    )
    return (
        valid.join(active, "BookingID")
        .groupBy("ScheduleID", "SeatID")
        .agg(F.count(F.lit(1)).alias("Holders"))
        .filter(F.col("Holders") > 1)
    )
