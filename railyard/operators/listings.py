"""Filterable listings and look-ups. Identifier parameters take a list or a DataFrame of
ids, so each look-up is also the bulk extract over all rows (``None``).

``ordered=False`` drops the final sort, which a bulk extract to files does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (
    instant,
    keep_days,
    keep_equal,
    keep_ids,
    keep_search,
    minutes_crossed,
    money,
    when_money,
)
from ..functions.lookups import with_refund_percentage, with_ticket_price
from ..plans.joins import class_of_coach, route_dims, seat_dims, trips_for
from ..plans.tables import Tables
from .views import (
    STATIONS,
    TIMES,
    customer_bookings,
    seat_rows,
    ticket_rows,
    users_for,
    with_booking_code,
    with_ticket_number,
)

USER_CARD = ("UserID", "FullName", "Email", "PhoneNumber", "UserType", "IsActive", "CreatedAt")


def _sorted(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """Sorts by the listing's column and then by a unique one, so that a date with very
    many rows is spread over several sort partitions."""
    return df.orderBy(*keys) if ordered else df


def _zero(column: str):
    return F.coalesce(column, F.lit(0).cast("bigint"))


def _bookings_by(t: Tables, key: str) -> DataFrame:
    """Booking number, paid amount and last date per user or schedule."""
    paid = when_money(F.col("PaymentStatus") == "Paid", F.col("TotalAmount"))
    return (
        t["Bookings"]
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(paid).alias("paid"),
            F.max("BookingDate").alias("LastBookingDate"),
        )
    )


def _paid():
    return money(F.coalesce("paid", F.lit(0).cast("decimal(28,2)")))


def list_users(
    t: Tables, user_type=None, is_active=None, search=None, ordered: bool = True
) -> DataFrame:
    users = keep_equal(t["Users"].select(*USER_CARD), UserType=user_type, IsActive=is_active)
    users = keep_search(users, search, "FullName", "Email", "PhoneNumber")
    stats = users.join(_bookings_by(t, "UserID"), "UserID", "left").select(
        *USER_CARD,
        _zero("n").alias("TotalBookings"),
        _paid().alias("TotalSpent"),
        "LastBookingDate",
    )
    return _sorted(stats, ordered, F.desc("CreatedAt"), "UserID")


def user_cards(t: Tables, user_ids=None) -> DataFrame:
    return keep_ids(t["Users"].select(*USER_CARD), "UserID", user_ids)


def user_bookings(t: Tables, user_ids=None, ordered: bool = True) -> DataFrame:
    rows = (
        keep_ids(t["Bookings"], "UserID", user_ids)
        .join(trips_for(t, "TrainCode", *STATIONS, "DepartureTime"), "ScheduleID")
        .select(
            "BookingID",
            "BookingCode",
            "BookingDate",
            "TrainCode",
            *STATIONS,
            "DepartureTime",
            "TotalAmount",
            "PaymentStatus",
            "BookingStatus",
        )
    )
    return _sorted(rows, ordered, F.desc("BookingDate"), "BookingID")


def list_stations(t: Tables, is_active=None, search=None) -> DataFrame:
    """Stations with their route numbers, counted per side instead of over the product
    of departing and arriving routes."""

    def routes_by(column: str, name: str) -> DataFrame:
        routes = t["Routes"].filter(F.col(column).isNotNull())
        counted = routes.groupBy(F.col(column).alias("StationID")).agg(
            F.count(F.lit(1)).alias(name)
        )
        return t.hint(counted, "Routes")

    stations = keep_equal(t["Stations"], IsActive=is_active)
    stations = keep_search(stations, search, "StationName", "StationCode", "City")
    return (
        stations.join(routes_by("DepartureStationID", "d"), "StationID", "left")
        .join(routes_by("ArrivalStationID", "a"), "StationID", "left")
        .select(
            "StationID",
            "StationCode",
            "StationName",
            "City",
            "Province",
            "Address",
            "IsActive",
            _zero("d").alias("DepartureRoutes"),
            _zero("a").alias("ArrivalRoutes"),
        )
        .orderBy("StationName")
    )


def _upcoming(t: Tables, as_of, key: str) -> DataFrame:
    """Number of Scheduled trips after ``as_of`` per train or route."""
    soon = t["Schedules"].filter(
        (F.col("Status") == "Scheduled") & (F.col("DepartureTime") > instant(as_of))
    )
    return t.hint(soon.groupBy(key).agg(F.count(F.lit(1)).alias("upcoming")), "Schedules")


def list_trains(
    t: Tables, as_of, is_active=None, train_type=None, fanout: str = "rows"
) -> DataFrame:
    """Trains with coaches, seats and upcoming trips. With ``fanout="rows"`` the seats
    count once per upcoming trip, as a join of coaches and schedules makes them."""
    coaches = (
        t["Coaches"]
        .groupBy("TrainID")
        .agg(F.count(F.lit(1)).alias("coaches"), F.sum("TotalSeats").alias("seats"))
    )
    times = F.greatest(_zero("upcoming"), F.lit(1)) if fanout == "rows" else F.lit(1)
    return (
        keep_equal(t["Trains"], IsActive=is_active, TrainType=train_type)
        .join(t.hint(coaches, "Coaches"), "TrainID", "left")
        .join(_upcoming(t, as_of, "TrainID"), "TrainID", "left")
        .select(
            "TrainID",
            "TrainCode",
            "TrainName",
            "TrainType",
            "TotalCoaches",
            "IsActive",
            _zero("coaches").alias("ConfiguredCoaches"),
            (F.col("seats") * times).cast("bigint").alias("TotalSeats"),
            _zero("upcoming").alias("UpcomingSchedules"),
        )
        .orderBy("TrainCode")
    )


def list_routes(t: Tables, as_of, is_active=None) -> DataFrame:
    return (
        keep_equal(route_dims(t), IsActive=is_active)
        .join(_upcoming(t, as_of, "RouteID"), "RouteID", "left")
        .select(
            "RouteID",
            "RouteCode",
            "DepartureStationID",
            "DepartureStation",
            "DepartureStationCode",
            "ArrivalStationID",
            "ArrivalStation",
            "ArrivalStationCode",
            "Distance",
            "EstimatedDuration",
            "IsActive",
            _zero("upcoming").alias("UpcomingSchedules"),
        )
        .orderBy("RouteCode")
    )


def list_schedules(
    t: Tables, status=None, start=None, end=None, train_id=None, route_id=None
) -> DataFrame:
    trips = trips_for(
        t,
        *TIMES,
        "TrainID",
        "RouteID",
        "TrainCode",
        "TrainName",
        *STATIONS,
        "Distance",
        "BasePrice",
        "AvailableSeats",
        "Status",
    )
    trips = keep_equal(trips, Status=status, TrainID=train_id, RouteID=route_id)
    trips = keep_days(trips, "DepartureTime", start, end)
    sold = t.hint(_bookings_by(t, "ScheduleID"), "Schedules")
    return (
        trips.join(sold, "ScheduleID", "left")
        .select(
            "ScheduleID",
            *TIMES,
            "TrainCode",
            "TrainName",
            *STATIONS,
            "Distance",
            "BasePrice",
            "AvailableSeats",
            "Status",
            _zero("n").alias("TotalBookings"),
            _paid().alias("Revenue"),
        )
        .orderBy(F.desc("DepartureTime"))
    )


def list_bookings(
    t: Tables,
    booking_status=None,
    payment_status=None,
    start=None,
    end=None,
    search=None,
    ordered: bool = True,
) -> DataFrame:
    bookings = keep_equal(
        t["Bookings"], BookingStatus=booking_status, PaymentStatus=payment_status
    )
    bookings = keep_days(bookings, "BookingDate", start, end)
    rows = keep_search(customer_bookings(t, bookings), search, "BookingCode", "CustomerName", "Email")
    return _sorted(rows, ordered, F.desc("BookingDate"), "BookingID")


def user_notifications(t: Tables, user_ids=None, ordered: bool = True) -> DataFrame:
    rows = with_booking_code(t, keep_ids(t["Notifications"], "UserID", user_ids))
    rows = (
        rows.select(
            "NotificationID",
            "NotificationType",
            "Title",
            "Message",
            "IsRead",
            "SentAt",
            "ScheduledFor",
            "BookingCode",
        )
    )
    return _sorted(rows, ordered, F.desc("SentAt"), "NotificationID")


def user_tickets(t: Tables, user_ids=None, ordered: bool = True) -> DataFrame:
    bookings = keep_ids(t["Bookings"], "UserID", user_ids)
    keys = (F.desc("DepartureTime"), F.col("TicketID"))
    few, order = user_ids is not None, keys if ordered else ()
    rows = ticket_rows(t, bookings, *TIMES, *STATIONS, "TrainName", few=few, order=order).select(
        "TicketID",
        "PassengerName",
        "PassengerIDNumber",
        "PassengerPhone",
        "TicketPrice",
        "TicketStatus",
        "BookingCode",
        *TIMES,
        *STATIONS,
        "TrainName",
        "SeatClass",
        "CoachNumber",
        "SeatNumber",
    )
    return _sorted(rows, ordered, *keys)


def user_payments(t: Tables, user_ids=None, ordered: bool = True) -> DataFrame:
    codes = keep_ids(t["Bookings"], "UserID", user_ids).select("BookingID", "BookingCode")
    rows = (
        t["Payments"]
        .join(codes, "BookingID")
        .select(
            "PaymentID",
            "BookingCode",
            "PaymentMethod",
            "TransactionID",
            "Amount",
            "PaymentStatus",
            "ResponseCode",
            "ResponseMessage",
            "PaymentDate",
        )
    )
    return _sorted(rows, ordered, F.desc("PaymentDate"), "PaymentID")


def booking_history(t: Tables, user_ids=None, status=None, ordered: bool = True) -> DataFrame:
    bookings = keep_equal(keep_ids(t["Bookings"], "UserID", user_ids), BookingStatus=status)
    rows = (
        with_ticket_number(t, bookings)
        .join(trips_for(t, "TrainCode", "TrainName", *STATIONS, *TIMES), "ScheduleID")
        .select(
            "BookingID",
            "BookingCode",
            "BookingDate",
            "TrainCode",
            "TrainName",
            *STATIONS,
            *TIMES,
            "TotalAmount",
            "PaymentStatus",
            "BookingStatus",
            "NumberOfTickets",
        )
    )
    return _sorted(rows, ordered, F.desc("BookingDate"), "BookingID")


def booking_headers(t: Tables, as_of, booking_ids=None) -> DataFrame:
    trips = trips_for(
        t,
        "TrainCode",
        "TrainName",
        "DepartureStation",
        "DepartureStationCode",
        "ArrivalStation",
        "ArrivalStationCode",
        *TIMES,
        "Distance",
        "EstimatedDuration",
    )
    users = users_for(t, F.col("FullName").alias("CustomerName"), "Email", "PhoneNumber")
    bookings = keep_ids(t["Bookings"], "BookingID", booking_ids).join(trips, "ScheduleID")
    return (
        with_refund_percentage(t, bookings, as_of)
        .join(users, "UserID")
        .select(
            "BookingID",
            "BookingCode",
            "BookingDate",
            "TotalAmount",
            "PaymentStatus",
            "BookingStatus",
            "CustomerName",
            "Email",
            "PhoneNumber",
            "TrainCode",
            "TrainName",
            "DepartureStation",
            "DepartureStationCode",
            "ArrivalStation",
            "ArrivalStationCode",
            *TIMES,
            "Distance",
            "EstimatedDuration",
            "RefundPercentage",
        )
    )


def booking_tickets(t: Tables, booking_ids=None) -> DataFrame:
    seats = seat_dims(t).select(
        "SeatID", "CoachNumber", "SeatNumber", "SeatType", F.col("ClassName").alias("SeatClass")
    )
    tickets, ticket_id = t.in_parts("Tickets", "TicketID")
    return (
        keep_ids(tickets, "BookingID", booking_ids)
        .join(seats, "SeatID")
        .select(
            ticket_id.alias("TicketID"),
            "PassengerName",
            "PassengerIDNumber",
            "PassengerPhone",
            "CoachNumber",
            "SeatNumber",
            "SeatType",
            "SeatClass",
            "TicketPrice",
            "TicketStatus",
        )
    )


def booking_payments(t: Tables, booking_ids=None) -> DataFrame:
    return keep_ids(t["Payments"], "BookingID", booking_ids).select(
        "PaymentID", "PaymentMethod", "TransactionID", "Amount", "PaymentDate", "PaymentStatus"
    )


def search_trips(
    t: Tables,
    departure_station=None,
    arrival_station=None,
    date=None,
    seat_class=None,
) -> DataFrame:
    """Bookable trips, one row per coach of the train. With a class only its coaches are
    shown and the price is for that class; a train without it keeps one row, class NULL."""
    trips = trips_for(
        t,
        "TrainID",
        "TrainCode",
        "TrainName",
        "DepartureStationID",
        "ArrivalStationID",
        *STATIONS,
        *TIMES,
        "BasePrice",
        "AvailableSeats",
        "Status",
    )
    trips = keep_equal(
        trips, DepartureStationID=departure_station, ArrivalStationID=arrival_station
    )
    trips = keep_days(trips, "DepartureTime", date, date).filter(
        (F.col("Status") == "Scheduled") & (F.col("AvailableSeats") > 0)
    )
    if seat_class is None:
        trips = trips.withColumn("Price", F.col("BasePrice"))
    else:
        wanted = trips.withColumn("WantedClassID", F.lit(seat_class).cast("bigint"))
        trips = with_ticket_price(t, wanted, seat_class="WantedClassID")
    coaches = keep_equal(t["Coaches"].select("TrainID", "SeatClassID"), SeatClassID=seat_class)
    names = t.small("SeatClasses").select("SeatClassID", F.col("ClassName").alias("SeatClass"))
    return (
        trips.join(t.hint(coaches, "Coaches"), "TrainID", "left")
        .join(t.hint(names, "SeatClasses"), "SeatClassID", "left")
        .select(
            "ScheduleID",
            "TrainCode",
            "TrainName",
            *STATIONS,
            *TIMES,
            minutes_crossed(F.col("DepartureTime"), F.col("ArrivalTime")).alias(
                "TravelTimeMinutes"
            ),
            "Price",
            "AvailableSeats",
            "SeatClass",
        )
        .orderBy("DepartureTime")
    )


def seat_map(t: Tables, schedule_id: int, coach_id: int | None = None) -> DataFrame:
    """Seats of one coach (or of every coach) as seen from one schedule, with price."""
    coaches = keep_equal(class_of_coach(t, "SeatClassID", "ClassName"), CoachID=coach_id)
    seats = (
        keep_equal(t["Seats"], CoachID=coach_id)
        .join(coaches, "CoachID")
        .withColumn("ScheduleID", F.lit(schedule_id).cast("bigint"))
    )
    return (
        with_ticket_price(t, seat_rows(t, seats, few=coach_id is not None))
        .select(
            "SeatID",
            "SeatNumber",
            "SeatType",
            "ClassName",
            F.when(F.col("Booked"), 0).otherwise(1).alias("IsAvailable"),
            "Price",
        )
        .orderBy("SeatNumber")
    )
