"""Aggregated reports. Every function is ``(tables, parameters) -> DataFrame``.

Amounts are summed on pre-aggregated rows: tickets are counted per booking, bookings are
summed per schedule, day or user, and only those small results meet the dimensions. So no
report shuffles raw fact rows to a dimension key, and a hot key costs one row per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (
    as_date,
    count_if,
    instant,
    int_div,
    keep_days,
    mean,
    money,
    month_range,
    percent,
    week_of_year,
    when_money,
)
from ..plans.joins import booking_facts, class_of_coach, trips_for
from ..plans.tables import Tables


def _paid():
    return F.col("PaymentStatus") == "Paid"


def _cancelled():
    return F.col("BookingStatus") == "Cancelled"


def _weighted():
    return F.col("TotalAmount") * F.col("weight")


def _weighted_if(cond):
    return when_money(cond, F.col("TotalAmount")) * F.col("weight")


def _amount_sums(cancelled_as: str = "CancelledRevenue") -> list:
    return [
        money(F.sum(_weighted())).alias("TotalRevenue"),
        money(F.sum(_weighted_if(_paid()))).alias("PaidRevenue"),
        money(F.sum(_weighted_if(_cancelled()))).alias(cancelled_as),
    ]


def _daily(t: Tables, start, end, fanout: str) -> DataFrame:
    """Booking measures per day; weeks and months are rolled up from these rows."""
    bookings = t.days("Bookings", "BookingDate", start, end)
    return (
        booking_facts(t, bookings, fanout)
        .groupBy(F.to_date("BookingDate").alias("Day"))
        .agg(
            F.count(F.lit(1)).alias("TotalBookings"),
            F.sum("tickets").alias("TotalTickets"),
            *_amount_sums(),
        )
    )


def revenue_by_date(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    daily = _daily(t, start, end, fanout).withColumnRenamed("Day", "BookingDate")
    return daily.orderBy(F.desc("BookingDate"))


def revenue_by_day(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    return _daily(t, start, end, fanout).withColumnRenamed("Day", "Period").orderBy("Period")


def _rollup(daily: DataFrame, *keys, extra=()) -> DataFrame:
    return daily.groupBy(*keys).agg(
        *extra,
        F.sum("TotalBookings").alias("TotalBookings"),
        F.sum("TotalTickets").alias("TotalTickets"),
        money(F.sum("TotalRevenue")).alias("TotalRevenue"),
        money(F.sum("PaidRevenue")).alias("PaidRevenue"),
    )


def revenue_by_week(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    day = F.col("Day")
    return _rollup(
        _daily(t, start, end, fanout),
        F.year(day).alias("Year"),
        week_of_year(day).alias("Week"),
        extra=[F.min(day).alias("WeekStart")],
    ).orderBy("Year", "Week")


def revenue_by_month(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    day = F.col("Day")
    return _rollup(
        _daily(t, start, end, fanout),
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.date_format(day, "MMMM").alias("MonthName"),
    ).orderBy("Year", "Month")


def revenue_analytics(t: Tables, start=None, end=None, group_by="Day", fanout="rows") -> DataFrame:
    by = {"Day": revenue_by_day, "Week": revenue_by_week, "Month": revenue_by_month}
    return by[group_by](t, start, end, fanout)


_ROUTE = ("RouteCode", "DepartureStation", "ArrivalStation")


def revenue_by_route(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    bookings = t.days("Bookings", "BookingDate", start, end).filter(_paid())
    per_schedule = (
        booking_facts(t, bookings, fanout)
        .groupBy("ScheduleID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("tickets").alias("tickets"),
            F.sum("weight").alias("weight"),
            F.sum(_weighted()).alias("amount"),
        )
    )
    return (
        per_schedule.join(trips_for(t, *_ROUTE), "ScheduleID")
        .groupBy(*_ROUTE)
        .agg(
            F.sum("n").alias("TotalBookings"),
            F.sum("tickets").alias("TotalTickets"),
            money(F.sum("amount")).alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("weight")).alias("AverageBookingValue"),
        )
        .orderBy(F.desc("TotalRevenue"), "RouteCode")
    )


def _paid_by_route(t: Tables, start, end, paid_only: bool) -> DataFrame:
    """Bookings and paid revenue per route, without tickets and so without fan-out."""
    bookings = t.days("Bookings", "BookingDate", start, end)
    if paid_only:
        bookings = bookings.filter(_paid())
    per_schedule = bookings.groupBy("ScheduleID").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(when_money(_paid(), F.col("TotalAmount"))).alias("amount"),
    )
    return (
        per_schedule.join(trips_for(t, *_ROUTE), "ScheduleID")
        .groupBy(*_ROUTE)
        .agg(F.sum("n").alias("Bookings"), money(F.sum("amount")).alias("Revenue"))
    )


def _class_stats(t: Tables, start, end, *keys: str) -> DataFrame:
    """Tickets of paid bookings per seat class, with each class's share of all tickets.

    Two reductions come before the dimension joins: bookings shrink to their ids, and
    tickets to one row per seat, so a seat or class in high demand is no hot join key.
    """
    paid = t.days("Bookings", "BookingDate", start, end).filter(_paid())
    per_seat = (
        t["Tickets"]
        .join(paid.select("BookingID"), "BookingID", "left_semi")
        .groupBy("SeatID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("TicketPrice").alias("amount"),
            F.min("TicketPrice").alias("low"),
            F.max("TicketPrice").alias("high"),
        )
    )
    per_coach = (
        per_seat.join(t["Seats"].select("SeatID", "CoachID"), "SeatID")
        .groupBy("CoachID")
        .agg(
            F.sum("n").alias("n"),
            F.sum("amount").alias("amount"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
    )
    by_class = (
        per_coach.join(class_of_coach(t, "SeatClassID", "ClassName"), "CoachID")
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("TicketsSold"),
            money(F.sum("amount")).alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("n")).alias("AveragePrice"),
            F.min("low").alias("MinPrice"),
            F.max("high").alias("MaxPrice"),
        )
    )
    # the window sees one row per seat class
    total = F.sum("TicketsSold").over(Window.partitionBy())
    return by_class.withColumn("PercentageOfTotal", percent(F.col("TicketsSold"), total))


def revenue_by_seat_class(t: Tables, start=None, end=None) -> DataFrame:
    return (
        _class_stats(t, start, end, "ClassName")
        .drop("MinPrice", "MaxPrice")
        .orderBy(F.desc("TotalRevenue"), "ClassName")
    )


def seat_class_analytics(t: Tables, start=None, end=None) -> DataFrame:
    return (
        _class_stats(t, start, end, "ClassName", "SeatClassID")
        .drop("SeatClassID")
        .orderBy(F.desc("TotalRevenue"), "ClassName")
    )


def top_customers(t: Tables, as_of, top_n: int = 10, fanout: str = "rows") -> DataFrame:
    """Customers by paid amount. Those without a paid booking stay, with a NULL total."""
    per_user = (
        booking_facts(t, t["Bookings"].filter(_paid()), fanout)
        .groupBy("UserID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("tickets").alias("tickets"),
            money(F.sum(_weighted())).alias("TotalSpent"),
            F.max("BookingDate").alias("LastBookingDate"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return (
        t["Users"]
        .filter(F.col("UserType") == "Customer")
        .join(per_user, "UserID", "left")
        .select(
            "UserID",
            "FullName",
            "Email",
            "PhoneNumber",
            F.coalesce("n", zero).alias("TotalBookings"),
            F.coalesce("tickets", zero).alias("TotalTickets"),
            "TotalSpent",
            "LastBookingDate",
            F.datediff(instant(as_of), "CreatedAt").alias("DaysSinceRegistration"),
        )
        .orderBy(F.desc_nulls_last("TotalSpent"), "UserID")
        .limit(top_n)
    )


def payment_analytics(t: Tables, start=None, end=None) -> DataFrame:
    success, failed = (F.col("PaymentStatus") == s for s in ("Success", "Failed"))
    n = F.count(F.lit(1))
    return (
        t.days("Payments", "PaymentDate", start, end)
        .groupBy("PaymentMethod")
        .agg(
            n.alias("TransactionCount"),
            money(F.sum("Amount")).alias("TotalAmount"),
            mean(F.sum("Amount"), n).alias("AverageAmount"),
            F.min("Amount").alias("MinAmount"),
            F.max("Amount").alias("MaxAmount"),
            count_if(success).alias("SuccessCount"),
            count_if(failed).alias("FailedCount"),
            percent(count_if(success), n).alias("SuccessRate"),
        )
        .orderBy(F.desc("TotalAmount"), "PaymentMethod")
    )


def payment_method_statistics(t: Tables, start=None, end=None) -> DataFrame:
    return payment_analytics(t, start, end).drop("MinAmount", "MaxAmount")


def revenue_summary(t: Tables, year: int, month: int | None = None, fanout="rows") -> DataFrame:
    start, end = month_range(year, month)
    bookings = t.days("Bookings", "BookingDate", start, end)
    return booking_facts(t, bookings, fanout, few=True).agg(
        F.count(F.lit(1)).alias("TotalBookings"),
        F.coalesce(F.sum("tickets"), F.lit(0)).cast("bigint").alias("TotalTickets"),
        *_amount_sums("CancelledAmount"),
        mean(F.sum(_weighted()), F.sum("weight")).alias("AverageBookingValue"),
        F.count_distinct("UserID").alias("UniqueCustomers"),
    )


def revenue_summary_by_route(t: Tables, year: int, month: int | None = None) -> DataFrame:
    start, end = month_range(year, month)
    by_route = _paid_by_route(t, start, end, paid_only=False)
    return by_route.orderBy(F.desc("Revenue"), "RouteCode")


def revenue_summary_by_method(t: Tables, year: int, month: int | None = None) -> DataFrame:
    start, end = month_range(year, month)
    return (
        t.days("Payments", "PaymentDate", start, end)
        .filter(F.col("PaymentStatus") == "Success")
        .groupBy("PaymentMethod")
        .agg(F.count(F.lit(1)).alias("Transactions"), money(F.sum("Amount")).alias("Amount"))
    )


def _dashboard_start(as_of, days: int) -> dt.date:
    return as_date(as_of) - dt.timedelta(days=days)


def dashboard_totals(t: Tables, as_of, days: int = 30, fanout: str = "rows") -> DataFrame:
    bookings = t.days("Bookings", "BookingDate", _dashboard_start(as_of, days), None)
    known = t.hint(t["Schedules"].select("ScheduleID", F.lit(True).alias("known")), "Schedules")
    return (
        booking_facts(t, bookings, fanout, few=True)
        .join(known, "ScheduleID", "left")
        .agg(
            F.count(F.lit(1)).alias("TotalBookings"),
            F.count(F.when(F.col("BookingStatus") == "Active", 1)).alias("ActiveBookings"),
            F.coalesce(F.sum("tickets"), F.lit(0)).cast("bigint").alias("TotalTickets"),
            money(F.sum(_weighted_if(_paid()))).alias("TotalRevenue"),
            F.count_distinct("UserID").alias("UniqueCustomers"),
            F.count_distinct(F.when(F.col("known"), F.col("ScheduleID"))).alias("TotalSchedules"),
            mean(F.sum(_weighted()), F.sum("weight")).alias("AverageBookingValue"),
        )
    )


def dashboard_days(t: Tables, as_of, days: int = 30) -> DataFrame:
    return (
        t.days("Bookings", "BookingDate", _dashboard_start(as_of, days), None)
        .groupBy(F.to_date("BookingDate").alias("BookingDate"))
        .agg(
            F.count(F.lit(1)).alias("Bookings"),
            money(F.sum(when_money(_paid(), F.col("TotalAmount")))).alias("Revenue"),
        )
        .orderBy(F.desc("BookingDate"))
    )


def dashboard_top_routes(t: Tables, as_of, days: int = 30, top_n: int = 5) -> DataFrame:
    by_route = _paid_by_route(t, _dashboard_start(as_of, days), None, paid_only=True)
    return by_route.orderBy(F.desc("Revenue"), "RouteCode").limit(top_n)


# days of the longest slice that is tried before all bookings
LONGEST_SLICE = 40_000


def dashboard_latest(t: Tables, as_of=None, top_n: int = 10) -> DataFrame:
    """Latest bookings over all dates, by booking date and then booking id.

    A booking qualifies only if its customer exists. That is a semi join on the id; names
    are fetched for the few top rows alone. With ``as_of``, which need not be near the latest
    booking, slices of days are tried until enough bookings qualify: those from one day
    before it on, from four days, sixteen and so on, and last all. The file statistics skip
    what lies before a slice, so an answer reads the latest one only.
    """
    users = t.hint(t["Users"].select("UserID", "FullName"), "Users")
    trips = trips_for(t, "TrainCode", "DepartureStation", "ArrivalStation")

    def qualified(bookings: DataFrame) -> DataFrame:
        return (
            bookings.select(
                "BookingID",
                "BookingCode",
                "UserID",
                "ScheduleID",
                "TotalAmount",
                "BookingStatus",
                "BookingDate",
            )
            .join(trips, "ScheduleID")
            .join(users.select("UserID"), "UserID", "left_semi")
        )

    rows = qualified(t["Bookings"])
    days = 1
    while as_of is not None and days <= LONGEST_SLICE:
        part = qualified(t.days("Bookings", "BookingDate", _dashboard_start(as_of, days), None))
        if part.select("BookingID").limit(top_n).count() == top_n:
            rows = part
            break
        days *= 4
    latest = rows.orderBy(F.desc("BookingDate"), F.desc("BookingID")).limit(top_n)
    return (
        users.join(F.broadcast(latest), "UserID")
        .orderBy(F.desc("BookingDate"), F.desc("BookingID"))
        .select(
            "BookingCode",
            "FullName",
            "TrainCode",
            "DepartureStation",
            "ArrivalStation",
            "TotalAmount",
            "BookingStatus",
            "BookingDate",
        )
    )


def _of_trips(t: Tables, trips: DataFrame, start, end) -> DataFrame:
    """Bookings of trips that are limited to a range; with no limit all bookings."""
    if start is None and end is None:
        return t["Bookings"]
    ids = t.hint(trips.select("ScheduleID"), "Schedules")
    return t["Bookings"].join(ids, "ScheduleID", "left_semi")


def train_utilization(t: Tables, start=None, end=None) -> DataFrame:
    """Trips, occupancy and revenue per train, all counted once per booking row (a trip
    without bookings is one row). Capacity is 50 seats per declared coach."""
    schedules = keep_days(t["Schedules"], "DepartureTime", start, end)
    per_booking = (
        _of_trips(t, schedules, start, end)
        .groupBy("ScheduleID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(when_money(_paid(), F.col("TotalAmount"))).alias("paid"),
        )
    )
    rows = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)).cast("bigint")
    trips = (
        schedules.join(t.hint(per_booking, "Schedules"), "ScheduleID", "left")
        .select("TrainID", "Status", "AvailableSeats", "n", "paid", rows.alias("rows"))
    )
    known_seats = F.col("AvailableSeats").isNotNull()
    per_train = trips.groupBy("TrainID").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.when(F.col("Status") == "Completed", F.col("rows"))).alias("completed"),
        F.sum(F.when(F.col("Status") == "Cancelled", F.col("rows"))).alias("cancelled"),
        F.sum(F.when(known_seats, F.col("rows"))).alias("seat_rows"),
        F.sum(F.col("AvailableSeats") * F.col("rows")).alias("free"),
        F.sum("n").alias("bookings"),
        F.sum("paid").alias("paid"),
    )
    capacity = F.col("TotalCoaches").cast("bigint") * F.lit(50)
    occupied = (capacity * F.col("seat_rows") - F.col("free")) * F.lit(100)
    zero = F.lit(0).cast("bigint")
    return (
        t["Trains"]
        .join(t.hint(per_train, "Schedules"), "TrainID", "left")
        .select(
            "TrainCode",
            "TrainName",
            F.coalesce("trips", zero).alias("TotalTrips"),
            F.coalesce("completed", zero).alias("CompletedTrips"),
            F.coalesce("cancelled", zero).alias("CancelledTrips"),
            mean(occupied, capacity * F.col("seat_rows")).alias("AverageOccupancy"),
            F.coalesce("bookings", zero).alias("TotalBookings"),
            money(F.coalesce("paid", F.lit(0).cast("decimal(28,2)"))).alias("TotalRevenue"),
        )
        .orderBy(F.desc("TotalRevenue"), "TrainCode")
    )


def route_performance(t: Tables, start=None, end=None, fanout: str = "rows") -> DataFrame:
    """Schedules, bookings, tickets and revenue per route for departures in the range."""
    trips = trips_for(t, *_ROUTE, "Distance", "BasePrice", "DepartureTime")
    trips = keep_days(trips, "DepartureTime", start, end)
    ranged = not (start is None and end is None)
    per_schedule = (
        booking_facts(t, _of_trips(t, trips, start, end), fanout, few=ranged)
        .groupBy("ScheduleID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("tickets").alias("tickets"),
            F.sum("weight").alias("weight"),
            F.sum(_weighted()).alias("amount"),
            F.sum(_weighted_if(_paid())).alias("paid"),
        )
    )
    zero = F.lit(0).cast("bigint")
    # a schedule without bookings is one joined row; fan-out "once" counts each one once
    copies = F.coalesce("weight", F.lit(1)) if fanout == "rows" else F.lit(1)
    copies = copies.cast("bigint")
    return (
        t.hint(trips, "Schedules")
        .join(t.hint(per_schedule, "Schedules"), "ScheduleID", "left")
        .groupBy(*_ROUTE, "Distance")
        .agg(
            F.count(F.lit(1)).alias("TotalSchedules"),
            F.coalesce(F.sum("n"), zero).alias("TotalBookings"),
            F.coalesce(F.sum("tickets"), zero).alias("TotalTickets"),
            money(F.coalesce(F.sum("paid"), F.lit(0))).alias("TotalRevenue"),
            mean(F.sum("amount"), F.sum("weight")).alias("AverageBookingValue"),
            mean(F.sum(F.col("BasePrice") * copies), F.sum(copies)).alias("AverageBasePrice"),
        )
        .orderBy(F.desc("TotalRevenue"), "RouteCode")
    )


# Lower limits of the customer segments, in currency units.
SEGMENTS = (("VIP", 10_000_000), ("Gold", 5_000_000), ("Silver", 2_000_000))


def customer_segmentation(t: Tables) -> DataFrame:
    per_user = (
        t["Bookings"]
        .groupBy("UserID")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(when_money(_paid(), F.col("TotalAmount"))).alias("spent"),
        )
    )
    customers = (
        t["Users"]
        .filter(F.col("UserType") == "Customer")
        .select("UserID")
        .join(per_user, "UserID", "left")
        .select(
            F.coalesce("n", F.lit(0)).alias("n"),
            money(F.coalesce("spent", F.lit(0))).alias("spent"),
        )
    )
    segment, rank = F.lit("Regular"), F.lit(len(SEGMENTS) + 1)
    for place, (name, limit) in reversed(list(enumerate(SEGMENTS, 1))):
        reached = F.col("spent") >= F.lit(limit)
        segment = F.when(reached, name).otherwise(segment)
        rank = F.when(reached, place).otherwise(rank)
    n = F.count(F.lit(1))
    return (
        customers.groupBy(segment.alias("CustomerSegment"), rank.alias("rank"))
        .agg(
            n.alias("CustomerCount"),
            mean(F.sum("spent"), n).alias("AvgSpent"),
            int_div(F.sum("n"), n).alias("AvgBookings"),
            money(F.sum("spent")).alias("TotalRevenue"),
        )
        .orderBy("rank")
        .drop("rank")
    )


def bookings_by_hour(t: Tables, start=None, end=None) -> DataFrame:
    return (
        t.days("Bookings", "BookingDate", start, end)
        .groupBy(F.hour("BookingDate").alias("Hour"))
        .agg(F.count(F.lit(1)).alias("BookingCount"), money(F.sum("TotalAmount")).alias("Revenue"))
        .orderBy("Hour")
    )


def bookings_by_weekday(t: Tables, start=None, end=None) -> DataFrame:
    """Weekdays are numbered from Sunday = 1."""
    return (
        t.days("Bookings", "BookingDate", start, end)
        .groupBy(
            F.date_format("BookingDate", "EEEE").alias("DayOfWeek"),
            F.dayofweek("BookingDate").alias("DayNumber"),
        )
        .agg(F.count(F.lit(1)).alias("BookingCount"), money(F.sum("TotalAmount")).alias("Revenue"))
        .orderBy("DayNumber")
    )


def notification_stats(t: Tables, as_of, start=None, end=None) -> DataFrame:
    """Read rate per type. Missing dates default to the 30 days up to ``as_of``."""
    start = as_date(as_of) - dt.timedelta(days=30) if start is None else start
    end = as_date(as_of) if end is None else end
    n = F.count(F.lit(1))
    return (
        keep_days(t["Notifications"], "SentAt", start, end)
        .groupBy("NotificationType")
        .agg(
            n.alias("TotalSent"),
            count_if(F.col("IsRead")).alias("ReadCount"),
            count_if(~F.col("IsRead")).alias("UnreadCount"),
            percent(count_if(F.col("IsRead")), n).alias("ReadRate"),
        )
        .orderBy(F.desc("TotalSent"), "NotificationType")
    )


def monthly_revenue(t: Tables, year: int, month: int, fanout: str = "rows") -> DataFrame:
    return (
        revenue_summary(t, year, month, fanout)
        .drop("UniqueCustomers")
        .withColumnsRenamed(
            {"PaidRevenue": "CollectedRevenue", "CancelledAmount": "CancelledRevenue"}
        )
    )


def monthly_top_routes(t: Tables, year: int, month: int, top_n: int = 5) -> DataFrame:
    start, end = month_range(year, month)
    return (
        _paid_by_route(t, start, end, paid_only=True)
        .orderBy(F.desc("Revenue"), "RouteCode")
        .limit(top_n)
        .select(
            "RouteCode",
            F.concat("DepartureStation", F.lit(" → "), "ArrivalStation").alias("Route"),
            "Bookings",
            "Revenue",
        )
    )


def monthly_customers(t: Tables, year: int, month: int) -> DataFrame:
    """Customers of the month, those whose first booking is in it or later, and those
    with more than one booking in it. One pass over the bookings gives all three."""
    start, end = month_range(year, month)
    past = end + dt.timedelta(days=1)
    at = F.col("BookingDate")
    in_month = (at >= instant(str(start))) & (at < instant(str(past)))
    per_user = (
        t["Bookings"]
        .filter(F.col("UserID").isNotNull())
        .groupBy("UserID")
        .agg(F.min("BookingDate").alias("first"), F.count(F.when(in_month, 1)).alias("n"))
        .filter(F.col("n") > 0)
    )
    return per_user.agg(
        F.count(F.lit(1)).alias("UniqueCustomers"),
        F.count(F.when(F.col("first") >= instant(str(start)), 1)).alias("NewCustomers"),
        F.count(F.when(F.col("n") > 1, 1)).alias("ReturningCustomers"),
    )
