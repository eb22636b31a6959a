"""The traced user flow on the sample data, with its expected numbers."""

from decimal import Decimal as D

import pytest
from helpers import AS_OF, ATTEMPT, BOOKING_REQUEST, CANCEL, FLOW_REQUESTS, apply, fix, rows
from pyspark.sql import functions as F

from railyard.operators import booking_jobs, listings, master_data, payment_jobs, reports, views
from railyard.operators.lifecycle_jobs import roll_counts, roll_statuses
from railyard.sources.seed import seed_tables


@pytest.fixture(scope="module")
def flow(spark):
    seed = seed_tables(spark)
    seed = seed.with_frames(Seats=fix(seed["Seats"]), Users=fix(seed["Users"]))
    sign_up = spark.createDataFrame(
        [(1, "Trần Tôn Anh", "tonanh@gmail.com", "0123456789", "tonanh_hash_pass", "Customer")],
        "request_id bigint, FullName string, Email string, PhoneNumber string, password string,"
        " UserType string",
    )
    added = master_data.append_rows(seed, "Users", sign_up, AS_OF)
    start = seed.with_frames(Users=fix(seed["Users"].unionByName(added["rows"])))
    booked = booking_jobs.create_bookings(
        start, spark.createDataFrame(FLOW_REQUESTS, BOOKING_REQUEST), AS_OF
    )
    at_b = apply(start, booked)
    paid = payment_jobs.process_payments(
        at_b, spark.createDataFrame([(1, 1, "VNPay_TXN_001", "00")], ATTEMPT), AS_OF
    )
    at_p = apply(at_b, paid)
    cancelled = booking_jobs.cancel_bookings(
        at_p, spark.createDataFrame([(1, 1, "busy", None)], CANCEL), AS_OF
    )
    at_c = apply(at_p, cancelled)
    return dict(
        seed=seed, added=added, b=at_b, p=at_p, c=at_c, booked=booked, cancelled=cancelled
    )


def test_seed_seats(flow):
    seats = flow["seed"]["Seats"]
    assert seats.count() == 372
    first = dict(rows(seats.groupBy("CoachID").agg(F.min("SeatID"))))
    assert first == {1: 1, 5: 65, 6: 101, 7: 137, 8: 161, 9: 185, 10: 197, 11: 261, 12: 313, 13: 349}
    singles = seats.filter("SeatType = 'Single'").select("CoachID").distinct()
    assert {r[0] for r in rows(singles)} == {1, 10, 11}


def test_sign_up(flow):
    assert rows(flow["added"]["ids"]) == [(1, 7)]
    new = flow["b"]["Users"].filter("UserID = 7").first()
    assert (new.UserType, new.IsActive) == ("Customer", True)


def test_search_and_seats_before_booking(flow):
    seed = flow["seed"]
    assert {r.ScheduleID for r in views.available_schedules(seed, AS_OF).collect()} == {1, 5, 6}
    found = listings.search_trips(seed, 1, 8, "2025-11-25").collect()
    assert len(found) == 9
    assert {(r.ScheduleID, r.Price, r.TravelTimeMinutes) for r in found} == {(1, D("800000.00"), 480)}
    seats = listings.seat_map(seed, 1, 5).collect()
    assert len(seats) == 36
    assert {(s.IsAvailable, s.Price) for s in seats} == {(1, D("1200000.00"))}


def test_search_by_class_keeps_a_row_without_the_class(flow):
    seed = flow["seed"]
    found = listings.search_trips(seed, 1, 4, "2025-11-18", seat_class=5).collect()
    assert [(r.ScheduleID, r.SeatClass, r.Price) for r in found] == [(5, None, D("875000.00"))]
    unknown = listings.search_trips(seed, 1, 4, "2025-11-18", seat_class=99).collect()
    assert [(r.SeatClass, r.Price) for r in unknown] == [(None, D("0.00"))]


def test_bookings(flow):
    b = flow["b"]
    got = rows(b["Bookings"].orderBy("BookingID"), "BookingCode", "TotalAmount", "BookingStatus")
    assert got == [
        ("BK2025110500001", D("1600000.00"), "Active"),
        ("BK2025110500002", D("1600000.00"), "Active"),
        ("BK2025110500003", D("2400000.00"), "Active"),
    ]
    tickets = rows(b["Tickets"].orderBy("TicketID"), "TicketID", "BookingID", "SeatID", "PassengerName")
    assert tickets == [
        (1, 1, 3, "Tôn"),
        (2, 1, 4, "Anh"),
        (3, 2, 12, "Thanh"),
        (4, 2, 13, "Hưng"),
        (5, 3, 21, "Long"),
        (6, 3, 22, "VIệt"),
        (7, 3, 25, "Bình"),
    ]
    assert b["Schedules"].filter("ScheduleID = 1").first().AvailableSeats == 343
    assert b["Payments"].filter("PaymentStatus = 'Pending'").count() == 3
    numbers = rows(views.customer_bookings(b).orderBy("BookingID"), "NumberOfTickets")
    assert numbers == [(2,), (2,), (3,)]
    header = listings.booking_headers(b, AS_OF, [1]).first()
    assert header.RefundPercentage == D("90.00")


def test_payment(flow):
    p = flow["p"]
    pay = p["Payments"].filter("PaymentID = 1").first()
    assert (pay.PaymentStatus, pay.TransactionID, pay.Amount) == (
        "Success",
        "VNPay_TXN_001",
        D("1600000.00"),
    )
    assert p["Bookings"].filter("BookingID = 1").first().PaymentStatus == "Paid"
    note = listings.user_notifications(p, [1]).collect()
    assert len(note) == 1 and note[0].BookingCode == "BK2025110500001"
    assert note[0].Message == "Bạn đã thanh toán thành công 1,600,000đ cho mã đặt vé BK2025110500001"
    seats = listings.seat_map(p, 1, 1).collect()
    assert len(seats) == 64
    assert sorted(s.SeatID for s in seats if not s.IsAvailable) == [3, 4, 12, 13, 21, 22, 25]
    assert {s.Price for s in seats} == {D("800000.00")}
    assert views.payment_history(p).count() == 3
    assert listings.user_payments(p, [1]).count() == 1
    assert listings.user_tickets(p, [1]).count() == 2


def test_cancellation(flow):
    c = flow["c"]
    got = c["Bookings"].filter("BookingID = 1").first()
    assert (got.BookingStatus, got.PaymentStatus, got.CancellationReason) == (
        "Cancelled",
        "Refunded",
        "busy",
    )
    assert rows(flow["cancelled"]["refunds"]) == [(1, 1, D("90.00"))]
    assert c["Schedules"].filter("ScheduleID = 1").first().AvailableSeats == 345
    states = rows(c["Tickets"].orderBy("TicketID"), "TicketStatus")
    assert states == [("Cancelled",)] * 2 + [("Valid",)] * 5
    last = c["Notifications"].orderBy(F.desc("NotificationID")).first()
    assert last.Message == "Đặt vé #BK2025110500001 đã được hủy. Hoàn tiền: 90.00%"
    seats = listings.seat_map(c, 1, 1).collect()
    assert len(seats) == 64 and sum(s.IsAvailable for s in seats) == 59


def test_reports_at_payment(flow):
    p, c = flow["p"], flow["c"]
    day = reports.revenue_by_date(p, "2025-10-01", "2025-11-05").first()
    assert (day.TotalBookings, day.TotalTickets) == (3, 7)
    assert (day.TotalRevenue, day.PaidRevenue, day.CancelledRevenue) == (
        D("13600000.00"),
        D("3200000.00"),
        D("0.00"),
    )
    once = reports.revenue_by_date(p, "2025-10-01", "2025-11-05", fanout="once").first()
    assert (once.TotalRevenue, once.PaidRevenue) == (D("5600000.00"), D("1600000.00"))
    later = reports.revenue_by_date(c, "2025-10-01", "2025-11-05").first()
    assert (later.PaidRevenue, later.CancelledRevenue) == (D("0.00"), D("3200000.00"))
    for report in (reports.revenue_by_seat_class, reports.seat_class_analytics):
        (row,) = report(p, "2025-10-01", "2025-11-05").collect()
        assert (row.TicketsSold, row.TotalRevenue, row.AveragePrice, row.PercentageOfTotal) == (
            2,
            D("1600000.00"),
            800000.0,
            D("100.00"),
        )
    for report in (reports.payment_method_statistics, reports.payment_analytics):
        (row,) = report(p, "2025-10-01", "2025-11-05").collect()
        assert (row.PaymentMethod, row.TransactionCount, row.TotalAmount) == (
            "VNPay",
            3,
            D("5600000.00"),
        )
        assert (row.SuccessCount, row.FailedCount, row.SuccessRate) == (1, 0, D("33.33"))


def test_utilisation_and_routes(flow):
    p = flow["p"]
    got = {r.TrainCode: r for r in reports.train_utilization(p, "2025-11-01", "2025-11-30").collect()}
    assert got["SE1"].TotalTrips == 2 and got["SE1"].TotalBookings == 3
    assert got["SE1"].AverageOccupancy == pytest.approx(42.541667, abs=1e-6)
    assert got["SE1"].TotalRevenue == D("1600000.00")
    assert got["SE2"].AverageOccupancy == pytest.approx(41.666667, abs=1e-6)
    assert got["SE3"].AverageOccupancy == got["SE4"].AverageOccupancy == pytest.approx(44.0)
    assert got["TN1"].AverageOccupancy == pytest.approx(45.0)
    assert got["SNT1"].TotalTrips == 0 and got["SNT1"].AverageOccupancy is None
    routes = {
        r.RouteCode: r for r in reports.route_performance(p, "2025-11-01", "2025-11-30").collect()
    }
    sg = routes["HN-SG"]
    assert (sg.TotalSchedules, sg.TotalBookings, sg.TotalTickets) == (3, 3, 7)
    assert sg.TotalRevenue == D("3200000.00")
    assert sg.AverageBookingValue == pytest.approx(1942857.142857)
    assert sg.AverageBasePrice == pytest.approx(805555.555556)
    assert routes["HN-DN"].TotalSchedules == 2 and routes["HN-DN"].AverageBookingValue is None
    assert routes["HN-HUE"].TotalSchedules == 1


def test_segments_listings_and_seat_view(flow):
    p = flow["p"]
    (seg,) = reports.customer_segmentation(p).collect()
    assert (seg.CustomerSegment, seg.CustomerCount, seg.AvgSpent, seg.AvgBookings) == (
        "Regular",
        5,
        320000.0,
        0,
    )
    assert seg.TotalRevenue == D("1600000.00")
    (hanoi,) = listings.list_stations(p, search="Hà Nội").collect()
    assert (hanoi.StationID, hanoi.DepartureRoutes, hanoi.ArrivalRoutes) == (1, 4, 0)
    trains = {r.TrainCode: r for r in listings.list_trains(p, AS_OF).collect()}

    def shown(code):
        r = trains[code]
        return r.ConfiguredCoaches, r.TotalSeats, r.UpcomingSchedules

    assert shown("SE1") == (9, 728, 2)
    assert shown("SE2") == (4, 176, 0)
    assert shown("TN1") == (0, None, 1)
    assert shown("SE3") == (0, None, 0)
    view = views.seat_availability(p)
    assert view.count() == 568
    assert view.filter("SeatStatus = 'Booked'").count() == 7


def test_search_term_ignores_case_but_not_accents(flow):
    users = listings.list_users
    assert users(flow["p"], search="nguyễn").count() == 1
    assert users(flow["p"], search="NGUYỄN VĂN").count() == 1
    # the e-mail address has no accents
    assert {r.UserID for r in users(flow["p"], search="nguyen").collect()} == {1}
    assert users(flow["p"], user_type="Admin").count() == 1


def test_status_roll_is_idempotent(flow):
    p = flow["p"]
    changed = roll_statuses(p, AS_OF)
    assert {r.ScheduleID for r in changed["schedules"].collect()} == {2, 3, 4}
    assert dict(rows(roll_counts(changed))) == {"schedules": 3, "bookings": 0, "tickets": 0}
    again = roll_statuses(apply(p, changed), AS_OF)
    assert dict(rows(roll_counts(again))) == {"schedules": 0, "bookings": 0, "tickets": 0}
