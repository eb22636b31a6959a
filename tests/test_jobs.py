"""Batch jobs on the sample data: edge cases that the large tables do not contain."""

import random
from decimal import Decimal as D

import pytest
from helpers import (
    AS_OF,
    ATTEMPT,
    BOOKING_REQUEST,
    CANCEL,
    FLOW_REQUESTS,
    apply,
    fix,
    frame,
    rows,
    ts,
)
from pyspark.sql import functions as F

from railyard import messages as msg
from railyard.functions import exprs, lookups
from railyard.operators import booking_jobs, lifecycle_jobs, master_data, payment_jobs, quality
from railyard.plans.outputs import write_together
from railyard.sources.seed import seed_tables

CANCEL_TRIP = "request_id bigint, schedule_id bigint, reason string, admin_id bigint"
DELETE = "request_id bigint, id bigint, admin_id bigint"
ADMIN = 4


@pytest.fixture(scope="module")
def seed(spark):
    t = seed_tables(spark)
    return t.with_frames(Seats=fix(t["Seats"]), Users=fix(t["Users"]))


@pytest.fixture(scope="module")
def booked(spark, seed):
    requests = spark.createDataFrame(FLOW_REQUESTS, BOOKING_REQUEST)
    return apply(seed, booking_jobs.create_bookings(seed, requests, AS_OF))


def reasons(result):
    return {r.request_id: (r.code, r.reason) for r in result["rejects"].collect()}


@pytest.mark.parametrize(
    "hours, percent",
    [(100, 90), (72, 90), (71, 70), (48, 70), (47, 50), (24, 50), (23, 30), (12, 30), (11, 0)]
    + [(0, 0), (-1, None)],
)
def test_refund_boundaries(spark, booked, hours, percent):
    leaves = ts("2025-11-25 19:00:00")
    now = str(leaves - __import__("datetime").timedelta(hours=hours))
    commands = spark.createDataFrame([(1, 2, None, None)], CANCEL)
    looked_up = dict(rows(lookups.refund_percentages(booked, now)))
    assert looked_up[2] == D(percent or 0)
    if percent is None:
        out = booking_jobs.cancel_bookings(booked, commands, now)
        assert reasons(out) == {1: msg.ALREADY_DEPARTED}
    elif percent in (0, 90):
        out = booking_jobs.cancel_bookings(booked, commands, now)
        status = out["bookings"].first().PaymentStatus
        assert status == ("Refunded" if percent else "Pending")
        assert out["refunds"].first().RefundPercentage == D(percent)


def test_cancel_order_rights_and_unknown(spark, booked):
    commands = [
        (5, 1, "later", None),
        (2, 1, "no rights", 1),
        (3, 1, "by admin", ADMIN),
        (4, 77, "unknown", None),
    ]
    out = booking_jobs.cancel_bookings(booked, spark.createDataFrame(commands, CANCEL), AS_OF)
    assert out["bookings"].first().CancellationReason == "by admin"
    assert reasons(out) == {
        2: (None, msg.NO_RIGHTS),
        4: msg.NO_BOOKING_TO_CANCEL,
        5: msg.BOOKING_NOT_ACTIVE,
    }
    again = booking_jobs.cancel_bookings(
        apply(booked, out), spark.createDataFrame([(9, 1, "x", None)], CANCEL), AS_OF
    )
    assert reasons(again) == {9: msg.BOOKING_NOT_ACTIVE}
    assert again["tickets"].isEmpty() and again["notifications"].isEmpty()


def test_seats_of_earlier_cancelled_tickets_are_given_back_too(spark, booked):
    tickets = booked["Tickets"].withColumn(
        "TicketStatus",
        F.when(F.col("TicketID") == 1, "Cancelled").otherwise(F.col("TicketStatus")),
    )
    t = booked.with_frames(Tickets=tickets)
    out = booking_jobs.cancel_bookings(
        t, spark.createDataFrame([(1, 1, "x", None)], CANCEL), AS_OF
    )
    assert out["tickets"].count() == 1
    assert out["schedules"].first().AvailableSeats == 345


def test_cancel_schedule(spark, booked):
    before = apply(
        booked,
        booking_jobs.cancel_bookings(
            booked, spark.createDataFrame([(1, 1, "x", None)], CANCEL), AS_OF
        ),
    )
    commands = [(1, 1, "bão", ADMIN), (2, 1, None, None), (3, 6, "no", 2), (4, 99, "gone", None)]
    out = booking_jobs.cancel_schedules(
        before, spark.createDataFrame(commands, CANCEL_TRIP), AS_OF, cascade=True
    )
    assert {r.ScheduleID for r in out["schedules"].collect()} == {1}
    assert {(r.BookingID, r.CancellationReason) for r in out["bookings"].collect()} == {
        (2, "bão"),
        (3, "bão"),
    }
    # all three bookings are told, and by each of the two commands
    texts = [r.Message for r in out["notifications"].collect()]
    assert sorted(x is None for x in texts) == [False] * 3 + [True] * 3
    assert set(texts) == {"Chuyến tàu SE1 đã bị hủy. Lý do: bão", None}
    assert reasons(out) == {3: (None, msg.NO_RIGHTS)}
    assert out["tickets"].count() == 5
    without = booking_jobs.cancel_schedules(
        before, spark.createDataFrame(commands, CANCEL_TRIP), AS_OF
    )
    assert "tickets" not in without


def pay(spark, t, attempts):
    return payment_jobs.process_payments(t, spark.createDataFrame(attempts, ATTEMPT), AS_OF)


def test_last_attempt_sets_the_payment_and_success_stays(spark, booked):
    out = pay(spark, booked, [(1, 2, "A", "00"), (2, 2, "B", "51"), (3, 88, "C", "00")])
    row = out["payments"].first()
    assert (row.TransactionID, row.PaymentStatus, row.PaymentDate) == ("B", "Failed", None)
    assert out["bookings"].first().PaymentStatus == "Paid"
    assert out["tickets"].count() == 2
    assert reasons(out) == {3: msg.NO_BOOKING_TO_PAY}
    assert out["notifications"].count() == 2


def test_booking_without_payment_logs_the_first_attempt(spark, booked):
    amount = F.when(F.col("BookingID") == 3, D("2400000.99")).otherwise(F.col("TotalAmount"))
    t = booked.with_frames(
        Payments=booked["Payments"].filter("BookingID = 1"),
        Bookings=booked["Bookings"].withColumn("TotalAmount", amount.cast("decimal(10,2)")),
    )
    out = pay(spark, t, [(1, 2, "A", "00"), (5, 3, "X", "00"), (6, 3, "Y", "00"), (7, 3, "Z", "51")])
    assert reasons(out) == {1: msg.NO_PAYMENT, 5: msg.NO_PAYMENT}
    logged = {
        r.BookingID: (r.PaymentID, r.TransactionID, r.PaymentStatus, r.ResponseCode, r.Amount)
        for r in out["new_payments"].collect()
    }
    assert logged == {
        2: (2, "A", "Failed", "99", D("1600000.00")),
        3: (3, "Z", "Failed", "51", D("2400000.00")),
    }
    assert {r.BookingID for r in out["bookings"].collect()} == {3}
    assert out["payments"].isEmpty()


def test_paying_a_cancelled_booking(spark, booked):
    t = booked.with_frames(
        Bookings=booked["Bookings"].withColumn("BookingStatus", F.lit("Cancelled"))
    )
    out = pay(spark, t, [(1, 1, "A", "00")])
    assert reasons(out) == {1: msg.NOT_ACTIVE_TO_PAY}
    assert out["notifications"].isEmpty() and out["new_payments"].isEmpty()


def test_mixed_payment_batch_tells_only_success(spark, booked):
    three = F.array(F.lit("Success"), F.lit("Failed"), F.lit("Pending"))
    states = F.element_at(three, F.col("PaymentID").cast("int"))
    changed = booked["Payments"].withColumn("PaymentStatus", states)
    titles = lambda df: sorted(r.Title for r in df.collect())
    notices = payment_jobs.payment_notices
    assert titles(notices(booked, changed, AS_OF)) == [msg.PAID_TITLE, msg.UNPAID_TITLE]
    assert titles(notices(booked, changed, AS_OF, per_row=False)) == [msg.PAID_TITLE]
    failed = changed.filter("PaymentStatus <> 'Success'")
    assert titles(notices(booked, failed, AS_OF, per_row=False)) == [msg.UNPAID_TITLE]


def test_reminders_are_sent_once(spark, booked):
    paid = booked["Bookings"].withColumn(
        "PaymentStatus", F.when(F.col("BookingID") < 3, "Paid").otherwise("Pending")
    )
    t = booked.with_frames(Bookings=paid)
    # the train leaves at 19:00; hour boundaries count, minutes do not
    for now, n in [
        ("2025-11-24 18:59:00", 0),
        ("2025-11-24 19:30:00", 2),
        ("2025-11-25 17:59:00", 2),
        ("2025-11-25 18:00:00", 0),
    ]:
        assert lifecycle_jobs.departure_reminders(t, now).count() == n, now
    sent = lifecycle_jobs.departure_reminders(t, "2025-11-25 08:00:00")
    row = sent.first()
    assert row.ScheduledFor == ts("2025-11-25 17:00:00")
    assert "SE1" in row.Message and "19:00 25/11/2025" in row.Message
    again = lifecycle_jobs.departure_reminders(
        apply(t, {"notifications": sent}), "2025-11-25 08:00:00"
    )
    assert again.isEmpty()


def test_status_roll_cascades(spark, booked):
    late = "2025-12-01 00:00:00"
    out = lifecycle_jobs.roll_statuses(booked, late)
    assert (out["schedules"].count(), out["bookings"].count(), out["tickets"].count()) == (6, 3, 7)
    done = apply(booked, out)
    assert all(df.isEmpty() for df in lifecycle_jobs.roll_statuses(done, late).values())


def test_schedule_delete_is_all_or_nothing(booked):
    blocked = lifecycle_jobs.delete_schedules(booked, [1, 2])
    assert blocked["schedules"].count() == 6
    assert {r[0] for r in rows(blocked["rejects"])} == {1, 2}
    free = lifecycle_jobs.delete_schedules(booked, [2, 3])
    assert free["schedules"].count() == 4 and free["rejects"].isEmpty()


def test_late_bookings(spark, booked):
    ok, late = booking_jobs.split_late(booked, booked["Bookings"], "2025-11-25 18:10:00")
    assert (ok.count(), late.count()) == (0, 3)
    ok, late = booking_jobs.split_late(booked, booked["Bookings"], "2025-11-25 17:59:00")
    assert (ok.count(), late.count()) == (3, 0)


def test_hours_and_travel_time_count_boundaries(spark):
    df = spark.sql("select timestamp_ntz'2025-01-01 10:59' a, timestamp_ntz'2025-01-01 11:01' b")
    got = df.select(
        exprs.hours_crossed(F.col("a"), F.col("b")),
        exprs.minutes_crossed(F.col("a"), F.col("b")),
        exprs.hours_crossed(F.col("b"), F.col("a")),
        lookups.travel_time(F.col("a"), F.col("b")),
    ).first()
    assert tuple(got) == (1, 2, -1, "1 giờ 2 phút")


def test_week_numbers(spark):
    days = [("2023-01-01", 1), ("2023-01-07", 1), ("2023-01-08", 2), ("2022-12-31", 53)]
    df = spark.createDataFrame(days, "d string, w int").withColumn("d", F.to_date("d"))
    assert all(r.w == r.got for r in df.withColumn("got", exprs.week_of_year(F.col("d"))).collect())


NEW_USER = (
    "request_id bigint, admin_id bigint, FullName string, Email string, PhoneNumber string,"
    " password string, UserType string"
)


def test_new_users(spark, seed):
    new = [
        (1, None, "A", "a@x", "1", "longenough", "Customer"),
        (2, None, "B", "a@x", "2", "longenough", "Customer"),  # e-mail of 1
        (3, None, "C", "c@x", "2", "longenough", "Customer"),  # 2 lost, so its phone is free
        (4, None, "D", "tranthib@email.com", "4", "longenough", "Customer"),
        (5, None, "E", "e@x", "0901234567", "longenough", "Customer"),
        (6, None, "F", "f@x", "6", "short  ", "Customer"),
        (7, ADMIN, "G", "g@x", "7", "short", "Staff"),
        (8, 1, "H", "h@x", "8", "longenough", "Staff"),
        (9, None, "I", "i@x", "9", "longenough", "Driver"),
        (10, None, None, "j@x", "10", "longenough", "Customer"),
    ]
    out = master_data.append_rows(seed, "Users", spark.createDataFrame(new, NEW_USER), AS_OF)
    assert dict(rows(out["ids"])) == {1: 7, 3: 8, 7: 9}
    got = {k: v[1] for k, v in reasons(out).items()}
    assert got == {
        2: "an earlier row of the batch has this key",
        4: msg.EMAIL_EXISTS,
        5: msg.PHONE_EXISTS,
        6: msg.PASSWORD_TOO_SHORT,
        8: msg.NO_RIGHTS,
        9: "UserType is not an allowed value",
        10: "FullName is missing",
    }
    row = out["rows"].filter("UserID = 7").first()
    assert row.IsActive and row.CreatedAt == ts(AS_OF)
    import hashlib

    assert bytes(row.PasswordHash) == hashlib.sha256(b"longenough").digest()


def test_new_master_data(spark, seed):
    stations = spark.createDataFrame(
        [(1, "CT", "Cần Thơ", "Cần Thơ", "Cần Thơ", "Đường 30/4"), (2, "HN", "x", "x", "x", "x")],
        "request_id bigint, StationCode string, StationName string, City string,"
        " Province string, Address string",
    )
    out = master_data.append_rows(seed, "Stations", stations, AS_OF)
    assert rows(out["ids"]) == [(1, 9)] and set(reasons(out)) == {2}
    trains = spark.createDataFrame(
        [(1, ADMIN, "SE10", "Thống Nhất SE10", "SE", 10), (2, 2, "SE11", "x", "SE", 1)]
        + [(3, ADMIN, "SE10", "again", "SE", 1)],
        "request_id bigint, admin_id bigint, TrainCode string, TrainName string,"
        " TrainType string, TotalCoaches int",
    )
    out = master_data.append_rows(seed, "Trains", trains, AS_OF)
    assert rows(out["ids"]) == [(1, 7)] and set(reasons(out)) == {2, 3}
    routes = spark.createDataFrame(
        [(1, ADMIN, "HN-HP", 1, 2, 100, 90), (2, ADMIN, "HN-HN", 1, 1, 1, 1)]
        + [(3, ADMIN, "HN-XX", 1, 55, 1, 1)],
        "request_id bigint, admin_id bigint, RouteCode string, DepartureStationID bigint,"
        " ArrivalStationID bigint, Distance int, EstimatedDuration int",
    )
    out = master_data.append_rows(seed, "Routes", routes, AS_OF)
    assert rows(out["ids"]) == [(1, 7)]
    assert {k: v[1] for k, v in reasons(out).items()} == {
        2: msg.SAME_STATION,
        3: "unknown ArrivalStationID",
    }
    trips = spark.createDataFrame(
        [(1, 1, 1, ts("2025-12-01 19:00"), ts("2025-12-03 03:00"), D(900000))]
        + [(2, 6, 1, ts("2025-12-01 19:00"), ts("2025-12-03 03:00"), D(900000))]
        + [(3, 1, 1, ts("2025-12-01 19:00"), ts("2025-12-01 18:00"), D(900000))],
        "request_id bigint, TrainID bigint, RouteID bigint, DepartureTime timestamp_ntz,"
        " ArrivalTime timestamp_ntz, BasePrice decimal(10,2)",
    )
    out = master_data.append_rows(seed, "Schedules", trips, AS_OF)
    got = rows(out["rows"].orderBy("ScheduleID"), "ScheduleID", "AvailableSeats", "Status")
    assert got == [(7, 364, "Scheduled"), (8, None, "Scheduled")]
    assert set(reasons(out)) == {3}


def test_updates(spark, seed):
    changes = spark.createDataFrame(
        [(1, 2, "First", None, "x", ADMIN), (2, 2, "Last", None, "y", ADMIN)]
        + [(3, 1, "No", None, "z", 1), (4, 99, "Nobody", None, "w", ADMIN)],
        "request_id bigint, UserID bigint, FullName string, Email string, PhoneNumber string,"
        " admin_id bigint",
    )
    out = master_data.update_rows(seed, "Users", changes)
    users = {r.UserID: (r.FullName, r.Email, r.UserType) for r in out["rows"].collect()}
    assert len(users) == 6
    assert users[2] == ("Last", None, "Customer")
    assert users[1][0] == "Nguyễn Văn An"
    assert dict(rows(out["affected"])) == {1: 1, 2: 1, 4: 0}
    assert set(reasons(out)) == {3}


def test_updates_keep_the_rules(spark, seed):
    users = {r.UserID: r for r in seed["Users"].collect()}
    mail = {i: u.Email for i, u in users.items()}
    changes = spark.createDataFrame(
        [(1, 2, None, None, "1"), (2, 2, "x" * 101, None, "2"), (3, 2, "Takes another's", mail[1], "3"),
         (4, 3, "New address", "new@x.vn", "4"), (5, 2, "The same one", "new@x.vn", "5"),
         (6, 3, "Keeps it", "new@x.vn", "6"), (7, 1, "Own address", mail[1], "7"), (8, 99, None, None, None),
         (9, 2, "Good", None, "9"), (10, 2, None, None, "10")],
        "request_id bigint, UserID bigint, FullName string, Email string, PhoneNumber string",
    )
    out = master_data.update_rows(seed, "Users", changes)
    late = "an earlier change of the batch has this key"
    assert {k: v[1] for k, v in reasons(out).items()} == {
        1: "FullName is missing", 2: "FullName is too long", 3: msg.EMAIL_EXISTS, 5: late,
        10: "FullName is missing",
    }
    assert dict(rows(out["affected"])) == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 1, 7: 1, 8: 0, 9: 1, 10: 0}
    new = {r.UserID: (r.FullName, r.Email, r.PhoneNumber) for r in out["rows"].collect()}
    assert new[1] == ("Own address", mail[1], "7") and new[2] == ("Good", None, "9")
    assert new[3] == ("Keeps it", "new@x.vn", "6")
    assert quality.violations(seed.with_frames(Users=out["rows"]), tables=["Users"]).isEmpty()


def test_a_refused_change_blocks_no_other(spark, seed):
    changes = spark.createDataFrame(
        [(1, 1, "A", "x@x.vn", "1"), (2, 2, "B", "x@x.vn", "09"), (3, 3, "C", "c@x.vn", "09")],
        "request_id bigint, UserID bigint, FullName string, Email string, PhoneNumber string",
    )
    out = master_data.update_rows(seed, "Users", changes)
    assert set(reasons(out)) == {2}
    assert {r.UserID: r.PhoneNumber for r in out["rows"].collect()}[3] == "09"


def one_by_one(users, changes):
    """(refused requests, users) after applying the changes in order."""
    users, refused = {k: list(v) for k, v in users.items()}, set()
    for request, key, mail, phone in sorted(changes):
        taken = any(k != key and ((mail and v[0] == mail) or (phone and v[1] == phone)) for k, v in users.items())
        if key not in users:
            continue
        if taken:
            refused.add(request)
        else:
            users[key] = [mail, phone]
    return refused, users


@pytest.mark.parametrize("seed_of", range(3))
def test_changes_apply_one_by_one(spark, seed, seed_of):
    rng = random.Random(seed_of)
    first = {r.UserID: (r.Email, r.PhoneNumber) for r in seed["Users"].collect()}
    mails = [m for m, _ in first.values()] + [f"m{i}@x.vn" for i in range(4)] + [None]
    phones = [p for _, p in first.values()] + [str(i) for i in range(6)]
    made = [(r, rng.choice([*first, 99]), rng.choice(mails), rng.choice(phones)) for r in range(1, 120)]
    changes = spark.createDataFrame(made, "request_id bigint, UserID bigint, Email string, PhoneNumber string")
    out = master_data.update_rows(seed, "Users", changes.repartition(3))
    refused, users = one_by_one(first, made)
    assert set(reasons(out)) == refused and refused
    assert {r.UserID: [r.Email, r.PhoneNumber] for r in out["rows"].collect()} == users


def test_a_value_held_twice_refuses_once(spark, seed):
    held = seed["Users"].unionByName(seed["Users"].filter("UserID = 1").withColumn("UserID", F.lit(77).cast("bigint")))
    user = held.filter("UserID = 1").first()
    asked = spark.createDataFrame(
        [(1, "Again", user.Email, "0", "password1")],
        "request_id bigint, FullName string, Email string, PhoneNumber string, password string",
    )
    out = master_data.append_rows(seed.with_frames(Users=held), "Users", asked, AS_OF)
    assert rows(out["rejects"], "request_id", "reason") == [(1, msg.EMAIL_EXISTS)]


def test_soft_deletes(spark, booked):
    def delete(table, commands, now=AS_OF):
        return master_data.soft_delete(booked, table, spark.createDataFrame(commands, DELETE), now)

    out = delete("Users", [(1, 1, ADMIN), (2, 5, ADMIN), (3, 6, 2), (4, 2, None), (5, None, ADMIN)])
    assert {r.UserID for r in out["rows"].collect()} == {5, 2}
    assert {k: v[1] for k, v in reasons(out).items()} == {1: msg.USER_HAS_BOOKINGS, 3: msg.NO_RIGHTS}
    out = delete("Stations", [(1, 1, ADMIN), (2, 2, ADMIN), (3, 7, None)])
    assert {(r.StationID, r.IsActive) for r in out["rows"].collect()} == {(2, False)}
    assert {k: v[1] for k, v in reasons(out).items()} == {1: msg.STATION_IN_ROUTES, 3: msg.NO_RIGHTS}
    out = delete("Trains", [(1, 1, ADMIN), (2, 2, ADMIN)])
    assert {r.TrainID for r in out["rows"].collect()} == {2}
    assert reasons(out)[1][1] == msg.TRAIN_HAS_SCHEDULES


def test_seats_of_small_and_large_coaches(spark):
    coaches = frame(spark, "Coaches", [(1, 1, 1, 1, 64), (2, 1, 2, 1, 4), (3, 1, 3, 1, 120)])
    seats = lifecycle_jobs.generate_seats(coaches)
    small = rows(seats.filter("CoachID = 2").orderBy("SeatNumber"), "SeatNumber", "SeatType")
    assert small == [("01", "Lower"), ("02", "Middle"), ("03", "Upper"), ("04", "Lower")]
    assert seats.filter("CoachID = 3").select("SeatNumber").distinct().count() == 120


def test_admins_must_be_active(spark, seed):
    users = seed["Users"].withColumn("IsActive", F.col("UserID") != ADMIN)
    t = seed.with_frames(Users=users)
    commands = spark.createDataFrame([(1, ADMIN), (2, None)], "request_id bigint, admin_id bigint")
    may, may_not = lookups.split_authorised(t, commands)
    assert rows(may, "request_id") == [(2,)] and rows(may_not, "request_id") == [(1,)]


def test_a_job_runs_once_for_all_outputs(spark, booked):
    """One write gives what the outputs give one by one, with their counts."""
    commands = [(1, 1, "ill", None), (2, 1, "late", None), (3, 99, "none", None)]
    out = booking_jobs.cancel_bookings(booked, spark.createDataFrame(commands, CANCEL), AS_OF)
    frames, counts = write_together(out)
    assert set(frames) == set(out)
    for name, df in out.items():
        assert frames[name].schema.simpleString() == df.schema.simpleString(), name
        assert sorted(map(str, rows(frames[name]))) == sorted(map(str, rows(df))), name
        assert counts[name] == df.count(), name
    assert (counts["bookings"], counts["rejects"]) == (1, 2)
    nothing = booking_jobs.cancel_bookings(booked, spark.createDataFrame([], CANCEL), AS_OF)
    frames, counts = write_together(nothing)
    assert not any(counts.values()) and all(df.isEmpty() for df in frames.values())
