"""Constraint checks, the store, streams and the shape of the plans."""

import datetime as dt
import os
import re
import subprocess
import sys
import types
import uuid

import pytest
from helpers import AS_OF, BOOKING_REQUEST, FLOW_REQUESTS, apply, fix, rows
from pyspark.sql import functions as F

from railyard.catalog import all_queries
from railyard.functions import lookups
from railyard.operators import booking_jobs, lifecycle_jobs, payment_jobs, quality, reports, timelines, views
from railyard.plans.checkpoints import scratch_dir
from railyard.sources import star as star_source
from railyard.sources import store
from railyard.sources.seed import seed_tables
from railyard.sources.star import star_tables
from railyard.streaming import jobs as streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def booked(spark):
    t = seed_tables(spark)
    t = t.with_frames(Seats=fix(t["Seats"]), Users=fix(t["Users"]))
    requests = spark.createDataFrame(FLOW_REQUESTS, BOOKING_REQUEST)
    return apply(t, booking_jobs.create_bookings(t, requests, AS_OF))


def test_clean_data_has_no_violations(booked):
    assert quality.violations(booked).isEmpty()
    assert all(r.Violations == 0 for r in quality.summary(booked).collect())


def test_every_kind_of_violation_is_found(booked):
    users = booked["Users"]
    bad_user = (
        users.filter("UserID = 1")
        .withColumn("UserType", F.lit("Driver"))
        .withColumn("FullName", F.lit(None).cast("string"))
        .withColumn("Email", F.repeat(F.lit("x"), F.lit(101)))
        .withColumn("PhoneNumber", F.lit("1"))
    )
    routes = booked["Routes"].withColumn(
        "ArrivalStationID", F.when(F.col("RouteID") == 1, 1).otherwise(F.col("ArrivalStationID"))
    )
    seats = booked["Seats"].withColumn(
        "SeatNumber", F.when(F.col("SeatID") == 2, "01").otherwise(F.col("SeatNumber"))
    )
    tickets = booked["Tickets"].withColumn(
        "SeatID", F.when(F.col("TicketID") == 1, 999).otherwise(F.col("SeatID"))
    )
    trips = booked["Schedules"].withColumn(
        "ArrivalTime",
        F.when(F.col("ScheduleID") == 2, F.col("DepartureTime")).otherwise(F.col("ArrivalTime")),
    )
    t = booked.with_frames(
        Users=users.unionByName(bad_user), Routes=routes, Seats=seats, Tickets=tickets, Schedules=trips
    )
    found = {(r.TableName, r.Rule, r.KeyValue) for r in quality.violations(t).collect()}
    assert found == {
        ("Users", "unique UserID", "1"),
        ("Users", "domain UserType", "1"),
        ("Users", "required FullName", "1"),
        ("Users", "length Email", "1"),
        ("Routes", "different stations", "1"),
        ("Seats", "unique CoachID, SeatNumber", "1|01"),
        ("Tickets", "foreign SeatID", "1"),
        ("Schedules", "arrival after departure", "2"),
    }


def test_double_booked_seats(booked):
    more = booked["Tickets"].filter("TicketID = 1").withColumn("TicketID", F.lit(99))
    t = booked.with_frames(Tickets=booked["Tickets"].unionByName(more.select(*booked["Tickets"].columns)))
    assert rows(booking_jobs.double_booked_seats(t)) == [(1, 3, 2)]


def test_long_repeats_use_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(views, "_CHUNK", 4)
    df = spark.createDataFrame([("a", 9), ("b", 4), ("c", 0), ("d", 1)], "k string, n bigint")
    got = dict(rows(views._repeat(df, "n").groupBy("k").count()))
    assert got == {"a": 9, "b": 4, "d": 1}


def test_store_publishes_versions(spark, booked):
    root = scratch_dir(spark, "store")
    store.create_store(root, booked)
    t = store.read_store(spark, root)
    assert t["Tickets"].count() == 7 and t.bounds["Stations"] == 8
    changed = lifecycle_jobs.roll_statuses(t, "2025-12-01 00:00:00")
    states = apply(t, changed)
    version = store.replace_tables(
        spark, root, {n: states[n] for n in ("Schedules", "Bookings", "Tickets")}
    )
    notes = payment_jobs.payment_notices(
        t, t["Payments"].withColumn("PaymentStatus", F.lit("Success")), AS_OF
    )
    new = store.with_ids(t, "Notifications", notes, "BookingID")
    assert store.append_tables(spark, root, {"Notifications": new}) == version + 1
    again = store.with_ids(store.read_store(spark, root), "Notifications", notes, "BookingID")
    store.append_tables(spark, root, {"Notifications": again})
    now = store.read_store(spark, root)
    assert {r.BookingStatus for r in now["Bookings"].collect()} == {"Completed"}
    ids = sorted(r[0] for r in rows(now["Notifications"], "NotificationID"))
    assert ids == [1, 2, 3, 4, 5, 6]
    # a reader of the old tables still finds its files
    assert {r.BookingStatus for r in t["Bookings"].collect()} == {"Active"}


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return plan(df).split("== Physical Plan ==")[1]


def test_date_range_and_columns_reach_the_scan(spark, booked):
    root = scratch_dir(spark, "store")
    store.create_store(root, booked)
    t = store.read_store(spark, root)
    text = physical(reports.bookings_by_hour(t, "2025-11-01", "2025-11-05"))
    assert "GreaterThanOrEqual(BookingDate" in text and "LessThan(BookingDate" in text
    assert re.search(r"ReadSchema: struct<BookingDate:timestamp_ntz,TotalAmount:decimal\(10,2\)>", text)


def test_bucketed_tables_join_without_a_shuffle(spark, booked):
    db = "b" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db}")
    store.save_bucketed(booked, db, 4)
    t = booked.with_frames(
        Bookings=spark.table(f"{db}.bookings"), Tickets=spark.table(f"{db}.tickets")
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from railyard.plans.joins import booking_facts

        text = physical(booking_facts(t, t["Bookings"]))
        assert "SortMergeJoin" in text and "Exchange" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="star files are not here")
def test_no_python_and_no_products_in_queries(spark):
    # a join on a literal key: one schedule or one class is looked up
    by_literal = ("l13_search_trips_by_class", "l14_seat_map", "l14_seat_map_of_coach")
    lazy = [n for n in all_queries() if not n.startswith(("m01", "m07", "s0"))]
    for name in lazy:
        text = physical(all_queries()[name](spark, SF))
        assert "CartesianProduct" not in text, name
        assert not re.search(r"InPandas|PythonUDF|EvalPython", text), name
        if "BroadcastNestedLoopJoin" in text and name not in by_literal:
            # the refund policies are the only range join
            assert "HoursBeforeDeparture" in text, name


def test_date_ranges_reach_the_files(spark):
    """Narrow reports prune orders in the scan and tickets before they are counted."""
    for name in ("q06a_revenue_summary", "q06c_revenue_summary_by_method", "q07b_dashboard_days",
                 "q16a_monthly_revenue", "q16b_monthly_top_routes"):
        text = physical(all_queries()[name](spark, SF))
        assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", text), name
    for name in ("q06a_revenue_summary", "q11_route_performance", "l14_seat_map_of_coach"):
        assert "LeftSemi" in physical(all_queries()[name](spark, SF)), name


def test_sign_ups_are_settled_without_python(spark):
    text = physical(all_queries()["m07_users"](spark, SF))
    assert not re.search(r"InPandas|PythonUDF|EvalPython", text)


def parts(spark, df, n, tmp):
    """Stream of n files, one per micro-batch, in key order."""
    path = f"{tmp}/in"
    for i in range(n):
        df.filter(F.col("_part") == i).drop("_part").coalesce(1).write.mode("append").parquet(path)
    schema = df.drop("_part").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_booking_stream_equals_batch(spark, booked):
    requests = []
    for i in range(10, 40):
        seats = sorted({30 + i % 5, 30 + i % 7})
        names = ",".join("x" for _ in seats)
        trip = 1 if i % 4 else 6
        requests.append((i, 1 + i % 3, trip, ",".join(map(str, seats)), names, "Visa"))
    df = spark.createDataFrame(requests, BOOKING_REQUEST)
    batch = booking_jobs.create_bookings(booked, df, AS_OF)
    tmp = scratch_dir(spark, "test")
    source = parts(spark, df.withColumn("_part", F.when(F.col("request_id") < 25, 0).otherwise(1)), 2, tmp)
    streams.booking_request_stream(booked, source, f"{tmp}/out", f"{tmp}/chk", AS_OF).awaitTermination()

    def seats(tickets, bookings):
        return set(rows(tickets.join(bookings, "BookingID"), "ScheduleID", "SeatID", "UserID", "BookingID"))

    streamed = {
        p: streams.read_results(spark, f"{tmp}/out", p, booked[p.capitalize()].schema)
        for p in ("bookings", "tickets", "payments")
    }
    assert seats(streamed["tickets"], streamed["bookings"]) == seats(batch["tickets"], batch["bookings"])
    for p in ("bookings", "payments"):
        assert sorted(map(str, rows(streamed[p]))) == sorted(map(str, rows(batch[p])))
    refused = streams.read_results(
        spark, f"{tmp}/out", "rejects", "request_id bigint, code int, reason string"
    )
    assert set(rows(refused)) == set(rows(batch["rejects"]))


def test_reminder_stream_sends_once(spark, booked):
    paid = booked["Bookings"].withColumn("PaymentStatus", F.lit("Paid"))
    t = booked.with_frames(Bookings=paid)
    now = "2025-11-25 08:00:00"
    twice = paid.withColumn("_part", F.lit(0)).unionByName(paid.withColumn("_part", F.lit(1)))
    tmp = scratch_dir(spark, "test")
    source = parts(spark, twice, 2, tmp)
    streams.reminder_stream(t, source, f"{tmp}/out", f"{tmp}/chk", now).awaitTermination()
    expected = lifecycle_jobs.departure_reminders(t, now)
    got = streams.read_results(spark, f"{tmp}/out", "notifications", expected.schema)
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected)))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_payment_stream_does_not_depend_on_the_cut(spark, booked, n):
    state = F.when(F.col("PaymentID") == 1, "Success").otherwise("Failed")
    changed = booked["Payments"].withColumn("PaymentStatus", state)
    tmp = scratch_dir(spark, "test")
    source = parts(spark, changed.withColumn("_part", (F.col("PaymentID") % n).cast("int")), n, tmp)
    streams.payment_notice_stream(booked, source, f"{tmp}/out", f"{tmp}/chk", AS_OF).awaitTermination()
    expected = payment_jobs.payment_notices(booked, changed, AS_OF)
    got = streams.read_results(spark, f"{tmp}/out", "notifications", expected.schema)
    assert sorted(map(str, rows(got))) == sorted(map(str, rows(expected)))
    assert {r.BookingID for r in got.collect()} == {1, 2, 3}


@pytest.mark.parametrize("order", [(0, 1, 2, 3, 4), (4, 2, 0, 3, 1)])
def test_first_claims_in_any_order(spark, booked, order):
    """Five micro-batches years apart: nothing is lost, no seat is given twice."""
    made = [
        (1, 7, 14, "2025-01-01 10:00"), (1, 7, 2, "2025-01-01 10:00"), (1, 8, 3, "1995-01-01 12:00"),
        (1, 7, 4, "2025-06-01 10:00"), (1, 8, 5, "2025-02-01 10:00"), (99, 1, 6, "2020-01-01 10:00"),
        (1, 9, 8, "2099-01-01 10:00"), (1, 9, 9, "2025-03-01 10:00"),
    ]
    claims = spark.createDataFrame(
        [(s, p, b, dt.datetime.fromisoformat(at), order[i % 5]) for i, (s, p, b, at) in enumerate(made)],
        "ScheduleID bigint, SeatID bigint, BookingID bigint, ClaimedAt timestamp_ntz, _part int",
    )
    tmp = scratch_dir(spark, "test")
    source = parts(spark, claims, 5, tmp)
    for query in streams.first_claim_stream(booked, source, f"{tmp}/out", f"{tmp}/chk"):
        query.awaitTermination()
    got = streams.read_first_claims(spark, f"{tmp}/out")
    assert set(rows(got, "ScheduleID", "SeatID", "BookingID")) == {(1, 7, 2), (1, 8, 3), (1, 9, 9)}
    refused = streams.read_results(
        spark, f"{tmp}/out", "claim_rejects", "BookingID bigint, code int, reason string"
    )
    assert {r.BookingID for r in refused.collect()} == {6, 8}


def state_rows(query):
    return sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])


def test_claims_are_forgotten_after_departure(spark, booked):
    """By the clock of arrivals the trip leaves between the micro-batches: its state goes, and a
    claim that comes later is refused, even if it is the least."""
    later = F.col("DepartureTime") + F.make_dt_interval(F.lit(15))
    trips = booked["Schedules"].withColumn("DepartureTime", F.when(F.col("ScheduleID") == 6, later).otherwise(F.col("DepartureTime")))
    booked = booked.with_frames(Schedules=trips)
    leaves, hour = trips.filter("ScheduleID = 1").first().DepartureTime, dt.timedelta(hours=1)
    other = 6
    made = [  # seat, booking, claimed and arrived before departure, trip
        (1, 7, 20, leaves - 9 * hour, leaves - 9 * hour, 0), (1, 7, 21, leaves - 8 * hour, leaves - 8 * hour, 0),
        (other, 3, 22, leaves - 8 * hour, leaves - 8 * hour, 0), (other, 4, 23, leaves - 8 * hour, leaves + 5 * hour, 1),
        (1, 7, 24, leaves - 10 * hour, leaves + 6 * hour, 2), (other, 3, 25, leaves - 9 * hour, leaves + 6 * hour, 2),
    ]
    claims = spark.createDataFrame(
        made,
        "ScheduleID bigint, SeatID bigint, BookingID bigint, ClaimedAt timestamp_ntz, ArrivedAt timestamp_ntz, _part int",
    )
    tmp = scratch_dir(spark, "test")
    started = streams.first_claim_stream(booked, parts(spark, claims, 3, tmp), f"{tmp}/out", f"{tmp}/chk", "ArrivedAt")
    for query in started:
        query.awaitTermination()
    got = streams.read_first_claims(spark, f"{tmp}/out")
    assert set(rows(got, "ScheduleID", "SeatID", "BookingID")) == {(1, 7, 20), (other, 3, 25), (other, 4, 23)}
    assert [r.BookingID for r in streams.read_claim_rejects(spark, f"{tmp}/out").collect()] == [24]
    assert state_rows(started[0]) == 2  # the two seats of the trip that is yet to leave


def test_reminders_wait_for_their_time(spark, booked):
    """Bookings that come days early are told once, when due; cancelled and late ones never."""
    trip = booked["Schedules"].filter("ScheduleID = 1").first()
    leaves, hour = trip.DepartureTime, dt.timedelta(hours=1)
    opens = leaves.replace(minute=0, second=0) - 24 * hour
    made = [  # booking, status, payment, arrives, micro-batch
        (101, "Active", "Paid", leaves - 72 * hour, 0), (102, "Active", "Paid", leaves - 71 * hour, 0),
        (103, "Active", "Pending", leaves - 71 * hour, 0), (104, "Active", "Paid", leaves - 72 * hour, 0),
        (102, "Cancelled", "Paid", leaves - 50 * hour, 1), (103, "Active", "Paid", leaves - 50 * hour, 1),
        (101, "Active", "Paid", leaves - 49 * hour, 1), (105, "Active", "Paid", leaves - 12 * hour, 2),
        (101, "Active", "Paid", leaves - 11 * hour, 3), (106, "Active", "Paid", leaves - 0.5 * hour, 4),
        (107, "Active", "Paid", leaves + 9 * hour, 5),
    ]
    df = spark.createDataFrame(
        [(b, 1, 1, s, p, at, i) for b, s, p, at, i in made],
        "BookingID bigint, UserID bigint, ScheduleID bigint, BookingStatus string, PaymentStatus string, ArrivedAt timestamp_ntz, _part int",
    )
    tmp = scratch_dir(spark, "test")
    query = streams.reminder_stream(
        booked, parts(spark, df, 6, tmp), f"{tmp}/out", f"{tmp}/chk", AS_OF, "ArrivedAt", "10 minutes"
    )
    query.awaitTermination()
    schema = lifecycle_jobs.departure_reminders(booked, AS_OF).schema
    got = streams.read_results(spark, f"{tmp}/out", "notifications", schema)
    assert sorted(rows(got, "BookingID", "SentAt", "ScheduledFor")) == [
        (101, opens, leaves - 2 * hour), (103, opens, leaves - 2 * hour), (104, opens, leaves - 2 * hour),
        (105, leaves - 12 * hour, leaves - 2 * hour),
    ]
    assert state_rows(query) == 0


def test_latest_bookings_read_the_latest_slice(spark, booked):
    """Ten rows come from the last days; too few of them bring in all bookings."""
    text = physical(reports.dashboard_latest(star_tables(spark, SF), "2001-01-01"))
    pushed = re.findall(r"GreaterThanOrEqual\(o_orderdate,(\d{4}-\d\d)", text)
    assert pushed and all(day > "1998" for day in pushed)
    every = rows(reports.dashboard_latest(booked))
    assert len(every) == booked["Bookings"].count() == 3
    for as_of in ("2025-11-06", "2030-01-01", "1990-01-01"):
        assert rows(reports.dashboard_latest(booked, as_of)) == every
        assert rows(reports.dashboard_latest(booked, as_of, 2)) == every[:2]


def test_queries_are_named_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) > 150"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)


def test_reminders_are_settled_without_python(spark):
    """Random arrivals in two micro-batches against the rule applied row by row."""
    import random

    from railyard.streaming import timed

    hour, dice = timed.HOUR, random.Random(5)
    made = sorted(
        (dice.randrange(400) * hour // 2 + i, dice.randrange(25), dice.randrange(60, 220) * hour + 7, dice.random() < 0.8)
        for i in range(150)
    )
    batches, clocks = (made[:80], made[80:]), []
    waiting, got = spark.createDataFrame([], timed.WAITING), []
    state, expected, before = {}, [], -(1 << 62)
    for batch in batches:
        clock = batch[-1][0] - hour
        clocks.append((before, clock))
        df = spark.createDataFrame(
            [(b, b, f"T{at}", leaves, at, ok) for at, b, leaves, ok in dice.sample(batch, len(batch))],
            "BookingID bigint, user bigint, train string, leaves bigint, arrives bigint, wanted boolean",
        )
        settled = timed.settle_reminders(waiting, df, before, clock)
        assert "Python" not in physical(settled) and "Pandas" not in physical(settled)
        out = settled.collect()
        got += [(r.BookingID, x.train, x.leaves, x.told) for r in out for x in r.told]
        kept = [(r.BookingID, r.user, r.train, r.leaves, r.done) for r in out if r.leaves is not None]
        waiting = spark.createDataFrame(kept, timed.WAITING)

        def due(b, now):
            if b in state and not state[b][2] and state[b][1] // hour * hour - 24 * hour <= now:
                train, leaves, _ = state[b]
                expected.append((b, train, leaves, leaves // hour * hour - 24 * hour))
                state[b] = (train, leaves, True)

        for at, b, leaves, ok in batch:
            opens, past = leaves // hour * hour - 24 * hour, leaves // hour * hour - hour
            now = max(at, before)
            if at < before or at >= past:
                continue
            due(b, now)
            if b in state and state[b][2]:
                continue
            state.pop(b, None)
            if ok and now < past:
                state[b] = (f"T{at}", leaves, now >= opens)
                if now >= opens:
                    expected.append((b, f"T{at}", leaves, now))
        for b in list(state):
            due(b, clock)
            if state[b][1] // hour * hour - hour <= clock:
                del state[b]
        assert {k[0] for k in kept} == set(state)
        before = clock
    assert len(expected) > 20 and sorted(got) == sorted(expected)


def test_key_checks_deal_rows_by_their_number(spark, booked, monkeypatch):
    """Keys and references go to as many tasks as there are rows for, and what is found stays."""
    monkeypatch.setattr(quality, "ROWS_OF_A_TASK", 2)
    more = booked["Tickets"].withColumn("BookingID", F.when(F.col("SeatID") == 3, 999).otherwise(F.col("BookingID")))
    twice = booked["Bookings"].unionByName(booked["Bookings"].filter("BookingID = 1"))
    t = booked.with_frames(Tickets=more, Bookings=twice)
    lost = {r.KeyValue for r in more.filter("SeatID = 3").withColumn("KeyValue", F.col("TicketID").cast("string")).collect()}
    found = quality.violations(t, ("foreign",), ("Tickets",))
    assert lost and {(r.Rule, r.KeyValue, r.Detail) for r in found.collect()} == {("foreign BookingID", k, "999") for k in lost}
    again = quality.violations(t, ("keys",), ("Bookings",))
    assert ("unique BookingID", "1", "2") in {(r.Rule, r.KeyValue, r.Detail) for r in again.collect()}
    assert re.search(r"hashpartitioning\(BookingID#\d+L?, 2\), REPARTITION_BY_NUM", physical(again))


@pytest.mark.skipif(not __import__("os").path.isdir(SF), reason="star files are not here")
def test_ticket_listings_shuffle_no_texts_of_trips(spark):
    """Station and train names are joined after the last shuffle, by broadcast, and sorting adds none."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, keys in (
            ("v03_ticket_details", ["BookingID", "SeatID"]),
            ("l09_user_tickets", ["DepartureTime", "BookingID", "SeatID"]),
        ):
            text = physical(all_queries()[name](spark, SF))
            found = re.findall(r"Exchange (?:hash|range)partitioning\((\w+)#", text)
            assert found[: len(keys)] == keys and found.count("DepartureTime") == len(keys) - 2, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.skipif(not os.path.isdir(SF), reason="star files are not here")
def test_ticket_prices_shuffle_no_texts_of_tickets(spark):
    """A TicketID is made after the last shuffle, of numbers; a table without them keeps its own."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prices = all_queries()["f01_ticket_price"](spark, SF)
        text = physical(prices)
        assert text.count("concat_ws") == 1 and text.index("concat_ws") < text.index("Exchange hashpartitioning")
        t = star_tables(spark, SF)
        named = t.with_frames(Tickets=t["Tickets"])
        assert named.in_parts("Tickets", "TicketID")[0] is named["Tickets"]
        plain = lookups.ticket_prices(named)
        assert sorted(rows(prices)) == sorted(rows(plain)) and not prices.isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.skipif(not os.path.isdir(SF), reason="star files are not here")
def test_ticket_listings_join_numbers_of_tickets(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("v03_ticket_details", "l12b_booking_tickets", "l09_user_tickets"):
            text = physical(all_queries()[name](spark, SF))
            assert text.index("concat_ws(-") < text.index("Exchange hashpartitioning"), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_parts_of_a_ticket_give_its_text_even_if_one_is_missing(spark):
    asked = "1 l_orderkey, 2 l_partkey, 3 l_suppkey, 4 l_linenumber, timestamp_ntz'1999-12-31 23:59:59' l_shipdate"
    line = spark.range(1).selectExpr(*asked.split(", "))
    whole = {"1-4-2-3-19991231"}
    for lost, text in ((None, whole), ("l_linenumber", {"1-2-3-19991231"}), ("l_shipdate", {"1-4-2-3"})):
        some = line.withColumn(lost, F.lit(None)) if lost else line
        star = types.SimpleNamespace(lineitem=some.withColumns({
            c: F.lit(None).cast("string") for c in ("l_returnflag", "l_linestatus", "l_extendedprice")
        }))
        made = star_source._ticket_parts(star).select(star_source._ticket_id().alias("TicketID"))
        assert {r[0] for r in made.collect()} == {r[0] for r in star_source._tickets(star).select("TicketID").collect()} == text


def test_changes_that_free_nothing_stay_out_of_the_ordered_pass(spark):
    start = [(1, ["0a", "1p"]), (2, ["0b", "1q"])]
    asked = [(10, 1, ["0n10", "1n10"])]  # frees p
    asked += [(20, 2, ["0n20", "1p"])]  # takes it
    asked += [(r, 2, [f"0n{r}", f"1n{r}"]) for r in range(21, 60)]  # the first of these frees it
    asked += [(70, 1, ["0n70", "1p"]), (71, 2, ["0n71", "1p"])]  # taken again, refused
    changes = spark.createDataFrame(asked, "request_id bigint, key bigint, items array<string>")
    holders = spark.createDataFrame(start, "key bigint, items array<string>")
    ordered = timelines._in_question(changes, holders).select("request_id").collect()
    assert sorted(r[0] for r in ordered) == [timelines.START, 10, 20, 21, 70, 71]
    got = timelines.refused_changes(changes, holders).collect()
    assert [tuple(r) for r in got] == [(71, "1p", False)]
