"""Named queries over the star files: one entry per operator and result set."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as SF

from .functions import lookups as F
from .operators import booking_jobs as B
from .operators import lifecycle_jobs as C
from .operators import listings as L
from .operators import master_data as D
from .operators import payment_jobs as P
from .operators import quality as Q
from .operators import reports as R
from .operators import views as V
from .operators.notices import NOTICE_COLUMNS
from .plans.checkpoints import scratch_dir, shared_dir
from .plans.tables import Tables
from .sources import commands as K
from .sources import partitioned as W
from .sources.star import AS_OF, star_tables, stream_star, stream_table
from .streaming import jobs as S

START, END = "1995-01-01", "2001-12-31"
YEAR, MONTH = 1998, 3
REFUND_AS_OF = JOB_AS_OF = "1998-06-15 09:30:00"
REMIND_AS_OF = "1998-07-18 12:00:00"
# seen from here every trip is still ahead
EARLY = "1990-01-01 00:00:00"
MIDWAY = "1997-01-09 08:30:00"
NOTICE_START, NOTICE_END = "2024-01-01", "2024-01-31"

Query = Callable[[SparkSession, str], DataFrame]


def _on(fn, *args, as_of: str = AS_OF, **kwargs) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_tables(spark, sf_dir, as_of), *args, **kwargs)

    return run


def report_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    for suffix, fanout in (("", "rows"), ("_once", "once")):
        ranged = {"fanout": fanout}
        q["q01_revenue_by_date" + suffix] = _on(R.revenue_by_date, START, END, **ranged)
        q["q02_revenue_by_route" + suffix] = _on(R.revenue_by_route, START, END, **ranged)
        q["q04_top_customers" + suffix] = _on(R.top_customers, AS_OF, 10, **ranged)
        q["q06a_revenue_summary" + suffix] = _on(R.revenue_summary, YEAR, **ranged)
        q["q07a_dashboard_totals" + suffix] = _on(R.dashboard_totals, AS_OF, 30, **ranged)
        for letter, by in (("a", "Day"), ("b", "Week"), ("c", "Month")):
            name = f"q08{letter}_revenue_by_{by.lower()}{suffix}"
            q[name] = _on(R.revenue_analytics, START, END, by, **ranged)
        q["q11_route_performance" + suffix] = _on(R.route_performance, START, END, **ranged)
        q["q16a_monthly_revenue" + suffix] = _on(R.monthly_revenue, YEAR, MONTH, **ranged)
    q["q03_revenue_by_seat_class"] = _on(R.revenue_by_seat_class, START, END)
    q["q05_payment_method_statistics"] = _on(R.payment_method_statistics, START, END)
    q["q06b_revenue_summary_by_route"] = _on(R.revenue_summary_by_route, YEAR)
    q["q06c_revenue_summary_by_method"] = _on(R.revenue_summary_by_method, YEAR)
    q["q07b_dashboard_days"] = _on(R.dashboard_days, AS_OF, 30)
    q["q07c_dashboard_top_routes"] = _on(R.dashboard_top_routes, AS_OF, 30)
    q["q07d_dashboard_latest"] = _on(R.dashboard_latest, AS_OF)
    q["q09_seat_class_analytics"] = _on(R.seat_class_analytics, START, END)
    q["q10_train_utilization"] = _on(R.train_utilization, START, END)
    q["q12_customer_segmentation"] = _on(R.customer_segmentation)
    q["q13_payment_analytics"] = _on(R.payment_analytics, START, END)
    q["q14a_bookings_by_hour"] = _on(R.bookings_by_hour, START, END)
    q["q14b_bookings_by_weekday"] = _on(R.bookings_by_weekday, START, END)
    q["q15_notification_stats"] = _on(R.notification_stats, AS_OF, NOTICE_START, NOTICE_END)
    q["q16b_monthly_top_routes"] = _on(R.monthly_top_routes, YEAR, MONTH)
    q["q16c_monthly_customers"] = _on(R.monthly_customers, YEAR, MONTH)
    return q


def _trips_by_view(t: Tables) -> DataFrame:
    """A query in SQL over the tables as temporary views."""
    t.register_views("rail_")
    return t["Schedules"].sparkSession.sql(
        "SELECT Status, count(*) AS Trips, count(DISTINCT TrainID) AS Trains FROM rail_Schedules"
        " WHERE RouteID IN (SELECT RouteID FROM rail_Routes WHERE IsActive) GROUP BY Status"
    )


def listing_queries() -> dict[str, Query]:
    return {
        "l01_users": _on(L.list_users),
        "l01_users_filtered": _on(L.list_users, "Customer", True, "customer%1"),
        "l02a_user_cards": _on(L.user_cards),
        "l02b_user_bookings": _on(L.user_bookings),
        "l03_stations": _on(L.list_stations),
        "l03_stations_filtered": _on(L.list_stations, True, "nation_1"),
        "l04_trains": _on(L.list_trains, AS_OF),
        "l04_trains_once": _on(L.list_trains, AS_OF, fanout="once"),
        "l04_trains_filtered": _on(L.list_trains, AS_OF, True, "SE"),
        "l05_routes": _on(L.list_routes, AS_OF, True),
        "l06_schedules": _on(L.list_schedules),
        "l07_bookings": _on(L.list_bookings),
        "l07_bookings_filtered": _on(
            L.list_bookings, "Active", "Paid", "1996-01-01", "2000-06-30", "bk199"
        ),
        "l08_user_notifications": _on(L.user_notifications),
        "l09_user_tickets": _on(L.user_tickets),
        "l10_user_payments": _on(L.user_payments),
        "l11_booking_history": _on(L.booking_history),
        "l12a_booking_headers": _on(L.booking_headers, REFUND_AS_OF),
        "l12b_booking_tickets": _on(L.booking_tickets),
        "l12c_booking_payments": _on(L.booking_payments),
        "l13_search_trips": _on(L.search_trips),
        "l13_search_trips_by_class": _on(L.search_trips, seat_class=3),
        "l14_seat_map": _on(L.seat_map, 725),
        "l14_seat_map_of_coach": _on(L.seat_map, 725, 115),
        "v01_available_schedules": _on(V.available_schedules, AS_OF),
        "v02_customer_bookings": _on(V.customer_bookings),
        "v03_ticket_details": _on(V.ticket_details),
        "v04_seat_availability": _on(V.seat_availability),
        "v04_seat_status_counts": _on(V.seat_status_counts),
        "v05_payment_history": _on(V.payment_history),
        "v06_unread_notifications": _on(V.unread_notifications),
        "view_scan": _on(_trips_by_view),
        "f01_price_list": _on(F.price_list),
        "f01_ticket_price": _on(F.ticket_prices),
        "f02_refund_percentage": _on(F.refund_percentages, REFUND_AS_OF),
        "f03_travel_time": _on(F.schedules_with_travel_time),
        "f04_seat_available": _on(lambda t: F.with_seat_available(t, F.seats_asked_for(t))),
        "f05_route_names": _on(F.route_names),
        "f06_admins": _on(F.admin_flags),
    }


def _job(part: str, fn, as_of: str = JOB_AS_OF) -> Query:
    """One named result of a job; ``fn`` is called with (tables, spark, sf_dir)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(star_tables(spark, sf_dir, as_of), spark, sf_dir)[part]

    return run


def _without_hash(df: DataFrame) -> DataFrame:
    return df.drop("PasswordHash")


def _hash_as_text(df: DataFrame) -> DataFrame:
    text = SF.lower(SF.hex("PasswordHash"))
    return df.withColumn("PasswordHex", text).drop("PasswordHash")


def job_queries() -> dict[str, Query]:
    done: dict[tuple, dict[str, DataFrame]] = {}

    def create(t, spark, sf_dir):
        # the results are written tables, so its five outputs need one run
        memo = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir)
        if memo not in done:
            done[memo] = B.create_bookings(t, K.booking_requests(spark, sf_dir), EARLY)
        return done[memo]

    def create_checked(t, spark, sf_dir):
        # seen early every trip is open, by the time of the job half of them have left
        memo = (spark.sparkContext.applicationId, shared_dir(spark), sf_dir, "checked")
        if memo not in done:
            asked = K.mixed_booking_requests(t, spark, sf_dir)
            rules = {"check_train": True, "refuse_late": True, "first_code": 70}
            done[memo] = B.create_bookings(t, asked, MIDWAY, **rules)
        return done[memo]

    def cancel(t, spark, sf_dir):
        return B.cancel_bookings(t, K.cancel_commands(spark, sf_dir), JOB_AS_OF)

    def cancel_trips(t, spark, sf_dir):
        return B.cancel_schedules(t, K.cancel_schedule_commands(t), JOB_AS_OF)

    def pay(t, spark, sf_dir):
        return P.process_payments(t, K.payment_attempts(spark, sf_dir), JOB_AS_OF)

    def roll(t, spark, sf_dir):
        return C.roll_statuses(t, JOB_AS_OF)

    def sign_up(t, spark, sf_dir):
        return D.append_rows(t, "Users", K.new_users(spark, sf_dir), JOB_AS_OF)

    def add_trips(t, spark, sf_dir):
        return D.append_rows(t, "Schedules", K.new_schedules(spark, sf_dir), JOB_AS_OF)

    def append(table: str, rows):
        return lambda t, spark, sf_dir: D.append_rows(t, table, rows(spark, sf_dir), JOB_AS_OF)

    def move_codes(table: str):
        return lambda t, spark, sf_dir: D.update_rows(t, table, K.code_moves(t, table))

    def fix_users(t, spark, sf_dir):
        return D.update_rows(t, "Users", K.user_edits(spark, sf_dir))

    def fix_trips(t, spark, sf_dir):
        return D.update_rows(t, "Schedules", K.schedule_edits(t))

    def cascade(t, spark, sf_dir):
        return B.cancel_schedules(t, K.cancel_schedule_commands(t), JOB_AS_OF, cascade=True)

    def pay_unpaid(t, spark, sf_dir):
        # one of seven payments is taken away
        some = t["Payments"].filter(SF.col("PaymentID") % 7 != 3)
        return pay(t.with_frames(Payments=some), spark, sf_dir)

    def stored(table: str, part, change, as_of: str = JOB_AS_OF, drop: tuple = ()) -> Query:
        """A stored, partitioned table after ``change``, which is called with the tables, the
        session, the folder and the stored table's name; ``part`` gives the partition."""

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = star_tables(spark, sf_dir, as_of)
            name = f"stored_{uuid.uuid4().hex}"
            W.create(t[table].drop(*drop), name, part(), scratch_dir(spark, "table"))
            change(t, spark, sf_dir, name)
            return W.read(spark, name)

        return run

    def add_stored_trips(t, spark, sf_dir, name):
        W.append(name, add_trips(t, spark, sf_dir)["rows"], W.month_of("DepartureTime"))

    def update_stored_users(t, spark, sf_dir, name):
        changed = _without_hash(edit_users(t, spark, sf_dir)["changed"])
        W.update(name, changed, "UserID", W.key_block("UserID"))

    def update_stored_trips(t, spark, sf_dir, name):
        changed = edit_trips(t, spark, sf_dir)["changed"]
        W.update(name, changed, "ScheduleID", W.month_of("DepartureTime"))

    def cancel_stored_bookings(t, spark, sf_dir, name):
        changed = cancel(t, spark, sf_dir)["bookings"]
        W.update(name, changed, "BookingID", W.month_of("BookingDate"))

    def delete_stored_trips(t, spark, sf_dir, name):
        gone = C.delete_schedules(t, free_trips(t))["deleted"]
        W.delete(name, gone, "ScheduleID")

    def edit_users(t, spark, sf_dir):
        return D.update_rows(t, "Users", K.user_changes(spark, sf_dir))

    def edit_trips(t, spark, sf_dir):
        return D.update_rows(t, "Schedules", K.schedule_changes(t))

    def delete(table: str, as_of: str = JOB_AS_OF):
        return lambda t, spark, sf_dir: D.soft_delete(t, table, K.delete_commands(t, table), as_of)

    def free_trips(t):
        active = t["Bookings"].filter(SF.col("BookingStatus") == "Active")
        booked = active.select("ScheduleID").distinct()
        return t["Schedules"].select("ScheduleID").join(booked, "ScheduleID", "left_anti")

    def then(change, query: Query) -> Query:
        return lambda spark, sf_dir: change(query(spark, sf_dir))

    q: dict[str, Query] = {}
    for part in ("bookings", "tickets", "payments", "schedules", "rejects"):
        q[f"m01_{part}"] = _job(part, create, EARLY)
        q[f"m01_checked_{part}"] = _job(part, create_checked, EARLY)
    for part in ("bookings", "refunds", "tickets", "schedules", "notifications", "rejects"):
        q[f"m02_{part}"] = _job(part, cancel)
    for part in ("schedules", "bookings", "notifications", "rejects"):
        q[f"m03_{part}"] = _job(part, cancel_trips)
    for part in ("payments", "bookings", "tickets", "notifications", "rejects"):
        q[f"m04_{part}"] = _job(part, pay)
    q["m05_departure_reminders"] = _on(
        C.departure_reminders, REMIND_AS_OF, as_of=JOB_AS_OF
    )
    for part in ("schedules", "bookings", "tickets"):
        q[f"m06_{part}"] = _job(part, roll, EARLY)
    q["m06_counts"] = _on(lambda t: C.roll_counts(C.roll_statuses(t, JOB_AS_OF)), as_of=EARLY)
    q["m07_users"] = then(_hash_as_text, _job("rows", sign_up))
    q["m07_user_rejects"] = _job("rejects", sign_up)
    q["m07_schedules"] = _job("rows", add_trips)
    q["m07_schedule_rejects"] = _job("rejects", add_trips)
    q["m08_users"] = then(_without_hash, _job("rows", edit_users))
    q["m08_users_affected"] = _job("affected", edit_users)
    q["m08_schedules"] = _job("rows", edit_trips)
    q["m09_users"] = then(_without_hash, _job("rows", delete("Users")))
    q["m09_stations"] = _job("rows", delete("Stations"))
    q["m09_trains"] = _job("rows", delete("Trains", "2001-07-15 00:00:00"), AS_OF)
    q["m10_delete_blocked"] = _job(
        "schedules", lambda t, spark, sf_dir: C.delete_schedules(t, None)
    )
    q["m10_delete_free"] = _job(
        "schedules", lambda t, spark, sf_dir: C.delete_schedules(t, free_trips(t))
    )
    q["m11_payment_notices"] = _on(
        lambda t: P.payment_notices(t, t["Payments"], JOB_AS_OF), as_of=JOB_AS_OF
    )
    q["m11_payment_notices_per_row"] = q["m11_payment_notices"]
    q["m11_payment_notices_statement"] = _on(
        lambda t: P.payment_notices(t, t["Payments"], JOB_AS_OF, per_row=False), as_of=JOB_AS_OF
    )
    q["m03_cascade_tickets"] = _job("tickets", cascade)
    q["m04_new_payments"] = _job("new_payments", pay_unpaid)
    q["m04_unpaid_rejects"] = _job("rejects", pay_unpaid)
    for table, rows in (("Stations", K.new_stations), ("Trains", K.new_trains), ("Routes", K.new_routes)):
        q[f"m07_{table.lower()}"] = _job("rows", append(table, rows))
        q[f"m07_{table.lower()}_rejects"] = _job("rejects", append(table, rows))
    for table in ("Stations", "Trains", "Routes"):
        q[f"m08_{table.lower()}"] = _job("rows", move_codes(table))
        q[f"m08_{table.lower()}_rejects"] = _job("rejects", move_codes(table))
    q["m08_users_rejects"] = _job("rejects", fix_users)
    q["m08_users_fixed"] = then(_without_hash, _job("rows", fix_users))
    q["m08_schedules_rejects"] = _job("rejects", fix_trips)
    for table, as_of in (("Users", JOB_AS_OF), ("Stations", JOB_AS_OF)):
        q[f"m09_{table.lower()}_rejects"] = _job("rejects", delete(table))
    q["m09_trains_rejects"] = _job("rejects", delete("Trains", "2001-07-15 00:00:00"), AS_OF)
    q["m10_rejects"] = _job("rejects", lambda t, spark, sf_dir: C.delete_schedules(t, None))
    def month():
        return W.month_of("DepartureTime")

    q["w01_appended_schedules"] = stored("Schedules", month, add_stored_trips)
    q["w02_updated_users"] = stored(
        "Users", lambda: W.key_block("UserID"), update_stored_users, drop=("PasswordHash",)
    )
    q["w02_updated_schedules"] = stored("Schedules", month, update_stored_trips)
    q["w02_updated_bookings"] = stored(
        "Bookings", lambda: W.month_of("BookingDate"), cancel_stored_bookings
    )
    q["w03_remaining_schedules"] = stored("Schedules", month, delete_stored_trips)
    q["m12_generated_seats"] = _on(lambda t: C.generate_seats(t["Coaches"]))
    q["m13_double_booked_seats"] = _on(B.double_booked_seats)
    q["m14_cancelled_tickets"] = _on(B.cancelled_tickets)
    q["m15_late_bookings"] = _on(
        lambda t: B.split_late(t, t["Bookings"], JOB_AS_OF)[1], as_of=JOB_AS_OF
    )
    q["f06_authorised"] = lambda spark, sf_dir: F.split_authorised(
        star_tables(spark, sf_dir, JOB_AS_OF), K.cancel_commands(spark, sf_dir)
    )[0].select("request_id")
    return q


def quality_queries() -> dict[str, Query]:
    names = {
        "c01_unique_keys": "keys",
        "c02_composite_keys": "composite",
        "c03_foreign_keys": "foreign",
        "c04_domains": "domains",
        "c05_row_checks": "rows",
        "c06_required_and_length": "required",
    }
    return {name: _on(Q.summary, families=(family,)) for name, family in names.items()}


def stream_queries() -> dict[str, Query]:
    """Each stream reads its file to the end and stops; the query returns what it stored."""

    def run(start, part: str, schema: Callable[[Tables], object]) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            as_of = EARLY if part in ("bookings", "rejects") else JOB_AS_OF
            t = star_tables(spark, sf_dir, as_of)
            out = scratch_dir(spark, "stream")
            start(t, spark, sf_dir, f"{out}/result", f"{out}/progress").awaitTermination()
            return S.read_results(spark, f"{out}/result", part, schema(t))

        return query

    def pay(t, spark, sf_dir, out, progress):
        changes = stream_table(spark, sf_dir, "Payments")
        return S.payment_notice_stream(t, changes, out, progress, JOB_AS_OF)

    def remind(t, spark, sf_dir, out, progress):
        arriving = stream_table(spark, sf_dir, "Bookings")
        return S.reminder_stream(t, arriving, out, progress, REMIND_AS_OF)

    def replay(t, spark, sf_dir, out, progress):
        arriving = stream_table(spark, sf_dir, "Bookings")
        return S.reminder_stream(t, arriving, out, progress, JOB_AS_OF, "BookingDate", "90 seconds")

    def book(t, spark, sf_dir, out, progress):
        arriving = K.booking_requests(spark, sf_dir, stream_star)
        return S.booking_request_stream(t, arriving, out, progress, EARLY)

    def claims(read) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = scratch_dir(spark, "stream")
            arriving = K.seat_claims(spark, sf_dir, stream_star)
            t = star_tables(spark, sf_dir, EARLY)
            for started in S.first_claim_stream(
                t, arriving, f"{out}/result", f"{out}/progress", arrived="ClaimedAt"
            ):
                started.awaitTermination()
            return read(spark, f"{out}/result")

        return query

    def notice_schema(t: Tables):
        return t["Notifications"].select(*NOTICE_COLUMNS).schema

    return {
        "s01_payment_notices": run(pay, "notifications", notice_schema),
        "s02_departure_reminders": run(remind, "notifications", notice_schema),
        "s02_reminders_when_due": run(replay, "notifications", notice_schema),
        "s03_bookings": run(book, "bookings", lambda t: t["Bookings"].schema),
        "s03_rejects": run(
            book, "rejects", lambda t: "request_id bigint, code int, reason string"
        ),
        "s03_first_claims": claims(S.read_first_claims),
        "s03_claim_rejects": claims(S.read_claim_rejects),
    }


def all_queries() -> dict[str, Query]:
    return {
        **report_queries(),
        **listing_queries(),
        **job_queries(),
        **quality_queries(),
        **stream_queries(),
    }
