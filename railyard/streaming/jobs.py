"""Streaming forms of the event-driven jobs.

S01 applies the batch job to each micro-batch, and S03 the booking rule, so a stream gives
what the batch job gives on the same rows. Reminders (S02) wait in a stored table that each
micro-batch replaces, seat claims (S03) in keyed state with event-time timers. Results of a micro-batch go to their own
folder, which a retry of that batch overwrites: each is stored exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import messages as msg
from ..functions.exprs import instant
from ..functions.lookups import taken_seats
from ..operators.booking_jobs import create_bookings, first_new_ids
from ..operators.lifecycle_jobs import reminder_notices
from ..operators.notices import first_failure
from ..operators.payment_jobs import payment_notices
from ..plans.checkpoints import cut
from ..plans.tables import Tables
from . import timed

# the clock of a stream before its first row
_NO_CLOCK = -(1 << 62)


def _batch_path(out_dir: str, name: str, batch_id: int) -> str:
    return f"{out_dir.rstrip('/')}/{name}/batch_id={batch_id}"


def _store(df: DataFrame, out_dir: str, name: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(_batch_path(out_dir, name, batch_id))


def read_results(spark: SparkSession, out_dir: str, name: str, schema) -> DataFrame:
    """All results of one kind that a stream has stored."""
    stored = spark.read.schema(schema).parquet(f"{out_dir.rstrip('/')}/{name}")
    return stored.drop("batch_id")


def _earlier(spark, out_dir: str, name: str, batch_id: int, like: DataFrame) -> DataFrame:
    """Results of earlier micro-batches; a retried batch does not see its own."""
    path = f"{out_dir.rstrip('/')}/{name}"
    if batch_id == 0:
        return like.limit(0)
    schema = T.StructType([*like.schema.fields, T.StructField("batch_id", T.LongType())])
    return (
        spark.read.schema(schema).parquet(path).filter(F.col("batch_id") < batch_id).drop("batch_id")
    )


def _start(
    stream: DataFrame, work: Callable, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def payment_notice_stream(
    t: Tables, payments: DataFrame, out_dir: str, checkpoint: str, as_of, per_row: bool = True
) -> StreamingQuery:
    """Tells payers about each micro-batch of changed payments (S01)."""

    def work(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            _store(payment_notices(t, kept, as_of, per_row), out_dir, "notifications", batch_id)
        finally:
            kept.unpersist()

    return _start(payments, work, checkpoint)


def reminder_stream(
    t: Tables,
    bookings: DataFrame,
    out_dir: str,
    checkpoint: str,
    as_of,
    arrived: str | None = None,
    lateness: str = "1 hour",
) -> StreamingQuery:
    """Sends departure reminders for arriving bookings, once per booking, when due (S02).

    The clock is the watermark of ``arrived``, the column that tells when a booking's row came;
    rows that come more than ``lateness`` behind it are too late for the stream. Without that
    column every row comes at ``as_of``, where the clock stands still. A booking that arrives
    days early waits in a stored table until it is due; one that has a reminder in the tables, or
    that a later row cancels, is not told. SentAt is the time at which a reminder fell due.
    """
    trips = (
        t["Schedules"]
        .join(t.hint(t["Trains"].select("TrainID", "TrainCode"), "Trains"), "TrainID")
        .select("ScheduleID", F.col("TrainCode").alias("train"), timed.millis(F.col("DepartureTime")).alias("leaves"))
    )
    reminded = (
        t["Notifications"]
        .filter((F.col("NotificationType") == "Reminder") & F.col("BookingID").isNotNull())
        .select("BookingID")
        .distinct()
    )
    at = timed.millis(instant(as_of) if arrived is None else F.col(arrived))
    wanted = (F.col("BookingStatus") == "Active") & (F.col("PaymentStatus") == "Paid")
    arriving = bookings.select(
        "BookingID",
        F.col("UserID").alias("user"),
        "ScheduleID",
        F.coalesce(wanted, F.lit(False)).alias("wanted"),
        at.alias("arrives"),
    )
    behind = F.timestamp_millis(F.max("arrives")) - F.expr(f"INTERVAL {lateness}")
    leaves = timed.from_millis(F.col("told.leaves"))

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _NO_CLOCK
        waiting = spark.createDataFrame([], timed.WAITING)
        if batch_id:
            last = spark.read.parquet(_batch_path(out_dir, "clock", batch_id - 1)).first()
            before = last["clock"]
            # two folders in turn: a retry of this micro-batch finds what the one before it left
            stored = spark.read.parquet(_batch_path(out_dir, "waiting", (batch_id - 1) % 2))
            waiting = stored.filter(F.col("leaves").isNotNull()).drop("told")
        reached = batch.agg(F.unix_millis(behind).alias("at")).first()["at"]
        clock = before if reached is None else max(before, reached)
        rows = (
            batch.join(t.hint(trips, "Schedules"), "ScheduleID")
            .drop("ScheduleID")
            .join(reminded, "BookingID", "left_anti")
        )
        if arrived is None:  # where the clock stands still, what is not due now never falls due
            rows = rows.filter(timed.opens(F.col("leaves")) <= F.col("arrives"))
        _store(timed.settle_reminders(waiting, rows, before, clock), out_dir, "waiting", batch_id % 2)
        settled = spark.read.parquet(_batch_path(out_dir, "waiting", batch_id % 2))
        told = settled.select("BookingID", F.explode("told").alias("told")).select(
            "BookingID", F.col("told.user").alias("UserID"), "told"
        )
        sent = reminder_notices(told, F.col("told.train"), leaves, timed.from_millis(F.col("told.told")))
        _store(sent, out_dir, "notifications", batch_id)
        _store(spark.range(1).select(F.lit(clock).cast("bigint").alias("clock")), out_dir, "clock", batch_id)

    return _start(arriving, work, checkpoint)


def booking_request_stream(
    t: Tables, requests: DataFrame, out_dir: str, checkpoint: str, as_of
) -> StreamingQuery:
    """Books arriving requests (S03). Seats given away in earlier micro-batches count as
    taken, and ids continue; within a micro-batch the batch job decides.

    Held seats and greatest ids are taken from the tables once, when the stream starts,
    and only for trips that can still be booked. A micro-batch then reads just those and
    what the stream itself has given away, not the booking history.
    """
    parts = ("bookings", "tickets", "payments")
    open_trips = t["Schedules"].filter(F.col("Status") == "Scheduled").select("ScheduleID")
    sold = cut(taken_seats(t).join(t.hint(open_trips, "Schedules"), "ScheduleID", "left_semi"))
    start = first_new_ids(t)

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = {
            part: _earlier(spark, out_dir, part, batch_id, t[part.capitalize()]) for part in parts
        }
        # row counts come from the file footers
        done = {part: 0 if batch_id == 0 else earlier[part].count() for part in parts}
        given = earlier["tickets"].join(
            earlier["bookings"].select("BookingID", "ScheduleID"), "BookingID"
        )
        result = create_bookings(
            t,
            batch,
            as_of,
            first_code=done["bookings"] + 1,
            held=sold.unionByName(given.select("SeatID", "ScheduleID")),
            first_ids={part: start[part] + done[part] for part in parts},
        )
        for part in (*parts, "rejects"):
            _store(result[part], out_dir, part, batch_id)

    return _start(requests, work, checkpoint)


def split_claims(t: Tables, claims: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(claims that count, refused ones) of single-seat claims (ScheduleID, SeatID,
    BookingID, ClaimedAt): a trip must be Scheduled and not have left at that time."""
    trips = t.hint(
        t["Schedules"].select("ScheduleID", "Status", F.col("DepartureTime").alias("_leaves")),
        "Schedules",
    )
    code, reason = first_failure(
        (~F.col("Status").eqNullSafe("Scheduled"), msg.NO_SCHEDULE),
        (F.col("ClaimedAt") >= F.col("_leaves"), msg.TOO_LATE),
    )
    judged = claims.join(trips, "ScheduleID", "left").select(
        *claims.columns, code.alias("code"), reason.alias("reason")
    )
    return (
        judged.filter(F.col("reason").isNull()).select(*claims.columns),
        judged.filter(F.col("reason").isNotNull()),
    )


def first_claims(claims: DataFrame) -> DataFrame:
    """The least claim of every seat and trip, by (ClaimedAt, BookingID)."""
    return claims.groupBy("ScheduleID", "SeatID").agg(
        F.min(F.struct("ClaimedAt", "BookingID")).alias("first")
    )


def first_claim_stream(
    t: Tables,
    claims: DataFrame,
    out_dir: str,
    checkpoint: str,
    arrived: str | None = None,
    lateness: str = "1 hour",
) -> tuple[StreamingQuery, StreamingQuery]:
    """Settles arriving claims (S03): seats whose least claim changed in a micro-batch, and
    refused claims. `read_first_claims` gives the state after all stored micro-batches.

    A claim may come in as late as it likes and still wins if it is the least, as long as its
    trip has not left by the clock, the watermark of the column ``arrived`` of claims; then its
    state is gone, and it is refused. Without that column the clock stands still, and the state
    of every claimed seat stays.
    """
    good, refused = split_claims(t, claims)
    trips = t.hint(
        t["Schedules"].select("ScheduleID", timed.millis(F.col("DepartureTime")).alias("leaves")),
        "Schedules",
    )
    still = F.lit(86_400_000).cast("bigint")  # a clock that stands still long before any departure
    rows = good.join(trips, "ScheduleID").select(
        "ScheduleID",
        "SeatID",
        "BookingID",
        _micros(F.col("ClaimedAt")).alias("claimed"),
        "leaves",
        (still if arrived is None else timed.millis(F.col(arrived))).alias("arrives"),
    )
    settled = timed.claims_until_departure(rows, lateness, msg.TOO_LATE)

    def store_claims(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            told = kept.filter("reason is null").select(
                "ScheduleID", "SeatID", _from_micros(F.col("claimed")).alias("ClaimedAt"), "BookingID"
            )
            _store(told, out_dir, "claims", batch_id)
            late = kept.filter("reason is not null")
            late = late.select("BookingID", F.lit(None).cast("int").alias("code"), "reason")
            _store(late, out_dir, "late_claims", batch_id)
        finally:
            kept.unpersist()

    def store_rejects(batch: DataFrame, batch_id: int) -> None:
        rejects = batch.select("BookingID", "code", "reason")
        _store(rejects, out_dir, "claim_rejects", batch_id)

    base = checkpoint.rstrip("/")
    return (
        timed.start_with_state(
            claims.sparkSession,
            lambda: _start(settled, store_claims, f"{base}/claims", "update"),
        ),
        _start(refused, store_rejects, f"{base}/claim_rejects"),
    )


def _micros(time: Column) -> Column:
    return timed.millis(time) * 1000 + F.date_format(time, "SSSSSS").cast("bigint")


def _from_micros(us: Column) -> Column:
    ms = F.floor(us / 1000)
    rest = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), ((us % 1000) / 1_000_000).cast("decimal(18,6)"))
    return (timed.from_millis(ms) + rest).cast("timestamp_ntz")


def read_claim_rejects(spark: SparkSession, out_dir: str) -> DataFrame:
    """(BookingID, code, reason) of the claims that a stream has refused."""
    schema = "BookingID bigint, code int, reason string"
    unfit, late = (read_results(spark, out_dir, kind, schema) for kind in ("claim_rejects", "late_claims"))
    return unfit.unionByName(late)


def read_first_claims(spark: SparkSession, out_dir: str) -> DataFrame:
    """(ScheduleID, SeatID, ClaimedAt, BookingID) of each claimed seat: of the claims that a
    stream has told for it the least, which is also the last."""
    schema = "ScheduleID bigint, SeatID bigint, ClaimedAt timestamp_ntz, BookingID bigint"
    told = read_results(spark, out_dir, "claims", schema)
    return first_claims(told).select("ScheduleID", "SeatID", "first.ClaimedAt", "first.BookingID")
