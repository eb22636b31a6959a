"""Timed state: reminders told when due, claims kept until departure.

The clock of a stream is the watermark of an arrival time in its rows, never the host's. The state
is that of trips yet to leave, whatever the age of the stream. Reminders are settled once a
micro-batch, over all bookings that wait, in joins and folds without Python; a claimed seat has its
own keyed state and one timer that ends it. Processors are made in functions, so that they travel
to the workers by value.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

HOUR = 3_600_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def millis(time: Column) -> Column:
    """Milliseconds of a ``timestamp_ntz`` since 1970, without regard to any time zone."""
    seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)
    return (F.unix_date(F.to_date(time)) * F.lit(86_400).cast("bigint") + seconds) * 1000


def from_millis(ms: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (ms % F.lit(86_400_000)).cast("decimal(18,6)") / 1000
    days = F.floor(ms / F.lit(86_400_000)).cast("int")
    return (epoch + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))).cast("timestamp_ntz")


def start_with_state(spark: SparkSession, start) -> StreamingQuery:
    """Starts a query on the state store that has timers; the session's own setting stays."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return start()
    finally:
        spark.conf.set(PROVIDER, before)


# ---------------------------------------------------------------- reminders
WAITING = "BookingID bigint, user bigint, train string, leaves bigint, done boolean"
_TOLD = "array<struct<user:bigint,train:string,leaves:bigint,told:bigint>>"


def opens(leaves: Column) -> Column:
    return F.floor(leaves / HOUR) * HOUR - 24 * HOUR


def past(leaves: Column) -> Column:
    return F.floor(leaves / HOUR) * HOUR - HOUR


def settle_reminders(waiting: DataFrame, bookings: DataFrame, before: int, clock: int) -> DataFrame:
    """Bookings after a micro-batch, with what was told in it: (``WAITING``, told).

    ``waiting`` has the bookings of the last micro-batch (``WAITING``), ``before`` is the clock at
    its end, ``clock`` that at the end of this one. ``bookings`` has BookingID, user, train, leaves
    and arrives (milliseconds) and wanted. One that arrives within the 24 to 2 hours before departure
    is told at once, an earlier one when they begin, a later one never. A booking that comes again
    before it was told is taken as it comes last; after that it is left out. It is forgotten, with
    leaves NULL, two hours before departure. The rows of a booking are folded in order of arrival.
    """
    fits = (F.col("arrives") >= before) & (F.col("arrives") < past(F.col("leaves")))
    came = bookings.filter(fits).select(
        "BookingID", F.struct("arrives", "user", "train", "leaves", "wanted").alias("row")
    )
    known = waiting.select("BookingID", F.struct("user", "train", "leaves", "done").alias("state"))
    each = known.unionByName(came, allowMissingColumns=True).groupBy("BookingID").agg(
        F.first("state", ignorenulls=True).alias("state"), F.array_sort(F.collect_list("row")).alias("rows")
    )

    def booking(user, train, leaves, done, told) -> Column:
        return F.struct(
            user.alias("user"), train.alias("train"), leaves.alias("leaves"), done.alias("done"), told.alias("told")
        )

    def telling(of: Column, at: Column) -> Column:
        told = F.struct(of["user"].alias("user"), of["train"].alias("train"), of["leaves"].alias("leaves"), at.alias("told"))
        return F.array(told).cast(_TOLD)

    def tell_due(state: Column, now: Column) -> Column:
        opened = opens(state["leaves"]).cast("bigint")
        due = state["leaves"].isNotNull() & ~state["done"] & (opened <= now)
        told = F.concat(state["told"], telling(state, opened))
        return F.when(due, booking(state["user"], state["train"], state["leaves"], F.lit(True), told)).otherwise(state)

    none = {"user": "bigint", "train": "string", "leaves": "bigint"}
    nothing = [F.lit(None).cast(kind) for kind in none.values()]

    def arrive(state: Column, row: Column) -> Column:
        now = F.greatest(row["arrives"], F.lit(before).cast("bigint"))
        due = tell_due(state, now)  # due before this row came
        open_ = row["wanted"] & (now < past(row["leaves"]))  # else cancelled, not paid any more or too late
        at_once = now >= opens(row["leaves"])
        told = F.when(at_once, F.concat(state["told"], telling(row, now))).otherwise(state["told"])
        fresh = booking(row["user"], row["train"], row["leaves"], at_once, told)
        return (
            F.when(due["leaves"].isNotNull() & due["done"], due)
            .when(open_, fresh)
            .otherwise(booking(*nothing, F.lit(False), state["told"]))
        )

    no_told = F.array().cast(_TOLD)
    start = booking(*(F.col("state")[name] for name in none), F.coalesce(F.col("state")["done"], F.lit(False)), no_told)
    end = F.lit(clock).cast("bigint")
    after = F.aggregate("rows", start, arrive, lambda state: tell_due(state, end))
    kept = F.when(past(F.col("after.leaves")) > end, F.col("after.leaves"))
    return (
        each.select("BookingID", after.alias("after"))
        .select("BookingID", "after.user", "after.train", kept.alias("leaves"), "after.done", "after.told")
        .filter(F.col("leaves").isNotNull() | (F.size("told") > 0))
    )


# ---------------------------------------------------------------- seat claims
def _claim_processor(late: str) -> StatefulProcessor:
    class Claims(StatefulProcessor):
        columns = ("ScheduleID", "SeatID", "BookingID", "claimed", "reason")

        def init(self, handle) -> None:
            self.handle = handle
            self.first = handle.getValueState("first", "claimed bigint, booking bigint")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            told, clock = [], timerValues.getCurrentWatermarkInMs()
            best = before = tuple(self.first.get()) if self.first.exists() else None
            leaves = None
            for frame in rows:  # a seat that very many ask for streams through
                gone = frame["leaves"] <= clock
                told += [(*key, int(b), int(c), late) for b, c in zip(frame["BookingID"][gone], frame["claimed"][gone])]
                frame = frame[~gone].sort_values(["claimed", "BookingID"])
                if len(frame):
                    least = (int(frame["claimed"].iloc[0]), int(frame["BookingID"].iloc[0]))
                    best, leaves = min(best or least, least), int(frame["leaves"].iloc[0])
            if best != before:
                if before is None:
                    self.handle.registerTimer(leaves)
                self.first.update(best)
                told.append((*key, best[1], best[0], None))
            yield pd.DataFrame(told, columns=self.columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.first.clear()
            yield pd.DataFrame([], columns=self.columns)

        def close(self) -> None:
            pass

    return Claims()


def claims_until_departure(claims: DataFrame, lateness: str, late: str) -> DataFrame:
    """(ScheduleID, SeatID, BookingID, claimed, reason): seats whose least claim has changed.

    ``claims`` has ScheduleID, SeatID, BookingID, claimed, leaves and arrives (milliseconds but
    for claimed, which is only compared). The state of a seat ends when the clock of arrivals
    passes the trip's departure; a claim that arrives after that is told with ``late`` as its
    reason, so a seat is never given anew.
    """
    timed = claims.withColumn("_at", F.timestamp_millis("arrives")).withWatermark("_at", lateness)
    return timed.groupBy("ScheduleID", "SeatID").transformWithStateInPandas(
        statefulProcessor=_claim_processor(late),
        outputStructType="ScheduleID bigint, SeatID bigint, BookingID bigint, claimed bigint, reason string",
        outputMode="Update",
        timeMode="EventTime",
    )
