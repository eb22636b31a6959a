"""Batch jobs on payments: process attempts, notify payers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import messages as msg
from ..functions.exprs import instant
from ..functions.ids import next_id, number_rows
from ..plans.checkpoints import cut
from ..plans.tables import Tables
from .notices import first_failure, notices

SUCCESS_CODE = "00"


def _texts(amount: Column, ok: Column) -> tuple[Column, Column]:
    """(title, message) of a payment notice; the amount is shown in whole units."""
    shown = F.format_number(F.round(amount, 0), 0)

    def text(parts):
        return F.concat(F.lit(parts[0]), shown, F.lit(parts[1]), "BookingCode")

    return (
        F.when(ok, msg.PAID_TITLE).otherwise(msg.UNPAID_TITLE),
        F.when(ok, text(msg.PAID_TEXT)).otherwise(text(msg.UNPAID_TEXT)),
    )


def payment_notices(
    t: Tables, changed: DataFrame, as_of, per_row: bool = True
) -> DataFrame:
    """Notices for changed payments: each success and each failure is told, however the
    payments are cut into batches.

    ``per_row=False`` takes the batch for one statement: if any payment of it succeeded,
    only successes are told; else the failures are."""
    told = changed.filter(F.col("PaymentStatus").isin("Success", "Failed"))
    if not per_row:
        won = F.col("PaymentStatus") == "Success"
        any_won = told.agg(F.coalesce(F.bool_or(won), F.lit(False)).alias("any")).scalar()
        told = told.filter(won | ~any_won)
    codes = t["Bookings"].select("BookingID", "BookingCode", "UserID")
    title, text = _texts(F.col("Amount"), F.col("PaymentStatus") == "Success")
    return notices(
        told.select("BookingID", "Amount", "PaymentStatus").join(codes, "BookingID"),
        "Payment",
        title,
        text,
        as_of,
    )


def process_payments(t: Tables, attempts: DataFrame, as_of) -> dict[str, DataFrame]:
    """Applies (request_id, booking_id, transaction_id, response_code) to the latest
    payment of each booking. A NULL response code counts as a failure.

    The last attempt sets the payment row; any success makes the booking Paid and its
    tickets Valid, and a later failure does not undo that. The amount is cut to whole
    units. A booking without a payment refuses its first attempt and logs it as a failed
    payment, which later attempts then find and update.
    """
    bookings = t["Bookings"].select(
        F.col("BookingID").alias("booking_id"),
        "BookingStatus",
        "UserID",
        "BookingCode",
        F.col("TotalAmount").cast("int").cast("decimal(10,2)").alias("amount"),
    )
    code, why = first_failure(
        (F.col("BookingStatus").isNull(), msg.NO_BOOKING_TO_PAY),
        (F.col("BookingStatus") != "Active", msg.NOT_ACTIVE_TO_PAY),
    )
    # bookings and payments are read once: every output comes from these two written steps
    judged = cut(
        attempts.join(bookings, "booking_id", "left").select(
            "*", code.alias("code"), why.alias("why")
        )
    )
    good = judged.filter(F.col("why").isNull()).drop("code", "why")

    # per booking: first attempt, last attempt and how many there are, and the payment
    ok = F.coalesce(F.col("response_code") == SUCCESS_CODE, F.lit(False))
    attempt = F.struct("request_id", "transaction_id", "response_code")
    per_booking = good.groupBy("booking_id").agg(
        F.min("request_id").alias("first"),
        F.max(attempt).alias("last"),
        F.first("amount").alias("amount"),
        F.min_by("transaction_id", "request_id").alias("first_txn"),
    )
    latest = (
        t["Payments"]
        .groupBy(F.col("BookingID").alias("booking_id"))
        .agg(F.max(F.struct("PaymentID", "PaymentMethod")).alias("_payment"))
        .select("booking_id", "_payment.*")
    )
    target = cut(per_booking.join(latest, "booking_id", "left"))
    unpaid = target.filter(F.col("PaymentID").isNull()).drop("PaymentID", "PaymentMethod")
    start = next_id(t["Payments"], "PaymentID") - 1
    logged = number_rows(unpaid, "first").withColumn("PaymentID", F.col("_n") + F.lit(start))

    def result(rows: DataFrame, method: Column) -> DataFrame:
        won = F.coalesce(F.col("last.response_code") == SUCCESS_CODE, F.lit(False))
        return rows.select(
            "PaymentID",
            F.col("booking_id").alias("BookingID"),
            method.alias("PaymentMethod"),
            F.col("last.transaction_id").alias("TransactionID"),
            F.col("amount").alias("Amount"),
            F.when(won, instant(as_of)).alias("PaymentDate"),
            F.when(won, "Success").otherwise("Failed").alias("PaymentStatus"),
            F.col("last.response_code").alias("ResponseCode"),
            F.when(won, msg.PAYMENT_OK).otherwise(msg.PAYMENT_FAILED).alias("ResponseMessage"),
        )

    no_method = F.lit(None).cast("string")
    columns = t["Payments"].columns
    updated = result(target.filter(F.col("PaymentID").isNotNull()), F.col("PaymentMethod"))
    retried = result(logged.filter(F.col("last.request_id") > F.col("first")), no_method)
    only_logged = logged.filter(F.col("last.request_id") == F.col("first")).select(
        "PaymentID",
        F.col("booking_id").alias("BookingID"),
        no_method.alias("PaymentMethod"),
        F.col("first_txn").alias("TransactionID"),
        F.col("amount").alias("Amount"),
        instant(as_of).alias("PaymentDate"),
        F.lit("Failed").alias("PaymentStatus"),
        F.lit("99").alias("ResponseCode"),
        F.lit(msg.NO_PAYMENT[1]).alias("ResponseMessage"),
    )
    log_rows = retried.unionByName(only_logged)

    # an attempt counts unless it is the one that found no payment
    refused_first = unpaid.select("booking_id", F.col("first").alias("refused"))
    marked = good.join(refused_first, "booking_id", "left")
    counted = marked.filter(
        F.col("refused").isNull() | (F.col("request_id") != F.col("refused"))
    )
    paid = counted.filter(ok).select(F.col("booking_id").alias("BookingID")).distinct()
    title, text = _texts(F.col("amount"), ok)
    sent = notices(
        counted.withColumnRenamed("booking_id", "BookingID"), "Payment", title, text, as_of
    )
    no_payment = marked.filter(F.col("request_id") == F.col("refused")).select(
        "request_id",
        F.lit(msg.NO_PAYMENT[0]).alias("code"),
        F.lit(msg.NO_PAYMENT[1]).alias("reason"),
    )
    refused = judged.filter("why is not null").select(
        "request_id", "code", F.col("why").alias("reason")
    )
    return {
        "payments": updated.select(*columns),
        "new_payments": log_rows.select(*columns),
        "bookings": t["Bookings"]
        .join(paid, "BookingID", "left_semi")
        .withColumn("PaymentStatus", F.lit("Paid")),
        "tickets": t["Tickets"]
        .join(paid, "BookingID", "left_semi")
        .withColumn("TicketStatus", F.lit("Valid")),
        "notifications": sent,
        "rejects": refused.unionByName(no_payment),
    }
