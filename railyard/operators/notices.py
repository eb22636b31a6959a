"""Shape shared by the notifications that the jobs send."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import instant

NOTICE_COLUMNS = (
    "UserID",
    "BookingID",
    "NotificationType",
    "Title",
    "Message",
    "IsRead",
    "SentAt",
    "ScheduledFor",
)


def notices(
    rows: DataFrame, kind: str, title: Column, message: Column, as_of, scheduled_for=None
) -> DataFrame:
    """New notifications for rows with UserID and BookingID. Ids are given when they are
    stored (`sources.store.append_rows`), as with an identity column."""
    later = F.lit(None) if scheduled_for is None else scheduled_for
    return rows.select(
        "UserID",
        "BookingID",
        F.lit(kind).alias("NotificationType"),
        title.alias("Title"),
        message.alias("Message"),
        F.lit(False).alias("IsRead"),
        (as_of if isinstance(as_of, Column) else instant(as_of)).alias("SentAt"),
        later.cast("timestamp_ntz").alias("ScheduledFor"),
    )


def reject(rows: DataFrame, why: tuple[int, str] | str) -> DataFrame:
    """``(request_id, code, reason)``; the code is NULL for refusals without a number."""
    code, text = why if isinstance(why, tuple) else (None, why)
    return rows.select(
        "request_id", F.lit(code).cast("int").alias("code"), F.lit(text).alias("reason")
    )


def first_failure(*checks) -> tuple[Column, Column]:
    """(code, reason) of the first check that fails, both NULL when none does."""
    code, reason = F.lit(None).cast("int"), F.lit(None).cast("string")
    for failed, why in reversed(checks):
        number, text = why if isinstance(why, tuple) else (None, why)
        code = F.when(failed, F.lit(number).cast("int")).otherwise(code)
        reason = F.when(failed, F.lit(text)).otherwise(reason)
    return code, reason
