"""Column expressions with the semantics the reports rely on."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# sums of money: wide enough for 10^26 currency units
MONEY_SUM = "decimal(28,2)"


def instant(value: str | dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal; jobs get their clock this way, never from the host."""
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
    return F.lit(text).cast("timestamp_ntz")


def day(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def as_date(value: str | dt.date | dt.datetime) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value[:10])


def month_range(year: int, month: int | None) -> tuple[dt.date, dt.date]:
    """First and last day of a month, or of the year when no month is given."""
    if month is None:
        return dt.date(year, 1, 1), dt.date(year, 12, 31)
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(year, month, 1), following - dt.timedelta(days=1)


def int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour boundaries between two instants: 10:59 -> 11:01 is one hour."""
    days = F.datediff(end, start)
    return days * F.lit(24) + F.hour(end) - F.hour(start)


def minutes_crossed(start: Column, end: Column) -> Column:
    return hours_crossed(start, end) * F.lit(60) + F.minute(end) - F.minute(start)


def week_of_year(date: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday."""
    jan1 = F.dayofweek(F.trunc(date, "YEAR"))
    weeks = int_div(F.dayofyear(date) + jan1 - F.lit(2), F.lit(7))
    return (weeks + F.lit(1)).cast("int")


def money(total: Column) -> Column:
    return total.cast(MONEY_SUM)


def when_money(cond: Column, amount: Column) -> Column:
    return F.when(cond, amount).otherwise(F.lit(Decimal("0.00")).cast("decimal(10,2)"))


def mean(total: Column, n: Column) -> Column:
    """Average as one double division, so that every engine rounds alike."""
    return total.cast("double") / F.nullif(n, F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` rounded half up to two places, by integer arithmetic."""
    part, whole = part.cast("bigint"), whole.cast("bigint")
    twice = F.nullif(whole * F.lit(2), F.lit(0))
    hundredths = int_div(part * F.lit(20000) + whole, twice)
    return (hundredths.cast("double") / F.lit(100.0)).cast("decimal(5,2)")


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def between_days(ts: Column, start, end) -> Column:
    """Date range on a timestamp. Plain comparisons against the first and past-the-end
    instants, which the Parquet reader accepts as pushed filters."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= instant(str(as_date(start))))
    if end is not None:
        past = as_date(end) + dt.timedelta(days=1)
        cond = cond & (ts < instant(str(past)))
    return cond


def keep_days(df: DataFrame, column: str, start, end) -> DataFrame:
    if start is None and end is None:
        return df
    return df.filter(between_days(F.col(column), start, end))


def keep_equal(df: DataFrame, **wanted) -> DataFrame:
    """Optional equality filters; ``None`` means no filter."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def keep_search(df: DataFrame, term: str | None, *columns: str) -> DataFrame:
    """Case-insensitive substring search; ``%`` and ``_`` in the term act as wildcards."""
    if term is None:
        return df
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).ilike(f"%{term}%")
    return df.filter(cond)


def keep_ids(df: DataFrame, column: str, ids) -> DataFrame:
    """Restrict to an id list or a one-column id DataFrame; ``None`` keeps every row."""
    if ids is None:
        return df
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(column)).distinct()
        return df.join(wanted, column, "left_semi")
    return df.filter(F.col(column).isin(list(ids)))


def padded(value: Column, width: int) -> Column:
    """Zero-padded text that never loses digits when the number outgrows the width."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def password_hash(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))
