"""Epoch milliseconds, text dates and event time. The zone is the session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
COMPACT = "yyyyMMdd"


def at(ms: Column) -> Column:
    """Epoch milliseconds (number or text) as a timestamp; text that is no number gives null."""
    return F.timestamp_millis(ms.try_cast("bigint"))


def ms_to_date(ms: Column) -> Column:
    return F.date_format(at(ms), DATE)


def ms_to_datetime(ms: Column) -> Column:
    return F.date_format(at(ms), DATETIME)


def ms_to_compact(ms: Column) -> Column:
    return F.date_format(at(ms), COMPACT)


def datetime_to_ms(text: Column) -> Column:
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATETIME)))


def date_to_ms(text: Column) -> Column:
    """Milliseconds of the midnight that opens the given date."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(DATE)))


def today_compact() -> Column:
    return F.date_format(F.current_date(), COMPACT).cast("int")


def epoch_day_to_date(days: Column) -> Column:
    return F.date_from_unix_date(days.try_cast("int"))


def event_time(ms: Column) -> Column:
    """Event time for a watermark: an unreadable time counts as the epoch, so it is late."""
    return F.coalesce(at(ms), F.timestamp_millis(F.lit(0).cast("bigint")))


def to_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp, or of a zoneless one read in the session zone."""
    return F.unix_millis(ts.cast("timestamp"))
