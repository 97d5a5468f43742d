"""Per-key date state: first visit of a day, returning users, new-visitor repair.

Each function takes a batch or a stream. The batch form reads the rows of a key in event-time
order. It never gathers a key's rows in one place: what a key has to remember is the earliest
row per day, a minimum that is taken before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import times
from tidewell.streaming import state

RETURN_DAYS = 8


def _only_on_streams(start: DataFrame | None) -> None:
    if start is not None:
        raise ValueError("a batch has no earlier state")


def first_of_day(
    df: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    order: Sequence[str] = (),
    carry: Sequence[str] = (),
    delay: str = "0 seconds",
    keep_ms: int | None = 0,
    start: DataFrame | None = None,
) -> DataFrame:
    """The first row per key and date, as ``keys``, ``visit_date``, ``ts`` and ``carry``.

    ``ts`` is in epoch milliseconds; ``order`` breaks ties. On a stream a key fires whenever its
    date differs from the last one seen, and ``_event_time`` carries the watermark on. A stream
    forgets a key when the watermark is ``keep_ms`` past the end of its date: rows of that date
    would be too late by then. None keeps it for ever. ``start``, a result of the batch form, is
    what a stream takes as seen before.
    """
    if df.isStreaming:
        return state.first_of_day(df, keys, ts, order, carry, delay, keep_ms, start).drop("prev_date")
    _only_on_streams(start)
    day = times.at(F.col(ts)).cast("date").alias("visit_date")
    rest = [c for c in (*order, *carry) if c != ts]
    if not rest:
        return df.groupBy(*keys, day).agg(F.min(ts).alias(ts))
    # A struct of the order columns first, so that its minimum is the earliest row.
    first = F.min(F.struct(ts, *dict.fromkeys(rest))).alias("_first")
    return df.groupBy(*keys, day).agg(first).select(
        *keys, "visit_date", F.col(f"_first.{ts}").alias(ts), *[f"_first.{c}" for c in carry]
    )


def return_logins(
    df: DataFrame,
    key: str = "uid",
    ts: str = "ts",
    days: int = RETURN_DAYS,
    delay: str = "0 seconds",
    keep_ms: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """One row per user and login date: ``uu_ct`` 1, ``back_ct`` 1 after a long absence.

    Absence is in whole days since the midnight that opened the previous login date. A stream
    forgets users ``keep_ms`` after their last login date, and by default never: a forgotten user
    cannot come back. ``start``, a result of the batch form, is what a stream takes as seen before.
    """
    if df.isStreaming:
        if start is not None:
            start = start.select(key, F.to_date("login_date", times.DATE).alias("visit_date"))
        firsts = state.first_of_day(df, [key], ts, (), (), delay, keep_ms, start)
        extra = ["_event_time"]
    else:
        _only_on_streams(start)
        # At most one row per user and day is left when the users are ordered.
        firsts = first_of_day(df, [key], ts).withColumn(
            "prev_date", F.lag("visit_date").over(W.partitionBy(key).orderBy("visit_date"))
        )
        extra = []
    gap = F.col(ts) - F.unix_millis(F.col("prev_date").cast("timestamp"))
    back = F.coalesce(F.floor(gap / F.lit(86_400_000)) >= days, F.lit(False))
    return firsts.select(
        key,
        ts,
        F.date_format("visit_date", times.DATE).alias("login_date"),
        F.lit(1).cast("bigint").alias("uu_ct"),
        back.cast("bigint").alias("back_ct"),
        *extra,
    )


def first_dates(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """(mid, anchor): the date that the first record of each device fixes."""
    today = times.at(F.col("_first.ts")).cast("date")
    return (
        df.select(F.col("common.mid").alias("mid"), "ts", *order, F.col("common.is_new").alias("_new"))
        .filter("mid IS NOT NULL")
        .groupBy("mid")
        .agg(F.min(F.struct("ts", *order, "_new")).alias("_first"))
        .select("mid", (today - F.when(F.col("_first._new") == "1", 0).otherwise(1)).alias("anchor"))
    )


def fix_is_new(
    df: DataFrame, order: Sequence[str] = (), ttl_ms: int | None = None, start: DataFrame | None = None
) -> DataFrame:
    """Correct the new-visitor flag of log records.

    The first record of a device fixes a date: its own day if it claims to be new, else the day
    before. A later claim to be new on any other date is set to ``0``. Records without a device
    stay as they are. ``start``, a result of ``first_dates``, is what a stream knows before.
    """
    if df.isStreaming:
        return state.fix_is_new(df, order, ttl_ms, start)
    _only_on_streams(start)
    if ttl_ms is not None:
        raise ValueError("a time to live in processing time has no meaning on a batch")
    mid, new = F.col("common.mid"), F.col("common.is_new")
    today = times.at(F.col("ts")).cast("date")
    anchors = first_dates(df, order).toDF("_mid", "_anchor")
    fixed = F.when((new == "1") & (F.col("_anchor") != today), F.lit("0")).otherwise(new)
    return (
        df.join(anchors, mid == F.col("_mid"), "left")
        .withColumn("common", F.col("common").withField("is_new", fixed))
        .drop("_mid", "_anchor")
    )
