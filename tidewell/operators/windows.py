"""Tumbling windows with text bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import times


def tumble(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    aggs: Sequence[Column],
) -> DataFrame:
    """Aggregate per window and key; adds ``stt``, ``edt`` and ``cur_date`` of the window.

    ``ts`` is a timestamp column, or epoch milliseconds on a batch. On a stream the column must
    carry a watermark; rows behind it are dropped. Sums and counts are taken per input partition
    first, so a window without keys is no bottleneck either.
    """
    column = F.col(ts)
    if dict(df.dtypes)[ts] == "bigint":
        column = times.at(column)
    return window_text(df.groupBy(F.window(column, size).alias("_w"), *keys).agg(*aggs))


def window_text(df: DataFrame) -> DataFrame:
    """The window ``_w`` of each row as text columns."""
    return df.select(
        F.date_format("_w.start", times.DATETIME).alias("stt"),
        F.date_format("_w.end", times.DATETIME).alias("edt"),
        F.date_format("_w.start", times.DATE).alias("cur_date"),
        F.col("*"),
    ).drop("_w")
