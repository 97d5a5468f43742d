"""Duplicate and superseded versions of a row."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions import times
from tidewell.streaming import state
from tidewell.streaming.bloom import Bloom


def retract(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    amounts: Sequence[str],
    ttl_ms: int | None = None,
    start: DataFrame | None = None,
) -> DataFrame:
    """All versions, and for each superseded one a copy with its amounts negated.

    Sums over the result count every key once, with its newest version. A retraction keeps the
    time and all else of the row that it takes back. ``amounts`` may be numbers or text. Versions
    of equal order are taken back but for one. ``start``, the newest rows of a batch (see ``latest``), are
    versions that a stream knows before.

    On a batch, the newest version of each key is found by an aggregate that reduces before its
    shuffle, and rows are then compared with it.
    """
    if df.isStreaming:
        return state.retract(df, key, order, amounts, ttl_ms, start)
    if start is not None:
        raise ValueError("a batch has no earlier state")
    if ttl_ms is not None:
        raise ValueError("a time to live in processing time has no meaning on a batch")
    # Equal rows are versions as well; one row with their number stands for them. Among versions of
    # equal order a hash of the whole row decides, the same on every run.
    counted = df.groupBy(*df.columns).agg(F.count("*").cast("int").alias("_n"))
    place = F.struct(*order, F.xxhash64(*df.columns))
    newest = df.groupBy(F.col(key).alias("_key")).agg(F.max(place).alias("_last"))
    back = F.when(place < F.col("_last"), F.col("_n")).otherwise(F.col("_n") - 1)
    signs = F.concat(F.array_repeat(F.lit(1), F.col("_n")), F.array_repeat(F.lit(-1), back))
    doubled = counted.join(newest, F.col(key).eqNullSafe(F.col("_key"))).withColumn("_sign", F.explode(signs))
    types = dict(df.dtypes)
    return doubled.select(
        *[
            _negated(c, types[c]).alias(c) if c in amounts else F.col(c)
            for c in df.columns
        ]
    )


def _negated(name: str, kind: str) -> Column:
    value = F.col(name)
    taken_back = F.concat(F.lit("-"), value) if kind == "string" else (-value).cast(kind)
    return F.when(F.col("_sign") < 0, taken_back).otherwise(value)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], wait_ms: int = 5000) -> DataFrame:
    """The version of each key that is greatest by ``order``.

    A ranking that keeps one row per group is cut down on each input partition before the
    shuffle. On a stream, versions are collected for ``wait_ms`` after the first one came.
    """
    if df.isStreaming:
        return state.latest(df, keys, order, wait_ms)
    by = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    by = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(by)).filter("_rn = 1").drop("_rn")


def exact(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    delay: str = "10 minutes",
    ms: str = "ts_ms",
) -> DataFrame:
    """One row per combination of ``keys``.

    A batch keeps the first by ``order``, or any if there is no order. A stream keeps the first
    to arrive and forgets a combination once the watermark is ``delay`` past it.
    """
    if df.isStreaming:
        return (
            df.withColumn("_event_time", times.event_time(F.col(ms)))
            .withWatermark("_event_time", delay)
            .dropDuplicatesWithinWatermark(list(keys))
        )
    return earliest(df, keys, order) if order else df.dropDuplicates(list(keys))


# Most bytes of one Bloom filter: more combinations take more shards.
FILTER_BYTES = 64 << 20
# Shards of a stream whose filters would fit in fewer. State is kept per shard, so this may not
# follow the session.
STREAM_SHARDS = 64


def filter_shards(expected: int, fpp: float, least: int) -> int:
    """Shards for ``expected`` combinations, such that no filter is above ``FILTER_BYTES``."""
    size = expected * -math.log(fpp) / (8 * math.log(2) ** 2)
    return max(least, math.ceil(size / FILTER_BYTES))


def bloom(
    df: DataFrame, keys: Sequence[str], expected: int, fpp: float = 0.01, shards: int | None = None
) -> DataFrame:
    """Like ``exact``, with Bloom filters for memory: a share ``fpp`` of new rows may be lost.

    Equal combinations meet in one shard, whatever their entity, so no entity owns a task.
    Copies within one Arrow batch are dropped before the shuffle, so a combination that fills a
    third of the table does not travel row by row. ``expected`` is the number of combinations
    in the whole table, of which each shard sees its share. ``shards`` is how many tasks the work
    can take; by default it follows from ``expected``, and is never below the shuffle partitions
    of a batch or ``STREAM_SHARDS``. A running stream must keep its number.
    """
    if df.isStreaming:
        return state.bloom(df, keys, expected, fpp, shards or filter_shards(expected, fpp, STREAM_SHARDS))
    if shards is None:
        least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = filter_shards(expected, fpp, least)
    marked = df.withColumn("_h1", F.xxhash64(*keys)).withColumn(
        "_h2", F.xxhash64(F.lit("second"), *keys)
    )
    per_shard = max(1, -(-expected // shards))
    spread = marked.mapInPandas(_without_copies, marked.schema).repartition(shards, "_h1", "_h2")
    return spread.mapInPandas(_bloom_pass(per_shard, fpp), marked.schema).drop("_h1", "_h2")


def _without_copies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch[~batch.duplicated(["_h1", "_h2"])]


def _bloom_pass(expected: int, fpp: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Bloom.sized(expected, fpp)
        for batch in batches:
            once = batch[~batch.duplicated(["_h1", "_h2"])]
            fresh = seen.add(once["_h1"].to_numpy(np.int64), once["_h2"].to_numpy(np.int64))
            if fresh.any():
                yield once[fresh]

    return run
