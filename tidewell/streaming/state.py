"""Stateful processors: what cannot be said with Spark's own streaming operators.

Keys are dealt to shards, and a processor gets the rows of a shard in a micro-batch as Arrow frames. What
a key has to remember is an entry of the shard's map state; only entries of keys that occur are read or
written. Rows are worked on by column, for all keys of the shard at once: Python's share per row is
nil, per key it is one read and one write of state. A hot key is rows in a frame like others.

Names in frames must not begin with an underscore: Spark would number such columns. Columns that a
processor does not look at travel packed in one text column, so that no type is changed on
the way. Order columns travel with a mark for null, as nulls would turn whole numbers to floats.

The frames of a shard and micro-batch are in memory together; the size of a micro-batch is set at the
source (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``). State may begin with the result of a batch
(``start``). The number of shards is part of the state: a running stream must keep its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.functions import times
from tidewell.streaming.bloom import BlockedBloom

SHARDS = 64
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_NO_DAY = -(10**9)


def packed(columns: Sequence[str]) -> Column:
    """Columns as one text."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), _JSON)


def key_text(keys: Sequence[str]) -> Column:
    """A key as text; null differs from any value."""
    return F.to_json(F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]), _JSON)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int").alias("shard")


def day_of(date: Column) -> Column:
    return F.coalesce(F.unix_date(date), F.lit(_NO_DAY)).cast("int")


class Order:
    """Order columns as pairs of a null mark and a value without nulls; nulls come first."""

    EMPTY = {"string": "", "double": 0.0, "float": 0.0, "boolean": False}

    def __init__(self, df: DataFrame, columns: Sequence[str]):
        kinds = dict(df.dtypes)
        self.columns, self.names, self.state = [], [], []
        for i, c in enumerate(dict.fromkeys(columns)):
            kind = kinds[c]
            if kind not in ("bigint", "int", "smallint", "tinyint", *self.EMPTY):
                kind = "string"
            value = F.col(f"`{c}`").cast(kind)
            self.columns += [
                value.isNotNull().cast("int").alias(f"n{i}"),
                F.coalesce(value, F.lit(self.EMPTY.get(kind, 0)).cast(kind)).alias(f"o{i}"),
            ]
            self.names += [f"n{i}", f"o{i}"]
            self.state += [f"n{i} int", f"o{i} {kind}"]


def _frames(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames with rows; a shard with a timer or an initial state alone comes with none."""
    return (frame for frame in rows if len(frame))


def _frame(rows: Iterator[pd.DataFrame]) -> pd.DataFrame | None:
    every = list(_frames(rows))
    return pd.concat(every, ignore_index=True) if every else None


def _python(value: Any) -> Any:
    return value.item() if hasattr(value, "item") else value


class Sharded(StatefulProcessor):
    """A processor with one map from key text to what the key remembers."""

    MEMORY = "value string"

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getMapState("memory", "key string", self.MEMORY, self.ttl_ms)

    def known(self, keys: Sequence[str]) -> dict[str, tuple]:
        """What the keys remember, for those that do."""
        out = {}
        for k in keys:
            held = self.memory.getValue((k,)) if self.memory.containsKey((k,)) else None
            if held is not None:
                out[k] = tuple(held)
        return out

    def remember(self, key: str, *values: Any) -> None:
        self.memory.updateValue((key,), tuple(_python(v) for v in values))

    def close(self) -> None:
        pass


class FirstOfDay(Sharded):
    """Remembers the last date of a key and gives the row that changes it.

    Rows of an earlier date than the stored one count as a change too. With ``keep_ms`` a key is
    forgotten once the watermark is that far past the end of its date.
    """

    MEMORY = "day int, ends bigint"

    def __init__(self, order: Sequence[str], keep_ms: int | None = None):
        super().__init__()
        self.order, self.keep_ms = list(order), keep_ms

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # Only the earliest row per key and date is held beyond a frame.
        firsts = None
        for frame in _frames(rows):
            firsts = frame if firsts is None else pd.concat([firsts, frame], ignore_index=True)
            firsts = firsts.sort_values(self.order, kind="stable").drop_duplicates(["key", "day"])
        if firsts is None:
            return
        firsts = firsts.sort_values(["key", *self.order], kind="stable")
        held = self.known(firsts["key"].unique().tolist())
        before = firsts.groupby("key")["day"].shift()
        first = before.isna()
        before[first] = [held[k][0] if k in held else _NO_DAY for k in firsts["key"][first]]
        changed = firsts[firsts["day"] != before]
        for k, day, ends in changed.drop_duplicates("key", keep="last")[["key", "day", "ends"]].itertuples(index=False):
            self.remember(k, day, ends)
        if self.keep_ms is not None:
            for ends in changed["ends"].unique():
                self.handle.registerTimer(int(ends) + self.keep_ms)
        if len(changed):
            yield pd.DataFrame(
                {
                    "row": changed["row"],
                    "_prev": before[changed.index].astype("int32"),
                    "_event_time": pd.to_datetime(changed["ms"], unit="ms", utc=True),
                }
            )

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        for k, day, ends in initialState[["key", "day", "ends"]].itertuples(index=False):
            self.remember(k, day, ends)
        if self.keep_ms is not None:
            for ends in initialState["ends"].unique():
                self.handle.registerTimer(int(ends) + self.keep_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for (k,) in [k for k, held in self.memory.iterator() if held[1] + self.keep_ms <= now]:
            self.memory.removeKey((k,))
        return iter(())


def first_of_day(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    carry: Sequence[str],
    delay: str,
    keep_ms: int | None,
    start: DataFrame | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """Date changes per key with ``prev_date``; ``_event_time`` keeps a watermark of ``delay``.

    ``start`` (keys, ``visit_date``) holds rows of a batch; the stream goes on from the newest date
    of each key.
    """
    out = [*keys, "visit_date", ts, *[c for c in carry if c not in keys and c != ts]]
    wanted = list(dict.fromkeys([*keys, ts, *order, *carry]))
    rows = (
        df.select(*wanted, times.event_time(F.col(ts)).alias("_event_time"))
        .withWatermark("_event_time", delay)
        .withColumn("visit_date", F.col("_event_time").cast("date"))
        .filter("visit_date IS NOT NULL")
    )
    by = Order(rows, [ts, *order])
    ends = F.unix_millis(F.date_add("visit_date", 1).cast("timestamp")).alias("ends")
    shard, key, day = shard_of(key_text(keys), shards), key_text(keys).alias("key"), day_of(F.col("visit_date")).alias("day")
    slim = rows.select(shard, key, day, ends, F.unix_millis("_event_time").alias("ms"), packed(out).alias("row"), "_event_time", *by.columns)
    begin = None
    if start is not None:
        newest = start.groupBy(*keys).agg(F.max("visit_date").alias("visit_date")).filter("visit_date IS NOT NULL")
        begin = newest.select(shard, key, day, ends).groupBy("shard")
    found = slim.groupBy("shard").transformWithStateInPandas(
        FirstOfDay(by.names, keep_ms), "row string, _prev int, _event_time timestamp", "Append", "EventTime", begin, "_event_time"
    )
    prev = F.when(F.col("_prev") != _NO_DAY, F.date_from_unix_date("_prev")).alias("prev_date")
    shape = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in out])
    return found.select(F.from_json("row", shape, _JSON).alias("_r"), "_event_time", prev).select("_r.*", "_event_time", "prev_date")


class FixIsNew(Sharded):
    """Remembers one date per device and gives every row with a corrected flag.

    Rows without a device pass as they are and leave no state.
    """

    MEMORY = "day int"

    def __init__(self, order: Sequence[str], ttl_ms: int | None):
        super().__init__(ttl_ms)
        self.order = list(order)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        every = _frame(rows)
        if every is None:
            return
        some = every[every["key"].notna()]
        anchors = {k: held[0] for k, held in self.known(some["key"].unique().tolist()).items()}
        # The first row of a device that has no date yet decides.
        fresh = some[~some["key"].isin(anchors)].sort_values(self.order, kind="stable").drop_duplicates("key")
        for k, new, today in fresh[["key", "new", "today"]].itertuples(index=False):
            anchors[k] = int(today) - (new != "1" and today != _NO_DAY)
            self.remember(k, anchors[k])
        anchor = every["key"].map(anchors)
        late = every["key"].notna() & (every["new"] == "1") & (anchor != every["today"])
        late &= (anchor != _NO_DAY) & (every["today"] != _NO_DAY)
        yield pd.DataFrame({"row": every["row"], "_flag": every["new"].mask(late, "0")})

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        for k, day in initialState[["key", "day"]].itertuples(index=False):
            self.remember(k, day)


def fix_is_new(
    df: DataFrame, order: Sequence[str], ttl_ms: int | None, start: DataFrame | None = None, shards: int = SHARDS
) -> DataFrame:
    """``start`` (``mid``, ``anchor``: date) holds the dates of devices that a batch has seen."""
    by = Order(df, ["ts", *order])
    mid = F.col("common.mid")
    # Rows without a device need not meet, so they are spread.
    shard = shard_of(F.coalesce(mid, F.xxhash64("ts", *order).cast("string")), shards)
    rows = df.select(
        shard,
        mid.alias("key"),
        F.col("common.is_new").alias("new"),
        day_of(times.at(F.col("ts")).cast("date")).alias("today"),
        packed(df.columns).alias("row"),
        *by.columns,
    )
    begin = None
    if start is not None:
        known = start.filter("mid IS NOT NULL AND anchor IS NOT NULL")
        begin = known.select(shard_of(F.col("mid"), shards), F.col("mid").alias("key"), day_of(F.col("anchor")).alias("day")).groupBy("shard")
    mode = "None" if ttl_ms is None else "ProcessingTime"
    fixed = rows.groupBy("shard").transformWithStateInPandas(FixIsNew(by.names, ttl_ms), "row string, _flag string", "Append", mode, begin)
    fixed = fixed.select(F.from_json("row", _shape(df), _JSON).alias("_r"), "_flag").select("_r.*", "_flag")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_flag"))).drop("_flag")


def _shape(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


class Retract(Sharded):
    """Keeps the last row of a key; a further one is preceded by its retraction."""

    MEMORY = "row string"

    def __init__(self, order: Sequence[str], ttl_ms: int | None):
        super().__init__(ttl_ms)
        self.order = list(order)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        every = _frame(rows)
        if every is None:
            return
        every = every.sort_values(["key", *self.order], kind="stable", ignore_index=True)
        before = every.groupby("key")["row"].shift()
        first = ~every["key"].duplicated()
        held = self.known(every["key"][first].tolist())
        before[first] = [held[k][0] if k in held else None for k in every["key"][first]]
        for k, row in every.drop_duplicates("key", keep="last")[["key", "row"]].itertuples(index=False):
            self.remember(k, row)
        # A row's retraction stands before the row that takes its place.
        back = pd.DataFrame({"row": before, "_sign": -1, "_at": 2 * every.index})
        new = pd.DataFrame({"row": every["row"], "_sign": 1, "_at": 2 * every.index + 1})
        both = pd.concat([back[before.notna()], new]).sort_values("_at")
        yield both[["row", "_sign"]].astype({"_sign": "int32"})

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        for k, row in initialState[["key", "row"]].itertuples(index=False):
            self.remember(k, row)


def retract(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    amounts: Sequence[str],
    ttl_ms: int | None,
    start: DataFrame | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """``start`` holds the newest row of each key that a batch has seen, in the columns of ``df``."""
    from tidewell.operators.dedup import _negated

    by = Order(df, order)
    columns = [shard_of(key_text([key]), shards), key_text([key]).alias("key"), packed(df.columns).alias("row")]
    begin = None if start is None else start.select(*columns).groupBy("shard")
    mode = "None" if ttl_ms is None else "ProcessingTime"
    signed = df.select(*columns, *by.columns).groupBy("shard").transformWithStateInPandas(
        Retract(by.names, ttl_ms), "row string, _sign int", "Append", mode, begin
    )
    signed = signed.select(F.from_json("row", _shape(df), _JSON).alias("_r"), "_sign").select("_r.*", "_sign")
    kinds = dict(df.dtypes)
    return signed.select(
        *[_negated(c, kinds[c]).alias(c) if c in amounts else F.col(c) for c in df.columns]
    )


class Latest(Sharded):
    """Holds the greatest row of a key until its time is up, then gives and forgets it."""

    def __init__(self, order: Sequence[str], memory: str, wait_ms: int):
        super().__init__()
        self.order, self.MEMORY, self.wait_ms = list(order), memory, wait_ms

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        # One row per key is held beyond a frame. Of equal rows the later one counts.
        best = None
        for frame in _frames(rows):
            best = frame if best is None else pd.concat([best, frame], ignore_index=True)
            best = best.sort_values(self.order, kind="stable").drop_duplicates("key", keep="last")
        if best is None:
            return iter(())
        held = self.known(best["key"].tolist())
        due = timerValues.getCurrentProcessingTimeInMs() + self.wait_ms
        if len(held) < len(best):
            self.handle.registerTimer(due)
        if held:
            old = pd.DataFrame([(k, *v) for k, v in held.items()], columns=["key", "due", "row", *self.order])
            best = pd.concat([old, best], ignore_index=True).sort_values(self.order, kind="stable").drop_duplicates("key", keep="last")
        for k, row, *at in best[["key", "row", *self.order]].itertuples(index=False):
            self.remember(k, held[k][0] if k in held else due, row, *at)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        done = [(k[0], held[1]) for k, held in self.memory.iterator() if held[0] <= now]
        for k, _ in done:
            self.memory.removeKey((k,))
        if done:
            yield pd.DataFrame({"row": [row for _, row in done]})


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], wait_ms: int, shards: int = SHARDS) -> DataFrame:
    by = Order(df, order)
    rows = df.select(shard_of(key_text(keys), shards), key_text(keys).alias("key"), packed(df.columns).alias("row"), *by.columns)
    memory = ", ".join(["due bigint", "row string", *by.state])
    found = rows.groupBy("shard").transformWithStateInPandas(Latest(by.names, memory, wait_ms), "row string", "Append", "ProcessingTime")
    return found.select(F.from_json("row", _shape(df), _JSON).alias("_r")).select("_r.*")


class BloomShard(StatefulProcessor):
    """A blocked Bloom filter per shard, a map entry per block; gives the rows that it had not seen.

    A micro-batch reads and writes the blocks that its rows fall into, whatever the filter's size.
    """

    def __init__(self, expected: int, fpp: float):
        self.expected, self.fpp = expected, fpp

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.blocks = handle.getMapState("bloomBlocks", "block int", "bits binary")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        shape = BlockedBloom.sized(self.expected, self.fpp)
        for frame in _frames(rows):
            once = frame.drop_duplicates(["h1", "h2"])
            h1, h2 = once["h1"].to_numpy(np.int64), once["h2"].to_numpy(np.int64)
            block = shape.block_of(h1)
            fresh = np.zeros(len(once), bool)
            order = np.argsort(block, kind="stable")
            for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                where = (int(block[at[0]]),)
                old = bytes(self.blocks.getValue(where)[0]) if self.blocks.containsKey(where) else None
                fresh[at], new = shape.add(old, h1[at], h2[at])
                if fresh[at].any():
                    self.blocks.updateValue(where, (new,))
            if fresh.any():
                yield once.loc[fresh, ["row"]]

    def close(self) -> None:
        pass


def bloom(df: DataFrame, keys: Sequence[str], expected: int, fpp: float, shards: int) -> DataFrame:
    h1, h2 = F.xxhash64(*keys), F.xxhash64(F.lit("second"), *keys)
    rows = df.select(
        F.pmod(h1, F.lit(shards)).cast("int").alias("shard"), h1.alias("h1"), h2.alias("h2"), packed(df.columns).alias("row")
    )
    per_shard = max(1, -(-expected // shards))
    found = rows.groupBy("shard").transformWithStateInPandas(BloomShard(per_shard, fpp), "row string", "Append", "None")
    return found.select(F.from_json("row", _shape(df), _JSON).alias("_r")).select("_r.*")
