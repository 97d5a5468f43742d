"""Streams of changes: rows with ``_sign``, 1 for a row that holds from now on and -1 for one that no longer does.

``folded`` turns changes back into the rows that hold. What a processor gives after any number
of micro-batches folds to the batch result over the same input.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewell.streaming.state import SHARDS, _JSON, Order, Sharded, _frames, _shape, key_text, packed, shard_of


def folded(changes: DataFrame, sign: str = "_sign") -> DataFrame:
    """The rows that hold after all changes, as often as they do."""
    columns = [c for c in changes.columns if c != sign]
    held = changes.groupBy(*columns).agg(F.sum(sign).cast("int").alias("_n")).filter("_n > 0")
    return held.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n")


class LeftJoin(StatefulProcessor):
    """Holds the rows of all sides of a key and gives what each micro-batch changes in their left join."""

    def __init__(self, kinds: Sequence[T.StructType], ttl_ms: int | None):
        self.kinds, self.ttl_ms = list(kinds), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sides = [handle.getListState(f"side{i}", kind, self.ttl_ms) for i, kind in enumerate(self.kinds)]

    def joined(self, sides: Sequence[list[tuple]]) -> Counter:
        missing = [[(None,) * len(kind)] for kind in self.kinds]
        rights = [rows or none for rows, none in zip(sides[1:], missing[1:])]
        return Counter(tuple(itertools.chain(*parts)) for parts in itertools.product(sides[0], *rights))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        new: list[list[tuple]] = [[] for _ in self.kinds]
        for row in rows:
            i = row["_side"]
            new[i].append(tuple(row[f"_s{i}"][f.name] for f in self.kinds[i]))
        old = [[tuple(r) for r in side.get()] if side.exists() else [] for side in self.sides]
        make = Row(*(f.name for kind in self.kinds for f in kind), "_sign")
        before, after = self.joined(old), self.joined([a + b for a, b in zip(old, new)])
        for sign, changed in ((-1, before - after), (1, after - before)):
            for values, n in changed.items():
                for _ in range(n):
                    yield make(*values, sign)
        for side, more in zip(self.sides, new):
            if more:
                side.appendList(more)

    def close(self) -> None:
        pass


def left_join(
    left: DataFrame, rights: Sequence[tuple[DataFrame, str]], key: str, ttl_ms: int | None = None
) -> DataFrame:
    """Changes of ``left`` joined with each of ``rights`` (rows, column that matches ``key``).

    A row of ``left`` is given as soon as it comes, with nulls for what is not there yet. When that comes, the row
    with nulls is taken back and the whole one given. Names must not clash. A null key matches nothing.
    ``ttl_ms`` of processing time after they came, rows of a side are forgotten.
    """
    frames = [left, *(r for r, _ in rights)]
    columns = [[c for c in f.columns if c != "_event_time"] for f in frames]
    kinds = [T.StructType([T.StructField(c, f.schema[c].dataType) for c in own]) for f, own in zip(frames, columns)]
    keys = [key, *(k for _, k in rights)]

    def side(i: int) -> DataFrame:
        value = F.col(f"`{keys[i]}`").cast("string")
        # Rows without a key need not meet, and only those of the left side are joined to nulls.
        rows = frames[i] if i == 0 else frames[i].filter(value.isNotNull())
        spread = F.when(value.isNull(), F.xxhash64(*[f"`{c}`" for c in columns[i]]))
        packs = [
            F.struct(*[f"`{c}`" for c in columns[i]]).alias(f"_s{j}") if i == j else F.lit(None).cast(kind).alias(f"_s{j}")
            for j, kind in enumerate(kinds)
        ]
        return rows.select(value.alias("_key"), spread.alias("_spread"), F.lit(i).alias("_side"), *packs)

    both = side(0)
    for i in range(1, len(frames)):
        both = both.unionByName(side(i))
    out = T.StructType([f for kind in kinds for f in kind] + [T.StructField("_sign", T.IntegerType())])
    mode = "None" if ttl_ms is None else "ProcessingTime"
    return both.groupBy("_key", "_spread").transformWithState(LeftJoin(kinds, ttl_ms), out, "Append", mode)


class Upserts(Sharded):
    """Remembers the newest version of a key and gives the rows that it takes back and brings.

    Versions older than the one that is known change nothing, in whichever micro-batch they come.
    """

    def __init__(self, order: Sequence[str], memory: str, ttl_ms: int | None):
        super().__init__(ttl_ms)
        self.order, self.MEMORY = list(order), memory

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        newest = None
        for frame in _frames(rows):
            newest = frame if newest is None else pd.concat([newest, frame], ignore_index=True)
            newest = newest.sort_values(self.order, kind="stable").drop_duplicates("key", keep="last")
        if newest is None:
            return
        held = self.known(newest["key"].tolist())
        old = pd.DataFrame([(k, v[0] == 1, v[1]) for k, v in held.items()], columns=["key", "was", "old"])
        both = newest.merge(old, on="key", how="left")
        gone, come = [], []
        for k, row, live, was, before, at in zip(
            both["key"], both["row"], both["live"], both["was"], both["old"], both[self.order].itertuples(index=False, name=None)
        ):
            if k in held and tuple(at) <= held[k][2:]:
                continue
            self.remember(k, live, row, *at)
            same = k in held and was and live and before == row
            if k in held and was and not same:
                gone.append(before)
            if live and not same:
                come.append(row)
        if gone or come:
            yield pd.DataFrame({"row": gone + come, "_sign": pd.array([-1] * len(gone) + [1] * len(come), dtype="int32")})


def upsert_changes(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, ttl_ms: int | None = None, shards: int = SHARDS
) -> DataFrame:
    """Upserts and tombstones (rows without ``value``) as changes before and after.

    ``order`` tells which version of a key is the newest; it folds to ``merges.upsert_latest``. With
    ``ttl_ms`` keys are forgotten that long after their last change.
    """
    # Of versions equal in order the greater text counts, whichever came first.
    by = Order(df.withColumn("_text", packed(df.columns)), [*order, "_text"])
    rows = df.withColumn("_text", packed(df.columns)).select(
        shard_of(key_text(keys), shards),
        key_text(keys).alias("key"),
        F.col("_text").alias("row"),
        F.col(value).isNotNull().cast("int").alias("live"),
        *by.columns,
    )
    memory = ", ".join(["live int", "row string", *by.state])
    mode = "None" if ttl_ms is None else "ProcessingTime"
    found = rows.groupBy("shard").transformWithStateInPandas(Upserts(by.names, memory, ttl_ms), "row string, _sign int", "Append", mode)
    return found.select(F.from_json("row", _shape(df), _JSON).alias("_r"), "_sign").select("_r.*", "_sign")


class ClockSums(StatefulProcessor):
    """Sums per key and window of the clock, given when the clock passes the window's end."""

    def __init__(self, names: Sequence[str], size_ms: int):
        self.names, self.size_ms = list(names), size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        sums = ", ".join(f"{n} bigint" for n in self.names)
        self.open = handle.getMapState("windows", "begins bigint, key string", sums)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        begins = timerValues.getCurrentProcessingTimeInMs() // self.size_ms * self.size_ms
        sums = None
        for frame in _frames(rows):
            part = frame.groupby("key")[self.names].sum()
            sums = part if sums is None else sums.add(part, fill_value=0).astype("int64")
        if sums is None:
            return iter(())
        for k, *more in sums.itertuples(name=None):
            at = (begins, k)
            held = tuple(self.open.getValue(at)) if self.open.containsKey(at) else (0,) * len(self.names)
            self.open.updateValue(at, tuple(int(a + b) for a, b in zip(held, more)))
        self.handle.registerTimer(begins + self.size_ms)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last = expiredTimerInfo.getExpiryTimeInMs() - self.size_ms
        done = [(tuple(at), tuple(held)) for at, held in self.open.iterator() if at[0] <= last]
        for at, _ in done:
            self.open.removeKey(at)
        if done:
            yield pd.DataFrame([(*at, *held) for at, held in done], columns=["begins", "key", *self.names])

    def close(self) -> None:
        pass


def clock_sums(df: DataFrame, key: str, amounts: Mapping[str, Column], size_ms: int, shards: int = SHARDS) -> DataFrame:
    """(``_w``, key, sums): whole numbers summed per key and window of the clock at which they come.

    A window is given once the clock has passed its end, with or without further input. Nulls count as 0.
    """
    value = F.col(key).cast("string")
    rows = df.select(
        shard_of(F.coalesce(value, F.lit("")), shards), F.coalesce(F.concat(F.lit("="), value), F.lit("")).alias("key"),
        *[F.coalesce(v.cast("bigint"), F.lit(0)).cast("bigint").alias(n) for n, v in amounts.items()],
    )
    schema = ", ".join(["begins bigint", "key string", *[f"{n} bigint" for n in amounts]])
    found = rows.groupBy("shard").transformWithStateInPandas(ClockSums(list(amounts), size_ms), schema, "Append", "ProcessingTime")
    window = F.struct(F.timestamp_millis("begins").alias("start"), F.timestamp_millis(F.col("begins") + size_ms).alias("end"))
    name = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(df.schema[key].dataType).alias(key)
    return found.select(window.alias("_w"), name, *amounts)
