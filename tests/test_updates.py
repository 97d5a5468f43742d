"""Changes on streams fold to the batch result; state that begins with a batch; windows by the clock."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_stream_jobs import ENVELOPE, DAY, finish, trade
from test_streams import detail_rows

from tidewell.operators import dedup, merges, visits
from tidewell.plans import facts, stream_jobs, summaries
from tidewell.sources import adapters as ad
from tidewell.sources.streams import file_stream
from tidewell.streaming import runs, sinks, state, updates
from tidewell.streaming.bloom import BlockedBloom


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def in_files(spark, path, *frames):
    for frame in frames:
        frame.coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, frames[0].schema, max_files=1)


def test_left_join_gives_rows_at_once_and_corrects_them(spark, tmp_path):
    made = [
        ("l", "1", "x"), ("l", "1", "x"), ("l", "2", "y"), ("l", None, "z"), ("a", "3", "early"), ("a", None, "lost"),
        ("a", "1", "a1"), ("l", "3", "w"), ("b", "2", "b2"), ("a", "1", "a2"), ("b", "1", None), ("a", "9", "alone"),
    ]
    frames = [spark.createDataFrame(made[i : i + 4], "side string, k string, v string") for i in (0, 4, 8)]

    def sides(df):
        left = df.filter("side = 'l'").select("k", "v")
        return left, df.filter("side = 'a'").select(F.col("k").alias("ak"), F.col("v").alias("av")), df.filter("side = 'b'").select(F.col("k").alias("bk"), F.col("v").alias("bv"))

    left, a, b = sides(in_files(spark, str(tmp_path / "in"), *frames))
    got = runs.run_available(spark, updates.left_join(left, [(a, "ak"), (b, "bk")], "k"), str(tmp_path))
    left, a, b = sides(frames[0].unionAll(frames[1]).unionAll(frames[2]))
    want = left.join(a, F.col("k") == F.col("ak"), "left").join(b, F.col("k") == F.col("bk"), "left")
    assert rows(updates.folded(got)) == rows(want)
    found = Counter(tuple(r) for r in got.select("k", "av", "bv", "_sign").collect())
    assert found["2", None, None, 1] == found["2", None, None, -1] == 1  # came before its match, and was taken back
    assert found["3", None, None, 1] == 0  # its match was there


def test_order_lines_at_once(spark, tmp_path):
    changes = list(trade(20_000 * DAY, range(4)))
    late = [c for c in changes if c[0] in ("order_detail_activity", "order_detail_coupon")]
    early = [c for c in changes if c not in late]

    def envelopes(part):
        made = [(before, after, {"table": table, "db": ad.DB}, op, ts) for table, op, before, after, ts in part]
        return spark.createDataFrame(made, ENVELOPE)

    topic = in_files(spark, str(tmp_path / "in"), envelopes(early), envelopes(late[:3]), envelopes(late[3:]))
    finish(stream_jobs.write_order_updates(topic, str(tmp_path), "1 minute", once=True))
    want = facts.order_detail(envelopes(changes))
    shape = T.StructType([*want.schema.fields, T.StructField("_sign", T.IntegerType())])
    sent = sinks.read_topic_files(spark, f"{tmp_path}/{stream_jobs.FACT_TOPICS['order_detail']}")
    got = sent.select(F.from_json("value", shape).alias("r")).select("r.*")
    assert rows(want) and rows(updates.folded(got)) == rows(want)
    # No line waited for its activity or coupon.
    assert got.filter("_sign = 1 AND activity_id IS NULL AND coupon_id IS NULL").count() == 8


@pytest.mark.parametrize("seed", [0, 1])
def test_upserts_and_tombstones_as_changes(spark, tmp_path, seed):
    rng = random.Random(seed)
    made = [(rng.choice(["a", "b", "c", None]), rng.randrange(12), rng.choice([None, "x", "y", "z"]), (1 << 60) + i) for i in range(60)]
    df = spark.createDataFrame(made, "k string, n int, v string, big bigint")
    # Equal versions are told apart by the whole row.
    frames = [spark.createDataFrame(made[i::3], df.schema) for i in range(3)]
    stream = in_files(spark, str(tmp_path / "in"), *frames)
    got = runs.run_available(spark, updates.upsert_changes(stream, ["k"], ["n", "big"], "v"), str(tmp_path))
    want = merges.upsert_latest(df, ["k"], ["n", "big"], "v")
    assert rows(updates.folded(got)) == rows(want)
    assert got.filter("_sign = -1").count() > 0


def test_clock_windows_close_without_input(spark, events, tmp_path):
    """All lines come at once and nothing after them; still every window comes out, named and summed."""
    names = {
        "sku": "sku_name spu_id category3_id tm_id", "spu": "spu_name", "trademark": "tm_name",
        "category3": "name category2_id", "category2": "name category1_id", "category1": "name",
    }
    dims = {
        n: spark.createDataFrame([("1",) * (1 + len(c.split()))], "row_key string, " + ", ".join(f"{x} string" for x in c.split()))
        for n, c in names.items()
    }
    stream = in_files(spark, str(tmp_path / "in"), events)
    query = stream_jobs.write_skus(detail_rows(stream), lambda: dims, str(tmp_path), "1 second", ("ts_ms", "event_id"))
    want = summaries.sku_order(detail_rows(events), dims, "100 days", ("ts_ms", "event_id"))
    out = f"{tmp_path}/{stream_jobs.SUMMARY_TABLES['sku_order']}"

    def totals(df):
        return rows(df.groupBy("sku_id", "category1_name").agg(*[F.sum(c).cast("decimal(26,2)").alias(c) for c in summaries.AMOUNTS.values()]))

    got = None
    try:
        for _ in range(90):
            query.awaitTermination(1)
            if (tmp_path / stream_jobs.SUMMARY_TABLES["sku_order"]).exists():
                got = totals(sinks.read_table(spark, out, want.schema))
                if got == totals(want):
                    break
    finally:
        query.stop()
    assert got == totals(want)


def test_streams_begin_with_the_result_of_a_batch(spark, events, tmp_path):
    half = events.count() // 2
    old, new = ad.page_logs(events.filter(F.col("event_id") < half)), events.filter(F.col("event_id") >= half)
    every = ad.page_logs(events)

    def streamed(name, make):
        return runs.run_available(spark, make(ad.page_logs(in_files(spark, str(tmp_path / name / "in"), new))), str(tmp_path / name))

    def flat(df):
        return df.select(F.col("common.mid").alias("mid"), "event_id", "ts")

    args = (["mid"], "ts", ["event_id"], ["event_id"])
    before = visits.first_of_day(flat(old), *args)
    got = streamed("first", lambda s: visits.first_of_day(flat(s), *args, start=before)).drop("_event_time")
    assert rows(got) + rows(before) == rows(visits.first_of_day(flat(every), *args))

    def logins(df):
        return df.select(F.col("common.uid").alias("uid"), "ts")

    before = visits.return_logins(logins(old))
    got = streamed("logins", lambda s: visits.return_logins(logins(s), start=before)).drop("_event_time")
    assert rows(got) + rows(before) == rows(visits.return_logins(logins(every)))

    def fixed(df):
        return df.select("event_id", "common.is_new", "common.mid")

    before = visits.first_dates(old, ["event_id"])
    got = streamed("fixed", lambda s: visits.fix_is_new(s, ["event_id"], start=before))
    assert rows(fixed(got)) + rows(fixed(visits.fix_is_new(old, ["event_id"]))) == rows(fixed(visits.fix_is_new(every, ["event_id"])))

    order = ("ts_ms", "event_id")
    lines = detail_rows(events.filter(F.col("event_id") < half))
    stream = detail_rows(in_files(spark, str(tmp_path / "lines" / "in"), new))
    start = dedup.latest(lines, ["id"], order)
    got = runs.run_available(spark, dedup.retract(stream, "id", order, ["split_total_amount"], start=start), str(tmp_path / "lines"))

    def sums(df):
        return {r.id: r.s for r in df.groupBy("id").agg(F.sum(F.col("split_total_amount").cast("decimal(20,2)")).alias("s")).collect()}

    whole = dedup.retract(lines, "id", order, ["split_total_amount"]).unionByName(got)
    assert sums(whole) == sums(dedup.latest(detail_rows(events), ["id"], order))
    with pytest.raises(ValueError):
        visits.first_of_day(flat(old), *args, start=before)


def test_changes_go_on_after_a_snapshot(spark, tmp_path):
    """Random changes while chunks are read at any moment between their marks; the changes then come as a stream."""
    from tidewell.sources import snapshots

    rng = random.Random(11)
    table, history = {k: 100 + k for k in range(40)}, []
    states = [dict(table)]
    for at in range(1, 301):
        k = rng.randrange(50)
        op = "d" if k in table and rng.random() < 0.3 else "u" if k in table else "c"
        table.pop(k, None) if op == "d" else table.update({k: at})
        history.append((k // 10, k, None if op == "d" else at, op, at))
        states.append(dict(table))
    marks = [(c, low := rng.randrange(150), low + rng.randrange(100)) for c in range(5)]
    read = []
    for c, low, high in marks:
        for k in range(10 * c, 10 * c + 10):
            seen = states[rng.randint(low, high)]  # each row at a moment of its own
            if k in seen:
                read.append((c, k, seen[k]))
    shape = "chunk bigint, id bigint, v bigint"
    read, marks = spark.createDataFrame(read, shape), spark.createDataFrame(marks, "chunk bigint, low bigint, high bigint")
    made = spark.createDataFrame(history, f"{shape}, op string, position bigint")
    frames = [made.filter(f"position % 3 = {i}") for i in range(3)]
    stream = in_files(spark, str(tmp_path / "in"), *frames)
    tail = runs.run_available(spark, snapshots.changes_after(stream, marks, "position"), str(tmp_path))
    rows_read = snapshots.settled(read, made, marks, ["id"], "position")
    whole = rows_read.unionByName(tail)
    assert rows(whole) == rows(snapshots.snapshot_then_changes(read, made, marks, ["id"]))
    final = merges.upsert_latest(whole, ["id"], ["position"], "v")
    assert {r.id: r.v for r in final.collect()} == table
    # Nothing twice: a row's snapshot and its changes have positions of their own.
    assert whole.groupBy("id", "position").count().filter("count > 1 AND id IS NOT NULL").count() == 0


class Blocks(dict):
    """A map state in memory that counts what is written."""

    written = 0

    def containsKey(self, key):
        return key in self

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self.written += len(value[0])
        self[key] = value


def test_written_blocks_follow_the_new_rows():
    import pandas as pd

    rng = np.random.default_rng(1)
    h = rng.integers(-(1 << 63), 1 << 63, (200_000, 2), dtype=np.int64)

    def frame(some):
        return pd.DataFrame({"h1": some[:, 0], "h2": some[:, 1], "row": [str(i) for i in range(len(some))]})

    shard = state.BloomShard(1_000_000, 0.01)
    shard.blocks = Blocks()

    def fresh(some):
        return sum(len(f) for f in shard.handleInputRows((0,), iter([frame(some)]), None))

    assert fresh(np.repeat(h[:20], 3, axis=0)) == 20
    assert shard.blocks.written <= 20 * BlockedBloom.BLOCK < BlockedBloom.sized(1_000_000, 0.01).blocks * BlockedBloom.BLOCK / 10
    before = shard.blocks.written
    assert fresh(h[:20]) == 0 and shard.blocks.written == before
    shard.expected = 200_000
    shard.blocks = Blocks()
    lost = len(h) - fresh(h)
    assert fresh(h) == 0 and lost < 0.01 * len(h)
