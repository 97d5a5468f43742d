"""Stream forms against batch forms, late rows and restarts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewell.functions import times
from tidewell.operators import dedup, joins, logs, visits
from tidewell.plans import facts, summaries
from tidewell.sources import adapters as ad
from tidewell.sources.streams import file_stream
from tidewell.streaming import runs


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="module")
def event_files(spark, events, tmp_path_factory):
    """Events in four files that follow each other in time."""
    path = str(tmp_path_factory.mktemp("events"))
    for i in range(4):
        part = events.filter(F.floor(F.col("event_id") * 4 / events.count()) == i)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture()
def stream(spark, events, event_files):
    return file_stream(spark, event_files, events.schema, max_files=1)


def closed(df, summary):
    """Windows that the watermark has passed: all but the newest ones."""
    last = df.agg(F.max(times.to_ms(F.col("ts")))).first()[0]
    return summary.filter(times.datetime_to_ms(F.col("edt")) <= last)


def test_traffic_stream_equals_batch(spark, events, stream, folder):
    got = runs.run_available(
        spark, summaries.traffic_page_view(ad.page_logs(stream), "1 hour", order=("event_id",)), folder
    )
    want = summaries.traffic_page_view(ad.page_logs(events), "1 hour", order=("event_id",))
    assert rows(got) == rows(closed(events, want))


def test_home_detail_stream_equals_batch(spark, events, stream, folder):
    got = runs.run_available(spark, summaries.home_detail_uv(ad.page_logs(stream), "1 hour"), folder)
    want = summaries.home_detail_uv(ad.page_logs(events), "1 hour")
    pages = logs.filter_pages(ad.page_logs(events))
    last = pages.agg(F.max("ts")).first()[0]
    assert rows(got) == rows(want.filter(times.datetime_to_ms(F.col("edt")) <= last))


def test_login_stream_equals_batch(spark, events, stream, folder):
    got = runs.run_available(spark, summaries.user_login(ad.page_logs(stream), "1 hour"), folder)
    want = summaries.user_login(ad.page_logs(events), "1 hour")
    last = logs.filter_logins(ad.page_logs(events)).agg(F.max("ts")).first()[0]
    assert rows(got) == rows(want.filter(times.datetime_to_ms(F.col("edt")) <= last))


def test_keyword_stream_equals_batch(spark, events, stream, folder):
    got = runs.run_available(spark, summaries.keyword_count(ad.page_logs(stream), "1 hour"), folder)
    want = summaries.keyword_count(ad.page_logs(events), "1 hour")
    last = logs.filter_searches(ad.page_logs(events)).agg(F.max("ts")).first()[0] - 3000
    assert rows(got) == rows(want.filter(times.datetime_to_ms(F.col("edt")) <= last))


def detail_rows(df):
    """Events as order lines: a line per user and order, in several versions, province by order."""
    return df.select(
        F.concat_ws("-", "user_id", F.col("event_id") % 40).alias("id"),
        (F.col("event_id") % 40).cast("string").alias("order_id"),
        (F.col("event_id") % 4).cast("string").alias("province_id"),
        (F.col("user_id") % 5).cast("string").alias("sku_id"),
        *[F.col("value").cast("decimal(16,2)").cast("string").alias(c) for c in summaries.AMOUNTS],
        times.to_ms(F.col("ts")).alias("ts_ms"),
        "event_id",
    )


def test_province_stream_equals_batch(spark, events, folder):
    names = spark.createDataFrame([(str(i), f"p{i}") for i in range(3)], "row_key string, name string")

    def summary(df):
        # Retractions come late by the time between two versions, so the delay spans the data.
        return summaries.province_order(detail_rows(df), names, "1 day", "60 days", ("ts_ms", "event_id"))

    # Two rows of another user, long after, close all windows.
    later = events.filter("event_id = 0").withColumns(
        {"ts": F.col("ts") + F.expr("INTERVAL 100 DAYS"), "user_id": F.lit(-7).cast("bigint")}
    )
    path = f"{folder}/in"
    for part in (events, later, later):
        part.coalesce(1).write.mode("append").parquet(path)
    got = runs.run_available(spark, summary(file_stream(spark, path, events.schema, max_files=1)), folder)
    assert rows(got) == rows(summary(events))


def test_cart_stream_equals_batch(spark, events, stream, folder):
    from tidewell.operators import changes

    got = runs.run_available(spark, summaries.cart_add_uu(changes.cart_add(ad.cart_info(stream)), "1 hour"), folder)
    carts = changes.cart_add(ad.cart_info(events))
    last = carts.agg(F.max("ts_ms")).first()[0]
    want = summaries.cart_add_uu(carts, "1 hour").filter(times.datetime_to_ms(F.col("edt")) <= last)
    assert rows(got) == rows(want)


def test_sku_stream_sums_each_line_once(spark, events, folder):
    """Windows go by the clock here, so only the totals per sku are compared."""
    dims = {
        name: spark.createDataFrame([("x",) * (1 + len(cols.split()))], "row_key string, " + ", ".join(f"{c} string" for c in cols.split()))
        for name, cols in {
            "sku": "sku_name spu_id category3_id tm_id", "spu": "spu_name", "trademark": "tm_name",
            "category3": "name category2_id", "category2": "name category1_id", "category1": "name",
        }.items()
    }
    path = f"{folder}/in"
    events.coalesce(1).write.parquet(path)
    df = summaries.sku_order(
        detail_rows(file_stream(spark, path, events.schema)), dims, "1 second", ("ts_ms", "event_id")
    )
    query = runs.start(df, f"{folder}/out", f"{folder}/cp", every="1 second")
    want = summaries.sku_order(detail_rows(events), dims, "100 days", ("ts_ms", "event_id"))

    def totals(frame):
        return rows(frame.groupBy("sku_id").agg(F.sum("order_amount").cast("decimal(20,2)").alias("s")))

    try:
        for i in range(40):
            query.awaitTermination(1)
            if i == 20:  # A later line moves the watermark past the windows of the first ones.
                extra = events.limit(1).withColumn("user_id", F.lit(-7).cast("bigint"))
                extra.coalesce(1).write.mode("append").parquet(path)
            if i > 25 and totals(spark.read.schema(df.schema).parquet(f"{folder}/out")) >= totals(want):
                break
        got = totals(spark.read.schema(df.schema).parquet(f"{folder}/out"))
    finally:
        query.stop()
    assert got == totals(want)


def test_fix_is_new_stream_equals_batch(spark, events, stream, folder):
    def flat(df):
        return df.select("event_id", "common.mid", "common.is_new", "ts")

    got = runs.run_available(spark, flat(visits.fix_is_new(ad.page_logs(stream), ("event_id",))), folder)
    assert rows(got) == rows(flat(visits.fix_is_new(ad.page_logs(events), ("event_id",))))


def test_fix_is_new_leaves_records_without_a_device(spark, events, folder):
    def without(df):
        none = F.when(F.col("event_id") % 3 == 0, F.lit(None)).otherwise(F.col("common.mid"))
        return ad.page_logs(df).withColumn("common", F.col("common").withField("mid", none))

    def flat(df):
        return df.select("event_id", "common.mid", "common.is_new", "ts")

    src = f"{folder}/in"
    events.coalesce(1).write.parquet(src)
    logs_in = without(file_stream(spark, src, events.schema))
    got = runs.run_available(spark, flat(visits.fix_is_new(logs_in, ("event_id",))), folder)
    want = flat(visits.fix_is_new(without(events), ("event_id",)))
    assert rows(got) == rows(want)
    assert rows(want.filter("mid IS NULL")) == rows(flat(without(events)).filter("mid IS NULL"))


def test_first_of_day_forgets_past_days(spark, events, stream, folder):
    def mids(df):
        return ad.page_logs(df).select(F.col("common.mid").alias("mid"), "ts")

    kept = {}
    for keep in (0, None):
        df = visits.first_of_day(mids(stream), ["mid"], keep_ms=keep).drop("_event_time")
        query = runs.start(df, f"{folder}/out{keep}", f"{folder}/cp{keep}", once=True)
        assert query.awaitTermination(300)
        kept[keep] = query.lastProgress.stateOperators[0].numRowsTotal
        got = spark.read.schema(df.schema).parquet(f"{folder}/out{keep}")
        assert rows(got) == rows(visits.first_of_day(mids(events), ["mid"]))
    today = mids(events).groupBy("mid").agg(F.max("ts").alias("ts"))
    assert kept[0] < kept[None] and kept[None] >= today.count()


def test_retract_stream_equals_batch(spark, events, stream, folder):
    def versions(df):
        return df.select(
            F.col("user_id").cast("string").alias("id"), "event_id",
            F.col("value").cast("decimal(16,2)").cast("string").alias("amount"),
        )

    got = runs.run_available(spark, dedup.retract(versions(stream), "id", ["event_id"], ["amount"]), folder)
    assert rows(got) == rows(dedup.retract(versions(events), "id", ["event_id"], ["amount"]))


def test_bloom_stream_loses_no_row_when_sized(spark, events, stream, folder):
    got = runs.run_available(
        spark, dedup.bloom(stream.select("user_id", "event_type"), ["user_id", "event_type"], 1_000_000, 1e-6, 4), folder
    )
    assert rows(got) == rows(events.select("user_id", "event_type").distinct())


def test_interval_join_stream_equals_batch(spark, events, stream, event_files, folder):
    other = file_stream(spark, event_files, events.schema, max_files=1)

    def join(left, right, delay=None):
        return joins.interval_join(
            ad.timed_events(left), ad.shifted_events(right, 180_000), ("uid", "uid"), "ts_ms",
            "-5 minutes", "5 minutes", right_columns={"height": "height"}, delay=delay,
        )

    got = runs.run_available(spark, join(stream, other, "1 hour"), folder)
    assert rows(got) == rows(join(events, events))


def test_exact_dedup_stream(spark, events, stream, folder):
    twice = stream.unionAll(stream).select("event_id", times.to_ms(F.col("ts")).alias("ts_ms"))
    got = runs.run_available(spark, dedup.exact(twice, ["event_id", "ts_ms"], delay="1 day").drop("_event_time"), folder)
    assert got.count() == events.count()


def test_latest_stream_waits_for_its_timer(spark, stream, events, folder):
    df = dedup.latest(stream.select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"], wait_ms=2000)
    query = runs.start(df, f"{folder}/out", f"{folder}/cp", every="1 second")
    want = rows(dedup.latest(events.select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"]))
    try:
        for _ in range(60):
            query.awaitTermination(1)
            got = spark.read.schema(df.schema).parquet(f"{folder}/out") if _ > 8 else None
            # A version may be emitted before a later one came; the last one must come too.
            if got is not None and not (want - rows(got)):
                break
    finally:
        query.stop()
    assert not (want - rows(got))


def test_late_rows_are_dropped(spark, folder, tmp_path):
    src = str(tmp_path / "in")
    schema = "ts bigint, page struct<last_page_id:string,item_type:string,item:string>"

    def put(*minutes):
        data = [(m * 60_000, ("search", "keyword", "red")) for m in minutes]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)

    put(1, 10)
    put(11)
    put(2)
    put(30)
    df = summaries.keyword_count(
        file_stream(spark, src, spark.read.parquet(src).schema, max_files=1), "1 minute", "3 seconds"
    )
    got = runs.run_available(spark, df, folder)
    # Minute 2 came when the watermark was already past it; minute 30 is still open.
    assert sorted(r.stt[14:16] for r in got.collect()) == ["01", "10", "11"]


def test_restart_goes_on_from_the_checkpoint(spark, events, folder, tmp_path):
    src = str(tmp_path / "in")
    half = events.count() // 2
    events.filter(F.col("event_id") < half).coalesce(1).write.mode("append").parquet(src)

    def run():
        df = visits.first_of_day(
            ad.page_logs(file_stream(spark, src, events.schema)).select(F.col("common.mid").alias("mid"), "ts"), ["mid"]
        ).drop("_event_time")
        return runs.run_available(spark, df, folder)

    first = run().count()
    events.filter(F.col("event_id") >= half).coalesce(1).write.mode("append").parquet(src)
    got = run()
    want = visits.first_of_day(ad.page_logs(events).select(F.col("common.mid").alias("mid"), "ts"), ["mid"])
    assert 0 < first < got.count()
    assert rows(got) == rows(want)


def test_fact_join_stream_drops_state_after_its_horizon(spark, folder, tmp_path):
    src = str(tmp_path / "in")
    schema = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"

    def put(*data):
        made = [(None, after, {"table": table}, "r", ts) for table, after, ts in data]
        spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(src)

    def order(i, ts):
        return ("order_info", {"id": i, "user_id": "u", "province_id": "1", "order_status": "1006"}, ts)

    def refund(i, o, ts):
        return ("order_refund_info", {"id": i, "order_id": o, "create_time": "0"}, ts)

    minute = 60_000
    put(order("1", 100 * minute), order("2", 100 * minute), refund("a", "1", 101 * minute))
    put(refund("b", "2", 129 * minute), refund("c", "1", 131 * minute))
    topic = file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    df = facts.order_refund(topic, delay="1 minute")
    got = runs.run_available(spark, df, folder)
    # Refund c is 31 minutes after its order.
    assert sorted(r.id for r in got.collect()) == ["a", "b"]


def test_dropped_rows_are_counted(spark, tmp_path):
    """Late rows of distinct keys: the table of losses counts each of them, per operator."""
    from tidewell.streaming import losses

    src, day = str(tmp_path / "in"), 86_400_000
    parts = [
        [(i, 100 * day + i) for i in range(5)],
        [(i, 200 * day + i) for i in range(5, 9)],
        [(20 + i, 50 * day + i * 3_600_000) for i in range(7)] + [(40, 200 * day)],  # seven come too late
        [(60, 300 * day), (61, 10 * day)],  # one more
    ]
    for part in parts:
        spark.createDataFrame(part, "k int, ts_ms bigint").coalesce(1).write.mode("append").parquet(src)
    schema = spark.read.parquet(src).schema
    listener = losses.watch(spark, str(tmp_path / "losses"))
    try:
        once = dedup.exact(file_stream(spark, src, schema, max_files=1), ["k"], delay="1 minute")
        got = runs.run_available(spark, once, str(tmp_path / "dedup"))
        windows = summaries.tumble(joins.with_event_time(file_stream(spark, src, schema, max_files=1), "1 minute"), "_event_time", "1 hour", ["k"], [F.count("*").alias("n")])
        runs.run_available(spark, windows, str(tmp_path / "windows"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        counts = sorted(r.dropped for r in losses.dropped(spark, str(tmp_path / "losses")).collect())
    finally:
        spark.streams.removeListener(listener)
    assert got.count() == 5 + 4 + 1 + 1
    assert counts == [8, 8]
