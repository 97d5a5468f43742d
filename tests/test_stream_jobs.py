from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import changes, merges
from tidewell.plans import facts, jobs, stream_jobs, summaries
from tidewell.sources import adapters as ad
from tidewell.sources.changes import envelope_messages, change_view, with_maps
from tidewell.sources.streams import file_stream, text_stream
from tidewell.streaming import sinks


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def finish(*queries):
    for q in queries:
        assert q.awaitTermination(120)


def test_log_topics(spark, events, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    few = events.filter("event_id < 400")
    # Each record once per device, so that arrival order within the one batch does not matter.
    good = ad.log_messages(few).select("value")
    bad = few.filter("event_type = 'error'").select(F.lit("{broken").alias("value"))
    good.unionAll(bad).coalesce(1).write.text(src)
    finish(*stream_jobs.split_logs(text_stream(spark, src), root, once=True))
    want = jobs.split_log_messages(good.unionAll(bad))
    for kind, topic in {**stream_jobs.LOG_TOPICS, "dirty": stream_jobs.DIRTY_TOPIC}.items():
        got = sinks.read_topic_files(spark, f"{root}/{kind}")
        assert {r.topic for r in got.select("topic").distinct().collect()} == {topic}
        assert got.count() == want[kind].count()


def test_dim_tables(spark, small, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    customer = with_maps(ad.user_info(ad.table(spark, small, "customer")))
    other = with_maps(ad.payment_info(ad.table(spark, small, "orders")))
    renamed = customer.withColumn(
        "after", F.map_concat(F.map_filter("after", lambda k, _: k == "id"), F.create_map(F.lit("name"), F.lit("new")))
    ).withColumn("ts_ms", F.col("ts_ms") + 1)
    for part in (customer.unionAll(other), renamed.filter(F.col("after")["id"].cast("int") < 3)):
        envelope_messages(part).coalesce(1).write.mode("append").text(src)
    topic = change_view(text_stream(spark, src, max_files=1))
    finish(stream_jobs.load_dims(topic, lambda: ad.dim_config(spark), ad.DB, root, once=True))
    got = stream_jobs.read_dim(spark, root, "dim_user_info")
    assert got.count() == customer.count()
    byid = {r.row_key: r for r in got.collect()}
    # The second change brought a name only: what it left out is kept.
    assert byid["1"].name == "new" and byid["1"].user_level is not None
    assert byid["5"].name == "Customer#000000005"
    # No row of this table came, so nothing was written for it.
    assert stream_jobs.read_dim(spark, root, "dim_order_info") is None


def test_cart_table(spark, events, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    carts = with_maps(ad.cart_info(events))
    for half in ("ts_ms % 2 = 0", "ts_ms % 2 = 1"):
        envelope_messages(carts.filter(half)).coalesce(1).write.mode("append").text(src)
    topic = change_view(text_stream(spark, src, max_files=1))
    finish(stream_jobs.cart_table(topic, root, once=True))
    want = merges.partial_update(
        changes.typed_cart_changes(carts), ["id", "ds"], stream_jobs.CART_COLUMNS, ["ts_ms"]
    )
    assert len(list((tmp_path / "out" / "table").glob("batch=*"))) == 2
    assert rows(stream_jobs.read_carts(spark, root)) == rows(want)


ENVELOPE = "before map<string,string>, after map<string,string>, source map<string,string>, op string, ts_ms bigint"
MINUTE, DAY = 60_000, 86_400_000


def envelopes(spark, *data):
    made = [(before, after, {"table": table, "db": ad.DB}, op, ts) for table, op, before, after, ts in data]
    return spark.createDataFrame(made, ENVELOPE).coalesce(1)


def trade(at, numbers):
    """Changes of all trade tables, some minutes after each other, for the given orders."""
    for n in numbers:
        t, o = at + n * MINUTE, str(n)
        status = ["1001", "1003", "1006"][n % 3]
        order = {"id": o, "user_id": f"u{n}", "province_id": str(n % 2), "order_status": status, "operate_time": str(t)}
        yield "order_info", "r", None, order, t
        for i in (1, 2):
            line = f"{o}-{i}"
            yield "order_detail", "r", None, {
                "id": line, "order_id": o, "sku_id": str(i), "sku_name": "s", "create_time": str(t), "sku_num": "2",
                "order_price": "1.50", "split_total_amount": "3.00", "split_activity_amount": "0", "split_coupon_amount": "0",
            }, t + 1000
        yield "order_detail_activity", "r", None, {"order_detail_id": f"{o}-1", "activity_id": "a", "activity_rule_id": "ar"}, t + 1000
        yield "order_detail_coupon", "r", None, {"order_detail_id": f"{o}-2", "coupon_id": "c"}, t + 1000
        yield "payment_info", "r", None, {
            "user_id": f"u{n}", "order_id": o, "payment_type": "p", "callback_time": str(t), "payment_status": "1602"
        }, t + 2000
        yield "order_refund_info", "r", None, {
            "id": f"r{n}", "order_id": o, "sku_id": "1", "refund_num": "1", "refund_amount": "1", "refund_status": "0705", "create_time": str(t)
        }, t + 3000
        yield "refund_payment", "r", None, {
            "id": f"q{n}", "order_id": o, "sku_id": "1", "payment_type": "p", "callback_time": str(t), "total_amount": "1", "refund_status": "1602"
        }, t + 4000
        yield "cart_info", "r", None, {"id": o, "user_id": f"u{n}", "sku_id": "1", "sku_num": "2"}, t
        yield "comment_info", "r", None, {"id": o, "order_id": o, "appraise": "1", "comment_txt": "fine"}, t


def batch_fact(name, topic):
    if name == "cart_add":
        return changes.cart_add(topic)
    if name == "comments":
        return changes.flatten_comments(topic)
    if name in ("pay_success", "order_cancel"):
        return getattr(facts, name)(topic, facts.order_detail(topic))
    return getattr(facts, name)(topic)


@pytest.fixture(scope="module")
def trade_files(spark, tmp_path_factory):
    """Orders in two files, and two files of orders long after, which let all joins close."""
    src = str(tmp_path_factory.mktemp("trade"))
    start = 20_000 * DAY
    first, second = list(trade(start, range(6))), list(trade(start, range(6, 12)))
    for part in (first, second, list(trade(start + 3 * DAY, [12, 13, 14])), list(trade(start + 6 * DAY, [15, 16, 17]))):
        envelopes(spark, *part).write.mode("append").parquet(src)
    return src, envelopes(spark, *first, *second)


@pytest.mark.parametrize("name", stream_jobs.FACT_TOPICS)
def test_fact_topics_equal_batch(spark, trade_files, tmp_path, name):
    src, all_changes = trade_files
    topic = file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
    finish(*stream_jobs.write_facts(topic, str(tmp_path), "1 minute", [name], once=True).values())
    target = stream_jobs.FACT_TOPICS[name]
    want = batch_fact(name, all_changes)
    sent = sinks.read_topic_files(spark, f"{tmp_path}/{target}")
    got = sent.select(F.from_json("value", want.schema).alias("r")).select("r.*").filter(F.col("ts_ms") < 20_002 * DAY)
    assert rows(want) and rows(got) == rows(want)
    assert {r.topic for r in sent.select("topic").distinct().collect()} == {target}


def test_traffic_tables_equal_batch(spark, events, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(2):
        events.filter(F.floor(F.col("event_id") * 2 / events.count()) == i).coalesce(1).write.mode("append").parquet(src)
    pages = ad.page_logs(file_stream(spark, src, events.schema, max_files=1))
    finish(*stream_jobs.write_traffic(pages, root, "1 hour", "3 seconds", once=True).values())
    for name in ("keyword_count", "traffic_page_view", "home_detail_uv", "user_login"):
        want = getattr(summaries, name)(ad.page_logs(events), "1 hour")
        got = sinks.read_table(spark, f"{root}/{stream_jobs.SUMMARY_TABLES[name]}", want.schema)
        if name == "traffic_page_view":
            # Which view of a millisecond is the first is not said without an order.
            want, got = (d.groupBy("stt").agg(F.sum("pv_ct").alias("pv"), F.sum("uv_ct").alias("uv")) for d in (want, got))
        missing = rows(want) - rows(got)
        # Only windows that are still open are missing: those of the last hours.
        assert not rows(got) - rows(want) and rows(got)
        newest = want.agg(F.max("stt")).first()[0]
        spot = sorted(want.columns).index("stt")
        assert all(r[spot] >= newest[:10] for r in missing)


def test_names_are_those_of_the_moment(spark, trade_files, tmp_path):
    src, _ = trade_files
    lines = str(tmp_path / "lines")
    for part in range(4):
        made = [(f"{part}-{i}", f"o{part}", str(i % 2), "1.00", (20_000 + 3 * part) * DAY + i) for i in range(4)]
        spark.createDataFrame(
            made, "id string, order_id string, province_id string, split_total_amount string, ts_ms bigint"
        ).coalesce(1).write.mode("append").parquet(lines)
    table = sinks.CellTable(spark, str(tmp_path / "provinces"), ["row_key"])
    calls = []

    def names(*pairs):
        rows = spark.createDataFrame([(*p, "c", 1) for p in pairs], "k string, name string, op string, ts bigint")
        return merges.dim_cells(rows, "k", ["name"], ["ts"])

    table.add(names(("0", "north")), 0)

    def read():
        calls.append(1)
        found = merges.dim_values(table.cells())
        if len(calls) == 1:
            # Another job loads a province while this one runs.
            table.add(names(("1", "south")), 1)
        return found

    details = file_stream(spark, lines, spark.read.parquet(lines).schema, max_files=1)
    # State with a lifetime makes micro-batches without end, so the job is stopped.
    query = stream_jobs.write_provinces(details, read, str(tmp_path), "1 day", ttl_ms=DAY)
    schema = T.StructType().add("province_name", "string").add("order_count", "long")
    found = set()
    try:
        for _ in range(90):
            query.awaitTermination(1)
            if len(calls) > 1:
                got = sinks.read_table(spark, f"{tmp_path}/{stream_jobs.SUMMARY_TABLES['province_order']}", schema)
                found = {tuple(r) for r in got.collect()}
                if {"north", "south"} <= {name for name, _ in found}:
                    break
    finally:
        query.stop()
    assert found >= {("north", 1), ("south", 1)} and {n for _, n in found} == {1}


def test_cart_summary_table(spark, events, tmp_path):
    src = str(tmp_path / "in")
    events.coalesce(1).write.parquet(src)
    carts = changes.cart_add(ad.cart_info(file_stream(spark, src, events.schema)))
    finish(stream_jobs.write_carts(carts, str(tmp_path), "1 hour", once=True))
    want = summaries.cart_add_uu(changes.cart_add(ad.cart_info(events)), "1 hour")
    got = sinks.read_table(spark, f"{tmp_path}/{stream_jobs.SUMMARY_TABLES['cart_add_uu']}", want.schema)
    assert rows(got) and not rows(got) - rows(want)


def test_order_lines_out_of_their_topic(spark, trade_files, tmp_path):
    _, all_changes = trade_files
    want = facts.order_detail(all_changes)
    sinks.write_topic_files(stream_jobs.shapes.to_messages(want, "lines"), str(tmp_path))
    got = stream_jobs.read_order_lines(sinks.read_topic_files(spark, str(tmp_path)), "1 minute")
    assert rows(got) == rows(want)


def test_configuration_from_its_changes(spark, tmp_path):
    src, root, dims = (str(tmp_path / n) for n in ("in", "config", "dims"))

    def rule(table, columns="id,name"):
        return {
            "source_table": table, "sink_table": f"dim_made_{table}", "sink_columns": columns, "sink_family": "info",
            "sink_row_key": "id", "op": "r",
        }

    def change(*data):
        envelopes(spark, *data).write.mode("append").parquet(src)
        topic = file_stream(spark, src, spark.read.parquet(src).schema, max_files=1)
        finish(stream_jobs.follow_config(topic, root, dims, "default", once=True))

    def load(table, key, ts):
        path = str(tmp_path / "topic")
        envelopes(spark, (table, "r", None, {"id": key, "name": "n", "extra": "x"}, ts)).write.mode("append").parquet(path)
        topic = file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)
        finish(stream_jobs.load_dims(topic, lambda: stream_jobs.read_config(spark, root), ad.DB, dims, once=True))

    def dim(table):
        found = stream_jobs.read_dim(spark, dims, f"dim_made_{table}")
        return None if found is None else sorted(tuple(r) for r in found.collect())

    load("a", "0", 0)  # There is no configuration yet.
    change(("cfg", "r", None, rule("a"), 1), ("cfg", "c", None, rule("b", "id"), 2))
    load("a", "1", 1)
    load("b", "1", 2)
    assert dim("a") == [("1", "1", "n")] and dim("b") == [("1", "1")]
    assert len(sinks.CellTable(spark, f"{dims}/dim_made_a", ["row_key"]).folders()) == 1
    assert spark.table("dim_made_a").columns == ["row_key", "id", "name"]
    change(("cfg", "d", rule("b", "id"), None, 3), ("cfg", "u", rule("a"), rule("a", "id,extra"), 4))
    assert dim("a") is None and dim("b") is None
    load("a", "2", 3)
    load("b", "2", 4)
    assert dim("a") == [("2", "2", "x")] and dim("b") is None
    # Micro-batches run in a session of their own.
    spark.catalog.refreshTable("dim_made_a")
    assert not spark.catalog.tableExists("dim_made_b") and spark.table("dim_made_a").columns == ["row_key", "id", "extra"]
    spark.sql("DROP TABLE dim_made_a")


def test_moderation_stream_equals_batch(spark, small, tmp_path):
    docs = ad.table(spark, small, "documents")
    src = str(tmp_path / "in")
    comments = ad.comments_for_check(docs)
    comments.coalesce(1).write.parquet(src)
    words = ad.banned_words(docs)
    stream = file_stream(spark, src, comments.schema)
    finish(stream_jobs.write_ban_list(stream, lambda: words, "checked", str(tmp_path), once=True))
    # Which of several copies stays is open on a stream, so the text decides.
    want = jobs.ban_list(comments, words, ["doc_id"])
    sent = sinks.read_topic_files(spark, f"{tmp_path}/checked")
    got = sent.select(F.from_json("value", want.schema).alias("r")).select("r.*")
    assert rows(got.drop("doc_id")) == rows(want.drop("doc_id"))
