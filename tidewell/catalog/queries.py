"""One query per operator, over the supplied tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions import lexicon, money, people, text, times
from tidewell.operators import (
    changes,
    dedup,
    joins,
    logs,
    merges,
    moderation,
    shapes,
    visits,
)
from tidewell.operators.once import with_column_once
from tidewell.plans import facts, jobs, summaries
from tidewell.session import configure, shared_dir
from tidewell.sources import adapters as ad
from tidewell.sources import changes as cdc
from tidewell.sources import dims, snapshots
from tidewell.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WINDOW = "1 hour"
TRADE_WINDOW = "1 day"
AS_OF = "2024-06-30"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Text dates and epoch times are only comparable in one zone, UTC.
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/tidewell-{name}-{uuid.uuid4().hex}"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.page_logs(ad.table(spark, sf_dir, "events"))


def detail_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in several versions: the line number is not unique within an order."""
    lines = ad.order_detail(ad.table(spark, sf_dir, "lineitem"), ad.LINE_KEY)
    return facts.order_lines(lines).selectExpr(
        "id",
        "order_id",
        "sku_id",
        "CAST(CAST(source_id AS BIGINT) % 27 AS STRING) AS province_id",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
        "ts_ms",
        "CAST(sku_id AS BIGINT) AS part_no",
        "CAST(source_id AS BIGINT) AS supp_no",
    )


VERSION_ORDER = ("ts_ms", "part_no", "supp_no")


# --- sources ----------------------------------------------------------------------------------


@query
def src_event_stream(spark, sf_dir):
    """Messages as text, as the stream source hands them on."""
    return ad.log_messages(ad.table(spark, sf_dir, "events")).select(
        "event_id",
        F.get_json_object("value", "$.common.mid").alias("mid"),
        F.get_json_object("value", "$.ts").alias("ts"),
    )


@query
def src_cdc_map_view(spark, sf_dir):
    """Orders as JSON envelopes, parsed into maps."""
    orders = ad.order_info(ad.table(spark, sf_dir, "orders"), mixed_ops=True)
    messages = cdc.envelope_messages(cdc.with_maps(orders))
    view = cdc.change_view(messages)
    return view.select(
        F.col("source")["table"].alias("table"),
        "op",
        "ts_ms",
        F.col("after")["id"].alias("after_id"),
        F.col("before")["id"].alias("before_id"),
        F.col("after")["total_amount"].alias("total_amount"),
    )


@query
def src_cdc_typed_view(spark, sf_dir):
    """The same envelopes, parsed into the fields that are asked for."""
    orders = ad.order_info(ad.table(spark, sf_dir, "orders"), mixed_ops=True)
    messages = cdc.envelope_messages(cdc.with_maps(orders))
    view = cdc.typed_view(messages, ("id", "total_amount"))
    return view.select(
        F.col("source")["table"].alias("table"),
        "op",
        "ts_ms",
        F.col("after.id").alias("after_id"),
        F.col("before.id").alias("before_id"),
        F.col("after.total_amount").alias("total_amount"),
    )


@query
def cdc_snapshot_envelope(spark, sf_dir):
    """A table snapshot as JSON change messages."""
    customer = ad.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    rows = cdc.snapshot_envelopes(customer, ad.DB, "customer", F.expr(ad.USER_MS))
    return cdc.envelope_messages(rows)


@query
def rename_snake_to_camel(spark, sf_dir):
    return shapes.camel_columns(
        ad.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    )


SUPPLIER = {"s_name": "supplier_name", "s_nationkey": "nation_key"}


def _supplier_dim(spark, sf_dir):
    return dims.as_dim(ad.table(spark, sf_dir, "supplier"), "s_suppkey", SUPPLIER)


@query
def dim_point_lookup(spark, sf_dir):
    return dims.find_row(ad.table(spark, sf_dir, "supplier"), "s_suppkey", SUPPLIER, "7", camel=True)


@query
def dim_scan_limit(spark, sf_dir):
    return dims.scan(_supplier_dim(spark, sf_dir), 5)


@query
def dim_row_count(spark, sf_dir):
    return dims.count_rows(_supplier_dim(spark, sf_dir))


# --- sinks and merges ---------------------------------------------------------------------------


@query
def sink_json_lines(spark, sf_dir):
    """Events written as messages of one topic and read back."""
    events = ad.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path = scratch(spark, "topic")
    sinks.write_topic_files(shapes.to_messages(events, "dwd_events"), path)
    return sinks.read_topic_files(spark, path)


@query
def route_dynamic_topic(spark, sf_dir):
    topic = ad.topic_db(spark, sf_dir)
    sent = shapes.route_topics(topic, ad.fact_config(spark), tables=ad.FACT_SOURCES)
    keys = ("id", "name", "login_name", "order_id", "payment_type", "payment_status")
    return with_column_once(sent, "body", F.col("value")).select(
        "topic", *[F.get_json_object("body", f"$.{k}").alias(k) for k in keys]
    )


@query
def upsert_latest_by_key(spark, sf_dir):
    """Newest purchase value per user; a user whose newest event is an error is deleted."""
    rows = ad.table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("value"),
    )
    return merges.upsert_latest(rows, ["user_id"], ["event_id"], "value")


@query
def sink_summary_table(spark, sf_dir):
    """The traffic summary written to an append table as JSON lines and read back."""
    rows = shapes.to_snake_json(summaries.traffic_page_view(pages(spark, sf_dir), WINDOW, order=("event_id",)))
    path = scratch(spark, "summary")
    schema = "stt string, edt string, cur_date string, vc string, ch string, ar string, is_new string, uv_ct bigint, sv_ct bigint, pv_ct bigint, dur_sum bigint"
    parsed = with_column_once(rows, "r", F.from_json("value", schema)).select("r.*")
    sinks.append_table(parsed, path)
    return spark.read.schema(schema).json(f"{path}/batch=0")


def _cart_puts(spark, sf_dir):
    carts = ad.cart_info(ad.table(spark, sf_dir, "events"))
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    rows = carts.select(
        row["user_id"].alias("row_key"),
        row["sku_num"].alias("sku_num"),
        row["is_ordered"].alias("is_ordered"),
        row["operate_time"].alias("operate_time"),
        "op",
        "ts_ms",
        row["id"].cast("bigint").alias("seq"),
    )
    return rows, "row_key", ["sku_num", "is_ordered", "operate_time"], ["ts_ms", "seq"]


def _batches(rows, key, n=3):
    """Rows cut by a hash, so that older changes come after newer ones."""
    return [rows.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


@query
def dim_upsert_merge(spark, sf_dir):
    """Carts as a dimension keyed by user, after puts and deletes."""
    return merges.dim_merge(*_cart_puts(spark, sf_dir))


@query
def sink_dim_merge_table(spark, sf_dir):
    """The same dimension through its table, in three batches cut by a hash of the change."""
    rows, key, columns, order = _cart_puts(spark, sf_dir)
    target = sinks.CellTable(spark, scratch(spark, "dim"), ["row_key"], every=2)
    for batch_id, part in enumerate(_batches(rows, "seq")):
        target.add(merges.dim_cells(part, key, columns, order), batch_id)
    return merges.dim_values(target.cells())


@query
def dim_delete_by_keys(spark, sf_dir):
    """Suppliers without those of the first region."""
    gone = (
        ad.table(spark, sf_dir, "supplier")
        .join(ad.table(spark, sf_dir, "nation").filter("n_regionkey = 0"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(ad.text("s_suppkey").alias("row_key"))
    )
    return merges.delete_by_keys(_supplier_dim(spark, sf_dir), gone)


@query
def partial_update_merge(spark, sf_dir):
    """Cart changes merged by user and day, each column keeping its last value."""
    rows = changes.typed_cart_changes(ad.cart_info(ad.table(spark, sf_dir, "events")))
    return merges.partial_update(
        rows, ["user_id", "ds"], ["is_ordered", "sku_num", "sku_name", "operate_time"], ["ts_ms", "id"]
    )


@query
def sink_partial_update_table(spark, sf_dir):
    """The same merge through its table, in three batches cut by a hash of the change."""
    rows = changes.typed_cart_changes(ad.cart_info(ad.table(spark, sf_dir, "events")))
    keys, columns, order = ["user_id", "ds"], ["is_ordered", "sku_num", "sku_name", "operate_time"], ["ts_ms", "id"]
    target = sinks.CellTable(spark, scratch(spark, "carts"), keys, every=2)
    for batch_id, part in enumerate(_batches(rows, "id")):
        target.add(merges.partial_cells(part, keys, columns, order), batch_id)
    return merges.partial_values(target.cells(), keys)


def _account_chunks(spark, sf_dir):
    """Balances of customers that change while they are read, a hundred keys at a time."""
    base = ad.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_acctbal").alias("balance"))
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    moves = ad.table(spark, sf_dir, "events").select(
        (F.col("event_id") * 7919 % 1600).alias("id"), F.when(op != "d", F.col("value")).alias("balance"), op.alias("op"), F.col("event_id").alias("position")
    )
    moves = moves.withColumn("chunk", snapshots.chunk_of(F.col("id"), 100))
    chunks = base.select(snapshots.chunk_of(F.col("id"), 100).alias("chunk")).union(moves.select("chunk")).distinct()
    turn = F.col("chunk") % 16 * 50
    marks = chunks.select("chunk", (turn + 20).alias("low"), (turn + 320).alias("high"))
    # Each row is read at a moment of its own between the marks: as the newest change before has left it.
    moment = F.col("low") + F.pmod(F.xxhash64("id"), F.lit(301))
    past = base.select(snapshots.chunk_of(F.col("id"), 100).alias("chunk"), "id", "balance", F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("position"))
    past = past.unionByName(moves).join(marks, "chunk").filter(F.col("position") <= moment)
    seen = past.groupBy("chunk", "id").agg(F.max_by(F.struct("op", "balance"), "position").alias("r")).filter("r.op <> 'd'")
    return seen.select("chunk", "id", "r.balance"), moves, marks


@query
def cdc_snapshot_then_changes(spark, sf_dir):
    """Snapshot rows as of their chunk's high mark, and every later change once."""
    return snapshots.snapshot_then_changes(*_account_chunks(spark, sf_dir), ["id"]).drop("chunk")


@query
def log_dirty_records(spark, sf_dir):
    _, dirty = logs.parse_or_dirty(
        ad.props_messages(ad.table(spark, sf_dir, "events")), schemas.text_struct("k")
    )
    return dirty


# --- changes ------------------------------------------------------------------------------------


def _mixed_orders(spark, sf_dir):
    return cdc.with_maps(ad.order_info(ad.table(spark, sf_dir, "orders"), mixed_ops=True))


@query
def cdc_filter_valid(spark, sf_dir):
    rows = changes.filter_valid(_mixed_orders(spark, sf_dir), ad.DB)
    return rows.select(F.col("after")["id"].alias("id"), "op", "ts_ms")


@query
def cdc_filter_valid_deletes(spark, sf_dir):
    rows = changes.filter_valid(_mixed_orders(spark, sf_dir), ad.DB, use_before_for_delete=True)
    return rows.select(F.col("after")["id"].alias("id"), "op", "ts_ms")


@query
def cdc_project_order(spark, sf_dir):
    """Fields of one table out of all changes."""
    return changes.project(
        ad.topic_db(spark, sf_dir), "order_info", ("id", "user_id", "province_id", "total_amount")
    )


@query
def dim_column_prune(spark, sf_dir):
    """Stored fields of every routed row."""
    routed = changes.route(ad.topic_db(spark, sf_dir), ad.dim_config(spark), ad.DIM_SOURCES)
    return changes.cells(routed)


@query
def dim_route_tables(spark, sf_dir):
    routed = changes.route(ad.topic_db(spark, sf_dir), ad.dim_config(spark), ad.DIM_SOURCES)
    return routed.groupBy("sink_table", "op").agg(
        F.count("*").alias("n"), F.countDistinct("row_key").alias("row_keys")
    )


@query
def dwd_cart_add(spark, sf_dir):
    return changes.cart_add(ad.cart_info(ad.table(spark, sf_dir, "events")), "snapshot")


@query
def dwd_cart_add_delta(spark, sf_dir):
    return changes.cart_add(ad.cart_info(ad.table(spark, sf_dir, "events")), "delta")


@query
def cart_change_typed(spark, sf_dir):
    return changes.typed_cart_changes(ad.cart_info(ad.table(spark, sf_dir, "events")))


@query
def comment_flatten(spark, sf_dir):
    return changes.flatten_comments(ad.comment_info(ad.table(spark, sf_dir, "documents")))


@query
def cdc_after_or_before(spark, sf_dir):
    return changes.after_or_before(_mixed_orders(spark, sf_dir), ("id", "user_id", "order_status"))


@query
def cancel_filter(spark, sf_dir):
    return changes.cancelled_orders(ad.order_info(ad.table(spark, sf_dir, "orders"), mixed_ops=True))


@query
def cancel_filter_reference(spark, sf_dir):
    return changes.cancelled_orders(ad.order_info(ad.table(spark, sf_dir, "orders"), mixed_ops=True), "reference")


@query
def user_profile(spark, sf_dir):
    return jobs.user_profiles(ad.TopicByTable(spark, sf_dir), F.lit(AS_OF).cast("date"))


@query
def bean_to_snake_json(spark, sf_dir):
    """Events as rows with camelCase names and a hidden field, to JSON text."""
    rows = ad.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("eventId"),
        F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"),
        F.when(F.col("event_type") == "purchase", F.lit("y")).alias("isPaid"),
        times.to_ms(F.col("ts")).alias("tsMs"),
    )
    return shapes.to_snake_json(rows, hidden=("tsMs",))


# --- logs -----------------------------------------------------------------------------------------


def _split(spark, sf_dir):
    return jobs.split_log_messages(ad.log_messages(ad.table(spark, sf_dir, "events")), ("event_id",))


@query
def log_split_err(spark, sf_dir):
    return _split(spark, sf_dir)["err"].select(
        "event_id", "common.mid", "common.is_new", "page.page_id", F.col("err")["error_code"].alias("error_code"), "ts"
    )


@query
def log_split_start(spark, sf_dir):
    return _split(spark, sf_dir)["start"].select(
        "event_id", "common.mid", "common.is_new", F.col("start")["entry"].alias("entry"), "ts"
    )


@query
def log_split_page(spark, sf_dir):
    return _split(spark, sf_dir)["page"].select(
        "event_id", "common.mid", "common.is_new", "page.page_id", "page.last_page_id", "page.item", "page.during_time", "ts"
    )


@query
def log_split_display(spark, sf_dir):
    return _split(spark, sf_dir)["display"].select(
        "common.mid",
        "page.page_id",
        F.col("display")["item"].alias("item"),
        F.col("display")["pos"].alias("pos"),
        "ts",
    )


@query
def log_split_action(spark, sf_dir):
    return _split(spark, sf_dir)["action"].select(
        "common.mid", "page.page_id", F.col("action")["item"].alias("item"), F.col("action")["pos"].alias("pos")
    )


@query
def login_filter(spark, sf_dir):
    return logs.filter_logins(pages(spark, sf_dir)).select("event_id", "common.uid", "page.last_page_id", "ts")


@query
def search_filter(spark, sf_dir):
    return logs.filter_searches(pages(spark, sf_dir)).select("event_id", "page.item", "ts")


# --- facts ----------------------------------------------------------------------------------------


def _details(spark, sf_dir):
    return facts.order_detail(ad.TopicByTable(spark, sf_dir))


@query
def dwd_order_detail(spark, sf_dir):
    return _details(spark, sf_dir)


@query
def dwd_pay_success(spark, sf_dir):
    topic = ad.TopicByTable(spark, sf_dir)
    return facts.pay_success(topic, facts.order_detail(topic, of=facts.payments(topic)))


@query
def dwd_order_cancel(spark, sf_dir):
    topic = ad.TopicByTable(spark, sf_dir)
    return facts.order_cancel(topic, facts.order_detail(topic, of=changes.cancelled_orders(topic), key="id"))


@query
def dwd_order_refund(spark, sf_dir):
    return facts.order_refund(ad.TopicByTable(spark, sf_dir))


@query
def dwd_refund_pay_success(spark, sf_dir):
    return facts.refund_pay(ad.TopicByTable(spark, sf_dir))


@query
def dwd_comment_dic(spark, sf_dir):
    return facts.comments(ad.TopicByTable(spark, sf_dir), ad.base_dic(ad.table(spark, sf_dir, "region")))


@query
def interval_join_user(spark, sf_dir):
    events = ad.table(spark, sf_dir, "events")
    return jobs.join_supplements(ad.timed_events(events), ad.shifted_events(events, 180_000))


@query
def interval_join_prefix(spark, sf_dir):
    events = ad.table(spark, sf_dir, "events")
    orders = ad.shifted_events(events, 45_000).select("uid", "height", "ts_ms")
    return joins.interval_join(
        ad.timed_events(events), orders, ("uid", "uid"), "ts_ms", "-1 minute", "1 minute", prefix="info_"
    )


@query
def dim_join_province(spark, sf_dir):
    orders = facts.orders_with_status(ad.TopicByTable(spark, sf_dir), "1006")
    return joins.dim_join(
        orders, ad.province_dim(ad.table(spark, sf_dir, "nation")), "province_id", {"name": "province_name"}
    )


@query
def dim_join_default(spark, sf_dir):
    """Comments with the name of their code, found under its hash, or ``N/A``."""
    rows = changes.project(ad.TopicByTable(spark, sf_dir), "comment_info", ("id", "appraise"))
    return joins.dim_join(
        rows,
        ad.base_dic_by_hash(ad.table(spark, sf_dir, "region")),
        text.md5_key(F.col("appraise")),
        {"dic_name": "dic_name"},
        default="N/A",
    )


@query
def dim_chain_sku(spark, sf_dir):
    """Quantity per sku, with the names of all levels above it."""
    sold = (
        facts.order_lines(ad.TopicByTable(spark, sf_dir))
        .groupBy("sku_id")
        .agg(F.sum(F.col("sku_num").cast("bigint")).alias("sku_num"))
    )
    return joins.dim_chain(sold, summaries.sku_lookups(ad.sku_dims(spark, sf_dir)))


# --- summaries ------------------------------------------------------------------------------------


@query
def dws_keyword_count(spark, sf_dir):
    return summaries.keyword_count(pages(spark, sf_dir), WINDOW)


@query
def dws_home_detail_uv(spark, sf_dir):
    return summaries.home_detail_uv(pages(spark, sf_dir), WINDOW)


@query
def dws_traffic_page_view(spark, sf_dir):
    return summaries.traffic_page_view(pages(spark, sf_dir), WINDOW, order=("event_id",))


@query
def dws_traffic_page_view_10s(spark, sf_dir):
    return summaries.traffic_page_view(pages(spark, sf_dir), order=("event_id",))


@query
def dws_user_login(spark, sf_dir):
    return summaries.user_login(pages(spark, sf_dir), WINDOW)


@query
def dws_cart_add_uu(spark, sf_dir):
    return summaries.cart_add_uu(dwd_cart_add_delta(spark, sf_dir), WINDOW)


@query
def dws_province_order(spark, sf_dir):
    return summaries.province_order(
        detail_versions(spark, sf_dir),
        ad.province_dim(ad.table(spark, sf_dir, "nation")),
        TRADE_WINDOW,
        order=VERSION_ORDER,
    )


@query
def dws_sku_order(spark, sf_dir):
    return summaries.sku_order(
        detail_versions(spark, sf_dir), ad.sku_dims(spark, sf_dir), TRADE_WINDOW, VERSION_ORDER
    )


@query
def report_channel_uv(spark, sf_dir):
    return summaries.channel_uv(dws_traffic_page_view(spark, sf_dir))


@query
def report_province_amount(spark, sf_dir):
    return summaries.province_amount(dws_province_order(spark, sf_dir))


# --- state and duplicates -------------------------------------------------------------------------


@query
def fix_is_new(spark, sf_dir):
    return visits.fix_is_new(pages(spark, sf_dir), ("event_id",)).select(
        "event_id", "common.mid", "common.is_new", "ts"
    )


@query
def first_visit_of_day(spark, sf_dir):
    rows = pages(spark, sf_dir).select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "event_id", "ts")
    firsts = visits.first_of_day(rows, ["mid"], "ts", ["event_id"], ["page_id", "event_id"])
    return firsts.withColumn("visit_date", F.date_format("visit_date", times.DATE))


@query
def login_return_user(spark, sf_dir):
    seen = logs.filter_logins(pages(spark, sf_dir)).select(F.col("common.uid").alias("uid"), "ts")
    return visits.return_logins(seen)


@query
def first_cart_of_day(spark, sf_dir):
    carts = dwd_cart_add_delta(spark, sf_dir).withColumn("seq", F.col("id").cast("bigint"))
    firsts = visits.first_of_day(carts, ["user_id"], "ts_ms", ["seq"], ["id", "sku_id", "sku_num"])
    return firsts.drop("visit_date")


@query
def dedup_retract(spark, sf_dir):
    return dedup.retract(
        detail_versions(spark, sf_dir).drop("split_original_amount", "split_activity_amount", "split_coupon_amount"),
        "id",
        VERSION_ORDER,
        ["split_total_amount"],
    )


@query
def dedup_latest(spark, sf_dir):
    return dedup.latest(
        detail_versions(spark, sf_dir).drop("split_original_amount", "split_activity_amount", "split_coupon_amount"),
        ["id"],
        VERSION_ORDER,
    )


@query
def dedup_exact_key(spark, sf_dir):
    comments = ad.comments_for_check(ad.table(spark, sf_dir, "documents"))
    return dedup.exact(comments, ["order_id", "ts_ms"], ["doc_id"]).select("doc_id", "order_id", "ts_ms")


@query
def dedup_bloom(spark, sf_dir):
    """Order lines by number, once each. So few false positives are allowed that none occur here."""
    lines = ad.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    # The count comes from the file footers; a shard may get twice its share.
    return dedup.bloom(lines, ["l_orderkey", "l_linenumber"], 2 * lines.count() + 1000, 1e-9)


# --- functions ------------------------------------------------------------------------------------


def _event_ms(spark, sf_dir):
    return ad.table(spark, sf_dir, "events").select("event_id", times.to_ms(F.col("ts")).alias("ms"))


@query
def fn_epoch_format(spark, sf_dir):
    ms = F.col("ms")
    return _event_ms(spark, sf_dir).select(
        "event_id",
        times.ms_to_date(ms).alias("d"),
        times.ms_to_datetime(ms).alias("dt"),
        times.ms_to_compact(ms).alias("c"),
    )


@query
def fn_text_to_epoch(spark, sf_dir):
    ms = F.col("ms")
    return _event_ms(spark, sf_dir).select(
        "event_id",
        times.datetime_to_ms(times.ms_to_datetime(ms)).alias("dt_ms"),
        times.date_to_ms(times.ms_to_date(ms)).alias("d_ms"),
    )


def _births(spark, sf_dir):
    """Birthdays as epoch days, several per day of the year."""
    return ad.table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") * 37) % 15000 + 1000).alias("days"))


@query
def fn_epoch_day(spark, sf_dir):
    return _births(spark, sf_dir).select(
        "c_custkey", times.epoch_day_to_date(F.col("days")).cast("string").alias("birthday")
    )


@query
def fn_age(spark, sf_dir):
    born = times.epoch_day_to_date(F.col("days"))
    return _births(spark, sf_dir).select("c_custkey", people.age(born, F.lit(AS_OF).cast("date")).alias("age"))


@query
def fn_decade(spark, sf_dir):
    born = times.epoch_day_to_date(F.col("days"))
    return _births(spark, sf_dir).select("c_custkey", people.decade(born).alias("decade"))


@query
def fn_zodiac(spark, sf_dir):
    born = times.epoch_day_to_date(F.col("days"))
    return _births(spark, sf_dir).select("c_custkey", people.zodiac(born).alias("zodiac_sign"))


@query
def fn_decimal_amount(spark, sf_dir):
    return ad.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        money.product_text(F.col("l_quantity").cast("int").cast("string"), ad.cents("l_extendedprice").cast("string")).alias("amount"),
    )


@query
def fn_md5_key(spark, sf_dir):
    name = F.col("c_name")
    return ad.table(spark, sf_dir, "customer").select(
        "c_custkey", text.md5_key(name).alias("row_key"), text.cache_key(F.lit("dim_user"), name).alias("cache_key")
    )


@query
def fn_last_token(spark, sf_dir):
    return ad.table(spark, sf_dir, "documents").select("doc_id", text.last_token(F.col("text")).alias("token"))


# --- moderation -----------------------------------------------------------------------------------


@query
def keyword_explode(spark, sf_dir):
    words = moderation.explode_keywords(ad.table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return words.groupBy("keyword").agg(F.count("*").alias("n"))


@query
def keyword_lexicon(spark, sf_dir):
    """Part names without their blanks, cut by the words that parts have; words in many names weigh more."""
    names = ad.table(spark, sf_dir, "part").select(F.lower("p_name").alias("name"))
    words = names.select(F.explode(F.split("name", " ")).alias("word")).filter("word <> ''")
    weights = words.groupBy("word").agg(F.count("*").alias("weight"))
    # Short words that others begin with or hold, so that there is a choice.
    parts = weights.select(F.explode(F.array(F.substr("word", F.lit(1), F.lit(2)), F.substr("word", F.lit(3)))).alias("word"), F.lit(1).alias("weight"))
    text = names.distinct().select("name", F.replace("name", F.lit(" "), F.lit("")).alias("text"))
    found = lexicon.with_words(text, "text", weights.unionByName(parts), runs="[a-z]+")
    return found.groupBy("keyword").agg(F.count("*").alias("n"))


def _checked(spark, sf_dir):
    documents = ad.table(spark, sf_dir, "documents")
    return (
        moderation.moderate_exact(ad.comments_for_check(documents), ad.banned_words(documents)),
        ad.banned_words(documents),
    )


@query
def moderate_exact(spark, sf_dir):
    return _checked(spark, sf_dir)[0].select("doc_id", "is_violation", "violation_grade", "violation_msg")


@query
def moderate_contains(spark, sf_dir):
    first, words = _checked(spark, sf_dir)
    return moderation.moderate_contains(first, words, ["doc_id"]).select(
        "doc_id", "is_violation", "violation_grade", "violation_msg"
    )


@query
def words_batch_check(spark, sf_dir):
    documents = ad.table(spark, sf_dir, "documents")
    asked = documents.select(text.last_token(F.col("text")).alias("word")).distinct()
    return moderation.words_check(asked, ad.banned_words(documents))


# --- jobs -----------------------------------------------------------------------------------------


@query
def job_ban_list(spark, sf_dir):
    documents = ad.table(spark, sf_dir, "documents")
    return jobs.ban_list(ad.comments_for_check(documents), ad.banned_words(documents), ["doc_id"]).drop("msg")


@query
def job_dim_load(spark, sf_dir):
    """The user dimension out of all changes, by configuration."""
    routed = jobs.dim_load(ad.topic_db(spark, sf_dir), ad.dim_config(spark), ad.DB, tables=["user_info"])
    return jobs.dim_table(routed, "dim_user_info", ["id", "name", "user_level", "gender"])


@query
def job_comment_enrich(spark, sf_dir):
    documents = ad.table(spark, sf_dir, "documents")
    orders = documents.select(
        F.col("doc_id").alias("o_orderkey"),
        F.col("n_chars").alias("o_custkey"),
        (F.expr(ad.COMMENT_MS) + (F.col("doc_id") % 5 - 2) * 45_000).alias("ms"),
    )
    info = cdc.snapshot_envelopes(
        orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("consignee"), "ms"),
        ad.DB,
        "order_info",
        F.col("ms"),
        ["id", "consignee"],
    )
    return jobs.comment_enrich(
        ad.TopicByTable(spark, sf_dir),
        info,
        ad.base_dic_by_hash(ad.table(spark, sf_dir, "region")),
        ("id", "consignee"),
    ).drop("commentTxt")


@query
def job_user_label(spark, sf_dir):
    return jobs.user_labels(ad.TopicByTable(spark, sf_dir), F.lit(AS_OF).cast("date"))
