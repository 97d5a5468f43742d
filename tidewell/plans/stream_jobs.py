"""Jobs that keep tables and topics up to date from streams."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell import schemas
from tidewell.operators import changes, dedup, joins, logs, merges, moderation, shapes, visits
from tidewell.plans import facts, jobs, summaries
from tidewell.streaming import runs, sinks

# The topics and tables that consumers of these jobs read.
# Topics of the five kinds of log record, and of the records that are none.
LOG_TOPICS = {
    "err": "dwd_traffic_err",
    "start": "dwd_traffic_start",
    "page": "dwd_traffic_page",
    "display": "dwd_traffic_display",
    "action": "dwd_traffic_action",
}
DIRTY_TOPIC = "dirty_data"
FACT_TOPICS = {
    "comments": "dwd_interaction_comment_info",
    "cart_add": "dwd_trade_cart_add",
    "order_detail": "dwd_trade_order_detail",
    "order_cancel": "dwd_trade_order_cancel",
    "pay_success": "dwd_trade_order_payment_success",
    "order_refund": "dwd_trade_order_refund",
    "refund_pay": "dwd_trade_refund_payment_success",
}
SUMMARY_TABLES = {
    "keyword_count": "dws_traffic_source_keyword_page_view_window",
    "traffic_page_view": "dws_traffic_vc_ch_ar_is_new_page_view_window",
    "home_detail_uv": "dws_traffic_home_detail_page_view_window",
    "user_login": "dws_user_user_login_window",
    "cart_add_uu": "dws_trade_cart_add_uu_window",
    "sku_order": "dws_trade_sku_order_window",
    "province_order": "dws_trade_province_order_window",
}


def split_logs(messages: DataFrame, root: str, once: bool = False) -> list[StreamingQuery]:
    """Log messages to topics under ``root``: one query for good records, one for dirty ones.

    A micro-batch of good records is parsed and repaired once and read by all five outputs.
    """
    good, dirty = logs.parse_logs(messages)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for kind, rows in logs.split_logs(batch).items():
                sent = shapes.to_messages(rows, LOG_TOPICS[kind])
                sinks.write_topic_files(sent, f"{root}/{kind}", batch_id)
        finally:
            batch.unpersist()

    def write_dirty(batch: DataFrame, batch_id: int) -> None:
        sent = shapes.to_messages(batch, DIRTY_TOPIC, value=F.col("value"))
        sinks.write_topic_files(sent, f"{root}/dirty", batch_id)

    return [
        runs.start_each(visits.fix_is_new(good), write, f"{root}/checkpoint-good", once=once),
        runs.start_each(dirty, write_dirty, f"{root}/checkpoint-dirty", once=once),
    ]


LookUp = Callable[[DataFrame], DataFrame]


def to_topic(
    rows: DataFrame, topic: str, root: str, look_up: LookUp | None = None, once: bool = False
) -> StreamingQuery:
    """Rows of a stream as JSON messages of one topic under ``root``; ``look_up`` as in ``to_table``."""
    columns = [c for c in rows.columns if c != "_event_time"]

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select(*columns)
        sent = shapes.to_messages(look_up(kept) if look_up else kept, topic)
        sinks.write_topic_files(sent, f"{root}/{topic}", batch_id)

    return runs.start_each(rows, write, f"{root}/checkpoint-{topic}", once=once)


def to_table(
    rows: DataFrame, table: str, root: str, look_up: LookUp | None = None, once: bool = False
) -> StreamingQuery:
    """Rows of a stream appended to a table under ``root``.

    ``look_up`` adds names to a micro-batch. It is called for each one, so dimension tables that
    it reads are those of the moment.
    """
    columns = [c for c in rows.columns if c != "_event_time"]

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.select(*columns)
        sinks.append_table(look_up(kept) if look_up else kept, f"{root}/{table}", batch_id)

    return runs.start_each(rows, write, f"{root}/checkpoint-{table}", once=once)


def fact_rows(name: str, topic: DataFrame, delay: str, details: DataFrame | None = None) -> DataFrame:
    """The stream of one fact. Payments and cancellations take the stream of order lines.

    ``comments`` lack the name of their appraisal, which ``comment_enrich`` of the batch jobs adds.
    """
    if name in ("pay_success", "order_cancel"):
        lines = facts.order_detail(topic, delay) if details is None else details
        return getattr(facts, name)(topic, lines, delay=delay)
    if name == "cart_add":
        return changes.cart_add(topic)
    if name == "comments":
        return changes.flatten_comments(topic)
    return getattr(facts, name)(topic, delay)


def read_order_lines(messages: DataFrame, delay: str) -> DataFrame:
    """Order lines out of the messages of their topic, for the facts and summaries that follow."""
    kind = ", ".join(f"{c} {'bigint' if c == 'ts_ms' else 'string'}" for c in schemas.ORDER_DETAIL_FACT)
    rows = messages.select(F.from_json("value", kind).alias("_r")).select("_r.*")
    return joins.with_event_time(rows, delay) if messages.isStreaming else rows


def write_facts(
    topic: DataFrame, root: str, delay: str, names: Iterable[str] = tuple(FACT_TOPICS), once: bool = False
) -> dict[str, StreamingQuery]:
    """Facts from changes into their topics, one query each, so that one may fail or lag alone."""
    return {n: to_topic(fact_rows(n, topic, delay), FACT_TOPICS[n], root, once=once) for n in names}


def write_order_updates(
    topic: DataFrame, root: str, delay: str, ttl_ms: int | None = None, once: bool = False
) -> StreamingQuery:
    """Order lines into their topic as soon as their order is there, each change with its ``_sign``."""
    return to_topic(facts.order_detail_updates(topic, delay, ttl_ms), FACT_TOPICS["order_detail"], root, once=once)


def traffic_rows(name: str, pages: DataFrame, size: str, delay: str) -> DataFrame:
    """The stream of one traffic or login summary."""
    return getattr(summaries, name)(pages, size, delay)


def write_traffic(
    pages: DataFrame,
    root: str,
    size: str = "10 seconds",
    delay: str = "3 seconds",
    names: Iterable[str] = ("keyword_count", "traffic_page_view", "home_detail_uv", "user_login"),
    once: bool = False,
) -> dict[str, StreamingQuery]:
    """Summaries of page logs into their tables, one query each."""
    return {n: to_table(traffic_rows(n, pages, size, delay), SUMMARY_TABLES[n], root, once=once) for n in names}


def write_provinces(
    details: DataFrame,
    read_provinces: Callable[[], DataFrame],
    root: str,
    size: str = "4 seconds",
    delay: str = "0 seconds",
    order: Sequence[str] = ("ts_ms",),
    ttl_ms: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Orders per province into their table, with names as they are when a window closes."""
    summed = summaries.province_sums(details, size, delay, order, ttl_ms)
    return to_table(
        summed,
        SUMMARY_TABLES["province_order"],
        root,
        lambda batch: summaries.name_provinces(batch, read_provinces()),
        once,
    )


def write_skus(
    details: DataFrame,
    read_dims: Callable[[], dict[str, DataFrame]],
    root: str,
    size: str = "10 seconds",
    order: Sequence[str] = ("ts_ms",),
    once: bool = False,
) -> StreamingQuery:
    """Amounts per sku into their table, with names as they are when a window closes.

    Windows close by the clock, also when no line comes any more, so the job must be stopped.
    """
    return to_table(
        summaries.sku_sums(details, size, order),
        SUMMARY_TABLES["sku_order"],
        root,
        lambda batch: joins.dim_chain(batch, summaries.sku_lookups(read_dims())),
        once,
    )


def write_carts(
    carts: DataFrame, root: str, size: str = "2 seconds", delay: str = "0 seconds", once: bool = False
) -> StreamingQuery:
    """Users who add to their cart for the first time of a day into their table."""
    return to_table(summaries.cart_add_uu(carts, size, delay), SUMMARY_TABLES["cart_add_uu"], root, once=once)


def write_ban_list(
    comments: DataFrame,
    read_words: Callable[[], DataFrame],
    topic: str,
    root: str,
    delay: str = "10 minutes",
    once: bool = False,
) -> StreamingQuery:
    """Comments with both banned-word checks into a topic, without the copies of ``delay``.

    Words are those of the moment, so a new one counts from the next micro-batch on.
    """
    fresh = dedup.exact(comments, ["order_id", "ts_ms"], delay=delay)
    return to_topic(fresh, topic, root, lambda batch: moderation.ban_list(batch, read_words()), once)


CONFIG_FIELDS = tuple(schemas.DIM_CONFIG.fieldNames())


def follow_config(
    topic: DataFrame,
    root: str,
    dims: str | None = None,
    namespace: str | None = None,
    once: bool = False,
) -> StreamingQuery:
    """The dimension configuration as a table under ``root``, from changes of its source table.

    ``lambda: read_config(spark, root)`` is a ``read_config`` for ``load_dims``. Tables under
    ``dims`` whose rule was deleted or changed are dropped; their next rows create them anew. Start it
    before ``load_dims``, which would fail and start again if its table goes during a merge. Catalog
    tables of ``namespace``, if given, are created and dropped by the same rules.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist()
        try:
            _config(session, root).add(changes.config_cells(batch, CONFIG_FIELDS), batch_id)
            if dims is not None:
                old = F.col("before")["sink_table"]
                gone = batch.filter(F.col("op").isin("d", "u")).select(old.alias("name")).distinct()
                for row in gone.filter("name IS NOT NULL").collect():
                    _dim(session, dims, row.name).drop()
            if namespace is not None:
                rules = changes.config_rows(batch, CONFIG_FIELDS).orderBy("ts_ms")
                sinks.apply_dim_config(session, rules, namespace)
        finally:
            batch.unpersist()

    return runs.start_each(topic, write, f"{root}-checkpoint", once=once)


def load_dims(
    topic: DataFrame,
    read_config: Callable[[], DataFrame | None],
    db: str,
    root: str,
    use_before_for_delete: bool = False,
    once: bool = False,
) -> StreamingQuery:
    """Dimension tables under ``root`` from changes, routed by the configuration of the moment.

    The configuration is read anew for each micro-batch, and its names are a filter on the
    changes. It has one row per table, so walking through it on the driver is no matter of data
    size. Tables without a row in a micro-batch are left alone. ``ts_ms`` decides between changes of
    one row, in whichever micro-batches they come; ``read_dim`` gives the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        config = read_config()
        rules = [] if config is None else config.collect()
        if not rules:
            return
        names = [rule.source_table for rule in rules]
        routed = jobs.dim_load(batch, config, db, use_before_for_delete, names).persist()
        try:
            busy = {r.sink_table for r in routed.select("sink_table").distinct().collect()}
            columns = {r.sink_table: r.sink_columns.split(",") for r in rules if r.sink_table in busy}
            for name, kept in columns.items():
                _dim(batch.sparkSession, root, name).add(jobs.dim_cells(routed, name, kept), batch_id)
        finally:
            routed.unpersist()

    return runs.start_each(topic, write, f"{root}/checkpoint", once=once)


CART_COLUMNS = (
    "is_ordered",
    "sku_num",
    "create_time",
    "user_id",
    "sku_id",
    "sku_name",
    "operate_time",
)


CART_KEYS = ("id", "ds")


def cart_table(topic: DataFrame, root: str, once: bool = False) -> StreamingQuery:
    """The cart table under ``root``, where each column keeps its last value; ``read_carts`` gives it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        cells = merges.partial_cells(batch, CART_KEYS, CART_COLUMNS, ["ts_ms"])
        _carts(batch.sparkSession, root).add(cells, batch_id)

    return runs.start_each(changes.typed_cart_changes(topic), write, f"{root}/checkpoint", once=once)


def _carts(spark: SparkSession, root: str) -> sinks.CellTable:
    return sinks.CellTable(spark, f"{root}/table", CART_KEYS)


def _dim(spark: SparkSession, root: str, name: str) -> sinks.CellTable:
    return sinks.CellTable(spark, f"{root}/{name}", ["row_key"])


def _config(spark: SparkSession, root: str) -> sinks.CellTable:
    return sinks.CellTable(spark, root, ["source_table"])


def read_carts(spark: SparkSession, root: str) -> DataFrame | None:
    """What ``cart_table`` keeps, none before its first micro-batch."""
    cells = _carts(spark, root).cells()
    return None if cells is None else merges.partial_values(cells, CART_KEYS)


def read_dim(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A table that ``load_dims`` keeps, none if it has no row yet."""
    cells = _dim(spark, root, name).cells()
    return None if cells is None else merges.dim_values(cells)


def read_config(spark: SparkSession, root: str) -> DataFrame | None:
    """What ``follow_config`` keeps, none before its first change."""
    cells = _config(spark, root).cells()
    return None if cells is None else changes.config_values(cells)
