"""Detail facts from change records: one frame of all tables' changes, or a frame per table.

On streams give ``delay``: every side then carries a watermark and join state is dropped once
the match horizon has passed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import money
from tidewell.operators import changes, joins


def _project(
    topic: changes.Topic,
    table: str,
    columns: Iterable[str] | Mapping[str, str],
    delay: str | None,
    where: Column | None = None,
) -> DataFrame:
    rows = changes.project(topic, table, columns, ("r",), where)
    return joins.with_event_time(rows, delay) if delay else rows


def order_lines(topic: changes.Topic, delay: str | None = None) -> DataFrame:
    rows = _project(
        topic,
        "order_detail",
        (
            "id",
            "order_id",
            "sku_id",
            "sku_name",
            "create_time",
            "source_id",
            "source_type",
            "sku_num",
            "order_price",
            "split_total_amount",
            "split_activity_amount",
            "split_coupon_amount",
        ),
        delay,
    )
    return rows.withColumn(
        "split_original_amount", money.product_text(F.col("sku_num"), F.col("order_price"))
    ).drop("order_price")


def _status(value: str, field: str = "order_status") -> Column:
    return F.col("after")[field] == value


def orders_with_status(topic: changes.Topic, status: str, delay: str | None = None) -> DataFrame:
    return _project(
        topic, "order_info", ("id", "user_id", "province_id"), delay, _status(status)
    )


def _detail_sides(topic: changes.Topic, delay: str | None) -> tuple[DataFrame, ...]:
    return (
        order_lines(topic, delay),
        _project(topic, "order_info", ("id", "user_id", "province_id"), delay),
        _project(
            topic,
            "order_detail_activity",
            ("order_detail_id", "activity_id", "activity_rule_id"),
            delay,
        ),
        _project(topic, "order_detail_coupon", ("order_detail_id", "coupon_id"), delay),
    )


def order_detail(topic: changes.Topic, delay: str | None = None, of: DataFrame | None = None, key: str = "order_id") -> DataFrame:
    """Order lines; of tables, those of the orders that column ``key`` of ``of`` names, if given.

    A caller who joins the lines by order names the orders, so that no others are shuffled.
    """
    detail, orders, *more = _detail_sides(topic, delay)
    if of is not None:
        orders = orders.join(of.select(F.col(key).alias("_asked")), F.col("id") == F.col("_asked"), "left_semi")
    return joins.order_detail(detail, orders, *more)


def order_detail_updates(topic: changes.Topic, delay: str, ttl_ms: int | None = None) -> DataFrame:
    """Streamed order lines at once, as changes; see ``joins.order_detail_updates``."""
    return joins.order_detail_updates(*_detail_sides(topic, delay), ttl_ms)


def payments(topic: changes.Topic, delay: str | None = None) -> DataFrame:
    """Payments that succeeded."""
    return _project(
        topic,
        "payment_info",
        ("user_id", "order_id", "payment_type", "callback_time"),
        delay,
        _status("1602", "payment_status"),
    )


def pay_success(topic: changes.Topic, details: DataFrame, delay: str | None = None) -> DataFrame:
    return joins.pay_success(payments(topic, delay), details)


def order_cancel(
    topic: changes.Topic, details: DataFrame, mode: str = "orders", delay: str | None = None
) -> DataFrame:
    cancelled = changes.cancelled_orders(topic, mode)
    if delay:
        cancelled = joins.with_event_time(cancelled, delay)
    return joins.order_cancel(details, cancelled)


def order_refund(topic: changes.Topic, delay: str | None = None) -> DataFrame:
    refunds = _project(
        topic,
        "order_refund_info",
        (
            "id",
            "user_id",
            "order_id",
            "sku_id",
            "refund_type",
            "refund_num",
            "refund_amount",
            "refund_reason_type",
            "refund_reason_txt",
            "create_time",
        ),
        delay,
    )
    return joins.order_refund(refunds, orders_with_status(topic, "1006", delay))


def refund_pay(topic: changes.Topic, delay: str | None = None) -> DataFrame:
    paid = _project(
        topic,
        "refund_payment",
        ("id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount"),
        delay,
        _status("1602", "refund_status"),
    )
    refunds = _project(
        topic,
        "order_refund_info",
        ("order_id", "sku_id", "refund_num"),
        delay,
        _status("0705", "refund_status"),
    )
    return joins.refund_pay(paid, refunds, orders_with_status(topic, "1006", delay))


def comments(topic: changes.Topic, dic: DataFrame) -> DataFrame:
    rows = changes.project(
        topic,
        "comment_info",
        ("id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"),
    )
    return joins.comment_dic(rows, dic)
