"""Fact joins, interval joins and dimension lookups.

No join here is forced to broadcast. Spark broadcasts a side whose size it knows to be under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both, where AQE splits a
partition that one hot key has made too big.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions import times
from tidewell.streaming import updates

HORIZON = "30 minutes 5 seconds"


def seconds(interval: str) -> int:
    sizes = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    words = interval.split()
    return sum(int(n) * sizes[unit.rstrip("s")] for n, unit in zip(words[::2], words[1::2]))


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    horizon: str = HORIZON,
) -> DataFrame:
    """Equi join on (left column, right column) pairs; right names must not clash.

    On two streams, state cannot be kept for ever: both sides then need ``_event_time`` (see
    ``with_event_time``) and match within ``horizon`` of each other.
    """
    cond = None
    for a, b in on:
        part = left[a] == right[b]
        cond = part if cond is None else cond & part
    if left.isStreaming and right.isStreaming:
        span = F.expr(f"INTERVAL {seconds(horizon)} SECONDS")
        lt, rt = left["_event_time"], right["_event_time"]
        cond = cond & (rt >= lt - span) & (rt <= lt + span)
        return left.join(right, cond, how).drop(right["_event_time"])
    return left.join(right, cond, how)


def with_event_time(df: DataFrame, delay: str, ms: str = "ts_ms") -> DataFrame:
    return df.withColumn("_event_time", times.event_time(F.col(ms))).withWatermark(
        "_event_time", delay
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(
        *[F.col(c) if c == "_event_time" else F.col(c).alias(prefix + c) for c in df.columns]
    )


def _event_time(df: DataFrame) -> list[str]:
    return ["_event_time"] if df.isStreaming and "_event_time" in df.columns else []


def _detail_fact(joined: DataFrame, more: Sequence[str]) -> DataFrame:
    return joined.select(
        "id",
        "order_id",
        F.col("o_user_id").alias("user_id"),
        "sku_id",
        "sku_name",
        F.col("o_province_id").alias("province_id"),
        F.col("a_activity_id").alias("activity_id"),
        F.col("a_activity_rule_id").alias("activity_rule_id"),
        F.col("c_coupon_id").alias("coupon_id"),
        times.ms_to_date(F.col("create_time")).alias("date_id"),
        "create_time",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
        "ts_ms",
        *more,
    )


def order_detail(
    detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame
) -> DataFrame:
    """Order lines with their order, and with activity and coupon where there are any.

    On streams a line without one of them comes out when none can come any more; see
    ``order_detail_updates`` for lines that come at once.
    """
    o, a, c = _prefixed(orders, "o_"), _prefixed(activity, "a_"), _prefixed(coupon, "c_")
    if any(df.isStreaming for df in (detail, orders, activity, coupon)):
        joined = equi_join(detail, o, [("order_id", "o_id")])
        joined = equi_join(joined, a, [("id", "a_order_detail_id")], "left")
        joined = equi_join(joined, c, [("id", "c_order_detail_id")], "left")
        return _detail_fact(joined, _event_time(detail))
    # Lines are shuffled once, by a hash of their id, and orders are sent to the hashes of their lines.
    at = F.hash(F.coalesce("id", "order_id"))
    lines = detail.repartition(at).withColumn("_at", at)
    # An order that comes n times is one row with its count, so that it is sent to a hash once.
    o = o.groupBy("o_id", "o_user_id", "o_province_id").agg(F.count("*").cast("int").alias("_n"))
    placed = detail.select(F.col("order_id").alias("_order"), at.alias("_o_at"))
    placed = placed.join(o, F.col("_order") == F.col("o_id")).drop("_order").repartition("_o_at").distinct()
    placed = placed.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.col("_n")))).drop("_n")
    joined = equi_join(lines, placed, [("_at", "_o_at"), ("order_id", "o_id")])
    for more, key in ((a, "a_order_detail_id"), (c, "c_order_detail_id")):
        more = more.repartition(F.hash(key)).withColumn("_m_at", F.hash(key))
        joined = equi_join(joined, more, [("_at", "_m_at"), ("id", key)], "left").drop("_m_at")
    return _detail_fact(joined, [])


def order_detail_updates(
    detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame, ttl_ms: int | None = None
) -> DataFrame:
    """Streamed order lines as changes (``_sign``, see ``streaming.updates``).

    A line comes out with its order, without waiting for activity and coupon; when one comes, the
    line is taken back and given anew with it.
    """
    joined = equi_join(detail, _prefixed(orders, "o_"), [("order_id", "o_id")])
    a, c = _prefixed(activity, "a_"), _prefixed(coupon, "c_")
    # Only what the fact reads is kept in state.
    a = a.select("a_order_detail_id", "a_activity_id", "a_activity_rule_id")
    c = c.select("c_order_detail_id", "c_coupon_id")
    found = updates.left_join(joined, [(a, "a_order_detail_id"), (c, "c_order_detail_id")], "id", ttl_ms)
    return _detail_fact(found, ["_sign"])


def pay_success(payments: DataFrame, details: DataFrame) -> DataFrame:
    """Paid order lines; time and payer come from the payment and the order line."""
    p = _prefixed(payments, "p_")
    return equi_join(details, p, [("order_id", "p_order_id")]).select(
        F.col("id").alias("order_detail_id"),
        "order_id",
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        F.col("p_payment_type").alias("payment_type_code"),
        F.col("p_callback_time").alias("callback_time"),
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"),
        F.col("p_ts_ms").alias("ts_ms"),
    )


def order_cancel(details: DataFrame, cancelled: DataFrame) -> DataFrame:
    c = _prefixed(cancelled, "x_")
    kept = [f for f in schemas.ORDER_DETAIL_FACT if f not in ("date_id", "create_time", "ts_ms")]
    return equi_join(details, c, [("order_id", "x_id")]).select(
        *kept,
        times.ms_to_date(F.col("create_time")).alias("date_id"),
        F.col("x_operate_time").alias("cancel_time"),
        F.col("x_ts_ms").alias("ts_ms"),
    )


def order_refund(refunds: DataFrame, orders: DataFrame) -> DataFrame:
    o = _prefixed(orders, "o_")
    return equi_join(refunds, o, [("order_id", "o_id")]).select(
        "id",
        "user_id",
        "order_id",
        "sku_id",
        F.col("o_province_id").alias("province_id"),
        times.ms_to_date(F.col("create_time")).alias("date_id"),
        "create_time",
        F.col("refund_type").alias("refund_type_code"),
        F.col("refund_reason_type").alias("refund_reason_type_code"),
        "refund_reason_txt",
        "refund_num",
        "refund_amount",
        "ts_ms",
    )


def refund_pay(paid: DataFrame, refunds: DataFrame, orders: DataFrame) -> DataFrame:
    r = _prefixed(refunds, "r_")
    o = _prefixed(orders, "o_")
    joined = equi_join(paid, r, [("order_id", "r_order_id"), ("sku_id", "r_sku_id")])
    return equi_join(joined, o, [("order_id", "o_id")]).select(
        "id",
        F.col("o_user_id").alias("user_id"),
        "order_id",
        "sku_id",
        F.col("o_province_id").alias("province_id"),
        F.col("payment_type").alias("payment_type_code"),
        times.ms_to_date(F.col("callback_time")).alias("date_id"),
        "callback_time",
        F.col("r_refund_num").alias("refund_num"),
        F.col("total_amount").alias("refund_amount"),
        "ts_ms",
    )


def comment_dic(comments: DataFrame, dic: DataFrame) -> DataFrame:
    """Comments with the name of their appraisal code; unknown codes drop out."""
    names = dic.select(
        F.col("dic_code").alias("_code"), F.col("info.dic_name").alias("appraise_name")
    )
    return comments.join(names, F.col("appraise") == F.col("_code")).select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts_ms"
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    ts: str,
    lo: str,
    hi: str,
    prefix: str | None = None,
    right_columns: Mapping[str, str] | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Pairs with equal key and right time within [left + lo, left + hi], bounds included.

    ``ts`` names an epoch-millisecond column of both sides. Besides the key, rows are matched on
    a time slice as wide as the interval, a right row being copied into the slices it can reach.
    So a key that holds a large share of the rows is spread over many tasks, and only rows of
    neighbouring slices are ever compared.

    All right columns come along under ``prefix``, or those of ``right_columns`` renamed.
    """
    lo_ms, hi_ms = _signed_ms(lo), _signed_ms(hi)
    width = max(hi_ms - lo_ms, 1)
    if prefix is not None:
        names = {c: prefix + c for c in right.columns}
    else:
        names = dict(right_columns or {})
    lt, rt = F.col("_lt"), F.col("_rt")
    l = left.withColumn("_lt", F.col(ts).cast("bigint")).withColumn(
        "_slice", F.floor(lt / F.lit(width)).cast("bigint")
    )
    r = right.select(
        F.col(on[1]).alias("_rk"),
        F.col(ts).cast("bigint").alias("_rt"),
        *[F.col(src).alias(dst) for src, dst in names.items()],
    ).withColumn(
        "_rslice",
        F.explode(
            F.sequence(
                F.floor((rt - hi_ms) / F.lit(width)).cast("bigint"),
                F.floor((rt - lo_ms) / F.lit(width)).cast("bigint"),
            )
        ),
    )
    cond = (
        (F.col(on[0]) == F.col("_rk"))
        & (F.col("_slice") == F.col("_rslice"))
        & (rt >= lt + lo_ms)
        & (rt <= lt + hi_ms)
    )
    if delay is not None:
        l = l.withColumn("_le", times.at(lt)).withWatermark("_le", delay)
        r = r.withColumn("_re", times.at(rt)).withWatermark("_re", delay)
        cond = cond & F.expr(
            f"_re >= _le + INTERVAL {lo_ms // 1000} SECONDS"
            f" AND _re <= _le + INTERVAL {hi_ms // 1000} SECONDS"
        )
    return l.join(r, cond).select(*left.columns, *names.values())


def _signed_ms(interval: str) -> int:
    sign = -1 if interval.startswith("-") else 1
    return sign * seconds(interval.lstrip("-")) * 1000


@dataclass(frozen=True)
class Lookup:
    """One dimension lookup: ``key`` of the row is the ``row_key`` of ``dim``.

    ``add`` maps dimension columns to the columns they become.
    """

    dim: DataFrame
    key: str
    add: Mapping[str, str]
    default: str | None = None


def dim_join(
    df: DataFrame,
    dim: DataFrame,
    key: str | Column,
    add: Mapping[str, str],
    default: str | None = None,
) -> DataFrame:
    """Left lookup of a dimension row; a miss keeps the row, with ``default`` or nulls.

    A key finds one row at most: of several the one with the greatest values is taken.
    """
    on = F.col(key) if isinstance(key, str) else key
    values = F.struct(*[F.col(src).alias(dst) for src, dst in add.items()])
    found = dim.groupBy(F.col("row_key").alias("_row_key")).agg(F.max(values).alias("_values"))
    found = found.select("_row_key", *[F.col("_values")[dst].alias(dst) for dst in add.values()])
    joined = df.join(found, on == F.col("_row_key"), "left").drop("_row_key")
    if default is not None:
        joined = joined.withColumns(
            {dst: F.coalesce(F.col(dst), F.lit(default)) for dst in add.values()}
        )
    return joined


def dim_chain(df: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Lookups in order; a later key may be a column that an earlier lookup added."""
    for step in lookups:
        df = dim_join(df, step.dim, step.key, step.add, step.default)
    return df
