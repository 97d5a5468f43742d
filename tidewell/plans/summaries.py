"""Windowed summaries of traffic, logins and trade.

Each works on a batch and on a stream. Event time on a stream comes with its watermark from the
operator below, or is set here with ``delay``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import dedup, joins, logs, moderation, visits
from tidewell.operators.windows import tumble, window_text
from tidewell.streaming import updates

KINDS = {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"}
DIMS = ("vc", "ch", "ar", "is_new")


def _timed(df: DataFrame, ms: str, delay: str) -> tuple[DataFrame, str]:
    """A frame and the column to window on: with a watermark if the frame is a stream."""
    if not df.isStreaming:
        return df, ms
    if "_event_time" in df.columns:
        return df, "_event_time"
    return joins.with_event_time(df, delay, ms), "_event_time"


def keyword_count(
    pages: DataFrame, size: str = "10 seconds", delay: str = "3 seconds", ts: str = "ts",
    lexicon: Sequence[str] = (),
) -> DataFrame:
    """Search words per window. ``ts`` may be the log's own time or the broker's."""
    words = moderation.explode_keywords(
        logs.filter_searches(pages).select(ts, F.col("page.item").alias("_item")), "_item",
        lexicon=lexicon,
    )
    words, column = _timed(words.select(ts, "keyword"), ts, delay)
    return tumble(words, column, size, ["keyword"], [F.count("*").alias("keyword_count")])


def home_detail_uv(
    pages: DataFrame, size: str = "10 seconds", delay: str = "0 seconds"
) -> DataFrame:
    """First visitors of the day of the home and of the detail pages."""
    views = logs.filter_pages(pages, tuple(KINDS)).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("kind"), "ts"
    )
    firsts, column = _timed(visits.first_of_day(views, ["mid", "kind"], delay=delay), "ts", delay)
    return tumble(
        firsts,
        column,
        size,
        [],
        [F.sum((F.col("kind") == kind).cast("bigint")).alias(name) for kind, name in KINDS.items()],
    )


def traffic_page_view(
    pages: DataFrame,
    size: str = "10 seconds",
    delay: str = "0 seconds",
    order: Sequence[str] = (),
) -> DataFrame:
    """Visitors, sessions, views and stay per version, channel, area and visitor kind.

    The first view of a device on a day counts as a visitor under that view's own attributes.
    Views and visitors are two inputs of one aggregate: the views need no state, and visitors
    were reduced to one row per device and day before.
    """
    flat = pages.select(
        F.col("common.mid").alias("mid"),
        *[F.col(f"common.{d}").alias(d) for d in DIMS],
        logs.opens_session().cast("bigint").alias("sv"),
        F.coalesce(F.col("page.during_time"), F.lit(0)).cast("bigint").alias("dur"),
        *dict.fromkeys(["ts", *order]),
    )
    none = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    firsts, column = _timed(
        visits.first_of_day(
            flat.select("mid", *dict.fromkeys(["ts", *order]), *DIMS), ["mid"], "ts", order, DIMS, delay
        ),
        "ts",
        delay,
    )
    views, column = _timed(flat, "ts", delay)
    both = views.select(
        column, *DIMS, none.alias("uv"), "sv", one.alias("pv"), "dur"
    ).unionByName(
        firsts.select(
            column, *DIMS, one.alias("uv"), none.alias("sv"), none.alias("pv"), none.alias("dur")
        )
    )
    return tumble(
        both,
        column,
        size,
        list(DIMS),
        [
            F.sum("uv").alias("uv_ct"),
            F.sum("sv").alias("sv_ct"),
            F.sum("pv").alias("pv_ct"),
            F.sum("dur").alias("dur_sum"),
        ],
    )


def user_login(pages: DataFrame, size: str = "10 seconds", delay: str = "0 seconds") -> DataFrame:
    """Users of the day and users who came back, per window."""
    seen = logs.filter_logins(pages).select(F.col("common.uid").alias("uid"), "ts")
    users, column = _timed(visits.return_logins(seen, delay=delay), "ts", delay)
    return tumble(
        users, column, size, [], [F.sum("back_ct").alias("back_ct"), F.sum("uu_ct").alias("uu_ct")]
    )


def cart_add_uu(carts: DataFrame, size: str = "2 seconds", delay: str = "0 seconds") -> DataFrame:
    """Users whose first cart addition of the day falls in the window."""
    firsts, column = _timed(
        visits.first_of_day(carts, ["user_id"], "ts_ms", delay=delay), "ts_ms", delay
    )
    return tumble(firsts, column, size, [], [F.count("*").alias("cart_add_uu_ct")])


def province_order(
    details: DataFrame,
    provinces: DataFrame,
    size: str = "4 seconds",
    delay: str = "0 seconds",
    order: Sequence[str] = ("ts_ms",),
    ttl_ms: int | None = None,
) -> DataFrame:
    """Order amount and orders per province; names are looked up on the finished windows."""
    return name_provinces(province_sums(details, size, delay, order, ttl_ms), provinces)


def name_provinces(summed: DataFrame, provinces: DataFrame) -> DataFrame:
    return joins.dim_join(summed, provinces, "province_id", {"name": "province_name"})


def province_sums(
    details: DataFrame,
    size: str = "4 seconds",
    delay: str = "0 seconds",
    order: Sequence[str] = ("ts_ms",),
    ttl_ms: int | None = None,
) -> DataFrame:
    """Order amount and orders per province id.

    An order counts even if its line was taken back, as its retraction names it too. A stream
    keeps the newest version of a line for ``ttl_ms`` by the clock; Spark then runs micro-batches
    without input too, so it has to be stopped.
    """
    lines = details.select(
        *dict.fromkeys(["id", "order_id", "province_id", "split_total_amount", "ts_ms", *order])
    )
    rows = dedup.retract(lines, "id", order, ["split_total_amount"], ttl_ms).withColumn(
        "split_total_amount", F.col("split_total_amount").cast("decimal(16,2)")
    )
    if details.isStreaming:
        return _province_stream(lines, rows, size, delay)
    return tumble(
        rows,
        "ts_ms",
        size,
        ["province_id"],
        [
            F.countDistinct("order_id").alias("order_count"),
            F.sum("split_total_amount").alias("order_amount"),
        ],
    )


def _province_stream(lines: DataFrame, rows: DataFrame, size: str, delay: str) -> DataFrame:
    """Amounts of all rows and the orders that are new to their window and province.

    Streams have no distinct count, and a set of orders as one group's state would grow with the
    group. So each order is a key of its own, which counts once. A retraction repeats the order,
    time and province of a line, so the lines themselves name all orders.
    """
    window = F.window("_event_time", size).alias("_w")
    amounts = joins.with_event_time(rows, delay).select(
        window, "province_id", F.lit(0).cast("bigint").alias("n"), "split_total_amount"
    )
    orders = (
        joins.with_event_time(lines, delay)
        .select(window, "province_id", "order_id")
        .dropDuplicates()
        .select(
            "_w",
            "province_id",
            F.lit(1).cast("bigint").alias("n"),
            F.lit(0).cast("decimal(16,2)").alias("split_total_amount"),
        )
    )
    summed = (
        amounts.unionByName(orders)
        .groupBy("_w", "province_id")
        .agg(F.sum("n").alias("order_count"), F.sum("split_total_amount").alias("order_amount"))
    )
    return window_text(summed)


AMOUNTS = {
    "split_original_amount": "original_amount",
    "split_activity_amount": "activity_reduce_amount",
    "split_coupon_amount": "coupon_reduce_amount",
    "split_total_amount": "order_amount",
}


def sku_lookups(dims: dict[str, DataFrame]) -> list[joins.Lookup]:
    """The six lookups from a sku up to its top category."""
    step = joins.Lookup
    return [
        step(
            dims["sku"],
            "sku_id",
            {
                "sku_name": "sku_name",
                "spu_id": "spu_id",
                "category3_id": "category3_id",
                "tm_id": "trademark_id",
            },
        ),
        step(dims["spu"], "spu_id", {"spu_name": "spu_name"}),
        step(dims["trademark"], "trademark_id", {"tm_name": "trademark_name"}),
        step(
            dims["category3"],
            "category3_id",
            {"name": "category3_name", "category2_id": "category2_id"},
        ),
        step(
            dims["category2"],
            "category2_id",
            {"name": "category2_name", "category1_id": "category1_id"},
        ),
        step(dims["category1"], "category1_id", {"name": "category1_name"}),
    ]


def sku_order(
    details: DataFrame,
    dims: dict[str, DataFrame],
    size: str = "10 seconds",
    order: Sequence[str] = ("ts_ms",),
    arrival: str = "ts_ms",
) -> DataFrame:
    """Amounts per sku with names, which are looked up last."""
    return joins.dim_chain(sku_sums(details, size, order, arrival), sku_lookups(dims))


def sku_sums(
    details: DataFrame,
    size: str = "10 seconds",
    order: Sequence[str] = ("ts_ms",),
    arrival: str = "ts_ms",
) -> DataFrame:
    """Amounts per sku id, from the newest version of each order line.

    Windows go by arrival: on a batch the ``arrival`` column, on a stream the clock when a line leaves
    the dedup. A streamed window is given when the clock passes its end, whether or not more lines
    come; amounts that are no number count as 0 there.
    """
    newest = dedup.latest(
        details.select(*dict.fromkeys(["id", "sku_id", *AMOUNTS, "ts_ms", arrival, *order])),
        ["id"],
        order,
    )
    if newest.isStreaming:
        cents = {dst: F.round(F.col(src).cast("decimal(16,2)") * 100) for src, dst in AMOUNTS.items()}
        sums = updates.clock_sums(newest, "sku_id", cents, int(joins.seconds(size) * 1000))
        whole = [(F.col(c).cast("decimal(20,0)") / 100).cast("decimal(26,2)").alias(c) for c in cents]
        return window_text(sums.select("_w", "sku_id", *whole))
    return tumble(
        newest,
        arrival,
        size,
        ["sku_id"],
        [F.sum(F.col(src).cast("decimal(16,2)")).alias(dst) for src, dst in AMOUNTS.items()],
    )


def channel_uv(traffic: DataFrame) -> DataFrame:
    """Visitors per channel, from the traffic summary."""
    return traffic.groupBy("ch").agg(F.sum("uv_ct").alias("uv_ct"))


def province_amount(summary: DataFrame) -> DataFrame:
    """Order amount per province name, from the province summary."""
    return summary.groupBy("province_name").agg(F.sum("order_amount").alias("order_amount"))
