"""The supplied tables in the shapes that the jobs read.

Row images are structs and every source is a literal, so Catalyst reduces a projection of one
table's changes to a plain column scan of the one file behind it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions import times
from tidewell.operators.once import with_column_once
from tidewell.sources.changes import origin, record, with_maps

DB = "retail"
HOUR_MS = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def cents(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(16,2)")


# --- app logs ---------------------------------------------------------------------------------


def page_logs(events: DataFrame) -> DataFrame:
    """Events as app log records, with ``event_id`` as arrival order."""

    def repeated(n: int) -> str:
        entry = "map('item', CAST(event_id AS STRING), 'item_type', 'sku_id', 'pos', CAST(i AS STRING))"
        count = f"CAST(event_id % {n} AS INT)"
        return f"CASE WHEN {count} > 0 THEN transform(sequence(1, {count}), i -> {entry}) END"

    def only(kind: str, expr: str) -> str:
        return f"CASE WHEN event_type = '{kind}' THEN {expr} END"

    item = "concat_ws(' ', 'Search', concat('brand', user_id % 7), get_json_object(props, '$.k'))"
    return events.selectExpr(
        "event_id",
        """struct(CAST(user_id AS STRING) AS mid, CAST(user_id AS STRING) AS uid, concat('v', user_id % 3) AS vc,
            concat('ch', user_id % 4) AS ch, concat('ar', user_id % 5) AS ar, CAST(event_id % 2 AS STRING) AS is_new) AS common""",
        f"""struct(
            CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' ELSE event_type END AS page_id,
            CASE event_type WHEN 'signup' THEN 'login' WHEN 'purchase' THEN 'search' WHEN 'error' THEN '' ELSE 'home' END AS last_page_id,
            {only('purchase', item)} AS item, {only('purchase', "'keyword'")} AS item_type,
            CAST(floor(value * 1000) AS BIGINT) AS during_time) AS page""",
        only("error", "map('error_code', CAST(event_id % 100 AS STRING), 'msg', props)") + " AS err",
        only("signup", "map('entry', 'icon')") + " AS start",
        only("view", repeated(4)) + " AS displays",
        only("click", repeated(3)) + " AS actions",
        _ms("ts") + " AS ts",
    )


def log_messages(events: DataFrame) -> DataFrame:
    """App logs as JSON text, with ``event_id`` beside it."""
    text = F.to_json(F.struct(*[f.name for f in schemas.LOG]))
    return with_column_once(page_logs(events), "value", text).select("event_id", "value")


def props_messages(events: DataFrame) -> DataFrame:
    """The raw ``props`` text, where error events lost their last character on the way."""
    props = F.col("props")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return events.select("event_id", F.when(F.col("event_type") == "error", cut).otherwise(props).alias("value"))


# --- change records ---------------------------------------------------------------------------
# Rows as SQL text: one call per table builds the whole projection.


def _ms(column: str) -> str:
    return f"unix_millis(CAST({column} AS TIMESTAMP))"


def _cents(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(16,2))"


def _changes(
    df: DataFrame,
    name: str,
    row: dict[str, str],
    ts_ms: str,
    op: str | None = None,
    before: dict[str, str] | None = None,
) -> DataFrame:
    """Rows as changes with struct images of text, by default a snapshot."""

    def struct(fields: dict[str, str]) -> str:
        return "struct(" + ", ".join(f"CAST({e} AS STRING) AS {f}" for f, e in fields.items()) + ")"

    made = df.selectExpr(
        f"CASE WHEN {op or SNAPSHOT} IN ('u', 'd') THEN {struct(before or row)} END AS before",
        f"CASE WHEN {op or SNAPSHOT} <> 'd' THEN {struct(row)} END AS after",
        f"map('db', '{DB}', 'table', '{name}', 'server_id', '1') AS source",
        f"{op or SNAPSHOT} AS op",
        f"CAST({ts_ms} AS BIGINT) AS ts_ms",
    )
    if op is None:
        return made
    # An image that depends on the op cannot be taken apart: build it once for all its fields.
    images = with_column_once(made, "_i", F.struct("before", "after"))
    return images.select("_i.before", "_i.after", "source", "op", "ts_ms")


SNAPSHOT = "'r'"
ORDER_OP = (
    "CASE o_orderpriority WHEN '5-LOW' THEN 'd' WHEN '4-NOT SPECIFIED' THEN 'u' "
    "WHEN '3-MEDIUM' THEN 'c' ELSE 'r' END"
)
# An order may list one part of one supplier twice under one number; day and price tell them apart.
DETAIL_ID = (
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date_format(l_shipdate, 'yyyyMMdd'), "
    "CAST(round(l_extendedprice * 100) AS BIGINT))"
)
LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber)"


def order_info(orders: DataFrame, mixed_ops: bool = False) -> DataFrame:
    """Orders: a snapshot, or with ops by priority."""
    ms = _ms("o_orderdate")
    row = {
        "id": "o_orderkey",
        "user_id": "o_custkey",
        "province_id": "o_custkey % 25",
        "order_status": "CASE WHEN o_orderstatus = 'P' THEN '1003' WHEN o_orderstatus = 'F' THEN '1006' "
        "WHEN o_orderpriority = '1-URGENT' THEN '1001' ELSE '1002' END",
        "total_amount": _cents("o_totalprice"),
        "create_time": ms,
        "operate_time": f"{ms} + {HOUR_MS}",
    }
    return _changes(orders, "order_info", row, ms, ORDER_OP if mixed_ops else None)


def order_detail(lineitem: DataFrame, key: str = DETAIL_ID) -> DataFrame:
    ms, price = _ms("l_shipdate"), _cents("l_extendedprice")

    def share(rate: str) -> str:
        return _cents(f"{price} * {rate}")

    row = {
        "id": key,
        "order_id": "l_orderkey",
        "sku_id": "l_partkey",
        "sku_name": "concat('sku-', l_partkey)",
        "create_time": ms,
        "source_id": "l_suppkey",
        "source_type": "'2401'",
        "sku_num": "CAST(l_quantity AS INT)",
        "order_price": price,
        "split_total_amount": share("(1 - CAST(l_discount AS DECIMAL(4,2)))"),
        "split_activity_amount": share("CAST(l_discount AS DECIMAL(4,2))"),
        "split_coupon_amount": share("CAST(l_tax AS DECIMAL(4,2))"),
    }
    return _changes(lineitem, "order_detail", row, ms)


def order_detail_activity(lineitem: DataFrame) -> DataFrame:
    row = {"order_detail_id": DETAIL_ID, "activity_id": "l_linenumber", "activity_rule_id": "l_suppkey"}
    used = lineitem.filter("l_discount > 0.05D")
    return _changes(used, "order_detail_activity", row, _ms("l_shipdate"))


def order_detail_coupon(lineitem: DataFrame) -> DataFrame:
    row = {"order_detail_id": DETAIL_ID, "coupon_id": "l_suppkey"}
    return _changes(lineitem.filter("l_tax > 0.04D"), "order_detail_coupon", row, _ms("l_shipdate"))


def payment_info(orders: DataFrame) -> DataFrame:
    ms = _ms("o_orderdate")
    row = {
        "user_id": "o_custkey",
        "order_id": "o_orderkey",
        "payment_type": "concat('110', substring(o_orderpriority, 1, 1))",
        "callback_time": f"{ms} + {HOUR_MS}",
        "payment_status": "CASE WHEN o_orderstatus = 'F' THEN '1602' ELSE '1601' END",
    }
    return _changes(orders, "payment_info", row, ms)


def order_refund_info(lineitem: DataFrame) -> DataFrame:
    ms = _ms("l_shipdate")
    row = {
        "id": DETAIL_ID,
        "user_id": "l_suppkey",
        "order_id": "l_orderkey",
        "sku_id": "l_partkey",
        "refund_type": "'1502'",
        "refund_num": "CAST(l_quantity AS INT)",
        "refund_amount": _cents("l_extendedprice"),
        "refund_reason_type": "concat('130', l_linenumber)",
        "refund_reason_txt": "concat('line ', l_linestatus)",
        "create_time": ms,
        "refund_status": "CASE WHEN l_linestatus = 'F' THEN '0705' ELSE '0701' END",
    }
    return _changes(lineitem.filter("l_returnflag = 'R'"), "order_refund_info", row, ms)


def refund_payment(lineitem: DataFrame) -> DataFrame:
    ms = _ms("l_shipdate")
    row = {
        "id": DETAIL_ID,
        "order_id": "l_orderkey",
        "sku_id": "l_partkey",
        "payment_type": "concat('110', l_linenumber)",
        "callback_time": f"{ms} + {HOUR_MS}",
        "total_amount": _cents("l_extendedprice"),
        "refund_status": "CASE WHEN l_linestatus = 'F' THEN '1602' ELSE '1601' END",
    }
    return _changes(lineitem.filter("l_returnflag = 'R'"), "refund_payment", row, ms)


# The time of a comment or user row: 2024 begins at number 0.
DAY_0 = 1_704_067_200_000
COMMENT_MS = f"{DAY_0} + doc_id * 60000"
USER_MS = f"{DAY_0} + c_custkey * 1000"


def comment_info(documents: DataFrame) -> DataFrame:
    row = {
        "id": "doc_id",
        "user_id": "doc_id % 150",
        "sku_id": "n_chars",
        "spu_id": "n_chars % 97",
        "order_id": "doc_id",
        "appraise": "concat('120', n_chars % 7)",
        "comment_txt": "text",
        "create_time": COMMENT_MS,
    }
    return _changes(documents, "comment_info", row, COMMENT_MS)


def cart_info(events: DataFrame) -> DataFrame:
    """Cart rows: views are the snapshot, clicks create, signups delete, all else changes a count."""
    op = "CASE event_type WHEN 'view' THEN 'r' WHEN 'click' THEN 'c' WHEN 'signup' THEN 'd' ELSE 'u' END"
    ms = _ms("ts")
    row = {
        "id": "event_id",
        "user_id": "user_id",
        "sku_id": "event_id % 1000",
        "sku_name": "concat('sku-', event_id % 1000)",
        "sku_num": "CAST(floor(value) AS INT)",
        "is_ordered": "CASE WHEN event_type = 'purchase' THEN 1 END",
        "create_time": ms,
        "operate_time": f"CASE WHEN event_type = 'purchase' THEN {ms} + {HOUR_MS} END",
    }
    return _changes(events, "cart_info", row, ms, op, {**row, "sku_num": "CAST(user_id % 60 AS INT)"})


def user_info(customer: DataFrame) -> DataFrame:
    row = {
        "id": "c_custkey",
        "name": "c_name",
        "user_level": "c_nationkey % 3",
        "login_name": "lower(c_name)",
        "phone_num": "concat('13', lpad(CAST(c_custkey AS STRING), 9, '0'))",
        "email": "concat(lower(c_name), '@example.com')",
        "gender": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'F' END",
        "birthday": "(c_custkey * 37) % 15000 + 1000",
    }
    return _changes(customer, "user_info", row, USER_MS)


def user_info_sup_msg(customer: DataFrame) -> DataFrame:
    """Supplements that come 0, 3 or 6 minutes before or after the user row."""
    row = {
        "uid": "c_custkey",
        "height": "150 + c_custkey % 50",
        "unit_height": "'cm'",
        "weight": "45 + c_custkey % 60",
        "unit_weight": "'kg'",
        "create_ts": USER_MS,
    }
    return _changes(customer, "user_info_sup_msg", row, f"{USER_MS} + (c_custkey % 5 - 2) * 180000")


# Which table each kind of change comes from.
CHANGES = {
    "order_info": (order_info, "orders"),
    "order_detail": (order_detail, "lineitem"),
    "order_detail_activity": (order_detail_activity, "lineitem"),
    "order_detail_coupon": (order_detail_coupon, "lineitem"),
    "payment_info": (payment_info, "orders"),
    "order_refund_info": (order_refund_info, "lineitem"),
    "refund_payment": (refund_payment, "lineitem"),
    "comment_info": (comment_info, "documents"),
    "cart_info": (cart_info, "events"),
    "user_info": (user_info, "customer"),
    "user_info_sup_msg": (user_info_sup_msg, "customer"),
}


class TopicByTable(Mapping):
    """Changes by table, each with its own fields, made when they are asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        make, source = CHANGES[name]
        return make(table(self.spark, self.sf_dir, source))

    def __iter__(self) -> Iterator[str]:
        return iter(CHANGES)

    def __len__(self) -> int:
        return len(CHANGES)


def topic_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables' changes in one frame, as one topic holds them, with map images."""
    return reduce(DataFrame.unionAll, map(with_maps, TopicByTable(spark, sf_dir).values()))


# --- shifted pairs for the interval joins --------------------------------------------------------


def timed_events(events: DataFrame) -> DataFrame:
    return events.select(
        text("user_id").alias("uid"), "event_id", "event_type", times.to_ms(F.col("ts")).alias("ts_ms")
    )


def shifted_events(events: DataFrame, step_ms: int) -> DataFrame:
    """The same users at 0, 1 or 2 steps before or after."""
    return events.select(
        text("user_id").alias("uid"),
        text(150 + F.col("event_id") % 50).alias("height"),
        F.lit("cm").alias("unit_height"),
        text(45 + F.col("event_id") % 60).alias("weight"),
        F.lit("kg").alias("unit_weight"),
        (times.to_ms(F.col("ts")) + (F.col("event_id") % 5 - 2) * step_ms).alias("ts_ms"),
    )


# --- dimensions and configuration ----------------------------------------------------------------


def base_dic(region: DataFrame) -> DataFrame:
    """Dictionary codes 1200 and up with the name nested, as the store shows it."""
    return region.select(
        F.concat(F.lit("120"), text("r_regionkey")).alias("dic_code"),
        F.struct(F.col("r_name").alias("dic_name")).alias("info"),
    )


def base_dic_by_hash(region: DataFrame) -> DataFrame:
    """The same dictionary under hashed row keys."""
    return base_dic(region).select(F.md5("dic_code").alias("row_key"), F.col("info.dic_name").alias("dic_name"))


def sku_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Six chained dimensions, each keyed by ``row_key``."""
    part, nation, region = (table(spark, sf_dir, n) for n in ("part", "nation", "region"))
    return {
        "sku": part.select(
            text("p_partkey").alias("row_key"),
            F.col("p_name").alias("sku_name"),
            F.concat(F.lit("spu-"), F.lower("p_type")).alias("spu_id"),
            text(F.col("p_partkey") % 27).alias("category3_id"),
            F.col("p_brand").alias("tm_id"),
        ),
        "spu": part.select(
            F.concat(F.lit("spu-"), F.lower("p_type")).alias("row_key"), F.col("p_type").alias("spu_name")
        ).distinct(),
        "trademark": part.select(
            F.col("p_brand").alias("row_key"), F.upper("p_brand").alias("tm_name")
        ).distinct(),
        "category3": nation.select(
            text("n_nationkey").alias("row_key"), F.col("n_name").alias("name"), text("n_regionkey").alias("category2_id")
        ),
        "category2": region.select(
            text("r_regionkey").alias("row_key"), F.col("r_name").alias("name"), text(F.col("r_regionkey") % 2).alias("category1_id")
        ),
        "category1": region.select(
            text(F.col("r_regionkey") % 2).alias("row_key"),
            F.concat(F.lit("division-"), text(F.col("r_regionkey") % 2)).alias("name"),
        ).distinct(),
    }


def province_dim(nation: DataFrame) -> DataFrame:
    return nation.select(text("n_nationkey").alias("row_key"), F.col("n_name").alias("name"))


# The source tables of the two configurations below.
DIM_SOURCES = ("user_info", "order_info")
FACT_SOURCES = ("user_info", "payment_info")


def dim_config(spark: SparkSession) -> DataFrame:
    """Which tables become dimensions, and with which columns."""
    rows = [
        ("user_info", "dim_user_info", "id,name,user_level,gender", "info", "id", "r"),
        ("order_info", "dim_order_info", "id,order_status,province_id", "info", "id", "r"),
    ]
    return spark.createDataFrame(rows, schemas.DIM_CONFIG)


def fact_config(spark: SparkSession) -> DataFrame:
    rows = [
        ("user_info", "r", "dwd_user_register", "id,name,login_name", "r"),
        ("payment_info", "r", "dwd_payment", "order_id,payment_type,payment_status", "r"),
    ]
    return spark.createDataFrame(rows, schemas.FACT_CONFIG)


def banned_words(documents: DataFrame) -> DataFrame:
    """Short words that documents end with: what follows their last comma, if it is brief."""
    from tidewell.functions.text import last_token

    token = last_token(F.col("text"))
    return documents.filter((F.length(token) > 2) & (F.length(token) <= 12)).select(token.alias("word")).distinct()


def comments_for_check(documents: DataFrame) -> DataFrame:
    """Comments as the moderation job reads them; only true copies share order and time."""
    ms = F.lit(1_704_067_200_000) + (F.col("n_chars") % 1000) * 60_000
    return documents.select(
        F.col("doc_id"),
        F.conv(F.substring(F.md5(F.col("text")), 1, 15), 16, 10).cast("bigint").alias("order_id"),
        (F.col("doc_id") % 150).alias("user_id"),
        F.concat(F.lit("user-"), text(F.col("doc_id") % 150)).alias("info_consignee"),
        ms.alias("ts_ms"),
        times.ms_to_compact(ms).alias("ds"),
        F.col("text").alias("commentTxt"),
    )
