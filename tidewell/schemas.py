"""Record shapes. Parsing happens once, against these; text scalars are cast afterwards."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TEXT_MAP = T.MapType(TEXT, TEXT)


def text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, TEXT) for name in names])


# One change of a source row.
ENVELOPE = T.StructType(
    [
        T.StructField("before", TEXT_MAP),
        T.StructField("after", TEXT_MAP),
        T.StructField("source", TEXT_MAP),
        T.StructField("op", TEXT),
        T.StructField("ts_ms", T.LongType()),
    ]
)

COMMON_FIELDS = ("mid", "uid", "vc", "ch", "ar", "is_new")
PAGE_FIELDS = ("page_id", "last_page_id", "item", "item_type", "during_time")

# One app log record. Every scalar is text, so a number where text was expected, or the other
# way round, is no parse failure.
LOG = T.StructType(
    [
        T.StructField("common", text_struct(*COMMON_FIELDS)),
        T.StructField("page", text_struct(*PAGE_FIELDS)),
        T.StructField("err", TEXT_MAP),
        T.StructField("start", TEXT_MAP),
        T.StructField("displays", T.ArrayType(TEXT_MAP)),
        T.StructField("actions", T.ArrayType(TEXT_MAP)),
        T.StructField("ts", TEXT),
    ]
)

# Configuration of a dimension table: which source feeds it and what is kept.
DIM_CONFIG = text_struct(
    "source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key", "op"
)
FACT_CONFIG = text_struct("source_table", "source_type", "sink_table", "sink_columns", "op")

ORDER_DETAIL_FACT = (
    "id",
    "order_id",
    "user_id",
    "sku_id",
    "sku_name",
    "province_id",
    "activity_id",
    "activity_rule_id",
    "coupon_id",
    "date_id",
    "create_time",
    "sku_num",
    "split_original_amount",
    "split_activity_amount",
    "split_coupon_amount",
    "split_total_amount",
    "ts_ms",
)
