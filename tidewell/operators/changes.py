"""Change records: filter, project, route and prune."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import times

OPS = ("c", "u", "d", "r")


def field(df: DataFrame, name: str, side: str = "after") -> Column:
    """A field of a row image, which is a map or a struct; null where there is none."""
    kind = df.schema[side].dataType
    if isinstance(kind, T.StructType) and name not in kind.fieldNames():
        return F.lit(None).cast("string")
    return F.col(side)[name]


def table_is(name: str) -> Column:
    return F.col("source")["table"] == name


# One frame of all tables' changes, or a frame per table.
Topic = DataFrame | Mapping[str, DataFrame]


def of_table(topic: Topic, name: str) -> DataFrame:
    """The changes of one table."""
    rows = topic[name] if isinstance(topic, Mapping) else topic
    return rows.filter(table_is(name))


def filter_valid(
    df: DataFrame, db: str, ops: Iterable[str] = OPS, use_before_for_delete: bool = False
) -> DataFrame:
    """Changes of one database with a known op and a non-empty row image.

    A delete carries its row in ``before`` and so never passes, unless
    ``use_before_for_delete`` moves that image to ``after`` first.
    """
    if use_before_for_delete:
        df = df.withColumn(
            "after", F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        )
    return df.filter(
        (F.col("source")["db"] == db)
        & F.col("op").isin(*ops)
        & F.col("after").isNotNull()
        & (
            F.size("after") > 0
            if isinstance(df.schema["after"].dataType, T.MapType)
            else F.lit(True)
        )
    )


def project(
    topic: Topic,
    table: str,
    columns: Iterable[str] | Mapping[str, str],
    ops: Iterable[str] = ("r",),
    where: Column | None = None,
) -> DataFrame:
    """Named fields of the row image of one table, plus ``ts_ms``."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    kept = of_table(topic, table).filter(F.col("op").isin(*ops))
    if where is not None:
        kept = kept.filter(where)
    return kept.select(*[F.col("after")[src].alias(dst) for src, dst in names.items()], "ts_ms")


def after_or_before(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """``after`` where it holds anything, else ``before``, with the op and its time."""
    whole = F.col("after").isNotNull()
    if isinstance(df.schema["after"].dataType, T.MapType):
        whole = whole & (F.size("after") > 0)
    return df.select(
        F.col("op"),
        F.col("ts_ms").alias("tm_ms"),
        *[
            F.when(whole, field(df, f)).otherwise(field(df, f, "before")).alias(f)
            for f in fields
        ],
    )


def only_tables(df: DataFrame, tables: Iterable[str] | None) -> DataFrame:
    """Changes of the named tables, by a filter that Catalyst can push to the sources."""
    return df if tables is None else df.filter(F.col("source")["table"].isin(*tables))


def route(df: DataFrame, config: DataFrame, tables: Iterable[str] | None = None) -> DataFrame:
    """Attach the configured target to each change and keep the configured fields only.

    Tables without configuration drop out. The configuration holds one row per source table;
    Spark broadcasts it when its size estimate allows and shuffles otherwise. A caller who knows
    the source tables names them in ``tables``, and no other one is read.
    """
    df = only_tables(df, tables)
    rules = config.select(
        F.col("source_table").alias("_table"), "sink_table", "sink_columns", "sink_row_key"
    )
    wanted = F.split("sink_columns", ",", -1)
    return (
        df.join(rules, F.col("source")["table"] == F.col("_table"))
        .withColumn("data", F.map_filter("after", lambda k, _: F.array_contains(wanted, k)))
        .select(
            "sink_table",
            F.col("data")[F.col("sink_row_key")].alias("row_key"),
            "data",
            "op",
            "ts_ms",
        )
    )


def cells(routed: DataFrame) -> DataFrame:
    """Routed rows as one row per stored field."""
    return routed.select(
        "sink_table", "row_key", "op", "ts_ms", F.explode("data").alias("column", "value")
    )


def config_rows(changes: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Changes of a configuration table as its fields, with the op and its time."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    return changes.select(
        *[image[f].alias(f) for f in fields if f != "op"], F.col("op"), F.col("ts_ms")
    )


def config_cells(changes: DataFrame, fields: Iterable[str]) -> DataFrame:
    """The newest change of each source table's configuration as one cell, see ``merges``."""
    rows = config_rows(changes, fields)
    rest = [c for c in rows.columns if c not in ("source_table", "ts_ms")]
    return rows.groupBy("source_table").agg(F.max(F.struct("ts_ms", *rest)).alias("_row"))


def config_values(cells: DataFrame) -> DataFrame:
    """Configuration that cells stand for, deleted rules left out."""
    return cells.select("source_table", "_row.*").filter("op <> 'd'").drop("ts_ms")


def current_config(changes: DataFrame, fields: Iterable[str]) -> DataFrame:
    """Configuration in force after a change history: newest row per source table, deletes out."""
    return config_values(config_cells(changes, fields))


def cart_add(df: DataFrame, mode: str = "delta") -> DataFrame:
    """Cart additions.

    ``snapshot`` keeps snapshot rows with their full count. ``delta`` adds the increases: a
    change row counts by how much its ``sku_num`` grew over ``before``.
    """
    after = F.col("after")["sku_num"].try_cast("int")
    before = F.col("before")["sku_num"].try_cast("int")
    snapshot = F.col("op") == "r"
    kept = df.filter(table_is("cart_info"))
    if mode == "snapshot":
        kept, count = kept.filter(snapshot), F.col("after")["sku_num"]
    elif mode == "delta":
        kept = kept.filter(snapshot | (F.col("op").isin("c", "u") & (after > F.coalesce(before, F.lit(0)))))
        count = F.when(snapshot, F.col("after")["sku_num"]).otherwise(
            (after - F.coalesce(before, F.lit(0))).cast("string")
        )
    else:
        raise ValueError(f"unknown cart mode: {mode}")
    return kept.select(
        F.col("after")["id"].alias("id"),
        F.col("after")["user_id"].alias("user_id"),
        F.col("after")["sku_id"].alias("sku_id"),
        count.alias("sku_num"),
        "ts_ms",
    )


def typed_cart_changes(df: DataFrame) -> DataFrame:
    """Created and updated cart rows with types; a missing int is 0, a missing long is null."""

    def whole(name: str) -> Column:
        return F.coalesce(F.col("after")[name].try_cast("int"), F.lit(0)).alias(name)

    def long(name: str) -> Column:
        return F.col("after")[name].try_cast("bigint").alias(name)

    def text(name: str) -> Column:
        return F.col("after")[name].alias(name)

    return df.filter(table_is("cart_info") & F.col("op").isin("u", "c")).select(
        "ts_ms",
        whole("is_ordered"),
        whole("sku_num"),
        long("create_time"),
        text("user_id"),
        whole("sku_id"),
        text("sku_name"),
        whole("id"),
        long("operate_time"),
        times.ms_to_compact(F.col("ts_ms")).alias("ds"),
    )


def cancelled_orders(topic: Topic, mode: str = "orders") -> DataFrame:
    """Cancelled orders, status 1001 or 1003.

    ``orders`` asks both statuses to be snapshot rows of the order table. ``reference`` lets a
    row with status 1003 pass whatever its table or op, and so needs all changes in one frame.
    """
    status = F.col("after")["order_status"]
    on_orders = table_is("order_info") & (F.col("op") == "r")
    if mode == "orders":
        kept = of_table(topic, "order_info").filter(on_orders & status.isin("1001", "1003"))
    elif mode == "reference":
        kept = topic.filter((on_orders & (status == "1001")) | (status == "1003"))
    else:
        raise ValueError(f"unknown cancel mode: {mode}")
    return kept.select(
        F.col("after")["id"].alias("id"),
        F.col("after")["operate_time"].alias("operate_time"),
        "ts_ms",
    )


def flatten_comments(df: DataFrame, dic_name: Column | None = None) -> DataFrame:
    """Comment changes as flat rows; a change without ``after`` has no row.

    ``nick_name`` is no field of the row image and stays null. ``dic_name`` is the name that was
    looked up, or that field of the row image.
    """
    name = dic_name if dic_name is not None else field(df, "dic_name")

    def long(name: str) -> Column:
        return F.col("after")[name].try_cast("bigint").alias(name)

    def text(name: str, alias: str | None = None) -> Column:
        return F.col("after")[name].alias(alias or name)

    return df.filter(table_is("comment_info") & F.col("after").isNotNull()).select(
        "ts_ms",
        F.col("source")["db"].alias("db"),
        F.col("source")["table"].alias("table"),
        F.col("source")["server_id"].alias("server_id"),
        text("appraise"),
        text("comment_txt", "commentTxt"),
        "op",
        F.lit(None).cast("string").alias("nick_name"),
        long("create_time"),
        long("user_id"),
        long("sku_id"),
        long("id"),
        long("spu_id"),
        long("order_id"),
        name.alias("dic_name"),
    )
