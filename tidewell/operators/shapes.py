"""Rows as JSON text and back to columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.operators.changes import only_tables


def to_snake_json(df: DataFrame, hidden: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Each row as one JSON text with snake_case names; nulls and hidden columns are left out."""
    kept = [F.col(c).alias(tx.snake(c)) for c in df.columns if c not in hidden]
    return df.select(F.to_json(F.struct(*kept)).alias(value))


def to_messages(
    df: DataFrame, topic: str | Column, key: Column | None = None, value: Column | None = None
) -> DataFrame:
    """Rows as messages: ``topic``, ``key`` and ``value``, by default the whole row as JSON."""
    target = F.lit(topic) if isinstance(topic, str) else topic
    body = value if value is not None else F.to_json(F.struct(*df.columns))
    name = key if key is not None else F.lit(None).cast("string")
    return df.select(target.alias("topic"), name.alias("key"), body.alias("value"))


def route_topics(
    df: DataFrame, config: DataFrame, key: str = "id", tables: Iterable[str] | None = None
) -> DataFrame:
    """Changes as messages for the topic that is configured for their table.

    ``tables`` may name the source tables, so that no other one is read.
    """
    rules = config.select(
        F.col("source_table").alias("_table"), F.col("sink_table").alias("_topic"), "sink_columns"
    )
    wanted = F.split("sink_columns", ",", -1)
    kept = only_tables(df, tables).join(rules, F.col("source")["table"] == F.col("_table")).withColumn(
        "_data", F.map_filter("after", lambda k, _: F.array_contains(wanted, k))
    )
    return to_messages(kept, F.col("_topic"), F.col("after")[key], F.to_json("_data"))


def camel_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: tx.camel(c) for c in df.columns})
