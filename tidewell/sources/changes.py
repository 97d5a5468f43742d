"""Change records from messages, and snapshots of tables as change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.operators import shapes
from tidewell.operators.once import with_column_once


def change_view(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns parsed from JSON text; text that is no JSON gives nulls throughout."""
    return with_column_once(df, "_e", F.from_json(value, schemas.ENVELOPE)).select("_e.*")


def image(columns: dict[str, Column]) -> Column:
    """A row image: named values as text."""
    parts: list[Column] = []
    for name, column in columns.items():
        parts += [F.lit(name), column.cast("string")]
    return F.create_map(*parts)


def no_image() -> Column:
    return F.lit(None).cast("map<string,string>")


def record(columns: dict[str, Column]) -> Column:
    """A row image with fixed fields: a struct of text.

    Where a table's columns are known this is the form to read (see ``typed_view``): a field is a
    column, not a search in a map, and fields that nobody asks for are never built.
    """
    return F.struct(*[column.cast("string").alias(name) for name, column in columns.items()])


def with_maps(df: DataFrame) -> DataFrame:
    """Struct images as maps, for operators that work on fields of any name."""
    fields = df.schema["after"].dataType.fieldNames()

    def as_map(side: str) -> str:
        entries = ", ".join(f"'{f}', {side}.`{f}`" for f in fields)
        return f"CASE WHEN {side} IS NOT NULL THEN map({entries}) END AS {side}"

    return df.selectExpr(as_map("before"), as_map("after"), "source", "op", "ts_ms")


def typed_view(df: DataFrame, fields: Sequence[str], value: str = "value") -> DataFrame:
    """Envelope columns parsed from JSON text, with the named fields of the row images only."""
    row = schemas.text_struct(*fields)
    shape = T.StructType(
        [
            T.StructField(f.name, row if f.name in ("before", "after") else f.dataType)
            for f in schemas.ENVELOPE
        ]
    )
    return with_column_once(df, "_e", F.from_json(value, shape)).select("_e.*")


def origin(db: str, table: str, server_id: str = "1") -> Column:
    return F.create_map(
        *[F.lit(x) for x in ("db", db, "table", table, "server_id", server_id)]
    )


def snapshot_envelopes(
    df: DataFrame, db: str, table: str, ts_ms: Column, columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows of a table as snapshot changes, op ``r``."""
    return df.select(
        no_image().alias("before"),
        image({c: F.col(c) for c in columns or df.columns}).alias("after"),
        origin(db, table).alias("source"),
        F.lit("r").alias("op"),
        ts_ms.cast("bigint").alias("ts_ms"),
    )


def envelope_messages(df: DataFrame) -> DataFrame:
    """Change records as JSON messages."""
    return df.select(F.to_json(F.struct("before", "after", "source", "op", "ts_ms")).alias("value"))


def jdbc_table(
    spark: SparkSession, url: str, query: str, camel: bool = False, **options: str
) -> DataFrame:
    """Result of a query in a database, with camelCase names on demand.

    Give ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` with
    ``dbtable`` in ``options`` to read a large table in parallel.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if "dbtable" not in options:
        reader = reader.option("query", query)
    for key, value in options.items():
        reader = reader.option(key, value)
    df = reader.load()
    return shapes.camel_columns(df) if camel else df
