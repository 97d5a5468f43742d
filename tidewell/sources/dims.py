"""Dimension tables: columns of text, keyed by ``row_key``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import shapes


def as_dim(df: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """A table in dimension form; ``columns`` maps source columns to stored ones."""
    return df.select(
        F.col(key).cast("string").alias("row_key"),
        *[F.col(src).cast("string").alias(dst) for src, dst in columns.items()],
    )


def find_row(df: DataFrame, key: str, columns: Mapping[str, str], value: str, camel: bool = False) -> DataFrame:
    """One row of a table in dimension form; the filter is on the typed key and reaches the files."""
    typed = F.col(key) == F.lit(value).try_cast(df.schema[key].dataType)
    return get_row(as_dim(df.filter(typed), key, columns), value, camel)


def get_row(dim: DataFrame, key: str, camel: bool = False) -> DataFrame:
    """The row with the given key, or no row; the filter reaches the files of a stored dimension."""
    found = dim.filter(F.col("row_key") == key)
    return shapes.camel_columns(found) if camel else found


def scan(dim: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows in key order."""
    return dim.orderBy("row_key").limit(limit)


def count_rows(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count("row_key").alias("row_count"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; blank lines are no words."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter("word <> ''")
