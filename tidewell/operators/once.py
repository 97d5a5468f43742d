"""Expensive expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_column_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever filters and projections follow.

    Catalyst moves a filter below the projection it refers to and copies the expression into it,
    so a parse would run again for each use. It does not do so across a generator.
    """
    return df.select("*", F.explode(F.array(column)).alias(name))
