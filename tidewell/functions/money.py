"""Decimal amounts carried as text, as change records hold them."""

from __future__ import annotations

from pyspark.sql import Column

AMOUNT = "decimal(16,2)"


def amount(value: Column) -> Column:
    return value.cast(AMOUNT)


def product_text(count: Column, price: Column) -> Column:
    return (amount(count) * amount(price)).cast("string")
