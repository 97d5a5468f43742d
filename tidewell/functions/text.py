"""Keys, tokens and column names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_RUN = r"[\p{L}\p{N}&&[^\p{IsHan}]]+"
HAN_CHAR = r"\p{IsHan}"


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def md5_key(text: Column) -> Column:
    return F.md5(text)


def cache_key(table: Column, key: Column) -> Column:
    return F.concat_ws(":", table, key)


def last_token(text: Column) -> Column:
    """Text after the last comma, where trailing commas do not count."""
    return F.substring_index(F.rtrim(text, F.lit(",")), ",", -1)


def keywords(text: Column, lexicon: Iterable[str] = ()) -> Column:
    """Words of a text, lower case, in order.

    Letter and digit runs are words. Han text has no blanks: the longest lexicon entry at a
    position is a word, any other Han character stands alone. All of it is one regular
    expression, so it stays in the JVM.
    """
    entries = sorted({w.lower() for w in lexicon if w}, key=lambda w: (-len(w), w))
    pattern = "|".join([re.escape(w) for w in entries] + [WORD_RUN, HAN_CHAR])
    return F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"), F.lit(1))


def camel(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def snake(name: str) -> str:
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()
