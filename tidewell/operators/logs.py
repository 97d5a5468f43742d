"""App logs: parse, set broken records aside, split by kind."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas
from tidewell.functions.text import is_blank
from tidewell.operators.once import with_column_once

def _raw(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "variant")


def _misfits(record: Column, path: str, fields: Sequence[T.StructField], parsed: Column) -> list[Column]:
    """Conditions under which a nested value is there but not of the schema's nesting."""
    out = []
    for f in fields:
        nested = f.dataType
        if not isinstance(nested, (T.StructType, T.ArrayType)):
            continue
        raw, value = _raw(record, f"{path}.{f.name}"), parsed[f.name]
        out.append(raw.isNotNull() & ~F.is_variant_null(raw) & value.isNull())
        if isinstance(nested, T.StructType):
            out += _misfits(record, f"{path}.{f.name}", nested.fields, value)
        elif isinstance(nested.elementType, (T.StructType, T.ArrayType)):
            every = F.arrays_zip(value.alias("_value"), F.try_variant_get(record, f"{path}.{f.name}", "array<variant>").alias("_raw"))
            out.append(F.exists(every, lambda e: e["_value"].isNull() & ~F.is_variant_null(e["_raw"])))
    return out


def parse_or_dirty(
    df: DataFrame, schema: T.StructType, value: str = "value", fail: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split a text frame into parsed records and dirty ones; null text is in neither.

    Dirty is what is not one JSON object and nothing else, names a field twice, or does not fit the
    schema's nesting. With ``fail`` a dirty record ends the job that reads the parsed ones. A text is
    parsed once, to a variant; what else is asked of it is read from that. Numbers read as text
    lose zeros at the end of a fraction.
    """
    text = F.col(value)
    # The text is all of an element, followed by a zero: with more behind it there are other elements.
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit(",0]")))
    parsed = with_column_once(df.filter(text.isNotNull()), "_all", whole)
    shape = schema.simpleString()
    parsed = with_column_once(parsed, "_rec", F.try_variant_get("_all", "$[0]", shape))
    every = F.col("_all")
    alone = (F.try_variant_get(every, "$[1]", "int") == 0) & _raw(every, "$[2]").isNull()
    misfit = reduce(Column.__or__, _misfits(every, "$[0]", schema.fields, F.col("_rec")), F.lit(False))
    ok = F.col("_rec").isNotNull() & F.coalesce(alone, F.lit(False)) & ~F.coalesce(misfit, F.lit(False))
    parsed = with_column_once(parsed, "_ok", ok)
    ok = F.col("_ok")
    kept = [c for c in df.columns if c != value]
    if fail:
        broken = F.raise_error(F.concat(F.lit("not a record: "), text))
        parsed_ok = parsed.filter(F.when(ok, F.lit(True)).otherwise(broken.cast("boolean")))
    else:
        parsed_ok = parsed.filter(ok)
    good = parsed_ok.select(
        *kept, *[F.col("_rec")[f.name].alias(f.name) for f in schema.fields]
    )
    return good, parsed.filter(~ok).select(*kept, value)


def parse_logs(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Log records with numeric ``ts`` and ``during_time``, and the dirty rest."""
    good, dirty = parse_or_dirty(df, schemas.LOG, value)
    return good.withColumn("ts", F.col("ts").try_cast("bigint")).withColumn(
        "page",
        F.col("page").withField("during_time", F.col("page.during_time").try_cast("bigint")),
    ), dirty


def split_logs(df: DataFrame) -> dict[str, DataFrame]:
    """Five kinds of record from one log frame.

    A record with ``err`` goes to ``err`` whole and then on without it. A record with ``start``
    ends there. Any other is a page view, and each of its displays and actions is a record too.
    Displays carry ``ts``, actions do not.
    """
    is_start = F.col("start").isNotNull()
    views = df.filter(~is_start)
    return {
        "err": df.filter(F.col("err").isNotNull()),
        "start": df.filter(is_start).drop("err"),
        "page": views.drop("err", "start", "displays", "actions"),
        "display": views.select("common", "page", F.explode("displays").alias("display"), "ts"),
        "action": views.select("common", "page", F.explode("actions").alias("action")),
    }


def filter_pages(df: DataFrame, page_ids: tuple[str, ...] = ("home", "good_detail")) -> DataFrame:
    return df.filter(F.col("page.page_id").isin(*page_ids))


def opens_session() -> Column:
    """A page view that no other page led to."""
    return is_blank(F.col("page.last_page_id"))


def filter_logins(df: DataFrame) -> DataFrame:
    """Views of a known user that come from the login page or open a session."""
    return df.filter(
        ~is_blank(F.col("common.uid"))
        & ((F.col("page.last_page_id") == "login") | opens_session())
    )


def filter_searches(df: DataFrame) -> DataFrame:
    return df.filter(
        (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
        & F.col("page.item").isNotNull()
    )
