"""Jobs that end in several tables, or combine several operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import people, times
from tidewell.functions.text import is_blank, md5_key
from tidewell.operators import changes, dedup, joins, logs, merges, moderation, visits


def dim_load(
    topic: DataFrame,
    config: DataFrame,
    db: str,
    use_before_for_delete: bool = False,
    tables: Iterable[str] | None = None,
) -> DataFrame:
    """Routed dimension rows: valid changes of configured tables with their kept fields.

    If the source ``tables`` are named, no other one is read.
    """
    valid = changes.filter_valid(topic, db, use_before_for_delete=use_before_for_delete)
    return changes.route(valid, config, tables)


def dim_cells(routed: DataFrame, sink_table: str, columns: Sequence[str], order: Sequence[str] = ("ts_ms",)) -> DataFrame:
    """Cells of one dimension table out of routed rows."""
    rows = routed.filter(F.col("sink_table") == sink_table).select(
        "row_key", *[F.col("data")[c].alias(c) for c in columns], "op", *order
    )
    return merges.dim_cells(rows, "row_key", columns, order)


def dim_table(routed: DataFrame, sink_table: str, columns: Sequence[str], order: Sequence[str] = ("ts_ms",)) -> DataFrame:
    """One dimension table out of routed rows."""
    return merges.dim_values(dim_cells(routed, sink_table, columns, order))


def split_log_messages(messages: DataFrame, order: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Log text to five kinds of record and the dirty rest, with the new-visitor flag repaired."""
    good, dirty = logs.parse_logs(messages)
    return {**logs.split_logs(visits.fix_is_new(good, order)), "dirty": dirty}


def comment_enrich(
    topic: changes.Topic,
    orders: DataFrame,
    dic: DataFrame,
    order_fields: Sequence[str],
    delay: str | None = None,
) -> DataFrame:
    """Comments with the name of their appraisal, their order within a minute, and a day.

    ``dic`` is keyed by the hash of the code. Order fields come under the prefix ``info_``.
    """
    comments = changes.of_table(topic, "comment_info")
    named = joins.dim_join(
        comments, dic, md5_key(F.col("after")["appraise"]), {"dic_name": "_dic"}, default="N/A"
    )
    flat = changes.flatten_comments(named, F.col("_dic"))
    info = changes.after_or_before(orders.filter(changes.table_is("order_info")), order_fields)
    keyed = info.withColumn("ts_ms", F.col("tm_ms")).withColumn("id", F.col("id").try_cast("bigint"))
    joined = joins.interval_join(
        flat, keyed, ("order_id", "id"), "ts_ms", "-1 minute", "1 minute", prefix="info_", delay=delay
    ).drop("info_ts_ms")
    return joined.withColumn("ds", times.ms_to_compact(F.col("ts_ms")))


def user_profiles(topic: changes.Topic, as_of: Column) -> DataFrame:
    """User rows with age, decade and sign at ``as_of``; no gender is ``home``."""
    after = F.col("after")
    born = times.epoch_day_to_date(after["birthday"])
    return (
        changes.of_table(topic, "user_info")
        .filter(after.isNotNull())
        .select(
            after["id"].alias("uid"),
            after["name"].alias("uname"),
            *[after[c].alias(c) for c in ("user_level", "login_name", "phone_num", "email")],
            F.coalesce(after["gender"], F.lit("home")).alias("gender"),
            born.cast("string").alias("birthday"),
            "ts_ms",
            people.decade(born).alias("decade"),
            people.age(born, as_of).alias("age"),
            people.zodiac(born).alias("zodiac_sign"),
        )
        .filter(~is_blank(F.col("uid")))
    )


def user_supplements(topic: changes.Topic) -> DataFrame:
    after = F.col("after")
    return (
        changes.of_table(topic, "user_info_sup_msg")
        .filter(after.isNotNull())
        .select(
            *[after[c].alias(c) for c in ("uid", "unit_height")],
            after["create_ts"].try_cast("bigint").alias("create_ts"),
            *[after[c].alias(c) for c in ("weight", "unit_weight", "height")],
            "ts_ms",
        )
        .filter(~is_blank(F.col("uid")))
    )


BODY_FIELDS = ("height", "unit_height", "weight", "unit_weight")


def join_supplements(users: DataFrame, supplements: DataFrame, delay: str | None = None) -> DataFrame:
    """User rows with the supplements of the same user within five minutes."""
    return joins.interval_join(
        users,
        supplements,
        ("uid", "uid"),
        "ts_ms",
        "-5 minutes",
        "5 minutes",
        right_columns={c: c for c in BODY_FIELDS},
        delay=delay,
    )


def user_labels(topic: changes.Topic, as_of: Column, delay: str | None = None) -> DataFrame:
    """Labelled users, one row per user and time."""
    joined = join_supplements(user_profiles(topic, as_of), user_supplements(topic), delay)
    return dedup.exact(joined, ["uid", "ts_ms"], () if joined.isStreaming else BODY_FIELDS)


def ban_list(comments: DataFrame, words: DataFrame, order: Iterable[str] = ()) -> DataFrame:
    """Comments without duplicates, with both banned-word checks."""
    once = dedup.exact(comments, ["order_id", "ts_ms"], list(order))
    return moderation.ban_list(once, words)
