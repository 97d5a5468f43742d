"""A table's snapshot and its changes as one stream of changes, without a lock.

The table is read in chunks of keys while it changes. Each chunk has a low mark, the newest change
when its read began, and a high mark, the newest when it ended; what was read of a row is from some moment
between. Changes between the marks are laid over the rows that were read: the chunk is then the table
as of its high mark, and its changes go on from there. A change at or before the high mark of
its chunk is in the snapshot already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS = ("r", "c", "u", "d")


def chunk_of(key: Column, rows: int) -> Column:
    """The chunk of a whole-number key, ``rows`` keys each."""
    return F.floor(key / rows).cast("bigint")


def settled(read: DataFrame, changes: DataFrame, marks: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Chunks as of their high marks: rows with op ``r`` and the high mark as ``position``.

    ``read`` has ``chunk`` and the table's columns, ``changes`` also ``op`` and ``position`` and, for
    deletes, at least the keys; ``marks`` has ``chunk``, ``low`` and ``high``. A chunk without marks is not
    read yet and gives nothing.
    """
    columns = [c for c in read.columns if c != "chunk"]
    # A row that was read is older than any change between the marks, or equal to what that left.
    seen = read.select("chunk", *columns, F.lit("r").alias("op"), F.lit(None).cast("bigint").alias("_at"))
    between = changes.join(marks, "chunk").filter((F.col(position) > F.col("low")) & (F.col(position) <= F.col("high")))
    later = between.select("chunk", *columns, "op", F.col(position).cast("bigint").alias("_at"))
    rest = [c for c in columns if c not in keys]
    newest = seen.unionByName(later).groupBy("chunk", *keys).agg(F.max(F.struct("_at", "op", *rest)).alias("_row"))
    alive = newest.filter("_row.op <> 'd'").join(marks.select("chunk", "high"), "chunk")
    return alive.select("chunk", *keys, *[F.col("_row")[c].alias(c) for c in rest], F.lit("r").alias("op"), F.col("high").alias(position))


def changes_after(changes: DataFrame, marks: DataFrame, position: str) -> DataFrame:
    """Changes behind the high mark of their chunk; on a batch or, with the marks of a finished snapshot, a stream."""
    high = marks.select("chunk", "high")
    return changes.join(high, "chunk").filter(F.col(position) > F.col("high")).drop("high")


def snapshot_then_changes(
    read: DataFrame, changes: DataFrame, marks: DataFrame, keys: Sequence[str], position: str = "position"
) -> DataFrame:
    """The snapshot's rows and the changes after it: each state of a row from its high mark on, once."""
    rows = settled(read, changes, marks, keys, position)
    return rows.unionByName(changes_after(changes, marks, position).select(*rows.columns))
