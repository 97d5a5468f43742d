"""Keyed merges: what an upsert target holds after a set of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators import dedup


def upsert_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Newest row per key; a key whose newest value is null was deleted."""
    return dedup.latest(df, keys, order).filter(F.col(value).isNotNull())


# Tables that are merged batch by batch hold cells: a value with the order of the change that it came
# from. Cells fold by maximum, so the result is the same however the changes fall into batches, in
# which order these come, and whether one comes twice.


def fold(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of cells per key: the greatest of each column. Reduced before it is shuffled."""
    return cells.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cells.columns if c not in keys])


def _order(order: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"_{i}") for i, c in enumerate(order)]


def _cell(value: Column, order: Sequence[str], where: Column) -> Column:
    return F.when(where, F.struct(*_order(order), value.alias("_v")))


def dim_cells(changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cells of a dimension table: ``row_key``, its newest delete and put, and a cell per column.

    Empty values leave no cell. A key whose delete is its newest change stays as a tombstone, so that
    older puts that come later do not bring it back; ``forget`` removes old ones.
    """
    put, at = F.col("op") != "d", F.struct(*_order(order))
    text = {c: F.col(c).cast("string") for c in columns}
    cells = changes.select(
        F.col(key).alias("row_key"),
        F.when(~put, at).alias("_gone"),
        F.when(put, at).alias("_put"),
        *[_cell(v, order, put & v.isNotNull() & (v != "")).alias(c) for c, v in text.items()],
    )
    return fold(cells, ["row_key"])


def dim_values(cells: DataFrame) -> DataFrame:
    """The dimension table that cells stand for.

    A delete removes what came before it, and a put of equal order. Otherwise each column holds
    its last non-empty value: an empty one leaves the older value in place.
    """

    def alive(at: Column) -> Column:
        return F.col("_gone").isNull() | (at > F.col("_gone"))

    def value(name: str) -> Column:
        cell = F.col(f"`{name}`")
        at = F.struct(*[cell[f].alias(f) for f in cells.schema["_put"].dataType.fieldNames()])
        return F.when(cell.isNotNull() & alive(at), cell["_v"]).alias(name)

    names = [c for c in cells.columns if c not in ("row_key", "_gone", "_put")]
    return cells.filter(F.col("_put").isNotNull() & alive(F.col("_put"))).select("row_key", *map(value, names))


def forget(cells: DataFrame, before: int) -> DataFrame:
    """Cells without the tombstones of deletes before ``before``, in the first column of the order.

    A put from before such a delete must not come any more, or its row would be back.
    """
    dead = F.col("_put").isNull() | (F.col("_put") <= F.col("_gone"))
    return cells.filter(~F.coalesce(dead & (F.col("_gone._0") < before), F.lit(False)))


def dim_merge(changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A dimension table after upserts and deletes (op ``d``); see ``dim_values``."""
    return dim_values(dim_cells(changes, key, columns, order))


def partial_cells(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Cells of a table where each column has a version of its own. Deletes are ignored, nulls leave no cell."""
    rows = changes.filter("op <> 'd'") if "op" in changes.columns else changes
    kept = [c for c in dict.fromkeys([*columns, *order]) if c not in keys]
    cells = rows.select(*keys, *[_cell(F.col(c), order, F.col(c).isNotNull()).alias(c) for c in kept])
    return fold(cells, keys)


def partial_values(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that cells stand for: each column with its last non-null value."""
    return cells.select(*keys, *[F.col(f"`{c}`")["_v"].alias(c) for c in cells.columns if c not in keys])


def partial_update(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows by primary key where each column holds its last non-null value.

    ``order`` starts with the sequence column; equal sequences go by the rest, then by the greater value.
    """
    return partial_values(partial_cells(changes, keys, columns, order), keys)


def delete_by_keys(df: DataFrame, gone: DataFrame, key: str = "row_key") -> DataFrame:
    return df.join(gone.select(key), key, "left_anti")
