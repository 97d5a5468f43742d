"""Merkle manifests of a dataset: subtree roots per group, one root, and proofs for any rows.

Building hashes every level but keeps one in ``LEVELS`` only: a task takes an aligned run of
2**LEVELS stored nodes and climbs LEVELS levels in memory. A proof needs the levels between too; for
the runs that hold a wanted row they are made again from the stored nodes, the siblings on the way
up are given out, and the rest is dropped. Runs are found by the same keys whatever the tree's
size, so no task holds more than one run of nodes and nothing but the number of levels goes to the driver.

Positions in a group do not come from a window over the group, which may hold most of all rows: rows
are sorted by ranges, and a row's position is its place in its range plus what stands before it.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Scratch

LEVELS = 8  # from one stored level to the next
OUT = 20_000  # siblings lists that a task gives out at once

PATH = T.ArrayType(T.StructType([T.StructField("left", T.BooleanType()), T.StructField("hash", T.StringType())]))
_PATH = pa.list_(pa.struct([("left", pa.bool_()), ("hash", pa.string())]))


def leaf(*columns: Column) -> Column:
    """Hash of values, each as byte count and text; null is a dash."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


def tree_name(group: Column) -> Column:
    """A name for a group that sorts like it, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def ranked(scratch: Scratch, rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Adds ``pos`` (from 0) and ``n`` (rows of the tree) to rows with ``tree``; order is by ``order``, nulls first."""
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "_tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    rows = rows.withColumn("_part", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    rows = scratch.keep(rows, f"{name}-sorted")
    # One row per range and tree.
    parts = rows.groupBy("tree", "_part").agg(F.min("_i").alias("_low"), F.count("*").alias("_rows"))
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "tree", "_part", "_low", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(by_tree).alias("n")
    )
    rows = rows.join(parts, ["tree", "_part"])
    return rows.withColumn("pos", F.col("_i") - F.col("_low") + F.col("_before")).drop("_part", "_i", "_low", "_before")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def interior(hashes: list[str], steps: int) -> list[list[str]]:
    """The levels over an aligned run of nodes: each two neighbours, or a last one alone, become their hash."""
    levels = [hashes]
    for _ in range(steps):
        row = levels[-1]
        levels.append([digest("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def steps_of(n: int, levels: int) -> int:
    """How many levels a tree with ``n`` nodes climbs from one stored level to the next."""
    return min(levels, (n - 1).bit_length())


def _runs(batches, width: int):
    """Rows equal in their first ``width`` columns, which stand together."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:width] != held[-1][:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def climb(nodes: DataFrame, levels: int) -> DataFrame:
    """The next stored level: (tree, pos, n, hash)."""
    runs = nodes.where("n > 1").select("tree", F.shiftright("pos", levels).alias("run"), "pos", "n", "hash")
    runs = runs.repartition("tree", "run").sortWithinPartitions("tree", "run", "pos")

    def work(batches):
        out = []
        for rows in _runs(batches, 2):
            n = rows[0][3]
            steps = steps_of(n, levels)
            top = interior([r[4] for r in rows], steps)[-1]
            out.append((rows[0][0], rows[0][1], -(-n // (1 << steps)), top[0]))
            if len(out) >= OUT:
                yield _nodes(out)
                out = []
        if out:
            yield _nodes(out)

    return runs.mapInArrow(work, "tree string, pos long, n long, hash string")


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["tree", "pos", "n", "hash"])


class Forest:
    """The stored levels of the trees over ``rows`` (tree, hash and others), lowest first."""

    def __init__(self, scratch: Scratch, rows: DataFrame, order: Sequence[str], name: str, levels: int = LEVELS):
        self.scratch, self.name, self.levels = scratch, name, levels
        self.stored = [scratch.keep(ranked(scratch, rows, order, name), f"{name}-0")]
        while (self.stored[-1].agg(F.max("n")).first()[0] or 0) > 1:
            self.stored.append(scratch.keep(climb(self.stored[-1], levels), f"{name}-{len(self.stored)}"))

    def roots(self) -> DataFrame:
        """(tree, hash): one row per tree."""
        found = [s.where("n = 1").select("tree", "hash") for s in self.stored]
        while len(found) > 1:
            found = [found[0].unionByName(found[1]), *found[2:]]
        return found[0]

    def prove(self, above: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
        """Rows of the lowest level with ``path``: siblings up to the root, then those of ``above`` (tree, path).

        A sibling tells on which side it stands; its hash is null where a node climbs alone. ``wanted``
        (tree, pos) names rows to prove; runs without one are not made again.
        """
        asked, call = [wanted], uuid.uuid4().hex
        for _ in self.stored[1:]:
            last = asked[-1]
            asked.append(None if last is None else last.select("tree", F.shiftright("pos", self.levels).alias("pos")).distinct())
        paths = None
        for k in reversed(range(len(self.stored))):
            nodes = self.stored[k]
            alone = nodes.where("n = 1").join(above, "tree")
            alone = alone if asked[k] is None else alone.join(asked[k], ["tree", "pos"], "left_semi")
            if paths is not None:
                more = self._descend(nodes.where("n > 1"), paths, asked[k + 1])
                more = more if asked[k] is None else more.join(asked[k], ["tree", "pos"], "left_semi")
                alone = alone.unionByName(more)
            if k == 0:
                return alone
            paths = self.scratch.keep(alone.select("tree", "pos", "path"), f"{self.name}-paths-{call}-{k}")

    def _descend(self, nodes: DataFrame, paths: DataFrame, runs: DataFrame | None) -> DataFrame:
        """``nodes`` with the siblings in their run and then the path of the run's top."""
        levels = self.levels
        rest = [c for c in nodes.columns if c not in ("tree", "pos", "n", "hash")]
        nodes = nodes.withColumn("run", F.shiftright("pos", levels))
        if runs is not None:
            nodes = nodes.join(runs.withColumnRenamed("pos", "run"), ["tree", "run"], "left_semi")
        kept = F.struct(*rest) if rest else F.lit(0)
        low = nodes.select("tree", "run", F.lit(1).alias("side"), "pos", "n", "hash", kept.alias("row"))
        high = paths.select("tree", F.col("pos").alias("run"), F.lit(0).alias("side"), "path")
        rows = high.unionByName(low, allowMissingColumns=True).select("tree", "run", "side", "pos", "n", "hash", "row", "path")
        rows = rows.repartition("tree", "run").sortWithinPartitions("tree", "run", "side", "pos")
        row_type = rows.schema["row"]
        schema = T.StructType([rows.schema[c] for c in ("tree", "pos", "n", "hash")] + [row_type, T.StructField("path", PATH)])

        def work(batches):
            arrow_row, out, ends, left, hashes = None, [], [0], [], []

            def flush():
                columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.string(), pa.int64(), pa.int64(), pa.string(), arrow_row])]
                pairs = pa.StructArray.from_arrays([pa.array(left, pa.bool_()), pa.array(hashes, pa.string())], fields=list(_PATH.value_type))
                path = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs, type=_PATH)
                return pa.RecordBatch.from_arrays([*columns, path], schema.names)

            def typed():
                nonlocal arrow_row
                for batch in batches:
                    arrow_row = batch.schema.field(6).type
                    yield batch

            for rows in _runs(typed(), 2):
                if rows[0][2] != 0 or len(rows) < 2:
                    continue  # nobody asked for this run
                above, rows = rows[0][7], rows[1:]
                over = interior([r[5] for r in rows], steps_of(rows[0][4], levels))[:-1]
                above_left, above_hash = [s["left"] for s in above], [s["hash"] for s in above]
                for i, r in enumerate(rows):
                    out.append((r[0], r[3], r[4], r[5], r[6]))
                    for k, row in enumerate(over):
                        at = i >> k ^ 1
                        left.append(at & 1 == 0)
                        hashes.append(row[at] if at < len(row) else None)
                    left += above_left
                    hashes += above_hash
                    ends.append(len(left))
                if len(out) >= OUT:
                    yield flush()
                    out, ends, left, hashes = [], [0], [], []
            if out:
                yield flush()

        found = rows.mapInArrow(work, schema)
        return found.select("tree", "pos", "n", "hash", *(F.col("row").getField(c).alias(c) for c in rest), "path")


class Manifest:
    """Trees over the rows of each group, and one tree over their roots.

    ``rows`` has ``tree`` (see ``tree_name``), ``hash`` (see ``leaf``) and others; trees take their rows by
    ``order``, nulls first. Rows equal in ``order`` go by hash, and repeated rows are leaves of
    their own. A tree of one row is that row's hash. No rows give no root. Columns with the names of
    results (``RESERVED``) or beginning with an underscore are left out.
    """

    RESERVED = ("pos", "n", "run", "path", "subroot")

    def __init__(self, scratch: Scratch, rows: DataFrame, order: Sequence[str], levels: int = LEVELS):
        rows = rows.drop(*self.RESERVED, *(c for c in rows.columns if c.startswith("_")))
        rows = scratch.keep(rows, "leaves")
        self.groups = Forest(scratch, rows, [*order, "hash"], "groups", levels)
        subroots = scratch.keep(self.groups.roots().select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"), "subroots")
        self.top = Forest(scratch, subroots, ["group"], "top", levels)
        first = self.top.roots().first()
        self.root: str | None = first["hash"] if first else None

    def proofs(self, wanted: DataFrame | None = None) -> DataFrame:
        """Rows with ``subroot`` and ``path``, the siblings from the leaf to the root."""
        nothing = F.array().cast(PATH)
        above = self.top.roots().select("tree", nothing.alias("path"))
        above = self.top.prove(above).select(F.col("group").alias("tree"), F.col("hash").alias("subroot"), "path")
        above = self.top.scratch.keep(above, f"above-{uuid.uuid4().hex}")
        rows = self.groups.prove(above.select("tree", "path"), wanted)
        return rows.join(above.select("tree", "subroot"), "tree")


def proof_digest(path: Column) -> Column:
    """Hash of a path's siblings."""
    return F.sha2(F.concat_ws("", path["hash"]), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""

    def step(node: Column, sibling: Column) -> Column:
        other = F.coalesce(sibling["hash"], F.lit(""))
        return F.sha2(F.when(sibling["left"], F.concat(other, node)).otherwise(F.concat(node, other)), 256)

    return F.aggregate(path, start, step)
