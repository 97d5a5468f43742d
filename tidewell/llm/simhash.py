"""SimHash near copies with BK-trees.

Documents get a 64-bit fingerprint of their word shingles. Distinct fingerprints go to shards such
that any two within the radius share one: the 64 bits are cut into radius + 2 stretches, of which
two at least agree, so a shard is a pair of stretches and their bits. Each shard holds a BK-tree
(children keyed by their distance to the parent); each fingerprint descends only along edges whose
distance differs by the radius or less from its own, and then joins the tree. A shard emits a
spanning forest of the links it finds, never all its pairs.

A tree of all fingerprints would have no size bound, so trees meet their queries by the shuffle of
shards and are not broadcast. A shard over ``SHARD`` rows is dealt out as pairs of blocks.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Scratch, as_bytes, components

WORDS_PER_SHINGLE = 3
RADIUS = 3
SHARD = 1024
_BLOCK = 100_000  # shingles whose bits are counted at once


def print_of(text: bytes, size: int = WORDS_PER_SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number; a bit is set if over half the hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0]
    for w in words:
        starts.append(starts[-1] + len(w) + 1)
    size = min(size, len(words))
    n = len(words) - size + 1
    of = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        hashes = [of(joined[s : e - 1], 42) for s, e in zip(starts[a:b], starts[a + size : b + size])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``fp``. Null and empty texts have fingerprint 0."""
    keep = [c for c in docs.columns if c != "fp"]
    at = keep.index(text)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])

    def work(batches):
        for batch in batches:
            prints = pa.array([print_of(t) for t in as_bytes(batch.column(at))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], [*batch.schema.names, "fp"])

    return docs.select(*keep).mapInArrow(work, schema)


class BKTree:
    def __init__(self, radius: int):
        self.radius, self.root = radius, None

    def near_then_add(self, value: int) -> list[int]:
        """The tree's values within the radius; then ``value`` joins the tree."""
        if self.root is None:
            self.root = (value, {})
            return []
        found, stack, radius = [], [self.root], self.radius
        while stack:
            other, children = stack.pop()
            d = (value ^ other).bit_count()
            if d <= radius:
                found.append(other)
            for edge in range(max(d - radius, 0), d + radius + 1):
                if edge in children:
                    stack.append(children[edge])
        node = self.root
        while True:
            d = (value ^ node[0]).bit_count()
            if d not in node[1]:
                node[1][d] = (value, {})
                return found
            node = node[1][d]


def forest(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect what the radius connects among ``values`` (unsigned, distinct)."""
    tree, owner, out = BKTree(radius), {}, []

    def top(v: int) -> int:
        while owner[v] != v:
            owner[v] = v = owner[owner[v]]
        return v

    for value in values:
        owner[value] = value
        for other in tree.near_then_add(value):
            a, b = top(value), top(other)
            if a != b:
                owner[a] = b
                out.append((value, other))
    return out


def links(prints: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): links between distinct fingerprints (``fp``) that connect all within ``radius``."""
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    bits = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(cuts, cuts[1:])]
    keys = [F.xxhash64(F.lit(i), bits[a], bits[b]) for i, (a, b) in enumerate(combinations(range(n), 2))]
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = rows.groupBy("key").count().where(F.col("count") > shard)
    hot = hot.select("key", F.ceil(F.col("count") / shard).cast("int").alias("blocks"))
    rows = rows.join(hot, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    rows = rows.withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)")))
    rows = rows.select("key", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "fp")
    names = ["key", "i", "j", "fp"]

    def work(batches):
        group, held = None, []
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)]
            change = np.zeros(len(cols[0]), bool)
            for c in cols[:3]:
                change[1:] |= c[1:] != c[:-1]
            firsts = np.flatnonzero(change)
            edges: list[tuple[int, int]] = []
            values = cols[3].view(np.uint64)
            bounds = [0, *firsts.tolist(), len(values)]
            for a, b in zip(bounds, bounds[1:]):
                now = tuple(int(c[a]) for c in cols[:3]) if a < b else group
                if now != group:
                    if len(held) > 1:
                        edges += forest(held, radius)
                    group, held = now, []
                held += values[a:b].tolist()
            yield _edges(edges)
        if len(held) > 1:
            yield _edges(forest(held, radius))

    # The join's and the count's shards are dealt by key; the pairs of a hot shard's blocks are not.
    return rows.repartition("key", "i", "j").sortWithinPartitions(*names[:3]).select(*names).mapInArrow(work, "a long, b long")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def clusters(scratch: Scratch, prints: DataFrame, key: str = "doc_id", radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(fp, root, component_id): for each fingerprint of ``prints`` (key, fp) its component.

    ``component_id`` is the smallest key of the component's rows, null if all keys are null;
    ``root`` is the component's smallest fingerprint. Equal rows and ties share a fingerprint and
    so a component. An empty table gives an empty result.
    """
    ids = scratch.keep(prints.groupBy("fp").agg(F.min(key).alias("id")), "prints")
    found = components(scratch, scratch.keep(links(ids.select("fp"), radius, shard), "found"))
    rooted = ids.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = scratch.keep(rooted.select("fp", "id", F.coalesce("component", "fp").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")
