"""Nearest neighbours by a block matrix join over int8 codes; the result is exact.

1. Classes. Equal vectors are one class with its ``k + 1`` smallest keys: no query can use more of
   them, so a vector that holds a third of all rows costs as much as any other.
2. Tiles. Query classes are dealt to blocks of about ``QUERY_CELLS`` numbers, candidates to at most ``GROUPS``
   groups; a tile is one block against one group. Its candidates stream by in chunks. The product of
   int8 codes (exact, in float32 matrix products) gives each inner product up to a bound that
   follows from the lengths of what rounding cut off (Cauchy-Schwarz).
3. Heaps. Pairs whose upper bound reaches the k-th best so far are computed again from the original
   vectors in double precision and go to the query's heap. A tile gives its heaps, and a query's
   heaps of all groups are merged.

Memory is one query block, one chunk of candidates and the heaps, whatever the table's size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.llm.common import Scratch

K = 20
QUERY_CELLS = 1 << 20  # numbers (rows times length) of a query block
GROUP_ROWS, GROUPS = 8192, 64  # a group of candidates has so many rows at least, and there are so many groups at most
SLICE = 512  # queries of a block that meet a chunk at once
EXACT = 1 << 15  # pairs computed again at once
_DEPTH = 1024  # so many products of codes add up exactly in float32
_LAST = -(1 << 63) - 1  # a null key stands behind all others


def points(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, size, v): the vectors that take part, as bytes; float32 if they are stored so, else float64."""
    narrow = isinstance(rows.schema[vector].dataType.elementType, T.FloatType)
    kind = np.dtype(np.float32 if narrow else np.float64)

    def work(batches):
        for batch in batches:
            lists = batch.column(1)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind)  # null becomes NaN
            starts = np.cumsum(lengths) - lengths
            for size in np.unique(lengths[lengths > 0]).tolist():
                at = np.flatnonzero(lengths == size)
                x = flat[starts[at][:, None] + np.arange(size)]
                ok = np.isfinite(x).all(1) & (x != 0).any(1)
                at, x = at[ok], x[ok]
                columns = [batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), size)), pa.array([r.tobytes() for r in x], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "size", "v"])

    typed = F.col(vector).cast("array<float>" if narrow else "array<double>")
    return rows.select(F.col(key).cast("long").alias("key"), typed.alias("v")).mapInArrow(work, "key long, size long, v binary")


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """(c, size, v, first, ids, codes, scale, rest): distinct vectors, numbered, with their smallest keys and codes.

    ``scale`` times the codes is the vector but for a difference of length ``rest``; ``norm`` is the
    vector's own length.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.asc_nulls_last("key")))
    some = vectors.withColumn("place", place).where(F.col("place") <= k + 1)
    ids = F.array_sort(F.collect_list(F.struct("place", "key")))
    some = some.groupBy("v").agg(F.first("size").alias("size"), ids.alias("ids"))
    slim = some.select("size", "v", F.col("ids")[0]["key"].alias("first"), F.col("ids.key").alias("ids"))

    def work(batches):
        for batch in batches:
            names = batch.schema.names
            sizes = batch.column(0).to_numpy()
            codes = [b""] * len(sizes)
            scale, rest, norm = (np.zeros(len(sizes)) for _ in range(3))
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                x = matrix(batch.column(1).take(pa.array(at)).to_pylist(), size)
                top = np.abs(x).max(1)
                unit = x / top[:, None]  # so that squares neither vanish nor overflow
                code = np.rint(unit * 127).astype(np.int8)
                scale[at], norm[at] = top / 127, top * np.linalg.norm(unit, axis=1)
                rest[at] = top * np.linalg.norm(unit - code / 127.0, axis=1)
                for i, c in zip(at, code):
                    codes[i] = c.tobytes()
            new = [pa.array(codes, pa.binary()), pa.array(scale), pa.array(rest), pa.array(norm)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*names, "codes", "scale", "rest", "norm"])

    schema = "size long, v binary, first long, ids array<long>, codes binary, scale double, rest double, norm double"
    return slim.mapInArrow(work, schema).withColumn("c", F.monotonically_increasing_id())


def matrix(rows: list[bytes], size: int) -> np.ndarray:
    kind = np.float32 if rows and len(rows[0]) == 4 * size else np.float64
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), size).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of codes, exact."""
    if a.shape[1] <= _DEPTH:
        return (a @ b.T).astype(np.float64)
    return sum((a[:, s : s + _DEPTH] @ b[:, s : s + _DEPTH].T).astype(np.float64) for s in range(0, a.shape[1], _DEPTH))


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    return np.cumsum(x * y, axis=1)[:, -1]


class Rows:
    """Rows of a block with their codes."""

    def __init__(self, size: int, c, first, v, codes, scale, rest, norm):
        self.c, self.first = c, [_LAST if f is None else -f for f in first]
        self.x = matrix(v, size)
        self.codes = np.frombuffer(b"".join(codes), np.int8).reshape(-1, size).astype(np.float32)
        self.scale, self.rest, self.norm = (np.array(a, np.float64) for a in (scale, rest, norm))

    def __add__(self, other: Rows) -> Rows:
        new = Rows.__new__(Rows)
        for name, mine in vars(self).items():
            more = getattr(other, name)
            setattr(new, name, mine + more if isinstance(mine, list) else np.concatenate((mine, more)))
        return new


class Tile:
    """A block of queries and the heaps of their best candidates so far."""

    def __init__(self, queries: Rows, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple]] = [[] for _ in queries.c]
        self.floor = np.full(len(queries.c), -np.inf)  # the worst of a full heap
        # The longest that a query's rounded form can be.
        self.reach = queries.norm + queries.rest

    def feed(self, chunk: Rows) -> None:
        for start in range(0, len(self.queries.c), SLICE):
            with np.errstate(over="ignore", invalid="ignore", under="ignore"):
                self._meet(slice(start, start + SLICE), chunk)

    def _meet(self, part: slice, chunk: Rows) -> None:
        q = self.queries
        near = products(q.codes[part], chunk.codes) * q.scale[part, None] * chunk.scale[None, :]
        bound = self.reach[part, None] * chunk.rest[None, :] + q.rest[part, None] * chunk.norm[None, :]
        bound += 1e-9 * self.reach[part, None] * chunk.norm[None, :]  # rounding in double precision
        floor = self.floor[part].copy()
        if len(chunk.c) >= self.k and (floor == -np.inf).any():
            low = near - bound
            low[np.isnan(low)] = -np.inf
            floor = np.maximum(floor, np.partition(low, -self.k, axis=1)[:, -self.k])
        # Not below, so that bounds that overflow survive.
        i, j = np.nonzero(~(near + bound < floor[:, None]))
        i += part.start
        for a in range(0, len(i), EXACT):
            self._push(i[a : a + EXACT], j[a : a + EXACT], chunk)

    def _push(self, i: np.ndarray, j: np.ndarray, chunk: Rows) -> None:
        score = inner(self.queries.x[i], chunk.x[j])
        order = np.where(np.isnan(score), -np.inf, score)
        good = np.flatnonzero(order >= self.floor[i])
        for row, at, value, rank in zip(i[good].tolist(), j[good].tolist(), score[good].tolist(), order[good].tolist()):
            heap, item = self.heaps[row], (rank, chunk.first[at], -chunk.c[at], value)
            if len(heap) < self.k:
                heapq.heappush(heap, item)
            elif item[:3] > heap[0][:3]:
                heapq.heapreplace(heap, item)
            if len(heap) == self.k:
                self.floor[row] = heap[0][0]

    def best(self) -> Iterator[tuple[int, int, int, float]]:
        for c, heap in zip(self.queries.c, self.heaps):
            for _, first, other, value in heap:
                yield c, -other, None if first == _LAST else -first, value


def tiles(known: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(q, c, first, score): for each class in ``asked`` (c) and group of candidates the ``k`` best classes."""
    wanted = known.join(asked.select("c").distinct(), "c", "left_semi")
    plan = known.groupBy("size").agg(F.count("*").alias("n")).join(wanted.groupBy("size").agg(F.count("*").alias("m")), "size")
    plan = plan.select(
        "size",
        F.ceil(F.col("m") * F.col("size") / QUERY_CELLS).alias("blocks"),
        F.least(F.lit(GROUPS), F.ceil(F.col("n") / GROUP_ROWS)).cast("long").alias("groups"),
    )
    data = ["c", "first", "v", "codes", "scale", "rest", "norm"]

    def deal(rows: DataFrame, side: int, own: str, n_own: str, other: str, n_other: str) -> DataFrame:
        rows = rows.select("size", *data).join(plan, "size")
        rows = rows.withColumn(own, F.pmod(F.xxhash64("c", F.lit(side)), F.col(n_own)))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(n_other) - 1)))
        return rows.select("size", "block", "group", F.lit(side).alias("side"), *data)

    rows = deal(wanted, 0, "block", "blocks", "group", "groups").unionByName(deal(known, 1, "group", "groups", "block", "blocks"))
    rows = rows.repartition("size", "block", "group").sortWithinPartitions("size", "block", "group", "side")

    def work(batches):
        tile, queries, last = None, None, None

        def flush():
            columns = list(zip(*tile.best())) if tile else [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["q", "c", "first", "score"])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(4)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                key, side = tuple(keys[a, :3]), keys[a, 3]
                own = Rows(int(key[0]), *(batch.column(i).slice(a, b - a).to_pylist() for i in range(4, 11)))
                if key != last:
                    if tile:
                        yield flush()
                    tile, queries, last = None, None, key
                if side == 0:
                    queries = own if queries is None else queries + own
                elif queries is not None:
                    tile = tile or Tile(queries, k)
                    tile.feed(own)
        if tile:
            yield flush()

    return rows.mapInArrow(work, "q long, c long, first long, score double")


def merged(heaps: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query's heaps; there are at most ``GROUPS`` of them."""

    def work(batches):
        held, rows = None, []

        def best():
            ranked = ((-math.inf if math.isnan(r[3]) else r[3], _LAST if r[2] is None else -r[2], -r[1], r) for r in rows)
            return [r[-1] for r in heapq.nlargest(k, ranked, key=lambda r: r[:3])]

        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != held and rows:
                    out += best()
                    rows = []
                held = row[0]
                rows.append(row)
            yield pa.RecordBatch.from_pylist([dict(zip(batch.schema.names, r)) for r in out], batch.schema)
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(batch.schema.names, r)) for r in best()], batch.schema)

    return heaps.repartition("q").sortWithinPartitions("q").mapInArrow(work, heaps.schema)


def search(scratch: Scratch, rows: DataFrame, wanted: Column, key: str = "vec_id", vector: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of largest inner product for each row where ``wanted``.

    ``wanted`` speaks of the column ``key``. The result is exact: products are summed in double
    precision from the first component on, nearest first, ties to the smaller key, null keys last.
    Rows without a key can be found but not asked for. Null, empty and zero vectors, and those that
    hold null or non-finite components, take no part; vectors of different lengths do not meet.
    Repeated rows are rows of their own: a query leaves out its own row only. Products
    that overflow rank as they are, NaN last. With fewer than ``k`` others, all are given. An empty table
    gives an empty result, and other columns do not matter.
    """
    vectors = scratch.keep(points(rows, key, vector), "points")
    known = scratch.keep(classes(vectors, k), "classes")
    asked = vectors.withColumnRenamed("key", key).where(wanted & F.col(key).isNotNull())
    asked = scratch.keep(asked.join(known.select("v", "c"), "v").select(F.col(key).alias("query_id"), "c"), "asked")
    # One class more than asked for: of a query's own class nothing may be left.
    best = scratch.keep(merged(tiles(known, asked, k + 1), k + 1), "best")

    order = F.when(F.isnan("score"), F.lit(float("-inf"))).otherwise(F.col("score"))
    found = best.join(known.select("c", "ids"), "c").select("q", "c", "score", F.posexplode("ids").alias("nth", "vec_id"))
    by_query = Window.partitionBy("q").orderBy(order.desc(), F.asc_nulls_last("vec_id"), "c", "nth")
    found = found.withColumn("place", F.row_number().over(by_query)).where(F.col("place") <= k + 1)
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "c"))).alias("found"))
    rows = asked.join(lists, asked["c"] == lists["q"]).select("query_id", "q", "found")
    # Leave out the query's own row: the first of its class with its key.
    own = F.filter("found", lambda f: (f["c"] == F.col("q")) & (f["vec_id"] == F.col("query_id")))
    rows = rows.withColumn("own", F.get(own, F.lit(0))["place"])
    others = F.filter("found", lambda f: F.col("own").isNull() | (f["place"] != F.col("own")))
    rows = rows.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "f"))
    return rows.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
