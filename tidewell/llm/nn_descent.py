"""Near copies among embeddings by NN-descent.

1. Classes. Vectors within half the threshold's angle of a leader are all linked to one another,
   whatever they are. Rounds of random hyperplanes bring close vectors together; leaders found in a
   round meet in the next. A tight group of any size ends as a few leaders and never as its pairs.
2. Graph of leaders. Hyperplane tables, so many that a pair at the threshold misses them all with a
   chance of ``MISS`` at most, give first pairs; a bucket of any size is compared in full, as pairs of
   blocks. Then each node's neighbours, in both directions, are compared with one another. Every pair near enough for a link is kept,
   however many a node has; the lists that the search goes by hold a node's nearest, and are
   doubled in length while they are saturated and longer ones find links. Only nodes within
   ``REACH`` threshold angles are neighbours: farther ones lead nowhere a threshold link could be.
3. Audit. Partners just within the threshold are planted beside some nodes before the search, and samples
   of nodes are compared with all others until enough true links are seen. If too few of either are found, tables are
   doubled; a search that stays below ``RECALL`` is an error.
4. Links. By the triangle inequality most pairs of classes are linked as a whole or not at all. The
   others are compared member by member, one block against a stream, and counted, not listed.
   Cosines of members are taken in double precision; no link lies below the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import Scratch, components, mixed

COSINE = 0.95
REACH = 3.0  # in threshold angles
ROUNDS = 3
CHUNK = 256  # rows of a bucket that are compared with one another
PER_BUCKET, MISS = 16, 0.005
NEIGHBOURS = 8
GAIN = 0.001  # new links, as a share of all, for which the search goes on
PLANTED = 256
AUDIT, SEEN, MOST_AUDITED = 64, 200, 4096  # nodes sampled first, links to see, nodes sampled at most
RECALL, ATTEMPTS = 0.98, 4


def points(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v): unit vectors as bytes of doubles; null for vectors that link with nothing."""

    def work(batches):
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                ok = x is not None and len(x) > 0 and None not in x
                x = np.array(x, np.float64) if ok else None
                ok = ok and bool(np.isfinite(x).all()) and bool((x != 0).any())
                if ok:
                    x = x / np.abs(x).max()  # so that squares neither vanish nor overflow
                    x = x / np.linalg.norm(x)
                out.append(x.tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [key, "v"])

    slim = rows.select(F.col(key).cast("long").alias(key), vector)
    return slim.mapInArrow(work, f"{key} long, v binary").withColumn("n", F.monotonically_increasing_id())


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1, 1))


def groups(batches, width: int, limit: int | None = None) -> Iterator[list[tuple]]:
    """Rows of one group (equal in their first ``width`` columns), at most ``limit`` at a time."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (row[:width] != held[-1][:width] or len(held) == limit):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def bucketed(nodes: DataFrame, first_table: int, tables: int, bits: int) -> DataFrame:
    """(bucket, place, blocks, n, v, rho, marks) for each table: nodes on the same sides of random hyperplanes.

    Vectors of different length never share a bucket. ``place`` is the table's, from 0, and ``marks`` are the
    buckets of all. A bucket of more than ``CHUNK`` rows has several ``blocks``.
    """

    def work(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            n, v, rho = (batch.column(i).to_pylist() for i in range(3))
            by_size: dict[int, list[int]] = {}
            for i, x in enumerate(v):
                by_size.setdefault(len(x), []).append(i)
            for size, at in by_size.items():
                x, found = _matrix([v[i] for i in at]), []
                for t in range(first_table, first_table + tables):
                    if (size, t) not in planes:
                        planes[size, t] = np.random.default_rng([t, size]).normal(size=(x.shape[1], bits))
                    sides = (x @ planes[size, t] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                    found.append(mixed(mixed(sides.astype(np.uint64) + np.uint64(1)) + np.uint64(t * 65_537 + size)).view(np.int64))
                marks = pa.array([m.tobytes() for m in np.stack(found, 1)], pa.binary())
                own = [pa.array([c[i] for i in at], k) for c, k in zip((n, v, rho), (pa.int64(), pa.binary(), pa.float64()))]
                for place, bucket in enumerate(found):
                    columns = [pa.array(bucket), pa.array(np.full(len(at), place, np.int32)), *own, marks]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "place", "n", "v", "rho", "marks"])

    rows = nodes.select("n", "v", "rho").mapInArrow(work, "bucket long, place int, n long, v binary, rho double, marks binary")
    hot = rows.groupBy("bucket").count().where(F.col("count") > CHUNK)
    return rows.join(hot, "bucket", "left").withColumn("blocks", F.ceil(F.coalesce("count", F.lit(1)) / CHUNK)).drop("count")


def _near(rows: list[tuple], others: list[tuple] | None, threshold: float) -> tuple[np.ndarray, ...]:
    """(a, b, angle, link) of pairs within reach among ``rows``, or between them and ``others``; rows end in n, v, rho.

    ``link``: near enough for the classes to be linked.
    """
    right = rows if others is None else others
    n, m = np.array([r[-3] for r in rows]), np.array([r[-3] for r in right])
    angle = angles(_matrix([r[-2] for r in rows]), _matrix([r[-2] for r in right]))
    far = angle <= REACH * threshold
    i, j = np.nonzero(far & (n[:, None] < m[None, :]) if others is None else far & (n[:, None] != m[None, :]))
    rho, more, angle = np.array([r[-1] for r in rows])[i], np.array([r[-1] for r in right])[j], angle[i, j]
    return np.minimum(n[i], m[j]), np.maximum(n[i], m[j]), angle, angle <= threshold + rho + more + 1e-6, i, j


PAIR = "a long, b long, angle double, link boolean"


def _pairs(a, b, angle, link) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, angle, link)], ["a", "b", "angle", "link"])


def together(rows: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a < b, angle, link) within reach that share a bucket, each once: in the first table where they do."""
    block = F.pmod(F.xxhash64("n"), F.col("blocks"))
    rows = rows.withColumn("block", block).withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    rows = rows.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "place", "marks", "n", "v", "rho"
    )
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def work(batches):
        for rows in groups(batches, 3):
            by_size: dict[int, list[tuple]] = {}
            for r in rows:
                by_size.setdefault(len(r[-2]), []).append(r)
            for own in by_size.values():
                left, right, place = own, None, own[0][4]
                if own[0][1] != own[0][2]:
                    left, right = [r for r in own if r[3] == r[1]], [r for r in own if r[3] == r[2]]
                if not left or right == [] or right is None and len(left) < 2:
                    continue
                a, b, angle, link, i, j = _near(left, right, threshold)
                if place and len(a):
                    marks = [np.frombuffer(b"".join(r[5] for r in side), np.int64).reshape(len(side), -1)[:, :place] for side in (left, right or left)]
                    new = ~(marks[0][i] == marks[1][j]).any(1)
                    a, b, angle, link = a[new], b[new], angle[new], link[new]
                yield _pairs(a, b, angle, link)

    return rows.mapInArrow(work, PAIR)


def lead(nodes: DataFrame, number: int, bits: int, radius: float) -> DataFrame:
    """(n, leader, v, rho): nodes of a bucket go to its first leader within ``radius`` of all they stand for."""

    def work(batches):
        for rows in groups(batches, 2, CHUNK):
            x, rho = _matrix([r[3] for r in rows]), np.array([r[4] for r in rows])
            leader, reach = np.full(len(rows), -1), rho.copy()
            for i in range(len(rows)):
                if leader[i] < 0:
                    away = angles(x[i : i + 1], x)[0] + rho
                    mine = (leader < 0) & (away <= radius)
                    mine[i] = True
                    leader[mine] = i
                    mine[i] = False
                    reach[i] = max(rho[i], away[mine].max(initial=0))
            n = [r[2] for r in rows]
            own = leader == np.arange(len(rows))
            columns = [n, [n[k] for k in leader], [r[3] if o else None for r, o in zip(rows, own)], np.where(own, reach, 0.0)]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["n", "leader", "v", "rho"])

    rows = bucketed(nodes, 1000 + number, 1, bits).withColumn("salt", F.pmod(F.xxhash64("n"), F.col("blocks")))
    rows = rows.select("bucket", "salt", "n", "v", "rho").repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "n")
    return rows.mapInArrow(work, "n long, leader long, v binary, rho double")


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select("a", "b", "angle").union(pairs.select("b", "a", "angle"))


def nearest(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest (b, angle) of each a; cut down on each input partition first."""
    place = F.row_number().over(Window.partitionBy("a").orderBy("angle", "b"))
    return edges.withColumn("place", place).where(F.col("place") <= k)


def around(nodes: DataFrame, graph: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs within reach among each node's neighbours in both directions, the node included."""
    back = nearest(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "angle"), k)
    lists = graph.select("a", "b").union(back.select("a", "b")).union(graph.select("a", F.col("a").alias("b"))).distinct()
    rows = lists.join(nodes.select(F.col("n").alias("b"), "v", "rho"), "b").select("a", F.col("b").alias("n"), "v", "rho")
    rows = rows.repartition("a").sortWithinPartitions("a")

    def work(batches):
        for rows in groups(batches, 1):
            by_size: dict[int, list[tuple]] = {}
            for r in rows:
                by_size.setdefault(len(r[-2]), []).append(r)
            for own in by_size.values():
                if len(own) > 1:
                    yield _pairs(*_near(own, None, threshold)[:4])

    return rows.mapInArrow(work, PAIR).dropDuplicates(["a", "b"])


def descend(
    scratch: Scratch, nodes: DataFrame, graph: DataFrame, links: DataFrame, k: int, threshold: float, name: str
) -> tuple[DataFrame, DataFrame, int]:
    """Refine neighbour lists through neighbours of neighbours; (graph, links, length of lists)."""
    known = links.count()
    step, idle = 0, 0
    # Lists longer than there are nodes cannot be saturated, and a step without new links ends the search soon.
    while idle < 2:
        found = scratch.keep(around(nodes, graph, k, threshold), f"{name}-found-{step}")
        new = scratch.keep(found.where("link").join(links, ["a", "b"], "left_anti").select("a", "b", "angle"), f"{name}-new-{step}")
        more = new.count()
        links = links.unionByName(new)
        if step % 4 == 3:
            links = scratch.keep(links, f"{name}-links-{step}")
        edges = graph.select("a", "b", "angle").union(both_ways(found)).dropDuplicates(["a", "b"])
        graph = scratch.keep(nearest(edges, k).select("a", "b", "angle", "place"), f"{name}-{step}")
        known += more
        idle = idle + 1 if more <= GAIN * known else 0
        # Saturated: the last of a full list is still near enough for a link between classes.
        if not idle and graph.where((F.col("place") == k) & (F.col("angle") <= 2 * threshold)).limit(1).count():
            k *= 2
        step += 1
    return graph, scratch.keep(links, f"{name}-links"), k


def plant(nodes: DataFrame, threshold: float, count: int = PLANTED) -> tuple[DataFrame, DataFrame]:
    """(nodes, pairs): partners of about ``count`` nodes just within the threshold, numbered below zero."""
    total = nodes.count()
    draw = F.pmod(F.xxhash64("n", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, count / max(1, total)))
    rng, made, pairs = np.random.default_rng(20240601), [], []
    for r in nodes.where(draw & (F.octet_length("v") > 8)).select("n", "v").orderBy("n").collect():
        x = np.frombuffer(r["v"], np.float64)
        side = rng.normal(size=len(x))
        side -= (side @ x) * x
        y = math.cos(0.999 * threshold) * x + math.sin(0.999 * threshold) * side / np.linalg.norm(side)
        made.append((-1 - len(made), bytearray((y / np.linalg.norm(y)).tobytes()), 0.0))
        pairs.append((made[-1][0], r["n"]))
    spark = nodes.sparkSession
    return spark.createDataFrame(made, "n long, v binary, rho double"), spark.createDataFrame(pairs, "a long, b long")


def audit(nodes: DataFrame, links: DataFrame, threshold: float, sample: int) -> tuple[int, int]:
    """(links of about ``sample`` nodes, how many of them were found); the nodes meet all others."""
    total = nodes.count()
    draw = F.pmod(F.xxhash64("n", F.lit(7)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, total)))
    asked = [(r["n"], r["v"], r["rho"]) for r in nodes.where(draw).select("n", "v", "rho").collect()]
    if not asked:
        return 0, 0
    shared = nodes.sparkSession.sparkContext.broadcast(asked)

    def work(batches):
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for size in {len(r[1]) for r in rows} & {len(q[1]) for q in shared.value}:
                own, qs = [r for r in rows if len(r[1]) == size], [q for q in shared.value if len(q[1]) == size]
                limit = threshold + np.array([q[2] for q in qs])[:, None] + np.array([r[2] for r in own])[None, :]
                n, m = np.array([q[0] for q in qs]), np.array([r[0] for r in own])
                i, j = np.nonzero((angles(_matrix([q[1] for q in qs]), _matrix([r[1] for r in own])) <= limit) & (n[:, None] != m[None, :]))
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(n[i], m[j])), pa.array(np.maximum(n[i], m[j]))], ["a", "b"])

    true = nodes.select("n", "v", "rho").mapInArrow(work, "a long, b long").distinct()
    row = true.join(links.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").agg(F.count("*").alias("n"), F.count("hit").alias("hit")).first()
    return row["n"], row["hit"]


def recall(nodes: DataFrame, links: DataFrame, planted: DataFrame, threshold: float) -> float:
    """The lesser of the shares of planted and of sampled true links that were found."""
    n, hit = planted.count(), planted.join(links, ["a", "b"], "left_semi").count()
    least, total, sample = hit / n if n else 1.0, nodes.count(), AUDIT
    while True:
        n, hit = audit(nodes, links, threshold, sample)
        if n >= SEEN or sample >= min(total, MOST_AUDITED):
            return min(least, hit / n) if n else least
        sample *= 8


def search(scratch: Scratch, nodes: DataFrame, bits: int, threshold: float) -> DataFrame:
    """(a, b, angle): pairs of nodes (n, v, rho) near enough for a link; raises if too few are found."""
    partners, planted = plant(nodes, threshold)
    every = scratch.keep(nodes.select("n", "v", "rho").unionByName(partners), "nodes")
    planted = scratch.keep(planted, "planted")
    chance = (1 - threshold / math.pi) ** bits
    tables, first = math.ceil(math.log(MISS) / math.log(1 - chance)), 0
    graph, links, k, found = None, None, NEIGHBOURS, 0.0
    for attempt in range(ATTEMPTS):
        near = scratch.keep(together(bucketed(every, first, tables, bits), threshold), f"near-{attempt}")
        new = near.where("link").select("a", "b", "angle")
        links = scratch.keep(new if links is None else links.unionByName(new).dropDuplicates(["a", "b"]), f"links-{attempt}")
        edges = both_ways(near) if graph is None else graph.select("a", "b", "angle").union(both_ways(near)).dropDuplicates(["a", "b"])
        graph = scratch.keep(nearest(edges, k).select("a", "b", "angle", "place"), f"first-{attempt}")
        graph, links, k = descend(scratch, every, graph, links, k, threshold, f"graph-{attempt}")
        found = recall(nodes, links, planted, threshold)
        if found >= RECALL:
            return links.where("a >= 0")
        first += tables
        tables *= 2
    raise RuntimeError(f"only {found:.3f} of the links were found, {RECALL} are wanted")


def member_links(pairs: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """(n, own, other, links): links of members with members of the other class of each pair (a, b)."""
    own = members.select("leader", "n", "v", F.pmod(F.xxhash64("n"), F.lit(1 << 30)).alias("draw"))
    sizes = members.groupBy("leader").count().select("leader", F.ceil(F.col("count") / CHUNK).alias("blocks"))
    pairs = pairs.join(sizes.withColumnRenamed("leader", "a"), "a").withColumnRenamed("blocks", "na")
    held = pairs.join(own.withColumnRenamed("leader", "a"), "a").select("a", "b", F.expr("draw % na").alias("i"), F.lit(0).alias("side"), "n", "v")
    block = F.explode(F.expr("sequence(0L, na - 1)"))
    streamed = pairs.withColumn("i", block).join(own.withColumnRenamed("leader", "b"), "b").select("a", "b", "i", F.lit(1).alias("side"), "n", "v")
    rows = held.unionByName(streamed).repartition("a", "b", "i").sortWithinPartitions("a", "b", "i", "side")

    def work(batches):
        def out(rows):
            columns = list(zip(*rows)) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n", "own", "other", "links"])

        left, x, count = [], None, None
        for rows in groups(batches, 4, 4 * CHUNK):
            a, b = rows[0][:2]
            if rows[0][3] == 0:
                if left and left[0][:3] != rows[0][:3]:
                    left = []
                left += rows
                x = _matrix([r[5] for r in left])
            elif left and left[0][:3] == rows[0][:3]:
                y = _matrix([r[5] for r in rows])
                near = x @ y.T >= cosine
                yield out([(r[4], a, b, int(c)) for r, c in zip(left, near.sum(1)) if c] + [(r[4], b, a, int(c)) for r, c in zip(rows, near.sum(0)) if c])

    return rows.mapInArrow(work, "n long, own long, other long, links long")


def link(scratch: Scratch, rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """(key, n_links, component_id, kept), one row per row of ``rows``.

    Vectors that are null, empty, zero or hold null or infinite components, and vectors of different
    lengths, link with nothing. Equal vectors, and rows with one key, are vectors of their own and
    link. ``component_id`` is the smallest key reachable (null if none has one), the row's own for
    rows without links; ``kept`` compares the two, null with null being equal.
    """
    threshold = math.acos(cosine)
    every = scratch.keep(points(rows, key, vector), "points")
    valid = every.where("v IS NOT NULL")
    bits = max(1, math.ceil(math.log2(max(2, valid.count()) / PER_BUCKET)))
    bits = min(bits, 40)

    # Classes.
    nodes = valid.select("n", "v", F.lit(0.0).alias("rho"))
    owner = valid.select("n", F.col("n").alias("leader"))
    for number in range(ROUNDS):
        found = scratch.keep(lead(nodes, number, bits, threshold / 2 - 1e-6), f"leaders-{number}")
        nodes = found.where("n = leader").select("n", "v", "rho")
        step = found.select(F.col("n").alias("leader"), F.col("leader").alias("next"))
        owner = owner.join(step, "leader").select("n", F.col("next").alias("leader"))
    owner = scratch.keep(owner, "owners")
    members = scratch.keep(valid.select("n", "v").join(owner, "n"), "members")

    graph = search(scratch, nodes, bits, threshold)

    # Links between classes: all, or some to be compared.
    rho = nodes.select("n", "rho")
    pairs = graph.join(rho.toDF("a", "ra"), "a").join(rho.toDF("b", "rb"), "b").where(F.col("angle") <= threshold + F.col("ra") + F.col("rb") + 1e-6)
    pairs = scratch.keep(pairs.withColumn("whole", F.col("angle") + F.col("ra") + F.col("rb") <= threshold - 1e-6), "pairs")
    sizes = members.groupBy("leader").agg(F.count("*").alias("size"))
    whole = pairs.where("whole").select("a", "b")
    whole = whole.union(whole.select("b", "a")).join(sizes.withColumnRenamed("leader", "b"), "b")
    by_class = sizes.join(whole.groupBy(F.col("a").alias("leader")).agg(F.sum("size").alias("more")), "leader", "left")
    by_class = by_class.select("leader", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("base"))
    some = scratch.keep(member_links(pairs.where("NOT whole").select("a", "b"), members, cosine), "members-linked")
    edges = pairs.where("whole").select("a", "b").union(some.selectExpr("own AS a", "other AS b").distinct())
    found = components(scratch, edges, "classes").withColumnRenamed("node", "leader")

    extra = some.groupBy("n").agg(F.sum("links").alias("extra"))
    linked = owner.join(by_class, "leader").join(extra, "n", "left").join(found, "leader", "left")
    linked = linked.select("n", (F.col("base") + F.coalesce("extra", F.lit(0))).alias("n_links"), F.coalesce("component", "leader").alias("root"))
    linked = scratch.keep(every.drop("v").join(linked, "n", "left"), "linked")
    least = linked.where("root IS NOT NULL").groupBy("root").agg(F.min(key).alias("component_id"))
    out = linked.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col(key)).otherwise(F.col("component_id"))
    out = out.select(key, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
