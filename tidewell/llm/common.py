"""Tables, scratch tables in the shared folder, connected components, and word hashing in tasks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import shared_dir

SLICE = 1 << 20  # bytes of text that numpy works on at once; a longer text is a slice of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Whole texts go to Python workers in batches of so many rows; the default suits short rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


class Scratch:
    """Tables of one run below ``spark.checkpoint.dir``; they cut lineage and survive executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_dir(spark).rstrip('/')}/tidewell-{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, by: tuple[str, ...] = (), **options: str) -> DataFrame:
        df.write.partitionBy(*by).options(**options).parquet(f"{self.path}/{name}")
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


SALTS = 16  # parts of the edges of a node that many others are linked to


def components(scratch: Scratch, edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, component): the smallest node that ``edges`` (a, b: long) reach.

    Alternating large-star and small-star steps; each is one grouped minimum, combined before
    its shuffle, and one join. Edges go from the larger node a to the smaller b. A root has no smaller neighbour,
    so its many edges stay as they are; they meet the few nodes that have both smaller and larger
    neighbours by node and salt, and no task gets all edges of one node. Nodes without an edge to another are left out.
    """
    now = scratch.keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0"
    )
    for step in range(1, 60):
        low = now.groupBy("a").agg(F.min("b").alias("m"))
        inner = low.join(now.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        inner = inner.select(F.col("a").alias("b"), "m", F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt"))
        salted = now.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
        large = salted.join(inner, ["b", "salt"], "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        large = scratch.keep(large, f"{name}-{step}-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b AS x", "m").unionByName(low.selectExpr("a AS x", "m"))
        small = small.where("x <> m").selectExpr("x AS a", "m AS b").distinct()
        small = scratch.keep(small, f"{name}-{step}")
        sums = [
            d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for d in (now, small)
        ]
        now = small
        if sums[0] == sums[1]:
            break
    else:
        raise RuntimeError("components did not settle")
    ends = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = now.selectExpr("b AS node", "b AS component").distinct()
    return ends.selectExpr("a AS node", "component").unionByName(roots)


# Word hashing. Sums of random 64-bit values times powers of an odd number: the hash of any byte
# range follows from two prefix sums.
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and those of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Hasher:
    """Hashes of ranges of a buffer of bytes, or of code points (any other type)."""

    def __init__(self, buf: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None = None):
        up, self.down = table if table is not None and len(table[0]) > len(buf) else powers(len(buf) + 1)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        values = _VALUES[buf] if buf.dtype == np.uint8 else mixed(buf.astype(np.uint64) + np.uint64(257)) | np.uint64(1)
        np.cumsum(values * up[: len(buf)], out=self.sums[1:])

    def plain(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal ranges; only the first bits are well mixed."""
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed(self.plain(starts, ends))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])).view(np.int8)))
    return edge[::2], edge[1::2]


def slices(texts: list[bytes], limit: int = SLICE) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, last, bytes, starts): texts joined by line feeds, about ``limit`` bytes at a time."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < limit):
            size += len(texts[last]) + 1
            last += 1
        lengths = np.fromiter((len(t) + 1 for t in texts[first:last]), np.int64, last - first)
        yield first, last, b"\n".join(texts[first:last]), np.concatenate(([0], np.cumsum(lengths)))
        first = last


def as_bytes(column) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if x is None else x for x in column.cast("binary").to_pylist()]
