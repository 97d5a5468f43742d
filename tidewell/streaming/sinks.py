"""Where results go: message topics, append tables and tables of cells.

Every write of a micro-batch is keyed by its batch id and replaces what an earlier attempt at
the same batch left, so a replay after a lost executor or driver changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import merges


def kafka_options(servers: str, idempotent: bool = False) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    if idempotent:
        options |= {"kafka.acks": "all", "kafka.enable.idempotence": "true"}
    return options


def write_kafka(messages: DataFrame, servers: str, idempotent: bool = False) -> None:
    """Send a batch of messages (``topic``, ``key``, ``value``). Needs Spark's Kafka package."""
    messages.write.format("kafka").options(**kafka_options(servers, idempotent)).save()


def stream_kafka(messages: DataFrame, servers: str, checkpoint: str, idempotent: bool = True):
    return (
        messages.writeStream.format("kafka")
        .options(**kafka_options(servers, idempotent))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_topic_files(messages: DataFrame, path: str, batch_id: int = 0) -> None:
    """Messages as text files under ``batch=<id>/topic=<topic>``: the offline form of topics."""
    messages.select("topic", "value").write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).partitionBy("topic").text(f"{path}/batch={batch_id}")


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("topic", "value")


def append_table(df: DataFrame, path: str, batch_id: int = 0) -> None:
    """Rows of one micro-batch as JSON lines under ``batch=<id>``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").json(
        f"{path}/batch={batch_id}"
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that ``append_table`` wrote."""
    return spark.read.schema(schema).json(path).select(*schema.names)


def for_each_batch(path: str, write: Callable[[DataFrame, str, int], None] = append_table):
    def run(batch: DataFrame, batch_id: int) -> None:
        write(batch, path, batch_id)

    return run


class CellTable:
    """A keyed table as the cells (see ``merges``) that its batches left.

    A batch is one Spark write of its own cells into ``batch=<id>``, whatever the size of the table, and
    a second try replaces it. ``cells`` folds what all folders hold; since cells fold by maximum, a reader may meet
    a batch half, once or twice. After ``every`` folders a batch writes ``upto=<id>`` with all older cells as well.
    The folders before the last but one of those are then deleted, so plans that
    were made before the last one read on.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], every: int = 20):
        self.spark, self.path, self.keys, self.every = spark, path.rstrip("/"), list(keys), every

    def _at(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def folders(self, before: int | None = None) -> list[tuple[int, str]]:
        """(batch id, name) of the folders, oldest first."""
        fs, where = self._at(self.path)
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        found = [(int(name.split("=")[1]), name) for name in names if name.startswith(("batch=", "upto="))]
        return sorted(f for f in found if before is None or f[0] < before)

    def cells(self, before: int | None = None) -> DataFrame | None:
        """The cells of the table; none if nothing was written yet."""
        paths = [f"{self.path}/{name}" for _, name in self.folders(before)]
        return merges.fold(self.spark.read.parquet(*paths), self.keys) if paths else None

    def add(self, cells: DataFrame, batch_id: int) -> None:
        """Add the cells of a batch. Batch ids must rise, as those of one streaming query do."""
        older = self.folders(batch_id)
        whole = [i for i, name in older if name.startswith("upto=")]
        name = f"batch={batch_id}"
        if len(older) - (older.index((whole[-1], f"upto={whole[-1]}")) if whole else 0) >= self.every:
            cells = merges.fold(self.cells(batch_id).unionByName(cells), self.keys)
            name = f"upto={batch_id}"
        cells.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/{name}")
        for i, old in older:
            if len(whole) > 1 and i < whole[-2]:
                self._delete(f"{self.path}/{old}")

    def _delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def drop(self) -> None:
        """Delete the table."""
        self._delete(self.path)


def apply_dim_config(spark: SparkSession, changes: DataFrame, namespace: str = "default") -> list[str]:
    """Create and drop dimension tables as their configuration changes.

    ``r`` and ``c`` create, ``d`` drops, ``u`` drops and creates anew. The configuration is a
    handful of rows; returns the statements that were run.
    """
    ran: list[str] = []
    for row in changes.select("sink_table", "sink_columns", "op").collect():
        name = f"{namespace}.{row.sink_table}"
        columns = ", ".join(f"`{c}` STRING" for c in ["row_key", *row.sink_columns.split(",")])
        if row.op in ("d", "u"):
            ran.append(f"DROP TABLE IF EXISTS {name}")
        if row.op != "d":
            ran.append(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    for statement in ran:
        spark.sql(statement)
    return ran


def put_rows(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Any rows as dimension puts: every value as text, op ``c``."""
    kept = columns or [c for c in df.columns if c != key]
    return df.select(
        F.col(key).cast("string").alias("row_key"),
        *[F.col(c).cast("string").alias(c) for c in kept],
        F.lit("c").alias("op"),
    )
