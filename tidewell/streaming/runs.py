"""Starting streaming queries and running one over what is there now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    fmt: str = "parquet",
    once: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Write a stream to files. State and progress live under ``checkpoint``, so the query can
    be started again with the same arguments after any failure."""
    writer = df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start(path)


def start_each(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    once: bool = False,
) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_available(spark: SparkSession, df: DataFrame, folder: str, timeout: int = 600) -> DataFrame:
    """Run a stream over all input there is and read back what it wrote under ``folder``."""
    query = start(df, f"{folder}/out", f"{folder}/checkpoint", once=True)
    try:
        if not query.awaitTermination(timeout):
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        if query.isActive:
            query.stop()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")
