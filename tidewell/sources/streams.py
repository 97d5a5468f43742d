"""Message streams as a ``value`` text column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    offset: str = "earliest",
    max_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """Messages of a topic: ``value`` as text (null stays null) and the broker's ``timestamp``.

    Needs Spark's Kafka package on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offset)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"), "timestamp")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int = 64,
) -> DataFrame:
    """Files of a folder as a stream; ``max_files`` bounds a micro-batch."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )


def text_stream(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
