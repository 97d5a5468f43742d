"""Rows that streams dropped because they came behind the watermark, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "query string, name string, batch bigint, watermark string, place int, operator string, dropped bigint"


class Losses(StreamingQueryListener):
    """Writes a row per stateful operator and micro-batch that dropped rows, under the query's id.

    A micro-batch that is reported twice replaces its own rows. An aggregation sees rows after they were
    reduced on their input partition, so late rows of one group and partition are one row there.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        now = event.progress
        rows = [
            (str(now.id), now.name, now.batchId, now.eventTime.get("watermark"), place, op.operatorName, op.numRowsDroppedByWatermark)
            for place, op in enumerate(now.stateOperators)
            if op.numRowsDroppedByWatermark
        ]
        if rows:
            made = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
            made.write.mode("overwrite").json(f"{self.path}/of={now.id}/at={now.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def watch(spark: SparkSession, path: str) -> Losses:
    """Count dropped rows of all queries of the session from now on; ``spark.streams.removeListener`` ends it."""
    listener = Losses(spark, path)
    spark.streams.addListener(listener)
    return listener


def dropped(spark: SparkSession, path: str) -> DataFrame:
    """Rows dropped so far per query and operator."""
    rows = spark.read.schema(SCHEMA).json(f"{path}/of=*/at=*")
    return rows.groupBy("query", "name", "place", "operator").agg(F.sum("dropped").alias("dropped"))
