"""What a stream has done, as a table: one row for each micro-batch, written while it runs."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.sinks import folders

SCHEMA = "query_id string, run_id string, batch_id long, input_rows long, late_rows long, state_rows long, duration_ms long, watermark string"


class ProgressTable(StreamingQueryListener):
    """Writes the progress of the queries that run while it listens, one small file a report.

    Spark keeps the last reports of a query that runs and none of one that ended; the table has those of all runs.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ended = spark, path, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = dict(query_id=str(p.id), run_id=str(p.runId), batch_id=p.batchId, input_rows=p.numInputRows,
                   late_rows=sum(o.numRowsDroppedByWatermark for o in p.stateOperators), state_rows=sum(o.numRowsTotal for o in p.stateOperators),
                   duration_ms=p.batchDuration, watermark=p.eventTime.get("watermark"))
        folders.write_text(self.spark, f"{self.path}/{p.id}-{p.batchId}-{p.runId}-{p.timestamp.replace(':', '')}.json", json.dumps(row))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def progress(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query and micro-batch; of several reports about one the fullest counts."""
    if not folders.names(spark, path):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).json(path)
    names = ["input_rows", "late_rows", *(n for n in rows.columns if n not in ("query_id", "batch_id", "input_rows", "late_rows"))]
    return rows.groupBy("query_id", "batch_id").agg(F.max(F.struct(*names)).alias("r")).select(
        "query_id", "batch_id", *(F.col("r")[n].alias(n) for n in names))


def late_rows(spark: SparkSession, path: str) -> int:
    """Rows that state operators dropped because they came after the watermark, in all micro-batches of all runs."""
    return progress(spark, path).agg(F.coalesce(F.sum("late_rows"), F.lit(0))).first()[0]
