"""Observed metrics of every micro-batch, appended to a table by a streaming query listener."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = "query string, batch long, at string, metrics string"


class ProgressTable(StreamingQueryListener):
    """Appends one row per reported micro-batch with metrics called ``name``; nothing is kept in memory.

    Add it with ``spark.streams.addListener`` before the query starts. A batch that is retried is
    reported again; :func:`progress_rows` takes the last report.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "progress"):
        self._spark, self._path, self._name = spark, path, name
        self._ended: set[str] = set()
        self._change = threading.Condition()
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get(self._name)
        if metrics is None:
            return
        row = str(progress.id), progress.batchId, progress.timestamp, json.dumps(metrics.asDict())
        try:
            self._spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self._path)
        except Exception as error:  # noqa: BLE001 - raised where the query is awaited
            self.failure = self.failure or error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def await_reports(self, query: StreamingQuery, seconds: float = 600.0) -> None:
        """Wait until the query has ended and all its reports are stored."""
        query.awaitTermination()
        run = str(query.runId)
        with self._change:
            if not self._change.wait_for(lambda: run in self._ended, seconds):
                raise TimeoutError(f"no end of run {run} reported")
        if self.failure is not None:
            raise self.failure


def progress_rows(spark: SparkSession, path: str, metrics: str) -> DataFrame:
    """``(query, batch, *metrics)`` of every micro-batch, by the schema of the metrics.

    A query without a reported batch leaves no table, which reads as no rows.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], f"query string, batch long, {metrics}")
    stored = spark.read.schema(PROGRESS).parquet(path)
    last = F.row_number().over(Window.partitionBy("query", "batch").orderBy(F.desc("at")))
    stored = stored.withColumn("_last", last).filter("_last = 1")
    return stored.select("query", "batch", F.from_json("metrics", metrics).alias("m")).select("query", "batch", "m.*")
