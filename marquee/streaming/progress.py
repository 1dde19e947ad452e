"""Durable totals of a stream: what arrived, was malformed, repeated and kept, per micro-batch.

The counts are observed inside the query, once before its state and once behind it, and come
with the query's progress.  A listener writes one record per micro-batch under its number, so
a batch that is run again replaces its own record and totals hold over restarts.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

ARRIVED, KEPT = "arrived", "kept"
RECORD = "rows long, malformed long, repeated long, kept long"


def observe_arrived(stream: DataFrame, key: str) -> DataFrame:
    """Counted before any state: all rows, and those without a ``key``."""
    return stream.observe(ARRIVED, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(key).isNull()).alias("malformed"))


def observe_kept(stream: DataFrame) -> DataFrame:
    """Counted behind the state: rows that go on to the sink."""
    return stream.observe(KEPT, F.count(F.lit(1)).alias("rows"))


class ProgressLedger(StreamingQueryListener):
    """Writes the counts of every micro-batch of the queries named ``name`` to
    ``<path>/batch_id=<n>`` (a folder on the shared file system)."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.written: set[tuple[str, int]] = set()
        self.lock = threading.Lock()  # the listener's thread and settle() write one at a time

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self._record(str(event.progress.runId), event.progress.batchId, event.progress.observedMetrics)

    def settle(self, query) -> None:
        """Record what the listener was not told yet; call it when the query has ended."""
        for p in query.recentProgress:
            self._record(str(p.runId), p.batchId, p.observedMetrics)

    def _record(self, run: str, batch_id: int, metrics: dict) -> None:
        with self.lock:
            if ARRIVED not in metrics or (run, batch_id) in self.written:
                return  # a trigger without data has no metrics
            arrived, kept = metrics[ARRIVED], metrics.get(KEPT, metrics[ARRIVED])
            row = (arrived["rows"], arrived["malformed"], arrived["rows"] - kept["rows"], kept["rows"])
            self.spark.createDataFrame([row], RECORD).coalesce(1).write.mode("overwrite").json(f"{self.path}/batch_id={batch_id}")
            self.written.add((run, batch_id))


def batch_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: ``batch_id`` and its counts."""
    return spark.read.schema(RECORD + ", batch_id long").json(path)


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The counts over all micro-batches, restarts included."""
    return batch_records(spark, path).agg(
        F.count(F.lit(1)).alias("batches"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "malformed", "repeated", "kept")])
