"""Progress of continuous runs (R5): a listener that keeps rows and durations of each micro-batch."""
from __future__ import annotations

import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run_id string, batch_id long, rows long, batch_ms long, sink_ms long"


class BatchProgress(StreamingQueryListener):
    """The newest ``keep`` batches of all streams of a session; use as a context manager around the streams."""

    def __init__(self, spark: SparkSession, keep: int = 10_000):
        self.spark, self._rows = spark, deque(maxlen=keep)
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def __enter__(self):
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error):
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        took = dict(p.durationMs)
        with self._change:
            self._rows.append((str(p.runId), int(p.batchId), int(p.numInputRows), int(took.get("triggerExecution", 0)),
                               int(took.get("addBatch", 0))))
            self._change.notify_all()

    def onQueryTerminated(self, event):
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def ended(self, query, timeout: float = 60.0) -> bool:
        """Wait for a query to end and for its last report to arrive; False after ``timeout`` seconds."""
        query.awaitTermination()
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, timeout)

    def batches(self, query=None) -> list[tuple]:
        """(run_id, batch_id, rows, batch_ms, sink_ms) in order, of one query or of all; batches without rows are left out."""
        with self._change:
            return [r for r in self._rows if r[2] > 0 and (query is None or r[0] == str(query.runId))]

    def frame(self, query=None) -> DataFrame:
        return self.spark.createDataFrame(self.batches(query), SCHEMA)

    def slower_than(self, seconds: float, query=None) -> list[tuple]:
        """The batches that took longer than a cadence."""
        return [r for r in self.batches(query) if r[3] > 1000 * seconds]
