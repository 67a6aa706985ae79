"""Run log of streams: one row per micro-batch, and one for a stream that failed."""

from __future__ import annotations

import threading
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

STREAM_LOG = ("run_id string, query string, batch_id long, status string, started_at timestamp, duration_ms long, "
              "rows_in long, rows_out long, rows_late long, watermark string, error string")
MADE = "rows_made"
FLUSH = 100          # rows held by the driver before they are written


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` of a stream with their number observed, to be logged as ``rows_out``."""
    return rows.observe(MADE, F.count(F.lit(1)).alias("n"))


class BatchLog(StreamingQueryListener):
    """Appends to a Parquet log what Spark reports of each micro-batch of the session's streams.

    ``rows_out`` is null for a stream without :func:`counted`. Reports of a trigger that found nothing
    are no batches and are left out. The rows come in the order of the reports; a batch that is run again
    after a failure has a row per attempt, told apart by ``run_id``. A failure bears the number of the
    batch after the last one reported.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._rows: list[tuple] = []
        self._last: dict[str, tuple[str, int]] = {}
        self._open: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event):
        with self._change:
            self._open.add(str(event.runId))
            self._last[str(event.runId)] = (event.name, -1)

    def onQueryProgress(self, event):
        p = event.progress
        name, last = self._last.get(str(p.runId), (p.name, -1))
        if p.batchId == last or "addBatch" not in p.durationMs:
            return
        made = p.observedMetrics.get(MADE)
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).replace(tzinfo=None)
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        self._add(str(p.runId), name, p.batchId, "success", at, p.durationMs.get("triggerExecution"), p.numInputRows,
                  made["n"] if made is not None else None, late, p.eventTime.get("watermark"), None)
        self._last[str(p.runId)] = (name, p.batchId)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        run = str(event.runId)
        name, last = self._last.pop(run, (None, -1))
        if event.exception:
            self._add(run, name, last + 1, "failed", None, None, None, None, None, None, event.exception)
        with self._change:
            self._open.discard(run)
            self._change.notify_all()

    def _add(self, *row) -> None:
        with self._change:
            self._rows.append(row)
            full = len(self._rows) >= FLUSH
        if full:
            self.flush()

    def flush(self) -> None:
        with self._change:
            rows, self._rows = self._rows, []
        if rows:
            (self.spark.createDataFrame(rows, STREAM_LOG).coalesce(1).write.mode("append").parquet(self.path))

    def settled(self, seconds: float) -> None:
        """Wait until the end of all streams that are no longer active has been reported."""
        active = {str(q.runId) for q in self.spark.streams.active}
        with self._change:
            self._change.wait_for(lambda: self._open <= active, seconds)


@contextmanager
def logged_streams(spark: SparkSession, path: str, seconds: float = 60):
    """Log all streams that run inside the block, failed ones included; written at its end at the latest."""
    log = BatchLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        log.settled(seconds)
        spark.streams.removeListener(log)
        log.flush()
