"""Per-batch metrics of a running query."""

from __future__ import annotations

import datetime as dt
import logging
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from rowtide.sinks import metrics as m

log = logging.getLogger(__name__)


def _instant(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text.replace("Z", "+00:00"))


class BatchMetricsListener(StreamingQueryListener):
    """Writes the metrics of every finished batch, and one for a query that ended in an error."""

    def __init__(self, spark: SparkSession, path: str, app: str, cluster: str = "", every_seconds: int | None = None):
        self.spark, self.path, self.app = spark, path, app
        self.dimensions = {"ApplicationName": app, "JobFlowId": cluster}
        self.every_seconds = every_seconds
        self.ended = threading.Event()
        self._run = None
        self._last_start: dt.datetime | None = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.app:
            self._run = event.runId

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.app or p.numInputRows == 0:
            return
        start = _instant(p.timestamp)
        rows = self.rows(p.batchId, start, p.numInputRows, p.durationMs.get("triggerExecution", 0))
        self._append(rows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId != self._run:
            return
        if event.exception:
            self._append([m.metric_row(m.RECEIVER_ERROR, 1, m.COUNT, None, self.dimensions)])
        self.ended.set()

    def rows(self, batch_id: int, start: dt.datetime, n_rows: int, processing_ms: int) -> list[tuple]:
        """Spark reports no scheduling delay; it is taken as start minus the tick that was due."""
        delay = 0.0
        if self.every_seconds and self._last_start:
            due = self._last_start + dt.timedelta(seconds=self.every_seconds)
            delay = max(0.0, (start - due).total_seconds() * 1000)
        self._last_start = start

        def row(name, value, unit):
            return m.metric_row(name, value, unit, batch_id, self.dimensions)

        return [
            row(m.BATCH_COMPLETED, 1, m.COUNT),
            row(m.SCHEDULING_DELAY, delay, m.MILLISECONDS),
            row(m.PROCESSING_DELAY, processing_ms, m.MILLISECONDS),
            row(m.NUM_RECORDS, n_rows, m.COUNT),
            row(m.TOTAL_DELAY, delay + processing_ms, m.MILLISECONDS),
        ]

    def _append(self, rows: list[tuple]) -> None:
        try:
            m.append_metrics(self.spark, rows, self.path, f"{self.app}-listener")
        except Exception:  # a listener must not stop the stream
            log.exception("metrics of %s not written", self.app)
