"""Counters of running queries, kept by a listener on the driver."""

from __future__ import annotations

from pyspark.sql.streaming.listener import StreamingQueryListener


class ProgressCounters(StreamingQueryListener):
    """Rows read and late rows dropped, per query. Only numbers reach the driver."""

    def __init__(self):
        self.rows_read: dict[str, int] = {}
        self.late_dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        name = progress.name or str(progress.id)
        dropped = sum(s.numRowsDroppedByWatermark for s in progress.stateOperators)
        self.rows_read[name] = self.rows_read.get(name, 0) + progress.numInputRows
        self.late_dropped[name] = self.late_dropped.get(name, 0) + dropped

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
