"""An always-on run that stops when nothing comes any more."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Activity(StreamingQueryListener):
    """When a query last had rows, from its own progress events."""

    def __init__(self, query_id: str):
        self.query_id, self.last_rows, self.rows = query_id, time.monotonic(), 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if str(event.progress.id) == self.query_id and event.progress.numInputRows > 0:
            self.last_rows = time.monotonic()
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def run_until_idle(query: StreamingQuery, idle_seconds: float = 30.0, poll_seconds: float = 0.5) -> int:
    """Let a started query (processing-time trigger) run until ``idle_seconds`` have passed
    without a row, as the original pull loop did, then stop it between two micro-batches.
    Returns the rows it has read; a query that fails raises."""
    streams = SparkSession.active().streams
    seen = Activity(str(query.id))
    streams.addListener(seen)
    try:
        while not query.awaitTermination(poll_seconds):
            busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            if not busy and time.monotonic() - seen.last_rows >= idle_seconds:
                query.stop()
    finally:
        streams.removeListener(seen)
    return seen.rows
