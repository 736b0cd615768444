"""Progress of streaming jobs: rows per batch, observed metrics, state size.

``ProgressRecorder`` is a ``StreamingQueryListener`` that keeps the last
``keep`` progress reports (bounded driver memory).  ``summary()`` gives one
record per batch with the input rows, the observed metrics (e.g. the
warehouse batch row count) and, per stateful operator, the rows and bytes in
the state store: the number to watch for hot cards in the per-card state.
"""

from __future__ import annotations

import collections
import json
import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class ProgressRecorder(StreamingQueryListener):
    def __init__(self, keep: int = 1000):
        super().__init__()
        self._events: collections.deque = collections.deque(maxlen=keep)
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        with self._lock:
            self._events.append(json.loads(event.progress.json))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def summary(self) -> list[dict]:
        with self._lock:
            events = list(self._events)
        latest: dict = {}
        for p in events:            # a batch may be reported more than once
            latest[(p.get("id"), p.get("batchId"))] = p
        out = []
        for p in latest.values():
            out.append({
                "name": p.get("name"), "id": p.get("id"), "batch": p.get("batchId"),
                "input_rows": p.get("numInputRows"),
                "observed": {k: v for k, v in (p.get("observedMetrics") or {}).items()},
                "state_rows": sum(op.get("numRowsTotal", 0) for op in p.get("stateOperators", [])),
                "state_bytes": sum(op.get("memoryUsedBytes", 0) for op in p.get("stateOperators", [])),
            })
        return out


def record_progress(spark: SparkSession, keep: int = 1000) -> ProgressRecorder:
    """Attach a recorder to the session's stream manager and return it."""
    rec = ProgressRecorder(keep)
    spark.streams.addListener(rec)
    return rec
