"""Counts reported by running queries: frames by outcome, and rows that came too late."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class CountListener(StreamingQueryListener):
    """Adds up the ``ingest`` and ``sink`` metrics of every micro-batch."""

    def __init__(self, names: tuple[str, ...] = ("ingest", "sink")) -> None:
        self.totals: dict[str, Counter[str]] = {name: Counter() for name in names}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, total in self.totals.items():
            metrics = event.progress.observedMetrics.get(name)
            if metrics is not None:
                total.update(metrics.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_as_late(query: StreamingQuery) -> int:
    """Rows the query's first stateful step has dropped behind the watermark.

    Only the recent progress reports the query keeps are counted.
    """
    return sum(
        progress["stateOperators"][-1]["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        if progress["stateOperators"]
    )
