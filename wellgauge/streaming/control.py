"""When a streaming query runs, and how its caller waits for it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql.streaming import StreamingQuery

# Take what is there, in as many batches as the source options ask for, and stop.
AVAILABLE_NOW: Mapping[str, bool] = {"availableNow": True}

# How long each query is looked at before the next, in seconds.
_LOOK = 0.5


def every(interval: str) -> Mapping[str, str]:
    """A new batch at a fixed interval, such as ``"5 seconds"``."""
    return {"processingTime": interval}


def await_all(*queries: StreamingQuery, meanwhile: Callable[[], None] | None = None) -> None:
    """Wait until all queries have ended. The error of a failed one is raised
    within seconds, whichever it is, and stops the others, so nothing that comes
    after runs on half a result. ``meanwhile`` is called again and again."""
    running = list(queries)
    try:
        while running:
            running = [query for query in running if not query.awaitTermination(_LOOK)]
            if meanwhile is not None:
                meanwhile()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def start_all(*starts: Callable[[], StreamingQuery]) -> list[StreamingQuery]:
    """Start several queries, or none: when one does not start, those before it are
    stopped and its error is raised."""
    started: list[StreamingQuery] = []
    try:
        for start in starts:
            started.append(start())
    except BaseException:
        for query in started:
            query.stop()
        raise
    return started


def run_for(query: StreamingQuery, seconds: int) -> bool:
    """Let a query run for a limited time. True if it ended by itself; the error
    of a failed query is raised."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return bool(ended)
