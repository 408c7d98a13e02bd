"""Restart of failed streaming jobs from their checkpoint.

A job that fails is started again and goes on at the offsets of its checkpoint;
its batches are repeated, not doubled, as sinks are keyed by the batch. Failures
without a completed batch in between are tolerated TOLERATED times.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQuery

#: failures in a row that are tolerated, and the least seconds between two starts
TOLERATED = 3
PAUSE_S = 10.0


def run_supervised(start: Callable[[], StreamingQuery], tolerated: int = TOLERATED, pause_s: float = PAUSE_S) -> int:
    """Run a job until it ends by itself or is stopped; the number of restarts that it took.

    ``start`` starts the job on its checkpoint. The last failure is raised when
    more than ``tolerated`` follow each other without a completed batch."""
    restarts = failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except Exception:  # noqa: BLE001  whatever ended the query
            # the report of a completed batch; a batch that fails has none
            failures = 1 if query.recentProgress else failures + 1
            if failures > tolerated:
                raise
        restarts += 1
        time.sleep(pause_s)
