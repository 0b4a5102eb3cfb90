"""T4: stop after N *consecutive* failed flushes; a committed batch resets the count.

A failed micro-batch fails the streaming query; the buffer is not lost because
the offsets were not committed, so restarting from the checkpoint retries the
same data. This wrapper restarts the query until it either finishes (e.g. an
``availableNow`` drain) or fails ``limit`` times in a row without committing a
batch in between.
"""

from __future__ import annotations

import logging
from typing import Callable

from pyspark.sql.streaming import StreamingQuery

from eventlake.sources.lake import LakeConflict

log = logging.getLogger(__name__)

MAX_FLUSH_FAILURES = 5  # fixed value: the reference's consecutive-failure limit


class FailureLimitReached(RuntimeError):
    pass


def run_with_failure_limit(start: Callable[[], StreamingQuery | list[StreamingQuery]],
                           limit: int = MAX_FLUSH_FAILURES, timeout: float | None = None) -> int:
    """Run what ``start()`` starts (one query, or the list of ``ingest_stream``) until it
    terminates cleanly; returns the number of restarts.

    ``start`` should use the same checkpoint each time: what a failed flush read is then
    read again. An error of ``start`` itself counts as a failed flush, too; a refused lake
    (``LakeConflict``) is raised at once. Raises ``FailureLimitReached`` after ``limit``
    consecutive failures.
    """
    failures = restarts = 0
    while True:
        queries: list[StreamingQuery] = []
        try:
            started = start()
            queries = started if isinstance(started, list) else [started]
            for q in queries:
                q.awaitTermination(timeout)
            for q in queries:
                if q.isActive:
                    q.stop()
            return restarts
        except LakeConflict:
            raise
        except Exception as e:  # one failed flush
            for q in queries:  # the others go on from their checkpoint, too
                if q.isActive:
                    q.stop()
            committed = any(_committed_a_batch(q) for q in queries)
            failures = 1 if committed else failures + 1
            log.error("flush failed (%d consecutive): %s", failures, e)
            if failures >= limit:
                raise FailureLimitReached(f"flush failed {limit} consecutive times; stopping") from e
            restarts += 1


def _committed_a_batch(q: StreamingQuery) -> bool:
    """True when this run committed a batch that took in data.

    A progress entry is added only after its batch commits, but a
    ``processingTime`` trigger also reports idle progress (no input rows);
    those do not count as a successful flush.
    """
    for p in q.recentProgress:
        rows = p.numInputRows if hasattr(p, "numInputRows") else dict(p).get("numInputRows")
        if rows:
            return True
    return False
