"""Structured Streaming ingest: triggers, exactly-once file sink, shared lakes, drain, failure limit, metrics."""

from eventlake.streaming.ingest import MetricsListener, ingest_stream, drain, run_metrics, observe_batch
from eventlake.streaming.shared import SharedIngest
from eventlake.streaming.failures import run_with_failure_limit, FailureLimitReached, MAX_FLUSH_FAILURES

__all__ = ["MetricsListener", "SharedIngest", "ingest_stream", "drain", "run_metrics", "observe_batch", "run_with_failure_limit",
           "FailureLimitReached", "MAX_FLUSH_FAILURES"]
