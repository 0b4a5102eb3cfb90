"""eventlake — a Spark-native ingest engine for raw social-network events.

Raw JSON event bytes (JSON-lines files or Kafka) are validated, bad records are
quarantined with a reason, good records are flattened under a stable inferred
schema, and appended to a Parquet lake partitioned by year/month/day/hour.
Everything is expressed with DataFrame / SQL built-ins so Catalyst plans it.
"""

from eventlake.session import get_spark, scratch_path, configure_session

__all__ = ["get_spark", "scratch_path", "configure_session"]
