"""Sources: JSON-lines files (S1), Kafka (S2), the partitioned lake (S3)."""

from eventlake.sources.jsonl import read_jsonl, strip_blank
from eventlake.sources.kafka import kafka_source_options, read_kafka
from eventlake.sources.lake import open_lake, open_lake_slice, read_schema_sidecar

__all__ = ["read_jsonl", "strip_blank", "read_kafka", "kafka_source_options", "open_lake", "open_lake_slice",
           "read_schema_sidecar"]
