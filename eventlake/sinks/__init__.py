"""Sinks: partitioned Parquet lake (K1/K2), Kafka (K3), JSON lines (K4)."""

from eventlake.sinks.lake import append_evolving, repair_schema_sidecar, write_lake, write_schema_sidecar
from eventlake.sinks.kafka import kafka_frame, kafka_sink_options, write_kafka
from eventlake.sinks.jsonl import write_jsonl

__all__ = ["append_evolving", "repair_schema_sidecar", "write_lake", "write_schema_sidecar", "kafka_frame", "kafka_sink_options",
           "write_kafka", "write_jsonl"]
