"""Kafka stream source (value bytes only; the producer sends no key).

The Spark Kafka connector jar is not bundled here; ``read_kafka`` builds the
reader and needs ``spark-sql-kafka`` on the classpath at run time. Offsets
live in the streaming checkpoint, which replaces the consumer group's commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TOPIC = "social-events"  # an argument; set it to the deployment's topic
# Fixed value: the consumer's max poll interval.
MAX_POLL_INTERVAL_MS = 300000


def kafka_source_options(servers: str, topic: str = DEFAULT_TOPIC, starting: str = "earliest",
                         min_rows: int | None = None, max_delay: str | None = None,
                         fail_on_data_loss: bool = True, min_partitions: int | None = None,
                         group: str | None = None, **extra) -> dict:
    """Options for ``format('kafka')``.

    ``min_rows`` / ``max_delay`` give the count-or-time trigger (T1) with
    ``minOffsetsPerTrigger`` + ``maxTriggerDelay``. ``maxOffsetsPerTrigger`` is
    deliberately not set from ``min_rows``: that would throttle throughput.
    ``min_partitions`` splits large topic partitions over more Spark tasks, so
    parallelism is not capped at the topic's partition count (12 by default).
    No consumer group is set unless asked for: Spark gives every query its own, and queries
    that share one may each see a part of the data only. Offsets are in the checkpoint.
    """
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
        "kafka.max.poll.interval.ms": str(MAX_POLL_INTERVAL_MS),
    }
    if group:
        opts["kafka.group.id"] = group
    if min_rows:
        opts["minOffsetsPerTrigger"] = str(int(min_rows))
    if max_delay:
        opts["maxTriggerDelay"] = max_delay
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    for k, v in extra.items():
        opts[k] = str(v)
    return opts


def read_kafka(spark: SparkSession, servers: str, topic: str = DEFAULT_TOPIC,
               starting: str = "earliest", streaming: bool = True, **opts) -> DataFrame:
    """Kafka records as ``value BINARY`` (plus partition/offset for lineage)."""
    o = kafka_source_options(servers, topic, starting, **opts)
    if not streaming:
        o.pop("minOffsetsPerTrigger", None)
        o.pop("maxTriggerDelay", None)
    reader = (spark.readStream if streaming else spark.read).format("kafka").options(**o)
    return reader.load().select(F.col("value"), "partition", "offset", "timestamp")
