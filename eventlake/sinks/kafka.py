"""K3: Kafka sink — raw value bytes, no key; producer settings of the reference.

Needs the Spark Kafka connector on the classpath to run; ``kafka_frame`` (the
rows that would be sent) and the options are usable without it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.sources.kafka import DEFAULT_TOPIC

# Producer settings of the reference.
PRODUCER = {
    "kafka.acks": "all",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "100",
    "kafka.retries": "3",
}


def kafka_frame(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows as the Kafka sink expects them: NULL key, value as bytes (str -> UTF-8)."""
    dt = dict(df.dtypes)[value]
    v = F.col(value) if dt == "binary" else F.encode(F.col(value).cast("string"), "UTF-8")
    return df.select(F.lit(None).cast("binary").alias("key"), v.alias("value"))


def kafka_sink_options(servers: str, topic: str = DEFAULT_TOPIC, **extra) -> dict:
    o = {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER}
    o.update({k: str(v) for k, v in extra.items()})
    return o


def write_kafka(df: DataFrame, servers: str, topic: str = DEFAULT_TOPIC, streaming: bool = False,
                checkpoint: str | None = None, **extra):
    if streaming and not checkpoint:
        # Offsets and sink progress live in the checkpoint; without one a restart
        # would re-send everything (the reference commits only after delivery).
        raise ValueError("a streaming Kafka write needs checkpoint= (a shared folder)")
    frame = kafka_frame(df)
    opts = kafka_sink_options(servers, topic, **extra)
    if streaming:
        w = frame.writeStream.format("kafka").options(**opts).option("checkpointLocation", checkpoint)
        return w.start()
    frame.write.format("kafka").options(**opts).save()
    return None
