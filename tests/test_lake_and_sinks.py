"""Lake layout, partition pruning, bounded files, schema evolution, Kafka frames."""

import json
import os

import pytest
from pyspark.sql import functions as F

from eventlake.operators import filters, reports
from eventlake.plans import fixtures as fx
from eventlake.plans.ingest import ingest_batch
from eventlake.session import scratch_path
from eventlake.sinks.kafka import PRODUCER, kafka_frame, kafka_sink_options
from eventlake.sources.kafka import kafka_source_options
from eventlake.sources.lake import open_lake
from tests.conftest import SF_SMALL


def _raw(spark, rows):
    return spark.createDataFrame([(r.encode(),) for r in rows], "value binary")


def test_partitions_are_padded_strings_and_pruned(spark):
    path = scratch_path(spark, "t-lake")
    raw = _raw(spark, ['{"did":"a","time_us":1704067207179575}',    # 2024-01-01 00h
                       '{"did":"b","time_us":1717200000000000}'])   # 2024-06-01 00h
    ingest_batch(raw, path, ts="event")
    lake = open_lake(spark, path)
    types = dict(lake.dtypes)
    assert types["month"] == "string" and types["hour"] == "string"
    sl = filters.lake_slice(lake, year=2024, month=6, day=1, hour=0)
    assert [r.did for r in sl.select("did").collect()] == ["b"]
    plan = sl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "isnotnull(month" in plan
    # only the matching folder is read
    files = {r.f for r in sl.select(F.col("_metadata.file_path").alias("f")).collect()}
    assert all("month=06" in f for f in files)
    assert os.path.isdir(path.replace("file:", "") + "/year=2024/month=01/day=01/hour=00")


def test_slice_lists_only_its_folder(spark):
    from eventlake.sources.lake import open_lake_slice, slice_prefix
    path = scratch_path(spark, "t-slice")
    raw = _raw(spark, ['{"did":"a","time_us":1704067207179575}',    # 2024-01-01 00h
                       '{"did":"b","time_us":1717200000000000}',    # 2024-06-01 00h
                       '{"did":"c","time_us":1717203600000000}'])   # 2024-06-01 01h
    ingest_batch(raw, path, ts="event")
    assert slice_prefix(path, year=2024, month=6, hour=1) == path + "/year=2024/month=06"
    sl = open_lake_slice(spark, path, year=2024, month=6, day=1, hour=1)
    assert all("/year=2024/month=06/day=01/hour=01/" in f for f in sl.inputFiles())
    assert sl.columns == open_lake(spark, path).columns
    assert [r.did for r in sl.collect()] == ["c"]
    # a partial prefix (no day) still filters exactly on the later values
    assert sorted(r.did for r in open_lake_slice(spark, path, year=2024, month=6, hour=0).collect()) == ["b"]
    empty = open_lake_slice(spark, path, year=2023, month=1)
    assert empty.count() == 0 and empty.schema == open_lake(spark, path).schema


def test_column_pruning_reaches_scan(spark):
    path = scratch_path(spark, "t-prune")
    ingest_batch(fx.env(fx.load(spark, SF_SMALL, "events")).select(F.col("value").cast("binary").alias("value")),
                 path, ts="event")
    q = open_lake(spark, path).select("did").filter(F.col("hour") == "14")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<did:string>" in plan


def test_bounded_files(spark):
    path = scratch_path(spark, "t-bounded")
    raw = fx.env(fx.load(spark, SF_SMALL, "events")).select(F.col("value").cast("binary").alias("value"))
    ingest_batch(raw, path, ts="ingest", max_rows=100)
    inv = reports.lake_inventory(open_lake(spark, path))
    got = inv.agg(F.max("rows").alias("m"), F.sum("rows").alias("s"), F.count("*").alias("files")).first()
    assert got.m <= 100 and got.s == 1000 and got.files >= 10


def test_empty_batch_is_noop(spark):
    path = scratch_path(spark, "t-empty")
    raw = _raw(spark, ['[1]'])  # quarantined: nothing good to write
    res = ingest_batch(raw, path)
    assert res.written == 0 and res.quarantined == 1


def test_quarantine_written(spark):
    path, qpath = scratch_path(spark, "t-lake"), scratch_path(spark, "t-quar")
    raw = _raw(spark, ['{"a":1}', '{"a":1} xyz', '[2]'])
    res = ingest_batch(raw, path, quarantine_path=qpath)
    assert res.counts == {"ok": 1, "bad_json": 1, "not_object": 1}
    q = spark.read.parquet(qpath)
    assert sorted(r.reason for r in q.collect()) == ["bad_json", "not_object"]
    assert sorted(bytes(r.raw) for r in q.collect()) == [b"[2]", b'{"a":1} xyz']


def test_schema_evolution_across_batches(spark):
    path = scratch_path(spark, "t-evolve")
    ingest_batch(_raw(spark, ['{"a":1,"t":2.5}']), path)
    ingest_batch(_raw(spark, ['{"b":"x","a":3,"t":4}']), path)   # new column; t BIGINT into DOUBLE
    rows = open_lake(spark, path).select("a", "b", "t").collect()
    assert sorted((r.a, r.b, r.t) for r in rows) == [(1, None, 2.5), (3, "x", 4.0)]


def test_kafka_frame_and_options(spark):
    df = spark.createDataFrame([("{\"a\":1}",)], "value string")
    row = kafka_frame(df).first()
    assert row.key is None and bytes(row.value) == b'{"a":1}'
    o = kafka_sink_options("b:9092")
    assert o["kafka.acks"] == "all" and o["kafka.compression.type"] == "snappy"
    assert o["kafka.linger.ms"] == "100" and o["topic"] == "social-events"
    assert PRODUCER["kafka.retries"] == "3"
    s = kafka_source_options("b:9092", min_rows=10000, max_delay="60s")
    assert s["startingOffsets"] == "earliest" and s["minOffsetsPerTrigger"] == "10000"
    assert s["maxTriggerDelay"] == "60s" and "maxOffsetsPerTrigger" not in s


def test_declared_model_keeps_raw_event(spark):
    from eventlake.operators.derive import project_event
    from eventlake.operators.guards import classify
    raw = fx.envc(fx.load(spark, SF_SMALL, "conversations")).select(F.col("value").cast("binary").alias("value"))
    ev = project_event(classify(raw).filter("reason is null"), collected_ms=0)
    assert ev.columns == ["collection_timestamp", "event_timestamp", "did", "event_type", "collection",
                          "action", "cid", "record_text", "reply_parent", "reply_root", "embed_type",
                          "raw_event"]
    r = ev.filter("reply_parent is not null").first()
    doc = json.loads(bytes(r.raw_event))
    assert doc["commit"]["record"]["text"] == r.record_text
    assert doc["commit"]["record"]["reply"]["parent"] == r.reply_parent


def test_top_accounts_ties_are_deterministic(spark):
    df = spark.createDataFrame([("b", "commit"), ("a", "commit"), ("c", "x"), ("c", "x")],
                               "did string, event_type string")
    got = [(r.did, r["count"]) for r in reports.top_accounts(df, 2).collect()]
    assert got == [("c", 2), ("a", 1)]


def test_histogram_cumulative(spark):
    df = spark.createDataFrame([(0.001,), (0.3,), (7.0,), (50.0,)], "d double")
    h = {r.le: r["count"] for r in reports.histogram(df, "d").collect()}
    assert h["0.005"] == 1 and h["0.5"] == 2 and h["10.0"] == 3 and h["+Inf"] == 4


def test_keep_raw_event(spark):
    path = scratch_path(spark, "t-raw")
    ingest_batch(_raw(spark, ['{"a":1,"value":"v"}']), path, keep_raw=True)
    r = open_lake(spark, path).first()
    assert bytes(r.raw_event) == b'{"a":1,"value":"v"}' and r.value == "v"


def test_kafka_min_partitions():
    assert kafka_source_options("b:9092", min_partitions=96)["minPartitions"] == "96"


def test_event_key_named_like_partition_is_kept(spark):
    path = scratch_path(spark, "t-clash")
    ingest_batch(_raw(spark, ['{"hour":"x","time_us":5}']), path, ts="event")
    r = open_lake(spark, path).first()
    assert r.hour_ == "x" and r.hour == "00" and r.year == "1970"


def test_keys_differing_by_case_are_written_whole(spark):
    from eventlake.session import conf_scope
    with conf_scope(spark, **{"spark.sql.caseSensitive": "false"}):
        path = scratch_path(spark, "t-case")
        ingest_batch(_raw(spark, ['{"aB":1,"ab":2,"m":[{"K":1,"k":2}]}']), path)
        r = open_lake(spark, path).first()
        assert (r.aB, r.ab_) == (1, 2) and (r.m[0].K, r.m[0].k) == (1, 2)


def test_quarantine_with_pinned_schema(spark):
    from pyspark.sql.types import LongType, StructField, StructType
    path, qpath = scratch_path(spark, "t-lake"), scratch_path(spark, "t-quar")
    raw = _raw(spark, ['{"a":1}', '{"a":1} xyz', '"s"'])
    res = ingest_batch(raw, path, schema=StructType([StructField("a", LongType())]), quarantine_path=qpath)
    assert res.counts == {"ok": 1, "bad_json": 1, "not_object": 1}
    assert spark.read.parquet(qpath).count() == 2 and open_lake(spark, path).count() == 1


def test_event_time_write_splits_a_hot_hour(spark):
    """One hour holding nearly all rows is written by several tasks (AQE splits the
    rebalance partition), not funnelled through one; every row is kept."""
    from eventlake.session import conf_scope
    import hashlib
    pad = lambda i: "".join(hashlib.sha256(f"{i}-{k}".encode()).hexdigest() for k in range(4))
    hot = [f'{{"did":"h{i}","time_us":{1704067200000000 + i},"pad":"{pad(i)}"}}' for i in range(3000)]
    cold = [f'{{"did":"c{i}","time_us":{1704070800000000 + i}}}' for i in range(30)]
    raw = _raw(spark, hot + cold).repartition(8)
    path = scratch_path(spark, "t-hot")
    with conf_scope(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": "65536"}):
        ingest_batch(raw, path, ts="event")
    root = path.replace("file:", "")
    hot_files = [f for f in os.listdir(root + "/year=2024/month=01/day=01/hour=00") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    lake = open_lake(spark, path)
    assert lake.count() == 3030
    assert lake.filter(F.col("hour") == "00").count() == 3000


def test_register_lake_slice_view(spark):
    from eventlake.sources.lake import register_lake
    path = scratch_path(spark, "t-view")
    raw = _raw(spark, ['{"did":"a","time_us":1704067207179575}', '{"did":"b","time_us":1717200000000000}'])
    ingest_batch(raw, path, ts="event")
    register_lake(spark, path, "t_view_june", year=2024, month=6)
    rows = spark.sql("SELECT did, month FROM t_view_june").collect()
    assert [(r.did, r.month) for r in rows] == [("b", "06")]
    assert all("/month=06/" in f for f in spark.table("t_view_june").inputFiles())


def test_slice_of_missing_folder_without_sidecar(spark):
    from eventlake.sources.lake import SCHEMA_FILE, open_lake_slice
    path = scratch_path(spark, "t-nosidecar")
    raw = _raw(spark, ['{"did":"a","time_us":1704067207179575}'])
    ingest_batch(raw, path, ts="event")
    os.remove(path.replace("file:", "") + "/" + SCHEMA_FILE)
    assert open_lake_slice(spark, path, year=2023).count() == 0
    assert [r.did for r in open_lake_slice(spark, path, year=2024).collect()] == ["a"]


def test_small_batch_over_many_hours_keeps_parallel_writers(spark):
    """A small batch (~500 KB) over many hours: one file per hour, written by several tasks."""
    import hashlib
    rows = [f'{{"did":"d{h}-{i}","time_us":{1704067200000000 + h * 3600000000 + i},'
            f'"pad":"{hashlib.sha256(f"{h}-{i}".encode()).hexdigest() * 2}"}}'
            for h in range(48) for i in range(60)]  # ~500 KB: small, but above the write floor
    path = scratch_path(spark, "t-many-hours")
    ingest_batch(_raw(spark, rows).repartition(4), path, ts="event")
    root = path.replace("file:", "")
    files = [(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")]
    assert len(files) == 48 and len({d for d, _ in files}) == 48  # one file per hour
    assert len({f.split("-")[1] for _, f in files}) > 1  # part numbers: more than one writer task


def test_repair_schema_after_a_writer_died_before_the_schema_update(spark):
    from eventlake.sinks.lake import repair_schema_sidecar, write_schema_sidecar
    from eventlake.sources.lake import read_schema_sidecar
    path = scratch_path(spark, "t-repair")
    ingest_batch(_raw(spark, ['{"did":"a","time_us":1}']), path, ts="event")
    before = read_schema_sidecar(spark, path)
    ingest_batch(_raw(spark, ['{"did":"b","time_us":2,"extra":5}']), path, ts="event")
    write_schema_sidecar(before, path)  # as if the second writer died after its data commit
    assert "extra" not in open_lake(spark, path).columns
    st = repair_schema_sidecar(spark, path)
    assert "extra" in st.names and "year" not in st.names
    lake = open_lake(spark, path)
    assert sorted((r.did, r.extra) for r in lake.select("did", "extra").collect()) == [("a", None), ("b", 5)]


def test_streaming_kafka_write_needs_a_checkpoint(spark):
    import pytest
    from eventlake.sinks.kafka import write_kafka
    stream = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS value")
    with pytest.raises(ValueError, match="checkpoint"):
        write_kafka(stream, "broker:9092", streaming=True)


def test_lines_that_are_not_json_are_dropped_with_a_warning(spark, tmp_path, caplog):
    from pyspark.sql import Observation
    from eventlake.sources.jsonl import read_jsonl, warn_dropped
    path = str(tmp_path / "a.jsonl")
    with open(path, "wb") as f:
        f.write(b'{"a":1}\n\n  [1]  \n{"a":1} x\n{bad\n{"a":"\xff"}\nnull\n')
    dropped = Observation()
    got = read_jsonl(spark, path, drop_invalid=True, dropped=dropped)
    assert sorted(bytes(r.value) for r in got.collect()) == [b"[1]", b"null", b'{"a":1}']
    assert warn_dropped(dropped, path) == 3 and "3 lines" in caplog.text
    assert read_jsonl(spark, path).count() == 6
