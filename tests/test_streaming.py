"""availableNow drain, exactly-once restart, failure limit, metrics."""

import pytest

from eventlake.plans.ingest import prepare
from eventlake.session import scratch_path
from eventlake.sinks.jsonl import write_jsonl
from eventlake.sources.jsonl import read_jsonl
from eventlake.streaming import FailureLimitReached, ingest_stream, run_metrics, run_with_failure_limit


def _lines(spark, rows, path):
    write_jsonl(spark.createDataFrame([(r,) for r in rows], "value string"), path)


def test_restart_does_not_duplicate(spark):
    src, lake, ckpt = (scratch_path(spark, n) for n in ("src", "lake", "ckpt"))
    _lines(spark, ['{"did":"a","time_us":1}', '{"did":"b","time_us":2}', "[1]"], f"{src}/b=0")
    _, schema, _ = prepare(read_jsonl(spark, f"{src}/b=0"))
    for i in range(2):
        if i == 1:
            _lines(spark, ['{"did":"c","time_us":3}'], f"{src}/b=1")
        stream = read_jsonl(spark, f"{src}/b=*", streaming=True)
        (q,) = ingest_stream(stream, lake, ckpt, schema, ts="event", trigger={"availableNow": True})
        q.awaitTermination()
        m = run_metrics(q)
        assert m["batches"] >= 1
    got = sorted(r.did for r in spark.read.parquet(lake).collect())
    assert got == ["a", "b", "c"]


def test_metrics_count_quarantine(spark):
    src, lake, ckpt = (scratch_path(spark, n) for n in ("src", "lake", "ckpt"))
    _lines(spark, ['{"did":"a"}', '{"did":"b"} x', "[1]", "  "], src)
    _, schema, _ = prepare(read_jsonl(spark, src))
    (q,) = ingest_stream(read_jsonl(spark, src, streaming=True), lake, ckpt, schema,
                         trigger={"availableNow": True})
    q.awaitTermination()
    m = run_metrics(q)
    assert (m["consumed"], m["written"], m["errors"]) == (3, 1, 2)
    assert "lag_seconds" not in m  # no event has a time


def test_lag_gauge(spark):
    import time
    src = scratch_path(spark, "src")
    _lines(spark, [f'{{"time_us":{int((time.time() - 100) * 1e6)}}}', '{"time_us":5}'], src)
    _, schema, _ = prepare(read_jsonl(spark, src))
    (q,) = ingest_stream(read_jsonl(spark, src, streaming=True), scratch_path(spark, "lake"), scratch_path(spark, "ckpt"), schema,
                         trigger={"availableNow": True})
    q.awaitTermination()
    assert 90 < run_metrics(q)["lag_seconds"] < 200


class _Failing:
    """Fails in some of its runs, or there at one row; every run has the same checkpoint and
    input folder."""

    def __init__(self, spark, fails, lines=("x",)):
        self.spark, self.fails, self.calls, self.rows = spark, fails, 0, []
        self.src, self.ckpt = scratch_path(spark, "fail-src"), scratch_path(spark, "fail-ckpt")
        self.add(lines)

    def add(self, lines):
        self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(self.src)

    def start(self):
        fail = self.fails(self.calls)
        self.calls += 1

        def sink(df, epoch):
            rows = [r.value for r in df.collect()]
            if fail is True or fail in rows:
                raise RuntimeError("flush failed")
            self.rows += rows

        return [self.spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(self.src)
                .writeStream.foreachBatch(sink).option("checkpointLocation", self.ckpt).trigger(availableNow=True).start()]


def test_failure_limit_stops_after_five(spark):
    f = _Failing(spark, lambda call: True)
    with pytest.raises(FailureLimitReached):
        run_with_failure_limit(f.start, limit=5)
    assert f.calls == 5


def test_failure_limit_recovers_below_limit(spark):
    f = _Failing(spark, lambda call: call < 2)
    assert run_with_failure_limit(f.start, limit=5) == 2
    assert f.rows == ["x"]  # what the failed flushes read was kept


def test_failures_in_starting_count_and_a_commit_resets(spark):
    f = _Failing(spark, lambda call: "b" if call == 0 else None, ["a"])  # commits a, then fails at b
    f.add(["b"])
    calls = []

    def start():
        calls.append(1)
        if len(calls) in (1, 2, 4, 5):
            raise RuntimeError("no source yet")
        return f.start()

    assert run_with_failure_limit(start, limit=4) == 5
    assert f.rows == ["a", "b"]
    with pytest.raises(FailureLimitReached):
        run_with_failure_limit(lambda: 1 / 0, limit=3)


def test_metrics_listener(spark):
    import time
    from eventlake.streaming import MetricsListener
    ml = MetricsListener()
    spark.streams.addListener(ml.listener)
    try:
        src, lake, ckpt = (scratch_path(spark, n) for n in ("src", "lake", "ckpt"))
        _lines(spark, ['{"did":"a"}', "[1]"], src)
        _, schema, _ = prepare(read_jsonl(spark, src))
        (q,) = ingest_stream(read_jsonl(spark, src, streaming=True), lake, ckpt, schema,
                             trigger={"availableNow": True})
        q.awaitTermination()
        for _ in range(50):  # listener events arrive asynchronously
            if ml.totals["consumed"] >= 2:
                break
            time.sleep(0.2)
        assert ml.totals["consumed"] == 2 and ml.totals["written"] == 1 and ml.totals["errors"] == 1
    finally:
        spark.streams.removeListener(ml.listener)


def test_strip_blank(spark):
    from eventlake.sources.jsonl import strip_blank
    df = spark.createDataFrame([("  {} ",), (" \t ",), ("x",)], "value string")
    assert [bytes(r.value) for r in strip_blank(df).collect()] == [b"{}", b"x"]


def test_quarantine_query_exactly_once(spark):
    """The second (quarantine) query keeps its own checkpoint: reasons are kept and a
    restart over the same files adds nothing."""
    src, lake, ckpt, quar = (scratch_path(spark, n) for n in ("src", "lake", "ckpt", "quar"))
    _lines(spark, ['{"did":"a","time_us":1}', '{"did":"b"} x', "[1]", '{"time_us":"7"}'], f"{src}/b=0")
    _, schema, _ = prepare(read_jsonl(spark, f"{src}/b=0"))
    for i in range(2):
        if i == 1:
            _lines(spark, ["2"], f"{src}/b=1")
        qs = ingest_stream(read_jsonl(spark, f"{src}/b=*", streaming=True), lake, ckpt, schema,
                           trigger={"availableNow": True}, quarantine_path=quar)
        assert len(qs) == 2
        for q in qs:
            q.awaitTermination()
    bad = sorted((r.reason, bytes(r.raw)) for r in spark.read.parquet(quar).collect())
    assert bad == [("bad_json", b'{"did":"b"} x'), ("bad_time_us", b'{"time_us":"7"}'),
                   ("not_object", b"2"), ("not_object", b"[1]")]
    assert [r.did for r in spark.read.parquet(lake).collect()] == ["a"]


def test_strip_unicode_whitespace_either_side(spark):
    from eventlake.sources.jsonl import strip_blank
    lines = ['　{"a":1} ', '{"a":1}', ' {"a":1}', '{"a":1} ', " \t", '{"a":" x "}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [bytes(r.value).decode() for r in strip_blank(df).collect()]
    assert got == ['{"a":1}', '{"a":1}', '{"a":1}', '{"a":1}', '{"a":" x "}']


def test_clean_source_archives_committed_files(spark):
    import os
    src, lake, ckpt, arch = (scratch_path(spark, n) for n in ("src", "lake", "ckpt", "arch"))
    _lines(spark, ['{"did":"a","time_us":1}'], f"{src}/b=0")
    _, schema, _ = prepare(read_jsonl(spark, f"{src}/b=0"))
    stream = read_jsonl(spark, f"{src}/b=*", streaming=True, clean_source="archive", archive_dir=arch)
    (q,) = ingest_stream(stream, lake, ckpt, schema, trigger={"availableNow": True})
    q.awaitTermination()
    assert [r.did for r in spark.read.parquet(lake).collect()] == ["a"]
    # Spark archives a batch's files once the next batch starts; a second run commits it.
    _lines(spark, ['{"did":"b","time_us":2}'], f"{src}/b=1")
    stream = read_jsonl(spark, f"{src}/b=*", streaming=True, clean_source="archive", archive_dir=arch)
    (q,) = ingest_stream(stream, lake, ckpt, schema, trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.did for r in spark.read.parquet(lake).collect()) == ["a", "b"]
    archived = [f for _, _, fs in os.walk(arch.replace("file:", "")) for f in fs if f.startswith("part-")]
    assert archived, "committed source files are moved to the archive"


def test_lake_and_quarantine_hold_every_record(spark):
    """A record that fails only a further time path of the pinned schema is quarantined."""
    src, lake, ckpt, quar = (scratch_path(spark, n) for n in ("src", "lake", "ckpt", "quar"))
    lines = ['{"did":"a","":{"time_us":1}}', '{"did":"b","":{"time_us":"x"}}', '{"did":"c"}', "[1]"]
    _lines(spark, lines[:1] + lines[2:], f"{src}/b=0")
    _, schema, _ = prepare(read_jsonl(spark, f"{src}/b=0"))
    _lines(spark, lines[1:2], f"{src}/b=1")
    for q in ingest_stream(read_jsonl(spark, f"{src}/b=*", streaming=True), lake, ckpt, schema,
                           trigger={"availableNow": True}, quarantine_path=quar):
        q.awaitTermination()
    bad = sorted((r.reason, bytes(r.raw).decode()) for r in spark.read.parquet(quar).collect())
    assert bad == [("bad_time_us", lines[1]), ("not_object", "[1]")]
    assert spark.read.parquet(lake).count() + len(bad) == len(lines)


def test_metrics_of_more_batches_than_spark_keeps(spark, monkeypatch):
    from eventlake.streaming import ingest
    n = 104
    src, lake, ckpt = (scratch_path(spark, x) for x in ("src", "lake", "ckpt"))
    lines = [("[1]",) if i % 10 == 0 else (f'{{"did":"d{i}"}}',) for i in range(n)]
    spark.createDataFrame(spark.sparkContext.parallelize(lines, n), "value string").write.text(src)  # a file for each
    _, schema, _ = prepare(read_jsonl(spark, src))
    # as a run of over 2,000 batches would be
    monkeypatch.setattr(ingest, "PROGRESS_KEPT", 40, raising=False)
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    kept = spark.conf.get(setting, "100")
    spark.conf.set(setting, "40")
    try:
        (q,) = ingest_stream(read_jsonl(spark, src, streaming=True, max_files_per_trigger=1), lake, ckpt, schema,
                             trigger={"availableNow": True})
        q.awaitTermination()
        m = run_metrics(q)
        assert len(q.recentProgress) <= 40
    finally:
        spark.conf.set(setting, kept)
    assert (m["batches"], m["input_rows"], m["consumed"], m["written"], m["errors"]) == (n, n, n, n - 11, 11)
    assert m["missed"] == 0
    assert run_metrics(q) == m
