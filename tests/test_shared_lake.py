"""Streams and batches on one lake: commits, crashes, flushes by count or time, drain."""

import json
import os
import time
from collections import Counter

import pytest

from eventlake.plans.ingest import ingest_batch
from eventlake.sinks import commits
from eventlake.sinks.commits import committed, run_totals
from eventlake.sources.jsonl import read_jsonl
from eventlake.sources.lake import PENDING, STAGING, open_lake, open_lake_slice, open_quarantine
from eventlake.streaming import shared
from eventlake.streaming.shared import SharedIngest


def put(folder, name, *events):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.write("".join((e if isinstance(e, str) else json.dumps(e)) + "\n" for e in events))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def events(*ids):
    return [{"did": f"d{i}", "time_us": 1_700_000_000_000_000 + i} for i in ids]


@pytest.fixture()
def paths(tmp_path):
    return {k: str(tmp_path / k) for k in ("src", "lake", "ckpt", "bad")}


def run(spark, paths, **kw):
    """One run over what has arrived."""
    ingest = SharedIngest(spark, paths["lake"], paths["ckpt"], ts="event", **kw)
    ingest.start(read_jsonl(spark, paths["src"], streaming=True), {"availableNow": True}).awaitTermination()
    ingest.drain()
    return ingest


def dids(spark, paths):
    return Counter(r.did for r in open_lake(spark, paths["lake"]).collect())


def leftovers(folder):
    return [n for part in (PENDING, STAGING) for n in (os.listdir(f"{folder}/{part}") if os.path.isdir(f"{folder}/{part}") else []) if not n.startswith(".")]


def test_batches_and_two_streams_share_a_lake(spark, paths, tmp_path):
    def batch(*ids):
        raw = spark.createDataFrame([(json.dumps(e).encode(),) for e in events(*ids)], "value binary")
        ingest_batch(raw, paths["lake"], ts="event")

    batch(1, 2)
    put(paths["src"], "a", *events(3, 4))
    run(spark, paths)
    batch(5)
    other = {**paths, "src": str(tmp_path / "src2"), "ckpt": str(tmp_path / "ckpt2")}
    put(other["src"], "a", *events(6))
    run(spark, other, writer="other")
    put(paths["src"], "b", *events(7), {"did": "d8", "time_us": 1_700_000_000_000_008, "more": [1]})
    run(spark, paths)
    run(spark, paths)  # nothing new
    assert dids(spark, paths) == Counter(f"d{i}" for i in range(1, 9))
    sliced = open_lake_slice(spark, paths["lake"], year=2023, month=11, day=14, hour=22)
    assert sliced.count() == 8 and sliced.where("more IS NOT NULL").count() == 1
    assert {(r.writer, r.batch, r.written) for r in committed(spark, paths["lake"]).collect()} == {("stream", 0, 2), ("stream", 1, 2), ("other", 0, 1)}


@pytest.mark.parametrize("crash", ["before_commit", "between_moves", "before_rename", "after_rename"])
def test_a_crash_at_any_point_loses_and_doubles_nothing(spark, paths, monkeypatch, crash):
    put(paths["src"], "a", *events(1, 2, 3), "{bad", "[1]")
    run_args = {"quarantine_path": paths["bad"]}

    class Crash(Exception):
        pass

    def crashed(*_):
        raise Crash

    with monkeypatch.context() as m:
        if crash == "before_commit":
            m.setattr(shared, "commit", crashed)
        elif crash == "after_rename":
            m.setattr(commits, "tidy", crashed)
        elif crash == "before_rename":
            # every file is moved, and the entry still pending
            fs_path, replace, listed = commits._fs_path, commits._replace_file, []
            m.setattr(commits, "_replace_file", lambda *a: (replace(*a), listed.append(a)))
            m.setattr(commits, "_fs_path", lambda s, p: crashed() if listed and f"/{commits.COMMITS}/" in p else fs_path(s, p))
        else:
            fs_path, seen = commits._fs_path, []

            def some(s, p):
                if f"/{STAGING}/" in p and p.endswith(".parquet"):
                    seen.append(p)
                    if len(seen) == 2:
                        raise Crash
                return fs_path(s, p)
            m.setattr(commits, "_fs_path", some)
        with pytest.raises(Exception):
            run(spark, paths, **run_args)
    if crash != "after_rename":
        # readers see nothing of it
        assert not os.path.isdir(paths["bad"]) or not [f for f in os.listdir(paths["bad"]) if f.startswith("reason")] or \
            open_quarantine(spark, paths["bad"]).count() == 0
        assert not [f for f in os.listdir(paths["lake"]) if f.startswith("year")] or open_lake(spark, paths["lake"]).count() == 0
    put(paths["src"], "b", *events(4), "{worse")
    run(spark, paths, **run_args)
    assert dids(spark, paths) == Counter(["d1", "d2", "d3", "d4"])
    assert Counter(bytes(r.raw) for r in open_quarantine(spark, paths["bad"]).collect()) == Counter([b"{bad", b"[1]", b"{worse"])
    total = run_totals(spark, paths["lake"]).first()
    assert (total.batches, total.consumed, total.written, total.errors) == (2, 7, 4, 3)


def test_count_or_time(spark, paths):
    os.makedirs(paths["src"])
    ingest = SharedIngest(spark, paths["lake"], paths["ckpt"], ts="event", min_rows=5, max_delay=10.0)
    query = ingest.start(read_jsonl(spark, paths["src"], streaming=True), {"processingTime": "200 milliseconds"})
    try:
        put(paths["src"], "warm", *events(*range(5)))
        wait(lambda: committed(spark, paths["lake"]).count() == 1, 120)
        put(paths["src"], "a", *events(10, 11))
        wait(lambda: ingest.gauges()["buffered_rows"] == 2, 30)
        put(paths["src"], "b", *events(12, 13, 14))  # now there are enough
        wait(lambda: committed(spark, paths["lake"]).count() == 2, 60)
        put(paths["src"], "c", *events(15))  # too few: time flushes it, although nothing more arrives
        wait(lambda: ingest.gauges()["buffered_rows"] == 1, 30)
        assert ingest.gauges()["seconds_since_flush"] < 10
        wait(lambda: committed(spark, paths["lake"]).count() == 3, 60)
        wait(lambda: ingest.gauges()["seconds_since_flush"] > 10, 30)  # idle for longer than the delay:
        put(paths["src"], "d", *events(16))  # one event is flushed as it comes
        begin = time.monotonic()
        wait(lambda: committed(spark, paths["lake"]).count() == 4, 60)
        assert ingest.gauges()["seconds_since_flush"] < time.monotonic() - begin
        put(paths["src"], "e", *events(17))
        ingest.drain()  # reads and flushes the rest of a running query
        assert not query.isActive and not leftovers(paths["lake"])
        assert [r.written for r in committed(spark, paths["lake"]).orderBy("batch").collect()] == [5, 5, 1, 1, 1]
        assert sum(dids(spark, paths).values()) == 13
    finally:
        query.stop()


def wait(until, seconds):
    end = time.monotonic() + seconds
    while not until():
        assert time.monotonic() < end
        time.sleep(0.1)


def test_the_buffer_survives_a_kill(spark, paths):
    put(paths["src"], "a", *events(1, 2))
    first = SharedIngest(spark, paths["lake"], paths["ckpt"], ts="event", min_rows=100, max_delay=1e9)
    first.start(read_jsonl(spark, paths["src"], streaming=True), {"availableNow": True}).awaitTermination()
    assert committed(spark, paths["lake"]).count() == 0 and first.gauges()["buffered_rows"] == 2
    put(paths["src"], "b", *events(3))
    second = run(spark, paths, min_rows=100, max_delay=1e9)  # the source has committed a already
    assert dids(spark, paths) == Counter(["d1", "d2", "d3"]) and second.gauges()["buffered_rows"] == 0


def test_bad_records_alone_and_an_empty_arrival(spark, paths):
    put(paths["src"], "a", "{bad", "[]")
    run(spark, paths, quarantine_path=paths["bad"])
    put(paths["src"], "b")
    run(spark, paths, quarantine_path=paths["bad"])
    put(paths["src"], "c", *events(1))
    run(spark, paths, quarantine_path=paths["bad"])
    assert dids(spark, paths) == Counter(["d1"]) and open_quarantine(spark, paths["bad"]).count() == 2
    assert run_totals(spark, paths["lake"]).first().consumed == 3
