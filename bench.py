"""Benchmark: ingest throughput and lake queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf", ...}.
Setup (building the JSON-lines input from ``events`` and the declared-model lake)
is not timed; each timed step runs its whole Spark job graph to completion.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import functions as F

    from eventlake.operators import reports
    from eventlake.operators.guards import classify
    from eventlake.plans import fixtures as fx
    from eventlake.plans.ingest import ingest_batch, ingest_declared, prepare
    from eventlake.session import checkpoint_root, get_spark, scratch_path
    from eventlake.sinks.jsonl import write_jsonl
    from eventlake.sources.jsonl import read_jsonl
    from eventlake.sources.lake import open_lake, open_lake_slice
    from eventlake.streaming import ingest_stream, run_metrics

    # The bench input is one small JSON-lines file; a 1 MB open cost lets it split
    # across every core (the 4 MB default gives 5 splits for 8 cores at sf0.1).
    # At scale files are large and splits are bounded by maxPartitionBytes instead.
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.sql.files.openCostInBytes": str(1 << 20)}
    spark = get_spark(f"local[{cpus}]", app="eventlake-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)  # the configured shared folder; a local one only when unset

    events = fx.load(spark, sf_dir, "events")
    n_events = events.count()
    src = scratch_path(spark, "bench-env-jsonl")
    write_jsonl(fx.env(events), src)
    edge_src = scratch_path(spark, "bench-edge-jsonl")
    write_jsonl(fx.edge(events), edge_src)
    declared = scratch_path(spark, "bench-declared")
    ingest_declared(fx.env(events).select(F.col("value").cast("binary").alias("value")), declared,
                    ts="event", collected_ms=0)

    times, extra = {}, {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    timed("infer_schema", lambda: prepare(read_jsonl(spark, src)))
    timed("ingest_ingest_time", lambda: ingest_batch(read_jsonl(spark, src), scratch_path(spark, "b-lake"),
                                                     ts="ingest"))
    timed("ingest_event_time", lambda: ingest_batch(read_jsonl(spark, src), scratch_path(spark, "b-lake"),
                                                    ts="event"))
    timed("ingest_with_quarantine", lambda: ingest_batch(
        read_jsonl(spark, edge_src), scratch_path(spark, "b-lake"), ts="ingest",
        max_bytes=fx.EDGE_MAX_BYTES, quarantine_path=scratch_path(spark, "b-quarantine")))
    timed("quarantine_counts", lambda: reports.reason_counts(
        classify(read_jsonl(spark, edge_src), max_bytes=fx.EDGE_MAX_BYTES)).collect())

    def stream():
        _, schema, _ = prepare(read_jsonl(spark, src))
        (q,) = ingest_stream(read_jsonl(spark, src, streaming=True), scratch_path(spark, "b-slake"),
                             scratch_path(spark, "b-ckpt"), schema, trigger={"availableNow": True})
        q.awaitTermination()
        return run_metrics(q)

    timed("stream_ingest", stream)
    lake = open_lake(spark, declared)
    timed("a1_top_accounts_whole", lambda: reports.top_accounts(lake, 10).collect())
    timed("a1_top_accounts_hour", lambda: reports.top_accounts(
        open_lake_slice(spark, declared, year=2024, month=1, day=15, hour=14), 10).collect())
    timed("a5_inventory", lambda: reports.lake_inventory(lake).count())

    extra["events"] = n_events
    extra["ingest_events_per_sec"] = round(n_events / max(times["ingest_ingest_time"], 1e-9), 1)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "eventlake_total_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
