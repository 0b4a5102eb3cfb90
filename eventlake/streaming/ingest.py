"""Structured Streaming ingest (T1 trigger, T2 commit-after-write, T3 drain, T5 metrics).

* T2 — the good events go through Spark's Parquet file sink with a checkpoint:
  a micro-batch's files become visible only when its entry is committed in
  ``_spark_metadata``, and source offsets are committed after that. A crash
  between write and commit re-runs the batch without duplicates for Spark
  readers (plain directory globs by other engines may see the orphan files).
* The schema is pinned (streaming cannot re-infer per batch without drifting);
  by default it is inferred once (C1) from what is already in the source.
* T1 — ``trigger`` picks the flush policy: ``{"processingTime": "60 seconds"}``
  for time-based flushes, ``{"availableNow": True}`` to drain and stop (T3). For
  Kafka, count-or-time comes from ``minOffsetsPerTrigger`` + ``maxTriggerDelay``
  on the source (``sources.kafka.kafka_source_options``).
* T5 — counters are attached with ``DataFrame.observe`` and read from each
  batch's progress (no extra pass over the data).
* Quarantined records go to a second query with its own checkpoint when a
  ``quarantine_path`` is given, so each sink keeps its own exactly-once commit.
"""

from __future__ import annotations

import contextlib
import json
import threading
import time
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventlake.functions.jsonvalue import get_path
from eventlake.functions.timecols import DEFAULT_TEMPLATE, ingest_time, template_columns
from eventlake.operators.derive import with_partitions
from eventlake.operators.filters import wanted_collections
from eventlake.operators.flatten import case_scope, flattened_schema, paths_to
from eventlake.operators.guards import MAX_MESSAGE_BYTES, TIME_US_PATHS, classify
from eventlake.operators.schema import evolve_frame
from eventlake.plans.ingest import flatten_events, partition_time
from eventlake.sinks.lake import DEFAULT_MAX_ROWS, write_schema_sidecar
from eventlake.sources.lake import read_schema_sidecar

METRICS_NAME = "eventlake_metrics"
PROGRESS_SETTING = "spark.sql.streaming.numRecentProgressUpdates"
PROGRESS_KEPT = 2000  # progress entries that Spark keeps of a query, at least
PROGRESS_READ_S = 0.5  # how often it is looked whether many are new
WRITERS_PER_FOLDER = 8  # tasks that share an hour's rows when the lake follows event time


def observe_batch(classified: DataFrame, name: str = METRICS_NAME) -> DataFrame:
    """Attach consumed / written / error counters, and the newest event time for the lag
    gauge, to a classified frame."""
    r = F.col("reason")
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(r.isNull()).alias("written"),
        F.count_if(r.isNotNull()).alias("errors"),
        F.max(F.when(r.isNull(), get_path(F.col("v"), ("time_us",), "bigint"))).alias("newest_us"),
    )


def ingest_stream(stream: DataFrame, lake_path: str, checkpoint: str, schema: StructType,
                  template: str = DEFAULT_TEMPLATE, ts: str = "ingest",
                  max_rows: int | None = DEFAULT_MAX_ROWS, trigger: dict | None = None,
                  value: str = "value", max_bytes: int = MAX_MESSAGE_BYTES,
                  quarantine_path: str | None = None, query_name: str | None = None,
                  keep_raw: bool = True, wanted: str | None = None,
                  wanted_column: str = "commit_collection") -> list[StreamingQuery]:
    """Start the ingest query (and the quarantine query); returns the started queries.

    ``keep_raw`` (default on, since the schema is pinned) stores each event's
    bytes as ``raw_event`` so keys the pinned schema lacks are not lost. ``wanted`` is
    F1's comma list (None: every collection). A lake that batches write, or one that
    another checkpoint has streamed to, is refused.
    """
    spark = stream.sparkSession
    _refuse_conflicts(spark, lake_path, f"{checkpoint.rstrip('/')}/lake")
    trigger = trigger or {"processingTime": "60 seconds"}
    time_paths = (*TIME_US_PATHS, *paths_to(schema, "time_us"))  # both queries part the records alike
    c = observe_batch(classify(stream, value, max_bytes, time_paths))
    good = c.filter(F.col("reason").isNull())
    parts = template_columns(template)
    with case_scope(spark, flattened_schema(schema)):
        flat = wanted_collections(flatten_events(good, schema, keep_raw=keep_raw, value=value), wanted, wanted_column)
        out = with_partitions(flat, partition_time(flat, ts), template)
        # cast to the stored types, so that no file disagrees with the lake
        out, merged = evolve_frame(out, read_schema_sidecar(spark, lake_path), parts)
    write_schema_sidecar(merged, lake_path)
    if ts != "ingest":
        # rows of an hour go to few tasks, a hot hour's to several
        mixed = F.xxhash64(*[F.col("`" + c.replace("`", "``") + "`") for c in out.columns[:16]])
        out = out.repartition(*[F.col(f"`{p}`") for p in parts], F.pmod(mixed, F.lit(WRITERS_PER_FOLDER)))
    w = (out.writeStream.format("parquet")
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/lake")
         .option("compression", "snappy")
         .partitionBy(*template_columns(template))
         .outputMode("append")
         .trigger(**trigger))
    if max_rows:
        w = w.option("maxRecordsPerFile", int(max_rows))
    if query_name:
        w = w.queryName(query_name)
    if int(spark.conf.get(PROGRESS_SETTING, "100")) < PROGRESS_KEPT:  # read from the session at each batch
        spark.conf.set(PROGRESS_SETTING, str(PROGRESS_KEPT))
    with case_scope(spark, merged):  # a query keeps the settings it was started with
        queries = [w.start(lake_path)]
    _follow(queries[0])
    if quarantine_path:
        bad = classify(stream, value, max_bytes, time_paths).filter(F.col("reason").isNotNull()).select(
            F.col(value).cast("binary").alias("raw"), "reason",
            ingest_time().alias("ingested_at"))
        queries.append(bad.writeStream.format("parquet")
                       .option("checkpointLocation", f"{checkpoint.rstrip('/')}/quarantine")
                       .partitionBy("reason").outputMode("append").trigger(**trigger)
                       .start(quarantine_path))
    return queries


def _refuse_conflicts(spark, lake_path: str, checkpoint: str) -> None:
    """Before anything is written: a lake of batches would lose its rows from sight behind
    the stream's log, and a new checkpoint would number its batches from 0 again, which the
    log takes for batches that it has already."""
    from eventlake.sources.lake import LakeConflict, _fs_path, holds_batches, is_streamed
    if holds_batches(spark, lake_path):
        raise LakeConflict(f"{lake_path} is written by batches; stream into a lake of its own")
    fs, p = _fs_path(spark, f"{checkpoint}/offsets")
    if is_streamed(spark, lake_path) and not fs.exists(p):
        raise LakeConflict(f"{lake_path} has a stream's log, but {checkpoint} no offsets: "
                           "go on with the checkpoint that wrote this lake")


def drain(queries: list[StreamingQuery], timeout: float | None = None) -> None:
    """Wait for ``availableNow`` queries to finish (final flush + commit)."""
    for q in queries:
        q.awaitTermination(timeout)


class _RunTotals:
    """Totals of one run of a query, each batch added once."""

    def __init__(self, query: StreamingQuery, name: str):
        self.query, self.name, self.lock = query, name, threading.Lock()
        self.last = -1  # newest batch that was added
        self.totals = {"batches": 0, "input_rows": 0, "consumed": 0, "written": 0, "errors": 0,
                       "write_ms": 0, "missed": 0}

    def behind(self) -> int:
        newest = self.query.lastProgress
        return newest["batchId"] - self.last if newest else 0

    def take(self, final: bool = False) -> dict:
        """Adds the batches that are new among Spark's progress entries."""
        with self.lock:
            for p in self.query.recentProgress if self.query else ():
                prog = json.loads(p.json) if hasattr(p, "json") and isinstance(p.json, str) else dict(p)
                obs = (prog.get("observedMetrics") or {}).get(self.name)
                if not obs or prog["batchId"] <= self.last:  # the quarantine query, an idle trigger, or added before
                    continue
                if self.totals["batches"]:
                    self.totals["missed"] += prog["batchId"] - self.last - 1
                self.last = prog["batchId"]
                _count(self.totals, prog, obs)
            if final:
                self.query = None
            return dict(self.totals)


_runs: dict[str, _RunTotals] = {}


def _follow(query: StreamingQuery) -> None:
    """Takes the query's progress over, by a thread, before Spark drops it."""
    run = _runs[str(query.runId)] = _RunTotals(query, METRICS_NAME)

    def follow() -> None:
        with contextlib.suppress(Exception):  # the session may end first
            while query.isActive:
                if run.behind() > PROGRESS_KEPT // 8:
                    run.take()
                time.sleep(PROGRESS_READ_S)
            run.take(final=True)

    threading.Thread(target=follow, name="eventlake-metrics", daemon=True).start()


def run_metrics(query: StreamingQuery, name: str = METRICS_NAME) -> dict:
    """T5: totals over all batches of this run of the query (batches, rows, observed counters).

    Spark keeps only the last ``PROGRESS_SETTING`` progress entries of a query; those of
    the queries that ``ingest_stream`` started are added up while they are kept, however
    many batches there are. Batches are numbered without gaps, so one that was dropped
    unread all the same would be counted in ``missed``. Of other queries only what Spark
    still keeps is added. ``lag_seconds`` and ``behind`` are gauges of the last batch.
    """
    run = _runs.get(str(query.runId))
    if run is None or run.name != name:
        run = _RunTotals(query, name)
    return run.take()


def _count(tot: dict, prog: dict, obs) -> None:
    tot["batches"] += 1
    tot["input_rows"] += int(prog.get("numInputRows", 0) or 0)
    for k in ("consumed", "written", "errors"):
        tot[k] += int(obs[k] or 0)
    tot["write_ms"] += int((prog.get("durationMs") or {}).get("addBatch", 0))
    _gauges(tot, prog, obs)


def _gauges(tot: dict, prog: dict, obs) -> None:
    """Lag of the newest event when its batch was written, and what the sources still hold
    (Kafka reports it; files do not)."""
    newest = obs["newest_us"]
    if newest is not None:
        at = datetime.fromisoformat(prog["timestamp"].replace("Z", "+00:00")).timestamp()
        tot["lag_seconds"] = at - int(newest) / 1e6
    behind = [float(s["metrics"]["maxOffsetsBehindLatest"]) for s in prog.get("sources") or []
              if (s.get("metrics") or {}).get("maxOffsetsBehindLatest") is not None]
    if behind:
        tot["behind"] = int(max(behind))


class MetricsListener:
    """T5: totals across the session's ingest queries (consumed, written, errors,
    batches, input rows, write milliseconds), fed by ``StreamingQueryListener`` events.

    Register with ``spark.streams.addListener(MetricsListener().listener)``; read
    ``totals`` at any time. Only per-batch progress (a few numbers) reaches the
    driver, never rows.
    """

    def __init__(self, name: str = METRICS_NAME):
        from pyspark.sql.streaming import StreamingQueryListener

        self.name = name
        self.totals = {"batches": 0, "input_rows": 0, "consumed": 0, "written": 0, "errors": 0,
                       "write_ms": 0}
        outer = self

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                outer._add(json.loads(event.progress.json))

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.listener = _L()

    def _add(self, prog: dict) -> None:
        obs = (prog.get("observedMetrics") or {}).get(self.name)
        if not obs:  # another query of the session, or an idle trigger
            return
        _count(self.totals, prog, obs)
