"""Streaming ingest into a lake that batches and other streams share.

* T1, count or time: arrivals are kept, raw, in a buffer beside the checkpoint until there are
  ``min_rows`` of them or ``max_delay`` seconds have passed since the last flush; an event after
  an idle time flushes at once. The buffer is written before the source's offsets are, so a
  crash loses nothing. Without ``min_rows`` every micro-batch is flushed.
* T2, one commit: a flush parses its records once and writes the lake and the quarantine
  aside; both become visible by one rename (``sinks.commits``). A flush that is run again
  replaces what it left, or is passed over if it was done.
* T3, drain: ``drain()`` takes in what the source has, flushes and stops, also while the
  query runs on a ``processingTime`` trigger.
* T5: counts and write times are part of the commits, and so outlive restarts.

The schema of a flush is inferred from it and the lake evolves, as in batch ingest; a pinned
schema may be given.
"""

from __future__ import annotations

import logging
import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eventlake.functions.timecols import DEFAULT_TEMPLATE, ingest_time
from eventlake.operators.derive import with_partitions
from eventlake.operators.filters import wanted_collections
from eventlake.operators.flatten import case_scope, flattened_schema
from eventlake.operators.guards import MAX_MESSAGE_BYTES
from eventlake.plans.ingest import as_json, flatten_events, partition_time, stage
from eventlake.sinks.commits import commit, committed, is_committed, staging_folder, take_back
from eventlake.sinks.lake import append_evolving, write_paths
from eventlake.sources.lake import _fs_path, read_paths

log = logging.getLogger(__name__)

TICK_S = 0.5  # how often it is looked whether a flush is due while nothing arrives


class SharedIngest:
    """One writer of a shared lake. ``writer`` names it: no two writers of a lake may have the
    same name, and a writer keeps its checkpoint."""

    def __init__(self, spark, lake_path: str, checkpoint: str, writer: str = "stream", *, schema: StructType | None = None,
                 template: str = DEFAULT_TEMPLATE, ts: str = "ingest", max_rows: int | None = None, value: str = "value",
                 max_bytes: int = MAX_MESSAGE_BYTES, quarantine_path: str | None = None, min_rows: int | None = None,
                 max_delay: float = 60.0, keep_raw: bool = False, wanted: str | None = None,
                 wanted_column: str = "commit_collection", map_paths=()):
        self.spark, self.lake, self.checkpoint, self.writer = spark, lake_path.rstrip("/"), checkpoint.rstrip("/"), writer
        self.schema, self.template, self.ts, self.max_rows, self.value, self.max_bytes = schema, template, ts, max_rows, value, max_bytes
        self.quarantine = quarantine_path.rstrip("/") if quarantine_path else None
        self.folders = [self.lake, *([self.quarantine] if self.quarantine else [])]
        self.min_rows, self.max_delay, self.keep_raw = min_rows, max_delay, keep_raw
        self.wanted, self.wanted_column, self.map_paths = wanted, wanted_column, map_paths
        self.lock, self.failure, self.query = threading.RLock(), None, None
        self.upto = self._committed_upto()
        self.waiting: dict[int, int] = self._buffered()  # rows by batch
        self.flushed_at = time.monotonic()

    # --- what survives a restart -------------------------------------------------

    def _committed_upto(self) -> int:
        found = committed(self.spark, self.lake).where(F.col("writer") == self.writer).agg(F.max("upto")).first()[0]
        return -1 if found is None else found

    def _buffer(self, batch: int) -> str:
        return f"{self.checkpoint}/buffer/{batch:012d}"

    def _buffered(self) -> dict[int, int]:
        fs, root = _fs_path(self.spark, f"{self.checkpoint}/buffer")
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        done = [int(n) for n in names if n.isdigit() and fs.exists(_fs_path(self.spark, f"{self.checkpoint}/buffer/{n}/_SUCCESS")[1])]
        return {b: self.spark.read.parquet(self._buffer(b)).count() for b in sorted(done) if b > self.upto}

    def gauges(self) -> dict:
        """Rows and micro-batches that wait, and seconds since the last flush."""
        with self.lock:
            return {"buffered_rows": sum(self.waiting.values()), "buffered_batches": len(self.waiting),
                    "seconds_since_flush": time.monotonic() - self.flushed_at}

    # --- arrivals ------------------------------------------------------------------

    def start(self, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
        self.query = stream.writeStream.foreachBatch(self._arrive).option("checkpointLocation", f"{self.checkpoint}/source") \
            .trigger(**(trigger or {"processingTime": "1 second"})).start()
        if self.min_rows:
            threading.Thread(target=self._watch, args=(self.query,), name="eventlake-flush", daemon=True).start()
        return self.query

    def _arrive(self, batch: DataFrame, number: int) -> None:
        with self.lock:
            if self.failure:
                raise self.failure
            if number <= self.upto:
                return  # its commit was done before its offsets were
            rows = batch.select(F.col(self.value).cast("binary").alias(self.value))
            if not self.min_rows:
                self._flush(rows, number)
                return
            rows.write.mode("overwrite").parquet(self._buffer(number))
            self.waiting[number] = self.spark.read.schema(rows.schema).parquet(self._buffer(number)).count()
            self._flush_if_due()

    def _watch(self, query: StreamingQuery) -> None:
        """Flushes by time while nothing arrives; a failure ends the query at its next batch."""
        while query.isActive:
            time.sleep(TICK_S)
            try:
                with self.lock:
                    self._flush_if_due()
            except Exception as e:  # noqa: BLE001 - raised again in the query
                log.error("flush failed: %s", e)
                self.failure = e
                return

    def _flush_if_due(self) -> None:
        rows = sum(self.waiting.values())
        if rows and (rows >= self.min_rows or time.monotonic() - self.flushed_at >= self.max_delay):
            self.flush()

    def flush(self) -> None:
        """Writes and commits everything that waits."""
        with self.lock:
            if not self.waiting:
                return
            batches = sorted(self.waiting)
            rows = self.spark.read.parquet(*[self._buffer(b) for b in batches])
            self._flush(rows, batches[-1])
            for b in batches:
                fs, p = _fs_path(self.spark, self._buffer(b))
                fs.delete(p, True)
            self.waiting.clear()

    def drain(self) -> None:
        """Takes in what the source has, flushes, and stops: no row is left unread or
        uncommitted, whatever the trigger."""
        q = self.query
        if q is not None and q.isActive:
            q.processAllAvailable()
            q.stop()
        if q is not None and q.exception():
            raise q.exception()
        self.flush()
        # an arrival of the last moment was cut off; it is unread, and comes again with the next start
        for n in range(self.upto + 1, self.upto + 3):
            take_back(self.spark, self.lake, f"{self.writer}-{n:012d}", self.folders)

    # --- a flush -------------------------------------------------------------------

    def _flush(self, raw: DataFrame, upto: int) -> None:
        name, spark = f"{self.writer}-{upto:012d}", self.spark
        if not is_committed(spark, self.lake, name):
            take_back(spark, self.lake, name, self.folders)
            begin = time.monotonic()
            facts, pairs = self._write(raw, name)
            write_ms = int(1000 * (time.monotonic() - begin))
            commit(spark, self.lake, name, self.folders,
                   {"writer": self.writer, "batch": upto, "upto": upto, "write_ms": write_ms, **facts})
            if pairs:
                write_paths(spark, self.lake, pairs)
        self.upto, self.flushed_at = upto, time.monotonic()

    def _write(self, raw: DataFrame, name: str) -> tuple[dict, list | None]:
        known = read_paths(self.spark, self.lake) if self.schema is None else None
        staged = stage(raw, self.value, self.max_bytes, self.keep_raw or self.schema is not None, known)
        schema = as_json(self.schema if self.schema is not None else staged.schema, self.map_paths)
        kept = 0
        with case_scope(self.spark, flattened_schema(schema)):
            if staged.counts.get("ok"):
                good = staged.rows.where("reason IS NULL")
                flat = flatten_events(good, schema, keep_raw=self.keep_raw or self.schema is not None, value=self.value)
                flat = wanted_collections(flat, self.wanted, self.wanted_column)
                out = with_partitions(flat, partition_time(flat, self.ts), self.template)
                append_evolving(out, self.lake, self.template, self.max_rows, cluster=self.ts != "ingest", into=staging_folder(self.lake, name))
                kept = self.spark.read.parquet(staging_folder(self.lake, name)).count() if self.wanted else staged.counts["ok"]
        reasons = {k: n for k, n in staged.counts.items() if k != "ok"}
        if self.quarantine and reasons:
            staged.rows.where("reason IS NOT NULL").select(F.col(self.value).alias("raw"), "reason", ingest_time().alias("ingested_at")) \
                .write.mode("overwrite").partitionBy("reason").parquet(staging_folder(self.quarantine, name))
        ok, bad = staged.counts.get("ok", 0), sum(reasons.values())
        return {"consumed": ok + bad, "written": ok, "kept": kept, "errors": bad, "reasons": reasons}, staged.pairs
