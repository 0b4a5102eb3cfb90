"""Batch ingest: raw records -> guards -> flatten (C1 schema) -> event ms -> partitions -> lake.

Every record is parsed once. Without a pinned schema the parsed records are written to the
shared scratch folder first (``staged``: VARIANT, reason, shape, and the bytes of what the
quarantine or ``raw_event`` needs); then

1. inference reads the shapes only, and unites their paths in executors (``operators.paths``);
2. one map-only pass flattens and writes the good records;
3. the quarantine write reads the bad ones, after the lake has its batch.

A lake keeps the list of its paths. A later batch is compared to it by an anti-join, and only
one that has other paths or kinds is inferred anew. With a pinned ``schema`` nothing is staged.
No shuffle in the write unless it clusters by event-time partition; nothing is collected except
lists of paths and counts.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.timecols import DEFAULT_TEMPLATE, epoch_ms_to_ts, ingest_time
from eventlake.operators.derive import EVENT_MS, with_epoch_timestamps, with_event_ms, with_partitions
from eventlake.operators.filters import wanted_collections
from eventlake.operators.flatten import case_scope, flatten, flattened_schema, paths_to
from eventlake.operators.guards import MAX_MESSAGE_BYTES, REASONS, TIME_US_PATHS, classify, guard_time_us
from eventlake.operators.paths import OWN_TEXT, SHAPE, collect_pairs, path_kinds, schema_of_pairs, shapes_of, with_shape
from eventlake.operators.schema import normalize
from eventlake.session import scratch_path
from eventlake.sinks.lake import DEFAULT_MAX_ROWS, append_evolving, write_lake, write_paths
from eventlake.sources.lake import read_paths

log = logging.getLogger(__name__)


# Below this input (by Spark's estimate, several times the file size) a second parse is quicker
# than a written table of parsed records.
PARSE_ONCE_BYTES = 256 << 20


def _input_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # noqa: SLF001 - Spark's own estimate


@dataclass
class IngestResult:
    schema: StructType
    counts: dict = field(default_factory=dict)
    kept: int = 0
    new_paths: int | None = None  # pairs of path and kind that the lake did not have (None: not compared)

    @property
    def written(self) -> int:
        """Records in the lake: those that pass the guards and the wanted filter."""
        return self.kept

    @property
    def quarantined(self) -> int:
        return sum(v for k, v in self.counts.items() if k != "ok")


def partition_time(df: DataFrame, ts: str):
    """Column for the partition clock: ``ingest`` (wall clock) or ``event`` time."""
    if ts == "ingest":
        return None
    if ts == "event":
        return epoch_ms_to_ts(F.col(EVENT_MS))
    return F.col(ts)


# Wide tables usually mean data used as keys (ids, URLs). They are ingested whole; beyond this
# width a warning names the remedy.
WARN_COLUMNS = 5000


def flatten_events(good: DataFrame, schema: StructType, keep=(), keep_raw: bool = False,
                   value: str = "value") -> DataFrame:
    """P1-P5 on guarded records: flattened columns, ``event_timestamp_ms``, and timestamps for
    the epoch-millisecond columns.

    ``keep_raw`` adds ``raw_event`` (the record's bytes) so nothing is lost even
    when a pinned schema lacks a new key.
    """
    taken = {f.name.lower() for f in flattened_schema(schema).fields} | {c.lower() for c in good.columns}
    inner = "raw_event"
    while inner in taken:  # a key of that name keeps its own value
        inner = "_" + inner
    if keep_raw:
        good = good.withColumn(inner, F.col(value).cast("binary"))
        keep = tuple(keep) + (inner,)
    flat = with_epoch_timestamps(with_event_ms(flatten(good, schema, keep=keep)))
    if len(flat.columns) > WARN_COLUMNS:
        log.warning("flattened events have %d columns; if keys are data, name their objects in map_paths", len(flat.columns))
    return flat


def as_json(schema: StructType, map_paths) -> StructType:
    """``schema`` with the objects at ``map_paths`` (key tuples) as one JSON-text column each,
    for objects whose keys are data."""
    for path in map_paths:
        def settle(st: StructType, keys: tuple) -> StructType:
            return StructType([
                f if f.name != keys[0] else
                StructField(f.name, StringType()) if len(keys) == 1 else
                StructField(f.name, settle(f.dataType, keys[1:]) if isinstance(f.dataType, StructType) else f.dataType, True, f.metadata)
                for f in st.fields])
        schema = settle(schema, tuple(path))
    return schema


def prepare(raw: DataFrame, schema: StructType | None = None, value: str = "value",
            max_bytes: int = MAX_MESSAGE_BYTES):
    """(classified records, schema, counts): classify, and infer the schema (with reason
    counts) when none is given.

    Objects under empty keys can hold further paths that flatten to ``time_us``; if the
    schema has such, the records are guarded by those as well.
    """
    return _prepare(raw, schema, value, max_bytes)[:3]


def _prepare(raw: DataFrame, schema: StructType | None, value: str, max_bytes: int):
    """As ``prepare``, and the pairs of path and kind that were inferred."""
    if schema is not None:
        return classify(raw, value, max_bytes, _time_paths(schema)), schema, None, None
    paths = TIME_US_PATHS
    while True:
        c = classify(raw, value, max_bytes, paths)
        pairs, counts = collect_pairs(shapes_of(with_shape(c, value)))
        schema = _stored_types(pairs)
        more = _time_paths(schema)
        if set(more) <= set(paths):
            return c, schema, counts, pairs
        paths = (*paths, *[p for p in more if p not in paths])


def _time_paths(schema: StructType) -> tuple:
    return (*TIME_US_PATHS, *[p for p in paths_to(schema, "time_us") if p not in TIME_US_PATHS])


def _stored_types(pairs) -> StructType:
    return normalize(schema_of_pairs(pairs)) or StructType([])


@dataclass
class Staged:
    """Parsed records, written once: ``rows`` as ``classify`` gives them, their schema, counts,
    pairs of path and kind (None: the lake has them all), and which of these the lake lacks."""

    rows: DataFrame
    schema: StructType
    counts: dict
    pairs: list | None
    unseen: int | None


def stage(raw: DataFrame, value: str = "value", max_bytes: int = MAX_MESSAGE_BYTES, keep_raw: bool = False,
          known: DataFrame | None = None) -> Staged:
    """Parses every record once, into a table in the scratch folder, and infers the schema from
    it. ``known`` is the lake's list of paths; a batch that fits it takes the lake's schema, and
    nothing is inferred."""
    spark = raw.sparkSession
    shaped = with_shape(classify(raw, value, max_bytes), value)
    bytes_of = F.col(value).cast("binary")
    where = scratch_path(spark, "staged")
    shaped.select((bytes_of if keep_raw else F.when(F.col("reason").isNotNull(), bytes_of)).alias(value),
                  F.when(F.col("reason").isNull(), F.col("v")).alias("v"), "reason", OWN_TEXT, SHAPE) \
        .write.option("compression", "lz4_raw").parquet(where)
    rows, paths = spark.read.parquet(where), TIME_US_PATHS
    while True:
        shapes = shapes_of(rows)
        if known is not None:
            found, counts = unseen_pairs(shapes, known)
            if not found:
                main = [(tuple(r.path), r.kind, r.digits, r.scale) for r in known.where("main").collect()]
                schema, pairs, unseen = _stored_types(main), None, 0
            else:
                pairs, counts = collect_pairs(shapes)
                schema, unseen = _stored_types(pairs), sum(1 for f in found if f.new)
        else:
            pairs, counts = collect_pairs(shapes)
            schema, unseen = _stored_types(pairs), None
        more = [p for p in _time_paths(schema) if p not in paths]
        if not more:
            return Staged(rows, schema, counts, pairs, unseen)
        # guarded by the further paths, too, from the parsed values
        paths = (*paths, *more)
        rows = rows.withColumn("reason", F.coalesce("reason", F.when(~guard_time_us(F.col("v"), paths), "bad_time_us")))


def unseen_pairs(shapes: DataFrame, known: DataFrame) -> tuple[list, dict]:
    """(pairs of the batch that the lake does not have as its main ones, counts by outcome). A pair
    that the lake has beside the main ones is among them, with ``new`` false."""
    within = [F.coalesce(F.col(f"p.{c}"), F.lit(0)) <= F.coalesce(F.col(f"k.{c}"), F.lit(0)) for c in ("digits", "scale")]
    same = (F.col("p.path") == F.col("k.path")) & (F.col("p.kind") == F.col("k.kind")) & within[0] & within[1]
    pairs = path_kinds(shapes).alias("p").join(known.alias("k"), same, "left").select("p.*", F.col("k.main").alias("main"))
    # what the lake has already is only counted
    seen = F.coalesce("main", F.lit(False))
    rows = pairs.groupBy(*[F.when(~seen, F.col(c)).alias(c) for c in ("path", "kind", "digits", "scale")], "main",
                         F.col("path").isNotNull().alias("good")).agg(F.sum("n").alias("n")).collect()
    counts: dict[str, int] = {}
    for r in rows:
        key = "ok" if r.good else r.kind
        counts[key] = counts.get(key, 0) + r.n
    return [_Unseen(r, r.main is None) for r in rows if r.path is not None], {k: n for k, n in counts.items() if n}


@dataclass
class _Unseen:
    pair: object
    new: bool


def _reason_counts() -> dict:
    r = F.col("reason")
    return {"ok": F.count_if(r.isNull()), **{x: F.count_if(r == x) for x in REASONS}}


def observed(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """``classified`` with per-reason counts that the next job over it fills in."""
    obs = Observation(f"eventlake_{uuid.uuid4().hex}")
    return classified.observe(obs, *[c.alias(n) for n, c in _reason_counts().items()]), obs


def _nonzero(obs: Observation) -> dict:
    return {k: int(v) for k, v in obs.get.items() if v}


def ingest_batch(raw: DataFrame, lake_path: str, schema: StructType | None = None,
                 template: str = DEFAULT_TEMPLATE, ts: str = "ingest",
                 max_rows: int | None = DEFAULT_MAX_ROWS, value: str = "value",
                 max_bytes: int = MAX_MESSAGE_BYTES, quarantine_path: str | None = None,
                 cluster: bool | None = None, evolve: bool = True,
                 keep_raw: bool | None = None, wanted: str | None = None,
                 wanted_column: str = "commit_collection", map_paths=(), parse_once: bool | None = None) -> IngestResult:
    """E4 as one Spark job graph: raw ``value`` records in, partitioned lake out.

    ``cluster`` None picks by partition clock: ingest time needs no shuffle (a
    run lands in one hour); event time rebalances on the partition columns so
    each hour gets few files. ``keep_raw`` None keeps the records' bytes when the
    schema is pinned, as keys it lacks would be lost otherwise. ``wanted`` is F1's comma
    list; the default None takes every collection. ``map_paths`` names objects to store
    as one JSON-text column. Counts come from the same jobs: records by outcome, and ``kept``
    by the filter. ``parse_once`` False parses the records for the schema and again for the
    lake instead of writing them parsed in between; None does so for a small input without
    a quarantine into a new lake, where a further job costs more than the parse.
    """
    from eventlake.sources.lake import refuse_streamed
    spark = raw.sparkSession
    refuse_streamed(spark, lake_path)
    if cluster is None:
        cluster = ts != "ingest"
    pinned, staged = schema is not None, None
    if keep_raw is None:
        keep_raw = pinned
    known = read_paths(spark, lake_path) if evolve and not pinned else None
    if parse_once is None:
        parse_once = quarantine_path is not None or known is not None or _input_bytes(raw) >= PARSE_ONCE_BYTES
    if pinned or not parse_once:
        c, schema, counts, pairs = _prepare(raw, schema, value, max_bytes)
        seen, obs = observed(c) if pinned else (c, None)
    else:
        staged = stage(raw, value, max_bytes, keep_raw, known)
        c, schema, counts, pairs = staged.rows, staged.schema, staged.counts, staged.pairs
        seen = c
    schema = as_json(schema, map_paths)
    kept = Observation(f"eventlake_{uuid.uuid4().hex}")
    with case_scope(spark, flattened_schema(schema)):
        flat = flatten_events(seen.filter(F.col("reason").isNull()), schema, keep_raw=keep_raw, value=value)
        flat = wanted_collections(flat, wanted, wanted_column).observe(kept, F.count(F.lit(1)).alias("kept"))
        out = with_partitions(flat, partition_time(flat, ts), template)
        if evolve:
            append_evolving(out, lake_path, template, max_rows, cluster=cluster)
        else:
            write_lake(out, lake_path, template, max_rows, cluster=cluster)
    if pairs and evolve:
        write_paths(spark, lake_path, pairs)
    if pinned:
        counts = _nonzero(obs)
    # after the lake: a batch that fails and is run again has left no rows here
    if quarantine_path and any(counts.get(x) for x in REASONS):
        write_quarantine(c, quarantine_path, value)
    return IngestResult(schema=schema, counts=counts or {}, kept=int(kept.get["kept"]), new_paths=staged.unseen if staged else None)


def write_quarantine(classified: DataFrame, path: str, value: str = "value") -> None:
    """Bad records with reason, raw bytes and ingest time, partitioned by reason."""
    bad = classified.filter(F.col("reason").isNotNull()).select(
        F.col(value).cast("binary").alias("raw"), "reason",
        ingest_time().alias("ingested_at"))
    bad.write.mode("append").partitionBy("reason").parquet(path)


def ingest_declared(raw: DataFrame, lake_path: str, template: str = DEFAULT_TEMPLATE,
                    ts: str = "event", paths: dict | None = None, collected_ms=None,
                    max_rows: int | None = DEFAULT_MAX_ROWS, value: str = "value",
                    max_bytes: int = MAX_MESSAGE_BYTES, cluster: bool | None = None,
                    quarantine_path: str | None = None, wanted: str | None = None) -> IngestResult:
    """Declared 12-column model (P8) into a partitioned lake; records by outcome are counted
    in the write itself, and a second pass writes the bad ones if there are any."""
    from eventlake.operators.derive import project_event
    from eventlake.sources.lake import refuse_streamed
    refuse_streamed(raw.sparkSession, lake_path)
    c = classify(raw, value, max_bytes)
    seen, obs = observed(c)
    kept = Observation(f"eventlake_{uuid.uuid4().hex}")
    ev = project_event(seen.filter(F.col("reason").isNull()), paths, collected_ms, value=value)
    ev = wanted_collections(ev, wanted, "collection").observe(kept, F.count(F.lit(1)).alias("kept"))
    tcol = F.col("event_timestamp") if ts == "event" else None
    out = with_partitions(ev, tcol, template)
    write_lake(out, lake_path, template, max_rows, cluster=(ts != "ingest") if cluster is None else cluster)
    counts = _nonzero(obs)
    if quarantine_path and any(counts.get(x) for x in REASONS):
        write_quarantine(c, quarantine_path, value)
    return IngestResult(schema=ev.schema, counts=counts, kept=int(kept.get["kept"]))
