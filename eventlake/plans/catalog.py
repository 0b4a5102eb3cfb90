"""Query catalogue: one Spark query per operator, each with an independent DuckDB oracle.

Every query builds its input by Spark from the given tables (``events``,
``conversations``) — JSON envelopes (``plans.fixtures``), JSON-lines files or a
lake written to the shared scratch folder — and runs the operator over *all*
rows. The oracle computes the expected columns from the base tables without
any JSON, so the two sides share no code.
"""

from __future__ import annotations

import math
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from eventlake.functions.jsonvalue import get_path, strict_parse
from eventlake.functions.timecols import epoch_ms_to_ts, ts_to_epoch_us
from eventlake.operators import derive, filters, guards, reports, schema as sch
from eventlake.plans import fixtures as fx
from eventlake.plans.ingest import flatten_events, ingest_batch, ingest_declared, prepare
from eventlake.session import configure_session, scratch_path
from eventlake.sinks.jsonl import write_jsonl
from eventlake.sinks.kafka import kafka_frame
from eventlake.sources.jsonl import read_jsonl
from eventlake.sources.lake import open_lake, open_lake_slice, register_lake

# Fixed values used by the queries and their oracles.
NOW_US = 1735689600000000          # 2025-01-01 00:00:00 UTC, the "now" of lag queries
COLLECTED_MS = 1735689600000       # collection time given to the declared model
SLICE = dict(year=2024, month=1, day=15, hour=14)
WANTED_SPEC = " app.bsky.feed.post , app.bsky.feed.like,"
HIST_BUCKETS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0)
BOUNDED_ROWS = 5  # fewer than an hour holds, so the bound binds


# ---------------------------------------------------------------------------
# shared building blocks


def _events(spark, sf):
    return fx.load(spark, sf, "events")


def _env_raw(spark, sf) -> DataFrame:
    return fx.env(_events(spark, sf)).select(F.col("value").cast("binary").alias("value"))


def _envc_raw(spark, sf) -> DataFrame:
    return fx.envc(fx.load(spark, sf, "conversations")).select(F.col("value").cast("binary").alias("value"))


def _flat(raw: DataFrame) -> DataFrame:
    c, schema, _ = prepare(raw)
    return flatten_events(c.filter(F.col("reason").isNull()), schema)


def _env_flat(spark, sf) -> DataFrame:
    return _flat(_env_raw(spark, sf))


def _edge_lines(spark, sf) -> DataFrame:
    """EDGE written as JSON lines and read back through the JSON-lines source."""
    path = scratch_path(spark, "edge-jsonl")
    write_jsonl(fx.edge(_events(spark, sf)), path)
    return read_jsonl(spark, path)


def _env_lake(spark, sf, **kw) -> str:
    path = scratch_path(spark, "env-lake")
    ingest_batch(_env_raw(spark, sf), path, ts="event", **kw)
    return path


def _declared_lake(spark, sf) -> str:
    path = scratch_path(spark, "declared-lake")
    ingest_declared(_env_raw(spark, sf), path, ts="event", collected_ms=COLLECTED_MS)
    return path


def _nonnull_report(df: DataFrame, with_types: bool) -> DataFrame:
    """(column_name[, data_type], non_null) for every column, from one aggregate."""
    fields = [f for f in df.schema.fields]
    # Two levels: a partial row per map task holds one count per column (up to
    # thousands), so buckets of tasks are summed first, then the few bucket rows.
    bucket = F.pmod(F.spark_partition_id(), F.lit(256)).alias("__bucket")
    per_bucket = df.groupBy(bucket).agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}")
                                          for i, f in enumerate(fields)])
    agg = per_bucket.agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).cast("bigint").alias(f"c{i}")
                           for i in range(len(fields))])
    items = []
    for i, f in enumerate(fields):
        parts = [F.lit(f.name).alias("column_name")]
        if with_types:
            parts.append(F.lit(f.dataType.simpleString()).alias("data_type"))
        parts.append(F.col(f"c{i}").alias("non_null"))
        items.append(F.struct(*parts))
    return agg.select(F.inline(F.array(*items)))


# ---------------------------------------------------------------------------
# sources and sinks


def s1_jsonl_source(spark, sf):
    """Padded lines and whitespace-only lines; every event read once."""
    e = fx.env(_events(spark, sf))
    r = F.pmod(F.col("event_id"), F.lit(7))
    deco = (F.when(r == 0, F.concat(F.lit(" \t"), F.col("value"), F.lit("  ")))
            .when(r == 1, F.concat(F.col("value"), F.lit("\n   ")))
            .otherwise(F.col("value")))
    path = scratch_path(spark, "s1-jsonl")
    write_jsonl(e.select(deco.alias("value")), path)
    v = strict_parse(F.col("value").cast("string"))
    return read_jsonl(spark, path).select(
        get_path(v, ("did",), "string").alias("did"),
        get_path(v, ("time_us",), "bigint").alias("time_us"))


def s1_drop_invalid(spark, sf):
    """Lines that are not JSON are left out and counted, in one pass."""
    from pyspark.sql import Observation
    from eventlake.sources.jsonl import warn_dropped
    path, dropped = scratch_path(spark, "s1-edge"), Observation("s1_drop_invalid")
    write_jsonl(fx.edge(_events(spark, sf)), path)
    kept = read_jsonl(spark, path, drop_invalid=True, dropped=dropped).count()
    return spark.createDataFrame([(kept, warn_dropped(dropped, path))], "kept long, dropped long")


def k4_jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "k4-jsonl")
    write_jsonl(fx.env(_events(spark, sf)), path)
    v = strict_parse(F.col("value").cast("string"))
    return read_jsonl(spark, path).select(
        get_path(v, ("did",), "string").alias("did"),
        get_path(v, ("time_us",), "bigint").alias("time_us"),
        get_path(v, ("kind",), "string").alias("kind"))


def k1_write_lake(spark, sf):
    lake = open_lake(spark, _env_lake(spark, sf))
    return lake.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def s3_lake_scan(spark, sf):
    return (open_lake_slice(spark, _env_lake(spark, sf), year=2024, month=1, day=SLICE["day"])
            .groupBy("hour", "kind").agg(F.count(F.lit(1)).alias("n")))


def k2_bounded_files(spark, sf):
    lake = open_lake(spark, _env_lake(spark, sf, max_rows=BOUNDED_ROWS))
    inv = reports.written_inventory(lake, scratch_path(spark, "k2-inventory"))
    per_folder = inv.groupBy("year", "month", "day", "hour").agg(
        F.max("rows").alias("most"), F.sum("rows").alias("rows"), F.count("*").alias("files"))
    least = F.ceil(F.col("rows") / BOUNDED_ROWS)
    return per_folder.agg((F.max("most") <= BOUNDED_ROWS).alias("bounded"), F.sum("rows").alias("total"),
                          F.count("*").alias("folders"), F.sum(least).alias("least_files"),
                          F.bool_and(F.col("files") >= least).alias("enough"))


def k3_kafka_frame(spark, sf):
    frame = kafka_frame(fx.env(_events(spark, sf)))
    v = strict_parse(F.col("value").cast("string"))
    return frame.select(F.col("key").isNull().alias("key_is_null"),
                        get_path(v, ("did",), "string").alias("did"),
                        get_path(v, ("time_us",), "bigint").alias("time_us"))


# ---------------------------------------------------------------------------
# guards


def g1_utf8(spark, sf):
    lines = _edge_lines(spark, sf)
    return (lines.groupBy(guards.guard_utf8(F.col("value")).alias("utf8_ok"))
            .agg(F.count(F.lit(1)).alias("n")))


def g3_strict_json(spark, sf):
    lines = _edge_lines(spark, sf)
    ok = strict_parse(F.col("value").cast("string")).isNotNull()
    return lines.groupBy(ok.alias("json_ok")).agg(F.count(F.lit(1)).alias("n"))


def g5_size(spark, sf):
    lines = _edge_lines(spark, sf)
    ok = guards.guard_size(F.col("value"), fx.EDGE_MAX_BYTES)
    return lines.groupBy(ok.alias("size_ok")).agg(F.count(F.lit(1)).alias("n"))


def g6_time_us(spark, sf):
    lines = _edge_lines(spark, sf)
    ok = guards.guard_time_us(strict_parse(F.col("value").cast("string")))
    return lines.groupBy(ok.alias("time_us_ok")).agg(F.count(F.lit(1)).alias("n"))


def g4_quarantine(spark, sf):
    c = guards.classify(_edge_lines(spark, sf), max_bytes=fx.EDGE_MAX_BYTES)
    return reports.reason_counts(c)


def a2_counters(spark, sf):
    c = guards.classify(_edge_lines(spark, sf), max_bytes=fx.EDGE_MAX_BYTES)
    return reports.event_counters(c)


# ---------------------------------------------------------------------------
# filters


def f1_wanted_collections(spark, sf):
    kept = filters.wanted_collections(_env_flat(spark, sf), WANTED_SPEC)
    return kept.groupBy("kind", "commit_collection").agg(F.count(F.lit(1)).alias("n"))


def f2_lake_slice(spark, sf):
    return open_lake_slice(spark, _env_lake(spark, sf), **SLICE).select("did", "time_us", "kind")


def f3_capture(spark, sf):
    return filters.capture(_env_flat(spark, sf), 10, ("time_us", "did")).select("did", "time_us")


# ---------------------------------------------------------------------------
# projections


def p1_flatten(spark, sf):
    return _env_flat(spark, sf).select(
        "did", "time_us", "kind", "commit_operation", "commit_collection", "commit_cid",
        "commit_record_value", "commit_record_props_k")


def p2_flatten_list(spark, sf):
    f = _env_flat(spark, sf)
    return (f.select("commit_cid", F.posexplode("commit_record_facets").alias("pos", "e"))
            .select("commit_cid", "pos", F.col("e.f_k").alias("f_k")))


def p3_flatten_nested_list(spark, sf):
    f = _env_flat(spark, sf)
    return (f.select("commit_cid", F.posexplode("commit_record_grid").alias("i", "row"))
            .select("commit_cid", "i", F.posexplode("row").alias("j", "e"))
            .select("commit_cid", "i", "j", F.col("e.f__k").alias("f__k")))


def p4_event_ms(spark, sf):
    return _env_flat(spark, sf).select("did", "time_us", "event_timestamp_ms")


def p5_epoch_ms(spark, sf):
    f = _env_flat(spark, sf).select("did", F.col("event_timestamp_ms").alias("event_timestamp"))
    return derive.with_epoch_timestamps(f)


def p6_partitions(spark, sf):
    f = _env_flat(spark, sf)
    p = derive.with_partitions(f, epoch_ms_to_ts(F.col("event_timestamp_ms")))
    return p.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


def p7_lag(spark, sf):
    return derive.with_lag(_env_flat(spark, sf), NOW_US).select("did", "time_us", "lag_seconds")


def p8_event_schema(spark, sf):
    raw = _envc_raw(spark, sf)
    c = guards.classify(raw)
    ev = derive.project_event(c.filter(F.col("reason").isNull()), collected_ms=COLLECTED_MS)
    return ev.drop("raw_event")


# ---------------------------------------------------------------------------
# schema


def c1_union_schema(spark, sf):
    f = _flat(_env_raw(spark, sf).unionByName(_envc_raw(spark, sf)))
    return _nonnull_report(f, with_types=True)


PINNED = StructType([
    StructField("did", StringType()),
    StructField("time_us", StringType()),
    StructField("kind", StringType()),
    StructField("commit_record_text", StringType()),
    StructField("commit_record_value", DoubleType()),
    StructField("commit_record_reply_parent", StringType()),
])


def c2_conform(spark, sf):
    return sch.conform(_flat(_envc_raw(spark, sf)), PINNED)


def c3_evolve(spark, sf):
    ev = _events(spark, sf)
    is_commit = F.col("event_type").isin(*fx.COLLECTION_OF)
    path = scratch_path(spark, "c3-lake")
    for batch in (fx.env(ev.filter(is_commit)), fx.env(ev.filter(~is_commit)),
                  fx.envc(fx.load(spark, sf, "conversations"))):
        ingest_batch(batch.select(F.col("value").cast("binary").alias("value")), path, ts="event")
    lake = open_lake(spark, path).drop("year", "month", "day", "hour")
    return _nonnull_report(lake, with_types=False)


# ---------------------------------------------------------------------------
# streaming


def _stream_lake(spark, sf, arrivals: list[DataFrame], max_bytes=guards.MAX_MESSAGE_BYTES):
    """Write each frame of ``arrivals`` (a ``value`` column) as one file batch, then
    run the ingest with ``availableNow`` after each."""
    from eventlake.streaming.ingest import ingest_stream, run_metrics
    src = scratch_path(spark, "stream-src")
    lake = scratch_path(spark, "stream-lake")
    ckpt = scratch_path(spark, "stream-ckpt")
    schema = None
    totals = {"batches": 0, "consumed": 0, "written": 0, "errors": 0, "input_rows": 0}
    for i, lines_df in enumerate(arrivals):
        write_jsonl(lines_df.select("value"), f"{src}/run={i}")
        if schema is None:
            _, schema, _ = prepare(read_jsonl(spark, f"{src}/run={i}"), max_bytes=max_bytes)
        stream = read_jsonl(spark, f"{src}/run=*", streaming=True)
        qs = ingest_stream(stream, lake, ckpt, schema, ts="event",
                           trigger={"availableNow": True}, max_bytes=max_bytes)
        for q in qs:
            q.awaitTermination()
            m = run_metrics(q)
            for k in totals:
                totals[k] += m.get(k, 0)
    return lake, totals


def t2_stream_ingest(spark, sf):
    """Two arrivals (commit events, then the rest); the second run adds only new files."""
    ev = _events(spark, sf)
    is_commit = F.col("event_type").isin(*fx.COLLECTION_OF)
    lake, _ = _stream_lake(spark, sf, [fx.env(ev.filter(is_commit)), fx.env(ev.filter(~is_commit))])
    return open_lake(spark, lake).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def t5_run_metrics(spark, sf):
    _, m = _stream_lake(spark, sf, [fx.edge(_events(spark, sf))], max_bytes=fx.EDGE_MAX_BYTES)
    return spark.createDataFrame([(m["consumed"], m["written"], m["errors"])],
                                 "consumed long, written long, errors long")


# ---------------------------------------------------------------------------
# reports


def a1_top_accounts(spark, sf):
    """Flagship: JSON events -> guards -> declared model -> event-time lake -> top accounts."""
    lake = open_lake(spark, _declared_lake(spark, sf))
    return reports.top_accounts(lake, 10)


def a1_top_accounts_hour(spark, sf):
    return reports.top_accounts(open_lake_slice(spark, _declared_lake(spark, sf), **SLICE), 10)


LAKE_SQL = """
SELECT did, event_type, COUNT(*) AS count
FROM {view}
WHERE year = '2024' AND month = '01' AND day = '15' AND hour = '14'
GROUP BY did, event_type
ORDER BY count DESC, did, event_type
LIMIT 10
"""


def e3_lake_sql(spark, sf):
    """The documented lake query as Spark SQL over a registered view."""
    path = _declared_lake(spark, sf)
    view = "eventlake_lake_" + path.rsplit("-", 1)[-1]
    register_lake(spark, path, view)
    return spark.sql(LAKE_SQL.format(view=view))


def e3_lake_sql_slice(spark, sf):
    """E3 over a slice view: the same SQL text; the view lists only the hour's folder."""
    path = _declared_lake(spark, sf)
    view = "eventlake_slice_" + path.rsplit("-", 1)[-1]
    register_lake(spark, path, view, **SLICE)
    return spark.sql(LAKE_SQL.format(view=view))


def a3_histogram(spark, sf):
    h = reports.histogram(_env_flat(spark, sf), "commit_record_value", HIST_BUCKETS)
    return h.select("le", "ord", "count", "total",
                    F.round(F.col("sum") * 100).cast("bigint").alias("sum_cents"))


def a4_lag(spark, sf):
    return reports.current_lag(_env_flat(spark, sf), NOW_US)


def a5_inventory(spark, sf):
    inv = reports.lake_inventory(open_lake(spark, _env_lake(spark, sf)))
    return inv.groupBy("year", "month", "day", "hour").agg(F.sum("rows").alias("rows"))


# ---------------------------------------------------------------------------
# drift, odd keys, one writer per lake, nothing dropped unseen


def _json_object(**fields) -> "F.Column":
    """JSON text of an object; values are columns of JSON text."""
    items = [x for k, v in fields.items() for x in (F.lit(f'"{k}":'), v, F.lit(","))][:-1]
    return F.concat(F.lit("{"), *items, F.lit("}"))


def _as_value(df: DataFrame, text) -> DataFrame:
    return df.select(text.cast("binary").alias("value"))


def c3_evolve_nested(spark, sf):
    """C3 over three batches that drift: list elements with a new and with a missing key, an
    empty list before objects and numbers, whole numbers before fractions and the reverse, and an
    odd ``time_us``. Every value is read back."""
    ev, conv = _events(spark, sf), fx.load(spark, sf, "conversations")
    k = F.get_json_object("props", "$.k")
    us, num = ts_to_epoch_us(F.col("ts")).cast("string"), F.col("event_id").cast("string")
    odd = F.when(F.pmod("event_id", F.lit(1000)) == 0, F.lit("7.5")).otherwise(us)
    turn = F.col("turn").cast("string")
    batches = (
        _as_value(ev, _json_object(time_us=us, b=F.lit("1"), l=F.concat(F.lit('[{"a":'), k, F.lit("}]")), e=F.lit("[]"), n=F.lit("1.0"), w=num)),
        _as_value(ev, _json_object(time_us=odd, b=F.lit("2"), l=F.concat(F.lit('[{"a":1,"b":'), k, F.lit('},{"b":1}]')),
                                   e=F.concat(F.lit('[{"x":'), k, F.lit("}]")), n=F.lit("1.5"), w=F.concat(num, F.lit(".5")))),
        _as_value(conv, _json_object(b=F.lit("3"), l=F.concat(F.lit('[{"c":"t'), turn, F.lit('"}]')), e=F.concat(F.lit("["), turn, F.lit("]")),
                                     n=F.lit("2"), w=F.lit('"text"'))))
    path = scratch_path(spark, "c3-nested")
    for batch in batches:
        ingest_batch(batch, path, ts="event")
    items = F.col("l")
    total = lambda name: F.aggregate(items, F.lit(0).cast("long"), lambda t, x: t + F.coalesce(x[name], F.lit(0)))
    lake = open_lake(spark, path)
    return lake.groupBy("b").agg(
        F.count("*").alias("n_rows"), F.sum(total("a")).alias("sum_a"), F.sum(total("b")).alias("sum_b"),
        F.sum(F.size(F.filter(items, lambda x: x["c"].startswith("t")))).alias("n_c"),
        F.sum(F.size("e")).alias("n_e"), 
        F.sum(F.when(F.size("e") > 0, F.get_json_object(F.try_element_at("e", F.lit(1)), "$.x").cast("long"))).alias("sum_x"),
        F.sum((F.col("n") * 2).cast("long")).alias("twice_n"), F.count("w").alias("n_w"), F.count("w__alt").alias("n_w_alt"),
        F.sum(F.col("w__alt").try_cast("double").cast("long")).alias("sum_w_alt"),
        F.count("time_us").alias("n_time"), F.count("time_us__alt").alias("n_time_alt"))


def p1_hostile_keys(spark, sf):
    """Keys with quotes, a backslash and a backtick, an empty key, and keys named like
    derived columns, written to a lake and read back."""
    ev, num = _events(spark, sf), F.col("event_id").cast("string")
    text = _json_object(**{"q'\\\"z": num, "back\\\\slash": num, "tick`": num, "dot.ted key[0]": num, "${v}": num, "Hour": num,
                           "Event_Timestamp_Ms": num, "__raw_event": F.lit('"r"'), "raw_event": F.lit('"x"')}, time_us=ts_to_epoch_us(F.col("ts")).cast("string"))
    text = F.concat(F.regexp_replace(text, r"\}$", ""), F.lit(',"":{"e":'), num, F.lit("}}"))
    path = scratch_path(spark, "p1-hostile")
    ingest_batch(_as_value(ev, text), path, ts="event", keep_raw=True)
    c = lambda name: F.col("`" + name.replace("`", "``") + "`")
    return open_lake(spark, path).select(
        c("q'\"z").alias("quotes"), c("back\\slash").alias("backslash"), c("tick`").alias("backtick"), c("dot.ted key[0]").alias("dotted"),
        c("${v}").alias("variable"), c("e").alias("below_empty"), c("Hour_").alias("hour_key"), c("Event_Timestamp_Ms_").alias("ms_key"),
        c("__raw_event").alias("raw_key"), c("raw_event").alias("raw_key_2"), (F.octet_length("_raw_event") > 0).alias("has_bytes"),
        "event_timestamp_ms", "hour")


def p1_case_pairs(spark, sf):
    """Keys that differ only by case stay columns of their own; the session's setting does not change."""
    from eventlake.session import conf_scope
    num = F.col("event_id").cast("string")
    flat = _flat(_as_value(_events(spark, sf), _json_object(aB=num, ab=(F.col("event_id") * 10).cast("string"))))
    with conf_scope(spark, **{"spark.sql.caseSensitive": "true"}):
        return flat.select(F.col("aB").alias("upper"), F.col("ab").alias("lower"))


def p5_ingest(spark, sf):
    """P5 in the ingest: epoch-millisecond keys come back from the lake as timestamps."""
    ms = F.floor(ts_to_epoch_us(F.col("ts")) / 1000).cast("string")
    path = scratch_path(spark, "p5-lake")
    ingest_batch(_as_value(_events(spark, sf), _json_object(id=F.col("event_id").cast("string"), event_timestamp=ms, collection_timestamp=ms)), path)
    lake = open_lake(spark, path)
    return lake.select(F.col("id").alias("event_id"), "event_timestamp", "collection_timestamp",
                       F.lit(lake.schema["event_timestamp"].dataType.simpleString()).alias("stored_as"))


def f1_ingest(spark, sf):
    """F1 in the ingest: the lake holds only wanted collections and events without one."""
    path = scratch_path(spark, "f1-lake")
    res = ingest_batch(_env_raw(spark, sf), path, ts="event", wanted=WANTED_SPEC)
    return open_lake(spark, path).groupBy("kind", "commit_collection").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("written", F.lit(res.written).cast("long"))


def _edge_declared(spark, sf) -> tuple[str, str]:
    lake, bad = scratch_path(spark, "edge-lake"), scratch_path(spark, "edge-quarantine")
    ingest_declared(_edge_lines(spark, sf), lake, collected_ms=COLLECTED_MS, max_bytes=fx.EDGE_MAX_BYTES, quarantine_path=bad)
    return lake, bad


def a1_edge_accounts(spark, sf):
    """The flagship over input with bad records: they are left out of the lake ..."""
    return reports.top_accounts(open_lake(spark, _edge_declared(spark, sf)[0]), 10)


def a1_edge_quarantine(spark, sf):
    """... and are found in its quarantine."""
    return spark.read.parquet(_edge_declared(spark, sf)[1]).groupBy("reason").agg(F.count("*").alias("n"), F.count("raw").alias("n_raw"))


def _refused(start) -> bool:
    from eventlake.sources.lake import LakeConflict
    try:
        start()
    except LakeConflict:
        return True
    return False


def _lake_counts(spark, path, **found):
    """One row: rows by the lake, by its slices, and what was refused."""
    zero = F.lit(0).cast("long")
    whole = open_lake(spark, path).agg(F.count("*").alias("by_lake"), zero.alias("by_slice"))
    part = open_lake_slice(spark, path, year=2024, month=1).agg(zero.alias("by_lake"), F.count("*").alias("by_slice"))
    return whole.unionByName(part).agg(F.sum("by_lake").alias("by_lake"), F.sum("by_slice").alias("by_slice")) \
        .select("by_lake", "by_slice", *[v.alias(k) for k, v in found.items()])


def t2_batch_then_stream(spark, sf):
    """A lake of batches refuses a stream, a streamed lake refuses batches; no row is hidden."""
    from eventlake.streaming.ingest import ingest_stream
    raw = _env_raw(spark, sf)
    lake = _env_lake(spark, sf)
    src = scratch_path(spark, "t2-src")
    write_jsonl(fx.env(_events(spark, sf)).select("value"), src)
    _, schema, _ = prepare(raw)
    stream = read_jsonl(spark, src, streaming=True)
    no_stream = _refused(lambda: ingest_stream(stream, lake, scratch_path(spark, "t2-ckpt"), schema, ts="event", trigger={"availableNow": True}))
    streamed, _ = _stream_lake(spark, sf, [fx.env(_events(spark, sf))])
    no_batch = _refused(lambda: ingest_batch(raw, streamed, ts="event"))
    return _lake_counts(spark, lake, lake=F.lit("batch"), stream_refused=F.lit(no_stream), batch_refused=F.lit(False)) \
        .unionByName(_lake_counts(spark, streamed, lake=F.lit("stream"), stream_refused=F.lit(False), batch_refused=F.lit(no_batch)))


def t2_fresh_checkpoint(spark, sf):
    """A new checkpoint on a streamed lake is refused; the old one goes on without loss."""
    from eventlake.streaming.ingest import ingest_stream
    ev = _events(spark, sf)
    is_commit = F.col("event_type").isin(*fx.COLLECTION_OF)
    lake, ckpt, src = (scratch_path(spark, n) for n in ("t2-lake", "t2-ckpt", "t2-src"))
    _, schema, _ = prepare(_env_raw(spark, sf))
    refused = False
    for i, part in enumerate((ev.filter(is_commit), ev.filter(~is_commit))):
        write_jsonl(fx.env(part).select("value"), f"{src}/run={i}")
        stream = read_jsonl(spark, f"{src}/run=*", streaming=True)
        start = lambda at: ingest_stream(stream, lake, at, schema, ts="event", trigger={"availableNow": True})  # noqa: B023, E731
        refused = refused or i > 0 and _refused(lambda: start(scratch_path(spark, "t2-fresh")))  # noqa: B023
        for q in start(ckpt):
            q.awaitTermination()
    return _lake_counts(spark, lake, fresh_refused=F.lit(refused))


def _files_of(spark, sf, arrivals: int) -> int:
    """Files of one of so many arrivals of the events: one task writes a file."""
    return math.ceil(fx.n_tasks(spark, sf, "events") / arrivals)


def _arrivals(spark, lines: list[DataFrame], files: int = 1) -> str:
    """One folder of JSON lines per arrival, in order, each of ``files`` files."""
    src = scratch_path(spark, "arrivals")
    for i, df in enumerate(lines):
        write_jsonl(df.select("value").coalesce(files), f"{src}/run={i}")
    return src


def _shared_run(spark, src, lake, checkpoint, files: int = 1, **settings) -> None:
    """One run of a shared lake's stream over what has arrived, an arrival's ``files`` at a
    time; then it ends, as after a kill."""
    from eventlake.streaming.shared import SharedIngest
    run = SharedIngest(spark, lake, checkpoint, **settings)
    run.start(read_jsonl(spark, f"{src}/run=*", streaming=True, max_files_per_trigger=files), {"availableNow": True}).awaitTermination()
    run.drain()


def t2_shared_lake(spark, sf):
    """A batch, a stream and a second appender on one lake; no row is hidden or doubled."""
    ev = _events(spark, sf)
    parts = [fx.env(ev.filter(F.pmod("event_id", F.lit(3)) == i)) for i in range(3)]
    lake = scratch_path(spark, "shared-lake")
    as_raw = lambda df: df.select(F.col("value").cast("binary").alias("value"))
    ingest_batch(as_raw(parts[0]), lake, ts="event")
    files = _files_of(spark, sf, 3)
    _shared_run(spark, _arrivals(spark, [parts[1]], files), lake, scratch_path(spark, "shared-ckpt"), files, ts="event")
    ingest_batch(as_raw(parts[2]), lake, ts="event")
    return open_lake(spark, lake).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("did", "time_us").alias("n_distinct"))


def t2_quarantine_commit(spark, sf):
    """Lake and quarantine of a stream in one commit hold every record once."""
    from eventlake.sources.lake import open_quarantine
    lake, bad = scratch_path(spark, "qc-lake"), scratch_path(spark, "qc-bad")
    files = _files_of(spark, sf, 1)
    _shared_run(spark, _arrivals(spark, [fx.edge(_events(spark, sf))], files), lake, scratch_path(spark, "qc-ckpt"), files, ts="event",
                quarantine_path=bad, max_bytes=fx.EDGE_MAX_BYTES)
    return open_lake(spark, lake).agg(F.lit("ok").alias("reason"), F.count(F.lit(1)).alias("n")) \
        .unionByName(open_quarantine(spark, bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def _three_runs(spark, sf) -> str:
    """A lake that a stream wrote in three runs, each after an arrival."""
    ev, files = _events(spark, sf), _files_of(spark, sf, 3)
    lake, ckpt, src = (scratch_path(spark, n) for n in ("runs-lake", "runs-ckpt", "runs-src"))
    for i in range(3):
        write_jsonl(fx.edge(ev.filter(F.pmod("event_id", F.lit(3)) == i)).select("value").coalesce(files), f"{src}/run={i}")
        _shared_run(spark, src, lake, ckpt, files, ts="event", max_bytes=fx.EDGE_MAX_BYTES)
    return lake


def t5_restarted_run(spark, sf):
    """T5: totals of a stream that was restarted, each batch counted once."""
    from eventlake.sinks.commits import run_totals
    return run_totals(spark, _three_runs(spark, sf)).select("batches", "consumed", "written", "errors")


def a3_write_time(spark, sf):
    """A3: the histogram of a stream's write times, from its commits."""
    from eventlake.sinks.commits import run_totals, write_seconds
    lake = _three_runs(spark, sf)
    h = reports.histogram(write_seconds(spark, lake), "write_s")
    h = h.agg(F.max(F.when(F.col("le") == "+Inf", F.col("count"))).alias("batches"), F.max("total").alias("total"), F.max("sum").alias("seconds"),
              F.sort_array(F.collect_list(F.struct("ord", "count")))["count"].alias("counts")) \
        .select("batches", "total", "seconds", (F.sort_array("counts") == F.col("counts")).alias("cumulative"))
    whole = run_totals(spark, lake).select(*[F.lit(None).cast(t).alias(c) for c, t in h.dtypes if c != "seconds"], (-F.col("write_ms") / 1000).alias("seconds"))
    return h.unionByName(whole).agg(F.max("batches").alias("batches"), F.max("total").alias("total"), F.max("cumulative").alias("cumulative"),
                                    (F.abs(F.sum("seconds")) < 0.001).alias("sum_is_write_time"))


T1_ARRIVALS, T1_FLUSHES = 8, 3


def t1_count_or_time(spark, sf):
    """Arrivals wait for a number of rows; the last flush is the drain's."""
    from eventlake.sinks.commits import committed
    ev = _events(spark, sf)
    lake, min_rows = scratch_path(spark, "t1-lake"), ev.count() // T1_FLUSHES
    files = _files_of(spark, sf, T1_ARRIVALS)
    src = _arrivals(spark, [fx.env(ev.filter(F.pmod("event_id", F.lit(T1_ARRIVALS)) == i)) for i in range(T1_ARRIVALS)], files)
    _shared_run(spark, src, lake, scratch_path(spark, "t1-ckpt"), files, ts="event", min_rows=min_rows, max_delay=1e9)
    done = committed(spark, lake)
    whole = F.col("consumed") >= min_rows
    # the drain's flush is the one that may be smaller
    sizes = done.agg(F.count(F.lit(1)).alias("flushes"), F.sum("written").alias("written"), F.max(F.when(~whole, F.col("batch"))).alias("least"),
                     F.max("batch").alias("last"), F.count_if(~whole).alias("small"), F.lit(0).cast("long").alias("in_lake"))
    held = open_lake(spark, lake).agg(F.count(F.lit(1)).alias("in_lake"))
    return sizes.unionByName(held, allowMissingColumns=True).agg(
        F.sum("flushes").alias("flushes"), F.sum("written").alias("written"),
        F.max((F.col("small") == 0) | (F.col("small") == 1) & (F.col("least") == F.col("last"))).alias("whole_but_last"), F.sum("in_lake").alias("in_lake"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s1_jsonl_source": s1_jsonl_source,
    "s3_lake_scan": s3_lake_scan,
    "g1_utf8": g1_utf8,
    "g3_strict_json": g3_strict_json,
    "g4_quarantine": g4_quarantine,
    "g5_size": g5_size,
    "g6_time_us": g6_time_us,
    "f1_wanted_collections": f1_wanted_collections,
    "f2_lake_slice": f2_lake_slice,
    "f3_capture": f3_capture,
    "p1_flatten": p1_flatten,
    "p2_flatten_list": p2_flatten_list,
    "p3_flatten_nested_list": p3_flatten_nested_list,
    "p4_event_ms": p4_event_ms,
    "p5_epoch_ms": p5_epoch_ms,
    "p6_partitions": p6_partitions,
    "p7_lag": p7_lag,
    "p8_event_schema": p8_event_schema,
    "c1_union_schema": c1_union_schema,
    "c2_conform": c2_conform,
    "c3_evolve": c3_evolve,
    "k1_write_lake": k1_write_lake,
    "k2_bounded_files": k2_bounded_files,
    "k3_kafka_frame": k3_kafka_frame,
    "k4_jsonl_roundtrip": k4_jsonl_roundtrip,
    "t2_stream_ingest": t2_stream_ingest,
    "t5_run_metrics": t5_run_metrics,
    "a1_top_accounts": a1_top_accounts,
    "a1_top_accounts_hour": a1_top_accounts_hour,
    "e3_lake_sql": e3_lake_sql,
    "e3_lake_sql_slice": e3_lake_sql_slice,
    "a2_counters": a2_counters,
    "a3_histogram": a3_histogram,
    "a4_lag": a4_lag,
    "a5_inventory": a5_inventory,
    **{f.__name__: f for f in (
        c3_evolve_nested, p1_hostile_keys, p1_case_pairs, p5_ingest, f1_ingest, a1_edge_accounts, a1_edge_quarantine,
        t2_batch_then_stream, t2_fresh_checkpoint, t2_shared_lake, t2_quarantine_commit, t5_restarted_run, a3_write_time, t1_count_or_time, s1_drop_invalid)},
}


def wrap(fn):
    """Apply the session settings the operators need before running a query."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure_session(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---------------------------------------------------------------------------
# DuckDB oracles (base tables only)

_DID = "concat('did:t:', user_id)"
_US = "epoch_us(ts)"
_KIND = "CASE event_type WHEN 'signup' THEN 'account' WHEN 'error' THEN 'identity' ELSE 'commit' END"
_COLL = ("CASE event_type WHEN 'purchase' THEN 'app.bsky.feed.post' WHEN 'click' THEN 'app.bsky.feed.like' "
         "WHEN 'view' THEN 'app.bsky.feed.repost' END")
_IS_COMMIT = "event_type IN ('purchase', 'click', 'view')"
_K = "CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT)"
_R = "(event_id % 50)"
_REASON = (f"CASE {_R} WHEN 1 THEN 'bad_json' WHEN 2 THEN 'bad_json' WHEN 3 THEN 'not_object' "
           f"WHEN 4 THEN 'bad_time_us' WHEN 5 THEN 'bad_time_us' WHEN 6 THEN 'bad_utf8' "
           f"WHEN 8 THEN 'oversize' ELSE 'ok' END")
_Y, _M, _D, _H = ("CAST(year(ts) AS VARCHAR)", "strftime(ts, '%m')", "strftime(ts, '%d')",
                  "strftime(ts, '%H')")
_SLICE = "ts >= TIMESTAMP '2024-01-15 14:00:00' AND ts < TIMESTAMP '2024-01-15 15:00:00'"
_CDID = "concat('did:t:c', conv_id, ':', role)"
_CUS = "(1704067200000000 + conv_id * 1000000000 + turn * 1000000)"


def _nonnull_sql(with_types: bool) -> str:
    cols = [
        ("commit_cid", "string", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT}) + (SELECT count(*) FROM conversations)"),
        ("commit_collection", "string", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT}) + (SELECT count(*) FROM conversations)"),
        ("commit_operation", "string", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT}) + (SELECT count(*) FROM conversations)"),
        ("commit_record_embed", "string", "(SELECT count(*) FROM conversations WHERE turn % 5 <> 0)"),
        ("commit_record_facets", "array<struct<f_k:bigint>>", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT})"),
        ("commit_record_grid", "array<array<struct<f__k:bigint>>>", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT})"),
        ("commit_record_props_k", "bigint", f"(SELECT count(*) FROM events WHERE {_IS_COMMIT})"),
        ("commit_record_reply_parent", "string", "(SELECT count(*) FROM conversations WHERE turn > 0)"),
        ("commit_record_reply_root", "string", "(SELECT count(*) FROM conversations WHERE turn > 0)"),
        ("commit_record_text", "string", "(SELECT count(text) FROM conversations)"),
        ("commit_record_value", "double", f"(SELECT count(value) FROM events WHERE {_IS_COMMIT})"),
        ("did", "string", "(SELECT count(*) FROM events) + (SELECT count(*) FROM conversations)"),
        ("event_timestamp_ms", "bigint", "(SELECT count(*) FROM events) + (SELECT count(*) FROM conversations)"),
        ("kind", "string", "(SELECT count(*) FROM events) + (SELECT count(*) FROM conversations)"),
        ("time_us", "bigint", "(SELECT count(*) FROM events) + (SELECT count(*) FROM conversations)"),
    ]
    parts = []
    for name, t, expr in cols:
        typ = f", '{t}' AS data_type" if with_types else ""
        parts.append(f"SELECT '{name}' AS column_name{typ}, CAST({expr} AS BIGINT) AS non_null")
    return "\nUNION ALL ".join(parts)


ORACLES: dict[str, str] = {
    "s1_jsonl_source": f"SELECT {_DID} AS did, {_US} AS time_us FROM events",
    "k4_jsonl_roundtrip": f"SELECT {_DID} AS did, {_US} AS time_us, {_KIND} AS kind FROM events",
    "k1_write_lake": f"SELECT {_Y} AS year, {_M} AS month, {_D} AS day, {_H} AS hour, count(*) AS n "
                     f"FROM events GROUP BY 1, 2, 3, 4",
    "s3_lake_scan": f"SELECT {_H} AS hour, {_KIND} AS kind, count(*) AS n FROM events "
                    f"WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = {SLICE['day']} GROUP BY 1, 2",
    "k2_bounded_files": f"""
        WITH h AS (SELECT count(*) AS n FROM events GROUP BY date_trunc('hour', ts))
        SELECT true AS bounded, CAST(sum(n) AS BIGINT) AS total, count(*) AS folders,
               CAST(sum(ceil(n / {BOUNDED_ROWS}.0)) AS BIGINT) AS least_files, true AS enough FROM h""",
    "k3_kafka_frame": f"SELECT true AS key_is_null, {_DID} AS did, {_US} AS time_us FROM events",
    "g1_utf8": f"SELECT {_R} <> 6 AS utf8_ok, count(*) AS n FROM events GROUP BY 1",
    "g3_strict_json": f"SELECT {_R} NOT IN (1, 2, 6) AS json_ok, count(*) AS n FROM events GROUP BY 1",
    "g5_size": f"SELECT {_R} <> 8 AS size_ok, count(*) AS n FROM events GROUP BY 1",
    "g6_time_us": f"SELECT {_R} NOT IN (4, 5) AS time_us_ok, count(*) AS n FROM events GROUP BY 1",
    "g4_quarantine": f"SELECT {_REASON} AS reason, count(*) AS n FROM events GROUP BY 1",
    "a2_counters": (f"SELECT count(*) AS received, "
                    f"count(*) FILTER (WHERE {_R} NOT IN (1, 2, 6, 8)) AS produced, "
                    f"count(*) AS consumed, "
                    f"count(*) FILTER (WHERE {_REASON} = 'ok') AS written, "
                    f"count(*) FILTER (WHERE {_REASON} <> 'ok') AS errors FROM events"),
    "f1_wanted_collections": (f"SELECT {_KIND} AS kind, {_COLL} AS commit_collection, count(*) AS n "
                              f"FROM events WHERE event_type IN ('purchase', 'click', 'signup', 'error') "
                              f"GROUP BY 1, 2"),
    "f2_lake_slice": f"SELECT {_DID} AS did, {_US} AS time_us, {_KIND} AS kind FROM events WHERE {_SLICE}",
    "f3_capture": f"SELECT {_DID} AS did, {_US} AS time_us FROM events ORDER BY ts, did LIMIT 10",
    "p1_flatten": (f"SELECT {_DID} AS did, {_US} AS time_us, {_KIND} AS kind, "
                   f"CASE WHEN {_IS_COMMIT} THEN CASE event_id % 3 WHEN 0 THEN 'create' WHEN 1 THEN 'update' "
                   f"ELSE 'delete' END END AS commit_operation, {_COLL} AS commit_collection, "
                   f"CASE WHEN {_IS_COMMIT} THEN concat('cid', event_id) END AS commit_cid, "
                   f"CASE WHEN {_IS_COMMIT} THEN value END AS commit_record_value, "
                   f"CASE WHEN {_IS_COMMIT} THEN {_K} END AS commit_record_props_k FROM events"),
    "p2_flatten_list": (f"SELECT concat('cid', event_id) AS commit_cid, 0 AS pos, {_K} AS f_k "
                        f"FROM events WHERE {_IS_COMMIT} UNION ALL "
                        f"SELECT concat('cid', event_id) AS commit_cid, 1 AS pos, {_K} + 1 AS f_k "
                        f"FROM events WHERE {_IS_COMMIT}"),
    "p3_flatten_nested_list": (f"SELECT concat('cid', event_id) AS commit_cid, 0 AS i, 0 AS j, "
                               f"{_K} AS f__k FROM events WHERE {_IS_COMMIT}"),
    "p4_event_ms": f"SELECT {_DID} AS did, {_US} AS time_us, {_US} // 1000 AS event_timestamp_ms FROM events",
    "p5_epoch_ms": f"SELECT {_DID} AS did, date_trunc('millisecond', ts) AS event_timestamp FROM events",
    "p6_partitions": f"SELECT {_Y} AS year, {_M} AS month, {_D} AS day, {_H} AS hour, count(*) AS n "
                     f"FROM events GROUP BY 1, 2, 3, 4",
    "p7_lag": f"SELECT {_DID} AS did, {_US} AS time_us, ({NOW_US} - {_US}) / 1e6 AS lag_seconds FROM events",
    "p8_event_schema": (
        "SELECT TIMESTAMP '2025-01-01 00:00:00' AS collection_timestamp, "
        f"TIMESTAMP '1970-01-01 00:00:00' + to_microseconds({_CUS} // 1000 * 1000) AS event_timestamp, "
        f"{_CDID} AS did, 'commit' AS event_type, 'app.bsky.feed.post' AS collection, 'create' AS action, "
        "concat('c', conv_id, '-', turn) AS cid, text AS record_text, "
        "CASE WHEN turn > 0 THEN concat('did:t:c', conv_id, ':', "
        "lag(role) OVER (PARTITION BY conv_id ORDER BY turn)) END AS reply_parent, "
        "CASE WHEN turn > 0 THEN concat('did:t:c', conv_id, ':', "
        "first_value(role) OVER (PARTITION BY conv_id ORDER BY turn)) END AS reply_root, "
        "CASE turn % 5 WHEN 1 THEN 'images' WHEN 2 THEN 'video' WHEN 3 THEN 'external' "
        "WHEN 4 THEN 'record' END AS embed_type FROM conversations"),
    "c1_union_schema": _nonnull_sql(True),
    "c2_conform": (f"SELECT {_CDID} AS did, CAST({_CUS} AS VARCHAR) AS time_us, 'commit' AS kind, "
                   "text AS commit_record_text, CAST(NULL AS DOUBLE) AS commit_record_value, "
                   "CASE WHEN turn > 0 THEN concat('did:t:c', conv_id, ':', "
                   "lag(role) OVER (PARTITION BY conv_id ORDER BY turn)) END AS commit_record_reply_parent "
                   "FROM conversations"),
    "c3_evolve": _nonnull_sql(False),
    "t2_stream_ingest": f"SELECT {_KIND} AS kind, count(*) AS n FROM events GROUP BY 1",
    "t5_run_metrics": (f"SELECT count(*) AS consumed, count(*) FILTER (WHERE {_REASON} = 'ok') AS written, "
                       f"count(*) FILTER (WHERE {_REASON} <> 'ok') AS errors FROM events"),
    "a1_top_accounts": (f"SELECT {_DID} AS did, {_KIND} AS event_type, count(*) AS count FROM events "
                        f"GROUP BY 1, 2 ORDER BY count DESC, did, event_type LIMIT 10"),
    "a1_top_accounts_hour": (f"SELECT {_DID} AS did, {_KIND} AS event_type, count(*) AS count FROM events "
                             f"WHERE {_SLICE} GROUP BY 1, 2 ORDER BY count DESC, did, event_type LIMIT 10"),
    "e3_lake_sql": (f"SELECT {_DID} AS did, {_KIND} AS event_type, count(*) AS count FROM events "
                    f"WHERE {_SLICE} GROUP BY 1, 2 ORDER BY count DESC, did, event_type LIMIT 10"),
    "e3_lake_sql_slice": (f"SELECT {_DID} AS did, {_KIND} AS event_type, count(*) AS count FROM events "
                          f"WHERE {_SLICE} GROUP BY 1, 2 ORDER BY count DESC, did, event_type LIMIT 10"),
    "a3_histogram": (
        "WITH c AS (SELECT value FROM events WHERE " + _IS_COMMIT + "), "
        "b(le, ord, ub) AS (VALUES " + ", ".join(
            f"('{reports._fmt(b)}', {i}, {b})" for i, b in enumerate(HIST_BUCKETS))
        + f", ('+Inf', {len(HIST_BUCKETS)}, 'Infinity'::DOUBLE)) "
        "SELECT b.le, b.ord, (SELECT count(*) FROM c WHERE c.value <= b.ub) AS count, "
        "(SELECT count(*) FROM c) AS total, CAST(round((SELECT sum(value) FROM c) * 100) AS BIGINT) AS sum_cents "
        "FROM b"),
    "a4_lag": f"SELECT max({_US}) AS newest_us, ({NOW_US} - max({_US})) / 1e6 AS lag_seconds FROM events",
    "a5_inventory": f"SELECT {_Y} AS year, {_M} AS month, {_D} AS day, {_H} AS hour, count(*) AS rows "
                    f"FROM events GROUP BY 1, 2, 3, 4",
    "c3_evolve_nested": f"""
        SELECT 1 AS b, count(*) AS n_rows, CAST(sum({_K}) AS BIGINT) AS sum_a, CAST(0 AS BIGINT) AS sum_b, CAST(0 AS BIGINT) AS n_c,
               CAST(0 AS BIGINT) AS n_e, CAST(NULL AS BIGINT) AS sum_x, 2 * count(*) AS twice_n, count(*) AS n_w, CAST(0 AS BIGINT) AS n_w_alt,
               CAST(NULL AS BIGINT) AS sum_w_alt, count(*) AS n_time, CAST(0 AS BIGINT) AS n_time_alt FROM events
        UNION ALL
        SELECT 2, count(*), count(*), CAST(sum({_K} + 1) AS BIGINT), 0, count(*), CAST(sum({_K}) AS BIGINT), 3 * count(*), 0, count(*),
               CAST(sum(event_id) AS BIGINT), count(*) FILTER (WHERE event_id % 1000 <> 0), count(*) FILTER (WHERE event_id % 1000 = 0) FROM events
        UNION ALL
        SELECT 3, count(*), 0, 0, count(*), count(*), NULL, 4 * count(*), 0, count(*), NULL, 0, 0 FROM conversations""",
    "p1_hostile_keys": f"""
        SELECT event_id AS quotes, event_id AS backslash, event_id AS backtick, event_id AS dotted, event_id AS variable,
               event_id AS below_empty, event_id AS hour_key, event_id AS ms_key, 'r' AS raw_key, 'x' AS raw_key_2, true AS has_bytes,
               {_US} // 1000 AS event_timestamp_ms, {_H} AS hour FROM events""",
    "p1_case_pairs": "SELECT event_id AS upper, event_id * 10 AS lower FROM events",
    "p5_ingest": "SELECT event_id, date_trunc('millisecond', ts) AS event_timestamp, date_trunc('millisecond', ts) AS collection_timestamp, "
                 "'timestamp_ntz' AS stored_as FROM events",
    "f1_ingest": f"SELECT {_KIND} AS kind, {_COLL} AS commit_collection, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS written "
                 f"FROM events WHERE event_type IN ('purchase', 'click', 'signup', 'error') GROUP BY 1, 2",
    "a1_edge_accounts": f"SELECT {_DID} AS did, {_KIND} AS event_type, count(*) AS count FROM events WHERE {_REASON} = 'ok' "
                        f"GROUP BY 1, 2 ORDER BY count DESC, did, event_type LIMIT 10",
    "a1_edge_quarantine": f"SELECT {_REASON} AS reason, count(*) AS n, count(*) AS n_raw FROM events WHERE {_REASON} <> 'ok' GROUP BY 1",
    "s1_drop_invalid": (f"SELECT count(*) FILTER (WHERE {_REASON} NOT IN ('bad_json', 'bad_utf8')) AS kept, "
                        f"count(*) FILTER (WHERE {_REASON} IN ('bad_json', 'bad_utf8')) AS dropped FROM events"),
    "t2_shared_lake": f"SELECT {_KIND} AS kind, count(*) AS n, count(*) AS n_distinct FROM events GROUP BY 1",
    "t2_quarantine_commit": f"SELECT {_REASON} AS reason, count(*) AS n FROM events GROUP BY 1",
    "t5_restarted_run": (f"SELECT CAST(3 AS BIGINT) AS batches, count(*) AS consumed, count(*) FILTER (WHERE {_REASON} = 'ok') AS written, "
                         f"count(*) FILTER (WHERE {_REASON} <> 'ok') AS errors FROM events"),
    "a3_write_time": "SELECT CAST(3 AS BIGINT) AS batches, CAST(3 AS BIGINT) AS total, true AS cumulative, true AS sum_is_write_time",
    "t1_count_or_time": "SELECT CAST(3 AS BIGINT) AS flushes, count(*) AS written, true AS whole_but_last, count(*) AS in_lake FROM events",
    "t2_batch_then_stream": "SELECT count(*) AS by_lake, count(*) AS by_slice, 'batch' AS lake, true AS stream_refused, false AS batch_refused FROM events "
                            "UNION ALL SELECT count(*), count(*), 'stream', false, true FROM events",
    "t2_fresh_checkpoint": "SELECT count(*) AS by_lake, count(*) AS by_slice, true AS fresh_refused FROM events",
}
