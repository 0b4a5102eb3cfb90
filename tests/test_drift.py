"""Appends whose types drift, odd keys, and who may write a lake."""

import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from eventlake.operators import filters, reports
from eventlake.operators.flatten import flatten, flattened_schema
from eventlake.operators.schema import evolve_frame, merge_schemas
from eventlake.plans.ingest import ingest_batch, ingest_declared, prepare
from eventlake.session import conf_scope, scratch_path
from eventlake.sinks.jsonl import write_jsonl
from eventlake.sources.jsonl import read_jsonl
from eventlake.sources.lake import LakeConflict, open_lake, open_lake_slice
from eventlake.streaming import ingest_stream, run_metrics


def _raw(spark, lines):
    return spark.createDataFrame([(x.encode(),) for x in lines], "value binary")


def _lake(spark, *batches, **kw):
    path = scratch_path(spark, "t-drift")
    for lines in batches:
        ingest_batch(_raw(spark, lines), path, **kw)
    return open_lake(spark, path)


VALUES = ["1", "1.0", "1.5", "9007199254740993", "-0.25", "true", '"x"', '"7"', "[]", "[1,2]", "[1.5]", '["a"]', '[{"a":1}]', '[{"a":"s"}]',
          '[{"b":2},{"a":1,"b":3}]', "[[1]]", '[[{"p":{"q":1}}]]', "12345678901234567890", "null"]


@pytest.mark.parametrize("first", ["1", "1.5", '"x"', "[]", '[{"a":"s"}]', "[[1]]"])
def test_any_value_after_any_other_is_kept(spark, first):
    """A batch with every kind of value after one that set the type: each value is read back,
    either in its column or as text beside it."""
    path = scratch_path(spark, "t-any")
    ingest_batch(_raw(spark, [f'{{"id":0,"v":{first}}}']), path)
    for i, v in enumerate(VALUES, 1):
        ingest_batch(_raw(spark, [f'{{"id":{i},"v":{v}}}']), path)
    lake = open_lake(spark, path)
    alt = F.col("v__alt") if "v__alt" in lake.columns else F.lit(None).cast("string")
    rows = {r.id: r for r in lake.select("id", F.struct("v").alias("s"), alt.alias("alt")).withColumn("t", F.to_json("s")).collect()}
    assert len(rows) == len(VALUES) + 1
    for i, text in enumerate([first, *VALUES]):
        want, row = json.loads(text), rows[i]
        got = json.loads(row.t).get("v")
        if want is None:
            assert got is None and row.alt is None
            continue
        assert (got is None) != (row.alt is None), (text, row)
        found = got if got is not None else row.alt
        if isinstance(found, str) and not isinstance(want, str):
            found = json.loads(found)
        if isinstance(found, list) and any(isinstance(x, str) for x in found) and not all(isinstance(x, str) for x in want):
            found = [json.loads(x) if isinstance(x, str) else x for x in found]
        assert _plain(found) == _plain(want) or str(found) == str(want), (text, row)


def _plain(v):
    """Without fields that are NULL, and with flattened names."""
    if isinstance(v, list):
        return [_plain(x) for x in v]
    if isinstance(v, dict):
        out = {}
        for k, x in v.items():
            if isinstance(x, dict):
                out.update({f"{k}__{n}": y for n, y in _plain(x).items()})
            elif x is not None:
                out[k] = _plain(x)
        return out
    if isinstance(v, (int, float)) and not isinstance(v, bool) and abs(v) < 2 ** 53:
        return str(float(v))
    try:  # a number that came into a column of text
        return str(float(v)) if isinstance(v, str) else str(v)
    except ValueError:
        return v


def test_list_elements_gain_and_miss_keys(spark):
    lake = _lake(spark, ['{"l":[{"x":1}]}'], ['{"l":[{"x":2,"y":"a"}]}'], ['{"l":[{"y":"b"}]}', '{"l":[]}'])
    assert sorted(str([(e.x, e.y) for e in r.l]) for r in lake.collect()) == sorted(["[(1, None)]", "[(2, 'a')]", "[(None, 'b')]", "[]"])


def test_keys_that_differ_by_case_stay_apart_across_batches(spark):
    lake = _lake(spark, ['{"ab":1}'], ['{"aB":2}'], ['{"AB":3,"ab":4}'], ['{"aB":"x","ab_":5}'])
    got = {c: sorted((str(r[c]) for r in lake.collect() if r[c] is not None)) for c in lake.columns if c not in ("year", "month", "day", "hour")}
    assert got == {"ab": ["1", "4"], "ab_": ["2"], "ab__": ["3"], "ab___": ["5"], "ab___alt": ["x"], "event_timestamp_ms": []} or \
        sorted(map(tuple, got.values())) == sorted([("1", "4"), ("2",), ("3",), ("5",), ("x",), ()])


def test_stored_alt_column_keeps_its_name(spark):
    stored = StructType([StructField("a", LongType()), StructField("a__alt", LongType())])
    df = spark.createDataFrame([("x",), ("5",)], "a string")
    out, merged = evolve_frame(df, stored)
    assert out.columns == ["a", "a__alt_"] and [tuple(r) for r in out.collect()] == [(None, "x"), (None, "5")]
    again, more = evolve_frame(df, merged)
    assert again.columns == out.columns and more == merged
    assert merge_schemas(stored, StructType([StructField("a", StringType())]))["a"].dataType == StringType()


def test_one_odd_time_does_not_refuse_a_batch(spark):
    lake = _lake(spark, ['{"time_us":1000}'], ['{"time_us":7.5}', '{"time_us":3000}'], ['{"":{"time_us":"x"}}', '{"":{"time_us":4000}}'])
    assert sorted((r.time_us, r.time_us__alt) for r in lake.collect() if r.time_us) == [(1000, None), (3000, None), (4000, None)]
    assert [r.time_us__alt for r in lake.collect() if r.time_us__alt] == ["7.5"]
    assert lake.count() == 4


def test_empty_key_parents_are_guarded(spark):
    _, _, counts = prepare(_raw(spark, ['{"":{"":{"time_us":"x"}}}', '{"":{"time":{"us":1}}}', '{"a":1}']))
    assert counts == {"ok": 2, "bad_time_us": 1}


def test_wide_events_are_written_whole(spark, caplog):
    n = 6000
    lake = _lake(spark, ["{" + ",".join(f'"k{i}":{i}' for i in range(n)) + "}"])
    row = lake.drop("year", "month", "day", "hour").first().asDict()
    assert sum(v for k, v in row.items() if k[0] == "k") == n * (n - 1) // 2
    assert "map_paths" in caplog.text


def test_forty_levels_of_conflicts(spark):
    deep = "1"
    for i in range(40):
        deep = f'{{"k":{deep}}}'
    lines, inner = [deep], "2"
    for i in range(39):
        lines.append(inner)
        inner = f'{{"k":{inner}}}'
    lake = _lake(spark, [x for x in lines if x.startswith("{")])
    row = [r.asDict() for r in lake.collect()]
    names = ["_".join(["k"] * d) for d in range(1, 41)]
    for d, name in enumerate(names, 1):
        assert [r[name] for r in row if r.get(name) is not None] == ([1] if d == 40 else [2] if d < 39 else []), name


def test_map_paths_store_an_object_as_text(spark):
    lake = _lake(spark, ['{"a":{"m":{"u1":1,"u2":2},"x":1}}'], map_paths=[("a", "m")])
    assert "a_m_u1" not in lake.columns and json.loads(lake.first().a_m) == {"u1": 1, "u2": 2}


def test_building_two_thousand_columns_is_quick(spark):
    schema = StructType([StructField(f"k{i}", StructType([StructField("v", LongType())])) for i in range(2000)])
    df = spark.createDataFrame([("{}",)], "t string").select(F.parse_json("t").alias("v"))
    flatten(df, schema)
    begun = time.time()
    assert len(flatten(df, schema).columns) == 2000 == len(flattened_schema(schema))
    assert time.time() - begun < 6  # about 1 s on an idle machine


def test_session_settings_stay(spark):
    before = spark.conf.get("spark.sql.caseSensitive", None)
    with conf_scope(spark, **{"spark.sql.session.timeZone": "Asia/Tokyo"}):
        lake = _lake(spark, ['{"a":1,"time_us":1704067207179575}', '{"aB":1,"ab":2}'], ts="event")
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert spark.conf.get("spark.sql.caseSensitive", None) == before
        assert {(r.hour, r.day) for r in lake.select("hour", "day").collect() if r.hour} >= {("00", "01")}


def test_custom_templates_can_be_sliced(spark):
    path = scratch_path(spark, "t-template")
    template = "dt={year}-{month}/hr={hour}"
    ingest_batch(_raw(spark, ['{"did":"a","time_us":1704067207179575}', '{"did":"b","time_us":1717207200000000}']), path, ts="event", template=template)
    assert [r.did for r in open_lake_slice(spark, path, template, year=2024, month=6).collect()] == ["b"]
    assert [r.did for r in open_lake_slice(spark, path, template, month=1).collect()] == ["a"]
    assert [r.did for r in filters.lake_slice(open_lake(spark, path, template=template), hour=2, template=template).collect()] == ["b"]
    with pytest.raises(ValueError, match="day"):
        open_lake_slice(spark, path, template, day=1)
    assert set(reports.lake_inventory(open_lake(spark, path, template=template), template).columns) >= {"dt", "hr"}


def test_pinned_batch_counts_and_keeps_bytes(spark):
    path = scratch_path(spark, "t-pinned")
    pin = StructType([StructField("a", LongType())])
    res = ingest_batch(_raw(spark, ['{"a":1,"new":"lost"}', '{"a":"x"}', "[1]"]), path, schema=pin)
    assert res.counts == {"ok": 2, "not_object": 1} and res.written == 2
    assert sorted(bytes(r.raw_event) for r in open_lake(spark, path).collect()) == [b'{"a":"x"}', b'{"a":1,"new":"lost"}']


def test_declared_ingest_counts_and_filters(spark):
    path, bad = scratch_path(spark, "t-declared"), scratch_path(spark, "t-declared-bad")
    lines = ['{"did":"a","commit":{"collection":"x"}}', '{"did":"b","commit":{"collection":"y"}}', '{"did":"c"}', "{"]
    res = ingest_declared(_raw(spark, lines), path, ts="ingest", quarantine_path=bad, wanted="x")
    assert res.counts == {"ok": 3, "bad_json": 1} and res.written == 2
    assert sorted(r.did for r in open_lake(spark, path).collect()) == ["a", "c"] and spark.read.parquet(bad).count() == 1


# --- one writer per lake -----------------------------------------------------------


def _stream(spark, lake, ckpt, src, schema, **kw):
    qs = ingest_stream(read_jsonl(spark, src, streaming=True), lake, ckpt, schema, ts="event", trigger={"availableNow": True}, **kw)
    for q in qs:
        q.awaitTermination()
    return qs


def _source(spark, lines):
    src = scratch_path(spark, "t-src")
    write_jsonl(spark.createDataFrame([(x,) for x in lines], "value string"), src)
    return src


def test_stream_and_batch_do_not_share_a_lake(spark):
    schema = StructType([StructField("did", StringType()), StructField("time_us", LongType())])
    line = '{"did":"a","time_us":1704067207179575}'
    src, lake, ckpt = _source(spark, [line]), scratch_path(spark, "t-lake"), scratch_path(spark, "t-ckpt")
    ingest_batch(_raw(spark, [line]), lake, ts="event")
    with pytest.raises(LakeConflict):
        _stream(spark, lake, ckpt, src, schema)
    assert open_lake(spark, lake).count() == open_lake_slice(spark, lake, year=2024).count() == 1
    streamed = scratch_path(spark, "t-streamed")
    _stream(spark, streamed, ckpt, src, schema)
    with pytest.raises(LakeConflict):
        ingest_batch(_raw(spark, [line, "[1]"]), streamed, ts="event", quarantine_path=(bad := scratch_path(spark, "t-bad")))
    with pytest.raises(Exception):
        spark.read.parquet(bad).count()  # nothing was written
    with pytest.raises(LakeConflict):
        _stream(spark, streamed, scratch_path(spark, "t-other"), src, schema)
    assert open_lake(spark, streamed).count() == open_lake_slice(spark, streamed, year=2024, hour=0).count() == 1


def test_a_narrower_stream_type_is_cast(spark):
    src, lake, ckpt = _source(spark, ['{"v":"x"}', '{"v":3}']), scratch_path(spark, "t-lake"), scratch_path(spark, "t-ckpt")
    _stream(spark, lake, ckpt, src, StructType([StructField("v", StringType())]))
    write_jsonl(spark.createDataFrame([('{"v":4}',)], "value string"), src)
    _stream(spark, lake, ckpt, src, StructType([StructField("v", LongType())]))
    assert sorted(r.v for r in open_lake(spark, lake).collect()) == ["3", "4", "x"]


def test_metrics_leave_the_quarantine_query_out(spark):
    src = _source(spark, ['{"did":"a"}', "[1]", "[2]"])
    qs = _stream(spark, scratch_path(spark, "t-lake"), scratch_path(spark, "t-ckpt"), src,
                 StructType([StructField("did", StringType())]), quarantine_path=scratch_path(spark, "t-bad"), wanted="x")
    totals = [run_metrics(q) for q in qs]
    assert [(t["input_rows"], t["consumed"], t["batches"]) for t in totals] == [(3, 3, 1), (0, 0, 0)]
