"""Golden edge table (FIXTURES.md §4): flatten, guards and event ms on single events."""

import pytest
from pyspark.sql.types import ArrayType, LongType, StringType


def cols(schema):
    return {f.name: f.dataType for f in schema.fields}


def test_nested_object(run_lines):
    rows, schema, _ = run_lines(['{"a":{"b":{"c":1}}}'])
    assert rows == [{"a_b_c": 1, "event_timestamp_ms": None}]


def test_empty_object_vanishes(run_lines):
    rows, schema, _ = run_lines(['{"a":{}, "x":1}'])
    assert "a" not in cols(schema)
    assert rows[0]["x"] == 1


def test_null_kept(run_lines):
    rows, schema, _ = run_lines(['{"a":null, "x":1}'])
    assert rows[0]["a"] is None and isinstance(cols(schema)["a"], StringType)


def test_primitive_lists_kept(run_lines):
    rows, schema, _ = run_lines(['{"a":[]}', '{"a":[1,2]}'])
    assert sorted(r["a"] for r in rows) == [[], [1, 2]]
    assert cols(schema)["a"] == ArrayType(LongType(), True)


def test_list_of_objects(run_lines):
    rows, schema, _ = run_lines(['{"l":[{"p":{"q":1}}]}'])
    assert rows[0]["l"] == [{"p_q": 1}]


def test_list_of_lists_uses_double_underscore(run_lines):
    rows, schema, _ = run_lines(['{"l":[[{"p":{"q":1}}]]}'])
    assert rows[0]["l"] == [[{"p__q": 1}]]


def test_mixed_list_becomes_json_text(run_lines):
    rows, schema, _ = run_lines(['{"l":[1,{"p":{"q":1}}]}'])
    assert cols(schema)["l"] == ArrayType(StringType(), True)
    assert rows[0]["l"] == ["1", '{"p":{"q":1}}']


def test_list_of_empty_objects(run_lines):
    rows, schema, _ = run_lines(['{"l":[{}]}'])
    assert rows[0]["l"] == ["{}"]


def test_empty_key_adds_no_prefix(run_lines):
    rows, _, _ = run_lines(['{"":{"a":1}}'])
    assert rows[0]["a"] == 1


def test_key_collision_deeper_first(run_lines):
    rows, _, _ = run_lines(['{"a":{"b":1},"a_b":2}'])
    assert rows[0]["a_b"] == 1


def test_duplicate_key_last_wins(run_lines):
    rows, _, _ = run_lines(['{"a":1,"a":2}'])
    assert rows[0]["a"] == 2


def test_keys_differing_by_case(spark, run_lines):
    from eventlake.session import conf_scope
    with conf_scope(spark, **{"spark.sql.caseSensitive": "true"}):
        rows, schema, _ = run_lines(['{"aB":1,"ab":2}'])
    assert rows[0]["aB"] == 1 and rows[0]["ab"] == 2


def test_object_and_scalar_give_two_columns(run_lines):
    rows, schema, _ = run_lines(['{"a":{"b":1}}', '{"a":2}'])
    got = {(r["a_b"], r["a"]) for r in rows}
    assert got == {(None, 2), (1, None)}
    assert {"a", "a_b"} <= set(cols(schema))


def test_mixed_scalars_become_string(run_lines):
    rows, schema, _ = run_lines(['{"a":1}', '{"a":"s"}'])
    assert isinstance(cols(schema)["a"], StringType)
    assert sorted(r["a"] for r in rows) == ["1", "s"]


def test_big_int_not_degraded(run_lines):
    rows, schema, _ = run_lines(['{"a":9007199254740993}', "{}"])
    assert isinstance(cols(schema)["a"], LongType)
    assert 9007199254740993 in [r["a"] for r in rows]


@pytest.mark.parametrize("line,ms", [
    ('{"time_us":1704067207179575}', 1704067207179),
    ('{"time_us":-1500}', -2),
    ('{"time":{"us":5000}}', 5),
    ('{"time_us":1500.5}', 1),
])
def test_event_ms(run_lines, line, ms):
    rows, _, _ = run_lines([line])
    assert rows[0]["event_timestamp_ms"] == ms


def test_no_time_us_keeps_row(run_lines):
    rows, _, reasons = run_lines(["{}", '{"x":1}'])
    assert reasons == [None, None]
    assert all(r["event_timestamp_ms"] is None for r in rows)


def test_time_us_object_flattened_away(run_lines):
    rows, _, reasons = run_lines(['{"time_us":{"x":5}}'])
    assert reasons == [None]
    assert rows[0]["time_us_x"] == 5 and rows[0]["event_timestamp_ms"] is None


@pytest.mark.parametrize("line", ['{"time_us":null}', '{"time_us":"5"}', '{"time_us":[5]}',
                                  '{"time_us":true}'])
def test_bad_time_us(run_lines, line):
    _, _, reasons = run_lines([line])
    assert reasons == ["bad_time_us"]


@pytest.mark.parametrize("line", ["[1]", '"s"', "null", "5"])
def test_not_object(run_lines, line):
    _, _, reasons = run_lines([line])
    assert reasons == ["not_object"]


@pytest.mark.parametrize("line", ['{"a":1} xyz', '{"a":1}] [', '{"a":1}} {', "{'a':1}",
                                  '{"a":01}', "﻿{}", '{"a":NaN}', '{"a":1', ""])
def test_bad_json(run_lines, line):
    _, _, reasons = run_lines([line])
    assert reasons == ["bad_json"]


def test_bad_utf8(run_lines):
    _, _, reasons = run_lines([b"\xff\xfe"])
    assert reasons == ["bad_utf8"]


def test_oversize(spark):
    from eventlake.operators.guards import classify
    raw = spark.createDataFrame([(b'{"a":"' + b"x" * 100 + b'"}',), (b'{"a":1}',)], "value binary")
    got = [r["reason"] for r in classify(raw, max_bytes=50).collect()]
    assert got == ["oversize", None]


def test_conflict_inside_list_of_objects(run_lines):
    rows, schema, _ = run_lines(['{"m":[{"a":{"b":1}},{"a":2}]}', '{"m":[{"a":"x"}]}'])
    got = sorted((json_dumps(r["m"]) for r in rows))
    assert got == sorted([json_dumps([{"a": None, "a_b": 1}, {"a": "2", "a_b": None}]),
                          json_dumps([{"a": "x", "a_b": None}])])


def test_conflict_inside_list_of_lists(run_lines):
    rows, _, _ = run_lines(['{"n":[[{"a":{"b":1}},{"a":2}]]}'])
    assert rows[0]["n"] == [[{"a": None, "a__b": 1}, {"a": 2, "a__b": None}]]


def json_dumps(x):
    import json
    return json.dumps(x, sort_keys=True)


@pytest.mark.parametrize("tus,ms", [
    ("9223372036854775807", 9223372036854775),
    ("-9223372036854775808", -9223372036854776),
    ("12345678901234567890", 12345678901234567),  # us beyond BIGINT, ms fits
    ("1e300", None),                    # beyond BIGINT ms
])
def test_extreme_time_us_never_fails_the_batch(spark, run_lines, tus, ms):
    from eventlake.plans.ingest import ingest_batch
    from eventlake.session import scratch_path
    from eventlake.sources.lake import open_lake
    rows, _, reasons = run_lines([f'{{"time_us":{tus},"a":1}}', '{"time_us":1000,"a":2}'])
    assert reasons == [None, None]
    got = {r["a"]: r["event_timestamp_ms"] for r in rows}
    assert got[1] == ms and got[2] == 1
    path = scratch_path(spark, "t-extreme")
    raw = spark.createDataFrame([(f'{{"time_us":{tus},"a":1}}'.encode(),), (b'{"time_us":1000,"a":2}',)],
                                "value binary")
    ingest_batch(raw, path, ts="event")
    lake = open_lake(spark, path)
    assert sorted(r.a for r in lake.collect()) == [1, 2]


def test_duplicate_keys_on_a_plain_session(spark):
    from eventlake.operators.guards import classify
    from eventlake.session import conf_scope
    with conf_scope(spark, **{"spark.sql.variant.allowDuplicateKeys": "false"}):
        raw = spark.createDataFrame([(b'{"a":1,"a":2}',)], "value binary")
        assert classify(raw).first().reason is None
