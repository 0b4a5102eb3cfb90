"""Plan shapes the design relies on at scale (checked on the executed plan)."""

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from eventlake.operators.guards import classify
from eventlake.operators.paths import path_kinds, shapes_of, with_shape
from eventlake.plans.ingest import flatten_events, ingest_batch, prepare
from eventlake.sources.lake import open_lake


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _raw(spark):
    lines = ['{"did":"a","time_us":1,"l":[{"x":1}]}', '{"a":1} xyz', "[1]", "   "]
    return spark.createDataFrame([(x.encode(),) for x in lines], "value binary")


def test_each_wrapper_parsed_once_per_record(spark):
    """Both strict-parse wrappers appear once in the plan of the good records,
    even after the ``reason IS NULL`` filter is pushed down."""
    good = classify(_raw(spark)).filter(F.col("reason").isNull())
    for p in (_plan(good.select("v")), _plan(good)):
        assert p.count("parseJson(concat([") == 1, p
        assert p.count('parseJson(concat({"v":') == 1, p


def test_ingest_projection_is_shuffle_free_and_python_free(spark):
    c, schema, _ = prepare(_raw(spark))
    flat = flatten_events(c.filter(F.col("reason").isNull()), schema)
    p = _plan(flat)
    assert "Exchange" not in p and "Sort" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert p.count("parseJson(concat([") == 1


def test_schema_inference_unites_shapes_in_executors(spark):
    """C1 counts shapes map-side, exchanges distinct ones and pairs, and parses no record twice."""
    p = _plan(path_kinds(shapes_of(with_shape(classify(_raw(spark))))))
    assert "SinglePartition" not in p and "schema_of_variant_agg" not in p
    assert p.count("Exchange hashpartitioning(") == 2 and p.count(" HashAggregate(") == 4
    assert p.count("parseJson(concat([") == 1


def _spied(spark, monkeypatch, run):
    """The executed plans of all writes and collects of ``run``."""
    plans, frame = [], type(spark.range(1))
    collect, parquet = frame.collect, DataFrameWriter.parquet

    def spy_collect(self):
        plans.append(_plan(self))
        return collect(self)

    def spy_parquet(self, *args, **kw):
        plans.append(_plan(self._df))
        return parquet(self, *args, **kw)

    monkeypatch.setattr(frame, "collect", spy_collect)
    monkeypatch.setattr(DataFrameWriter, "parquet", spy_parquet)
    out = run()
    monkeypatch.undo()
    return plans, out


def test_ingest_with_quarantine_parses_each_record_once(spark, monkeypatch, tmp_path):
    plans, got = _spied(spark, monkeypatch, lambda: ingest_batch(
        _raw(spark), str(tmp_path / "lake"), quarantine_path=str(tmp_path / "bad")))
    assert sum(p.count("parseJson(concat([") for p in plans) == 1
    assert got.counts == {"ok": 1, "bad_json": 2, "not_object": 1}
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 3


def test_a_batch_without_news_is_not_inferred(spark, monkeypatch, tmp_path):
    def batch(*lines):
        return spark.createDataFrame([(x.encode(),) for x in lines], "value binary")

    lake = str(tmp_path / "lake")
    first = ingest_batch(batch('{"a":1,"b":{"c":"x"}}', '{"a":null}'), lake)
    assert first.new_paths is None
    _, same = _spied(spark, monkeypatch, lambda: ingest_batch(batch('{"b":{"c":"y"}}'), lake))
    assert same.new_paths == 0 and {f.name for f in same.schema.fields} == {"a", "b"}
    plans, more = _spied(spark, monkeypatch, lambda: ingest_batch(batch('{"a":2,"d":[1.5]}', '{"b":"z"}'), lake))
    assert more.new_paths == 2  # the elements of d, and text at b
    assert sum(p.count("parseJson(concat([") for p in plans) == 1
    # text came later at b: it is no main kind, so such a batch is inferred by itself again
    again = ingest_batch(batch('{"b":"w"}'), lake)
    assert again.new_paths == 0 and [f.name for f in again.schema.fields] == ["b"]
    rows = {(r.a, r.b_c, r.b, tuple(r.d or ())) for r in open_lake(spark, lake).collect()}
    assert rows == {(1, "x", None, ()), (None, None, None, ()), (None, "y", None, ()), (2, None, None, (1.5,)),
                    (None, None, "z", ()), (None, None, "w", ())}


def test_small_files_are_parsed_twice_and_leave_their_paths(spark, monkeypatch, tmp_path):
    from eventlake.sources.jsonl import read_jsonl
    (tmp_path / "a.jsonl").write_text('{"a":1}\n{"a":2,"b":[true]}\n')
    lake = str(tmp_path / "lake")
    plans, _ = _spied(spark, monkeypatch, lambda: ingest_batch(read_jsonl(spark, str(tmp_path / "a.jsonl")), lake))
    assert sum(p.count("parseJson(concat([") for p in plans) == 2
    plans, again = _spied(spark, monkeypatch, lambda: ingest_batch(read_jsonl(spark, str(tmp_path / "a.jsonl")), lake))
    assert sum(p.count("parseJson(concat([") for p in plans) == 1 and again.new_paths == 0
    assert open_lake(spark, lake).count() == 4


def test_top_accounts_reduces_map_side_and_takes_top_k(spark):
    """A hot account is counted per task before the shuffle; top-k is not a full sort."""
    from eventlake.operators.reports import top_accounts
    df = spark.createDataFrame([("hot", "commit")] * 50 + [(f"a{i}", "commit") for i in range(20)],
                               "did string, event_type string")
    p = _plan(top_accounts(df, 10))
    assert p.index("TakeOrderedAndProject") < p.index("Exchange hashpartitioning") < p.index("partial_count")
    assert "Sort [" not in p
    assert top_accounts(df, 10).first()["did"] == "hot"
