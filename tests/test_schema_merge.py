"""Schema union: types merge, and paths unite, as in Spark's own ``schema_of_variant_agg``
(property tests over random JSON values)."""

import json

from hypothesis import given, settings, strategies as st

from eventlake.operators.guards import classify
from eventlake.operators.paths import collect_pairs, schema_of_pairs, shapes_of, tree_of, with_shape
from eventlake.operators.schema import SCALAR_KEY, merge_variant_types, variant_ddl_to_type

_keys = st.sampled_from(["a", "b", "c", "A"])
_scalars = st.one_of(
    st.none(), st.booleans(), st.text(max_size=3),
    st.integers(min_value=-2**63, max_value=2**63 - 1),
    st.integers(min_value=2**63, max_value=10**40),
    st.decimals(allow_nan=False, allow_infinity=False, places=3, min_value=-10**6, max_value=10**6),
    st.floats(allow_nan=False, allow_infinity=False),
)


def _num_text(x):
    return str(x) if not isinstance(x, float) else repr(x)


def _json(v):
    if isinstance(v, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{_json(x)}" for k, x in v.items()) + "}"
    if isinstance(v, list):
        return "[" + ",".join(_json(x) for x in v) + "]"
    if v is None or isinstance(v, (bool, str)):
        return json.dumps(v)
    return _num_text(v)


_values = st.recursive(_scalars, lambda kids: st.one_of(
    st.lists(kids, max_size=3), st.dictionaries(_keys, kids, max_size=3)), max_leaves=8)


@settings(max_examples=40, deadline=None)
@given(st.lists(_values, min_size=1, max_size=6))
def test_merge_equals_spark(spark, values):
    texts = [_json(v) for v in values]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("parse_json(t) AS v")
    singles = [r[0] for r in df.selectExpr("schema_of_variant(v)").collect()]
    expected = df.selectExpr("schema_of_variant_agg(v)").first()[0]
    merged = None
    for s in singles:
        merged = merge_variant_types(merged, variant_ddl_to_type(s))
    assert merged == variant_ddl_to_type(expected), (texts, singles, expected)


def _pairs(spark, texts):
    raw = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    return collect_pairs(shapes_of(with_shape(classify(raw))))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.dictionaries(_keys, _values, max_size=3), min_size=1, max_size=6))
def test_paths_united_equal_spark(spark, values):
    """With its conflicts left as VARIANT, the union by paths is Spark's own aggregate."""
    texts = [_json(v) for v in values]
    expected = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("schema_of_variant_agg(parse_json(t)) AS s").first()[0]
    pairs, counts = _pairs(spark, [*texts, "{", "[1]"])
    assert counts == {"ok": len(texts), "bad_json": 1, "not_object": 1}
    assert tree_of(pairs).plain() == variant_ddl_to_type(expected), (texts, pairs)


def test_names_that_need_quotes(spark):
    names = ["a b", "`q`", "", "n\n", "a:b, OBJECT<", "é", "VARIANT", "OBJECT", "ARRAY", "DECIMAL(1,2)", '"', "\\", "a", "x`", "1st", "}", "'"]
    rows = [json.dumps({n: {m: 1 for m in names}, "l": [{n: "s"}]}) for n in names]
    pairs, _ = _pairs(spark, rows)
    assert {p for p, k, _, _ in pairs if k == "BIGINT"} == {(f"k{n}", f"k{m}") for n in names for m in names}
    assert {p for p, k, _, _ in pairs if k == "STRING"} == {("kl", "a", f"k{n}") for n in names}


def test_objects_and_other_values_at_every_depth(spark):
    """However deep the conflicts nest, the records are read once."""
    rows, deep = [], 1
    for _ in range(20):
        rows.append({"a": deep})
        deep = {"b": deep}
    pairs, _ = _pairs(spark, [json.dumps(r) for r in rows])
    node, st_ = schema_of_pairs(pairs)["a"], 0
    while node.metadata:
        assert node.metadata[SCALAR_KEY] == "bigint"
        node, st_ = node.dataType["b"], st_ + 1
    assert st_ == 19 and node.dataType.typeName() == "long"  # the deepest is always a number


def test_lists_that_mix_kinds(spark):
    pairs, _ = _pairs(spark, ['{"l":[1,{"x":2}]}', '{"l":[{"x":"s"}]}', '{"l":[{"x":{"y":1}}], "m":[[1],["a"]]}'])
    got = {("/".join(p), k) for p, k, _, _ in pairs}
    assert got == {("kl/a", "BIGINT"), ("kl/a/kx", "BIGINT"), ("kl/a/kx", "STRING"), ("kl/a/kx/ky", "BIGINT"),
                   ("km/a/a", "BIGINT"), ("km/a/a", "STRING")}


def test_a_hundred_thousand_keys(spark):
    """No schema text is collected, and no row holds more than a record's paths."""
    raw = spark.range(25_000).selectExpr(
        "CAST(concat('{', array_join(transform(sequence(0, 3), i -> concat('\"key', 4 * id + i, '\":', i)), ','), '}') AS BINARY) AS value")
    pairs, counts = collect_pairs(shapes_of(with_shape(classify(raw))))
    assert counts == {"ok": 25_000}
    assert len(schema_of_pairs(pairs).fields) == 100_000
