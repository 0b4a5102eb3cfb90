"""Property test: Spark flatten of random events == a small Python model of the rules.

The model is written from the flattening rules (SURVEY §2.4, P1-P3), not from the
engine: nested object keys join with ``_``, ``{}`` vanishes, a list of objects keeps a
list of flattened objects without parent prefix, below a list of lists every join is
``__``, missing keys are NULL. Key names decide value types (``i`` int, ``s`` string,
``o`` object, ``l`` list of ints, ``m`` list of objects, ``n`` list of lists of objects)
so a batch has unions of keys but no type conflicts; conflicts are covered by the
golden edge tests.
"""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

KEYS = ["a", "b", "A", "q'\"", "b\\s", "t`.k"]


def _obj(depth):
    def build(draw):
        out = {}
        for k in draw(st.lists(st.sampled_from(KEYS), min_size=1, max_size=3, unique=True)):
            kind = draw(st.sampled_from("isolmn" if depth > 0 else "isl"))
            name = kind + k
            if kind == "i":
                out[name] = draw(st.one_of(st.none(), st.integers(-10**12, 10**12)))
            elif kind == "s":
                out[name] = draw(st.text(alphabet="xyz é\"\\", max_size=4))
            elif kind == "l":
                out[name] = draw(st.lists(st.integers(-99, 99), max_size=3))
            elif kind == "o":
                out[name] = draw(_obj(depth - 1))
            elif kind == "m":
                out[name] = draw(st.lists(_leaf_obj(), min_size=1, max_size=3))
            else:
                out[name] = draw(st.lists(st.lists(_leaf_obj(), min_size=1, max_size=2),
                                          min_size=1, max_size=2))
        if draw(st.booleans()):
            out[""] = draw(st.dictionaries(st.sampled_from(["ia", "iz"]), st.integers(0, 9)))
        return out
    return st.composite(lambda draw: build(draw))()


def _leaf_obj():
    return st.fixed_dictionaries(
        {"ia": st.integers(-5, 5)},
        optional={"ob": st.fixed_dictionaries({"ic": st.integers(0, 9)}),
                  "sd": st.text(alphabet="pq", max_size=2)})


# ---------------------------------------------------------------------------
# the model


def _leaves(tree):
    """Every (path, value) below an object whose value is no object."""
    todo = [((k,), v) for k, v in tree.items()]
    for path, value in todo:
        if isinstance(value, dict):
            todo.extend(((*path, k), v) for k, v in value.items())
        else:
            yield path, value


def _name(path, sep):
    """Keys joined by ``sep``; nothing is joined to an empty beginning."""
    first = next((i for i, k in enumerate(path) if k), len(path) - 1)
    return sep.join(path[first:])


def _columns(tree, sep="_"):
    """Values by column name; of paths with one name the deepest that has a value counts."""
    by_name = {}
    for path, value in sorted(_leaves(tree), key=lambda leaf: -len(leaf[0])):
        if by_name.get(name := _name(path, sep)) is None:
            by_name[name] = _items(value, sep) if isinstance(value, list) else value
    return by_name


def _items(values, sep):
    """Lists keep their objects, flattened on their own; inside lists of lists by ``__``."""
    return [_columns(x, sep) if isinstance(x, dict) else _items(x, "__") if isinstance(x, list) else x for x in values]


def _fill(rows):
    """Union of keys across rows and across list elements; missing -> None."""
    cols = sorted({k for r in rows for k in r})
    out = []
    for r in rows:
        out.append({c: r.get(c) for c in cols})
    for c in cols:
        vals = [r[c] for r in out if isinstance(r[c], list)]
        dict_keys = {k for lst in vals for x in lst if isinstance(x, dict) for k in x}
        nested_keys = {k for lst in vals for x in lst if isinstance(x, list)
                       for y in x if isinstance(y, dict) for k in y}
        for r in out:
            if isinstance(r[c], list):
                r[c] = [{k: x.get(k) for k in dict_keys} if isinstance(x, dict) else
                        [{k: y.get(k) for k in nested_keys} for y in x] if isinstance(x, list) else x
                        for x in r[c]]
    return out


def _norm(v):
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_norm(x) for x in v]
    return v


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_obj(2), min_size=1, max_size=4))
def test_flatten_matches_model(run_lines, events):
    lines = [json.dumps(e, ensure_ascii=False) for e in events]
    rows, schema, reasons = run_lines(lines)
    assert reasons == [None] * len(events)
    expected = _fill([_columns(e) for e in events])
    got = [{k: _norm(v) for k, v in r.items() if k != "event_timestamp_ms"} for r in rows]
    key = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, expected))
