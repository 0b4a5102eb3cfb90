"""Flatten a VARIANT event into columns (P1 object flatten, P2 lists of objects, P3 lists of lists).

Semantics (driven by the resolved schema of ``operators.schema``):

* P1 — nested object keys are joined with ``sep`` (``_``): ``{"a":{"b":1}}`` gives
  ``a_b``. An empty key adds no prefix for its children; ``{}`` gives no column;
  primitives, nulls and lists of primitives stay as they are.
* P2 — a list of objects becomes ARRAY<STRUCT>; each element is flattened with
  ``sep`` and *no* parent prefix: ``{"l":[{"p":{"q":1}}]}`` gives ``l = [{p_q: 1}]``.
* P3 — below a list of lists every join uses ``inner_sep`` (``__``):
  ``{"l":[[{"p":{"q":1}}]]}`` gives ``l = [[{p__q: 1}]]``.
* A path holding objects in some rows and other values in others gives both the
  flattened object columns and a column for the other values.
* Two paths that flatten to one name are coalesced, deeper path first.
* Columns are ordered by name (object keys carry no order in a VARIANT).

Every value is read with ``try_variant_get`` — built-in, code-generated, no
Python per row — so the projection is one narrow, shuffle-free stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from eventlake.functions.jsonvalue import get_sql, sql_text
from eventlake.operators.schema import scalar_type
from eventlake.session import conf_scope

SEP = "_"
INNER_SEP = "__"


@dataclass
class _Out:
    """A flattened value: its name, the SQL text that reads it (empty when only the schema
    is asked for), its type, and how deep its key path is."""

    name: str
    sql: str
    dtype: DataType
    depth: int


def _join(prefix: str, key: str, sep: str) -> str:
    return f"{prefix}{sep}{key}" if prefix else key


def _value(v: str, keys: tuple[str, ...], dt: DataType, sep: str, inner: bool, level: int) -> tuple[str, DataType]:
    """SQL of a non-object value at ``keys`` of variant ``v``."""
    if isinstance(dt, ArrayType):
        return _array(get_sql(v, keys, "array<variant>") if v else "", dt, sep, inner, level)
    return (get_sql(v, keys, dt.simpleString()) if v else ""), dt


def _array(arr: str, dt: ArrayType, sep: str, inner: bool, level: int) -> tuple[str, DataType]:
    """ARRAY<VARIANT> -> typed array, flattening object elements. ``level`` counts the
    enclosing lambdas, so that each names its own variable."""
    e, x = dt.elementType, f"x{level}" if arr else ""
    if isinstance(e, StructType):
        cols = _resolve(_walk(x, (), "", e, INNER_SEP if inner else sep, inner, 0, level + 1))
        etype = StructType([StructField(n, t, True) for n, _, t in cols])
        fields = ", ".join(f"{sql_text(n)}, {c}" for n, c, _ in cols)
        null = f"({x} IS NULL OR coalesce(is_variant_null({x}), true))"
        item = f"CASE WHEN NOT {null} THEN named_struct({fields}) END"
    elif isinstance(e, ArrayType):
        # A list of lists: everything below is the "__" region.
        item, etype = _array(f"try_variant_get({x}, '$', 'array<variant>')" if arr else "", e, sep, True, level + 1)
    else:
        item, etype = f"try_variant_get({x}, '$', {sql_text(e.simpleString())})", e
    return (f"transform({arr}, {x} -> {item})" if arr else ""), ArrayType(etype, True)


def _walk(v: str, keys: tuple[str, ...], prefix: str, st: StructType, sep: str, inner: bool, depth: int, level: int) -> list[_Out]:
    out: list[_Out] = []
    for f in st.fields:
        name, path = _join(prefix, f.name, sep), keys + (f.name,)
        other = f.dataType
        if isinstance(f.dataType, StructType):
            out.extend(_walk(v, path, name, f.dataType, sep, inner, depth + 1, level))
            other = scalar_type(f)
        if other is not None:
            c, t = _value(v, path, other, sep, inner, level)
            if isinstance(f.dataType, StructType) and v:
                c = f"CASE WHEN {get_sql(v, path, 'struct<>')} IS NULL THEN {c} END"
            out.append(_Out(name, c, t, depth))
    return out


def _resolve(outs: list[_Out]) -> list[tuple[str, str, DataType]]:
    """Group equal names: coalesce deeper paths first; mixed types become STRING."""
    groups: dict[str, list[_Out]] = {}
    for o in outs:
        groups.setdefault(o.name, []).append(o)
    res = []
    for name in sorted(groups):
        g = sorted(groups[name], key=lambda o: -o.depth)
        if len(g) == 1:
            res.append((name, g[0].sql, g[0].dtype))
            continue
        dt = g[0].dtype if len({o.dtype for o in g}) == 1 else StringType()
        texts = [o.sql if o.dtype == dt else
                 f"to_json({o.sql})" if isinstance(o.dtype, (ArrayType, StructType)) else f"CAST({o.sql} AS STRING)" for o in g]
        res.append((name, f"coalesce({', '.join(texts)})", dt))
    return res


def flatten_columns(v: str, schema: StructType, sep: str = SEP) -> list[tuple[str, str, DataType]]:
    """(name, SQL text, type) of every flattened column of variant column ``v``, by name."""
    return _resolve(_walk(quoted(v), (), "", schema, sep, False, 0, 0))


def paths_to(schema: StructType, name: str, sep: str = SEP) -> list[tuple[str, ...]]:
    """Key paths whose values flatten to the column ``name``."""

    def walk(st: StructType, keys: tuple[str, ...], prefix: str) -> list[tuple[str, ...]]:
        out = []
        for f in st.fields:
            full, path = _join(prefix, f.name, sep), keys + (f.name,)
            if full == name:
                out.append(path)
            if isinstance(f.dataType, StructType) and (not full or name.startswith(full)):
                out.extend(walk(f.dataType, path, full))
        return out

    return walk(schema, (), "")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _case_collisions(dt: DataType) -> bool:
    """True when some struct level has two names equal up to case."""
    if isinstance(dt, StructType):
        lower = [f.name.lower() for f in dt.fields]
        if len(set(lower)) != len(lower):
            return True
        return any(_case_collisions(f.dataType) for f in dt.fields)
    if isinstance(dt, ArrayType):
        return _case_collisions(dt.elementType)
    return False


def case_scope(spark, schema: StructType):
    """A scope in which Spark tells names apart that differ only by case, if ``schema`` has
    such names (JSON keys may); otherwise a scope without effect."""
    return conf_scope(spark, **({"spark.sql.caseSensitive": "true"} if _case_collisions(schema) else {}))


def flatten(df: DataFrame, schema: StructType, v: str = "v", sep: str = SEP,
            keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Select the flattened columns of variant column ``v`` (plus ``keep``).

    Columns are built as SQL text in one projection: building thousands of them one by one
    would occupy the driver for many seconds.
    """
    cols = flatten_columns(v, schema, sep)
    names = {n for n, _, _ in cols}
    keep = [quoted(k) for k in keep if k not in names]
    with case_scope(df.sparkSession, StructType([StructField(n, t) for n, _, t in cols])):
        if any("${" in n for n in names):  # an alias the SQL parser would substitute in
            return df.select(*keep, *[F.expr(c).alias(n) for n, c, _ in cols])
        return df.selectExpr(*keep, *[f"{c} AS {quoted(n)}" for n, c, _ in cols])


def flattened_schema(schema: StructType, sep: str = SEP) -> StructType:
    """Output schema of ``flatten`` for a resolved event schema."""
    return StructType([StructField(n, t, True) for n, _, t in _resolve(_walk("", (), "", schema, sep, False, 0, 0))])
