"""JSON text -> VARIANT helpers.

``try_parse_json`` alone is lenient: it accepts a valid value followed by
trailing text. ``strict_parse`` wraps the text twice so that exactly one JSON
value must fill the whole string (the behaviour of a strict JSON reader):

* ``[`` text ``]`` must be an array of size 1 — rejects ``{"a":1} xyz``;
* ``{"v":`` text ``}`` must be an object whose only key is ``v`` — rejects
  ``{"a":1}] [``, which the first wrapper lets through.

Each wrapper alone lets one of those shapes through; together they do not.
NaN / Infinity, single quotes, leading zeros and a BOM are already rejected by
the parser itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_parts(text: Column) -> tuple[Column, Column]:
    """The two expensive pieces of ``strict_parse``: the ``[`` wrapper's parse and
    the ``{"v":`` wrapper's verdict (parsed only for texts containing ``]``, the
    only character that can close the first wrapper early)."""
    arr = F.call_function("try_parse_json", F.concat(F.lit("["), text, F.lit("]")))
    obj_ok = (F.instr(text, "]") == 0) | \
        F.call_function("try_parse_json", F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return arr, obj_ok


def strict_value(arr: Column, obj_ok: Column) -> Column:
    """Combine the pieces of ``strict_parts`` (cheap: no parsing)."""
    one = arr.isNotNull() & F.call_function("try_variant_get", arr, F.lit("$[1]"), F.lit("variant")).isNull()
    return F.when(one & obj_ok, F.call_function("try_variant_get", arr, F.lit("$[0]"), F.lit("variant")))


def strict_parse(text: Column) -> Column:
    """VARIANT of ``text`` if it is exactly one JSON value, else NULL.

    As one expression the wrapper parse appears three times; projections share
    it (common subexpressions), but generators and filters do not — where that
    matters, compute ``strict_parts`` once and ``strict_value`` from its output
    (as ``guards.classify`` does).
    """
    return strict_value(*strict_parts(text))


def variant_kind(v: Column) -> Column:
    """'object', 'array', 'null', 'string', 'boolean', 'number' or NULL (absent).

    One ``schema_of_variant`` call; meant for small values (not whole events).
    """
    s = F.substring(F.call_function("schema_of_variant", v), 1, 3)
    kinds = F.create_map(*[F.lit(x) for x in (
        "OBJ", "object", "ARR", "array", "VOI", "null", "STR", "string", "BOO", "boolean")])
    return F.when(v.isNotNull(), F.coalesce(F.element_at(kinds, s), F.lit("number")))


def is_object(v: Column) -> Column:
    """TRUE when ``v`` is a JSON object (FALSE for anything else, SQL NULL included).

    A cast to an empty struct succeeds exactly for objects and reads none of
    their fields, unlike ``schema_of_variant``, which walks the whole value.
    """
    return F.call_function("try_variant_get", v, F.lit("$"), F.lit("struct<>")).isNotNull()


def is_null_value(v: Column) -> Column:
    """SQL NULL or JSON null."""
    return v.isNull() | F.coalesce(F.call_function("is_variant_null", v), F.lit(True))


def sql_text(text: str) -> str:
    """``text`` as a SQL string expression. ``${`` is cut apart, because the SQL parser
    would substitute a variable there even inside a literal."""
    parts = ["'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for x in text.replace("${", "$\0{").split("\0")] \
        if "${" in text and "\0" not in text else None
    if parts is None:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "concat(" + ", ".join(parts) + ")"


def _in_path(key: str) -> bool:
    """Variant paths have no escapes: a key with a backslash, or with both kinds of quotes,
    cannot be written in one."""
    return "\\" not in key and not ("'" in key and '"' in key) and "${" not in key


def path_of(keys) -> str:
    """Variant path for a key sequence, quoting every key (dots, spaces, '$')."""
    return "$" + "".join(f"['{k}']" if '"' in k else f'["{k}"]' for k in keys)


def get_sql(v: str, keys, dtype: str = "variant") -> str:
    """SQL text of ``get_path`` on the expression ``v``. Keys that no path can hold are read
    from their parent as a map."""
    path: list[str] = []
    for k in keys:
        if _in_path(k):
            path.append(k)
        else:
            v = f"try_element_at(try_variant_get({v}, {sql_text(path_of(path))}, 'map<string,variant>'), {sql_text(k)})"
            path = []
    return f"try_variant_get({v}, {sql_text(path_of(path))}, {sql_text(dtype)})"


def get_path(v: Column, keys, dtype: str = "variant") -> Column:
    """``try_variant_get`` at a key path (NULL when absent or not castable)."""
    path: list[str] = []
    for k in keys:
        if _in_path(k):
            path.append(k)
        else:
            parent = F.call_function("try_variant_get", v, F.lit(path_of(path)), F.lit("map<string,variant>"))
            v, path = F.try_element_at(parent, F.lit(k)), []
    return F.call_function("try_variant_get", v, F.lit(path_of(path)), F.lit(dtype))
