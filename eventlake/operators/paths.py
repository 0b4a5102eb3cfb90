"""C1 by paths: the schema of a batch as a union of (path, kind) pairs, made in executors.

A record's shape (``schema_of_variant``) says which paths it has and of what kind, except
inside lists whose elements disagree. So one pass over the records counts distinct shapes,
map-side first; records with such a list stand for themselves, with their text. Shapes are
then taken apart into pairs, one row per leaf, and united by path: all in the same job, whose
rows are distinct shapes and no longer records. What reaches the driver is the final list, at
most a few rows per path. Paths that hold objects in some records and other values in others
need no further pass: both kinds are in the list.

A path is an array of steps: ``k`` and the key for a member of an object, ``a`` for the
elements of a list. Kinds are object, list and the scalar types of variants; decimals
are united by their digits before and after the point.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField, StructType, VariantType,
)

from eventlake.operators.schema import SCALAR_KEY, merge_variant_types, type_ddl
from eventlake.session import scratch_path

OBJECT, LIST, DEEPER = "OBJECT", "ARRAY", "DEEPER"
SHAPE, OWN_TEXT = "__shape", "__own_text"
DEPTH = 8  # levels that one plan takes apart

# Tokens of a shape's text: names in back quotes, opening marks, bare names and types, marks.
_TOKEN = r"`[^`]*+(?:``[^`]*+)*+`|OBJECT<|ARRAY<|\w++(?:\(\d+, ?\d+\))?+|[:,>]"


def with_shape(classified: DataFrame, value: str = "value") -> DataFrame:
    """Adds the shape of good records and whether it is the record's own text, since a list
    in it mixes kinds. Generators keep the schema walk from running twice (as in ``classify``)."""
    shaped = classified.withColumn(SHAPE, F.explode(F.array(
        F.when(F.col("reason").isNull(), F.call_function("schema_of_variant", F.col("v"))))))
    mixed = F.coalesce(F.instr(SHAPE, "VARIANT") > 0, F.lit(False))
    return shaped.select(*[F.col(f"`{c}`") for c in classified.columns], mixed.alias(OWN_TEXT),
                         F.when(mixed, F.col(value).cast("string")).otherwise(F.col(SHAPE)).alias(SHAPE))


def _skeleton(shape: Column) -> Column:
    """A shape's text as JSON: objects by ``k`` and key, lists as ``{"a": element}``, types as text."""
    def as_json(t: Column) -> Column:
        name = F.when(F.substring(t, 1, 1) == "`", F.replace(t.substr(F.lit(2), F.length(t) - 2), F.lit("``"), F.lit("`"))).otherwise(t)
        text = F.to_json(F.array(F.concat(F.lit("k"), name)))
        return (F.when(t == "OBJECT<", "{").when(t == "ARRAY<", '{"a":').when(t == ">", "}").when(t.isin(":", ","), t)
                .otherwise(text.substr(F.lit(2), F.length(text) - 2)))
    return F.array_join(F.transform(F.regexp_extract_all(shape, F.lit(_TOKEN), F.lit(0)), as_json), "")


# A leaf's kind: a record's own value is asked, a skeleton says it.
_KIND = """regexp_replace(IF(own OR schema_of_variant(v) <> 'STRING', schema_of_variant(v),
  substring(try_variant_get(v, '$', 'string'), 2)), '<.*', '')"""
# One level: a node's members or elements in its place; what has none stays, with its kind. The
# count goes with the first.
_LEVEL = f"""SELECT
  IF(step IS NULL, path, array_append(path, step)) AS path, value AS v,
  CASE WHEN step IS NOT NULL THEN IF(value IS NULL, 'VOID', NULL) WHEN v IS NULL THEN kind ELSE {_KIND} END AS kind,
  own, IF(pos > 0, 0, n) AS n
FROM ({{}}) LATERAL VIEW OUTER inline(coalesce(
  transform(map_entries(try_variant_get(v, '$', 'map<string,variant>')), (e, i) ->
    named_struct('step', IF(own, concat('k', e.key), e.key), 'value', e.value, 'pos', i)),
  transform(try_variant_get(v, '$', 'array<variant>'), (x, i) ->
    named_struct('step', 'a', 'value', x, 'pos', i)))) e AS step, value, pos"""


def shapes_of(shaped: DataFrame) -> DataFrame:
    """(reason, own, shape, n): the distinct shapes and outcomes, counted map-side first."""
    return shaped.groupBy("reason", F.col(OWN_TEXT).alias("own"), F.col(SHAPE).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def nodes_of(shapes: DataFrame) -> DataFrame:
    """(path, v, kind, own, n): the roots of the shapes; other outcomes have a kind and no path."""
    good = F.col("reason").isNull()
    text = F.when(F.col("own"), F.col("shape")).otherwise(_skeleton(F.col("shape")))
    return shapes.select(
        F.when(good, F.array().cast("array<string>")).alias("path"), F.when(good, F.try_parse_json(text)).alias("v"),
        F.col("reason").alias("kind"), "own", "n")


def _levels_below(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The nodes ``depth`` levels below, and the leaves above them, each with its kind."""
    sql = "SELECT * FROM {nodes}"
    for _ in range(depth):
        sql = _LEVEL.format(sql)
    return nodes.sparkSession.sql(f"SELECT path, v, coalesce(kind, IF({_KIND} IN ('{OBJECT}', '{LIST}'), '{DEEPER}', {_KIND})) AS kind, own, n "
                                  f"FROM ({sql})", nodes=nodes)


def _united(leaves: DataFrame) -> DataFrame:
    number = "regexp_extract(kind, '^DECIMAL[(](\\\\d+), ?(\\\\d+)[)]$', {})"
    return leaves.sparkSession.sql(f"""
        SELECT path, IF(kind LIKE 'DECIMAL%', 'DECIMAL', kind) AS kind, max(precision - scale) AS digits, max(scale) AS scale, sum(n) AS n
        FROM (SELECT *, CAST(nullif({number.format(1)}, '') AS INT) AS precision, CAST(nullif({number.format(2)}, '') AS INT) AS scale
              FROM {{leaves}})
        GROUP BY path, IF(kind LIKE 'DECIMAL%', 'DECIMAL', kind)""", leaves=leaves)


def path_kinds(shapes: DataFrame) -> DataFrame:
    """(path, kind, digits, scale, n): the leaves of all shapes, united; an empty object or list
    is a leaf, and so is, as DEEPER, what lies ``DEPTH`` levels down. The sum of ``n`` is the
    number of records; other outcomes than good records come as rows without a path."""
    return _united(_levels_below(nodes_of(shapes)))


def collect_pairs(shapes: DataFrame) -> tuple[list[tuple], dict[str, int]]:
    """The final list of pairs (path, kind, digits, scale), and records by outcome. Below ``DEPTH``
    levels the nodes that are left are written, and taken apart from there."""
    nodes, rows = nodes_of(shapes), []
    while True:
        below = _levels_below(nodes)
        found = _united(below).collect()
        rows += [r for r in found if r.kind != DEEPER]
        if all(r.kind != DEEPER for r in found):
            break
        where = scratch_path(shapes.sparkSession, "nodes")
        below.where(F.col("kind") == DEEPER).select("path", "v", "own", "n").write.parquet(where)
        nodes = shapes.sparkSession.read.parquet(where).select("path", "v", F.lit(None).cast("string").alias("kind"), "own", "n")
    return [(tuple(r.path), r.kind, r.digits, r.scale) for r in rows if r.path is not None], outcomes(rows)


def outcomes(rows: Iterable) -> dict[str, int]:
    """Records by outcome, of rows of ``path_kinds``."""
    out: dict[str, int] = {}
    for r in rows:
        key = "ok" if r.path is not None else r.kind
        out[key] = out.get(key, 0) + r.n
    return {k: n for k, n in out.items() if n}


# --- the final list as a type ------------------------------------------------------------

_SCALARS = {"BIGINT": LongType(), "DOUBLE": DoubleType(), "STRING": StringType(), "BOOLEAN": BooleanType(), "VOID": NullType()}


class Node:
    """What is known of one path."""

    def __init__(self):
        self.members: dict[str, Node] | None = None
        self.element: Node | None = None
        self.scalar: DataType | None = None  # NullType: only nulls

    def others(self) -> DataType:
        """The united type of what is no object: VARIANT if kinds differ."""
        kinds = [t for t in (self.scalar, ArrayType(self.element.plain(), True) if self.element else None)
                 if t is not None and not isinstance(t, NullType)]
        return NullType() if not kinds else kinds[0] if len(kinds) == 1 else VariantType()

    def plain(self) -> DataType:
        """The united type, VARIANT where kinds differ."""
        if self.members is None:
            return self.others()
        if not isinstance(self.others(), NullType):
            return VariantType()
        return StructType([StructField(k, self.members[k].plain(), True) for k in sorted(self.members)])

    def settled(self) -> DataType:
        """As ``plain``, but members that hold objects in some records and other values in
        others, or several kinds of these, keep both parts."""
        kind = self.plain()
        if isinstance(kind, StructType):
            return self._struct()
        if isinstance(kind, ArrayType):
            return ArrayType(self.element.settled(), True)
        return kind

    def _struct(self) -> StructType:
        fields = []
        for key in sorted(self.members or {}):
            m = self.members[key]
            if isinstance(m.plain(), VariantType):
                fields.append(StructField(key, m._struct(), True, {SCALAR_KEY: type_ddl(m.others())}))
            else:
                fields.append(StructField(key, m.settled(), True))
        return StructType(fields)


def schema_of_pairs(pairs: Iterable[tuple]) -> StructType:
    """The resolved variant schema (see ``operators.schema``) of a list of pairs."""
    return tree_of(pairs)._struct()


def tree_of(pairs: Iterable[tuple]) -> Node:
    root = Node()
    for path, kind, digits, scale in pairs:
        node = root
        for step in path:
            if step[0] == "a":
                node.element = node.element or Node()
                node = node.element
            else:
                node.members = {} if node.members is None else node.members
                node = node.members.setdefault(step[1:], Node())
        if kind == OBJECT:
            node.members = {} if node.members is None else node.members
        elif kind == LIST:
            node.element = node.element or Node()
        else:
            if kind == "DECIMAL":
                dt = DoubleType() if digits + scale > 38 else DecimalType(digits + scale, scale)
            else:
                dt = _SCALARS.get(kind, VariantType())
            node.scalar = merge_variant_types(node.scalar, dt)
    return root
