"""Schema operators: union-of-keys inference (C1), conform (C2), merge across batches.

C1 itself is in ``operators.paths``: executors unite the (path, kind) pairs of all records, so
that ``{"a":{"b":1}}`` and ``{"a":2}`` give both ``a_b`` and ``a`` (the flattening semantics)
instead of one lossy column. Here are the rules for types.

The resolved schema is an ordinary ``StructType``. A path that holds objects in
some rows and other values in others is a struct field (the object part) whose
metadata key ``eventlake.scalar`` carries the DDL type of the other values.
Types are widened so every file of the lake gets the same, stable types:

=====================  ============================================
inferred                stored
=====================  ============================================
BIGINT                  BIGINT
DECIMAL(p,0), p <= 18   DOUBLE (a number written with a fraction mark, as 1.0)
DECIMAL(p,0), p > 18    STRING (JSON text of the number)
DECIMAL(p,s>0), FLOAT   DOUBLE
VOID (only nulls)       STRING
VARIANT (mixed)         STRING (JSON text; bare text for strings)
OBJECT<>                no column
ARRAY<VARIANT>          ARRAY<STRING>
ARRAY<OBJECT<>>         ARRAY<STRING>
=====================  ============================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DecimalType, DoubleType, FloatType, LongType,
    IntegerType, ShortType, ByteType, NullType, StringType, StructField, StructType,
    VariantType, _parse_datatype_string,
)

SCALAR_KEY = "eventlake.scalar"
ALT_KEY = "eventlake.alt_of"
NAME_KEY = "eventlake.key"  # on a column that could not be named like its event key


# ---------------------------------------------------------------------------
# DDL conversion


def _object_to_struct(ddl: str) -> str:
    """Rename variant ``OBJECT<`` to ``STRUCT<`` outside back-quoted names."""
    out, i, n = [], 0, len(ddl)
    while i < n:
        c = ddl[i]
        if c == "`":
            j = i + 1
            while j < n:
                if ddl[j] == "`":
                    if j + 1 < n and ddl[j + 1] == "`":
                        j += 2
                        continue
                    break
                j += 1
            out.append(ddl[i:j + 1])
            i = j + 1
        elif ddl.startswith("OBJECT<", i):
            out.append("STRUCT<")
            i += len("OBJECT<")
        else:
            out.append(c)
            i += 1
    return "".join(out)


def variant_ddl_to_type(ddl: str | None) -> DataType | None:
    """Type string from ``schema_of_variant(_agg)`` -> Spark DataType (Spark parses it)."""
    if ddl is None:
        return None
    return _parse_datatype_string(_object_to_struct(ddl))


def type_ddl(dt: DataType) -> str:
    """DDL string usable as the target type of ``try_variant_get``."""
    return dt.simpleString()


# ---------------------------------------------------------------------------
# Normalisation (widening)


def _scalar(dt: DataType, in_array: bool) -> DataType | None:
    if isinstance(dt, (NullType, VariantType)):
        return StringType()
    if isinstance(dt, DecimalType):
        if dt.scale == 0:
            # whole numbers in BIGINT range are inferred as BIGINT, so a short decimal had a mark
            return DoubleType() if dt.precision <= 18 else StringType()
        return DoubleType()
    if isinstance(dt, (FloatType, DoubleType)):
        return DoubleType()
    if isinstance(dt, (IntegerType, ShortType, ByteType, LongType)):
        return LongType()
    return dt


def normalize(dt: DataType, in_array: bool = False) -> DataType | None:
    """Widen an inferred type; None means "no column" (empty object)."""
    if isinstance(dt, StructType):
        fields = []
        for f in dt.fields:
            meta = dict(f.metadata or {})
            if isinstance(f.dataType, VariantType) and in_array:
                fields.append(StructField(f.name, StringType(), True))
                continue
            sub = normalize(f.dataType, in_array)
            if SCALAR_KEY in meta:
                obj = sub if isinstance(sub, StructType) else StructType([])
                fields.append(StructField(f.name, obj, True, meta))
            elif sub is not None:
                fields.append(StructField(f.name, sub, True))
        if not fields:
            return None
        return StructType(fields)
    if isinstance(dt, ArrayType):
        e = dt.elementType
        if isinstance(e, StructType):
            ne = normalize(e, in_array=True)
            return ArrayType(ne if ne is not None else StringType(), True)
        if isinstance(e, ArrayType):
            ne = normalize(e, in_array=True)
            return ArrayType(ne if ne is not None else StringType(), True)
        return ArrayType(_scalar(e, True), True)
    return _scalar(dt, in_array)


# ---------------------------------------------------------------------------
# Union of inferred types

def _decimal_shape(dt: DataType) -> tuple[int, int] | None:
    """(integer digits, scale) of a number type in the decimal lattice; BIGINT
    counts as 20 integer digits, as variant schema merging treats it."""
    if isinstance(dt, LongType):
        return 20, 0
    if isinstance(dt, DecimalType):
        return dt.precision - dt.scale, dt.scale
    return None


def merge_variant_types(a: DataType | None, b: DataType | None) -> DataType | None:
    """Union of two ``schema_of_variant`` types under the rules of ``schema_of_variant_agg``.

    VOID yields to anything and VARIANT absorbs anything; objects take the union
    of their keys (merged per key); arrays merge their element types; BIGINT and
    decimals widen to a decimal holding both (DOUBLE beyond 38 digits); DOUBLE
    with any number stays DOUBLE; every other mix is VARIANT.
    """
    if a is None:
        return b
    if b is None:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if isinstance(a, VariantType) or isinstance(b, VariantType):
        return VariantType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        fa = {f.name: f.dataType for f in a.fields}
        fb = {f.name: f.dataType for f in b.fields}
        return StructType([StructField(n, merge_variant_types(fa.get(n), fb.get(n)), True)
                           for n in sorted(set(fa) | set(fb))])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merge_variant_types(a.elementType, b.elementType), True)
    if a == b:
        return a
    if isinstance(a, DoubleType) and _decimal_shape(b) or isinstance(b, DoubleType) and _decimal_shape(a):
        return DoubleType()
    da, db = _decimal_shape(a), _decimal_shape(b)
    if da and db:
        digits, scale = max(da[0], db[0]), max(da[1], db[1])
        return DoubleType() if digits + scale > 38 else DecimalType(digits + scale, scale)
    return VariantType()


def scalar_type(f: StructField) -> DataType | None:
    meta = f.metadata or {}
    if SCALAR_KEY not in meta:
        return None
    return normalize(_parse_datatype_string(meta[SCALAR_KEY]))


# ---------------------------------------------------------------------------
# C2


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order; missing ones NULL, others cast.

    Columns not in ``schema`` are dropped (keep ``raw_event`` in the pinned
    schema to lose nothing).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(cast_into(_named(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in schema.fields])


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def cast_into(c: Column, src: DataType, dst: DataType, same_kind: bool = False) -> Column:
    """Cast that never fails a job. Structs are rebuilt by field name (missing ones NULL),
    lists element by element, nested values become JSON text where text is wanted; what
    does not fit is NULL. With ``same_kind`` text or a truth value is no number, nor the
    reverse."""
    if src == dst:
        return c
    if isinstance(src, NullType):
        return F.lit(None).cast(dst)
    nested = isinstance(src, (StructType, ArrayType))
    if isinstance(dst, StringType):
        return F.to_json(c) if nested else c.cast("string")
    if isinstance(src, ArrayType) and isinstance(dst, ArrayType):
        return F.transform(c, lambda x: cast_into(x, src.elementType, dst.elementType, same_kind))
    if isinstance(src, StructType) and isinstance(dst, StructType):
        have = {f.name: f.dataType for f in src.fields}
        return F.when(c.isNotNull(), F.struct(*[
            (cast_into(c.getField(f.name), have[f.name], f.dataType, same_kind) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dst.fields]))
    if nested or isinstance(dst, (StructType, ArrayType)) or same_kind and not (type(src) in _NUM_RANK and type(dst) in _NUM_RANK):
        return F.lit(None).cast(dst)
    return c.try_cast(dst)


# ---------------------------------------------------------------------------
# C3

_NUM_RANK = {LongType: 1, DoubleType: 2}


def widen_type(a: DataType, b: DataType) -> DataType:
    """Common type of two stored types (never narrower than either)."""
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if type(a) in _NUM_RANK and type(b) in _NUM_RANK:
        return DoubleType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widen_type(a.elementType, b.elementType), True)
    return StringType()


def _union(a: StructType, b: StructType, both) -> StructType:
    """Fields of ``a``, then the further ones of ``b``; ``both`` settles a shared one's type."""
    other = {f.name: f for f in b.fields}
    fields = [StructField(f.name, both(f.dataType, other[f.name].dataType) if f.name in other else f.dataType, True, f.metadata) for f in a.fields]
    names = {f.name for f in a.fields}
    return StructType(fields + [StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name not in names])


def merge_schemas(a: StructType, b: StructType) -> StructType:
    """Union of fields; first-seen order; conflicting types widened."""
    return _union(a, b, widen_type)


def evolve_type(stored: DataType, new: DataType) -> DataType:
    """Type of a stored column after a batch of type ``new``. Parquet files do not change
    their types, so a scalar stays what it is; structs, also inside lists, gain fields (older
    files read NULL there)."""
    if isinstance(stored, NullType):
        return new
    if isinstance(stored, StructType) and isinstance(new, StructType):
        return _union(stored, new, evolve_type)
    if isinstance(stored, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(evolve_type(stored.elementType, new.elementType), True)
    return stored


def holds_all(src: DataType, dst: DataType) -> bool:
    """Whether every value of ``src`` survives ``cast_into`` to ``dst``."""
    if src == dst or isinstance(src, NullType) or isinstance(dst, StringType):
        return True
    if isinstance(src, ArrayType) and isinstance(dst, ArrayType):
        return holds_all(src.elementType, dst.elementType)
    if isinstance(src, StructType) and isinstance(dst, StructType):
        to = {f.name: f.dataType for f in dst.fields}
        return all(f.name in to and holds_all(f.dataType, to[f.name]) for f in src.fields)
    return False


def _lake_names(columns: list[str], stored: StructType, partition_cols) -> dict[str, str]:
    """Name in the lake of each event column. Names that differ only by case would be one
    column to Spark by default, so a later one gets trailing underscores, and its metadata
    keeps the key; a column known to the lake keeps its name."""
    key_of = {f.name: (f.metadata or {}).get(NAME_KEY, None if ALT_KEY in (f.metadata or {}) else f.name) for f in stored.fields}
    known = {key: name for name, key in key_of.items() if key is not None}
    names = {c: c if c in partition_cols else known[c] for c in columns if c in partition_cols or c in known}
    taken = {n.lower() for n in [*key_of, *partition_cols]}
    for c in columns:
        if c not in names:
            names[c] = c
            while names[c].lower() in taken:
                names[c] += "_"
            taken.add(names[c].lower())
    return names


def evolve_frame(df: DataFrame, stored: StructType | None, partition_cols: list[str] = ()) -> tuple[DataFrame, StructType]:
    """(``df`` as it can be appended, schema of the lake afterwards). No batch is refused
    and no value lost: each stored column keeps its type, gains new fields inside structs,
    and takes the values that survive the cast whole; the others are NULL there and go as
    text (JSON for lists) to a column beside it, ``<name>__alt``, whose metadata names the
    column it belongs to. Columns that differ only by case are told apart
    (``_lake_names``); ``df`` is read in the scope of ``flatten.case_scope``."""
    stored = stored if stored is not None else StructType([])
    old = {f.name: f.dataType for f in stored.fields}
    names = _lake_names(df.columns, stored, partition_cols)
    alts = {(f.metadata or {}).get(ALT_KEY): f.name for f in stored.fields}
    taken = {n.lower() for n in [*old, *names.values()]}
    cols, fields = [], []
    for f in df.schema.fields:
        c, name = _named(f.name), names[f.name]
        if f.name in partition_cols:
            cols.append(c)
            continue
        meta = {NAME_KEY: f.name} if name != f.name else {}
        to = evolve_type(old[name], f.dataType) if name in old else f.dataType
        value = cast_into(c, f.dataType, to, same_kind=True)
        fields.append(StructField(name, to, True, meta))
        if holds_all(f.dataType, to):
            cols.append(value.alias(name, metadata=meta))
            continue
        alt = alts.get(name, name + "__alt")
        while name not in alts and alt.lower() in taken:
            alt += "_"
        taken.add(alt.lower())
        kept = cast_into(value, to, f.dataType).eqNullSafe(c)
        cols.append(F.when(kept, value).alias(name, metadata=meta))
        cols.append(F.when(c.isNotNull() & ~kept, cast_into(c, f.dataType, StringType())).alias(alt, metadata={ALT_KEY: name}))
        fields.append(StructField(alt, StringType(), True, {ALT_KEY: name}))
    # ``fields`` hold the settled types already
    return df.select(*cols), _union(stored, StructType(fields), lambda _, settled: settled)
