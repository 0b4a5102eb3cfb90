"""Record guards (G1-G6). A failing record is quarantined with a reason, never fails the batch.

``classify`` adds two columns to a frame of raw records:

* ``v``      — the parsed event (VARIANT); meaningful where ``reason`` is NULL;
* ``reason`` — NULL for good records, else the first failing guard in priority
  order ``oversize``, ``bad_utf8``, ``bad_json``, ``not_object``, ``bad_time_us``.

The expensive parse runs once per record (and not at all for oversize or
non-UTF-8 records, because CASE short-circuits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.jsonvalue import (
    get_path, is_object, strict_parts, strict_value, variant_kind,
)

# Guard limits and reason labels.
MAX_MESSAGE_BYTES = 10 * 1024 * 1024
REASONS = ("oversize", "bad_utf8", "bad_json", "not_object", "bad_time_us")

# JSON paths that flatten to the ``time_us`` column and so must hold a number. Empty keys
# give any number of further ones; ``plans.ingest.prepare`` takes those from the schema.
TIME_US_PATHS = (("time_us",), ("time", "us"))


def guard_size(value: Column, max_bytes: int = MAX_MESSAGE_BYTES) -> Column:
    """TRUE when the record fits the message size cap."""
    return F.octet_length(value) <= F.lit(int(max_bytes))


def guard_utf8(value: Column) -> Column:
    """G1: TRUE when the bytes are valid UTF-8 (no re-encoding on the way)."""
    return F.call_function("is_valid_utf8", value.cast("string"))


def guard_time_us(v: Column, paths=TIME_US_PATHS) -> Column:
    """``time_us`` must be a number when present (absent or an object is fine).

    An explicit null, a string, a list or a boolean would fail the ms
    derivation, so the record is rejected; absence just means no derived column.
    """
    ok = F.lit(True)
    for path in paths:
        k = variant_kind(get_path(v, path))
        ok = ok & (k.isNull() | k.isin("number", "object"))
    return ok


def guard_object(v: Column) -> Column:
    """The parsed event must be a JSON object (arrays, scalars and null are rejected).

    Applied after G3 on the parsed value: a typed check of its kind, without
    re-reading the text or walking the object.
    """
    return is_object(v)


def classify(df: DataFrame, value: str = "value", max_bytes: int = MAX_MESSAGE_BYTES,
             time_paths=TIME_US_PATHS) -> DataFrame:
    """Add ``v`` (VARIANT) and ``reason`` to raw records in column ``value``.

    ``v`` is the parsed value where the text is one JSON value; use it only
    where ``reason IS NULL``. The parse pieces come out of a one-row ``inline``
    and ``v`` out of a one-element ``explode`` (Generate nodes): filters on
    ``reason`` cannot be pushed below them and generators share no common
    subexpressions, so this layout is what makes each wrapper parse run once
    per record (instead of three times when inlined).
    """
    from eventlake.session import configure_session
    configure_session(df.sparkSession)  # last duplicate key wins
    raw = F.col(value)
    text = raw.cast("string")
    size_ok = guard_size(raw, max_bytes)
    utf8_ok = guard_utf8(raw)
    arr, obj_ok = strict_parts(text)
    pre = size_ok & utf8_ok
    parts = df.select("*", F.inline(F.array(F.struct(
        F.when(pre, arr).alias("__strict_arr"), F.when(pre, obj_ok).alias("__strict_ok")))))
    parsed = parts.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.explode(F.array(strict_value(F.col("__strict_arr"), F.col("__strict_ok")))).alias("v"))
    pv = F.col("v")
    reason = (F.when(~size_ok, "oversize")
              .when(~utf8_ok, "bad_utf8")
              .when(pv.isNull(), "bad_json")
              .when(~guard_object(pv), "not_object")
              .when(~guard_time_us(pv, time_paths), "bad_time_us"))
    return parsed.withColumn("reason", reason)
