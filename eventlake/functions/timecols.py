"""Time columns: event ms (P4), epoch-ms timestamps (P5), partition values (P6), lag.

All conversions are zone-free (TIMESTAMP_NTZ anchored at 1970-01-01), so the
result does not depend on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

# Fixed value: the default partition layout of the lake.
DEFAULT_TEMPLATE = "year={year}/month={month}/day={day}/hour={hour}"

_FIELDS = ("year", "month", "day", "hour")


def _epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


# The epoch-millisecond range of Spark timestamps (0001-01-01 .. 9999-12-31).
MIN_MS = -62135596800000
MAX_MS = 253402300799999


def floor_ms(time_us: Column, dtype: DataType | None = None) -> Column:
    """floor(time_us / 1000) as BIGINT; NULL when the result does not fit.

    Integer input uses exact decimal arithmetic (no double rounding, and no
    overflow: -1500 -> -2, Long.MIN -> -9223372036854776). Fractional input is
    floored in DOUBLE. Under ANSI mode a plain cast would raise on one odd value
    and fail the whole job, so every step here returns NULL instead.
    """
    if isinstance(dtype, (DoubleType, FloatType)):
        q = time_us.try_cast("double") / F.lit(1000.0)
        # doubles from -2^63 up to, but not including, 2^63 are BIGINTs
        return F.when((q >= F.lit(-(2.0 ** 63))) & (q < F.lit(2.0 ** 63)), F.floor(q)).try_cast("bigint")
    d = time_us.try_cast("decimal(38,0)")
    return F.floor(d / F.lit(1000)).try_cast("bigint")


def ts_to_epoch_us(ts: Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ column."""
    return F.timestamp_diff("MICROSECOND", _epoch(), ts.cast("timestamp_ntz"))


def epoch_ms_to_ts(ms: Column) -> Column:
    """P5: epoch milliseconds -> TIMESTAMP_NTZ (millisecond precision); NULL out of range."""
    m = F.floor(ms.try_cast("double"))
    return F.when(m.between(MIN_MS, MAX_MS),
                  F.timestamp_add("MILLISECOND", m.cast("bigint"), _epoch()))


def ingest_time() -> Column:
    """Wall-clock UTC at query start as TIMESTAMP_NTZ (one value per query), whatever the
    session's time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), _epoch())


_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def template_columns(template: str = DEFAULT_TEMPLATE) -> list[str]:
    """Partition column names of a ``name={field}/...`` template."""
    names = []
    for seg in template.strip("/").split("/"):
        if "=" not in seg:
            raise ValueError(f"partition segment without '=': {seg!r}")
        names.append(seg.split("=", 1)[0])
    return names


def format_field(field: str, value) -> str:
    """A partition value as it appears in folder names: ``{year}`` as is, the others
    zero-padded to two digits (the same text ``partition_columns`` writes)."""
    return str(int(value)) if field == "year" else str(int(value)).zfill(2)


def partition_columns(ts: Column, template: str = DEFAULT_TEMPLATE) -> list[Column]:
    """One STRING column per ``name=value`` segment of the template.

    ``{year}`` is not padded; ``{month}``, ``{day}``, ``{hour}`` are two digits,
    as in the reference layout. Literal text around placeholders is kept.
    """
    ts = ts.cast("timestamp_ntz")
    parts = {
        "year": F.year(ts).cast("string"),
        "month": F.lpad(F.month(ts).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
        "hour": F.lpad(F.hour(ts).cast("string"), 2, "0"),
    }
    out = []
    for seg in template.strip("/").split("/"):
        name, fmt = seg.split("=", 1)
        pieces, pos = [], 0
        for m in _PLACEHOLDER.finditer(fmt):
            if m.group(1) not in parts:
                raise ValueError(f"unknown partition field {{{m.group(1)}}}; use one of {_FIELDS}")
            if m.start() > pos:
                pieces.append(F.lit(fmt[pos:m.start()]))
            pieces.append(parts[m.group(1)])
            pos = m.end()
        if pos < len(fmt):
            pieces.append(F.lit(fmt[pos:]))
        col = pieces[0] if len(pieces) == 1 else F.concat(*pieces)
        out.append(col.alias(name))
    return out


def lag_seconds(time_us: Column, now_us: Column | int | None = None) -> Column:
    """(now_us - time_us) / 1e6 as DOUBLE; ``now_us`` defaults to query start."""
    if now_us is None:
        now = F.unix_micros(F.current_timestamp())
    elif isinstance(now_us, Column):
        now = now_us
    else:
        now = F.lit(int(now_us))
    # DOUBLE subtraction: exact below 2**53 us (year 2255) and never overflows.
    diff = now.try_cast("double") - time_us.try_cast("double")
    return (diff / F.lit(1_000_000.0)).alias("lag_seconds")
