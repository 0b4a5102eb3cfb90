"""Derived columns on flattened events (P4-P8), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StringType

from eventlake.functions.jsonvalue import get_path
from eventlake.functions.timecols import (
    DEFAULT_TEMPLATE, epoch_ms_to_ts, floor_ms, ingest_time, lag_seconds, partition_columns,
    template_columns,
)
from eventlake.session import conf_scope

EVENT_MS = "event_timestamp_ms"


def _dtype(df: DataFrame, name: str):
    for f in df.schema.fields:
        if f.name == name:
            return f.dataType
    return None


def _aside(df: DataFrame, names, but: str | None = None) -> DataFrame:
    """Renames columns that equal one of ``names`` up to case (``but`` itself stays) by
    trailing underscores: Spark would take them for the same column."""
    wanted, taken = {n.lower() for n in names}, {c.lower() for c in df.columns} | {n.lower() for n in names}
    renamed = {}
    for c in df.columns:
        if c.lower() in wanted and c != but:
            new = c + "_"
            while new.lower() in taken:
                new += "_"
            taken.add(new.lower())
            renamed[c] = new
    if not renamed:
        return df
    with conf_scope(df.sparkSession, **{"spark.sql.caseSensitive": "true"}):
        return df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(renamed.get(c, c)) for c in df.columns])


def with_event_ms(df: DataFrame, time_col: str = "time_us", out: str = EVENT_MS) -> DataFrame:
    """``event_timestamp_ms = floor(time_us / 1000)`` where ``time_us`` is present.

    Rows without ``time_us`` keep their own ``event_timestamp_ms`` if the event
    carried one (NULL otherwise); rows with it get the derived value, which
    overwrites a carried key.
    """
    tdt = _dtype(df, time_col)
    df = _aside(df, [out], but=out)
    if tdt is None:
        if _dtype(df, out) is None:
            return df.withColumn(out, F.lit(None).cast("bigint"))
        return df
    t = F.col(f"`{time_col}`")
    if isinstance(tdt, StringType):
        # Numbers beyond BIGINT arrive as text (guards let only numbers through).
        ms = F.when(t.rlike(r"^-?\d+$"), floor_ms(t)).otherwise(floor_ms(t, DoubleType()))
    elif isinstance(tdt, (DoubleType, FloatType)):
        ms = floor_ms(t, tdt)
    else:
        ms = floor_ms(t, LongType())
    odt = _dtype(df, out)
    if odt is None:
        return df.withColumn(out, ms)
    old = F.col(f"`{out}`")
    if not isinstance(odt, LongType):
        ms = ms.try_cast(odt)
    return df.withColumn(out, F.when(t.isNotNull(), ms).otherwise(old))


def with_epoch_timestamps(df: DataFrame, cols=("collection_timestamp", "event_timestamp")) -> DataFrame:
    """P5: epoch-ms columns -> TIMESTAMP_NTZ, only for the columns that exist."""
    for c in cols:
        dt = _dtype(df, c)
        if dt is not None:
            df = df.withColumn(c, epoch_ms_to_ts(F.col(f"`{c}`")))
    return df


def with_partitions(df: DataFrame, ts: Column | str | None = None,
                    template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Partition value columns from ``template``.

    ``ts`` None (default) uses ingest wall-clock time, as the reference does;
    a column (e.g. the event time) partitions by event time instead. Existing
    columns named like a partition column are renamed with a trailing ``_``.
    """
    if ts is None:
        tcol = ingest_time()
    else:
        tcol = ts
    # An event key with a partition column's name, in any case, keeps its value under
    # ``name_`` (more underscores if that is taken too); nothing is dropped.
    before = df.columns
    df = _aside(df, template_columns(template))
    if isinstance(ts, str):
        tcol = F.col("`" + df.columns[before.index(ts)].replace("`", "``") + "`")
    return df.select("*", *partition_columns(tcol, template))


def with_lag(df: DataFrame, now_us=None, time_col: str = "time_us") -> DataFrame:
    """``lag_seconds`` = (now - time_us) / 1e6 where ``time_us`` is present."""
    if _dtype(df, time_col) is None:
        return df.withColumn("lag_seconds", F.lit(None).cast("double"))
    return df.withColumn("lag_seconds", lag_seconds(F.col(f"`{time_col}`"), now_us))


# Our JSON paths for the declared 12-column event (the reference
# names the fields but not their paths; these follow the public event envelope).
DEFAULT_PATHS = {
    "event_type": "kind",
    "collection": "commit.collection",
    "action": "commit.operation",
    "cid": "commit.cid",
    "record_text": "commit.record.text",
    "reply_parent": "commit.record.reply.parent",
    "reply_root": "commit.record.reply.root",
    "embed_type": "commit.record.embed",
}

DECLARED_COLUMNS = (
    "collection_timestamp", "event_timestamp", "did", "event_type", "collection", "action",
    "cid", "record_text", "reply_parent", "reply_root", "embed_type", "raw_event",
)


def project_event(df: DataFrame, paths: dict | None = None, collected_ms: Column | int | None = None,
                  v: str = "v", value: str = "value") -> DataFrame:
    """The declared 12-column event from parsed records.

    ``paths`` maps output fields to dotted JSON paths (``DEFAULT_PATHS`` merged
    with the argument). ``collected_ms`` defaults to ingest wall-clock time.
    ``raw_event`` keeps the original bytes, so nothing is lost.
    """
    p = dict(DEFAULT_PATHS)
    p.update(paths or {})
    vc = F.col(v)
    if collected_ms is None:
        coll = F.unix_millis(F.current_timestamp())
    elif isinstance(collected_ms, Column):
        coll = collected_ms
    else:
        coll = F.lit(int(collected_ms))
    ems = F.coalesce(floor_ms(get_path(vc, ("time_us",), "bigint"), LongType()),
                     floor_ms(get_path(vc, ("time_us",), "double"), DoubleType()))
    cols = [
        epoch_ms_to_ts(coll).alias("collection_timestamp"),
        epoch_ms_to_ts(ems).alias("event_timestamp"),
        get_path(vc, ("did",), "string").alias("did"),
    ]
    for name in ("event_type", "collection", "action", "cid", "record_text",
                 "reply_parent", "reply_root", "embed_type"):
        cols.append(get_path(vc, tuple(p[name].split(".")), "string").alias(name))
    cols.append(F.col(value).cast("binary").alias("raw_event"))
    return df.select(*cols)
