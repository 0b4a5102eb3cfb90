"""S3: scan of the partitioned Parquet lake.

Partition values are read as *strings* (``hour = '08'`` as in the lake's
paths) by passing the partition columns as STRING in the user schema — or, if
no schema is known, by turning partition type inference off for this read.
Filters on them become ``PartitionFilters``, so only matching folders are listed
and read; column selection reaches the scan as ``ReadSchema``.
"""

from __future__ import annotations

import functools
import json
import logging
import re

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventlake.functions.timecols import DEFAULT_TEMPLATE, format_field, template_columns
from eventlake.session import conf_scope

log = logging.getLogger(__name__)

SCHEMA_FILE = "_eventlake_schema.json"


@functools.lru_cache(maxsize=1)
def _hadoop(context: SparkContext):
    """Hadoop's Path and the session's settings: looked up anew they take several round trips to the JVM."""
    return context._jvm.org.apache.hadoop.fs.Path, context._jsc.hadoopConfiguration()  # noqa: SLF001 - Hadoop FS keeps this storage-agnostic


def _fs_path(spark: SparkSession, target: str):
    path, conf = _hadoop(spark.sparkContext)
    p = path(target)
    return p.getFileSystem(conf), p


def _read_text(spark: SparkSession, target: str) -> str | None:
    """A small metadata file, read through the Hadoop FileSystem API so any storage scheme
    works; None if there is none. (Spark's file listing skips ``_``-names.)"""
    fs, p = _fs_path(spark, target)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm  # noqa: SLF001
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_schema_sidecar(spark: SparkSession, path: str) -> StructType | None:
    """The widened lake schema stored beside the data, or None."""
    text = _read_text(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}")
    return StructType.fromJson(json.loads(text)) if text is not None else None


PATHS_FILE = "_eventlake_paths.json"


def read_paths(spark: SparkSession, path: str) -> DataFrame | None:
    """(path, kind, digits, scale, main): the paths of the events in the lake, with their kinds;
    ``main`` are those that the columns were made for. None if no list was stored."""
    text = _read_text(spark, f"{path.rstrip('/')}/{PATHS_FILE}")
    if text is None:
        return None
    return spark.createDataFrame([tuple(json.loads(line)) for line in text.splitlines()],
                                 "path array<string>, kind string, digits int, scale int, main boolean")


METADATA_LOG = "_spark_metadata"


# Entries of commits (``sinks.commits``), beside the data.
COMMITS, PENDING, STAGING = "_eventlake_commits", "_eventlake_pending", "_eventlake_staging"


def without_pending(df: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``df`` without the files of commits that are not done. Only those in flight have entries."""
    fs, p = _fs_path(spark, f"{path.rstrip('/')}/{PENDING}")
    if not fs.exists(p):
        return df
    names = []
    for f in fs.listStatus(p):
        text = _read_text(spark, f.getPath().toString()) if f.getPath().getName().endswith(".json") else None
        if text:
            entry = json.loads(text)
            done, q = _fs_path(spark, f"{entry['lake']}/{COMMITS}/{entry['name']}.json")
            if not done.exists(q):
                names.append(entry["name"])
    for name in names:
        df = df.where(~F.startswith(F.col("_metadata.file_name"), F.lit(name + "-")))
    return df


def open_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The quarantined records of a stream, of done commits only."""
    return without_pending(spark.read.parquet(path), spark, path)


class LakeConflict(RuntimeError):
    """A lake is written by batches or by one stream, not by both."""


def is_streamed(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes this lake: its log then decides which files count."""
    fs, p = _fs_path(spark, f"{path.rstrip('/')}/{METADATA_LOG}")
    return fs.exists(p)


def holds_batches(spark: SparkSession, path: str) -> bool:
    """Whether there is a lake at ``path`` that no stream writes."""
    fs, p = _fs_path(spark, path)
    if is_streamed(spark, path) or not fs.exists(p):
        return False
    return any(not f.getPath().getName().startswith((".", "_")) for f in fs.listStatus(p))


def refuse_streamed(spark: SparkSession, path: str) -> None:
    """Files that a batch adds to a streamed lake would stay hidden: its log lacks them."""
    if is_streamed(spark, path):
        raise LakeConflict(f"{path} is written by a stream; append batches to a lake of their own")


def _table_schema(schema: StructType, parts: list[str]) -> StructType:
    fields = [f for f in schema.fields if f.name not in parts]
    fields += [StructField(p, StringType(), True) for p in parts]
    return StructType(fields)


def open_lake(spark: SparkSession, path: str, schema: StructType | None = None,
              template: str = DEFAULT_TEMPLATE, merge_schema: bool = True,
              read_path: str | None = None) -> DataFrame:
    """Read the lake as one table; partition columns are STRING.

    ``read_path`` (a folder below ``path``) limits the file listing to that
    folder; ``basePath`` keeps the partition columns above it.
    """
    parts = template_columns(template)
    if schema is None:
        schema = read_schema_sidecar(spark, path)
    reader = spark.read.option("basePath", path)
    target = read_path or path
    if schema is not None:
        from eventlake.operators.flatten import _case_collisions
        if _case_collisions(schema):
            # Only fields inside lists can still differ by case alone. Spark reads such files
            # in no other way, and it reads them when the frame is run, not here.
            log.warning("%s has fields that differ only by case; setting spark.sql.caseSensitive=true", path)
            spark.conf.set("spark.sql.caseSensitive", "true")
        return without_pending(reader.schema(_table_schema(schema, parts)).parquet(target), spark, path)
    with conf_scope(spark, **{"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        return without_pending(reader.option("mergeSchema", str(merge_schema).lower()).parquet(target), spark, path)


_FIELD = re.compile(r"\{(\w+)\}")


def slice_prefix(path: str, template: str = DEFAULT_TEMPLATE, **values) -> str:
    """Folder holding the given leading partition values (``year``, then ``month`` ...).

    Stops at the first segment without a value (or one that is not a plain
    ``name={field}``); with no leading value it is the lake root.
    """
    segs = []
    for seg in template.strip("/").split("/"):
        name, fmt = seg.split("=", 1)
        m = _FIELD.fullmatch(fmt)
        if not m or values.get(name) is None:
            break
        segs.append(f"{name}={format_field(m.group(1), values[name])}")
    return "/".join([path.rstrip("/")] + segs)


def open_lake_slice(spark: SparkSession, path: str, template: str = DEFAULT_TEMPLATE,
                    schema: StructType | None = None, year=None, month=None, day=None,
                    hour=None) -> DataFrame:
    """S3 + F2 with pruning at the listing: a one-hour read lists one folder.

    Opening the lake root makes Spark list every file of every hour before
    partition filters drop them — at a year of hourly folders that listing alone
    dominates a one-hour query. Here only the folder prefix of the leading values
    is listed, and the same equality filter is applied on top (so a partial
    prefix, e.g. year and day without month, is still exact). A missing folder
    gives an empty frame with the lake's schema.
    """
    from eventlake.operators.filters import lake_slice
    prefix = slice_prefix(path, template, year=year, month=month, day=day, hour=hour)
    if schema is None:
        schema = read_schema_sidecar(spark, path)
    if is_streamed(spark, path):
        # a folder read would pass over the stream's log and show uncommitted files; the log
        # also spares the listing
        prefix = path.rstrip("/")
    if prefix != path.rstrip("/"):
        fs, p = _fs_path(spark, prefix)
        if not fs.exists(p):
            if schema is not None:
                return spark.createDataFrame([], _table_schema(schema, template_columns(template)))
            prefix = path  # no stored schema to shape an empty frame: filter the whole lake
    df = open_lake(spark, path, schema, template, read_path=prefix)
    return lake_slice(df, year=year, month=month, day=day, hour=hour, template=template)


def register_lake(spark: SparkSession, path: str, name: str = "lake",
                  template: str = DEFAULT_TEMPLATE, **slice_values) -> DataFrame:
    """Expose the lake to ``spark.sql`` as a temporary view (partition columns STRING).

    SQL over the view takes the same Catalyst path as the DataFrame API:
    partition predicates become ``PartitionFilters``, selected columns the
    ``ReadSchema``. The file listing is made once, when the view is created;
    with ``year=`` / ``month=`` / ``day=`` / ``hour=`` the view covers only that
    slice and lists only its folder (``open_lake_slice``).
    """
    if any(v is not None for v in slice_values.values()):
        df = open_lake_slice(spark, path, template, **slice_values)
    else:
        df = open_lake(spark, path, template=template)
    df.createOrReplaceTempView(name)
    return df
