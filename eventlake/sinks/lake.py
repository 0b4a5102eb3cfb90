"""K1/K2: append to the Parquet lake partitioned by the template columns.

* Snappy, append mode; an empty input writes nothing and succeeds.
* ``max_rows`` bounds rows per file (``maxRecordsPerFile``); ``FLUSH_ROWS`` is the
  reference's flush size. Unset, a file holds what one task writes. On a local disk files
  of few rows are written by ``sinks.smallfiles``.
* Spark names every file uniquely, so two writes in one second never
  overwrite each other.
* ``cluster=False``: no shuffle; each task sorts its rows by partition value
  and writes one file per partition it holds. Right for ingest-time
  partitioning (a batch lands in one hour) and time-ordered input.
* ``cluster=True``: a ``rebalance`` hint on the partition columns — one shuffle
  after which AQE coalesces small partitions and *splits* skewed ones, so each
  hour is written by few tasks (few, large files) and a hot hour holding a
  third of the data is still spread over many tasks. No sampling pass.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame

from eventlake.functions.timecols import DEFAULT_TEMPLATE, template_columns
from eventlake.session import PLAIN_FILES
from eventlake.sinks.smallfiles import local_root, write_small_files
from eventlake.sources.lake import SCHEMA_FILE

# Fixed value: the reference's flush size (events per file). Pass it as ``max_rows``
# for its file layout. It bounds an in-process buffer there; here a file is already
# bounded by its task (one input split, or one AQE-sized partition), and 10,000-row
# files at ~100 TB would mean tens of millions of ~1 MB files — so the default is none.
FLUSH_ROWS = 10000
DEFAULT_MAX_ROWS = None
WRITE_MIN_PARTITION = "64KB"


def write_lake(df: DataFrame, path: str, template: str = DEFAULT_TEMPLATE,
               max_rows: int | None = DEFAULT_MAX_ROWS, mode: str = "append",
               cluster: bool = False) -> None:
    parts = template_columns(template)
    missing = [p for p in parts if p not in df.columns]
    if missing:
        raise ValueError(f"partition columns missing: {missing}; add them with with_partitions()")
    if cluster:
        df = df.hint("rebalance", *parts)
    root = local_root(df, path, parts, max_rows) if mode == "append" else None
    w = df.write.mode(mode).option("compression", "snappy").options(**PLAIN_FILES).partitionBy(*parts)
    if max_rows:
        w = w.option("maxRecordsPerFile", int(max_rows))

    def write() -> None:
        if root is not None:
            write_small_files(df, root, parts, max_rows)
        else:
            w.parquet(path)

    if not cluster:
        write()
        return
    # A rebalanced write's cost is set by its folders as much as its bytes: with AQE's
    # 1 MB floor a small batch spanning many hours collapses into one task that writes
    # every folder in turn. A lower floor keeps the writers parallel (each hour still
    # lands in one partition); large batches are unaffected (partitions are ~advisory).
    from eventlake.session import conf_scope
    with conf_scope(df.sparkSession, **{"spark.sql.adaptive.coalescePartitions.minPartitionSize": WRITE_MIN_PARTITION}):
        write()


def write_schema_sidecar(df_or_schema, path: str) -> None:
    """Store the lake schema as one small JSON file beside the data: written under another
    name and renamed, so a reader sees the old file or the new one, never half of it."""
    from pyspark.sql import SparkSession
    from pyspark.sql.types import StructType
    if isinstance(df_or_schema, StructType):
        st, spark = df_or_schema, SparkSession.getActiveSession()
    else:
        st, spark = df_or_schema.schema, df_or_schema.sparkSession
    _replace_file(spark, f"{path.rstrip('/')}/{SCHEMA_FILE}", st.json())


def _replace_file(spark, target: str, text: str) -> None:
    from eventlake.sources.lake import _fs_path
    fs, p = _fs_path(spark, target)
    _, new = _fs_path(spark, f"{target}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(new, p):  # some stores do not rename onto a file that is there
        fs.delete(p, False)
        if not fs.rename(new, p):
            raise OSError(f"cannot put {target} into place")


def write_paths(spark, path: str, pairs: list[tuple]) -> None:
    """Adds a batch's pairs of path and kind to the lake's list. The first batch that has a path
    says what its column is made for (``main``); kinds that come later stand beside these."""
    from eventlake.sources.lake import PATHS_FILE, read_paths
    stored = read_paths(spark, path)
    old = {(tuple(r.path), r.kind): (r.digits, r.scale, r.main) for r in stored.collect()} if stored is not None else {}
    have = {p[:i] for p, _ in old for i in range(len(p) + 1)}
    for p, kind, digits, scale in pairs:
        was = old.get((p, kind))
        if was is None:
            old[p, kind] = digits, scale, p not in have
        elif digits is not None and (digits > was[0] or scale > was[1]):
            # wider numbers than the column was made for
            old[p, kind] = max(digits, was[0]), max(scale, was[1]), False
    lines = [json.dumps([p, k, d, s, m]) for (p, k), (d, s, m) in old.items()]
    _replace_file(spark, f"{path.rstrip('/')}/{PATHS_FILE}", "\n".join(lines) + "\n")


def append_evolving(df: DataFrame, path: str, template: str = DEFAULT_TEMPLATE,
                    max_rows: int | None = DEFAULT_MAX_ROWS, cluster: bool = False, into: str | None = None) -> DataFrame:
    """Append a flattened batch whose columns may differ from the lake's.

    The stored schema beside the lake decides each column's type; new columns and new fields
    inside lists are added, and values that do not fit go to a column beside theirs
    (``evolve_frame``). Returns the frame as written. The schema file is updated before the
    data: columns without files yet read as NULL, files with columns the schema lacks would
    be hidden. Concurrent appenders to one lake must be serialised by the caller (as with
    any single-writer table layout). A lake that a file-sink stream writes refuses batches.
    ``into`` is another folder for the files (``sinks.commits`` moves them in later).
    """
    from eventlake.operators.flatten import case_scope
    from eventlake.operators.schema import evolve_frame
    from eventlake.sources.lake import read_schema_sidecar, refuse_streamed
    spark = df.sparkSession
    refuse_streamed(spark, path)
    with case_scope(spark, df.schema):
        df, merged = evolve_frame(df, read_schema_sidecar(spark, path), template_columns(template))
    with case_scope(spark, merged):
        write_schema_sidecar(merged, path)
        write_lake(df, into or path, template, max_rows, cluster=cluster)
    return df


def repair_schema_sidecar(spark, path: str, template: str = DEFAULT_TEMPLATE):
    """Rebuild the stored lake schema from the files' footers.

    Needed only if the schema file was lost, or files came in another way
    (``append_evolving`` writes the schema before the data). Spark merges the footers in a
    distributed job (types agree across files, since appends never narrow them).
    """
    from pyspark.sql.types import StructType
    from eventlake.session import conf_scope
    with conf_scope(spark, **{"spark.sql.sources.partitionColumnTypeInference.enabled": "false"}):
        df = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(path)
    parts = template_columns(template)
    st = StructType([f for f in df.schema.fields if f.name not in parts])
    write_schema_sidecar(st, path)
    return st
