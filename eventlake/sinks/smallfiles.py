"""K2 on a local disk: many files of few rows.

Spark's writer creates files through Hadoop, which without its native library starts a process per
file there to set its mode: of the 14 ms that a file of 5 rows took, 12. Here Spark shuffles and
sorts the rows as for its own writer, and each task writes its files with Arrow, into a folder of
its attempt. When all tasks are done, the folders of the attempts that succeeded are moved into the
lake; what other attempts left is deleted. Other stores start no processes, and larger files do not
notice them: those are left to Spark's writer.
"""

from __future__ import annotations

import contextlib
import importlib.util
import os
import shutil
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sources.lake import STAGING, _fs_path

# Below this many rows a process costs more than the rows of its file.
FEW_ROWS = 1000
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
          T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _same_in_arrow(t: T.DataType) -> bool:
    """Whether Arrow stores the type in Parquet as Spark does."""
    if isinstance(t, T.ArrayType):
        return _same_in_arrow(t.elementType)
    if isinstance(t, T.StructType):
        return bool(t.fields) and all(_same_in_arrow(f.dataType) for f in t.fields)
    return type(t) in _PLAIN


def local_root(df: DataFrame, path: str, parts: list[str], max_rows: int | None) -> str | None:
    """The lake's folder as a plain path if these rows are better written here, else None."""
    data = [f.dataType for f in df.schema.fields if f.name not in parts]
    if not max_rows or not 0 < max_rows < FEW_ROWS or not data or not all(map(_same_in_arrow, data)) or importlib.util.find_spec("pyarrow") is None:
        return None
    fs, p = _fs_path(df.sparkSession, path)
    uri = fs.makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_small_files(df: DataFrame, root: str, parts: list[str], max_rows: int) -> None:
    """Appends ``df`` to the lake in the local folder ``root``, with at most ``max_rows`` rows a file."""
    name = uuid.uuid4().hex
    staging = os.path.join(root, STAGING, name)
    columns = [c for c in df.columns if c not in parts]
    # by plain names, as mapInArrow looks columns up by theirs
    rows = df.select(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(columns)],
                     *[F.col(p).cast("string").alias(f"p{i}") for i, p in enumerate(parts)])
    rows = rows.sortWithinPartitions(*[f"p{i}" for i in range(len(parts))])
    write = _writer(staging, name, columns, parts, int(max_rows))
    os.makedirs(staging)
    try:
        # as commit messages: a row per folder and task, of the attempts that count
        for at in [r.folder for r in rows.mapInArrow(write, "folder string").collect()]:
            _move(os.path.join(staging, at), os.path.join(root, at.partition("/")[2]))
    finally:
        shutil.rmtree(staging, ignore_errors=True)
        with contextlib.suppress(OSError):  # others write, too
            os.rmdir(os.path.dirname(staging))
    with open(os.path.join(root, "_SUCCESS"), "w"):
        pass


def _move(source: str, target: str) -> None:
    """A folder that the lake does not have is moved at once, else its files one by one."""
    os.makedirs(os.path.dirname(target), exist_ok=True)
    try:
        os.rename(source, target)
    except OSError:
        for file in os.listdir(source):
            os.rename(os.path.join(source, file), os.path.join(target, file))


def _writer(staging: str, name: str, columns: list[str], parts: list[str], max_rows: int):
    """For ``mapInArrow`` over ``columns`` and ``parts``, sorted by the latter: writes the files of a
    task and returns their folders. It names no global of this module, so that it can be sent
    to workers that lack this package."""

    def write(batches):
        import os
        import re
        from itertools import groupby

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        task, files, folders, held = TaskContext.get(), 0, [], []
        attempt = str(task.taskAttemptId())

        def folder_of(values) -> str:
            # the characters that Spark escapes in partition folders, too
            escaped = [re.sub(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]", lambda m: f"%{ord(m[0]):02X}", v or "") or "__HIVE_DEFAULT_PARTITION__" for v in values]
            return "/".join([attempt, *[f"{p}={v}" for p, v in zip(parts, escaped)]])

        def flush() -> None:
            nonlocal files
            if held:
                file = f"part-{task.partitionId():05d}-{name}.c{files:06d}.snappy.parquet"
                table = pa.Table.from_batches(held)
                # dictionaries of a few rows only add pages
                with pq.ParquetWriter(os.path.join(staging, folders[-1], file), table.schema, compression="snappy",
                                      use_dictionary=False, store_schema=False) as out:
                    out.write_table(table)
                files += 1
                held.clear()

        for batch in batches:
            data, start = pa.RecordBatch.from_arrays(batch.columns[:len(columns)], names=columns), 0
            values = zip(*[c.to_pylist() for c in batch.columns[len(columns):]])
            for key, run in groupby(values):
                end = start + sum(1 for _ in run)
                folder = folder_of(key)
                if not folders or folder != folders[-1]:
                    flush()
                    folders.append(folder)
                    os.makedirs(os.path.join(staging, folder), exist_ok=True)
                while start < end:
                    room = max_rows - sum(b.num_rows for b in held)
                    held.append(data.slice(start, min(room, end - start)))
                    start += held[-1].num_rows
                    if held[-1].num_rows == room:
                        flush()
        flush()
        yield pa.RecordBatch.from_pydict({"folder": pa.array(sorted(set(folders)), pa.string())})

    return write
