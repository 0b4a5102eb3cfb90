"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import eventlake
from eventlake.session import PLAIN_FILES, scratch_path

# ASCII whitespace that separates words: the complement of the class [^\x20\x09-\x0D].
# bytes.split() without arguments splits on exactly these six.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_sent_to: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Python workers import this package by name. It goes to them with the application,
    once, so that it need not be installed on every machine or lie in the working folder."""
    context = spark.sparkContext
    if context.applicationId in _sent_to:
        return
    root = Path(eventlake.__file__).resolve().parent
    # Spark's file server hands the archive on; only the driver reads it from here
    archive = Path(tempfile.mkdtemp(prefix="eventlake-package-")) / "eventlake_package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, Path("eventlake") / file.relative_to(root))
    context.addPyFile(str(archive))
    _sent_to.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in taken:
        name = "_" + name
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: it cuts lineage, and
    the files outlive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**PLAIN_FILES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_bytes(spark: SparkSession, path: str) -> Broadcast:
    """A small driver-side file (a tokenizer's vocabulary) for the tasks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Pauses the cycle collector: word lists and memos hold no cycles, only many objects
    that it would walk again and again."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()


def release() -> None:
    """Gives freed memory back to the system: Python workers live on from stage to stage, and
    what their allocators keep would add up."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b or b"" for b in col.cast(pa.binary()).to_pylist()]


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``max_bytes`` of ``column`` each (one row at least),
    so that what a task holds beside a batch stays bounded whatever the texts' lengths."""
    for batch in batches:
        n, col = batch.num_rows, batch.column(batch.schema.names.index(column))
        if n == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(col), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(lengths):
            if i > start and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        yield batch.slice(start, n - start)


def map_batches(df: DataFrame, column: str, schema: str, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
                max_bytes: int = 8 << 20) -> DataFrame:
    """``mapInArrow`` over bounded slices."""
    send_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, column, max_bytes):
            with uncollected():
                out = fn(part)
            yield out
        release()

    return df.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of the least hashes of ``key``: the same ones at each run.
    A share of the hash range, from the row count, leaves about twice as many to the ordering,
    so that no task hands on more than its part."""
    share = min(1.0, 2.0 * rows / max(1, df.count()))
    hashed, fine = F.xxhash64(key), 1 << 40
    return df.where(F.pmod(hashed, F.lit(fine)) < F.lit(int(share * fine) + 1)) \
        .orderBy(F.pmod(hashed, F.lit(fine)), key).limit(rows)


def id_and_text(docs: DataFrame) -> DataFrame:
    """Only the two columns that the operators read, so other columns cannot clash."""
    send_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
