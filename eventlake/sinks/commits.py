"""Commits of several folders at once: what a stream's batch adds to a lake and its quarantine.

The files of a commit are written aside, listed in a pending entry, moved into their folders
under names that begin with the commit's, and the entry is renamed to the list of commits: that
rename is the commit. Readers pass over files whose commit is pending. A batch that is run
again after a crash first takes back what its pending entry lists; one that is committed is
left alone. Batches that append without entries share the lake freely.

Entries are small JSON files; a commit's also keeps its counts and its write time, so the
totals of a pipeline are read from the lake (``committed``), whatever was restarted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.sinks.lake import _replace_file
from eventlake.sources.lake import COMMITS, PENDING, STAGING, _fs_path, _read_text

COMMIT_SCHEMA = """writer string, batch long, upto long, consumed long, written long, kept long, errors long,
  reasons map<string,long>, write_ms long, files long"""


MOVERS = 16  # calls of the file system that wait side by side


def _side_by_side(call: Callable, items: Iterable) -> list:
    """The calls' results; a call that fails is raised."""
    with ThreadPoolExecutor(MOVERS) as pool:
        return list(pool.map(call, items))


def is_committed(spark: SparkSession, lake: str, name: str) -> bool:
    fs, p = _fs_path(spark, f"{lake}/{COMMITS}/{name}.json")
    return fs.exists(p)


def staging_folder(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{STAGING}/{name}"


def _files_below(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the data files, relative to the folder. Listed folder by folder: a recursive
    listing also asks for owners, which on a local disk starts a process per file."""
    fs, root = _fs_path(spark, folder)
    if not fs.exists(root):
        return []
    base, out, folders = fs.makeQualified(root).toString().rstrip("/") + "/", [], [root]
    while folders:
        listed = [x for part in _side_by_side(lambda p: [(f.isDirectory(), f.getPath()) for f in fs.listStatus(p)], folders) for x in part]
        folders = [p for is_folder, p in listed if is_folder]
        files = [p.toString()[len(base):] for is_folder, p in listed if not is_folder]
        out += [f for f in files if not f.rpartition("/")[2].startswith(("_", "."))]
    return out


def take_back(spark: SparkSession, lake: str, name: str, folders: list[str]) -> None:
    """Removes what an attempt that did not commit has left."""
    text = _read_text(spark, f"{lake}/{PENDING}/{name}.json")
    for folder, file in json.loads(text)["moves"] if text else []:
        fs, p = _fs_path(spark, f"{folder}/{file}")
        fs.delete(p, False)
    for folder in folders:
        for part in (staging_folder(folder, name), f"{folder}/{PENDING}/{name}.json"):
            fs, p = _fs_path(spark, part)
            fs.delete(p, True)


def commit(spark: SparkSession, lake: str, name: str, folders: list[str], facts: dict) -> None:
    """Moves what lies in the folders' staging folders of this name into them, and commits."""
    folders = [f.rstrip("/") for f in folders]
    staged = [(f, file) for f in folders for file in _files_below(spark, staging_folder(f, name))]

    def named(file: str) -> str:
        head, _, last = file.rpartition("/")
        return f"{head}/{name}-{last}" if head else f"{name}-{last}"

    entry = {"lake": lake, "name": name, "folders": folders, "moves": [[f, named(file)] for f, file in staged], "files": len(staged), **facts}
    for folder in [f for f in folders if f != lake] + [lake]:  # before any file is moved
        _replace_file(spark, f"{folder}/{PENDING}/{name}.json", json.dumps(entry))

    def make(place: str) -> None:
        fs, p = _fs_path(spark, place)
        fs.mkdirs(p)

    def move(one: tuple[str, str]) -> None:
        folder, file = one
        fs, src = _fs_path(spark, f"{staging_folder(folder, name)}/{file}")
        _, dst = _fs_path(spark, f"{folder}/{named(file)}")
        if not fs.rename(src, dst):
            raise OSError(f"cannot move {src} to {dst}")

    _side_by_side(make, sorted({f"{folder}/{named(file)}".rpartition("/")[0] for folder, file in staged}))
    _side_by_side(move, staged)
    fs, done = _fs_path(spark, f"{lake}/{COMMITS}/{name}.json")
    fs.mkdirs(done.getParent())
    _, pending = _fs_path(spark, f"{lake}/{PENDING}/{name}.json")
    if not fs.rename(pending, done):
        raise OSError(f"cannot commit {name}")
    tidy(spark, name, folders, lake)


def tidy(spark: SparkSession, name: str, folders: list[str], lake: str) -> None:
    """What a commit leaves behind: empty staging folders, entries of the other folders."""
    for folder in folders:
        fs, p = _fs_path(spark, staging_folder(folder, name))
        fs.delete(p, True)
        if folder != lake:
            _, p = _fs_path(spark, f"{folder}/{PENDING}/{name}.json")
            fs.delete(p, False)


def committed(spark: SparkSession, lake: str) -> DataFrame:
    """One row per commit: writer, batch, counts, write time and number of files."""
    fs, p = _fs_path(spark, f"{lake.rstrip('/')}/{COMMITS}")
    if not fs.exists(p):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).json(p.toString())


def run_totals(spark: SparkSession, lake: str) -> DataFrame:
    """T5, one row: totals over all commits of a lake, each counted once, over all restarts."""
    return committed(spark, lake).agg(F.count(F.lit(1)).alias("batches"), *[
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("consumed", "written", "kept", "errors", "write_ms", "files")])


def write_seconds(spark: SparkSession, lake: str) -> DataFrame:
    """A3's input: the write time of every commit, for ``reports.histogram``."""
    return committed(spark, lake).select("writer", "batch", (F.col("write_ms") / 1000.0).alias("write_s"))
