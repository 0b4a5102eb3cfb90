"""Files of few rows on a local disk (``sinks.smallfiles``): as Spark's own writer, without a process per file."""

import os
from datetime import date, datetime
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.sinks.lake import write_lake
from eventlake.sinks.smallfiles import FEW_ROWS, local_root
from eventlake.sources.lake import open_lake

TEMPLATE = "year={year}/place={place}"
PARTS = ["year", "place"]


def _rows(spark):
    """Odd values, nulls at every level, and partition values that need escapes."""
    odd = [
        (1, "a", b"\x00\xff", True, 1.5, Decimal("1.25"), date(1500, 1, 1), datetime(2024, 1, 1, 2, 3, 4, 5), datetime(1960, 1, 1), [{"k": 1, "g": [1, None]}], "2024", "x"),
        (2, None, None, None, None, None, None, None, None, None, "2024", None),
        (3, "", b"", False, float("nan"), Decimal("-0.01"), date(2024, 2, 29), datetime(1890, 1, 1), None, [], "2024", ""),
        (4, "é\n\U0001F600", b"x", True, float("-inf"), Decimal("99999999.99"), None, None, None, [None, {"k": None, "g": None}], None, "a b/c=%:é"),
    ]
    kinds = "n long, s string, b binary, t boolean, d double, m decimal(10,2), day date, at timestamp, plain timestamp_ntz, " \
            "`fa.c` array<struct<k:bigint,g:array<int>>>, year string, place string"
    more = spark.range(100, 140).select(F.col("id").alias("n"), F.lit("2025").alias("year"), F.lit("hot").alias("place"))
    return spark.createDataFrame(odd, kinds).unionByName(more, allowMissingColumns=True)


def _files(root):
    return [os.path.join(at, f) for at, _, files in os.walk(root) for f in files if f.endswith(".parquet")]


def _as_text(df):
    return sorted(str(r) for r in df.select(*[f"`{c}`" for c in sorted(df.columns)]).collect())


@pytest.mark.parametrize("cluster", [False, True])
def test_small_files_hold_what_spark_writes(spark, tmp_path, cluster):
    rows, own, plain = _rows(spark).repartition(3), str(tmp_path / "own"), str(tmp_path / "plain")
    write_lake(rows, own, TEMPLATE, max_rows=3, cluster=cluster)
    rows.write.partitionBy(*PARTS).parquet(plain)
    schema = T.StructType([f for f in rows.schema.fields if f.name not in PARTS])
    lakes = [open_lake(spark, at, schema, TEMPLATE) for at in (own, plain)]
    assert _as_text(lakes[0]) == _as_text(lakes[1]) and lakes[0].count() == 44
    # the same folders, and the same types from the files alone
    assert {os.path.dirname(os.path.relpath(f, own)) for f in _files(own)} == {os.path.dirname(os.path.relpath(f, plain)) for f in _files(plain)}
    assert sorted(spark.read.parquet(own).dtypes) == sorted(spark.read.parquet(plain).dtypes)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in _files(own)]
    assert sum(sizes) == 44 and max(sizes) == 3
    # beside the data only the marker of a finished write: no staged files, no checksum files
    assert [f for f in os.listdir(own) if not f.startswith("year=")] == ["_SUCCESS"]


def test_no_process_is_started_per_file(spark, tmp_path):
    """Files created through Hadoop cost a process each; those written by Arrow do not."""
    write_lake(_rows(spark), str(tmp_path), TEMPLATE, max_rows=2)
    assert {pq.ParquetFile(f).metadata.created_by.split(" ")[0] for f in _files(tmp_path)} == {"parquet-cpp-arrow"}


def test_files_are_filled_across_batches(spark, tmp_path):
    from eventlake.session import conf_scope
    rows = spark.range(0, 101, 1, 1).select("id", F.lit("2024").alias("year"), (F.col("id") > 90).cast("string").alias("place"))
    with conf_scope(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": 7}):
        write_lake(rows, str(tmp_path), TEMPLATE, max_rows=5)
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in _files(tmp_path))
    assert sizes == [1, *[5] * 20]  # 91 and 10 rows
    assert open_lake(spark, str(tmp_path), template=TEMPLATE).select("id").distinct().count() == 101


def test_small_files_are_appended(spark, tmp_path):
    """Into folders that hold files, from several tasks, under names that are never taken."""
    rows, path = _rows(spark).repartition(4), tmp_path.as_uri() + "/a lake"
    for _ in range(3):
        write_lake(rows, path, TEMPLATE, max_rows=4)
    assert open_lake(spark, path, template=TEMPLATE).groupBy("n").count().where("count <> 3").count() == 0
    assert open_lake(spark, path, template=TEMPLATE).count() == 3 * 44


def test_a_write_that_fails_leaves_nothing(spark, tmp_path):
    rows = spark.range(0, 100, 1, 2).select(F.when(F.col("id") == 99, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("n"),
                                            F.lit("2024").alias("year"), F.col("id").cast("string").alias("place"))
    with pytest.raises(Exception, match="broken"):
        write_lake(rows, str(tmp_path / "lake"), TEMPLATE, max_rows=1)
    assert not _files(tmp_path) and os.listdir(tmp_path / "lake") == []


def test_an_empty_frame_writes_no_file(spark, tmp_path):
    write_lake(_rows(spark).where("n < 0"), str(tmp_path), TEMPLATE, max_rows=3, cluster=True)
    assert os.listdir(tmp_path) == ["_SUCCESS"]


def test_other_writes_are_left_to_spark(spark, tmp_path):
    rows = _rows(spark)
    assert local_root(rows, str(tmp_path), PARTS, 5) == str(tmp_path)
    assert local_root(rows, str(tmp_path), PARTS, None) is None
    assert local_root(rows, str(tmp_path), PARTS, FEW_ROWS) is None
    assert local_root(rows.select(*PARTS), str(tmp_path), PARTS, 5) is None
    assert local_root(rows.withColumn("v", F.parse_json(F.lit("1"))), str(tmp_path), PARTS, 5) is None
    assert local_root(rows, "hdfs://127.0.0.1:1/lake", PARTS, 5) is None


def test_the_inventory_reads_many_small_files_in_few_tasks(spark, tmp_path):
    """With Spark's own cost of opening a file, a task of 16 MB took 4 files: 50 tasks here."""
    from eventlake.operators import reports
    from eventlake.session import conf_scope
    rows = spark.range(200).select("id", F.lit("2024").alias("year"), F.lit("x").alias("place"))
    write_lake(rows.coalesce(1), str(tmp_path / "lake"), TEMPLATE, max_rows=1)
    lake, context = open_lake(spark, str(tmp_path / "lake"), template=TEMPLATE), spark.sparkContext
    context.setJobGroup("inventory", "tasks are counted")
    try:
        with conf_scope(spark, **{"spark.sql.files.maxPartitionBytes": "16MB"}):
            found = reports.written_inventory(lake, str(tmp_path / "inventory"), TEMPLATE)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("inventory") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages if s) <= max(16, 2 * context.defaultParallelism)
    assert _as_text(found) == _as_text(reports.lake_inventory(lake, TEMPLATE)) and found.count() == 200
