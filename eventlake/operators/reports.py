"""Aggregations and reports over events and the lake (A1-A5).

All are hash aggregates with map-side partial aggregation: a hot account or
partition is reduced to one row per task before any shuffle, so a key holding
a third of all rows does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.timecols import DEFAULT_TEMPLATE, lag_seconds, template_columns
from eventlake.session import PLAIN_FILES, conf_scope

# Default histogram buckets of the Prometheus client library.
DEFAULT_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)


def top_accounts(df: DataFrame, n: int = 10, keys=("did", "event_type")) -> DataFrame:
    """A1: ``COUNT(*)`` by ``did, event_type``, count desc, first ``n``.

    Ties are broken by the keys so the answer is deterministic. Planned as
    partial HashAggregate -> Exchange -> final HashAggregate -> TakeOrderedAndProject.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), *[F.col(k).asc_nulls_last() for k in keys])
            .limit(int(n)))


def event_counters(classified: DataFrame) -> DataFrame:
    """A2: pipeline counters from guarded records (one row).

    ``received`` every record that arrives, ``produced`` those forwarded as valid JSON
    (the ingest side forwards what parses), ``consumed`` every record that a worker reads
    here, whether it parses or not (as in ``streaming.ingest``), ``written`` records that
    pass every guard, ``errors`` the rest.
    """
    r = F.col("reason")
    return classified.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(r.isNull() | ~r.isin("oversize", "bad_utf8", "bad_json")).alias("produced"),
        F.count(F.lit(1)).alias("consumed"),
        F.count_if(r.isNull()).alias("written"),
        F.count_if(r.isNotNull()).alias("errors"),
    )


def reason_counts(classified: DataFrame) -> DataFrame:
    """G4 report: records per outcome (``ok`` or the quarantine reason)."""
    return (classified.groupBy(F.coalesce(F.col("reason"), F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, col: str, buckets=DEFAULT_BUCKETS) -> DataFrame:
    """A3: cumulative histogram (``le``, ``count``) with ``+Inf`` last, plus sum and total.

    One aggregate computes every bucket at once (no explode of the data), then
    the single result row is unpivoted.
    """
    c = F.col(f"`{col}`")
    bs = sorted(float(b) for b in buckets)
    aggs = [F.count_if(c <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bs)]
    aggs += [F.count(c).alias("total"), F.sum(c).alias("sum")]
    row = df.agg(*aggs)
    les = [F.struct(F.lit(_fmt(b)).alias("le"), F.lit(i).alias("ord"), F.col(f"b{i}").alias("count"))
           for i, b in enumerate(bs)]
    les.append(F.struct(F.lit("+Inf").alias("le"), F.lit(len(bs)).alias("ord"), F.col("total").alias("count")))
    return (row.select(F.explode(F.array(*les)).alias("b"), "sum", "total")
            .select("b.le", "b.ord", "b.count", "sum", "total"))


def _fmt(b: float) -> str:
    return repr(b) if b != int(b) else f"{b:.1f}"


def current_lag(df: DataFrame, now_us=None, time_col: str = "time_us") -> DataFrame:
    """A4: lag in seconds of the newest event: ``now - max(time_us)`` (a partial
    ``max`` per task, one tiny global merge)."""
    t = F.col(f"`{time_col}`")
    newest = df.agg(F.max(t).alias("newest_us"))
    return newest.select("newest_us", lag_seconds(F.col("newest_us"), now_us))


def lake_inventory(lake: DataFrame, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """A5: one row per file — partition values, rows and bytes (from ``_metadata``)."""
    parts = template_columns(template)
    return (lake.select(*parts, F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_size").alias("file_size"))
            .groupBy("file_path", *parts)
            .agg(F.count(F.lit(1)).alias("rows"), F.first("file_size").alias("bytes")))


# What opening a file counts for when files are dealt to tasks. Spark's 4 MB suits files of some size; one
# of a few rows is read in 2 ms, so that the 4 to 32 files of a task would hardly pay for the task.
SMALL_FILE_COST = "256KB"


def written_inventory(lake: DataFrame, path: str, template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """``lake_inventory`` of many small files, written to ``path`` and read back: the files are
    dealt to tasks when the lake is read, which is here."""
    spark, inventory = lake.sparkSession, lake_inventory(lake, template)
    with conf_scope(spark, **{"spark.sql.files.openCostInBytes": SMALL_FILE_COST}):
        inventory.write.options(**PLAIN_FILES).parquet(path)
    return spark.read.schema(inventory.schema).parquet(path)
