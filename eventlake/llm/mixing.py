"""Operator 5, mixing sources to target weights by capped water-filling.

A source's target is its weight's share of the mix, clamped at ``max_epochs`` times its
size; what the clamp frees is shared among the others by weight until none is above.
With the sources sorted by cap per unit of weight this has a closed form: the water
level is the greatest of (total - caps of the sources before) / (weights from here on),
and a target is the lesser of the cap and weight * level.

Each document of a source is then taken floor(target / size) whole times, and once more
if it lies in the fractional rest: the documents in the order of a seeded hash, up to
where their words reach what is still missing. That order is never sorted as a whole: a
histogram of the hash per source finds the one bucket in which the border falls, and only
that bucket's documents are ordered. A source misses its target by half a document at
most.

Defined cases: a null text has size 0; a null source is a source of its own, the last;
a source without words has target 0 and its documents are not taken; repeated rows count
each (between rows of equal doc_id the smaller size, then the lesser hash of the text, goes first); an
empty table gives an empty result; columns of the input keep their names whatever they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import WORD_PATTERN, fresh_name, written

WEIGHTS = (3, 1, 2)  # of the sources by code point, repeating
TOTAL = 1.5  # size of the mix, as a multiple of all sizes
MAX_EPOCHS = 2.0
SEED = 7
HEX_DIGITS = 3  # of the hash that name a bucket: 4096 buckets a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
                   max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """(source, size) -> (source, size, target). The windows run over one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1)
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.lit(max_epochs) * F.col("size"))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("size").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    level = (F.lit(total) * F.sum("size").over(everything) - F.lit(max_epochs) * before) / after
    return rows.withColumn("level", level).withColumn("level", F.max("level").over(everything)) \
        .select("source", "size", F.least(F.col("cap"), F.col("weight") * F.col("level")).alias("target"))


def with_plan(docs: DataFrame, plan: str, weights: Sequence[int] = WEIGHTS, total: float = TOTAL,
              max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``docs`` with a struct ``plan``: size, source_size, target, copies."""
    work = fresh_name(docs, "mix")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.withColumn(work, F.struct(word_count(F.col("text")).alias("size"), key.alias("key"),
                                          F.substring(key, 1, HEX_DIGITS).alias("bucket"),
                                          F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("tie")))
    buckets = written(rows.groupBy(F.col("source"), F.col(f"{work}.bucket").alias("bucket"))
                      .agg(F.sum(f"{work}.size").alias("size")), "mix-buckets")
    targets = source_targets(buckets.groupBy("source").agg(F.sum("size").alias("size")), weights, total, max_epochs)
    whole = F.when(F.col("s.size") > 0, F.floor(F.col("target") / F.col("s.size"))).otherwise(F.lit(0)).cast("long")
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    steps = buckets.withColumn("reached", F.sum("size").over(up_to)).alias("b") \
        .join(targets.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source"))) \
        .select(F.col("b.source").alias("source"), "bucket", F.col("s.size").alias("source_size"), "target",
                whole.alias("whole"), (F.col("reached") - F.col("b.size")).alias("before"), "reached",
                (F.col("target") - whole * F.col("s.size")).alias("rest"))
    step = f"{work}_step"
    steps = steps.select(F.struct(*steps.columns).alias(step))
    planned = rows.join(steps, F.col("source").eqNullSafe(F.col(f"{step}.source"))
                        & (F.col(f"{work}.bucket") == F.col(f"{step}.bucket")))
    at = lambda name: F.col(f"{step}.{name}")
    below = at("reached") <= at("rest")
    border = ~below & (at("before") <= at("rest"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    words = F.col(f"{work}.size")

    def result(df: DataFrame, extra: Column) -> DataFrame:
        copies = F.when(at("source_size") > 0,
                        F.least(at("whole") + extra.cast("long"), F.lit(int(-(-max_epochs // 1)))))
        return df.select(*own, F.struct(words.alias("size"), at("source_size").alias("source_size"),
                                        at("target").alias("target"),
                                        F.coalesce(copies, F.lit(0)).cast("int").alias("copies")).alias(plan))

    ordered = Window.partitionBy("source").orderBy(f"{work}.key", "doc_id", words, f"{work}.tie") \
        .rowsBetween(Window.unboundedPreceding, 0)
    reached = f"{work}_reached"
    edge = planned.where(border).withColumn(reached, at("before") + F.sum(words).over(ordered))
    return result(planned.where(~border), below) \
        .unionByName(result(edge, F.col(reached) - words / 2 <= at("rest")))


def mix_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words in the mix)."""
    plan = with_plan(docs.select("doc_id", "text", "source"), "plan")
    return plan.select(F.col("doc_id").cast("long").alias("doc_id"), "plan.size", "plan.source_size", "plan.target",
                       (F.col("plan.copies") * F.col("plan.size")).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken, with the same columns."""
    plan = fresh_name(docs, "plan")
    return with_plan(docs, plan).withColumn(plan, F.explode(F.array_repeat(F.lit(1), F.col(f"{plan}.copies")))) \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, text,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source),
w AS (
  SELECT source, size, 2.0::DOUBLE * size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
  FROM s),
l AS (
  SELECT *, (1.5::DOUBLE * sum(size) OVER () - 2.0::DOUBLE * coalesce(sum(size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT source, size AS source_size, least(cap, weight * max(level) OVER ()) AS target FROM l),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size, md5(coalesce(d.text, ''))
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size / 2.0::DOUBLE AS mid
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size > 0 THEN least(whole + CASE WHEN mid <= target - whole * source_size THEN 1 ELSE 0 END, 2) ELSE 0 END * size AS BIGINT) AS taken
FROM p
"""
