"""Operator 6, chat formatting after cumulative-snapshot collapse.

Chat logs often hold a conversation again each time it grew. Every turn is hashed with its
position in the conversation, and the running XOR of these hashes identifies each prefix
(two independent 64-bit hashes). A conversation whose whole hash is a proper prefix of a
longer one is a snapshot of it and goes; of conversations that are equal throughout, the
one of the smallest conv_id stays. What remains is rendered in order.

Only SQL functions run here. Positions and running hashes are taken in windows of
``BUCKET`` turn numbers and carried over between them, so a conversation that holds most
turns does not end in one task; prefixes are made distinct before they are joined, so a
first turn that many conversations share costs one row. The table is read three times: the
numbers of turns, then the texts to hash them, then those of the conversations that stay.
What is hashed is written once, in narrow rows, and texts are shuffled once, by conversation
and bucket.

Defined cases: turns are ordered by number, role and hash of the text, nulls first, and
repeated rows are turns of their own; a null conv_id is a conversation; a null role renders
as "unknown" and a null text as empty, and both differ from those strings in a prefix;
marks of the template inside a text are broken up; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import written

BUCKET = 1024  # turn numbers per window and rendered row
START, END = "<|im_start|>", "<|im_end|>"


_NO_TURN = -(1 << 62)  # the bucket of turns without a number, before all others
_KEY = ["unnamed", "conv", "bucket"]  # none of them null, so that plain equality joins them


def _hash(salt: int, *values: Column) -> Column:
    """xxhash64 passes over nulls, so each value also says whether it is one."""
    return F.xxhash64(F.lit(salt), *[x for v in values for x in (v.isNull(), v)])


def _keyed(turns: DataFrame, *more: Column) -> DataFrame:
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    return turns.select(conv.isNull().alias("unnamed"), F.coalesce(conv, F.lit(0)).alias("conv"),
                        F.coalesce(F.floor(turn / BUCKET), F.lit(_NO_TURN)).alias("bucket"), *more)


def _turn(*more: Column) -> list[Column]:
    """A turn's number, role and hashes, by which turns are ordered, nulls first."""
    return [F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
            *[_hash(salt, F.col("role"), F.col("text")).alias(name) for name, salt in (("one", 1), ("two", 2))], *more]


def prefixes(turns: DataFrame) -> DataFrame:
    """The hash of each conversation's first n turns, running within its bucket, and ``before``
    turns in earlier buckets, of ``turns`` in all; ``ends`` marks a bucket's last turn. Written."""
    by_conv = Window.partitionBy("unnamed", "conv")
    earlier = by_conv.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = _keyed(turns).groupBy(*_KEY).agg(F.count("*").alias("size")) \
        .withColumns({"before": F.coalesce(F.sum("size").over(earlier), F.lit(0)), "turns": F.sum("size").over(by_conv)})
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "one", "two")]
    rows = _keyed(turns, *_turn()).withColumn("place", F.row_number().over(Window.partitionBy(*_KEY).orderBy(*order)).cast("long"))
    rows = rows.join(sizes, _KEY).withColumn("n", F.col("before") + F.col("place"))
    up_to = Window.partitionBy(*_KEY).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    running = [F.bit_xor(F.xxhash64(F.lit(salt), "n", c)).over(up_to).alias(c) for c, salt in (("one", 3), ("two", 4))]
    return written(rows.select(*_KEY, "n", "before", "turns", (F.col("place") == F.col("size")).alias("ends"), *running), "chat-prefixes")


def maximal(found: DataFrame) -> DataFrame:
    """(unnamed, conv, n_turns) of the conversations that stay, from ``prefixes``."""
    key = ["n", "one", "two"]
    later = Window.partitionBy("unnamed", "conv").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    several = found.where("ends AND (before > 0 OR n < turns)")  # buckets of conversations with more than one
    carried = several.select(*_KEY, "before", *[F.bit_xor(c).over(later).alias(f"{c}_before") for c in ("one", "two")]).where("before > 0").drop("before")
    columns = ["unnamed", "conv", "n", "turns"]
    rows = found.where("before = 0").select(*columns, "one", "two").unionByName(
        found.where("before > 0").join(carried, _KEY).select(*columns, *[F.col(c).bitwiseXOR(F.col(f"{c}_before")).alias(c) for c in ("one", "two")]))
    whole = rows.where("n = turns").groupBy(*key).agg(F.min(F.struct("unnamed", "conv")).alias("first"))
    proper = rows.where("n < turns").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("first.unnamed", "first.conv", F.col("n").alias("n_turns"))


def render(role: Column, text: Column) -> Column:
    broken = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit(START), F.coalesce(role.cast("string"), F.lit("unknown")), F.lit("\n"), broken, F.lit(END + "\n"))


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, rendered): the maximal conversations, rendered; ``part``
    counts by BUCKET turn numbers, so conversations of fewer have one row."""
    found = prefixes(turns)
    kept = found.where("ends").select(*_KEY).join(maximal(found), ["unnamed", "conv"])
    rows = _keyed(turns, F.struct(*_turn(render(F.col("role"), F.col("text")).alias("rendered"))).alias("t"))
    return rows.join(kept, _KEY).groupBy(*_KEY, "n_turns").agg(F.sort_array(F.collect_list("t")).alias("t")) \
        .select(F.when(~F.col("unnamed"), F.col("conv")).alias("conv_id"), F.when(F.col("bucket") != _NO_TURN, F.col("bucket")).alias("part"),
                "n_turns", F.array_join(F.col("t.rendered"), "").alias("rendered"))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n,
         count(*) OVER (PARTITION BY conv_id) AS n_turns,
         md5(coalesce('r' || role, '-') || chr(10) || coalesce('t' || text, '-')) AS h
  FROM conversations),
p AS (
  SELECT *, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM t),
whole AS (SELECT min(conv_id) AS conv_id, n_turns, prefix FROM p WHERE n = n_turns GROUP BY n_turns, prefix),
kept AS (
  SELECT conv_id FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.n < p.n_turns AND p.prefix = w.prefix))
SELECT t.conv_id, CAST(floor(turn / 1024) AS BIGINT) AS part, n_turns,
       string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10)
                  || replace(coalesce(text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered
FROM t JOIN kept ON t.conv_id = kept.conv_id
GROUP BY t.conv_id, CAST(floor(turn / 1024) AS BIGINT), n_turns
"""
