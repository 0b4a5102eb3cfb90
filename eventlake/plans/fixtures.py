"""Event envelopes built by Spark from the given tables (one JSON text per row).

* ``env``  — from ``events``: account / identity / commit events with nested
  records, a list of objects (``facets``) and a list of lists (``grid``).
* ``envc`` — from ``conversations``: posts and replies; a reply names the
  previous turn's author and the first turn's author.
* ``edge`` — ``env`` with every 50th-residue class of ``event_id`` corrupted in
  one way (trailing text, cut JSON, array, null / string ``time_us``, an invalid
  UTF-8 byte, an extra blank line, an oversized record).

``to_json`` leaves NULL fields out, so rows differ in their keys, as real
events do. Every envelope is derived from every row of its table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.functions.timecols import ts_to_epoch_us

# The envelope conventions of our fixtures.
OPERATIONS = ("create", "update", "delete")
COLLECTION_OF = {
    "purchase": "app.bsky.feed.post",
    "click": "app.bsky.feed.like",
    "view": "app.bsky.feed.repost",
}
KIND_OF = {"signup": "account", "error": "identity"}
EMBEDS = (None, "images", "video", "external", "record")
CONV_T0_US = 1704067200000000
EDGE_PAD_BYTES = 2048
EDGE_MAX_BYTES = 1024


# A row of some compressed bytes becomes an envelope that takes 0.1 ms and more to build, parse
# and write.
ROWS_PER_TASK = 25_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_tasks(spark: SparkSession, sf_dir: str, name: str) -> int:
    """How many tasks the envelopes of a table are worth: by its rows, since its files have far
    fewer splits or row groups than that."""
    return max(1, math.ceil(_table(spark, sf_dir, name).count() / ROWS_PER_TASK))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table, its narrow rows dealt to as many tasks as their envelopes are worth."""
    tasks = n_tasks(spark, sf_dir, name)
    table = _table(spark, sf_dir, name)
    return table.repartition(tasks) if tasks > 1 else table


def _kind(event_type):
    c = F.when(event_type == "signup", KIND_OF["signup"])
    return c.when(event_type == "error", KIND_OF["error"]).otherwise("commit")


def env(events: DataFrame) -> DataFrame:
    """``event_id``, ``value`` (JSON text) for every row of ``events``."""
    et = F.col("event_type")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    kind = _kind(et)
    collection = F.when(et == "purchase", COLLECTION_OF["purchase"]) \
        .when(et == "click", COLLECTION_OF["click"]) \
        .when(et == "view", COLLECTION_OF["view"])
    op = F.element_at(F.array(*[F.lit(o) for o in OPERATIONS]),
                      (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int"))
    fk = lambda x: F.struct(F.struct(x.alias("k")).alias("f"))
    record = F.struct(
        F.col("value").alias("value"),
        F.struct(k.alias("k")).alias("props"),
        F.array(fk(k), fk(k + 1)).alias("facets"),
        F.array(F.array(fk(k))).alias("grid"),
    )
    commit = F.when(kind == "commit", F.struct(
        op.alias("operation"),
        collection.alias("collection"),
        F.concat(F.lit("cid"), F.col("event_id").cast("string")).alias("cid"),
        record.alias("record"),
    ))
    doc = F.struct(
        F.concat(F.lit("did:t:"), F.col("user_id").cast("string")).alias("did"),
        ts_to_epoch_us(F.col("ts")).alias("time_us"),
        kind.alias("kind"),
        commit.alias("commit"),
    )
    return events.select("event_id", F.to_json(doc).alias("value"))


def envc(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``value`` for every row of ``conversations``.

    The previous turn's and first turn's authors come from equi-joins on
    ``(conv_id, turn)`` keys rather than a window over the conversation: a
    conversation holding a large share of all turns then spreads over many
    tasks (unique join keys for the parent; AQE splits the skewed root side).
    """
    c = conversations.select("conv_id", "turn", "role", "text")
    did = lambda conv, role: F.concat(F.lit("did:t:c"), conv.cast("string"), F.lit(":"), role)
    prev = c.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("prev_role"))
    root = c.filter(F.col("turn") == 0).select("conv_id", F.col("role").alias("root_role"))
    j = c.join(prev, ["conv_id", "turn"], "left").join(root, ["conv_id"], "left")
    is_reply = F.col("turn") > 0
    reply = F.when(is_reply, F.struct(
        did(F.col("conv_id"), F.col("prev_role")).alias("parent"),
        did(F.col("conv_id"), F.col("root_role")).alias("root"),
    ))
    m = F.pmod(F.col("turn"), F.lit(5))
    embed = F.element_at(F.array(*[F.lit(e) for e in EMBEDS]), (m + 1).cast("int"))
    record = F.struct(F.col("text").alias("text"), reply.alias("reply"), embed.alias("embed"))
    commit = F.struct(
        F.lit("create").alias("operation"),
        F.lit("app.bsky.feed.post").alias("collection"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("cid"),
        record.alias("record"),
    )
    doc = F.struct(
        did(F.col("conv_id"), F.col("role")).alias("did"),
        (F.lit(CONV_T0_US) + F.col("conv_id") * F.lit(1000000000) + F.col("turn") * F.lit(1000000)).alias("time_us"),
        F.lit("commit").alias("kind"),
        commit.alias("commit"),
    )
    return j.select("conv_id", "turn", F.to_json(doc).alias("value"))


def edge(events: DataFrame) -> DataFrame:
    """``event_id``, ``value`` BINARY: ``env`` with corrupted residue classes of ``event_id % 50``.

    1 trailing text, 2 cut JSON, 3 wrapped as an array, 4 ``time_us`` null,
    5 ``time_us`` as a string, 6 an invalid UTF-8 byte, 7 a good event followed
    by a whitespace-only line (skipped by the JSON-lines source), 8 padded beyond
    ``EDGE_MAX_BYTES``; every other row is a good event. No row is dropped.
    """
    e = env(events)
    j = F.col("value")
    r = F.pmod(F.col("event_id"), F.lit(50))
    text = (F.when(r == 1, F.concat(j, F.lit(" xyz")))
            .when(r == 2, F.expr("substring(value, 1, length(value) - 5)"))
            .when(r == 3, F.concat(F.lit("["), j, F.lit("]")))
            .when(r == 4, F.regexp_replace(j, r'"time_us":-?[0-9]+', '"time_us":null'))
            .when(r == 5, F.regexp_replace(j, r'"time_us":(-?[0-9]+)', '"time_us":"$1"'))
            .when(r == 7, F.concat(j, F.lit("\n \t ")))
            .when(r == 8, F.concat(F.expr("substring(value, 1, length(value) - 1)"),
                                   F.lit(',"pad":"'), F.repeat(F.lit("x"), EDGE_PAD_BYTES), F.lit('"}')))
            .otherwise(j))
    raw = F.when(r == 6, F.concat(F.unhex(F.lit("FF")), F.encode(text, "UTF-8"))) \
        .otherwise(F.encode(text, "UTF-8"))
    return e.select("event_id", raw.alias("value"))
