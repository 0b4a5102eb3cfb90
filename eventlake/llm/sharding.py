"""Operator 11, sharding by balanced label propagation.

Documents of equal text are linked. Each begins in a shard taken from a hash; in every round
the links of a document vote with their shards, weighted, and joins bring the votes' winner
back to the documents elsewhere, which ask to move there. What moves is bounded by quotas per
pair of shards: as much as asks to move the other way, plus a share of the room that the
target has left. All documents of a group follow one winner (of equal votes another one each
round) and no move lowers the weight that its document joins. Every other round only shards with
room may win: what does not fit into a group's first shard gathers in the next one.

State is kept small: the documents of a group are cells, by ``CELLS`` hashes of doc_id and
place in the table, and a cell moves as a whole. So a group with a third of all rows is at
most ``CELLS`` rows in every join and window. Who moves under a quota is read from histograms
(by hash of the group, then by cell, so that groups move together), whose borders, one a pair
of shards, are all that the driver sees.

Documents without links need no votes. They fill what the linked ones leave of each shard's
target: the larger ones first, by intervals of their running sum, and then the small ones by
intervals of what is then left, so that shards differ by about one small document. Running sums
and slots come from windows over even hash ranges, carried over by a histogram.

``law`` says what is even: "bytes", the sum of sizes (shards differ by at most two documents
of the small class, or by the part of one document that exceeds a whole shard), or "rows", the
number of documents (shards differ by at most one). On the main path there are only DataFrame
and SQL functions.

Defined cases: a null text has no bytes and size 1, and counts as equal to an empty one; rows
of null or equal doc_id, and repeated rows, are documents of their own; a group that exceeds a
shard is spread over as few as the rounds find; the assignment is the same for the same files
(equal keys are told apart by their place); an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import written

CELLS = 4096  # of a group, and of group hashes in the histograms
ROUNDS = 12
RANGE_ROWS = 1 << 12  # rows that one window sorts, about
MAX_RANGES = 1 << 16


def _pick(values: list[int], at: Column) -> Column:
    """The value at a place from 0, never null, of a short list known to the driver."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), (at + 1).cast("int"))


def _cut(df: DataFrame, level: str, quota: list[int]) -> tuple[list[int], list[int]]:
    """Per code the first value of ``level`` at which the weights below and at it exceed the
    code's quota (CELLS: none does), and what the quota leaves for it."""
    by = Window.partitionBy("code").orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
    sums = df.groupBy("code", level).agg(F.sum("w").alias("w")).withColumn("upto", F.sum("w").over(by))
    over = sums.where(F.col("upto") > _pick(quota, F.col("code"))).groupBy("code") \
        .agg(F.min(F.struct(F.col(level), (F.col("upto") - F.col("w")).alias("below"))).alias("first"))
    border, left = [CELLS] * len(quota), [0] * len(quota)
    for r in over.collect():  # one row a code at most
        border[r.code], left[r.code] = r.first[level], quota[r.code] - r.first.below
    return border, left


def _within(df: DataFrame, quota: list[int]) -> Column:
    """Which rows (code, bucket, cell, w) fit under the quotas of their codes: whole buckets in
    order, and of the border bucket whole cells in order."""
    border, left = _cut(df, "bucket", quota)
    at_border = df.where(F.col("bucket") == _pick(border, F.col("code")))
    finer, _ = _cut(at_border, "cell", left)
    bucket, code = F.col("bucket"), F.col("code")
    return (bucket < _pick(border, code)) | ((bucket == _pick(border, code)) & (F.col("cell") < _pick(finer, code)))


def _sums(df: DataFrame, n: int, *, by: str = "shard", of: str = "w") -> list[int]:
    out = [0] * n
    for r in df.where(F.col(by).isNotNull()).groupBy(by).agg(F.sum(of).alias("sum")).collect():
        out[r[by]] = r["sum"]
    return out


def quotas(asked: list[list[int]], room: list[int]) -> list[int]:
    """Per pair (from, to), as one list: what asks the other way, and the target's room shared
    in proportion to what more there is."""
    n = len(room)
    swap = [[min(asked[i][j], asked[j][i]) for j in range(n)] for i in range(n)]
    rest = [sum(asked[i][j] - swap[i][j] for i in range(n)) for j in range(n)]
    return [swap[i][j] + (asked[i][j] - swap[i][j]) * min(room[j], rest[j]) // max(rest[j], 1) for i in range(n) for j in range(n)]


def propagate(cells: DataFrame, targets: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(link, cell, w, shard) after label propagation from such rows; ``w`` is the weight."""
    n, still = len(targets), 0
    for k in range(rounds):
        weights = _sums(cells, n)
        room = [max(0, t - w) for t, w in zip(targets, weights, strict=True)]
        votes = cells.groupBy("link", "shard").agg(F.sum("w").alias("votes")) \
            .withColumn("vote", F.struct("votes", F.xxhash64(F.lit(k), "link", "shard").alias("tie"), "shard"))
        may_win = F.lit(True)
        if k % 2:
            may_win = _pick([int(r * 16 >= t) for r, t in zip(room, targets, strict=True)], F.col("shard")) == 1
        winners = votes.where(may_win).groupBy("link").agg(F.max("vote").alias("best"))
        moves = votes.join(winners, "link").where(F.col("best") > F.col("vote")).select("link", "shard", F.col("best.shard").alias("to"))
        asked = written(cells.join(moves, ["link", "shard"], "left").select(
            "link", "cell", "w", "shard", "to", F.pmod(F.xxhash64(F.lit(k), "link"), F.lit(CELLS)).alias("bucket"),
            (F.col("shard") * n + F.coalesce("to", "shard")).alias("code")), "sharding-round")
        wish = _sums(asked.where("to IS NOT NULL"), n * n, by="code")
        quota = quotas([wish[i * n:(i + 1) * n] for i in range(n)], room)
        cells = asked
        if any(quota):
            goes = F.col("to").isNotNull() & _within(asked.where("to IS NOT NULL"), quota)
            cells = asked.withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard")))
        cells = cells.select("link", "cell", "w", "shard")
        # a round of each kind without a move: none will follow
        still = 0 if any(quota) else still + 1
        if still == 2:
            break
    return cells


def running(df: DataFrame, group: str, weight: Column, rows: int) -> DataFrame:
    """``df`` with ``before``: the sum of the weights before each row in its group, in the order
    of the hash ``spread`` (then ``row``). Windows hold even ranges of the hash."""
    ranges = 1
    while ranges < MAX_RANGES and ranges * RANGE_ROWS < rows:
        ranges *= 2
    df = df.withColumn("range", F.floor((F.shiftrightunsigned("spread", 32) * ranges) / F.lit(1 << 32)).cast("int")) \
        .withColumn("_w", weight)
    order = [F.shiftrightunsigned("spread", 32), F.col("spread"), F.col("row")]
    # at most ``MAX_RANGES`` rows a group
    sums = df.groupBy(group, "range").agg(F.sum("_w").alias("in_range"))
    carried = sums.select(group, "range", (F.sum("in_range").over(Window.partitionBy(group).orderBy("range")) - F.col("in_range")).alias("earlier"))
    within = Window.partitionBy(group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("_upto", F.sum("_w").over(within)).join(F.broadcast(carried), [group, "range"]) \
        .withColumn("before", F.col("earlier") + F.col("_upto") - F.col("_w")).drop("_upto", "_w", "earlier", "range")


def _interval(before: Column, upto: list[int]) -> Column:
    """The first shard whose end lies behind ``before``."""
    out = F.lit(len(upto) - 1)
    for k in range(len(upto) - 2, -1, -1):
        out = F.when(before < F.lit(upto[k]).cast("long"), k).otherwise(out)
    return out.cast("int")


def _ends(shares: list[int], total: int) -> list[int]:
    """The ends of intervals of ``total`` in proportion to the shares; the shares themselves if
    they add up to it."""
    whole = sum(shares) or 1
    return [s * total // whole for s in accumulate(shares)]


def filled(free: DataFrame, room: list[int], rows: int) -> DataFrame:
    """The free documents (with ``w``, ``spread``, ``row``) with a shard each, such that the
    shards' sums come near ``room``."""
    classes = sorted((r.c, r.w, r.most) for r in free.groupBy(F.floor(F.log2("w")).alias("c"))
                     .agg(F.sum("w").alias("w"), F.max("w").alias("most")).collect())  # at most 64 rows
    if not classes:
        return free.withColumn("shard", F.lit(None).cast("int"))
    # small: what weighs several times what the larger ones can leave uneven
    small, upto = classes[-1][0], 0
    for i, (c, w, _) in enumerate(classes[:-1]):
        upto += w
        if upto >= 4 * len(room) * classes[-1][2]:
            small = classes[i][0]
            break
    ranked = written(running(free.withColumn("large", F.floor(F.log2("w")) > small), "large", F.col("w"), rows), "sharding-free")
    total = {large: sum(w for c, w, _ in classes if (c > small) == large) for large in (False, True)}
    first = _interval(F.col("before"), _ends(room, total[True]))
    taken = _sums(ranked.where("large").withColumn("shard", first), len(room))
    left = [max(0, r - t) for r, t in zip(room, taken, strict=True)]
    rest = _interval(F.col("before"), _ends(left if any(left) else [1] * len(room), total[False]))
    return ranked.withColumn("shard", F.when(F.col("large"), first).otherwise(rest))


def shard(docs: DataFrame, shards: int = 8, law: str = "bytes", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if law not in ("bytes", "rows"):
        raise ValueError("law is bytes or rows")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("link"),
                       F.monotonically_increasing_id().alias("row"))
    # the place in the table is fixed by this file: later stages may be run again
    rows = written(rows, "sharding-rows").withColumn("spread", F.xxhash64("doc_id", "row")) \
        .withColumn("cell", F.pmod("spread", F.lit(CELLS))).withColumn("w", F.col("size") if law == "bytes" else F.lit(1).cast("long"))
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("w"), F.lit(0))).first()
    targets = [total // shards + (k < total % shards) for k in range(shards)]
    cells = rows.groupBy("link", "cell").agg(F.sum("w").alias("w"), F.count("*").alias("n")) \
        .withColumn("linked", F.sum("n").over(Window.partitionBy("link"))).where("linked > 1")
    cells = written(cells.select("link", "cell", "w", F.pmod(F.xxhash64(F.lit(-1), "link", "cell"), F.lit(shards)).cast("int").alias("shard")),
                    "sharding-cells")
    cells = propagate(cells, targets, rounds).withColumn("code", F.col("shard")).withColumn("bucket", F.pmod(F.xxhash64("link"), F.lit(CELLS)))
    cells = written(cells.where(_within(cells, targets)).select("link", "cell", "shard"), "sharding-placed")
    placed = written(rows.join(cells, ["link", "cell"], "left").select("doc_id", "size", "text_crc32", "row", "spread", "w", "shard"), "sharding-joined")
    room = [t - w for t, w in zip(targets, _sums(placed, shards), strict=True)]
    own = ["doc_id", "size", "text_crc32", "row", "spread", "shard"]
    free = filled(placed.where("shard IS NULL").drop("shard"), room, n)
    whole = placed.where("shard IS NOT NULL").select(*own).unionByName(free.select(*own))
    return running(whole, "shard", F.lit(1).cast("long"), n).select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", F.col("before").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
