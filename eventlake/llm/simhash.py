"""Operator 1, SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints: ASCII-lower-cased words, 3-word shingles, 64 majority bits of their
XXH64 hashes. Equal fingerprints collapse first; the distinct ones are routed by
pigeonhole (within 3 differing bits, one of four 16-bit blocks is equal), and each
block's group is sorted by Gray rank and indexed: every upper node keeps the bits that
all fingerprints below it share, a child only the shared bits its ancestors lack, so
that a search adds up differences on the way down and drops whole groups once they
exceed the limit. Groups too large for one task are split by a further pigeonhole over
the bits that are still free; no link is lost. Links become connected components
by star contraction.

Defined cases: a null or empty text, and one without words, has fingerprint zero and
links like any other; rows with equal doc_id are rows of their own; a null doc_id
never is a component's name unless all of its documents have none; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import fresh_name, id_and_text, map_batches, text_bytes, written

BITS = 64
SEED = 42
FAN_OUT = 16
MAX_GROUP = 1 << 17  # fingerprints indexed together; larger groups are split, never cut
BLOCK = 1 << 16  # shingles counted at a time


# --- fingerprints -----------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority bits over the hashes of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    if len(words) < shingle:
        return hashed(b" ".join(words))
    n = len(words) - shingle + 1
    hashes = map(hashed, map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    counts = np.zeros(BITS, np.int64)
    for _ in range(0, n, BLOCK):
        part = np.fromiter(islice(hashes, BLOCK), np.dtype("<u8"))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255  # sums of 255 bits fit a byte
        if whole:
            counts += bits[:whole].reshape(-1, 255, BITS).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int, column: str) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long in a further column."""
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([*docs.schema.fields, StructField(column, LongType())])
    at = docs.columns.index("text")

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column(at))], np.uint64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))],
                                          names=[*batch.schema.names, column])

    return map_batches(docs, "text", schema, add)


# --- the index of one task --------------------------------------------------------

class GrayIndex:
    """Hierarchical index over groups of fingerprints that lie sorted by Gray rank."""

    def __init__(self, fps: np.ndarray, starts: np.ndarray):
        n = len(fps)
        self.fps = fps
        first, low, high = np.arange(n + 1), fps, fps
        sizes, offset = np.diff(np.append(starts, n)), np.append(starts, n)
        last = np.arange(n)
        self.levels = []  # from leaves to roots: children, last element, shared mask and bits
        self._add(first, last, low, high)
        while sizes.max(initial=0) > 1 or len(self.levels) == 1:
            parents = -(-sizes // FAN_OUT)
            up = np.concatenate(([0], np.cumsum(parents)))
            group = np.repeat(np.arange(len(sizes)), parents)
            first = offset[:-1][group] + (np.arange(up[-1]) - up[:-1][group]) * FAN_OUT
            low = np.bitwise_and.reduceat(low, first)
            high = np.bitwise_or.reduceat(high, first)
            first = np.append(first, offset[-1])
            last = last[first[1:] - 1]
            sizes, offset = parents, up
            self._add(first, last, low, high)
        for below, above in zip(self.levels, self.levels[1:], strict=False):
            parent = np.repeat(np.arange(len(above["last"])), np.diff(above["first"]))
            below["residual"] = below["mask"] & ~above["mask"][parent]
        self.levels[-1]["residual"] = self.levels[-1]["mask"]

    def _add(self, first, last, low, high):
        mask = ~(low ^ high)
        self.levels.append({"first": first, "last": last, "mask": mask, "bits": low & mask})

    def links(self, queries: np.ndarray, roots: np.ndarray, label: np.ndarray, most: int):
        """Pairs (query, later element) within ``most`` bits, apart from those that hold no
        news: nodes whose elements all carry the query's component already are passed over."""
        smallest = largest = label
        spans = [(label, label)]
        for level in self.levels[1:]:
            smallest = np.minimum.reduceat(smallest, level["first"][:-1])
            largest = np.maximum.reduceat(largest, level["first"][:-1])
            spans.append((smallest, largest))
        q, node = queries, roots
        seen = np.zeros(len(q), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            level, (lo, hi) = self.levels[depth], spans[depth]
            if depth < len(self.levels) - 1:
                first = self.levels[depth + 1]["first"]
                count = first[node + 1] - first[node]
                ends = np.cumsum(count)
                child = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
                q, seen = np.repeat(q, count), np.repeat(seen, count)
                node = np.repeat(first[node], count) + child
            seen = seen + np.bitwise_count((self.fps[q] ^ level["bits"][node]) & level["residual"][node])
            own = label[q]
            keep = (seen <= most) & (level["last"][node] > q) & ~((lo[node] == own) & (hi[node] == own))
            q, node, seen = q[keep], node[keep], seen[keep]
        return q, node


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i]; ``label`` holds each element's root."""
    while True:
        x, y = label[a], label[b]
        new = x != y
        if not new.any():
            return
        np.minimum.at(label, np.maximum(x, y)[new], np.minimum(x, y)[new])
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def local_components(fps: np.ndarray, starts: np.ndarray, most: int, block: int = 1 << 14) -> np.ndarray:
    """Root of each element within its group under links of at most ``most`` bits."""
    n = len(fps)
    label = np.arange(n)
    index = GrayIndex(fps, starts)
    group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, n)))
    rank = np.arange(n) - starts[group]
    # The first elements ask alone: a dense group is one component after few rounds, and the
    # later rounds then pass over its nodes.
    rounds = np.frexp(rank + 1)[1]
    order = np.argsort(rounds, kind="stable")
    bounds = np.flatnonzero(np.diff(rounds[order])) + 1
    for part in np.split(order, bounds):
        for k in range(0, len(part), block):
            q = part[k:k + block]
            unite(label, *index.links(q, group[q], label, most))
    return label


def _links_of_groups(most: int):
    """Task side: rows sorted by (path, key, gray) to star links (a, b) of each group."""

    def emit(key: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        root = local_components(fps.view(np.uint64), starts, most)
        far = root != np.arange(len(fps))
        return pa.RecordBatch.from_arrays([pa.array(fps[far]), pa.array(fps[root[far]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, held = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys.append(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1))
            fps.append(batch.column(2).to_numpy())
            held += batch.num_rows
            if held >= MAX_GROUP:
                key, fp = np.concatenate(keys), np.concatenate(fps)
                same = (key == key[-1]).all(axis=1)
                cut = int(np.argmax(same))  # the last group may go on in the next batch
                if cut:
                    yield emit(key[:cut], fp[:cut])
                keys, fps, held = [key[cut:]], [fp[cut:]], len(fp) - cut
        if held:
            yield emit(np.concatenate(keys), np.concatenate(fps))

    return run


# --- Spark side -------------------------------------------------------------------

def _submasks(mask: int, parts: int) -> list[int]:
    """``mask`` joined with each of ``parts`` near-equal blocks of the bits it leaves free."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    return [mask | sum(1 << b for b in block.tolist()) for block in np.array_split(free, parts) if len(block)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> 63 else x


def _gray_rank(fp: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def _routed(fps: DataFrame, most: int, max_group: int) -> DataFrame:
    """(path, key, fp): every two fingerprints within ``most`` bits share some (path, key),
    and no (path, key) has more than ``max_group`` rows."""
    parts = most + 1
    masks = _submasks(0, parts)

    def keyed(df: DataFrame, masks_of: list[list[int]]) -> DataFrame:
        # path p of the level above owns the paths p * parts ... of this one
        lists = F.array(*[F.array(*[F.struct(F.lit(p * parts + i).cast("long").alias("path"),
                                             F.lit(_signed(m)).alias("mask")) for i, m in enumerate(ms)])
                          for p, ms in enumerate(masks_of)])
        return df.select("fp", F.explode(F.element_at(lists, (F.col("path") + 1).cast("int"))).alias("m")) \
            .select("m.path", F.col("m.mask").bitwiseAND(F.col("fp")).alias("key"), "fp")

    rows = keyed(fps.select(F.lit(0).cast("long").alias("path"), "fp"), [masks])
    done, level = [], [masks]
    while True:
        sizes = written(rows.groupBy("path", "key").agg(F.count("*").alias("n"))
                        .where(F.col("n") > max_group).select("path", "key"), "simhash-hot")
        if sizes.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(sizes, ["path", "key"], "left_anti"))
        hot = rows.join(sizes, ["path", "key"], "left_semi")
        deeper = [_submasks(m, parts) for ms in level for m in ms]
        rows = written(keyed(hot, deeper), "simhash-split")
        level = deeper
    out = done[0]
    for more in done[1:]:
        # paths of different levels must not meet
        out = out.withColumn("path", F.col("path") * 2).unionByName(more.withColumn("path", F.col("path") * 2 + 1))
    return out


def star_components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): (fp, root), root the smallest, for every linked
    fingerprint. Alternates large-star and small-star steps; each is a map-side combined
    minimum and a join, and each round is written to the shared folder."""
    links = written(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "simhash-links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state or now[0] == 0:
            return links.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        state = now
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()
        links = written(small, "simhash-links")


def components(fps: DataFrame, most: int = 3, max_group: int = MAX_GROUP) -> DataFrame:
    """(fp, root) of every fingerprint that links to a smaller one; root is the smallest reachable."""
    routed = _routed(fps, most, max_group).withColumn("gray", _gray_rank(F.col("fp")))
    links = routed.repartition("path", "key").sortWithinPartitions("path", "key", "gray") \
        .select("path", "key", "fp").mapInArrow(_links_of_groups(most), "a long, b long")
    return star_components(links)


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    rows = written(with_fingerprints(id_and_text(docs), shingle, "fp").select("doc_id", "fp"), "simhash-fps")
    found = _named(rows, most)
    return rows.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(rows: DataFrame, most: int) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint."""
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = distinct.join(components(distinct.select("fp"), most), "fp", "left") \
        .select("fp", F.coalesce("root", "fp").alias("root"), "least")
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest doc_id
    (of rows that share this doc_id, or lack one, the smallest by all columns)."""
    fp, name = fresh_name(docs, "fp"), fresh_name(docs, "component")
    rows = written(with_fingerprints(docs, shingle, fp), "simhash-docs")
    narrow = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"))
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "n")
    distinct = narrow.groupBy("fp", "doc_id").agg(F.count("*").alias("n")) \
        .groupBy("fp").agg(F.min(least).alias("least")).select("fp", "least.doc_id", "least.n")
    rooted = written(distinct.join(components(distinct.select("fp"), most), "fp", "left")
                     .select("fp", F.coalesce("root", "fp").alias("root"), "doc_id", "n"), "simhash-rooted")
    best = rooted.groupBy("root").agg(F.min("doc_id").alias("best"))
    chosen = rooted.join(best, "root").where(F.col("doc_id").eqNullSafe(F.col("best")))
    tied = chosen.groupBy("root").agg(F.sum("n").alias("rows")).where("rows > 1")
    chosen = chosen.join(tied, "root", "left").select(
        F.col("fp").alias(fp), F.col("best").alias(name), F.col("root").alias(name + "_root"),
        F.col("rows").isNotNull().alias(name + "_tied"))
    own = [F.col(f"`{c}`") for c in docs.columns]

    def first(of: DataFrame) -> DataFrame:
        return rows.join(of, fp).where(F.col("doc_id").cast("long").eqNullSafe(F.col(name)))

    alone = first(chosen.where(~F.col(name + "_tied"))).select(*own)
    if tied.isEmpty():
        return alone
    order = F.struct(*[F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t and "variant" not in t])
    equal = first(chosen.where(name + "_tied")).groupBy(name + "_root") \
        .agg(F.min_by(F.struct(*own), order).alias("row")).select("row.*")
    return alone.unionByName(equal)
