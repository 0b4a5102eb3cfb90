"""Operator 12, periodic runs of words, by scale-tiled distribution.

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST, 3 * q)`` words that no neighbouring word extends. Periods are taken by octave
[P, 2P), the first one [1, 8). A run of such a period holds a whole block of P (at least 8)
words that starts at a multiple of P and stands again q words later. So each octave is
covered by tiles: a tile is anchored at a multiple of P, its boundary, and spans the 2P words
before and the 4P words after it. Tiles are solved one by one, all tiles of a piece of text at
a time in numpy:

* hashes of 2^k words, from those of half as many, find the periods at which the boundary's
  block recurs; a period of which a proper divisor already is one of the tile goes;
* boundary Z-functions, forward and backward, say how far the words at the boundary and q
  words later agree, up to 2P either way; they are taken from the hashes by halving steps;
* the agreement, as an interval, is a fragment, unless it ends within the tile on both sides
  and is too short for a run.

Fragments are shuffled by document and period and stitched where they meet; what is long
enough is a run. Documents of at most ``TILE_WORDS`` words are exploded into tiles within
their task; longer ones into pieces per octave, which other tasks solve. Fragments of one
piece that meet are joined before the shuffle, so a (document, period) key has at most
one row per piece and stretch. The runs of a document go back to its text to collapse it;
texts without fragments are finished in the first pass and never shuffled. Documents are
known by two 64-bit hashes of doc_id and text, so repeated rows are solved alike.

Words are compared by hashes of 64 bits; other collisions than equal words are not expected
below 2^32 words a text. Memory: a piece holds its hashes at every power of two up to 2P,
that is about 8 bytes x log2(2P) a word.

Defined cases: a null or empty text, or one of white space, has no words, no runs and the
hash of the empty text; white space is the six ASCII characters; rows of null or equal doc_id
are kept each (many equal ones make the join of texts and runs skewed, which Spark splits: both
sides come from files); runs are listed by start and period, however many; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import id_and_text, pieces, release, text_bytes, uncollected, written
from eventlake.llm.textstats import word_ids

LEAST, TIMES = 24, 3
BLOCK = 8  # the shortest block; a run of LEAST words and a period below it holds one too
TILE_WORDS = 1 << 18  # longer documents go to several tasks
SLICE_BYTES = 2 << 20  # of text at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def octaves(n: int) -> list[int]:
    """The least periods of the octaves that a text of n words can have runs of (the first
    stands for all periods below it, too)."""
    out, p = [BLOCK // 2], BLOCK
    while TIMES * p <= n:
        out.append(p)
        p *= 2
    return out if n >= LEAST else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Hashes:
    """Hashes of all windows of 2^k words; ``level(k)[i]`` is that of words i, i + 1, ..."""

    def __init__(self, ids: np.ndarray):
        self.levels = [_mix((ids.astype(np.uint64) + np.uint64(1)) * _ODD)]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            h, size = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(_mix(h[:-size] * _ODD + h[size:]) if len(h) > size else h[:0])
        return self.levels[k]

    def equal(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        h = self.level(k)
        return h[i] == h[j]

    def agree(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """The boundary Z-functions: how many words from i on agree with those from j on
        (back: that end before i and before j), at most ``most``."""
        done = np.zeros(len(i), np.int64)
        if not len(i):
            return done
        for k in range(int(most.max()).bit_length() - 1, -1, -1):
            size = 1 << k
            fits = np.flatnonzero(done + size <= most)
            shift = -done[fits] - size if back else done[fits]
            done[fits[self.equal(k, i[fits] + shift, j[fits] + shift)]] += size
        return done


def _smallest_factor(upto: int) -> np.ndarray:
    out = np.zeros(upto + 1, np.int64)
    for p in range(2, upto + 1):
        if p * p > upto:
            break
        if out[p] == 0:
            rest = out[p * p::p]
            rest[rest == 0] = p
    left = out == 0
    out[left] = np.flatnonzero(left)
    return out


def _primitive(h: Hashes, at: np.ndarray, q: np.ndarray, block: int) -> np.ndarray:
    """Which of the repeats (block at ``at`` and again q later) have no proper divisor of q as
    a period of all the words from the one block to the other's end. ``q`` is below two blocks,
    so two windows of a block show it."""
    keep, rest, factor = np.ones(len(q), bool), q.copy(), _smallest_factor(int(q.max(initial=1)))
    k = block.bit_length() - 1
    while True:
        todo = np.flatnonzero(keep & (rest > 1))
        if not len(todo):
            return keep
        prime = factor[rest[todo]]
        rest[todo] //= prime
        d = q[todo] // prime
        last = at[todo] + np.maximum(q[todo] - d - block, 0)
        keep[todo[h.equal(k, at[todo], at[todo] + d) & h.equal(k, last, last + d)]] = False


def fragments(ids: np.ndarray, of: np.ndarray, first: np.ndarray, size: np.ndarray, lowest: list[int],
              anchors: tuple[int, int] | None = None) -> list[tuple[np.ndarray, ...]]:
    """Fragments (text, period, start, end) over texts laid end to end: ``of`` is each word's
    text, ``first`` and ``size`` a text's first word and length. A fragment says that the words
    from start to end equal those a period later. Only tiles whose boundary lies in ``anchors``
    are solved."""
    h, out = Hashes(ids), []
    for low in lowest:
        block = max(low, BLOCK)
        # boundaries count from the text's first word
        per_text = -(-size // block)
        text = np.repeat(np.arange(len(size)), per_text)
        at = (np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)) * block + first[text]
        if anchors:
            inside = (at >= anchors[0]) & (at < anchors[1])
            text, at = text[inside], at[inside]
        end = first[text] + size[text]
        windows = h.level(block.bit_length() - 1)
        found_at, found_q, found_text = [], [], []
        periods = range(1, BLOCK) if low < BLOCK else [low]
        step = 1 if low < BLOCK else low
        for q0 in periods:
            # all periods q0 .. q0 + step - 1 of some tiles at a time
            tiles = max(1, (1 << 20) // step)
            for lo in range(0, len(at), tiles):
                fits = at[lo:lo + tiles] + q0 + block <= end[lo:lo + tiles]
                x, t, e = at[lo:lo + tiles][fits], text[lo:lo + tiles][fits], end[lo:lo + tiles][fits]
                if not len(x):
                    continue
                to = x[:, None] + np.arange(q0, q0 + step)
                same = windows[np.minimum(to, len(windows) - 1)] == windows[x][:, None]
                same &= to + block <= e[:, None]
                i, j = np.nonzero(same)
                found_at.append(x[i])
                found_q.append(j + q0)
                found_text.append(t[i])
        if not found_at:
            continue
        x, q, t = map(np.concatenate, (found_at, found_q, found_text))
        keep = _primitive(h, x, q, block)
        x, q, t = x[keep], q[keep], t[keep]
        ahead = h.agree(x, x + q, np.minimum(2 * block, first[t] + size[t] - x - q))
        behind = h.agree(x, x + q, np.minimum(2 * block, x - first[t]), back=True)
        # bounded on both sides within the tile, it is known whole
        long = (ahead == 2 * block) | (behind == 2 * block) | (ahead + behind >= np.maximum(LEAST - q, (TIMES - 1) * q))
        x, q, t, ahead, behind = (v[long] for v in (x, q, t, ahead, behind))
        out.append((t, q, x - behind - first[t], x + ahead - first[t]))
    return out


def joined(text: np.ndarray, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one text and period that overlap or touch, as one."""
    order = np.lexsort((start, period, text))
    text, period, start, end = (v[order] for v in (text, period, start, end))
    if not len(text):
        return text, period, start, end
    same = (text[1:] == text[:-1]) & (period[1:] == period[:-1])
    group = np.concatenate([[0], np.cumsum(~same)])
    # the furthest end so far, within the group
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    opens = np.concatenate([[True], ~same | (start[1:] > reach[:-1])])
    at = np.flatnonzero(opens)
    return text[at], period[at], start[at], np.maximum.reduceat(end, at)


# --- the first pass: texts into tiles ------------------------------------------------

_FIRST = ("doc_id long, one long, two long, n long, text binary, collapsed string, period long, start long, end long, "
          "low int, base long, lo long, hi long, ids binary")
_FIELDS = pa.schema([("doc_id", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("n", pa.int64()), ("text", pa.binary()),
                     ("collapsed", pa.string()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("low", pa.int32()),
                     ("base", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("ids", pa.binary())])


def _rows(count: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(count, f.type) for f in _FIELDS],
                                      schema=_FIELDS)


def tiles_of(n: int, tile: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(least period, first word, last word, first boundary, last boundary) of the pieces of a
    long text. A piece holds a run of tiles of one octave; it is ``tile`` words long, or as long
    as one boundary's tile needs."""
    for low in octaves(n):
        block = max(low, BLOCK)
        step = max(1, tile // block) * block
        for lo in range(0, n, step):
            # a repeat is two periods wide at most, beyond the furthest agreement
            yield low, max(0, lo - 2 * block), min(n, lo + step + 4 * block), lo, min(n, lo + step)


def _explode(rewrite: Rewrite | None):
    """Texts into header rows, fragments of the short ones and pieces of the long ones."""

    def solve(batch: pa.RecordBatch, docs: list[int], words: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(words[i]) for i in docs], np.int64)
        first = np.cumsum(size) - size
        flat = [w for i in docs for w in words[i]]
        ids = word_ids(flat)
        # nothing can agree across texts: agreement is bounded by the text, blocks are checked
        parts = fragments(ids, np.repeat(np.arange(len(docs)), size), first, size, octaves(int(size.max(initial=0))))
        if parts:
            text, period, start, end = joined(*map(np.concatenate, zip(*parts, strict=True)))
        else:
            text = period = start = end = np.zeros(0, np.int64)
        keys = [batch.column(k).take(pa.array(docs, pa.int64())) for k in (0, 2, 3)]
        with_some = np.bincount(text, minlength=len(docs)) > 0
        whole = [b" ".join(words[i]) for i in docs]
        yield _rows(len(docs), doc_id=keys[0], one=keys[1], two=keys[2], n=size,
                    text=[w if f else None for w, f in zip(whole, with_some.tolist(), strict=True)],
                    collapsed=[None if f else hashlib.sha256(w).hexdigest() for w, f in zip(whole, with_some.tolist(), strict=True)])
        if len(text):
            at = pa.array(text)
            yield _rows(len(text), one=keys[1].take(at), two=keys[2].take(at), period=period, start=start, end=end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", SLICE_BYTES):
            with uncollected():
                ids = batch.column(0).to_pylist()
                words = [t.split() for t in text_bytes(batch.column(1))]
                if rewrite:
                    words = [rewrite(d, w) for d, w in zip(ids, words, strict=True)]
                groups: dict[int, list[int]] = {}
                for i, w in enumerate(words):
                    if len(w) > TILE_WORDS:
                        one, two = batch.column(2)[i].as_py(), batch.column(3)[i].as_py()
                        yield _rows(1, doc_id=[ids[i]], one=[one], two=[two], n=[len(w)], text=[b" ".join(w)])
                        numbers = word_ids(w).astype("<i4")
                        for low, base, stop, lo, hi in tiles_of(len(w), TILE_WORDS):
                            yield _rows(1, one=[one], two=[two], low=[low], base=[base], lo=[lo], hi=[hi],
                                        ids=[numbers[base:stop].tobytes()])
                    else:
                        # texts of like length share their octaves
                        groups.setdefault(len(octaves(len(w))) // 2, []).append(i)
                for docs in groups.values():
                    yield from solve(batch, docs, words)
                del words
        release()
    return run


def _solve_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "ids", 1):
        row = batch.slice(0, 1).to_pylist()[0]
        ids = np.frombuffer(row["ids"], "<i4").astype(np.int64)
        size = np.array([len(ids)])
        # boundaries are multiples of the block, and so is the piece's first word
        parts = fragments(ids, np.zeros(len(ids), np.int64), np.zeros(1, np.int64), size, [row["low"]],
                          (row["lo"] - row["base"], row["hi"] - row["base"]))
        if parts:
            _, period, start, end = joined(*map(np.concatenate, zip(*parts, strict=True)))
            n = len(period)
            yield pa.RecordBatch.from_arrays([pa.array([row["one"]] * n, pa.int64()), pa.array([row["two"]] * n, pa.int64()), pa.array(period),
                                              pa.array(start + row["base"]), pa.array(end + row["base"])],
                                             ["one", "two", "period", "start", "end"])
    release()


# --- stitching and the documents' runs ------------------------------------------------

def stitched(frags: DataFrame) -> DataFrame:
    """(one, two, start, length, period): the runs. Fragments that overlap or touch are one
    agreement; a run is a period longer."""
    key = ["one", "two", "period"]
    before = Window.partitionBy(*key).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    marked = frags.distinct().withColumn("opens", F.when(F.col("start") <= F.max("end").over(before), 0).otherwise(1)) \
        .withColumn("stretch", F.sum("opens").over(upto))
    whole = marked.groupBy(*key, "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.select("one", "two", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period") \
        .where((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


_OUT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
        "runs_sha256 string, collapsed_sha256 string")


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _OUT.split(", ")]
    types = [pa.string() if f.endswith("string") else pa.int64() for f in _OUT.split(", ")]
    for batch in pieces(batches, "text", 4 << 20):
        out = []
        for doc, text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = text.split()
            runs = sorted((r["start"], r["length"], r["period"]) for r in runs or [])
            dropped = np.zeros(len(words) + 1, np.int64)
            for start, length, period in runs:
                dropped[start + period] += 1
                dropped[start + length] -= 1
            kept = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(dropped[:-1]) == 0).tolist()]) if runs else text
            best = None
            for r in runs:  # in order of start and period, so the first of equals stays
                if best is None or r[1] * best[2] > best[1] * r[2]:
                    best = r
            listing = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
            out.append((doc, len(words), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                        hashlib.sha256(listing.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
    release()


def runs(docs: DataFrame, rewrite: Rewrite | None = None) -> tuple[DataFrame, DataFrame]:
    """The written first pass and (one, two, start, length, period) of every run."""
    keyed = id_and_text(docs).select("doc_id", "text", *[F.xxhash64(F.lit(salt), "doc_id", "text").alias(c)
                                                         for c, salt in (("one", 1), ("two", 2))])
    first = written(keyed.mapInArrow(_explode(rewrite), _FIRST), "periodic-tiles")
    frags = ["one", "two", "period", "start", "end"]
    near = first.where("period IS NOT NULL").select(*frags)
    # one piece of a long text a row: they spread over the tasks whatever text they are of
    far = first.where("ids IS NOT NULL").select("one", "two", "low", "base", "lo", "hi", "ids").repartition("one", "low", "lo") \
        .mapInArrow(_solve_pieces, "one long, two long, period long, start long, end long")
    return first, stitched(near.unionByName(far))


def collapse(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per row of ``docs``: its number of runs, the one repeated most often, a hash of
    all and a hash of the text with every run cut to its first period. ``rewrite`` may give
    the words to use in place of a text's own."""
    first, found = runs(docs, rewrite)
    heads = first.where("n IS NOT NULL")
    lists = written(found.groupBy("one", "two").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs")), "periodic-runs")
    periodic = heads.where("text IS NOT NULL").select("doc_id", "one", "two", "text").join(lists, ["one", "two"], "left") \
        .select("doc_id", "text", "runs").mapInArrow(_collapse, _OUT)
    # few and narrow rows: read from files, they go to fewer tasks than the join's, and are not made anew by each reader
    periodic = written(periodic, "periodic-rows")
    none = F.lit(None).cast("long")
    plain = heads.where("text IS NULL").select(
        "doc_id", F.col("n").alias("n_words"), F.lit(0).cast("long").alias("n_runs"), *[none.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
    return periodic.unionByName(plain)
