"""Operator 3, benchmark decontamination by q-gram lemma filtering.

A document is contaminated by a benchmark passage if some stretch of it is within the
passage's edit budget. Both sides are normalised: lower case, each run of other than
letters and digits one blank. If such a stretch exists, it and the passage share
L - q + 1 - k*q character q-grams (L the passage's length, k its budget), all on diagonals
(position in the document minus position in the passage) that lie within 2k + 1 of each
other. So shared q-grams are counted in overlapping bands of diagonals, each window of
2k + 1 diagonals lying wholly in one band; bands that reach the bound are verified by a
banded semi-global alignment. The filter drops no true occurrence.

Long items are cut into overlapping passages of ``PASSAGE`` characters, any of which
counts, and items of more than ``STRETCH`` characters also into passages of that length
(about 27 words), ``STRIDE`` apart, so that any copied stretch of ``STRETCH + STRIDE - 1``
normalised characters holds a whole one, wherever it begins. An item that is found by long
passages has the least edits of these, else the least of the short ones. The benchmark is the broadcast side: it is read in parts of at most
``MAX_PART_CHARS`` characters, one pass over the documents for each part.

Defined cases: a null or empty document shares nothing; items with fewer than ``Q``
normalised characters have no q-gram and match nothing; a null item_id is reported as
null; equal items are reported each; repeated documents are reported each; an empty
table on either side gives no row; other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import id_and_text, map_batches, text_bytes, written

Q = 10
EDIT_RATE = 0.08  # edits allowed, as a share of the passage's length
PASSAGE = 512
STRETCH, STRIDE = 160, 40
MAX_PART_CHARS = 1 << 18  # of benchmark text, whose index (up to some 180 times as much) is broadcast at a time
FILTER_BITS = 21
SLICE_BYTES = 2 << 20  # of text at a time
SEGMENT = 1 << 20  # characters hashed at a time; the q-gram hashes take some forty times as much
BLOCK = 1 << 20  # postings expanded at a time
OFTEN = 8  # times that a passage may hold a q-gram that is counted by diagonals
CELL = 16  # places in a document that count as one for q-grams held more often
ALIGNED = 1 << 18  # cells of alignment tables at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FAR = 1 << 14  # cost of crossing from one document into the next
_BAND_BITS = 40
SHIFT = 2 * PASSAGE  # of diagonals, so that no band's number is negative


# --- normalised characters ---------------------------------------------------------

@lru_cache(1)
def _kinds() -> np.ndarray:
    """Code point to normalised character: 0 separates documents, 32 is any blank or sign."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalnum():
            table[c] = c
    table[0] = 0
    return table


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all texts, each with a 0 before and after; the positions of the 0s."""
    joined = "\0".join(["", *(t.replace("\0", " ") for t in texts), ""]).lower()
    chars = _kinds()[np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)]
    blank = chars == 32
    edge = chars == 0
    # a blank goes if a blank or the text's edge stands before it, or the edge after it
    drop = blank.copy()
    drop[1:] &= blank[:-1] | edge[:-1]
    drop[:-1] |= blank[:-1] & edge[1:]
    chars = chars[~drop]
    # a run of blanks before an edge leaves its first one
    tail = np.flatnonzero((chars[:-1] == 32) & (chars[1:] == 0))
    if len(tail):
        chars = np.delete(chars, tail)
    return chars, np.flatnonzero(chars == 0)


def grams(chars: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the q-gram at each position, by doubling."""
    if len(chars) < Q:
        return np.zeros(0, np.uint64)
    powers = {1: chars.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)}
    size = 1
    while size * 2 <= Q:
        h = powers[size]
        powers[size * 2] = h[:-size] * (_BASE ** np.uint64(size)) + h[size:]
        size *= 2
    out, done = powers[size], size
    while done < Q:
        size = max(s for s in powers if s <= Q - done)
        add = powers[size][done:]
        n = len(chars) - done - size + 1
        out = out[:n] * (_BASE ** np.uint64(size)) + add[:n]
        done += size
    return out ^ (out >> np.uint64(29))


# --- the benchmark ------------------------------------------------------------------

def _cuts(length: int, size: int, step: int) -> list[int]:
    """Where passages of ``size`` characters begin; the last one ends with the item."""
    return [0] if length <= size else [*range(0, length - size, step), length - size]


def _expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers first .. first + count - 1 of each row, and the row of each."""
    ends = np.cumsum(count)
    row = np.repeat(np.arange(len(count)), count)
    return np.arange(ends[-1] if len(ends) else 0) - (ends - count - first)[row], row


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their values' sums."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[new], np.add.reduceat(value, new)


class Passages:
    """The q-gram index of a bounded part of the benchmark."""

    def __init__(self, texts: list[str]):
        place: dict[bytes, int] = {}
        parts: list[np.ndarray] = []
        links: set[tuple[int, int, bool]] = set()
        for i, text in enumerate(texts):
            c = normalised([text])[0][1:-1]
            cuts = [(cut, PASSAGE) for cut in _cuts(len(c), PASSAGE, PASSAGE // 2)]
            if len(c) > STRETCH:
                cuts += [(cut, STRETCH) for cut in _cuts(len(c), STRETCH, STRIDE)]
            for cut, size in cuts:
                part = c[cut:cut + size]
                if len(part) >= Q:
                    at = place.setdefault(part.tobytes(), len(parts))
                    if at == len(parts):
                        parts.append(part)
                    links.add((at, i, size == STRETCH))
        owners, self.item, self.short = np.array(sorted(links), np.int64).reshape(-1, 3).T
        self.links = np.searchsorted(owners, np.arange(len(parts) + 1))  # of a passage: its rows of item, short
        self.length = np.array([len(p) for p in parts], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.chars = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        # the largest budget for which the lemma still asks for one shared q-gram
        self.budget = np.minimum((self.length * EDIT_RATE).astype(np.int64), (self.length - Q) // Q)
        self.step = 2 * self.budget + 1
        self.need = self.length - Q + 1 - self.budget * Q
        pos, owner = _expand(np.zeros(len(parts), np.int64), self.length - Q + 1)
        h = grams(self.chars)[self.start[owner] + pos] if len(owner) else np.zeros(0, np.uint64)
        order = np.lexsort((pos, owner, h))
        h, owner, pos = h[order], owner[order], pos[order]
        self.hashes, slot = np.unique(h, return_inverse=True)
        new = np.flatnonzero(np.append(True, (slot[1:] != slot[:-1]) | (owner[1:] != owner[:-1])))[:len(h)]
        times = np.diff(np.append(new, len(h)))
        often = times > OFTEN
        # q-grams held often: their passages; and in how many places a passage has such q-grams
        self.often_owner = owner[new][often]
        self.often_first = np.searchsorted(slot[new][often], np.arange(len(self.hashes) + 1))
        self.credit = np.bincount(self.often_owner, times[often], len(parts)).astype(np.int64)
        rest = ~np.repeat(often, times)
        self.owner, self.pos = owner[rest], pos[rest]
        self.first = np.searchsorted(slot[rest], np.arange(len(self.hashes) + 1))
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[self.hashes >> np.uint64(64 - FILTER_BITS)] = True

    def _hits(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, q-gram) of every q-gram of the benchmark."""
        places, slots = [], []
        for k in range(0, len(chars), SEGMENT):
            h = grams(chars[k:k + SEGMENT + Q - 1])
            at = np.flatnonzero(self.maybe[h >> np.uint64(64 - FILTER_BITS)])
            slot = np.searchsorted(self.hashes, h[at])
            slot[slot == len(self.hashes)] = 0
            hit = self.hashes[slot] == h[at]
            places.append(at[hit] + k)
            slots.append(slot[hit])
        return np.concatenate(places), np.concatenate(slots)

    def _counted(self, at: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage and band, shared q-grams) of a block of hits, not those held often."""
        post, row = _expand(self.first[slot], self.first[slot + 1] - self.first[slot])
        owner = self.owner[post]
        diagonal = at[row] - self.pos[post] + SHIFT  # never below the longest step
        key = owner << _BAND_BITS | diagonal // self.step[owner]
        key, count = _summed(key, np.ones(len(key), np.int64))
        # two bands hold each diagonal
        return _summed(np.concatenate([key, key - 1]), np.concatenate([count, count]))

    def _reached(self, at: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Passage and band of every diagonal on which the hits' often-held q-grams may lie."""
        some = self.often_first[slot + 1] > self.often_first[slot]
        cell = np.unique(slot[some] << _BAND_BITS | at[some] // CELL)
        slot, at = cell >> _BAND_BITS, (cell & ((1 << _BAND_BITS) - 1)) * CELL
        post, row = _expand(self.often_first[slot], self.often_first[slot + 1] - self.often_first[slot])
        owner, at = self.often_owner[post], at[row]
        low = (at - self.length[owner] + SHIFT) // self.step[owner] - 1
        high = (at + CELL - 1 + SHIFT) // self.step[owner]
        span = np.unique(np.stack([owner, low, high]), axis=1) if len(owner) else np.zeros((3, 0), np.int64)
        band, row = _expand(span[1], span[2] - span[1] + 1)
        return np.unique(span[0][row] << _BAND_BITS | band)

    def bands(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, band, shared q-grams) with enough of these; band b covers the diagonals
        from b * (2k + 1) - ``SHIFT`` on, 2 * (2k + 1) of them."""
        at, slot = self._hits(chars)
        cost = np.cumsum(self.first[slot + 1] - self.first[slot] + self.often_first[slot + 1] - self.often_first[slot])
        cuts = np.unique(np.searchsorted(cost, np.arange(0, cost[-1] + BLOCK if len(cost) else 0, BLOCK)))
        cuts = np.unique(np.concatenate([[0], cuts, [len(at)]]))
        key, count, reached = (np.zeros(0, np.int64),) * 3
        out = []
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            more, n = self._counted(at[i:j], slot[i:j])
            key, count = _summed(np.concatenate([key, more]), np.concatenate([count, n]))
            reached = np.union1d(reached, self._reached(at[i:j], slot[i:j]))
            # bands that a later hit may still reach stay open
            until = at[j] if j < len(at) else np.iinfo(np.int64).max
            done, gone = self._passed(key, until), self._passed(reached, until)
            out.append(self._enough(key[done], count[done], reached[gone]))
            key, count, reached = key[~done], count[~done], reached[~gone]
        if not out:
            return (np.zeros(0, np.int64),) * 3
        key, count = (np.concatenate(c) for c in zip(*out, strict=True))
        return key >> _BAND_BITS, key & ((1 << _BAND_BITS) - 1), count

    def _passed(self, key: np.ndarray, until: int) -> np.ndarray:
        owner, band = key >> _BAND_BITS, key & ((1 << _BAND_BITS) - 1)
        return (band + 2) * self.step[owner] - SHIFT + self.length[owner] + CELL <= until

    def _enough(self, key: np.ndarray, count: np.ndarray, reached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        credit = self.credit[reached >> _BAND_BITS]
        key, count = _summed(np.concatenate([key, reached]), np.concatenate([count, credit]))
        keep = count >= self.need[key >> _BAND_BITS]
        return key[keep], count[keep]

    def distances(self, chars: np.ndarray, owner: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each passage within its band, and where that alignment ends."""
        best, ends = np.full(len(owner), _FAR, np.int64), np.zeros(len(owner), np.int64)
        order = np.argsort(-self.length[owner], kind="stable")
        while len(order):
            size = max(1, ALIGNED // int(self.length[owner[order[0]]] + 2 * self.step[owner[order[0]]]))
            part, order = order[:size], order[size:]
            best[part], ends[part] = self._aligned(chars, owner[part], band[part])
        return best, ends

    def _aligned(self, chars, owner, band):
        """One column a pair. Costs are kept less their place in the band, so that a step along
        the text is free and one past a character of the passage costs two."""
        length, width = self.length[owner], int(2 * self.step[owner].max())
        longest = int(length.max())
        start = band * self.step[owner] - SHIFT
        where = start + np.arange(longest + width)[:, None]
        there = np.where((where >= 0) & (where < len(chars)), chars[np.clip(where, 0, len(chars) - 1)], 0)
        wanted = self.chars[self.start[owner] + np.minimum(np.arange(longest)[:, None], length - 1)]
        walls = (there == 0).any(axis=0)
        best, ends = np.full(len(owner), _FAR, np.int64), np.zeros(len(owner), np.int64)
        ramp = np.arange(width)[:, None]
        for walled in (False, True):
            pairs = np.flatnonzero(walls == walled)
            if not len(pairs):
                continue
            text, item, size = there[:, pairs], wanted[:, pairs], length[pairs]
            cost = np.repeat(-ramp, len(pairs), axis=1).astype(np.int32 if walled else np.int16)
            for i in range(longest):
                here = text[i:i + width]
                now = cost + (here != item[i])
                np.minimum(now[:-1], cost[1:] + cost.dtype.type(2), out=now[:-1])
                if walled:
                    wall = here == 0
                    run = np.cumsum(np.where(wall, _FAR, 0), axis=0, dtype=np.int32)
                    now = np.minimum.accumulate(now + wall * _FAR - run, axis=0) + run
                    cost = np.minimum(now, _FAR - ramp).astype(np.int32)
                else:
                    # least of all before, by doubling (whole rows at a time)
                    reach = 1
                    while reach < width:
                        np.minimum(now[reach:], now[:-reach], out=now[reach:])
                        reach *= 2
                    cost = now
                over = np.flatnonzero(size == i + 1)
                if len(over):
                    edits = np.where(ramp < 2 * self.step[owner[pairs[over]]], cost[:, over] + ramp, _FAR)
                    j = edits.argmin(axis=0)
                    best[pairs[over]] = edits[j, np.arange(len(over))]
                    ends[pairs[over]] = start[pairs[over]] + i + j
        return best, ends

    def verified(self, chars: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, passage, edits) of every text and passage within the passage's budget; a pair may
        come again with more edits."""
        owner, band, count = self.bands(chars)
        fewest = np.maximum(0, -(-(self.length[owner] - Q + 1 - count) // Q))
        start = band * self.step[owner] - SHIFT
        until = start + 2 * self.step[owner] + self.length[owner]
        first, last = (np.searchsorted(edges, np.clip(p, 0, edges[-1] - 1), side="right") - 1 for p in (start, until))
        # bands of one text and passage form a group; those that touch two texts are each their own
        crossing = np.cumsum(first != last) * (first != last)
        order = np.lexsort((-count, fewest, crossing, owner, first))
        owner, band, fewest, first, crossing = (a[order] for a in (owner, band, fewest, first, crossing))
        new = np.append(True, (first[1:] != first[:-1]) | (owner[1:] != owner[:-1]) | (crossing[1:] != crossing[:-1]))[:len(owner)]
        group = np.cumsum(new) - 1
        least = self.budget[owner[new]] + 1  # found so far
        text = np.zeros(len(least), np.int64)
        place = np.arange(len(owner)) - np.flatnonzero(new)[group] if len(owner) else group
        pending, done, more = np.arange(len(owner)), 0, 1
        while len(pending):
            now = pending[place[pending] < done + more]
            edits, ends = self.distances(chars, owner[now], band[now])
            better = np.lexsort((edits, group[now]))
            once = better[np.append(True, group[now][better][1:] != group[now][better][:-1])] if len(better) else better
            once = once[edits[once] < least[group[now[once]]]]
            least[group[now[once]]] = edits[once]
            text[group[now[once]]] = np.searchsorted(edges, ends[once], side="right") - 1
            done, more = done + more, more * 4
            pending = pending[(place[pending] >= done) & (fewest[pending] < least[group[pending]])]
        passage = owner[new]
        kept = least <= self.budget[passage]
        return text[kept], passage[kept], least[kept]

    def found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, item, edits), each pair of a text and an item once, with its least edits."""
        if not len(self.hashes):
            return (np.zeros(0, np.int64),) * 3
        chars, edges = normalised(texts)
        text, passage, best = self.verified(chars, edges)
        link, row = _expand(self.links[passage], self.links[passage + 1] - self.links[passage])
        text, item, short, best = text[row], self.item[link], self.short[link], best[row]
        order = np.lexsort((best, short, item, text))
        text, item, best = text[order], item[order], best[order]
        new = np.append(True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]))[:len(text)]
        return text[new], item[new], best[new]


def benchmark_parts(benchmark: DataFrame, max_chars: int = MAX_PART_CHARS) -> list[DataFrame]:
    """Rows (item_id, text) in parts of bounded size, so that each may be broadcast."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total, rows = items.agg(F.sum(F.length("text")), F.count("*")).first()
    parts = -(-max(total or 0, 64 * rows) // max_chars)
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts)))
    return [items.where(spread == p) for p in range(parts)] if parts > 1 else [items] * parts


def _texts(col: pa.Array) -> list[str]:
    return [t.decode() for t in text_bytes(col)]


def _found(docs: DataFrame, part: list) -> DataFrame:
    """(doc_id, item_id, edits) of one part of the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast((Passages([r.text for r in part]), [r.item_id for r in part]))

    def hits(batch: pa.RecordBatch) -> pa.RecordBatch:
        passages, ids = shared.value
        text, item, edits = passages.found(_texts(batch.column(1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(text)), pa.array([ids[i] for i in item], pa.int64()),
             pa.array(edits.astype(np.int32))], names=["doc_id", "item_id", "edits"])

    return map_batches(docs, "text", "doc_id long, item_id long, edits int", hits, SLICE_BYTES)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits): every document with every benchmark item it holds."""
    docs, parts = id_and_text(docs), benchmark_parts(benchmark)
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, edits int")
    for part in parts:
        found = _found(docs, part.collect())
        # of several parts each is done before the next is read
        out = found if len(parts) == 1 else out.unionByName(written(found, "contaminated"))
    return out


def _kept(docs: DataFrame, column: int, part: list, hold: bool) -> DataFrame:
    """The rows of ``docs`` whose text, in that column, holds an item of the part, or none."""
    shared = docs.sparkSession.sparkContext.broadcast(Passages([r.text for r in part]))

    def rest(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = np.full(batch.num_rows, not hold)
        keep[shared.value.found(_texts(batch.column(column)))[0]] = hold
        return batch.filter(pa.array(keep))

    return map_batches(docs, docs.columns[column], docs.schema, rest, SLICE_BYTES)


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(F.lit(salt), text) for salt in (1, 2)]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns."""
    parts, at = benchmark_parts(benchmark), docs.columns.index("text")
    if len(parts) == 1:
        return _kept(docs, at, parts[0].collect(), False)
    if not parts:
        return docs
    bad = None
    for part in parts:
        one, two = _hashes(F.col("text"))
        held = _kept(docs.select("text"), 0, part.collect(), True).select(one.alias("one"), two.alias("two")).distinct()
        held = written(held, "contaminated-texts")
        bad = held if bad is None else bad.unionByName(held)
    bad = bad.distinct()
    one, two = _hashes(docs["text"])
    return docs.join(bad, (one == bad["one"]) & (two == bad["two"]), "left_anti")
