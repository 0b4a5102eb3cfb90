"""Operator 13, alignment of two tokenizers.

Every text is encoded by a byte-level BPE file (side A) and by a sentencepiece model (side B).
Token lengths in bytes give each token's byte range. Per batch, one ``pandas.merge_asof`` a
direction, keyed by document, takes each token's start to the covering token of the other
side; the union of both directions is the table of overlapping tokens. Overlapping tokens
that also end together are links, and their ends cut the text into groups.

Both sides part a text at a blank after other than white space, which is checked on the files.
So a distinct cut is encoded once and kept for a while; texts with a cut whose bytes do not
come out the same are encoded whole.

How often the corpus links an id pair is counted in two levels, per task and then by pair.
Tokens that end together are one a suffix of the other in bytes, so the vocabularies alone
say which pairs can ever be linked: at most the sum of all token lengths, times the ids that
may have the same bytes. This gives each pair its number, bounds the counts that a task holds,
and bounds the table of counts that the second pass gets by broadcast
(``Vocabularies.n_pairs``; below a million for the files used here, whatever the corpus). Links travel between the passes as these numbers,
in a written table, so nothing is encoded twice and no text is shuffled.

Defined cases: a null or empty text, and one whose tokens' bytes are not a blank and the text
(the model normalises it, or it holds U+2581), has no tokens and zeros; strings of special
tokens are plain text; rows of null or equal doc_id are kept each, and each row's links count;
texts longer than a slice form a slice of their own; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import broadcast_bytes, id_and_text, pieces, release, text_bytes, uncollected, written
from eventlake.llm.token_counts import _byte_letters

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 1 << 20  # of text at a time: a token takes some hundred bytes on the way
MEMO_BYTES, NEW_CUTS = 48 << 20, 1 << 14  # of cuts whose ids a task keeps; of cuts encoded at a time


class Vocabularies:
    """Both tokenizers, their tokens' bytes and the id pairs that can be linked."""

    _kept: tuple[bytes, bytes, Vocabularies] | None = None

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_buffer(a)
        self.a.encode_special_tokens = True
        added = {t["id"]: t["content"] for t in json.loads(a).get("added_tokens") or []}
        letters = _byte_letters()
        self.a_bytes = [b""] * (1 + max(self.a.get_vocab(with_added_tokens=True).values()))
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = token.encode() if i in added else bytes(map(letters.__getitem__, token))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.get_piece_size())))]
        self.a_len, self.b_len = (np.array([*map(len, x)], np.int64) for x in (self.a_bytes, self.b_bytes))
        self.a_same, self.b_same = _Same(self.a_bytes), _Same(self.b_bytes)
        of_a, of_b = self.a_len * self.b_same.most, self.b_len * self.a_same.most
        self.a_first, self.b_first = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b + int(of_a.sum())
        self.n_pairs = int(of_a.sum() + of_b.sum())
        self.parts, self.memo = self._parts(json.loads(a)), Memo(self)
        # a token's decimal id after each mark that may stand before it
        self.ids = max(len(self.a_bytes), len(self.b_bytes))
        self.marked = [m + b"%d" % i for m in (b",", b";", b"|", b"") for i in range(self.ids)]

    @classmethod
    def of(cls, a: bytes, b: bytes) -> Vocabularies:
        if cls._kept is None or cls._kept[:2] != (a, b):
            cls._kept = a, b, cls(a, b)
        return cls._kept[2]

    def _parts(self, how: dict) -> bool:
        """Whether both sides part at a blank after other than white space: the byte-level file
        has the usual pattern, and no piece of the model has a blank after another character."""
        pre = how.get("pre_tokenizer") or {}
        usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not how.get("normalizer")
        return usual and not any(b" " in p.lstrip(b" ") for p in self.b_bytes)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The numbers of id pairs of which one is a suffix of the other: the longer side's token
        and the length of the shorter say which, but for ids that have the same bytes."""
        x, y = self.a_len[a], self.b_len[b]
        return np.where(y <= x, self.a_first[a] + (y - 1) * self.b_same.most + self.b_same.rank[b],
                        self.b_first[b] + (x - 1) * self.a_same.most + self.a_same.rank[a])

    def b_of(self) -> np.ndarray:
        """The B id of every number that a pair has (-1: none has it)."""
        out = np.full(self.n_pairs, -1, np.int64)
        by_bytes: list[dict[bytes, list[int]]] = []
        for side in (self.a_bytes, self.b_bytes):
            by_bytes.append({})
            for i, x in enumerate(side):
                by_bytes[-1].setdefault(x, []).append(i)
        found = [(i, j) for i, x in enumerate(self.a_bytes) for k in range(len(x)) for j in by_bytes[1].get(x[k:], ())]
        found += [(i, j) for j, x in enumerate(self.b_bytes) for k in range(1, len(x)) for i in by_bytes[0].get(x[k:], ())]
        a, b = np.array(found, np.int64).T
        out[self.numbers(a, b)] = b
        return out


class _Same:
    """Each id's rank among those of the same bytes, and the greatest number of such."""

    def __init__(self, tokens: list[bytes]):
        seen: Counter[bytes] = Counter()
        self.rank = np.zeros(len(tokens), np.int64)
        for i, t in enumerate(tokens):
            self.rank[i] = seen[t]
            seen[t] += 1
        # no token is empty but those that never stand in a text
        self.most = max(n for t, n in seen.items() if t)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([*map(len, rows)], np.int64)
    return np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum())), sizes


def _whole(vocab: Vocabularies, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
    """Both sides' ids as the libraries give them, and whether either side has the bytes of a
    blank and the text."""
    strings = [t.decode() for t in texts]
    a = [e.ids for e in vocab.a.encode_batch_fast([" " + s for s in strings], add_special_tokens=False)]
    b = vocab.b.encode(strings, num_threads=1)
    good = [all(b"".join(map(table.__getitem__, x)) == b" " + t for x, table in ((i, vocab.a_bytes), (j, vocab.b_bytes)))
            for t, i, j in zip(texts, a, b, strict=True)]
    return a, b, np.array(good, bool)


_SPACE = rb"[\x00-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
_CUT = re.compile(rb"(?<!^)(?<![\x00-\x20])(?<!\xc2[\x85\xa0])(?<!\xe1\x9a\x80)(?<!\xe2\x80[\x80-\x8a\xa8\xa9\xaf])"
                  rb"(?<!\xe2\x81\x9f)(?<!\xe3\x80\x80) (?!$)")
_LAST = re.compile(rb"(?:" + _SPACE + rb")$")


def uncut(texts: list[bytes]) -> np.ndarray:
    """Which texts have a blank that does not part them: after white space, or at an end."""
    whole = b"   " + b" ".join(texts)
    at = np.frombuffer(whole, np.uint8)
    blank = np.flatnonzero(at[3:] == 32) + 3
    one, two, three = at[blank - 1], at[blank - 2], at[blank - 3]
    high = (two == 0xC2) & ((one == 0x85) | (one == 0xA0)) | (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    high |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
    high |= (three == 0xE2) & (two == 0x81) & (one == 0x9F) | (three == 0xE3) & (two == 0x80) & (one == 0x80)
    ends = np.cumsum([len(t) + 1 for t in texts])  # of each text, with the blank that was put after it
    out = np.zeros(len(texts) + 1, bool)
    out[np.searchsorted(ends, blank[(one <= 32) | high] - 3, "right")] = True
    return out[:-1] | np.array([t.endswith(b" ") for t in texts], bool)


def cuts_of(texts: list[bytes]) -> list[list[bytes]]:
    """Texts at their blanks after other than white space: there the pattern of byte-level files
    begins a pre-token, and no piece of the model goes on."""
    return [_CUT.split(t) if odd else t.split(b" ") for t, odd in zip(texts, uncut(texts).tolist(), strict=True)]


class Memo:
    """Both sides' ids of cuts, end to end, kept from slice to slice up to ``MEMO_BYTES``."""

    def __init__(self, vocab: Vocabularies):
        self.vocab = vocab
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = [np.zeros(0, np.int64)] * 2
        self.ends = [np.zeros(1, np.int64)] * 2
        self.good, self.held = np.zeros(0, bool), 0

    def places(self, cuts: list[bytes]) -> np.ndarray:
        if self.held > MEMO_BYTES:
            self.clear()
        found = [*map(self.place.get, cuts)]
        if None in found:
            missing = [i for i, x in enumerate(found) if x is None]
            new = [*{cuts[i]: None for i in missing}]
            for lo in range(0, len(new), NEW_CUTS):
                self._learn(new[lo:lo + NEW_CUTS])
            for i in missing:
                found[i] = self.place[cuts[i]]
        return np.array(found, np.int64)

    def _together(self, new: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Both sides' ids of the cuts and each one's number of them, from one text of them
        all; nothing if its tokens do not part where the cuts do."""
        text = b" ".join(new)
        string, want, sides = text.decode(), b" " + text, []
        ends = np.cumsum(np.array([*map(len, new)], np.int64) + 1)
        for ids, table, lengths in ((self.vocab.a.encode(" " + string, add_special_tokens=False).ids, self.vocab.a_bytes, self.vocab.a_len),
                                    (self.vocab.b.encode(string), self.vocab.b_bytes, self.vocab.b_len)):
            if b"".join(map(table.__getitem__, ids)) != want:
                return None
            ids = np.array(ids, np.int64)
            after = np.cumsum(lengths[ids])
            last = np.searchsorted(after, ends)
            if (after[last] != ends).any():
                return None
            sides.append((ids, np.diff(last, prepend=-1)))
        return sides

    def _learn(self, new: list[bytes]) -> None:
        # one that ends in white space, at the end of its text, may not stand before another
        last = {c for c in new if c[-1] < 33 or c[-1] > 127 and _LAST.search(c[-3:])}
        plain = [c for c in new if c not in last] if last else new
        sides = self._together(plain) if plain else None
        if sides:
            self._add(plain, sides, np.ones(len(plain), bool))
        for some in ([*last], [] if sides else plain):
            *lists, good = _whole(self.vocab, some)
            self._add(some, [_flat(side) for side in lists], good)

    def _add(self, new: list[bytes], sides: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray) -> None:
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
        self.good = np.concatenate([self.good, good])
        self.held += sum(map(len, new)) + 100 * len(new)
        for k, (ids, sizes) in enumerate(sides):
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(sizes)])
            self.ids[k] = np.concatenate([self.ids[k], ids])

    def ids_at(self, k: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Side k's ids of the cuts at ``places``, end to end, and each cut's number of them."""
        begin, sizes = self.ends[k][places], np.diff(self.ends[k])[places]
        total = np.cumsum(sizes)
        return self.ids[k][np.arange(int(sizes.sum())) + np.repeat(begin - total + sizes, sizes)], sizes


def encoded(vocab: Vocabularies, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts on both sides and each text's number of them (0 on both sides where
    the bytes of a side differ from a blank and the text)."""
    cuts = [c if t and vocab.parts else [] for t, c in zip(texts, cuts_of(texts), strict=True)]
    sizes = np.array([*map(len, cuts)], np.int64)
    of = np.repeat(np.arange(len(texts)), sizes)
    places = vocab.memo.places([*chain.from_iterable(cuts)])
    # a text with a cut that does not come out the same is left to the libraries as a whole
    alone = np.array([bool(t) and not vocab.parts for t in texts], bool)
    alone[of[~vocab.memo.good[places]]] = True
    kept = ~alone[of]
    sides = []
    for k in range(2):
        ids, n = vocab.memo.ids_at(k, places[kept])
        sides.append((ids, np.bincount(of[kept], weights=n, minlength=len(texts)).astype(np.int64)))
    if alone.any():
        some = np.flatnonzero(alone).tolist()
        *whole, good = _whole(vocab, [texts[i] for i in some])
        for k, (ids, n) in enumerate(sides):
            rows = np.split(ids, np.cumsum(n)[:-1])
            for i, new, fine in zip(some, whole[k], good.tolist(), strict=True):
                rows[i] = np.array(new if fine else [], np.int64)
            sides[k] = np.concatenate(rows), np.array([*map(len, rows)], np.int64)
    return *sides[0], *sides[1]


def _covering(left: np.ndarray, left_doc: np.ndarray, right: np.ndarray, right_doc: np.ndarray) -> np.ndarray:
    """For each start on the left the place of the right side's token that covers it."""
    found = pd.merge_asof(pd.DataFrame({"start": left, "doc": left_doc}),
                          pd.DataFrame({"start": right, "doc": right_doc, "place": np.arange(len(right))}),
                          on="start", by="doc", direction="backward")
    return found["place"].to_numpy().astype(np.int64)


def overlaps(a_ends: np.ndarray, a_doc: np.ndarray, b_ends: np.ndarray, b_doc: np.ndarray,
             a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of all tokens that share a byte, each pair once: the union of what
    covers A's starts and what covers B's. Ends are running byte counts over the batch; both
    sides of a document have the same bytes."""
    a_starts, b_starts = a_ends - a_len, b_ends - b_len
    of_a = _covering(a_starts, a_doc, b_starts, b_doc)
    of_b = _covering(b_starts, b_doc, a_starts, a_doc)
    later = b_starts > a_starts[of_b]  # equal starts are in the first direction already
    return np.concatenate([np.arange(len(a_ends)), of_b[later]]), np.concatenate([of_a, np.flatnonzero(later)])


class Aligned:
    """A batch's tokens, overlaps and links."""

    def __init__(self, vocab: Vocabularies, texts: list[bytes]):
        self.vocab = vocab
        self.a, self.n_a, self.b, self.n_b = encoded(vocab, texts)
        docs = np.arange(len(texts))
        self.a_doc, self.b_doc = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        a_len, b_len = vocab.a_len[self.a], vocab.b_len[self.b]
        self.a_end, self.b_end = np.cumsum(a_len), np.cumsum(b_len)
        self.in_a, self.in_b = overlaps(self.a_end, self.a_doc, self.b_end, self.b_doc, a_len, b_len) \
            if len(self.a) else (np.zeros(0, np.int64),) * 2
        linked = self.a_end[self.in_a] == self.b_end[self.in_b]
        order = np.argsort(self.in_a[linked])
        # places of the linked tokens, in text order: the groups' last tokens
        self.link_a, self.link_b = self.in_a[linked][order], self.in_b[linked][order]
        self.n_links = np.bincount(self.a_doc[self.link_a], minlength=len(texts))
        self.links = vocab.numbers(self.a[self.link_a], self.b[self.link_b])

    def groups(self) -> list[bytes]:
        """Per text its groups, written ``a1,a2|b1;a3|b2,b3``."""
        last_a, last_b = self.link_a, self.link_b  # the k-th group ends with these
        if not len(last_a):
            return [b""] * len(self.n_a)
        n_groups = len(last_a)
        size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        first_a, first_b = last_a + 1 - size_a, last_b + 1 - size_b
        # the tokens of a group stand together, those of A before those of B
        total = np.cumsum(size_a + size_b)
        begin = total - size_a - size_b
        slot_a = np.arange(len(self.a)) + np.repeat(begin - first_a, size_a)
        slot_b = np.arange(len(self.b)) + np.repeat(begin + size_a - first_b, size_b)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[slot_a], code[slot_b] = self.a, self.b
        code[begin] += self.vocab.ids
        code[begin + size_a] += 2 * self.vocab.ids
        doc_of_group = self.a_doc[last_a]
        opens = np.diff(doc_of_group, prepend=-1) > 0
        code[begin[opens]] += 2 * self.vocab.ids
        words = [*map(self.vocab.marked.__getitem__, code.tolist())]
        ends = np.zeros(len(self.n_a), np.int64)
        np.maximum.at(ends, doc_of_group, total)
        ends = np.maximum.accumulate(ends).tolist()
        return [b"".join(words[lo:hi]) for lo, hi in zip([0, *ends], ends, strict=False)]


_FIRST = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, pairs binary, counts binary"


def _encode(a: Broadcast, b: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabularies.of(a.value, b.value)
        counts = np.zeros(vocab.n_pairs, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                            ("groups_sha256", pa.string()), ("links", pa.binary()), ("pairs", pa.binary()), ("counts", pa.binary())])
        for part in pieces(batches, "text", SLICE_BYTES):
            with uncollected():
                got = Aligned(vocab, text_bytes(part.column(1)))
                counts += np.bincount(got.links, minlength=len(counts))
                cut = [0, *np.cumsum(got.n_links).tolist()]
                links = got.links.astype("<i4").tobytes()
                none = pa.nulls(part.num_rows, pa.binary())
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(got.n_a), pa.array(got.n_b), pa.array(got.n_links),
                     pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in got.groups()], pa.string()),
                     pa.array([links[4 * i:4 * j] for i, j in zip(cut, cut[1:], strict=False)], pa.binary()), none, none], schema=schema)
                del got
            yield out
        held = np.flatnonzero(counts)
        if len(held):
            # a task's counts: at most one per pair that the vocabularies allow
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in schema][:6] + [
                pa.array([held.astype("<i4").tobytes()], pa.binary()), pa.array([counts[held].astype("<i8").tobytes()], pa.binary())],
                schema=schema)
        release()
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(pairs, "<i4")), pa.array(np.frombuffer(counts, "<i8"))], ["pair", "n"])


def pair_counts(first: DataFrame) -> DataFrame:
    """(pair, n): how many links of the corpus hold each pair (by its number)."""
    return first.where("pairs IS NOT NULL").select("pairs", "counts").mapInArrow(_unpacked, "pair int, n long") \
        .groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(table: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = table.value
        for part in pieces(batches, "links", 4 * SLICE_BYTES):
            links = part.column(part.schema.names.index("links"))
            sizes = np.array([len(x) // 4 for x in links.to_pylist()], np.int64)
            pairs = np.frombuffer(b"".join(links.to_pylist()), "<i4")
            cut = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(x[pairs], dtype=np.int64)]) for x in (best, count)]
            sums = [s[cut] - s[cut - sizes] for s in sums]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:4], pa.array(sizes), *[pa.array(s) for s in sums], part.column(4)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links
    whose pair is the most frequent of its B id), count_sum, groups_sha256."""
    spark = docs.sparkSession
    files = [broadcast_bytes(spark, p) for p in (a_path, b_path)]
    first = written(id_and_text(docs).mapInArrow(_encode(*files), _FIRST), "alignment-links")
    vocab = Vocabularies.of(*[f.value for f in files])
    # bounded by the vocabularies, not by the corpus
    got = pair_counts(first).toArrow()
    count = np.zeros(vocab.n_pairs, np.int64)
    count[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    b = vocab.b_of()
    most = np.zeros(len(vocab.b_bytes) + 1, np.int64)
    np.maximum.at(most, b, count)
    table = spark.sparkContext.broadcast((count, count == most[b]))
    return first.where("pairs IS NULL").select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links").mapInArrow(
        _scored(table), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def overlap_table(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, a_index, b_index, a_id, b_id, start, end, ends_together): one row for every two
    tokens that share bytes, with the byte range they share in a blank and the text."""
    files = [broadcast_bytes(docs.sparkSession, p) for p in (a_path, b_path)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabularies.of(*[f.value for f in files])
        for part in pieces(batches, "text", SLICE_BYTES):
            got = Aligned(vocab, text_bytes(part.column(1)))
            order = np.lexsort((got.in_b, got.in_a))
            i, j = got.in_a[order], got.in_b[order]
            doc = got.a_doc[i]
            first_a, first_b = np.cumsum(got.n_a) - got.n_a, np.cumsum(got.n_b) - got.n_b
            bytes_of = np.bincount(got.a_doc, weights=vocab.a_len[got.a], minlength=len(got.n_a)).astype(np.int64)
            base = (np.cumsum(bytes_of) - bytes_of)[doc]
            start = np.maximum(got.a_end[i] - vocab.a_len[got.a[i]], got.b_end[j] - vocab.b_len[got.b[j]]) - base
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(doc)), pa.array(i - first_a[doc]), pa.array(j - first_b[doc]), pa.array(got.a[i]),
                 pa.array(got.b[j]), pa.array(start), pa.array(np.minimum(got.a_end[i], got.b_end[j]) - base),
                 pa.array(got.a_end[i] == got.b_end[j])],
                ["doc_id", "a_index", "b_index", "a_id", "b_id", "start", "end", "ends_together"])
        release()

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, a_index long, b_index long, a_id long, b_id long, start long, end long, ends_together boolean")
