"""Operator 10, token counts by distinct pre-tokens.

No text is encoded as a whole. A first pass over the documents gathers the distinct
pre-tokens of the corpus and counts each one's pieces once. A second pass takes every
document's pre-token frequencies; they are joined to the piece counts and summed.

Frequencies travel in chunks: a chunk is a bounded run of documents within a task, and one
row holds one pre-token's frequencies over the chunk's documents (two bytes of position and
one of frequency each). So a frequent pre-token has a row per chunk rather than per
document, and the join, which Spark may split at skewed keys, stays short. Rows carry a
64-bit hash in place of the pre-token; the vocabulary, which has both, is checked for two
pre-tokens of one hash, and if there are any, another seed is taken. The sums come back per
chunk, sparse, and are added up there; a chunk's header row, which carries its documents'
ids and lengths, goes the same way under a key of its own.

Pre-tokens are those of byte-level BPE files with the usual pattern: a blank or
line feed that follows other than white space always begins one, so texts are cut there and
each distinct cut is taken apart once per chunk. Other kinds of files are refused.

Defined cases: a null or empty text has 0 bytes and 0 tokens; special strings inside a text
count as the library has it, one token each; rows of null or equal doc_id are kept each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import broadcast_bytes, id_and_text, pieces, release, text_bytes, uncollected, written

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CHUNK_BYTES = 12 << 20
CHUNK_DOCS = 1 << 16
MOST = 255  # an entry's greatest frequency; more take further entries
HELD_SUMS = 1 << 20  # partial sums that a task holds before it hands them on
_BATCH_ROWS = 1 << 16


# --- pre-tokens -------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level files, by the rule that made them: printable
    bytes stand for themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PreTokens:
    """Takes cuts of a text apart into pre-tokens (UTF-8 bytes), and counts their pieces."""

    _kept: tuple[bytes, PreTokens] | None = None

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        how = json.loads(vocabulary)
        pre = how.get("pre_tokenizer") or {}
        plain = not any(t[k] for t in how.get("added_tokens") or [] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if how.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or not plain:
            raise ValueError("only byte-level BPE files with the usual pattern are supported")
        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.letters = _byte_letters()
        added = sorted((t["content"] for t in how.get("added_tokens") or []), key=len, reverse=True)
        self.added = {a.encode() for a in added}
        self.special = re.compile(("(" + "|".join(map(re.escape, added)) + ")").encode()) if added else None
        self.splitter = self.tokenizer.pre_tokenizer

    @classmethod
    def of(cls, vocabulary: bytes) -> PreTokens:
        if cls._kept is None or cls._kept[0] != vocabulary:
            cls._kept = vocabulary, cls(vocabulary)
        return cls._kept[1]

    def parts(self, text: bytes) -> list[bytes]:
        """A text between its special strings, and these."""
        if self.special and any(s in text for s in self.added):
            return [p for p in self.special.split(text) if p]
        return [text]

    def apart(self, key: bytes | tuple) -> list[bytes]:
        """The pre-tokens of a cut."""
        if isinstance(key, tuple):
            blank, word = b"", key[0]
            if word in self.added:
                return [word]
        elif key[:1] == b"\n":
            m = _PLAIN.fullmatch(key, 1)
            return [b"\n", *filter(None, m.groups())] if m else self._library(key)
        else:
            blank, word = b" ", key
        m = _PLAIN.fullmatch(word)
        if m:
            return [blank + m[1], m[2]] if m[2] else [blank + m[1]]
        return self._library(blank + word)

    def _library(self, cut: bytes) -> list[bytes]:
        return [bytes(map(self.letters.__getitem__, p)) for p, _ in self.splitter.pre_tokenize_str(cut.decode())]

    def counts(self, tokens: list[bytes]) -> list[int]:
        coded = self.tokenizer.encode_batch_fast([t.decode() for t in tokens], add_special_tokens=False)
        return [len(e.ids) for e in coded]


_CUT = re.compile(r"(?<=\S)(?=[ \n])")
# Latin letters in UTF-8, then ASCII signs: one pre-token each.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)([!-/:-@\[-`{-~]*)")


def _open(key: bytes | tuple) -> bool:
    """Whether a cut may not end before a blank: it is none, or ends in white space (or in
    another control character, which takes the longer way for nothing)."""
    cut = key[0] if isinstance(key, tuple) else key
    if not cut:
        return not isinstance(key, tuple)
    return cut[-1] < 33 or cut[-1] > 127 and cut.decode()[-1].isspace()


def _cut(part: bytes) -> list[bytes]:
    """A part cut at blanks and line feeds. What begins with a line feed has no blank before
    it, the others, apart from the first, have one."""
    return part.replace(b"\n", b" \n").split(b" ")


def _cut_slowly(part: bytes) -> list[tuple]:
    """The cuts of a part that has white space before a blank or a line feed."""
    return [(c.encode(),) for c in _CUT.split(part.decode())]


def cuts_of(texts: list[bytes], pre: PreTokens) -> tuple[dict, list[np.ndarray]]:
    """The distinct cuts, numbered, and each text's cuts by number. A word stands for itself
    after one blank, or with its line feed; a tuple for its only string."""
    index: defaultdict = defaultdict()
    index.default_factory = index.__len__
    read: list[tuple[int, bytes, np.ndarray]] = []
    for doc, text in enumerate(texts):
        for part in pre.parts(text):
            words: list = [part] if part in pre.added else _cut(part)
            words[0] = (words[0],)
            read.append((doc, part, np.fromiter(map(index.__getitem__, words), np.int64, len(words))))
    open_ = np.fromiter(map(_open, index), bool, len(index))
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for doc, part, cuts in read:
        if open_[cuts[:-1]].any():
            cuts = np.array([index[c] for c in _cut_slowly(part)], np.int64)
        out[doc].append(cuts)
    return index, [np.concatenate(c) if len(c) > 1 else c[0] for c in out]


def pretokens_of(texts: list[bytes], pre: PreTokens) -> set[bytes]:
    """The distinct pre-tokens of the texts (where white space stands before a blank, perhaps
    with some that the quick cuts would give)."""
    cuts: set = set()
    parts = [p for t in texts for p in pre.parts(t)]
    for part in parts:
        words = [part] if part in pre.added else _cut(part)
        cuts.add((words[0],))
        cuts.update(words[1:])
    open_ = {c if isinstance(c, bytes) else c[0] for c in filter(_open, cuts)}
    if open_:
        for part in parts:
            if part not in pre.added and not open_.isdisjoint(_cut(part)[:-1]):
                cuts.update(_cut_slowly(part))
    return {t for c in cuts for t in pre.apart(c)}


class Chunk:
    """Pre-token frequencies of a run of documents: token, document and frequency, in order."""

    def __init__(self, texts: list[bytes], pre: PreTokens):
        index, seen = cuts_of(texts, pre)
        tokens: defaultdict = defaultdict()
        tokens.default_factory = tokens.__len__
        flat, size = array("q"), array("q")
        for cut in index:
            own = pre.apart(cut)
            size.append(len(own))
            flat.extend(map(tokens.__getitem__, own))
        flat, size = np.frombuffer(flat, np.int64), np.frombuffer(size, np.int64)
        self.tokens: list[bytes] = [*tokens]
        first, many = np.cumsum(size) - size, max(1, len(size))
        del index, tokens
        key = np.concatenate(seen) if seen else np.zeros(0, np.int64)
        key += np.repeat(np.arange(len(seen)) * many, [len(c) for c in seen])
        key, n = np.unique(key, return_counts=True)
        doc, cut = np.divmod(key, many)
        own = size[cut]
        ends = np.cumsum(own)
        token = flat[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - own - first[cut], own)]
        # sorted with the frequency in the low bits
        key = (token * max(1, len(texts)) + np.repeat(doc, own)) << 24
        n = np.repeat(n, own)
        while (over := n >= 1 << 24).any():  # more often than the low bits hold
            key, n = np.append(key, key[over]), np.append(np.where(over, (1 << 24) - 1, n), n[over] - ((1 << 24) - 1))
        key = np.sort(key | n)
        n, key = key & 0xFFFFFF, key >> 24
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.freq = np.add.reduceat(n, new) if len(new) else n
        self.token, self.doc = np.divmod(key[new], max(1, len(texts)))

    def rows(self) -> pa.Array:
        """Per pre-token its entries: positions <u2, then frequencies u1."""
        parts = -(-self.freq // MOST)
        token, doc, freq = (np.repeat(a, parts) for a in (self.token, self.doc, self.freq))
        if len(freq) > len(parts):
            ends = np.cumsum(parts)
            freq = np.minimum(MOST, freq - (np.arange(len(freq)) - np.repeat(ends - parts, parts)) * MOST)
        starts = np.searchsorted(token, np.arange(len(self.tokens) + 1))
        count = np.diff(starts)
        place = np.arange(len(token)) - np.repeat(starts[:-1], count)
        base, data = np.repeat(3 * starts[:-1], count), np.empty(3 * len(token), np.uint8)
        data[base + 2 * place], data[base + 2 * place + 1] = doc & 255, doc >> 8
        data[base + 2 * np.repeat(count, count) + place] = freq
        return pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer((3 * starts).astype(np.int32)), pa.py_buffer(data)])


def entries(packed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries per row, positions, frequencies) of rows that ``Chunk.rows`` made."""
    packed = packed.cast(pa.binary())
    if not len(packed):
        return (np.zeros(0, np.int64),) * 3
    at = np.frombuffer(packed.buffers()[1], np.int32, len(packed) + 1, 4 * packed.offset).astype(np.int64)
    data = np.frombuffer(packed.buffers()[2], np.uint8) if at[-1] else np.zeros(0, np.uint8)
    count = np.diff(at) // 3
    place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    base = np.repeat(at[:-1], count)
    low = base + 2 * place
    return count, data[low] + (data[low + 1].astype(np.int64) << 8), data[base + 2 * np.repeat(count, count) + place].astype(np.int64)


# --- Spark side -------------------------------------------------------------------

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in pieces(batches, "text", CHUNK_BYTES):
        for k in range(0, part.num_rows, CHUNK_DOCS):
            yield part.slice(k, CHUNK_DOCS)


def _slices(*columns: pa.Array) -> Iterator[list[pa.Array]]:
    for k in range(0, len(columns[0]), _BATCH_ROWS):
        yield [c.slice(k, _BATCH_ROWS) for c in columns]


def _hashes(tokens: list[bytes], seed: int) -> np.ndarray:
    """Even numbers; odd ones are the keys of headers."""
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), tokens), np.uint64, len(tokens)).view(np.int64) & ~1


def vocabulary_of(docs: DataFrame, shared) -> DataFrame:
    """(token, pieces): every distinct pre-token of ``docs`` with its number of pieces."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokens.of(shared.value)
        for part in _chunks(batches):
            with uncollected():
                tokens = pa.array([*pretokens_of(text_bytes(part.column(0)), pre)], pa.binary())
            for columns in _slices(tokens):
                yield pa.RecordBatch.from_arrays(columns, names=["token"])
        release()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokens.of(shared.value)
        for batch in batches:
            with uncollected():
                counts = pre.counts(batch.column(0).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int32())], names=["token", "pieces"])
        release()

    return docs.select("text").mapInArrow(gather, "token binary").distinct().mapInArrow(count, "token binary, pieces int")


def piece_counts(docs: DataFrame, shared) -> tuple[DataFrame, int]:
    """(key, pieces) with the hash of every distinct pre-token, and the seed of the hash, the
    first under which no two pre-tokens share one."""
    words = written(vocabulary_of(docs, shared), "pretokens")
    seed = 0
    while True:
        def keys(batches: Iterator[pa.RecordBatch], seed=seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = _hashes(batch.column(0).cast(pa.binary()).to_pylist(), seed)
                yield pa.RecordBatch.from_arrays([pa.array(hashes), batch.column(1)], names=["key", "pieces"])

        counts = words.mapInArrow(keys, "key long, pieces int")
        if counts.groupBy("key").count().where("count > 1").isEmpty():
            return counts, seed
        seed += 1


def frequencies(docs: DataFrame, shared, seed: int) -> DataFrame:
    """(key, chunk, entries): rows per chunk and pre-token. A chunk's header has its documents'
    ids and lengths for entries, and a key of its own, which no pre-token has. (Columns that
    are null in most rows would be slow here: what Spark hands to Python row by row should be
    flat.)"""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = PreTokens.of(shared.value)
        for nth, part in enumerate(_chunks(batches)):
            with uncollected():
                texts, number = text_bytes(part.column(1)), TaskContext.get().partitionId() << 32 | nth
                chunk = Chunk(texts, pre)
                keys, packed = pa.array(_hashes(chunk.tokens, seed)), chunk.rows()
                header = _header(part.column(0), np.array([len(t) for t in texts], "<i8"))
                del chunk, texts
            yield _row_batch(pa.array([number << 1 | 1]), number, pa.array([header]))
            for key, entries_ in _slices(keys, packed):
                yield _row_batch(key, number, entries_)
        release()

    return docs.mapInArrow(take, "key long, chunk long, entries binary")


def _row_batch(key: pa.Array, chunk: int, entries_: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, pa.array(np.full(len(key), chunk)), entries_], names=["key", "chunk", "entries"])


def _header(ids: pa.Array, sizes: np.ndarray) -> bytes:
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    return b"".join((known.astype("u1").tobytes(), ids.fill_null(0).to_numpy().astype("<i8").tobytes(), sizes.tobytes()))


def _documents(header: bytes) -> tuple[pa.Array, pa.Array]:
    """The ids and lengths in a header."""
    n = len(header) // 17
    ids, sizes = np.frombuffer(header, "<i8", 2 * n, n).reshape(2, n)
    return pa.array(ids, mask=np.frombuffer(header, "u1", n) == 0), pa.array(sizes)


_SUMS = "chunk long, header boolean, sums binary"
_SUM = np.dtype([("place", "<u2"), ("sum", "<u4")])  # of a document in its chunk


def _added(chunk: np.ndarray, place: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the values per chunk and place, in order of both."""
    if not len(chunk):
        return chunk, place, value
    chunks, code = np.unique(chunk, return_inverse=True)
    key = code << 16 | place
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return chunks[key[new] >> 16], key[new] & 0xFFFF, np.add.reduceat(value, new)


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the pre-tokens of this task, per chunk. Only places with a sum are held, so
    a row costs the same whatever the number of chunks, and ``HELD_SUMS`` bounds them."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def batch_of(chunks: pa.Array, header: bool, sums: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([chunks, pa.array(np.full(len(chunks), header)), sums], names=["chunk", "header", "sums"])

    def together() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _added(*(np.concatenate(c) for c in zip(*held, strict=True)))

    def packed(chunk: np.ndarray, place: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        data = np.empty(len(chunk), _SUM)
        data["place"], data["sum"] = place, value
        new = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1]))[:len(chunk)]
        ends = (np.append(new, len(chunk)) * _SUM.itemsize).astype(np.int32)
        sums = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(ends), pa.py_buffer(data.tobytes())])
        return batch_of(pa.array(chunk[new], pa.int64()), False, sums)

    for batch in batches:
        headers = pc.bit_wise_and(batch.column(0), 1).cast(pa.bool_())
        head, rows = batch.filter(headers), batch.filter(pc.invert(headers))
        if head.num_rows:
            yield batch_of(head.column(1), True, head.column(2).cast(pa.binary()))
        count, place, freq = entries(rows.column(2))
        value = freq * np.repeat(rows.column(3).to_numpy(zero_copy_only=False).astype(np.int64), count)
        held.append(_added(np.repeat(rows.column(1).to_numpy(), count), place, value))
        size += len(held[-1][0])
        if size > HELD_SUMS:
            held = [together()]
            size = len(held[0][0])
            if size > HELD_SUMS // 2:
                yield packed(*held[0])
                held, size = [], 0
    if size:
        yield packed(*together())
    release()


def _chunk_totals(table: pa.Table) -> pa.Table:
    """All rows of one chunk to its documents' counts."""
    headers = table.column("header")
    sums = np.frombuffer(b"".join(table.filter(pc.invert(headers)).column("sums").to_pylist()), _SUM)
    total = np.bincount(sums["place"], sums["sum"], CHUNK_DOCS).astype(np.int64)  # exact: far below 2 ** 53
    ids = sizes = pa.array([], pa.int64())
    for header in table.filter(headers).column("sums").to_pylist():
        ids, sizes = _documents(header)
    return pa.table({"doc_id": ids, "n_bytes": sizes, "n_tokens": pa.array(total[:len(ids)])})


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    docs = id_and_text(docs)
    shared = broadcast_bytes(docs.sparkSession, tokenizer)
    PreTokens.of(shared.value)  # refuses other kinds of files here, not in a task
    counts, seed = piece_counts(docs, shared)
    joined = frequencies(docs, shared, seed).join(counts.hint("shuffle_hash"), "key", "left")
    sums = joined.select("key", "chunk", "entries", "pieces").mapInArrow(_partial_sums, _SUMS)
    return sums.groupBy("chunk").applyInArrow(_chunk_totals, "doc_id long, n_bytes long, n_tokens long") \
        .withColumn("over_limit", F.col("n_tokens") > limit)
