"""Operator 9, token-ID output in patched frame-of-reference blocks.

Documents are encoded in ascending doc_id order, each closed by an end id, and written as
shards: range partitions of the ids, one Parquet file of records each. A record holds whole
documents (doc_id, number of ids) and one binary ``payload`` with all their ids:

    fixed head    magic b"PFR1", number of ids, number of blocks          (<u4 each)
    block index   start of each block in the body, in bytes, and its end  (<u4 each)
    body          per block: minimum <u4, width u1, zero u1, exceptions <u2,
                  positions of the exceptions <u2 each, their high bits <u4 each,
                  BLOCK values of ``width`` bits in little-endian <u8 words

A block has BLOCK ids. Its minimum is subtracted, ``width`` is what the PERCENTILE of the
differences needs, and the bits above it of the few larger ones stand in the exception
list. The block index allows reading any range of ids without unpacking the rest. Spark's
committer moves a shard into place when its task ends, so a retried task leaves no
half-written file, and any store that Spark writes to will do.

Encoding goes word by word: no pre-token spans a blank or line feed, and lower case of
A-Z does not change an id (special strings apart), so ids are looked up per word and only new words reach the
tokenizer. The memo of a Python worker is bounded and never changes a result.

Defined cases: a null or empty text has the end id alone; rows of null doc_id come first;
rows of equal doc_id are ordered by a hash of their text and kept each; an empty table
writes no record; other columns are not read.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.llm.common import broadcast_bytes, id_and_text, pieces, release, text_bytes, uncollected
from eventlake.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK = 1024
PERCENTILE = 0.95
RECORD_IDS = 1 << 20  # a record is closed once it has as many
MEMO_WORDS = 800_000
_MAGIC = int.from_bytes(b"PFR1", "little")


# --- blocks -----------------------------------------------------------------------

def pack(ids: np.ndarray) -> bytes:
    n, blocks = len(ids), -(-len(ids) // BLOCK)
    if not blocks:
        return np.array([_MAGIC, 0, 0, 0], "<u4").tobytes()
    full = np.full(blocks * BLOCK, ids[-1], np.uint32)
    full[:n] = ids
    full = full.reshape(blocks, BLOCK)
    low = full.min(axis=1)
    rest = full - low[:, None]
    at = min(BLOCK - 1, int(PERCENTILE * BLOCK))
    width = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1]
    # a width of 32 leaves nothing above it
    high = np.where(width[:, None] < 32, rest >> np.minimum(width, 31)[:, None].astype(np.uint32), 0)
    parts: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        words = _pack_bits(rest[own] & np.uint32((1 << w) - 1), w)
        for b, body in zip(own.tolist(), words, strict=True):
            odd = np.flatnonzero(high[b])
            parts[b] = b"".join((np.array([low[b]], "<u4").tobytes(), bytes((w, 0)), np.array([len(odd)], "<u2").tobytes(),
                                 odd.astype("<u2").tobytes(), high[b][odd].astype("<u4").tobytes(), body.tobytes()))
    index = np.cumsum([0, *map(len, parts)])
    return b"".join((np.array([_MAGIC, n, blocks], "<u4").tobytes(), index.astype("<u4").tobytes(), *parts))


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """64 values of ``width`` bits in ``width`` words."""
    lanes = values.reshape(-1, 64).T.astype(np.uint64, order="C")  # the same place of all rows side by side
    words = np.zeros((width + 1, lanes.shape[1]), np.uint64)
    for i in range(64 if width else 0):
        word, shift = divmod(i * width, 64)
        words[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words[:width].T).reshape(len(values), -1).astype("<u8", copy=False)


def _unpack_bits(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of words to rows of BLOCK values."""
    lanes = np.zeros((64, len(words) * (BLOCK // 64)), np.uint32)
    if width:
        words = np.ascontiguousarray(words.reshape(-1, width).T)
        mask = np.uint64((1 << width) - 1)
        for i in range(64):
            word, shift = divmod(i * width, 64)
            v = words[word] >> np.uint64(shift)
            if shift + width > 64:
                v |= words[word + 1] << np.uint64(64 - shift)
            v &= mask
            lanes[i] = v
    return np.ascontiguousarray(lanes.T).reshape(-1, BLOCK)


def unpack(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids ``start`` to ``stop`` (all by default); only the blocks that hold them are read."""
    magic, n, blocks = np.frombuffer(payload, "<u4", 3).tolist()
    if magic != _MAGIC:
        raise ValueError("not a block payload")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, np.uint32)
    index = np.frombuffer(payload, "<u4", blocks + 1, 12)
    body = 12 + 4 * (blocks + 1)
    first, last = start // BLOCK, -(-stop // BLOCK)
    out = np.zeros((last - first, BLOCK), np.uint32)
    heads = []
    for b in range(first, last):
        at = body + int(index[b])
        low = int(np.frombuffer(payload, "<u4", 1, at)[0])
        odd = int(np.frombuffer(payload, "<u2", 1, at + 6)[0])
        heads.append((low, payload[at + 4], odd, at + 8))
    widths = np.array([h[1] for h in heads])
    for w in np.unique(widths).tolist():
        own = np.flatnonzero(widths == w)
        words = np.stack([np.frombuffer(payload, "<u8", w * BLOCK // 64, heads[b][3] + 6 * heads[b][2]) for b in own.tolist()])
        out[own] = _unpack_bits(words, w)
    for b, (low, w, odd, at) in enumerate(heads):
        if odd:
            where = np.frombuffer(payload, "<u2", odd, at)
            out[b, where] |= np.frombuffer(payload, "<u4", odd, at + 2 * odd) << np.uint32(min(w, 31))
        out[b] += np.uint32(low)
    return out.reshape(-1)[start - first * BLOCK:stop - first * BLOCK]


# --- encoding ---------------------------------------------------------------------

class WordEncoder:
    """Ids of texts as little-endian <u4 bytes, by a bounded memo of words."""

    _kept: tuple[bytes, WordEncoder] | None = None

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        # a task has one core; the library's own threads would only wait for it
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.memo: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}  # what the memo held before it was full
        # byte-level files write bytes as printable stand-ins
        rest = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or 174 <= b)]
        self.stand_ins = "".join(chr(256 + rest.index(b)) if b in rest else chr(b) for b in range(256))
        probe = "étretionœ"
        self.direct = array("I").itemsize == 4 and sys.byteorder == "little" and self.tokenizer.encode(probe, add_special_tokens=False).ids == \
            [t.id for t in self.tokenizer.model.tokenize(charmap_decode(probe.encode(), "strict", self.stand_ins)[0])]
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def of(cls, vocabulary: bytes) -> WordEncoder:
        """The one of this Python worker."""
        if cls._kept is None or cls._kept[0] != vocabulary:
            cls._kept = vocabulary, cls(vocabulary)
        return cls._kept[1]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        low = [t.lower() for t in texts]  # of bytes: A-Z alone
        special = [any(s in t for s in self.special) for t in low]
        # where a special string could come about, the text keeps its case
        words = [(t if odd else same).replace(b"\n", b" ").split(b" ") for t, same, odd in zip(texts, low, special, strict=True)]
        used = set().union(*words)
        if len(self.memo) > MEMO_WORDS // 2:
            self.older, self.memo = self.memo, {b"": b""}
        new = used.difference(self.memo)
        again = new.intersection(self.older)
        self.memo.update(zip(again, map(self.older.__getitem__, again), strict=True))
        self._learn(new.difference(again), any(special))
        return [b"".join(map(self.memo.__getitem__, w)) for w in words]

    def _learn(self, new: set[bytes], special: bool) -> None:
        memo, letters, others, joint = self.memo, [], set(), []
        bases, signs = set(), set()
        for word in new:
            m = _PLAIN.fullmatch(word)
            # a letter and a closing sign always belong to different pre-tokens
            if m is None or special and any(s in word.lower() for s in self.special):
                others.add(word.decode())
            elif m[2]:
                joint.append((word, m[1], m[2]))
                bases.add(m[1])
                signs.add(m[2])
            else:
                letters.append(word)
        letters += bases.difference(memo, letters)
        others.update(s.decode() for s in signs.difference(memo))
        self._learn_letters(letters, others)
        self._learn_each([*others])
        for word, base, sign in joint:
            memo[word] = memo[base] + memo[sign]

    def _learn_letters(self, words: list[bytes], others: set[str]) -> None:
        """Words of letters only are one pre-token each, which goes to the tokenizer's model as
        it is; ``others`` takes those that its normaliser might change."""
        tokenize, memo = self.tokenizer.model.tokenize, self.memo
        for word in words:
            if self.direct and (word if word.isascii() else word.decode()).islower():
                text = word.decode() if word.isascii() else charmap_decode(word, "strict", self.stand_ins)[0]
                memo[word] = array("I", [t.id for t in tokenize(text)]).tobytes()
            else:
                others.add(word.decode())

    def _learn_each(self, words: list[str]) -> None:
        for k in range(0, len(words), 4096):
            part = words[k:k + 4096]
            for word, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.memo[word.encode()] = np.array(e.ids, "<u4").tobytes()


# Latin letters in UTF-8, then ASCII signs. Not U+0130: its lower case ends with a combining
# dot, which is no letter and shares a pre-token with the signs after it.
_PLAIN = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)([!-/:-@\[-`{-~]*)")


# --- Spark side -------------------------------------------------------------------

RECORDS = "shard int, part int, n_ids long, doc_ids array<bigint>, lengths array<int>, payload binary"
_RECORDS_ARROW = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()),
                            ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("payload", pa.binary())])


def encode(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Records of the packed ids of ``docs``; ``tokenizer`` is the path of a tokenizers file."""
    vocabulary = broadcast_bytes(docs.sparkSession, tokenizer)
    end = np.array([end_id], "<u4").tobytes()

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part = WordEncoder.of(vocabulary.value), TaskContext.get().partitionId(), 0
        names: list = []
        coded: list[bytes] = []
        held = 0

        def record() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(coded), "<u4")
            row = [[shard], [part], [len(ids)], [names], [[len(c) // 4 for c in coded]], [pack(ids)]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _RECORDS_ARROW, strict=True)], schema=_RECORDS_ARROW)

        for batch in pieces(batches, "text", 4 << 20):
            ids_of = batch.column(0).to_pylist()
            with uncollected():
                ids = encoder.encode(text_bytes(batch.column(1)))
            for name, c in zip(ids_of, ids, strict=True):
                names.append(name)
                coded.append(c + end)
                held += len(c) // 4 + 1
                if held >= RECORD_IDS:
                    yield record()
                    names, coded, held, part = [], [], 0, part + 1
        if coded:
            yield record()
        release()

    # the ranges are drawn from doc_id alone, so that sampling them reads no text
    by_id = F.col("doc_id").asc_nulls_first()
    ordered = id_and_text(docs).repartitionByRange(by_id).sortWithinPartitions(by_id, F.xxhash64("text"))
    return ordered.mapInArrow(records, RECORDS)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    encode(docs, tokenizer, end_id).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    records = spark.read.schema(RECORDS).parquet(path)
    parts = records.select("shard", "part", "n_ids")
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per shard in the global window; records within their shard
    shards = parts.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")) \
        .select("shard", earlier(Window.orderBy("shard")).alias("shard_start"))
    starts = parts.select("shard", "part", earlier(Window.partitionBy("shard").orderBy("part")).alias("part_start")) \
        .join(shards, "shard").select("shard", "part", (F.col("shard_start") + F.col("part_start")).alias("record_start"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, part, _, names, lengths, payload = (c[i] for c in batch.columns)
                lengths = lengths.values.to_numpy()
                data = memoryview(unpack(payload.as_py()).astype("<u4", copy=False).tobytes())
                ends = np.cumsum(lengths, dtype=np.int64)
                sums = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * n, pa.int32()), pa.array([part.as_py()] * n, pa.int32()), names.values,
                     pa.array(ends - lengths), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64())],
                    names=["shard", "part", "doc_id", "offset", "n_tokens", "ids_crc32"])
        release()

    found = records.mapInArrow(documents, "shard int, part int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return found.join(starts, ["shard", "part"]) \
        .select("doc_id", (F.col("record_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes the ids of ``docs`` to new shards in the shared scratch folder and reads them."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-ids")
    write_shards(docs, path, tokenizer, end_id)
    return read_shards(spark, path)
