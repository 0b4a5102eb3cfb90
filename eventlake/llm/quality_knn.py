"""Operator 2, a quality classifier by nearest-neighbour voting in a latent-semantic space.

Terms describe a text's form: trigrams of character classes, how far back each word and
line last occurred, lengths of words and lines, and the text's own length. Term weights are
the square root of a term's share in its family times its idf; a truncated SVD of a bounded
sample of labelled documents gives the latent space. The labelled vectors are broadcast (at
most ``INDEX_ROWS`` x ``RANK`` floats), every document is compared to all of them by exact
cosine products in blocks, and its ``NEIGHBOURS`` nearest vote with weight by similarity.

Defined cases: a null or empty text has its length class as only term; without labelled
rows every score is 0.5; a doc_id labelled more than once counts by its greatest label;
rows of a null doc_id are scored and not held out; a very long text is
learned from and scored whole; repeated documents score alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import id_and_text, map_batches, text_bytes, written
from eventlake.llm.textstats import SPACE, gaps, word_ids
from eventlake.llm.toxicity import fold, labelled_sample

FOLDS, HELD_FOLD = 4, 2
INDEX_ROWS = 8192  # labelled rows that vote, at most
RANK = 96
NEIGHBOURS = 7
SHARPNESS = 30  # power of the similarity in a vote's weight
THRESHOLD = 0.7
BLOCK_ROWS = 1024

# Character classes by UTF-8 byte.
_CLASS_SETS = (b" ", b"\n\r", b"\t\x0b\x0c", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", b".,;:", b"!?", b"|",
               b"#*$%&<>", bytes(range(0x80, 0xC0)), bytes(range(0xC0, 0x100)))
CLASSES = len(_CLASS_SETS) + 1
_CLASS = np.zeros(256, np.int32)
for _i, _set in enumerate(_CLASS_SETS):
    _CLASS[list(_set)] = _i + 1

GAP_EDGES = np.array([1, 2, 5, 9, 65])  # 0: new; then last seen 1, 2-4, 5-8, 9-64, 65 and more words ago
LENGTH_EDGES = np.array([2, 4, 7, 11, 16, 32])  # of words, in bytes
LINE_EDGES = np.array([2, 4, 9, 21, 61])  # of lines, in words
_G, _W, _L, _D = (len(GAP_EDGES) + 1) ** 2, len(LENGTH_EDGES) + 1, 2 * (len(LINE_EDGES) + 1), 24
FAMILIES = np.cumsum([0, CLASSES ** 3, _G, _W, _L, _D])
TERMS = int(FAMILIES[-1])


def terms(text: bytes) -> np.ndarray:
    """Square roots of the terms' shares in their families."""
    out = np.zeros(TERMS, np.float32)

    def put(family: int, codes: np.ndarray) -> None:
        if len(codes):
            a, b = FAMILIES[family], FAMILIES[family + 1]
            out[a:b] = np.sqrt(np.bincount(codes, minlength=b - a)[:b - a] / np.float32(len(codes)))

    c = _CLASS[np.frombuffer(text, np.uint8)]
    if len(c) > 2:
        put(0, (c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:])
    words = text.split()
    gap = np.searchsorted(GAP_EDGES, gaps(word_ids(words)), side="right")
    if len(gap) > 1:
        put(1, gap[:-1] * (len(GAP_EDGES) + 1) + gap[1:])
    put(2, np.searchsorted(LENGTH_EDGES, np.fromiter(map(len, words), np.int64, len(words)), side="right"))
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    again = gaps(word_ids(lines)) > 0
    put(3, np.searchsorted(LINE_EDGES, np.array([len(x.split()) for x in lines], np.int64), side="right") * 2 + again)
    put(4, np.array([min(_D - 1, len(text).bit_length())]))
    return out


class Voters:
    """The latent space and the labelled vectors in it."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        n = len(x)
        self.idf = np.log((1 + n) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + np.float32(1)
        weighted = self._unit(x * self.idf)
        used = np.flatnonzero((x > 0).any(axis=0))  # other terms have no part in the space
        own = weighted[:, used]
        _, vectors = np.linalg.eigh((own.T @ own).astype(np.float64)) if len(used) else (0, np.zeros((0, 0)))
        self.axes = np.zeros((TERMS, min(RANK, len(used))), np.float32)
        self.axes[used] = vectors[:, ::-1][:, :RANK]
        self.vectors, self.labels = self._unit(weighted @ self.axes), (y > 0).astype(np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12).astype(np.float32)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(x), 0.5)
        out = np.empty(len(x))
        for k in range(0, len(x), BLOCK_ROWS):
            latent = self._unit(self._unit(x[k:k + BLOCK_ROWS] * self.idf) @ self.axes)
            cosine = latent @ self.vectors.T
            near = min(NEIGHBOURS, cosine.shape[1])
            nearest = np.argpartition(-cosine, near - 1, axis=1)[:, :near]
            weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 1e-3).astype(np.float64) ** SHARPNESS
            out[k:k + BLOCK_ROWS] = (weight * self.labels[nearest]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0, 1)


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.stack([terms(t) for t in texts]) if texts else np.zeros((0, TERMS), np.float32)


def _sparse(row: np.ndarray) -> bytes:
    """Places <u2 of a row's terms, then their values <f4."""
    where = np.flatnonzero(row)
    return where.astype("<u2").tobytes() + row[where].astype("<f4").tobytes()


def _dense(rows: list[bytes]) -> np.ndarray:
    x = np.zeros((len(rows), TERMS), np.float32)
    for i, row in enumerate(rows):
        n = len(row) // 6
        x[i, np.frombuffer(row, "<u2", n)] = np.frombuffer(row, "<f4", n, 2 * n)
    return x


def learn(docs: DataFrame, labels: DataFrame) -> Voters:
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_FOLD, INDEX_ROWS)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(text_bytes(batch.column(1)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([_sparse(r) for r in x], pa.binary()), batch.column(2)], names=["doc_id", "x", "y"])

    found = written(map_batches(sample.select("doc_id", "text", "y"), "text", "doc_id long, x binary, y int", rows), "quality-sample") \
        .orderBy("doc_id").collect()
    return Voters(_dense([r.x for r in found]), np.array([r.y for r in found]))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, voters = text_bytes(batch.column(1)), shared.value
        parts = [voters.scores(_matrix(texts[k:k + BLOCK_ROWS])) for k in range(0, len(texts), BLOCK_ROWS)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts))], names=["doc_id", "score"])

    return map_batches(id_and_text(docs), "text", "doc_id long, score double", scored) \
        .select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "score",
                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
