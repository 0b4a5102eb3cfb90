"""Statistics of one text that the quality operators share. Texts are UTF-8 bytes; words are
runs of other than the six ASCII white-space bytes, as ``bytes.split`` gives them."""

from __future__ import annotations

from itertools import count

import numpy as np

SPACE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)


def how_many(text: bytes, of: bytes) -> int:
    return len(text) - len(text.translate(None, of))


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def word_ids(words: list[bytes]) -> np.ndarray:
    """For each word the place of its first occurrence."""
    return np.array([*map({}.setdefault, words, count())], np.int64)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice."""
    if len(ids) <= window:
        return 0
    h = (ids.astype(np.uint64) + np.uint64(1)) * _ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    size = 1
    while size < window:  # hashes of twice as many words at each step
        h = h[:-size] * (_ODD ** np.uint64(size)) + h[size:]
        size *= 2
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    step[starts] += 1
    np.add.at(step, starts + window, -1)
    return int((np.cumsum(step[:-1]) > 0).sum())


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and those of them that equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines), len(lines) - len(set(lines))


def gaps(ids: np.ndarray) -> np.ndarray:
    """For each word the distance to its last occurrence, 0 if there is none."""
    order = np.argsort(ids, kind="stable")
    out = np.zeros(len(ids), np.int64)
    same = ids[order[1:]] == ids[order[:-1]]
    out[order[1:][same]] = (order[1:] - order[:-1])[same]
    return out
