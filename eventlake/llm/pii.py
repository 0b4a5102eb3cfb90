"""Operator 4, personal data by base patterns and a character-level BiLSTM with a CRF.

The base patterns (email, ip, card, phone) give spans that always stay. A bidirectional
LSTM over characters, with CRF transitions between tags, adds spans of the same kinds
written in ways the patterns miss ("name at host dot org", "(555) 010-4477", IPv6, cards
with unusual separators). It is trained in numpy on labelled spans: the base spans of a
bounded sample of the documents, and generated writings put between the sample's words,
beside look-alikes (hex strings, versions, dates, numbers that fail a check digit) that
carry no label.

Texts are cut into overlapping windows, all of which run side by side, one character at a
time in each direction. A span that reaches an edge of its window inside the text is read again
in a window around it, twice as wide each time, until it does not, so spans are found whole
however long they are. Windows whose scores cannot lift any path above "no span" are
settled by that bound, which is exact; the others are decoded by Viterbi. The spans of all
windows of a text are then reconciled together: those that hold their kind's
check (or, of adjoining spans proposed as one, the parts that do) are chosen for the greatest total score such that none overlaps another or a base
span.

Defined cases: a null or empty text has no span; null and repeated doc_ids are rows like
any other; an empty table trains on the generated spans alone and gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
import time
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import bounded_sample, id_and_text, map_batches, text_bytes

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 400  # documents trained on, at most
SAMPLE_CHARS = 20_000  # of each that are trained on, from a place that its hash says
HIDDEN = 8
WINDOW, OVERLAP = 1024, 96  # characters
SLICE_BYTES = 8 << 20
SIDE_CHARS = 1 << 20  # of windows that run side by side
STEPS, BATCH, LENGTH, RATE = 500, 48, 112, 0.02
SEED = 11

# --- base patterns ----------------------------------------------------------------
# Possessive groups and the look-behinds only save time: a match that could begin later in
# a run of digits could begin at the run's start as well.

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind, then start."""
    out, free = [], 0
    for m in _DOMAIN.finditer(text) if "@" in text else ():
        at = m.start()
        begin = at
        while begin > free and _LOCAL.match(text, begin - 1, begin):
            begin -= 1
        if begin < at:
            out.append((0, begin, m.end()))
            free = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


# --- what an added span must hold ---------------------------------------------------

_AT = re.compile(r"[\w.%+-]+ ?(?:@|[(\[{<] ?at ?[)\]}>]|\bat\b) ?[\w-]+(?: ?(?:\.|[(\[{<] ?dot ?[)\]}>]|\bdot\b) ?[\w-]+)+", re.I | re.A)
_IPV6 = re.compile(r"(?:[0-9a-f]{1,4}:){2,7}(?::?[0-9a-f]{1,4}){1,7}", re.I)
_IP_SPACED = re.compile(r"[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}")
_CARD_LOOSE = re.compile(r"[0-9]{4}(?:[ ./_-]{1,2}[0-9]{2,6}){2,4}")
_PHONE_LOOSE = re.compile(r"\(?[0-9]{2,4}\)?(?:[ ./-]{1,2}[0-9]{2,5}){2,4}")


_PATTERNS = ((_AT,), (_IPV6, _IP_SPACED), (_CARD_LOOSE,), (_PHONE_LOOSE,))


def holds(kind: int, text: str) -> bool:
    """Whether a proposed span can be what it is proposed as."""
    digits = _digits(text)
    if kind == 0:
        return _AT.fullmatch(text) is not None
    if kind == 1:
        return _IPV6.fullmatch(text) is not None and text.count(":") >= 3 or \
            _IP_SPACED.fullmatch(text) is not None and all(int(p) <= 255 for p in re.findall("[0-9]+", text))
    if kind == 2:
        return _CARD_LOOSE.fullmatch(text) is not None and 13 <= len(digits) <= 19 and luhn(digits)
    return _PHONE_LOOSE.fullmatch(text) is not None and 9 <= len(digits) <= 15


# --- characters -------------------------------------------------------------------

_ASCII = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
CODES = len(_ASCII) + 5  # and digit, blank, other white space, other letter, anything else


def _code_table() -> np.ndarray:
    n = len(_ASCII)
    table = np.full(0x110000, n + 4, np.uint8)
    for c in range(128, 0x3000):
        if unicodedata.category(chr(c))[0] == "L":
            table[c] = n + 3
    table[0x3000:0xE000] = n + 3  # most are letters
    for i, ch in enumerate(_ASCII):
        table[ord(ch)] = table[ord(ch.upper())] = i
    table[[*range(48, 58)]] = n
    table[32] = n + 1
    table[[*range(9, 14)]] = n + 2
    return table


_CODE = _code_table()


def codes(text: str) -> np.ndarray:
    return _CODE[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]


# --- the network ------------------------------------------------------------------
# Arrays are laid out (feature, window): every operation runs along the windows. Gates are
# input, forget, output, candidate; TAGS are none and the kinds.

TAGS = 1 + len(KINDS)


def _initial(rng: np.random.Generator, hidden: int) -> dict[str, np.ndarray]:
    p = {}
    for side in ("f", "b"):
        p[f"x{side}"] = 0.4 * rng.standard_normal((4 * hidden, CODES))
        p[f"x{side}"][hidden:2 * hidden] += 1.0  # remember at first
        p[f"h{side}"] = 0.4 * rng.standard_normal((4 * hidden, hidden))
        p[f"e{side}"] = 0.4 * rng.standard_normal((TAGS, hidden))
    p["e"], p["t"] = np.zeros((TAGS, 1)), np.eye(TAGS)
    p["e"][0] = 1.0
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(px: np.ndarray, ph: np.ndarray, x: np.ndarray) -> list[tuple]:
    """One direction over (time, window) codes: per step gates, cell and output."""
    n = ph.shape[1]
    h = c = np.zeros((n, x.shape[1]))
    steps = []
    for codes_ in x:
        z = px[:, codes_] + ph @ h
        gates, g = _sigmoid(z[:3 * n]), np.tanh(z[3 * n:])
        before, c_before = h, c
        c = gates[n:2 * n] * c + gates[:n] * g
        tc = np.tanh(c)
        h = gates[2 * n:] * tc
        steps.append((codes_, before, c_before, gates, g, tc, h))
    return steps


def _run_back(px, ph, steps, dh_out, grad_x, grad_h) -> None:
    """Adds the gradients of one direction, given those of its outputs."""
    n, all_dz = ph.shape[1], []
    dh, dc = np.zeros_like(steps[0][1]), np.zeros_like(steps[0][1])
    for (codes_, before, c_before, gates, g, tc, _), out in zip(reversed(steps), reversed(dh_out), strict=True):
        i, f, o = gates[:n], gates[n:2 * n], gates[2 * n:]
        dh = dh + out
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
        grad_h += dz @ before.T
        all_dz.append(dz)
        dh, dc = ph.T @ dz, dc * f
    chars = np.concatenate([s[0] for s in reversed(steps)])
    grad_x += np.concatenate(all_dz, axis=1) @ (chars[:, None] == np.arange(CODES))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _crf(e: np.ndarray, t: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log-likelihood of tags y (time, window) under emissions e (time, tag, window)
    and transitions t, summed, with its gradients by e and t."""
    steps, _, n = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for k in range(1, steps):
        alpha[k] = e[k] + _log_sum(alpha[k - 1][:, None] + t[:, :, None], 0)
    for k in range(steps - 2, -1, -1):
        beta[k] = _log_sum(t[:, :, None] + (e[k + 1] + beta[k + 1])[None], 1)
    z = _log_sum(alpha[-1], 0)
    de = np.exp(alpha + beta - z)
    pair = np.exp(alpha[:-1, :, None] + t[None, :, :, None] + (e[1:] + beta[1:])[:, None] - z)
    dt = pair.sum(axis=(0, 3))
    at = np.arange(n)
    gold = 0.0
    for k in range(steps):
        gold += e[k, y[k], at].sum()
        de[k, y[k], at] -= 1
    np.add.at(dt, (y[:-1].ravel(), y[1:].ravel()), -1.0)
    gold += t[y[:-1], y[1:]].sum()
    return float(z.sum() - gold), de, dt


def loss_and_gradients(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """For codes x and tags y, both (time, window)."""
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    steps = {"f": _run(p["xf"], p["hf"], x), "b": _run(p["xb"], p["hb"], x[::-1])[::-1]}
    e = np.stack([p["ef"] @ a[-1] + p["eb"] @ b[-1] + p["e"] for a, b in zip(steps["f"], steps["b"], strict=True)])
    loss, de, grad["t"] = _crf(e, p["t"], y)
    grad["e"] = de.sum(axis=(0, 2))[:, None]
    for side in "fb":
        h = np.stack([s[-1] for s in steps[side]])
        grad[f"e{side}"] = np.einsum("tkn,thn->kh", de, h)
        out = np.einsum("kh,tkn->thn", p[f"e{side}"], de)
        if side == "f":
            _run_back(p["xf"], p["hf"], steps["f"], out, grad["xf"], grad["hf"])
        else:
            _run_back(p["xb"], p["hb"], steps["b"][::-1], out[::-1], grad["xb"], grad["hb"])
    return loss, grad


# --- labelled spans for training ------------------------------------------------------

def _written(rng: np.random.Generator) -> tuple[int, str]:
    """A kind (or -1: a look-alike) and a writing of it."""
    pick = lambda *xs: xs[rng.integers(len(xs))]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: "".join(rng.choice(list("aeioulnrstdmkh"), rng.integers(2, 9)))

    def card(valid: bool) -> str:
        d = pick("4", "5", "37", "6011") + digits(14)
        d = d[:15]
        return d + next(str(k) for k in rng.permutation(10) if luhn(d + str(k)) == valid)

    kind = int(rng.integers(-1, 4))
    if kind == 0:
        name, host, top = pick(word(), f"{word()}.{word()}", f"{word()}{digits(2)}"), word(), pick("com", "org", "net", "example.com", "de")
        at, dot = pick(("@", "."), ("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" @ ", " . "), ("(at)", "."))
        return 0, f"{name}{at}{host}{dot}{top.replace('.', dot)}"
    if kind == 1:
        if rng.random() < 0.4:
            return 1, ":".join(f"{k:x}" for k in rng.integers(1, 65536, 8)) if rng.random() < 0.5 else f"2001:db8::{rng.integers(1, 65536):x}:{rng.integers(1, 65536):x}"
        return 1, pick(".", ".", ".", "[.]", " . ").join(str(k) for k in rng.integers(0, 256, 4))
    if kind == 2:
        d, sep = card(True), pick("", "", " ", "-", ".", "  ", "/")
        return 2, sep.join(d[i:i + 4] for i in range(0, 16, 4))
    if kind == 3:
        a, b, c = digits(3), digits(3), digits(4)
        return 3, pick(f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}")
    return -1, pick(hashlib.md5(rng.bytes(4)).hexdigest(), f"{digits(1)}.{digits(1)}.{digits(2)}", f"20{digits(2)}-0{digits(1)}-1{digits(1)}", digits(5),
                    f"{word()} at {word()}", f"{word()}@{word()}", f"{digits(2)}:{digits(2)}", f"${digits(3)}.{digits(2)}", f"{word()}, dot {word()}",
                    f"http://{word()}.com/{word()}", "### $$$", f"{digits(2)}/{digits(2)}/{digits(4)}", f"{word()}: {digits(3)} - {digits(3)}", f"{word()} | {word()}")


def training_windows(texts: list[str], rng: np.random.Generator, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags, (time, window), of ``n`` stretches of the texts with spans put in."""
    texts = [t for t in texts if t and not t.isspace()] or ["some words without any text"]
    x, y = np.empty((LENGTH, n), np.uint8), np.zeros((LENGTH, n), np.int64)
    for k in range(n):
        text = texts[rng.integers(len(texts))]
        spans = base_spans(text)
        if spans and rng.random() < 0.3:  # around a base span of the sample
            at = max(0, spans[rng.integers(len(spans))][1] - int(rng.integers(5, LENGTH - 30)))
        else:
            at = int(rng.integers(0, max(1, len(text) - LENGTH)))
        piece = text[at:at + LENGTH]
        tags = [0] * len(piece)
        for kind, a, b in spans:
            for i in range(max(a, at), min(b, at + LENGTH)):
                tags[i - at] = kind + 1
        if rng.random() < 0.75 and not any(tags):
            gaps = [i for i, c in enumerate(piece) if c == " "] or [0]
            i = gaps[rng.integers(len(gaps))]
            kind, s = _written(rng)
            s = s.upper() if rng.random() < 0.1 else s
            edge = ["", "(", ", ", ": "][rng.integers(4)] if rng.random() < 0.3 else ""
            tail = [".", ",", ")", "!!", "$$$"][rng.integers(5)] if rng.random() < 0.4 else ""
            piece = f"{piece[:i]} {edge}{s}{tail}{piece[i:] or ' '}"
            tags = tags[:i] + [0] * (1 + len(edge)) + [kind + 1] * len(s) + [0] * len(tail) + (tags[i:] or [0])
        if any(tags) and rng.random() < 0.25:  # the text ends soon after the span
            end = min(LENGTH, len(tags) - tags[::-1].index(max(tags)) + int(rng.integers(0, 3)))
            piece, tags = piece[:end].rjust(LENGTH), [0] * (LENGTH - len(tags[:end])) + tags[:end]
        piece = (piece + " " * LENGTH)[:LENGTH]
        x[:, k], y[:, k] = codes(piece), (tags + [0] * LENGTH)[:LENGTH]
    return x, y


def train(texts: list[str], steps: int = STEPS, seed: int = SEED) -> Tagger:
    rng = np.random.default_rng(seed)
    p = _initial(rng, HIDDEN)
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    for step in range(1, steps + 1):
        x, y = training_windows(texts, rng, BATCH)
        _, grad = loss_and_gradients(p, x, y)
        size = np.sqrt(sum((g ** 2).sum() for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 50 * BATCH / 8 / max(size, 1e-9))
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.01 * (g * g - square[k])
            p[k] -= rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)
    return Tagger(p)


# --- tagging ----------------------------------------------------------------------

def _active(sizes: np.ndarray) -> list[int]:
    """For each step t the number of windows, ordered longest first, that are longer than t."""
    return np.searchsorted(-sizes, -np.arange(sizes[0]), side="left").tolist() if len(sizes) else []


def _side_by_side(windows: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The windows (text, start, length) in groups of like length, each of at most ``SIDE_CHARS``
    characters or a single window."""
    groups, chars = [], 0
    for window in sorted(windows, key=lambda w: w[2], reverse=True):
        if not groups or chars + window[2] > SIDE_CHARS:
            groups.append([])
            chars = 0
        groups[-1].append(window)
        chars += window[2]
    return groups


def _inputs(px: np.ndarray, chars: np.ndarray, space: np.ndarray, by_rows: bool) -> np.ndarray:
    """The inputs' part of the gates, (feature, window), from a table by character (``by_rows``) or
    by feature."""
    if by_rows:
        return np.take(px, chars, axis=0, out=space.reshape(len(chars), -1), mode="clip").T
    return np.take(px, chars, axis=1, out=space.reshape(-1, len(chars)), mode="clip")


def logistic(z: np.ndarray, out: np.ndarray) -> None:
    """1 / (1 + e^z), into ``out`` (which may be z). An e^z beyond single precision is infinite,
    which gives the 0 that it should; numpy's warning of it is the caller's to silence. numpy's exp
    is arithmetic on all x86 machines; its tanh reads tables, slowly on some."""
    np.exp(z, out=out)
    out += np.float32(1)
    np.divide(np.float32(1), out, out=out)


def quick_tanh(z: np.ndarray, out: np.ndarray, s: np.ndarray, q: np.ndarray) -> None:
    """tanh of z, into ``out`` (which may be z); s and q are of its shape, to work in."""
    np.multiply(z, np.float32(-2), out=s)
    logistic(s, q)
    np.multiply(q, np.float32(2), out=out)
    out -= np.float32(1)


def cuts(n: int) -> list[tuple[int, int]]:
    """(start, length) of the windows of a text of n characters: as few as will do, of one length."""
    if n <= WINDOW:
        return [(0, n)] if n else []
    count = -(-(n - OVERLAP) // (WINDOW - OVERLAP))
    size = -(-(n + (count - 1) * OVERLAP) // count)
    return [(min(i * (size - OVERLAP), n - size), size) for i in range(count)]


@functools.cache
def rows_are_quicker() -> bool:
    """Which of the two gathers takes less time on this machine (they give the same numbers):
    whole rows, added transposed, or a column each. Once per process."""
    rng = np.random.default_rng(0)
    table, chars = rng.random((4 * HIDDEN, CODES)).astype(np.float32), rng.integers(0, CODES, 1024).astype(np.uint8)
    space, z, spent = np.empty(table.shape[0] * len(chars), np.float32), np.zeros((table.shape[0], len(chars)), np.float32), []
    for by_rows in (False, True):
        px, times = np.ascontiguousarray(table.T) if by_rows else table, []
        for _ in range(15):
            begin = time.perf_counter()
            z += _inputs(px, chars, space, by_rows)
            times.append(time.perf_counter() - begin)
        spent.append(min(times))
    return spent[1] < spent[0]


class Tagger:
    """The trained network in single precision, for many windows side by side."""

    def __init__(self, p: dict[str, np.ndarray]):
        n = p["hf"].shape[1]
        sign = np.full((4 * n, 1), -1.0)  # the logistic's e^-z
        sign[3 * n:] = -2.0  # tanh(z) = 2 / (1 + e^-2z) - 1
        # cells and outputs are kept at half their size, so what reads outputs takes twice of it
        share = {"x": sign, "h": 2 * sign, "e": 2.0}
        self.p = {k: np.ascontiguousarray(v * share[k[0]] if len(k) > 1 else v, np.float32) for k, v in p.items()}
        d = (self.p["t"] - self.p["t"][0, 0]).astype(np.float64)
        self.within = d[1:, 1:].max()  # most that one more step among the kinds can add,
        self.enter = d[0, 1:].max()  # coming from "none",
        self.around = self.enter + max(0.0, d[1:, 0].max()) - self.within  # and there and back

    def _direction(self, side: str, text: np.ndarray, first: np.ndarray, step: int, sizes: np.ndarray) -> np.ndarray:
        """One direction's part of the emissions, (time, tag, window); windows lie longest first."""
        px, ph, pe = self.p[f"x{side}"], self.p[f"h{side}"], self.p[f"e{side}"]
        n, m, by_rows = ph.shape[1], len(first), rows_are_quicker()
        if by_rows:
            px = np.ascontiguousarray(px.T)
        h, c = np.zeros((n, m), np.float32), np.zeros((n, m), np.float32)
        out = np.empty((int(sizes[0]), TAGS, m), np.float32)
        # the same memory at every step: fresh arrays of this size are mapped anew each time
        space, more = np.empty(4 * n * m, np.float32), np.empty(4 * n * m, np.float32)
        with np.errstate(over="ignore"):
            for t, k in enumerate(_active(sizes)):
                if k < h.shape[1]:
                    h, c = np.ascontiguousarray(h[:, :k]), np.ascontiguousarray(c[:, :k])
                z = space[:4 * n * k].reshape(4 * n, k)
                np.matmul(ph, h, out=z)
                z += _inputs(px, text[first[:k] + step * t], more[:4 * n * k], by_rows)
                logistic(z, z)
                gates, g = z[:3 * n], z[3 * n:]
                g -= np.float32(0.5)
                c *= gates[n:2 * n]
                g *= gates[:n]
                c += g
                np.multiply(c, np.float32(-4), out=h)  # tanh of twice the half cell, halved
                logistic(h, h)
                h -= np.float32(0.5)
                h *= gates[2 * n:]
                np.matmul(pe, h, out=out[t, :, :k])
        return out

    def emissions(self, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tag, place) scores of all windows, and where each window's places begin; windows
        (begin and length in ``text``) must be ordered longest first."""
        place = np.cumsum(sizes) - sizes
        out = np.empty((TAGS, int(sizes.sum())), np.float32)
        if len(sizes):
            ahead = self._direction("f", text, starts, 1, sizes)
            back = self._direction("b", text, starts + sizes - 1, -1, sizes)
            edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for a, b in zip(edges, edges[1:], strict=False):  # windows of one length
                n = int(sizes[a])
                both = ahead[:n, :, a:b] + back[:n, :, a:b][::-1]
                out[:, place[a]:place[a] + n * (b - a)] = both.transpose(1, 2, 0).reshape(TAGS, -1)
            out += self.p["e"]
        return out, place

    def undecided(self, e: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Windows in which some path might beat "none" throughout: the best stretch's sum of
        upper bounds, by a running maximum, must exceed what entering and leaving costs."""
        more = (e[1:].max(axis=0) - e[0]) + np.float32(self.within)
        # a path that begins among the kinds pays no entry
        best, run = np.full(len(place), -np.inf, np.float32), np.full(len(place), max(0.0, -self.enter), np.float32)
        for t, k in enumerate(_active(sizes)):
            r = run[:k]
            np.maximum(r, 0, out=r)
            r += more[place[:k] + t]
            np.maximum(best[:k], r, out=best[:k])
        return np.flatnonzero(best + self.around > -1e-3)

    def viterbi(self, e: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """Best tags of each window (longest first)."""
        if not len(sizes):
            return []
        t, n, steps = self.p["t"][:, :, None], len(sizes), int(sizes[0])
        best, back = e[:, place], np.empty((steps, TAGS, n), np.int8)
        back[:] = np.arange(TAGS)[:, None]  # past its end a window stays as it is
        for k, m in enumerate(_active(sizes)):
            if k:
                paths = best[:, None, :m] + t
                back[k, :, :m] = paths.argmax(axis=0)
                best[:, :m] = paths.max(axis=0) + e[:, place[:m] + k]
        tags, at = np.empty((steps, n), np.int8), np.arange(n)
        tags[-1] = best.argmax(axis=0)
        for k in range(steps - 1, 0, -1):
            tags[k - 1] = back[k, tags[k], at]
        return [tags[:size, i] for i, size in enumerate(sizes.tolist())]

    def proposals(self, texts: list[str]) -> list[list[tuple[float, int, int, int]]]:
        """Per text the spans of its windows: (score, kind, start, end)."""
        found: list[list] = [[] for _ in texts]
        lengths = [len(t) for t in texts]
        begins, coded = np.cumsum([0, *lengths]), codes("".join(texts))
        windows = [(i, *cut) for i, n in enumerate(lengths) for cut in cuts(n)]
        while windows:
            again = set()
            for side in _side_by_side(windows):
                for (i, start, size), spans in zip(side, self._spans(coded, begins, side), strict=True):
                    for gain, kind, a, b in spans:
                        if a == 0 < start or b == size < lengths[i] - start:
                            # cut off by its window's edge
                            wide = 2 * size
                            left = max(0, start + (a + b) // 2 - size)
                            again.add((i, left, min(wide, lengths[i] - left)))
                        else:
                            found[i].append((gain, kind, start + a, start + b))
            windows = sorted(again - set(windows))
        return found

    def _spans(self, coded: np.ndarray, begins: np.ndarray, windows: list[tuple[int, int, int]]) -> list[list]:
        """Per window (text, start, length) its spans: (score, kind, start, end) within it."""
        owner, start, size = np.array(windows, np.int64).T
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        e, place = self.emissions(coded, begins[owner] + start, size)
        open_ = self.undecided(e, place, size)
        out: list[list] = [[] for _ in windows]
        for w, tags in zip(open_.tolist(), self.viterbi(e, place[open_], size[open_]), strict=True):
            tags = tags.astype(np.int64)
            scores = e[:, place[w]:place[w] + size[w]]
            gains = np.concatenate([[0.0], np.cumsum(scores[tags, np.arange(len(tags))] - scores[0], dtype=np.float64)])
            edges = np.flatnonzero(np.diff(tags)) + 1
            bounds = [0, *edges.tolist(), len(tags)]
            out[order[w]] = [(float(gains[b] - gains[a]), int(tags[a]) - 1, a, b) for a, b in zip(bounds, bounds[1:], strict=False) if tags[a]]
        return out


def _held(kind: int, text: str, a: int, b: int) -> list[tuple[int, int]]:
    """A proposed span if it can be one, else what in it, give or take a character, can: adjoining
    spans of a kind are proposed as one."""
    if holds(kind, text[a:b]):
        return [(a, b)]
    a = max(0, a - 1)
    return [(a + m.start(), a + m.end()) for pattern in _PATTERNS[kind] for m in pattern.finditer(text[a:b + 1]) if holds(kind, m.group())]


def reconciled(text: str, base: list[tuple[int, int, int]], proposals: list[tuple[float, int, int, int]]) -> list[tuple[int, int, int]]:
    """The base spans, and the proposals of greatest total score that hold and do not overlap
    them or each other."""
    taken = sorted((a, b) for _, a, b in base)
    clear = {}
    for gain, kind, a, b in proposals:
        for c, d in _held(kind, text, a, b) if gain > 0 else ():
            if all(d <= x or c >= y for x, y in taken):
                share = gain * (d - c) / (b - a)
                clear[kind, c, d] = max(share, clear.get((kind, c, d), 0.0))
    spans = sorted(clear, key=lambda s: (s[2], s[1], s[0]))
    best: list[tuple[float, list]] = [(0.0, [])]
    for i, s in enumerate(spans):
        j = next((k for k in range(i, 0, -1) if spans[k - 1][2] <= s[1]), 0)
        with_it = best[j][0] + clear[s]
        best.append((with_it, [*best[j][1], s]) if with_it > best[i][0] else best[i])
    return sorted([*base, *best[-1][1]], key=lambda s: (s[0], s[1]))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# --- Spark side -------------------------------------------------------------------

def learn(docs: DataFrame) -> Tagger:
    """Trains on a bounded sample, chosen by a hash of doc_id: of each text up to ``SAMPLE_CHARS``
    characters. Narrow rows are ordered; the texts follow by their number and hash."""
    named = id_and_text(docs).where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("h"), "text")
    at = F.pmod("h", F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    named = named.withColumn("text", F.col("text").substr(at, F.lit(SAMPLE_CHARS)))
    chosen = bounded_sample(named.select("doc_id", "h").where("doc_id IS NOT NULL").distinct(), "doc_id", SAMPLE_ROWS)
    texts = named.join(F.broadcast(chosen), ["doc_id", "h"], "left_semi").select("text").distinct()
    return train(sorted(r.text for r in texts.collect()))


def find(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, counts of all spans by kind, base_sha256, spans."""
    docs = id_and_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs))

    def tagged(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.decode() for t in text_bytes(batch.column(1))]
        counts, digests, listed = [], [], []
        for text, proposals in zip(texts, shared.value.proposals(texts), strict=True):
            base = base_spans(text)
            spans = reconciled(text, base, proposals) if proposals else base
            counts.append([sum(s[0] == k for s in spans) for k in range(len(KINDS))])
            digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
            listed.append(_listed(spans))
        columns = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(KINDS))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests), pa.array(listed)],
                                          names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return map_batches(docs, "text", schema, tagged, SLICE_BYTES)
