"""Operator 8, toxicity by a weighted finite-state pattern grammar.

Three transducers in the (max, +) semiring:

* lexicon: the letters of a word to a class symbol. Insults and threats have four weight
  levels; targets, negation, reported speech and clause ends have a symbol each. The arcs
  are whole words and stems (a stem takes any ending).
* scope: marks what follows a negation (three words) or a verb of reported speech (the rest
  of the clause) and pays for it.
* pattern: scores a clause by its insults and threats, with a bonus where a target stands
  in the same clause.

Scope and pattern are composed once into a clause machine; a clause's score is its best
path. A document's score is a logistic function of the greatest clause score and of the
number, sum and share of its matched clauses.

Insult stems and the weights of all listed words are learned from a bounded sample of
labelled rows: a stem enters if the toxic share of the documents that hold it is
significant against all candidates, and weighs its smoothed log-odds. Counting runs on the
executors; the driver sees only stems that passed, and the sample's feature rows.

Defined cases: a null or empty text has no clause and scores the intercept; rows without
label, or of a null doc_id, are never learned from; a doc_id labelled more than once counts
as toxic if any of its labels does; without a toxic and a clean label the listed words keep
their prior weights; a very long text is learned from and scored whole; repeated documents score alike; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import bounded_sample, id_and_text, map_batches, pieces, text_bytes, written

FOLDS, HELD_FOLD = 5, 0
SAMPLE_ROWS = 12_000  # labelled rows learned from, at most
STEM_LENGTHS = range(4, 9)
STEM_SHARE = 0.9  # toxic share that a stem needs
MAX_STEMS = 5_000
THRESHOLD = 0.5
MEMO_WORDS = 100_000  # whose symbols a task remembers

# Fixed word lists of the grammar (lower case, a trailing * marks a stem).
INSULTS = "idiot* moron* stupid* dumb* loser* scum trash pathetic worthless disgusting clown* fool* dumm* trottel* imbécile* estúpid*"
THREATS = "kill* hurt* destroy* burn* beat* stab* töten verletzen tuer frapper matar golpear"
TARGETS = "you your yours he she him her they them these those people du dich dir ihr sie vous toi tu usted ustedes vosotros ellos"
NEGATIONS = "not no never neither nor nobody nicht kein* nie pas jamais aucun nunca jamás ningun*"
REPORTING = "said says say told tells quoted quote wrote claimed sagte sagt schrieb dit disait écrit dijo dice escribió"

OTHER, END, TARGET, NEGATION, REPORT = b".", b"|", b"Y", b"N", b"R"
INSULT_LEVELS, THREAT_LEVELS = b"abcd", b"efgh"
LEVEL_WEIGHTS = (1.0, 2.0, 3.5, 5.0)  # of the log-odds levels
PRIOR_WEIGHT = 2.0  # log-odds of a listed insult or threat before any label is seen
PRIOR_DOCS = 2.0
TARGET_BONUS, NEGATED, REPORTED = 1.5, -2.5, -1.0
SCOPE_WORDS = 3


# --- transducers ------------------------------------------------------------------

class Transducer:
    """Arcs (state, input byte) -> [(output byte, weight, state)]; weights add along a path,
    the best path counts. State 0 is the start; ``final`` has the weights of ending."""

    def __init__(self):
        self.arcs: dict[tuple[int, int], list[tuple[int, float, int]]] = defaultdict(list)
        self.final: dict[int, float] = {}

    def arc(self, state: int, symbol: int, out: int, weight: float, to: int) -> None:
        self.arcs[state, symbol].append((out, weight, to))

    def compose(self, other: Transducer) -> Transducer:
        """What ``other`` makes of this one's output."""
        result, names, open_ = Transducer(), {(0, 0): 0}, [(0, 0)]
        symbols = defaultdict(list)
        for (state, symbol), arcs in self.arcs.items():
            symbols[state].append((symbol, arcs))
        while open_:
            a, b = open_.pop()
            here = names[a, b]
            if a in self.final and b in other.final:
                result.final[here] = self.final[a] + other.final[b]
            for symbol, arcs in symbols[a]:
                for middle, weight, a2 in arcs:
                    for out, more, b2 in other.arcs.get((b, middle), ()):
                        if (a2, b2) not in names:
                            names[a2, b2] = len(names)
                            open_.append((a2, b2))
                        result.arc(here, symbol, out, weight + more, names[a2, b2])
        return result

    def best(self, symbols: bytes) -> float:
        """Weight of the best accepting path."""
        now = {0: 0.0}
        for symbol in symbols:
            new: dict[int, float] = {}
            for state, weight in now.items():
                for _, more, to in self.arcs.get((state, symbol), ()):
                    if weight + more > new.get(to, -math.inf):
                        new[to] = weight + more
            now = new
        return max((w + self.final[s] for s, w in now.items() if s in self.final), default=-math.inf)


ATTACKS = INSULT_LEVELS + THREAT_LEVELS
PLAIN = OTHER + TARGET + NEGATION + REPORT


def scope_transducer() -> Transducer:
    """Class symbols to class symbols; attacks under negation or report come out weakened.
    States: words left in the negation's scope, times two, plus one under report."""
    t = Transducer()
    for left in range(SCOPE_WORDS + 1):
        for reported in (0, 1):
            state = 2 * left + reported
            t.final[state] = 0.0
            after = 2 * max(left - 1, 0) + reported
            for c in OTHER + TARGET:
                t.arc(state, c, c, 0.0, after)
            t.arc(state, NEGATION[0], NEGATION[0], 0.0, 2 * SCOPE_WORDS + reported)
            t.arc(state, REPORT[0], REPORT[0], 0.0, 2 * max(left - 1, 0) + 1)
            for c in ATTACKS:
                t.arc(state, c, c, NEGATED * (left > 0) + REPORTED * reported, after)
    return t


def pattern_transducer() -> Transducer:
    """States: 0 nothing yet, 1 a target, 2 an attack, 3 both. A threat alone matches only
    half; an attack may also be passed over, so weakened ones never lower a clause."""
    t = Transducer()
    for state in range(4):
        t.final[state] = 0.0
        for c in PLAIN:
            target = c == TARGET[0]
            bonus = TARGET_BONUS if target and state == 2 else 0.0
            t.arc(state, c, c, bonus, state | 1 if target else state)
        for levels, share in ((INSULT_LEVELS, 1.0), (THREAT_LEVELS, 0.5)):
            for c, weight in zip(levels, LEVEL_WEIGHTS, strict=True):
                bonus = TARGET_BONUS if state == 1 else 0.0
                t.arc(state, c, c, weight * share + bonus, state | 2)
                t.arc(state, c, OTHER[0], -0.0, state)
    return t


class Lexicon:
    """The lexicon transducer: a word to its class symbol, and one more if it ends a clause."""

    def __init__(self, words: dict[str, int], stems: dict[str, int]):
        self.words, self.stems = words, stems
        self.longest = max(map(len, stems), default=0)
        self.memo: dict[str, bytes] = {}

    def symbols(self, word: str) -> bytes:
        core = word.strip(_EDGES)
        symbol = self.words.get(core)
        for k in range(min(len(core), self.longest), 0, -1) if symbol is None else ():
            if (symbol := self.stems.get(core[:k])) is not None:
                break
        out = OTHER if symbol is None else bytes((symbol,))
        return out + END if word == "|" or word.rstrip(_CLOSING)[-1:] in _ENDS else out

    def read(self, text: str) -> bytes:
        """Class symbols of a text."""
        words = text.lower().replace("\n", " | ").split()
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        for w in set(words).difference(self.memo):
            self.memo[w] = self.symbols(w)
        return b"".join(map(self.memo.__getitem__, words))


_CLOSING, _ENDS = ")]}\"'»”’*#$%&", tuple(".,;:!?…")
_EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’¿¡…"


class Grammar:
    """Lexicon and clause machine; ``coefficients`` of the logistic score, intercept first."""

    def __init__(self, lexicon: Lexicon, coefficients=None):
        self.lexicon = lexicon
        self.machine = scope_transducer().compose(pattern_transducer())
        self.coefficients = coefficients
        self.scores: dict[bytes, float] = {}

    def features(self, text: str) -> tuple[float, float, float, float]:
        """Greatest clause score; log of the matched clauses' sum and number; their share."""
        read = self.lexicon.read(text)
        top = total = matched = 0.0
        clauses = read.split(END)
        for clause in filter(_ATTACK.search, clauses):
            clause = _GAP.sub(OTHER * (SCOPE_WORDS + 1), clause)
            score = self.scores.get(clause)
            if score is None:
                if len(self.scores) > 100_000:
                    self.scores.clear()
                score = self.scores[clause] = max(0.0, self.machine.best(clause))
            if score > 0:
                top, total, matched = max(top, score), total + score, matched + 1
        return top, math.log1p(total), math.log1p(matched), matched / max(1, len(clauses))

    def scored(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts]).reshape(-1, 4)
        z = self.coefficients[0] + x @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


_ATTACK = re.compile(b"[" + ATTACKS + b"]")
_GAP = re.compile(re.escape(OTHER) + b"{%d,}" % (SCOPE_WORDS + 1))


# --- learning ---------------------------------------------------------------------

def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the number as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(doc_id.cast("long").cast("string").cast("binary")) % folds


BANDS, MINIMA = 4, 3  # least shingle hashes that near copies are told by
_MIXES = np.random.default_rng(8).integers(1, 1 << 62, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents outside the held-out fold,
    chosen by a hash of doc_id, whatever their length. Copies would make their chance words
    look significant, so of rows with one label that agree in all ``MINIMA`` of one of
    ``BANDS`` bands of least shingle hashes the one of least doc_id stays: that is likely
    from a similarity of 0.8 on, and rare (1 in 30) at 0.2, as for texts that only share
    a passage. Only narrow columns are ordered and grouped; then the chosen ids, a
    bounded number, pick the texts."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")) \
        .where(F.col("y").isNotNull() & (fold(F.col("doc_id"), folds) != held)) \
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = bounded_sample(known, "doc_id", rows)
    picked = written(id_and_text(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", F.xxhash64("text").alias("digest")), "labelled")
    bands = [f"band{i}" for i in range(BANDS)]
    kept = picked.mapInArrow(_bands, "doc_id long, y int, digest long, " + ", ".join(f"{b} long" for b in bands)) \
        .groupBy("doc_id", "y").agg(F.min(F.struct("digest", *bands)).alias("s")).select("doc_id", "y", "s.*")
    for band in bands:
        kept = kept.groupBy(band, "y").agg(F.min(F.struct("doc_id", "digest", *(b for b in bands if b != band))).alias("s")).select("y", band, "s.*")
    return picked.join(F.broadcast(kept.select("doc_id", "digest")), ["doc_id", "digest"]).groupBy("doc_id") \
        .agg(F.min("text").alias("text"), F.max("y").alias("y"))


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 4 << 20):
        found = np.zeros((batch.num_rows, BANDS), np.int64)
        for i, text in enumerate(text_bytes(batch.column(1))):
            words = text.split()
            shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False)) if len(words) > 2 else [text]
            hashes = np.fromiter(map(zlib.crc32, shingles), np.uint64)
            least = np.array([(hashes * mix >> np.uint64(32)).min() for mix in _MIXES], "<u8").reshape(BANDS, MINIMA)
            found[i] = [xxhash.xxh64_intdigest(band.tobytes()) >> 1 for band in least]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *map(pa.array, found.T.copy())],
                                         names=["doc_id", "y", "digest", *(f"band{i}" for i in range(BANDS))])


def _stems_of(text: str) -> set[str]:
    words = {w.strip(_EDGES) for w in text.lower().split()}
    return {w[:k] for w in words for k in STEM_LENGTHS if len(w) >= k and w[:k].isalpha()} | {w + "$" for w in words if w.isalpha()}


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", 4 << 20):
        counts: tuple[Counter, Counter] = Counter(), Counter()
        for t, y in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            counts[y > 0].update(_stems_of(t.decode()))
        stems = [*(counts[0] | counts[1])]
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([counts[1][s] for s in stems], pa.int64()),
                                          pa.array([counts[0][s] for s in stems], pa.int64())], names=["stem", "toxic", "clean"])


def _level(log_odds: float) -> int | None:
    """Index of the weight level nearest to the log-odds; none below half the least."""
    if log_odds < LEVEL_WEIGHTS[0] / 2:
        return None
    return min(range(len(LEVEL_WEIGHTS)), key=lambda i: abs(LEVEL_WEIGHTS[i] - log_odds))


def learned_lexicon(sample: DataFrame) -> Lexicon:
    n = {r.y: r.n for r in sample.groupBy((F.col("y") > 0).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    listed = {w: cls for cls, ws in ((INSULT_LEVELS, INSULTS), (THREAT_LEVELS, THREATS)) for w in ws.split()}
    rows = []
    if n_toxic and n_clean:
        share = n_toxic / (n_toxic + n_clean)
        counts = written(sample.select("doc_id", "text", "y").mapInArrow(_stem_counts, "stem string, toxic long, clean long")
                         .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxic-stems")
        k, m = F.col("toxic"), F.col("clean")
        rate = k / (k + m)
        gain = k * F.log(rate / share) + F.when(m > 0, m * F.log((m / (k + m)) / (1 - share))).otherwise(0.0)
        bound = math.log(max(2, counts.count())) + 5
        keys = [w[:-1] if w.endswith("*") else w + "$" for w in listed]
        rows = counts.where(((k > 0) & (rate > share) & (rate > STEM_SHARE) & (gain > bound))).orderBy(gain.desc(), "stem").limit(MAX_STEMS) \
            .unionByName(counts.where(F.col("stem").isin(keys))).distinct().collect()
    seen = {r.stem: (r.toxic, r.clean) for r in rows}

    def log_odds(stem: str, prior: float) -> float:
        t, c = seen.get(stem, (0, 0))
        if not (n_toxic and n_clean):
            return prior
        return math.log((t + PRIOR_DOCS * math.exp(prior) * n_toxic / (n_toxic + n_clean)) / (n_toxic + PRIOR_DOCS)
                        / ((c + PRIOR_DOCS * n_clean / (n_toxic + n_clean)) / (n_clean + PRIOR_DOCS)))

    words: dict[str, int] = {}
    stems: dict[str, int] = {}
    for symbol, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTING)):
        for w in ws.split():
            (stems if w.endswith("*") else words)[w.rstrip("*")] = symbol[0]
    for w, levels in listed.items():
        level = _level(log_odds(w[:-1] if w.endswith("*") else w + "$", PRIOR_WEIGHT))
        if level is not None:
            (stems if w.endswith("*") else words)[w.rstrip("*")] = levels[level]
    # the shortest significant stems; a longer one adds nothing where a prefix is as strong
    for stem in sorted(seen, key=lambda s: (len(s.rstrip("$")), s)):
        level = _level(log_odds(stem, 0.0))
        base = stem.rstrip("$")
        if level is None or any(stems.get(base[:k], -1) >= INSULT_LEVELS[level] for k in range(1, len(base) + 1)):
            continue
        (words if stem.endswith("$") else stems)[base] = INSULT_LEVELS[level]
    return Lexicon(words, stems)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Coefficients, intercept first, by iterated least squares."""
    a = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-3, *[ridge] * x.shape[1]])
    beta = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        hessian = (a * (p * (1 - p))[:, None]).T @ a + penalty
        step = np.linalg.solve(hessian, a.T @ (y - p) - penalty @ beta)
        beta += step / max(1.0, np.abs(step).max() / 5)
    return beta


PRIOR_COEFFICIENTS = (-3.0, 0.6, 0.6, 0.3, 2.0)  # without labels


def learn(docs: DataFrame, labels: DataFrame) -> Grammar:
    sample = written(labelled_sample(docs, labels, "toxic", FOLDS, HELD_FOLD, SAMPLE_ROWS), "toxic-sample")
    grammar = Grammar(learned_lexicon(sample))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        f = [grammar.features(t.decode()) for t in text_bytes(batch.column(1))]
        return pa.RecordBatch.from_arrays([pa.array(f, pa.list_(pa.float64())), batch.column(2)], names=["x", "y"])

    rows = map_batches(sample.select("doc_id", "text", "y"), "text", "x array<double>, y int", features).collect()
    y = np.array([r.y > 0 for r in rows], float)
    both = 0 < y.sum() < len(y)
    grammar.coefficients = fit_logistic(np.array([r.x for r in rows]), y) if both else np.array(PRIOR_COEFFICIENTS)
    return grammar


# --- Spark side -------------------------------------------------------------------

def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value.scored([t.decode() for t in text_bytes(batch.column(1))])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return map_batches(id_and_text(docs), "text", "doc_id long, score double", scored) \
        .select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"), "score",
                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels))
    at = docs.columns.index("text")

    def rest(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = shared.value.scored([t.decode() for t in text_bytes(batch.column(at))])
        return batch.filter(pa.array(s < THRESHOLD))

    return map_batches(docs, "text", docs.schema, rest)
