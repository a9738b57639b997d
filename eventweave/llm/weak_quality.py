"""Quality classifier from weak labels (operator 5).

Heuristic labellers vote good (1), bad (2) or abstain (0) on every document.  Their
accuracies are unknown and they overlap: expectation-maximisation over the counts of
vote patterns of *all* documents (Dawid-Skene: class prior and, per labeller and
class, the probability of each vote) estimates them, and the posterior of a document's
pattern is its weak label.  The posteriors train a hashed linear scorer (logistic
regression on hashed byte trigrams and hashed word shapes), which judges all documents,
including those on which every labeller abstains.

The pattern counts that reach the driver are bounded by 3^labellers.  The scorer is
fitted on a bounded sample of at most ``train_rows`` distinct documents, chosen by a hash
of id and text, in ``PARTS`` groups: each round they train on their own part from the common
coefficients and the results are averaged by rows.

Edge cases: a null or empty text gets only abstentions, so its weak label is the class
prior and its score the scorer's intercept; fewer than ``MIN_WORDS`` words: all
labellers abstain, and the score stays near the intercept; repeated rows are judged alike; an empty table gives an
empty result; other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesops as B
from .sampling import distinct_sample

TRAIN_ROWS = 20_000
PARTS = 16
ROUNDS = 3
EPOCHS = 6
TRIGRAMS = 1 << 15
SHAPES = 1 << 6
MIN_WORDS = 8
KEEP = 0.35

#: fixed values: frequent function words of the supported languages (en, fr, de, es)
STOP_WORDS = (
    "the and of to in is it that for on was with as at by an be this are or "
    "le la les des et un une est en que qui dans pour sur "
    "der die das und ist ein eine zu mit von auf nicht el los las una por con del de y"
).split()
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#%&$*{}<>^~=_\\@+", dtype=np.uint8)] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_END = np.zeros(256, dtype=bool)
_END[np.frombuffer(b".!?", dtype=np.uint8)] = True


def _stop_hashes() -> np.ndarray:
    text = " ".join(STOP_WORDS).encode()
    data = np.frombuffer(text, dtype=np.uint8)
    start, end, _ = B.words(data, np.array([0, len(data)]))
    return np.unique(B.word_hashes(data, start, end))


_INF = math.inf
#: (name, bad below, good from, good to, bad above) of a measure; a labeller abstains elsewhere
LABELLERS = (
    ("symbols", -_INF, _INF, _INF, 0.03),
    ("pipes", -_INF, _INF, _INF, 0.05),
    ("capitals", -_INF, _INF, _INF, 0.35),
    ("exclamations", -_INF, _INF, _INF, 0.15),
    ("repeats", -_INF, _INF, _INF, 0.20),
    ("stop_words", 0.04, 0.12, 0.42, 0.60),
    ("letters", 0.85, 0.93, 0.985, _INF),
    ("endings", 0.005, 0.03, 0.20, 0.50),
)


class Measures:
    """Measures, votes and scorer features of a slice of texts."""

    def __init__(self, text: pa.Array, stop: np.ndarray):
        data, offsets = B.buffers(text)
        self.data, self.offsets, self.rows = data, offsets, len(offsets) - 1
        self.start, self.end, self.first = B.words(data, offsets)
        folded = B.word_hashes(B.LOWER[data], self.start, self.end) if len(data) else np.empty(0, dtype=np.uint64)
        row_start = np.zeros(len(self.start), dtype=bool)
        row_start[self.first[:-1][self.first[:-1] < len(self.start)]] = True
        self.again = np.zeros(len(self.start), dtype=bool)
        self.again[1:] = (folded[1:] == folded[:-1]) & ~row_start[1:]
        at = np.minimum(np.searchsorted(stop, folded), len(stop) - 1)
        self.stop = stop[at] == folded

    def _bytes(self, mask: np.ndarray) -> np.ndarray:
        return B.row_sums(mask[self.data].astype(np.int64), self.offsets)

    def votes(self) -> np.ndarray:
        """(rows, labellers) of 0, 1, 2."""
        n = np.maximum(np.diff(self.first), 1)
        solid = np.maximum(self._bytes(~B.SPACE), 1)
        letters = self._bytes(_LETTER)
        pipe = np.zeros(256, dtype=bool)
        pipe[124] = True
        bang = np.zeros(256, dtype=bool)
        bang[33] = True
        ending = self.data[self.end - 1] if len(self.end) else self.data[:0]
        by_word = lambda x: B.row_sums(x.astype(np.int64), self.first) / n
        measure = (
            self._bytes(_SYMBOL) / solid,
            self._bytes(pipe) / n,
            self._bytes(_UPPER) / np.maximum(letters, 1),
            self._bytes(bang) / n,
            by_word(self.again),
            by_word(self.stop),
            letters / solid,
            by_word(_END[ending]),
        )
        out = np.zeros((self.rows, len(LABELLERS)), dtype=np.int64)
        for k, ((_, low, first, last, high), m) in enumerate(zip(LABELLERS, measure, strict=True)):
            out[:, k] = np.where((m < low) | (m > high), 2, np.where((m >= first) & (m <= last), 1, 0))
        # shares of words say little about a text that mostly repeats a few of them
        out[:, 5:][measure[4] > 0.1] = 0
        out[np.diff(self.first) < MIN_WORDS] = 0
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashed trigrams of all bytes and their row borders, hashed word shapes and theirs."""
        d = self.data.astype(np.uint32)
        if len(d) < 3:
            tri, border = np.empty(0, dtype=np.int64), np.zeros(self.rows + 1, dtype=np.int64)
        else:
            h = (d[:-2] * np.uint32(0x9E3779B1) + d[1:-1] * np.uint32(0x85EBCA77) + d[2:] * np.uint32(0xC2B2AE3D)).astype(np.uint32)
            h ^= h >> np.uint32(15)
            tri = (h * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)
            inside = np.ones(len(tri), dtype=bool)  # trigrams that cross a row border belong to no row
            for back in (1, 2):
                cross = self.offsets[1:-1] - back
                inside[cross[(cross >= 0) & (cross < len(tri))]] = False
            count = np.zeros(len(tri) + 1, dtype=np.int64)
            np.cumsum(inside, out=count[1:])
            border = count[np.minimum(self.offsets, len(tri))]
            tri = tri[inside]
        if len(self.start):
            a, z = self.data[self.start], self.data[self.end - 1]
            size = np.minimum(np.log2(self.end - self.start).astype(np.int64), 3)
            shape = self.again + 2 * _UPPER[a].astype(np.int64) + 4 * (~_LETTER[z]).astype(np.int64) + 8 * _UPPER[z].astype(np.int64) + 16 * size
            shape = shape.astype(np.int64) % SHAPES
        else:
            shape = np.empty(0, dtype=np.int64)
        return tri, border, shape, self.first


def pattern_code(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1]))


def expectation_maximisation(counts: dict[int, int], labellers: int, rounds: int = 200) -> tuple[dict[int, float], float, np.ndarray]:
    """Posterior of "good" for every pattern, prior of "good", and
    P(vote | class) as an array (labeller, class good/bad, vote).

    Documents without any vote (pattern 0) say nothing about accuracies; they are left
    out and have no posterior."""
    codes = np.array(sorted(c for c in counts if c), dtype=np.int64)
    if not len(codes):
        return {}, 0.5, np.full((labellers, 2, 3), 1 / 3)
    weight = np.array([counts[int(c)] for c in codes], dtype=float)
    votes = codes[:, None] // 3 ** np.arange(labellers) % 3
    good, bad = (votes == 1).sum(1), (votes == 2).sum(1)
    post = np.where(bad > 0, 0.1, np.where(good > 0, 0.9, 0.5))  # start: any bad vote speaks against a document
    prior, table = 0.5, np.zeros((labellers, 2, 3))
    for _ in range(rounds):
        mass = np.stack([weight * post, weight * (1 - post)])
        prior = (mass[0].sum() + 1) / (weight.sum() + 2)
        for v in range(3):
            table[:, :, v] = (mass @ (votes == v)).T + 1.0
        table /= table.sum(axis=2, keepdims=True)
        log = np.log(np.array([prior, 1 - prior]))[:, None] + np.stack([np.log(table[np.arange(labellers), c, votes]).sum(1) for c in (0, 1)])
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
        done = np.abs(new - post).max() < 1e-9
        post = new
        if done:
            break
    return dict(zip(codes.tolist(), post.tolist(), strict=True)), float(prior), table


class Scorer:
    """Logistic scorer on the mean weight of a text's hashed trigrams and word shapes.

    The means are shrunk by ``CALM`` neutral trigrams and words, so a text of a few words
    stays near the intercept."""

    GAIN = 10.0
    CALM = (64, 8)

    def __init__(self, w: np.ndarray | None = None):
        self.w = np.zeros(TRIGRAMS + SHAPES + 1) if w is None else w

    def _margin(self, tri: np.ndarray, at: np.ndarray, shape: np.ndarray, first: np.ndarray) -> np.ndarray:
        mean = lambda w, f, b, calm: B.row_sums(w[f], b) / (np.diff(b) + calm)
        z = mean(self.w[:TRIGRAMS], tri, at, self.CALM[0]) + mean(self.w[TRIGRAMS:-1], shape, first, self.CALM[1])
        return np.clip(self.w[-1] + self.GAIN * z, -50, 50)

    def score(self, m: Measures) -> np.ndarray:
        return 1 / (1 + np.exp(-self._margin(*m.features())))

    def train(self, parts: list[tuple[Measures, np.ndarray]], epochs: int) -> None:
        """Adagrad over slices of documents with soft labels."""
        seen = [(*m.features(), y) for m, y in parts]
        total = np.full(len(self.w), 1e-8)
        for _ in range(epochs):
            for tri, at, shape, first, y in seen:
                wrong = (1 / (1 + np.exp(-self._margin(tri, at, shape, first))) - y) / len(y)
                n, s = np.diff(at), np.diff(first)
                g = np.concatenate([
                    np.bincount(tri, np.repeat(self.GAIN * wrong / (n + self.CALM[0]), n), TRIGRAMS),
                    np.bincount(shape, np.repeat(self.GAIN * wrong / (s + self.CALM[1]), s), SHAPES),
                    [0.0],  # the intercept stays at the class prior: what a text without evidence gets
                ])
                g += 1e-6 * self.w
                total += g * g
                self.w -= 0.3 * g / np.sqrt(total)


def _by_slice(body):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = _stop_hashes()
        for batch in batches:
            for part in B.slices(batch, "text"):
                yield body(part, Measures(part.column("text"), stop))

    return run


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(pattern, docs): how many documents have each pattern of votes (at most 3^labellers rows)."""

    def body(part: pa.RecordBatch, m: Measures) -> pa.RecordBatch:
        code, n = np.unique(pattern_code(m.votes()), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n.astype(np.int64))], ["pattern", "docs"])

    counted = docs.select("text").mapInArrow(_by_slice(body), "pattern long, docs long")
    return counted.groupBy("pattern").agg(F.sum("docs").alias("docs"))


class WeakModel:
    """A fitted model: labeller accuracies, weak labels by pattern and the scorer."""

    def __init__(self, labels: dict[int, float], prior: float, table: np.ndarray, scorer: Scorer):
        self.labels, self.prior, self.table, self.scorer = labels, prior, table, scorer

    def accuracies(self) -> dict[str, float]:
        """Estimated probability that a labeller that votes is right."""
        good, bad = self.table[:, 0], self.table[:, 1]
        right = self.prior * good[:, 1] + (1 - self.prior) * bad[:, 2]
        wrong = self.prior * good[:, 2] + (1 - self.prior) * bad[:, 1]
        return {n[0]: float(a) for n, a in zip(LABELLERS, right / (right + wrong), strict=True)}


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS, epochs: int = EPOCHS) -> WeakModel:
    """Weak labels from all documents, the scorer from a bounded sample of them."""
    counts = {r["pattern"]: r["docs"] for r in vote_patterns(docs).collect()}
    scorer = Scorer()
    if not counts:
        return WeakModel({}, 0.5, np.full((len(LABELLERS), 2, 3), 1 / 3), scorer)
    labels, prior, table = expectation_maximisation(counts, len(LABELLERS))
    scorer.w[-1] = math.log(prior / (1 - prior))
    chosen = distinct_sample(docs.select("doc_id", "text"), train_rows, "weak_sample")
    # PARTS groups whatever the partitioning, so as many coefficient vectors come back each round
    sample = chosen.withColumn("part", F.pmod(F.col("pick"), F.lit(PARTS)).cast("int")).drop("pick")

    def local(w: np.ndarray):
        def run(table: pa.Table) -> pa.Table:
            stop, mine, parts, n = _stop_hashes(), Scorer(w.copy()), [], 0
            for batch in table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks().to_batches():
                for part in B.slices(batch, "text", 1 << 18):
                    y = np.array([labels.get(c, np.nan) for c in pattern_code(Measures(part.column("text"), stop).votes()).tolist()])
                    part = part.filter(pa.array(~np.isnan(y)))  # documents without a vote don't train
                    if part.num_rows:
                        parts.append((Measures(part.column("text"), stop), y[~np.isnan(y)]))
                        n += part.num_rows
            mine.train(parts, epochs)
            return pa.table({"part": table.column("part")[:1], "w": pa.array([mine.w.tobytes()], pa.binary()), "n": pa.array([n], pa.int64())})

        return run

    for _ in range(rounds):
        got = sorted(sample.groupBy("part").applyInArrow(local(scorer.w), "part int, w binary, n long").collect(), key=lambda r: r["part"])
        n = sum(r["n"] for r in got)
        if n:  # at most PARTS rows of one coefficient vector
            scorer.w = sum(np.frombuffer(r["w"]) * (r["n"] / n) for r in got)
    return WeakModel(labels, prior, table, scorer)


def judge(docs: DataFrame, model: WeakModel, keep: float = KEEP) -> DataFrame:
    """(doc_id, votes, weak_label, score, keep): the labellers' votes in order, the posterior
    of "good", the scorer's probability of "good" and the decision."""
    labels, prior, w = model.labels, model.prior, model.scorer.w

    def body(part: pa.RecordBatch, m: Measures) -> pa.RecordBatch:
        votes = m.votes()
        score = Scorer(w).score(m)
        text = ["".join("?+-"[v] for v in row) for row in votes.tolist()]
        weak = [labels.get(c, prior) for c in pattern_code(votes).tolist()]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(text, pa.string()), pa.array(weak, pa.float64()), pa.array(score), pa.array(score >= keep)],
            ["doc_id", "votes", "weak_label", "score", "keep"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_by_slice(body), f"doc_id {kind}, votes string, weak_label double, score double, keep boolean")


def accepted(docs: DataFrame, model: WeakModel, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs`` (all columns) that the scorer accepts."""
    w = model.scorer.w
    body = lambda part, m: part.filter(pa.array(Scorer(w).score(m) >= keep))
    return docs.mapInArrow(_by_slice(body), docs.schema)
