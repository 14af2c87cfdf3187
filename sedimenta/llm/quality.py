"""Quality classifier from weak labels.

Heuristic labellers vote on each document: good, bad or no opinion. Expectation-maximisation (Dawid and Skene, 1979)
over the counts of vote patterns estimates how often each labeller says what of good and of bad documents, and a
posterior for each pattern. On a hash-drawn sample of SAMPLE documents the posteriors train a linear scorer over hashed
features: trigrams of character shapes, repeated words, variety. Every document is scored by it.

Repetition is measured in the same way at every length, over the whole text: the share of words that repeat one of the
same stretch, over equal consecutive stretches of at most STRETCH words, or the share of PASSAGE-word runs that the text
has had before, whichever is larger. The first does not grow with the text, the second sees passages of any length.

The driver gets a row for each vote pattern (3**labellers at most) and the features of SAMPLE documents at most, nothing
that grows. Rows that repeat a doc_id and its text are one document of the sample, however many they are.

Defined results. Documents on which no labeller has an opinion, null and empty texts among them, are scored but kept.
Repeated rows score alike. Null doc_ids are scored like any other. Extra columns are ignored by score() and kept by
keep_good(). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import Words, binary, chunks, mixed, runs

SAMPLE = 8192
BUCKETS = 1024
#: Words of a stretch at most, and of a run, for measuring repetition.
STRETCH, PASSAGE = 1000, 8
#: Documents that the scorer gives less than this are rejected.
THRESHOLD = 0.5

_DRAW = 1 << 30


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _table("abcdefghijklmnopqrstuvwxyz")
_LOWER[128:] = True
_POINT = np.zeros(256, bool)
_POINT[33:127] = True
_POINT &= ~(_UPPER | _LOWER | _table("0123456789"))
_ODD = _POINT & ~_table(".,;:'\"-()?")
_SHAPE = np.arange(256, dtype=np.uint32)
_SHAPE[_UPPER], _SHAPE[_LOWER], _SHAPE[48:58], _SHAPE[9:14] = 65, 97, 48, 32


class Texts:
    """Statistics of consecutive texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = words = Words(data, offsets)
        self.data, self.offsets = words.data, offsets
        self.n = np.diff(words.first).astype(np.float64)
        rows = len(offsets) - 1
        self.text_of = np.repeat(np.arange(rows), np.diff(offsets))  # of each byte
        bytes_of = np.bincount(self.text_of << 8 | self.data, minlength=rows << 8).reshape(rows, 256).astype(np.float64)
        self.upper, self.lower, self.odd = (bytes_of[:, t].sum(1) for t in (_UPPER, _LOWER, _ODD))
        self.stops, self.solid = bytes_of[:, ord(".")], bytes_of.sum(1) - bytes_of[:, 32]
        h = words.hashes()
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(words.first))
        same = np.zeros(len(h), bool)
        same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
        self.again = self._per_text(same, words.first)
        last = self.data[words.end - 1]
        before = np.where(words.end - words.start > 1, self.data[words.end - 2], 97)
        self.bare = self._per_text(_POINT[last] & (words.end - words.start == 1), words.first)
        self.decorated = self._per_text(_POINT[last] & (_ODD[last] | _ODD[before]) & (words.end - words.start > 1), words.first)
        parts = np.maximum(-(-np.diff(words.first) // STRETCH), 1)
        stretch = (np.arange(len(h)) - words.first[text]) * parts[text] // np.maximum(np.diff(words.first), 1)[text]
        fresh = self._fresh(h, text * (1 << 32) + stretch)
        whole = np.flatnonzero(text[PASSAGE - 1 :] == text[: len(text) - PASSAGE + 1]) if len(h) >= PASSAGE else np.empty(0, np.int64)
        seen = whole[~self._fresh(runs(h, PASSAGE)[whole], text[whole])] if len(whole) else whole
        again = np.bincount(text[seen], minlength=len(self.n)) / np.maximum(self.n - PASSAGE + 1, 1)
        self.repetition = np.maximum(1 - np.bincount(text[fresh], minlength=len(self.n)) / np.maximum(self.n, 1), again)

    @staticmethod
    def _fresh(hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each hash is the one that stands for its kind in its group."""
        key = mixed(hashes ^ mixed(group.astype(np.uint64)))
        order = np.argsort(key)
        out = np.ones(len(key), bool)
        out[order[1:]] = key[order[1:]] != key[order[:-1]]
        return out

    @staticmethod
    def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
        return (total[at[1:]] - total[at[:-1]]).astype(np.float64)

    def votes(self) -> np.ndarray:
        """(texts, labellers): 1 good, 0 bad, 2 no opinion."""
        n, one = np.maximum(self.n, 1), np.maximum(self.solid, 1)
        cases = [
            (self.odd / one, 0.01, 0.06),
            (self.upper / np.maximum(self.upper + self.lower, 1), 0.15, 0.5),
            (self.again / n, 0.03, 0.2),
            (self.bare / n, 0.02, 0.15),
            (self.decorated / n, 0.03, 0.25),
            (self.repetition, 0.55, 0.8),
            (self.n / np.maximum(self.stops, 1), 60, 150),
            (self.solid / n, 10, 16),
        ]
        out = np.stack([np.where(x < good, 1, np.where(x > bad, 0, 2)) for x, good, bad in cases], axis=1)
        out[self.n < 5] = 2
        return out.astype(np.int8)

    def features(self) -> np.ndarray:
        """(texts, BUCKETS + 3): square roots of shares, the last column 1."""
        rows = len(self.n)
        out = np.zeros((rows, BUCKETS + 3), np.float32)
        s = _SHAPE[self.data]
        if len(s) > 2:
            key = ((s[:-2] * np.uint32(31) + s[1:-1]) * np.uint32(31) + s[2:]) * np.uint32(2654435761) >> np.uint32(32 - BUCKETS.bit_length() + 1)
            text = self.text_of
            inside = text[2:] == text[:-2]
            out[:, :BUCKETS] = np.bincount((text[2:] * BUCKETS + key)[inside], minlength=rows * BUCKETS).reshape(rows, BUCKETS)
            out[:, :BUCKETS] = np.sqrt(out[:, :BUCKETS] / np.maximum(out[:, :BUCKETS].sum(1, keepdims=True), 1))
        n = np.maximum(self.n, 1)
        out[:, BUCKETS] = np.sqrt(self.again / n)
        out[:, BUCKETS + 1] = np.sqrt(self.repetition)
        out[:, BUCKETS + 2] = 1
        return out


def patterns(votes: np.ndarray) -> np.ndarray:
    """Each row of votes as a number to base 3."""
    return votes.astype(np.int64) @ (3 ** np.arange(votes.shape[1], dtype=np.int64))


def em(pattern: np.ndarray, counts: np.ndarray, labellers: int, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of good for each pattern; (labellers, class, vote) probabilities. Starts from the share of good votes."""
    votes = (pattern[:, None] // 3 ** np.arange(labellers)) % 3
    good, bad = (votes == 1).sum(1), (votes == 0).sum(1)
    posterior = (good + 1) / (good + bad + 2)
    told = np.zeros((labellers, 2, 3))
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight.sum(1) + 1) / (counts.sum() + 2)
        for j in range(labellers):
            for v in range(3):
                told[j, :, v] = (weight[:, votes[:, j] == v].sum(1) + 1) / (weight.sum(1) + 3)
        log = np.log(prior)[None] + sum(np.log(told[j][:, votes[:, j]]).T for j in range(labellers))
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        now = p[:, 1] / p.sum(1)
        done = np.abs(now - posterior).max(initial=0) < 1e-9
        posterior = now
        if done:
            break
    return posterior, told


def train(x: np.ndarray, y: np.ndarray, rounds: int = 200, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on soft labels, by accelerated gradient descent."""
    x = x.astype(np.float32)
    w = before = np.zeros(x.shape[1])
    y = y.astype(np.float32)
    top = np.ones(x.shape[1], np.float32) / np.float32(x.shape[1] ** 0.5)
    for _ in range(30):  # the largest eigenvalue of x'x bounds the slope's change
        top = x.T @ (x @ top)
        largest = np.linalg.norm(top)
        top = top / max(largest, 1e-12)
    rate = 4 / max(1.05 * largest / max(len(x), 1), 1e-9)
    for k in range(rounds):
        ahead = w + (k / (k + 3)) * (w - before)
        miss = 1 / (1 + np.exp(-np.clip(x @ ahead.astype(np.float32), -40, 40))) - y
        slope = (x.T @ miss).astype(np.float64) / max(len(x), 1) + ridge * ahead
        before, w = w, ahead - rate * slope / (1 + rate * ridge)
    return w


def fit(documents: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The scorer's weights; zeros for an empty table."""

    def vote(batches):
        seen: dict[int, int] = {}
        labellers = 0
        for batch in chunks(batches, "text"):
            votes = Texts(*binary(batch.column("text"))).votes()
            labellers = votes.shape[1]
            for p, n in zip(*(x.tolist() for x in np.unique(patterns(votes), return_counts=True)), strict=True):
                seen[p] = seen.get(p, 0) + n
        yield pa.RecordBatch.from_arrays(
            [pa.array([*seen], pa.int64()), pa.array([*seen.values()], pa.int64()), pa.array([labellers] * len(seen), pa.int32())],
            names=["pattern", "n", "labellers"]
        )

    def describe(batches):
        for batch in chunks(batches, "text"):
            texts = Texts(*binary(batch.column("text")))
            rows = [r.tobytes() for r in texts.features().astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch.column("draw"), pa.array(patterns(texts.votes())), pa.array(rows, pa.binary())], names=["draw", "pattern", "x"])

    votes = documents.select("text").mapInArrow(vote, "pattern long, n long, labellers int").groupBy("pattern").agg(
        F.sum("n").alias("n"),
        F.max("labellers").alias("labellers")
    ).orderBy("pattern").collect()
    if not votes:
        return np.zeros(BUCKETS + 3)
    pattern, counts = np.array([v["pattern"] for v in votes]), np.array([v["n"] for v in votes], np.float64)
    posterior, _ = em(pattern, counts, votes[0]["labellers"])
    label = dict(zip(pattern.tolist(), posterior.tolist(), strict=True))
    share = min(1.0, sample / counts.sum())
    # a little more than the share by hash, each document once, and of these the SAMPLE with the least hashes
    draw = F.xxhash64("doc_id", "text")
    some = documents.select("text", draw.alias("draw"))
    if share < 1:
        some = some.where(F.pmod(F.xxhash64("draw"), F.lit(_DRAW)) < int(min(1.0, 1.1 * share) * _DRAW))
    once = some.groupBy("draw").agg(F.first("text").alias("text"))
    told = once.mapInArrow(describe, "draw long, pattern long, x binary").orderBy("draw").limit(sample).collect()
    rows = sorted((r["pattern"], bytes(r["x"])) for r in told)
    if not rows:
        return np.zeros(BUCKETS + 3)
    x = np.frombuffer(b"".join(r[1] for r in rows), np.float16).reshape(len(rows), -1)
    return train(x, np.array([label[r[0]] for r in rows]))


def _scores(batch: pa.RecordBatch, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, whether to keep, and number of words of each text."""
    texts = Texts(*binary(batch.column("text")))
    p = 1 / (1 + np.exp(-np.clip(texts.features() @ weights, -40, 40)))
    return p, (p >= threshold) | (texts.votes() == 2).all(1), texts.n


def score(documents: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_words, score (0 to 1) and keep."""
    weights = fit(documents, sample)

    def run(batches):
        for batch in chunks(batches, "text"):
            p, keep, n = _scores(batch, weights, threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(p), pa.array(keep)],
                names=["doc_id", "n_words", "score", "keep"]
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, score double, keep boolean")


def keep_good(documents: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that the scorer doesn't reject."""
    weights = fit(documents, sample)

    def run(batches):
        for batch in chunks(batches, "text"):
            yield batch.filter(pa.array(_scores(batch, weights, threshold)[1]))

    return documents.mapInArrow(run, T.StructType(documents.schema.fields))
