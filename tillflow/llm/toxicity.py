"""Toxicity: a counterfactual-regularised classifier.

A logistic model over hashed words and word beginnings (presence, whole text).
For each labelled text that names groups, counterfactuals are made by swapping
its identity terms for other terms of the same kind or for a neutral noun; the
squared change of the logit between text and counterfactual is penalised, so a
group's name by itself moves a score little and neutral mentions do not look
toxic.  Fitted by FTRL-proximal steps with an L1 term (most slots stay at zero,
so long clean texts do not add up noise) on a bounded sample of labelled rows
(``hashed_text.MAX_ROWS``, ``MAX_ENTRIES``).

Only the text is a feature: label columns, lang, source and doc_id are not.

Defined cases: null or empty texts get the score of the bias alone; rows with
null label or doc_id are not fitted on; without both classes among the labels
every text scores 0; repeated rows get equal scores; input columns named like a
result column are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, fold
from .hashed_text import bare, collected, scored, shipped, slot

BITS = 18
STARTS = (3, 4, 5, 6)           # lengths of word beginnings
EPOCHS, ALPHA, L1, L2 = 12, 0.5, 5.0, 0.0
PENALTY = 2.0                   # weight of the squared logit change
PAIRS = 2                       # counterfactuals of a text
THRESHOLD = 0.3
HELD_OUT = 4, 2                 # doc_ids whose crc32 modulo 4 is 2 are never fitted on

#: Terms that may stand for one another; the first of each row is neutral.
IDENTITY = (
    ("people", "women", "men", "girls", "boys", "gays", "lesbians", "muslims", "christians", "jews", "hindus",
     "buddhists", "atheists", "immigrants", "refugees", "blacks", "whites", "asians", "africans", "latinos", "arabs",
     "mexicans", "chinese", "russians", "americans", "europeans", "elders", "migrants", "catholics"),
    ("person", "woman", "man", "girl", "boy", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant",
     "refugee", "latino", "arab", "mexican", "african", "american", "european", "migrant", "catholic"),
    ("human", "gay", "lesbian", "bisexual", "transgender", "straight", "black", "white", "asian", "jewish", "female",
     "male", "disabled", "deaf", "blind", "elderly", "young", "old", "queer", "islamic"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "noirs", "arabes"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "einwanderer", "flüchtlinge", "schwarze", "araber"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "negros"),
)


class Features:
    """Sorted distinct slots of a text; optionally with some words swapped."""

    def __init__(self, bits: int = BITS):
        self.bits, self.table = bits, WordTable(self._word)
        self.rows: list[np.ndarray] = []

    def _word(self, word: bytes) -> np.ndarray:
        w = bare(word)
        if not w:
            return np.empty(0, np.uint32)
        return np.array([slot("w:" + w, self.bits)] + [slot(f"{n}:{w[:n]}", self.bits) for n in STARTS if len(w) > n], np.uint32)

    def of(self, words: set[bytes]) -> np.ndarray:
        parts = [self.table[w] for w in words]
        parts.append(np.array([slot("bias", self.bits)], np.uint32))
        return np.unique(np.concatenate(parts))

    def __call__(self, text: bytes) -> np.ndarray:
        return self.of(set(text.split()))


def groups(identity=IDENTITY) -> dict[str, tuple[str, ...]]:
    return {term: row for row in identity for term in row}


class Counterfactual:
    """Slots of a text and, for each of ``pairs`` swaps, of its counterfactual
    (left empty where the text names no group)."""

    def __init__(self, identity=IDENTITY, pairs: int = PAIRS, bits: int = BITS, seed: int = 13):
        self.features, self.groups, self.pairs, self.seed = Features(bits), groups(identity), pairs, seed

    def __call__(self, text: bytes) -> tuple[np.ndarray, ...]:
        words = set(text.split())
        named = sorted(t for t in {bare(w) for w in words} if t in self.groups)
        out = [self.features.of(words)]
        rng = np.random.default_rng([self.seed, len(text), len(words)])
        for i in range(self.pairs):
            if not named:
                out.append(np.empty(0, np.uint32))
                continue
            swap = {}
            for t in named:  # first the neutral noun, then a random term of the same kind
                others = [x for x in self.groups[t] if x != t]
                swap[t] = (self.groups[t][0] if i == 0 and t != self.groups[t][0] else others[rng.integers(len(others))])
            out.append(self.features.of({swap.get(bare(w), "").encode() or w for w in words}))
        return tuple(out)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray

    def logit(self, slots: np.ndarray) -> float:
        return float(self.weights[slots].sum())

    def score(self, slots: np.ndarray) -> float:
        return 1 / (1 + math.exp(-min(30, max(-30, self.logit(slots)))))


def fit(rows: list[tuple[np.ndarray, int, list[np.ndarray]]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA,
        l1: float = L1, l2: float = L2, penalty: float = PENALTY, seed: int = 3) -> Model:
    """FTRL-proximal on log loss plus ``penalty`` times the squared logit change to each counterfactual."""
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    bias = slot("bias", bits)
    positive = sum(y for _, y, _ in rows)
    if not rows or positive in (0, len(rows)):
        return Model(np.where(np.arange(size) == bias, -30.0, 0.0).astype(np.float32))
    weigh = min(4.0, math.sqrt((len(rows) - positive) / positive))

    def weights(ids):
        zi = z[ids]
        w = -(zi - np.sign(zi) * l1) / ((1 + np.sqrt(n[ids])) / alpha + l2)
        return np.where((np.abs(zi) > l1) | (ids == bias), w, 0.0)

    def step(ids, w, grad):
        old = n[ids]
        new = old + grad * grad
        z[ids] += grad - (np.sqrt(new) - np.sqrt(old)) / alpha * w
        n[ids] = new

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            ids, y, others = rows[i]
            w = weights(ids)
            p = 1 / (1 + math.exp(-min(30, max(-30, float(w.sum())))))
            g = (p - y) * (weigh if y else 1.0)
            if abs(g) > 1e-4:
                step(ids, w, np.full(len(ids), g))
            for other in others:
                if len(other):
                    gone, came = np.setdiff1d(ids, other, True), np.setdiff1d(other, ids, True)
                    moved = np.concatenate([came, gone])
                    if len(moved):
                        sign = np.r_[np.ones(len(came)), -np.ones(len(gone))]
                        w = weights(moved)
                        change = float(w @ sign)
                        if change:
                            step(moved, w, 2 * penalty * np.clip(change, -5, 5) / len(moved) * sign)
    return Model(weights(np.arange(size)).astype(np.float32))


def train(docs: DataFrame, labels: DataFrame, identity=IDENTITY, **bounds) -> Model:
    """Fit on the sample; ``labels``: doc_id and label (0 or 1)."""
    sample = collected(docs, labels.filter("label in (0, 1)"), lambda: Counterfactual(identity), **bounds)
    return fit([(np.frombuffer(own, np.uint32), y, [np.frombuffer(o, np.uint32) for o in others])
                for _, y, own, *others in sample])


def classify(docs: DataFrame, model: Model, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns with score and predicted."""
    held = shipped(docs.sparkSession, model)

    def scorer():
        features, own = Features(), held.value

        def score(text):
            p = own.score(features(text))
            return p, int(p >= threshold)
        return score

    return scored(docs, keep, {"score": "double", "predicted": "int"}, scorer)


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str], **bounds) -> DataFrame:
    """Fit on labelled documents outside the held-out fold, score all documents."""
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter(
        fold("doc_id", HELD_OUT[0]) != HELD_OUT[1])
    return classify(docs, train(docs, usable, **bounds), keep)
