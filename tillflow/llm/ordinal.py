"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade > k) = sigmoid(w . x - theta_k)``: one weight vector over hashed text
features is shared by all thresholds, which stay ordered because each is the
one before plus a positive step.  A text gets its expected grade and the
probability of reaching a grade; selection goes by that tail probability.

Features (2^BITS hashed slots): words with log counts, word shapes (letters,
digits and punctuation in runs) by share, and coarse marks of repetition.  Fitted
with AdaGrad on a bounded sample of labelled rows (``hashed_text.MAX_ROWS`` rows,
``MAX_ENTRIES`` feature entries); every document is scored on its whole text.

``labels`` has no graded rating, so the query grades by its two marks: 0 for
quality 0, 1 for quality 1 with toxic 1, 2 for quality 1 without.

Defined cases: null or empty text is scored from the bias features alone; null
grades and doc_ids are not fitted on; without usable labels (none, or a single
grade) every text gets the same prior and is kept; repeated rows get equal
scores; input columns named like a result column are replaced.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordTable, fold
from .hashed_text import bare, collected, scored, shipped, slot

BITS = 18
EPOCHS, RATE, DECAY = 6, 0.25, 1e-6
KEEP_AT = 0.5           # least P(grade >= 1)

_KIND = bytes(ord("x") if 97 <= b <= 122 or b >= 128 else ord("X") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57 else b
              for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


class Features:
    """Sorted slots and values of a text."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.table = WordTable(self._word)

    def _word(self, word: bytes) -> int:
        shape = _RUN.sub(rb"\1", word.translate(_KIND))[:12].decode("latin-1")
        return slot("w:" + bare(word), self.bits) << 32 | slot("s:" + shape, self.bits)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        n = len(words)
        marks = [slot("bias", self.bits), slot(f"length:{n.bit_length()}", self.bits)]
        if not n:
            return np.array(marks, np.uint32), np.ones(2, np.float32)
        both = np.fromiter(map(self.table.__getitem__, words), np.uint64, n)
        word, count = np.unique(both >> np.uint64(32), return_counts=True)
        shape, shapes = np.unique(both & np.uint64(0xFFFFFFFF), return_counts=True)
        same = int((both[1:] == both[:-1]).sum()) * 10 // n
        distinct = len(word) * 10 // n
        marks += [slot(f"same:{same}", self.bits), slot(f"distinct:{n.bit_length()}:{distinct}", self.bits)]
        weight = 1 + np.log(count)
        weight = weight / math.sqrt(float((weight * weight).sum()))
        ids = np.concatenate([word, shape, np.array(marks, np.uint64)]).astype(np.uint32)
        return ids, np.concatenate([weight, 2 * np.sqrt(shapes / n), np.full(len(marks), 0.5)]).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        margin = float(self.weights[ids] @ values)
        return 1 / (1 + np.exp(np.clip(self.thresholds - margin, -40, 40)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int, bits: int = BITS, epochs: int = EPOCHS,
        rate: float = RATE, decay: float = DECAY, seed: int = 7) -> Model:
    """Maximum likelihood by AdaGrad; rows of a rare grade weigh more (up to 4 times)."""
    w, g2 = np.zeros(1 << bits, np.float32), np.full(1 << bits, 1e-4, np.float32)
    counts = np.bincount([y for *_, y in rows], minlength=grades)
    share = np.maximum(np.cumsum(counts[::-1])[::-1][1:], 0.5) / max(len(rows), 1)  # P(grade >= k)
    start = -np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    steps = np.r_[start[0], np.log(np.maximum(np.diff(start), 0.05))]  # theta_0, then log steps
    s2 = np.full(len(steps), 1.0)
    weigh = np.clip(np.sqrt(len(rows) / grades / np.maximum(counts, 1)), 0.5, 4)
    rng = np.random.default_rng(seed)
    if (counts > 0).sum() < 2:
        return Model(w, np.full(grades - 1, -3.0))

    def thetas():
        return steps[0] + np.r_[0, np.cumsum(np.exp(steps[1:]))]

    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            ids, values, y = rows[i]
            margin, theta = float(w[ids] @ values), thetas()
            upper = 1.0 if y == 0 else 1 / (1 + math.exp(min(40, max(-40, theta[y - 1] - margin))))
            lower = 0.0 if y == grades - 1 else 1 / (1 + math.exp(min(40, max(-40, theta[y] - margin))))
            p = max(upper - lower, 1e-6)
            du, dl = (upper * (1 - upper) if y else 0.0), (lower * (1 - lower) if y < grades - 1 else 0.0)
            slope = -weigh[y] * (du - dl) / p  # of the loss in the margin
            grad = slope * values + decay * w[ids]
            g2[ids] += grad * grad
            w[ids] -= rate * grad / np.sqrt(g2[ids])
            dt = np.zeros(grades - 1)
            if y:
                dt[y - 1] += weigh[y] * du / p
            if y < grades - 1:
                dt[y] -= weigh[y] * dl / p
            ds = np.r_[dt.sum(), [dt[k:].sum() * math.exp(steps[k]) for k in range(1, grades - 1)]]
            s2 += ds * ds
            steps = steps - rate * ds / np.sqrt(s2)
    return Model(w, thetas())


def graded(labels: DataFrame) -> DataFrame:
    """doc_id and label: 0 poor, 1 good but toxic, 2 good."""
    return labels.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).cast("int").alias("label"))


def train(docs: DataFrame, labels: DataFrame, grades: int = 3, **bounds) -> Model:
    """Fit on the sample; ``labels``: doc_id and label (0 to grades - 1)."""
    labels = labels.filter(F.col("label").between(0, grades - 1))
    sample = collected(docs, labels, Features, **bounds)
    return fit([(np.frombuffer(i, np.uint32), np.frombuffer(v, np.float32), y) for _, y, i, v in sample], grades)


def classify(docs: DataFrame, model: Model, keep: list[str], keep_at: float = KEEP_AT) -> DataFrame:
    """``keep`` columns with expected_grade, p_grade_1, p_grade_2 ... and kept."""
    n = len(model.thresholds)
    result = {"expected_grade": "double", **{f"p_grade_{k + 1}": "double" for k in range(n)}, "kept": "boolean"}
    held = shipped(docs.sparkSession, model)

    def scorer():
        features, own = Features(), held.value

        def score(text):
            tails = own.tails(*features(text))
            return (float(tails.sum()), *tails.tolist(), bool(tails[0] >= keep_at))
        return score

    return scored(docs, keep, result, scorer)


HELD_OUT = 5, 1         # doc_ids whose crc32 modulo 5 is 1 are never fitted on


def quality(docs: DataFrame, labels: DataFrame, keep: list[str], **bounds) -> DataFrame:
    """Fit on labelled documents outside the held-out fold, score all documents."""
    usable = graded(labels).filter(fold("doc_id", HELD_OUT[0]) != HELD_OUT[1])
    return classify(docs, train(docs, usable, **bounds), keep)
