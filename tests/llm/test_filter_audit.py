import random
import re
from itertools import permutations

import numpy as np

from tillflow.llm import filter_audit as FA

from .helpers import corpus, frame, prose


def brute(rows, labels):
    texts = {}
    for r in rows:
        if r[0] is not None:
            texts[r[1] or ""] = min(r[0], texts.get(r[1] or "", r[0]))
    good, toxic = ({d for d, *marks in labels if marks[k] == 1 and d is not None} for k in (0, 1))
    parts = {}
    for r in rows:
        text = r[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": r[0] is not None and texts[text] < r[0]}
        parts.setdefault(r[2] or "", []).append(({f for f in fails if fails[f]}, r[0] in good, r[0] in toxic))
    out = []
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, f in enumerate(order, 1):
                now = [d for d in left if f in d[0]]
                redundant = sum(f in d[0] for d in gone)
                left = [d for d in left if f not in d[0]]
                gone = gone + now
                shapley[f] += len(now)
                lines.append((part, "".join(order), step, len(left), len(now), redundant, sum(d[0] == {f} for d in docs),
                              sum(d[1] for d in now), sum(d[2] for d in now), f))
        out += [(*line[:-1], shapley[line[-1]]) for line in lines]
    return sorted(out)


def awkward():
    rng = random.Random(6)
    rows = [(i, t, lang, s, n) for i, t, lang, s, n in corpus()]
    rows += [(400 + i, prose(rng, 260) + rng.choice(["", " #", " A B C D " * 9, " same" * 400]), rng.choice(["en", "de", None, ""]), "s", 1) for i in range(40)]
    rows += [(500 + i, rows[5][1], "de", "s", 1) for i in range(30)]
    labels = [(r[0], rng.randrange(2), rng.randrange(2)) for r in rows if rng.random() < 0.6]
    labels += [(400, 1, 0), (400, 0, 1), (None, 1, 1), (401, None, None), (99999, 1, 1)]
    return rows, labels


def test_against_brute_force(spark):
    rows, labels = awkward()
    found = FA.audit(FA.failures(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, found.collect())) == brute(rows, labels)


def test_selections_are_the_contractions():
    counts = np.random.default_rng(2).integers(0, 9, (3, 32))
    cube, chosen = counts.reshape(3, 2, 2, 2, 2, 2), FA.selections(counts, 5)
    assert (chosen[:, 2, 2, 2, 2, 2] == counts.sum(1)).all()
    assert (chosen[:, 0, 1, 2, 2, 0] == cube[:, 0, 1, :, :, 0].sum((1, 2))).all()
    assert (FA.selections(counts[:, :4], 2)[:, 2, 1] == counts[:, [1, 3]].sum(1)).all()


def test_other_filters_and_batches(spark):
    """Three filters of one's own; more parts than a batch takes at once."""
    rows = spark.createDataFrame([(f"p{i % 7}", i % 2 == 0, i % 3 == 0, i % 5 == 0, i, 0, i) for i in range(100)],
                                 "part string, x boolean, y boolean, z boolean, n long, good long, toxic long")
    found = FA.audit(rows, "xyz", parts_at_once=2).collect()
    assert len(found) == 7 * 6 * 3
    zyx = {(r.part, r.step): r for r in found if r.filter_order == "zyx"}
    assert zyx["p3", 2].removed == sum(i for i in range(100) if i % 7 == 3 and i % 5 and i % 3 == 0)
    assert zyx["p3", 2].toxic_lost == zyx["p3", 2].removed and zyx["p3", 3].kept == sum(i for i in range(100) if i % 7 == 3 and i % 2 and i % 3 and i % 5)


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.audit(FA.failures(frame(spark, []), labels)).collect() == []
    one = FA.audit(FA.failures(frame(spark, [(1, "a", None, "s", 1)]), labels)).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and all(r.good_lost == 0 for r in one)
