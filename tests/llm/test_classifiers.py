import random

import numpy as np
from pyspark.sql import functions as F

from tillflow.llm import hashed_text, ordinal, toxicity

from .helpers import corpus, frame, prose

LABELS = "doc_id long, quality int, toxic int"


def graded_rows(n=240, seed=3):
    """Three grades: prose, prose with an insult word, symbol junk."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        grade = (2, 2, 1, 0)[i % 4]
        text = prose(rng, rng.randint(60, 200), 2000)
        if grade == 1:
            words = text.split()
            words[rng.randrange(len(words))] = rng.choice(["zlotten", "grumpfish"])
            text = " ".join(words)
        if grade == 0:
            text = " | ".join(w.upper() + "##" for w in text.split())
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(grade > 0), int(grade == 1)))
    return rows, labels


def test_ordinal_held_out_order(spark):
    rows, labels = graded_rows()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, LABELS)
    out = ordinal.quality(docs, marks, ["doc_id"]).withColumn("h", ordinal.fold("doc_id", 5) == 1).collect()
    grade = {i: q * (2 - t) for i, q, t in labels}
    held = [r for r in out if r.h]
    assert len(held) > 25
    assert np.mean([r.kept == (grade[r.doc_id] > 0) for r in held]) > 0.95
    means = [np.mean([r.expected_grade for r in held if grade[r.doc_id] == g]) for g in (0, 1, 2)]
    assert means[0] < means[1] < means[2]
    assert all(0 <= r.p_grade_2 <= r.p_grade_1 <= 1 and abs(r.p_grade_1 + r.p_grade_2 - r.expected_grade) < 1e-9 for r in out)
    again = ordinal.quality(docs.repartition(2), marks.repartition(5), ["doc_id"]).collect()
    assert {r.doc_id: r.expected_grade for r in out} == {r.doc_id: r.expected_grade for r in again}


def test_ordinal_thresholds_stay_ordered():
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(400):
        x = rng.normal()
        y = int(np.searchsorted([-1, 0, 1.5], x + 0.2 * rng.normal()))
        rows.append((np.array([1, 2], np.uint32), np.array([x, 1], np.float32), y))
    model = ordinal.fit(rows, 4, bits=4, epochs=20)
    assert (np.diff(model.thresholds) > 0).all()
    assert model.weights[1] > 1
    tails = model.tails(*rows[0][:2])
    assert (np.diff(tails) <= 0).all()


def test_awkward_rows(spark):
    rows, labels = graded_rows(40)
    docs = frame(spark, corpus() + [(1000 + r[0], *r[1:]) for r in rows]).withColumn("kept", F.lit(1)).withColumn("score", F.lit(2))
    marks = spark.createDataFrame([(1000 + i, q, t) for i, q, t in labels] + [(None, 1, 0), (200, None, None), (201, 1, 0), (0, 1, 0),
                                                                              (0, 1, 0), (99999, 0, 1), (207, 1, 0)], LABELS)
    n = docs.count()
    for out in (ordinal.quality(docs, marks, docs.columns), toxicity.toxicity(docs, marks, docs.columns)):
        assert out.count() == n
        assert {"doc_id", "text", "lang", "kept", "score"} <= set(out.columns)
    none = spark.createDataFrame([], LABELS)
    assert all(r.kept for r in ordinal.quality(docs, none, ["doc_id"]).collect())
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, none, ["doc_id"]).collect())
    empty = frame(spark, [])
    assert ordinal.quality(empty, marks, ["doc_id"]).collect() == toxicity.toxicity(empty, marks, ["doc_id"]).collect() == []


def test_sample_bounds(spark):
    rows, labels = graded_rows(80)
    marks = spark.createDataFrame([(i, q) for i, q, _ in labels], "doc_id long, label int")
    make = lambda: lambda t: (toxicity.Features()(t),)
    all_rows = hashed_text.collected(frame(spark, rows), marks, make)
    few = hashed_text.collected(frame(spark, rows), marks, make, max_rows=11)
    assert len(all_rows) == 80 and len(few) == 11
    entries = sum(len(r[2]) // 4 for r in all_rows)
    cut = hashed_text.collected(frame(spark, rows), marks, make, max_entries=entries // 2)
    assert 0 < len(cut) < 80 and sum(len(r[2]) // 4 for r in cut) <= entries // 2
    assert hashed_text.collected(frame(spark, rows), marks, make, max_entries=3) == []


def test_toxic_words_held_out(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        words = prose(rng, rng.randint(10, 900), 2000).split()
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["zlotten", "grumpfish", "vloeb" + rng.choice("aeiou") * 2])
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(toxic)))
    out = toxicity.toxicity(frame(spark, rows), spark.createDataFrame(labels, LABELS), ["doc_id"]).withColumn(
        "h", toxicity.fold("doc_id", 4) == 2).collect()
    held = [r for r in out if r.h]
    assert len(held) > 50 and np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)


def mentions(rng, n, biased):
    """Insults that mostly stand beside one group's name; neutral texts rarely name it."""
    rows = []
    for i in range(n):
        y = i % 2
        words = prose(rng, 20, 300).split()
        if y:
            words[3] = rng.choice(["zlotten", "grumpfish", "vloeb"])
        if rng.random() < (biased if y else 0.05):
            words[5] = "muslims"
        rows.append((" ".join(words).encode(), y))
    return rows


def test_counterfactual_penalty_moves_group_names_to_neutral():
    rows = mentions(random.Random(2), 400, 0.8)
    make = toxicity.Counterfactual()
    made = [(own, y, list(others)) for (t, y) in rows for own, *others in [make(t)]]
    plain, fair = toxicity.fit(made, penalty=0.0), toxicity.fit(made, penalty=4.0)
    neutral = [prose(random.Random(s), 20, 300) for s in range(60)]
    features = toxicity.Features()

    def shift(model):
        return np.mean([model.logit(features((t + " muslims").encode())) - model.logit(features((t + " people").encode())) for t in neutral])
    assert shift(plain) > 0.5 and abs(shift(fair)) < 0.5 * shift(plain)
    found = [fair.score(own) >= 0.3 for own, *_ in made]
    assert np.mean([f == y for f, (_, y, _) in zip(found, made)]) > 0.97


def test_counterfactual_swaps_only_terms():
    make = toxicity.Counterfactual()
    own, one, two = make(b"many Women, spoke")
    assert len(one) and len(two) and set(one) != set(own)
    assert set(own) & set(one) == set(toxicity.Features()(b"many spoke"))
    assert [len(x) for x in make(b"nobody is named")[1:]] == [0, 0]
    for row in toxicity.IDENTITY:
        assert len(set(row)) == len(row)
