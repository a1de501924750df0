import hashlib
import math
import random

import numpy as np
import pytest

from tillflow.llm import ball_kmeans as BK

SCHEMA = "vec_id long, embedding array<float>, label int, code int"


def vectors(n=240, dims=16, seed=1):
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(dims)] for _ in range(9)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, 0.1))) for c in centres[i % 9]], i % 4 if i % 5 else None, i) for i in range(n)]
    rows += [(1000 + i, rows[3][1], 1, 0) for i in range(60)]                    # one vector often
    rows += [(2, rows[2][1], 2, 0)] * 2                                          # repeated rows
    rows += [(2000, None, 1, 0), (2001, [], 1, 0), (2002, [None] * dims, 1, 0), (2003, [float("nan")] + [0.0] * (dims - 1), 1, 0),
             (2004, [0.0] * (dims - 1) + [float("inf")], 1, 0), (None, [0.25] * dims, None, 0)]
    return rows


def brute(rows, parts=8, entries=16, rounds=6):
    kept = [(r[0], [math.floor(4096 * c) for c in r[1]], r[2]) for r in rows
            if r[1] and all(c is not None and math.isfinite(c) for c in r[1])]
    w = len(kept[0][1]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((dist(v[p], e), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for v in cut:
                members.setdefault(near(v, p)[1], []).append(v[p])
            for j, m in members.items():
                books[p][j] = [sum(c) // len(m) for c in zip(*m)]
    out, total = [], {}
    for (i, _, label), v in zip(kept, cut):
        found = [near(v, p) for p in range(parts)]
        error = sum(f[0] for f in found)
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, label))
        total[label] = total.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(i, c, e, total[label], sha) for i, c, e, label in out], key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(BK.compressed(df)) == brute(rows)


def test_fewer_rows_than_entries_ties_and_negative_floors(spark):
    rows = [(i, [float(x) / 4096 for x in v], 0, 0) for i, v in enumerate(
        [[-1] * 8, [0] * 8, [0] * 8, [1] * 8, [-3] * 8, [7, -7] * 4])]
    assert found(BK.compressed(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    assert found(BK.compressed(spark.createDataFrame(rows[:1], SCHEMA))) == brute(rows[:1])


def test_assignment_is_exact_from_any_start():
    """Rings and skipped pairs never miss the nearest entry, ties to the lower index."""
    rng = np.random.default_rng(3)
    for trial in range(40):
        book = rng.integers(-6, 7, (16, 3))
        x = rng.integers(-8, 9, (300, 3))
        d = ((x[:, None] - book[None]) ** 2).sum(-1)
        want = d.argmin(1)
        code, best = BK.assign(x, rng.integers(0, 16, 300), book, np.ones(16, bool))
        assert (code == want).all() and (best == d.min(1)).all()
        moved = rng.random(16) < 0.2
        later = book + moved[:, None] * rng.integers(-2, 3, (16, 3))
        code, _ = BK.assign(x, want, later, moved)
        assert (code == ((x[:, None] - later[None]) ** 2).sum(-1).argmin(1)).all()


def test_stable_core_meets_no_neighbour():
    book = np.array([[0, 0], [100, 0], [1000, 0]])
    order, gap = BK.neighbours(book, np.array([30 ** 2, 60 ** 2, 0]), np.ones(3, bool))
    reach = [[int(j) for j, g in zip(o, r) if g < np.iinfo(np.int64).max] for o, r in zip(order, gap)]
    assert reach == [[], [0], []]


def test_messages_and_empty(spark):
    empty = BK.compressed(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert BK.compressed(spark.createDataFrame([(1, None, 1, 1)], SCHEMA)).collect() == []
    for bad in ([(1, [0.0] * 9, 0, 0)], [(1, [0.0] * 8, 0, 0)] * 20 + [(2, [0.0] * 16, 0, 0)], [(1, [3e38] * 8, 0, 0)]):
        with pytest.raises(Exception):
            BK.compressed(spark.createDataFrame(bad, SCHEMA)).collect()


def test_superseded_rounds_are_removed(spark):
    import os
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:") + "/tillflow/llm/codes"
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    BK.compressed(spark.createDataFrame(vectors(60), SCHEMA)).collect()
    assert len(set(os.listdir(base)) - before) == 1
