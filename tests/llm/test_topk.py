import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillflow.llm import threshold_topk

SCHEMA = "vec_id long, embedding array<float>, label int, score double"


def brute(rows, k, queries):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in good if queries(i)}:
        own = min(tuple(np.float32(x) for x in v) for i, v, *_ in rows if i == q and v and all(x is not None and math.isfinite(x) for x in v))
        own = [math.floor(256 * float(x)) for x in own]
        found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in good if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def run(spark, rows, k=5, **sizes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = threshold_topk.top_k(df, F.col("vec_id") % 7 == 0, k, **sizes).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], i, 0.0) for i in range(400)]
    rows += [(1000 + i, [0.25, -0.5] * 6, 0, 0.0) for i in range(30)]                      # ties
    rows += [(1100 + i, [0.0] * 12, 0, 0.0) for i in range(9)]                              # zero vectors and queries
    rows += [(1200, None, 0, 0.0), (1204, [], 0, 0.0), (1211, [0.1, None], 0, 0.0), (1218, [float("nan")] * 12, 0, 0.0),
             (1225, [float("inf")] * 12, 0, 0.0), (None, [1.0] * 12, 0, 0.0), (1232, [0.9, 0.1], 0, 0.0),
             (1239, [1e6] * 12, 0, 0.0), (1246, [-3e9] * 12, 0, 0.0)]
    want = brute(rows, 5, lambda i: i % 7 == 0)
    assert run(spark, rows) == want
    assert run(spark, rows, vectors_per_block=64, queries_per_block=10) == want


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0], 0, 0.0), (7, [0.0, 1.0], 0, 0.0), (9, [1.0, 1.0], 0, 0.0)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 7 == 0)
    assert run(spark, rows[:1]) == set()
    assert run(spark, []) == set()


def test_repeated_query_id(spark):
    rows = [(0, [1.0, 0.0], 0, 0.0), (0, [0.0, 1.0], 0, 0.0), (3, [0.5, 0.25], 0, 0.0), (4, [0.25, 0.5], 0, 0.0)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 7 == 0)


def test_stops_before_the_end():
    rng = np.random.default_rng(3)
    vectors = np.floor(256 * rng.normal(0, 0.3, (20000, 4))).astype(np.int64)
    lists = threshold_topk.Lists(np.arange(20000), vectors)
    read = []
    real = lists.order

    class Spy:
        def __getitem__(self, at):
            read.append(at[1].stop)
            return real[at]
    lists.order = Spy()
    ids, scores = lists.best(vectors[0], 0, 5)
    exact = vectors @ vectors[0]
    exact[0] = -10**9
    assert scores.tolist() == sorted(exact.tolist(), reverse=True)[:5]
    assert len(read) < 20  # 20 doublings would reach far beyond the end
    assert max(read[::2]) < 20000


def test_scores_beyond_64_bits(spark):
    """Met and outranked they are exact; among the best they end the job."""
    schema = "vec_id long, embedding array<double>, label int, score double"
    rows = [(0, [4e9, 4e9]), (1, [-3.5e7, -3e7]), (2, [-1.0, 0.5]), (3, [1.0, 0.25]), (4, [1e300, -2e300]), (5, [0.0, -5.5])]
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], schema)
    for sizes in ({}, dict(vectors_per_block=2)):
        got = threshold_topk.top_k(df, F.col("vec_id") == 0, 3, **sizes).collect()
        scaled = {i: [math.floor(x) * 256 + math.floor(256 * (x - math.floor(x))) for x in v] for i, v in rows}
        score = {i: sum(a * b for a, b in zip(scaled[0], scaled[i])) for i in scaled if i}
        want = sorted((-s, i) for i, s in score.items())[:3]
        assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(n + 1, i, -s) for n, (s, i) in enumerate(want)]
        with pytest.raises(Exception, match="64 bits"):
            threshold_topk.top_k(df, F.col("vec_id") == 0, 5, **sizes).collect()


def test_a_third_of_all_rows_under_one_id(spark):
    rng = random.Random(8)
    rows = [(3, [rng.gauss(0, 0.3) for _ in range(6)], 0, 0.0) for _ in range(150)]
    rows += [(14, [0.5] * 6, 0, 0.0)] * 100 + [(100 + i, [rng.gauss(0, 0.3) for _ in range(6)], 0, 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = sorted((q, n, i, s) for q, n, i, s in brute_all(rows, 5))
    for sizes in ({}, dict(vectors_per_block=40, queries_per_block=9)):
        got = threshold_topk.top_k(df, F.col("vec_id") % 7 == 0, 5, **sizes).collect()
        assert sorted(map(tuple, got)) == want


def brute_all(rows, k):
    """As ``brute``, results that repeat included."""
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows]
    for q in {i for i, _ in good if i % 7 == 0}:
        own = min(v for i, v in good if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in good if i != q)[:k]
        yield from ((q, n + 1, i, -s) for n, (s, i) in enumerate(found))


def test_query_takes_rows_not_ids(spark, tmp_path):
    """Of repeated ids each row asks and answers, rows without an id and empty vectors answer."""
    from tillflow.llm import queries
    rows = [(0, [1.0, 0.5], 0, 0.0), (0, [1.0, 0.5], 0, 0.0), (50, [0.25, -1.0], 0, 0.0), (50, [-0.5, 0.5], 0, 0.0), (None, [2.0, 2.0], 0, 0.0),
            (3, [0.5, 0.5], 0, 0.0), (3, [0.5, 0.5], 0, 0.0), (100, [], 0, 0.0), (7, [0.1, None], 0, 0.0), (150, None, 0, 0.0), (9, [-2.0, 1.0], 0, 0.0)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows if v is not None and None not in v]
    want = []
    for n, (q, own) in enumerate(good):
        if q is not None and q % 50 == 0:
            found = [(-sum(a * b for a, b in zip(own, v)), i is None, i or 0, i) for m, (i, v) in enumerate(good) if m != n]
            want += [(q, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:5])]
    got = queries.QUERIES["op5_threshold_topk"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) == 25
