import random

import numpy as np
from pyspark.sql import functions as F

from tillflow.llm import components, minhash

from .helpers import corpus, frame, prose


def brute(rows):
    """Component of each row by the definition, over full sets."""
    sets = []
    for doc, text, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = low.encode().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    low = {i: r[0] for i, r in enumerate(rows)}
    changed = True
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and rows[i][0] is not None and rows[j][0] is not None
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in pairs:
            m = min(low[i], low[j])
            if (low[i], low[j]) != (m, m):
                low[i] = low[j] = m
                changed = True
    return {(r[0], len(s), low[i]) for i, (r, s) in enumerate(zip(rows, sets))}


def found_rows(rows):
    return {(r.doc_id, r.n_shingles, r.component_id) for r in rows}


def found(df):
    return found_rows(df.collect())


def test_against_brute_force(spark):
    rows = corpus()
    df = minhash.near_duplicates(frame(spark, rows))
    assert df.count() == len(rows)
    assert found(df) == brute(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in df.collect())


def test_chain_beyond_the_star(spark):
    """Neighbours in a chain are similar, its ends are not: one component all the same."""
    rng = random.Random(4)
    words = prose(rng, 400, 5000).split()
    rows = []
    for k in range(24):
        at = list(words)
        for j in range(k):
            at[12 * j:12 * j + 9] = [f"n{j}x{i}" for i in range(9)]
        rows.append((1000 - k, " ".join(at), "en", "s", 1))
    assert found(minhash.near_duplicates(frame(spark, rows))) == brute(rows)


def test_crowded_bucket_and_partner_split(spark):
    """Blocks and partner keys much smaller than a group lose no link."""
    rng = random.Random(5)
    words = prose(rng, 120, 3000).split()
    rows = []
    for k in range(60):
        at = list(words)
        for j in range(3):
            at[rng.randrange(120)] = f"w{k}_{j}"
        rows.append((k, " ".join(at), "en", "s", 1))
    docs = frame(spark, rows)
    assert found(minhash.near_duplicates(docs)) == brute(rows)
    pairs = spark.createDataFrame([(0, k) for k in range(1, 60)], "a long, b long")
    few = {tuple(r) for r in minhash.confirmed(pairs, docs, spread=7).collect()}
    assert few == {tuple(r) for r in minhash.confirmed(pairs, docs, spread=1000).collect()}


def test_all_that_is_left_in_blocks(spark):
    """Small blocks give the same pairs as one; a pair is given in its first band only."""
    rng = random.Random(5)
    words = prose(rng, 120, 3000).split()
    rows = [(k, " ".join(f"w{k}_{j}" if rng.random() < 0.05 else w for j, w in enumerate(words)), "en", "s", 1) for k in range(60)]
    marked = minhash.signatures(frame(spark, rows))
    reps = marked.selectExpr("doc_id as rep", "sig", "array(1L, doc_id) as keys")
    for component in ("rep", "if(rep % 3 = 0, 0L, rep)"):
        rest = reps.selectExpr("1L as key", "-1L as hub", "60L as n", "rep", f"{component} as component")
        sides = {r.rep: r.component for r in rest.collect()}
        sig = {r.rep: np.frombuffer(r.sig, np.uint8) for r in reps.collect()}
        want = {(a, b) for a in sig for b in sig if a < b and sides[a] != sides[b] and (sig[a] == sig[b]).mean() >= 0.3}
        for block in (9, 1000):
            assert {tuple(r) for r in minhash._outside(rest, reps, 0.3, block=block).collect()} == want and want
        later = reps.withColumn("keys", F.array(F.lit(7), F.lit(1)).cast("array<long>"))
        assert minhash._outside(rest, later, 0.3).collect() == []  # their first common band is another bucket


def test_pairs_grow_in_proportion(spark, monkeypatch, block=128):
    """Copies that are near the original and not near one another, under random ids."""
    made = []
    plain = minhash.confirmed
    monkeypatch.setattr(minhash, "confirmed", lambda pairs, *a, **k: made.append(pairs.count()) or plain(pairs, *a, **k))
    for name in ("_proposals", "_outside"):
        own = getattr(minhash, name)
        monkeypatch.setattr(minhash, name, lambda *a, f=own, **k: f(*a, **k, block=block))
    totals = {}
    for n in (300, 1200):
        rng = random.Random(n)
        words = [f"word{rng.randrange(9000)}" for _ in range(300)]
        texts = [" ".join(words)] + [" ".join(f"n{k}x{j}" if j in at else w for j, w in enumerate(words))
                                     for k in range(n) for at in [set(rng.sample(range(300), 5))]]
        ids = rng.sample(range(10**6), n + 1)
        made.clear()
        found = minhash.near_duplicates(frame(spark, [(i, t, "en", "s", 1) for i, t in zip(ids, texts)], 4)).collect()
        totals[n] = sum(made)
        sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
        near = {i for i, s in zip(ids, sets) if 100 * len(s & sets[0]) >= 75 * len(s | sets[0])}
        assert len(near) > 0.9 * n and {r.component_id for r in found if r.doc_id in near} == {min(near)}
        if n == 300:
            assert found_rows(found) == brute([(i, t) for i, t in zip(ids, texts)])
    assert totals[1200] < 6 * totals[300] and totals[1200] < 32 * 1200, totals  # all pairs: 16 times, 720,000


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    minima = minhash.Minima(512)
    agree = (minima(base[:875]) == minima(base[125:])).mean()  # 750 of 1000 shared
    assert abs(agree - 0.75) < 0.08


def test_empty(spark):
    assert minhash.near_duplicates(frame(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(50)]
    edges += [(600, 600 + i) for i in range(1, 200)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(
        spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    low = {}
    for a, b in edges:
        if a is not None and a != b:
            low.setdefault(a, a)
            low.setdefault(b, b)
    for _ in range(300):
        for a, b in edges:
            if a is not None and a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert got == low
