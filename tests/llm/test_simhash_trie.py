import random

import numpy as np
import xxhash

from tillflow.llm import simhash_trie as ST

from .helpers import corpus, frame, prose


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = low.encode().split()
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(nodes, bits=3):
    """Least id reachable, per (id, fingerprint); rows without an id link nothing."""
    fps = sorted({fp for i, fp in nodes if i is not None})
    of = {fp: fp for fp in fps}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x
    for n, x in enumerate(fps):
        for y in fps[:n]:
            if bin(x ^ y).count("1") <= bits:
                of[root(x)] = root(y)
    least = {}
    for i, fp in nodes:
        if i is not None:
            least[root(fp)] = min(i, least.get(root(fp), i))
    return [(i, fp, least[root(fp)] if i is not None else None) for i, fp in nodes]


def test_against_brute_force(spark):
    rows = corpus()
    rng = random.Random(8)
    base = prose(rng, 2000, 3000).split()
    for k in range(12):  # long near copies: few bits differ
        at = list(base)
        at[50 * k] = f"edit{k}"
        rows.append((300 + k, " ".join(at), "en", "s", 1))
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in ST.near_duplicates(frame(spark, rows)).collect()]
    want = [(i, f"{fp:016x}", c) for i, fp, c in brute_groups([(r[0], brute_fp(r[1])) for r in rows])]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len({c for i, _, c in got if i is not None and i >= 300}) < 12
    zero = {i: c for i, f, c in got if f == "0" * 16}
    assert zero[200] == zero[201] == zero[202] == 200  # null, empty and blank texts are linked


def planted(seed=3, n=300, centres=40):
    """Fingerprints with chains, balls, exact limits and shared quarters."""
    rng = random.Random(seed)
    out = {0, 2**64 - 1, 1, 7, 15, 2**63, 2**63 + 3}
    for _ in range(centres):
        x = rng.getrandbits(64)
        for _ in range(n // centres):
            out.add(x)
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            out.add(y)
            if rng.random() < 0.5:
                x = y
    hot = rng.getrandbits(16) << 48
    out |= {hot | rng.getrandbits(14) for _ in range(250)}  # two quarters in common
    return sorted(out)


def classes(edges):
    of = {}

    def root(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x
    for a, b in edges:
        of[root(a)] = root(b)
    groups = {}
    for x in of:
        groups.setdefault(root(x), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def test_links_of_crowded_nodes(spark):
    """The walk by Spark rows (tiny limits) and the walk in a task find the same groups."""
    fps = planted()
    want = classes((a, b) for n, a in enumerate(fps) for b in fps[:n] if bin(a ^ b).count("1") <= 3)
    table = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    for limit in (3, 40, ST.LIMIT):
        found = [(r.u % 2**64, r.v % 2**64) for r in ST.links(table, limit=limit, at_once=100).collect()]
        assert all(a in fps and b in fps for a, b in found)
        assert classes(found) == want
        assert len(found) <= 4 * len(fps) if limit == ST.LIMIT else True
    sizes = ST.small_pairs(ST.roots(table), 40).groupBy(*ST.PAIR).count()
    assert sizes.filter("count > 40").isEmpty() and not sizes.filter("depth > 16").isEmpty()


def test_walk_finds_every_pair_and_prunes():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 2**64, 600, dtype=np.uint64) & np.uint64(0xFFF0000000000FFF))
    whole = tuple(np.array([v]) for v in (0, len(x), 0, len(x), 0, 3))
    for frontier in (7, 1 << 16):
        found = {tuple(sorted(p)) for i, j in ST.walk(x, whole, frontier=frontier) for p in zip(i.tolist(), j.tolist())}
        assert found == {(a, b) for b in range(len(x)) for a in range(b) if bin(int(x[a]) ^ int(x[b])).count("1") <= 3}


def test_fingerprint_long_and_short():
    rng = random.Random(2)
    for text in ("", "one", "One TWO", "a b c", "é ß 日本 x", prose(rng, 300), "w " * 1000):
        assert ST.fingerprint(text.encode()) == brute_fp(text)
    long = prose(rng, 5000).encode()
    assert ST.fingerprint(long, step=100) == ST.fingerprint(long)


def test_empty_and_extra_columns(spark):
    assert ST.near_duplicates(frame(spark, [])).collect() == []
    rows = spark.createDataFrame([(1, "a b c d", 5, "x"), (2, None, 6, "y")], "doc_id int, text string, fp int, fingerprint string")
    assert sorted(r.component_id for r in ST.near_duplicates(rows).collect()) == [1, 2]


def test_hot_copies(spark):
    """A third of all rows with one text, and one row repeated, cost one fingerprint."""
    rng = random.Random(4)
    rows = [(i, prose(rng, 40), "en", "s", 1) for i in range(60)] + [(1000 + i, "the same text again", "en", "s", 1) for i in range(30)]
    rows += [(5000, "a repeated row of words", "en", "s", 1)] * 30
    got = {(r.doc_id, r.component_id) for r in ST.near_duplicates(frame(spark, rows)).collect()}
    assert {c for i, c in got if 1000 <= i < 2000} == {1000} and (5000, 5000) in got and len(got) == 91
