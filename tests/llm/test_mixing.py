import math
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tillflow.llm import mixing

from .helpers import corpus, frame


def test_targets():
    assert mixing.targets([]) == []
    assert mixing.targets([0, 0]) == [0, 0]
    sizes = [1000, 10, 500, 300]
    t = mixing.targets(sizes)
    assert sum(t) == Fraction(3, 2) * sum(sizes) and all(x <= 2 * s for x, s in zip(t, sizes))
    assert t[1] == 20  # capped
    free = mixing.targets([10**6, 10**6, 10**6], share=Fraction(1, 100))
    assert [x / free[2] for x in free] == [5, 2, 1]


def test_permutations_are_permutations():
    for n in (1, 2, 3, 5, 64, 1000, 4097):
        out = mixing.Permutation(n, 1, 2)(np.arange(n))
        assert sorted(out.tolist()) == list(range(n))
    a, b = (mixing.Permutation(1000, 1, p)(np.arange(1000)) for p in (0, 1))
    assert (a != b).mean() > 0.9 and (a != np.arange(1000)).mean() > 0.9


def test_shards_share_out_the_slots_exactly():
    mix = mixing.Mix(("a", "b", "c"), (5000, 300, 70000), (7500.0, 600.0, 105000.0), (60, 5, 821), (1, 1, 1), 128, 50, 3)
    total, at = np.zeros(3, int), np.zeros(3, int)
    for s in range(mix.shards):
        counts, start = mixing.shard_draw(mix, s)
        assert (start == at).all() and (counts >= 0).all()
        assert counts.sum() == min(50, sum(mix.slots) - 50 * s)
        at = at + counts
        total += counts
    assert tuple(total) == mix.slots
    assert len({tuple(mixing.shard_draw(mix, s)[0]) for s in range(mix.shards)}) > 1


def words(text):
    return (text or "").encode().split()


def test_usage(spark):
    rows = corpus()
    settings = dict(block=16, per_shard=32)
    docs = frame(spark, rows)
    out = mixing.usage(docs, **settings).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = dict(zip(order, mixing.targets([sizes[s] for s in order])))
    source = {i: s for i, _, _, s, _ in rows}
    got = Counter()
    for r in out:
        assert r.taken <= 2 * r.size
        assert r.source_size == sizes[source[r.doc_id]] and r.target == float(wanted[source[r.doc_id]])
        got[source[r.doc_id]] += r.taken
    assert all(abs(got[s] - wanted[s]) < 1 for s in order)
    again = mixing.usage(docs.repartition(2), **settings).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_mixed_documents_hold_the_words_taken(spark):
    rows = corpus()
    settings = dict(block=16, per_shard=32)
    docs = frame(spark, rows)
    taken = defaultdict(int)
    for r in mixing.usage(docs, **settings).collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed(docs, **settings)
    assert out.columns == docs.columns
    given = {i: Counter(words(t)) for i, t, *_ in rows}
    got, texts = defaultdict(int), defaultdict(list)
    for r in out.collect():
        got[r.doc_id] += len(words(r.text))
        texts[r.doc_id].append(r.text)
        assert r.n_chars == len(r.text) and not Counter(words(r.text)) - given[r.doc_id]
    assert dict(got) == {k: v for k, v in taken.items() if v}
    whole = {i: t for i, t, *_ in rows}
    assert any(ts.count(whole[i]) == 2 for i, ts in texts.items())


def test_slots_cover_each_block_as_often_as_planned(spark):
    mix = mixing.Mix(("a",), (1000,), (1500.0,), (12,), (100 - 96, ), 128, 5, 9)
    rows = mixing.slots(spark, mix).collect()
    assert len(rows) == 12 and len({(r.shard, r.slot) for r in rows}) == 12
    by_pass = defaultdict(list)
    for r in rows:
        by_pass[r["pass"]].append(r.block)
    assert sorted(by_pass[0]) == list(range(8)) and len(set(by_pass[1])) == 4


def test_empty(spark):
    assert mixing.usage(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [])).collect() == []


def test_hypergeometric_law():
    good, bad, take, n = 60, 90, 70, 20_000
    rng = np.random.default_rng(5)
    seen = Counter(mixing.hypergeometric(good, bad, take, rng) for _ in range(n))
    p = {k: math.comb(good, k) * math.comb(bad, take - k) / math.comb(good + bad, take) for k in range(good + 1)}
    common = [k for k in p if n * p[k] >= 20]
    chi = sum((seen[k] - n * p[k]) ** 2 / (n * p[k]) for k in common)
    assert chi < len(common) + 4 * math.sqrt(2 * len(common))


def test_hypergeometric_at_all_sizes():
    rng = np.random.default_rng(6)
    for good, bad, take in ((0, 5, 3), (5, 0, 3), (7, 9, 16), (7, 9, 0), (10**15, 3, 10**15), (3, 10**15, 10**15 + 1), (10**12, 10**12, 1)):
        assert max(0, take - bad) <= mixing.hypergeometric(good, bad, take, rng) <= min(good, take)
    for scale in (10**4, 10**8, 10**10, 10**14):  # one law: spread about the mean as the formula says
        good, bad, take = 3 * scale, 7 * scale, 4 * scale
        spread = math.sqrt(take * 0.3 * 0.7 * (good + bad - take) / (good + bad - 1))
        z = [(mixing.hypergeometric(good, bad, take, rng) - 0.3 * take) / spread for _ in range(2000)]
        assert abs(np.mean(z)) < 0.12 and abs(np.std(z) - 1) < 0.08


def hot():
    """A third of all rows alike, a third without words or id, one source with most of the rest."""
    rows = [(7, "one two three", "en", "a", 13)] * 150 + [(None, " ", "en", "a", 1)] * 100 + [(None, "same", "en", None, 4)] * 50
    return rows + [(1000 + i, f"w{i} " * (i % 40), "en", "a" if i % 5 else "b", 0) for i in range(150)]


def test_streams_and_words_taken_by_brute_force(spark):
    rows = hot()
    docs = frame(spark, rows, 5)
    settings = dict(block=16, per_shard=8)
    stored = mixing.staged(mixing.sized(docs), "numbered")
    mix = mixing.plan(stored, **settings)
    positions = mixing.placed(stored, mix, bucket=3).collect()
    assert len({r["_row"] for r in positions}) == len(positions) == sum(bool(words(r[1])) for r in rows)
    streams = defaultdict(list)
    for r in sorted(positions, key=lambda r: (r["_s"], r["_o"])):
        assert r["_o"] == len(streams[r["_s"]])  # no gap, nothing twice
        streams[r["_s"]] += [r["_row"]] * r["_size"]
    assert [len(streams[i]) for i in range(len(mix.sizes))] == list(mix.sizes)
    # the words of every slot, one by one, over the streams that usage works with
    streams = defaultdict(list)
    for r in sorted(mixing.placed(stored, mix).collect(), key=lambda r: (r["_s"], r["_o"])):
        streams[r["_s"]] += [r["_row"]] * r["_size"]
    taken = Counter()
    for slot in mixing.slots(spark, mix).collect():
        for at in range(slot.block * 16, slot.block * 16 + slot.words):
            taken[streams[slot["_s"]][at]] += 1
    want = Counter((r.doc_id, r["_size"], taken[r["_row"]]) for r in stored.collect())
    assert Counter((r.doc_id, r.size, r.taken) for r in mixing.usage(docs, **settings).collect()) == want
    assert sum(taken.values()) == sum(map(round, mix.wanted))


def test_rows_alike_are_counted_before_they_are_ordered(spark):
    """No task of the offsets holds the rows of a hot document, whatever the table's partitions."""
    docs = frame(spark, hot(), 5)
    once, again = (Counter(map(tuple, mixing.usage(docs.repartition(n, F.rand(3)), block=16, per_shard=8).collect()))
                   for n in (1, 6))
    assert once == again
