"""Near-duplicate groups of 64-bit SimHash fingerprints by a binary trie self-join.

A fingerprint bit is 1 if it is set in over half of the XXH64 values (seed 42) of a
text's 3-word shingles, repeats included (words: A-Z lower-cased runs without ASCII white
space; fewer words: the whole sequence; none: fingerprint zero).  Fingerprints
that differ in at most three bits are linked, documents of linked fingerprints form a group.

The self-join walks pairs of nodes of a binary trie of the distinct fingerprints together.  A pair
of nodes of one depth carries what is left of the error budget; its children
are the pairs of equal bits with the same budget and the pairs of unequal
bits with one less, and a pair without budget is pruned.  Two leaves that are left are compared as a whole.

How the walk is spread: two fingerprints that differ in three bits at most
agree in one of their four quarters.  Each fingerprint is entered four times,
turned so that quarter r comes first; below its 16 first bits only pairs of a node with itself
are walked.  A node pair with more than ``limit`` fingerprints is walked on in Spark, four
levels at a time (a fingerprint goes to each child pair that its bits and the budget allow), until
every pair is small; from there a task walks it, many pairs at once on numpy arrays.  So no task holds more than ``limit`` fingerprints of a pair, whatever the
data, and copies of a fingerprint count once.  A task returns its links as a
forest (an edge at most per fingerprint); large-star and small-star make the components.

Defined cases: null or empty text: fingerprint zero, linked like any other.  Null doc_id:
fingerprint given, linked with nothing, component_id null.  Rows that repeat a doc_id take the
component of their own fingerprint.  An empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, lower_words, small, staged, texts_of
from .components import components

WORDS, SEED, BITS = 3, 42, 3
QUARTERS = 4            # one more than the bits that may differ: one of them agrees
LIMIT = 8192            # fingerprints of a node pair that a task walks
AT_ONCE = 1 << 15       # fingerprints whose node pairs a task walks together
FRONTIER = 1 << 16      # node pairs that are split at once
STEP = 4                # levels that Spark walks at a time
PAIR = ["turn", "a", "b", "depth"]


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED, step: int = 1 << 16) -> int:
    w = lower_words(text)
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(w) > words:
        starts, ends = starts[:len(w) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = np.fromiter((xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), step):
        ones += np.unpackbits(h[i:i + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a long)."""
    def task(batches):
        for batch in small(batches):
            found = np.array([fingerprint(t) for t in texts_of(batch, "text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task, "doc_id long, fp long")


# ------------------------------------------------ the walk above: Spark rows

def roots(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Each fingerprint in four turns, under its first 16 bits' node paired with itself."""
    turned = F.array(*[F.struct(F.lit(r).alias("turn"), F.expr(f"shiftleft(fp, {16 * r}) | shiftrightunsigned(fp, {64 - 16 * r})" if r else "fp").alias("x"))
                       for r in range(QUARTERS)])
    rows = fps.select(F.explode(turned).alias("t")).select("t.turn", "t.x")
    node = F.expr("shiftleft(shiftrightunsigned(x, 48), 48)")
    return rows.select("turn", node.alias("a"), node.alias("b"), F.lit(16).alias("depth"), F.lit(bits).alias("left"), F.lit(0).alias("side"), "x")


def children(rows: DataFrame) -> DataFrame:
    """The node pairs ``STEP`` levels down to which each fingerprint of a pair belongs."""
    mine = f"cast(shiftrightunsigned(x, {64 - STEP} - depth) & {2 ** STEP - 1} as int)"
    down = rows.withColumn("own", F.expr(mine)).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(2 ** STEP - 1))))
    down = down.withColumn("rest", F.col("left") - F.bit_count(F.col("own").bitwiseXOR(F.col("other")))).filter("rest >= 0")
    first = F.when(F.col("a") == F.col("b"), F.col("own") <= F.col("other")).otherwise(F.col("side") == 0)
    down = down.withColumn("first", first)
    under = lambda node, bits: F.expr(f"{node} | shiftleft(cast({bits} as bigint), {64 - STEP} - depth)")
    return down.select("turn", under("a", "if(first, own, other)").alias("a"), under("b", "if(first, other, own)").alias("b"),
                       (F.col("depth") + STEP).alias("depth"), F.col("rest").alias("left"), F.expr("if(first, 0, 1)").alias("side"), "x")


def small_pairs(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows of node pairs that hold at most ``limit`` fingerprints each."""
    done = []
    while True:
        sizes = rows.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"), F.sum("side").alias("n1"))
        marks = staged(sizes.select(*PAIR, ((F.col("a") != F.col("b")) & ((F.col("n1") == 0) | (F.col("n1") == F.col("n")))).alias("alone"),
                                    (F.col("n") > limit).alias("big")).filter("alone or big"), "pairs")
        if marks.isEmpty():
            return reduce(DataFrame.unionByName, done, rows)
        marked = rows.join(marks, PAIR, "left")
        done.append(marked.filter("big is null").select(rows.columns))
        rows = staged(children(marked.filter("big and not alone").select(rows.columns)), "nodes")


# ------------------------------------------- the walk below: arrays in a task

def walk(x: np.ndarray, pairs: tuple[np.ndarray, ...], bits: int = BITS, frontier: int = FRONTIER):
    """Indexes (i, j) of linked fingerprints, in arrays.  ``x``: turned fingerprints,
    sorted within each node; ``pairs``: per node pair the bounds (lo, hi) of both
    nodes in ``x``, the depth and the budget that is left."""
    ones = np.zeros((65, len(x) + 1), np.int32)
    for d in range(64):
        np.cumsum((x >> np.uint64(63 - d)) & np.uint64(1), out=ones[d, 1:], dtype=np.int32)
    stack = [pairs]
    while stack:
        level = stack.pop()
        if len(level[0]) > frontier:
            stack += [tuple(c[s:s + frontier] for c in level) for s in range(0, len(level[0]), frontier)]
            continue
        l1, h1, l2, h2, depth, left = level
        leaf = (h1 - l1 == 1) & (h2 - l2 == 1)
        i, j = l1[leaf], l2[leaf]
        near = (i != j) & (np.bitwise_count(x[i] ^ x[j]) <= bits)
        if near.any():
            yield i[near], j[near]
        l1, h1, l2, h2, depth, left = (c[~leaf] for c in (l1, h1, l2, h2, depth, left))
        if not len(l1):
            continue
        m1, m2 = h1 - (ones[depth, h1] - ones[depth, l1]), h2 - (ones[depth, h2] - ones[depth, l2])
        crossed = l1 != l2
        below = []
        for p, q, r, s, cost, keep in ((l1, m1, l2, m2, 0, None), (m1, h1, m2, h2, 0, None), (l1, m1, m2, h2, 1, None), (m1, h1, l2, m2, 1, crossed)):
            ok = (p < q) & (r < s) & (left >= cost)
            if keep is not None:
                ok &= keep
            if cost == 0:
                ok &= crossed | (q - p > 1)
            below.append([c[ok] for c in (p, q, r, s, depth + 1, left - cost)])
        nodes = tuple(np.concatenate(c) for c in zip(*below))
        if len(nodes[0]):
            stack.append(nodes)


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after hooking the larger of two linked labels to the smaller."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def links(fps: DataFrame, bits: int = BITS, limit: int = LIMIT, at_once: int = AT_ONCE) -> DataFrame:
    """Edges (u, v) that connect all fingerprints within ``bits`` of one another, from a
    table of distinct ``fp``."""
    def found(t: pa.Table):
        turn, a, b, depth, left, side, x = (t.column(c).to_numpy() for c in ("turn", "a", "b", "depth", "left", "side", "x"))
        x = x.view(np.uint64)
        new = np.ones(len(x) + 1, bool)
        new[1:-1] = (turn[1:] != turn[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (depth[1:] != depth[:-1])
        cuts = np.flatnonzero(new)
        lo, hi = cuts[:-1], cuts[1:]
        mid = hi - np.add.reduceat(side, lo)
        own = a[lo] == b[lo]
        pairs = (lo, np.where(own, hi, mid), np.where(own, lo, mid), hi, depth[lo], left[lo])
        ok = np.where(own, hi - lo > 1, (mid > lo) & (mid < hi))
        label = np.arange(len(x))
        for i, j in walk(x, tuple(c[ok] for c in pairs), bits):
            label = joined(label, i, j)
        back = np.uint64(16) * turn.astype(np.uint64)
        fp = np.where(turn == 0, x, (x >> back) | (x << ((np.uint64(64) - back) & np.uint64(63)))).view(np.int64)
        at = np.flatnonzero(label != np.arange(len(x)))
        return pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[label[at]])], ["u", "v"])

    def task(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= at_once:
                rows = pa.Table.from_batches(held).combine_chunks()
                keys = [rows.column(c).to_numpy() for c in PAIR]
                change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
                if len(change):
                    cut = int(change[-1]) + 1
                    yield found(rows.slice(0, cut).combine_chunks())
                    held = rows.slice(cut).to_batches()
                    n -= cut
        if n:
            yield found(pa.Table.from_batches(held).combine_chunks())

    rows = small_pairs(roots(fps, bits), limit)
    return (rows.repartition(*PAIR).sortWithinPartitions(*PAIR, "side", "x")
            .mapInArrow(task, "u long, v long").distinct())


def near_duplicates(docs: DataFrame, bits: int = BITS, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    if bits >= QUARTERS:
        raise ValueError("four quarters find up to three differing bits")
    marked = staged(fingerprints(docs), "fingerprints")
    least = staged(marked.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "representatives")
    found = components(staged(links(least.select("fp"), bits, limit), "links"), "u", "v")
    named = least.join(found, F.col("fp") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("component", "fp").alias("class"))
    of_class = named.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    groups = named.join(of_class, "class").select("fp", "component_id")
    return (marked.join(groups, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
