"""Near-duplicate groups: many universal hash minima, banding, signature
verification, exact confirmation on full shingle sets, connected components.

A text's set holds its distinct 5-word shingles (words: A-Z lower-cased runs
without ASCII white space).  Fewer than five words make one shingle of the
whole sequence; a text without words has an empty set and links to nothing.
Two documents are linked when ``100 * |A & B| >= 75 * |A | B|``.

Steps, and why none of them meets a whole group in one task:

1. one pass over the texts gives set size, a 128-bit digest of the set, and
   512 minima under independent multiply-add hashes, the first 128 of them banded;
2. documents with equal sets collapse to the smallest doc_id of their digest
   (a partially aggregated minimum, so thousands of copies cost one row a task);
3. banding: in each bucket every member is paired with the bucket's smallest
   member only, so a bucket of n members gives n - 1 pairs;
4. pairs whose signatures agree too little are dropped, the rest is confirmed
   on full sets; a much-used partner is split over several keys;
5. components of the confirmed links (large-star, small-star);
6. buckets that still hold members of two components: rounds in which a member proposes
   its best partner of another component (by signature, in its block) and is paired with the
   bucket's centre; what is confirmed joins components.  So a group around one text is found
   whichever member has the smallest id, with pairs in proportion to its members;
7. when the pairs that are left are few in proportion to the members, or a round finds nothing new, all
   pairs between components of a bucket that agree by signature are confirmed.  No bucket and no partner is
   capped or skipped, no pair is tested twice; what is found does not depend on the rounds.

With 32 bands of 4 minima a pair at the threshold shares no bucket with
probability 5e-6.  Signatures hold 512 minima (8 bits each); the bound on their
agreement lies 4 standard deviations below the threshold.  Texts are always
dealt by a shuffle, at every size: a list of wanted doc_ids has no size bound.

Defined cases: null or empty text: n_shingles 0, own component.  Null doc_id:
linked to nothing, component_id null, kept true.  A row that repeats a doc_id
gets the component of its own text's set; sets whose smallest doc_id is the same
are one node of the graph.  An empty table gives an empty result, other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, hashes, lower_words, mix64, small, staged, texts_of, word_hasher
from .components import components

WORDS = 5
BANDS, ROWS = 32, 4
SIMILAR = 75            # per cent of the union
MINIMA, AGREE = 512, 0.67   # of a signature; least share that agree (4.2 sd below 0.75)
BLOCK = 512             # members of a bucket that are compared at once
SPREAD = 1000           # members of one partner under one key
ROUNDS = 8              # of few pairs a member, before all pairs that are left
FEW = 4                 # pairs left a member of a bucket that are tested at once


class Shingler:
    """Whole texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, words: int = WORDS):
        self.words, self.table = words, word_hasher(11)
        self.factors = (np.random.default_rng(5).integers(0, 2**63, words, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def __call__(self, text: bytes) -> np.ndarray:
        words = lower_words(text)
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), 17)], np.uint64)
        h = hashes(self.table, words)
        n = len(h) - self.words + 1
        total = h[:n] * self.factors[0]
        for i in range(1, self.words):
            total += h[i:n + i] * self.factors[i]
        return np.unique(mix64(total))


class Minima:
    """``k`` minima of a set under ``x -> a x + b mod 2^32`` (odd a), x mixed."""

    def __init__(self, k: int, seed: int = 29):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = rng.integers(0, 2**32, k, dtype=np.uint32)

    def __call__(self, members: np.ndarray, step: int = 2048) -> np.ndarray:
        x = (members >> np.uint64(32)).astype(np.uint32)
        low = np.full(len(self.a), 2**32 - 1, np.uint32)
        for i in range(0, len(x), step):
            image = x[i:i + step, None] * self.a
            image += self.b
            np.minimum(low, image.min(0), out=low)
        return low


def signatures(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS,
               k: int = MINIMA) -> DataFrame:
    """``doc_id, n_shingles, digest, keys, sig``: digest and the rest are null
    for empty sets; ``keys`` has one long a band, ``sig`` 8 bits a minimum."""
    if k < bands * rows:
        raise ValueError("fewer minima than the bands need")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minima = Shingler(words), Minima(k)
        factors = (np.random.default_rng(3).integers(0, 2**63, rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        salt = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in small(batches):
            n, digest, keys, sig = [], [], [], []
            for text in texts_of(batch, "text"):
                members = shingler(text)
                n.append(len(members))
                if not len(members):
                    digest.append(None)
                    keys.append(None)
                    sig.append(None)
                    continue
                low = minima(members)
                digest.append(xxhash.xxh128_digest(members.tobytes()))
                banded = low[:bands * rows].reshape(bands, rows).astype(np.uint64)
                keys.append(mix64((mix64(banded) * factors).sum(1) + salt).view(np.int64))
                sig.append(((low ^ (low >> np.uint32(8))) & np.uint32(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                ["doc_id", "n_shingles", "digest", "keys", "sig"])

    return arrow_map(
        docs.select(F.col("doc_id").cast("long"), "text"), task, "doc_id long, n_shingles long, digest binary, keys array<long>, sig binary")


def _agreeing(pairs: DataFrame, sigs: DataFrame, agree: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree in at least that share of minima."""

    def task(batches):
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                               for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).filter(pa.array((left == right).mean(1) >= agree))

    return (pairs.join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(task, "a long, b long"))


def confirmed(pairs: DataFrame, docs: DataFrame, similar: int = SIMILAR, words: int = WORDS,
              spread: int = SPREAD) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the similarity.

    Each text travels to its pairs once and becomes its set there; the sets are
    then dealt by ``a``, where a partner with many pairs is repeated under
    ``ceil(pairs / spread)`` keys, so no key holds more than about that many.
    """
    keys = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / spread).cast("int").alias("parts"))
    members = (pairs.join(keys, "a")
               .select("a", F.col("b").alias("doc_id"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part")))
    first = keys.select("a", F.col("a").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = members.unionByName(first)

    def to_sets(batches):
        shingler = Shingler(words)
        for batch in small(batches):
            sets = [shingler(t).tobytes() for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("part"), batch.column("doc_id"), pa.array(sets, pa.binary())],
                ["a", "part", "b", "members"])

    def compare(batches):
        key, partners = None, []
        for batch in small(batches):
            left, right = [], []
            for a, part, b, raw in zip(*(batch.column(c).to_pylist() for c in ("a", "part", "b", "members"))):
                members = np.frombuffer(raw, np.uint64)
                if (a, part) != key:
                    key, partners = (a, part), []
                if a == b:
                    partners.append(members)  # more than one only where a doc_id repeats
                    continue
                for own in partners:
                    both = len(np.intersect1d(own, members, assume_unique=True))
                    if both and 100 * both >= similar * (len(own) + len(members) - both):
                        left.append(a)
                        right.append(b)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    sets = (docs.select(F.col("doc_id").cast("long"), "text").join(wanted.hint("merge"), "doc_id")
            .select("a", "part", "doc_id", "text")
            .mapInArrow(to_sets, "a long, part int, b long, members binary"))
    return (sets.repartition("a", "part")
            .sortWithinPartitions("a", "part", (F.col("a") != F.col("b")), "b")
            .mapInArrow(compare, "a long, b long").distinct())


def _groups(batches, keys: list[str]):
    """The rows of each group of a stream that is sorted by ``keys``, as tables."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        columns = [rows.column(c).to_numpy() for c in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        start = 0
        for end in cuts.tolist():
            yield rows.slice(start, end - start)
            start = end
        held = rows.slice(start)
    if held is not None and held.num_rows:
        yield held


def _signatures(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(rows.num_rows, -1)


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Buckets that hold members of several components: key, hub, n, rep, component."""
    placed = (members.filter("n > 2").join(found, F.col("rep") == F.col("node"), "left")
              .select("key", "hub", "n", "rep", F.coalesce("component", "rep").alias("component")))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return placed.join(several.select("key"), "key", "left_semi")


def _proposals(rest: DataFrame, sigs: DataFrame, agree: float, salt: int, block: int = BLOCK) -> DataFrame:
    """At most two pairs a member and bucket: with the member of another component that
    agrees best in its block, and with the bucket's centre.

    A member sits in one block of a bucket.  The member that agrees best with its block as a whole
    is the block's centre, the best of these the bucket's.
    """
    def block_of(rows: pa.Table):
        key, rep, comp = (rows.column(c).to_numpy() for c in ("key", "rep", "component"))
        sig = _signatures(rows)
        share = np.stack([(sig == s).mean(1) for s in sig])
        centre = np.lexsort((rep, -share.mean(1)))[0]
        share[comp[:, None] == comp[None]] = -1
        best = share.argmax(1)
        at = np.flatnonzero(share[np.arange(len(rep)), best] >= agree)
        pairs = pa.table({"a": np.minimum(rep[at], rep[best[at]]), "b": np.maximum(rep[at], rep[best[at]])})
        middle = pa.table({"key": key[:1], "centre": rep[[centre]], "of": comp[[centre]], "score": sig_mean(sig, centre)})
        return pa.concat_tables([pairs, middle], promote_options="default").select(["a", "b", "key", "centre", "of", "score"])

    def sig_mean(sig, at):
        return np.array([(sig == sig[at]).mean()])

    def task(batches):
        for rows in _groups(batches, ["key", "own"]):
            yield from block_of(rows).to_batches()

    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = (rest.join(sigs, "rep").select("key", F.pmod(F.xxhash64("rep", F.lit(salt)), blocks).cast("int").alias("own"), "rep", "component", "sig"))
    found = staged(dealt.repartition("key", "own").sortWithinPartitions("key", "own")
                   .mapInArrow(task, "a long, b long, key long, centre long, of long, score double"), "proposals")
    centres = (found.filter("key is not null").groupBy("key")
               .agg(F.max_by(F.struct("centre", "of"), F.struct("score", -F.col("centre"))).alias("c")).select("key", "c.centre", "c.of"))
    stars = (rest.join(centres, "key").filter("component <> of")
             .select(F.least("centre", "rep").alias("a"), F.greatest("centre", "rep").alias("b")).distinct())
    return _agreeing(stars, sigs, agree).unionByName(found.filter("a is not null").select("a", "b")).distinct()


def _outside(rest: DataFrame, reps: DataFrame, agree: float, block: int = BLOCK) -> DataFrame:
    """All pairs of a bucket from different components that agree by signature.

    Of each pair one member at least lies outside the bucket's largest component. These
    outsiders visit every block of the bucket's members, in blocks of their own.
    A pair that shares several buckets is given once, in the first of its bands;
    if one of the two is that bucket's hub, the first star has tested the pair.
    """
    sizes = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c"))
    largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("c", "component")).alias("main"), F.max("c").alias("c"))
    rows = (rest.join(largest, "key").join(reps.select("rep", "sig", "keys"), "rep")
            .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
            .withColumn("visits", F.ceil((F.col("n") - F.col("c")) / block).cast("int")))
    of = lambda count: F.pmod(F.xxhash64("rep"), F.col(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    cols = ["key", "i", "j", "visitor", "hub", "main", "rep", "component", "sig", "keys"]
    seats = rows.withColumn("visitor", F.lit(0)).withColumn("i", of("blocks")).withColumn("j", each("visits")).select(cols)
    visitors = (rows.filter("component <> main").withColumn("visitor", F.lit(1))
                .withColumn("j", of("visits")).withColumn("i", each("blocks")).select(cols))

    def block_pairs(rows: pa.Table) -> pa.RecordBatch:
        rep, comp, visitor = (rows.column(c).to_numpy() for c in ("rep", "component", "visitor"))
        key, hub, main = (rows.column(c)[0].as_py() for c in ("key", "hub", "main"))
        sig = _signatures(rows)
        keys = rows.column("keys").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        seat = (visitor == 0) & (rep != hub)
        left, right = [], []
        for x in np.flatnonzero((visitor == 1) & (rep != hub)):
            at = np.flatnonzero(seat & (comp != comp[x]) & ((comp == main) | (rep > rep[x])))
            if len(at):
                at = at[(sig[at] == sig[x]).mean(1) >= agree]
                at = at[keys[x][(keys[at] == keys[x]).argmax(1)] == key]
                left += [rep[x]] * len(at)
                right += rep[at].tolist()
        left, right = (np.array(side, np.int64) for side in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(left, right)), pa.array(np.maximum(left, right))], ["a", "b"])

    def task(batches):
        for rows in _groups(batches, ["key", "i", "j"]):
            yield block_pairs(rows)

    return (seats.unionByName(visitors).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(task, "a long, b long").distinct())


def _linked(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links: those of the graph whose nodes are the components so far."""
    of = lambda side: found.select(F.col("node").alias(side), F.col("component").alias("c" + side))
    between = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    joined = components(between, "a", "b")
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("into"))
    return staged(found.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
                  .unionByName(joined.join(found, "node", "left_anti")), "components")


def _left(rest: DataFrame):
    """Members of mixed buckets, and the pairs that all their outsiders could make."""
    sizes = rest.groupBy("key", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(F.sum("c").alias("n"), F.max("c").alias("c"))
    return sizes.agg(F.sum("n").alias("members"), F.sum(F.col("n") * (F.col("n") - F.col("c"))).alias("pairs")).first()


def near_duplicates(docs: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS,
                    similar: int = SIMILAR, k: int = MINIMA, agree: float = AGREE, rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    marked = staged(signatures(docs, words, bands, rows, k), "signatures")
    usable = marked.filter("digest is not null and doc_id is not null")
    # equal sets have equal keys and signatures: any of them stands for the group
    reps = staged(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"),
                                               F.first("sig").alias("sig")), "representatives")
    sigs = reps.select("rep", "sig")
    banded = reps.select("rep", F.explode("keys").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(banded.join(buckets, "key"), "buckets")

    stars = members.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    tested = staged(_agreeing(stars, sigs, agree), "pairs")
    found = components(staged(confirmed(tested, docs, similar, words), "links"), "a", "b")

    last = False
    for salt in range(rounds + 1):
        rest = staged(_mixed(members, found), "mixed")
        left = _left(rest)
        if not left["members"]:
            break
        last = last or salt == rounds or left["pairs"] <= FEW * left["members"]
        pairs = _outside(rest, reps, agree) if last else _proposals(rest, sigs, agree, salt)
        pairs = staged(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            tested = tested.unionByName(pairs)
            links = staged(confirmed(pairs, docs, similar, words), "links")
            if not links.isEmpty():
                found = _linked(found, links)
                if not last:
                    continue
        if last:
            break
        last = True                  # a round that finds nothing: all pairs that are left

    # every document: through the set it holds, or through another row of its doc_id
    groups = (reps.select("digest", "rep").join(found, F.col("rep") == F.col("node"), "left")
              .select("digest", F.coalesce("component", "rep").alias("component")))
    return (marked.select("doc_id", "n_shingles", "digest").join(groups, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The rows that stay of each near-duplicate group: that of the smallest doc_id.

    Rows are numbered, so rows that share a doc_id and not a near-equal text stay apart, and no
    two rows can be taken for one.  Ties go to the least of the other columns, then of the
    text's SHA-256.  Rows without a doc_id all stay.
    """
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    named = rows.filter("doc_id is not null")
    found = near_duplicates(named.select(F.col("_row").alias("doc_id"), "text"), **how).select(F.col("doc_id").alias("_row"), "component_id")
    order = F.struct("doc_id", *[c for c in docs.columns if c not in ("doc_id", "text")], F.sha2("text", 256).alias("_text"), "_row")
    least = (named.select("_row", order.alias("_order")).join(found, "_row")
             .groupBy("component_id").agg(F.min("_order").alias("_least")).select("_least._row"))
    return named.join(least, "_row", "left_semi").select(docs.columns).unionByName(rows.filter("doc_id is null").select(docs.columns))
