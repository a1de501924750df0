"""Mixing sources to target weights with blocks, shards and permutations.

The words of each source, its documents in a fixed pseudorandom order, form a
stream that is cut into blocks of ``BLOCK`` words.  The mix is a list of slots,
dealt to output shards of ``SLOTS`` slots.  Every shard draws its number of
slots per source; the draws are multinomial with the sources' totals given (a
tree of hypergeometric splits), so that all shards together hit the targets
exactly and any shard can work out its own draw and where it starts without
looking at the others.  The k-th slot of a source takes block ``perm(k mod n)``
of pass ``k div n``, with a keyed Feistel permutation per source and pass; the
short block at the end of a stream is the last of its pass.  Slots and document
pieces are joined by (source, block index).

No pass repeats a block, a target is at most twice a source, so no document is
taken more than twice.  The last slot of a source is cut so that the words
taken differ from the target by less than one.

Rows are stored with a running number first.  Rows alike in key, source, size and
text checksum are counted per task of that table, and stream offsets are two-level
sums of these counts: over (source, hash bucket) totals, then in a bucket whose
expected number of counts and words is bounded.  So a source that holds most rows is
many buckets, and a row that repeats without end is one count a task.
Only one row per source (name, size) reaches the driver; more than
``MAX_SOURCES`` sources are refused.

Defined cases: null text has size 0 and is never taken; null source is a source
of its own, last in order; repeated rows are separate documents, equal rows are
interchangeable; an empty table gives an empty result; columns that clash with
working names (leading underscore) are not kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, arrow_map, mix64, small, staged, texts_of

BLOCK = 128
SLOTS = 8192
WEIGHTS = (5, 2, 1)
SHARE = Fraction(3, 2)
MOST = 2
BUCKET = 20_000           # expected counts of rows, and hundreds of words, of a bucket
FEW = 32                  # draws made one by one
MAX_SOURCES = 100_000


def targets(sizes: list[int], weights=WEIGHTS, share=SHARE, most: int = MOST) -> list[Fraction]:
    """Words wanted of each source: ``share`` of all words by repeating weights;
    what lies above ``most`` times a source is shared again by weight."""
    weight = [Fraction(weights[i % len(weights)]) for i in range(len(sizes))]
    out = [Fraction(0)] * len(sizes)
    open_, left = list(range(len(sizes))), share * sum(sizes)
    while open_:
        unit = left / sum(weight[i] for i in open_)
        over = [i for i in open_ if unit * weight[i] > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = unit * weight[i]
            break
        for i in over:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
        gone = set(over)
        open_ = [i for i in open_ if i not in gone]
    return out


class Permutation:
    """Keyed permutation of range(n): four Feistel rounds, walked back into range."""

    def __init__(self, n: int, *key: int):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        rng = np.random.default_rng([*key, 77])
        self.keys = rng.integers(0, 2**63, 4, dtype=np.uint64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        half, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)
        out = np.asarray(x, np.uint64).copy()
        todo = np.arange(len(out))
        while len(todo):
            left, right = out[todo] >> half, out[todo] & mask
            for k in self.keys:
                left, right = right, left ^ (mix64(right + k) & mask)
            out[todo] = left << half | right
            todo = todo[out[todo] >= self.n]
        return out.astype(np.int64)


@dataclass(frozen=True)
class Mix:
    """What the slots follow from: per source its name, size, target and slots."""

    names: tuple
    sizes: tuple[int, ...]
    wanted: tuple[float, ...]
    slots: tuple[int, ...]
    last: tuple[int, ...]     # words of the source's last slot
    block: int
    per_shard: int
    seed: int
    rows: int = 0             # documents with words

    @property
    def shards(self) -> int:
        return -(-sum(self.slots) // self.per_shard)


def hypergeometric(good: int, bad: int, take: int, rng) -> int:
    """How many good ones are among ``take`` of ``good + bad`` without replacement.

    Each one is taken with probability take / (good + bad); what that takes too many or too
    few, about the root of ``take``, is drawn in the same way among those taken or left.
    Given its size such a set is any set alike, so the law is exact, at all sizes.
    """
    drawn, sign = 0, 1
    while take > FEW:
        p = take / (good + bad)
        g, b = int(rng.binomial(good, p)), int(rng.binomial(bad, p))
        drawn += sign * g
        if g + b > take:
            good, bad, take, sign = g, b, g + b - take, -sign
        else:
            good, bad, take = good - g, bad - b, take - g - b
    for _ in range(take):
        if rng.integers(good + bad) < good:
            drawn, good = drawn + sign, good - 1
        else:
            bad -= 1
    return drawn


def _split(counts: np.ndarray, take: int, rng) -> np.ndarray:
    """``take`` of the counted slots without replacement, by source."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, have in enumerate(counts.tolist()):
        if not take:
            break
        rest -= have
        out[i] = hypergeometric(have, rest, take, rng)
        take -= int(out[i])
    return out


def shard_draw(mix: Mix, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """(slots per source in this shard, first slot index per source)."""
    counts, start = np.array(mix.slots, np.int64), np.zeros(len(mix.slots), np.int64)
    low, high = 0, mix.shards
    while high - low > 1:
        mid = (low + high) // 2
        left = _split(counts, (mid - low) * mix.per_shard, np.random.default_rng([mix.seed, low, high]))
        if shard < mid:
            counts, high = left, mid
        else:
            counts, start, low = counts - left, start + left, mid
    return counts, start


def plan(sized: DataFrame, block: int = BLOCK, per_shard: int = SLOTS, seed: int = 20, **share) -> Mix:
    """The mix for a table with ``_source`` and ``_size``; one row per source is collected."""
    rows = (sized.groupBy("_source").agg(F.sum("_size").alias("n"), F.count_if(F.col("_size") > 0).alias("rows"))
            .limit(MAX_SOURCES + 1).collect())
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    sizes = [r["n"] for r in rows]
    wanted = targets(sizes, **share)
    slots, last = [], []
    for size, target in zip(sizes, wanted):
        words = round(target)
        passes, rest = divmod(words, size) if size else (0, 0)
        slots.append(passes * -(-size // block) + -(-rest // block))
        last.append(rest % block or (block if rest else size % block or block))
    return Mix(tuple(r["_source"] for r in rows), tuple(sizes), tuple(map(float, wanted)), tuple(slots),
               tuple(last), block, per_shard, seed, sum(r["rows"] for r in rows))


def slots(spark: SparkSession, mix: Mix) -> DataFrame:
    """``shard, slot, _s, pass, block, words``: the mix, one row a slot."""

    def task(batches):
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
        names = ["shard", "slot", "_s", "pass", "block", "words"]
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                counts, start = shard_draw(mix, shard)
                own = np.repeat(np.arange(len(counts)), counts)
                np.random.default_rng([mix.seed, shard, 1]).shuffle(own)
                passes, blocks, words = (np.zeros(len(own), np.int64) for _ in range(3))
                for s in np.flatnonzero(counts).tolist():
                    at = np.flatnonzero(own == s)
                    k = start[s] + np.arange(len(at))
                    size = mix.sizes[s]
                    n, full = -(-size // mix.block), size // mix.block
                    i = k % n
                    passes[at] = k // n
                    take = i.copy()  # the short block, index ``full``, keeps its place at the end
                    for p in np.unique(k // n).tolist():
                        mine = (k // n == p) & (i < full)
                        take[mine] = Permutation(full, mix.seed, s, p)(i[mine])
                    blocks[at] = take
                    words[at] = np.where(k == mix.slots[s] - 1, np.minimum(mix.last[s], size - take * mix.block),
                                         np.minimum(mix.block, size - take * mix.block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip((np.full(len(own), shard), np.arange(len(own)), own, passes, blocks, words),
                                                    kinds)], names)

    n = mix.shards
    return (spark.range(0, n, 1, max(1, min(n, 10_000)))
            .mapInArrow(task, "shard long, slot int, _s int, pass int, block long, words int"))


def sized(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    """Adds ``_source``, ``_size`` (words), ``_crc`` and a running number, ``_row``; to be stored."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*[c for c in docs.columns if not c.startswith("_")], F.col(source).alias("_source"),
                       F.regexp_count(body, F.lit(WORD)).cast("long").alias("_size"), F.crc32(body).alias("_crc"),
                       F.monotonically_increasing_id().alias("_row"))


def placed(rows: DataFrame, mix: Mix, key: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """``_row, _s, _size, _o`` of the rows with words: source number and offset in the source's stream."""
    spark = rows.sparkSession
    numbers = spark.createDataFrame([(n, i) for i, n in enumerate(mix.names)], "_name string, _s int")
    rows = (rows.filter("_size > 0")
            .join(F.broadcast(numbers), F.col("_source").eqNullSafe(F.col("_name")))  # <= MAX_SOURCES rows
            .select("_row", "_s", F.col(key).alias("_key"), "_size", "_crc",
                    F.shiftright("_row", 33).alias("_part")))  # the task that numbered the row
    alike = ["_s", "_key", "_size", "_crc", "_part"]
    n = max(1, -(-sum(mix.sizes) // (bucket * 100)), -(-mix.rows // bucket))
    counts = (rows.groupBy(*alike).agg(F.count(F.lit(1)).alias("_times"))
              .withColumn("_h", F.xxhash64("_key", "_size", "_crc", F.lit(mix.seed)))
              .withColumn("_b", F.pmod(F.xxhash64("_h"), F.lit(n)).cast("int"))
              .withColumn("_words", F.col("_times") * F.col("_size")))
    before = W.partitionBy("_s").orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = (counts.groupBy("_s", "_b").agg(F.sum("_words").alias("_n"))
               .select("_s", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    inner = W.partitionBy("_s", "_b").orderBy("_h", "_key", "_size", "_crc", "_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (counts.withColumn("_in", F.coalesce(F.sum("_words").over(inner), F.lit(0))).join(offsets, ["_s", "_b"])
              .select(*alike, (F.col("_first") + F.col("_in")).alias("_start")))
    nth = F.row_number().over(W.partitionBy(*alike).orderBy("_row")) - 1  # at most the rows of one task
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) if c == "_key" else F.col(f"r.{c}") == F.col(f"c.{c}") for c in alike]
    return (rows.withColumn("_nth", nth).alias("r").join(starts.alias("c"), same)
            .select("_row", "r._s", "r._size", (F.col("_start") + F.col("_nth") * F.col("r._size")).alias("_o")))


def taken_pieces(positions: DataFrame, mix: Mix) -> DataFrame:
    """``_row, _s, shard, slot, pass, first, n``: the words [first, first + n) that a
    slot takes of the document at ``_o``.  Slots meet documents by block index."""
    pieces = (positions.select("_row", "_s", "_o", "_size", F.explode(F.sequence(
        F.floor(F.col("_o") / mix.block).cast("long"),
        F.floor((F.col("_o") + F.col("_size") - 1) / mix.block).cast("long"))).alias("block")))
    begin = F.col("block") * mix.block
    first = F.greatest(F.col("_o"), begin) - F.col("_o")
    stop = F.least(F.col("_o") + F.col("_size"), begin + F.col("words")) - F.col("_o")
    # both sides grow with the corpus (Spark takes generated slots for a few bytes)
    return (pieces.join(slots(positions.sparkSession, mix).hint("merge"), ["_s", "block"])
            .select("_row", "_s", "shard", "slot", "pass", first.alias("first"), (stop - first).alias("n"))
            .filter("n > 0"))


def usage(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """Per document: key, size, source_size, target, taken."""
    rows = staged(sized(docs.select(key, "text", "source")).select(key, "_source", "_size", "_crc", "_row"), "sizes")
    mix = plan(rows, **settings)
    positions = staged(placed(rows, mix, key), "positions")
    taken = taken_pieces(positions, mix).groupBy("_row").agg(F.sum("n").alias("taken"))
    sources = docs.sparkSession.createDataFrame(list(zip(mix.names, mix.sizes, mix.wanted)),
                                                "_name string, source_size long, target double")
    return (rows.join(taken, "_row", "left")
            .join(F.broadcast(sources), F.col("_source").eqNullSafe(F.col("_name")))  # <= MAX_SOURCES rows
            .select(key, F.col("_size").alias("size"), "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cut(text: bytes, ranges: list[tuple[int, int]], size: int) -> bytes:
    """The words of the ranges with what stands between them; ranges that touch
    are one piece, pieces are set apart by a line end."""
    joined: list[list[int]] = []
    for first, n in sorted(ranges):
        if joined and joined[-1][1] >= first:
            joined[-1][1] = max(joined[-1][1], first + n)
        else:
            joined.append([first, first + n])
    if joined == [[0, size]]:
        return text
    spans = [m.span() for m in _WORD.finditer(text)]
    return b"\n".join(text[spans[a][0]:spans[b - 1][1]] for a, b in joined)


def mixed(docs: DataFrame, key: str = "doc_id", **settings) -> DataFrame:
    """The mix as documents: a row per document and pass with the words taken in
    that pass, in order; documents that are not taken are gone, those taken
    twice come twice.  Columns are those of the input; ``n_chars`` is renewed."""
    columns = [c for c in docs.columns if not c.startswith("_")]
    rows = staged(sized(docs), "numbered")
    narrow = rows.select(key, "_source", "_size", "_crc", "_row")
    mix = plan(narrow, **settings)
    positions = staged(placed(narrow, mix, key), "positions")
    ranges = taken_pieces(positions, mix).groupBy("_row", "pass").agg(
        F.collect_list(F.struct("first", "n")).alias("_ranges")).drop("pass")  # as many as a document has blocks
    full = rows.join(ranges, "_row").select(*columns, "_size", "_ranges")

    def task(batches):
        for batch in small(batches):
            out = [_cut(t, [(r["first"], r["n"]) for r in rs], n) for t, rs, n in zip(
                texts_of(batch, "text"), batch.column("_ranges").to_pylist(), batch.column("_size").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.binary()).cast(pa.string()) if c == "text" else batch.column(c) for c in columns], columns)

    out = arrow_map(full, task, full.select(columns).schema)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(columns) if "n_chars" in columns else out
