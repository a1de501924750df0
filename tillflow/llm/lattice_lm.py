"""Language-model scores: subword lattice likelihood.

The piece vocabulary of an existing tokenizer is a unigram model over pieces;
its log probabilities are the smoothed counts of its pieces in the training
documents as that tokenizer segments them (the file's own scores are merge ranks,
not probabilities).  A text's score is its marginal probability: all
segmentations of every word into pieces, summed by a log-space forward
recursion.  No piece reaches over white space, so the lattice of a text is a
chain of word lattices and each distinct word of the corpus is summed once.
Characters that are no piece have one edge, their byte pieces.  Beside it stands
a smoothed word unigram score.

Work is dealt by chunk, about ``CHUNK`` bytes of text by hash of the row and its
place in the stored table, so equal rows spread as others do.  A chunk numbers
its distinct words; its documents shrink to (word number, count) lists, so texts
travel once.  (chunk, word) rows are counted by word, joined with the word's
figures, and come back to the chunk's documents.  No vocabulary is broadcast;
only the piece scores are, whose number the tokenizer fixes.

Defined cases: null text is empty (its only token is the end); null doc_id is a
training document; repeated rows count and score
alike; without training documents every word score is log10(1); an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, lower_words, staged
from .piece_merge import BYTE, CONTROL, SPACE, UNKNOWN, Merger, Pieces

CHUNK = 6_000_000
HELD_OUT = 5, 1         # doc_ids whose crc32 modulo 5 is 1 are not learned from
LN10 = math.log(10)


class Lattice:
    """Marginal log10 probability of a word under unigram piece scores (natural logs)."""

    def __init__(self, pieces: Pieces, logs: np.ndarray):
        self.logs = {t: float(logs[i]) for i, t in enumerate(pieces.text)
                     if pieces.kind[i] not in (CONTROL, UNKNOWN, BYTE)}
        self.longest = max(map(len, self.logs))
        self.byte = [float(logs[pieces.byte[b]]) for b in range(256)]

    def __call__(self, word: str) -> float:
        """Forward recursion over the characters of the word with its leading space."""
        text, logs, longest = SPACE + word, self.logs, self.longest
        alpha = [0.0]
        for end in range(1, len(text) + 1):
            terms = []
            for start in range(max(0, end - longest), end):
                edge = logs.get(text[start:end])
                if edge is not None:
                    terms.append(alpha[start] + edge)
            if text[end - 1] not in logs:
                terms.append(alpha[-1] + sum(self.byte[b] for b in text[end - 1].encode("utf-8", "surrogatepass")))
            if len(terms) == 1:
                alpha.append(terms[0])
            else:
                top = max(terms)
                alpha.append(top + math.log(sum([math.exp(t - top) for t in terms])))
        return alpha[-1] / LN10


def _chunked(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """doc_id, text, train, chunk; chunks hold about ``chunk_bytes`` of text.  ``docs`` is a
    stored table: its rows come in the same order when a task runs again."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       (fold("doc_id", HELD_OUT[0]) != HELD_OUT[1]).alias("train"))
    size = rows.agg(F.sum(F.octet_length("text") + 8).alias("n")).first()["n"] or 0
    chunks = max(1, -(-size // chunk_bytes))
    return rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(chunks)).cast("int"))


class _Numbers(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _parts(rows: pa.Table) -> pa.Table:
    """A chunk as rows of two kinds: its distinct words (number ``i``, word,
    count in training documents) and its documents (``bag``: packed word numbers
    and counts)."""
    numbers, bags, used = _Numbers(), [], []
    pack = zstandard.ZstdCompressor(level=1)
    for text, train in zip(rows.column("text").cast(pa.binary()).to_pylist(), rows.column("train").to_pylist()):
        words = lower_words(text)
        which, count = np.unique(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)), return_counts=True)
        if train:
            used.append((which, count))
        bags.append(pack.compress(np.concatenate([np.diff(which, prepend=np.int32(0)), count]).astype(np.int32).tobytes()))
    n = np.zeros(len(numbers), np.int64)
    for which, count in used:
        n[which] += count
    docs, words = len(bags), len(numbers)
    none = lambda kind, k: pa.nulls(k, kind)
    return pa.table({
        "chunk": pa.array(np.full(docs + words, rows.column("chunk")[0].as_py(), np.int32)),
        "i": pa.concat_arrays([none(pa.int32(), docs), pa.array(np.arange(words, dtype=np.int32))]),
        "word": pa.concat_arrays([none(pa.binary(), docs), pa.array(list(numbers), pa.binary())]),
        "n": pa.concat_arrays([none(pa.int64(), docs), pa.array(n)]),
        "doc_id": pa.concat_arrays([rows.column("doc_id").combine_chunks().cast(pa.int64()), none(pa.int64(), words)]),
        "train": pa.concat_arrays([rows.column("train").combine_chunks(), none(pa.bool_(), words)]),
        "bag": pa.concat_arrays([pa.array(bags, pa.binary()), none(pa.binary(), words)])})


PARTS = "chunk int, i int, word binary, n long, doc_id long, train boolean, bag binary"


def piece_logs(words: DataFrame, train_docs: int, model: str) -> np.ndarray:
    """Natural-log unigram scores of all pieces from (word, c) counts."""

    def task(batches):
        merger = Merger(model)
        total = np.zeros(len(merger.pieces), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 20_000):
                part = batch.slice(start, 20_000)
                count = part.column("c").to_numpy()
                ids, at = merger.encode_units([SPACE + w.decode("utf-8", "replace") for w in part.column("word").to_pylist()])
                np.add.at(total, ids, np.repeat(count, np.diff(at)))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["piece", "n"])

    counted = words.filter("c > 0").mapInArrow(task, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = Pieces(model)
    n = np.zeros(len(pieces))
    for row in counted.collect():  # at most one row a piece of the vocabulary
        n[row["piece"]] = row["n"]
    n[pieces.eos] = train_docs
    usable = ~np.isin(pieces.kind, (CONTROL, UNKNOWN))
    usable[pieces.eos] = True
    return np.where(usable, np.log((n + 0.5) / (n[usable].sum() + 0.5 * usable.sum())), -np.inf)


def scores(docs: DataFrame, model: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = _chunked(docs, chunk_bytes)
    parts = staged(rows.groupBy("chunk").applyInArrow(_parts, PARTS), "chunks")
    own_words, bags = parts.where("word is not null"), parts.where("bag is not null")
    words = staged(own_words.groupBy("word").agg(F.sum("n").alias("c")), "words")
    train_docs = rows.filter("train").count()
    totals = words.filter("c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    tokens, distinct = (totals["n"] or 0) + train_docs, totals["v"] + (train_docs > 0)
    logs = piece_logs(words, train_docs, model)
    end = float(logs[Pieces(model).eos]) / LN10
    floor = tokens + 0.5 * (distinct + 1)

    def lattice(batches):
        own = Lattice(Pieces(model), logs)
        for batch in batches:
            for start in range(0, batch.num_rows, 50_000):
                part = batch.slice(start, 50_000)
                found = [own(w.decode("utf-8", "replace")) for w in part.column("word").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("word"), part.column("c"), pa.array(found, pa.float64())],
                                                 ["word", "c", "lp"])

    figures = staged(words.mapInArrow(lattice, "word binary, c long, lp double"), "figures")
    known = own_words.select(F.col("chunk").alias("of"), "i", "word").join(figures, "word").drop("word")

    def score(docs: pa.Table, own: pa.Table) -> pa.Table:
        order = np.argsort(own.column("i").to_numpy())
        count, lp = own.column("c").to_numpy()[order], own.column("lp").to_numpy()[order]
        base, unpack = np.log10((count + 0.5) / floor), zstandard.ZstdDecompressor()
        out = []
        for bag in docs.column("bag").to_pylist():
            which, times = np.frombuffer(unpack.decompress(bag), np.int32).reshape(2, -1)
            i = np.cumsum(which)
            out.append((int(times.sum()) + 1, int(times[count[i] > 0].sum()) + (train_docs > 0),
                        float(base[i] @ times) + math.log10((train_docs + 0.5) / floor), float(lp[i] @ times) + end))
        cols = list(zip(*out)) if out else [()] * 4
        held = [not t for t in docs.column("train").to_pylist()]
        return pa.table([docs.column("doc_id"), pa.array(held, pa.bool_()), pa.array(cols[0], pa.int64()),
                         pa.array(cols[1], pa.int64()), pa.array([tokens] * len(out), pa.int64()),
                         pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64())], NAMES)

    return (bags.select("chunk", "doc_id", "train", "bag").groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
