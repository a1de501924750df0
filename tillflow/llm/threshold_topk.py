"""Exact top-k inner products by Fagin's threshold algorithm.

Components are scaled to integers, ``floor(256 x)``.  Vectors are stored once with
a running number and dealt into candidate blocks by hash of it, so vectors that
share an id spread as others do; queries, one row an id, are dealt into query
blocks.  Each pair of blocks is one task group of bounded size.  In it every dimension has a list of the block's
vectors sorted by that component.  A query reads all its lists in step (from the
end that its component's sign prefers), scores each newly met vector in full,
and stops once its kth score is above the bound: the sum over dimensions of its
component times the value that the list has reached, which no vector unseen can
exceed.  At a tie with the bound it reads on, so ties go to the smaller id.  The
block results, k rows a query and block, are cut to the best k by a ranked
window, which limits rows before its shuffle.

Defined cases: vectors that are null, empty, or hold a null or non-finite
component, and rows without an id, take no part; shorter vectors count as padded
with zeros; a query whose id repeats is the least of its vectors, and rows with
the query's own id are no candidates; candidates that repeat are separate
results; fewer than k candidates give fewer rows; no vectors give no rows.
With ``by_row`` rows count, not ids: each query row has results of its own, every
row but itself is a candidate (a copy under its id too, a row without an id last
at a tie), and an empty vector is one of zeros.
Scores are exact at any size: where a block's products could leave 64 bits they
are Python integers.  Such a score may be met and outranked; if it is among a
query's best, which the long column cannot hold, the job ends with a message.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

SCALE, K = 256, 5
VECTORS, QUERIES = 4_096, 1_024      # expected rows of a candidate and of a query block
STEP = 16                             # list entries read before the first bound check; doubles


def scaled(table: pa.Table, column: str) -> np.ndarray:
    """Integer matrix of a list column, padded with zeros; of Python integers if 64 bits are too few."""
    rows = [np.asarray(v.values, np.float64) for v in table.column(column)]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    if np.abs(out).max(initial=0) < 2.0**54:
        return np.floor(SCALE * out).astype(np.int64)
    whole = np.floor(SCALE * (out - np.trunc(out)))      # zero for components this large
    return _integers(out) * SCALE + _integers(whole)


def _integers(whole: np.ndarray) -> np.ndarray:
    """The whole parts as Python integers."""
    out = np.empty(whole.shape, object)
    out.ravel()[:] = [int(x) for x in whole.ravel()]
    return out


class Lists:
    """Sorted lists of each dimension of a block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, owners: np.ndarray | None = None, nameless: np.ndarray | None = None):
        """``owners``: what a query's own row is told by, its id if not given; ``nameless``: rows without an id."""
        self.ids, self.vectors = ids, vectors
        self.owners = ids if owners is None else owners
        self.nameless = np.zeros(len(ids), bool) if nameless is None else nameless
        self.order = np.argsort(-vectors, axis=0, kind="stable").T.copy()     # dimension, depth
        self.values = np.take_along_axis(vectors.T, self.order, 1)
        self.largest = int(np.abs(vectors).max(initial=0))

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, best first."""
        at, scores = self.places(query, own, k)
        return self.ids[at], scores

    def places(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in the block and scores of the k best, best first."""
        n, dims = self.vectors.shape
        q = np.zeros(dims, query.dtype)
        q[:min(dims, len(query))] = query[:dims]
        used = np.flatnonzero(q)
        most = dims * max(1, self.largest) * max(1, int(np.abs(q).max(initial=0)))
        # float products of small integers are exact, and fast
        kind = np.float64 if most < 2**53 else np.int64 if most < 2**63 else object
        plain = object if kind is object else np.int64
        weights, q = q.astype(kind), q.astype(plain)
        forward, backward = used[q[used] > 0], used[q[used] < 0]
        unseen = self.owners != own
        top, top_scores = np.empty(0, np.int64), np.empty(0, plain)
        at, step = 0, STEP
        while at < n:
            end = min(n, at + step)
            met = np.zeros(n, bool)
            met[self.order[forward, at:end].ravel()] = True
            met[self.order[backward, n - end:n - at].ravel()] = True
            if not len(used):
                met[:] = True  # a zero query: every score is 0
            new = np.flatnonzero(met & unseen)
            unseen[new] = False
            scores = (self.vectors[new].astype(kind) @ weights).astype(plain)
            top, top_scores = np.concatenate([top, new]), np.concatenate([top_scores, scores])
            if len(top) > k:
                cut = self._ordered(top, top_scores)[:k]
                top, top_scores = top[cut], top_scores[cut]
            bound = (int(self.values[forward, end - 1].astype(plain) @ q[forward])
                     + int(self.values[backward, n - end].astype(plain) @ q[backward]))
            if len(top) == k and int(top_scores.min()) > bound:
                break
            at, step = end, step * 2
        cut = self._ordered(top, top_scores)
        return top[cut], top_scores[cut]

    def _ordered(self, at: np.ndarray, scores: np.ndarray) -> np.ndarray:
        return np.lexsort((self.ids[at], self.nameless[at], -scores))


def top_k(vectors: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", column: str = "embedding",
          vectors_per_block: int = VECTORS, queries_per_block: int = QUERIES, by_row: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of every query, or with ``by_row`` of every query row."""
    good = F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    if not by_row:
        good = good & F.col("id").isNotNull() & (F.size("v") > 0)
    rows = vectors.select(F.col(key).cast("long").alias("id"), is_query.alias("q"),
                          F.col(column).cast("array<double>").alias("v")).filter(good)
    rows = staged(rows.withColumn("n", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("own", F.col("n") if by_row else F.col("id"))
    queries = rows.filter("q")
    queries = queries.select("own", "id", "v") if by_row else queries.groupBy("own", "id").agg(F.min("v").alias("v"))
    n_vectors, n_queries = rows.count(), queries.count()
    blocks = max(1, -(-n_vectors // vectors_per_block))
    query_blocks = max(1, -(-n_queries // queries_per_block))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = rows.select("own", "id", "v", F.pmod(F.xxhash64("n"), F.lit(blocks)).alias("c"), numbers(query_blocks).alias("b"))
    asked = queries.select("own", "id", "v", numbers(blocks).alias("c"), F.pmod(F.xxhash64("own"), F.lit(query_blocks)).alias("b"))

    def search(block: pa.Table, wanted: pa.Table) -> pa.Table:
        out = [[], [], [], []]
        if block.num_rows and wanted.num_rows:
            ids = block.column("id")
            lists = Lists(ids.fill_null(0).to_numpy(), scaled(block, "v"), block.column("own").to_numpy(),
                          ids.is_null().to_numpy())
            named = ids.to_pylist()
            for own, q, v in zip(wanted.column("own").to_pylist(), wanted.column("id").to_pylist(), scaled(wanted, "v")):
                at, scores = lists.places(v, own, k)
                out[0] += [own] * len(at)
                out[1] += [q] * len(at)
                out[2] += [named[i] for i in at.tolist()]
                out[3] += scores.tolist()
        over = [(x >= 2**63) - (x < -2**63) for x in out[3]]
        out[3] = [None if o else x for x, o in zip(out[3], over)]
        return pa.table([*[pa.array(a, pa.int64()) for a in out], pa.array(over, pa.int32())],
                        ["own", "query_id", "vec_id", "score", "over"])

    found = (dealt.groupBy("c", "b").cogroup(asked.groupBy("c", "b"))
             .applyInArrow(search, "own long, query_id long, vec_id long, score long, over int"))
    order = W.partitionBy("own").orderBy(F.col("over").desc(), F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    score = F.when(F.col("over") == 0, F.col("score")).otherwise(
        F.raise_error(F.lit("one of a query's best scores does not fit in 64 bits")).cast("long"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score")))
