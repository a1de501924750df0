"""What each filter of a chain removes, in every order of the chain.

A row either fails or passes each of k filters, so all that any order can do is
decided by the counts of the 2^k outcomes.  Per part these counts are reshaped to
a tensor with one axis of length two a filter; one ``einsum`` with the rows (pass,
fail, all) along every axis gives all 3^k contractions, and each step of each order
reads its figures there: kept = pass on the filters so far, removed = pass on the
earlier ones and fail on its own, and so on.

The counts are sums that Spark aggregates partially in each task, so a part with a
third of all rows costs one row a task.  Equal texts are found by their SHA-256:
rows are first counted by (doc_id, text), and the least doc_id of a text meets its
rows by (text, doc_id), so the copies of a text are spread over the tasks.

Defined cases: a null text counts as empty; a null ``lang`` is the part ``''``.  A null
doc_id is larger than none and smaller than none: such a row never fails E, nor
does it make another fail.  Rows that repeat a doc_id and its text count each;
none is a smaller doc_id's copy.  Several labels of a doc_id: one that says so
marks it.  An empty table has no parts and gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from string import ascii_lowercase

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

GAP = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")


def text_failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest`` and a boolean a filter for A to D, per row."""
    n, distinct = F.size("words").cast("long"), F.size(F.array_distinct("words")).cast("long")
    length = F.length("text").cast("long")
    capitals = length - F.length(F.translate("text", CAPITALS, ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("words", F.filter(F.split("text", GAP), lambda w: w != ""))
    return rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                       (n < 200).alias("A"), (100 * distinct < 50 * n).alias("B"), (100 * capitals > 3 * length).alias("C"),
                       F.col("text").rlike(r"[#$%&*|]").alias("D"))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counted outcomes: ``part``, a boolean a filter, ``n`` rows, and the ``good``
    and ``toxic`` ones of them."""
    counted = staged(text_failures(docs).groupBy("doc_id", "part", "digest", *"ABCD").agg(F.count(F.lit(1)).alias("n")), "outcomes")
    first = (counted.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("first", F.lit(True)))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    marked = lambda c: F.when(F.coalesce(F.col(c), F.lit(False)), F.col("n")).otherwise(0).alias(c)
    return (counted.join(first, ["digest", "doc_id"], "left")
            .withColumn("E", F.col("doc_id").isNotNull() & F.col("first").isNull())
            .join(marks, "doc_id", "left")
            .select("part", *FILTERS, "n", marked("good"), marked("toxic")))


def contingency(rows: DataFrame, filters: str = FILTERS, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """One row a part: per measure the array of its sums over the 2^k outcomes, the
    first filter's outcome changing slowest."""
    k = len(filters)
    outcome: Column = sum((F.col(f).cast("int") * 2 ** (k - 1 - i) for i, f in enumerate(filters)), F.lit(0))
    coded = rows.select("part", outcome.alias("outcome"), *measures)
    sums = [F.sum(F.when(F.col("outcome") == o, F.col(m)).otherwise(0)).alias(f"{m}_{o}") for m in measures for o in range(2 ** k)]
    return coded.groupBy("part").agg(*sums).select(
        "part", *[F.array(*[F.col(f"{m}_{o}") for o in range(2 ** k)]).alias(m) for m in measures])


def selections(counts: np.ndarray, k: int) -> np.ndarray:
    """(parts, 2^k) counts to (parts, 3, ..., 3): pass, fail or all along each axis."""
    choose = np.array([[1, 0], [0, 1], [1, 1]], np.int64)
    inner, outer = ascii_lowercase[:k], ascii_lowercase[k:2 * k]
    spec = ",".join(["z" + inner, *map("".join, zip(outer, inner))]) + "->z" + outer
    return np.einsum(spec, counts.reshape((-1,) + (2,) * k), *[choose] * k, optimize=True)


PASS, FAIL, ALL = 0, 1, 2


def steps(tables: dict[str, np.ndarray], k: int) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """All orders of the k filters, and per figure an array (parts, orders, steps)."""
    chosen = {m: selections(t, k) for m, t in tables.items()}
    parts = len(next(iter(tables.values())))
    orders = list(permutations(range(k)))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    out = {name: np.zeros((parts, len(orders), k), np.int64) for name in names}
    shapley = np.zeros((parts, k), np.int64)
    for o, order in enumerate(orders):
        for s, f in enumerate(order):
            kept, removed = [ALL] * k, [ALL] * k
            for g in order[:s + 1]:
                kept[g] = removed[g] = PASS
            removed[f] = FAIL
            failing, alone = [ALL] * k, [PASS] * k
            failing[f] = alone[f] = FAIL
            figure = lambda m, axes: chosen[m][(slice(None), *axes)]
            out["kept"][:, o, s] = figure("n", kept)
            out["removed"][:, o, s] = figure("n", removed)
            out["redundant"][:, o, s] = figure("n", failing) - figure("n", removed)
            out["unique_fails"][:, o, s] = figure("n", alone)
            out["good_lost"][:, o, s] = figure("good", removed)
            out["toxic_lost"][:, o, s] = figure("toxic", removed)
            shapley[:, f] += out["removed"][:, o, s]
    out["shapley"] = shapley[:, np.array(orders)]
    return orders, out


def audit(rows: DataFrame, filters: str = FILTERS, parts_at_once: int = 64) -> DataFrame:
    """``part, filter_order, step`` and the figures of each step of each order, from
    rows of ``part``, a boolean a filter, and the measures ``n, good, toxic``."""
    k = len(filters)
    figures = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")

    def task(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, parts_at_once):
                batch = whole.slice(at, parts_at_once)
                tables = {m: np.array(batch.column(m).to_pylist(), np.int64) for m in MEASURES}
                orders, out = steps(tables, k)
                each = len(orders) * k
                named = ["".join(filters[f] for f in order) for order in orders for _ in order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p in batch.column("part").to_pylist() for _ in range(each)], pa.string()),
                     pa.array(named * batch.num_rows, pa.string()),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), batch.num_rows * len(orders))),
                     *[pa.array(out[c].ravel()) for c in figures]], ["part", "filter_order", "step", *figures])

    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in figures)
    return contingency(rows, filters).mapInArrow(task, schema)

