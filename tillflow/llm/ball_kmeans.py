"""Vector codes by ball k-means on integer vectors, one codebook a part.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; each part
has a codebook, fitted by a fixed number of rounds of assignment and update.  All
distances and sums are exact integers.

An assignment starts from the entry that a part had in the round before.  The
parts of one entry form a ball around it, whose radius is their largest distance
(of the rows at hand: the rule holds for any set of rows).  Entry j can only take
a part from the ball of i if it lies no farther from i than twice the radius: the
neighbour entries.  With the neighbours in order of their distance, a part
at distance d from i lies in the ring of those whose distance is at most 2 d and meets
only these; a part in the stable core (ring 0) meets none.  A pair of entries that
both stood still since the last round is skipped too.  Ties go to the lower index:
the ring includes equality, so nothing that could win a tie is left out.

Each round is one pass without a shuffle of rows: a task writes its rows with their new codes, and one
row of its own sums beside them, which Spark adds up to one number per codebook
component (all that reaches the driver).  The rows of the round before are deleted once the new ones are written.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components
are dropped; a null vec_id is kept (last in order).  Rows that repeat a vec_id are rows of their own;
the first entries are the first rows by (vec_id, vector).  With fewer rows than entries the codebooks hold as
many entries as there are rows.  An empty table gives no rows.  Vectors of different lengths, a length that the
parts do not divide, and components too large for exact 64-bit sums end the job
with a message.  Other columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deleted, stored

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


def integers(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows with a usable vector: ``vec_id, label, v`` (array of longs)."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (rows.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, usable))
            .select("vec_id", "label", F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v")))


def neighbours(book: np.ndarray, radius: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry its neighbour entries by distance, and these squared distances
    (a value that no ring reaches behind the last neighbour)."""
    gap = ((book[:, None] - book[None]) ** 2).sum(-1)
    near = (gap <= 4 * radius[:, None]) & (moved[:, None] | moved[None]) & ~np.eye(len(book), dtype=bool)
    gap = np.where(near, gap, np.iinfo(np.int64).max)
    order = np.argsort(gap, axis=1, kind="stable")[:, :max(int(near.sum(1).max(initial=0)), 0)]
    return order, np.take_along_axis(gap, order, 1)


def assign(x: np.ndarray, own: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each row of ``x`` (ties to the lower index) and its squared
    distance; ``own`` are the entries before, ``moved`` the entries that changed since."""
    best = ((x - book[own]) ** 2).sum(1)
    radius = np.full(len(book), -1, np.int64)
    np.maximum.at(radius, own, best)
    order, gap = neighbours(book, radius, moved)
    ring = (gap[own] <= 4 * best[:, None]).sum(1)
    code = own.copy()
    for k in range(order.shape[1]):
        at = np.flatnonzero(ring > k)
        if not len(at):
            break
        j = order[own[at], k]
        d = ((x[at] - book[j]) ** 2).sum(1)
        wins = (d < best[at]) | ((d == best[at]) & (j < code[at]))
        best[at[wins]], code[at[wins]] = d[wins], j[wins]
    return code, best


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    values = batch.column("v")
    flat = values.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != width * batch.num_rows or (np.diff(values.offsets.to_numpy()) != width).any():
        raise ValueError(f"vectors of another length than {width}")
    largest = max(int(flat.max(initial=0)), -int(flat.min(initial=0)))
    if 4 * width * (2 * largest) ** 2 >= 2 ** 63:
        raise ValueError(f"a component of {largest} units is too large for exact 64-bit sums")
    return flat.reshape(batch.num_rows, width)


def _pass(rows: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """One assignment: rows with ``code`` and ``error`` (kind 0), and each task's
    sums and counts per part, entry and component as one row (kind 1)."""
    parts, entries, width = books.shape

    def task(batches):
        sums = np.zeros((parts, entries, width + 1), np.int64)
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.column(c).type for c in ("vec_id", "label", "v")]
            x = _vectors(batch, parts * width).reshape(-1, parts, width)
            before = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, parts)
            codes, error = np.empty_like(before), np.zeros(len(x), np.int64)
            for p in range(parts):
                code, d = assign(x[:, p], before[:, p].astype(np.int64), books[p], moved[p])
                codes[:, p] = code
                error += d
                np.add.at(sums[p, :, :width], code, x[:, p])
                sums[p, :, width] += np.bincount(code, minlength=entries)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("vec_id", "label", "v")], pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array(error), pa.nulls(len(x), pa.list_(pa.int64())), pa.array(np.zeros(len(x), np.int32))],
                ["vec_id", "label", "v", "code", "error", "sums", "kind"])
        if kinds:
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, t) for t in kinds], pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                 pa.array([sums.ravel().tolist()], pa.list_(pa.int64())), pa.array([1], pa.int32())],
                ["vec_id", "label", "v", "code", "error", "sums", "kind"])

    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.select("vec_id", "label", "v", "code").mapInArrow(
        task, f"vec_id {fields['vec_id']}, label {fields['label']}, v array<long>, code binary, error long, sums array<long>, kind int")


def updated(books: np.ndarray, written: DataFrame) -> np.ndarray:
    """The entries' new values; an entry without parts stays."""
    parts, entries, width = books.shape
    total = np.zeros(books.size + parts * entries, dtype=object)
    found = (written.filter("kind = 1").select(F.posexplode("sums").alias("at", "value"))
             .groupBy("at").agg(F.sum("value").alias("value")))
    for r in found.collect():  # one row per codebook component
        total[r["at"]] = r["value"]
    total = total.reshape(parts, entries, width + 1)
    new = books.copy()
    for p, e in np.argwhere(total[:, :, width] > 0):
        new[p, e] = [s // int(total[p, e, width]) for s in total[p, e, :width]]
    return new


def encode(rows: DataFrame, vector: str = "embedding", scale: int = SCALE, parts: int = PARTS,
           entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, v, code`` (a byte a part) and ``error`` of each kept row, and
    the codebooks (parts, entries, components)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte")
    spark = rows.sparkSession
    kept = integers(rows, vector, scale)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    if not first:
        return kept.select("*", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), np.empty((parts, 0, 0), np.int64)
    width = len(first[0]["v"])
    if width % parts or any(len(r["v"]) != width for r in first):
        raise ValueError(f"vectors of different lengths, or not of {parts} equal parts")
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    moved = np.ones(books.shape[:2], bool)
    state, path = kept.withColumn("code", F.lit(bytes(parts))), None
    for left in range(rounds, -1, -1):
        written, now = stored(_pass(state, books, moved), "codes", "kind")
        if path:
            deleted(spark, path)
        path, state = now, written.filter("kind = 0")
        new = updated(books, written) if left else books
        moved = (new != books).any(2)
        if not moved.any():
            break  # the next assignments would repeat this one
        books = new
    return state.select("vec_id", "label", "v", "code", "error"), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Per kept row: vec_id, code (two hex digits a part), error, and label_error, the
    errors' sum over equal labels (nulls together)."""
    found, books = encode(rows, vector)
    totals = found.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return (found.join(totals, found["label"].eqNullSafe(totals["of"]))
            .select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                    F.lit(digest(books)).alias("codebooks_sha256")))
