"""Hashed text features and bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, small, staged, texts_of

#: Bounds of what a classifier is fitted on: labelled rows, and feature entries of all of them.
MAX_ROWS, MAX_ENTRIES = 12_000, 12_000_000

_EDGE = re.compile(r"^\W+|\W+$")


def bare(word: bytes) -> str:
    """A lower-cased word without punctuation at its ends."""
    return _EDGE.sub("", word.decode("utf-8", "replace").lower())


def slot(name: str, bits: int) -> int:
    return xxhash.xxh64_intdigest(name.encode("utf-8"), 41) >> (64 - bits)


def chosen(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled rows, those of least hash of doc_id."""
    return (labels.withColumn("_h", F.xxhash64("doc_id")).orderBy("_h", *sorted(labels.columns))
            .limit(max_rows).drop("_h"))


def collected(docs: DataFrame, labels: DataFrame, features: Callable[[], Callable[[bytes], tuple]],
              max_rows: int = MAX_ROWS, max_entries: int = MAX_ENTRIES) -> list[tuple]:
    """(doc_id, label, feature arrays ...) of the sample, for the driver.

    ``labels``: doc_id and ``label``.  Rows beyond ``max_entries`` feature
    entries are left out in hash order, so the driver's memory is bounded even
    if every labelled text is very long.  ``features()`` makes, on a worker, a
    function of a text that returns numpy arrays (the first gives the length).
    """
    few = chosen(labels.filter("doc_id is not null and label is not null").select("doc_id", "label"), max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")  # at most max_rows narrow rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = features()
        for batch in small(batches):
            out = [made(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([len(o[0]) for o in out], pa.int64()),
                 pa.array([[a.tobytes() for a in o] for o in out], pa.list_(pa.binary()))], ["doc_id", "label", "n", "parts"])

    made = arrow_map(rows, task, "doc_id long, label int, n long, parts array<binary>")
    made = staged(made, "sample")
    sizes = made.select("doc_id", "n", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id", "n").limit(max_rows).collect()
    total, last = 0, None
    for r in sizes:
        total += r["n"]
        if total > max_entries:
            break
        last = r["h"]
    if last is None:
        return []
    kept = made.filter(F.xxhash64("doc_id") <= last).limit(max_rows).collect()
    kept.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["doc_id"]).encode()), r["label"], r["parts"]))
    return [(r["doc_id"], r["label"], *r["parts"]) for r in kept]


def scored(docs: DataFrame, keep: list[str], result: dict[str, str], scorer: Callable[[], Callable[[bytes], tuple]],
           text: str = "text") -> DataFrame:
    """The columns ``keep`` and the scorer's results (all double or int) of every text."""
    keep = [c for c in keep if c not in result]
    schema = docs.select(*keep, *[F.lit(None).cast(t).alias(c) for c, t in result.items()]).schema
    kinds = [{"double": pa.float64(), "int": pa.int32(), "boolean": pa.bool_()}[t] for t in result.values()]

    def task(batches):
        score = scorer()
        for batch in small(batches):
            out = [score(t) for t in texts_of(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [
                pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], [*keep, *result])

    return arrow_map(docs.select(*dict.fromkeys([*keep, text])), task, schema)


def shipped(spark: SparkSession, value):
    """A broadcast of a model of fixed size."""
    return spark.sparkContext.broadcast(value)
