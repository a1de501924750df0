"""Helpers shared by the operators: words, word tables, staged tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import shared_dir

#: A word is a maximal run of bytes that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text; ``bytes.split()`` cuts at exactly x20 and x09-x0D."""
    return text.split()


def lower_words(text: bytes) -> list[bytes]:
    """Words after lower-casing A-Z only (``bytes.lower`` leaves UTF-8 alone)."""
    return text.lower().split()


#: Rows of an Arrow batch where the session sets none: whole texts are long, and
#: what the JVM holds outside its heap grows with the batch.
ARROW_ROWS = 1000


def arrow_map(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow`` with batches of few rows."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(task, schema)


def small(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices: what a task holds as Python objects stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as the empty text."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


class WordTable(dict):
    """Per-task memo of a function of a word, emptied when it holds ``limit``
    words so that a worker's memory stays bounded."""

    def __init__(self, fn, limit: int = 200_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.fn(word)
        return value


def word_hasher(seed: int = 0) -> WordTable:
    return WordTable(lambda w: xxhash.xxh64_intdigest(w, seed))


def hashes(table: WordTable, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder of the cluster's shared directory and read it
    back: cuts the lineage, survives lost executors, fixes the rows for every
    later use."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str, *by: str) -> tuple[DataFrame, str]:
    """As ``staged``, in partitions by ``by`` if given; the folder's path comes too, for ``deleted``."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def deleted(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that a committed successor replaces."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id, n: int):
    """crc32 of doc_id written as text, modulo n (null: -1, never a match)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n, F.lit(-1))
