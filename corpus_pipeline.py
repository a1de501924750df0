"""A corpus pipeline of five stages over ``documents``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows that the next stage works on.  Each works on all rows that the
one before kept, and all but the last return the columns of ``documents``:

1. quality: the ordinal classifier drops documents that it rejects;
2. rules: compression bands and base rules drop documents that they reject;
3. near_dedup: the row of the smallest doc_id of every near-duplicate group stays;
   rows that share a doc_id but not a near-equal text stay apart;
4. mix: blocks of words drawn to the sources' target weights, put together
   again as documents (one row per document and pass);
5. encode: SentencePiece ids with an end id, and the text they decode to.

Null, empty and very long texts, repeated rows and empty tables take the defined
results of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import compression, minhash, mixing, ordinal, piece_merge
from tillflow.llm.common import staged, table

MODEL = "piece_bpe_32k.model"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labelled documents, keep what the classifier keeps."""
    found = ordinal.quality(docs, table(spark, sf_dir, "labels"), docs.columns)
    return found.filter("kept").select(docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the base rules and the compression bands."""
    return compression.judged(docs).filter("kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays, that of the smallest doc_id.

    Rows that share a doc_id and not a near-equal text are documents of their own.
    """
    return minhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to the sources' target weights, as documents."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the decoded text."""
    rows = piece_merge.encode(docs, public_tokenizers.path(MODEL), decoded="decoded", keep=["doc_id", "source"])
    return rows.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("rules", rules),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("encode", encode),
]

#: The stages fit models and hash texts; SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
