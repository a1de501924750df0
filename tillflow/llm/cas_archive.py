"""Content-addressed WARC archive.

``records`` renders one WARC/1.1 record per page: exact header bytes and the
payload.  Of records whose payloads are equal and at least ``MIN_SHARED`` bytes
long, that with the smallest page_id is a ``response``; the others are
``revisit`` records that name it.  ``store`` keeps headers and payloads apart:
a payload's bytes are stored once under their SHA-256, and a digest is only
accepted if all records that name it agree on length and a second, independent
checksum.  ``restore`` joins both tables and gives back every original record,
byte for byte; ``read`` parses the bytes, checks length and digest, and fails
on any mismatch.

A payload moves once from each task that holds it (``first`` is partially
aggregated); the join back deals narrow header rows, which adaptive execution
splits where one payload is very frequent.

Defined cases: null html is the empty payload; a null page_id is written as an
empty id and orders after all others; of rows that repeat the smallest page_id
each is a response; a null url has no target line and is read as null, one with
line breaks is written percent-encoded under a marking field and read back as it
was; empty tables give empty archives; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import shared_dir

from .common import arrow_map, small

MIN_SHARED = 100
CRLF = "\r\n"
ESCAPED = "X-Target-URI-Escaped"
ESCAPES = ("%", "%25"), ("\r", "%0D"), ("\n", "%0A")


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables of a store."""

    headers: str
    payloads: str


def records(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html",
            min_shared: int = MIN_SHARED) -> DataFrame:
    """``page_id, digest, header, payload, check``: a WARC record for each row."""
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(uri).alias("uri"), body.alias("payload"),
                        F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("bytes"),
                        F.xxhash64(body).alias("check"))
    firsts = rows.filter(F.col("bytes") >= min_shared).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    rows = rows.join(firsts, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def record_id(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))

    # a line break in a URL would end the header line: such URLs, and only these, are escaped and marked
    broken = F.coalesce(F.col("uri").rlike(r"[\r\n]"), F.lit(False))
    escaped = F.col("uri")
    for plain, code in ESCAPES:
        escaped = F.replace(escaped, F.lit(plain), F.lit(code))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        F.when(F.col("uri").isNull(), F.lit("")).otherwise(
            line("WARC-Target-URI", F.when(broken, escaped).otherwise(F.col("uri")))),
        F.when(broken, line(ESCAPED, F.lit("yes"))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(revisit, line("WARC-Refers-To", record_id(F.col("first_id")))).otherwise(F.lit("")),
        line("Content-Length", F.col("bytes").cast("string")),
        F.lit(CRLF))
    return rows.select("page_id", "digest", header.cast("binary").alias("header"), "payload", "check")


def store(rows: DataFrame, path: str | None = None) -> Archive:
    """Write the two tables; raises if two payloads share a digest."""
    spark = rows.sparkSession
    path = path or shared_dir(spark, "llm", "archive")
    out = Archive(f"{path}/headers", f"{path}/payloads")
    rows.select("page_id", "digest", "header").write.parquet(out.headers)
    (rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("check").alias("lo"),
                                F.max("check").alias("hi"))
     .select("digest", F.when(F.col("lo") == F.col("hi"), F.col("payload")).otherwise(
         F.raise_error(F.concat(F.lit("two payloads under digest "), F.col("digest"))).cast("binary")).alias("payload"))
     .write.parquet(out.payloads))
    return out


def restore(spark: SparkSession, archive: Archive) -> DataFrame:
    """``page_id, record``: the original records, header + payload + two line ends.
    A header whose payload is missing gives a null record, which ``read`` refuses."""
    headers, payloads = spark.read.parquet(archive.headers), spark.read.parquet(archive.payloads)
    return (headers.join(payloads, "digest", "left")
            .select("page_id", F.concat("header", "payload", F.lit(CRLF * 2).cast("binary")).alias("record")))


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record; raises on any damage."""
    head, found, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or not lines[0].startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = dict(x.decode("utf-8").split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    payload = rest[:size]
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']}: length differs from its header")
    if "sha256:" + hashlib.sha256(payload).hexdigest() != fields["WARC-Payload-Digest"]:
        raise ValueError(f"{fields['WARC-Record-ID']}: payload differs from its digest")
    return fields, payload


def _uri(fields: dict[str, str]) -> str | None:
    uri = fields.get("WARC-Target-URI")
    if ESCAPED in fields:
        for plain, code in reversed(ESCAPES):
            uri = uri.replace(code, plain)
    return uri


def _page(record_id: str) -> int | None:
    number = record_id[len("<urn:page:"):-1]
    return int(number) if number else None


def read(restored: DataFrame) -> DataFrame:
    """Parsed records: page_id, uri, payload_bytes, payload_digest, record_type, refers_to, payload."""

    def task(batches):
        for batch in small(batches):
            out = [[] for _ in range(7)]
            for raw in batch.column("record").to_pylist():
                if raw is None:
                    raise ValueError("a record's payload is missing from the archive")
                fields, payload = parse(raw)
                refers = fields.get("WARC-Refers-To")
                row = (_page(fields["WARC-Record-ID"]), _uri(fields), len(payload),
                       fields["WARC-Payload-Digest"][7:], fields["WARC-Type"], _page(refers) if refers else None, payload)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], NAMES)

    return arrow_map(
        restored.select("record"), task, "page_id long, uri string, payload_bytes long, payload_digest string, record_type string, "
              "refers_to long, payload binary")


NAMES = ["page_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
