import hashlib

import pytest

from tillflow.llm import cas_archive

SCHEMA = "page_id long, url string, html string, digest string"
BIG = "<p>" + "same body " * 30
ROWS = [(9, "http://a/9", BIG, "x"), (3, "http://a/3", BIG, None), (5, "http://a/5", BIG, None), (3, "http://a/3", BIG, None),
        (1, "http://a/1", "small", None), (2, "http://a/2", "small", None), (4, None, None, None), (6, "u\r\nX: y", "", None),
        (7, "http://é", "é\r\n\r\nWARC/1.1\r\n" * 20, None), (8, "v", "long " * 200_000, None), (None, "n", BIG, None),
        (None, "n", "t" * 99, None), (10, "e", "t" * 100, None), (11, "e", "t" * 100, None)]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    records = cas_archive.records(pages)
    archive = cas_archive.store(records)
    restored = cas_archive.restore(spark, archive)
    original = sorted(bytes(r.header) + bytes(r.payload) + b"\r\n\r\n" for r in records.collect())
    assert sorted(bytes(r.record) for r in restored.collect()) == original
    got = cas_archive.read(restored).collect()
    first = {}
    for i, _, h, _ in ROWS:
        if len((h or "").encode()) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h, _ in ROWS:
        body = (h or "").encode()
        at = first.get(h or "")
        revisit = at is not None and at != i
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                     at if revisit else None, body))
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload))
                  for r in got) == sorted(want, key=lambda w: (w[0], w[1], w[2], w[3], w[4] or 0))
    payloads = spark.read.parquet(archive.payloads)
    assert payloads.count() == len({h or "" for _, _, h, _ in ROWS})


def test_damage_is_found(spark):
    record = bytes(cas_archive.records(spark.createDataFrame(ROWS[:1], SCHEMA)).select("header").first()[0])
    body = BIG.encode()
    assert cas_archive.parse(record + body + b"\r\n\r\n")[1] == body
    for bad in (b"", record + body, record + body[:-1] + b"!\r\n\r\n", record + body[:-1] + b"\r\n\r\n", b"x" + record):
        with pytest.raises(ValueError):
            cas_archive.parse(bad)


def test_one_digest_two_payloads_is_refused(spark):
    rows = spark.createDataFrame([(1, "d", bytearray(b"h"), bytearray(b"a"), 1), (2, "d", bytearray(b"h"), bytearray(b"b"), 2)],
                                 "page_id long, digest string, header binary, payload binary, check long")
    with pytest.raises(Exception, match="two payloads"):
        cas_archive.store(rows)


def test_missing_payload_is_refused(spark):
    archive = cas_archive.store(cas_archive.records(spark.createDataFrame(ROWS, SCHEMA)))
    other = cas_archive.store(cas_archive.records(spark.createDataFrame(ROWS[:1], SCHEMA)))
    mixed = cas_archive.Archive(archive.headers, other.payloads)
    with pytest.raises(Exception, match="missing"):
        cas_archive.read(cas_archive.restore(spark, mixed)).collect()


def test_empty(spark):
    archive = cas_archive.store(cas_archive.records(spark.createDataFrame([], SCHEMA)))
    assert cas_archive.read(cas_archive.restore(spark, archive)).collect() == []


def test_urls_come_back_as_they_were(spark):
    urls = ["http://a/%0A?x=%20", "a\r\nb", "\n\n%0A%25", "", None, "plain", "é %\r", "x: y: z"]
    pages = spark.createDataFrame([(i, u, "body", None) for i, u in enumerate(urls)], SCHEMA)
    archive = cas_archive.store(cas_archive.records(pages))
    got = {r.page_id: r.uri for r in cas_archive.read(cas_archive.restore(spark, archive)).collect()}
    assert got == dict(enumerate(urls))
    headers = {r.page_id: bytes(r.header) for r in spark.read.parquet(archive.headers).collect()}
    assert b"WARC-Target-URI: http://a/%0A?x=%20\r\n" in headers[0] and cas_archive.ESCAPED.encode() not in headers[0]
    assert b"WARC-Target-URI: a%0D%0Ab\r\n" in headers[1]
