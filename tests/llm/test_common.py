import re
import zlib

import pyarrow as pa

from tillflow.llm import common

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_words_are_the_contract_runs():
    text = "A b\x0b c\x1cd e\tf\r\ng \x85h"
    assert [w.decode() for w in common.words_of(text.encode())] == re.findall(r"[^\x20\x09-\x0D]+", text)
    assert common.lower_words("ÀB İ".encode()) == ["Àb".encode(), "İ".encode()]


def test_small_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1100))], ["x"])
    parts = list(common.small([batch, batch.slice(0, 0), batch], 512))
    assert [p.num_rows for p in parts] == [512, 512, 76] * 2
    assert [x for p in parts for x in p.column("x").to_pylist()] == [*range(1100)] * 2


def test_word_table_stays_bounded():
    table = common.WordTable(len, limit=10)
    assert [table[b"x" * i] for i in range(40)] == list(range(40)) and len(table) <= 10


def test_arrow_batches_follow_the_session(spark):
    sizes = lambda: [r.n for r in common.arrow_map(spark.range(0, 2500, 1, 1), count, "n long").collect()]

    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])
    before = spark.conf.get(KEY, None)
    try:
        spark.conf.unset(KEY)
        assert max(sizes()) <= common.ARROW_ROWS
        spark.conf.set(KEY, "2000")
        assert max(sizes()) == 2000
    finally:
        spark.conf.set(KEY, before or str(common.ARROW_ROWS))


def test_fold_is_crc32_of_the_decimal_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 10**12, None)], "doc_id long").withColumn("f", common.fold("doc_id", 5)).collect()
    assert [r.f for r in rows] == [zlib.crc32(str(r.doc_id).encode()) % 5 if r.doc_id is not None else -1 for r in rows]
