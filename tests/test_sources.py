"""Sources: tolerant CSV, pipe files with preamble/trailer split in parts, XML."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from tillflow.sources import delimited as SD
from tillflow.sources import structured as SS


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_short_rows_padded_long_rows_dropped(spark):
    d = tempfile.mkdtemp(prefix="tf-csv-")
    _write(os.path.join(d, "a.csv"), 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n"x,y",z,w\n')
    rows = SD.scan_csv_header(spark, d).orderBy(F.col("_ord")).select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3"), ("4", "5", None), ("x,y", "z", "w")]


def test_pipe_preamble_and_trailer_over_many_splits(spark):
    d = tempfile.mkdtemp(prefix="tf-pipe-")
    head = "".join(f"HEADER {i}\n" for i in range(5))
    body = "".join(f"{i}|item {i}|{i * 2}\n" for i in range(3000))
    _write(os.path.join(d, "f1.txt"), head + body + "TOTAL|3000\n")
    _write(os.path.join(d, "f2.txt"), head + "7|seven|14\n" + "TOTAL|1\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 2   # the file is read in several splits
        df = SD.scan_lines_skipping(spark, d, 3, sep="|", skip_head=5, drop_last=True)
        rows = df.select("_c0").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = sorted(int(r._c0) for r in rows)
    assert got == sorted(list(range(3000)) + [7])


def test_xml_rows_missing_tag(spark):
    d = tempfile.mkdtemp(prefix="tf-xml-")
    _write(os.path.join(d, "s.xml"),
           "<NewDataSet><webtable><sku>1</sku><unitprice>9.99</unitprice></webtable>"
           "<webtable><sku>2</sku></webtable><other><sku>3</sku></other></NewDataSet>")
    rows = SS.scan_xml_rows(spark, d).orderBy("sku").select("sku", "unitprice").collect()
    assert [tuple(r) for r in rows] == [("1", "9.99"), ("2", None)]


def test_csv_binds_by_name_across_headers(spark):
    d = tempfile.mkdtemp(prefix="tf-csv-")
    _write(os.path.join(d, "a.csv"), "a,b,c\n1,2,3\n")
    _write(os.path.join(d, "b.csv"), "b,a\n20,10\n21,11,12\n")
    _write(os.path.join(d, "c.csv"), "\ufeffc,d\n30,NULL\n")
    rows = SD.scan_csv_header(spark, d).select("a", "b", "c", "d").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "2", "3", None), ("10", "20", None, None), (None, None, "30", None)]


def test_csv_quotes_line_ends_and_repeated_names(spark):
    d = tempfile.mkdtemp(prefix="tf-csv-")
    _write(os.path.join(d, "a.csv"), 'id,description,description\n1,"6"" PIZZA","two\nlines"\n2,N/A,"a,b"\n')
    rows = SD.scan_csv_header(spark, d).orderBy("id").select("id", "description", "description_2").collect()
    assert [tuple(r) for r in rows] == [("1", '6" PIZZA', "two\nlines"), ("2", None, "a,b")]


def test_edges_are_left_out_in_one_pass(spark):
    """One scan of the text, no exchange."""
    d = tempfile.mkdtemp(prefix="tf-pipe-")
    _write(os.path.join(d, "f.txt"), "".join(f"{i}|x\n" for i in range(100)))
    out = SD.drop_edge_lines(spark, d, 5, True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Window" not in plan
    assert out.count() == 94


def _dbf(spark, tmp, **files):
    from tillflow.sources import dbf
    for name, data in files.items():
        with open(os.path.join(tmp, name + ".dbf"), "wb") as fh:
            fh.write(data)
    return dbf.scan_dbf(spark, os.path.join(tmp, "*.dbf"))


def test_dbf_deleted_bad_and_merged_schemas(spark, monkeypatch):
    import datetime as dt

    from tillflow.sources import dbf
    monkeypatch.setattr(dbf, "RECORDS_PER_BATCH", 7)
    rows = [("A%d" % i, float(i), dt.datetime(2020, 1, 1 + i % 28)) for i in range(50)]
    data = bytearray(dbf.encode_table([("sku", "string"), ("qty", "double"), ("ts", "timestamp")], rows))
    n_rec, h_len, r_len, fields = dbf.read_header(bytes(data))
    assert n_rec == 50 and [f[0] for f in fields] == ["sku", "qty", "ts"]
    data[h_len + 3 * r_len:h_len + 3 * r_len + 1] = b"*"                      # deleted
    data[h_len + 4 * r_len + 255:h_len + 4 * r_len + 279] = b"12x".rjust(24)  # a bad number
    second = dbf.encode_table([("sku", "string"), ("extra", "string")], [("B", "only here")])
    got = {r.sku: r for r in _dbf(spark, tempfile.mkdtemp(prefix="tf-dbf-"), a=bytes(data), b=second).collect()}
    assert len(got) == 50 and "A3" not in got
    assert got["A4"].qty is None and got["A4"]._invalid == "qty=12x" and got["A10"].qty == 10.0
    assert got["A10"].ts == dt.datetime(2020, 1, 11) and got["B"].extra == "only here" and got["A1"].extra is None


def test_dbf_fields_of_every_kind():
    import datetime as dt
    import struct

    import numpy as np

    from tillflow.sources import dbf

    def read(kind, *cells):
        values, bad = dbf.field(np.frombuffer(b"".join(cells), np.uint8).reshape(len(cells), -1), kind, "latin-1")
        return values.to_pylist(), bad.tolist() if bad is not None else None
    assert read("I", *(struct.pack("<i", n) for n in (0, 32, -5, 2**31 - 1))) == ([0, 32, -5, 2**31 - 1], None)
    assert read("B", struct.pack("<d", 2.5)) == ([2.5], None)
    assert read("Y", struct.pack("<q", 123_456)) == ([12.3456], None)
    assert read("T", struct.pack("<ii", 2451545, 3_600_000), struct.pack("<ii", 0, 0)) == ([dt.datetime(2000, 1, 1, 1), None], None)
    assert read("L", b"?", b"y", b"N", b" ") == ([None, True, False, None], None)
    assert read("N", b"   ", b"1.5", b"***", b"-2 ", b" .5") == ([None, 1.5, None, -2.0, 0.5], None)
    assert read("N", b"12x", b" 1_", b"nan") == ([None] * 3, ["12x", "1_", "nan"])
    assert read("D", b"20240131", b"20230229", b"2024    ", b"        ") == (
        [dt.datetime(2024, 1, 31), None, None, None], ["", "20230229", "2024", ""])
    assert read("C", b"a\xe9  ", b"\x00\x00\x00\x00", b" b c") == (["a\xe9", "", " b c"], None)


def test_dbf_ranges_equal_the_whole_read(spark, monkeypatch):
    """Many partitions a file, pruned columns, no read of a whole file."""
    from tillflow.sources import dbf, files
    tmp = tempfile.mkdtemp(prefix="tf dbf-")
    os.makedirs(os.path.join(tmp, "r1", "0"))
    rows = [("A%d" % i, float(i), "text %d" % i) for i in range(5000)]
    content = dbf.encode_table([("sku", "string"), ("qty", "double"), ("note", "string")], rows)
    with open(os.path.join(tmp, "r1", "0", "x.DBF"), "wb") as fh:
        fh.write(content)
    parts = dbf.scan_dbf(spark, tmp, records_per_partition=700)
    assert parts.rdd.getNumPartitions() == 8
    whole = dbf.decode_files(spark.createDataFrame([("x", content)], "path string, content binary"))
    cols = ["sku", "qty", "note", "_record", "_invalid"]
    assert sorted(map(tuple, parts.select(cols).collect())) == sorted(map(tuple, whole.select(cols).collect()))
    assert [r.sku for r in parts.orderBy("_ord").select("sku").limit(3).collect()] == ["A0", "A1", "A2"]
    few = dbf.scan_dbf(spark, os.path.join(tmp, "*", "0"), columns=["QTY"])
    assert few.columns == ["qty", "_invalid", "_file_path", "_file_name", "_record", "_ord"] and few.agg({"qty": "sum"}).first()[0] == sum(range(5000))
    sizes = []
    plain = files.read_range
    monkeypatch.setattr(files, "read_range", lambda p, s, n, **k: sizes.append(n) or plain(p, s, n, **k))
    source = dbf.DbfSource({"path": tmp, "recordsPerPartition": "700"})
    reader = source.reader(spark.createDataFrame([], "sku string, _record long").schema)
    ranges = reader.partitions()
    assert sum(b.num_rows for r in ranges[2:4] for b in reader.read(r)) == 1400
    assert max(sizes) <= max(dbf.HEADER, 700 * ranges[0].header[2])
    big = reader.read(dbf.Range("missing", (10**9, 33, 600, ranges[0].header[3]), 5_000_000, 10))  # beyond 2 GB: only an offset
    try:
        next(big)
    except Exception as e:
        assert "missing" in str(e)


def test_small_dbf_files_share_tasks(spark):
    from tillflow.sources import dbf
    tmp = tempfile.mkdtemp(prefix="tfdbf-")
    for i in range(60):
        os.makedirs(os.path.join(tmp, f"r{i}"))
        with open(os.path.join(tmp, f"r{i}", "x.dbf"), "wb") as fh:
            fh.write(dbf.encode_table([("sku", "string")], [(f"{i}-{n}",) for n in range(i % 4)]))
    rows = dbf.scan_dbf(spark, tmp, records_per_partition=1000)
    assert rows.rdd.getNumPartitions() == 1
    assert sorted((r.sku, r._record) for r in rows.collect()) == sorted((f"{i}-{n}", n) for i in range(60) for n in range(i % 4))


def test_truncated_dbf_ends_the_job(spark):
    import pytest

    from tillflow.sources import dbf
    data = dbf.encode_table([("sku", "string")], [("a",), ("b",)])
    with pytest.raises(Exception, match="fewer records"):
        _dbf(spark, tempfile.mkdtemp(prefix="tf-dbf-"), a=data[:-200]).collect()


def test_archives_of_equal_names_stay_apart(spark):
    import zipfile

    from tillflow.sources import archive as A

    d = tempfile.mkdtemp(prefix="tf-zip-")
    for folder, header, val in (("r1", "CODE_NUM,BARCODE", "1,11"), ("r2", "BARCODE,CODE_NUM", "22,2")):
        os.makedirs(os.path.join(d, folder))
        with zipfile.ZipFile(os.path.join(d, folder, "export.zip"), "w") as z:
            z.writestr("sub/BARCODES.csv", f'{header}\n{val}\n"quoted\nline",x,too long\n')
            z.writestr("BARCODES.csv", f"{header}\n{val}\n")
            z.writestr("notes.txt", "ignored")
            z.writestr("invoices.csv", "a\n1\n")
    rows = A.expand_archives(A.archive_files(spark, os.path.join(d, "*", "*.zip"))).cache()
    assert sorted((m.archive.split("/")[-2], m.member, m.records) for m in A.manifest(rows).collect()) == [
        ("r1", "BARCODES.csv", 1), ("r1", "sub/BARCODES.csv", 2), ("r2", "BARCODES.csv", 1), ("r2", "sub/BARCODES.csv", 2)]
    bar = A.member_rows(rows, "barcodes").collect()
    assert sorted((r.archive.split("/")[-2], r.CODE_NUM, r.BARCODE) for r in bar) == [
        ("r1", "1", "11"), ("r1", "1", "11"), ("r2", "2", "22"), ("r2", "2", "22")]


def test_archive_records_find_their_columns_without_a_shuffle(spark):
    """Archives in file order, a member per role even where it has no row; as many header rows as there are headers."""
    from tillflow.plans import landing as L
    from tillflow.sources import archive as A
    inv = spark.createDataFrame([("r1", 0, (2, "b"), "s2", None), ("r1", 0, (1, "a"), "s1", 'x,"y'), ("r2", 1, (1, "a"), "s3", "n\nm")],
                                "retailer_id string, _part long, _ord struct<n:int,t:string>, SKU string, NAME string")
    upc = spark.createDataFrame([("r1", 0, 5, "s1", "u"), ("r1", 0, 4, "s1", "v")], "retailer_id string, _part long, _ord int, SKU string, UPC string")
    rows = A.stored(A.expand_archives(L.land_zip_members(spark, {"inv.csv": inv, "readme.csv": inv, "upc.csv": upc}, "zips")))
    got = A.member_rows(rows, "inv").orderBy("_ord")
    assert [(r.archive, r.SKU, r.NAME) for r in got.collect()] == [
        ("r1/000000000000/export.zip", "s1", 'x,"y'), ("r1/000000000000/export.zip", "s2", None), ("r2/000000000001/export.zip", "s3", "n\nm")]
    assert [r.UPC for r in A.member_rows(rows, "upc").orderBy("_ord").collect()] == ["v", "u"]
    assert rows.where("role = 'upc' AND pos = 0").count() == 2 and rows.where("role IS NULL").count() == 0
    assert "SortMergeJoin" not in A.member_rows(rows, "inv")._jdf.queryExecution().executedPlan().toString()
    assert rows.where("role = 'inv'").select("layout").distinct().count() == 1


def test_landed_xml_is_small_and_reads_back(spark):
    """A row a line, packed; texts that XML escapes, nulls and part files come back as they were."""
    import glob
    import gzip
    from tillflow.plans import landing as L
    from tillflow.sources import structured
    path = tempfile.mkdtemp(prefix="tf-xml-") + "/x"
    names = ["a", "a & <b> \"c\"", "d'e]]>", "Größe", None, "", "x\ty"]
    rows = [(r, i, n, "T" if i % 2 else None) for r in ("1", "a/b") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "retailer_id string, _ord int, sku string, onsale string")
    L.land_xml(spark, df, "x", path=path, packed=True)
    files = glob.glob(path + "/*/*.xml.gz")
    text = b"".join(gzip.open(f).read() for f in files).decode()
    assert files and "<webtable><sku>a</sku></webtable>\n" in text
    got = L.retailer_from_path(structured.scan_xml_rows(spark, path, tags=["sku", "onsale"]))
    want = sorted((r, n, o) for r, _, n, o in rows if n)
    assert sorted((r.retailer_id, r.sku, r.onsale) for r in got.where("sku != ''").collect()) == want
    assert got.count() == len(rows)


def test_a_dbase_texts_field_is_as_wide_as_its_longest_text():
    from tillflow.sources import dbf
    rows = [("é" * 3, 1, None), (None, 2.5, "x" * 300), ("", None, "yz")]
    data = dbf.encode_table([("a", "string"), ("n", "double"), ("b", "string")], rows, narrow=True)
    n, start, record, fields = dbf.read_header(data)
    assert (n, [f[2] for f in fields]) == (3, [3, 24, 254]) and len(data) == start + 3 * record + 1
    columns, bad, _ = dbf.decode(data[start:-1], fields, 0, [("a", "string"), ("n", "double"), ("b", "string")], "latin-1")
    assert [c.to_pylist() for c in columns] == [["ééé", "", ""], [1.0, 2.5, None], ["", "x" * 254, "yz"]] and bad == [None] * 3
    assert [f[2] for f in dbf.read_header(dbf.encode_table([("a", "string")], [(None,)], narrow=True))[3]] == [1]
    assert [f[2] for f in dbf.read_header(dbf.encode_table([("a", "string")], [], narrow=True))[3]] == [1]


def test_landed_archives_and_tables_in_passes_are_those_of_one(spark):
    import io
    import zipfile
    from tillflow.plans import landing as L
    rows = [(r, p, o, f"{r}{o}") for r in ("1", "2", "x") for p in (0, 1) for o in range(4)]
    df = spark.createDataFrame(rows, "retailer_id string, _part long, _ord long, name string")
    texts = lambda d: sorted((r["path"], zipfile.ZipFile(io.BytesIO(r["content"])).read("inv.csv")) for r in d.collect())
    one, three = (texts(L.land_zip_members(spark, {"inv.csv": df}, "zips", n)) for n in (1, 3))
    assert one == three and len(one) == 6
    one, three = (sorted((r["path"], bytes(r["content"])) for r in L.land_dbf(spark, df, "t", "inv", n).collect()) for n in (1, 3))
    assert one == three and len(one) == 6


def test_only_the_roles_members_are_unpacked_and_have_a_schema(spark):
    import io
    import zipfile
    from tillflow.sources import archive as A
    from tillflow.sources import dbf
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("inv.dbf", dbf.encode_table([("sku", "string")], [("1",)]))
        z.writestr("prc.dbf", dbf.encode_table([("sku", "string"), ("price", "double")], [("1", 2.0)]))
        z.writestr("readme.dbf", b"no table")
    zips = spark.createDataFrame([("a.zip", out.getvalue())], "path string, content binary")
    assert [r["path"] for r in A.member_files(zips, roles=("prc",)).collect()] == ["a.zip!/prc.dbf"]
    assert dbf.schemas_of(A.member_files(zips, roles=("inv", "prc", "stk")), ("inv", "prc", "stk")) == {
        "inv": [("sku", "string")], "prc": [("sku", "string"), ("price", "double")], "stk": []}


def test_steps_run_together_and_keep_their_order(spark):
    import threading
    from tillflow.session import together
    met = threading.Barrier(3, timeout=60)

    def step(i):
        met.wait()              # all three are under way at once
        return spark.range(i).count()
    assert together(spark, [lambda i=i: step(i) for i in (3, 1, 2)]) == [3, 1, 2]
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1, lambda: 1 // 0])
