"""Records that cross lines and splits, headers by ranged reads, file helpers."""

import csv
import gzip
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from tillflow.sources import delimited as SD
from tillflow.sources import files
from tillflow.sources import records as R


@pytest.fixture
def splits(spark):
    """Sets the size at which files are split; -1 ends it."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")

    def cut(n):
        for k, v in zip(keys, (n, 0, 1)):
            spark.conf.set(k, str(v)) if n > 0 else spark.conf.unset(k)
    yield cut
    cut(-1)


def _file(data: bytes, name="f.csv", folder=None):
    folder = folder or tempfile.mkdtemp(prefix="tf rec%20-")
    with open(os.path.join(folder, name), "wb") as fh:
        fh.write(data)
    return folder


TEXT = ('id,name,note\n1,"two\nlines",x\n2,"a ""quoted"" word",6" PIZZA\n3,"long\n\n\ncell, with ""q"" and\r\nmore",y\n'
        '4,plain,"\n"\n5,"",""\n6,x"y,z\n\n7,"é\n日本",ok\n8,9\n10,"last\none",end')


def one_task(data: str):
    """What a reader that sees the whole file makes of it."""
    rows = [r for r in csv.reader(io.StringIO(data.replace("\r\n", "\n"), newline="")) if r]
    return [tuple((c or None) for c in (r + [None] * 3)[:3]) for r in rows]


@pytest.mark.parametrize("size", [9, 10_000])
def test_quoted_line_ends_in_files_cut_anywhere(spark, splits, size):
    folder = _file(TEXT.encode())
    want = one_task(TEXT)
    assert want[0] == ("id", "name", "note") and len(want) == 10
    splits(size)
    rows = SD.scan_positional(spark, folder, 3, sep=",", null_text=False).orderBy("_ord").collect()
    assert [(r._c0, r._c1, r._c2) for r in rows] == want
    rows = SD.scan_csv_header(spark, folder, null_text=False).orderBy("_ord").collect()
    assert [(r.id, r.name, r.note) for r in rows] == want[1:]


def test_many_tasks_read_one_file(spark, splits):
    rng = random.Random(2)
    cell = lambda: rng.choice(["a", 'say ""hi""', "x\ny", "b\n\n\nc" * 30, "", "d" * 200])
    body = "".join(f'{i},"{cell()}",{i}\n' for i in range(1500))
    folder = _file(("k,t,n\n" + body).encode())
    _file(b"t,k\nz,9999\n", "g.csv", folder)
    splits(8192)
    assert spark.read.text(folder).rdd.getNumPartitions() > 10
    df = SD.scan_csv_header(spark, folder, null_text=False)
    got = {r.k: (r.t, r.n) for r in df.collect()}
    want = {r[0]: (r[1] or None, r[2]) for r in csv.reader(io.StringIO(body))}
    assert got == want | {"9999": ("z", None)}
    order = [int(r.k) for r in df.where("n is not null").orderBy("_ord").select("k").collect()]
    assert order == list(range(1500))


def test_plain_files_stay_with_the_native_reader(spark):
    folder = _file(b'a,b\n1,"x, y"\n2,5" pipe\n')
    plan = SD.scan_csv_header(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "FileScan csv" in plan
    assert "MapInArrow" in SD.scan_csv_header(spark, _file(b'a,b\n1,"x\ny"\n'))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [40, 10_000])
def test_preamble_and_trailer_with_quotes(spark, splits, size):
    """Quotes of a preamble mean nothing; a quoted line end in a pipe file stays in its cell."""
    folder = _file(b'HEAD "one\nHEAD two"\n1|"a\nb"|c\n2|x|y\n3|"z\n"|w\nTOTAL|"3\n')
    _file(b'HEAD "one\nHEAD "\n9|k|\n\nTOTAL|1', "g.txt", folder)
    splits(size)
    rows = SD.scan_lines_skipping(spark, folder, 3, skip_head=2, drop_last=True).orderBy("_ord").collect()
    assert [(r._c0, r._c1, r._c2) for r in rows] == [("1", "a\nb", "c"), ("2", "x", "y"), ("3", "z\n", "w"), ("9", "k", None)]
    lines = SD.drop_edge_lines(spark, folder, 2, True).where(F.col("_file_name") == "f.csv").orderBy("_ord").collect()
    assert [r.value for r in lines] == ['1|"a', 'b"|c', "2|x|y", '3|"z', '"|w']


def test_gzip_encodings_and_a_cell_that_never_ends(spark, monkeypatch):
    folder = _file(gzip.compress(b'a,b\n1,"x\ny"\n2,z\n'), "f.csv.gz")
    assert sorted((r.a, r.b) for r in SD.scan_csv_header(spark, folder).collect()) == [("1", "x\ny"), ("2", "z")]
    folder = _file('a,b\n1,"café\nñ"\n2,é\n'.encode("latin-1"))
    assert sorted((r.a, r.b) for r in SD.scan_csv_header(spark, folder, encoding="ISO-8859-1").collect()) == [("1", "café\nñ"), ("2", "é")]
    rows = SD.scan_csv_header(spark, _file(b'a,b\n1,x\n2,"open\n3,y\n')).orderBy("_ord").collect()
    assert [(r.a, r.b) for r in rows][0] == ("1", "x") and len(rows) == 2  # the last cell takes the rest


def test_headers_cost_one_small_read(spark, monkeypatch):
    """However long a file is, its header is read in one step; any number of layouts binds."""
    long = _file(b'"id","two\nlines",id\n' + b"1,2,3\n" * 200_000)
    read = []
    plain = files.blocks

    def counted(path, start=0, step=files.STEP, encoded=True):
        for block in plain(path, start, step, encoded):
            read.append(len(block))
            yield block
    monkeypatch.setattr(files, "blocks", counted)
    assert next(files.lines(os.path.join(long, "f.csv"))) == b'"id","two' and read == [files.STEP]
    assert [r["names"] for r in R.first_records(spark, long, ",").collect()] == [["id", "two\nlines", "id"]]
    assert SD.header_names(spark, long) == ["id", "two\nlines", "id_2"]
    folder = tempfile.mkdtemp(prefix="tf-lay-")
    for i in range(200):
        _file(f"x{i % 40},K,y{i % 31}\n{i},k{i},{i}\n".encode(), f"{i}.csv", folder)
    rows = SD.scan_csv_header(spark, folder)
    assert len(rows.columns) == 40 + 1 + 31 + 3
    got = {r.K: r for r in rows.collect()}
    assert len(got) == 200 and got["k177"][f"x{177 % 40}"] == "177" == got["k177"][f"y{177 % 31}"] and got["k177"].y0 is None


def test_a_store_without_ranged_reads(spark, monkeypatch):
    """Headers and quoted line ends are read by Spark's own readers then."""
    folder = _file(b'\xef\xbb\xbfa,b\n1,"x\ny"\n2,z\n')
    _file(b"b,a\nq,3\n", "g.csv", folder)

    def unknown(path, encoded=True):
        raise ValueError("Unrecognized filesystem type in URI")
    monkeypatch.setattr(files, "locate", unknown)
    rows = SD.scan_csv_header(spark, folder)
    assert "MapInArrow" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", "x\ny"), ("2", "z"), ("3", "q")]


def test_header_names_that_differ_in_case(spark):
    folder = _file(b"SKU,Name\n1,a\n")
    _file(b"name,sku\nb,2\n", "g.csv", folder)
    assert sorted((r.SKU, r.name) for r in SD.scan_csv_header(spark, folder).collect()) == [("1", "a"), ("2", "b")]


def test_state_of_a_line():
    for line, inside, want in ((b'a,"b', False, True), (b'a,"b""', False, True), (b'a,"b"', False, False), (b'a,6" x', False, False),
                               (b'x",y', True, False), (b'x"",y', True, True), (b'x","', True, True), (b"", True, True), (b'"', False, True),
                               (b'"a"b"c,"', False, True), (b'""', False, False), (b'a|"b', False, False)):
        assert R.ends_open(line, inside, b",") is want, line


def test_file_helpers():
    folder = tempfile.mkdtemp(prefix="tf fs%2B-")
    path = os.path.join(folder, "a b%20c.txt")
    for data in (b"", b"one", b"one\n", b"one\r\ntwo\rthree\n\nfive", b"x" * 70_000 + b"\r\n" + b"y" * 70_000 + b"\n"):
        with open(path, "wb") as fh:
            fh.write(data)
        for step in (1, 2, 3, 1 << 16):
            if len(data) < 1000 or step > 1000:
                assert list(files.lines(path, 0, step)) == data.splitlines()
                start = files.last_line_start(path, len(data), step)
                assert data[start:].splitlines() == data.splitlines()[-1:]
    uri = "file://" + folder.replace("%", "%25").replace(" ", "%20") + "/a%20b%2520c.txt"
    assert files.read_range(uri, 69_999, 4) == b"x\r\ny" and files.read_range("file:" + path, 0, 2, encoded=False) == b"xx"
    os.makedirs(os.path.join(folder, "sub=1"))
    for n in ("sub=1/t.DBF", "u.dbf", "_hidden.dbf", ".x.dbf"):
        with open(os.path.join(folder, n), "wb") as fh:
            fh.write(b"123")
    assert files.listed(folder, ".dbf") == [(os.path.join(folder, "sub=1/t.DBF"), 3), (os.path.join(folder, "u.dbf"), 3)]
    assert files.listed("file://" + folder + "/*/*.DBF", ".dbf") == [("file://" + folder + "/sub=1/t.DBF", 3)]
    assert files.listed(os.path.join(folder, "u.dbf"), ".dbf") == [(os.path.join(folder, "u.dbf"), 3)]


def test_many_files_with_trailers_are_few_batches(spark):
    """Rows behind a held-back line go on in batches, not one by one."""
    folder = tempfile.mkdtemp(prefix="tf trail-")
    for i in range(5):
        _file(b"HEAD\n" + b"".join(b"%d|%d\n" % (i, n) for n in range(200)) + b"TOTAL|200\n", f"f{i}.txt", folder)
    rows = SD.drop_edge_lines(spark, folder, skip_head=1, drop_last=True)
    assert sorted(r.value for r in rows.collect()) == sorted(f"{i}|{n}" for i in range(5) for n in range(200))
    taken = {}

    class Caught(Exception):
        pass

    class Lines:
        """The frame's columns, and the task that ``records`` gives to it."""
        columns = ["value", R.PATH, R.BLOCK, R.MONO, R.LENGTH, R.SIZE, "_inside"]
        schema = spark.createDataFrame([], f"value binary, {R.PATH} string, {R.BLOCK} long, {R.MONO} long").schema

        def withColumn(self, *_):
            return self

        def mapInArrow(self, task, *_):
            taken["task"] = task
            raise Caught

    with pytest.raises(Caught):
        R.records(Lines(), "", skip_lines=1, drop_last=True, quoted=False)
    import pyarrow as pa
    n = 300
    batch = pa.RecordBatch.from_arrays(
        [pa.array([b"x"] * n, pa.binary()), pa.array(["f"] * n), pa.array([1] * n, pa.int64()), pa.array(range(n), pa.int64()),
         pa.array([10] * n, pa.int64()), pa.array([10**6] * n, pa.int64()), pa.array([False] * n)], Lines.columns)
    sizes = [b.num_rows for b in taken["task"](iter([batch, batch]))]
    assert sum(sizes) == 2 * n and len(sizes) <= 4


def test_landed_files_are_those_of_sparks_writer(spark, monkeypatch):
    from tillflow.plans import landing as L
    rows = [(r, i, f"a,{i}" if i % 3 else 'q"x', None if i % 4 else "") for r in ("r1.csv", None, "x=y/z", "7") for i in range(9)]
    df = spark.createDataFrame(rows, "retailer_id string, _ord long, one string, `two words` string")
    lines = df.selectExpr("retailer_id", "_ord % 2 AS _part", "_ord", "one AS value")
    xml = df.withColumnRenamed("two words", "two")
    for kind, make in (("text", lambda: L.land_csv(spark, df, "t")), ("text", lambda: L.land_csv(spark, df, "t", sep="\t", header=False)),
                       ("text", lambda: L.land_lines(spark, lines, "t")), ("xml", lambda: L.land_xml(spark, xml, "t"))):
        def read(path):
            r = spark.read.format(kind)
            r = r.option("rowTag", "webtable").schema("one string, two string, retailer_id string") if kind == "xml" else r
            return sorted(str(row) for row in r.load(path).collect())
        own = read(make())
        with monkeypatch.context() as m:
            m.setattr(L, "_reachable", lambda path: False)
            assert own == read(make()) and len(own) >= len(rows)


def test_lines_between_preamble_and_trailer_are_landed_in_passes_and_packed(spark, monkeypatch):
    from tillflow.plans import landing as L
    from tillflow.sources.delimited import drop_edge_lines
    rows = [(r, p, o, f"{r} {p} {o}") for r in ("1", "x=y", None, "7") for p in (0, 12, None) for o in range(5)]
    lines = spark.createDataFrame(rows, "retailer_id string, _part long, _ord long, value string")
    found = []
    for there in (True, False):
        with monkeypatch.context() as m:
            if not there:
                m.setattr(L, "_reachable", lambda path: False)
            path = L.land_lines(spark, lines, "t", head="one\ntwo\n", tail="TOTAL|{n}\n", packed=True, passes=3)
        assert all(f.endswith(".txt.gz") for f in spark.read.text(path).inputFiles())
        whole = L.with_part(spark.read.text(path).select("*", "_metadata.file_name"), "file_name")
        assert whole.where("value = 'TOTAL|5'").count() == whole.where("value = 'two'").count() == 12
        data = L.with_part(drop_edge_lines(spark, path, skip_head=2, drop_last=True))
        found.append(sorted(map(str, data.orderBy("_ord").select("retailer_id", "_part", "value").collect())))
    assert found[0] == found[1] == sorted(f"Row(retailer_id={r!r}, _part={p}, value={v!r})" for r, p, _, v in rows)


def test_a_packed_file_keeps_all_lines_but_its_last(spark, tmp_path):
    """Its size is that of the packed bytes, in which no line end stands where one is in the text."""
    import gzip
    import random
    from tillflow.sources.delimited import drop_edge_lines
    r = random.Random(5)
    texts = [[f"{i} {r.random()}" for i in range(n)] for n in (1, 2, 400)]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.txt.gz").write_bytes(gzip.compress("\n".join(text).encode()))
    left = [row["value"] for row in drop_edge_lines(spark, str(tmp_path), drop_last=True).collect()]
    assert sorted(left) == sorted(x for text in texts for x in text[:-1])


def test_a_landing_leaves_no_shuffle_files(spark, tmp_path):
    import time
    from pathlib import Path
    from tillflow.plans import landing as L
    local = [Path(x) for x in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    shuffles = lambda: {f.name for d in local for f in d.rglob("shuffle_*.data")}
    before = shuffles()
    df = spark.range(2000).selectExpr("cast(id % 5 AS string) AS retailer_id", "id % 2 AS _part", "id AS _ord", "cast(id AS string) AS value")
    L.land_lines(spark, df, "t", head="h\n", passes=2)
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
