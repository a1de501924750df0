"""Write derived feeds to the shared folder in a POS export format.

Used by the scan queries: a feed derived from the driver tables is written as
the POS would export it, then read back through the matching source.  Paths lie
under the cluster's shared checkpoint folder (``tillflow.session.shared_dir``).  A
retailer's rows are ranged over several files in file order (part numbers rise with
it), so a large retailer is many tasks; formats with a preamble give each part file its own.

There are as many files as retailers and parts, mostly small.  Spark formats the lines; the tasks
write them through Arrow's file systems, as Spark's partitioned writer costs some 40 ms a small file
(directories, permissions, renames in the driver).  It stays for stores that Arrow does not know.

Disk: a landing of many rows goes by retailers in several passes (``passes``), each of which ends with the driver's
garbage collection, as a shuffle's files stay until then; ``packed`` files are gzip.
"""

from __future__ import annotations

import csv
import io
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.columns import KEY, ORD
from tillflow.session import few_listing_tasks, free_shuffles, shared_dir
from tillflow.sources import files

META = (KEY, ORD, "_line", "_part")
#: Rows that a pass of a landing shuffles at least, and the most passes: each reads the input, and a quarter of
#: the shuffles is less than what reading the files back shuffles.
ROWS_PER_PASS, MOST_PASSES = 3_000_000, 4
#: zlib's level of packed files.
PACKING = 6


def passes(rows: int) -> int:
    return min(max(1, -(-rows // ROWS_PER_PASS)), MOST_PASSES)


def _by_pass(df: DataFrame, n: int):
    """``df`` in ``n`` parts by retailer; a part reads the input anew, and its shuffles go when it is done."""
    for i in range(n):
        yield df.where(F.pmod(F.xxhash64(KEY), F.lit(n)) == i) if n > 1 else df
        if n > 1:
            free_shuffles(df.sparkSession)


def in_order(df: DataFrame) -> DataFrame:
    """Ranges over (retailer, file order): files of a retailer follow each other."""
    return df.repartitionByRange(KEY, ORD).sortWithinPartitions(KEY, ORD)


def _text(df: DataFrame) -> DataFrame:
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in META]
    return in_order(df).select(KEY, ORD, *cols).drop(ORD)


def _folder(column: str, value) -> str:
    """A partition folder's name, as Spark writes it."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}=" + re.sub(r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", str(value))


def _reachable(path: str) -> bool:
    try:
        return files.locate(path, encoded=False) is not None
    except (pa.ArrowException, OSError, ValueError):
        return False


def _write_files(rows: DataFrame, keys: tuple[str, ...], path: str, suffix: str, head: str = "", tail: str = "", flat: bool = False) -> None:
    """Write ``rows`` (``keys``, value) as files ``<key>=<value>/.../part-<task>-<run><suffix>``; a task's rows lie
    by keys.  ``flat``: the last key is no folder, its value stands in the files' names (``part-<value>-<task>-...``).  A file is written under a name of its own and then moved, so a repeated task leaves the same file.
    ``{n}`` in ``tail`` stands for the number of a file's rows.  With a suffix ``.gz`` files are compressed."""
    run = uuid.uuid4().hex
    few_listing_tasks(rows.sparkSession)

    def write(batches):
        import zlib

        from pyspark import TaskContext
        name = f"part-{TaskContext.get().partitionId():05d}-{run}{suffix}"
        key, out, at, packer, count = None, None, None, None, 0

        def put(data):
            out.write(packer.compress(data) if packer else data)

        def close():
            put(tail.replace("{n}", str(count)).encode())
            if packer:
                out.write(packer.flush())
            out.close()
            system.move(own, inner)

        for batch in batches:
            values = batch.column("value")
            where = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1] if len(values) else []
            data = memoryview(values.buffers()[2] or b"")
            ends = sorted({e for k in keys for e in pc.run_end_encode(batch.column(k)).run_ends.to_pylist()})
            for start, end in zip([0, *ends], ends):
                now = tuple(batch.column(k)[start].as_py() for k in keys)
                if out is None or now != key:
                    if out is not None:
                        close()
                        yield pa.RecordBatch.from_arrays([pa.array([at])], ["path"])
                    key, at = now, "/".join([path, *map(_folder, keys, now), name])
                    if flat:
                        value = "" if now[-1] is None else now[-1]
                        at = "/".join([path, *map(_folder, keys[:-1], now), name.replace("part-", f"part-{value}-", 1)])
                    system, inner = files.locate(at, encoded=False)
                    own = f"{inner.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.tmp"
                    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(own)
                    packer, count = zlib.compressobj(PACKING, wbits=31) if suffix.endswith(".gz") else None, 0
                    put(head.encode())
                count += end - start
                put(data[where[start]:where[end]])      # the rows lie one behind the other
        if out is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array([at])], ["path"])

    (rows.select(*keys, F.concat(F.coalesce("value", F.lit("")), F.lit("\n")).alias("value")).mapInArrow(write, "path string")
     .write.format("noop").mode("overwrite").save())


def land_csv(spark: SparkSession, df: DataFrame, name: str, sep: str = ",", header: bool = True,
             path: str | None = None, mode: str = "overwrite", packed: bool = False, passes: int = 1) -> str:
    """Write ``df`` (retailer_id, _ord, text columns) as delimited files,
    one directory per retailer, rows in ``_ord`` order.  ``packed``: gzip files."""
    path = path or shared_dir(spark, "landing", name)
    if not _reachable(path):
        out = _text(df).write.mode(mode).partitionBy(KEY).option("header", header).option("sep", sep).option("escape", '"')
        (out.option("compression", "gzip") if packed else out).csv(path)
        return path
    for part in _by_pass(df, passes):
        text = _text(part)
        columns = [c for c in text.columns if c != KEY]
        line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), {"sep": sep, "escape": '"'})
        head = io.StringIO()
        csv.writer(head, delimiter=sep, lineterminator="\n").writerow(columns)
        _write_files(text.select(KEY, line.alias("value")), (KEY,), path, ".csv.gz" if packed else ".csv", head.getvalue() if header else "")
    return path


def _with_edges(lines: DataFrame, head: str, tail: str) -> DataFrame:
    """The lines of each (retailer, part) between those of ``head`` and ``tail``, for a writer that knows rows only."""
    each = lines.groupBy(KEY, "_part").agg(F.count(F.lit(1)).cast("string").alias("n"))
    none = F.lit(None).cast(lines.schema[ORD].dataType)
    place = lambda k, h, o: F.struct(F.lit(k).alias("k"), h.alias("h"), o.alias("o")).alias(ORD)
    out = lines.select(KEY, "_part", place(1, F.lit(0), F.col(ORD)), "value")
    for k, text in ((0, head), (2, tail)):
        if text:
            rows = each.select(KEY, "_part", "n", F.posexplode(F.array(*[F.lit(x) for x in text.splitlines()])).alias("h", "x"))
            out = out.unionByName(rows.select(KEY, "_part", place(k, F.col("h"), none), F.replace("x", F.lit("{n}"), F.col("n")).alias("value")))
    return out


def land_lines(spark: SparkSession, lines: DataFrame, name: str, path: str | None = None, head: str = "", tail: str = "",
               packed: bool = False, passes: int = 1) -> str:
    """Write pre-formatted text lines (retailer_id, _part, _ord, value): one file
    per retailer and part, each with its own preamble ``head`` and trailer ``tail`` (``{n}``: its number of lines).
    Without ``_part`` a retailer's lines are ranged over files in file order.
    ``packed``: gzip files, each read by one task; a part is no folder but stands in its file's name (``with_part``)."""
    path = path or shared_dir(spark, "landing", name)
    keys = (KEY, "_part") if "_part" in lines.columns else (KEY,)
    if not _reachable(path):
        lines = lines if len(keys) == 2 else lines.withColumn("_part", F.lit(0))
        rows = _with_edges(lines, head, tail).repartition(KEY, "_part").sortWithinPartitions(KEY, "_part", ORD).select(*keys, "value")
        out = rows.write.mode("append").partitionBy(*keys)
        (out.option("compression", "gzip") if packed else out).text(path)
        return path
    for part in _by_pass(lines, passes):
        rows = part.repartition(*keys).sortWithinPartitions(*keys, ORD) if len(keys) == 2 else in_order(part)
        _write_files(rows.select(*keys, "value"), keys, path, ".txt.gz" if packed else ".txt", head, tail, flat=packed and len(keys) == 2)
    return path


def with_part(df: DataFrame, name: str = "_file_name") -> DataFrame:
    """``_part`` as a number: from the folder where there is one, else from the file's name."""
    if "_part" not in df.columns:
        df = df.withColumn("_part", F.regexp_extract(name, "^part-(-?[0-9]*)-[0-9]{5,}-", 1))
    return df.withColumn("_part", F.col("_part").try_cast("long"))


def _xml_row(columns: list[str], row_tag: str) -> Column:
    """A row's element on one line, without the children that are null.  Texts with characters that XML escapes or
    refuses go through ``to_xml``, which costs some ten times as much."""
    cells = [F.col(f"`{c}`") for c in columns]
    odd = F.concat_ws("", *cells).rlike(r"[^ -~]|[&<>\"']")
    plain = F.concat(F.lit(f"<{row_tag}>"), *[F.coalesce(F.concat(F.lit(f"<{c}>"), v, F.lit(f"</{c}>")), F.lit(""))
                                             for c, v in zip(columns, cells)], F.lit(f"</{row_tag}>"))
    return F.when(odd, F.to_xml(F.struct(*cells), {"rowTag": row_tag})).otherwise(plain)


def land_xml(spark: SparkSession, df: DataFrame, name: str, row_tag: str = "webtable",
             root_tag: str = "NewDataSet", path: str | None = None, packed: bool = False) -> str:
    """XML files, one folder a retailer.  ``packed``: gzip files, which the XML reader opens by their suffix
    (it reads a file as a whole in either case)."""
    path = path or shared_dir(spark, "landing", name)
    text = _text(df)
    if not _reachable(path):
        out = text.write.mode("append").partitionBy(KEY).format("xml").option("rowTag", row_tag).option("rootTag", root_tag)
        (out.option("compression", "gzip") if packed else out).save(path)
        return path
    row = _xml_row([c for c in text.columns if c != KEY], row_tag)
    _write_files(text.select(KEY, row.alias("value")), (KEY,), path, ".xml.gz" if packed else ".xml", f"<{root_tag}>\n", f"</{root_tag}>")
    return path


def land_json(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = shared_dir(spark, "landing", name)
    df.write.json(path)
    return path


def retailer_from_path(df: DataFrame) -> DataFrame:
    """Partition directory value -> text retailer id."""
    return df.withColumn(KEY, F.col(KEY).cast("string"))


def _files(df: DataFrame, name: str, make, spark: SparkSession, passes: int = 1) -> DataFrame:
    path = shared_dir(spark, "landing", name)
    for part in _by_pass(df, passes):
        part.groupBy(KEY, "_part").applyInArrow(make, "path string, content binary").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def land_dbf_files(spark: SparkSession, df: DataFrame, name: str, member: str, passes: int = 1) -> str:
    """dBase files ``<folder>/<retailer>/<part>-<member>.dbf`` in the shared folder.  A task writes each
    under a name of its own and then moves it, so a repeated task leaves the same file."""
    root = shared_dir(spark, "landing", name)

    def write(batches):
        from uuid import uuid4

        from tillflow.sources.files import locate
        for batch in batches:
            paths = [f"{root}/{p}" for p in batch.column("path").to_pylist()]
            for path, content in zip(paths, batch.column("content").to_pylist()):
                fs, inner = locate(path, encoded=False)
                own = f"{inner}.{uuid4().hex}.tmp"
                fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(own) as f:
                    f.write(content)
                fs.move(own, inner)
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], ["path"])

    for part in _by_pass(df, passes):
        _dbf(part, member, "-").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()
    return root


def _dbf(df: DataFrame, member: str, sep: str) -> DataFrame:
    """``path, content`` of a dBase file per retailer and part."""
    cols = [(c, t) for c, t in df.dtypes if c not in META]

    def make(rows: pa.Table) -> pa.Table:
        from tillflow.sources.dbf import encode_table
        key, part = rows.column(KEY)[0].as_py(), rows.column("_part")[0].as_py()
        data = rows.sort_by([("_n", "ascending")]).select([c for c, _ in cols])
        content = encode_table(cols, zip(*(data.column(c).to_pylist() for c, _ in cols)), narrow=True)
        return pa.table({"path": pa.array([f"{key}/{part:012d}{sep}{member}.dbf"]), "content": pa.array([content], pa.binary())})

    return _numbered(df).groupBy(KEY, "_part").applyInArrow(make, "path string, content binary")


def land_dbf(spark: SparkSession, df: DataFrame, name: str, member: str, passes: int = 1) -> DataFrame:
    """``path, content`` of dBase files ``<retailer>/<part>/<member>.dbf`` (parts
    hold a bounded range of the retailer's rows), stored in the shared folder."""
    path = shared_dir(spark, "landing", name)
    for part in _by_pass(df, passes):
        _dbf(part, member, "/").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def _numbered(df: DataFrame) -> DataFrame:
    """``_n``: the order of a row within its part."""
    from pyspark.sql import Window
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(KEY, "_part").orderBy(ORD))).drop(ORD, "_line")


def land_zip_members(spark: SparkSession, members: dict, name: str, passes: int = 1) -> DataFrame:
    """``path, content`` of one zip archive per retailer and part, a CSV or dBase
    table per member (``members``: file name -> frame with retailer_id, _part, _ord, columns)."""
    stacked = None
    columns = {}
    for member, d in members.items():
        columns[member] = [c for c in d.columns if c not in META]
        rows = _numbered(d).select(KEY, "_part", "_n", F.lit(member).alias("member"),
                                   F.array(*[F.col(f"`{c}`").cast("string") for c in columns[member]]).alias("cells"))
        stacked = rows if stacked is None else stacked.unionByName(rows)

    def make(rows: pa.Table) -> pa.Table:
        import csv
        import io
        import zipfile

        from tillflow.sources.dbf import encode_table
        key, part = rows.column(KEY)[0].as_py(), rows.column("_part")[0].as_py()
        rows = rows.sort_by([("member", "ascending"), ("_n", "ascending")])
        cells = {m: [] for m in columns}
        for m, row in zip(rows.column("member").to_pylist(), rows.column("cells").to_pylist()):
            cells[m].append(["" if c is None else c for c in row])
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for m, data in cells.items():
                if m.lower().endswith(".dbf"):
                    z.writestr(m, encode_table([(c, "string") for c in columns[m]], data, narrow=True))
                    continue
                text = io.StringIO()
                csv.writer(text, lineterminator="\n").writerows([columns[m], *data])
                z.writestr(m, text.getvalue())
        return pa.table({"path": pa.array([f"{key}/{part:012d}/export.zip"]), "content": pa.array([out.getvalue()], pa.binary())})

    return _files(stacked, name, make, spark, passes)
