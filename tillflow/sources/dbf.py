"""dBase (.dbf) tables.

``spark.read.format("dbf")`` is a data source over ranges of records: all records of a file have one
length, so a partition is (path, first record, number of records) and a task reads these bytes
and no others.  Files may be of any size.  The schema is that of all files (their headers, one small read each, are read
on the driver, as Spark's own sources list files there); option ``columns`` names those that are decoded.

Members of archives come as ``path, content`` rows instead (``decode_files``).

Deleted records are skipped, missing memo files do not
matter (memo fields give their block number as text).  A number or date that
does not read as one is null and its text is kept in ``_invalid``; a file that
is shorter than its header says ends the job with its path.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tillflow.operators.columns import ORD
from tillflow.sources import files

RECORDS_PER_BATCH = 50_000
RECORDS_PER_PARTITION = 500_000
RECORDS_PER_PACK = 20_000       # of small files, which a task reads together
MAX_FIELDS = 5000       # distinct (field, type) pairs of one scan
HEADER = 65_536         # a header's length is two bytes

# dBase field type -> Spark type; others are text
_TYPES = {"N": "double", "F": "double", "I": "bigint", "+": "bigint", "B": "double", "O": "double", "Y": "double",
          "D": "timestamp_ntz", "T": "timestamp_ntz", "@": "timestamp_ntz", "L": "boolean"}
_ARROW = {"double": pa.float64(), "bigint": pa.int64(), "timestamp_ntz": pa.timestamp("us"), "boolean": pa.bool_(),
          "string": pa.string()}
_META = {"_invalid": "string", "_file_path": "string", "_file_name": "string", "_record": "bigint"}
_NUMBER = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"


def read_header(data: bytes):
    """(n_records, header_len, record_len, [(name, type, length, decimals)])."""
    n_rec, h_len, r_len = struct.unpack("<IHH", data[4:12])
    fields, at = [], 32
    while at + 32 <= len(data) and data[at] != 0x0D:
        d = data[at:at + 32]
        name = d[:11].split(b"\x00", 1)[0].decode("ascii", "ignore").strip().lower()
        fields.append((name, chr(d[11]), d[16], d[17]))
        at += 32
    return n_rec, h_len, r_len, fields


def _texts(cells: np.ndarray, encoding: str) -> np.ndarray:
    """Cells (records x bytes) as text without blanks and zero bytes at their end."""
    raw = np.ascontiguousarray(cells).view(f"S{cells.shape[1]}").ravel() if cells.shape[1] else np.zeros(len(cells), "S1")
    return np.char.rstrip(np.char.decode(raw, encoding, "ignore"), " \x00")


def field(cells: np.ndarray, kind: str, encoding: str) -> tuple[pa.Array, np.ndarray | None]:
    """(values, texts of the cells where they do not read as their type) of one field; the
    cells' bytes are records x length, and whole columns are decoded at once."""
    n, width = cells.shape
    fixed = lambda form: np.ascontiguousarray(cells).view(form)
    if kind in "I+" and width == 4:
        return pa.array(fixed("<i4").ravel().astype(np.int64)), None
    if kind in "BO" and width == 8:
        return pa.array(fixed("<f8").ravel()), None
    if kind == "Y" and width == 8:
        return pa.array(fixed("<i8").ravel() / 10_000), None
    if kind in "T@" and width == 8:   # FoxPro: Julian day and milliseconds
        day, ms = fixed("<i4").reshape(n, 2).astype(np.int64).T
        micros = (day - 2_440_588) * 86_400_000_000 + ms * 1000
        return pa.array(micros, pa.int64(), mask=day == 0).cast(pa.timestamp("us")), None
    text = _texts(cells, encoding)
    if kind not in _TYPES:
        return pa.array(text, pa.string()), None
    text = np.char.lstrip(text, " \x00")
    if kind == "L":
        blank = (text == "") | (text == "?")
        return pa.array(np.isin(text.astype("U1"), list("TtYy")), pa.bool_(), mask=blank), None
    blank = np.char.strip(text, "*") == ""   # blank, or a number that overflowed its field
    given = pa.array(text, pa.string(), mask=blank)
    if kind == "D":
        whole = pc.if_else(pc.match_substring_regex(given, "^[0-9]{8}$"), given, None)
        values = pc.strptime(whole, format="%Y%m%d", unit="us", error_is_null=True)
        back = pc.equal(pc.strftime(values, format="%Y%m%d"), whole)   # the 31st of a short month rolls over
        values = pc.if_else(back, values, None)
    else:
        values = pc.if_else(pc.match_substring_regex(given, _NUMBER), given, None).cast(pa.float64())
    bad = ~blank & values.is_null().to_numpy(zero_copy_only=False)
    return values, np.where(bad, text, "") if bad.any() else None


def decode(data: bytes, fields, first: int, want: list[tuple[str, str]], encoding: str):
    """(columns, ``_invalid`` texts, record numbers) of the live records in ``data``, whole records
    of which the first has number ``first``; ``want``: (name, Spark type)."""
    r_len = 1 + sum(f[2] for f in fields)
    rows = np.frombuffer(data, np.uint8).reshape(-1, r_len)
    live = np.flatnonzero(rows[:, 0] != ord("*"))
    rows = rows[live]
    at, offset = {}, 1
    for name, kind, length, _ in fields:
        at.setdefault(name, (kind, offset, length))
        offset += length
    invalid: list = [None] * len(live)
    columns = []
    for name, spark_type in want:
        kind, o, length = at.get(name, ("", 0, 0))
        if not kind:
            columns.append(pa.nulls(len(live), _ARROW[spark_type]))
            continue
        values, bad = field(rows[:, o:o + length], kind, encoding)
        if bad is not None:
            for i in np.flatnonzero(bad != "").tolist():
                invalid[i] = f"{invalid[i] + '; ' if invalid[i] else ''}{name}={bad[i]}"
        columns.append(values.cast(_ARROW[spark_type]))
    return columns, invalid, first + live


def _batches(read, header, path: str, first: int, count: int, want, encoding: str) -> Iterator[pa.RecordBatch]:
    """Arrow batches of a range of records; ``read(start, length)`` gives bytes of the file."""
    n_rec, h_len, r_len, fields = header
    if r_len != 1 + sum(f[2] for f in fields):
        raise ValueError(f"{path}: the fields' lengths are not the record's")
    for at in range(first, first + count, RECORDS_PER_BATCH):
        n = min(RECORDS_PER_BATCH, first + count - at)
        data = read(h_len + at * r_len, n * r_len)
        if len(data) < n * r_len:
            raise ValueError(f"{path}: the file holds fewer records than its header says ({n_rec})")
        columns, invalid, record = decode(data, fields, at, [w for w in want if w[0] not in _META], encoding)
        made = dict(zip([w[0] for w in want if w[0] not in _META], columns))
        k = len(record)
        made |= {"_invalid": pa.array(invalid, pa.string()), "_file_path": pa.array([path] * k, pa.string()),
                 "_file_name": pa.array([path.rsplit("/", 1)[-1]] * k, pa.string()), "_record": pa.array(record, pa.int64())}
        yield pa.RecordBatch.from_arrays([made[name] for name, _ in want], [name for name, _ in want])


def merged(heads: list[tuple[int, str, str]]) -> list[tuple[str, str]]:
    """(name, type) of every field of any file from (position, name, type), in the order of their
    first position; a field with different types is a number if all are, else text."""
    if len(set(heads)) > MAX_FIELDS:
        raise ValueError(f"more than {MAX_FIELDS} fields")
    types: dict[str, set] = {}
    for _, name, kind in sorted(set(heads)):
        types.setdefault(name, set()).add(kind)
    pick = lambda t: next(iter(t)) if len(t) == 1 else "double" if t <= {"double", "bigint"} else "string"
    return [(n, pick(t)) for n, t in types.items()]


# ------------------------------------------------ files: ranges of records

@dataclass
class Range(InputPartition):
    path: str
    header: tuple
    first: int
    count: int


@dataclass
class Pack(InputPartition):
    """Whole files that are small, read by one task."""

    ranges: list[Range]


class DbfReader(DataSourceReader):
    def __init__(self, source: DbfSource, want: list[tuple[str, str]]):
        self.found, self.want = source.found(), want
        self.encoding = source.options.get("encoding", "latin-1")
        self.step = int(source.options.get("recordsPerPartition", RECORDS_PER_PARTITION))

    def partitions(self) -> list[Range | Pack]:
        """Ranges of a large file; small files together, up to ``RECORDS_PER_PACK`` records."""
        out, pack, size, known = [], [], 0, {}
        for path, _, (n, head, record, fields) in self.found:
            header = (n, head, record, known.setdefault(tuple(fields), fields))     # sent once a task
            if n > self.step:
                out += [Range(path, header, first, min(self.step, n - first)) for first in range(0, n, self.step)]
                continue
            if pack and size + n + 1 > max(self.step, RECORDS_PER_PACK):
                out.append(Pack(pack))
                pack, size = [], 0
            pack.append(Range(path, header, 0, n))
            size += n + 1            # an empty file costs its opening
        if pack:
            out.append(Pack(pack))
        return out or [Range("", (0, 0, 1, []), 0, 0)]

    def read(self, partition: Range | Pack) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Pack):
            held, size = [], 0
            for one in partition.ranges:
                for batch in self.read(one):
                    held.append(batch)
                    size += batch.num_rows
                    if size >= RECORDS_PER_BATCH:
                        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                        held, size = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            return

        def read(start, length):
            return files.read_range(partition.path, start, length, encoded=False)
        yield from _batches(read, partition.header, partition.path, partition.first, partition.count, self.want, self.encoding)


class DbfSource(DataSource):
    """``spark.read.format("dbf").load(path)``: a folder, file or glob.  Options ``columns`` (comma-separated;
    all), ``encoding`` (latin-1), ``recordsPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def found(self) -> list[tuple[str, int, tuple]]:
        """(path, size, header) of every file."""
        there = files.listed(self.options["path"], ".dbf")
        with ThreadPoolExecutor(16) as pool:
            heads = pool.map(lambda f: read_header(files.read_range(f[0], 0, HEADER, encoded=False)), there)
        return [(path, size, head) for (path, size), head in zip(there, heads)]

    def schema(self) -> str:
        every = merged([(i, f[0], _TYPES.get(f[1], "string")) for _, _, head in self.found() for i, f in enumerate(head[3])])
        columns = [c.strip().lower() for c in self.options.get("columns", "").split(",") if c.strip()]
        if missing := set(columns) - {n for n, _ in every}:
            raise ValueError(f"no such fields: {sorted(missing)}")
        kept = [f for f in every if not columns or f[0] in columns]
        return ", ".join(f"`{n}` {t}" for n, t in [*kept, *_META.items()])

    def reader(self, schema) -> DbfReader:
        return DbfReader(self, [(f.name, f.dataType.simpleString()) for f in schema.fields])


def scan_dbf(spark: SparkSession, path: str, encoding: str = "latin-1", columns: list[str] | None = None,
             records_per_partition: int = RECORDS_PER_PARTITION) -> DataFrame:
    """All .dbf files of a folder, file or glob -> typed rows with file order; only ``columns`` are decoded."""
    spark.dataSource.register(DbfSource)
    df = (spark.read.format("dbf").option("encoding", encoding).option("columns", ",".join(columns or []))
          .option("recordsPerPartition", records_per_partition).load(path))
    return df.withColumn(ORD, F.struct(F.col("_file_path").alias("path"), F.col("_record").alias("pos")))


# ------------------------------------------------ archive members: path, content

def schemas_of(rows: DataFrame, groups: tuple[str, ...], by: str = "role") -> dict[str, list[tuple[str, str]]]:
    """(name, type) of every field of any file of ``path, content`` rows, for each group of files, in one pass."""
    def task(batches):
        for batch in batches:
            found = sorted({(g, i, f[0], _TYPES.get(f[1], "string")) for g, c in zip(batch.column("g").to_pylist(), batch.column("content").to_pylist())
                            for i, f in enumerate(read_header(c)[3])})
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.string()))],
                                             ["g", "pos", "name", "type"])

    heads = rows.select(F.col(by).alias("g"), F.substring("content", 1, HEADER).alias("content")).mapInArrow(task, "g string, pos int, name string, type string")
    found = heads.groupBy("g", "name", "type").agg(F.min("pos").alias("pos")).limit(len(groups) * MAX_FIELDS + 1).collect()
    return {g: merged([(r["pos"], r["name"], r["type"]) for r in found if r["g"] == g]) for g in groups}


def schema_of(rows: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of every field of any file of ``path, content`` rows."""
    return schemas_of(rows.withColumn("_all", F.lit("")), ("",), "_all")[""]


def decode_files(rows: DataFrame, encoding: str = "latin-1", fields: list[tuple[str, str]] | None = None) -> DataFrame:
    """All records of ``path, content`` files, with ``_file_path, _file_name,
    _record, _invalid`` and the file order ``_ord``."""
    want = [*(schema_of(rows) if fields is None else fields), *_META.items()]

    def task(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                header = read_header(content)
                yield from _batches(lambda start, length: content[start:start + length], header, path, 0, header[0], want, encoding)

    df = rows.select("path", "content").mapInArrow(task, ", ".join(f"`{n}` {t}" for n, t in want))
    return df.withColumn(ORD, F.struct(F.col("_file_path").alias("path"), F.col("_record").alias("pos")))


def encode_table(columns: list[tuple[str, str]], rows, narrow: bool = False) -> bytes:
    """A dBase III table: columns = [(name, spark type)], rows = tuples.  Text fields are 254 bytes wide; ``narrow``: as wide as
    their longest text, if it is shorter."""
    kinds = ["N" if t in ("double", "float", "bigint", "int") else "D" if t.startswith("timestamp") or t == "date" else "C" for _, t in columns]
    cells = [[("" if v is None else v.strftime("%Y%m%d") if kind == "D" else
               repr(float(v)) if kind == "N" and not isinstance(v, int) else str(v)).encode("latin-1", "replace") for kind, v in zip(kinds, row)]
             for row in rows]
    widest = [max(map(len, column)) for column in zip(*cells)] or [1] * len(columns)
    spec = [(n, kind, {"N": 24, "D": 8}.get(kind, min(max(w, 1), 254) if narrow else 254)) for (n, _), kind, w in zip(columns, kinds, widest)]
    body = []
    for row in cells:
        body.append(b" ")
        body += [raw[:length].rjust(length) if kind == "N" else raw[:length].ljust(length) for (_, kind, length), raw in zip(spec, row)]
    n = len(cells)
    r_len, h_len = 1 + sum(f[2] for f in spec), 33 + 32 * len(spec)
    head = [struct.pack("<BBBBIHH20x", 3, 100, 1, 1, n, h_len, r_len)]
    head += [struct.pack("<11sc4xBB14x", name.upper().encode("ascii")[:10], kind.encode(), length, 0) for name, kind, length in spec]
    return b"".join([*head, b"\x0D", *body, b"\x1A"])
