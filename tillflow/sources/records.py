"""Records of delimited text whose quoted cells may hold line ends, many tasks a file.

A line end inside a quoted cell does not end a record, so where a split begins, only the text
before it tells whether a cell is open.  Two passes settle that:

1. ``open_splits``: only lines with a quote are looked at.  A split is summed up as the function
   from "a cell is open at its begin" to "a cell is open at its end" (two bits); these are
   composed in file order, one small row a split.  Result: the splits that begin inside a cell.
2. ``records``: each task joins its splits' lines to records.  A split that begins inside a cell leaves the
   lines up to the record's end to the split where it began; a record that is open at the end of its split is
   read on from the file (a small ranged read).  No row is shuffled.

Where no line opens a cell that the line does not close (``opens`` of the first pass), lines are records
already, and the sources use Spark's own CSV reader.

A cell is quoted if its first character is a quote; doubled quotes inside are quotes; after the
closing quote the cell goes on to the next separator.  Other quotes are text (``6" PIZZA``).  A line end inside a
cell reads as LF.  The last record of a file may end inside a cell; a record longer than ``MAX_RECORD`` bytes
ends the job with its path, as a quote that never closes would take the rest of the file into one cell.
"""

from __future__ import annotations

import itertools

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.session import few_listing_tasks
from tillflow.sources import files

MAX_RECORD = 64 << 20
BROADCAST = 100_000     # open splits (a path and two numbers each) that are sent to every task
PATH, BLOCK, LENGTH, SIZE, MONO = "_file_path", "_block", "_length", "_size", "_mono"
_WORK = (LENGTH, SIZE, "_inside")


def text_lines(spark: SparkSession, path) -> DataFrame:
    """Lines as bytes with their split: ``value``, path and name of the file, the split's begin and length,
    the file's size and a number that rises within a split; and the folders' partition columns."""
    few_listing_tasks(spark)
    raw = spark.read.text(path)
    return raw.withColumns({
        "value": F.col("value").cast("binary"), PATH: F.col("_metadata.file_path"), "_file_name": F.col("_metadata.file_name"),
        BLOCK: F.col("_metadata.file_block_start"), LENGTH: F.col("_metadata.file_block_length"), SIZE: F.col("_metadata.file_size"),
        MONO: F.monotonically_increasing_id()})


def _closed(line: bytes, at: int) -> int:
    """Position behind the quote that closes a cell whose text begins at ``at``; -1 if none does."""
    while True:
        q = line.find(b'"', at)
        if q < 0:
            return -1
        if line[q + 1:q + 2] != b'"':
            return q + 1
        at = q + 2


def ends_open(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a quoted cell is open at the end of a line, given whether one was at its begin."""
    at = 0
    while True:
        if inside or line.startswith(b'"', at):
            at = _closed(line, at if inside else at + 1)
            if at < 0:
                return True
            inside = False
            at = line.find(sep, at)
            if at < 0:
                return False
            at += len(sep)
        else:
            at = line.find(sep + b'"', at)
            if at < 0:
                return False
            at += len(sep)


def _head_quotes(path: str, n: int) -> int:
    """How many of a file's first ``n`` lines hold a quote."""
    return sum(b'"' in line for line in itertools.islice(files.lines(path), n)) if n else 0


def split_functions(lines: DataFrame, sep: str, skip_head: int = 0) -> DataFrame:
    """Per split with quotes: ``s0, s1`` (open at the end, if closed or open at the begin) and ``opens``."""
    mark = sep.encode()

    def task(batches):
        key, s0, s1, opens, skip = None, False, True, False, 0
        out = []
        for batch in batches:
            for line, path, block in zip(*(batch.column(c).to_pylist() for c in ("value", PATH, BLOCK))):
                if (path, block) != key:
                    if key:
                        out.append((*key, s0, s1, opens))
                    key, s0, s1, opens = (path, block), False, True, False
                    skip = _head_quotes(path, skip_head) if block == 0 else 0
                if skip:
                    skip -= 1
                    continue
                from_closed, from_open = ends_open(line, False, mark), ends_open(line, True, mark)
                opens |= from_closed
                s0, s1 = (from_open if s else from_closed for s in (s0, s1))
            if len(out) >= 1000:
                yield _split_rows(out)
                out = []
        if key:
            out.append((*key, s0, s1, opens))
        yield _split_rows(out)

    quoted = lines.where(F.col("value").cast("string").contains('"')).select("value", PATH, BLOCK)
    return quoted.mapInArrow(task, f"{PATH} string, {BLOCK} long, s0 boolean, s1 boolean, opens boolean")


def _split_rows(rows) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [PATH, BLOCK, "s0", "s1", "opens"])


def open_splits(functions: DataFrame) -> DataFrame:
    """``path, after, upto``: the splits of a file that begin behind ``after`` and not behind
    ``upto`` begin inside a quoted cell."""
    def fold(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in (BLOCK, "s0", "s1"))))
        path, spans, since = table.column(PATH)[0].as_py(), [], None
        for block, s0, s1 in rows:
            now = s1 if since is not None else s0
            if since is None and now:
                since = block
            elif since is not None and not now:
                spans.append((since, block))
                since = None
        if since is not None:
            spans.append((since, 2 ** 62))
        return pa.table({"path": pa.array([path] * len(spans), pa.string()), "after": pa.array([s[0] for s in spans], pa.int64()),
                         "upto": pa.array([s[1] for s in spans], pa.int64())})

    return functions.groupBy(PATH).applyInArrow(fold, "path string, after long, upto long")


def _continued(path: str, end: int, record: bytes, sep: bytes) -> bytes:
    """A record that is open at its split's end, read on from the file."""
    found = files.lines(path, end)
    next(found, None)             # the rest of the line that crosses the end, or the line that begins there
    size = len(record)
    parts = [record]
    for line in found:
        parts.append(line)
        size += len(line) + 1
        if size > MAX_RECORD:
            raise ValueError(f"{path}: a quoted cell before byte {end} does not end")
        if b'"' in line and not ends_open(line, True, sep):
            break
    return b"\n".join(parts)


def _owns_last_line(path: str, block: int, length: int, size: int) -> bool:
    """Whether the file's last line belongs to a split: it begins behind the split's first byte and not behind its end.
    A file that is one split (compressed ones are) is not looked into."""
    if block == 0 and length >= size:
        return True
    if size - block - length > length:
        return False
    start = files.last_line_start(path, size)
    return (block < start or block == start == 0) and start <= block + length


def records(lines: DataFrame, sep: str, spans: DataFrame | None = None, skip_records: int = 0, skip_lines: int = 0,
            drop_last: bool = False, encoding: str = "UTF-8", quoted: bool = True) -> DataFrame:
    """One row a record: ``value`` (text) and the columns of its first line.

    ``spans`` (of ``open_splits``): the splits that begin inside a cell.  A file's first ``skip_records``
    records, or ``skip_lines`` lines (a preamble, whose quotes mean nothing), and with ``drop_last`` its last line, are left out.
    Blank lines outside cells are too.  Without ``quoted`` every line is a record.
    """
    mark, utf8 = sep.encode(), encoding.upper().replace("-", "") in ("UTF8", "ASCII", "USASCII")
    if spans is None:
        rows = lines.withColumn("_inside", F.lit(False))
    else:
        inside = (lines[PATH] == spans["path"]) & (lines[BLOCK] > spans["after"]) & (lines[BLOCK] <= spans["upto"])
        if spans.count() <= BROADCAST:
            rows = lines.join(F.broadcast(spans), inside, "left")
        else:                         # a join that deals the lines out: put each split together again
            rows = lines.join(spans.hint("merge"), inside, "left").repartition(PATH, BLOCK).sortWithinPartitions(PATH, BLOCK, MONO)
        rows = rows.withColumn("_inside", F.col("after").isNotNull()).drop("path", "after", "upto")
    keep = [c for c in rows.columns if c not in _WORK]

    def decoded(values: list[bytes]):
        return pa.array(values, pa.binary()) if utf8 else pa.array([v.decode(encoding, "replace").encode() for v in values], pa.binary())

    def task(batches):
        key, skip, open_, discard, last = None, 0, None, False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            paths, starts, value = batch.column(PATH), batch.column(BLOCK), batch.column("value")
            same = key is not None and key == (paths[0].as_py(), starts[0].as_py()) and pc.all(
                pc.and_(pc.equal(paths, paths[0]), pc.equal(starts, starts[0]))).as_py()
            plain = same and not skip and open_ is None and not discard and not drop_last and utf8 and (
                not quoted or not pc.any(pc.match_substring(value.cast(pa.binary()), b'"')).as_py())
            if plain:
                yield _columns(batch, keep, None, None).filter(pc.greater(pc.binary_length(value), 0))
                continue
            out, at = [], []          # records, and the row of the batch that each takes its columns from
            held = []                 # records whose first line lies in an earlier batch, with that line's row

            def give(row):
                if isinstance(row[1], int):
                    out.append(row[0])
                    at.append(row[1])
                else:
                    held.append(row)

            work = zip(value.to_pylist(), paths.to_pylist(), starts.to_pylist(), *(batch.column(c).to_pylist() for c in _WORK))
            for i, (line, path, block, length, size, inside) in enumerate(work):
                if key != (path, block):
                    for row in _end(key, open_, last, drop_last, mark):
                        give(row)
                    key, open_, last, discard = (path, block), None, None, inside
                    skip = (skip_records or skip_lines) if block == 0 else 0
                if discard:           # the rest of a record that began in an earlier split
                    discard = b'"' not in line or ends_open(line, True, mark)
                    continue
                if open_ is not None:
                    open_[0].append(line)
                    if b'"' not in line or ends_open(line, True, mark):
                        if sum(map(len, open_[0][-2:])) > MAX_RECORD or len(open_[0]) > MAX_RECORD:
                            raise ValueError(f"{path}: a quoted cell does not end")
                        continue
                    row, open_ = (b"\n".join(open_[0]), open_[1]), None
                elif skip and skip_lines:
                    skip -= 1
                    continue
                elif not line.strip() and not drop_last:
                    continue
                elif quoted and b'"' in line and ends_open(line, False, mark):
                    open_ = ([line], i, (path, block, length, size))
                    continue
                else:
                    row = (line, i)
                if skip:              # a header record
                    skip -= 1
                    continue
                if drop_last:         # one line is held back until the next shows that it was not the last
                    if last is not None and last[0].strip():
                        give(last[:2])
                    last = (*row, (path, block, length, size))
                else:
                    give(row)
            if open_ is not None:     # what goes on in the next batch keeps its own first row
                open_ = (open_[0], _first(batch, open_[1]), open_[2])
            if last is not None:
                last = (last[0], _first(batch, last[1]), last[2])
            yield from _held(held, keep, decoded)
            if out:
                yield _columns(batch.take(pa.array(at)), keep, "value", decoded(out))
        yield from _held(list(_end(key, open_, last, drop_last, mark)), keep, decoded)

    def _end(key, open_, last, drop_last, mark):
        """What is left at the end of a split: a held line, and a record that is read on."""
        if last is not None and last[0].strip() and (open_ is not None or not _owns_last_line(*last[2])):
            yield last[:2]
        if open_ is not None:
            path, block, length, size = open_[2]
            record = b"\n".join(open_[0])
            if block + length < size:
                record = _continued(path, block + length, record, mark)
            if not drop_last:
                yield record, open_[1]
            elif block + length < size:
                yield record, open_[1]

    fields = ", ".join(f"`{f.name}` {'binary' if f.name == 'value' else f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep)
    return rows.mapInArrow(task, fields).withColumn("value", F.col("value").cast("string")).where(F.col("value").rlike(r"[^\x00-\x20]"))


def _columns(batch: pa.RecordBatch, keep: list[str], name: str | None, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([values if c == name else batch.column(c) for c in keep], keep)


def _first(batch: pa.RecordBatch, at) -> pa.RecordBatch:
    return batch.slice(at, 1) if isinstance(at, int) else at


def _held(rows, keep: list[str], decoded):
    """Batches of single records, each with the columns of its first line."""
    for record, first in rows:
        yield _columns(first, keep, "value", decoded([record]))


def ranged(spark: SparkSession, path) -> bool:
    """Whether tasks can read ranges of the files: not in a store that only Spark's readers reach."""
    one = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path")).limit(1).collect()
    try:
        return all(files.locate(r[0]) for r in one)
    except (pa.ArrowException, OSError, ValueError):
        return False


def first_records(spark: SparkSession, path, sep: str, encoding: str = "UTF-8") -> DataFrame:
    """``_file_path, names``: the cells of each file's first record, read with one small ranged read a
    file (in steps, if the record is long).  Where files have no ranged reads: the cells of the first line, from a
    scan of the text."""
    import csv
    mark = sep.encode()

    if not ranged(spark, path):
        def cells(line):
            return next(csv.reader([bytes(line).removeprefix(b"\xef\xbb\xbf").decode(encoding, "replace")], delimiter=sep), [])
        lines = text_lines(spark, path).where(F.col(BLOCK) == 0)
        heads = lines.groupBy(PATH).agg(F.min_by("value", MONO).alias("line"))
        return heads.select(PATH, F.udf(cells, "array<string>")("line").alias("names"))

    def first(file: str) -> list[str] | None:
        parts: list[bytes] = []
        for line in files.lines(file):
            if not parts and not line.strip(b" \t\xef\xbb\xbf"):
                continue
            parts.append(line if parts else line.removeprefix(b"\xef\xbb\xbf"))
            if not (b'"' in line and ends_open(line, len(parts) > 1, mark) or len(parts) > 1 and b'"' not in line):
                break
            if sum(map(len, parts)) > MAX_RECORD:
                raise ValueError(f"{file}: the header does not end")
        return next(csv.reader([b"\n".join(parts).decode(encoding, "replace")], delimiter=sep), []) if parts else None

    def task(batches):
        for batch in batches:
            paths = batch.column(PATH).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(list(map(first, paths)), pa.list_(pa.string()))], [PATH, "names"])

    listing = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(PATH))
    return listing.mapInArrow(task, f"{PATH} string, names array<string>").where("names is not null")
