"""Delimited text feeds: CSV with header, headerless positional, pipe files
with a preamble and a trailer.

Every raw column is read as a string (no inference), quotes may be doubled, quoted cells may
hold line ends, and cells that mean "missing" are null.  Files are split: where a record
crosses a line or a split, ``records`` joins it; where none does, Spark's CSV reader reads the lines.
Every row carries ``_ord`` = (file path, split start, position in split) -- its file order -- and
``_file_name``.  Short rows are padded; rows with more fields than
their file's header come apart, for a rejects table (the ``scan_`` functions drop them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.functions.text import nullify
from tillflow.operators.columns import ORD
from tillflow.session import shared_dir
from tillflow.sources import records as R

EXTRA = "_extra"


def _with_order(df: DataFrame) -> DataFrame:
    return df.withColumns({
        ORD: F.struct(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("pos")),
        "_file_name": F.col("_metadata.file_name"),
        "_file_path": F.col("_metadata.file_path"),
    })


def _string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def unique_names(names: list[str]) -> list[str]:
    """Repeated header names get _2, _3 ... in order; empty ones their position."""
    seen: dict[str, int] = {}
    out = []
    for i, n in enumerate(names):
        n = n.strip() or f"_c{i}"
        k = n.lower()
        seen[k] = seen.get(k, 0) + 1
        out.append(n if seen[k] == 1 else f"{n}_{seen[k]}")
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """A small table (a row per file or split) written once to the shared folder."""
    path = shared_dir(df.sparkSession, "sources", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def layouts(heads: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """(``keys``, ``_at``: the place of each column in that header, ``_width``) and the columns of
    all headers (``names``), each under the spelling that stands first.  Names differ by more than case.
    What reaches the driver is one row a column name, whatever the number of headers."""
    key = F.transform("names", lambda n: F.lower(n))
    found = (heads.select(F.posexplode("names").alias("pos", "name")).groupBy(F.lower("name").alias("key"))
             .agg(F.min(F.struct("pos", "name")).alias("first")).orderBy("first.pos", "first.name").select("key", "first.name").collect())
    places = F.transform(F.array(*[F.lit(r["key"]) for r in found]).cast("array<string>"), lambda n: (F.array_position(key, n) - 1).cast("int"))
    return heads.select(*keys, places.alias("_at"), F.size("names").alias("_width")), [r["name"] for r in found]


def bind(rows: DataFrame, heads: DataFrame, keys: list[str], cells: str = "cells") -> tuple[DataFrame, DataFrame]:
    """(rows with an array of cells -> one text column per header name, by the header that the row's
    ``keys`` find; the rows that have more cells than their header).  The array's cells behind a
    row's last are null."""
    at, names = layouts(heads, keys)
    too_long = F.exists(F.slice(cells, F.col("_width") + 1, F.greatest(F.size(cells), F.lit(1))), lambda c: c.isNotNull())
    joined = rows.join(at, keys)
    keep = [F.col(f"`{c}`") for c in rows.columns if c != cells and c not in names]
    bound = [nullify(F.get(cells, F.get("_at", F.lit(i)))).alias(n) for i, n in enumerate(names)]
    return joined.where(~too_long).select(*bound, *keep), _long(joined.where(too_long), F.col(cells))


def _long(rows: DataFrame, cells) -> DataFrame:
    """Over-long rows for a rejects table: where they stand, and their cells as JSON."""
    return rows.select("_file_path", *[c for c in (ORD, "_file_name") if c in rows.columns],
                       F.to_json(F.filter(cells, lambda c: c.isNotNull())).alias("record"))


def raw_cells(spark: SparkSession, path, width: int, sep: str = ",", header: bool = False, encoding: str = "UTF-8",
              skip_lines: int = 0, drop_last: bool = False) -> DataFrame:
    """Text columns ``_c0 .. _c{width-1}`` and ``_extra`` of every record, with the file's order and name."""
    schema = _string_schema([*(f"_c{i}" for i in range(width)), EXTRA])
    lines = R.text_lines(spark, path)
    functions = stored(R.split_functions(lines, sep, skip_lines), "splits")
    opens = not functions.where("opens").isEmpty()
    edges = skip_lines or drop_last
    alone = opens and not edges and not R.ranged(spark, path)     # one task a file reads what crosses its splits
    if not (opens or edges) or alone:
        return _with_order(spark.read.option("header", header).option("sep", sep).option("encoding", encoding).option("multiLine", alone)
                           .option("quote", '"').option("escape", '"').schema(schema).csv(path))
    spans = stored(R.open_splits(functions), "spans") if opens else None
    found = R.records(lines, sep, spans, skip_records=int(header), skip_lines=skip_lines, drop_last=drop_last, encoding=encoding)
    cells = F.from_csv(F.col("value"), schema.simpleString(), {"sep": sep, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})
    return _ordered(found).withColumn("_rec", cells).select("_rec.*", *[c for c in _ordered(found).columns if c != "value"])


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.withColumn(ORD, F.struct(F.col(R.PATH).alias("path"), F.col(R.BLOCK).alias("block"), F.col(R.MONO).alias("pos"))).drop(R.BLOCK, R.MONO)


def _named(raw: DataFrame, names: list[str], null_text: bool) -> tuple[DataFrame, DataFrame]:
    """(columns by position under ``names``, the over-long rows)."""
    wide = [f"_c{i}" for i in range(len(names))]
    rest = [c for c in raw.columns if c != EXTRA and c not in wide]
    value = lambda i: nullify(F.col(f"_c{i}")) if null_text else F.col(f"_c{i}")
    rows = raw.where(F.col(EXTRA).isNull()).select(*[value(i).alias(n) for i, n in enumerate(names)], *[c for c in rest if c not in names])
    return rows, _long(raw.where(F.col(EXTRA).isNotNull()), F.array(*wide, EXTRA))


def header_names(spark: SparkSession, path, sep: str = ",") -> list[str]:
    """All column names of the files' headers."""
    return layouts(_headers(spark, path, sep), ["_file_path"])[1]


def _headers(spark: SparkSession, path, sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    heads = R.first_records(spark, path, sep, encoding)
    name = F.udf(lambda n: unique_names(n), "array<string>")  # one call a file
    return stored(heads.select("_file_path", name("names").alias("names")), "headers")


def csv_header(spark: SparkSession, path, sep: str = ",", names: list[str] | None = None,
               encoding: str = "UTF-8", null_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, over-long rows) of CSV with a header record; all columns text.

    Columns are bound by name: each file's own header (one ranged read a file) says what its columns
    are, and a column that a file lacks is null there.  With ``names`` the
    headers are skipped and the columns bound by position.
    """
    if names is None:
        heads = _headers(spark, path, sep, encoding)
        several = [r["names"] for r in heads.select("names").distinct().limit(2).collect()]
        if len(several) == 2:
            width = heads.agg(F.max(F.size("names"))).first()[0]
            raw = raw_cells(spark, path, width, sep, True, encoding)
            wide = [*(f"_c{i}" for i in range(width)), EXTRA]
            rows = raw.select(F.array(*wide).alias("cells"), *[c for c in raw.columns if c not in wide])
            return bind(rows, heads, ["_file_path"])
        names = several[0] if several else ["value"]
    return _named(raw_cells(spark, path, len(names), sep, True, encoding), names, null_text)


def positional(spark: SparkSession, path, n_cols: int, sep: str = "\t", skip_head: int = 0, drop_last: bool = False,
               null_text: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, over-long rows) of a headerless delimited file, columns ``_c0 .. _c{n-1}`` by position, without
    ``skip_head`` preamble lines and (optionally) one trailer line per file."""
    return _named(raw_cells(spark, path, n_cols, sep, skip_lines=skip_head, drop_last=drop_last), [f"_c{i}" for i in range(n_cols)], null_text)


def scan_csv_header(spark: SparkSession, path, sep: str = ",", names: list[str] | None = None,
                    encoding: str = "UTF-8", null_text: bool = True) -> DataFrame:
    """The rows of ``csv_header``; over-long ones dropped."""
    return csv_header(spark, path, sep, names, encoding, null_text)[0]


def scan_positional(spark: SparkSession, path, n_cols: int, sep: str = "\t", null_text: bool = True) -> DataFrame:
    """The rows of ``positional``; over-long ones dropped."""
    return positional(spark, path, n_cols, sep, null_text=null_text)[0]


def scan_lines_skipping(spark: SparkSession, path, n_cols: int, sep: str = "|",
                        skip_head: int = 5, drop_last: bool = False, null_text: bool = True) -> DataFrame:
    """The rows of ``positional`` behind a preamble; over-long ones dropped."""
    return positional(spark, path, n_cols, sep, skip_head, drop_last, null_text)[0]


def drop_edge_lines(spark: SparkSession, path, skip_head: int = 0, drop_last: bool = False) -> DataFrame:
    """Text lines of files without each file's first ``skip_head`` lines (and its last), and without blank lines.
    One pass, no shuffle: the task that holds a file's begin skips its first lines, the one that holds
    its end holds the last line back."""
    return _ordered(R.records(R.text_lines(spark, path), "", skip_lines=skip_head, drop_last=drop_last, quoted=False))
