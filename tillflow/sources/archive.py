"""Multi-member exports delivered as zip archives.

Archives come as ``path, content`` rows (Spark's ``binaryFile`` source, any file
system, up to its 2 GB limit a file).  Tasks stream the members out as records:
``expand_archives`` gives one row per CSV record with its archive's full path, so
archives of equal names in different folders stay apart, and ``member_files``
gives the bytes of binary members (.dbf) for their own decoder.  ``member_rows``
binds a role's records to column names by each member's own header.
"""

from __future__ import annotations

import csv
import io
import json
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.columns import ORD, member_role, role_of
from tillflow.session import shared_dir
from tillflow.sources.delimited import bind, unique_names
from tillflow.sources.delimited import stored as stored_heads

RECORDS_PER_BATCH = 10_000


def archive_files(spark: SparkSession, path) -> DataFrame:
    """``path, content`` of all zip archives below a folder (or of a glob)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").option("recursiveFileLookup", True)
            .load(path).select("path", "content"))


def expand_archives(archives: DataFrame, encoding: str = "utf-8") -> DataFrame:
    """``archive, member, pos, fields, layout, role``: the records of all CSV members
    that have a role; position 0 is the header.  Quoted cells may hold line ends.  ``layout`` is the
    member's header (its names as JSON; null where its first line is blank): records find their columns by it."""
    def batches_of(path, content):
        rows = []
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in z.infolist():
                role, layout = role_of(info.filename), None
                if info.is_dir() or role is None or not info.filename.lower().endswith(".csv"):
                    continue
                with z.open(info) as raw:
                    text = io.TextIOWrapper(raw, encoding, errors="replace", newline="")
                    for pos, fields in enumerate(csv.reader(text)):
                        if not fields:
                            continue
                        if pos == 0:
                            layout = json.dumps(unique_names(fields))
                        rows.append((path, info.filename, pos, fields, layout, role))
                        if len(rows) >= RECORDS_PER_BATCH:
                            yield rows
                            rows = []
        yield rows

    def task(it):
        for batch in it:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                for rows in batches_of(path, content):
                    cols = list(zip(*rows)) if rows else [()] * len(types)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    names, types = ["archive", "member", "pos", "fields", "layout", "role"], [pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()]
    return archives.mapInArrow(task, "archive string, member string, pos long, fields array<string>, layout string, role string")


def stored(expanded: DataFrame) -> DataFrame:
    """The expanded records written once to the shared folder, a partition per
    role: each archive is unpacked a single time, and a role reads its own part."""
    spark = expanded.sparkSession
    path = shared_dir(spark, "expanded")
    expanded.write.partitionBy("role").parquet(path)
    return spark.read.schema(expanded.schema).parquet(path)


def member_files(archives: DataFrame, suffix: str = ".dbf", roles: tuple[str, ...] | None = None) -> DataFrame:
    """``archive, path, role, content`` of the binary members that have a role (one of ``roles``); no others are unpacked."""
    def task(it):
        for batch in it:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for info in z.infolist():
                        role = role_of(info.filename)
                        if info.filename.lower().endswith(suffix) and role is not None and (roles is None or role in roles):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([path]), pa.array([f"{path}!/{info.filename}"]), pa.array([z.read(info)], pa.binary())],
                                ["archive", "path", "content"])

    rows = archives.mapInArrow(task, "archive string, path string, content binary")
    return rows.withColumn("role", member_role("path")).where(F.col("role").isNotNull())


def manifest(expanded: DataFrame) -> DataFrame:
    """``archive, member, role, records`` of the expanded CSV members."""
    return expanded.where("pos > 0").groupBy("archive", "member", "role").agg(F.count(F.lit(1)).alias("records"))


def member_rows(expanded: DataFrame, role: str) -> DataFrame:
    """Records of a role as text columns, bound by each member's own header;
    over-long records dropped, short ones padded, file order kept."""
    mine = expanded.where(F.col("role") == role)
    names = F.from_json("layout", "array<string>")          # as many rows as there are different headers
    heads = stored_heads(mine.where("pos = 0").select("layout").distinct().select("layout", names.alias("names")), "members")
    rows = mine.where("pos > 0").select("layout", "archive", F.struct("archive", "member", "pos").alias(ORD), F.col("fields").alias("cells"))
    return bind(rows.withColumn("_file_path", F.col("archive")), heads, ["layout"])[0].drop("layout", "_file_path")
