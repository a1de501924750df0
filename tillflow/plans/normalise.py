"""Uploads in, one parsed inventory out: registry dispatch over all POS kinds.

``normalise(spark, root, registry, as_of)`` takes a folder of uploads.  An upload
is a file ``<root>/<name>`` or a folder of that name holding its parts (also
``<root>/<anything>=<name>/``).  Its name finds the registry row, which gives the
retailer and the POS kind, and so the format and the adapter.  Every kind's
uploads are read together, all retailers at once; the adapters' rows are stacked
and parsed in one pass.

Rejects hold what cannot be used, with a reason: uploads without a registry row,
of an unknown POS kind or of another file type than the kind's, rows without
a product id, rows with more cells than their header (``over_long_row``, the cells as JSON), and cells that
should be numbers and are not (``unparsable_<column>``, with product id and cell; the row itself goes on, as 0).  One (POS kind, path) pair per upload file reaches the driver, as
Spark's own file index does; no data rows do.

Quoted cells of CSV, positional and pipe uploads may hold line ends; a large file is read by
many tasks all the same (``sources/records.py``).
"""

from __future__ import annotations

import functools
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.text import is_blank, strict_double
from tillflow.operators.columns import KEY, ORD
from tillflow.operators.joins import join_registry
from tillflow.plans import feeds
from tillflow.plans.pipeline import unified_inventory
from tillflow.schema import CANONICAL_COLUMNS, NUMERIC_COLUMNS
from tillflow.session import few_listing_tasks, shared_dir, together
from tillflow.sources import archive, dbf, delimited, structured

NAME, PATH = "_file_name", "_file_path"


@dataclass(frozen=True)
class Kind:
    """How a POS kind's uploads are read: ``ext`` of the upload, ``read(spark,
    paths)`` -> (rows, over-long rows or None) for text, or the ``roles`` of an archive's members and their type."""

    ext: str
    prepare: object
    read: object = None
    roles: tuple[str, ...] = ()
    member: str = ".csv"


def _positional(n_cols):
    return lambda spark, paths: delimited.positional(spark, paths, n_cols)


def _pipe(n_cols, drop_last=False):
    return lambda spark, paths: delimited.positional(spark, paths, n_cols, "|", 5, drop_last)


SPIRIT = ("inv", "prc", "stk", "upc")


def kinds(as_of: str) -> dict[str, Kind]:
    """All POS kinds that uploads can have."""
    plain = {"mpower": feeds.feed_mpower, "tiger": feeds.feed_tiger, "lightspeed": feeds.feed_lightspeed,
             "square": feeds.feed_square, "cobaltconnect": feeds.feed_cobaltconnect, "kmds": feeds.feed_kmds,
             "fastraxpos": feeds.feed_fastraxpos, "ptech": feeds.feed_ptech, "lajoypos": feeds.feed_lajoypos}
    out = {pos: Kind(".csv", fn.prepare, delimited.csv_header) for pos, fn in plain.items()}
    bme, wine, cre = (f.prepare for f in (feeds.feed_businessmasterespanol, feeds.feed_winepos, feeds.feed_cashregisterexpress))
    return out | {
        "businessmasterespanol": Kind(".csv", lambda d: bme(d, as_of), delimited.csv_header),
        "winepos": Kind(".csv", lambda d: wine(d, as_of), _positional(23)),
        "cashregisterexpress": Kind(".csv", cre, _pipe(91)),
        "cashregisterexpress_v2": Kind(".csv", lambda d: cre(d, v2=True), _pipe(101, drop_last=True)),
        "spirit2000_xml": Kind(".xml", feeds.feed_spirit2000_xml.prepare, lambda spark, paths: (structured.scan_xml_rows(spark, paths), None)),
        "liquorpos": Kind(".zip", feeds.feed_liquorpos.prepare, roles=("barcodes", "liqcode"), member=".dbf"),
        "liquorpos_csv": Kind(".zip", feeds.feed_liquorpos_csv.prepare, roles=("barcodes", "liqcode")),
        "spirit2000_csv": Kind(".zip", feeds.feed_spirit2000_csv.prepare, roles=SPIRIT),
        "spirit2000_dbf": Kind(".zip", feeds.feed_spirit2000_dbf.prepare, roles=SPIRIT, member=".dbf"),
        "spirit2000_tower": Kind(".zip", feeds.feed_spirit2000_tower.prepare, roles=SPIRIT, member=".dbf"),
        "adventpos": Kind(".zip", feeds.feed_adventpos.prepare, roles=("raw", "itemsize", "itempack")),
    }


def upload_name(path: Column, root: str) -> Column:
    """Name of the upload that a path belongs to: its first part below the root."""
    slash = F.regexp_replace(path, r"^([A-Za-z0-9]+):/+", "$1:/")
    base = root.rstrip("/").split(":", 1)[-1].strip("/").replace("\\E", "")
    below = F.regexp_extract(slash, rf"\Q/{base}/\E(.*)$" if base else "^/*(.*)$", 1)
    first = F.split(below, "/")[0]
    return F.coalesce(F.try_url_decode(F.substring_index(first, "=", -1)), first)


def dispatch(uploads: DataFrame, registry: DataFrame, known: dict[str, Kind]) -> tuple[DataFrame, DataFrame]:
    """(usable uploads with retailer_id and pos, rejected uploads with a reason).
    ``uploads``: path and _file_name."""
    matched, unmatched = join_registry(uploads, registry, NAME)
    pos = F.lower("pos")
    ext = F.create_map(*[F.lit(x) for p, k in known.items() for x in (p, k.ext)])
    reason = (F.when(ext[pos].isNull(), F.lit("unknown_pos"))
              .when(~F.lower(NAME).contains(ext[pos]), F.lit("unrecognized_file_type")))
    judged = matched.withColumns({"pos": pos, "reason": reason})
    bad = (judged.where(F.col("reason").isNotNull()).select(KEY, F.col("pos").alias("source"), "reason", NAME)
           .unionByName(unmatched.select(F.lit(None).cast("string").alias(KEY), F.lit(None).cast("string").alias("source"),
                                         F.lit("no_registry_row").alias("reason"), NAME)).distinct())
    return judged.where(F.col("reason").isNull()).drop("reason"), bad.withColumnRenamed(NAME, "record")


def _members(archives: DataFrame, kind: Kind) -> list[DataFrame]:
    """One frame per role, with the retailer of each archive."""
    owners = archives.select(F.col("path").alias("archive"), KEY)
    if kind.member == ".csv":
        rows = archive.stored(archive.expand_archives(archives.select("path", "content")))
        frames = [archive.member_rows(rows, role) for role in kind.roles]
    else:
        packed, frames = archives.select("path", "content"), []
        fields = dbf.schemas_of(archive.member_files(packed, roles=kind.roles), kind.roles)
        for role in kind.roles:
            d = dbf.decode_files(archive.member_files(packed, roles=(role,)), fields=fields[role])
            frames.append(d.withColumn("archive", F.substring_index(PATH, "!/", 1))
                          .drop(PATH, NAME, "_record", "_invalid"))
    return [f.join(owners, "archive").drop("archive") for f in frames]


def _bad_numbers(prepared: DataFrame) -> Column:
    """array<struct<column, cell>> of a row's texts that do not read as a number."""
    text = [f.name for f in prepared.schema.fields if f.name in NUMERIC_COLUMNS and f.dataType.simpleString() == "string"]
    cells = [F.when(~is_blank(F.col(c)) & strict_double(F.col(c), exponent=True).isNull(),
                    F.struct(F.lit(c).alias("column"), F.col(c).alias("cell"))) for c in text]
    kind = "array<struct<column:string,cell:string>>"
    return F.filter(F.array(*cells), lambda x: x.isNotNull()).cast(kind) if cells else F.array().cast(kind)


def _stored(prepared: DataFrame, pos: str) -> DataFrame:
    """A kind's rows under canonical names, written once to the shared folder:
    uploads are read and joined once for good rows and rejects alike, and the
    stacked plan stays small.  ``_record`` is set where a row has no product id, ``_errors``
    holds the cells that should be numbers and are not (they read as 0)."""
    spark = prepared.sparkSession
    pid = feeds.product_id()
    # in a fixed order: that of the columns depends on which files are read together
    place = {c: i for i, c in enumerate(CANONICAL_COLUMNS)}
    cells = sorted((c for c in prepared.columns if c not in (KEY, ORD)), key=lambda c: (place.get(c, len(place)), c))
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in cells]))
    have = [c for c in CANONICAL_COLUMNS if c in prepared.columns]
    order = [ORD] if ORD in prepared.columns else []
    rows = prepared.select(F.col(KEY).cast("string").alias(KEY), *order, *have,
                           F.when(pid.isNull() | (pid == ""), record).alias("_record"), _bad_numbers(prepared).alias("_errors"))
    path = shared_dir(spark, "normalise", pos)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def normalise(spark: SparkSession, root: str, registry: DataFrame, as_of: str, archives: DataFrame | None = None,
              listed: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed inventory with ``pos``, rejects: retailer_id, source, reason, record).

    ``listed`` (path): the uploads' files, where they are not all that lie below ``root``.
    ``archives`` (path, content; path as below ``root``) stands for the zip
    uploads where they are not files of their own.
    """
    known = kinds(as_of)
    few_listing_tasks(spark)
    if listed is None:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    zips = archives if archives is not None else archive.archive_files(spark, root)
    named = listed.select("path").withColumn(NAME, upload_name(F.col("path"), root))
    named_zips = zips.withColumn(NAME, upload_name(F.col("path"), root))
    uploads = named.unionByName(named_zips.select("path", NAME)).distinct() if archives is not None else named
    good, bad = dispatch(uploads, registry, known)
    paths: dict[str, list[str]] = defaultdict(list)
    for r in good.select("pos", "path").orderBy("pos", "path").collect():
        paths[r["pos"]].append(r["path"])
    owner = good.select(NAME, KEY).distinct()

    def one(pos: str, own: list[str]) -> tuple[DataFrame, list[DataFrame]]:
        """(canonical rows, rejects) of a kind."""
        kind, rejected = known[pos], []
        if kind.read:
            read, long = kind.read(spark, own)
            rows = read.withColumn(NAME, upload_name(F.col(PATH), root)).join(owner, NAME)
            prepared = kind.prepare(rows.drop(NAME, PATH))
            if long is not None:
                of = long.withColumn(NAME, upload_name(F.col(PATH), root)).join(owner, NAME)
                rejected.append(of.select(F.col(KEY).cast("string").alias(KEY), F.lit(pos).alias("source"),
                                          F.lit("over_long_row").alias("reason"), "record"))
        else:
            mine = named_zips.join(good.where(F.col("pos") == pos).select(NAME, KEY).distinct(), NAME)
            prepared = kind.prepare(*_members(mine.select("path", "content", KEY), kind))
        rows = _stored(prepared, pos)
        rejected.append(rows.where("_record is not null").select(
            KEY, F.lit(pos).alias("source"), F.lit("missing_product_id").alias("reason"), F.col("_record").alias("record")))
        bad = rows.where("_record is null and size(_errors) > 0").select(KEY, "rt_product_id", F.explode("_errors").alias("e"))
        rejected.append(bad.select(KEY, F.lit(pos).alias("source"), F.concat(F.lit("unparsable_"), "e.column").alias("reason"),
                                   F.to_json(F.struct("rt_product_id", F.col("e.cell").alias("cell"))).alias("record")))
        return feeds.finish(rows.where("_record is null").drop("_record", "_errors")), rejected

    # a kind's reading is many small jobs, one after the other
    made = dict(zip(paths, together(spark, [functools.partial(one, pos, own) for pos, own in paths.items()])))
    frames = {pos: frame for pos, (frame, _) in made.items()}
    rejected = [bad, *(r for _, of in made.values() for r in of)]
    rejects = rejected[0]
    for r in rejected[1:]:
        rejects = rejects.unionByName(r)
    if not frames:
        empty = spark.createDataFrame([], f"{KEY} string, rt_product_id string, rt_brand_description string, price_regular string, "
                                          f"qty_on_hand string, {ORD} long")
        frames = {"mpower": feeds.finish(empty)}
    return unified_inventory(frames), rejects
