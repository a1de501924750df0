"""Projection / filter / cast steps shared by every feed adapter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions.text import (blank_if_null, numeric_or_zero, strict_double,
                                     strip_dot_zero)
from tillflow.schema import CANONICAL_COLUMNS, NUMERIC_COLUMNS, OPTIONAL_TEXT_COLUMNS

# bookkeeping columns carried next to the feed columns
KEY = "retailer_id"
ORD = "_ord"          # file order of a raw row (orderable, unique per retailer)
META = [KEY, ORD]


def cols_lower(df: DataFrame) -> DataFrame:
    """Lower-case every column name (bookkeeping columns untouched)."""
    return df.toDF(*[c if c in META else c.lower() for c in df.columns])


def cols_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by name; names absent from the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def cols_rename_ordinal(df: DataFrame, mapping: dict[int, str]) -> DataFrame:
    """Rename headerless positional columns ``_c{n}`` to canonical names."""
    return cols_rename(df, {f"_c{n}": name for n, name in mapping.items()})


def cols_backfill(df: DataFrame) -> DataFrame:
    """Add the optional canonical columns a feed does not carry."""
    add = {c: F.lit("") for c in OPTIONAL_TEXT_COLUMNS if c not in df.columns}
    if "price_sale" not in df.columns:
        add["price_sale"] = F.lit(0.0)
    return df.withColumns(add) if add else df


def cast_canonical(df: DataFrame) -> DataFrame:
    """Numbers: unparsable/missing -> 0.0; text: null -> ''; UPC without '.0'."""
    out = {}
    for c in CANONICAL_COLUMNS:
        if c in NUMERIC_COLUMNS:
            out[c] = numeric_or_zero(F.col(c))
        elif c == "rt_upc_code":
            out[c] = strip_dot_zero(blank_if_null(F.col(c)))
        else:
            out[c] = blank_if_null(F.col(c))
    return df.withColumns(out)


def filter_zero_price(df: DataFrame) -> DataFrame:
    """Drop rows whose regular price reads as exactly zero; unparsable kept."""
    p = strict_double(F.col("price_regular").cast("string"), exponent=True)
    return df.where(p.isNull() | (p != 0))


def filter_digit_id(df: DataFrame, col: str = "rt_product_id") -> DataFrame:
    return df.where(F.col(col).rlike("^[0-9]+$"))


def filter_level(df: DataFrame, level: str, col: str = "level") -> DataFrame:
    """Keep one price level ('1' standard, '7' tower); compared as text."""
    return df.where(F.col(col).cast("string") == level)


def cols_canonical(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    keep = [c for c in META if c in df.columns and c != ORD] + CANONICAL_COLUMNS + (extra or [])
    return df.select(*keep)


def add_load_cols(df: DataFrame) -> DataFrame:
    """Load columns; ``retailer_id`` already comes from the registry join."""
    return df.withColumn("active", F.lit(1))


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Dot-flatten nested structs; array columns are dropped (as the source does)."""
    from pyspark.sql.types import ArrayType, StructType

    cols = []

    def walk(prefix, dtype, path):
        for f in dtype.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            ref = path + [f.name]
            if isinstance(f.dataType, StructType):
                walk(name, f.dataType, ref)
            elif isinstance(f.dataType, ArrayType):
                continue
            else:
                cols.append(F.col(".".join(f"`{p}`" for p in ref)).alias(name))

    walk("", df.schema, [])
    return df.select(*cols)


# Member roles of multi-member exports.  A member has a role if
# its lower-case file name ends in one of the names (first listed wins).
MEMBER_ROLES = [("barcodes", "barcodes"), ("liqcode", "liqcode"), ("zz_adventpos_raw_itemsize", "itemsize"),
                ("zz_adventpos_raw_itempack", "itempack"), ("zz_adventpos_raw", "raw"), ("inv", "inv"),
                ("prc", "prc"), ("stk", "stk"), ("upc", "upc")]
MEMBER_TYPES = ("csv", "dbf")


def member_role(path) -> F.Column:
    """Role of a member file by its name (null for members no adapter reads)."""
    name = F.lower(F.regexp_extract(F.col(path) if isinstance(path, str) else path, "([^/]*)$", 1))
    role = F.lit(None).cast("string")
    for token, r in reversed(MEMBER_ROLES):
        role = F.when(name.rlike(rf"{token}\.({'|'.join(MEMBER_TYPES)})$"), F.lit(r)).otherwise(role)
    return role


def role_of(path: str) -> str | None:
    """``member_role`` of one file name, for tasks that open archives."""
    name = path.rsplit("/", 1)[-1].lower()
    return next((r for token, r in MEMBER_ROLES if name.endswith(tuple(f"{token}.{t}" for t in MEMBER_TYPES))), None)


def route_members(df: DataFrame, file_col: str = "_file_name") -> DataFrame:
    """Role of each member file (null for members no adapter reads)."""
    return df.withColumn("member", member_role(file_col))


def member_prune(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keys and the listed columns of a member, those it has."""
    low = cols_lower(df)
    return low.select(*[c for c in META if c in low.columns], *[c for c in cols if c in low.columns])


def filter_shop(df: DataFrame, array: str, id_field: str, shop: str = "shop_id") -> DataFrame:
    """Keep those entries of an array of structs that belong to the row's shop
    (in the row: nothing is exploded or shuffled)."""
    return df.withColumn(array, F.filter(F.col(array), lambda x: x[id_field] == F.col(shop)))


def filter_incremental(df: DataFrame, high_water: DataFrame, ts: str, key: str = KEY) -> DataFrame:
    """Rows newer than their retailer's high-water mark (rows of retailers
    without one are all new).  ``high_water``: (key, hw) -- one row per retailer."""
    j = df.join(high_water, key, "left")
    return j.where(F.col("hw").isNull() | (F.col(ts) > F.col("hw"))).drop("hw")
