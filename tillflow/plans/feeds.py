"""POS feed adapters: raw feed frames -> canonical product rows.

Every adapter is a declarative composition: rename to canonical names, the
POS's own steps, then the shared ``finish`` (backfill optional columns, clean
the product id, drop zero prices, keep the first row per product in file
order, cast).  Raw frames carry ``retailer_id`` and ``_ord`` (file order)
next to the POS's own columns, so many retailers are processed at once and
every dedup / pick / join is keyed by ``retailer_id`` first.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.functions import text as T
from tillflow.operators import pick
from tillflow.operators.columns import (KEY, ORD, cast_canonical, cols_backfill, cols_canonical,
                                        cols_lower, cols_rename, cols_rename_ordinal, filter_digit_id,
                                        filter_level, filter_zero_price, member_prune)
from tillflow.operators.joins import join_anchor_left, join_inner_chain, join_lookup_left
from tillflow.session import compiled_methods
from tillflow.sources.structured import outer_upcs

# ---------------------------------------------------------------------------
# Source column -> canonical column, per POS system.
# ---------------------------------------------------------------------------
MPOWER_MAP = {
    "product_id": "rt_product_id", "upc_code": "rt_upc_code", "brand_name": "rt_brand_name",
    "brand_description": "rt_brand_description", "product_type": "rt_product_type",
    "product_category": "rt_product_category", "package_size": "rt_package_size",
    "sale_price": "price_sale", "casepk": "wholesale_package_size",
}
WINEPOS_MAP = {
    0: "rt_product_id", 12: "rt_upc_code", 1: "rt_brand_description", 14: "rt_product_type",
    4: "rt_item_size", 15: "rt_product_category", 9: "rt_package_size", 7: "unit_price_regular",
    8: "pack_price_regular", 19: "unit_price_sale", 20: "pack_price_sale", 11: "qty_on_hand",
    6: "wholesale_package_size", 21: "sale_date_start", 22: "sale_date_end",
}
TIGER_MAP = {
    "itemid": "rt_product_id", "itemscanid": "rt_upc_code", "itemorder": "rt_brand_name",
    "itemname": "rt_brand_description", "deptid": "rt_product_type", "catgid": "rt_product_category",
    "isize": "rt_package_size", "stdprice": "price_regular", "webprice": "price_sale",
    "qtyonhand": "qty_on_hand",
}
TIGER_DEPT_CODES = (3, 2, 4)      # BEER, LIQUOR, WINE
CRE_MAP = {
    0: "rt_upc_code", 1: "rt_brand_description", 4: "price_regular", 5: "price_sale", 6: "qty_on_hand",
    13: "rt_product_type", 27: "rt_product_category", 36: "rt_package_size", 90: "rt_product_id",
}
CRE_V2_MAP = {
    0: "rt_upc_code", 1: "rt_brand_description", 4: "price_regular", 100: "price_sale", 6: "qty_on_hand",
    94: "rt_product_type", 13: "rt_product_category", 36: "rt_package_size", 90: "rt_product_id",
}
LIQUORPOS_MAP = {
    "code_num": "rt_product_id", "barcode": "rt_upc_code", "brand": "rt_brand_name",
    "descrip": "rt_brand_description", "typenam": "rt_product_type", "size": "rt_package_size",
    "price": "price_regular", "qty_on_hnd": "qty_on_hand", "qty_case": "wholesale_package_size",
}
SPIRIT_DBF_MAP = {
    "sku": "rt_product_id", "upc": "rt_upc_code", "name": "rt_brand_description",
    "typename": "rt_product_type", "qty": "rt_package_size", "sname": "rt_item_size",
    "price": "price_regular", "sale": "price_sale", "back": "qty_on_hand",
}
SPIRIT_CSV_MAP = {
    "sku": "rt_product_id", "upc": "rt_upc_code", "name": "rt_brand_description",
    "typename": "rt_product_type", "qty": "rt_package_size", "sname": "rt_item_size",
    "price": "price_regular", "sale": "price_sale", "pack": "wholesale_package_size",
}
SPIRIT_TOWER_MAP = {
    "sku": "rt_product_id", "upc": "rt_upc_code", "name": "rt_brand_description",
    "typename": "rt_product_type", "qty": "rt_package_size", "sname": "rt_item_size",
    "price": "price_regular", "sale": "price_sale",
}
SPIRIT_XML_MAP = {
    "sku": "rt_product_id", "upccode": "rt_upc_code", "prodname": "rt_brand_description",
    "catname": "rt_product_category", "typename": "rt_product_type", "sizename": "rt_item_size",
    "unitprice": "price_regular", "sale": "price_sale", "stockqty": "qty_on_hand",
    "pack": "wholesale_package_size", "onsale": "onsale",
}
SPIRIT_INV = ["sku", "name", "sname", "ml", "pack", "sdate", "typename", "websent", "sent"]
SPIRIT_STANDARD_LEVEL = "1"
SPIRIT_TOWER_LEVEL = "7"
LIGHTSPEED_MAP = {
    "systemsku": "rt_product_id", "upc": "rt_upc_code", "description": "rt_brand_description",
    "fullpathname": "rt_product_type", "name": "rt_product_category", "amount": "price_regular",
    "qoh": "qty_on_hand",
}
SQUARE_MAP = {
    "item_variation_object_id": "rt_product_id", "item_variation_data.sku": "rt_upc_code",
    "item_data.name": "rt_brand_description", "item_data.product_type": "rt_product_type",
    "category_data.name": "rt_product_category", "item_variation_data.name": "rt_package_size",
    "item_variation_data.price_money.amount": "price_regular", "quantity": "qty_on_hand",
}
COBALT_MAP = {
    "code": "rt_product_id", "sku": "rt_upc_code", "name": "rt_brand_description",
    "size": "rt_item_size", "retail_price": "price_regular", "stock": "qty_on_hand",
}
KMDS_MAP = {
    "id": "rt_product_id", "description": "rt_brand_description", "price": "price_regular",
    "onhand": "qty_on_hand", "salesdepartmentid": "rt_product_category",
    "description_2": "rt_item_size",
}
ADVENT_MAP = {
    "sku": "rt_product_id", "mainupc": "rt_upc_code", "itemname": "rt_brand_name",
    "description": "rt_brand_description", "catid": "rt_product_type", "packname": "rt_package_size",
    "sizename": "rt_item_size", "priceperunit": "price_regular", "isserialized": "price_sale",
    "instoreqty": "qty_on_hand",
}
ADVENT_DEPT_CODES = (5, 1, 2)     # BEER, LIQUOR, WINE
BME_MAP = {
    "sku": "rt_product_id", "upc": "rt_upc_code", "product name": "rt_brand_description",
    "contenido": "rt_package_size", "quantity": "qty_on_hand", "price": "price_regular",
    "saleprice": "price_sale", "department": "rt_product_type",
}
FASTRAX_MAP = {
    "row_id": "rt_product_id", "plu_num": "rt_upc_code", "plu_desc": "rt_brand_description",
    "dept_grp": "rt_product_type", "category": "rt_product_category", "class": "rt_package_size",
    "sub_class": "rt_item_size", "qty_on_hand": "qty_on_hand", "last_price": "price_regular",
}
PTECH_MAP = {
    "sku": "rt_product_id", "mainupc": "rt_upc_code", "itemname": "rt_brand_description",
    "deptname": "rt_product_type", "instoreqty": "qty_on_hand", "priceperunit": "price_regular",
}
# ---------------------------------------------------------------------------

KEYS = [KEY, "rt_product_id"]


def adapter(prepare):
    """A feed adapter: ``prepare`` maps raw frames to rows under canonical names,
    the adapter finishes them.  ``adapter.prepare`` is kept for ``rejects``."""
    @functools.wraps(prepare)
    def feed(*args, **kwargs):
        return finish(prepare(*args, **kwargs))
    feed.prepare = prepare
    return feed


def product_id():
    return T.strip_dot_zero(F.col("rt_product_id").cast("string"))


def clean_id(df: DataFrame) -> DataFrame:
    """Product id as text without any '.0'; rows with no id go to ``rejects``."""
    pid = product_id()
    return df.withColumn("rt_product_id", pid).where(pid.isNotNull() & (pid != ""))


def finish(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Shared tail of every adapter -> retailer_id + 13 canonical columns."""
    compiled_methods(df.sparkSession)
    df = cols_backfill(df)
    df = clean_id(df)
    df = filter_zero_price(df)
    if ORD not in df.columns:
        df = df.withColumn(ORD, F.lit(0))
    # cast first: what the pick shuffles is then less than the texts
    df = cols_canonical(cast_canonical(df), [ORD, *(extra or [])])
    return cols_canonical(pick.dedup_first_in_file(df, KEYS), extra)


def rejects(prepared: DataFrame, source: str) -> DataFrame:
    """Rows of a prepared feed that ``finish`` cannot use, with a reason
    (missing product id) and the whole record as JSON."""
    pid = product_id() if "rt_product_id" in prepared.columns else F.lit(None).cast("string")
    bad = prepared.where(pid.isNull() | (pid == ""))
    rec = F.to_json(F.struct(*[F.col(f"`{c}`") for c in prepared.columns if c not in (KEY, ORD)]))
    return bad.select(F.col(KEY).cast("string").alias(KEY), F.lit(source).alias("source"),
                      F.lit("missing_product_id").alias("reason"), rec.alias("record"))


def _wholesale_pack(df: DataFrame, word: str = " Pack", strip: bool = True) -> DataFrame:
    w = F.col("wholesale_package_size").cast("string")
    txt = T.strip_dot_zero(w) if strip else w
    return df.withColumn("wholesale_package_size",
                         F.when(w.isNull(), F.lit("")).otherwise(F.concat(txt, F.lit(word))))


@adapter
def feed_mpower(raw: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(raw), MPOWER_MAP)
    if "wholesale_package_size" in df.columns:
        q = T.strict_double(F.col("qty_on_hand").cast("string"), exponent=True)
        w = T.strict_double(F.col("wholesale_package_size").cast("string"), exponent=True)
        df = df.withColumns({
            "rt_wholesale_qty": F.coalesce(T.float_text(F.try_divide(q, w)), F.lit("")),
            "wholesale_package_size": F.when(w.isNotNull(), F.concat(T.integer_text(w), F.lit(" Pack")))
                                       .otherwise(F.lit("")),
        })
    return df


@adapter
def feed_winepos(raw: DataFrame, as_of: str) -> DataFrame:
    df = cols_rename_ordinal(raw, WINEPOS_MAP)
    num = {c: T.strict_double(F.col(c).cast("string"), exponent=True)
           for c in ("pack_price_regular", "unit_price_regular", "unit_price_sale", "pack_price_sale")}
    start, end = T.parse_ts(F.col("sale_date_start")), T.parse_ts(F.col("sale_date_end"))
    df = df.withColumns({
        "price_regular": T.price_pack_or_unit(num["pack_price_regular"], num["unit_price_regular"]),
        "price_sale": T.sale_in_window(num["pack_price_sale"], num["unit_price_sale"], start, end, as_of),
        "qty_on_hand": T.safe_divide(T.strict_double(F.col("qty_on_hand").cast("string"), exponent=True),
                                     T.strict_double(F.col("rt_package_size").cast("string"), exponent=True)),
        "rt_package_size": F.concat(T.blank_if_null(F.col("rt_package_size")), F.lit(" Pack")),
    })
    df = _wholesale_pack(df)
    return df


@adapter
def feed_tiger(raw: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(raw), TIGER_MAP)
    df = df.withColumn("rt_product_type", T.dept_code_type(F.col("rt_product_type"), *TIGER_DEPT_CODES))
    return df


@adapter
def feed_cashregisterexpress(raw: DataFrame, v2: bool = False) -> DataFrame:
    df = cols_rename_ordinal(raw, CRE_V2_MAP if v2 else CRE_MAP)
    df = df.withColumns({
        "rt_product_id": T.id_remove_dash(F.col("rt_product_id").cast("string")),
        "price_sale": T.numeric_or_zero(F.col("price_sale")),
    })
    return df


def _liquorpos(barcodes: DataFrame, liqcode: DataFrame, digits_only: bool) -> DataFrame:
    b = cols_lower(barcodes).select(KEY, "code_num", "barcode", *([ORD] if ORD in barcodes.columns else []))
    lc = cols_lower(liqcode).drop("barcode")
    if ORD in lc.columns and ORD in b.columns:
        lc = lc.withColumnRenamed(ORD, "_ord_liq")
    df = join_inner_chain([b, lc], [KEY, "code_num"])
    if "_ord_liq" in df.columns:
        df = df.withColumn(ORD, F.struct(F.col(ORD), F.col("_ord_liq"))).drop("_ord_liq")
    df = cols_rename(df, LIQUORPOS_MAP)
    if digits_only:
        df = filter_digit_id(df.withColumn("rt_product_id", F.col("rt_product_id").cast("string")))
    df = df.withColumns({
        "rt_product_category": F.col("rt_product_type"),
        "rt_brand_description": T.desc_compose(F.col("rt_brand_name"), F.col("rt_brand_description")),
    })
    df = _wholesale_pack(df)
    return df


@adapter
def feed_liquorpos(barcodes: DataFrame, liqcode: DataFrame) -> DataFrame:
    return _liquorpos(barcodes, liqcode, digits_only=True)


@adapter
def feed_liquorpos_csv(barcodes: DataFrame, liqcode: DataFrame) -> DataFrame:
    return _liquorpos(barcodes, liqcode, digits_only=False)


def spirit_prices(prc: DataFrame, level: str, max_qty: bool) -> DataFrame:
    """Price member: one level, then max QTY and newest (or newest only)."""
    p = cols_lower(prc)
    p = filter_level(p, level)
    p = p.withColumn("tstamp", T.parse_ts(F.col("tstamp")) if dict(p.dtypes)["tstamp"] == "string"
                     else F.col("tstamp").cast("timestamp_ntz"))
    keys = [KEY, "sku"]
    if max_qty:
        p = pick.keep_maxqty_then_latest(p, keys, "qty", "tstamp")
    else:
        p = pick.keep_latest(p, keys, "tstamp")
    cols = [c for c in ("sku", "qty", "price", "sale", "onsale", "who", "level") if c in p.columns]
    out = p.select(KEY, *cols, *([F.col(ORD).alias("_ord_prc")] if ORD in p.columns else []))
    return out


def spirit_latest(member: DataFrame, keep: list[str], ts: str = "tstamp") -> DataFrame:
    m = cols_lower(member)
    m = m.withColumn(ts, T.parse_ts(F.col(ts)) if dict(m.dtypes)[ts] == "string"
                     else F.col(ts).cast("timestamp_ntz"))
    m = pick.keep_latest(m, [KEY, "sku"], ts)
    extra = [F.col(ORD).alias("_ord_" + keep[-1])] if ORD in m.columns else []
    return m.select(KEY, "sku", *keep, *extra)


def _spirit_rows(df: DataFrame, mapping: dict, pack_word_cols: list[str]) -> DataFrame:
    tie = [c for c in ("_ord_upc", "_ord_prc", "_ord_back") if c in df.columns]
    df = df.withColumn(ORD, F.struct(*[F.col(c) for c in tie]) if tie else F.lit(0))
    df = pick.first_per_key(df, [KEY, "sku"],
                            [F.col("upc").isNull(), F.col("upc").cast("string").try_cast("double"),
                             F.col("upc").cast("string"), F.col(ORD)], tiebreak_all=True)
    df = df.drop(*tie)
    df = cols_rename(df, mapping)
    adds = {}
    for c in pack_word_cols:
        if c in df.columns:
            adds[c] = F.concat(T.blank_if_null(F.col(c).cast("string")), F.lit(" pack"))
    if adds:
        df = df.withColumns(adds)
    return df


@adapter
def feed_spirit2000_csv(inv: DataFrame, prc: DataFrame, stk: DataFrame, upc: DataFrame) -> DataFrame:
    members = {
        "inv": member_prune(inv, SPIRIT_INV).drop(ORD),
        "prc": spirit_prices(prc, SPIRIT_STANDARD_LEVEL, max_qty=True),
        "stk": spirit_latest(stk, ["back"]),
        "upc": spirit_latest(upc, ["upc"]),
    }
    df = join_anchor_left(members, [KEY, "sku"])
    df = df.withColumn("qty_on_hand", T.safe_divide(F.col("back"), F.col("qty")))
    return _spirit_rows(df, SPIRIT_CSV_MAP, ["rt_package_size", "wholesale_package_size"])


@adapter
def feed_spirit2000_dbf(inv: DataFrame, prc: DataFrame, stk: DataFrame, upc: DataFrame) -> DataFrame:
    i = member_prune(inv, SPIRIT_INV).drop(ORD)
    df = join_inner_chain([i, spirit_prices(prc, SPIRIT_STANDARD_LEVEL, max_qty=True),
                           spirit_latest(stk, ["back"]), spirit_latest(upc, ["upc"])], [KEY, "sku"])
    return _spirit_rows(df, SPIRIT_DBF_MAP, ["rt_package_size"])


@adapter
def feed_spirit2000_tower(inv: DataFrame, prc: DataFrame, stk: DataFrame, upc: DataFrame,
                          upc_ts: str = "last") -> DataFrame:
    i = member_prune(inv, SPIRIT_INV).drop(ORD)
    df = join_inner_chain([i, spirit_prices(prc, SPIRIT_TOWER_LEVEL, max_qty=False),
                           spirit_latest(stk, ["back"]), spirit_latest(upc, ["upc"], ts=upc_ts)], [KEY, "sku"])
    df = df.withColumn("qty_on_hand", T.safe_divide(F.col("back"), F.col("qty")))
    return _spirit_rows(df.drop("back"), SPIRIT_TOWER_MAP, ["rt_package_size"])


@adapter
def feed_spirit2000_xml(rows: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(rows), SPIRIT_XML_MAP)
    sale = T.strict_double(F.col("price_sale").cast("string"), exponent=True)
    df = df.withColumns({
        "wholesale_package_size": F.concat(T.blank_if_null(F.col("wholesale_package_size")), F.lit(" pack")),
        "price_sale": T.sale_flag(F.col("onsale").cast("string"), sale),
    })
    return df


@adapter
def feed_lightspeed(items: DataFrame) -> DataFrame:
    return cols_rename(cols_lower(items), LIGHTSPEED_MAP)


@adapter
def feed_square(rows: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(rows), SQUARE_MAP)
    df = df.withColumn("price_regular", T.cents_to_units(
        T.strict_double(F.col("price_regular").cast("string"), exponent=True)))
    return df


@adapter
def feed_cobaltconnect(raw: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(raw), COBALT_MAP)
    df = df.withColumn("rt_upc_code", T.upc_strip_prefix(F.col("rt_upc_code").cast("string")))
    if "wholesale_package_size" in df.columns:
        df = df.withColumn("wholesale_package_size", T.wholesale_label(F.col("wholesale_package_size")))
    return df


def kmds_wholesale(case_qty, units) -> F.Column:
    """Case size > 1 -> 'N Pack'; else integer-like units per case -> 'N Pack'; else ''."""
    cq = T.strict_double(F.col(case_qty).cast("string"), exponent=True)
    return F.when(cq > 1, F.concat(T.integer_text(cq), F.lit(" Pack"))).otherwise(
        T.wholesale_label(F.col(units)))


@adapter
def feed_kmds(raw: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(raw), KMDS_MAP)
    df = df.withColumns({
        "rt_product_id": F.col("rt_product_id").cast("string"),
        "rt_upc_code": T.upc_same_as_id(F.col("upcitemid").cast("string"), F.col("rt_product_id").cast("string")),
    })
    adds = {"rt_product_category": F.col("rt_product_category").cast("string"),
            "wholesale_package_size": kmds_wholesale("sizecaseqty", "unitspercase")}
    if "rt_item_size" in df.columns:
        adds["rt_item_size"] = T.size_oz(F.col("rt_item_size").cast("string"))
    # fewer columns go through the pick's shuffle than the feed has
    df = df.withColumns(adds).drop("upcitemid", "sizecaseqty", "unitspercase")
    return pick.keep_longest(df, [KEY, "rt_product_id"], "rt_upc_code")


@adapter
def feed_adventpos(raw: DataFrame, itemsize: DataFrame, itempack: DataFrame) -> DataFrame:
    items = cols_lower(raw)
    df = join_lookup_left(items, cols_lower(itempack).select(KEY, "packid", "packname"), ["packid"])
    df = join_lookup_left(df, cols_lower(itemsize).select(KEY, "sizeid", "sizename"), ["sizeid"])
    df = cols_rename(df, ADVENT_MAP)
    dept = T.dept_code_type(F.col("rt_product_type"), *ADVENT_DEPT_CODES)
    df = df.withColumns({
        "rt_package_size": T.split_first(F.col("rt_package_size")),
        "rt_product_type": dept,
        "rt_product_category": dept,
        "rt_brand_description": T.desc_compose(F.col("rt_brand_name"), F.col("rt_brand_description")),
    })
    if "price_sale" in df.columns:
        df = df.withColumn("price_sale", T.numeric_or_zero(F.col("price_sale")))
    return df


@adapter
def feed_businessmasterespanol(raw: DataFrame, as_of: str) -> DataFrame:
    df = cols_rename(cols_lower(raw), BME_MAP)
    start, end = T.parse_ts(F.col("salestartdate")), T.parse_ts(F.col("saleenddate"))
    reg = T.strict_double(F.col("price_regular").cast("string"), exponent=True)
    sale = T.strict_double(F.col("price_sale").cast("string"), exponent=True)
    df = df.withColumns({
        "rt_upc_code": F.col("rt_product_id").cast("string"),
        "rt_product_id": T.id_compose(F.col("rt_product_id").cast("string"), F.col("rt_package_size").cast("string")),
        "rt_package_size": F.concat(T.blank_if_null(F.col("rt_package_size")), F.lit(" Pack")),
        "price_sale": T.sale_in_window_diff(reg, sale, start, end, as_of),
    })
    return df


@adapter
def feed_fastraxpos(raw: DataFrame) -> DataFrame:
    return cols_rename(cols_lower(raw), FASTRAX_MAP)


@adapter
def feed_ptech(raw: DataFrame) -> DataFrame:
    df = cols_rename(cols_lower(raw), PTECH_MAP)
    return df.withColumn("rt_upc_code", T.upc_digits_only(F.col("rt_upc_code").cast("string")))


@adapter
def feed_lajoypos(raw: DataFrame) -> DataFrame:
    df = cols_lower(raw)
    return df.withColumn("rt_upc_code", T.upc_digits_only(F.col("rt_upc_code").cast("string")))


def mpower_api_rows(items: DataFrame) -> DataFrame:
    """Landed item pages (one row per item, ``AdditionalUpcs`` array) ->
    base-feed columns: one row per item and extra UPC (outer)."""
    x = outer_upcs(items)
    if ORD in x.columns:
        x = x.withColumn(ORD, F.struct(F.col(ORD).alias("item"), F.col("_pos").alias("pos")))
    up, ret, qty = F.col("_add.Upc"), F.col("_add.Retail"), F.col("_add.Quantity")
    return x.select(
        *[c for c in (KEY, ORD) if c in x.columns],
        F.col("SkuNumber").cast("string").alias("product_id"),
        T.coalesce_upc(F.col("Upc").cast("string") if "Upc" in items.columns else F.lit(None).cast("string"),
                       up.cast("string")).alias("upc_code"),
        F.col("Name").alias("brand_description"),
        F.col("Department").alias("product_type"),
        F.col("Category").alias("product_category"),
        F.col("CaseQuantity").cast("string").alias("casepk"),
        T.retail_coalesce(ret, F.col("Retail"), F.col("CaseRetail"), F.col("CaseQuantity"))
         .cast("string").alias("price_regular"),
        T.qty_units(F.col("QuantityOnHand"), qty).cast("string").alias("qty_on_hand"),
        T.size_label(F.col("Size").cast("string"), qty).alias("package_size"),
    )


@adapter
def feed_mpower_api(items: DataFrame) -> DataFrame:
    return feed_mpower.prepare(mpower_api_rows(items))
