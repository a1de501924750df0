"""Feeds derived from the driver's tables (TPC-H-like parquet).

Each builder reads the given tables with Spark and shapes them like a POS
export (all text columns, ids, barcodes, pack texts, price history...), so
every registered query grows with the input tables.  The same shapes are
written in SQL in ``tillflow.plans.oracle`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.columns import ORD


def table(spark: SparkSession, sf_dir, name: str, partitions: int | None = None) -> DataFrame:
    """A driver table.  ``sf_dir`` may also be a dict of frames, which then stand
    for the tables they name.  ``partitions`` deals the rows out explicitly: for a
    table that lies in one row group and goes straight into CPU-heavy narrow work."""
    df = sf_dir[name] if isinstance(sf_dir, dict) else spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions) if partitions else df


def numbers(spark, n: int, name: str) -> DataFrame:
    return spark.range(n).select(F.col("id").alias(name))


def line_ord() -> F.Column:
    """File order of a lineitem-derived row.  (l_orderkey, l_linenumber)
    repeats in the driver data, so the order key carries enough columns to
    be unique."""
    return F.struct(*[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                         "l_extendedprice", "l_quantity")])


def line_no() -> F.Column:
    """Integer line number (display / per-row variation; not unique)."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


#: Orders in a part of a retailer's export: files hold a bounded range of rows.
PART_ORDERS = 100_000


def part_no() -> F.Column:
    """Number of the export file that a line belongs to (rises with file order)."""
    return F.floor(F.col("l_orderkey") / PART_ORDERS).cast("long")


def s(c) -> F.Column:
    """Text of a number column (ints print plainly)."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# Pack phrases appended to part names (F1) by p_partkey % 12.
F1_PHRASES = ["6 PK 12 OZ CANS", "12/ PK BTL", "750 ML", "1.75L", "1/2 KEG", "24-PACK 12OZ BOTTLE",
              "BOMBER", "PINT", "2/12/16 OZ", "5KG", "6-12PK", "SINGLE"]


def f1_base(spark, sf_dir) -> DataFrame:
    """Base (MPower-style) feed: pack texts, dirty ids, zero/unparsable prices."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    phrase = F.element_at(F.array(*[F.lit(x) for x in F1_PHRASES]), (k % 12 + 1).cast("int"))
    return p.select(
        s(k % 10 + 1).alias("retailer_id"),
        k.alias(ORD),
        F.when(k % 89 == 0, F.lit("")).otherwise(s(k)).alias("product_id"),
        F.concat(F.lit("0"), s(k * 7919), F.when(k % 10 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("upc_code"),
        F.col("p_brand").alias("brand_name"),
        F.concat(F.col("p_name"), F.lit(" "), phrase).alias("brand_description"),
        F.col("p_type").alias("product_type"),
        s("p_size").alias("product_category"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(s("p_size"), F.lit(" pk"))).alias("package_size"),
        F.when(k % 17 == 0, F.lit("0")).when(k % 19 == 0, F.lit("n/a")).otherwise(s("p_retailprice")).alias("price_regular"),
        F.when(k % 3 == 0, s(F.col("p_retailprice") * 0.5)).otherwise(F.lit("")).alias("sale_price"),
        s(F.col("p_size") * 3).alias("qty_on_hand"),
        s(F.when(k % 23 == 0, F.lit(0)).otherwise(F.col("p_size"))).alias("casepk"),
    )


# Pack phrase shapes for the line-level text feed (F8), chosen
# by (l_orderkey + l_linenumber) % 16; {q} quantity, {s} part size, {n} line.
F8_SHAPES = [
    "{q} PK {s} OZ CANS", "{q}/ PK BTL", "{s}0 ML", "1.{n}L", "1/{n} KEG", "{q}-PACK {s}OZ BOTTLE",
    "BOMBER", "PINT {s}", "{n}/{q}/{s} OZ", "{s}KG", "{n}-{q}PK", "{q}PCK {n} GAL",
    "{s} LTR TETRA", "{q} PC {s}FL OZ POUCH", "{s} GAL BOX ", "M{s} JUG ALUM BTL",
]


def _shape_expr(shape: str, q, sz, n):
    parts, buf, i = [], "", 0
    while i < len(shape):
        if shape[i] == "{":
            j = shape.index("}", i)
            if buf:
                parts.append(F.lit(buf))
                buf = ""
            parts.append({"q": q, "s": sz, "n": n}[shape[i + 1:j]])
            i = j + 1
        else:
            buf += shape[i]
            i += 1
    if buf:
        parts.append(F.lit(buf))
    return F.concat(*parts)


def f8_lines(spark, sf_dir, partitions: int | None = None) -> DataFrame:
    """Line-level product feed: one row per lineitem, many retailers
    (l_suppkey), pack text built from the line's own numbers."""
    li = table(spark, sf_dir, "lineitem", partitions).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_tax")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey, "inner")
    q = F.col("l_quantity").cast("long").cast("string")
    sz = s("p_size")
    n = s("l_linenumber")
    sel = (F.col("l_orderkey") + F.col("l_linenumber")) % 16
    phrase = None
    for i, shape in enumerate(F8_SHAPES):
        e = _shape_expr(shape, q, sz, n)
        phrase = F.when(sel == i, e) if phrase is None else phrase.when(sel == i, e)
    return j.select(
        s("l_suppkey").alias("retailer_id"),
        line_ord().alias(ORD), line_no().alias("_line"),
        s(F.col("l_partkey")).alias("product_id"),
        s(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("upc_code"),
        F.col("p_brand").alias("brand_name"),
        F.concat(F.col("p_name"), F.lit(" "), phrase).alias("brand_description"),
        F.col("p_type").alias("product_type"),
        s("p_size").alias("product_category"),
        F.concat(n, F.lit(" pk")).alias("package_size"),
        s("l_extendedprice").alias("price_regular"),
        F.when(F.col("l_tax") > 0.04, s(F.col("l_extendedprice") * 0.5)).otherwise(F.lit("")).alias("sale_price"),
        q.alias("qty_on_hand"),
    )


def f2_inv(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_type")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(s("l_suppkey").alias("retailer_id"), s("p_partkey").alias("sku"), F.col("p_name").alias("name"),
                    F.concat(s("p_size"), F.lit(" OZ")).alias("sname"), F.col("p_size").alias("pack"),
                    F.col("p_type").alias("typename"))
            .distinct())


def f2_prc(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        s("l_suppkey").alias("retailer_id"),
        line_ord().alias(ORD), line_no().alias("_line"),
        s("l_partkey").alias("sku"), F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_discount") > 0.05, F.col("l_extendedprice") * 0.5).otherwise(F.lit(0.0)).alias("sale"),
        F.when(F.col("l_returnflag") == "R", F.lit("T")).otherwise(F.lit("F")).alias("onsale"),
        s("l_linenumber").alias("level"), F.col("l_shipdate").alias("tstamp"))


def f2_stk(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        s("l_suppkey").alias("retailer_id"), line_ord().alias(ORD), line_no().alias("_line"),
        F.when(F.col("l_linestatus") == "O", s("l_partkey")).otherwise(F.concat(F.lit("x"), s("l_partkey"))).alias("sku"), F.col("l_quantity").alias("back"),
        F.col("l_shipdate").alias("tstamp"))


def f2_upc(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey")
    return li.select(
        s("l_suppkey").alias("retailer_id"),
        line_ord().alias(ORD), line_no().alias("_line"),
        s("l_partkey").alias("sku"),
        F.when(ok % 11 == 0, F.lit(None).cast("string")).otherwise(s(ok * 10 + F.col("l_linenumber"))).alias("upc"),
        F.when(ok % 13 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")).alias("tstamp"))


F3_RETAILERS = 12


def f3_items(spark, sf_dir) -> DataFrame:
    """Items of several retailers; pack and size ids are shared, their names not."""
    p = table(spark, sf_dir, "part")
    return p.select(s(F.col("p_partkey") % F3_RETAILERS).alias("retailer_id"), F.col("p_partkey").alias(ORD),
                    s("p_partkey").alias("sku"), F.col("p_name").alias("itemname"), F.col("p_brand").alias("description"),
                    s(F.col("p_size") % 7).alias("packid"), s(F.col("p_size") % 30).alias("sizeid"),
                    s(F.col("p_size") % 6).alias("catid"), s("p_retailprice").alias("priceperunit"),
                    s(F.col("p_partkey") * 13).alias("mainupc"), s(F.col("p_size") * 2).alias("instoreqty"))


def f3_pack(spark, sf_dir) -> DataFrame:
    r = table(spark, sf_dir, "region").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(F3_RETAILERS - 1))))
    return r.select(s("r").alias("retailer_id"), F.col("r_regionkey").alias(ORD), s("r_regionkey").alias("packid"),
                    F.concat(s(F.col("r_regionkey") * 6 + F.col("r")), F.lit(" PK,"), F.col("r_name")).alias("packname"))


def f3_size(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(F3_RETAILERS - 1))))
    return n.select(s("r").alias("retailer_id"), F.col("n_nationkey").alias(ORD), s("n_nationkey").alias("sizeid"),
                    F.concat(s(F.col("n_nationkey") * 50 + F.col("r")), F.lit(" ML")).alias("sizename"))


def f4_registry(spark, sf_dir) -> DataFrame:
    su = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return su.select(
        k.alias("id"),
        F.when(k % 4 == 0, F.lit("MPower")).when(k % 4 == 1, F.lit("spirit2000_csv"))
         .when(k % 4 == 2, F.lit("AdventPOS")).otherwise(F.lit("unknown")).alias("pos"),
        F.col("s_name").alias("name"),
        F.concat(F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("_"))), F.lit(".csv")).alias("filename"),
        s("s_nationkey").alias("shopid"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("x")).alias("refreshtoken"))


def f5_sale(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") < 0.03, F.lit(0.0)).otherwise(F.col("l_extendedprice")).alias("pack_price"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.when(F.col("l_tax") < 0.02, F.lit(0.0)).otherwise(F.col("l_extendedprice") * 0.5).alias("pack_sale"),
        (F.col("l_extendedprice") * 0.25).alias("unit_sale"),
        F.col("l_shipdate").alias("sale_start"),
        (F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS")).alias("sale_end"))


def f6_barcodes(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    return li.select(
        s("l_suppkey").alias("retailer_id"),
        line_ord().alias(ORD), line_no().alias("_line"),
        s(pk).alias("id"), "l_orderkey", "l_linenumber",
        F.when(ok % 7 == 0, F.lit(None).cast("string")).when(ok % 5 == 0, s(pk)).otherwise(s(ok)).alias("upcitemid"),
        (F.col("l_linenumber") % 4).alias("sizecaseqty"), s("l_linenumber").alias("unitspercase"),
        F.concat(F.lit("ITEM "), s(pk)).alias("description"), s("l_extendedprice").alias("price"),
        s("l_quantity").alias("onhand"), s(F.col("l_suppkey") % 7).alias("salesdepartmentid"),
        F.when(F.col("l_linenumber") == 7, F.lit("LARGE")).otherwise(s(F.col("l_quantity") * 0.05))
         .alias("description_2"))


def f4_incoming(spark, sf_dir) -> DataFrame:
    """Incoming file names: exact, upper-cased, wrong extension, unknown."""
    su = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    fname = F.concat(F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("_"))), F.lit(".csv"))
    return su.select(
        k.alias(ORD),
        F.when(k % 5 == 0, F.concat(F.lit("missing_"), s(k), F.lit(".csv")))
         .when(k % 7 == 0, F.replace(fname, F.lit(".csv"), F.lit(".xlsx")))
         .when(k % 2 == 0, F.upper(fname)).otherwise(fname).alias("_file_name"))


def _lines_parts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey)


def winepos_raw(spark, sf_dir) -> DataFrame:
    """Tab-separated, headerless, 23 positions (F8 shapes, sale windows)."""
    j = _lines_parts(spark, sf_dir)
    ship = F.col("l_shipdate")
    vals = {
        0: s("l_partkey"), 1: F.col("p_name"), 4: F.concat(s("p_size"), F.lit(" OZ")),
        6: F.concat(s("l_linenumber"), F.lit(".0")),
        7: s(F.col("l_extendedprice") / F.col("l_quantity")),
        8: F.when(F.col("l_discount") < 0.03, F.lit("0")).otherwise(s("l_extendedprice")),
        9: s(F.col("l_linenumber") % 4), 11: s("l_quantity"), 12: s(F.col("l_orderkey") * 10 + F.col("l_linenumber")),
        14: F.col("p_type"), 15: F.col("p_brand"), 19: s(F.col("l_extendedprice") * 0.25),
        20: F.when(F.col("l_tax") < 0.02, F.lit("0")).otherwise(s(F.col("l_extendedprice") * 0.5)),
        21: F.date_format(ship, "yyyy-MM-dd"), 22: F.date_format(ship + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd"),
    }
    cols = [vals.get(i, F.lit("x")).alias(f"_c{i}") for i in range(23)]
    return j.select(s("l_suppkey").alias("retailer_id"), line_ord().alias(ORD), line_no().alias("_line"),
                    *cols)


#: Lines before and behind the data of each file of a register export; v1 has no trailer.
CRE_HEAD = "".join(f"EXPORT HEADER {i}\n" for i in range(1, 6))
CRE_TAIL = "TOTAL|{n}\n"


def cre_lines(spark, sf_dir, v2: bool = False) -> DataFrame:
    """Pipe-separated register export: the data lines, between CRE_HEAD and (v2) CRE_TAIL in every file."""
    j = _lines_parts(spark, sf_dir)
    n_cols = 101 if v2 else 91
    sale_pos, type_pos, cat_pos = (100, 94, 13) if v2 else (5, 13, 27)
    vals = {
        0: s(F.col("l_orderkey") * 10 + F.col("l_linenumber")), 1: F.col("p_name"), 4: s("l_extendedprice"),
        sale_pos: F.when(F.col("l_tax") > 0.04, s(F.col("l_extendedprice") * 0.5)).otherwise(F.lit("N/A")),
        6: s("l_quantity"), type_pos: F.col("p_type"), cat_pos: F.col("p_brand"),
        36: F.concat(s("p_size"), F.lit(" PK")), 90: F.concat(s("l_partkey"), F.lit("-0")),
    }
    line = F.concat_ws("|", *[vals.get(i, F.lit("")) for i in range(n_cols)])
    return j.select(s("l_suppkey").alias("retailer_id"), part_no().alias("_part"), line_ord().alias(ORD), line.alias("value"))


def cre_rows(spark, sf_dir, v2: bool) -> DataFrame:
    """The data rows of the register export, already split into ``_c0`` ..."""
    n = 101 if v2 else 91
    cells = F.split("value", "[|]")
    return cre_lines(spark, sf_dir, v2).select("retailer_id", ORD, *[cells[i].alias(f"_c{i}") for i in range(n)])


def spirit_xml_rows(spark, sf_dir) -> DataFrame:
    j = _lines_parts(spark, sf_dir)
    return j.select(
        s("l_suppkey").alias("retailer_id"), line_ord().alias(ORD), line_no().alias("_line"),
        s("l_partkey").alias("sku"), s(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("upccode"),
        F.col("p_name").alias("prodname"), F.col("p_brand").alias("catname"), F.col("p_type").alias("typename"),
        F.concat(s("p_size"), F.lit(" OZ")).alias("sizename"), s("l_extendedprice").alias("unitprice"),
        s(F.col("l_extendedprice") * 0.5).alias("sale"), s("l_quantity").alias("stockqty"),
        s("l_linenumber").alias("pack"),
        F.when(F.col("l_returnflag") == "R", F.lit("T")).otherwise(F.lit("F")).alias("onsale"))


def mpower_pages(spark, sf_dir) -> DataFrame:
    """MPower API pages: items (orders) with an array of additional UPCs
    (their lines); 100 items per page.  Retailer 3 declares one page too many."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    adds = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        F.col("l_linenumber").cast("string").alias("Upc"), F.col("l_extendedprice").alias("Retail"),
        F.col("l_quantity").alias("Quantity")))).alias("AdditionalUpcs"))
    k = F.col("o_orderkey")
    items = o.join(adds, o.o_orderkey == adds.l_orderkey, "left").select(
        s(F.col("o_custkey") % 10).alias("retailer_id"), (k / 100).cast("long").alias("page"),
        F.struct(k.alias("Id"), s(k % 5000).alias("SkuNumber"), F.col("o_orderpriority").alias("Name"),
                 F.lit("SPIRITS").alias("Department"), F.col("o_orderpriority").alias("Category"),
                 F.when(k % 4 == 0, F.lit(None).cast("double")).otherwise((k % 12 + 1).cast("double")).alias("CaseQuantity"),
                 (F.col("o_totalprice") / 10).alias("CaseRetail"),
                 F.when(k % 3 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") / 100).alias("Retail"),
                 (k % 40).cast("double").alias("QuantityOnHand"),
                 F.concat(s(k % 30), F.lit(" OZ")).alias("Size"),
                 F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(s(k * 7)).alias("Upc"),
                 F.coalesce(F.col("AdditionalUpcs"), F.array().cast(
                     "array<struct<Upc:string,Retail:double,Quantity:double>>")).alias("AdditionalUpcs")).alias("item"))
    pages = items.groupBy("retailer_id", "page").agg(F.sort_array(F.collect_list(F.col("item"))).alias("Results"))
    # a page per order, whatever its lines: counted without them
    numbered = o.select(s(F.col("o_custkey") % 10).alias("retailer_id"), (k / 100).cast("long").alias("page"))
    declared = numbered.groupBy("retailer_id").agg((F.countDistinct("page") + F.when(F.col("retailer_id") == "3", 1).otherwise(0))
                                                .alias("TotalPages"))
    return pages.join(declared, "retailer_id")


def line_products(spark, sf_dir) -> DataFrame:
    """Generic line-level product attributes (text), the base of the simple
    POS exports below."""
    j = _lines_parts(spark, sf_dir)
    return j.select(
        s("l_suppkey").alias("retailer_id"), line_ord().alias(ORD), line_no().alias("_line"),
        s("l_partkey").alias("id"), s(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("upc"),
        F.col("p_brand").alias("brand"), F.col("p_name").alias("descr"), F.col("p_type").alias("typ"),
        F.col("p_brand").alias("cat"), F.concat(s("l_linenumber"), F.lit(" pk")).alias("pkg"),
        F.concat(s("p_size"), F.lit(" OZ")).alias("size"), s("l_extendedprice").alias("price"),
        F.when(F.col("l_tax") > 0.04, s(F.col("l_extendedprice") * 0.5)).otherwise(F.lit("")).alias("sale"),
        s("l_quantity").alias("qty"), F.col("l_linenumber").alias("ln"), F.col("l_shipdate").alias("ship"),
        F.col("l_extendedprice").alias("ext"), F.col("p_partkey").alias("pk"), F.col("p_size").alias("psize"),
        F.col("p_retailprice").alias("pprice"))


def pos_export(spark, sf_dir, pos: str) -> DataFrame:
    """Raw export of one simple POS kind, in its own column names."""
    lp = line_products(spark, sf_dir)
    c = F.col
    base = [c("retailer_id"), c(ORD)]
    if pos == "tiger":
        cols = [c("id").alias("ITEMID"), c("upc").alias("ITEMSCANID"), c("brand").alias("ITEMORDER"),
                c("descr").alias("ITEMNAME"), F.concat(s(c("ln") % 5), F.lit(".0")).alias("DEPTID"),
                c("cat").alias("CATGID"), c("pkg").alias("ISIZE"), c("price").alias("STDPRICE"),
                c("sale").alias("WEBPRICE"), c("qty").alias("QTYONHAND")]
    elif pos == "fastraxpos":
        cols = [c("id").alias("row_id"), c("upc").alias("plu_num"), c("descr").alias("plu_desc"),
                c("typ").alias("dept_grp"), c("cat").alias("category"), c("pkg").alias("class"),
                c("size").alias("sub_class"), c("qty").alias("qty_on_hand"), c("price").alias("last_price")]
    elif pos == "ptech":
        cols = [c("id").alias("SKU"), F.concat(F.lit("U-"), c("upc")).alias("MAINUPC"), c("descr").alias("ITEMNAME"),
                c("typ").alias("DEPTNAME"), c("qty").alias("INSTOREQTY"), c("price").alias("PRICEPERUNIT")]
    elif pos == "lajoypos":
        cols = [c("id").alias("rt_product_id"), F.concat(F.lit("U-"), c("upc")).alias("rt_upc_code"),
                c("brand").alias("rt_brand_name"), c("descr").alias("rt_brand_description"),
                c("typ").alias("rt_product_type"), c("cat").alias("rt_product_category"),
                c("pkg").alias("rt_package_size"), c("size").alias("rt_item_size"), c("price").alias("price_regular"),
                c("sale").alias("price_sale"), c("qty").alias("qty_on_hand"),
                F.concat(s("ln"), F.lit(" Pack")).alias("wholesale_package_size")]
    elif pos == "cobaltconnect":
        cols = [c("id").alias("code"),
                F.when(c("ln") % 2 == 0, F.concat(F.lit("cc"), c("upc"))).otherwise(c("upc")).alias("sku"),
                c("descr").alias("name"), c("size").alias("size"), c("price").alias("retail_price"),
                c("qty").alias("stock")]
    elif pos == "businessmasterespanol":
        cols = [c("id").alias("SKU"), c("upc").alias("UPC"), c("descr").alias("Product Name"),
                s("ln").alias("Contenido"), c("qty").alias("Quantity"), c("price").alias("Price"),
                F.when(c("ln") % 2 == 0, c("price")).otherwise(s(c("ext") * 0.9)).alias("SalePrice"),
                c("typ").alias("Department"), F.date_format(c("ship"), "yyyy-MM-dd").alias("SaleStartDate"),
                F.date_format(c("ship") + F.expr("INTERVAL 30 DAYS"), "yyyy-MM-dd").alias("SaleEndDate")]
    elif pos == "lightspeed":
        cols = [c("id").alias("systemSku"), c("upc").alias("upc"), c("descr").alias("description"),
                c("typ").alias("fullPathName"), c("cat").alias("name"), c("price").alias("amount"),
                c("qty").alias("qoh")]
    elif pos == "square":
        cols = [c("id").alias("item_variation_object_id"), c("upc").alias("item_variation_data.sku"),
                c("descr").alias("item_data.name"), c("typ").alias("item_data.product_type"),
                c("cat").alias("category_data.name"), c("pkg").alias("item_variation_data.name"),
                s((c("ext") * 100).cast("long")).alias("item_variation_data.price_money.amount"),
                c("qty").alias("quantity")]
    else:
        raise ValueError(pos)
    return lp.select(*base, *cols)


def liquorpos_members(spark, sf_dir):
    """(barcodes, liqcode): several barcodes per code; some codes not digits."""
    lp = line_products(spark, sf_dir)
    code = F.when(F.col("pk") % 9 == 0, F.concat(F.lit("X"), s("pk"))).otherwise(s("pk"))
    part = (F.col("pk") % 3).alias("_part")  # a code's rows share an archive
    barcodes = lp.select("retailer_id", part, ORD, code.alias("CODE_NUM"), F.col("upc").alias("BARCODE"))
    liq = lp.select("retailer_id", part, F.col("pk").alias(ORD), code.alias("CODE_NUM"), F.col("brand").alias("BRAND"),
                    F.col("descr").alias("DESCRIP"), F.col("typ").alias("TYPENAM"),
                    F.concat(s("psize"), F.lit(" pk")).alias("SIZE"), s("pprice").alias("PRICE"),
                    s(F.col("psize") * 3).alias("QTY_ON_HND"), F.concat(s(F.col("psize") % 12), F.lit(".0")).alias("QTY_CASE"),
                    F.lit("").alias("BARCODE")).distinct()
    return barcodes, liq


LIGHTSPEED_RETAILERS, SQUARE_RETAILERS = 11, 13


def lightspeed_pages(spark, sf_dir):
    """(item pages, category pages, registry) of several Lightspeed accounts, each
    for one shop that the registry names.  Every item has prices for two use types and quantities for two shops;
    category ids are shared by the accounts, their names are not, and items of
    categories 8 and 9 have none."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    r = k % LIGHTSPEED_RETAILERS
    item = F.struct(
        s(k).alias("itemID"), s(k * 3).alias("systemSku"), s(k * 7919).alias("upc"), F.col("p_name").alias("description"),
        s(F.col("p_size") % 10).alias("categoryID"),
        F.struct(F.array(F.struct(F.lit("1").alias("useTypeID"), s("p_retailprice").alias("amount")),
                         F.struct(F.lit("2").alias("useTypeID"), s(F.col("p_retailprice") * 0.5).alias("amount")))
                 .alias("ItemPrice")).alias("Prices"),
        F.struct(F.array(F.struct(s(k).alias("itemID"), F.lit("1").alias("shopID"), s(F.col("p_size") * 2).alias("qoh")),
                         F.struct(s(k).alias("itemID"), F.lit("2").alias("shopID"), s("p_size").alias("qoh")))
                 .alias("ItemShop")).alias("ItemShops"))
    items = (p.select(s(r).alias("retailer_id"), (k / 100).cast("long").alias("page"),
                      F.struct(k.alias("k"), item.alias("i")).alias("x"))
             .groupBy("retailer_id", "page").agg(F.sort_array(F.collect_list("x")).alias("x"))
             .select("retailer_id", "page", F.col("x.i").alias("Item")))
    n = table(spark, sf_dir, "nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(LIGHTSPEED_RETAILERS - 1))))
    category = F.when(F.col("n_nationkey") < 8, s("n_nationkey")).otherwise(F.concat(F.lit("x"), s("n_nationkey")))
    name = F.concat(F.col("n_name"), F.lit("-"), s("r"))
    cats = (n.groupBy(s("r").alias("retailer_id")).agg(F.sort_array(F.collect_list(F.struct(
        category.alias("categoryID"), name.alias("name"), F.concat(F.lit("Spirits/"), name).alias("fullPathName"))))
        .alias("Category")))
    registry = numbers(spark, LIGHTSPEED_RETAILERS, "r").select(
        F.col("r").alias("id"), F.lit("lightspeed").alias("pos"), F.lit("").alias("name"), F.lit("").alias("filename"),
        s(F.col("r") % 2 + 1).alias("shopid"), F.lit("x").alias("refreshtoken"))
    return items, cats, registry


def square_objects(spark, sf_dir):
    """Square catalogs of several retailers (items, categories, variations) and
    inventory counts; object ids are shared by the retailers, values are not.
    Also each retailer's location."""
    p = table(spark, sf_dir, "part")
    n_r = SQUARE_RETAILERS
    j, r = F.floor(F.col("p_partkey") / n_r).cast("long"), s(F.col("p_partkey") % n_r).alias("retailer_id")
    items = p.select(r, F.concat(F.lit("I"), s(j)).alias("id"), F.struct(
        F.col("p_name").alias("name"), F.col("p_type").alias("product_type"),
        F.concat(F.lit("C"), s(F.col("p_size") % 8)).alias("category_id")).alias("item_data"))
    n = table(spark, sf_dir, "nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1))))
    cats = n.select(s("r").alias("retailer_id"),
                    F.concat(F.lit("C"), s("n_nationkey"), F.when(F.col("n_nationkey") >= 6, F.lit("x")).otherwise(F.lit("")))
                    .alias("id"), F.struct(F.concat(F.col("n_name"), F.lit("-"), s("r")).alias("name")).alias("category_data"))

    def variation(prefix, where, size_mult):
        return p.where(where).select(r, F.col("p_partkey").alias(ORD), F.concat(F.lit(prefix), s(j)).alias("id"), F.struct(
            F.concat(F.lit("I"), s(j)).alias("item_id"), s(F.col("p_partkey") * 11).alias("sku"),
            F.concat(s(F.col("p_size") * size_mult), F.lit(" pk")).alias("name"),
            F.struct((F.col("p_retailprice") * 100 * size_mult).cast("long").alias("amount")).alias("price_money"))
            .alias("item_variation_data"))
    # every third item has a second variation
    variations = variation("V", F.lit(True), 1).unionByName(variation("W", j % 3 == 0, 2))
    j2 = F.substring("id", 2, 12).cast("long")
    counts = variations.select(
        "retailer_id", F.col("id").alias("catalog_object_id"),
        F.when(j2 % 4 == 0, F.lit("2")).otherwise(F.lit("1")).alias("location_id"),
        F.when(j2 % 5 == 0, F.lit("SOLD_OUT")).otherwise(F.lit("IN_STOCK")).alias("state"),
        s(j2).alias("quantity"))
    locations = numbers(spark, n_r, "r").select(s("r").alias("retailer_id"), s(F.col("r") % 2 + 1).alias("location_id"))
    return items, cats, variations, counts, locations


def square_pages(spark, sf_dir) -> DataFrame:
    """The same catalogs as the API gives them: pages of at most 100 objects of a kind (or counts),
    linked by cursors; every fourth page is landed twice."""
    items, cats, variations, counts, _ = square_objects(spark, sf_dir)
    kinds = {"ITEM": (items, "item_data"), "CATEGORY": (cats, "category_data"), "ITEM_VARIATION": (variations, "item_variation_data")}
    full = "struct<type:string,id:string,item_data:{},category_data:{},item_variation_data:{}>".format(
        *[d.schema[c].dataType.simpleString() for d, c in kinds.values()])
    count = "struct<catalog_object_id:string,location_id:string,state:string,quantity:string>"
    none = lambda t: F.lit(None).cast(t)
    stacked = None
    for kind, (d, data) in kinds.items():
        parts = {"item_data": None, "category_data": None, "item_variation_data": None} | {data: F.col(data)}
        obj = F.struct(F.lit(kind).alias("type"), "id", *[v.alias(c) if v is not None else F.lit(None).alias(c) for c, v in parts.items()])
        rows = d.select("retailer_id", F.lit(kind).alias("types"), F.col("id").alias("k"), obj.cast(full).alias("o"), none(count).alias("c"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    c = F.struct("catalog_object_id", "location_id", "state", "quantity")
    stacked = stacked.unionByName(counts.select("retailer_id", F.lit("COUNTS").alias("types"), F.col("catalog_object_id").alias("k"),
                                                none(full).alias("o"), c.cast(count).alias("c")))
    n_pages = F.ceil(F.count(F.lit(1)) / 100).cast("int")
    sizes = stacked.groupBy("retailer_id", "types").agg(n_pages.alias("n"))
    dealt = stacked.join(sizes, ["retailer_id", "types"]).withColumn("page", F.pmod(F.xxhash64("k"), F.col("n")).cast("int"))
    at = lambda p: F.concat(F.lit("c"), s(p))
    pages = dealt.groupBy("retailer_id", "types", "n", "page").agg(F.collect_list("o").alias("objects"), F.collect_list("c").alias("counts"))
    every = sizes.withColumn("page", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).join(
        pages.drop("n"), ["retailer_id", "types", "page"], "left")
    pages = every.select("retailer_id", "types", F.when(F.col("page") > 0, at(F.col("page"))).alias("offset"),
                         F.when(F.col("page") + 1 < F.col("n"), at(F.col("page") + 1)).alias("cursor"), "objects", "counts", "page")
    return pages.unionByName(pages.where("page % 4 = 0")).drop("page")


def csv_lines(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows (retailer_id, _ord, text columns; ``_part`` if they have one) as CSV lines; a file has its header line besides."""
    line = F.concat_ws(",", *[F.coalesce(s(c), F.lit("")) for c in cols])
    return df.select("retailer_id", *[c for c in ("_part",) if c in df.columns], ORD, line.alias("value"))


_KMDS_COLS = ["id", "upcitemid", "sizecaseqty", "unitspercase", "description", "price", "onhand", "salesdepartmentid",
              "description_2"]
#: The barcode export's header names two columns 'description'.
KMDS_HEAD = ",".join([*_KMDS_COLS[:-1], "description"]) + "\n"


def kmds_lines(spark, sf_dir) -> DataFrame:
    """The barcode export, under KMDS_HEAD in every file."""
    return csv_lines(f6_barcodes(spark, sf_dir), _KMDS_COLS)


def f2_member(df: DataFrame) -> DataFrame:
    """A spirit2000 member ready for landing: parts by product, file order."""
    return df.withColumn("_part", F.substring("sku", -1, 1).cast("long")) if ORD in df.columns else \
        df.withColumns({"_part": F.substring("sku", -1, 1).cast("long"), ORD: F.col("sku")})


def member_files(spark, sf_dir) -> DataFrame:
    """File names found in multi-member archives, one set per supplier."""
    su = table(spark, sf_dir, "supplier").select("s_suppkey")
    names = ["INV.CSV", "prc.csv", "Stk.DBF", "upc.dbf", "barcodes.dbf", "LIQCODE.csv", "readme.txt",
             "ZZ_AdventPOS_Raw_ItemSize.csv", "invoices.csv", "old/OLD-Inv.csv"]
    return su.select(s("s_suppkey").alias("retailer_id"), F.explode(F.array(*[F.lit(x) for x in names])).alias("f")) \
        .select("retailer_id", F.concat(F.lit("exports/s"), F.col("retailer_id"), F.lit("/"), F.col("f")).alias("_file_name"))
