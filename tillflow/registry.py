"""Registered queries (Spark) and their oracle SQL, keyed by operator name."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.functions.package import parse_package
from tillflow.operators.columns import add_load_cols
from tillflow.plans import derived as D
from tillflow.plans import feeds
from tillflow.plans import oracle as O
from tillflow.schema import OUTPUT_COLUMNS

QUERIES: dict = {}
ORACLE: dict = {}


_LANDED: dict = {}


def landed(fn):
    """A fixture's export is written once per session and table folder; the
    queries then read it like any upload that lies there."""
    @functools.wraps(fn)
    def once(spark, sf_dir, *args):
        key = (fn.__name__, spark.sparkContext.applicationId, str(sf_dir), args)
        if key not in _LANDED:
            _LANDED[key] = fn(spark, sf_dir, *args)
        return _LANDED[key]
    return once


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


# ---------------------------------------------------------------- flagship

def q_parse_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.feed_mpower(D.f1_base(spark, sf_dir))
    out = add_load_cols(parse_package(rows))
    return out.select(*OUTPUT_COLUMNS)


def _sql_parse_package() -> str:
    mp = O.mpower_ctes("f1", "mp")
    pctes, pout = O.parse_ctes("mp")
    cols = ", ".join(O.CANON + O.PARSED)
    return O.with_clause(O.F1, mp, pctes) + f"\nSELECT {cols}, 1 AS active, retailer_id FROM {pout}"


register("parse_package", _sql_parse_package())(q_parse_package)


@register("feed_mpower", O.with_clause(O.F1, O.mpower_ctes("f1", "mp")) + "\nSELECT * FROM mp")
def q_feed_mpower(spark, sf_dir):
    return feeds.feed_mpower(D.f1_base(spark, sf_dir))


# ------------------------------------------------ package parse: rule level
# Rules applied to the description text of every lineitem-level feed row.

from tillflow.functions import package as P  # noqa: E402


RULE_ROWS = 200_000      # texts of a task that applies rules


def _f8_texts(spark, sf_dir):
    # dealt out before the CPU-heavy rules: neither row groups nor a join's partitions say how many rows a task gets
    n = max(spark.sparkContext.defaultParallelism, -(-D.table(spark, sf_dir, "lineitem").count() // RULE_ROWS))
    texts = D.f8_lines(spark, sf_dir).select(F.col("_line").alias("line_id"), F.col("brand_description").alias("text"))
    return texts.repartition(n)


@register("pkg_size_rule", O.with_clause(O.F8) + f"""
SELECT _line AS line_id, brand_description AS text, {O.pack_case(O.pack_text('brand_description'))} AS pack_count
FROM f8""")
def q_pkg_size_rule(spark, sf_dir):
    return P.with_pkg_size_rule(_f8_texts(spark, sf_dir), "text", "pack_count")


@register("item_size_rule", O.with_clause(O.F8, f"""f8i AS (
SELECT _line AS line_id, brand_description AS text, {O.item_case(O.item_text('brand_description'))} AS r FROM f8)""") + """
SELECT line_id, text, r.size AS item_size, r.unit AS item_unit FROM f8i""")
def q_item_size_rule(spark, sf_dir):
    d = P.with_item_size_rule(_f8_texts(spark, sf_dir), "text", "r")
    return d.select("line_id", "text", F.col("r.size").alias("item_size"), F.col("r.unit").alias("item_unit"))


@register("container_rule", O.with_clause(O.F8) + f"""
SELECT _line AS line_id, brand_description AS text, {O.container_case(O.container_text('brand_description'))} AS container
FROM f8""")
def q_container_rule(spark, sf_dir):
    return P.with_container_rule(_f8_texts(spark, sf_dir), "text", "container")


# ------------------------------------------ package parse: pick / assemble
# The parse over the lineitem-level feed, one key per step of the assembly.

def _f8_parsed(spark, sf_dir):
    rows = feeds.feed_mpower(D.f8_lines(spark, sf_dir))
    return P.parse_package(rows, keep_steps=True)


def _f8_parse_sql(select: str) -> str:
    mp = O.mpower_ctes("f8", "mp", casepk=False)
    pctes, pout = O.parse_ctes("mp")
    src = "pp_fill" if any(x in select for x in ("it0", "it1", "ct0")) else pout
    return O.with_clause(O.F8, mp, pctes) + f"\nSELECT retailer_id, rt_product_id, {select} FROM {src}"


_STEPS = {
    "pkg_size": ("package_size_num", lambda: [F.col("package_size_num")]),
    "item_size_pick": ("it0.size AS item_size, it0.unit AS item_unit",
                       lambda: [F.col("step_item_pick.size").alias("item_size"),
                                F.col("step_item_pick.unit").alias("item_unit")]),
    "size_standardise": ("it1.size AS item_size, it1.unit AS item_unit",
                         lambda: [F.col("step_item_std.size").alias("item_size"),
                                  F.col("step_item_std.unit").alias("item_unit")]),
    "container_pick": ("ct0 AS container", lambda: [F.col("step_container_pick").alias("container")]),
    "special_config": ("item_size_value, item_units",
                       lambda: [F.col("item_size_value"), F.col("item_units")]),
    "container_fill": ("container_type", lambda: [F.col("container_type")]),
    "item_size_text": ("item_size", lambda: [F.col("item_size")]),
    "package_configuration": ("package_size_num, item_size, container_type, package_configuration",
                              lambda: [F.col(c) for c in ("package_size_num", "item_size", "container_type",
                                                          "package_configuration")]),
}


def _step_query(cols_fn):
    def q(spark, sf_dir):
        return _f8_parsed(spark, sf_dir).select("retailer_id", "rt_product_id", *cols_fn())
    return q


for _k, (_sql_sel, _cols) in _STEPS.items():
    register(_k, _f8_parse_sql(_sql_sel))(_step_query(_cols))


def _sql_f8_mpower():
    return O.with_clause(O.F8, O.mpower_ctes("f8", "mp", casepk=False)) + "\nSELECT * FROM mp"


@register("feed_mpower_lines", _sql_f8_mpower())
def q_feed_mpower_lines(spark, sf_dir):
    return feeds.feed_mpower(D.f8_lines(spark, sf_dir))


# ------------------------------------------------------------- spirit2000
# Four-member feed (inv / prc / stk / upc) with price history, per retailer.

def _f2(spark, sf_dir):
    return (D.f2_inv(spark, sf_dir), D.f2_prc(spark, sf_dir), D.f2_stk(spark, sf_dir), D.f2_upc(spark, sf_dir))


register("feed_spirit2000_csv", O.spirit_sql("csv"))(lambda spark, sf: feeds.feed_spirit2000_csv(*_landed_spirit_zip(spark, sf)))


@register("feed_spirit2000_dbf", O.spirit_sql("dbf"))
def q_feed_spirit2000_dbf(spark, sf_dir):
    m = _landed_spirit_dbf(spark, sf_dir)
    return feeds.feed_spirit2000_dbf(m["inv"], m["prc"], m["stk"], m["upc"])


@register("feed_spirit2000_tower", O.spirit_sql("tower"))
def q_feed_spirit2000_tower(spark, sf_dir):
    inv, prc, stk, upc = _f2(spark, sf_dir)
    last = upc.withColumn("LAST", F.date_format("tstamp", "yyyy-MM-dd HH:mm:ss")).drop("tstamp")
    return feeds.feed_spirit2000_tower(inv, prc, stk, last)


@register("win_latest_ties", O.with_clause(O.F2) + f"""
SELECT retailer_id, sku, back, tstamp FROM {O.latest_sql('f2_stk')}""")
def q_win_latest_ties(spark, sf_dir):
    from tillflow.operators import pick
    return pick.keep_latest(D.f2_stk(spark, sf_dir), ["retailer_id", "sku"], "tstamp").select(
        "retailer_id", "sku", "back", "tstamp")


@register("win_maxqty_then_latest", O.with_clause(O.F2) + f"""
SELECT retailer_id, sku, qty, price, tstamp FROM {O.maxqty_latest_sql("(SELECT * FROM f2_prc WHERE level = '1')")}""")
def q_win_maxqty_then_latest(spark, sf_dir):
    from tillflow.operators import pick
    from tillflow.operators.columns import filter_level
    prc = filter_level(D.f2_prc(spark, sf_dir), "1")
    return pick.keep_maxqty_then_latest(prc, ["retailer_id", "sku"], "qty", "tstamp").select(
        "retailer_id", "sku", "qty", "price", "tstamp")


@register("agg_group_max", O.with_clause(O.F2) + """
SELECT retailer_id, sku, max(qty) AS max_qty, max(tstamp) AS max_tstamp FROM f2_prc GROUP BY retailer_id, sku""")
def q_agg_group_max(spark, sf_dir):
    from tillflow.operators import pick
    return pick.group_max(D.f2_prc(spark, sf_dir), ["retailer_id", "sku"], ["qty", "tstamp"])


@register("filter_price_level", O.with_clause(O.F2) + """
SELECT retailer_id, sku, qty, price, level FROM f2_prc WHERE level = '7'""")
def q_filter_price_level(spark, sf_dir):
    from tillflow.operators.columns import filter_level
    return filter_level(D.f2_prc(spark, sf_dir), "7").select("retailer_id", "sku", "qty", "price", "level")


@register("dedup_smallest_upc", O.with_clause(O.F2) + """
SELECT retailer_id, sku, upc, tstamp FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id, sku ORDER BY
  upc IS NULL, TRY_CAST(upc AS DOUBLE) NULLS FIRST, upc NULLS FIRST, _ord) AS _rn FROM f2_upc) WHERE _rn = 1""")
def q_dedup_smallest_upc(spark, sf_dir):
    from tillflow.operators import pick
    return pick.dedup_smallest(D.f2_upc(spark, sf_dir), ["retailer_id", "sku"], "upc").select(
        "retailer_id", "sku", "upc", "tstamp")


def _spirit_join_sql(join: str) -> str:
    return O.with_clause(O.F2, O.spirit_members("1", max_qty=True), join) + """
SELECT retailer_id, sku, name, qty, price, back, upc FROM sp_join"""


def _spirit_members_spark(spark, sf_dir):
    inv, prc, stk, upc = _f2(spark, sf_dir)
    return {"inv": inv.select("retailer_id", "sku", "name", "sname", "pack", "typename"),
            "prc": feeds.spirit_prices(prc, "1", max_qty=True),
            "stk": feeds.spirit_latest(stk, ["back"]),
            "upc": feeds.spirit_latest(upc, ["upc"])}


@register("join_sku_inner", _spirit_join_sql(O.SPIRIT_INNER))
def q_join_sku_inner(spark, sf_dir):
    from tillflow.operators.joins import join_inner_chain
    m = _spirit_members_spark(spark, sf_dir)
    return join_inner_chain(list(m.values()), ["retailer_id", "sku"]).select(
        "retailer_id", "sku", "name", "qty", "price", "back", "upc")


@register("join_sku_anchor_left", _spirit_join_sql(O.SPIRIT_ANCHOR))
def q_join_sku_anchor_left(spark, sf_dir):
    from tillflow.operators.joins import join_anchor_left
    m = _spirit_members_spark(spark, sf_dir)
    return join_anchor_left(m, ["retailer_id", "sku"]).select(
        "retailer_id", "sku", "name", "qty", "price", "back", "upc")


# ------------------------------------------------------ kmds / adventpos

def _passes(spark, sf_dir) -> int:
    return L.passes(D.table(spark, sf_dir, "lineitem").count())


@landed
def _kmds_files(spark, sf_dir):
    return L.land_lines(spark, D.kmds_lines(spark, sf_dir), "kmds", head=D.KMDS_HEAD, packed=True, passes=_passes(spark, sf_dir))


def _landed_kmds(spark, sf_dir):
    return L.retailer_from_path(SD.scan_csv_header(spark, _kmds_files(spark, sf_dir)))


register("feed_kmds", O.kmds_sql())(lambda spark, sf: feeds.feed_kmds(_landed_kmds(spark, sf)))


@register("win_longest_upc", O.with_clause(O.F6) + """
SELECT retailer_id, id, up AS upc, l_orderkey, l_linenumber FROM (
  SELECT *, max(length(up)) OVER (PARTITION BY retailer_id, id) AS _ml FROM (
    SELECT *, CASE WHEN id = upcitemid THEN '-1' ELSE upcitemid END AS up FROM f6) WHERE up IS NOT NULL)
WHERE length(up) = _ml""")
def q_win_longest_upc(spark, sf_dir):
    from tillflow.functions.text import upc_same_as_id
    from tillflow.operators import pick
    d = D.f6_barcodes(spark, sf_dir).withColumn("upc", upc_same_as_id(F.col("upcitemid"), F.col("id")))
    return pick.keep_longest(d, ["retailer_id", "id"], "upc").select("retailer_id", "id", "upc", "l_orderkey",
                                                                     "l_linenumber")


@register("agg_max_length", O.with_clause(O.F6) + """
SELECT retailer_id, id, max(length(upcitemid)) AS max_len FROM f6 GROUP BY retailer_id, id""")
def q_agg_max_length(spark, sf_dir):
    from tillflow.operators import pick
    return pick.max_length(D.f6_barcodes(spark, sf_dir), ["retailer_id", "id"], "upcitemid")


register("feed_adventpos", O.advent_sql())(
    lambda spark, sf: feeds.feed_adventpos(D.f3_items(spark, sf), D.f3_size(spark, sf), D.f3_pack(spark, sf)))


@register("join_lookup_left", O.with_clause(O.F3) + """
SELECT retailer_id, sku, packid, sizeid, packname, sizename FROM f3_items LEFT JOIN f3_pack USING (retailer_id, packid)
LEFT JOIN f3_size USING (retailer_id, sizeid)""")
def q_join_lookup_left(spark, sf_dir):
    from tillflow.operators.joins import join_lookup_left
    d = join_lookup_left(D.f3_items(spark, sf_dir), D.f3_pack(spark, sf_dir).drop("_ord"), ["packid"])
    d = join_lookup_left(d, D.f3_size(spark, sf_dir).drop("_ord"), ["sizeid"])
    return d.select("retailer_id", "sku", "packid", "sizeid", "packname", "sizename")


# ------------------------------------------------------------- registry

def _registry_join(spark, sf_dir, registry):
    from tillflow.operators.joins import join_registry
    return join_registry(D.f4_incoming(spark, sf_dir), registry)


@register("scan_registry", O.with_clause(O.F4) + "\nSELECT * FROM f4_registry")
def q_scan_registry(spark, sf_dir):
    return SS.scan_registry(spark, L.land_json(spark, D.f4_registry(spark, sf_dir), "registry"))


@register("join_registry", O.with_clause(O.F4) + """
SELECT i._file_name, CAST(r.id AS VARCHAR) AS retailer_id, r.pos FROM f4_incoming i
JOIN f4_registry r ON lower(i._file_name) = lower(r.filename)""")
def q_join_registry(spark, sf_dir):
    matched, _ = _registry_join(spark, sf_dir, D.f4_registry(spark, sf_dir))
    return matched.select("_file_name", "retailer_id", "pos")


@register("first_match", O.with_clause(O.F4, """dup AS (
  SELECT * FROM f4_registry UNION ALL SELECT id + 1000, 'tiger', name, filename, shopid, refreshtoken FROM f4_registry),
first AS (SELECT lower(filename) AS fname, arg_min(id, id) AS id, arg_min(pos, id) AS pos FROM dup GROUP BY 1)""") + """
SELECT i._file_name, CAST(f.id AS VARCHAR) AS retailer_id, f.pos FROM f4_incoming i
JOIN first f ON lower(i._file_name) = f.fname""")
def q_first_match(spark, sf_dir):
    reg = D.f4_registry(spark, sf_dir)
    dup = reg.unionByName(reg.withColumn("id", F.col("id") + 1000).withColumn("pos", F.lit("tiger")))
    matched, _ = _registry_join(spark, sf_dir, dup)
    return matched.select("_file_name", "retailer_id", "pos")


@register("reject_unknown_format", O.with_clause(O.F4) + """
SELECT _file_name, 'unrecognized_file_type' AS reason FROM f4_incoming WHERE NOT contains(lower(_file_name), '.csv')""")
def q_reject_unknown_format(spark, sf_dir):
    from tillflow.plans.pipeline import reject_unknown_format
    return reject_unknown_format(D.f4_incoming(spark, sf_dir), ".csv").select("_file_name", "reason")


@register("filter_retailers", O.with_clause(O.F4) + """
SELECT id, name, shopid FROM f4_registry WHERE lower(pos) = 'mpower' AND refreshtoken IS NOT NULL""")
def q_filter_retailers(spark, sf_dir):
    from tillflow.plans.pipeline import filter_retailers
    return filter_retailers(D.f4_registry(spark, sf_dir), "mpower").select("id", "name", "shopid")


@register("registry_unmatched", O.with_clause(O.F4) + """
SELECT _file_name FROM f4_incoming i WHERE NOT EXISTS (
  SELECT 1 FROM f4_registry r WHERE lower(r.filename) = lower(i._file_name))""")
def q_registry_unmatched(spark, sf_dir):
    _, rejected = _registry_join(spark, sf_dir, D.f4_registry(spark, sf_dir))
    return rejected.select("_file_name")


# ------------------------------------------------------------ sale windows

def _f5(spark, sf_dir):
    return D.f5_sale(spark, sf_dir)


@register("sale_in_window", O.with_clause(O.F5) + f"""
SELECT l_orderkey, l_linenumber, CASE WHEN TIMESTAMP '{O.AS_OF}' BETWEEN sale_start AND sale_end THEN
  (CASE WHEN pack_sale > 0 THEN pack_sale WHEN unit_sale > 0 THEN unit_sale ELSE 0.0 END) ELSE 0.0 END AS price_sale
FROM f5""")
def q_sale_in_window(spark, sf_dir):
    from tillflow.functions.text import sale_in_window
    d = _f5(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber",
                    sale_in_window("pack_sale", "unit_sale", "sale_start", "sale_end", O.AS_OF).alias("price_sale"))


@register("price_pack_or_unit", O.with_clause(O.F5) + """
SELECT l_orderkey, l_linenumber, CASE WHEN pack_price > 0 THEN pack_price ELSE unit_price END AS price_regular FROM f5""")
def q_price_pack_or_unit(spark, sf_dir):
    from tillflow.functions.text import price_pack_or_unit
    d = _f5(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber", price_pack_or_unit("pack_price", "unit_price").alias("price_regular"))


@register("sale_in_window_diff", O.with_clause(O.F5) + f"""
SELECT l_orderkey, l_linenumber, CASE WHEN TIMESTAMP '{O.AS_OF}' BETWEEN sale_start AND sale_end
  AND pack_price <> pack_sale THEN pack_sale ELSE 0.0 END AS price_sale FROM f5""")
def q_sale_in_window_diff(spark, sf_dir):
    from tillflow.functions.text import sale_in_window_diff
    d = _f5(spark, sf_dir)
    return d.select("l_orderkey", "l_linenumber",
                    sale_in_window_diff("pack_price", "pack_sale", "sale_start", "sale_end", O.AS_OF)
                    .alias("price_sale"))


# ----------------------------------------------- scalar functions (2.8/2.2)
# Each is a projection over the lineitem-level feed; inputs are dirtied per
# row (by the line key) so every branch of a function is exercised.

from tillflow.functions import text as T  # noqa: E402
from tillflow.operators import columns as C  # noqa: E402


def _f8(spark, sf_dir):
    return D.f8_lines(spark, sf_dir)


def _f8_proj(key: str, sql_expr: str, x_sql: str | None = None):
    """Register ``key`` = (line_id, value) over F8; spark side given by the
    decorated fn.  ``x_sql`` optionally defines an input column ``x``."""
    def deco(fn):
        def q(spark, sf_dir):
            d = _f8(spark, sf_dir)
            return d.select(F.col("_line").alias("line_id"), fn(d).alias("value"))
        src = f"(SELECT *, {x_sql} AS x FROM f8)" if x_sql else "f8"
        register(key, O.with_clause(O.F8) + f"\nSELECT _line AS line_id, {sql_expr} AS value FROM {src}")(q)
        return fn
    return deco


_DIRTY_UPC_SQL = "('UPC-' || upc_code || CASE WHEN _line % 2 = 0 THEN '.0' ELSE '' END)"


@_f8_proj("upc_digits_only", f"regexp_replace({_DIRTY_UPC_SQL}, '[^0-9]', '', 'g')")
def _s_upc_digits(d):
    dirty = F.concat(F.lit("UPC-"), F.col("upc_code"), F.when(F.col("_line") % 2 == 0, F.lit(".0")).otherwise(F.lit("")))
    return T.upc_digits_only(dirty)


@_f8_proj("strip_dot_zero", f"replace({_DIRTY_UPC_SQL}, '.0', '')")
def _s_strip_dot_zero(d):
    dirty = F.concat(F.lit("UPC-"), F.col("upc_code"), F.when(F.col("_line") % 2 == 0, F.lit(".0")).otherwise(F.lit("")))
    return T.strip_dot_zero(dirty)


@_f8_proj("upc_strip_prefix", "(CASE WHEN starts_with(x, 'cc') THEN substr(x, 3) ELSE x END)",
          "CASE WHEN _line % 3 = 0 THEN 'cc' || upc_code ELSE upc_code END")
def _s_upc_strip_prefix(d):
    x = F.when(F.col("_line") % 3 == 0, F.concat(F.lit("cc"), F.col("upc_code"))).otherwise(F.col("upc_code"))
    return T.upc_strip_prefix(x)


@_f8_proj("upc_same_as_id", "(CASE WHEN product_id = x THEN '-1' ELSE x END)",
          "CASE WHEN _line % 4 = 0 THEN product_id ELSE upc_code END")
def _s_upc_same_as_id(d):
    x = F.when(F.col("_line") % 4 == 0, F.col("product_id")).otherwise(F.col("upc_code"))
    return T.upc_same_as_id(x, F.col("product_id"))


@_f8_proj("id_remove_dash", "replace(product_id || '-' || qty_on_hand, '-', '')")
def _s_id_remove_dash(d):
    return T.id_remove_dash(F.concat(F.col("product_id"), F.lit("-"), F.col("qty_on_hand")))


@_f8_proj("id_compose", "coalesce(product_id, '') || ' - ' || coalesce(package_size, '')")
def _s_id_compose(d):
    return T.id_compose(F.col("product_id"), F.col("package_size"))


@_f8_proj("desc_compose", "coalesce(brand_name, '') || ' ' || coalesce(brand_description, '')")
def _s_desc_compose(d):
    return T.desc_compose(F.col("brand_name"), F.col("brand_description"))


@_f8_proj("pack_suffix", "coalesce(qty_on_hand, '') || ' Pack'")
def _s_pack_suffix(d):
    return T.pack_suffix(F.col("qty_on_hand"))


@_f8_proj("split_first", "split_part(package_size || ',' || brand_name, ',', 1)")
def _s_split_first(d):
    return T.split_first(F.concat(F.col("package_size"), F.lit(","), F.col("brand_name")))


@_f8_proj("dept_code_type", O.dept_sql("(CAST(_line % 8 AS VARCHAR) || '.0')", 3, 2, 4))
def _s_dept_code_type(d):
    return T.dept_code_type(F.concat((F.col("_line") % 8).cast("string"), F.lit(".0")), 3, 2, 4)


@_f8_proj("cents_to_units", f"{O.num('price_regular')} / 100.0")
def _s_cents_to_units(d):
    return T.cents_to_units(T.strict_double(F.col("price_regular")))


@_f8_proj("qty_per_pack", f"(CASE WHEN _line % 3 = 0 THEN NULL ELSE {O.num('qty_on_hand')} / (_line % 3) END)")
def _s_qty_per_pack(d):
    return T.safe_divide(T.strict_double(F.col("qty_on_hand")), F.col("_line") % 3)


@_f8_proj("wholesale_qty", "coalesce(" + O.float_text(
    f"(CASE WHEN _line % 4 = 0 THEN NULL ELSE {O.num('qty_on_hand')} / (_line % 4) END)") + ", '')")
def _s_wholesale_qty(d):
    return F.coalesce(T.float_text(T.safe_divide(T.strict_double(F.col("qty_on_hand")), F.col("_line") % 4)),
                      F.lit(""))


_LABEL_IN_SQL = ("(CASE _line % 5 WHEN 0 THEN qty_on_hand WHEN 1 THEN qty_on_hand || '.5' WHEN 2 THEN 'n/a' "
                 "WHEN 3 THEN '' ELSE qty_on_hand || '.0' END)")


@_f8_proj("wholesale_label", O.wholesale_label_sql(_LABEL_IN_SQL))
def _s_wholesale_label(d):
    q, k = F.col("qty_on_hand"), F.col("_line") % 5
    x = (F.when(k == 0, q).when(k == 1, F.concat(q, F.lit(".5"))).when(k == 2, F.lit("n/a"))
         .when(k == 3, F.lit("")).otherwise(F.concat(q, F.lit(".0"))))
    return T.wholesale_label(x)


@_f8_proj("cast_numeric_zero", "coalesce(" + O.num_exp(
    "(CASE WHEN _line % 7 = 0 THEN 'n/a' WHEN _line % 7 = 1 THEN NULL ELSE price_regular END)") + ", 0.0)")
def _s_cast_numeric_zero(d):
    k = F.col("_line") % 7
    x = F.when(k == 0, F.lit("n/a")).when(k == 1, F.lit(None).cast("string")).otherwise(F.col("price_regular"))
    return T.numeric_or_zero(x)


@_f8_proj("cast_string_blank", "coalesce(CASE WHEN _line % 3 = 0 THEN NULL ELSE sale_price END, '')")
def _s_cast_string_blank(d):
    return T.blank_if_null(F.when(F.col("_line") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("sale_price")))


@_f8_proj("copy_type_to_category", "product_type")
def _s_copy_type(d):
    return F.col("product_type")


@_f8_proj("path_basename", "regexp_extract('landing/raw/' || retailer_id || '/' || product_id || '.csv', '[^/]*$', 0)")
def _s_path_basename(d):
    return T.path_basename(F.concat(F.lit("landing/raw/"), F.col("retailer_id"), F.lit("/"), F.col("product_id"),
                                    F.lit(".csv")))


@_f8_proj("url_unquote", "url_decode('raw%2F' || replace(brand_name, '#', '%23') || '%20' || product_id)")
def _s_url_unquote(d):
    return T.url_unquote(F.concat(F.lit("raw%2F"), F.replace(F.col("brand_name"), F.lit("#"), F.lit("%23")),
                                  F.lit("%20"), F.col("product_id")))


@register("parse_ts", O.with_clause(O.F2) + """
SELECT _line AS line_id, CASE _line % 3 WHEN 0 THEN tstamp WHEN 1 THEN date_trunc('day', tstamp) ELSE NULL END AS value
FROM f2_prc""")
def q_parse_ts(spark, sf_dir):
    d = D.f2_prc(spark, sf_dir)
    k = F.col("_line") % 3
    txt = (F.when(k == 0, F.date_format("tstamp", "yyyy-MM-dd HH:mm:ss"))
           .when(k == 1, F.date_format("tstamp", "MM/dd/yyyy")).otherwise(F.lit("not a date")))
    return d.select(F.col("_line").alias("line_id"), T.parse_ts(txt).alias("value"))


@register("size_oz", O.with_clause(O.F6) + f"\nSELECT _line AS line_id, {O.size_oz_sql('description_2')} AS value FROM f6")
def q_size_oz(spark, sf_dir):
    d = D.f6_barcodes(spark, sf_dir)
    return d.select(F.col("_line").alias("line_id"), T.size_oz(F.col("description_2")).alias("value"))


@register("sale_flag", O.with_clause(O.F2) + """
SELECT _line AS line_id, CASE WHEN onsale = 'T' AND sale > 0 THEN sale ELSE 0.0 END AS value FROM f2_prc""")
def q_sale_flag(spark, sf_dir):
    d = D.f2_prc(spark, sf_dir)
    return d.select(F.col("_line").alias("line_id"), T.sale_flag("onsale", "sale").alias("value"))


# ------------------------------------------------ projection / filter steps

@register("filter_zero_price", O.with_clause(O.F1) + f"""
SELECT product_id, price_regular FROM f1 WHERE NOT coalesce({O.num_exp('price_regular')} = 0, false)""")
def q_filter_zero_price(spark, sf_dir):
    return C.filter_zero_price(D.f1_base(spark, sf_dir)).select("product_id", "price_regular")


@register("filter_digit_id", O.with_clause(O.F8) + """
SELECT line_id, pid FROM (SELECT _line AS line_id, CASE WHEN _line % 6 = 0 THEN 'A' || product_id ELSE product_id END AS pid
FROM f8) WHERE regexp_matches(pid, '^[0-9]+$')""")
def q_filter_digit_id(spark, sf_dir):
    d = _f8(spark, sf_dir).select(F.col("_line").alias("line_id"), F.when(
        F.col("_line") % 6 == 0, F.concat(F.lit("A"), F.col("product_id"))).otherwise(F.col("product_id")).alias("pid"))
    return C.filter_digit_id(d, "pid")




@register("cols_lower", O.with_clause(O.F8) + "\nSELECT * EXCLUDE (retailer_id, _ord) FROM f8")
def q_cols_lower(spark, sf_dir):
    d = _f8(spark, sf_dir)
    shouty = d.toDF(*[c.upper() if c not in ("retailer_id", "_ord") else c for c in d.columns])
    return C.cols_lower(shouty).drop("retailer_id", "_ord")


@register("cols_rename", O.with_clause(O.F8) + """
SELECT product_id AS rt_product_id, upc_code AS rt_upc_code, brand_name AS rt_brand_name,
 brand_description AS rt_brand_description, product_type AS rt_product_type, product_category AS rt_product_category,
 package_size AS rt_package_size, price_regular, sale_price AS price_sale, qty_on_hand FROM f8""")
def q_cols_rename(spark, sf_dir):
    return C.cols_rename(_f8(spark, sf_dir), feeds.MPOWER_MAP).drop("retailer_id", "_ord", "_line")


@register("cols_backfill", O.with_clause(O.F8) + """
SELECT product_id AS rt_product_id, '' AS rt_item_size, '' AS wholesale_package_size, '' AS rt_wholesale_qty,
 0.0 AS price_sale FROM f8""")
def q_cols_backfill(spark, sf_dir):
    d = _f8(spark, sf_dir).select(F.col("product_id").alias("rt_product_id"), "upc_code", "brand_name")
    d = C.cols_backfill(C.cols_rename(d, {"upc_code": "rt_upc_code", "brand_name": "rt_brand_name"}))
    return d.select("rt_product_id", "rt_item_size", "wholesale_package_size", "rt_wholesale_qty", "price_sale")


@register("cols_rename_ordinal", O.with_clause(O.F8) + """
SELECT product_id AS rt_product_id, brand_description AS rt_brand_description, price_regular AS price_regular FROM f8""")
def q_cols_rename_ordinal(spark, sf_dir):
    d = _f8(spark, sf_dir).select(F.col("product_id").alias("_c0"), F.col("brand_description").alias("_c1"),
                                  F.col("price_regular").alias("_c4"))
    return C.cols_rename_ordinal(d, {0: "rt_product_id", 1: "rt_brand_description", 4: "price_regular"})


@register("add_load_cols", O.with_clause(O.F1, O.mpower_ctes("f1", "mp")) + "\nSELECT *, 1 AS active FROM mp")
def q_add_load_cols(spark, sf_dir):
    return C.add_load_cols(feeds.feed_mpower(D.f1_base(spark, sf_dir)))


@register("dedup_product", O.with_clause(O.F8) + """
SELECT retailer_id, product_id, upc_code, price_regular FROM (SELECT *, row_number() OVER (
  PARTITION BY retailer_id, product_id ORDER BY _ord) AS _rn FROM f8) WHERE _rn = 1""")
def q_dedup_product(spark, sf_dir):
    from tillflow.operators import pick
    d = _f8(spark, sf_dir).select("retailer_id", "_ord", "product_id", "upc_code", "price_regular")
    return pick.dedup_first_in_file(d, ["retailer_id", "product_id"]).drop("_ord")


# ------------------------------------------------------------ scans (2.1)
# A derived feed is written to the shared folder in the POS's format, then
# read back through the source and the adapter.

from tillflow.plans import landing as L  # noqa: E402
from tillflow.sources import delimited as SD  # noqa: E402
from tillflow.sources import structured as SS  # noqa: E402

_F1_COLS = ["product_id", "upc_code", "brand_name", "brand_description", "product_type", "product_category",
            "package_size", "price_regular", "sale_price", "qty_on_hand", "casepk"]


@landed
def _landed_f1(spark, sf_dir):
    """F1 as CSV files of three shapes: columns in order, columns reversed, and
    rows with one field more than their header (the reader drops those)."""
    f1 = D.f1_base(spark, sf_dir)
    kind = F.col("_ord") % 97
    path = L.land_csv(spark, f1.where((kind != 0) & (kind % 2 == 0)), "f1_csv")
    back = f1.select("retailer_id", "_ord", *reversed(_F1_COLS))
    L.land_csv(spark, back.where((kind != 0) & (kind % 2 == 1)), "f1_csv", path=path, mode="append")
    long_rows = f1.where(kind == 0).withColumns({"_part": F.lit(0), "extra": F.lit("X")})
    lines = L.land_lines(spark, D.csv_lines(long_rows, [*_F1_COLS, "extra"]), "f1_long", head=",".join(_F1_COLS) + "\n")
    out = SD.scan_csv_header(spark, path)
    return L.retailer_from_path(out.unionByName(SD.scan_csv_header(spark, lines).drop("_part")))


_F1_NO_LONG = O.F1.replace("from part)", "from part where p_partkey % 97 <> 0)")


@register("scan_csv_header", O.with_clause(_F1_NO_LONG) + """
SELECT retailer_id, """ + ", ".join(f"coalesce({c}, '') AS {c}" for c in _F1_COLS) + " FROM f1")
def q_scan_csv_header(spark, sf_dir):
    d = _landed_f1(spark, sf_dir)
    # 'n/a' reads as missing
    price = F.coalesce("price_regular", F.lit("n/a")).alias("price_regular")
    return d.select("retailer_id", *[price if c == "price_regular" else F.coalesce(F.col(c), F.lit("")).alias(c) for c in _F1_COLS])


@register("feed_mpower_csv", O.with_clause(_F1_NO_LONG, O.mpower_ctes("f1", "mp")) + "\nSELECT * FROM mp")
def q_feed_mpower_csv(spark, sf_dir):
    return feeds.feed_mpower(_landed_f1(spark, sf_dir))


def _numbered(df, *cols, keys=("retailer_id",)):
    """Raw scanned rows with their number in file order."""
    from pyspark.sql import Window
    n = F.row_number().over(Window.partitionBy(*keys).orderBy("_ord")).alias("n")
    return df.select(*keys, n, *cols)


_RAW = O.with_clause("""raw AS (SELECT CAST(l_suppkey AS VARCHAR) AS retailer_id, l_orderkey // 100000 AS part,
  row_number() OVER (PARTITION BY l_suppkey ORDER BY struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey,
    s := l_suppkey, e := l_extendedprice, q := l_quantity)) AS n,
  row_number() OVER (PARTITION BY l_suppkey, l_orderkey // 100000 ORDER BY struct_pack(o := l_orderkey, n := l_linenumber,
    p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity)) AS np, *
  FROM lineitem JOIN part ON l_partkey = p_partkey)""")


@landed
def _landed_winepos(spark, sf_dir):
    path = L.land_csv(spark, D.winepos_raw(spark, sf_dir), "winepos", sep="\t", header=False, packed=True, passes=_passes(spark, sf_dir))
    return L.retailer_from_path(SD.scan_positional(spark, path, 23, sep="\t"))


@register("scan_tsv_positional", _RAW + """
SELECT retailer_id, n, CAST(l_partkey AS VARCHAR) AS _c0, p_name AS _c1, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS _c12,
  CAST(l_quantity AS VARCHAR) AS _c11, 'x' AS _c2 FROM raw""")
def q_scan_tsv_positional(spark, sf_dir):
    return _numbered(_landed_winepos(spark, sf_dir), "_c0", "_c1", "_c12", "_c11", "_c2")


@register("feed_winepos", O.winepos_sql())
def q_feed_winepos(spark, sf_dir):
    return feeds.feed_winepos(_landed_winepos(spark, sf_dir), O.AS_OF)


def _cre_files(spark, sf_dir, v2):
    return L.land_lines(spark, D.cre_lines(spark, sf_dir, v2=v2), "cre_v2" if v2 else "cre", head=D.CRE_HEAD, tail=D.CRE_TAIL if v2 else "",
                        packed=True, passes=_passes(spark, sf_dir))


@landed
def _landed_cre(spark, sf_dir, v2):
    path = _cre_files(spark, sf_dir, v2)
    return L.retailer_from_path(SD.scan_lines_skipping(spark, path, 101 if v2 else 91, sep="|", skip_head=5,
                                                        drop_last=v2))


def _pipe_sql(fields: int) -> str:
    return _RAW + f"""
SELECT retailer_id, part AS _part, np AS n, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS _c0, p_name AS _c1,
  CAST(l_partkey AS VARCHAR) || '-0' AS _c90{', ' + str(fields) + ' AS fields' if fields else ''} FROM raw"""


def _pipe_rows(df):
    return _numbered(L.with_part(df), "_c0", "_c1", "_c90", keys=("retailer_id", "_part"))


@register("scan_pipe_preamble", _pipe_sql(0))
def q_scan_pipe_preamble(spark, sf_dir):
    return _pipe_rows(_landed_cre(spark, sf_dir, False))


@register("scan_pipe_trailer", _pipe_sql(0))
def q_scan_pipe_trailer(spark, sf_dir):
    return _pipe_rows(_landed_cre(spark, sf_dir, True))


@register("drop_last", _pipe_sql(101))
def q_drop_last(spark, sf_dir):
    """The lines themselves: without each file's preamble and its last line."""
    path = _cre_files(spark, sf_dir, True)
    lines = SD.drop_edge_lines(spark, path, skip_head=5, drop_last=True)
    cells = F.split("value", "[|]")
    lines = L.with_part(L.retailer_from_path(lines)).withColumns({
        "_c0": cells[0], "_c1": cells[1], "_c90": cells[90], "fields": F.size(cells)})
    return _numbered(lines, "_c0", "_c1", "_c90", "fields", keys=("retailer_id", "_part"))


@register("feed_cashregisterexpress", O.cre_sql())
def q_feed_cashregisterexpress(spark, sf_dir):
    return feeds.feed_cashregisterexpress(_landed_cre(spark, sf_dir, False))


@register("feed_cashregisterexpress_v2", O.cre_sql())
def q_feed_cashregisterexpress_v2(spark, sf_dir):
    return feeds.feed_cashregisterexpress(_landed_cre(spark, sf_dir, True), v2=True)


@landed
def _landed_xml(spark, sf_dir):
    path = L.land_xml(spark, D.spirit_xml_rows(spark, sf_dir), "spirit_xml", packed=True)
    return L.retailer_from_path(SS.scan_xml_rows(spark, path))


@register("scan_xml_rows", _RAW + """
SELECT retailer_id, n, CAST(l_partkey AS VARCHAR) AS sku, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS upccode,
  CAST(l_extendedprice AS VARCHAR) AS unitprice FROM raw""")
def q_scan_xml_rows(spark, sf_dir):
    return _numbered(_landed_xml(spark, sf_dir), "sku", "upccode", "unitprice")


@register("feed_spirit2000_xml", O.spirit_xml_sql())
def q_feed_spirit2000_xml(spark, sf_dir):
    return feeds.feed_spirit2000_xml(_landed_xml(spark, sf_dir))


@landed
def _landed_mpower_pages(spark, sf_dir):
    path = L.land_json(spark, D.mpower_pages(spark, sf_dir), "mpower_pages")
    return SS.mpower_items(SS.scan_json(spark, path, SS.MPOWER_PAGE_SCHEMA))


@register("scan_json_mpower", O.with_clause(O.MPOWER_API_FLAT) + """
SELECT retailer_id, CAST(o_orderkey AS BIGINT) AS id, any_value(product_id) AS sku, count(l_linenumber) AS n_upcs
FROM mpa_flat GROUP BY retailer_id, o_orderkey""")
def q_scan_json_mpower(spark, sf_dir):
    return _landed_mpower_pages(spark, sf_dir).select(
        "retailer_id", F.col("Id").alias("id"), F.col("SkuNumber").alias("sku"),
        F.size("AdditionalUpcs").cast("long").alias("n_upcs"))


@register("feed_mpower_api", O.mpower_api_sql())
def q_feed_mpower_api(spark, sf_dir):
    return feeds.feed_mpower_api(_landed_mpower_pages(spark, sf_dir))


@register("join_outer_upcs", O.with_clause(O.MPOWER_API_FLAT) + """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(l_linenumber AS VARCHAR) AS add_upc, l_extendedprice AS add_retail
FROM mpa_flat""")
def q_join_outer_upcs(spark, sf_dir):
    items = _landed_mpower_pages(spark, sf_dir)
    return SS.outer_upcs(items).select(F.col("Id").alias("id"), F.col("_add.Upc").alias("add_upc"),
                                       F.col("_add.Retail").alias("add_retail"))


@register("union_pages", """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_custkey % 10 AS VARCHAR) AS retailer_id,
  CASE WHEN CAST(trunc(o_orderkey / 100) AS BIGINT) % 3 = 0 THEN NULL ELSE o_orderpriority END AS category FROM orders""")
def q_union_pages(spark, sf_dir):
    """Pages of two shapes: every third page has no Category column at all."""
    pages = D.mpower_pages(spark, sf_dir)
    bare = pages.where(F.col("page") % 3 == 0).withColumn("Results", F.transform("Results", lambda r: r.dropFields("Category")))
    paths = [L.land_json(spark, d, "pages") for d in (pages.where(F.col("page") % 3 != 0), bare)]
    items = SS.mpower_items(SS.scan_json(spark, paths, SS.MPOWER_PAGE_SCHEMA))
    return items.select(F.col("Id").alias("id"), "retailer_id", F.col("Category").alias("category"))


# ------------------------------------------------------ simple POS kinds

_SIMPLE = {
    "tiger": feeds.feed_tiger, "fastraxpos": feeds.feed_fastraxpos, "ptech": feeds.feed_ptech,
    "lajoypos": feeds.feed_lajoypos, "cobaltconnect": feeds.feed_cobaltconnect,
    "lightspeed": feeds.feed_lightspeed, "square": feeds.feed_square,
}


def _simple_query(pos, fn):
    return lambda spark, sf_dir: fn(D.pos_export(spark, sf_dir, pos))


for _pos, _fn in _SIMPLE.items():
    register(f"feed_{_pos}", O.simple_pos_sql(_pos))(_simple_query(_pos, _fn))

register("feed_businessmasterespanol", O.simple_pos_sql("businessmasterespanol"))(
    lambda spark, sf: feeds.feed_businessmasterespanol(D.pos_export(spark, sf, "businessmasterespanol"), O.AS_OF))
register("feed_liquorpos", O.liquorpos_sql(True))(
    lambda spark, sf: feeds.feed_liquorpos(*D.liquorpos_members(spark, sf)))


@register("join_code_inner", O.with_clause(O.LP, O.LIQ) + """
SELECT retailer_id, code_num, barcode, brand, price FROM lq_join""")
def q_join_code_inner(spark, sf_dir):
    from tillflow.operators.columns import cols_lower
    from tillflow.operators.joins import join_inner_chain
    b, lq = D.liquorpos_members(spark, sf_dir)
    b = cols_lower(b).select("retailer_id", "code_num", "barcode")
    lq = cols_lower(lq).drop("barcode", "_ord")
    return join_inner_chain([b, lq], ["retailer_id", "code_num"]).select(
        "retailer_id", "code_num", "barcode", "brand", "price")


# ------------------------------------------------ unified inventory / sinks

from tillflow.plans import pipeline as PL  # noqa: E402
from tillflow.plans import sinks as SK  # noqa: E402
from tillflow.session import shared_dir, together  # noqa: E402


KINDS = ["mpower_lines", "tiger", "fastraxpos", "ptech", "lajoypos", "cobaltconnect", "lightspeed", "square",
         "businessmasterespanol", "liquorpos", "liquorpos_csv", "spirit2000_csv", "spirit2000_dbf", "spirit2000_tower",
         "spirit2000_xml", "kmds", "winepos", "cashregisterexpress", "cashregisterexpress_v2"]


_OWN = "(l_suppkey * 3 + l_orderkey % 3)"      # a retailer: a supplier's lines of every third order


def _of_kind(spark, sf_dir, k: int, n: int = len(KINDS)) -> dict:
    """The tables of the retailers of one POS kind; a retailer's number says its kind."""
    li = D.table(spark, sf_dir, "lineitem").withColumn("l_suppkey", F.expr(_OWN)).where(F.col("l_suppkey") % n == k)
    return {"lineitem": li, "part": D.table(spark, sf_dir, "part")}


def _kind_sql(sql: str, k: int, n: int = len(KINDS), where: str = "true") -> str:
    return sql.replace("lineitem", f"(SELECT * REPLACE ({_OWN} AS l_suppkey) FROM lineitem WHERE {_OWN} % {n} = {k} AND {where})")


def _unified_frames(spark, sf_dir):
    """Canonical rows of all 21 adapters: every line belongs to one retailer and
    so to one POS kind; the page feeds and lookups have retailers of their own."""
    t = {kind: _of_kind(spark, sf_dir, k) for k, kind in enumerate(KINDS)}
    frames = {kind: fn(D.pos_export(spark, t[kind], kind)) for kind, fn in _SIMPLE.items()}
    return frames | {
        "mpower": feeds.feed_mpower(D.f1_base(spark, sf_dir)),
        "mpower_lines": feeds.feed_mpower(D.f8_lines(spark, t["mpower_lines"])),
        "mpower_api": feeds.feed_mpower_api(SS.mpower_items(D.mpower_pages(spark, sf_dir))),
        "adventpos": feeds.feed_adventpos(D.f3_items(spark, sf_dir), D.f3_size(spark, sf_dir), D.f3_pack(spark, sf_dir)),
        "businessmasterespanol": feeds.feed_businessmasterespanol(
            D.pos_export(spark, t["businessmasterespanol"], "businessmasterespanol"), O.AS_OF),
        "liquorpos": feeds.feed_liquorpos(*D.liquorpos_members(spark, t["liquorpos"])),
        "liquorpos_csv": feeds.feed_liquorpos_csv(*D.liquorpos_members(spark, t["liquorpos_csv"])),
        "spirit2000_csv": feeds.feed_spirit2000_csv(*_f2(spark, t["spirit2000_csv"])),
        "spirit2000_dbf": feeds.feed_spirit2000_dbf(*_f2(spark, t["spirit2000_dbf"])),
        "spirit2000_tower": feeds.feed_spirit2000_tower(*_f2(spark, t["spirit2000_tower"]), upc_ts="tstamp"),
        "spirit2000_xml": feeds.feed_spirit2000_xml(D.spirit_xml_rows(spark, t["spirit2000_xml"])),
        "kmds": feeds.feed_kmds(D.f6_barcodes(spark, t["kmds"])),
        "winepos": feeds.feed_winepos(D.winepos_raw(spark, t["winepos"]), O.AS_OF),
        "cashregisterexpress": feeds.feed_cashregisterexpress(D.cre_rows(spark, t["cashregisterexpress"], False)),
        "cashregisterexpress_v2": feeds.feed_cashregisterexpress(D.cre_rows(spark, t["cashregisterexpress_v2"], True), v2=True),
    }


def _kind_canon_sql(kind: str) -> str:
    """Canonical rows of one kind, over the whole line table."""
    if kind in _SIMPLE or kind == "businessmasterespanol":
        return O.simple_pos_sql(kind)
    return {"mpower_lines": _sql_f8_mpower, "liquorpos": lambda: O.liquorpos_sql(True), "liquorpos_csv": lambda: O.liquorpos_sql(False),
            "spirit2000_csv": lambda: O.spirit_sql("csv"), "spirit2000_dbf": lambda: O.spirit_sql("dbf"),
            "spirit2000_tower": lambda: O.spirit_sql("tower"), "spirit2000_xml": O.spirit_xml_sql, "kmds": O.kmds_sql,
            "winepos": O.winepos_sql, "cashregisterexpress": O.cre_sql, "cashregisterexpress_v2": O.cre_sql}[kind]()


def _unified_sql(select_cols: str | None = None) -> str:
    parts = [(kind, _kind_sql(_kind_canon_sql(kind), k)) for k, kind in enumerate(KINDS)]
    parts += [("mpower", O.with_clause(O.F1, O.mpower_ctes("f1", "mp")) + "\nSELECT * FROM mp"),
              ("mpower_api", O.mpower_api_sql()), ("adventpos", O.advent_sql())]
    cols = ", ".join(["retailer_id", *O.CANON])
    union = "\nUNION ALL\n".join(f"SELECT '{pos}' AS pos, {cols} FROM ({sql})" for pos, sql in parts)
    if select_cols:
        return f"SELECT {select_cols} FROM ({union})"
    pctes, pout = O.parse_ctes("u")
    return (O.with_clause(f"u AS MATERIALIZED ({union})", pctes) +
            f"\nSELECT {', '.join(O.CANON + O.PARSED)}, 1 AS active, retailer_id, pos FROM {pout}")


@register("unified_inventory", _unified_sql())
def q_unified_inventory(spark, sf_dir):
    return PL.unified_inventory(_unified_frames(spark, sf_dir))


@register("union_feeds", _unified_sql("pos, retailer_id, rt_product_id, price_regular"))
def q_union_feeds(spark, sf_dir):
    frames = _unified_frames(spark, sf_dir)
    return PL.union_feeds([PL.tag(d, p) for p, d in frames.items()]).select(
        "pos", "retailer_id", "rt_product_id", "price_regular")


@register("sink_processed", _sql_parse_package())
def q_sink_processed(spark, sf_dir):
    path = shared_dir(spark, "processed")
    SK.write_processed(q_parse_package(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.withColumn("retailer_id", F.col("retailer_id").cast("string")).select(*OUTPUT_COLUMNS)


@register("sink_timestamped", _sql_parse_package().replace(
    ", 1 AS active, retailer_id FROM pp_out", ", 1 AS active, retailer_id, '19970601-000000' AS ingest_ts FROM pp_out"))
def q_sink_timestamped(spark, sf_dir):
    path = shared_dir(spark, "processed_ts")
    SK.write_timestamped(q_parse_package(spark, sf_dir), path, O.AS_OF)
    back = spark.read.option("basePath", path).parquet(path)
    return back.withColumns({"retailer_id": F.col("retailer_id").cast("string"),
                             "ingest_ts": F.col("ingest_ts").cast("string")}).select(*OUTPUT_COLUMNS, "ingest_ts")


@register("sink_landed_csv", O.with_clause(O.MPOWER_API_FLAT) + """
SELECT retailer_id, product_id, upc_code FROM mpa""")
def q_sink_landed_csv(spark, sf_dir):
    rows = feeds.mpower_api_rows(_landed_mpower_pages(spark, sf_dir)).drop("_ord")
    path = shared_dir(spark, "landed_api")
    SK.write_landed_csv(rows, path)
    back = spark.read.option("header", True).schema(
        ", ".join(f"`{c}` string" for c in rows.columns if c != "retailer_id") + ", retailer_id string").csv(path)
    return back.select("retailer_id", "product_id", F.coalesce(F.col("upc_code"), F.lit("")).alias("upc_code"))


# ------------------------------------------------ uploads -> registry -> inventory

UPLOADS = [k for k in KINDS if k != "mpower_lines"] + ["unknown"]
_EXT = {"spirit2000_xml": ".xml", "liquorpos": ".zip", "liquorpos_csv": ".zip", "spirit2000_csv": ".zip",
        "spirit2000_dbf": ".zip", "spirit2000_tower": ".zip", "adventpos": ".zip"}


@landed
def _uploads(spark, sf_dir):
    """Every kind's export as uploads of one folder, and their registry.  Line
    retailers r: those of r % 17 = 0 have no registry row, r % 19 = 0 a wrong file
    type, the last kind is unknown.  MPower retailers are 200001 and up, AdventPOS
    100000 and up."""
    root = shared_dir(spark, "uploads")
    n = len(UPLOADS)
    t = {kind: _of_kind(spark, sf_dir, k, n) for k, kind in enumerate(UPLOADS)}

    def named(df, kind):
        r = F.col("retailer_id").cast("long")
        return df.withColumn("retailer_id", F.concat(
            F.lit("r"), F.col("retailer_id"), F.when(r % 19 == 0, F.lit(".txt")).otherwise(F.lit(_EXT.get(kind, ".csv")))))

    def csv(df, **kw):
        L.land_csv(spark, df, "uploads", path=root, mode="append", **kw)

    def lines(df, **kw):
        L.land_lines(spark, df, "uploads", path=root, **kw)

    def archive(kind):
        ext = ".dbf" if kind in ("liquorpos", "spirit2000_dbf", "spirit2000_tower") else ".csv"
        if kind == "adventpos":
            one = [("ZZ_AdventPOS_Raw", D.f3_items(spark, sf_dir)), ("ZZ_AdventPOS_Raw_ItemSize", D.f3_size(spark, sf_dir)),
                   ("ZZ_AdventPOS_Raw_ItemPack", D.f3_pack(spark, sf_dir))]
            members = [(n, d.withColumns({"_part": F.lit(0), "retailer_id": F.concat(F.lit("a"), "retailer_id", F.lit(".zip"))}))
                       for n, d in one]
        elif kind.startswith("liquorpos"):
            members = [(n, named(d, kind)) for n, d in zip(("BARCODES", "LIQCODE"), D.liquorpos_members(spark, t[kind]))]
        else:
            inv, prc, stk, upc = _f2(spark, t[kind])
            upc = upc.withColumnRenamed("tstamp", "LAST") if kind == "spirit2000_tower" else upc
            members = [(n, named(D.f2_member(d), kind)) for n, d in zip(("inv", "prc", "stk", "upc"), (inv, prc, stk, upc))]
        return L.land_zip_members(spark, {name + ext: d for name, d in members}, "uploads_zip")

    of = functools.partial
    steps = [of(lambda k: csv(named(D.pos_export(spark, t[k], k), k)), k) for k in [*_SIMPLE, "businessmasterespanol"]]
    steps += [lambda: csv(named(D.pos_export(spark, t["unknown"], "tiger"), "unknown")),
              lambda: csv(named(D.winepos_raw(spark, t["winepos"]), "winepos"), sep="\t", header=False),
              lambda: csv(D.f1_base(spark, sf_dir).withColumn("retailer_id", F.concat(F.lit("m"), "retailer_id", F.lit(".csv")))),
              lambda: L.land_xml(spark, named(D.spirit_xml_rows(spark, t["spirit2000_xml"]), "spirit2000_xml"), "uploads", path=root)]
    steps += [of(lambda k, v2: lines(named(D.cre_lines(spark, t[k], v2=v2), k), head=D.CRE_HEAD, tail=D.CRE_TAIL if v2 else ""), k, v2)
              for k, v2 in (("cashregisterexpress", False), ("cashregisterexpress_v2", True))]
    steps.append(lambda: lines(named(D.kmds_lines(spark, t["kmds"]), "kmds"), head=D.KMDS_HEAD))
    landings = len(steps)
    steps += [of(archive, k) for k in ("liquorpos", "liquorpos_csv", "spirit2000_csv", "spirit2000_dbf", "spirit2000_tower", "adventpos")]
    zips = functools.reduce(lambda x, y: x.unionByName(y), together(spark, steps)[landings:])
    zips = zips.withColumn("path", F.concat(F.lit(root + "/"), "path"))

    r = F.col("r")
    kind = F.element_at(F.array(*[F.lit(k) for k in UPLOADS]), (r % n + 1).cast("int"))
    ext = F.when(r % 19 == 0, F.lit(".txt")).when(kind.isin([k for k, e in _EXT.items() if e == ".zip"]), F.lit(".zip")).when(
        kind == "spirit2000_xml", F.lit(".xml")).otherwise(F.lit(".csv"))
    of_lines = (D.table(spark, sf_dir, "lineitem").select(F.expr(_OWN).alias("r")).distinct().where(r % 17 != 0)
                .select(r.alias("id"), kind.alias("pos"), F.concat(F.lit("R"), D.s("r"), ext).alias("filename")))
    m = D.numbers(spark, 11, "i").where("i > 0").select((F.col("i") + 200_000).alias("id"), F.lit("MPower").alias("pos"),
                                                         F.concat(F.lit("m"), D.s("i"), F.lit(".csv")).alias("filename"))
    a = D.numbers(spark, D.F3_RETAILERS, "i").select((F.col("i") + 100_000).alias("id"), F.lit("AdventPOS").alias("pos"),
                                                     F.concat(F.lit("a"), D.s("i"), F.lit(".zip")).alias("filename"))
    return root, of_lines.unionByName(m).unionByName(a), zips


@landed
def _normalised(spark, sf_dir):
    """(good, rejects); both queries of a session share one run."""
    from tillflow.plans.normalise import normalise
    root, registry, zips = _uploads(spark, sf_dir)
    return normalise(spark, root, registry, O.AS_OF, archives=zips)


def _normalised_sql() -> str:
    n, ok = len(UPLOADS), f"{_OWN} % 17 <> 0 AND {_OWN} % 19 <> 0"
    cols = ", ".join(O.CANON)
    parts = [f"SELECT '{kind}' AS pos, retailer_id, {cols} FROM ({_kind_sql(_kind_canon_sql(kind), k, n, ok)})"
             for k, kind in enumerate(UPLOADS[:-1])]
    for pos, sql, shift in (("mpower", O.with_clause(O.F1, O.mpower_ctes("f1", "mp")) + "\nSELECT * FROM mp", 200_000),
                            ("adventpos", O.advent_sql(), 100_000)):
        parts.append(f"SELECT '{pos}' AS pos, CAST({shift} + CAST(retailer_id AS BIGINT) AS VARCHAR) AS retailer_id, {cols} FROM ({sql})")
    pctes, pout = O.parse_ctes("u")
    union = "\nUNION ALL\n".join(parts)
    return (O.with_clause(f"u AS MATERIALIZED ({union})", pctes) +
            f"\nSELECT {', '.join(O.CANON + O.PARSED)}, 1 AS active, retailer_id, pos FROM {pout}")


@register("normalise_good", _normalised_sql())
def q_normalise_good(spark, sf_dir):
    return _normalised(spark, sf_dir)[0]


@register("normalise_rejects", f"""
WITH u AS (SELECT DISTINCT {_OWN} AS r FROM lineitem),
k AS (SELECT r, [{', '.join(repr(k) for k in UPLOADS)}][r % {len(UPLOADS)} + 1] AS kind FROM u),
f AS (SELECT *, 'r' || CAST(r AS VARCHAR) || CASE WHEN r % 19 = 0 THEN '.txt'
  WHEN kind IN ({', '.join(repr(k) for k, e in _EXT.items() if e == '.zip')}) THEN '.zip' WHEN kind = 'spirit2000_xml' THEN '.xml'
  ELSE '.csv' END AS name FROM k)
SELECT CASE WHEN r % 17 <> 0 THEN CAST(r AS VARCHAR) END AS retailer_id, CASE WHEN r % 17 <> 0 THEN kind END AS source,
  CASE WHEN r % 17 = 0 THEN 'no_registry_row' WHEN kind = 'unknown' THEN 'unknown_pos' ELSE 'unrecognized_file_type' END AS reason,
  name AS record FROM f WHERE r % 17 = 0 OR kind = 'unknown' OR r % 19 = 0
UNION ALL
SELECT CAST(200000 + p_partkey % 10 + 1 AS VARCHAR), 'mpower', 'missing_product_id',
  concat('0', CAST(p_partkey * 7919 AS VARCHAR), CASE WHEN p_partkey % 10 = 0 THEN '.0' ELSE '' END) FROM part WHERE p_partkey % 89 = 0""")
def q_normalise_rejects(spark, sf_dir):
    """The rejects table; of a rejected row's record, its barcode."""
    bad = _normalised(spark, sf_dir)[1]
    upc = F.get_json_object("record", "$.rt_upc_code")
    return bad.withColumn("record", F.when(F.col("reason") == "missing_product_id", upc).otherwise(F.col("record")))


# --------------------------------------------------------------- streaming

def _drain(spark, base, uploads, root, registry):
    from tillflow.streaming.intake import start_intake
    start_intake(uploads, root, registry, O.AS_OF, base + "/table", base + "/rejects", base + "/checkpoint").awaitTermination()


def _f1_registry(spark):
    return D.numbers(spark, 11, "i").where("i > 0").select(F.col("i").alias("id"), F.lit("MPower").alias("pos"),
                                                           F.concat(F.lit("m"), D.s("i"), F.lit(".csv")).alias("filename"))


def _streamed_f1(spark, drops, base):
    """Drops of F1 rows into a landing folder; the stream runs after each drop
    (availableNow) and takes only the new files."""
    from tillflow.streaming.intake import uploads_stream
    landing = base + "/landing"
    for drop in drops:
        L.land_csv(spark, drop.withColumn("retailer_id", F.concat(F.lit("m"), "retailer_id", F.lit(".csv"))),
                   "unused", path=landing, mode="append")
        _drain(spark, base, uploads_stream(spark, landing), landing, lambda: _f1_registry(spark))


@register("stream_intake", _sql_parse_package())
def q_stream_intake(spark, sf_dir):
    """Two drops of feed files: the table holds the rows of both."""
    from tillflow.plans.current import current
    f1 = D.f1_base(spark, sf_dir)
    base = shared_dir(spark, "stream")
    _streamed_f1(spark, [f1.where(F.col("_ord") % 2 == 0), f1.where(F.col("_ord") % 2 == 1)], base)
    return current(spark, base + "/table").select(*OUTPUT_COLUMNS)


def _sql_stream_current() -> str:
    drop = "CASE WHEN _ord % 5 = 0 THEN 2 WHEN _ord % 3 = 0 THEN 1 ELSE 0 END"
    last = f"""f1u AS (SELECT * EXCLUDE (qty_on_hand, product_category), CAST(CAST(qty_on_hand AS BIGINT) + 100 * ({drop}) AS VARCHAR) AS qty_on_hand,
  CASE WHEN {drop} > 0 THEN concat('drop ', {drop}) ELSE product_category END AS product_category FROM f1)"""
    pctes, pout = O.parse_ctes("mp")
    return (O.with_clause(O.F1, last, O.mpower_ctes("f1u", "mp"), pctes) +
            f"\nSELECT {', '.join(O.CANON + O.PARSED)}, 1 AS active, retailer_id FROM {pout}")


@register("stream_current", _sql_stream_current())
def q_stream_current(spark, sf_dir):
    """Three drops, each with its own column order; the later ones bring newer rows of
    products that are there already.  One current row per product remains."""
    from tillflow.plans.current import current
    f1 = D.f1_base(spark, sf_dir)
    base = shared_dir(spark, "stream")

    def drop(i, every):
        cols = [c for c in f1.columns if c not in ("retailer_id", "_ord")]
        newer = f1.where(F.col("_ord") % every == 0).withColumns({
            "qty_on_hand": D.s(F.col("qty_on_hand").cast("long") + 100 * i),
            "product_category": F.lit(f"drop {i}") if i else F.col("product_category")})
        return newer.select("retailer_id", "_ord", *cols[4 * i:], *cols[:4 * i])

    _streamed_f1(spark, [drop(0, 1), drop(1, 3), drop(2, 5)], base)
    return current(spark, base + "/table").select(*OUTPUT_COLUMNS)


@landed
def _streamed_uploads(spark, sf_dir):
    """All kinds' uploads arrive in two drops, an upload's files together, as a table of
    (path, content); each drop is a micro-batch."""
    from tillflow.plans.normalise import upload_name
    root, registry, zips = _uploads(spark, sf_dir)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.lit(None).cast("binary").alias("content"))
    arrivals = listed.unionByName(zips.select("path", "content")).withColumn(
        "drop", F.pmod(F.xxhash64(upload_name(F.col("path"), root)), F.lit(2)))
    base = shared_dir(spark, "stream_uploads")
    for i in range(2):
        arrivals.where(F.col("drop") == i).drop("drop").write.mode("append").parquet(base + "/arrivals")
        _drain(spark, base, spark.readStream.schema("path string, content binary").parquet(base + "/arrivals"), root, registry)
    return base


@register("stream_normalise", _normalised_sql())
def q_stream_normalise(spark, sf_dir):
    """Uploads of all kinds through the stream: the table of one batch run over all."""
    from tillflow.plans.current import current
    return current(spark, _streamed_uploads(spark, sf_dir) + "/table")


@register("stream_rejects", ORACLE["normalise_rejects"])
def q_stream_rejects(spark, sf_dir):
    bad = spark.read.parquet(_streamed_uploads(spark, sf_dir) + "/rejects").drop("batch_id")
    upc = F.get_json_object("record", "$.rt_upc_code")
    return bad.withColumn("record", F.when(F.col("reason") == "missing_product_id", upc).otherwise(F.col("record")))


# --------------------------------------------------- API pages (JSON) / misc

@landed
def _landed_lightspeed(spark, sf_dir):
    ip, cp, rp = (L.land_json(spark, d, "lightspeed") for d in D.lightspeed_pages(spark, sf_dir))
    return (SS.scan_json(spark, ip, SS.LIGHTSPEED_ITEM_PAGE_SCHEMA),
            SS.scan_json(spark, cp, SS.LIGHTSPEED_CATEGORY_PAGE_SCHEMA), SS.registry_shops(SS.scan_registry(spark, rp)))


@register("scan_json_lightspeed", O.lightspeed_sql())
def q_scan_json_lightspeed(spark, sf_dir):
    return feeds.feed_lightspeed(SS.lightspeed_items(*_landed_lightspeed(spark, sf_dir)))


@register("join_item_price_qty", O.with_clause(O.LIGHTSPEED) + "\nSELECT itemID, amount, qoh FROM ls_items")
def q_join_item_price_qty(spark, sf_dir):
    return SS.lightspeed_items(*_landed_lightspeed(spark, sf_dir)).select("itemID", "amount", "qoh")


@register("join_category_left", O.with_clause(O.LIGHTSPEED) + "\nSELECT itemID, name, fullPathName FROM ls_rows")
def q_join_category_left(spark, sf_dir):
    return SS.lightspeed_items(*_landed_lightspeed(spark, sf_dir)).select("itemID", "name", "fullPathName")


@register("filter_shop", O.with_clause(O.LIGHTSPEED) + "\nSELECT itemID, amount FROM ls_items")
def q_filter_shop(spark, sf_dir):
    items, _, shops = _landed_lightspeed(spark, sf_dir)
    x = items.join(shops, "retailer_id").select("shop_id", F.explode("Item").alias("i")).select(
        "shop_id", F.col("i.itemID").alias("itemID"), F.col("i.Prices.ItemPrice").alias("prices"))
    x = C.filter_shop(x, "prices", "useTypeID")
    return x.select("itemID", F.explode("prices").alias("p")).select("itemID", F.col("p.amount").alias("amount"))


def _square(spark, sf_dir):
    return SS.square_catalog(*D.square_objects(spark, sf_dir))


@register("join_catalog_chain", O.with_clause(O.SQUARE) + """
SELECT retailer_id, item_variation_object_id, iname AS item_name, cname AS category_name, quantity FROM sq_rows""")
def q_join_catalog_chain(spark, sf_dir):
    x = _square(spark, sf_dir)
    return x.select("retailer_id", "item_variation_object_id", F.col("item_data.name").alias("item_name"),
                    F.col("category_data.name").alias("category_name"), "quantity")


@register("filter_in_stock", O.with_clause(O.SQUARE) + "\nSELECT item_variation_object_id FROM sq_rows")
def q_filter_in_stock(spark, sf_dir):
    return _square(spark, sf_dir).select("item_variation_object_id")


@register("flatten_struct", O.with_clause(O.SQUARE) + """
SELECT item_variation_object_id, sku AS "item_variation_data.sku", iname AS "item_data.name",
  amount AS "item_variation_data.price_money.amount" FROM sq_rows""")
def q_flatten_struct(spark, sf_dir):
    flat = C.flatten_struct(_square(spark, sf_dir))
    return flat.select("item_variation_object_id", "`item_variation_data.sku`", "`item_data.name`",
                       "`item_variation_data.price_money.amount`")


@register("scan_json_square", O.square_sql())
def q_scan_json_square(spark, sf_dir):
    *objects, locations = D.square_objects(spark, sf_dir)
    back = [spark.read.schema(d.schema).json(L.land_json(spark, d, "square")) for d in objects]
    return feeds.feed_square(C.flatten_struct(SS.square_catalog(*back, locations)))


@landed
def _landed_square_pages(spark, sf_dir):
    return SS.scan_square_pages(spark, L.land_json(spark, D.square_pages(spark, sf_dir), "square_pages"))


@register("scan_square_pages", O.square_sql())
def q_scan_square_pages(spark, sf_dir):
    """Pages as the API gives them, some landed twice -> the adapter."""
    locations = D.square_objects(spark, sf_dir)[-1]
    return feeds.feed_square(C.flatten_struct(SS.square_catalog(*SS.square_members(_landed_square_pages(spark, sf_dir)), locations)))


_MPA_PAGES = O.with_clause(O.MPOWER_API_FLAT, """pg AS (
  SELECT retailer_id, CAST(trunc(o_orderkey / 100) AS BIGINT) AS page, count(DISTINCT o_orderkey) AS items FROM mpa_flat GROUP BY 1, 2)""")


@register("page_gate", _MPA_PAGES + """
SELECT retailer_id, count(*) AS pages, sum(items)::BIGINT AS items, max(page % 3)::INTEGER AS released_in
FROM pg WHERE retailer_id <> '3' GROUP BY retailer_id""")
def q_page_gate(spark, sf_dir):
    """Pages in three drops: each feed goes on once, whole, with the drop that completes it; retailer 3's last
    page never comes."""
    from tillflow.streaming.pages import gate
    pages = SS.scan_json(spark, L.land_json(spark, D.mpower_pages(spark, sf_dir), "mpower_pages_gate"), SS.MPOWER_PAGE_SCHEMA).drop("_file_name")
    base, out = shared_dir(spark, "page_gate"), None
    for i in range(3):
        released, _ = gate(spark, base, pages.where(F.col("page") % 3 == i), i)
        got = released.groupBy("retailer_id").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.size("Results")).alias("items"),
                                                  F.lit(i).alias("released_in"))
        out = got if out is None else out.unionByName(got)
    return out


@register("member_prune", O.with_clause(O.F2) + "\nSELECT retailer_id, sku, name, sname FROM f2_inv")
def q_member_prune(spark, sf_dir):
    return C.member_prune(D.f2_inv(spark, sf_dir), ["sku", "name", "sname", "absent"])


@register("route_members", """
WITH f AS (SELECT CAST(s_suppkey AS VARCHAR) AS retailer_id, x FROM supplier,
  (SELECT unnest(['INV.CSV', 'prc.csv', 'Stk.DBF', 'upc.dbf', 'barcodes.dbf', 'LIQCODE.csv', 'readme.txt',
                  'ZZ_AdventPOS_Raw_ItemSize.csv', 'invoices.csv', 'old/OLD-Inv.csv']) AS x))
SELECT retailer_id, 'exports/s' || retailer_id || '/' || x AS _file_name,
  CASE x WHEN 'INV.CSV' THEN 'inv' WHEN 'old/OLD-Inv.csv' THEN 'inv' WHEN 'prc.csv' THEN 'prc' WHEN 'Stk.DBF' THEN 'stk'
    WHEN 'upc.dbf' THEN 'upc' WHEN 'barcodes.dbf' THEN 'barcodes' WHEN 'LIQCODE.csv' THEN 'liqcode'
    WHEN 'ZZ_AdventPOS_Raw_ItemSize.csv' THEN 'itemsize' END AS member
FROM f""")
def q_route_members(spark, sf_dir):
    return C.route_members(D.member_files(spark, sf_dir))


@register("agg_pages", O.with_clause(O.MPOWER_API_FLAT) + """
SELECT retailer_id, pages, items, pages + extra AS declared, extra = 0 AS complete FROM (
  SELECT retailer_id, count(DISTINCT CAST(trunc(o_orderkey / 100) AS BIGINT)) AS pages,
    count(DISTINCT o_orderkey) AS items, CASE WHEN retailer_id = '3' THEN 1 ELSE 0 END AS extra
  FROM mpa_flat GROUP BY retailer_id)""")
def q_agg_pages(spark, sf_dir):
    pages = SS.scan_json(spark, L.land_json(spark, D.mpower_pages(spark, sf_dir), "mpower_pages_agg"),
                         SS.MPOWER_PAGE_SCHEMA)
    return SS.page_check(pages)


@register("filter_incremental", O.with_clause(O.F2, """hw AS (
  SELECT retailer_id, max(tstamp) AS hw FROM f2_stk GROUP BY retailer_id)""") + """
SELECT p.retailer_id, p.sku, p.tstamp FROM f2_prc p LEFT JOIN hw USING (retailer_id)
WHERE hw.hw IS NULL OR p.tstamp > hw.hw""")
def q_filter_incremental(spark, sf_dir):
    hw = D.f2_stk(spark, sf_dir).groupBy("retailer_id").agg(F.max("tstamp").alias("hw"))
    return C.filter_incremental(D.f2_prc(spark, sf_dir), hw, "tstamp").select("retailer_id", "sku", "tstamp")


@register("pull_incremental", O.with_clause(O.F2, """p0 AS (SELECT * FROM f2_prc WHERE tstamp < TIMESTAMP '1995-01-01'),
hw AS (SELECT retailer_id, max(tstamp) AS hw FROM p0 GROUP BY retailer_id)""") + """
SELECT retailer_id, sku, tstamp, 0 AS pull FROM p0
UNION ALL SELECT p.retailer_id, p.sku, p.tstamp, 1 FROM f2_prc p LEFT JOIN hw USING (retailer_id) WHERE hw.hw IS NULL OR p.tstamp > hw.hw""")
def q_pull_incremental(spark, sf_dir):
    """Two pulls, the second over everything: the marks that the sink keeps let each retailer's newer rows through."""
    from tillflow.plans.current import high_water, merge
    prc = D.f2_prc(spark, sf_dir).select("retailer_id", "sku", "tstamp")
    base, out = shared_dir(spark, "pulls"), None
    for i, pulled in enumerate((prc.where(F.col("tstamp") < F.lit("1995-01-01").cast("timestamp")), prc)):
        fresh = C.filter_incremental(pulled, high_water(spark, base, before=i), "tstamp")
        merge(spark, base, fresh, i, keys=("retailer_id", "sku", "tstamp"), mark="tstamp")
        got = fresh.withColumn("pull", F.lit(i))
        out = got if out is None else out.unionByName(got)
    return out


# ---------------------------------------------------------- dBase tables

def _with_retailer(df, path="_file_path"):
    """Retailer folder of a landed file's path (the third from its end)."""
    return df.withColumn("retailer_id", F.element_at(F.split(path, "/"), -3))


@landed
def _landed_spirit_dbf(spark, sf_dir):
    from tillflow.sources.dbf import decode_files
    out = {}
    for name, d in zip(("inv", "prc", "stk", "upc"), _f2(spark, sf_dir)):
        files = L.land_dbf(spark, D.f2_member(d), "spirit_dbf_" + name, name, _passes(spark, sf_dir))
        out[name] = _with_retailer(decode_files(files)).drop("_file_path", "_file_name", "_record", "_invalid")
    return out


@landed
def _landed_upc_dbf(spark, sf_dir):
    return L.land_dbf_files(spark, D.f2_member(D.f2_upc(spark, sf_dir)), "dbf_rows", "upc", _passes(spark, sf_dir))


@register("scan_dbf", O.with_clause(O.F2) + """
SELECT retailer_id, CAST(right(sku, 1) AS BIGINT) AS part, sku, upc,
  row_number() OVER (PARTITION BY retailer_id, right(sku, 1) ORDER BY _ord) - 1 AS record,
  date_trunc('day', tstamp) AS tstamp FROM f2_upc""")
def q_scan_dbf(spark, sf_dir):
    from tillflow.sources.dbf import scan_dbf
    upc = scan_dbf(spark, _landed_upc_dbf(spark, sf_dir), columns=["sku", "upc", "tstamp"], records_per_partition=1000)
    at = F.split("_file_path", "/")
    part = F.split(F.element_at(at, -1), "-")[0].cast("long")
    # dBase has no null text: blanks read as ''
    return upc.withColumn("retailer_id", F.element_at(at, -2)).select("retailer_id", part.alias("part"), "sku", F.nullif("upc", F.lit("")).alias("upc"),
                                      F.col("_record").alias("record"), "tstamp")


# ------------------------------------------------------------- archives

@landed
def _spirit_zips(spark, sf_dir):
    members = {f"{n}.csv": D.f2_member(d) for n, d in zip(("inv", "prc", "stk", "upc"), _f2(spark, sf_dir))}
    return L.land_zip_members(spark, members, "spirit_zip", _passes(spark, sf_dir))


def _landed_spirit_zip(spark, sf_dir):
    from tillflow.sources import archive as A
    names = ("inv", "prc", "stk", "upc")
    rows = A.stored(A.expand_archives(_spirit_zips(spark, sf_dir)))
    return [_with_retailer(A.member_rows(rows, n), "archive").drop("archive") for n in names]


def _expanded_liquorpos(spark, sf_dir):
    from tillflow.sources import archive as A
    b, lq = D.liquorpos_members(spark, sf_dir)
    return A.expand_archives(L.land_zip_members(spark, {"BARCODES.csv": b, "LIQCODE.csv": lq}, "liquorpos_zip", _passes(spark, sf_dir)))


@register("expand_archive", O.with_clause(O.LP) + """
SELECT retailer_id, pk % 3 AS part, 'BARCODES.csv' AS member, 'barcodes' AS role, count(*) AS records FROM lp GROUP BY 1, 2
UNION ALL SELECT retailer_id, pk % 3, 'LIQCODE.csv', 'liqcode', count(DISTINCT pk) FROM lp GROUP BY 1, 2""")
def q_expand_archive(spark, sf_dir):
    from tillflow.sources import archive as A
    m = A.manifest(_expanded_liquorpos(spark, sf_dir))
    return _with_retailer(m, "archive").select(
        "retailer_id", F.element_at(F.split("archive", "/"), -2).cast("long").alias("part"), "member", "role", "records")


def _liquorpos_csv(spark, sf_dir):
    from tillflow.sources import archive as A
    rows = A.stored(_expanded_liquorpos(spark, sf_dir))
    return [_with_retailer(A.member_rows(rows, role), "archive").drop("archive") for role in ("barcodes", "liqcode")]


register("feed_liquorpos_csv", O.liquorpos_sql(False))(
    lambda spark, sf: feeds.feed_liquorpos_csv(*_liquorpos_csv(spark, sf)))


# ------------------------------------------- API scalar steps (MPower pages)

def _mpower_rows(spark, sf_dir):
    return feeds.mpower_api_rows(_landed_mpower_pages(spark, sf_dir))


def _mpa_key(key: str, sql_col: str, spark_col):
    register(key, O.with_clause(O.MPOWER_API_FLAT) + f"\nSELECT retailer_id, product_id, {sql_col} AS value FROM mpa")(
        lambda spark, sf: _mpower_rows(spark, sf).select("retailer_id", "product_id", spark_col().alias("value")))


_mpa_key("coalesce_upc", "upc_code", lambda: F.col("upc_code"))
_mpa_key("retail_coalesce", "TRY_CAST(price_regular AS DOUBLE)", lambda: F.col("price_regular").cast("double"))
_mpa_key("qty_units", "TRY_CAST(qty_on_hand AS DOUBLE)", lambda: F.col("qty_on_hand").cast("double"))
_mpa_key("size_label", "package_size", lambda: F.col("package_size"))

register("cols_canonical", O.with_clause(O.F1, O.mpower_ctes("f1", "mp")) + "\nSELECT * FROM mp")(
    lambda spark, sf: C.cols_canonical(feeds.feed_mpower(D.f1_base(spark, sf))))
