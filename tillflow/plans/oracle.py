"""DuckDB SQL equivalents of the registered queries (independent cross-check).

The driver runs each ``queries()`` entry on Spark and the matching SQL here
on DuckDB over the same parquet tables, and compares rows.  The SQL is
written by hand from the rule descriptions -- it does not reuse the Spark
rule tables -- and uses RE2 (no look-around, linear time), so the number run
is the plain repeated group.
"""

from __future__ import annotations

# number run: chunks of (sign)?(dot)?digit
N = r"(?:[-+]?\.?[0-9])+"


def num(e: str) -> str:
    """Strict decimal text -> DOUBLE (NULL when malformed)."""
    pat = r"^\s*([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+))\s*$"
    return f"(CASE WHEN regexp_matches({e}, '{pat}') THEN TRY_CAST(regexp_extract({e}, '{pat}', 1) AS DOUBLE) END)"


def num_exp(e: str) -> str:
    """Like ``num`` but an exponent is allowed (numeric feed columns)."""
    pat = r"^\s*([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)\s*$"
    return (f"(CASE WHEN regexp_matches(CAST({e} AS VARCHAR), '{pat}') "
            f"THEN TRY_CAST(regexp_extract(CAST({e} AS VARCHAR), '{pat}', 1) AS DOUBLE) END)")


def float_text(e: str) -> str:
    return (f"(CASE WHEN {e} IS NULL THEN NULL WHEN {e} = floor({e}) AND abs({e}) < 1e16 "
            f"THEN CAST(CAST({e} AS BIGINT) AS VARCHAR) || '.0' ELSE CAST({e} AS VARCHAR) END)")


def _g(t: str, body: str, word: str) -> str:
    return f"regexp_extract({t}, '({body}){word}', 1)"


def _m(t: str, body: str, word: str) -> str:
    return f"regexp_matches({t}, '{body}{word}')"


def pack_case(pt: str) -> str:
    """Pack count of upper-cased text ``pt`` (with '/ PK' already -> 'PK')."""
    a = N + r"[^\n]"
    s = N + r"/[^\n]"
    tri = r"[0-9][- /.][0-9]*[- /.][0-9]*"
    strip = lambda x: f"replace({x}, '/', '')"
    return f"""(CASE
  WHEN {_m(pt, s, 'PK')} THEN abs({num(strip(_g(pt, s, 'PK')))})
  WHEN {_m(pt, a, '-PK')} THEN abs({num(strip(_g(pt, a, '-PK')))})
  WHEN {_m(pt, N, '-PK')} THEN abs({num(strip(_g(pt, N, '-PK')))})
  WHEN {_m(pt, a, '-PACK')} THEN abs({num(strip(_g(pt, a, '-PACK')))})
  WHEN {_m(pt, N, '-PACK')} THEN abs({num(strip(_g(pt, N, '-PACK')))})
  WHEN {_m(pt, a, 'PK')} THEN abs({num(strip(_g(pt, a, 'PK')))})
  WHEN {_m(pt, N, 'PK')} THEN abs({num(strip(_g(pt, N, 'PK')))})
  WHEN {_m(pt, N, '-PCK')} THEN abs({num(_g(pt, N, '-PCK'))})
  WHEN {_m(pt, a, '-PCK')} THEN abs({num(_g(pt, a, '-PCK'))})
  WHEN {_m(pt, N, 'PCK')} THEN abs({num(_g(pt, N, 'PCK'))})
  WHEN {_m(pt, a, 'PCK')} THEN abs({num(_g(pt, a, 'PCK'))})
  WHEN {_m(pt, N, 'PACK')} THEN abs({num(_g(pt, N, 'PACK'))})
  WHEN {_m(pt, a, 'PACK')} THEN abs({num(_g(pt, a, 'PACK'))})
  WHEN regexp_matches({pt}, '{tri}') AND regexp_matches({pt}, '[0-9]/') THEN
    (CASE WHEN len(string_split(regexp_extract({pt}, '{tri}', 0), '/')) = 3
          THEN {num(f"string_split(regexp_extract({pt}, '{tri}', 0), '/')[2]")}
          ELSE TRY_CAST(regexp_extract({pt}, '([0-9]+)/', 1) AS DOUBLE) END)
  WHEN {_m(pt, N, 'PC')} THEN abs({num(_g(pt, N, 'PC'))})
  WHEN {_m(pt, a, 'PC')} THEN abs({num(_g(pt, a, 'PC'))})
  WHEN {_m(pt, N, 'NR')} THEN abs({num(_g(pt, N, 'NR'))})
  WHEN {_m(pt, a, 'NR')} THEN abs({num(_g(pt, a, 'NR'))})
  WHEN {_m(pt, a, 'BTL')} THEN abs({num(strip(_g(pt, a, 'BTL')))})
  WHEN {pt} IN ('SINGLE', 'SNG', 'SGL', 'EA', 'KEG') THEN 1.0
END)"""


def item_case(it: str) -> str:
    """struct(size, unit) of upper-cased, fraction-rewritten text ``it``."""
    a = N + r"[^\n]"
    pad = f"(' ' || {it} || ' ')"

    def sz(v, unit):
        return f"{{'size': CAST({v} AS DOUBLE), 'unit': '{unit}'}}"

    def pair(word, unit, absolute=True):
        out = []
        for body in (N, a):
            # the matched text loses every occurrence of the word (a one-letter
            # word also takes a gap character equal to it)
            v = num(f"replace({_g(it, body, word)}, '{word}', '')")
            out.append(f"  WHEN {_m(it, body, word)} THEN {sz(f'abs({v})' if absolute else v, unit)}")
        return "\n".join(out)

    mpre = r"M+([-+]?[0-9]*\.?[0-9]+)"
    return f"""(CASE
  WHEN contains({pad}, ' PINT ') OR contains({pad}, ' PT ') THEN {sz('NULL', 'PINT')}
  WHEN contains({pad}, ' BOMBER ') OR contains({pad}, ' BOMB ') THEN {sz('NULL', 'BOMBER')}
{pair('KEG', 'KEG')}
{pair('FL OZ', 'OZ', absolute=False)}
{pair('FLOZ', 'OZ', absolute=False)}
{pair('OZ', 'OZ')}
{pair('ML', 'ML')}
{pair('LBS', 'LB')}
{pair('LB', 'LB')}
{pair('GALLON', 'GAL')}
{pair('GAL', 'GAL')}
  WHEN regexp_matches({it}, '{mpre}') THEN {sz(f"abs(TRY_CAST(regexp_extract({it}, '{mpre}', 1) AS DOUBLE))", 'ML')}
{pair('GL', 'GAL')}
{pair('G', 'GAL')}
{pair('LITER', 'L')}
{pair('LTR', 'L')}
{pair('LIT', 'L')}
{pair('LT', 'L')}
{pair('L', 'L')}
{pair('KG', 'KG')}
  WHEN contains({it}, '19.2') THEN {sz('19.2', 'OZ')}
  WHEN contains({it}, '.375') THEN {sz('375.0', 'ML')}
  WHEN contains({it}, '375') THEN {sz('375.0', 'ML')}
  WHEN contains({it}, '750') THEN {sz('750.0', 'ML')}
  WHEN contains({it}, '1.75') THEN {sz('1.75', 'L')}
  WHEN contains({it}, '1.5') THEN {sz('1.5', 'L')}
  ELSE {sz('NULL', '')}
END)"""


def container_case(ct: str) -> str:
    """Container label of ``ct`` = ' ' || upper(text) || ' '."""
    return f"""(CASE
  WHEN regexp_matches({ct}, ' TETRA|TETR') THEN 'Tetra Pak'
  WHEN contains({ct}, ' CARTO') THEN 'Carto Cans'
  WHEN contains({ct}, ' POUCH') THEN 'Pouch'
  WHEN regexp_matches({ct}, 'PKCN|PK CN|OZCN|OZ CN|SGLCN|SGL CN|PKC|PK C|PC|OZC|OZ C|SGLC|CANS|CAN|CNS|CN')
    THEN 'Aluminum Cans'
  WHEN regexp_matches({ct}, 'PKBTL|PK BTL|OZBTL|OZ BTL|SGLBTL|SGL BTL|ML BTL|MLBTL|PKB|PK B|OZB|OZ B|SGLB|BTL|BOTTLES|BOTTLE|ML B|MLB|BT|NR |LN ')
    THEN (CASE WHEN regexp_matches({ct}, ' ALUMINUM| ALUM') THEN 'Aluminum Bottles' ELSE 'Glass Bottles' END)
  WHEN regexp_matches({ct}, ' BOXED | BOX ') THEN 'Bag-in-box'
  WHEN regexp_matches({ct}, ' KEG|KEGS') THEN 'Keg'
  WHEN contains({ct}, ' JUG') THEN 'Jug'
END)"""


def pack_text(t: str) -> str:
    return f"upper(replace(coalesce({t}, ''), '/ PK', 'PK'))"


def item_text(t: str) -> str:
    x = f"upper(coalesce({t}, ''))"
    for a, b in (("1/16", ".0625"), ("1/6", ".167"), ("1/8", ".125"), ("1/4", ".25"),
                 ("1/3", ".333"), ("1/2", ".5")):
        x = f"replace({x}, '{a}', '{b}')"
    return x


def container_text(t: str) -> str:
    return f"(' ' || upper(coalesce({t}, '')) || ' ')"


def size_text(v: str) -> str:
    return (f"(CASE WHEN {v} IS NULL THEN '' WHEN {v} = floor({v}) AND abs({v}) < 1e16 "
            f"THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) ELSE CAST({v} AS VARCHAR) END)")


def blank(e: str) -> str:
    return f"regexp_matches(coalesce({e}, ''), '^\\s*$')"


def parse_ctes(src: str, d: str = "rt_brand_description",
               p: str = "rt_package_size", i: str = "rt_item_size", prefix: str = "pp") -> tuple[str, str]:
    """CTEs adding the six parsed columns to CTE ``src`` (its texts are never null).

    Returns (ctes, final_cte_name).  The rules run once over the distinct texts
    of all columns and are joined back by text.
    """
    ctes = f"""
{prefix}_texts AS MATERIALIZED (
  SELECT {d} AS t FROM {src} UNION SELECT {p} FROM {src} UNION SELECT {i} FROM {src}),
{prefix}_norm AS MATERIALIZED (
  SELECT t, {pack_text('t')} AS pt, {item_text('t')} AS it, {container_text('t')} AS ct FROM {prefix}_texts),
{prefix}_rules AS MATERIALIZED (
  SELECT t, {pack_case('pt')} AS pk, {item_case('it')} AS itm, {container_case('ct')} AS ctr FROM {prefix}_norm),
{prefix}_pick AS MATERIALIZED (
  SELECT s.*,
    coalesce(rd.pk, rp.pk, 1.0) AS package_size_num,
    CASE WHEN ri.itm.size IS NOT NULL THEN ri.itm WHEN rp.itm.size IS NOT NULL THEN rp.itm ELSE rd.itm END AS it0,
    coalesce(ri.ctr, rp.ctr, rd.ctr) AS ct0
  FROM {src} s
  JOIN {prefix}_rules rd ON rd.t = s.{d}
  JOIN {prefix}_rules rp ON rp.t = s.{p}
  JOIN {prefix}_rules ri ON ri.t = s.{i}),
{prefix}_std AS (
  SELECT *, CASE WHEN upper(it0.unit) = 'L' AND it0.size < 1.0 THEN {{'size': it0.size * 1000.0, 'unit': 'ML'}}
                 WHEN upper(it0.unit) = 'ML' AND it0.size >= 1000.0 THEN {{'size': it0.size / 1000.0, 'unit': 'L'}}
                 ELSE it0 END AS it1
  FROM {prefix}_pick),
{prefix}_sp AS (
  SELECT *,
    CASE WHEN it1.unit = 'BOMBER' THEN 22.0 WHEN it1.unit = 'PINT' THEN 16.0 ELSE it1.size END AS item_size_value,
    CASE WHEN it1.unit IN ('BOMBER', 'PINT') THEN 'OZ' ELSE it1.unit END AS item_units,
    CASE WHEN it1.unit = 'BOMBER' THEN 'Bottles' ELSE ct0 END AS ct1
  FROM {prefix}_std),
{prefix}_fill AS (
  SELECT *,
    CASE WHEN coalesce(ct1, '') <> '' THEN ct1
         WHEN item_size_value >= 500 AND item_units = 'ML' THEN 'Bottles'
         WHEN item_units = 'L' AND item_size_value < 3 THEN 'Bottles'
         WHEN item_units = 'LB' THEN 'Bag' ELSE '' END AS container_type,
    {size_text('item_size_value')} || ' ' || item_units AS item_size
  FROM {prefix}_sp),
{prefix}_out AS (
  SELECT * EXCLUDE (it0, it1, ct0, ct1),
    CASE WHEN {blank('item_size')} AND {blank('container_type')} THEN pn || ' pack'
         WHEN {blank('container_type')} THEN pn || ' pack ' || item_size
         WHEN {blank('item_size')} THEN pn || ' pack ' || container_type
         ELSE pn || ' pack ' || item_size || ' ' || container_type END AS package_configuration
  FROM (SELECT *, CAST(CAST(trunc(package_size_num) AS BIGINT) AS VARCHAR) AS pn FROM {prefix}_fill))"""
    return ctes, f"{prefix}_out"


PARSED = ["package_size_num", "item_size_value", "item_units", "container_type", "item_size",
          "package_configuration"]
CANON = ["rt_product_id", "rt_upc_code", "rt_brand_name", "rt_brand_description", "rt_product_type",
         "rt_product_category", "rt_package_size", "rt_item_size", "price_regular", "price_sale",
         "qty_on_hand", "wholesale_package_size", "rt_wholesale_qty"]


# ---------------------------------------------------------------------------
# Derived feeds (the fixture SQL, with retailer and file-order columns added)
# ---------------------------------------------------------------------------

F1 = """f1 AS (
select cast(p_partkey % 10 + 1 as varchar) as retailer_id, p_partkey as _ord,
 case when p_partkey % 89 = 0 then '' else cast(p_partkey as varchar) end as product_id,
 concat('0', cast(p_partkey * 7919 as varchar), case when p_partkey % 10 = 0 then '.0' else '' end) as upc_code,
 p_brand as brand_name,
 concat(p_name, ' ', case p_partkey % 12 when 0 then '6 PK 12 OZ CANS' when 1 then '12/ PK BTL' when 2 then '750 ML'
  when 3 then '1.75L' when 4 then '1/2 KEG' when 5 then '24-PACK 12OZ BOTTLE' when 6 then 'BOMBER' when 7 then 'PINT'
  when 8 then '2/12/16 OZ' when 9 then '5KG' when 10 then '6-12PK' else 'SINGLE' end) as brand_description,
 p_type as product_type, cast(p_size as varchar) as product_category,
 case when p_partkey % 5 = 0 then null else concat(cast(p_size as varchar), ' pk') end as package_size,
 case when p_partkey % 17 = 0 then '0' when p_partkey % 19 = 0 then 'n/a'
  else cast(p_retailprice as varchar) end as price_regular,
 case when p_partkey % 3 = 0 then cast(p_retailprice * 0.5 as varchar) else '' end as sale_price,
 cast(p_size * 3 as varchar) as qty_on_hand,
 cast(case when p_partkey % 23 = 0 then 0 else p_size end as varchar) as casepk
from part)"""


def finish_ctes(src: str, name: str) -> tuple[str, str]:
    """Shared adapter tail: id clean, zero-price filter, first row per
    (retailer, product) in file order, casts.  ``src`` has the 13 canonical
    columns plus retailer_id and _ord."""
    canon_cast = ",\n    ".join(
        f"coalesce({num_exp(c)}, 0.0) AS {c}" if c in ("price_regular", "price_sale", "qty_on_hand")
        else (f"replace(coalesce(CAST({c} AS VARCHAR), ''), '.0', '') AS {c}" if c == "rt_upc_code"
              else f"coalesce(CAST({c} AS VARCHAR), '') AS {c}")
        for c in CANON)
    ctes = f"""
{name}_id AS (
  SELECT * REPLACE (replace(CAST(rt_product_id AS VARCHAR), '.0', '') AS rt_product_id) FROM {src}),
{name}_z AS (
  SELECT * FROM {name}_id
  WHERE rt_product_id IS NOT NULL AND rt_product_id <> ''
    AND NOT coalesce({num_exp('price_regular')} = 0, false)),
{name}_d AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id, rt_product_id ORDER BY _ord) AS _rn
                 FROM {name}_z) WHERE _rn = 1),
{name} AS (
  SELECT CAST(retailer_id AS VARCHAR) AS retailer_id,
    {canon_cast}
  FROM {name}_d)"""
    return ctes, name


def mpower_ctes(src: str, name: str, casepk: bool = True) -> str:
    """Base (MPower) adapter over a base-format feed CTE."""
    q, w = num_exp("qty_on_hand"), num_exp("casepk")
    whl = (f"""CASE WHEN {w} IS NOT NULL THEN CAST(CAST(trunc({w}) AS BIGINT) AS VARCHAR) || ' Pack' ELSE '' END
      AS wholesale_package_size,
    coalesce({float_text(f"(CASE WHEN {w} = 0 THEN NULL ELSE {q} / {w} END)")}, '') AS rt_wholesale_qty"""
           if casepk else "'' AS wholesale_package_size, '' AS rt_wholesale_qty")
    body = f"""
{name}_m AS (
  SELECT retailer_id, _ord, product_id AS rt_product_id, upc_code AS rt_upc_code, brand_name AS rt_brand_name,
    brand_description AS rt_brand_description, product_type AS rt_product_type,
    product_category AS rt_product_category, package_size AS rt_package_size, '' AS rt_item_size,
    price_regular, sale_price AS price_sale, qty_on_hand,
    {whl}
  FROM {src}),"""
    fin, _ = finish_ctes(f"{name}_m", name)
    return body + fin


def with_clause(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts if p.strip())


F8 = """f8 AS (
select cast(l_suppkey as varchar) as retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) as _ord, l_orderkey * 8 + l_linenumber as _line,
 cast(l_partkey as varchar) as product_id,
 cast(l_orderkey * 10 + l_linenumber as varchar) as upc_code,
 p_brand as brand_name,
 concat(p_name, ' ', case (l_orderkey + l_linenumber) % 16
   when 0 then q || ' PK ' || sz || ' OZ CANS'
   when 1 then q || '/ PK BTL'
   when 2 then sz || '0 ML'
   when 3 then '1.' || n || 'L'
   when 4 then '1/' || n || ' KEG'
   when 5 then q || '-PACK ' || sz || 'OZ BOTTLE'
   when 6 then 'BOMBER'
   when 7 then 'PINT ' || sz
   when 8 then n || '/' || q || '/' || sz || ' OZ'
   when 9 then sz || 'KG'
   when 10 then n || '-' || q || 'PK'
   when 11 then q || 'PCK ' || n || ' GAL'
   when 12 then sz || ' LTR TETRA'
   when 13 then q || ' PC ' || sz || 'FL OZ POUCH'
   when 14 then sz || ' GAL BOX '
   else 'M' || sz || ' JUG ALUM BTL' end) as brand_description,
 p_type as product_type, cast(p_size as varchar) as product_category,
 n || ' pk' as package_size,
 cast(l_extendedprice as varchar) as price_regular,
 case when l_tax > 0.04 then cast(l_extendedprice * 0.5 as varchar) else '' end as sale_price,
 q as qty_on_hand
from (select *, cast(cast(trunc(l_quantity) as bigint) as varchar) as q, cast(p_size as varchar) as sz,
             cast(l_linenumber as varchar) as n
      from lineitem join part on l_partkey = p_partkey))"""


F2 = """f2_inv AS (
select distinct cast(l_suppkey as varchar) as retailer_id, cast(p_partkey as varchar) as sku, p_name as name,
 concat(cast(p_size as varchar), ' OZ') as sname, p_size as pack, p_type as typename
from lineitem join part on l_partkey = p_partkey),
f2_prc AS (
select cast(l_suppkey as varchar) as retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) as _ord, l_orderkey * 8 + l_linenumber as _line,
 cast(l_partkey as varchar) as sku, l_quantity as qty,
 l_extendedprice as price, case when l_discount > 0.05 then l_extendedprice * 0.5 else 0.0 end as sale,
 case when l_returnflag = 'R' then 'T' else 'F' end as onsale, cast(l_linenumber as varchar) as level, l_shipdate as tstamp
from lineitem),
f2_stk AS (
select cast(l_suppkey as varchar) as retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) as _ord, l_orderkey * 8 + l_linenumber as _line,
 case when l_linestatus = 'O' then cast(l_partkey as varchar) else 'x' || cast(l_partkey as varchar) end as sku,
 l_quantity as back, l_shipdate as tstamp
from lineitem),
f2_upc AS (
select cast(l_suppkey as varchar) as retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) as _ord, l_orderkey * 8 + l_linenumber as _line,
 cast(l_partkey as varchar) as sku,
 case when l_orderkey % 11 = 0 then null else cast(l_orderkey * 10 + l_linenumber as varchar) end as upc,
 case when l_orderkey % 13 = 0 then null else l_shipdate end as tstamp
from lineitem)"""


def latest_sql(src: str, ts: str = "tstamp") -> str:
    """Rows of ``src`` with the newest ``ts`` per (retailer_id, sku)."""
    return (f"(SELECT * EXCLUDE (_mt) FROM (SELECT *, max({ts}) OVER (PARTITION BY retailer_id, sku) AS _mt "
            f"FROM {src}) WHERE {ts} = _mt)")


def maxqty_latest_sql(src: str) -> str:
    """Max qty per (retailer_id, sku), then the newest among those."""
    q = (f"(SELECT * EXCLUDE (_mq) FROM (SELECT *, max(qty) OVER (PARTITION BY retailer_id, sku) AS _mq "
         f"FROM {src} WHERE qty IS NOT NULL) WHERE qty = _mq)")
    return latest_sql(q)


def spirit_members(level: str, max_qty: bool) -> str:
    prc = f"(SELECT * FROM f2_prc WHERE level = '{level}')"
    prc = maxqty_latest_sql(prc) if max_qty else latest_sql(prc)
    return f"""sp_inv AS (SELECT retailer_id, sku, name, sname, pack, typename FROM f2_inv),
sp_prc AS (SELECT retailer_id, sku, qty, price, sale, onsale, level, _ord AS _ord_prc FROM {prc}),
sp_stk AS (SELECT retailer_id, sku, back, _ord AS _ord_back FROM {latest_sql('f2_stk')}),
sp_upc AS (SELECT retailer_id, sku, upc, _ord AS _ord_upc FROM {latest_sql('f2_upc')})"""


SPIRIT_ANCHOR = """sp_cnt AS (
  SELECT retailer_id, 'inv' AS member, 0 AS prio, count(*) AS n FROM sp_inv GROUP BY retailer_id
  UNION ALL SELECT retailer_id, 'prc', 1, count(*) FROM sp_prc GROUP BY retailer_id
  UNION ALL SELECT retailer_id, 'stk', 2, count(*) FROM sp_stk GROUP BY retailer_id
  UNION ALL SELECT retailer_id, 'upc', 3, count(*) FROM sp_upc GROUP BY retailer_id),
sp_anc AS (SELECT retailer_id, arg_max(member, n * 10 - prio) AS anchor FROM sp_cnt GROUP BY retailer_id),
sp_full AS (
  SELECT * FROM (SELECT *, true AS _in_inv FROM sp_inv)
  FULL OUTER JOIN (SELECT *, true AS _in_prc FROM sp_prc) USING (retailer_id, sku)
  FULL OUTER JOIN (SELECT *, true AS _in_stk FROM sp_stk) USING (retailer_id, sku)
  FULL OUTER JOIN (SELECT *, true AS _in_upc FROM sp_upc) USING (retailer_id, sku)),
sp_join AS (
  SELECT sp_full.* EXCLUDE (_in_inv, _in_prc, _in_stk, _in_upc) FROM sp_full JOIN sp_anc USING (retailer_id)
  WHERE (anchor = 'inv' AND _in_inv) OR (anchor = 'prc' AND _in_prc)
     OR (anchor = 'stk' AND _in_stk) OR (anchor = 'upc' AND _in_upc))"""

SPIRIT_INNER = """sp_join AS (
  SELECT * FROM sp_inv JOIN sp_prc USING (retailer_id, sku) JOIN sp_stk USING (retailer_id, sku)
  JOIN sp_upc USING (retailer_id, sku))"""

SPIRIT_DEDUP = """sp_dedup AS (
  SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY retailer_id, sku ORDER BY
    upc IS NULL, TRY_CAST(upc AS DOUBLE) NULLS FIRST, upc NULLS FIRST, _ord_upc NULLS FIRST,
    _ord_prc NULLS FIRST, _ord_back NULLS FIRST) AS _rn FROM sp_join) WHERE _rn = 1)"""


def spirit_sql(kind: str) -> str:
    """spirit2000 adapters: 'csv' (anchor-left, back/qty, pack), 'dbf'
    (inner, back), 'tower' (level 7, newest only, inner, back/qty)."""
    if kind == "tower":
        members, join = spirit_members("7", max_qty=False), SPIRIT_INNER
    elif kind == "dbf":
        members, join = spirit_members("1", max_qty=True), SPIRIT_INNER
    else:
        members, join = spirit_members("1", max_qty=True), SPIRIT_ANCHOR
    qoh = "back" if kind == "dbf" else "(CASE WHEN qty = 0 THEN NULL ELSE back / qty END)"
    whl = "coalesce(CAST(pack AS VARCHAR), '') || ' pack'" if kind == "csv" else "''"
    canon = f"""sp_canon AS (
  SELECT retailer_id, 0 AS _ord, sku AS rt_product_id, upc AS rt_upc_code, '' AS rt_brand_name,
    name AS rt_brand_description, typename AS rt_product_type, '' AS rt_product_category,
    coalesce(CAST(qty AS VARCHAR), '') || ' pack' AS rt_package_size, sname AS rt_item_size,
    CAST(price AS VARCHAR) AS price_regular, CAST(sale AS VARCHAR) AS price_sale,
    CAST({qoh} AS VARCHAR) AS qty_on_hand, {whl} AS wholesale_package_size, '' AS rt_wholesale_qty
  FROM sp_dedup)"""
    fin, name = finish_ctes("sp_canon", "sp")
    return with_clause(F2, members, join, SPIRIT_DEDUP, canon, fin) + f"\nSELECT * FROM {name}"


F6 = """f6 AS (
select cast(l_suppkey as varchar) as retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) as _ord, l_orderkey * 8 + l_linenumber as _line,
 cast(l_partkey as varchar) as id, l_orderkey, l_linenumber,
 case when l_orderkey % 7 = 0 then null when l_orderkey % 5 = 0 then cast(l_partkey as varchar)
  else cast(l_orderkey as varchar) end as upcitemid,
 l_linenumber % 4 as sizecaseqty, cast(l_linenumber as varchar) as unitspercase,
 'ITEM ' || cast(l_partkey as varchar) as description, cast(l_extendedprice as varchar) as price,
 cast(l_quantity as varchar) as onhand, cast(l_suppkey % 7 as varchar) as salesdepartmentid,
 case when l_linenumber = 7 then 'LARGE' else cast(l_quantity * 0.05 as varchar) end as description_2
from lineitem)"""


def wholesale_label_sql(u: str) -> str:
    n = num(f"CAST({u} AS VARCHAR)")
    return (f"(CASE WHEN regexp_matches(split_part(CAST({u} AS VARCHAR), '.', 1), '^[0-9]+$') AND {n} IS NOT NULL "
            f"THEN CAST(CAST(trunc({n}) AS BIGINT) AS VARCHAR) || ' Pack' ELSE '' END)")


def size_oz_sql(x: str) -> str:
    n = num_exp(x)
    return (f"(CASE WHEN {n} IS NULL THEN {x} WHEN {n} > 1 THEN {float_text(f'round_even({n}, 2)')} || 'oz' "
            f"ELSE NULL END)")


def kmds_sql() -> str:
    cq = num_exp("CAST(sizecaseqty AS VARCHAR)")
    body = f"""k0 AS (SELECT *, CASE WHEN id = upcitemid THEN '-1' ELSE upcitemid END AS up FROM f6),
k1 AS (SELECT * EXCLUDE (_ml) FROM (SELECT *, max(length(up)) OVER (PARTITION BY retailer_id, id) AS _ml
       FROM k0 WHERE up IS NOT NULL) WHERE length(up) = _ml),
k2 AS (SELECT retailer_id, _ord, id AS rt_product_id, up AS rt_upc_code, '' AS rt_brand_name,
    description AS rt_brand_description, '' AS rt_product_type, salesdepartmentid AS rt_product_category,
    '' AS rt_package_size, {size_oz_sql('description_2')} AS rt_item_size, price AS price_regular,
    0.0 AS price_sale, onhand AS qty_on_hand,
    CASE WHEN {cq} > 1 THEN CAST(CAST(trunc({cq}) AS BIGINT) AS VARCHAR) || ' Pack'
         ELSE {wholesale_label_sql('unitspercase')} END AS wholesale_package_size, '' AS rt_wholesale_qty
  FROM k1)"""
    fin, name = finish_ctes("k2", "km")
    return with_clause(F6, body, fin) + f"\nSELECT * FROM {name}"


F3 = """f3_items AS (
select cast(p_partkey % 12 as varchar) as retailer_id, p_partkey as _ord, cast(p_partkey as varchar) as sku, p_name as itemname,
 p_brand as description, cast(p_size % 7 as varchar) as packid, cast(p_size % 30 as varchar) as sizeid,
 cast(p_size % 6 as varchar) as catid, p_retailprice as priceperunit,
 cast(p_partkey * 13 as varchar) as mainupc, cast(p_size * 2 as varchar) as instoreqty
from part),
f3_pack AS (select cast(r as varchar) as retailer_id, cast(r_regionkey as varchar) as packid,
 concat(cast(r_regionkey * 6 + r as varchar), ' PK,', r_name) as packname from region, range(12) t(r)),
f3_size AS (select cast(r as varchar) as retailer_id, cast(n_nationkey as varchar) as sizeid,
 concat(cast(n_nationkey * 50 + r as varchar), ' ML') as sizename from nation, range(12) t(r))"""


def dept_sql(x: str, beer: int, liquor: int, wine: int) -> str:
    n = num(f"CAST({x} AS VARCHAR)")
    return (f"(CASE WHEN {n} = {beer} THEN 'BEER' WHEN {n} = {liquor} THEN 'LIQUOR' "
            f"WHEN {n} = {wine} THEN 'WINE' ELSE 'EXTRAS' END)")


def advent_sql() -> str:
    body = f"""a0 AS (SELECT * FROM f3_items LEFT JOIN f3_pack USING (retailer_id, packid) LEFT JOIN f3_size USING (retailer_id, sizeid)),
a1 AS (SELECT retailer_id, _ord, sku AS rt_product_id, mainupc AS rt_upc_code, itemname AS rt_brand_name,
    coalesce(itemname, '') || ' ' || coalesce(description, '') AS rt_brand_description,
    {dept_sql('catid', 5, 1, 2)} AS rt_product_type, {dept_sql('catid', 5, 1, 2)} AS rt_product_category,
    split_part(packname, ',', 1) AS rt_package_size, sizename AS rt_item_size,
    CAST(priceperunit AS VARCHAR) AS price_regular, 0.0 AS price_sale, instoreqty AS qty_on_hand,
    '' AS wholesale_package_size, '' AS rt_wholesale_qty
  FROM a0)"""
    fin, name = finish_ctes("a1", "ad")
    return with_clause(F3, body, fin) + f"\nSELECT * FROM {name}"


F4 = """f4_registry AS (
select s_suppkey as id, case s_suppkey % 4 when 0 then 'MPower' when 1 then 'spirit2000_csv' when 2 then 'AdventPOS' else 'unknown' end as pos,
 s_name as name, concat(lower(replace(s_name, '#', '_')), '.csv') as filename, cast(s_nationkey as varchar) as shopid,
 case when s_suppkey % 3 = 0 then null else 'x' end as refreshtoken
from supplier),
f4_incoming AS (
select s_suppkey as _ord,
 case when s_suppkey % 5 = 0 then 'missing_' || cast(s_suppkey as varchar) || '.csv'
      when s_suppkey % 7 = 0 then replace(concat(lower(replace(s_name, '#', '_')), '.csv'), '.csv', '.xlsx')
      when s_suppkey % 2 = 0 then upper(concat(lower(replace(s_name, '#', '_')), '.csv'))
      else concat(lower(replace(s_name, '#', '_')), '.csv') end as _file_name
from supplier)"""

F5 = """f5 AS (
select l_orderkey, l_linenumber, case when l_discount < 0.03 then 0.0 else l_extendedprice end as pack_price,
 l_extendedprice / l_quantity as unit_price, case when l_tax < 0.02 then 0.0 else l_extendedprice * 0.5 end as pack_sale,
 l_extendedprice * 0.25 as unit_sale, l_shipdate as sale_start, l_shipdate + interval '30' day as sale_end
from lineitem)"""
AS_OF = "1997-06-01 00:00:00"


LINES_PARTS = "lineitem JOIN part ON l_partkey = p_partkey"


def winepos_sql() -> str:
    body = f"""wp_raw AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) AS _ord, l_orderkey * 8 + l_linenumber AS _line,
    CAST(l_partkey AS VARCHAR) AS c0, p_name AS c1, CAST(p_size AS VARCHAR) || ' OZ' AS c4,
    CAST(l_linenumber AS VARCHAR) || '.0' AS c6, l_extendedprice / l_quantity AS unit,
    CASE WHEN l_discount < 0.03 THEN 0.0 ELSE l_extendedprice END AS pack, l_linenumber % 4 AS pkg,
    l_quantity AS qty, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS c12, p_type AS c14, p_brand AS c15,
    l_extendedprice * 0.25 AS usale, CASE WHEN l_tax < 0.02 THEN 0.0 ELSE l_extendedprice * 0.5 END AS psale,
    date_trunc('day', l_shipdate) AS st, date_trunc('day', l_shipdate + INTERVAL 30 DAY) AS en
  FROM {LINES_PARTS}),
wp_canon AS (
  SELECT retailer_id, _ord, c0 AS rt_product_id, c12 AS rt_upc_code, '' AS rt_brand_name, c1 AS rt_brand_description,
    c14 AS rt_product_type, c15 AS rt_product_category, CAST(pkg AS VARCHAR) || ' Pack' AS rt_package_size,
    c4 AS rt_item_size,
    CAST(CASE WHEN pack > 0 THEN pack ELSE unit END AS VARCHAR) AS price_regular,
    CAST(CASE WHEN TIMESTAMP '{AS_OF}' BETWEEN st AND en THEN
      (CASE WHEN psale > 0 THEN psale WHEN usale > 0 THEN usale ELSE 0.0 END) ELSE 0.0 END AS VARCHAR) AS price_sale,
    CAST(CASE WHEN pkg = 0 THEN NULL ELSE qty / pkg END AS VARCHAR) AS qty_on_hand,
    replace(c6, '.0', '') || ' Pack' AS wholesale_package_size, '' AS rt_wholesale_qty
  FROM wp_raw)"""
    fin, name = finish_ctes("wp_canon", "wp")
    return with_clause(body, fin) + f"\nSELECT * FROM {name}"


def cre_sql() -> str:
    body = f"""cre_canon AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) AS _ord, l_orderkey * 8 + l_linenumber AS _line,
    replace(CAST(l_partkey AS VARCHAR) || '-0', '-', '') AS rt_product_id,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS rt_upc_code, '' AS rt_brand_name,
    p_name AS rt_brand_description, p_type AS rt_product_type, p_brand AS rt_product_category,
    CAST(p_size AS VARCHAR) || ' PK' AS rt_package_size, '' AS rt_item_size,
    CAST(l_extendedprice AS VARCHAR) AS price_regular,
    CAST(CASE WHEN l_tax > 0.04 THEN l_extendedprice * 0.5 ELSE 0.0 END AS VARCHAR) AS price_sale,
    CAST(l_quantity AS VARCHAR) AS qty_on_hand, '' AS wholesale_package_size, '' AS rt_wholesale_qty
  FROM {LINES_PARTS})"""
    fin, name = finish_ctes("cre_canon", "cre")
    return with_clause(body, fin) + f"\nSELECT * FROM {name}"


def spirit_xml_sql() -> str:
    body = f"""sx_canon AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) AS _ord, l_orderkey * 8 + l_linenumber AS _line,
    CAST(l_partkey AS VARCHAR) AS rt_product_id, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS rt_upc_code,
    '' AS rt_brand_name, p_name AS rt_brand_description, p_type AS rt_product_type, p_brand AS rt_product_category,
    '' AS rt_package_size, CAST(p_size AS VARCHAR) || ' OZ' AS rt_item_size,
    CAST(l_extendedprice AS VARCHAR) AS price_regular,
    CAST(CASE WHEN l_returnflag = 'R' AND l_extendedprice * 0.5 > 0 THEN l_extendedprice * 0.5 ELSE 0.0 END AS VARCHAR)
      AS price_sale,
    CAST(l_quantity AS VARCHAR) AS qty_on_hand, CAST(l_linenumber AS VARCHAR) || ' pack' AS wholesale_package_size,
    '' AS rt_wholesale_qty
  FROM {LINES_PARTS})"""
    fin, name = finish_ctes("sx_canon", "sx")
    return with_clause(body, fin) + f"\nSELECT * FROM {name}"


MPOWER_API_FLAT = """mpa_flat AS (
  SELECT CAST(o_custkey % 10 AS VARCHAR) AS retailer_id, o_orderkey, l_linenumber,
    CAST(o_orderkey % 5000 AS VARCHAR) AS product_id,
    coalesce(CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderkey * 7 AS VARCHAR) END,
             CAST(l_linenumber AS VARCHAR), '') AS upc_code,
    NULL AS brand_name, o_orderpriority AS brand_description, 'SPIRITS' AS product_type,
    o_orderpriority AS product_category,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 12 + 1 AS DOUBLE) END AS cq,
    o_totalprice, l_extendedprice, l_quantity
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey),
mpa AS (
  SELECT retailer_id, row_number() OVER (ORDER BY o_orderkey, CAST(l_linenumber AS VARCHAR) NULLS FIRST,
                                         l_extendedprice NULLS FIRST, l_quantity NULLS FIRST) AS _ord,
    product_id, upc_code, brand_name, brand_description, product_type, product_category,
    NULL AS package_size_unused,
    CAST(coalesce(l_extendedprice, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice / 100 END,
                  CASE WHEN cq = 0 THEN NULL ELSE (o_totalprice / 10) / cq END) AS VARCHAR) AS price_regular,
    CAST(CASE WHEN l_quantity IS NOT NULL THEN (CASE WHEN l_quantity = 0 THEN NULL
         ELSE (o_orderkey % 40) / l_quantity END) ELSE CAST(o_orderkey % 40 AS DOUBLE) END AS VARCHAR) AS qty_on_hand,
    CASE WHEN l_quantity IS NOT NULL THEN CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) || ' Pack '
         || CAST(o_orderkey % 30 AS VARCHAR) || ' OZ' ELSE CAST(o_orderkey % 30 AS VARCHAR) || ' OZ' END AS package_size,
    '' AS sale_price, CAST(cq AS VARCHAR) AS casepk
  FROM mpa_flat)"""


def mpower_api_sql() -> str:
    return with_clause(MPOWER_API_FLAT, mpower_ctes("mpa", "mp")) + "\nSELECT * FROM mp"


LP = f"""lp AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS retailer_id, struct_pack(o := l_orderkey, n := l_linenumber, p := l_partkey, s := l_suppkey, e := l_extendedprice, q := l_quantity) AS _ord, l_orderkey * 8 + l_linenumber AS _line,
    CAST(l_partkey AS VARCHAR) AS id, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS upc,
    p_brand AS brand, p_name AS descr, p_type AS typ, p_brand AS cat, CAST(l_linenumber AS VARCHAR) || ' pk' AS pkg,
    CAST(p_size AS VARCHAR) || ' OZ' AS size, CAST(l_extendedprice AS VARCHAR) AS price,
    CASE WHEN l_tax > 0.04 THEN CAST(l_extendedprice * 0.5 AS VARCHAR) ELSE '' END AS sale,
    CAST(l_quantity AS VARCHAR) AS qty, l_linenumber AS ln, l_shipdate AS ship, l_extendedprice AS ext,
    p_partkey AS pk, p_size AS psize, p_retailprice AS pprice
  FROM {LINES_PARTS})"""


def simple_pos_sql(pos: str) -> str:
    """Canonical rows of the simple POS exports (one SELECT over ``lp``)."""
    e = {"rt_product_id": "id", "rt_upc_code": "upc", "rt_brand_name": "''", "rt_brand_description": "descr",
         "rt_product_type": "''", "rt_product_category": "''", "rt_package_size": "''", "rt_item_size": "''",
         "price_regular": "price", "price_sale": "'0'", "qty_on_hand": "qty", "wholesale_package_size": "''",
         "rt_wholesale_qty": "''"}
    if pos == "tiger":
        e.update(rt_brand_name="brand", rt_product_type=dept_sql("(CAST(ln % 5 AS VARCHAR) || '.0')", 3, 2, 4),
                 rt_product_category="cat", rt_package_size="pkg", price_sale="sale")
    elif pos == "fastraxpos":
        e.update(rt_product_type="typ", rt_product_category="cat", rt_package_size="pkg", rt_item_size="size")
    elif pos == "ptech":
        e.update(rt_upc_code="regexp_replace('U-' || upc, '[^0-9]', '', 'g')", rt_product_type="typ")
    elif pos == "lajoypos":
        e.update(rt_upc_code="regexp_replace('U-' || upc, '[^0-9]', '', 'g')", rt_brand_name="brand",
                 rt_product_type="typ", rt_product_category="cat", rt_package_size="pkg", rt_item_size="size",
                 price_sale="sale", wholesale_package_size="CAST(ln AS VARCHAR) || ' Pack'")
    elif pos == "cobaltconnect":
        e.update(rt_item_size="size")
    elif pos == "businessmasterespanol":
        sale = f"(CASE WHEN ln % 2 = 0 THEN {num('price')} ELSE ext * 0.9 END)"
        e.update(rt_product_id="id || ' - ' || CAST(ln AS VARCHAR)", rt_upc_code="id",
                 rt_package_size="CAST(ln AS VARCHAR) || ' Pack'", rt_product_type="typ",
                 price_sale=(f"CAST(CASE WHEN TIMESTAMP '{AS_OF}' BETWEEN date_trunc('day', ship) AND "
                             f"date_trunc('day', ship + INTERVAL 30 DAY) AND {num('price')} <> {sale} "
                             f"THEN {sale} ELSE 0.0 END AS VARCHAR)"))
    elif pos == "lightspeed":
        e.update(rt_product_type="typ", rt_product_category="cat")
    elif pos == "square":
        e.update(rt_product_type="typ", rt_product_category="cat", rt_package_size="pkg",
                 price_regular="CAST(CAST(CAST(trunc(ext * 100) AS BIGINT) AS DOUBLE) / 100.0 AS VARCHAR)")
    else:
        raise ValueError(pos)
    sel = ",\n    ".join(f"{v} AS {k}" for k, v in e.items())
    body = f"""{pos}_canon AS (
  SELECT retailer_id, _ord,
    {sel}
  FROM lp)"""
    fin, name = finish_ctes(f"{pos}_canon", f"{pos}_fin")
    return with_clause(LP, body, fin) + f"\nSELECT * FROM {name}"


LIQ = """lq_bar AS (SELECT retailer_id, _ord, CASE WHEN pk % 9 = 0 THEN 'X' || CAST(pk AS VARCHAR) ELSE CAST(pk AS VARCHAR) END
                       AS code_num, upc AS barcode FROM lp),
lq_liq AS (SELECT DISTINCT retailer_id, pk AS _ord_liq,
    CASE WHEN pk % 9 = 0 THEN 'X' || CAST(pk AS VARCHAR) ELSE CAST(pk AS VARCHAR) END AS code_num,
    brand, descr AS descrip, typ AS typenam, CAST(psize AS VARCHAR) || ' pk' AS size, CAST(pprice AS VARCHAR) AS price,
    CAST(psize * 3 AS VARCHAR) AS qty_on_hnd, CAST(psize % 12 AS VARCHAR) || '.0' AS qty_case FROM lp),
lq_join AS (SELECT * FROM lq_bar JOIN lq_liq USING (retailer_id, code_num))"""


def liquorpos_sql(digits_only: bool) -> str:
    where = "WHERE regexp_matches(code_num, '^[0-9]+$')" if digits_only else ""
    body = f"""lq_canon AS (
  SELECT retailer_id, _ord, code_num AS rt_product_id, barcode AS rt_upc_code, brand AS rt_brand_name,
    coalesce(brand, '') || ' ' || coalesce(descrip, '') AS rt_brand_description, typenam AS rt_product_type,
    typenam AS rt_product_category, size AS rt_package_size, '' AS rt_item_size, price AS price_regular,
    '0' AS price_sale, qty_on_hnd AS qty_on_hand, replace(qty_case, '.0', '') || ' Pack' AS wholesale_package_size,
    '' AS rt_wholesale_qty
  FROM lq_join {where})"""
    fin, name = finish_ctes("lq_canon", "lq")
    return with_clause(LP, LIQ, body, fin) + f"\nSELECT * FROM {name}"


LIGHTSPEED = """ls_items AS (
  SELECT p_partkey, CAST(p_partkey % 11 AS VARCHAR) AS retailer_id, CAST(p_partkey AS VARCHAR) AS itemID,
    CAST(p_partkey * 3 AS VARCHAR) AS systemSku, CAST(p_partkey * 7919 AS VARCHAR) AS upc, p_name AS description,
    CAST(p_size % 10 AS VARCHAR) AS categoryID,
    CASE WHEN p_partkey % 11 % 2 = 0 THEN CAST(p_retailprice AS VARCHAR) ELSE CAST(p_retailprice * 0.5 AS VARCHAR) END AS amount,
    CASE WHEN p_partkey % 11 % 2 = 0 THEN CAST(p_size * 2 AS VARCHAR) ELSE CAST(p_size AS VARCHAR) END AS qoh FROM part),
ls_cat AS (SELECT CAST(r AS VARCHAR) AS retailer_id,
    CASE WHEN n_nationkey < 8 THEN CAST(n_nationkey AS VARCHAR) ELSE 'x' || CAST(n_nationkey AS VARCHAR) END AS categoryID,
    n_name || '-' || CAST(r AS VARCHAR) AS name, 'Spirits/' || n_name || '-' || CAST(r AS VARCHAR) AS fullPathName
  FROM nation, range(11) t(r)),
ls_rows AS (SELECT * FROM ls_items LEFT JOIN ls_cat USING (retailer_id, categoryID))"""


def lightspeed_sql() -> str:
    body = """ls_canon AS (
  SELECT retailer_id, p_partkey AS _ord, systemSku AS rt_product_id, upc AS rt_upc_code, '' AS rt_brand_name,
    description AS rt_brand_description, fullPathName AS rt_product_type, name AS rt_product_category,
    '' AS rt_package_size, '' AS rt_item_size, amount AS price_regular, '0' AS price_sale, qoh AS qty_on_hand,
    '' AS wholesale_package_size, '' AS rt_wholesale_qty FROM ls_rows)"""
    fin, name = finish_ctes("ls_canon", "ls")
    return with_clause(LIGHTSPEED, body, fin) + f"\nSELECT * FROM {name}"


SQUARE = """sq_var AS (
  SELECT 'V' || CAST(p_partkey // 13 AS VARCHAR) AS vid, p_partkey, 1 AS m FROM part
  UNION ALL SELECT 'W' || CAST(p_partkey // 13 AS VARCHAR), p_partkey, 2 FROM part WHERE (p_partkey // 13) % 3 = 0),
sq_rows AS (
  SELECT CAST(p.p_partkey % 13 AS VARCHAR) AS retailer_id, v.vid AS item_variation_object_id,
    CAST(p.p_partkey * 11 AS VARCHAR) AS sku, CAST(p.p_size * v.m AS VARCHAR) || ' pk' AS vname,
    CAST(trunc(p.p_retailprice * 100 * v.m) AS BIGINT) AS amount, p.p_name AS iname, p.p_type AS ptype,
    n.n_name || '-' || CAST(p.p_partkey % 13 AS VARCHAR) AS cname, CAST(p.p_partkey // 13 AS VARCHAR) AS quantity, p.p_partkey
  FROM sq_var v JOIN part p ON p.p_partkey = v.p_partkey
  JOIN nation n ON n.n_nationkey < 6 AND n.n_nationkey = p.p_size % 8
  WHERE (CASE WHEN (p.p_partkey // 13) % 4 = 0 THEN 2 ELSE 1 END) = p.p_partkey % 13 % 2 + 1
    AND (p.p_partkey // 13) % 5 <> 0)"""


def square_sql() -> str:
    body = """sq_canon AS (
  SELECT retailer_id, p_partkey AS _ord, item_variation_object_id AS rt_product_id,
    sku AS rt_upc_code, '' AS rt_brand_name, iname AS rt_brand_description, ptype AS rt_product_type,
    cname AS rt_product_category, vname AS rt_package_size, '' AS rt_item_size,
    CAST(amount / 100.0 AS VARCHAR) AS price_regular, '0' AS price_sale, quantity AS qty_on_hand,
    '' AS wholesale_package_size, '' AS rt_wholesale_qty FROM sq_rows)"""
    fin, name = finish_ctes("sq_canon", "sq")
    return with_clause(SQUARE, body, fin) + f"\nSELECT * FROM {name}"
