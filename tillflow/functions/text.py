"""Scalar column builders shared by the feed adapters.

Each function takes and returns ``Column`` objects; nothing here runs Python
per row.  Text inputs are the raw strings of a feed (all feeds are read as
strings and cast once, see ``strict_double``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's float() and str.isspace() treat as blank, as a regex class.
WS_CLASS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# plain decimal number, optionally padded with blanks
_DECIMAL = r"^" + WS_CLASS + r"*([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+))" + WS_CLASS + r"*$"
# the same with an optional exponent (numeric feed columns allow it)
_DECIMAL_EXP = (r"^" + WS_CLASS + r"*([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"
                + WS_CLASS + r"*$")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_double(c, exponent: bool = False) -> Column:
    """Text -> double only for well-formed decimal text, else null.

    Spark's own cast accepts '12D', '6F' and 'NaN'; a number parsed from a
    feed must not: what the pattern does not find is '', which casts to null.
    """
    pat = _DECIMAL_EXP if exponent else _DECIMAL
    return F.regexp_extract(col_(c), pat, 1).try_cast("double")


def numeric_or_zero(c) -> Column:
    """Numeric feed column: parse, anything unparsable or missing -> 0.0."""
    return F.coalesce(strict_double(col_(c).cast("string"), exponent=True), F.lit(0.0))


def blank_if_null(c) -> Column:
    return F.coalesce(col_(c).cast("string"), F.lit(""))


def is_blank(c) -> Column:
    """True for '' or whitespace-only text (null counts as blank)."""
    c = col_(c)
    return F.coalesce(c.rlike("^" + WS_CLASS + "*$"), F.lit(True))


def strip_dot_zero(c) -> Column:
    """Delete every literal '.0' (parity form: also inside, '12.05' -> '125')."""
    return F.replace(col_(c), F.lit(".0"), F.lit(""))


def upc_digits_only(c) -> Column:
    return F.regexp_replace(col_(c), "[^0-9]", "")


def upc_strip_prefix(c, prefix: str = "cc") -> Column:
    """Drop a leading lower-case 'cc' from a UPC."""
    c = col_(c)
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def upc_same_as_id(upc, pid) -> Column:
    """A UPC equal to the product id is a placeholder: '-1'."""
    upc, pid = col_(upc), col_(pid)
    return F.when(pid == upc, F.lit("-1")).otherwise(upc)


def id_remove_dash(c) -> Column:
    return F.replace(col_(c), F.lit("-"), F.lit(""))


def id_compose(sku, pack) -> Column:
    return F.concat(blank_if_null(sku), F.lit(" - "), blank_if_null(pack))


def desc_compose(brand, desc) -> Column:
    return F.concat(blank_if_null(brand), F.lit(" "), blank_if_null(desc))


def pack_suffix(c, word: str = " Pack") -> Column:
    return F.concat(blank_if_null(c), F.lit(word))


def split_first(c, sep: str = ",") -> Column:
    return F.substring_index(col_(c), sep, 1)


def dept_code_type(c, beer: float, liquor: float, wine: float) -> Column:
    """Department code -> BEER / LIQUOR / WINE / EXTRAS, compared as numbers."""
    n = strict_double(col_(c))
    return (F.when(n == beer, F.lit("BEER")).when(n == liquor, F.lit("LIQUOR"))
            .when(n == wine, F.lit("WINE")).otherwise(F.lit("EXTRAS")))


def price_pack_or_unit(pack, unit) -> Column:
    pack, unit = col_(pack), col_(unit)
    return F.when(pack > 0, pack).otherwise(unit)


def sale_in_window(pack_sale, unit_sale, start, end, as_of) -> Column:
    """Pack sale if > 0, else unit sale if > 0, else 0 -- only inside [start, end]."""
    pack_sale, unit_sale, start, end = map(col_, (pack_sale, unit_sale, start, end))
    ts = F.lit(as_of).cast("timestamp_ntz")
    price = (F.when(pack_sale > 0, pack_sale).when(unit_sale > 0, unit_sale)
             .otherwise(F.lit(0.0)))
    return F.when((ts >= start) & (ts <= end), price).otherwise(F.lit(0.0))


def sale_in_window_diff(regular, sale, start, end, as_of) -> Column:
    """Sale price inside [start, end] and different from the regular price."""
    regular, sale, start, end = map(col_, (regular, sale, start, end))
    ts = F.lit(as_of).cast("timestamp_ntz")
    return F.when((ts >= start) & (ts <= end) & (regular != sale), sale).otherwise(F.lit(0.0))


def sale_flag(flag, sale) -> Column:
    """Sale price only when the on-sale flag is 'T' and the price is > 0."""
    flag, sale = col_(flag), col_(sale)
    return F.when((flag == "T") & (sale > 0), sale).otherwise(F.lit(0.0))


def cents_to_units(c) -> Column:
    return col_(c) / F.lit(100.0)


def as_double(c) -> Column:
    """Number of a column of any type: text goes through ``strict_double``, so
    a bad cell is null and never ends the job."""
    return strict_double(col_(c).cast("string"), exponent=True)


def safe_divide(a, b) -> Column:
    """x / 0, bad text and null operands give null (ANSI-safe)."""
    return F.try_divide(as_double(a), as_double(b))


def integer_text(c) -> Column:
    """A double without its fraction, as plain digits at any size."""
    c = col_(c)
    return (F.when(F.abs(c) < 1e15, F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)).cast("string"))
            .when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None).cast("string"))
            .otherwise(F.format_string("%.0f", c)))


def float_text(c) -> Column:
    """Decimal text of a double the way feeds print it ('3.0', '2.5'); whole
    numbers keep all their digits."""
    c = col_(c)
    return (F.when(c.isNull() | F.isnan(c), F.lit(None))
            .when(c == F.round(c), F.concat(integer_text(c), F.lit(".0")))
            .otherwise(c.cast("string")))


def wholesale_label(c, word: str = " Pack") -> Column:
    """Integer-like text 'N[.x]' -> 'N Pack', anything else -> ''.

    Matches the rule "the part before the first '.' is all digits": the
    number is then truncated to an integer.
    """
    c = col_(c).cast("string")
    head = F.substring_index(c, ".", 1)
    val = strict_double(c)
    ok = head.rlike("^[0-9]+$") & val.isNotNull()
    return F.when(ok, F.concat(integer_text(val), F.lit(word))).otherwise(F.lit(""))


def size_oz(c) -> Column:
    """Number > 1 -> rounded (half-even) to 2 places + 'oz'; number <= 1 -> null;
    text that is not a number stays as it is."""
    c = col_(c)
    n = strict_double(c, exponent=True)
    r = F.bround(n, 2)
    return F.when(n.isNull(), c).when(n > 1, F.concat(float_text(r), F.lit("oz"))).otherwise(F.lit(None).cast("string"))


def coalesce_upc(upc, extra_upc) -> Column:
    return F.coalesce(col_(upc), col_(extra_upc), F.lit(""))


def retail_coalesce(extra_retail, retail, case_retail, case_qty) -> Column:
    return F.coalesce(col_(extra_retail), col_(retail), safe_divide(case_retail, case_qty))


def qty_units(on_hand, qty) -> Column:
    on_hand, qty = col_(on_hand), col_(qty)
    return F.when(qty.isNotNull(), safe_divide(on_hand, qty)).otherwise(as_double(on_hand))


def size_label(size, qty) -> Column:
    size, qty = col_(size), col_(qty)
    return F.when(qty.isNotNull(),
                  F.concat(integer_text(as_double(qty)), F.lit(" Pack "), blank_if_null(size))).otherwise(size)


# Cell texts that read as missing (the defaults of pandas' reader).
NULL_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
              "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def nullify(c) -> Column:
    """Null for a cell whose text means 'missing'."""
    c = col_(c)
    return F.when(~c.isin(NULL_TEXTS), c)


def parse_ts(c, formats=("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd",
                         "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy")) -> Column:
    """Text -> timestamp (no zone) trying several layouts; unparsable -> null.

    A layout that does not fit ends in an exception inside the parser, which costs far more
    than a parse: a layout is tried only on texts that hold all its separators.
    """
    c = col_(c).cast("string")

    def fits(layout):
        plain = layout.replace("'T'", "")
        has = [F.contains(c, F.lit(x)) for x in sorted(set(plain) - set("yMdHms"))]
        if "'T'" in layout:
            has.append(F.contains(F.upper(c), F.lit("T")))
        return reduce(lambda x, y: x & y, has, F.lit(True))

    tries = [F.when(fits(f), F.try_to_timestamp(c, F.lit(f))) for f in formats]
    return F.coalesce(*tries).cast("timestamp_ntz")


def url_unquote(c) -> Column:
    return F.try_url_decode(col_(c))


def path_basename(c) -> Column:
    return F.substring_index(col_(c), "/", -1)
