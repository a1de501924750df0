"""Package-configuration parse as native Spark expressions.

From three free-text columns (description, package size, item size) derive

* ``package_size_num``  -- units per pack (double, never null; default 1.0)
* ``item_size_value`` / ``item_units`` -- size of one unit and its unit
* ``container_type``    -- Aluminum Cans, Glass Bottles, Keg, ...
* ``item_size``         -- printable size, e.g. ``750 ML``
* ``package_configuration`` -- label, e.g. ``6 pack 12 OZ Aluminum Cans``

Each rule family is an ordered cascade: the first rule whose pattern is found
decides, even when its number then fails to parse (the value is null and the
caller falls back to the next text column).  One regex pass marks the number runs
(``marked``), then each rule is a search for a fixed text in the whole marked text
(``first_rule``); no Python runs per row.

Number runs
-----------
A number run is one or more chunks of *(sign)?(dot)?digit*.  Written as a
plain repeated group it backtracks badly and, in Java, recurses once per
chunk (a stack overflow on long digit strings).  Here it is written
possessively and may only start at a chunk boundary.  Both are exact: for a
fixed start the run that precedes a unit word is unique, and the leftmost
match always starts at a boundary.  Matching is linear in the text length,
whole texts are processed, nothing is truncated.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.functions.text import WS_CLASS, col_, integer_text, is_blank, strict_double
from tillflow.session import compiled_methods

# start of a number run: the previous character cannot continue it
_RUN_START = r"(?:(?<![-+.0-9])(?=[0-9])|(?<![-+0-9])(?=\.)|(?<![0-9])(?=[-+]))"
RUN = _RUN_START + r"(?:[-+]?\.?[0-9])++"
# exactly one character (not a line break) between number run and unit word;
# when that character is a digit it was absorbed by the possessive run, which
# then ends in two digits
GAP = r"(?:(?<=[0-9][0-9])|[^0-9\n])"
# three digit groups such as 2/12/16
TRIPLE = r"[0-9][- /.][0-9]*[- /.][0-9]*"

# ---------------------------------------------------------------------------
# Rule tables.  They must equal the source system's rules for
# identical results; order matters (first found wins).
# ---------------------------------------------------------------------------

# Pack count rules on upper-cased text (after '/ PK' -> 'PK').
# (gap, word, drop '/' from the number): gap "" = number directly before the
# word, "any" = one character between, "slash" = '/' and one character.
PACK_RULES = [
    ("slash", "PK", True),
    ("any", "-PK", True),
    ("", "-PK", True),
    ("any", "-PACK", True),
    ("", "-PACK", True),
    ("any", "PK", True),
    ("", "PK", True),
    ("", "-PCK", False),
    ("any", "-PCK", False),
    ("", "PCK", False),
    ("any", "PCK", False),
    ("", "PACK", False),
    ("any", "PACK", False),
    ("triple", None, False),
    ("", "PC", False),
    ("any", "PC", False),
    ("", "NR", False),
    ("any", "NR", False),
    ("any", "BTL", True),
]
PACK_SINGLE_WORDS = ["SINGLE", "SNG", "SGL", "EA", "KEG"]

# Item size: fraction rewrites applied in this order before matching.
ITEM_FRACTIONS = [("1/16", ".0625"), ("1/6", ".167"), ("1/8", ".125"),
                  ("1/4", ".25"), ("1/3", ".333"), ("1/2", ".5")]
# whole words (space-delimited) that give a unit but no size
ITEM_WORDS = [("PINT", "PINT"), ("PT", "PINT"), ("BOMBER", "BOMBER"), ("BOMB", "BOMBER")]
# (word after the number, unit, absolute value); each is tried with the number
# right before the word, then with one character between.  None marks the
# place of the 'M' prefix rule (M, MM, ... followed by a number -> ML).
ITEM_RULES = [
    ("KEG", "KEG", True),
    ("FL OZ", "OZ", False),
    ("FLOZ", "OZ", False),
    ("OZ", "OZ", True),
    ("ML", "ML", True),
    ("LBS", "LB", True),
    ("LB", "LB", True),
    ("GALLON", "GAL", True),
    ("GAL", "GAL", True),
    None,
    ("GL", "GAL", True),
    ("G", "GAL", True),
    ("LITER", "L", True),
    ("LTR", "L", True),
    ("LIT", "L", True),
    ("LT", "L", True),
    ("L", "L", True),
    ("KG", "KG", True),
]
ITEM_PREFIX_M = r"M+([-+]?[0-9]*\.?[0-9]+)"
# literal text anywhere -> (size, unit), last resort
ITEM_LITERALS = [("19.2", 19.2, "OZ"), (".375", 375.0, "ML"), ("375", 375.0, "ML"),
                 ("750", 750.0, "ML"), ("1.75", 1.75, "L"), ("1.5", 1.5, "L")]

# Container rules on ' ' + upper(text) + ' ': (any of these substrings, label)
CONTAINER_RULES = [
    ([" TETRA", "TETR"], "Tetra Pak"),
    ([" CARTO"], "Carto Cans"),
    ([" POUCH"], "Pouch"),
    (["PKCN", "PK CN", "OZCN", "OZ CN", "SGLCN", "SGL CN", "PKC", "PK C", "PC", "OZC",
      "OZ C", "SGLC", "CANS", "CAN", "CNS", "CN"], "Aluminum Cans"),
    (["PKBTL", "PK BTL", "OZBTL", "OZ BTL", "SGLBTL", "SGL BTL", "ML BTL", "MLBTL", "PKB",
      "PK B", "OZB", "OZ B", "SGLB", "BTL", "BOTTLES", "BOTTLE", "ML B", "MLB", "BT",
      "NR ", "LN "], "Bottles"),
    ([" BOXED ", " BOX "], "Bag-in-box"),
    ([" KEG", "KEGS"], "Keg"),
    ([" JUG"], "Jug"),
]
BOTTLE_ALUMINUM_WORDS = [" ALUMINUM", " ALUM"]
BOTTLE_LABELS = ("Aluminum Bottles", "Glass Bottles")

# Special units and the size/unit/container they stand for.
BOMBER_CONFIG = (22.0, "OZ", "Bottles")
PINT_CONFIG = (16.0, "OZ")

# Container guessed from the size when no container word was found.
FILL_ML_BOTTLE_MIN = 500.0
FILL_L_BOTTLE_BELOW = 3.0

# ---------------------------------------------------------------------------


# Marks of a text: one regex pass puts marks around every number run and behind the character that follows it
# (BEGIN run END gap AFTER; no gap at a line's end).  A rule is then a search for a fixed text: END + first letter + AFTER +
# rest where the word follows the run directly, AFTER + word where one character lies between.
_BEGIN, _END, _AFTER, _OTHER = "\u0001", "\u0002", "\u0004", "\u0003"
MARKED = "(" + _RUN_START + r"(?:[-+]?\.?[0-9])++)([^0-9\n]?)"
_NONE = 1 << 20


def marked(t: Column) -> Column:
    """The text with its number runs marked, in one scan; the marks' own characters in a text count as another
    control character.  A run never begins right behind another one, so the character behind it is no run's."""
    plain = F.translate(t, _BEGIN + _END + _AFTER, _OTHER * 3)
    return F.regexp_replace(plain, MARKED, f"{_BEGIN}$1{_END}$2{_AFTER}")


def _direct(word: str) -> str:
    return _END + word[0] + _AFTER + word[1:]


def _rule_mark(gap: str, word: str) -> str:
    """What a marked text holds where a rule without a pattern fits (after the number text)."""
    return _direct(word) if gap == "" else _AFTER + word


def _rule_pattern(rules: list[tuple[int, str, str]], gap: str, word: str) -> str | None:
    """Pattern of the rules that one fixed text does not find; group 1 is the number text with its marks.

    A digit between run and word belongs to the run, which then ends in two digits.  Where the rule without
    a gap comes first in the table it has taken these.
    """
    run = f"[^{_END}]*"
    if gap == "slash":
        return f"{_BEGIN}({run}{_END}/{_AFTER}(?:[^\n{_BEGIN}](?={word})|{_BEGIN}[0-9](?={_direct(word)})))"
    if gap == "any":
        order = [(g, w) for _, g, w in rules]
        if ("", word) not in order[:order.index((gap, word))]:
            return f"{_BEGIN}({run}{_END}[^{_AFTER}]{_AFTER}(?={word})|{run}[0-9][0-9](?={_direct(word)}))"
    return None


def first_rule(m: Column, rules: list[tuple[int, str, str]]) -> Column:
    """Index of the first rule that a marked text fits anywhere."""
    out = F.when(~F.contains(m, F.lit(_END)), F.lit(_NONE))
    for idx, gap, word in rules:
        pattern = _rule_pattern(rules, gap, word)
        cond = F.contains(m, F.lit(_rule_mark(gap, word))) if pattern is None else F.contains(m, F.lit(word[1:])) & m.rlike(pattern)
        out = out.when(cond, F.lit(idx))
    return out.otherwise(F.lit(_NONE))


def number_text(m: Column, idx: Column, rules: list[tuple[int, str, str]]) -> Column:
    """The number text that the materialised ``first_rule`` reads, at the leftmost run that it fits: the run, and
    the character between it and the word where there is one."""
    marks = {i: _rule_mark(gap, word) for i, gap, word in rules}
    by_idx = F.element_at(F.array(*[F.lit(marks.get(i, "")) for i in range(max(marks) + 1)]), idx + 1)
    text = F.substring_index(F.call_function("substring_index", m, by_idx, F.lit(1)), _BEGIN, -1)
    out = F.when(idx == _NONE, F.lit(""))
    for i, gap, word in rules:
        pattern = _rule_pattern(rules, gap, word)
        if pattern is not None:
            out = out.when(idx == i, F.regexp_extract(m, pattern, 1))
    return F.translate(out.otherwise(text), _BEGIN + _END + _AFTER, "")


def _word_rules(table) -> list[tuple[int, str, str]]:
    return [(i, gap, word) for i, (gap, word) in enumerate(table) if gap in ("", "any", "slash")]


# rule order of each family: (gap, word) per position
_PACK_ORDER = [(gap, word) for gap, word, _ in PACK_RULES]
_PACK_TRIPLE = [g for g, _ in _PACK_ORDER].index("triple")
_PACK_SLASH_DROP = [i for i, (_, _, drop) in enumerate(PACK_RULES) if drop]

_ITEM_ORDER: list[tuple[str, str]] = []
_ITEM_META: list[tuple[str, bool]] = []          # (unit, absolute) per position
for _rule in ITEM_RULES:
    if _rule is None:
        _ITEM_ORDER.append(("prefix_m", "M"))
        _ITEM_META.append(("ML", True))
        continue
    for _gap in ("", "any"):
        _ITEM_ORDER.append((_gap, _rule[0]))
        _ITEM_META.append((_rule[1], _rule[2]))
_ITEM_PREFIX = [g for g, _ in _ITEM_ORDER].index("prefix_m")


def pack_text(c) -> Column:
    """Text normalisation of the pack-count rules."""
    return F.upper(F.replace(F.coalesce(col_(c), F.lit("")), F.lit("/ PK"), F.lit("PK")))


def item_text(c) -> Column:
    """Text normalisation of the item-size rules (upper case, fractions)."""
    t = F.upper(F.coalesce(col_(c), F.lit("")))
    for frac, dec in ITEM_FRACTIONS:
        t = F.replace(t, F.lit(frac), F.lit(dec))
    return t


def _size(val: Column, unit) -> Column:
    u = F.lit(unit) if isinstance(unit, str) else unit
    return F.struct(val.cast("double").alias("size"), u.alias("unit"))


def _pick(pos: Column, positions: list[int]) -> Column:
    return pos.isin(*positions) if positions else F.lit(False)


def candidate(m: Column, idx: Column, rules: list[tuple[int, str, str]]) -> Column:
    """struct(idx, text) of a marked text given its materialised ``first_rule``."""
    return F.struct(idx.alias("idx"), number_text(m, idx, rules).alias("text"))


PACK_WORDS, ITEM_WORD_RULES = _word_rules(_PACK_ORDER), _word_rules(_ITEM_ORDER)


def pkg_size_from(t: Column, best: Column) -> Column:
    """Pack count of normalised text ``t`` given its materialised best candidate."""
    idx = best["idx"]
    # three-group rule: 'a/b/c' -> b, else first number before '/'
    tri_found = t.rlike(TRIPLE) & t.rlike("[0-9]/")
    grp = F.regexp_extract(t, TRIPLE, 0)
    parts = F.split(grp, "/")
    tri_val = F.when(F.size(parts) == 3, strict_double(F.try_element_at(parts, F.lit(2)))).otherwise(
        F.regexp_extract(t, "([0-9]+)/", 1).try_cast("double"))
    text = F.when(_pick(idx, _PACK_SLASH_DROP), F.replace(best["text"], F.lit("/"), F.lit(""))).otherwise(best["text"])
    word_val = F.abs(strict_double(text))
    return (F.when(idx < _PACK_TRIPLE, word_val)
            .when(tri_found, tri_val)
            .when(idx < _NONE, word_val)
            .when(t.isin(*PACK_SINGLE_WORDS), F.lit(1.0))
            .otherwise(F.lit(None).cast("double")))


def item_size_from(t: Column, padded: Column, best: Column) -> Column:
    """struct<size, unit> of normalised text ``t`` (``padded`` = ' ' + t + ' ')
    given its materialised best candidate.

    No match gives (null, ''); a word such as PINT gives (null, 'PINT').
    """
    idx = best["idx"]
    units = F.array(*[F.lit(u) for u, _ in _ITEM_META])
    absolute = [i for i, (_, a) in enumerate(_ITEM_META) if a]
    num = strict_double(best["text"])
    word_size = _size(F.when(_pick(idx, absolute), F.abs(num)).otherwise(num), F.element_at(units, idx + 1))
    m_size = _size(F.abs(F.regexp_extract(t, ITEM_PREFIX_M, 1).try_cast("double")), "ML")
    out = None
    for word, unit in ITEM_WORDS:
        cond = padded.contains(" " + word + " ")
        val = _size(F.lit(None), unit)
        out = F.when(cond, val) if out is None else out.when(cond, val)
    out = (out.when(idx < _ITEM_PREFIX, word_size)
           .when(t.rlike(ITEM_PREFIX_M), m_size)
           .when(idx < _NONE, word_size))
    for lit_text, size, unit in ITEM_LITERALS:
        out = out.when(t.contains(lit_text), _size(F.lit(size), unit))
    return out.otherwise(_size(F.lit(None), ""))


def with_pkg_size_rule(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out`` = pack count found in text column ``src`` (null when none)."""
    compiled_methods(df.sparkSession)
    t, m, i, c = "_pkt_" + out, "_pkm_" + out, "_pki_" + out, "_pkc_" + out
    df = df.withColumn(t, pack_text(F.col(src)))
    df = df.withColumn(m, marked(F.col(t)))
    df = df.withColumn(i, first_rule(F.col(m), PACK_WORDS))
    df = df.withColumn(c, candidate(F.col(m), F.col(i), PACK_WORDS))
    return df.withColumn(out, pkg_size_from(F.col(t), F.col(c))).drop(t, m, i, c)


def with_item_size_rule(df: DataFrame, src: str, out: str) -> DataFrame:
    """Add ``out`` = struct<size double, unit string> found in ``src``."""
    compiled_methods(df.sparkSession)
    t, m, i, q, c = "_itt_" + out, "_itm_" + out, "_iti_" + out, "_itq_" + out, "_itc_" + out
    df = df.withColumn(t, item_text(F.col(src)))
    df = df.withColumn(m, marked(F.col(t)))
    df = df.withColumn(i, first_rule(F.col(m), ITEM_WORD_RULES))
    df = df.withColumns({q: F.concat(F.lit(" "), F.col(t), F.lit(" ")), c: candidate(F.col(m), F.col(i), ITEM_WORD_RULES)})
    return df.withColumn(out, item_size_from(F.col(t), F.col(q), F.col(c))).drop(t, m, i, q, c)


def container_text(c) -> Column:
    """' ' + upper(text) + ' ', the text the container rules search."""
    return F.concat(F.lit(" "), F.upper(F.coalesce(col_(c), F.lit(""))), F.lit(" "))


def container_rule(c, padded: Column | None = None) -> Column:
    """Container label found in one text column (null when none).  Pass the
    materialised ``container_text`` as ``padded`` to avoid recomputing it."""
    padded = container_text(c) if padded is None else padded

    def any_of(words):
        cond = None
        for w in words:
            cond = padded.contains(w) if cond is None else (cond | padded.contains(w))
        return cond

    out = None
    for words, label in CONTAINER_RULES:
        if label == "Bottles":
            value = F.when(any_of(BOTTLE_ALUMINUM_WORDS), F.lit(BOTTLE_LABELS[0])).otherwise(
                F.lit(BOTTLE_LABELS[1]))
        else:
            value = F.lit(label)
        out = F.when(any_of(words), value) if out is None else out.when(any_of(words), value)
    return out.otherwise(F.lit(None).cast("string"))


def with_container_rule(df: DataFrame, src: str, out: str) -> DataFrame:
    tmp = "_ctt_" + out
    df = df.withColumn(tmp, container_text(F.col(src)))
    return df.withColumn(out, container_rule(None, F.col(tmp))).drop(tmp)


def _pair(size: Column, unit: Column) -> Column:
    return F.struct(size.cast("double").alias("size"), unit.alias("unit"))


def size_standardise(size: Column, unit: Column) -> Column:
    """L below 1 -> ML x 1000; ML from 1000 -> L / 1000."""
    return (F.when((F.upper(unit) == "L") & (size < 1.0), _pair(size * 1000.0, F.lit("ML")))
            .when((F.upper(unit) == "ML") & (size >= 1000.0), _pair(size / 1000.0, F.lit("L")))
            .otherwise(_pair(size, unit)))


def size_number_text(size: Column) -> Column:
    """Printed number of an item size: whole numbers without '.0'."""
    return (F.when(size.isNull() | F.isnan(size), F.lit(""))
            .when(size == F.round(size), integer_text(size))
            .otherwise(size.cast("string")))


def pack_count_text(n: Column) -> Column:
    """Integer part of the pack count as text, at any size."""
    return integer_text(n)


def item_size_pick(it_item: Column, it_pkg: Column, it_desc: Column) -> Column:
    """Item size from the item-size text, else package text, else description.

    A found unit with no number falls through to the next text (its unit is
    lost), so PINT / BOMBER only take effect from the description.
    """
    return (F.when(it_item.getField("size").isNotNull(), it_item)
            .when(it_pkg.getField("size").isNotNull(), it_pkg)
            .otherwise(it_desc))


def special_config(size: Column, unit: Column, container: Column) -> Column:
    """BOMBER -> 22 OZ Bottles; PINT -> 16 OZ; others unchanged."""
    return (F.when(unit == "BOMBER", F.struct(F.lit(BOMBER_CONFIG[0]).alias("size"), F.lit(BOMBER_CONFIG[1]).alias("unit"),
                                              F.lit(BOMBER_CONFIG[2]).alias("container")))
            .when(unit == "PINT", F.struct(F.lit(PINT_CONFIG[0]).alias("size"), F.lit(PINT_CONFIG[1]).alias("unit"),
                                           container.alias("container")))
            .otherwise(F.struct(size.alias("size"), unit.alias("unit"), container.alias("container"))))


def container_fill(container: Column, size: Column, unit: Column) -> Column:
    """Container guessed from the size when none was found."""
    return (F.when(F.coalesce(container, F.lit("")) != "", container)
            .when((size >= FILL_ML_BOTTLE_MIN) & (unit == "ML"), F.lit("Bottles"))
            .when((unit == "L") & (size < FILL_L_BOTTLE_BELOW), F.lit("Bottles"))
            .when(unit == "LB", F.lit("Bag"))
            .otherwise(F.lit("")))


def package_label(n: Column, item_size: Column, container: Column) -> Column:
    """'N pack[ size][ container]', blank parts left out."""
    n = pack_count_text(n)
    return (F.when(is_blank(item_size) & is_blank(container), F.concat(n, F.lit(" pack")))
            .when(is_blank(container), F.concat(n, F.lit(" pack "), item_size))
            .when(is_blank(item_size), F.concat(n, F.lit(" pack "), container))
            .otherwise(F.concat(n, F.lit(" pack "), item_size, F.lit(" "), container)))


_MARKS = [f"_{kind}_{t}" for kind in "mn" for t in ("tp_d", "tp_p", "ti_i", "ti_d", "ti_p")]
_TEMP = ["_tp_d", "_tp_p", "_ti_i", "_ti_p", "_ti_d", "_tc_i", "_tc_p", "_tc_d", "_tq_i", "_tq_p", "_tq_d",
         "_c_pk_d", "_c_pk_p", "_c_it_i", "_c_it_p", "_c_it_d", "_pk_d", "_pk_p", "_it_i", "_it_p", "_it_d",
         "_ct_i", "_ct_p", "_ct_d", "_item", "_ct", "_sp"]


# Column expressions are unresolved and reusable across DataFrames; building
# them is thousands of Python->JVM calls, so each stage is built once.

@lru_cache(maxsize=None)
def _stage0_exprs(description: str, package_size: str, item_size: str) -> tuple:
    """Normalised texts, each computed once per row."""
    d, p, i = F.col(description), F.col(package_size), F.col(item_size)
    return (pack_text(d).alias("_tp_d"), pack_text(p).alias("_tp_p"),
            item_text(i).alias("_ti_i"), item_text(p).alias("_ti_p"), item_text(d).alias("_ti_d"),
            container_text(i).alias("_tc_i"), container_text(p).alias("_tc_p"), container_text(d).alias("_tc_d"))


@lru_cache(maxsize=None)
def _mark_exprs() -> tuple[tuple, ...]:
    """Marks and first rules of the texts, in steps that each read materialised columns.  The description and the
    package text are scanned once for both rule families; the item family scans again only where its
    normalised text differs (a fraction, or '/ PK')."""
    c = F.col
    marks = tuple(marked(c(f"_{t}")).alias(f"_m_{t}") for t in ("tp_d", "tp_p", "ti_i"))
    again = tuple(F.when(c(f"_ti_{x}") != c(f"_tp_{x}"), marked(c(f"_ti_{x}"))).otherwise(c(f"_m_tp_{x}")).alias(f"_m_ti_{x}")
                  for x in "dp")
    rules = (*(first_rule(c(f"_m_tp_{x}"), PACK_WORDS).alias(f"_n_tp_{x}") for x in "dp"),
             *(first_rule(c(f"_m_ti_{x}"), ITEM_WORD_RULES).alias(f"_n_ti_{x}") for x in "idp"))
    return marks, again, rules


@lru_cache(maxsize=None)
def _stage1_exprs() -> tuple:
    """Number text of the first rule per text."""
    c = F.col
    return (*(candidate(c(f"_m_tp_{x}"), c(f"_n_tp_{x}"), PACK_WORDS).alias(f"_c_pk_{x}") for x in "dp"),
            *(candidate(c(f"_m_ti_{x}"), c(f"_n_ti_{x}"), ITEM_WORD_RULES).alias(f"_c_it_{x}") for x in "ipd"),
            *(F.concat(F.lit(" "), c(f"_ti_{x}"), F.lit(" ")).alias(f"_tq_{x}") for x in "ipd"))


@lru_cache(maxsize=None)
def _stage2_exprs() -> tuple:
    """Rule values per text column."""
    c = F.col
    return (pkg_size_from(c("_tp_d"), c("_c_pk_d")).alias("_pk_d"),
            pkg_size_from(c("_tp_p"), c("_c_pk_p")).alias("_pk_p"),
            item_size_from(c("_ti_i"), c("_tq_i"), c("_c_it_i")).alias("_it_i"),
            item_size_from(c("_ti_p"), c("_tq_p"), c("_c_it_p")).alias("_it_p"),
            item_size_from(c("_ti_d"), c("_tq_d"), c("_c_it_d")).alias("_it_d"),
            container_rule(None, c("_tc_i")).alias("_ct_i"), container_rule(None, c("_tc_p")).alias("_ct_p"),
            container_rule(None, c("_tc_d")).alias("_ct_d"))


def parse_package(df: DataFrame, description: str = "rt_brand_description",
                  package_size: str = "rt_package_size",
                  item_size: str = "rt_item_size", keep_steps: bool = False) -> DataFrame:
    """Add the six parsed columns to ``df`` (narrow: no shuffle, no Python).

    Each rule family runs once per text column; then pick (item size ->
    package size -> description), standardise, special units, container fill,
    printed size and label.
    """
    compiled_methods(df.sparkSession)
    out = df.select("*", *_stage0_exprs(description, package_size, item_size))
    for step in _mark_exprs():
        out = out.select("*", *step)
    out = out.select("*", *_stage1_exprs()).drop(*_MARKS)
    out = out.select("*", *_stage2_exprs())
    out = out.withColumn("_pick", item_size_pick(F.col("_it_i"), F.col("_it_p"), F.col("_it_d")))
    picked = F.col("_pick")
    out = out.withColumns({
        "package_size_num": F.coalesce(F.col("_pk_d"), F.col("_pk_p"), F.lit(1.0)),
        "_item": size_standardise(picked.getField("size"), picked.getField("unit")),
        "_ct": F.coalesce(F.col("_ct_i"), F.col("_ct_p"), F.col("_ct_d")),
    })
    out = out.withColumn("_sp", special_config(F.col("_item.size"), F.col("_item.unit"), F.col("_ct")))
    size, unit = F.col("_sp.size"), F.col("_sp.unit")
    out = out.withColumns({
        "item_size_value": size,
        "item_units": unit,
        "container_type": container_fill(F.col("_sp.container"), size, unit),
        "item_size": F.concat(size_number_text(size), F.lit(" "), unit),
    })
    out = out.withColumn("package_configuration",
                         package_label(F.col("package_size_num"), F.col("item_size"), F.col("container_type")))
    if keep_steps:
        # intermediate steps, for inspection: picked size (before
        # standardising), standardised size, picked container
        return out.withColumnsRenamed({"_pick": "step_item_pick", "_item": "step_item_std",
                                       "_ct": "step_container_pick"}).drop(*_TEMP)
    return out.drop(*_TEMP, "_pick")


__all__ = ["with_pkg_size_rule", "with_item_size_rule", "with_container_rule", "container_rule",
           "parse_package", "size_standardise", "size_number_text", "item_size_pick",
           "special_config", "container_fill", "package_label", "WS_CLASS"]
